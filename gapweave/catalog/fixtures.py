"""Inputs of the registered queries, all whole tables of the test data.

* register: four tables read as extracts of one equipment register. They drift apart in columns and
  date formats, so the union has natural nulls.
* records:  all documents with the quality label that some of them have. Those without are the
  incomplete target, those with one the master.
* vectors:  all embeddings, and one centroid per label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.functions.text import quoted
from gapweave.operators.combine import union_by_name
from gapweave.operators.encode import mean_pool
from gapweave.operators.scoring import MASTER_KEY, TARGET_KEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Equipment"),
        F.col("p_name").alias("Equipment description"),
        F.col("p_type").alias("ObjectType"),
        F.col("p_brand").alias("Manufacturer of Asset"),
        F.col("p_size").cast("string").alias("Size"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Equipment"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Created on"),
        F.col("o_orderpriority").alias("ObjectType"),
    )
    lineitem = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("Equipment"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("Chngd On"),
        F.col("l_suppkey").cast("string").alias("Manufacturer of Asset"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Equipment"),
        F.col("c_name").alias("Equipment description"),
        F.col("c_mktsegment").alias("ObjectType"),
        F.col("c_nationkey").cast("string").alias("Nation"),
    )
    return {"part": part, "orders": orders, "lineitem": lineitem, "customer": customer}


REGISTER_SQL = """
part_extract AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "Equipment", p_name AS "Equipment description",
         p_type AS "ObjectType", p_brand AS "Manufacturer of Asset", CAST(p_size AS VARCHAR) AS "Size"
  FROM part),
orders_extract AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Equipment",
         strftime(o_orderdate, '%Y-%m-%d') AS "Created on", o_orderpriority AS "ObjectType"
  FROM orders),
lineitem_extract AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "Equipment",
         strftime(l_shipdate, '%m/%d/%Y') AS "Chngd On",
         CAST(l_suppkey AS VARCHAR) AS "Manufacturer of Asset"
  FROM lineitem),
customer_extract AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "Equipment", c_name AS "Equipment description",
         c_mktsegment AS "ObjectType", CAST(c_nationkey AS VARCHAR) AS "Nation"
  FROM customer),
register AS (
  SELECT * FROM part_extract UNION ALL BY NAME SELECT * FROM orders_extract
  UNION ALL BY NAME SELECT * FROM lineitem_extract UNION ALL BY NAME SELECT * FROM customer_extract)
"""


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_by_name(list(extracts(spark, sf_dir).values()))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("equipment_type"))
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("equipment_description"))
    return documents.join(labels, "doc_id", "left").select("doc_id", "equipment_type", "equipment_description")


def record_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Master: documents with a label. Target: all documents."""
    everything = records(spark, sf_dir)
    return everything.where("equipment_type is not null"), everything


RECORDS_SQL = r"""
records AS (
  SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS equipment_type, d.text AS equipment_description
  FROM documents d LEFT JOIN labels l USING (doc_id)),
texts AS (
  SELECT doc_id, equipment_type,
         trim(regexp_replace(
           CASE WHEN equipment_type IS NOT NULL THEN 'Type: ' || equipment_type || ' | ' ELSE '' END
           || 'Description: ' || equipment_description, '\s+', ' ', 'g')) AS text
  FROM records)
"""

MATCHES_SQL = (
    RECORDS_SQL
    + """,
counts AS (
  SELECT doc_id, equipment_type IS NULL AS incomplete, token, count(*) AS n
  FROM (SELECT doc_id, equipment_type, unnest(string_split(lower(text), ' ')) AS token FROM texts)
  WHERE token <> '' GROUP BY ALL),
weights AS (
  SELECT doc_id, incomplete, token, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS w FROM counts),
scores AS (
  SELECT t.doc_id AS target_key, m.doc_id AS master_key, round(sum(t.w * m.w), 6) AS score
  FROM weights t JOIN weights m USING (token)
  WHERE t.incomplete AND NOT m.incomplete GROUP BY ALL),
best AS (
  SELECT * FROM scores WHERE score >= 0.75
  QUALIFY row_number() OVER (PARTITION BY target_key ORDER BY score DESC, master_key) = 1),
completed AS (
  SELECT r.doc_id, coalesce(r.equipment_type, m.equipment_type) AS equipment_type,
         r.equipment_description, b.score AS equipment_type_similarity_score,
         CAST(NULL AS DOUBLE) AS equipment_description_similarity_score
  FROM records r LEFT JOIN best b ON r.doc_id = b.target_key
  LEFT JOIN records m ON b.master_key = m.doc_id)
"""
)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")


def vector_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors as targets and as masters."""
    df = vectors(spark, sf_dir)
    return (
        df.select(quoted("vec_id").alias(TARGET_KEY), "vector"),
        df.select(quoted("vec_id").alias(MASTER_KEY), "vector"),
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector per label; labels are 0, 1, ..."""
    return mean_pool(vectors(spark, sf_dir), "label", "vector").select(
        F.col("label").alias("cell"), F.col("vector").alias("centroid")
    )


VECTORS_SQL = """
vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
means AS (
  SELECT label, pos, avg(x) AS x
  FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
               unnest(range(len(embedding))) AS pos FROM embeddings)
  GROUP BY ALL),
raw_centroids AS (SELECT label AS cell, list(x ORDER BY pos) AS c FROM means GROUP BY label),
centroids AS (
  SELECT cell, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS c FROM raw_centroids)
"""
