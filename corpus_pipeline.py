"""The pipeline over `documents`, stage by stage; each stage is one operator of `gapweave.llm`.

1. quality: documents that importance resampling does not draw go.
2. near duplicates: of the documents that n-gram Jaccard links connect, the one with the smallest id stays.
3. secrets: every span that the secret scan finds is replaced by a mark; n_chars follows.
4. mix: the files are put in the order of the mix of their sources.
5. bpe: the texts are encoded; every row has its place in the mix, and sorting by `mix_position` gives the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm import bpe, jaccard, mixing, quality, queries, secrets
from gapweave.storage import materialize, scratch_path, ship_package


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): the other columns as one value, whose names then meet none of a stage's own; the text once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select((F.struct(*others) if others else F.lit(0)).alias("doc"), "doc_id", "text")


def _unpacked(rows: DataFrame, columns: list[str], changed: dict | None = None) -> DataFrame:
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")} | (changed or {})
    return rows.select(*(own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are drawn; those with a null id are judged like an empty id.

    All columns stay as they are, whatever their names. An empty table stays empty.
    """
    ship_package(spark)
    drawn = quality.resample(docs, queries.good_documents(spark, sf_dir)).where("selected").select("doc_id").distinct()
    return docs.alias("d").join(drawn.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component: that of the smallest id and, of rows with that id, the smallest text hash.

    Rows are judged by their own texts, whether or not their ids repeat. Rows with a null id, and rows whose text has no
    words, link with nothing and stay. All columns stay as they are, whatever their names. An empty table stays empty.
    """
    ship_package(spark)
    # Written, so that the numbers stay with their rows.
    rows = materialize(_packed(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id IS NOT NULL")
    order = named.select("row", F.struct("doc_id", F.xxhash64("text").alias("hash"), "row").alias("order"))
    found = jaccard.similar_documents(named.select("row", "text"), id_column="row").select("row", "component_id")
    first = found.join(order, "row").groupBy("component_id").agg(F.min("order").alias("order"))
    kept = named.join(first.select("order.row"), "row", "left_semi")
    return _unpacked(rows.where("doc_id IS NULL").unionByName(kept), docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; n_chars of a changed text is its new length.

    Null texts stay null, other columns stay as they are, whatever their names. An empty table stays empty.
    """
    ship_package(spark)
    before = _packed(docs).withColumn("doc", F.struct("doc", F.xxhash64("text").alias("text_hash")))
    clean = secrets.redact_documents(before, scratch_path(spark, "ledger"))
    changed = F.col("doc.text_hash") != F.xxhash64("text")
    length = F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("doc.doc.n_chars"))
    return _unpacked(clean.select("doc.doc", "doc_id", "text", length.alias("length")), docs.columns, {"n_chars": F.col("length")})


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the files in the order of the mix. A reader may lose that order; `bpe_stage` does not rely on it.

    Columns stay as they are; names that begin with `mix_` may clash with those of the mix and are then refused.
    """
    return mixing.in_mix_order(mix_places(docs)).select(*docs.columns)


def mix_places(docs: DataFrame) -> DataFrame:
    """All documents with their places in the mix, which depend on the rows alone, not on their order.

    Every source has a weight of its own; those that `MIX_WEIGHTS` does not list share the weight of `"*"` evenly.
    """
    return mixing.mix(docs, mixing.each_source(docs, queries.MIX_WEIGHTS), queries.MIX_BLOCK_ROWS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of every document, with its slot and position in the mix.

    Other columns go, but those named like the ones of the mix are refused. A null text counts as empty; an empty table
    stays empty.
    """
    ship_package(spark)
    ranks = bpe.RankMap(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    # The place goes through the encoder with the id, so repeated and null ids keep their own; texts are read twice.
    placed = mix_places(docs).select(F.struct("doc_id", "mix_slot", "mix_position").alias("place"), "text")
    encoded = bpe.encode(materialize(placed, "places"), ranks, "place")
    return encoded.select(
        "place.*",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("bpe", bpe_stage),
]

#: The quality model and the similarity join are beyond SQL; the tests hold `run` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
