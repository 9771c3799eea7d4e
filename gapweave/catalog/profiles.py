"""Queries on profiles, scalar functions and type narrowing, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.catalog.fixtures import (
    RECORDS_SQL,
    REGISTER_SQL,
    extracts,
    records,
    register,
    table,
    vectors,
)
from gapweave.config import DATE_FORMATS, FIELDS, REQUIRED_COLUMNS
from gapweave.functions.dates import parse_date
from gapweave.functions.text import combine_fields, normalize_text, quoted, truncate_tokens
from gapweave.functions.vectors import cast_vector, l2_normalize
from gapweave.operators.combine import combination_stats, project_required
from gapweave.operators.narrow import (
    dictionary_encode,
    narrow_floats,
    narrow_integers,
    narrow_schema,
    narrowed_footprint,
    narrowing_decisions,
)
from gapweave.operators.profile import (
    cardinality_ratio,
    column_info,
    completeness,
    footprint,
    footprint_reduction,
    footprint_summary,
    missing_field_census,
    sample_values,
)
from gapweave.operators.report import combination_text, processing_report, reduction_text
from gapweave.plans.consolidate import combine, consolidate
from gapweave.storage import materialize


def census(spark, sf):
    return missing_field_census(records(spark, sf), FIELDS)


def normalized_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalize_text(F.col("text")).alias("text"))


def combined_fields(spark, sf):
    text = combine_fields({"Type": F.col("equipment_type"), "Description": F.col("equipment_description")})
    return records(spark, sf).select("doc_id", text.alias("text"))


def truncated(spark, sf):
    return table(spark, sf, "documents").select("doc_id", truncate_tokens(F.col("text"), 512).alias("text"))


def parsed_dates(spark, sf):
    sources = extracts(spark, sf)
    raw = (
        sources["orders"].select(quoted("Created on").alias("raw"))
        .unionByName(sources["lineitem"].select(quoted("Chngd On").alias("raw")))
        .unionByName(sources["customer"].select(F.col("ObjectType").alias("raw")))
        .unionByName(sources["part"].select(F.lit(None).cast("string").alias("raw")))
    )
    parsed = raw.groupBy("raw").agg(F.count("*").alias("n"))
    return parsed.select("raw", "n", parse_date(F.col("raw"), DATE_FORMATS).alias("parsed"))


def normalized_vectors(spark, sf):
    scaled = F.transform("vector", lambda x: x.cast("double") * F.col("label"))
    unit = vectors(spark, sf).select("vec_id", F.posexplode(l2_normalize(scaled)).alias("pos", "x"))
    return unit.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


def cast_vectors(spark, sf):
    thirds = F.transform("vector", lambda x: x.cast("double") / 3)
    narrow = vectors(spark, sf).select("vec_id", F.posexplode(cast_vector(thirds)).alias("pos", "x"))
    return narrow.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.col("x").cast("double").alias("x"))


def _totals(df, columns):
    """Narrowed type and total of each column, which shows that no value changed."""
    sums = df.groupBy().agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(dict(df.dtypes)[c]).alias("type"),
            F.round(c, 2).alias("total"),
        )
        for c in columns
    ]
    return sums.select(F.inline(F.array(*cells)))


_INTEGERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_DOUBLES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def narrowed_integers(spark, sf):
    return _totals(narrow_integers(table(spark, sf, "lineitem")), _INTEGERS)


def narrowed_floats(spark, sf):
    return _totals(narrow_floats(table(spark, sf, "lineitem")), _DOUBLES)


def encoded(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return dictionary_encode(orders, ["o_orderpriority", "o_orderstatus"], spread="o_orderkey")


def _narrowed(df):
    return narrow_schema(df, ("created_on", "changed_on"), DATE_FORMATS)


def narrowed_schema(spark, sf):
    # Stored, because deciding and casting read the de-duplicated table twice.
    before = materialize(combine([register(spark, sf)]), "combined")
    return narrowing_decisions(before, _narrowed(before))


def _part_reduction(spark, sf):
    part = table(spark, sf, "part")
    return footprint_reduction(footprint(part), narrowed_footprint(_narrowed(part)))


def report_lines(spark, sf):
    kept = project_required(register(spark, sf), REQUIRED_COLUMNS).dropDuplicates()
    stats = combination_stats(list(extracts(spark, sf).values()), kept)
    return combination_text(stats).unionByName(reduction_text(_part_reduction(spark, sf)))


def processing(spark, sf):
    kept = project_required(register(spark, sf), REQUIRED_COLUMNS).dropDuplicates()
    return processing_report(kept, combination_stats(list(extracts(spark, sf).values()), kept))


QUERIES = {
    "missing_field_census": census,
    "profile_completeness": lambda spark, sf: completeness(register(spark, sf)),
    "profile_columns": lambda spark, sf: column_info(table(spark, sf, "lineitem")),
    "profile_samples": lambda spark, sf: sample_values(register(spark, sf)),
    "cardinality_ratio": lambda spark, sf: cardinality_ratio(register(spark, sf)),
    "column_footprint": lambda spark, sf: footprint(table(spark, sf, "lineitem")),
    "footprint_summary": lambda spark, sf: footprint_summary(table(spark, sf, "lineitem")),
    "footprint_reduction": _part_reduction,
    "normalize_text": normalized_text,
    "combine_fields": combined_fields,
    "truncate_tokens": truncated,
    "parse_dates": parsed_dates,
    "l2_normalize": normalized_vectors,
    "cast_vectors": cast_vectors,
    "narrow_integers": narrowed_integers,
    "narrow_floats": narrowed_floats,
    "dictionary_encode": encoded,
    "narrow_schema": narrowed_schema,
    "report_text": report_lines,
    "processing_report": processing,
    "consolidate": lambda spark, sf: consolidate(list(extracts(spark, sf).values())),
}

_REGISTER_COLUMNS = (
    "Chngd On",
    "Created on",
    "Equipment",
    "Equipment description",
    "Manufacturer of Asset",
    "Nation",
    "ObjectType",
    "Size",
)
_LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
_WIDTH = {"bigint": 8, "int": 4, "double": 8, "timestamp_ntz": 8}


def _each(columns, select):
    return " UNION ALL ".join(select(c) for c in columns)


def _facts(columns, source):
    return _each(
        columns,
        lambda c: f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(\"{c}\") AS non_null_count, "
        f'count(DISTINCT "{c}") AS unique_values FROM {source}',
    )


def _integer_type(low, high):
    return (
        f"CASE WHEN {low} >= -128 AND {high} <= 127 THEN 'tinyint' "
        f"WHEN {low} >= -32768 AND {high} <= 32767 THEN 'smallint' "
        f"WHEN {low} >= -2147483648 AND {high} <= 2147483647 THEN 'int' ELSE 'bigint' END"
    )


def _faithful(c):
    return f"bool_and(abs(CAST(CAST({c} AS FLOAT) AS DOUBLE) - {c}) <= 5e-4)"


_LINEITEM_BYTES = _each(
    _LINEITEM,
    lambda c: f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", "
    + (f"sum(strlen({c}))" if _LINEITEM[c] == "string" else f"count({c}) * {_WIDTH[_LINEITEM[c]]}")
    + "::BIGINT AS bytes FROM lineitem",
)

_PARSED = (
    "coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y-%m-%d'), "
    "try_strptime(raw, '%m/%d/%Y'), try_strptime(raw, '%d.%m.%Y'))"
)

_KEPT_SQL = """
kept AS (
  SELECT DISTINCT "Equipment", "Equipment description", "Created on", "Chngd On", "ObjectType",
         "Manufacturer of Asset" FROM register)
"""

_CONSOLIDATED_SQL = f"""
consolidated AS (
  SELECT "Equipment" AS equipment_number, "Equipment description" AS "Equipment Description",
         {_PARSED.replace('raw', '"Created on"')} AS created_on,
         {_PARSED.replace('raw', '"Chngd On"')} AS changed_on,
         "ObjectType" AS "Equipment Type", "Manufacturer of Asset" AS manufacturer
  FROM kept)
"""

_REDUCTION_SQL = f"""
widths AS (
  SELECT CASE {_integer_type('min(p_partkey)', 'max(p_partkey)')}
           WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 ELSE 8 END AS partkey,
         CASE {_integer_type('min(p_size)', 'max(p_size)')}
           WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 ELSE 4 END AS size,
         CASE WHEN {_faithful('p_retailprice')} THEN 4 ELSE 8 END AS price, count(*) AS n
  FROM part),
reduction AS (
  SELECT 'p_partkey' AS "column", n * 8 AS bytes_before, n * partkey AS bytes_after FROM widths
  UNION ALL SELECT 'p_size', n * 4, n * size FROM widths
  UNION ALL SELECT 'p_retailprice', n * 8, n * price FROM widths
  UNION ALL {_each(('p_name', 'p_brand', 'p_type'), lambda c: f'''
    SELECT '{c}', (SELECT sum(strlen({c})) FROM part),
           CASE WHEN d.k < 0.5 * w.n
                THEN w.n * (CASE WHEN d.k <= 127 THEN 1 WHEN d.k <= 32767 THEN 2 ELSE 4 END) + d.b
                ELSE (SELECT sum(strlen({c})) FROM part) END
    FROM widths w, (SELECT count(*) AS k, sum(strlen({c})) AS b FROM (SELECT DISTINCT {c} FROM part)) d''')})
"""

ORACLE = {
    "missing_field_census": f"""
        WITH {RECORDS_SQL}, n AS (
          SELECT 'equipment_type' AS field, count(*) - count(equipment_type) AS missing FROM records
          UNION ALL SELECT 'equipment_description', count(*) - count(equipment_description) FROM records)
        SELECT * FROM n WHERE missing > 0""",
    "profile_completeness": f"""
        WITH {REGISTER_SQL}, facts AS ({_facts(_REGISTER_COLUMNS, 'register')})
        SELECT "column", non_null_count, "rows" - non_null_count AS null_count,
               round(non_null_count * 100.0::DOUBLE / "rows", 2) AS completeness_percent FROM facts""",
    "profile_columns": f"""
        WITH facts AS ({_facts(_LINEITEM, 'lineitem')}),
        kinds AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{k}')" for c, k in _LINEITEM.items())})
                  AS k("column", data_type))
        SELECT "column", data_type, unique_values, non_null_count,
               round(("rows" - non_null_count) * 100.0::DOUBLE / "rows", 2) AS null_percentage
        FROM facts JOIN kinds USING ("column")""",
    "profile_samples": f"""
        WITH {REGISTER_SQL}, pairs AS ({_each(_REGISTER_COLUMNS, lambda c:
          f'''SELECT DISTINCT '{c}' AS "column", "{c}" AS value FROM register WHERE "{c}" IS NOT NULL''')})
        SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY value) AS position, value
        FROM pairs QUALIFY position <= 5""",
    "cardinality_ratio": f"""
        WITH {REGISTER_SQL}, facts AS ({_facts(_REGISTER_COLUMNS, 'register')})
        SELECT "column", unique_values, "rows",
               round(unique_values / CAST("rows" AS DOUBLE), 6) AS ratio,
               unique_values / CAST("rows" AS DOUBLE) < 0.5 AS category_first_pass,
               unique_values / CAST("rows" AS DOUBLE) < 0.3 AS category_second_pass FROM facts""",
    "column_footprint": _LINEITEM_BYTES,
    "footprint_summary": f"""
        WITH facts AS ({_LINEITEM_BYTES})
        SELECT round(sum(bytes) / 1048576.0::DOUBLE, 2) AS total_mb,
               round(sum(bytes) / 1024.0::DOUBLE / max("rows"), 3) AS kb_per_row,
               max("rows") AS "rows", {len(_LINEITEM)}::BIGINT AS columns FROM facts""",
    "footprint_reduction": f"""
        WITH {_REDUCTION_SQL}
        SELECT "column", bytes_before::BIGINT AS bytes_before, bytes_after::BIGINT AS bytes_after,
               round((bytes_before - bytes_after) * 100.0::DOUBLE / bytes_before, 1) AS reduction_percent
        FROM reduction""",
    "normalize_text": r"""
        SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents""",
    "combine_fields": """
        SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN 'Type: ' || l.quality || ' | ' ELSE '' END
               || 'Description: ' || d.text AS text
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "truncate_tokens": r"""
        SELECT doc_id, array_to_string(
          list_slice(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), 1, 512), ' ') AS text
        FROM documents""",
    "parse_dates": f"""
        WITH {REGISTER_SQL}, texts AS (
          SELECT "Created on" AS raw FROM orders_extract UNION ALL SELECT "Chngd On" FROM lineitem_extract
          UNION ALL SELECT "ObjectType" FROM customer_extract
          UNION ALL SELECT CAST(NULL AS VARCHAR) FROM part_extract)
        SELECT raw, count(*) AS n, {_PARSED} AS parsed FROM texts GROUP BY raw""",
    "l2_normalize": """
        WITH scaled AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * label) AS v FROM embeddings),
        norms AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM scaled)
        SELECT vec_id, unnest(range(len(v))) AS pos,
               round(unnest(list_transform(v, lambda x: CASE WHEN n > 0 THEN x / n ELSE x END)), 6) AS x
        FROM norms""",
    "cast_vectors": """
        SELECT vec_id, unnest(range(len(embedding))) AS pos,
               unnest(list_transform(embedding, lambda x: (x::DOUBLE / 3)::FLOAT::DOUBLE)) AS x
        FROM embeddings""",
    "narrow_integers": _each(
        _INTEGERS,
        lambda c: f"SELECT '{c}' AS \"column\", {_integer_type(f'min({c})', f'max({c})')} AS type, "
        f"round(sum({c})::DOUBLE, 2) AS total FROM lineitem",
    ),
    "narrow_floats": _each(
        _DOUBLES,
        lambda c: f"SELECT '{c}' AS \"column\", CASE WHEN {_faithful(c)} THEN 'float' ELSE 'double' END AS type, "
        f"round(CASE WHEN {_faithful(c)} THEN sum(CAST(CAST({c} AS FLOAT) AS DOUBLE)) ELSE sum({c}) END, 2) "
        "AS total FROM lineitem",
    ),
    "dictionary_encode": """
        SELECT o_orderkey, o_orderpriority, o_orderstatus,
               dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_code,
               dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS o_orderstatus_code
        FROM orders""",
    "narrow_schema": f"""
        WITH {REGISTER_SQL}, {_KEPT_SQL}, {_CONSOLIDATED_SQL}, facts AS (
          {_facts(('equipment_number', 'Equipment Description', 'created_on', 'changed_on', 'Equipment Type',
                   'manufacturer'), 'consolidated')})
        SELECT "column", 'string' AS type_before,
               CASE WHEN "column" IN ('created_on', 'changed_on') THEN 'timestamp_ntz' ELSE 'string' END AS type_after,
               "column" NOT IN ('created_on', 'changed_on') AND unique_values < 0.5 * "rows" AS category,
               non_null_count
        FROM facts""",
    "report_text": f"""
        WITH {REGISTER_SQL}, {_KEPT_SQL}, {_REDUCTION_SQL},
        n AS (SELECT (SELECT count(*) FROM register) AS b, (SELECT count(*) FROM kept) AS a),
        t AS (SELECT sum(bytes_before)::DOUBLE AS b, sum(bytes_after)::DOUBLE AS a FROM reduction)
        SELECT 'combination' AS report, 1::BIGINT AS line, 'Files Combined: 4' AS text
        UNION ALL SELECT 'combination', 2, format('Original Total Rows: {{:,}}', b) FROM n
        UNION ALL SELECT 'combination', 3, format('Final Rows: {{:,}}', a) FROM n
        UNION ALL SELECT 'combination', 4, format('Rows Removed: {{:,}}', b - a) FROM n
        UNION ALL SELECT 'combination', 5, 'Final Columns: 6'
        UNION ALL SELECT 'narrowing', 1, printf('Before: %.2f MB', b / 1048576) FROM t
        UNION ALL SELECT 'narrowing', 2, printf('After: %.2f MB', a / 1048576) FROM t
        UNION ALL SELECT 'narrowing', 3, printf('Saved: %.2f MB', (b - a) / 1048576) FROM t
        UNION ALL SELECT 'narrowing', 4, printf('Reduction: %.1f%%', round((b - a) * 100 / b, 1)) FROM t""",
    "processing_report": f"""
        WITH {REGISTER_SQL}, {_KEPT_SQL}, facts AS (
          {_facts(('Equipment', 'Equipment description', 'Created on', 'Chngd On', 'ObjectType',
                   'Manufacturer of Asset'), 'kept')}),
        bytes AS (SELECT {' + '.join(f'coalesce(sum(strlen("{c}")), 0)' for c in (
          'Equipment', 'Equipment description', 'Created on', 'Chngd On', 'ObjectType',
          'Manufacturer of Asset'))} AS b, count(*) AS a FROM kept),
        n AS (SELECT (SELECT count(*) FROM register)::DOUBLE AS b, (SELECT count(*) FROM kept)::DOUBLE AS a)
        SELECT 'data_quality' AS section, 'total' AS subject, 'total_mb' AS metric,
               round(b / 1048576.0::DOUBLE, 2) AS value FROM bytes
        UNION ALL SELECT 'data_quality', 'total', 'kb_per_row', round(b / 1024.0::DOUBLE / a, 3) FROM bytes
        UNION ALL SELECT 'data_quality', 'total', 'rows', a FROM bytes
        UNION ALL SELECT 'data_quality', 'total', 'columns', 6
        UNION ALL SELECT 'completeness', "column", 'non_null_count', non_null_count FROM facts
        UNION ALL SELECT 'completeness', "column", 'null_count', "rows" - non_null_count FROM facts
        UNION ALL SELECT 'completeness', "column", 'completeness_percent',
                  round(non_null_count * 100.0::DOUBLE / "rows", 2) FROM facts
        UNION ALL SELECT 'column_info', "column", 'unique_values', unique_values FROM facts
        UNION ALL SELECT 'column_info', "column", 'non_null_count', non_null_count FROM facts
        UNION ALL SELECT 'column_info', "column", 'null_percentage',
                  round(("rows" - non_null_count) * 100.0::DOUBLE / "rows", 2) FROM facts
        UNION ALL SELECT 'processing_statistics', 'total', 'files_combined', 4
        UNION ALL SELECT 'processing_statistics', 'total', 'original_total_rows', b FROM n
        UNION ALL SELECT 'processing_statistics', 'total', 'final_rows', a FROM n
        UNION ALL SELECT 'processing_statistics', 'total', 'rows_removed', b - a FROM n
        UNION ALL SELECT 'processing_statistics', 'total', 'final_columns', 6""",
    "consolidate": f"""
        WITH {REGISTER_SQL}, {_KEPT_SQL}, {_CONSOLIDATED_SQL} SELECT * FROM consolidated""",
}
