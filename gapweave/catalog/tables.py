"""Queries on sources, sinks, columns, filters and set operations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.catalog.fixtures import (
    REGISTER_SQL,
    extracts,
    records,
    register,
    table,
)
from gapweave.config import COLUMN_MAPPINGS, FIELDS, REQUIRED_COLUMNS, CompletionConfig
from gapweave.functions.text import quoted
from gapweave.operators.columns import add_missing_columns, order_output_columns, resolve_aliases
from gapweave.operators.combine import (
    combination_stats,
    drop_empty_rows,
    missing_columns_by_source,
    project_required,
    rename_columns,
)
from gapweave.operators.profile import completeness
from gapweave.operators.report import tidy
from gapweave.operators.validate import (
    drop_unusable,
    rows_needing_fill,
    validate_null_ratio,
    validate_table,
)
from gapweave.sources.files import (
    discover_files,
    load_files,
    load_summary,
    load_table,
    load_typed,
    load_validation,
    normalize_na,
)
from gapweave.sources.sinks import (
    backup_snapshot,
    save_completed,
    save_multi_format,
    save_with_facts,
    verify_write,
    write_csv,
    write_json_report,
    write_parquet,
)
from gapweave.storage import scratch_path

_TEXT_TABLES = "{benchmark,conversations,documents,labels}.parquet"

_TEXT_TABLES_SQL = """
loaded AS (
  SELECT 'benchmark' AS _source, CAST(item_id AS VARCHAR) AS item_id, text FROM benchmark
  UNION ALL BY NAME
  SELECT 'conversations' AS _source, CAST(conv_id AS VARCHAR) AS conv_id,
         CAST(turn AS VARCHAR) AS turn, role, text FROM conversations
  UNION ALL BY NAME
  SELECT 'documents' AS _source, CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source,
         CAST(n_chars AS VARCHAR) AS n_chars FROM documents
  UNION ALL BY NAME
  SELECT 'labels' AS _source, CAST(doc_id AS VARCHAR) AS doc_id,
         CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic FROM labels)
"""


def _load(spark, sf):
    return load_files(spark, discover_files(spark, sf, _TEXT_TABLES), "parquet")


def scan_multi_file(spark, sf):
    return _load(spark, sf).df


def scan_all_string(spark, sf):
    return load_table(spark, f"{sf}/part.parquet")


def scan_typed(spark, sf):
    path = write_csv(table(spark, sf, "customer"), scratch_path(spark, "customer") + ".csv")
    return load_typed(spark, path, infer=True)


def scan_skip_corrupt(spark, sf):
    base = scratch_path(spark, "extracts")
    healthy = extracts(spark, sf)
    paths = [write_parquet(healthy[n], f"{base}/{n}.parquet") for n in ("customer", "part")]
    broken = f"{base}/broken.parquet"
    table(spark, sf, "benchmark").select("text").write.text(broken)
    return load_files(spark, [broken, *paths], "parquet", skip_corrupt=True).df


def normalize_na_tokens(spark, sf):
    tokens = ["", "NA", "null", "None", "nan", "-", " N/A"]
    brand = F.col("p_brand")
    for i, token in enumerate(tokens):
        brand = F.when(F.col("p_size") % 10 == i, F.lit(token)).otherwise(brand)
    return normalize_na(table(spark, sf, "part").select("p_partkey", "p_name", brand.alias("brand")))


def roundtrip_csv(spark, sf):
    path = write_csv(register(spark, sf), scratch_path(spark, "register") + ".csv")
    return load_typed(spark, path)


def roundtrip_parquet(spark, sf):
    path = write_parquet(register(spark, sf), scratch_path(spark, "register") + ".parquet")
    return load_typed(spark, path)


def report_json(spark, sf):
    report = tidy(completeness(register(spark, sf)), "completeness", "column")
    path = write_json_report(report, scratch_path(spark, "report") + ".json")
    return spark.read.schema(report.schema).json(path)


def save_formats(spark, sf):
    saved = save_multi_format(register(spark, sf), scratch_path(spark, "saved"), "register")
    return load_typed(spark, saved["csv"])


def verify(spark, sf):
    df = register(spark, sf)
    saved, facts = save_with_facts(df, scratch_path(spark, "saved"), "register")
    return verify_write(spark, saved, df, facts)


def save_completed_query(spark, sf):
    original = write_parquet(records(spark, sf), scratch_path(spark, "records") + ".parquet")
    done = load_typed(spark, original).withColumn("match_score", F.length("equipment_description") / 1000.0)
    config = CompletionConfig(output_format="parquet")
    return load_typed(spark, save_completed(done, original, config=config))


def backup(spark, sf):
    original = write_parquet(register(spark, sf), scratch_path(spark, "original") + ".parquet")
    return load_typed(spark, backup_snapshot(spark, original))


def rename(spark, sf):
    return rename_columns(register(spark, sf), COLUMN_MAPPINGS)


def _aliased(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("ObjectType"), F.col("p_name").alias("DESC")
    )


def add_missing(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("equip_type"))
    return add_missing_columns(resolve_aliases(orders))


def order_columns(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_retailprice").alias("Match_Score"),
        "p_partkey",
        F.col("p_name").alias("equipment_description"),
        F.col("p_type").alias("equipment_type"),
    )
    return order_output_columns(part, include_scores=False)


def drop_empty(spark, sf):
    return drop_empty_rows(project_required(register(spark, sf), ["Equipment description", "Manufacturer of Asset"]))


def _completion_input(spark, sf):
    return resolve_aliases(register(spark, sf)).select(quoted("Equipment"), *FIELDS)


def null_ratio(spark, sf):
    return validate_null_ratio(add_missing_columns(register(spark, sf), ["Serial"]))


def dedup(spark, sf):
    kept = project_required(register(spark, sf), ["Equipment description", "ObjectType", "Manufacturer of Asset"])
    return kept.dropDuplicates()


def combined_stats(spark, sf):
    sources = list(extracts(spark, sf).values())
    kept = project_required(register(spark, sf), REQUIRED_COLUMNS)
    return combination_stats(sources, kept.dropDuplicates())


QUERIES = {
    "scan_multi_file": scan_multi_file,
    "scan_all_string": scan_all_string,
    "normalize_na_tokens": normalize_na_tokens,
    "scan_skip_corrupt": scan_skip_corrupt,
    "scan_typed": scan_typed,
    "load_summary": lambda spark, sf: load_summary(_load(spark, sf)),
    "load_validation": lambda spark, sf: load_validation(_load(spark, sf)),
    "roundtrip_csv": roundtrip_csv,
    "roundtrip_parquet": roundtrip_parquet,
    "report_json": report_json,
    "save_multi_format": save_formats,
    "save_completed": save_completed_query,
    "backup_snapshot": backup,
    "verify_write": verify,
    "project_required": lambda spark, sf: project_required(register(spark, sf), REQUIRED_COLUMNS),
    "rename_columns": rename,
    "resolve_aliases": lambda spark, sf: resolve_aliases(_aliased(spark, sf)),
    "add_missing_columns": add_missing,
    "order_output_columns": order_columns,
    "drop_empty_rows": drop_empty,
    "drop_unusable_master": lambda spark, sf: drop_unusable(_completion_input(spark, sf)),
    "rows_needing_fill": lambda spark, sf: rows_needing_fill(_completion_input(spark, sf)),
    "validate_master": lambda spark, sf: validate_table(_aliased(spark, sf), "master"),
    "validate_null_ratio": null_ratio,
    "dedup_rows": dedup,
    "combination_stats": combined_stats,
    "union_by_name": register,
    "missing_columns": lambda spark, sf: missing_columns_by_source(extracts(spark, sf), REQUIRED_COLUMNS),
}

_REGISTER = f"WITH {REGISTER_SQL} SELECT * FROM register"
_COMPLETION_INPUT = (
    f'WITH {REGISTER_SQL}, input AS (SELECT "Equipment", "ObjectType" AS equipment_type, '
    '"Equipment description" AS equipment_description FROM register) SELECT * FROM input '
)
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
_NULL_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(\"{c}\") AS non_null_count FROM register"
    for c in _REGISTER_COLUMNS
)

ORACLE = {
    "scan_multi_file": f"WITH {_TEXT_TABLES_SQL} SELECT * FROM loaded",
    "scan_all_string": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
               CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
        FROM part""",
    "normalize_na_tokens": """
        SELECT p_partkey, p_name,
               CASE WHEN p_size % 10 IN (0, 1, 2, 3, 4) THEN NULL WHEN p_size % 10 = 5 THEN '-'
                    WHEN p_size % 10 = 6 THEN ' N/A' ELSE p_brand END AS brand
        FROM part""",
    "scan_skip_corrupt": f"""
        WITH {REGISTER_SQL}
        SELECT 'part' AS _source, * FROM part_extract
        UNION ALL BY NAME SELECT 'customer' AS _source, * FROM customer_extract""",
    "scan_typed": "SELECT * FROM customer",
    "load_summary": f"""
        WITH {_TEXT_TABLES_SQL}
        SELECT _source AS source, count(*) AS "rows",
               CASE _source WHEN 'benchmark' THEN 2 WHEN 'conversations' THEN 4
                            WHEN 'documents' THEN 5 ELSE 3 END AS columns
        FROM loaded GROUP BY _source""",
    "load_validation": f"""
        WITH {_TEXT_TABLES_SQL}
        SELECT _source AS source, count(*) AS "rows",
               CASE _source WHEN 'benchmark' THEN 2 WHEN 'conversations' THEN 4
                            WHEN 'documents' THEN 5 ELSE 3 END AS columns,
               0 AS rows_rejected, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'ok' END AS verdict
        FROM loaded GROUP BY _source""",
    "roundtrip_csv": _REGISTER,
    "roundtrip_parquet": _REGISTER,
    "report_json": f"""
        WITH {REGISTER_SQL}, facts AS ({_NULL_COUNTS})
        SELECT 'completeness' AS section, "column" AS subject, metric, value FROM (
          SELECT "column", 'non_null_count' AS metric, CAST(non_null_count AS DOUBLE) AS value FROM facts
          UNION ALL SELECT "column", 'null_count', CAST("rows" - non_null_count AS DOUBLE) FROM facts
          UNION ALL SELECT "column", 'completeness_percent',
            round(non_null_count * 100.0::DOUBLE / "rows", 2) FROM facts)""",
    "save_multi_format": _REGISTER,
    "save_completed": """
        SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS equipment_type, d.text AS equipment_description,
               length(d.text) / 1000.0::DOUBLE AS match_score
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "backup_snapshot": _REGISTER,
    "verify_write": f"""
        WITH {REGISTER_SQL}
        SELECT format, (SELECT count(*) FROM register) AS "rows", 8::BIGINT AS columns, true AS verified
        FROM (VALUES ('csv'), ('parquet')) AS f(format)""",
    "project_required": f"""
        WITH {REGISTER_SQL}
        SELECT "Equipment", "Equipment description", "Created on", "Chngd On", "ObjectType",
               "Manufacturer of Asset" FROM register""",
    "rename_columns": f"""
        WITH {REGISTER_SQL}
        SELECT "Equipment" AS equipment_number, "Equipment description" AS "Equipment Description",
               "Created on" AS created_on, "Chngd On" AS changed_on, "ObjectType" AS "Equipment Type",
               "Manufacturer of Asset" AS manufacturer, "Nation", "Size" FROM register""",
    "resolve_aliases": """
        SELECT p_partkey, p_type AS equipment_type, p_name AS equipment_description FROM part""",
    "add_missing_columns": """
        SELECT o_orderkey, o_orderpriority AS equipment_type,
               CAST(NULL AS VARCHAR) AS equipment_description FROM orders""",
    "order_output_columns": """
        SELECT p_type AS equipment_type, p_name AS equipment_description, p_partkey FROM part""",
    "drop_empty_rows": f"""
        WITH {REGISTER_SQL}
        SELECT "Equipment description", "Manufacturer of Asset" FROM register
        WHERE "Equipment description" IS NOT NULL OR "Manufacturer of Asset" IS NOT NULL""",
    "drop_unusable_master": _COMPLETION_INPUT
    + "WHERE equipment_type IS NOT NULL OR equipment_description IS NOT NULL",
    "rows_needing_fill": _COMPLETION_INPUT + "WHERE equipment_type IS NULL OR equipment_description IS NULL",
    "validate_master": """
        SELECT c.name AS "check", (SELECT count(*) FROM part) AS "rows", true AS passed
        FROM (VALUES ('not_empty'), ('has_equipment_type'), ('has_equipment_description')) AS c(name)""",
    "validate_null_ratio": f"""
        WITH {REGISTER_SQL}, facts AS ({_NULL_COUNTS}
          UNION ALL SELECT 'Serial', count(*), 0 FROM register)
        SELECT "column", "rows", "rows" - non_null_count AS null_count,
               round(("rows" - non_null_count) / CAST("rows" AS DOUBLE), 6) AS null_ratio,
               CASE WHEN non_null_count = 0 THEN 'all_null'
                    WHEN ("rows" - non_null_count) / CAST("rows" AS DOUBLE) > 0.9 THEN 'warn'
                    ELSE 'ok' END AS severity
        FROM facts""",
    "dedup_rows": f"""
        WITH {REGISTER_SQL}
        SELECT DISTINCT "Equipment description", "ObjectType", "Manufacturer of Asset" FROM register""",
    "combination_stats": f"""
        WITH {REGISTER_SQL}, kept AS (
          SELECT DISTINCT "Equipment", "Equipment description", "Created on", "Chngd On", "ObjectType",
                 "Manufacturer of Asset" FROM register),
        n AS (SELECT (SELECT count(*) FROM register) AS before, (SELECT count(*) FROM kept) AS after)
        SELECT 4::BIGINT AS files_combined, before AS original_total_rows, after AS final_rows,
               before - after AS rows_removed, 6::BIGINT AS final_columns FROM n""",
    "union_by_name": _REGISTER,
    "missing_columns": """
        SELECT source, "column", rows_without FROM (VALUES
          ('part', 'Created on', (SELECT count(*) FROM part)),
          ('part', 'Chngd On', (SELECT count(*) FROM part)),
          ('orders', 'Equipment description', (SELECT count(*) FROM orders)),
          ('orders', 'Chngd On', (SELECT count(*) FROM orders)),
          ('orders', 'Manufacturer of Asset', (SELECT count(*) FROM orders)),
          ('lineitem', 'Equipment description', (SELECT count(*) FROM lineitem)),
          ('lineitem', 'Created on', (SELECT count(*) FROM lineitem)),
          ('lineitem', 'ObjectType', (SELECT count(*) FROM lineitem)),
          ('customer', 'Created on', (SELECT count(*) FROM customer)),
          ('customer', 'Chngd On', (SELECT count(*) FROM customer)),
          ('customer', 'Manufacturer of Asset', (SELECT count(*) FROM customer)))
          AS v(source, "column", rows_without)""",
}
