"""Many drifting extracts into one clean, narrow table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gapweave.config import ConsolidationConfig
from gapweave.operators.combine import (
    clean,
    missing_required,
    project_required,
    rename_columns,
    union_by_name,
)
from gapweave.operators.fingerprint import TableFacts, compare_content, content_facts
from gapweave.operators.narrow import narrow_types
from gapweave.operators.profile import (
    cardinality_ratio_of,
    column_info_of,
    completeness_of,
    footprint_reduction,
    footprint_total,
    sample_values_of,
    value_counts,
)
from gapweave.operators.report import processing_report_of
from gapweave.operators.validate import null_ratio_of
from gapweave.sources.files import (
    discover_files,
    drop_source,
    format_of,
    load_files,
    load_validation,
    quarantine,
)
from gapweave.sources.sinks import (
    read_saved,
    report_document,
    run_timestamp,
    save_with_facts,
    write_json_document,
    write_parquet,
)
from gapweave.storage import materialize


def combine(dfs: Sequence[DataFrame], config: ConsolidationConfig = ConsolidationConfig()) -> DataFrame:
    """Union, required columns, cleaning, renaming. Columns go before rows: records that differ only
    in dropped columns are duplicates."""
    kept = project_required(union_by_name(dfs), config.required_columns)
    cleaned = clean(kept, config.remove_duplicates, config.remove_empty_rows)
    return rename_columns(cleaned, config.column_mappings)


def consolidate(dfs: Sequence[DataFrame], config: ConsolidationConfig = ConsolidationConfig()) -> DataFrame:
    return narrow(combine(dfs, config), config)


def narrow(combined: DataFrame, config: ConsolidationConfig = ConsolidationConfig()) -> DataFrame:
    if not config.narrow_types:
        return combined
    return narrow_types(combined, config.date_columns, config.date_formats)


def verify_saved(
    spark: SparkSession, saved: dict[str, str], facts: dict[str, TableFacts], seen: dict[str, TableFacts], schema: StructType
) -> None:
    """Raise unless every output holds what was written. Those `seen` were read already, the others get a pass of their own."""
    for fmt, path in saved.items():
        if fmt in seen:
            found = seen[fmt].content(spark)
        else:
            found = content_facts(read_saved(spark, path, schema), blank_is_null=fmt == "csv")
        differing = compare_content(found, facts[fmt].content(spark)).where("NOT same").collect()
        if differing:
            raise ValueError(f"Written {fmt} data differs from the result: {[tuple(r) for r in differing]}")


def run_consolidation(
    spark: SparkSession,
    directory: str,
    output: str,
    pattern: str = "*.csv",
    prefix: str = "records",
    config: ConsolidationConfig = ConsolidationConfig(),
) -> dict:
    """Load, combine, check, narrow, save and report. Errors are raised, not turned into a status."""
    paths = discover_files(spark, directory, pattern)
    load = load_files(spark, paths, format_of(pattern), config.multi_line, config.skip_corrupt, keep_rejects=config.quarantine)
    checks = load_validation(load).collect()
    if any(r["verdict"] == "no_columns" for r in checks):
        raise ValueError("A source has no columns")
    raw = drop_source(load.df)
    # Stored once: narrowing measures it and casts it. Its size, and all facts of the result, are taken while writing.
    before = TableFacts(combine([raw], config))
    result = narrow(materialize(before.df, "combined"), config)
    saved, all_facts = save_with_facts(result, output, prefix, config)
    fmt = "parquet" if "parquet" in saved else "csv"
    # The one pass over the written table: its values are counted, and its content is checked on the way.
    written = TableFacts(read_saved(spark, saved[fmt], result.schema), blank_is_null=fmt == "csv")
    counts = materialize(value_counts(written.df), "values")
    verify_saved(spark, saved, all_facts, {fmt: written}, result.schema)
    facts = all_facts[fmt]
    rows_read = sum(r["rows"] for r in checks)
    steps = spark.createDataFrame(
        [(len(load.columns), rows_read, facts.rows, rows_read - facts.rows, len(result.columns))],
        "files_combined bigint, original_total_rows bigint, final_rows bigint, rows_removed bigint, final_columns bigint",
    )
    size = footprint_total(facts.footprint(spark), len(result.columns))
    nulls = facts.null_counts(spark)
    report = report_document(
        processing_report_of(size, completeness_of(nulls), column_info_of(counts, result.dtypes), steps, size)
    )
    report["null_ratio"] = {r["column"]: r["severity"] for r in null_ratio_of(nulls).collect()}
    texts = [name for name, kind in result.dtypes if kind == "string"]
    report["category_columns"] = sorted(
        r["column"]
        for r in cardinality_ratio_of(counts).where("category_first_pass OR category_second_pass").collect()
        if r["column"] in texts
    )
    report["missing_columns"] = missing_required(raw.columns, config.required_columns)
    report["skipped_sources"] = dict(load.reasons)
    report["sources"] = {
        r["source"]: {"rows": r["rows"], "rows_rejected": r["rows_rejected"], "columns": r["columns"]} for r in checks
    }
    report["data_types"] = dict(result.dtypes)
    report["narrowing"] = {
        r["column"]: {k: r[k] for k in ("bytes_before", "bytes_after", "reduction_percent")}
        for r in footprint_reduction(before.footprint(spark), facts.footprint(spark)).collect()
    }
    samples: dict[str, list] = {}
    for row in sample_values_of(counts, texts).orderBy("column", "position").collect():
        samples.setdefault(row["column"], []).append(row["value"])
    report["sample_values"] = samples
    report["processing_date"] = run_timestamp()
    report["output_files"] = dict(saved)
    report["configuration"] = config.describe()
    stem = saved[fmt].rsplit(".", 1)[0]
    if config.quarantine:
        saved["rejected"] = write_parquet(quarantine(load), f"{stem}_rejected.parquet")
    saved["report"] = write_json_document(spark, report, f"{stem}_report.json")
    return {"status": "success", "saved_files": saved, "statistics": report}
