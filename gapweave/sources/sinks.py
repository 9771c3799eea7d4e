"""Writing results: datasets by format, reports, backups, and the check of what was written."""

from __future__ import annotations

import json
import logging
import os
import uuid
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gapweave.config import CompletionConfig, ConsolidationConfig
from gapweave.operators.columns import order_output_columns
from gapweave.operators.fingerprint import TableFacts, beside, content_facts
from gapweave.sources.files import FORMATS, format_of, load_typed
from gapweave.storage import remove_scratch, rename

log = logging.getLogger(__name__)


#: Options with which a CSV file gives back what was written, but for empty texts that were null.
_CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> str:
    df.write.options(**_CSV).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


def write_json_report(report: DataFrame, path: str) -> str:
    """Tidy report rows, one JSON object per line. Reports have one row per column and metric."""
    report.coalesce(1).write.json(path)
    return path


def write_json_document(spark: SparkSession, document: dict, path: str) -> str:
    """A nested report as one indented JSON document; values of unknown type are written as text."""
    text = json.dumps(document, indent=2, default=str, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def report_document(report: DataFrame) -> dict:
    """Tidy rows nested as section -> subject -> metric; the report is bounded by the column count."""
    nested: dict = {}
    for row in report.collect():
        nested.setdefault(row["section"], {}).setdefault(row["subject"], {})[row["metric"]] = row["value"]
    return nested


def run_timestamp() -> str:
    return datetime.now().strftime("%Y%m%d_%H%M%S")


def output_paths(base: str, prefix: str, stamp: str | None = None) -> dict[str, str]:
    """Paths of one run's outputs, told apart by its time stamp."""
    stamp = stamp or run_timestamp()
    base = base.rstrip("/")
    return {
        "csv": f"{base}/{prefix}_{stamp}.csv",
        "parquet": f"{base}/{prefix}_{stamp}.parquet",
        "report": f"{base}/{prefix}_report_{stamp}.json",
    }


def save_multi_format(
    df: DataFrame, base: str, prefix: str, config: ConsolidationConfig = ConsolidationConfig()
) -> dict[str, str]:
    """Write `df` in the configured formats and return their paths; an empty table is an error.

    The first format is computed, the second is copied from it, so the plan runs once.
    """
    return save_with_facts(df, base, prefix, config)[0]


def save_with_facts(
    df: DataFrame, base: str, prefix: str, config: ConsolidationConfig = ConsolidationConfig()
) -> tuple[dict[str, str], dict[str, TableFacts]]:
    """`save_multi_format` with facts of each output, taken while it is written. For CSV empty texts count as null."""
    if not (config.save_parquet or config.save_csv):
        raise ValueError("No output format is switched on")
    paths = output_paths(base, prefix)
    spark = df.sparkSession
    saved, facts = {}, {}

    def write(fmt: str, table: DataFrame, writer) -> None:
        facts[fmt] = TableFacts(table, blank_is_null=fmt == "csv")
        saved[fmt] = writer(facts[fmt].df, paths[fmt])

    if config.save_parquet:
        write("parquet", df, write_parquet)
    else:
        write("csv", df, write_csv)
    if next(iter(facts.values())).rows == 0:
        for path in saved.values():
            remove_scratch(spark, path)
        raise ValueError("The table to save is empty")
    if config.save_parquet and config.save_csv:
        write("csv", read_saved(spark, paths["parquet"], df.schema), write_csv)
    return saved, facts


def read_saved(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that was written by this module, with the types it had."""
    fmt = format_of(path)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**_CSV).option("multiLine", "true")
    return reader.format(fmt).load(path)


def completed_path(original: str, fmt: str, suffix: str = "completed") -> str:
    stem = os.path.splitext(original.rstrip("/"))[0]
    return f"{stem}_{suffix}.{fmt}"


def backup_snapshot(spark: SparkSession, path: str) -> str | None:
    """Copy a dataset next to itself; a failure is only reported.

    An earlier copy is replaced when the new one is complete, by a change of names.
    """
    stem, extension = os.path.splitext(path.rstrip("/"))
    copy, fresh = f"{stem}_backup{extension}", f"{stem}_backup_{uuid.uuid4().hex}{extension}"
    try:
        fmt = format_of(path)
        rows = spark.read.text(path) if fmt != "parquet" else spark.read.parquet(path)
        rows.write.text(fresh) if fmt != "parquet" else rows.write.parquet(fresh)
        remove_scratch(spark, copy)
        rename(spark, fresh, copy)
        return copy
    except (PySparkException, ValueError, OSError) as error:
        remove_scratch(spark, fresh)
        log.warning("No backup of %s: %s", path, str(error).splitlines()[0])
        return None


def resolve_output(
    spark: SparkSession, original: str, output: str | None = None, config: CompletionConfig = CompletionConfig()
) -> str:
    """The path that a completed table will get; an unknown extension falls back to CSV.

    To be called before any work: a path that exists is refused unless `config.overwrite` is set, and the
    original is never written over, since it is read while the result is written.
    """
    output = output or completed_path(original, config.output_format)
    stem, extension = os.path.splitext(output.rstrip("/"))
    if extension.lower() not in FORMATS:
        log.warning("Unsupported output format %s, saved as CSV", extension)
        output = f"{stem}.csv"
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.makeQualified(path).equals(system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(original))):
        raise ValueError(f"The output is the original: {output}")
    if not config.overwrite and system.exists(path):
        raise FileExistsError(f"The output exists: {output}")
    return output


def save_completed(
    df: DataFrame,
    original: str,
    output: str | None = None,
    config: CompletionConfig = CompletionConfig(),
) -> str:
    """Write a completed table by the extension of `output`; an unknown one falls back to CSV."""
    output = resolve_output(df.sparkSession, original, output, config)
    if config.backup_original:
        backup_snapshot(df.sparkSession, original)
    ordered = order_output_columns(df, config.include_scores)
    writer = ordered.write.mode("overwrite" if config.overwrite else "errorifexists")
    fmt = format_of(output)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    writer.format(fmt).save(output)
    return output


def verify_write(
    spark: SparkSession, saved: dict[str, str], expected: DataFrame, facts: dict[str, TableFacts] | None = None
) -> DataFrame:
    """Per output: rows and columns read back, and whether names, rows and values all agree with `expected`.

    Each output is read once. With the `facts` that `save_with_facts` took while it wrote `expected`, this is not
    computed again; without them it is, once per output.
    """
    found = None
    for fmt, path in sorted(saved.items()):
        names = load_typed(spark, path).columns
        # Every value is compared through the check sums, so a file with other columns is not read by the names of these.
        same = names == expected.columns
        df = read_saved(spark, path, expected.schema) if same else load_typed(spark, path)
        blank = fmt != "parquet"
        wanted = content_facts(expected, blank) if facts is None else facts[fmt].content(spark)
        compared = beside(content_facts(df, blank), wanted).groupBy().agg(
            F.coalesce(F.max(F.when(F.col("level") == "row", F.col("found")["rows"])), F.lit(0)).alias("rows"),
            F.every(F.col("found").eqNullSafe(F.col("expected"))).alias("same"),
        )
        row = compared.select(
            F.lit(fmt).alias("format"),
            "rows",
            F.lit(len(names)).cast("bigint").alias("columns"),
            (F.lit(same) & F.col("same") & (F.col("rows") > 0)).alias("verified"),
        )
        found = row if found is None else found.unionByName(row)
    return found
