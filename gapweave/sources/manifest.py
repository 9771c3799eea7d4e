"""Loading that remembers: a store of rows already read, with a manifest of the files they came from.

    store/rows/_batch=1/     rows of the files read by the first run, as text, with the path of their file
    store/manifest/batch=1/  one row per file: place, length, time, columns, rows, rejected rows, content check
    store/profile/batch=1/   mergeable profile states per file and column (see `operators.states`)

A later run lists the files, reads those that the manifest does not have with this length and time, and adds a batch. A
file that changed is a new version of itself, one that is gone gets an entry that says so; nothing is ever rewritten. A
batch counts from the moment its manifest is written, which is the last thing a run does: what a run that failed has left
is not referred to by anything. One run at a time may add to a store. Files must not have columns of the names that the rows
of a store have besides: `_file`, `_batch`, `_rejected` and `_source`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.text import quoted
from gapweave.operators.fingerprint import CHECKS, content_aggregates, content_rows
from gapweave.operators.states import PROFILE, profile_states
from gapweave.sources.files import REJECTED, SOURCE, discover_files, format_of, load_files, plain_path, source_names

FILE = "_file"
BATCH = "_batch"
_MANIFEST = (
    "file string, length bigint, modified bigint, present boolean, reason string, columns array<string>, rows bigint, "
    "rows_rejected bigint, check_a decimal(20,0), check_b decimal(20,0), batch bigint"
)


@dataclass(frozen=True)
class Refresh:
    """What a run did: the files it read, those it left out as damaged, those that are gone, and how many it knew."""

    batch: int | None
    read: tuple[str, ...]
    skipped: tuple[str, ...]
    removed: tuple[str, ...]
    known: int


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, length, modified) of files and of folders of part files: bytes in all, time of the latest change."""
    rows = []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        status = system.getFileStatus(target)
        length, modified = status.getLen(), status.getModificationTime()
        if status.isDirectory():
            parts = [p for p in system.listStatus(target) if not p.getPath().getName().startswith(("_", "."))]
            length = sum(p.getLen() for p in parts)
            modified = max([modified, *(p.getModificationTime() for p in parts)])
        rows.append((plain_path(path), length, modified))
    return spark.createDataFrame(rows, "file string, length bigint, modified bigint")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """The newest entry of every file that is not gone."""
    if not _exists(spark, f"{store}/manifest"):
        return spark.createDataFrame([], _MANIFEST)
    entries = spark.read.schema(_MANIFEST).parquet(f"{store}/manifest")
    newest = entries.groupBy("file").agg(F.max_by(F.struct("*"), "batch").alias("e"))
    return newest.select("e.*").where("present")


def refresh(
    spark: SparkSession, directory: str, store: str, pattern: str = "*.csv", multi_line: bool = True, skip_corrupt: bool = False
) -> Refresh:
    """Bring `store` up to date with the files of `directory`; only new and changed ones are read.

    A file counts as changed if its length or time did. A file left out as damaged is known with its reason and read again
    when it changes. No files at all, or none that can be read, is an error, as for `load_files`, and adds nothing.
    """
    store = store.rstrip("/")
    paths = {plain_path(p): p for p in discover_files(spark, directory, pattern)}
    listed = list_files(spark, list(paths.values()))
    known = manifest(spark, store)
    same = ["file", "length", "modified"]
    fresh = [r["file"] for r in listed.join(known, same, "left_anti").orderBy("file").collect()]
    removed = [r["file"] for r in known.join(listed, "file", "left_anti").orderBy("file").collect()]
    if not fresh and not removed:
        return Refresh(None, (), (), (), len(paths))
    batch = 1 + (spark.read.schema(_MANIFEST).parquet(f"{store}/manifest").agg(F.max("batch")).first()[0]
                 if _exists(spark, f"{store}/manifest") else 0)
    gone = known.join(listed, "file", "left_anti").withColumn("present", F.lit(False)).drop("batch")
    entries, skipped = gone, ()
    if fresh:
        load = load_files(spark, [paths[f] for f in fresh], format_of(pattern), multi_line, skip_corrupt, by_path=True)
        taken = {FILE, BATCH, REJECTED, SOURCE}.intersection(c for columns in load.columns.values() for c in columns)
        if taken:
            raise ValueError(f"Columns with the names of the store's own: {sorted(taken)}")
        skipped = load.skipped
        found = _add_rows(load.scanned.withColumnRenamed(SOURCE, FILE), store, batch)
        layout = [(f, list(columns), None) for f, columns in load.columns.items()]
        layout += [(f, [], reason) for f, reason in load.reasons.items()]
        names = spark.createDataFrame(layout, "file string, columns array<string>, reason string")
        entries = (
            names.join(listed, "file").join(found, "file", "left")
            .select(
                "file", "length", "modified", F.lit(True).alias("present"), "reason", "columns",
                *(F.coalesce(c, F.lit(0)).cast(k).alias(c) for c, k in (
                    ("rows", "bigint"), ("rows_rejected", "bigint"), *((check, "decimal(20,0)") for check in CHECKS))),
            )
            .unionByName(gone)
        )
    entries.write.parquet(f"{store}/manifest/batch={batch}")
    return Refresh(batch, tuple(fresh), skipped, tuple(removed), len(paths) - len(fresh))


def _add_rows(scanned: DataFrame, store: str, batch: int) -> DataFrame:
    """Write the rows and profile states of a batch; (file, rows, rows_rejected, check_a, check_b) from what was written."""
    place = f"{store}/rows/{BATCH}={batch}"
    # A run that failed may have left rows under this number; they were never part of the store.
    scanned.write.mode("overwrite").parquet(place)
    written = scanned.sparkSession.read.schema(scanned.schema).parquet(place)
    good = written.where(~F.col(REJECTED)).drop(REJECTED)
    values = [c for c in good.columns if c != FILE]
    profile_states(good, FILE, values).write.mode("overwrite").parquet(f"{store}/profile/batch={batch}")
    checks = good.groupBy(quoted(FILE).alias("file")).agg(*content_aggregates(good.select(*map(quoted, values))))
    rejected = written.groupBy(quoted(FILE).alias("file")).agg(F.count_if(REJECTED).alias("rows_rejected"))
    # The check of the rows of a file, over the columns of its batch.
    whole = content_rows(checks, [], keep=["file"])
    return rejected.join(whole.select("file", "rows", *CHECKS), "file", "left")


def _sources(spark: SparkSession, store: str) -> DataFrame:
    """(file, source): names as a full load would give them."""
    names = source_names([r["file"] for r in manifest(spark, store).where("reason IS NULL").select("file").collect()])
    return spark.createDataFrame(list(names.items()), "file string, source string")


def snapshot(spark: SparkSession, store: str) -> DataFrame:
    """All rows of the newest versions of all files, as `load_files` gives them: values as text and `_source`.

    Only batches with such rows are read, and no source file. Columns that only former versions had are left out.
    """
    store = store.rstrip("/")
    current = manifest(spark, store).where("reason IS NULL")
    facts = current.groupBy().agg(
        F.collect_set("batch").alias("batches"), F.array_distinct(F.flatten(F.collect_set("columns"))).alias("columns")
    ).first()
    if not facts["batches"]:
        raise ValueError(f"Nothing is stored in {store}")
    places = [f"{store}/rows/{BATCH}={batch}" for batch in sorted(facts["batches"])]
    versions = current.select(F.col("file").alias(FILE), F.col("batch").alias(BATCH)).join(
        _sources(spark, store).select(F.col("file").alias(FILE), F.col("source").alias(SOURCE)), FILE
    )
    columns = [T.StructField(c, T.StringType()) for c in sorted(facts["columns"])]
    own = [T.StructField(FILE, T.StringType()), T.StructField(REJECTED, T.BooleanType()), T.StructField(BATCH, T.LongType())]
    rows = spark.read.schema(T.StructType([*columns, *own])).option("basePath", f"{store}/rows").parquet(*places)
    kept = rows.where(~F.col(REJECTED)).join(versions, [FILE, BATCH])
    return kept.select(*[quoted(c) for c in sorted(facts["columns"])], SOURCE)


def stored_summary(spark: SparkSession, store: str) -> DataFrame:
    """(source, rows, columns, rows_rejected, verdict) as `load_validation`, from the manifest alone."""
    known = manifest(spark, store.rstrip("/"))
    verdict = (
        F.when(F.col("reason").isNotNull(), "skipped").when(F.size("columns") == 0, "no_columns")
        .when(F.col("rows") == 0, "empty").otherwise("ok")
    )
    names = source_names([r["file"] for r in known.select("file").collect()])
    sources = spark.createDataFrame(list(names.items()), "file string, source string")
    return known.join(sources, "file").select(
        "source", "rows", F.size("columns").cast("bigint").alias("columns"), "rows_rejected", verdict.alias("verdict")
    )


def stored_states(spark: SparkSession, store: str) -> DataFrame:
    """Profile states (source, column, ...) of the newest versions of all files, to be merged at will."""
    store = store.rstrip("/")
    current = manifest(spark, store).where("reason IS NULL AND size(columns) > 0").select(
        "file", "batch", F.explode("columns").alias("column")
    )
    states = spark.read.schema(f"{PROFILE}, batch bigint").parquet(f"{store}/profile").withColumnRenamed("part", "file")
    kept = states.join(current, ["file", "batch", "column"]).join(_sources(spark, store), "file")
    return kept.select(F.col("source").alias("part"), *[c for c in states.columns if c not in ("file", "batch")])
