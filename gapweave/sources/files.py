"""Reading extracts: many files with drifting columns, or one typed table."""

from __future__ import annotations

import json
import logging
import os
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.functions.text import null_if_na_token, quoted
from gapweave.operators.combine import as_strings, union_by_name

log = logging.getLogger(__name__)

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}

# Columns the loaders add; they are dropped from the data, not from the lineage.
SOURCE = "_source"
CORRUPT = "_corrupt_record"
REJECTED = "_rejected"
RAW, FILE, BLOCK, ROW = "_raw", "_file", "_block", "_row"
_PLACE_COLUMNS = (RAW, FILE, BLOCK, ROW)


def format_of(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in FORMATS:
        raise ValueError(f"Unsupported file format '{extension}' of {path}; known: {sorted(FORMATS)}")
    return FORMATS[extension]


def discover_files(spark: SparkSession, directory: str, pattern: str = "*.csv") -> list[str]:
    """Sorted paths of the files below `directory` whose name fits `pattern`, empty ones included.

    A folder whose name fits is one table of part files: it is listed as such and not looked into, so the list
    grows with the tables, not with their parts. Hidden names (`_` or `.` first) are passed over.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root) or not system.getFileStatus(root).isDirectory():
        raise FileNotFoundError(f"Directory not found: {directory}")
    fits = jvm.org.apache.hadoop.fs.GlobFilter(pattern)
    found, waiting = [], [root]
    while waiting:
        for status in system.listStatus(waiting.pop()):
            path = status.getPath()
            if path.getName().startswith(("_", ".")):
                continue
            if fits.accept(path):
                found.append(path.toString())
            elif status.isDirectory():
                waiting.append(path)
    if not found:
        raise FileNotFoundError(f"No files like {pattern} in {directory}")
    return sorted(found)


def _reader(spark: SparkSession, fmt: str, multi_line: bool = True):
    """Reader without type inference.

    Quoted line breaks are honoured, for which a CSV file is read by one task; `multi_line=False` lets
    Spark split large files that are known to have none.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false").option("escape", '"')
        reader = reader.option("multiLine", str(multi_line).lower())
    elif fmt == "json":
        reader = reader.option("primitivesAsString", "true").option("columnNameOfCorruptRecord", CORRUPT)
    return reader


# Errors of a job that PySpark does not translate come as Py4JJavaError.
_SPARK_ERRORS = (PySparkException, Py4JJavaError)
# What errors say when a file's content cannot be read, and when something else was in the way.
_DAMAGE = re.compile(
    "FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER|UNABLE_TO_INFER_SCHEMA|is not a Parquet file|[Cc]ould not read footer"
    "|Decoding|[Cc]orrupt|[Mm]alformed|EOFException"
)
_TROUBLE = re.compile("[Tt]ime(d )?[Oo]ut|SocketException|ConnectException|UnknownHost|FILE_NOT_EXIST|AccessControl|Lost executor")


@dataclass(frozen=True)
class Load:
    """All-string table with a `_source` column, the columns of each source, and what was left out.

    `scanned` has all rows that were read, with `_rejected` for those that do not parse; `df` is the rest of them.
    `skipped` names the sources that could not be read, `reasons` says why.
    """

    df: DataFrame
    columns: dict[str, tuple[str, ...]]
    skipped: tuple[str, ...]
    scanned: DataFrame
    reasons: dict[str, str]


def load_files(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str,
    multi_line: bool = True,
    skip_corrupt: bool = False,
    by_path: bool = False,
    keep_rejects: bool = False,
) -> Load:
    """Union of the files by column name, every value as text.

    Schemas are looked at on the driver, several at a time. Files with equal columns then share one
    scan, so the plan grows with the number of layouts, not of files. A file that cannot be read fails the load,
    at once or while scanning. With `skip_corrupt` all files are read through first, and those with damage
    are left out whole, logged and named in `skipped`; any other error, such as a time-out, still fails. Rows that do
    not parse are counted by `load_validation`. A file without columns is kept as a source without rows. With `by_path`
    a source is named by its path (`plain_path`), whatever other files there are. With `keep_rejects` a row that was read
    in part is rejected too, and `quarantine` gives all rejected rows as they stand in their files.
    """
    names = {path: plain_path(path) for path in paths} if by_path else source_names(paths)
    reasons: dict[str, str] = {}

    def skip(path: str, error: Exception) -> None:
        if not (skip_corrupt and _is_damage(error)):
            raise error
        lines = [line.strip() for line in str(error).splitlines() if line.strip()]
        reasons[names[path]] = next((line for line in lines if _DAMAGE.search(line)), lines[0])[:500]
        log.warning("Skipped %s: %s", path, reasons[names[path]])

    def layout(path: str):
        try:
            schema = _reader(spark, fmt, multi_line).load(path).schema
        except _SPARK_ERRORS as error:
            skip(path, error)
            return None
        return tuple(n for n in schema.names if n != CORRUPT), schema.json()

    with ThreadPoolExecutor(16) as pool:
        layouts = dict(zip(paths, pool.map(layout, paths)))
    columns = {names[path]: found[0] for path, found in layouts.items() if found}
    groups: dict[tuple, list[str]] = {}
    for path, found in layouts.items():
        if found and found[0]:
            # Sources that are named by their folder cannot be told apart by the scan, so they get one each.
            own = names[path] if not by_path and names[path] != source_name(path) else None
            groups.setdefault((*found, own), []).append(path)
    frames = []
    for (fields, schema_json, own), members in groups.items():
        scan = lambda chosen: _scan(_reader(spark, fmt, multi_line), chosen, fmt, fields, schema_json, own, by_path, keep_rejects)
        if skip_corrupt:
            members = _readable(scan, members, skip)
        if members:
            frames.append(scan(members))
    if not frames:
        raise ValueError("No file could be loaded")
    for name in reasons:
        columns.pop(name, None)
    scanned = union_by_name(frames)
    df = scanned.where(~F.col(REJECTED)).drop(REJECTED, *_PLACE_COLUMNS)
    return Load(df, columns, tuple(sorted(reasons)), scanned, reasons)


def quarantine(load: Load) -> DataFrame:
    """(source, file, record, raw, reason) of the rejected rows of a load with `keep_rejects`.

    `raw` is the text of the row in its file, `record` counts the rows of the file from 1, blank lines and the header left
    out. Accepted and quarantined rows together are all rows read. Rows are numbered in the scan and shifted by the sizes of
    the parts of the file before, so only counts are shuffled. A load without rejected rows gives an empty table.
    """
    scanned = load.scanned
    if ROW not in scanned.columns:
        raise ValueError("load the files with keep_rejects=True to get the rejected rows")
    part = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        scanned.groupBy(FILE, BLOCK)
        .agg(F.min(ROW).alias("first"), F.count("*").alias("rows"), F.max(F.col(REJECTED)).alias("any"))
        .withColumn("before", F.coalesce(F.sum("rows").over(part), F.lit(0)))
        .where("any")
        .select(FILE, BLOCK, (F.col("before") - F.col("first") + 1).alias("shift"))
    )
    widths = [(name, len(columns)) for name, columns in load.columns.items()]
    fields = load.df.sparkSession.createDataFrame(widths, "source string, fields int")
    rejected = scanned.where(REJECTED).select(
        F.col(SOURCE).alias("source"), FILE, BLOCK, ROW, RAW
    )
    # Quoted parts hold no separators; a quote that is left over was never closed.
    bare = F.regexp_replace(RAW, '"[^"]*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    csv_reason = F.when(bare.contains('"'), "open quote").otherwise(
        F.concat(found.cast("string"), F.lit(" fields instead of "), F.col("fields").cast("string"))
    )
    is_json = F.lower(FILE).rlike(r"\.json(/[^/]*)?$")
    reason = F.when(~is_json, csv_reason).when(F.ltrim(RAW).startswith("{"), "JSON object not whole").otherwise("no JSON object")
    return (
        rejected.join(shifts, [FILE, BLOCK]).join(F.broadcast(fields), "source")
        .select("source", F.col(FILE).alias("file"), (F.col(ROW) + F.col("shift")).alias("record"), F.col(RAW).alias("raw"),
                reason.alias("reason"))
    )


def _is_damage(error: Exception) -> bool:
    """Whether the content of a file is at fault, rather than the store or the job."""
    text = str(error)
    return bool(_DAMAGE.search(text)) and not _TROUBLE.search(text)


def _readable(scan, paths: list[str], skip) -> list[str]:
    """The paths whose data can be read to the end. Damaged ones are found by halving, so few jobs run if few are."""
    try:
        _fingerprint(scan(paths)).collect()
        return paths
    except _SPARK_ERRORS as error:
        if len(paths) == 1:
            skip(paths[0], error)
            return []
    half = len(paths) // 2
    return _readable(scan, paths[:half], skip) + _readable(scan, paths[half:], skip)


def _fingerprint(df: DataFrame) -> DataFrame:
    """One row that depends on every value, so that no column of any file stays unread."""
    return df.groupBy().agg(F.max(F.xxhash64(*[quoted(c) for c in df.columns])).alias("fingerprint"))


def _scan(reader, paths, fmt, names, schema_json, own, by_path, keep_rejects) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(schema_json))
    reader = reader.option("ignoreCorruptFiles", "false").option("mode", "PERMISSIVE")
    rejected, raw = F.lit(False), F.lit(None).cast("string")
    if fmt != "parquet":
        # A row that does not fit the layout is flagged; it is rejected if nothing of it could be read, or in any case.
        fields = [f for f in schema.fields if f.name != CORRUPT]
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        raw = F.col(CORRUPT)
        values = [quoted(c) for c in names]
        # The remainder is always 0. It takes every column along: a row is judged by all of them, whichever are asked for.
        judged = F.xxhash64(*values) % 1 == 0 if keep_rejects else F.coalesce(*values).isNull()
        rejected = raw.isNotNull() & judged
    df = reader.schema(schema).load(list(paths))
    columns = [quoted(c).cast("string").alias(c) for c in names]
    source = _path_column() if by_path else _source_column() if own is None else F.lit(own)
    place = []
    if keep_rejects:
        block = F.col("_metadata.file_block_start")
        place = [raw.alias(RAW), _file_path().alias(FILE), block.alias(BLOCK), F.monotonically_increasing_id().alias(ROW)]
    return df.select(*columns, source.alias(SOURCE), rejected.alias(REJECTED), *place)


def source_names(paths: Sequence[str]) -> dict[str, str]:
    """A name for each path: that of the table or file, with its folders if several share it."""
    short: dict[str, list[str]] = {}
    for path in paths:
        short.setdefault(source_name(path), []).append(path)
    names = {}
    for name, members in short.items():
        if len(members) == 1:
            names[members[0]] = name
            continue
        parts = {path: path.rstrip("/").split("/") for path in members}
        same = len(os.path.commonprefix([p[:-1] for p in parts.values()]))
        for path, own in parts.items():
            names[path] = "/".join([*own[same:-1], os.path.splitext(own[-1])[0]])
    if len(set(names.values())) < len(names):  # equal but for the extension
        names = {path: path.rstrip("/").split("/")[-1] if len(short[source_name(path)]) > 1 else n for path, n in names.items()}
    return names


def source_name(path: str) -> str:
    """Name of the table a file belongs to: its folder if that is one, else the file itself."""
    parts = path.rstrip("/").split("/")
    if len(parts) > 1 and os.path.splitext(parts[-2])[1].lower() in FORMATS:
        return os.path.splitext(parts[-2])[0]
    return os.path.splitext(parts[-1])[0]


def plain_path(path: str) -> str:
    """The path of a table without the ways in which the scheme of local files is written."""
    return re.sub("^file:/+", "/", path.rstrip("/"))


# A row's file is looked at for every row, so its path is cut by plain string functions, which take a tenth of a microsecond.
def _decoded(path):
    # The path is given as a URL, in which a plus sign stands for itself.
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _file_path():
    return _decoded(F.col("_metadata.file_path"))


def _folder_and_leaf():
    path = F.col("_metadata.file_path")
    return _decoded(F.substring_index(F.substring_index(path, "/", -2), "/", 1)), _decoded(F.substring_index(path, "/", -1))


def _ends_as_table(folder, extension: str):
    return F.lower(folder).endswith(extension)


def _without_end(text, length):
    return F.substring(text, F.lit(1), F.length(text) - length)


def _path_column():
    """`plain_path` of the row's table, as an expression."""
    path = _file_path()
    folder, leaf = _folder_and_leaf()
    is_table = F.lit(False)
    for extension in FORMATS:
        is_table = is_table | _ends_as_table(folder, extension)
    table = F.when(is_table, _without_end(path, F.length(leaf) + 1)).otherwise(path)
    local = F.concat(F.lit("/"), F.ltrim(F.substring(table, F.lit(len("file:") + 1), F.length(table)), F.lit("/")))
    return F.when(table.startswith("file:/"), local).otherwise(table)


def _source_column():
    """`source_name` of the row's file, as an expression."""
    folder, leaf = _folder_and_leaf()
    extension = F.substring_index(leaf, ".", -1)
    stem = F.length(leaf) - F.length(extension) - 1  # of a name without a dot: -1
    name = F.when((stem > 0) & (extension != ""), F.substring(leaf, F.lit(1), stem)).otherwise(leaf)
    for known in FORMATS:
        is_table = _ends_as_table(folder, known) & (F.length(folder) > len(known))
        name = F.when(is_table, _without_end(folder, F.lit(len(known)))).otherwise(name)
    return name


def load_table(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One file or dataset with every column as text; ids keep their leading zeros."""
    return as_strings(load_typed(spark, path, multi_line=multi_line))


def load_typed(
    spark: SparkSession, path: str, infer: bool = False, multi_line: bool = True
) -> DataFrame:
    """One table by the extension of `path`, with types inferred on demand for text formats."""
    fmt = format_of(path)
    reader = _reader(spark, fmt, multi_line)
    if infer:
        reader = reader.option("inferSchema", "true").option("primitivesAsString", "false")
    try:
        return reader.load(path)
    except PySparkException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise


def normalize_na(df: DataFrame) -> DataFrame:
    """Text values that readers take for "no value" become null."""
    texts = {n for n, k in df.dtypes if k == "string"}
    return df.select(
        *[null_if_na_token(quoted(n)).alias(n) if n in texts else quoted(n) for n in df.columns]
    )


def _source_facts(load: Load) -> DataFrame:
    """(source, rows, rows_rejected, columns) of every source that was loaded, also of those without rows.

    Rows are counted as they are scanned: all columns are read, so data that cannot be read fails here.
    """
    values = [quoted(c) for c in load.scanned.columns]
    counts = load.scanned.groupBy(F.col(SOURCE).alias("source")).agg(
        F.sum(F.when(F.col(REJECTED), 0).otherwise(1)).alias("rows"),
        F.sum(F.when(F.col(REJECTED), 1).otherwise(0)).alias("rows_rejected"),
        F.max(F.xxhash64(*values)).alias("read"),
    )
    listing = load.df.sparkSession.createDataFrame(
        [(name, len(columns)) for name, columns in load.columns.items()], "source string, columns bigint"
    )
    read = lambda name: F.when(F.col("read").isNull(), F.lit(0)).otherwise(F.col(name)).alias(name)
    return listing.join(counts, "source", "left").select("source", read("rows"), read("rows_rejected"), "columns")


def load_summary(load: Load) -> DataFrame:
    """(source, rows, columns) of every source that was loaded, also of those without rows."""
    return _source_facts(load).select("source", "rows", "columns")


def load_validation(load: Load) -> DataFrame:
    """Load summary with the rows that did not parse and a verdict per source.

    `ok`, `empty` (a warning), `no_columns` (a failure) or `skipped` (a source that could not be read).
    """
    verdict = F.when(F.col("columns") == 0, "no_columns").when(F.col("rows") == 0, "empty").otherwise("ok")
    facts = _source_facts(load).select("source", "rows", "columns", "rows_rejected", verdict.alias("verdict"))
    if not load.skipped:
        return facts
    left_out = load.df.sparkSession.createDataFrame([(name,) for name in load.skipped], "source string")
    nothing = [F.lit(0).cast("bigint").alias(c) for c in ("rows", "columns", "rows_rejected")]
    return facts.unionByName(left_out.select("source", *nothing, F.lit("skipped").alias("verdict")))


def drop_source(df: DataFrame) -> DataFrame:
    return df.drop(SOURCE)
