"""One date format per column and source, chosen by what fits its values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.dates import parse_date
from gapweave.functions.text import quoted
from gapweave.storage import materialize

#: Sources whose choices are broadcast; with more of them Spark chooses the join.
BROADCAST_SOURCES = 100_000


def format_votes(df: DataFrame, columns: Sequence[str], formats: Sequence[str], source: str | None = None) -> DataFrame:
    """(source, column, values, fits, formats): how many values each format fits, and the formats in the order to try them.

    One pass over `df` whatever the number of columns and formats; only counts are shuffled. The format that fits most
    values comes first, among equals the one listed first. `fits` follows the order of `formats` in the call. Without a
    `source` column the whole table is one source, null. An empty table gives no rows, as does one without columns.
    """
    origin = F.lit(None).cast("string") if source is None else quoted(source)
    if not columns:
        return df.select(origin.alias("source")).where(F.lit(False)).selectExpr(
            "source", "'' AS column", "0L AS values", "array(0L) AS fits", "array('') AS formats"
        )

    def votes(name: str):
        fits = F.array(*[F.count(parse_date(quoted(name), [pattern])) for pattern in formats])
        return F.struct(F.lit(name).alias("column"), F.count(quoted(name)).alias("values"), fits.alias("fits"))

    places = F.array(*[F.struct((-F.get("fits", F.lit(i))).alias("n"), F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(formats)])
    counted = df.groupBy(origin.alias("source")).agg(F.array(*map(votes, columns)).alias("votes"))
    return counted.select("source", F.inline("votes")).withColumn("formats", F.transform(F.array_sort(places), lambda f: f["p"]))


def parse_dates_by_vote(df: DataFrame, columns: Sequence[str], formats: Sequence[str], source: str | None = None) -> DataFrame:
    """`df` with the columns as timestamps, each read by the format that fits most of the column's values in that source.

    So `03/04/2024` is the third of April where the column also holds `25/04/2024`. Values that this format does not fit
    are read by the next best one, and are null if none fits. A column of ambiguous values only takes the format listed
    first. Nulls stay null; a null source is a source of its own; other columns and repeated rows stay as they are.
    """
    if not formats:
        raise ValueError("No date formats given")
    if not columns:
        return df
    votes = format_votes(df, columns, formats, source)
    chosen = votes.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "formats"))).alias("chosen")
    )
    chosen = materialize(chosen.select(F.col("source").alias("_vote_source"), F.col("chosen").alias("_vote")), "votes")
    if chosen.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        chosen = F.broadcast(chosen)
    # The row travels as one value, so none of its names can clash.
    rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_vote_row"))
    origin = F.lit(None).cast("string") if source is None else F.col("_vote_row")[source]
    joined = rows.withColumn("_vote_origin", origin)
    joined = joined.join(chosen, F.col("_vote_origin").eqNullSafe(F.col("_vote_source")), "left")

    def parsed(name: str):
        value, chosen_formats = F.col("_vote_row")[name], F.col("_vote")[name]

        def by_format_at(place: int):
            chosen_format = F.get(chosen_formats, F.lit(place))
            attempt = F.lit(None).cast("timestamp_ntz")
            for pattern in formats:
                attempt = F.when(chosen_format == pattern, parse_date(value, [pattern])).otherwise(attempt)
            return attempt

        # The next format is only tried on a value that the ones before it do not fit.
        return F.coalesce(*map(by_format_at, range(len(formats))))

    return joined.select(
        *[(parsed(c) if c in columns else F.col("_vote_row")[c]).alias(c) for c in df.columns]
    )
