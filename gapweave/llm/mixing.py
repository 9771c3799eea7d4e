"""Mixing sources to target weights, by Pfair scheduling in DataFrame operations.

Rows of a source are put in a shuffled order and cut into blocks. A source of weight w, out of weights that sum
to W, has one block for each of its windows: block j may not start before slot floor(j * W / w) and must be
done by slot ceil((j + 1) * W / w). Earliest deadline first meets all windows, so after any number of slots
each source is less than one block away from its share.

Weights are integers, so the schedule repeats every W slots. A period is therefore computed once, by a fold whose
size depends on the weights alone, and every block finds its slot by arithmetic: nothing is scheduled row
by row. When a source runs out, the periods go on among the others, which keep their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Weight of all sources that are not listed; they are mixed as one.
REST = "*"
#: Sources that `each_source` gives weights of their own at most; the fold of `mix` grows with them.
MOST_SOURCES = 200
_HEX_DIGITS = 3


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def each_source(docs: DataFrame, weights: dict[str, int], source_column: str = "source") -> dict[str, int]:
    """`weights` with one for every source of `docs`: those not listed share the weight of `"*"` evenly.

    All weights are scaled to stay integers, so listed sources keep their shares. `"*"` is left to a null source (and
    one of that name), which counts as one of those that share. More than `MOST_SOURCES` sources are refused rather than
    pooled. The driver gets one row per source.
    """
    seen = [row[0] for row in docs.select(source_column).distinct().limit(MOST_SOURCES + 1).collect()]
    if len(seen) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    unlisted = {REST if name is None else name for name in seen} - (weights.keys() - {REST})
    scaled = {name: weight * max(1, len(unlisted)) for name, weight in weights.items() if name != REST}
    scaled |= dict.fromkeys([*sorted(unlisted), REST], weights[REST])
    divisor = math.gcd(*scaled.values())
    return {name: weight // divisor for name, weight in scaled.items()}


def _period(sources: Column) -> Column:
    """Earliest deadline first over one period.

    sources: array of structs (source, weight). Gives an array of structs (source, turn, slot): the turn-th block
    of the source in this period has this slot. Equal deadlines go by the order of the sources.
    """
    total = F.aggregate(sources, F.lit(0).cast("bigint"), lambda acc, s: acc + s["weight"])

    def step(total: Column):
        def run(acc: Column, slot: Column) -> Column:
            due = F.transform(
                sources,
                lambda s, i: F.when(
                    (F.get(acc["done"], i) < s["weight"])
                    & (F.get(acc["done"], i) * total < (slot + 1) * s["weight"]),  # released
                    F.struct(
                        F.ceil((F.get(acc["done"], i) + 1) * total / s["weight"]).alias("deadline"), i.alias("place")
                    ),
                ),
            )
            place = F.array_min(due)["place"]
            return F.get(
                F.transform(
                    F.array(place),
                    lambda p: F.struct(
                        F.transform(acc["done"], lambda n, i: F.when(i == p, n + 1).otherwise(n)).alias("done"),
                        F.concat(
                            acc["slots"],
                            F.array(
                                F.struct(
                                    F.get(sources, p)["source"].alias("source"),
                                    F.get(acc["done"], p).alias("turn"),
                                    slot.alias("slot"),
                                )
                            ),
                        ).alias("slots"),
                    ),
                ),
                F.lit(0),
            )

        return run

    empty = F.array().cast("array<struct<source:string,turn:bigint,slot:bigint>>")
    start = F.struct(F.transform(sources, lambda _: F.lit(0).cast("bigint")).alias("done"), empty.alias("slots"))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), total - 1), start, step(total), lambda acc: acc["slots"])


def mix(
    docs: DataFrame,
    weights: dict[str, int],
    block_rows: int = 16,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """All rows and columns of `docs`, with the place of each row in the mix.

    Adds `mix_source`, `mix_block` (number of the block in its source), `mix_slot` (of the block) and `mix_position`
    (of the row; increasing, with gaps after blocks that are not full). Sorting by `mix_position` gives the mix.

    `weights` names sources and must have `"*"` for all others, a null source included, which are mixed as
    one. Rows are ordered in their source by the md5 of the id, then by the id and the other columns; fully equal
    rows may swap. No row is dropped. A period in which a source runs out skips its missing blocks.
    Columns named like the added ones are refused, whatever their case; any others come back as they are. An empty table gives an empty result.
    """
    if REST not in weights or any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError(f"weights are integers of 1 or more, with one for {REST!r}")
    added = {"mix_source", "mix_block", "mix_slot", "mix_position"}
    if clash := added & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns already there: {sorted(clash)}")
    spark = docs.sparkSession
    listed = [name for name in weights if name != REST]
    source = F.when(F.col(source_column).isin(listed), F.col(source_column)).otherwise(F.lit(REST))
    order = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    # A source is dealt to many partitions by the first digits of the order, whose row counts give the offsets.
    # The row itself travels as one value, so none of its names can meet those used here.
    keyed = docs.select(
        F.struct("*").alias("_row"), F.col(id_column).alias("_id"),
        F.coalesce(source, F.lit(REST)).alias("mix_source"), order.alias("_order"),
    ).withColumn("_part", F.substring("_order", 1, _HEX_DIGITS))
    counts = keyed.groupBy("mix_source", "_part").agg(F.count("*").alias("_rows"))
    offsets = counts.select(
        "mix_source",
        "_part",
        (F.sum("_rows").over(W.partitionBy("mix_source").orderBy("_part")) - F.col("_rows")).alias("_offset"),
    )
    weight = spark.createDataFrame(sorted((k, int(v)) for k, v in weights.items()), "mix_source string, weight bigint")
    sizes = (
        counts.groupBy("mix_source")
        .agg(F.sum("_rows").alias("rows"))
        .join(F.broadcast(weight), "mix_source")
        .select("mix_source", "weight", F.ceil(F.ceil(F.col("rows") / block_rows) / F.col("weight")).alias("periods"))
    )
    # Phases: stretches of periods with the same sources. There are at most as many as weights.
    ends = sizes.groupBy().agg(F.array_sort(F.collect_set("periods")).alias("ends"), F.collect_list(
        F.struct(F.col("mix_source").alias("source"), "weight", "periods")
    ).alias("all"))
    phases = ends.select("all", "ends", F.posexplode("ends").alias("i", "until")).select(
        F.when(F.col("i") > 0, F.get("ends", F.col("i") - 1)).otherwise(F.lit(0)).alias("since"),
        "until",
        F.transform(
            F.array_sort(F.filter("all", lambda s: s["periods"] >= F.col("until"))),
            lambda s: F.struct(s["source"].alias("source"), s["weight"].alias("weight")),
        ).alias("sources"),
    )
    total = F.aggregate("sources", F.lit(0).cast("bigint"), lambda acc, s: acc + s["weight"])
    length = phases.select("*", total.alias("length"))
    before = F.coalesce(
        F.sum((F.col("until") - F.col("since")) * F.col("length")).over(
            W.orderBy("since").rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    timed = length.select("since", "until", "length", "sources", before.alias("before"))
    slots = timed.select("since", "until", "length", "before", F.inline(_period(F.col("sources")))).withColumnRenamed(
        "source", "mix_source"
    )
    sortable = [F.col(f"_row.{_quoted(c)}") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    numbered = (
        keyed.withColumn(
            "_number",
            F.row_number().over(
                W.partitionBy("mix_source", "_part").orderBy("_order", "_id", F.xxhash64(*sortable))
            ),
        )
        # At most (number of weights) * 4,096 rows.
        .join(F.broadcast(offsets), ["mix_source", "_part"])
        .withColumn("_rank", F.col("_offset") + F.col("_number") - 1)
        .withColumn("mix_block", F.floor(F.col("_rank") / block_rows))
        .join(F.broadcast(weight), "mix_source")
        .withColumn("turn", F.col("mix_block") % F.col("weight"))
        .withColumn("_at", F.floor(F.col("mix_block") / F.col("weight")))
    )
    placed = numbered.alias("n").join(
        # At most (number of weights) * (sum of the weights) rows.
        F.broadcast(slots).alias("s"),
        (F.col("n.mix_source") == F.col("s.mix_source"))
        & (F.col("n.turn") == F.col("s.turn"))
        & (F.col("n._at") >= F.col("s.since"))
        & (F.col("n._at") < F.col("s.until")),
    )
    slot = F.col("s.before") + (F.col("n._at") - F.col("s.since")) * F.col("s.length") + F.col("s.slot")
    return placed.select(
        *(F.col(f"n._row.{_quoted(c)}").alias(c) for c in docs.columns),
        F.col("n.mix_source"),
        F.col("n.mix_block"),
        slot.alias("mix_slot"),
        (slot * block_rows + F.col("n._rank") % block_rows).alias("mix_position"),
    )


def in_mix_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows sorted by `mix_position`, range-partitioned, so that files follow the mix."""
    n = partitions or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(n, "mix_position").sortWithinPartitions("mix_position")
