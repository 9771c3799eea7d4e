"""Prefix trie of conversations, by collapsing whole sequences.

Every conversation becomes a chain of digests, one for each of its prefixes, so a prefix is known by 16 bytes. Equal
whole conversations are then one sequence with a weight and a list of those that end there. A sequence that is a proper
prefix of another falls out of the leaves by an anti-join. The rest is sums of weights over the prefixes of distinct
sequences: a thousand copies of a conversation cost as much as one.

`conv_id` names a node by its smallest member. A sequence is followed through its smallest member, its representative;
of the sequences through a node, the one of the smallest member owns it. Each node has one owner, so what is summed over
a subtree is summed over the owned nodes below on every sequence that passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.llm.streams import joined_digests, walk_sorted
from gapweave.storage import materialize

ROOT = bytes(16)
_ID_BITS = 12
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_PATH = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
    ("words", pa.int64()), ("last", pa.bool_()),
])
_PATH_DDL = "conv_id bigint, depth bigint, node binary, parent binary, words bigint, last boolean"


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of role and text, unambiguous where one of them ends."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def rebuilt_turns(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, skip, part, turn, role, digest, words): the turns of every rebuilt conversation.

    Conversation c takes the first h turns of c - c % family and its own turns after its first h, where h is the
    unsigned CRC-32 of the decimal c, modulo `heads`. Part 0 holds the former, part 1 all of c's own turns, of which the
    first `skip` = h do not count. Turns go by `turn` (nulls first), role and digest. Rows without conv_id take no part.
    Every null role or text counts as empty.
    """
    role, text = (F.coalesce(F.col(f"t.{c}"), F.lit("")) for c in ("role", "text"))
    skip = F.crc32(F.col("conv_id").cast("string")) % heads
    own = turns.alias("t").where("t.conv_id IS NOT NULL").select(
        "t.conv_id", "t.turn", role.alias("role"), turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    base = F.col("conv_id") - F.col("conv_id") % family
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    first = (
        own.where(F.col("conv_id") % family == 0)
        .withColumn("place", F.row_number().over(by_turn))
        .where(F.col("place") < heads)
        .select(F.col("conv_id").alias("base"), (F.col("place") - 1).cast("bigint").alias("place"), "role", "digest", "words")
    )
    members = own.select("conv_id").distinct().select("conv_id", skip.alias("skip"), base.alias("base"))
    taken = members.join(first, "base").where("place < skip")
    return (
        own.select("conv_id", skip.alias("skip"), F.lit(1).alias("part"), "turn", "role", "digest", "words")
        .unionByName(taken.select("conv_id", "skip", F.lit(0).alias("part"), F.col("place").alias("turn"), "role", "digest", "words"))
    )


def _chains(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of `_PATH` from sorted rows (conv_id, skip, part, digest, words): the prefixes of each conversation."""
    conv, held, left = None, None, 0
    for conv_id, skip, part, digest, words in rows:
        if held is None or conv_id != conv:
            if held is not None:
                yield *held, True
            conv, held, left = conv_id, (conv_id, 0, ROOT, None, 0), skip
        if part == 1 and left:
            left -= 1
            continue
        yield *held, False
        node = hashlib.sha256(held[2] + digest).digest()[:16]
        held = (conv_id, held[1] + 1, node, held[2], words)
    if held is not None:
        yield *held, True


def prefix_paths(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, depth, node, parent, words, last): every prefix of every rebuilt conversation, the root included."""
    order = [F.col("part"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        return _chains((c, skip, part, digest, words) for c, skip, part, _, _, digest, words in rows)

    return walk_sorted(rebuilt_turns(turns, family, heads), "conv_id", order, walk, _PATH, _PATH_DDL)


def ends(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which a conversation ends; at most 4,096 ids are ever one row."""
    block = F.shiftright("conv_id", _ID_BITS).alias("block")
    pieces = paths.where("last").groupBy("node", block).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    )
    return joined_digests(pieces, "node", "block", "ids")


def prefix_trie(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see `rebuilt_turns`).

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves
    (childless nodes in its subtree), saved_tokens ((members - 1) * words of the last text, summed over its subtree) and
    ends_sha256 (of the comma-joined ids of those that end there). `turns` has conv_id, turn, role and text; other
    columns are ignored. Rows that repeat are turns of their own. Turns of the same number go by role and SHA-256 of
    role and text. No conversations, no rows. Texts of any length are hashed in full and never shuffled.
    """
    paths = materialize(prefix_paths(turns, family, heads), "paths")
    whole = paths.where("last").groupBy("node").agg(F.count("*").alias("weight"), F.min("conv_id").alias("rep"))
    inner = paths.where("NOT last").select("node").distinct()
    leaves = whole.join(inner, "node", "left_anti").select("rep", F.lit(1).alias("leaf"))
    sequences = whole.join(leaves, "rep", "left").select(
        "rep", "weight", F.coalesce("leaf", F.lit(0)).cast("bigint").alias("leaf")
    )
    steps = materialize(
        paths.join(sequences, F.col("conv_id") == F.col("rep")).select("rep", "weight", "leaf", "depth", "node", "parent", "words"),
        "sequences",
    )
    nodes = materialize(
        steps.groupBy("node").agg(
            F.min("rep").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.max("words").alias("words"),
        ),
        "nodes",
    )
    owned = nodes.select(
        F.col("conv_id").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("value")
    )
    below = Window.partitionBy("rep").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    saved = (
        steps.select("rep", "depth", "node")
        .join(owned, ["rep", "depth"], "left")
        .withColumn("value", F.sum(F.coalesce("value", F.lit(0))).over(below))
        .groupBy("node").agg(F.sum("value").alias("saved_tokens"))
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(saved, "node").join(children, "node", "left").join(ends(paths), "node", "left").join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )
    )
