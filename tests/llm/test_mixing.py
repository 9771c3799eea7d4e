from collections import Counter

import pytest

from gapweave.llm import mixing

WEIGHTS = {"a": 3, "b": 2, mixing.REST: 5}


def mixed(spark, rows, block=4, weights=WEIGHTS):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    return mixing.mix(docs, weights, block).orderBy("mix_position").collect()


def test_less_than_one_block_from_target(spark):
    rows = [(i, "a" if i % 10 < 3 else "b" if i % 10 < 5 else f"other{i % 3}", "t") for i in range(400)]
    got = mixed(spark, rows)
    assert Counter(r.doc_id for r in got) == Counter(range(400))
    slots = {r.mix_slot: r.mix_source for r in got}
    assert sorted(slots) == list(range(100))
    seen = Counter()
    for slot in range(100):
        seen[slots[slot]] += 1
        for source, weight in WEIGHTS.items():
            assert abs(seen[source] - (slot + 1) * weight / 10) < 1


def test_sources_run_out_and_nothing_is_lost(spark):
    rows = [(i, "a", None) for i in range(9)] + [(i, None, "") for i in range(100, 260)] + [(500, "b", "x")] * 3
    got = mixed(spark, rows)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert len({r.mix_position for r in got}) == len(rows)
    assert {r.mix_source for r in got if r.source is None} == {mixing.REST}


def test_null_ids_empty_tables_and_clashes(spark):
    assert len(mixed(spark, [(None, "a", "x"), (None, "a", "y"), (1, "zz", None)])) == 3
    assert mixed(spark, []) == []
    with pytest.raises(ValueError, match="already there"):
        mixing.mix(spark.createDataFrame([(1, "a", 2)], "doc_id bigint, source string, Mix_Slot int"), WEIGHTS)
    with pytest.raises(ValueError, match="weights"):
        mixing.mix(spark.createDataFrame([(1, "a")], "doc_id bigint, source string"), {"a": 1})


def test_same_order_however_it_is_partitioned(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(200)], "doc_id bigint, source string")
    one = mixing.mix(docs.repartition(1), WEIGHTS).collect()
    many = mixing.mix(docs.repartition(7), WEIGHTS).collect()
    assert sorted(one) == sorted(many)


def test_files_follow_the_mix(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(200)], "doc_id bigint, source string")
    ordered = mixing.in_mix_order(mixing.mix(docs, WEIGHTS), 3)
    parts = ordered.rdd.glom().collect()
    positions = [row.mix_position for part in parts for row in part]
    assert positions == sorted(positions)


def test_every_source_has_a_weight_of_its_own(spark):
    names = ["a", "b"] + [f"s{i:02}" for i in range(17)] + [None]
    rows = [(i, name, "t") for i, name in enumerate(name for name in names for _ in range(240))]
    rows += [(10_000 + i, "s03", "hot") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    weights = mixing.each_source(docs, WEIGHTS)
    assert set(weights) == {n or mixing.REST for n in names}
    total = sum(weights.values())
    assert weights["a"] * 10 == 3 * total and weights["b"] * 10 == 2 * total
    assert all(weights[n or mixing.REST] * 36 == total for n in names[2:])
    got = mixing.mix(docs, weights, 4).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    slots = {r.mix_slot: r.mix_source for r in got}
    seen = Counter()
    for slot in range(60 * 3):  # until the first source runs out
        seen[slots[slot]] += 1
        assert all(abs(seen[s] - (slot + 1) * w / total) < 1 for s, w in weights.items())


def test_too_many_sources_are_refused_and_none_are_fine(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    docs = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "doc_id bigint, source string")
    with pytest.raises(ValueError, match="sources"):
        mixing.each_source(docs, WEIGHTS)
    assert mixing.each_source(docs.limit(0), WEIGHTS) == WEIGHTS


def test_columns_of_any_other_name_come_back(spark):
    names = "_row _id _order _part _rows _offset _number _rank _at turn weight since until length sources before slot source_x a`b".split()
    columns = ["doc_id", "source", *names]
    docs = spark.createDataFrame([(n, "ab"[n % 2], *range(len(names))) for n in range(40)], columns)
    got = mixing.mix(docs, WEIGHTS, 4)
    assert got.columns[: len(columns)] == columns
    assert sorted(map(tuple, got.select(*(f"`{c.replace('`', '``')}`" for c in columns)).collect())) == sorted(map(tuple, docs.collect()))
