import math

import numpy as np
import pytest

from gapweave.llm import ann, topk

ODD = [(900, None), (901, [1.0, None]), (902, [float("nan"), 1.0]), (903, [float("inf"), 1.0]), (None, [1.0, 2.0])]
SCHEMA = "vec_id bigint, embedding array<float>, score string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(3)


def fine(rows):
    return [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def ranked(rows, is_query, k, score):
    out = []
    for q, v in rows:
        if is_query(q):
            found = sorted((-score(v, w), i) for i, w in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(n, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim))
    rows = centres[rng.integers(0, 8, n)] + 0.4 * rng.standard_normal((n, dim))
    return [(i, [float(np.float32(x)) for x in row / np.linalg.norm(row)]) for i, row in enumerate(rows)]


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE_ROWS", 60)
    rows = vectors(200) + [(300 + i, vectors(1, seed=9)[0][1]) for i in range(70)] + [(950, [0.0] * 12), (1000, [0.5])] + ODD
    df = frame(spark, rows)
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, 5).collect()
    whole = lambda v, w: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w))
    assert sorted(map(tuple, got)) == ranked(fine(rows), lambda q: q % 50 == 0, 5, whole)


def test_top_k_copies_no_queries_and_broadcasts_nothing(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE_ROWS", 20)
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    rows = vectors(200)
    df = frame(spark, rows)
    got = topk.top_k(df.where("vec_id % 10 = 0"), df, 5)
    assert len(got.collect()) == 20 * 5
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


def test_top_k_of_few_rows_and_none(spark):
    df = frame(spark, [(0, [1.0]), (50, [2.0])])
    assert sorted(map(tuple, topk.top_k(df, df, 5).collect())) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    none = frame(spark, [])
    assert topk.top_k(none, none, 5).collect() == []


def test_blocks_are_skipped_and_large_numbers_stay_exact():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * np.repeat(rng.standard_normal((20, 16)), 50, axis=0) + rng.standard_normal((1_000, 16)))
    ids = np.arange(1_000)
    found, scored = topk.search_range(ids[:5], rows[:5], ids, rows, 3, block_rows=50)
    assert scored < 5 * 20
    exact = rows[:5] @ rows.T
    exact[np.arange(5), np.arange(5)] = -np.inf
    want = [(q, int(i), int(exact[q, i])) for q in range(5) for i in np.lexsort((ids, -exact[q]))[:3]]
    assert found == want
    large = np.array([[3.0e9, 1.0], [3.0e9, 2.0], [3.0e9, 3.0]])
    found, _ = topk.search_range(np.array([7]), large[:1], np.array([1, 2, 3]), large, 2)
    assert found == [(7, 3, 9 * 10**18 + 3), (7, 2, 9 * 10**18 + 2)]


def test_ann_recall_scores_and_ties(spark):
    rows = vectors(1_500) + [(5_000 + i, [0.0] * 12) for i in range(3)] + ODD
    df = frame(spark, rows)
    got = ann.search(df.where("vec_id % 20 = 0"), df, 10).collect()
    kept = [(i, v) for i, v in fine(rows) if any(v)]
    want = ranked(kept, lambda q: q % 20 == 0, 10, lambda v, w: sum(a * b for a, b in zip(v, w)))
    assert len(got) == len(want)
    assert len({(r[0], r[2]) for r in got} & {(w[0], w[2]) for w in want}) / len(want) >= 0.9
    by_id = dict(kept)
    for r in got:
        assert r.score == pytest.approx(sum(a * b for a, b in zip(by_id[r.query_id], by_id[r.vec_id])), abs=1e-15)


def test_ann_with_very_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    same = vectors(1, seed=3)[0][1]
    df = frame(spark, [(i, same) for i in range(400)] + [(1_000 + i, v) for i, v in vectors(400)])
    got = ann.search(df.where("vec_id = 20"), df, 5).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [0, 1, 2, 3, 4]


def test_ann_of_few_rows_and_none(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (20, [1.0, 0.5]), (21, [0.5, 0.5])])
    got = {(r.query_id, r["rank"], r.vec_id) for r in ann.search(df.where("vec_id % 20 = 0"), df, 20).collect()}
    assert got == {(0, 1, 20), (0, 2, 21), (20, 1, 0), (20, 2, 21)}
    none = frame(spark, [])
    assert ann.search(none, none, 5).collect() == []


def test_parts_are_balanced_and_cut_few_edges():
    points = np.array([v for _, v in vectors(800)])
    graph = ann.neighbours(points, 10)
    label = ann.balanced_parts(points, graph, 8, np.random.default_rng(0))
    assert np.bincount(label, minlength=8).max() <= 1.1 * 800 / 8 + 1
    inside = (label[graph] == label[:, None]).mean()
    assert inside > 0.6


def test_ann_recall_of_twenty_with_tens_of_parts():
    points = np.array([v for _, v in vectors(20_000)])
    sample = points[np.random.default_rng(5).permutation(len(points))[: ann.FIT_ROWS]]
    router = ann.fit_router(sample, 24, 20)
    place = router.best(points, 1)[:, 0]
    asked = np.arange(0, len(points), 40)
    sizes = np.bincount(place, minlength=24)
    looked = router.looked_into(points[asked], sizes, 20)
    near = ann.neighbours(points, 20, asked)
    found = np.mean([np.isin(place[near[i]], looked[i]).mean() for i in range(len(asked))])
    assert found >= 0.96
    assert np.mean([sizes[parts].sum() for parts in looked]) < len(points) / 2


def test_ann_looks_beyond_empty_parts():
    router = ann.Router([np.zeros((2, 1)), np.zeros(1), np.zeros((1, 4)), np.array([3.0, 2.0, 1.0, 0.0])], 2)
    looked = router.looked_into(np.ones((1, 2)), np.array([0, 3, 50, 50]), 20)
    assert [list(parts) for parts in looked] == [[0, 1, 2]]
    assert list(router.looked_into(np.ones((1, 2)), np.array([9, 30, 5, 5]), 20)[0]) == [0, 1]
