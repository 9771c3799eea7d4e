import logging
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from gapweave.catalog.search import knn_exact, knn_ivf, knn_lsh
from gapweave.operators import knn
from gapweave.operators.encode import HashedTokenEncoder, embed_cached, embed_texts, lexical_vectors, mean_pool
from gapweave.operators.knn import (
    BlockLimits,
    cell_count,
    hash_bits,
    hash_patterns,
    nearest,
    probes_for,
    random_hyperplanes,
    train_centroids,
)
from gapweave.operators.scoring import (
    CodeScorer,
    DenseScorer,
    LexicalScorer,
    decode_vectors,
    encode_vectors,
    match_block,
    prepare,
)
from gapweave.operators.validate import require_searchable

SMALL = BlockLimits(block_rows=16, broadcast_rows=0)
BROADCAST = BlockLimits()


def brute_force(targets, masters, k, threshold, score):
    """(target, master, score, rank) by comparing every pair in plain Python."""
    found = set()
    for t, x in targets:
        pairs = [(-s, m) for m, y in masters if (s := score(x, y)) is not None and s >= threshold]
        found |= {(t, m, -s, i + 1) for i, (s, m) in enumerate(sorted(pairs)[:k])}
    return found


def dense_score(x, y):
    x, y = np.float32(x).astype(float), np.float32(y).astype(float)
    return round(float(x @ y), 6) if x.any() and y.any() else None


def token_score(x, y):
    a, b = Counter(x.lower().split()), Counter(y.lower().split())
    if not a or not b:
        return None
    norms = sum(n * n for n in a.values()) * sum(n * n for n in b.values())
    return round(sum(n * b[w] for w, n in a.items()) / norms**0.5, 6)


def frame(spark, side, kind, rows):
    column = "vector array<float>" if kind == "vector" else "text string"
    rows = [(k, [float(v) for v in x] if kind == "vector" else x) for k, x in rows]
    key = "string" if isinstance(rows[0][0], str) else "bigint"
    return spark.createDataFrame(rows, f"{side}_key {key}, {column}")


def result(df):
    return {(r["target_key"], r["master_key"], r["score"], r["rank"]) for r in df.collect()}


def unit(rng, n, d=8):
    v = rng.standard_normal((n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def vectors():
    """A third of the masters are copies of one vector; both sides hold a zero vector."""
    rng = np.random.default_rng(1)
    masters = unit(rng, 90)
    masters[::3] = masters[0]
    masters[1] = 0
    targets = np.vstack([unit(rng, 40), masters[:1], np.zeros((1, 8))])
    return list(enumerate(targets)), list(enumerate(masters))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)]

    def text():
        n = int(rng.integers(1, 25))
        return " ".join(rng.choice(words, n, p=np.arange(60, 0, -1) / 1830.0))

    masters = [text() for _ in range(120)]
    masters[::3] = [masters[0]] * 40
    masters[1] = "  "
    targets = [text() for _ in range(70)] + [masters[0].upper(), "", masters[0] + "\n zz"]
    return list(enumerate(targets)), list(enumerate(masters))


@pytest.mark.parametrize("limits", [BROADCAST, SMALL], ids=["broadcast", "blocks"])
@pytest.mark.parametrize("k, threshold", [(1, 0.3), (5, 0.3), (200, -1.0), (1, 0.0)])
def test_dense_search_equals_brute_force(spark, vectors, limits, k, threshold):
    targets, masters = vectors
    got = nearest(frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters),
                  k, threshold, limits=limits)
    assert result(got) == brute_force(targets, masters, k, threshold, dense_score)


@pytest.mark.parametrize("limits", [BROADCAST, SMALL], ids=["broadcast", "blocks"])
@pytest.mark.parametrize("k, threshold", [(1, 0.6), (7, 0.6), (1, 0.0), (60, 0.0)])
def test_lexical_search_equals_brute_force(spark, texts, limits, k, threshold):
    targets, masters = texts
    got = nearest(frame(spark, "target", "text", targets), frame(spark, "master", "text", masters),
                  k, threshold, scorer=LexicalScorer(), limits=limits)
    assert result(got) == brute_force(targets, masters, k, threshold, token_score)


@pytest.mark.parametrize("k, threshold", [(1, 0.4), (7, 0.6), (60, 0.8), (3, 0.95)])
def test_prefix_search_equals_brute_force(spark, texts, k, threshold):
    targets, masters = texts
    t, m = frame(spark, "target", "text", targets), frame(spark, "master", "text", masters)
    limits = BlockLimits(block_rows=16, bucket_rows=20)
    got = nearest(t, m, k, threshold, "prefix", LexicalScorer(), limits=limits)
    assert result(got) == brute_force(targets, masters, k, threshold, token_score)


def test_short_texts_are_compared_by_prefix_and_long_ones_in_blocks(spark, monkeypatch):
    from gapweave.operators import knn

    def refuse(*args, **kwargs):
        raise AssertionError("blocks")

    rows = [(i, f"pump p{i} q{i % 7} r{i % 11}") for i in range(200)]
    t, m = frame(spark, "target", "text", rows), frame(spark, "master", "text", rows)
    limits = BlockLimits(broadcast_rows=0, bucket_rows=5)
    exact = brute_force(rows, rows, 2, 0.7, token_score)
    assert result(nearest(t, m, 2, 0.7, scorer=LexicalScorer(), limits=limits)) == exact
    monkeypatch.setattr(knn, "block_knn", refuse)
    assert result(nearest(t, m, 2, 0.7, scorer=LexicalScorer(), limits=limits)) == exact
    long = [(i, " ".join(f"w{j}" for j in range(i % 5, 60))) for i in range(200)]
    t, m = frame(spark, "target", "text", long), frame(spark, "master", "text", long)
    with pytest.raises(AssertionError, match="blocks"):
        nearest(t, m, 2, 0.2, scorer=LexicalScorer(), limits=limits)


def test_prefix_search_is_for_texts_above_a_threshold(spark, texts, vectors):
    t, m = (frame(spark, side, "text", rows) for side, rows in zip(("target", "master"), texts))
    with pytest.raises(ValueError, match="0.1"):
        nearest(t, m, 1, 0.0, "prefix", LexicalScorer())
    t, m = (frame(spark, side, "vector", rows) for side, rows in zip(("target", "master"), vectors))
    with pytest.raises(ValueError, match="texts"):
        nearest(t, m, 1, 0.5, "prefix")


def test_lexical_slices_do_not_change_the_result(spark, texts, monkeypatch):
    import pyarrow as pa

    from gapweave.operators import scoring

    targets, masters = (
        pa.table({f"{side}_key": [k for k, _ in rows], "text": [" ".join(x.lower().split()) for _, x in rows]})
        for side, rows in zip(("target", "master"), texts)
    )
    whole = scoring.match_block(targets, scoring.prepare(masters, LexicalScorer()), 3, 0.2)
    monkeypatch.setattr(scoring, "_SLICE_BYTES", 200)
    monkeypatch.setattr(scoring, "_CELLS", 300)
    monkeypatch.setattr(scoring, "_DENSE_CELLS", 400)
    cut = scoring.match_block(targets, scoring.prepare(masters, LexicalScorer()), 3, 0.2)
    order = [("target_key", "ascending"), ("rank", "ascending")]
    assert cut.sort_by(order).to_pylist() == whole.sort_by(order).to_pylist()


def test_text_keys(spark):
    targets = [("t1", [1, 0]), ("t2", [0, 1])]
    masters = [("b", [1, 0]), ("a", [1, 0]), ("c", [0.6, 0.8])]
    for limits in (BROADCAST, SMALL):
        got = nearest(frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters), 1, 0.5, limits=limits)
        assert result(got) == {("t1", "a", 1.0, 1), ("t2", "c", 0.8, 1)}


def test_no_match_and_no_masters(spark):
    target = frame(spark, "target", "vector", [(1, [1, 0])])
    master = frame(spark, "master", "vector", [(1, [0, 1])])
    for limits in (BROADCAST, SMALL):
        assert nearest(target, master, 1, 0.5, limits=limits).count() == 0
        assert nearest(target, master.limit(0), 1, 0.5, limits=limits).count() == 0
        assert nearest(target.limit(0), master, 1, 0.5, limits=limits).count() == 0


def test_unknown_index_type_is_reported_and_exact(spark, vectors, caplog):
    targets, masters = vectors
    with caplog.at_level(logging.WARNING):
        got = nearest(frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters), 1, 0.3, "annoy")
    assert "annoy" in caplog.text
    assert result(got) == brute_force(targets, masters, 1, 0.3, dense_score)


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors around five directions, a third of them in one tight bundle."""
    rng = np.random.default_rng(3)
    centers = unit(rng, 5, 16)
    which = np.where(rng.random(300) < 0.4, 0, rng.integers(0, 5, 300))
    points = centers[which] + 0.15 * rng.standard_normal((300, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = list(enumerate(points))
    centroids = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "cell int, centroid array<double>")
    return rows[:100], rows[100:], centroids


@pytest.mark.parametrize("threshold", [0.0, 0.8, 0.95])
def test_cells_are_exact(spark, clustered, threshold):
    targets, masters, centroids = clustered
    got = nearest(frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters), 3, threshold,
                  "cells", centroids=centroids, limits=SMALL)
    assert result(got) == brute_force(targets, masters, 3, threshold, dense_score)


def test_probing_every_cell_is_exact_and_fewer_only_lose_matches(spark, clustered):
    targets, masters, centroids = clustered
    t, m = frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters)
    exact = brute_force(targets, masters, 200, 0.5, dense_score)
    all_cells = nearest(t, m, 200, 0.5, "ivfflat", centroids=centroids, nprobe=5, limits=SMALL)
    assert result(all_cells) == exact
    one_cell = {r[:3] for r in result(nearest(t, m, 200, 0.5, "ivfflat", centroids=centroids, nprobe=1))}
    assert one_cell <= {r[:3] for r in exact}
    assert len(one_cell) > 0.5 * len(exact)


def test_hashed_search_gives_true_scores_and_no_pair_twice(spark, clustered):
    targets, masters, _ = clustered
    t, m = frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters)
    planes = random_hyperplanes(16, tables=8, bits=3)
    rows = nearest(t, m, 200, 0.8, "hnsw", hyperplanes=planes, limits=SMALL).collect()
    pairs = {(r["target_key"], r["master_key"], r["score"]) for r in rows}
    exact = {r[:3] for r in brute_force(targets, masters, 200, 0.8, dense_score)}
    assert len(pairs) == len(rows)
    assert pairs <= exact
    assert len(pairs) > 0.9 * len(exact)


def test_codes_give_upper_bounds_close_to_the_scores():
    rng = np.random.default_rng(11)
    queries, masters = rng.standard_normal((40, 64)), rng.standard_normal((60, 64)) * rng.uniform(0.1, 9, (60, 1))
    masters[7] = 0.0
    coded = lambda m: pa.table({"code": pa.array(encode_vectors(m), pa.binary())})
    assert np.allclose(decode_vectors(coded(masters)["code"])[0], masters, atol=0.2)
    assert {len(c.as_py()) for c in coded(masters)["code"]} == {64 + 16}
    true = queries @ masters.T
    scale = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(masters, axis=1)
    for top, columns, found in CodeScorer().index(coded(masters)).scores(coded(queries), 5):
        above = found - true[top : top + len(found), columns]
        assert 7 not in columns and (above >= -1e-6).all() and (above <= 0.03 * scale[top : top + len(found), columns] + 1e-6).all()


@pytest.mark.parametrize("k, threshold", [(3, 0.3), (1, 0.9)])
def test_search_on_codes_equals_search_in_the_same_cells(spark, clustered, k, threshold):
    """Also with copies, of which more than the short list holds have the same score."""
    targets, masters, centroids = clustered
    masters = masters + [(1_000 + i, masters[0][1]) for i in range(30)] + [(2_000, np.zeros(16))]
    t, m = frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters)
    coded, plain = (
        result(nearest(t, m, k, threshold, kind, centroids=centroids, nprobe=2, limits=SMALL)) for kind in ("coded", "ivfflat")
    )
    assert coded == plain and plain


@pytest.mark.parametrize("threshold", [-1.0, 0.3, 0.9])
def test_first_bounds_do_not_change_the_result(spark, clustered, threshold):
    """Also with targets that have fewer than k matches, copies, and vectors of zero."""
    rows = clustered[0] + [(1_000 + i, clustered[0][0][1]) for i in range(40)] + [(2_000, np.zeros(16))]
    target, master = frame(spark, "target", "vector", rows), frame(spark, "master", "vector", rows)
    seeded = BlockLimits(block_rows=16, broadcast_rows=0, seeded_blocks=2)
    assert result(nearest(target, master, 4, threshold, limits=seeded)) == brute_force(rows, rows, 4, threshold, dense_score)
    few = BlockLimits(block_rows=1, broadcast_rows=0, seeded_blocks=2)
    found = nearest(target, frame(spark, "master", "vector", rows[:3]), 4, threshold, limits=few)
    assert result(found) == brute_force(rows, rows[:3], 4, threshold, dense_score)


def test_first_bounds_leave_about_k_rows_per_target(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    points = np.vstack([c + 0.2 * rng.standard_normal((40, 16)) for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = list(enumerate(points.tolist()))
    target, master = frame(spark, "target", "vector", rows), frame(spark, "master", "vector", rows)
    emitted, k, rank = {}, 3, knn._rank

    for label, blocks in (("without", 1_000), ("with", 2)):
        def counted(found, *more, label=label):
            emitted[label] = found.count()
            return rank(found, *more)

        monkeypatch.setattr(knn, "_rank", counted)
        limits = BlockLimits(block_rows=80, broadcast_rows=0, seeded_blocks=blocks)
        found = result(nearest(target, master, k, 0.3, limits=limits))
        assert found == emitted.setdefault("result", found)
    assert emitted["with"] <= 2 * k * len(rows)
    assert emitted["without"] >= 4 * emitted["with"]


@pytest.mark.parametrize("query", [knn_ivf, knn_lsh])
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_registered_approximate_searches_find_nine_of_ten_others(spark, query, size):
    pairs = lambda df: {(r["target_key"], r["master_key"]) for r in df.collect() if r["target_key"] != r["master_key"]}
    wanted = pairs(knn_exact(spark, f"/root/testdata/{size}"))
    assert wanted and len(wanted & pairs(query(spark, f"/root/testdata/{size}"))) >= 0.9 * len(wanted)


def test_trained_centroids_serve_the_exact_search(spark, clustered):
    targets, masters, _ = clustered
    t, m = frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters)
    centroids = train_centroids(m, len(masters), nlist=6)
    assert centroids.count() <= 6
    got = nearest(t, m, 1, 0.7, "cells", centroids=centroids)
    assert result(got) == brute_force(targets, masters, 1, 0.7, dense_score)


def test_cell_count():
    assert [cell_count(n) for n in (0, 5, 95, 5_000, 100_000)] == [1, 1, 9, 100, 316]
    assert cell_count(100_000, 50) == 50
    assert [hash_bits(n) for n in (10, 100_000, 10**9)] == [4, 7, 13]


@pytest.mark.parametrize("rows", [1_000, 100_000, 1_000_000, 10**9])
def test_hashed_recall_holds_at_every_size(spark, rows):
    bits, rng = hash_bits(rows), np.random.default_rng(rows)
    planes, patterns = random_hyperplanes(24, bits=bits), hash_patterns(bits, 0.75)
    assert 6 * len(patterns) < 2**bits
    a, u = rng.standard_normal((2, 400, 24))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    u -= (u * a).sum(axis=1, keepdims=True) * a
    b = 0.7501 * a + np.sqrt(1 - 0.7501**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    t, m = (frame(spark, side, "vector", list(enumerate(x.tolist()))) for side, x in (("target", a), ("master", b)))
    found = nearest(t, m, 400, 0.75, "hnsw", hyperplanes=planes, patterns=patterns).collect()
    assert sum(r["target_key"] == r["master_key"] for r in found) / 400 >= 0.85


@pytest.mark.parametrize("cells", [20, 100, 400])
def test_probes_follow_the_cells(spark, cells):
    rng = np.random.default_rng(cells)
    masters = rng.standard_normal((5_000, 8))
    masters /= np.linalg.norm(masters, axis=1, keepdims=True)
    targets = masters[:600] + 0.2 * rng.standard_normal((600, 8))
    targets /= np.linalg.norm(targets, axis=1, keepdims=True)
    matrix = masters[rng.choice(5_000, cells, replace=False)]
    t, m = (frame(spark, side, "vector", list(enumerate(x.tolist()))) for side, x in (("target", targets), ("master", masters)))
    probes = probes_for(t, m, matrix, 0.75, least=2)
    homes = (masters @ matrix.T).argmax(axis=1)
    visited = np.argsort(-(targets @ matrix.T), axis=1)[:, :probes]
    scores = targets @ masters.T
    best = scores.argmax(axis=1)
    hit = (visited == homes[best][:, None]).any(axis=1)[scores.max(axis=1) >= 0.75]
    assert hit.mean() >= 0.9 and 2 <= probes < cells


def test_cell_search_needs_centroids_and_few_cells(spark, vectors):
    targets, masters = vectors
    with pytest.raises(ValueError, match="centroids"):
        nearest(frame(spark, "target", "vector", targets), frame(spark, "master", "vector", masters), 1, 0.3, "ivfflat")
    with pytest.raises(ValueError, match="cells"):
        random_hyperplanes(8, tables=100, bits=20)


def test_encoder_normalises_and_leaves_empty_texts_zero(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, " "), (3, None), (4, "B  A\na")], "id int, t string")
    got = {r["id"]: np.array(r["vector"]) for r in embed_texts(df, "t", HashedTokenEncoder, 2).collect()}
    assert np.allclose(got[1], got[4]) and abs(np.linalg.norm(got[1]) - 1) < 1e-6
    assert not got[2].any() and not got[3].any()


def test_encoder_gets_batches_of_the_given_size(spark):
    class Recorder:
        def encode(self, texts):
            return np.array([[len(texts), 1.0]] * len(texts))

    df = spark.range(10).selectExpr("id", "cast(id as string) t").coalesce(1)
    sizes = {round(r["vector"][0] / r["vector"][1]) for r in embed_texts(df, "t", Recorder, 4).collect()}
    assert sizes == {4, 2}


def test_a_text_is_encoded_once_over_all_runs(spark, tmp_path):
    calls = tmp_path / "calls"

    class Counting(HashedTokenEncoder):
        def encode(self, texts):
            with open(calls, "a") as out:
                out.write("".join(f"{t}\n" for t in texts))
            return super().encode(texts)

    def encoded():
        texts = calls.read_text().splitlines() if calls.exists() else []
        calls.unlink(missing_ok=True)
        return sorted(texts)

    first = spark.createDataFrame([(i, "a b" if i % 3 else f"t {i}") for i in range(60)], "id int, text string").repartition(6)
    second = spark.createDataFrame(
        [(1, "a b"), (2, " a  b "), (3, "new"), (3, "new"), (4, None), (5, "")], "id int, text string"
    )
    run = lambda df, version="v1": embed_cached(df, "text", Counting, str(tmp_path / "store"), version, "id", hot_rows=10)
    rows = lambda df: sorted((r["id"], r["text"] or "", tuple(r["vector"])) for r in df.collect())
    for df, wanted in ((first, sorted({"a b"} | {f"t {i}" for i in range(0, 60, 3)})), (second, ["", "new"]), (second, [])):
        got = run(df)
        assert encoded() == wanted
        assert rows(got) == rows(embed_texts(df, "text", HashedTokenEncoder))
    run(second, "v2")
    assert encoded() == ["", "a b", "new"]
    assert run(second.limit(0)).isEmpty() and encoded() == []


def test_lexical_vectors_are_unit_length(spark):
    df = spark.createDataFrame([(1, "a A b"), (2, " ")], "id int, t string")
    got = {(r["id"], r["token"]): r["weight"] for r in lexical_vectors(df, "id", "t").collect()}
    assert got == {(1, "a"): pytest.approx(2 / 5**0.5), (1, "b"): pytest.approx(1 / 5**0.5)}


def test_mean_pool_respects_the_mask(spark):
    rows = [(1, [1.0, 3.0], 1), (1, [3.0, 5.0], 1), (1, [99.0, 99.0], 0), (2, [4.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "k int, v array<float>, m int")
    assert {r["k"]: r["vector"] for r in mean_pool(df, "k", "v", "m").collect()} == {1: [2.0, 4.0], 2: [4.0, 4.0]}


def test_searchable_vectors(spark):
    records = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, [1.0]), (2, [0.0])], "k int, vector array<float>")
    require_searchable(records, good, "k")
    for bad in ([(1, [1.0])], [(1, [1.0]), (2, [1.0, 2.0])], [(1, [1.0]), (2, [])], [(1, [1.0]), (1, [1.0]), (2, [1.0])]):
        with pytest.raises(ValueError):
            require_searchable(records, spark.createDataFrame(bad, "k int, vector array<float>"), "k")
    with pytest.raises(ValueError, match="No vectors"):
        require_searchable(records, good.limit(0), "k")


def test_copies_are_not_listed_beyond_the_first_k():
    """250,000 masters of 50 texts: what is compared grows with the texts, not with their copies."""
    keys = pa.array(range(250_000), pa.int64())
    masters = pa.table({"master_key": keys, "text": pa.array([f"text number {i % 50} of fifty" for i in range(250_000)])})
    targets = pa.table({"target_key": pa.array(range(2_000), pa.int64()), "text": pa.array([f"text number {i % 50} of fifty" for i in range(2_000)])})
    prepared = prepare(masters, LexicalScorer())
    start = time.perf_counter()
    found = match_block(targets, prepared, 5, 0.5)
    assert time.perf_counter() - start < 20
    first = found.filter(pc.equal(found["target_key"], 7)).to_pydict()
    assert first["master_key"] == [7, 57, 107, 157, 207] and first["rank"] == [1, 2, 3, 4, 5]
    vectors = np.tile(np.eye(4), (30, 1))
    dense = pa.table({"master_key": pa.array(range(120), pa.int64()), "vector": pa.array(list(vectors))})
    one = pa.table({"target_key": pa.array([0], pa.int64()), "vector": pa.array([[1.0, 0.5, 0.0, 0.0]])})
    best = match_block(one, prepare(dense, DenseScorer()), 3, 0.1).to_pydict()
    assert best["master_key"] == [0, 4, 8]


@pytest.mark.parametrize("k, threshold", [(1, 0.75), (3, 0.3), (5, 0.0)])
def test_long_texts_are_scored_whole_only_where_sketches_allow_a_match(monkeypatch, k, threshold):
    """The result is that of all pairs, also with copies, texts without a common token and sketches of few places."""
    from gapweave.operators import scoring

    monkeypatch.setattr(scoring, "_SKETCHED_TARGETS", 50)
    monkeypatch.setattr(scoring, "_SKETCHED_MASTERS", 70)
    monkeypatch.setattr(scoring, "_COUNTED_BYTES", 2_000)
    rng = np.random.default_rng(3)
    words = [[f"{lang}{i}" for i in (rng.zipf(1.3, 120) % 3_000)] for lang in "abc" for _ in range(90)]
    texts = [" ".join(w) for w in words] + [" ".join(w[:100]) for w in words[:60]]
    texts += [texts[7]] * 9 + [" ".join(f"only{i}" for i in range(60))]
    targets, masters = list(enumerate(texts[::2])), list(enumerate(texts[1::2]))
    scored, score = [], scoring._Sketches._score
    monkeypatch.setattr(scoring._Sketches, "_score", lambda self, near, spread: scored.append(len(near)) or score(self, near, spread))
    as_table = lambda key, rows: pa.table({key: pa.array([i for i, _ in rows], pa.int64()), "text": [text for _, text in rows]})
    found = match_block(as_table("target_key", targets), prepare(as_table("master_key", masters), LexicalScorer()), k, threshold)
    exact = brute_force(targets, masters, k, threshold, token_score)
    assert sorted(zip(*(found[c].to_pylist() for c in ("target_key", "master_key", "score", "rank")))) == sorted(exact)
    if threshold:
        assert sum(scored) < 0.4 * len(targets) * len(masters)


@pytest.mark.parametrize("t_blocks, m_blocks", [(3, 4), (8, 12)])
def test_blocks_of_texts_are_packed_once_and_copied_nowhere(spark, texts, t_blocks, m_blocks):
    """Also with blocks without a row, and with tasks that take their targets through several blocks."""
    targets, masters = texts
    t, m = frame(spark, "target", "text", targets), frame(spark, "master", "text", masters)
    t, m = LexicalScorer().ready(t), LexicalScorer().ready(m)
    got = knn.block_knn(t, m, 2, 0.3, LexicalScorer(), t_blocks, m_blocks)
    assert result(got) == brute_force(targets, masters, 2, 0.3, token_score)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "Broadcast" not in plan
    assert result(knn.block_knn(t, m.limit(0), 2, 0.3, LexicalScorer(), t_blocks, m_blocks)) == set()


@pytest.mark.parametrize("k", [1, 3])
def test_targets_take_what_they_have_found_to_the_next_block(monkeypatch, k):
    from gapweave.operators import scoring

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in (rng.zipf(1.3, 120) % 3_000)) for _ in range(240)]
    texts += [text + " more" for text in texts[:40]]
    targets, masters = list(enumerate(texts[:80])), list(enumerate(texts[80:][::-1]))
    as_table = lambda key, rows: pa.table({key: pa.array([i for i, _ in rows], pa.int64()), "text": [text for _, text in rows]})
    asked = pa.py_buffer(scoring.pack_texts(as_table("target_key", targets), "target_key"))
    blocks = [pa.py_buffer(scoring.pack_texts(as_table("master_key", masters[a : a + 50]), "master_key")) for a in range(0, 200, 50)]
    scored, score = [], scoring._Sketches._score
    monkeypatch.setattr(scoring._Sketches, "_score", lambda self, near, query: scored.append(len(near)) or score(self, near, query))
    found = pa.concat_tables(scoring.match_packed(asked, blocks, k, 0.3))
    together = sum(scored)
    pairs = sorted((t, -s, m) for t, m, s in zip(*(found[c].to_pylist() for c in ("target_key", "master_key", "score"))))
    best = {(t, m, -s, i + 1) for q, _ in targets for i, (t, s, m) in enumerate([x for x in pairs if x[0] == q][:k])}
    assert best == brute_force(targets, masters, k, 0.3, token_score)
    scored.clear()
    apart = [pa.concat_tables(scoring.match_packed(asked, [block], k, 0.3)) for block in blocks]
    assert together < 0.8 * sum(scored) and len(found) < sum(map(len, apart))


@pytest.mark.parametrize("rows", [400, 1_600])
def test_rows_alone_do_not_multiply_the_copies_of_a_side(spark, monkeypatch, rows):
    """A side is copied once per block of the other; blocks of a few rows would copy it as often as it has rows."""
    grids, compare = [], knn.block_knn
    monkeypatch.setattr(knn, "block_knn", lambda *args: grids.append(args[-2:]) or compare(*args))
    rng = np.random.default_rng(8)
    points = rng.standard_normal((rows, 8))
    frame_rows = list(enumerate((points / np.linalg.norm(points, axis=1, keepdims=True)).tolist()))
    t, m = frame(spark, "target", "vector", frame_rows), frame(spark, "master", "vector", frame_rows)
    limits = BlockLimits(broadcast_rows=0, block_rows=5, seeded_blocks=10_000)
    assert nearest(t, m, 1, 0.5, limits=limits).where("target_key = master_key").count() == rows
    assert max(grids[0]) <= 16


def test_batches_of_texts_are_worked_on_in_pieces(spark, monkeypatch):
    """Memory follows a few megabytes of texts, not the texts of a batch; nothing else changes."""
    from gapweave.operators import encode

    monkeypatch.setattr(encode, "_PIECE_BYTES", 1_000)
    texts = pa.array([f"text {i} " * (1 + i % 9) for i in range(300)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), texts], ["k", "text"])
    pieces = list(encode._small_pieces([batch, batch.slice(0, 0)], "text"))
    assert len(pieces) > 5 and max(piece.num_rows for piece in pieces) < 100
    assert pa.Table.from_batches(pieces).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    encoder = HashedTokenEncoder(8)
    monkeypatch.setattr(encode, "_KNOWN_TOKENS", 10)
    assert (encoder.encode(texts.to_pylist()) == HashedTokenEncoder(8).encode(texts.to_pylist())).all() and len(encoder.places) == 10


def test_prefix_search_compares_copies_once(spark, monkeypatch):
    """60 rows of each text: no more texts are routed than there are distinct ones, and the first k copies are found."""
    routed, sizes = [], knn._cell_sizes
    monkeypatch.setattr(knn, "_cell_sizes", lambda *args: routed.append(args[1].select("text").count()) or sizes(*args))
    rows = [(i, f"pump p{i % 20} q{i % 10} of steel") for i in range(1_200)]
    t, m = frame(spark, "target", "text", rows[:300]), frame(spark, "master", "text", rows)
    got = nearest(t, m, 70, 0.7, "prefix", LexicalScorer(), limits=BlockLimits(bucket_rows=20))
    assert result(got) == brute_force(rows[:300], rows, 70, 0.7, token_score)
    assert routed and max(routed) <= 20 * 5


def test_a_cell_is_cut_until_a_task_compares_a_bounded_number_of_pairs():
    size = {"cell": 0, "t_rows": 500_000, "t_bytes": 500_000 * 80, "m_rows": 60_000, "m_bytes": 60_000 * 80}
    t_blocks, m_blocks = knn._cell_grid(size, BlockLimits())
    assert 500_000 / t_blocks * 60_000 / m_blocks <= 10**9 and t_blocks * m_blocks < 60
    assert knn._cell_grid({**size, "t_rows": 10, "t_bytes": 800}, BlockLimits()) == (1, 1)
