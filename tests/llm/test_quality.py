import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from gapweave.llm import quality, text

GOOD = "The river runs past the old mill, and the people of the town walk along it."
JUNK = "WIN!! $$$ | click*** now||| %%% FREE!! $$$ |"


def corpus(spark, n=120):
    rows = [(i, f"{GOOD} Day {i}. {GOOD}" if i % 5 else f"{JUNK} {i} {JUNK}", "clash") for i in range(n)]
    rows += [(1_000, None, "clash"), (1_001, "", "clash"), (None, GOOD, "clash"), (7, GOOD, "clash"), (1_002, GOOD * 2_000, "clash")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, rank string").repartition(3), rows


def targets(spark):
    return spark.createDataFrame([(i,) for i in range(0, 60) if i % 5] + [(None,), (1,), (77_777,)], "doc_id bigint")


def test_junk_goes_and_good_text_stays(spark):
    docs, rows = corpus(spark)
    got = quality.resample(docs, targets(spark)).collect()
    assert len(got) == len(rows)
    assert sorted(r["rank"] for r in got) == list(range(1, len(rows) + 1))
    kept = {r.doc_id for r in got if r.selected}
    good = {i for i, t, _ in rows if t and "$$$" not in t}
    assert len(kept & good) >= 0.95 * len(good)
    assert not kept & {i for i, t, _ in rows if t and "$$$" in t}


def test_weights_equal_brute_force(spark):
    docs, rows = corpus(spark, 40)
    ratios = quality.fit(docs, targets(spark))

    def grams(line):
        found = re.findall(r"\w+|[^\w\s]+", line or "", re.A)
        return found + list(zip(found, found[1:]))

    named = {}  # buckets of the n-grams, from texts that hold just these
    def bucket(gram):
        if gram not in named:
            data = " ".join([gram] if isinstance(gram, str) else gram).encode()
            _, b = quality.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            named[gram] = int(b[-1])
        return named[gram]

    every, wanted = Counter(), Counter()
    chosen = {i for i in range(60) if i % 5}
    for i, t, _ in rows:
        counts = Counter(map(bucket, grams(t)))
        every += counts
        if i in chosen:
            wanted += counts
    e = np.array([every[b] + 1.0 for b in range(quality.BUCKETS)])
    w = np.array([wanted[b] + 1.0 for b in range(quality.BUCKETS)])
    want = np.log(w / w.sum()) - np.log(e / e.sum())
    assert np.allclose(ratios, want)
    scored = {(r.doc_id, r.n_grams): r.log_weight for r in quality.score(docs, ratios).collect()}
    for i, t, _ in rows:
        found = [bucket(g) for g in grams(t)]
        assert math.isclose(scored[i, len(found)], float(want[found].sum()), abs_tol=1e-5)


def test_selection_does_not_depend_on_partitions(spark):
    docs, _ = corpus(spark)
    key = lambda r: (r.doc_id or -1, r.n_grams, r.selected)
    one = sorted(map(key, quality.resample(docs.repartition(1), targets(spark)).collect()))
    assert one == sorted(map(key, quality.resample(docs.repartition(6), targets(spark)).collect()))


def test_empty_table_and_no_targets(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.resample(none, targets(spark)).collect() == []
    docs, rows = corpus(spark, 10)
    assert all(r.selected for r in quality.resample(docs, targets(spark).limit(0)).collect())


def test_hashes_do_not_depend_on_place_or_company():
    texts = ["alpha beta  gamma", "", "gamma", "beta gamma\nalpha beta gamma delta epsilon zeta", None, "Alpha bEta gamma alpha BETA"]
    alone = [list(h) for t in texts for _, _, d, r in text.text_chunks(pa.array([t])) for _, h in [text.shingles(d, r, 3)]]
    first, last, data, rows = next(text.text_chunks(pa.array(texts)))
    row, hashes = text.shingles(data, rows, 3)
    assert [sorted(hashes[row == n].tolist()) for n in range(last)] == [sorted(map(int, a)) for a in alone]
    assert set(alone[0]) <= set(alone[3]) and len(alone[2]) == 1
