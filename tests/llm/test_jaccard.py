import itertools
import random
import re

import numpy as np
import pytest

from gapweave.llm import jaccard


def brute(rows, words=5):
    """{row number: (n, component)} by all pairs."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, text in rows:
        found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))
        grams = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
        sets.append(grams or ({tuple(found)} if found else set()))
    label = list(range(len(rows)))
    links = [
        (a, b)
        for a, b in itertools.combinations(range(len(rows)), 2)
        if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[label[n]] = min(least.get(label[n], i), i)
    return sorted((i if i is not None else -1, len(s), least[label[n]] if i is not None else None) for n, ((i, _), s) in enumerate(zip(rows, sets)))


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, class int").repartition(3)
    return sorted((r[0] if r[0] is not None else -1, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect())


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(400))
    passage = [word() for _ in range(12)]
    rows = []
    for group in range(12):
        base = [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy + passage if group % 2 else copy))
    rows += ["", None, "   \n", "one two", "One\tTWO", "one two three", rows[0].upper(), rows[0], "wort " * 3_000, "wort " * 5]
    numbered = [(n * 3 % 101, text) for n, text in enumerate(rows)] + [(None, rows[1]), (None, None)]
    assert run(spark, numbered) == brute(numbered)


def test_chain_of_links_and_exact_threshold(spark):
    # 100 * 6 >= 75 * 8 holds exactly; the ends of the chain are linked by the middle only.
    words = [f"w{i}" for i in range(30)]
    rows = [(9, " ".join(words[0:11])), (4, " ".join(words[1:12])), (7, " ".join(words[2:13])), (1, " ".join(words[15:26]))]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_prefix_filter_keeps_every_link():
    rng = np.random.default_rng(2)
    sketch = rng.integers(1, 50, jaccard.COUNTERS)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        common = rng.integers(0, 2**63, n).astype(np.uint64)
        a = np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, 12))).astype(np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, 12))).astype(np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        for order in range(jaccard.ORDERS):
            first, second = (x[jaccard._ordered(x, sketch, order)[: jaccard.prefix_size(len(x))]] for x in (a, b))
            assert len(np.intersect1d(first, second))


@pytest.mark.parametrize("links, want", [
    ([(1, 2), (2, 3), (5, 4)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(7, 7), (9, 7), (9, 7)], {7: 7, 9: 7}),
])
def test_components(spark, links, want):
    found = jaccard.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == want


def test_words_of_repeating_patterns_are_different_words(spark):
    """A polynomial modulo a power of two takes these words for one."""
    word = "a"
    while len(word) < 2_048:
        word += word.translate({97: "b", 98: "a"})
    texts = [f"{word} one two three four five", f"{word.translate({97: 'b', 98: 'a'})} one two three four five"]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(2, texts[1])], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect()}
    assert got == {0: (2, 0), 1: (2, 1), 2: (2, 1)}


def test_pivots_are_central_in_a_group_of_near_copies(spark, monkeypatch):
    """Forty texts with two words changed all link; a hundred with six changed link with none, and must not be their pivots."""
    words = [f"wa{i}" for i in range(150)]

    def changed(row, places):
        return " ".join(f"own{row}x{i}" if i in places else word for i, word in enumerate(words))

    texts = [changed(row, {20 + row, 90 + row} if row < 40 else {(row + 25 * k) % 150 for k in range(6)}) for row in range(140)]
    compared = []
    links = jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda pairs, *rest: compared.append(pairs.count()) or links(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {row.doc_id: row.component_id for row in jaccard.similar_documents(docs).collect()}
    assert got == {row: 0 if row < 40 else row for row in range(140)}
    assert sum(compared) < 3 * len(texts), compared
