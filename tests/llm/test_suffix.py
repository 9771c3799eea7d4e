import hashlib
import random

import numpy as np

from gapweave.llm import suffix


def brute(rows, length=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for k in range(len(data) - length + 1):
                piece = data[k : k + length]
                first[piece] = min(first.get(piece, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for k in range(len(data) - length + 1):
                if first[data[k : k + length]] < i:
                    gone[k : k + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((-1 if i is None else i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, parts=3):
    docs = spark.createDataFrame([(i, t, b"") for i, t in rows], "doc_id bigint, text string, kept binary").repartition(parts)
    got = suffix.remove_repeats(docs).collect()
    return sorted((-1 if r[0] is None else r[0], r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randrange(9, 40))) for _ in range(5)]
    rows = []
    for n in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 50)))]
        for _ in range(rng.randrange(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randrange(0, 30)
            parts += [passage[cut:], word()]
        rows.append((n * 7 % 101, " ".join(parts)))
    rows += [(200, rows[0][1]), (3, rows[1][1]), (3, "other text " * 9), (None, rows[2][1]), (None, None), (201, ""), (202, None)]
    rows += [(203, "a" * 49), (204, "a" * 50), (205, "a" * 400), (206, "ab" * 120), (207, "x" + "ab" * 60), (208, "a" * 51)]
    assert run(spark, rows) == brute(rows)


def test_many_copies_and_a_long_text(spark):
    base = " ".join(str(i) for i in range(9_000))
    rows = [(n, base[: 300 + n % 3]) for n in range(80)] + [(500, base), (501, base[1_000:])]
    assert run(spark, rows, 5) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_runs_larger_than_their_blocks(monkeypatch):
    monkeypatch.setattr(suffix, "RUN_ROWS", 60)
    monkeypatch.setattr(suffix, "BLOCK_ROWS", 7)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(8, 30))) for _ in range(60)]
    ids = np.array([rng.randrange(20) for _ in texts])
    first = {}
    for text, i in zip(texts, ids):
        for k in range(len(text) - 7):
            first[text[k : k + 8]] = min(first.get(text[k : k + 8], i), i)
    want = {(n, k) for n, t in enumerate(texts) for k in range(len(t) - 7) if first[t[k : k + 8]] < ids[n]}
    got = [(int(o), int(p)) for owner, place in suffix.equal_windows(texts, ids, 8) for o, p in zip(owner, place)]
    assert len(got) == len(set(got)) and set(got) == want


def test_texts_of_one_id_are_told_apart_whatever_repeats_in_them(spark):
    """Words of Thue and Morse and their complements have equal polynomials modulo 2**64 from 1,024 letters on."""
    rows = []
    for n, size in enumerate((1_024, 2_048, 4_096)):
        word = "".join("ab"[k.bit_count() % 2] for k in range(size))
        other = word.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer((word + other).encode(), np.uint8)
        one, two = suffix._text_refs(data, np.array([0, size, 2 * size]))
        assert one != two
        # The complements stand under one id, each after what a smaller document holds of one of them alone.
        mark = f" {n} " + "-" * n
        rows += [(10 * n, f"{mark}{word[:60]}x"), (10 * n + 1, word + mark), (10 * n + 1, other + mark)]
    assert run(spark, rows) == brute(rows)


def test_places_need_more_than_32_bits_of_their_own():
    runs = suffix.SuffixRuns([b"abcdefgh" * 4], 8)
    try:
        runs.add(np.array([3, 11]), np.array([0, 0]))
        file, count = runs.runs[0]
        file.seek(0)
        assert len(file.read()) == count * 2 * 8
    finally:
        runs.close()
