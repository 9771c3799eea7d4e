import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from gapweave.llm import bpe
from gapweave.llm.text import word_hashes

WORDS = ["the", "The", " ", "don't", "naïve", "été", "123", "4567890", "ñandú", "\n\n", "a_b", "🙂", "日本語", "$$$", "x" * 90]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_equals_the_library_and_round_trips(spark, ranks, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(WORDS) + rng.choice(["", " ", "\t"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += ["", None, " ", "   x", "x   ", "  y", "<|endoftext|>", "a" * 3_000 + " b", "it's 'twas 'LL", texts[0], texts[0]]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "null id", "clash"), (3, "again", "clash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string").repartition(3)
    got = bpe.encode(docs, bpe.RankMap(ranks)).collect()
    plain = lambda t: t or ""
    want = sorted((i if i is not None else -1, library.encode_ordinary(plain(t)), plain(t).encode()) for i, t, _ in rows)
    assert sorted((r[0] if r[0] is not None else -1, list(r.token_ids), bytes(r.decoded)) for r in got) == want


def test_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode(docs, bpe.RankMap(ranks)).collect() == []


def test_long_words_by_the_heap(ranks, library):
    rng = random.Random(1)
    for alphabet in ("a", "ab", "etaoinshrdlu", "éàü", "xyz0"):
        word = "".join(rng.choice(alphabet) for _ in range(2_500)).encode()
        assert bpe.encode_long_word(word, ranks) == library._encode_single_piece(word)


def test_common_words_do_not_change_ids(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_DISTINCT", 6)
    texts = [f"alpha beta gamma delta{i % 3} epsilon" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    known, ids = bpe.common_words(docs, bpe.RankMap(ranks))
    assert len(known) == len(ids) >= 3 and (known[1:] > known[:-1]).all()
    got = {r.doc_id: list(r.token_ids) for r in bpe.encode(docs, bpe.RankMap(ranks)).collect()}
    assert got == {i: library.encode_ordinary(text) for i, text in enumerate(texts)}


def test_incomplete_ranks_are_refused():
    with pytest.raises(ValueError, match="without a rank"):
        bpe.RankMap({b"a": 0})


def words_of(texts):
    codes, start, end, row = bpe.cut_words(texts, {})
    out = [[] for _ in texts]
    for a, b, r in zip(start, end, row):
        out[r].append("".join(map(chr, codes[a:b])))
    return out


def test_texts_are_cut_as_by_the_pattern():
    assert bpe.PATTERN == public_tokenizers.PATTERN
    find = regex.compile(bpe.PATTERN).findall
    rng = random.Random(4)
    marks = ["'", "'s", "'re", "'ll", "'ve", "s", "t", "re", "l", "ab", "1", "22", "!", " ", "  ", "\n", "\t", "\u00a0", "é", "_", "'m", "'D"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(12))) for _ in range(4_000)]
    assert words_of(texts) == [find(text) for text in texts]


def test_every_character_is_cut_as_the_library_does(ranks, library):
    for start in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1 {c}b" for c in chars)
        own = [i for word in words_of([text])[0] for i in library._encode_single_piece(word.encode())]
        assert own == library.encode_ordinary(text), hex(start)


def thue_morse(size):
    """Two words that any polynomial hash modulo a power of two takes for one."""
    word = "a"
    while len(word) < size:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def test_words_of_repeating_patterns_stay_apart(spark, ranks, library):
    texts = [word for size in (1_024, 2_048, 4_096) for word in thue_morse(size)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (list(r.token_ids), bytes(r.decoded)) for r in bpe.encode(docs, bpe.RankMap(ranks)).collect()}
    assert got == {i: (library.encode_ordinary(t), t.encode()) for i, t in enumerate(texts)}


def test_equal_hashes_are_settled_by_the_text(spark, ranks, library, monkeypatch):
    """Words of one length have one hash here, and the second hash tells."""
    def weak(codes, start, end, seed=0):
        real = word_hashes(codes, start, end, seed)
        return real if seed else (end - start).astype(np.uint64)

    monkeypatch.setattr(bpe, "word_hashes", weak)
    texts = pa.array(["ab cd ab", "xy zw", ""])
    rows = [[places, words] for _, _, places, _, words in bpe._numbered(texts, {})]
    assert [rows[0][1][p] for p in rows[0][0]] == ["ab", " cd", " ab", "xy", " zw"]


def test_equal_sums_are_settled_by_the_text(spark, ranks, library, monkeypatch):
    """Words of one length have one hash here, whatever its seed, so only the texts tell."""
    monkeypatch.setattr(bpe, "word_hashes", lambda codes, start, end, seed=0: (end - start).astype(np.uint64))
    rows = list(bpe._numbered(pa.array(["ab cd ab", "xy zw"]), {}))
    assert [rows[0][4][p] for p in rows[0][2]] == ["ab", " cd", " ab", "xy", " zw"]


def test_plans_do_not_hold_the_ranks(spark, ranks):
    docs = spark.createDataFrame([(1, "some text of words")], "doc_id bigint, text string")
    encoded = bpe.encode(docs, bpe.RankMap(ranks))
    assert len(encoded._jdf.queryExecution().toString()) < 100_000


def test_every_pair_has_its_slot_and_others_none():
    rng = random.Random(3)
    pairs = {rng.randrange(1 << 42): rng.randrange(1 << 21) for _ in range(20_000)}
    shifts, slots = bpe._spread(pairs)
    find = lambda pair: slots[(pair + shifts[pair % len(shifts)]) % len(slots)]
    assert all(find(pair) == pair << 21 | number for pair, number in pairs.items())
    assert not any(find(pair) >> 21 == pair for pair in (rng.randrange(1 << 42) for _ in range(20_000)) if pair not in pairs)
    assert bpe._spread({}) == ([0], [-1])
