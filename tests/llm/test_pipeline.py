import re

import public_tokenizers
import tiktoken

import corpus_pipeline
from gapweave.llm import bpe, queries
from gapweave.storage import materialize
from tests.llm.test_jaccard import brute
from tests.llm.test_secrets import brute as secret_spans

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, states = docs.columns, [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), name)
        states.append({r.doc_id: r for r in docs.collect()})
        if name != "bpe":
            assert docs.columns == columns
    start, good, single, clean, mixed, encoded = states

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = [i for i in start if labels.get(i) == 1]
    assert sum(i in good for i in kept) / len(kept) > 0.99
    assert all(good[i] == start[i] for i in good)

    components = brute([(i, r.text) for i, r in good.items()])
    assert set(single) == {i for i, _, component in components if component == i}

    for i, row in clean.items():
        spans = secret_spans(single[i].text)
        assert (row.text == single[i].text) == (not spans) and not secret_spans(row.text)
        assert row.n_chars == (len(row.text) if spans else single[i].n_chars)
    assert mixed == clean

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: list(r.token_ids) for i, r in encoded.items()} == {i: library.encode_ordinary(r.text) for i, r in mixed.items()}


def test_registered_queries_are_the_operators_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_run_equals_its_stages(spark):
    rows = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    again = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert rows == again and rows


def test_mix_reaches_the_rows(spark):
    docs = spark.createDataFrame(
        [(i, "src0" if i % 20 < 5 else "src1" if i % 20 < 8 else None, f"text {i}") for i in range(640)]
        + [(None, None, "without id"), (None, "src0", "without id")],
        "doc_id bigint, source string, text string",
    )
    mixed = materialize(corpus_pipeline.mix_stage(spark, docs, SF_DIR), "mix")
    rows = corpus_pipeline.bpe_stage(spark, mixed, SF_DIR).orderBy("mix_position").collect()
    assert len({r.mix_position for r in rows}) == len(rows) == 642
    weights = {"src0": 5, "src1": 3, None: 12}
    source = {r.doc_id: r.source for r in docs.where("doc_id IS NOT NULL").collect()}
    slots = {r.mix_slot: source[r.doc_id] for r in rows if r.doc_id is not None}
    seen = dict.fromkeys(weights, 0)
    for slot in range(40):
        seen[slots[slot]] += 1
        assert all(abs(seen[s] - (slot + 1) * w / 20) < 1 for s, w in weights.items())


def test_run_gives_every_row_its_place(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and len({r.mix_position for r in rows}) == len(rows)


def test_pipeline_mixes_each_source(spark):
    docs = spark.createDataFrame([(i, f"src{i % 5}", "t") for i in range(400)], "doc_id bigint, source string, text string")
    assert {r.mix_source for r in corpus_pipeline.mix_places(docs).collect()} == {f"src{i}" for i in range(5)}


def test_one_row_of_each_component(spark):
    one, two, other = (" ".join(f"{word}{i}" for i in range(60)) for word in ("one", "two", "other"))
    rows = [(1, one), (1, one), (2, one), (2, two), (3, two + " end"), (3, two), (4, other), (4, other), (None, one), (None, one), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR).collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, two), (4, other), (None, one), (None, one), (5, "")], key=str)


def test_stages_give_clashing_columns_back(spark):
    """Names that the stages use themselves."""
    names = "_row row doc order hash component_id _chars _blob _spans _id _found blob spans path content turn weight rank".split()
    text = "one two three four five six token = abcdef123456"
    rows = [(n, text if n < 2 else f"text {n} of its own words", "en", "src0", 5, *range(len(names))) for n in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    once = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert once.columns == docs.columns
    assert sorted(map(tuple, once.collect())) == [tuple(r) for r in rows if r[0] != 1]
    clean = corpus_pipeline.secrets_stage(spark, docs, "")
    assert clean.columns == docs.columns
    want = text[: text.index("token")] + "[secret]"
    assert sorted(map(tuple, clean.collect())) == [
        (r[0], want, "en", "src0", len(want), *r[5:]) if r[0] < 2 else r for r in rows
    ]
    mixed = corpus_pipeline.mix_stage(spark, docs, "")
    assert mixed.columns == docs.columns and sorted(map(tuple, mixed.collect())) == rows
    empty = docs.limit(0)
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.secrets_stage, corpus_pipeline.mix_stage):
        assert stage(spark, empty, "").columns == docs.columns
