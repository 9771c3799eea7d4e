import datetime

import pytest
from pyspark.sql import functions as F

from gapweave.config import CompletionConfig, ConsolidationConfig
from gapweave.functions.dates import parse_date
from gapweave.functions.text import (
    NA_TOKENS,
    combine_fields,
    is_blank,
    normalize_text,
    null_if_na_token,
    truncate_tokens,
)
from gapweave.functions.vectors import dot, l2_normalize


def one(spark, schema, values, *exprs):
    return [tuple(r) for r in spark.createDataFrame(values, schema).select(*exprs).collect()]


def test_normalize_text_treats_blanks_like_str_split(spark):
    texts = [" a\t b\n\nc ", "", "   ", None, "x  y　z", "p\x1cq\x1fr", "a​b"]
    got = one(spark, "t string", [(t,) for t in texts], normalize_text(F.col("t")), is_blank(F.col("t")))
    assert [g[0] for g in got] == [" ".join((t or "").split()) for t in texts]
    assert [g[1] for g in got] == [not (t or "").strip() for t in texts]


def test_combine_fields_skips_null_blank_and_nan(spark):
    rows = [("A", "d"), (None, "d"), ("A", None), ("  ", "nan"), (None, None), ("0", "x y")]
    text = combine_fields({"Type": F.col("a"), "Description": F.col("b")})
    assert [r[0] for r in one(spark, "a string, b string", rows, text)] == [
        "Type: A | Description: d",
        "Description: d",
        "Type: A",
        "",
        "",
        "Type: 0 | Description: x y",
    ]


def test_na_tokens_are_exact(spark):
    kept = ["-", " N/A", "na", "Null", "0"]
    rows = [(t,) for t in (*NA_TOKENS, *kept)]
    got = [r[0] for r in one(spark, "t string", rows, null_if_na_token(F.col("t")))]
    assert got == [None] * len(NA_TOKENS) + kept


def test_truncate_counts_tokens_not_characters(spark):
    assert one(spark, "t string", [(" a  bb\nc d ",)], truncate_tokens(F.col("t"), 3)) == [("a bb c",)]


def test_parse_date_takes_any_format_that_fits(spark):
    rows = [("2024-01-02",), ("03/04/2024",), ("2024-13-01",), ("soon",), (None,), ("2024-01-02 03:04:05",)]
    formats = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "d MMM yyyy")
    assert [r[0] for r in one(spark, "t string", rows, parse_date(F.col("t"), formats))] == [
        datetime.datetime(2024, 1, 2),
        datetime.datetime(2024, 3, 4),
        None,
        None,
        None,
        datetime.datetime(2024, 1, 2, 3, 4, 5),
    ]
    assert one(spark, "t string", [("7 Mar 2024",)], parse_date(F.col("t"), formats)) == [
        (datetime.datetime(2024, 3, 7),)
    ]


def test_l2_normalize_keeps_the_zero_vector(spark):
    rows = [([3.0, 4.0],), ([0.0, 0.0],)]
    got = one(spark, "v array<double>", rows, l2_normalize(F.col("v")), dot(F.col("v"), F.col("v")))
    assert got == [([0.6, 0.8], 25.0), ([0.0, 0.0], 0.0)]


@pytest.mark.parametrize(
    "bad",
    [{"threshold": 1.1}, {"threshold": -0.1}, {"batch_size": 0}, {"top_k": 0}, {"output_format": "xlsx"}],
)
def test_completion_config_rejects(bad):
    with pytest.raises(ValueError):
        CompletionConfig(**bad)


def test_config_accepts_zero_threshold_and_describes_itself():
    assert CompletionConfig(threshold=0.0).describe()["threshold"] == 0.0
    assert ConsolidationConfig().describe()["remove_duplicates"] is True
    with pytest.raises(ValueError):
        ConsolidationConfig(required_columns=())
