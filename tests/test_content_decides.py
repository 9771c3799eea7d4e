"""Distinct rows by hash, date formats by vote, and rows put aside while loading."""

import datetime as dt

import pytest

from gapweave.config import ConsolidationConfig
from gapweave.operators import distinct
from gapweave.operators.date_vote import format_votes, parse_dates_by_vote
from gapweave.operators.distinct import distinct_rows
from gapweave.plans.consolidate import run_consolidation
from gapweave.sources.files import discover_files, load_files, quarantine

FORMATS = ["MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd"]


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


ODD = [
    ("a", None, 0.0, [1, None]), ("a", None, -0.0, [1, None]), (None, "a", 0.0, []), (None, "a", 0.0, None),
    ("", "", float("nan"), []), ("", "", float("nan"), []), (None, None, None, None), (None, None, None, None),
    ("x" * 100_000, "y", 1.0, [2]), ("x" * 100_000, "y", 1.0, [2]), ("x" * 100_000, "z", 1.0, [2]),
]


@pytest.mark.parametrize("pieces", [0, 1, 16_384])
def test_distinct_rows_whatever_the_map_holds(spark, monkeypatch, pieces):
    # With one piece and many repeated hashes nearly every bit is set, so unique rows are compared too.
    monkeypatch.setattr(distinct, "MAX_PIECES", max(pieces, 1))
    monkeypatch.setattr(distinct, "BITS_PER_HASH", 32 if pieces else 0)
    df = spark.createDataFrame(ODD, "key string, place string, row double, `a.b` array<int>").repartition(5)
    many = spark.range(40_000).selectExpr("cast(id % 30000 as string) key", "'p' place", "1.5D row", "array(int(id % 30000)) `a.b`")
    df = df.unionAll(many)
    assert distinct_rows(df).columns == df.columns
    assert rows(distinct_rows(df)) == rows(df.dropDuplicates())


def test_distinct_rows_of_a_hot_group_and_of_nothing(spark):
    hot = spark.range(3_000).selectExpr("if(id % 3 = 0, -1, id) AS id")
    assert distinct_rows(hot).count() == 2_001
    assert distinct_rows(hot.where("id < -5")).collect() == []
    folded = hot.selectExpr("if(id % 2 = 0, 'A', 'a') COLLATE UTF8_LCASE AS c")
    assert distinct_rows(folded).count() == folded.dropDuplicates().count() == 1
    with pytest.raises(ValueError):
        distinct_rows(hot.select("id", "id"))


def test_rows_without_a_copy_are_not_shuffled(spark):
    df = spark.range(5_000).selectExpr("id", "repeat(cast(id as string), 50) AS wide").unionAll(
        spark.range(10).selectExpr("id", "repeat(cast(id as string), 50) AS wide")
    )
    got = distinct_rows(df)
    assert got.count() == 5_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    # One branch of the union has no exchange but that of the map.
    first = plan.split("Union", 1)[1].split(":- ", 1)[1].split("\n+- ", 1)[0].split("\n   +- ", 1)[0]
    assert "Exchange hashpartitioning(row" not in first and "Exchange hashpartitioning(wide" not in first


def day(y, m, d):
    return dt.datetime(y, m, d)


def test_ambiguous_dates_follow_their_column_and_source(spark):
    df = spark.createDataFrame(
        [
            (1, "eu", "03/04/2024", "03/04/2024"), (2, "eu", "25/04/2024", "12/31/2023"), (3, "us", "03/04/2024", None),
            (4, "us", "04/25/2024", ""), (5, None, "03/04/2024", "x"), (6, None, "2024-04-03", "2024-04-03"),
            (7, "eu", "2024-02-30", "03/04/2024"), (8, "eu", "05/13/2024", "03/04/2024"), (8, "eu", "05/13/2024", "03/04/2024"),
            (9, "eu", "26/04/2024", None), (10, "eu", "27/04/2024", None),
        ],
        "formats int, source string, a string, `b.c` string",
    )
    got = parse_dates_by_vote(df, ["a", "b.c"], FORMATS, "source")
    assert got.columns == df.columns
    a = {(r[0], r[1]): r[2] for r in got.collect()}
    assert a[1, "eu"] == day(2024, 4, 3) and a[3, "us"] == day(2024, 3, 4)
    assert a[8, "eu"] == day(2024, 5, 13)  # only the other format fits
    assert a[7, "eu"] is None and a[6, None] == day(2024, 4, 3)
    assert a[5, None] == day(2024, 3, 4)  # a tie goes to the format listed first
    assert got.count() == df.count()
    b = {r[0]: r[3] for r in got.collect()}
    assert b[1] == day(2024, 3, 4) and b[2] == day(2023, 12, 31) and b[3] is b[4] is b[5] is None
    votes = {(r.source, r.column): r for r in format_votes(df, ["a", "b.c"], FORMATS, "source").collect()}
    assert votes["eu", "a"].values == 7 and votes["eu", "a"].fits == [3, 4, 0]
    assert votes["eu", "a"].formats == ["dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd"]


def test_votes_of_a_whole_table_of_nothing_and_without_columns(spark):
    df = spark.createDataFrame([("25/04/2024",), ("03/04/2024",)], "d string")
    assert sorted(r.d for r in parse_dates_by_vote(df, ["d"], FORMATS).collect()) == [day(2024, 4, 3), day(2024, 4, 25)]
    assert parse_dates_by_vote(df.limit(0), ["d"], FORMATS).collect() == []
    assert parse_dates_by_vote(df, [], FORMATS).columns == ["d"]
    assert format_votes(df, [], FORMATS).collect() == []
    with pytest.raises(ValueError):
        parse_dates_by_vote(df, ["d"], [])


def put_aside(load):
    return sorted((r.file.rsplit("/", 1)[1], r.record, r.raw, r.reason) for r in quarantine(load).collect())


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_rows_that_do_not_fit_are_kept_with_their_place(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('id,name,size\n1,x,2\n2,y\n\n3,"a,b",4\n4,z,5,6\n5,"q ""r"", s"\n')
    (tmp_path / "b.csv").write_text("id,name,size\n7,,\n")
    (tmp_path / "c.csv").write_text("id\n1\n")
    load = load_files(spark, discover_files(spark, str(tmp_path)), "csv", multi_line=multi_line, keep_rejects=True)
    assert put_aside(load) == [
        ("a.csv", 2, "2,y", "2 fields instead of 3"),
        ("a.csv", 4, "4,z,5,6", "4 fields instead of 3"),
        ("a.csv", 5, '5,"q ""r"", s"', "2 fields instead of 3"),
    ]
    assert sorted(r.id for r in load.df.collect()) == ["1", "1", "3", "7"]
    assert load.df.columns == ["_source", "id", "name", "size"]
    assert load.df.count() + quarantine(load).count() == 7


def test_records_are_numbered_through_the_parts_of_a_file(spark, tmp_path):
    lines = [f"{i},{'x' * 50}" if i % 997 else f"{i}" for i in range(1, 5_001)]
    (tmp_path / "big.csv").write_text("id,name\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        load = load_files(spark, [f"{tmp_path}/big.csv"], "csv", multi_line=False, keep_rejects=True)
        assert load.scanned.rdd.getNumPartitions() > 3
        assert {(r.record, r.raw) for r in quarantine(load).collect()} == {(i, f"{i}") for i in range(997, 5_001, 997)}
        assert load.df.count() + quarantine(load).count() == 5_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_lines_and_tables_without_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "x"}\n{"id": 2, "name"\nnonsense\n{"id": 3}\n')
    load = load_files(spark, [f"{tmp_path}/a.json"], "json", keep_rejects=True)
    assert put_aside(load) == [
        ("a.json", 2, '{"id": 2, "name"', "JSON object not whole"), ("a.json", 3, "nonsense", "no JSON object"),
    ]
    assert sorted(r.id for r in load.df.collect()) == ["1", "3"]
    spark.range(3).write.parquet(f"{tmp_path}/p.parquet")
    whole = load_files(spark, [f"{tmp_path}/p.parquet"], "parquet", keep_rejects=True)
    assert whole.df.count() == 3 and quarantine(whole).collect() == []
    with pytest.raises(ValueError):
        quarantine(load_files(spark, [f"{tmp_path}/p.parquet"], "parquet"))


def test_a_run_puts_rows_that_do_not_fit_beside_its_output(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Equipment,Size\na1,5\na2\na3,6,7\n")
    (tmp_path / "b.csv").write_text("Equipment,Size\nb1,5\n")
    config = ConsolidationConfig(required_columns=("Equipment", "Size"), column_mappings={}, quarantine=True)
    result = run_consolidation(spark, str(tmp_path), f"{tmp_path}/out", config=config)
    saved, sources = result["saved_files"], result["statistics"]["sources"]
    rejected = spark.read.parquet(saved["rejected"])
    assert sorted((r.source, r.record, r.raw) for r in rejected.collect()) == [("a", 2, "a2"), ("a", 3, "a3,6,7")]
    assert sources["a"] == {"rows": 1, "rows_rejected": 2, "columns": 2}
    assert sorted(r.Equipment for r in spark.read.parquet(saved["parquet"]).collect()) == ["a1", "b1"]


def test_a_value_is_read_by_the_next_format_only_if_the_ones_before_do_not_fit(spark):
    df = spark.createDataFrame([("25/04/2024",), ("03/04/2024",), ("04/25/2024",), ("soon",), (None,)], "d string")
    # Each value was parsed by all formats for each of them, in a map that also refused a format listed twice.
    got = parse_dates_by_vote(df, ["d"], ["MM/dd/yyyy", "dd/MM/yyyy", "dd/MM/yyyy"])
    assert [r.d for r in got.collect()] == [day(2024, 4, 25), day(2024, 3, 4), day(2024, 4, 25), None, None]
    assert "map(" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
