from datetime import date
from decimal import Decimal

import pytest

from gapweave.config import ConsolidationConfig
from gapweave.operators.fingerprint import TableFacts, compare_content, content_facts, merge_content
from gapweave.operators.profile import footprint, null_counts
from gapweave.plans.consolidate import run_consolidation
from gapweave.sources.sinks import read_saved, save_multi_format, save_with_facts, verify_write, write_csv, write_parquet

SCHEMA = "id int, `a b` string, x double, d date, m map<string,int>, l array<struct<y:int>>, n decimal(9,2)"
ROWS = [
    (1, "p", 0.5, date(2024, 1, 2), {"k": 1, "j": 2}, [(1,)], Decimal("1.10")),
    (2, "q", None, None, None, None, None),
    (2, "q", None, None, None, None, None),
    (3, "", float("nan"), date(1900, 1, 1), {}, [(None,), (2,)], Decimal("-3.00")),
]


def same(df, other):
    return {(r["level"], r["column"]): r["same"] for r in compare_content(content_facts(df), content_facts(other)).collect()}


def test_order_and_partitions_do_not_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    other = spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(3)
    assert set(same(df, other).values()) == {True}
    assert len(same(df, other)) == len(df.columns) + 1


def test_every_kind_of_change_shows_where_it_is(spark):
    df = spark.createDataFrame([(1, "p", "x"), (2, "q", "y"), (2, "q", "y"), (3, None, "z")], "id int, a string, b string")

    def against(rows):
        return {c for (_, c), ok in same(df, spark.createDataFrame(rows, df.schema)).items() if not ok}

    assert against([(1, "q", "x"), (2, "p", "y"), (2, "q", "y"), (3, None, "z")]) == {""}  # swapped between rows
    assert against([(1, "p", "x"), (2, "q", "y"), (3, None, "z")]) == {"", "id", "a", "b"}  # a lost duplicate
    assert against([(1, "p", "x"), (2, "q", "y"), (1, "p", "x"), (3, None, "z")]) == {"", "id", "a", "b"}  # another repeated
    assert against([(1, "p", "x"), (2, "q", "y"), (2, "q", "Y"), (3, None, "z")]) == {"", "b"}  # one cell
    assert against([(1, "p", "x"), (2, "q", "y"), (2, "q", "y"), (3, "z", None)]) == {"", "a", "b"}  # a null that moved


def test_facts_of_parts_add_up(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    parts = [spark.createDataFrame(rows, SCHEMA) for rows in (ROWS[:1], ROWS[1:], [])]
    merged = merge_content(content_facts(parts[0]).unionByName(content_facts(parts[1])).unionByName(content_facts(parts[2])))
    assert {r["same"] for r in compare_content(merged, content_facts(df)).collect()} == {True}


def test_sums_are_taken_modulo_two_to_the_64(spark):
    total = content_facts(spark.range(5000)).where("level = 'row'").first()
    brute = [0, 0]
    for row in spark.range(5000).selectExpr("xxhash64(1, id, id IS NULL) AS a", "xxhash64(2, id, id IS NULL) AS b").collect():
        brute = [(brute[0] + row["a"]) % 2**64, (brute[1] + row["b"]) % 2**64]
    assert [int(total["check_a"]), int(total["check_b"])] == brute


def test_facts_taken_while_writing(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    facts = TableFacts(df)
    facts.df.write.parquet(f"{tmp_path}/t.parquet")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert facts.rows == 4
    assert rows(facts.null_counts(spark)) == rows(null_counts(df))
    assert rows(facts.footprint(spark)) == rows(footprint(df))
    assert rows(facts.content(spark)) == rows(content_facts(df))
    empty = TableFacts(df.limit(0))
    empty.df.write.parquet(f"{tmp_path}/e.parquet")
    assert empty.rows == 0 and {r["check_a"] for r in empty.content(spark).collect()} == {0}


def test_verification_reads_values(spark, tmp_path):
    df = spark.createDataFrame([(1, " p ", None), (2, "", "y\r\nz"), (2, "q", "y")], "id int, a string, b string")
    saved = save_multi_format(df, f"{tmp_path}/out", "p")
    assert {r["format"]: r["verified"] for r in verify_write(spark, saved, df).collect()} == {"csv": True, "parquet": True}
    swapped = spark.createDataFrame([(2, " p ", None), (1, "", "y\r\nz"), (2, "q", "y")], df.schema)
    assert not any(r["verified"] for r in verify_write(spark, saved, swapped).collect())
    renamed = verify_write(spark, saved, df.withColumnRenamed("a", "c")).collect()
    assert [(r["rows"], r["verified"]) for r in renamed] == [(3, False)] * 2


@pytest.mark.parametrize("formats", [(True, True), (True, False), (False, True)])
def test_run_finds_what_a_writer_changes(spark, tmp_path, monkeypatch, formats):
    from gapweave.sources import sinks

    (tmp_path / "a.csv").write_text('Equipment,Size\na1,5\na1,5\na2,\na3,"x\ny"\n')
    config = ConsolidationConfig(
        required_columns=("Equipment", "Size"), column_mappings={}, save_parquet=formats[0], save_csv=formats[1]
    )
    fine = run_consolidation(spark, str(tmp_path), f"{tmp_path}/out", config=config)
    report = fine["statistics"]
    assert report["processing_statistics"]["total"]["rows_removed"] == 1
    assert report["completeness"]["Size"] == {"non_null_count": 2.0, "null_count": 1.0, "completeness_percent": 66.67}
    schema = "Equipment string, Size string"
    for path in (p for name, p in fine["saved_files"].items() if name != "report"):
        assert read_saved(spark, path, spark.createDataFrame([], schema).schema).count() == 3
    name = "write_parquet" if formats[0] else "write_csv"
    writer = write_parquet if formats[0] else write_csv
    monkeypatch.setattr(sinks, name, lambda df, path: writer(df.selectExpr("Equipment", "replace(Size, '5', '6') AS Size"), path))
    with pytest.raises(ValueError, match="differs"):
        run_consolidation(spark, str(tmp_path), f"{tmp_path}/bad", config=config)


def test_the_written_table_is_read_twice(spark, tmp_path):
    """Scans of the stored result in the jobs of a run: the copy to CSV, and one for everything else."""
    (tmp_path / "a.csv").write_text("Equipment,Size\na1,5\na2,6\n")
    config = ConsolidationConfig(required_columns=("Equipment", "Size"), column_mappings={})
    seen = []
    original = type(spark.read).load

    def load(self, path=None, *rest, **options):
        seen.append(str(path))
        return original(self, path, *rest, **options)

    type(spark.read).load = load
    try:
        saved = run_consolidation(spark, str(tmp_path), f"{tmp_path}/out", config=config)["saved_files"]
    finally:
        type(spark.read).load = original
    assert seen.count(saved["parquet"]) == 2
    assert seen.count(saved["csv"]) == 1


def test_what_was_written_is_read_once_and_not_computed_again(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("", 2), (None, 3)], "a string, b int")
    saved, facts = save_with_facts(df, str(tmp_path), "t")
    # Rows were counted by a scan of their own, and the table was computed twice more.
    checked = verify_write(spark, saved, df, facts)
    assert {r["format"]: (r["rows"], r["verified"]) for r in checked.collect()} == {"csv": (3, True), "parquet": (3, True)}
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    write_parquet(df.union(df.limit(1)), f"{tmp_path}/more.parquet")
    changed = verify_write(spark, {"parquet": f"{tmp_path}/more.parquet"}, df, facts).collect()
    assert [(r["rows"], r["verified"]) for r in changed] == [(4, False)]
