import logging
import pathlib

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from gapweave.config import CompletionConfig, ConsolidationConfig
from gapweave.plans.consolidate import run_consolidation
from gapweave.sources.files import (
    discover_files,
    format_of,
    load_files,
    load_summary,
    load_table,
    load_typed,
    load_validation,
    plain_path,
    source_name,
)
from gapweave.sources.sinks import (
    backup_snapshot,
    completed_path,
    output_paths,
    resolve_output,
    save_completed,
    save_multi_format,
    verify_write,
    write_json_document,
)


def names(paths):
    return [p.rsplit("/", 1)[-1] for p in paths]


def test_discovery_is_sorted_and_strict(spark, tmp_path):
    for name in ("b.csv", "a.csv", "c.txt"):
        (tmp_path / name).write_text("x\n1\n")
    assert names(discover_files(spark, str(tmp_path))) == ["a.csv", "b.csv"]
    with pytest.raises(FileNotFoundError):
        discover_files(spark, str(tmp_path), "*.json")
    with pytest.raises(FileNotFoundError):
        discover_files(spark, str(tmp_path / "nowhere"))


def test_drifting_files_are_joined_by_name_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n001,x\n")
    (tmp_path / "b +1 ü.csv").write_text("name,id\ny,002\n")
    (tmp_path / "c.csv").write_text("id,extra\n003,\n")
    (tmp_path / "d.csv").write_text("id,name\n")
    load = load_files(spark, discover_files(spark, str(tmp_path)), "csv")
    rows = {(r["id"], r["name"], r["extra"], r["_source"]) for r in load.df.collect()}
    assert rows == {("001", "x", None, "a"), ("002", "y", None, "b +1 ü"), ("003", None, None, "c")}
    assert {tuple(r) for r in load_summary(load).collect()} == {("a", 1, 2), ("b +1 ü", 1, 2), ("c", 1, 2), ("d", 0, 2)}
    assert {r["source"]: r["verdict"] for r in load_validation(load).collect()}["d"] == "empty"


def test_files_of_one_layout_share_a_scan(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"f{i}.csv").write_text(f"id,name\n{i},x\n")
    df = load_files(spark, discover_files(spark, str(tmp_path)), "csv").df
    assert df.count() == 30
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_unreadable_files_are_skipped_unless_none_is_left(spark, tmp_path, caplog):
    spark.range(3).write.parquet(f"{tmp_path}/good.parquet")
    (tmp_path / "bad.parquet").write_text("this is no parquet file, not at all")
    with caplog.at_level(logging.WARNING):
        load = load_files(
            spark, [f"{tmp_path}/bad.parquet", f"{tmp_path}/good.parquet"], "parquet", skip_corrupt=True
        )
    assert load.skipped == ("bad",) and "bad.parquet" in caplog.text
    assert load.df.count() == 3
    with pytest.raises(ValueError):
        load_files(spark, [f"{tmp_path}/bad.parquet"], "parquet", skip_corrupt=True)


def test_broken_json_rows_are_left_out(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "n": "x"}\n{"id": 2, \n{"id": 3}\n')
    df = load_files(spark, [f"{tmp_path}/a.json"], "json").df
    assert {(r["id"], r["n"]) for r in df.collect()} == {("1", "x"), ("3", None)}


def test_typed_and_text_loading(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n007,1.5\n")
    assert load_table(spark, f"{tmp_path}/a.csv").first()["id"] == "007"
    assert dict(load_typed(spark, f"{tmp_path}/a.csv", infer=True).dtypes) == {"id": "int", "x": "double"}
    with pytest.raises(FileNotFoundError):
        load_typed(spark, f"{tmp_path}/none.csv")
    with pytest.raises(ValueError, match="xlsx"):
        load_typed(spark, f"{tmp_path}/none.xlsx")
    assert format_of("a/B.CSV") == "csv"


def test_names():
    assert source_name("file:/x/a.csv") == "a"
    assert source_name("file:/x/a.parquet/part-0.snappy.parquet") == "a"
    assert completed_path("/d/target.csv", "parquet") == "/d/target_completed.parquet"
    paths = output_paths("/out/", "records", "20240102_030405")
    assert paths == {
        "csv": "/out/records_20240102_030405.csv",
        "parquet": "/out/records_20240102_030405.parquet",
        "report": "/out/records_report_20240102_030405.json",
    }


def test_saved_formats_agree_and_empty_tables_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b",\nc', None), ("2", "y", "x")], "id string, `t x` string, n string")
    saved = save_multi_format(df, f"{tmp_path}/out", "p")
    assert {r["format"]: r["verified"] for r in verify_write(spark, saved, df).collect()} == {"csv": True, "parquet": True}
    got = load_typed(spark, saved["csv"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    only = save_multi_format(df, f"{tmp_path}/only", "p", ConsolidationConfig(save_parquet=False))
    assert list(only) == ["csv"]
    with pytest.raises(ValueError, match="empty"):
        save_multi_format(df.limit(0), f"{tmp_path}/none", "p")
    bad = verify_write(spark, saved, df.union(df)).collect()
    assert not any(r["verified"] for r in bad)


def test_unknown_output_format_falls_back_to_csv(spark, tmp_path, caplog):
    df = spark.createDataFrame([("1", 0.5)], "id string, my_score double")
    df.write.parquet(f"{tmp_path}/in.parquet")
    with caplog.at_level(logging.WARNING):
        written = save_completed(df, f"{tmp_path}/in.parquet", f"{tmp_path}/done.xlsx")
    assert written == f"{tmp_path}/done.csv" and ".xlsx" in caplog.text
    assert load_typed(spark, f"{tmp_path}/in_backup.parquet").count() == 1
    plain = save_completed(df, f"{tmp_path}/in.parquet", config=CompletionConfig(include_scores=False, output_format="json"))
    assert load_typed(spark, plain).columns == ["id"]


def test_failed_backup_only_warns(spark, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        assert backup_snapshot(spark, f"{tmp_path}/missing.parquet") is None
    assert "No backup" in caplog.text


def test_json_document_is_indented_and_tolerant(spark, tmp_path):
    path = write_json_document(spark, {"a": {"b": ConsolidationConfig}}, f"{tmp_path}/r.json")
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    assert text.startswith('{\n  "a": {\n    "b": "<class')


def damaged_parquet(spark, path, rows=20_000):
    """One Parquet file with a healthy footer and overwritten pages."""
    folder = pathlib.Path(path).parent / "_parts"
    spark.range(rows).selectExpr("id", "uuid() AS text").coalesce(1).write.parquet(str(folder))
    part = next(p for p in folder.iterdir() if p.suffix == ".parquet")
    data = bytearray(part.read_bytes())
    data[len(data) // 3 : len(data) // 3 + 2_000] = b"\x00" * 2_000
    pathlib.Path(path).write_bytes(bytes(data))


def test_damaged_pages_fail_the_load_or_leave_the_file_out_whole(spark, tmp_path):
    damaged_parquet(spark, f"{tmp_path}/bad.parquet")
    for name in ("one", "two"):
        spark.range(5).selectExpr("id", "'x' AS text").write.parquet(f"{tmp_path}/{name}.parquet")
    paths = discover_files(spark, str(tmp_path), "*.parquet")
    assert names(paths) == ["bad.parquet", "one.parquet", "two.parquet"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        load_validation(load_files(spark, paths, "parquet")).collect()
    load = load_files(spark, paths, "parquet", skip_corrupt=True)
    assert load.skipped == ("bad",) and load.reasons["bad"]
    assert load.df.count() == 10
    assert {(r["source"], r["rows"], r["verdict"]) for r in load_validation(load).collect()} == {
        ("one", 5, "ok"), ("two", 5, "ok"), ("bad", 0, "skipped")
    }


def test_rejected_rows_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2, \nnonsense\n{"id": 3}\n')
    (row,) = load_validation(load_files(spark, [f"{tmp_path}/a.json"], "json")).collect()
    assert (row["rows"], row["rows_rejected"], row["verdict"]) == (2, 2, "ok")


def test_files_of_one_name_in_several_folders_stay_apart(spark, tmp_path):
    for folder, header in (("x", "id,name"), ("y", "id,other")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text(f"{header}\n1,2\n")
    (tmp_path / "b.csv").write_text("id,name\n3,4\n")
    load = load_files(spark, discover_files(spark, str(tmp_path)), "csv")
    assert load.columns == {"x/a": ("id", "name"), "y/a": ("id", "other"), "b": ("id", "name")}
    assert {(r["source"], r["rows"]) for r in load_summary(load).collect()} == {("x/a", 1), ("y/a", 1), ("b", 1)}


def test_files_without_columns_are_a_failure(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "full.csv").write_text("id\n1\n")
    paths = discover_files(spark, str(tmp_path))
    assert names(paths) == ["empty.csv", "full.csv"]
    verdicts = {r["source"]: r["verdict"] for r in load_validation(load_files(spark, paths, "csv")).collect()}
    assert verdicts == {"empty": "no_columns", "full": "ok"}
    with pytest.raises(ValueError, match="no columns"):
        run_consolidation(spark, str(tmp_path), f"{tmp_path}/out")


def test_folders_of_part_files_are_one_source(spark, tmp_path):
    spark.range(40).repartition(6).write.parquet(f"{tmp_path}/deep/numbers.parquet")
    paths = discover_files(spark, str(tmp_path), "*.parquet")
    assert names(paths) == ["numbers.parquet"]
    assert [tuple(r) for r in load_summary(load_files(spark, paths, "parquet")).collect()] == [("numbers", 40, 1)]


def test_an_empty_table_leaves_nothing_behind(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        save_multi_format(spark.range(0), str(tmp_path), "none")
    assert list(tmp_path.iterdir()) == []


def test_existing_outputs_are_found_before_any_work(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id\n1\n")
    (tmp_path / "t_completed.csv").mkdir()
    with pytest.raises(FileExistsError):
        resolve_output(spark, f"{tmp_path}/t.csv")
    assert resolve_output(spark, f"{tmp_path}/t.csv", None, CompletionConfig(overwrite=True)).endswith("t_completed.csv")
    with pytest.raises(ValueError, match="original"):
        resolve_output(spark, f"{tmp_path}/t.csv", f"{tmp_path}/t.csv", CompletionConfig(overwrite=True))


def test_the_run_report_names_files_types_and_sizes(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"Equipment,Size\n{name}1,5\n{name}2,6\n")
    config = ConsolidationConfig(required_columns=("Equipment", "Size"), column_mappings={})
    report = run_consolidation(spark, str(tmp_path), f"{tmp_path}/out", config=config)["statistics"]
    assert 2 in {facts.get("files_combined") for facts in report["processing_statistics"].values()}
    assert set(report["data_types"]) == {"Equipment", "Size"} == set(report["narrowing"])
    assert report["sample_values"]["Equipment"] == ["a1", "a2", "b1", "b2"]
    assert report["sources"]["a"] == {"rows": 2, "rows_rejected": 0, "columns": 2}


def test_rows_name_their_file_by_plain_string_functions(spark, tmp_path):
    for name in ("a.b.csv", "odd + %41 é.csv", "T.CSV/part-0.csv", "deep/u.csv/part-1.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x\n1\n")
    paths = discover_files(spark, str(tmp_path), "*.{csv,CSV}")
    assert len(paths) == 4
    for by_path, named in ((False, source_name), (True, plain_path)):
        load = load_files(spark, paths, "csv", by_path=by_path)
        assert sorted(r["_source"] for r in load.df.collect()) == sorted(map(named, paths))
        # Patterns on the path of each row took 25 to 100 microseconds a row.
        assert "regexp" not in load.df._jdf.queryExecution().optimizedPlan().toString().lower()
