import os

import pytest

from gapweave.operators.profile import completeness, footprint, sample_values
from gapweave.operators.states import STANDARD_ERROR, merge_states, profile_states, state_profile, state_samples
from gapweave.sources.files import discover_files, load_files, load_validation
from gapweave.sources.manifest import manifest, refresh, snapshot, stored_states, stored_summary


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def assert_like_a_full_load(spark, directory, store, pattern="*.csv", **options):
    load = load_files(spark, discover_files(spark, directory, pattern), pattern.rsplit(".", 1)[1], **options)
    got = snapshot(spark, store)
    assert sorted(got.columns) == sorted(load.df.columns)
    assert rows(got) == rows(load.df)
    assert rows(stored_summary(spark, store)) == rows(load_validation(load))


def test_runs_read_new_and_changed_files_only(spark, tmp_path):
    raw, store = tmp_path / "raw", f"{tmp_path}/store"
    raw.mkdir()
    (raw / "a.csv").write_text("id,name\n001,x\n001,x\n")
    (raw / "b +1 ü.csv").write_text("name,size\ny,\n")
    (raw / "empty.csv").write_text("id,old\n")
    first = refresh(spark, str(raw), store)
    assert (first.batch, len(first.read), first.known, first.removed) == (1, 3, 0, ())
    assert_like_a_full_load(spark, str(raw), store)
    # What is known is not opened again: its bytes are spoiled, with the length and time they had.
    status = os.stat(raw / "a.csv")
    (raw / "a.csv").write_text("#" * status.st_size)
    os.utime(raw / "a.csv", ns=(status.st_atime_ns, status.st_mtime_ns))
    assert refresh(spark, str(raw), store).batch is None
    (raw / "sub").mkdir()
    (raw / "sub" / "a.csv").write_text("id,name\n7,z\n")
    second = refresh(spark, str(raw), store)
    assert (second.batch, [p.rsplit("/", 2)[1:] for p in second.read], second.known) == (2, [["sub", "a.csv"]], 3)
    (raw / "a.csv").write_text("id,name\n001,x\n001,x\n")
    os.utime(raw / "a.csv", ns=(status.st_atime_ns, status.st_mtime_ns))
    assert_like_a_full_load(spark, str(raw), store)  # two files of one name now, so both are named by their folders
    # A changed file is a new version; one that is gone takes its rows and columns along.
    (raw / "a.csv").write_text("id,note\n001,new\n")
    (raw / "empty.csv").unlink()
    third = refresh(spark, str(raw), store)
    assert (third.batch, len(third.read), [p.rsplit("/", 1)[1] for p in third.removed]) == (3, 1, ["empty.csv"])
    assert_like_a_full_load(spark, str(raw), store)
    assert "old" not in snapshot(spark, store).columns
    # A file that comes back is read again.
    (raw / "empty.csv").write_text("id,old\n5,o\n")
    assert len(refresh(spark, str(raw), store).read) == 1
    assert_like_a_full_load(spark, str(raw), store)


def test_equal_contents_have_equal_checks(spark, tmp_path):
    for name, text in (("a", "id\n1\n2\n"), ("b", "id\n2\n1\n"), ("c", "id\n2\n2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    refresh(spark, str(tmp_path), f"{tmp_path}/store")
    checks = {r["file"][-5]: r["check_a"] for r in manifest(spark, f"{tmp_path}/store").collect()}
    assert checks["a"] == checks["b"] != checks["c"]


def test_a_failed_run_leaves_the_store_as_it_was(spark, tmp_path):
    raw, store = tmp_path / "raw", f"{tmp_path}/store"
    raw.mkdir()
    (raw / "a.csv").write_text("id\n1\n")
    refresh(spark, str(raw), store)
    # Rows of a second run without its manifest.
    spark.createDataFrame([("9", "/x", False)], "id string, _file string, _rejected boolean").write.parquet(f"{store}/rows/_batch=2")
    assert_like_a_full_load(spark, str(raw), store)
    (raw / "b.csv").write_text("id\n2\n")
    assert refresh(spark, str(raw), store).batch == 2
    assert_like_a_full_load(spark, str(raw), store)
    (raw / "c.csv").write_text("_file\n2\n")
    with pytest.raises(ValueError, match="_file"):
        refresh(spark, str(raw), store)
    assert len(snapshot(spark, store).collect()) == 2
    with pytest.raises(FileNotFoundError):
        refresh(spark, str(raw), store, "*.json")


def test_damaged_files_and_folders_of_parts(spark, tmp_path):
    raw, store = tmp_path / "raw", f"{tmp_path}/store"
    spark.range(30).repartition(3).write.parquet(f"{raw}/n.parquet")
    (raw / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        refresh(spark, str(raw), store, "*.parquet")
    found = refresh(spark, str(raw), store, "*.parquet", skip_corrupt=True)
    assert len(found.skipped) == 1 and found.known == 0
    assert snapshot(spark, store).count() == 30
    verdicts = {r["source"]: (r["rows"], r["verdict"]) for r in stored_summary(spark, store).collect()}
    assert verdicts == {"n": (30, "ok"), "bad": (0, "skipped")}
    assert refresh(spark, str(raw), store, "*.parquet", skip_corrupt=True).batch is None


def test_merged_states_equal_the_profile_at_once(spark, tmp_path):
    data = [(n % 3, f"v{n % 700:03}", None if n % 4 else "é", "") for n in range(3000)] + [(None, None, None, None)]
    df = spark.createDataFrame(data, "part int, a string, b string, c string").repartition(4)
    plain = df.drop("part")
    states = profile_states(df.withColumn("part", df["part"].cast("string")), "part", plain.columns)
    assert states.count() == 4 * 3
    at_once = profile_states(plain.selectExpr("'all' AS part", "*"), "part", plain.columns)
    merged, direct = state_profile(merge_states(states)), state_profile(merge_states(at_once))
    assert rows(merged) == rows(direct)
    assert rows(merged.select("column", "non_null_count", "null_count", "completeness_percent")) == rows(completeness(plain))
    assert rows(merged.select("column", "rows", "bytes")) == rows(footprint(plain))
    assert rows(state_samples(merge_states(states))) == rows(sample_values(plain))
    distinct = {r["column"]: r["unique_values"] for r in merged.collect()}
    assert distinct["b"] == 1 and distinct["c"] == 1 and abs(distinct["a"] - 700) <= 4 * STANDARD_ERROR * 700
    by_part = merge_states(states, ["part"])
    assert rows(by_part.where("part IS NULL").select("column", "rows", "non_null_count")) == [
        repr(("a", 0, 1)), repr(("b", 0, 1)), repr(("c", 0, 1))
    ]
    assert merge_states(profile_states(df.limit(0), "part", ["a"])).count() == 0


def test_states_of_a_store_follow_its_files(spark, tmp_path):
    raw, store = tmp_path / "raw", f"{tmp_path}/store"
    raw.mkdir()
    (raw / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (raw / "b.csv").write_text("id\n3\n")
    refresh(spark, str(raw), store)
    (raw / "a.csv").write_text("id,name\n1,zz\n")
    refresh(spark, str(raw), store)
    got = {r["column"]: (r["rows"], r["non_null_count"], r["null_count"], r["bytes"]) for r in state_profile(
        merge_states(stored_states(spark, store)), 2).collect()}
    assert got == {"id": (2, 2, 0, 2), "name": (2, 1, 1, 2)}
