import pytest

from gapweave.sources.codes import decode_stored, encode_stored, extend_codes, stored_codes, versions


def rows(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, t string").repartition(5)


def codes(spark, store, version=None):
    return {r["value"]: r["code"] for r in stored_codes(spark, store, version).collect()}


def test_codes_of_a_run_stay_in_the_next(spark, tmp_path):
    store = str(tmp_path / "codes")
    assert versions(spark, store) == [] and codes(spark, store) == {}
    assert extend_codes(rows(spark, ["m", "z", None, "m"]), ["t"], store) == 1
    assert codes(spark, store) == {"m": 0, "z": 1}
    assert extend_codes(rows(spark, ["z", "a", "", "x", None]), ["t"], store) == 2
    assert codes(spark, store) == {"m": 0, "z": 1, "": 2, "a": 3, "x": 4}
    assert codes(spark, store, 1) == {"m": 0, "z": 1}
    # Nothing new: no version, and the same codes.
    assert extend_codes(rows(spark, ["a", "m"]), ["t"], store) == 2
    assert versions(spark, store) == [1, 2]
    with pytest.raises(ValueError):
        stored_codes(spark, store, 3)


def test_columns_are_numbered_apart_and_an_empty_table_makes_a_store(spark, tmp_path):
    store = str(tmp_path / "codes")
    df = spark.createDataFrame([], "a string, `b c` string")
    assert extend_codes(df, ["a", "b c"], store) == 1 and codes(spark, store) == {}
    df = spark.createDataFrame([("x", "y"), ("y", None), ("x", "x")], df.schema)
    assert extend_codes(df, ["a", "b c"], store) == 2
    got = {(r["column"], r["value"], r["code"]) for r in stored_codes(spark, store).collect()}
    assert got == {("a", "x", 0), ("a", "y", 1), ("b c", "x", 0), ("b c", "y", 1)}


@pytest.mark.parametrize("limit", [0, 2**20])
def test_decoding_gives_the_input_by_either_join(spark, tmp_path, limit):
    store = str(tmp_path / "codes")
    values = ["hot" if i % 3 else f"v{i}" for i in range(200)] + [None, ""]
    df = rows(spark, values)
    extend_codes(rows(spark, values[:50]), ["t"], store)
    extend_codes(df, ["t"], store)
    encoded = encode_stored(df, ["t"], store, "id", broadcast_bytes=limit)
    assert encoded.where("t IS NOT NULL AND t_code IS NULL").isEmpty()
    back = decode_stored(encoded.drop("t"), ["t"], store, "id", broadcast_bytes=limit)
    assert {r["id"]: r["t"] for r in back.collect()} == dict(enumerate(values))


def test_a_run_that_ended_early_leaves_the_store_as_it_was(spark, tmp_path):
    store = str(tmp_path / "codes")
    extend_codes(rows(spark, ["m"]), ["t"], store)
    rows(spark, ["half"]).write.parquet(f"{store}/_pending-2")
    assert codes(spark, store) == {"m": 0}
    assert extend_codes(rows(spark, ["k"]), ["t"], store) == 2
    assert codes(spark, store) == {"m": 0, "k": 1}
