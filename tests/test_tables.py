import datetime

import pytest

from gapweave.config import ConsolidationConfig
from gapweave.operators.columns import (
    add_missing_columns,
    find_column_mapping,
    order_output_columns,
    resolve_aliases,
)
from gapweave.operators.combine import (
    combination_stats,
    missing_columns_by_source,
    project_required,
    rename_columns,
    union_by_name,
)
from gapweave.operators.lookup import skew_safe_lookup
from gapweave.operators.narrow import (
    category_columns,
    dictionary,
    dictionary_encode,
    narrow_floats,
    narrow_integers,
    smallest_integer_type,
)
from gapweave.operators.profile import cardinality_ratio, column_info, completeness, sample_values
from gapweave.operators.validate import column_issues, require_valid, rows_needing_fill, validate_null_ratio
from gapweave.plans.consolidate import consolidate


def test_union_sorts_columns_and_fills_with_null(spark):
    a = spark.createDataFrame([("1", "x")], "b string, a string")
    b = spark.createDataFrame([("2",)], "`c d` string")
    df = union_by_name([a, b, a])
    assert df.columns == ["a", "b", "c d"]
    assert sorted(map(tuple, df.collect()), key=repr) == [("x", "1", None), ("x", "1", None), (None, None, "2")]
    with pytest.raises(ValueError):
        union_by_name([])


def test_union_turns_columns_of_differing_type_into_text(spark):
    a = spark.createDataFrame([(7, 1)], "id bigint, n bigint")
    b = spark.createDataFrame([("007", 2)], "id string, n bigint")
    df = union_by_name([a, b])
    assert dict(df.dtypes) == {"id": "string", "n": "bigint"}
    assert sorted(map(tuple, df.collect())) == [("007", 2), ("7", 1)]


def test_projection_keeps_required_order(spark):
    df = spark.createDataFrame([("1", "2", "3")], "z string, `a b` string, m string")
    assert project_required(df, ["m", "nope", "a b"]).columns == ["m", "a b"]
    with pytest.raises(ValueError):
        project_required(df, ["nope"])
    assert rename_columns(df, {"a b": "c", "unknown": "d"}).columns == ["z", "c", "m"]


def test_missing_columns_without_any(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert missing_columns_by_source({"x": df}, ["a"]).collect() == []


def test_combination_stats_of_empty_sources(spark):
    empty = spark.createDataFrame([], "a string")
    assert combination_stats([empty, empty], empty).collect()[0].asDict() == {
        "files_combined": 2,
        "original_total_rows": 0,
        "final_rows": 0,
        "rows_removed": 0,
        "final_columns": 1,
    }


def test_consolidate_drops_rows_that_differ_only_in_dropped_columns(spark):
    a = spark.createDataFrame(
        [("007", "Pump", "2024-01-02", "x"), ("007", "Pump", "2024-01-02", "y")],
        "Equipment string, `Equipment description` string, `Created on` string, Note string",
    )
    b = spark.createDataFrame([("007", "Pump", None), ("8", None, "bad")], "Equipment string, ObjectType string, `Chngd On` string")
    df = consolidate([a, b])
    assert df.columns == [
        "equipment_number",
        "Equipment Description",
        "created_on",
        "changed_on",
        "Equipment Type",
    ]
    assert sorted(map(tuple, df.collect()), key=repr) == [
        ("007", "Pump", datetime.datetime(2024, 1, 2), None, None),
        ("007", None, None, None, "Pump"),
        ("8", None, None, None, None),
    ]


def test_consolidate_is_idempotent_on_rows(spark):
    once = union_by_name([spark.createDataFrame([("1", "a"), ("1", "a"), (None, None)], "Equipment string, ObjectType string")])
    config = ConsolidationConfig(column_mappings={})
    first = consolidate([once], config)
    assert sorted(first.collect(), key=repr) == sorted(consolidate([first], config).collect(), key=repr)
    no_empty = consolidate([once], ConsolidationConfig(remove_empty_rows=True))
    assert no_empty.count() == 1
    assert consolidate([once], ConsolidationConfig(remove_duplicates=False)).count() == 3


def test_alias_resolution_prefers_exact_then_any_case():
    assert find_column_mapping(["objecttype", "equip_type", "DESC"]) == {
        "equipment_type": "equip_type",
        "equipment_description": "DESC",
    }
    assert find_column_mapping(["OBJECTTYPE", "x"]) == {"equipment_type": "OBJECTTYPE"}
    assert find_column_mapping(["ObjectType", "Equipment Type"]) == {"equipment_type": "Equipment Type"}


def test_alias_clash_is_an_error(spark):
    df = spark.createDataFrame([("1", "2")], "`Equipment Type` string, equipment_type string")
    with pytest.raises(ValueError, match="equipment_type"):
        resolve_aliases(df)


def test_missing_logical_columns_and_output_order(spark):
    df = spark.createDataFrame([("s", "1", "k")], "My_Score string, equip_type string, key string")
    full = add_missing_columns(resolve_aliases(df))
    assert full.schema["equipment_description"].dataType.simpleString() == "string"
    assert order_output_columns(full).columns == ["equipment_type", "equipment_description", "key", "My_Score"]
    assert order_output_columns(full, include_scores=False).columns == ["equipment_type", "equipment_description", "key"]


def test_validation(spark):
    assert column_issues(["description"], "master") == ["master table has no equipment_type column"]
    assert column_issues([], "target") == []
    with pytest.raises(ValueError, match="empty"):
        require_valid(spark.createDataFrame([], "desc string, equip_type string"), "master")
    df = spark.createDataFrame([(None, "1")] * 10 + [("x", None)], "a string, b string").selectExpr("a", "b", "cast(null as string) c")
    severity = {r["column"]: r["severity"] for r in validate_null_ratio(df).collect()}
    assert severity == {"a": "warn", "b": "ok", "c": "all_null"}
    assert rows_needing_fill(df, ["b"]).count() == 1


@pytest.mark.parametrize(
    "low, high, kind",
    [(0, 127, "tinyint"), (0, 128, "smallint"), (0, 254, "smallint"), (0, 255, "smallint"), (-128, 0, "tinyint"),
     (-129, 0, "smallint"), (0, 32767, "smallint"), (0, 65535, "int"), (0, 2**31 - 1, "int"), (0, 2**31, "bigint"),
     (-(2**31) - 1, 0, "bigint")],
)
def test_smallest_integer_type(low, high, kind):
    assert smallest_integer_type(low, high) == kind


def test_narrowing_keeps_values_and_skips_empty_columns(spark):
    df = spark.createDataFrame([(1, 300, None, 1e300, 0.5, None), (2, -1, None, 1.0, None, None)],
                               "a bigint, b bigint, c bigint, d double, e double, f double")
    narrowed = narrow_floats(narrow_integers(df))
    assert dict(narrowed.dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "bigint", "d": "double", "e": "float", "f": "double",
    }
    assert sorted(map(tuple, narrowed.collect())) == sorted(map(tuple, df.collect()))


def test_dictionary_codes_follow_the_sorted_values(spark):
    values = [f"v{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "t string").repartition(7)
    codes = {r["value"]: r["code"] for r in dictionary(df, "t").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("limit", [0, 2**20])
def test_dictionary_encode_by_either_join(spark, limit):
    rows = [(i, "hot" if i % 3 else f"v{i}") for i in range(200)] + [(i, None) for i in range(200, 300)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {r["id"]: (r["t"], r["t_code"]) for r in dictionary_encode(df, ["t"], "id", limit).collect()}
    order = {v: i for i, v in enumerate(sorted({t for _, t in rows if t}))}
    assert got == {i: (t, order.get(t)) for i, t in rows}


def test_lookup_salts_hot_keys_without_losing_or_doubling_rows(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)] + [(i, None) for i in range(300, 320)],
                                  "id int, k int")
    dimension = spark.createDataFrame([(k, f"n{k}") for k in range(150)], "k int, name string")
    got = {r["id"]: r["name"] for r in skew_safe_lookup(facts, dimension, "k", "id", hot_rows=10).collect()}
    want = {r["id"]: f"n{r['k']}" if r["k"] is not None and r["k"] < 150 else None for r in facts.collect()}
    assert got == want


def test_profiles(spark):
    df = spark.createDataFrame([("b", 0.0), ("a", -0.0), (None, 1.0), ("b", None)], "t string, x double")
    info = {r["column"]: r for r in column_info(df).collect()}
    assert (info["t"]["unique_values"], info["t"]["non_null_count"], info["t"]["null_percentage"]) == (2, 3, 25.0)
    assert (info["x"]["unique_values"], info["x"]["data_type"]) == (2, "double")
    estimate = {r["column"]: r["unique_values"] for r in column_info(df, approximate=True).collect()}
    assert estimate["t"] == 2
    assert [(r["position"], r["value"]) for r in sample_values(df).orderBy("position").collect()] == [(1, "a"), (2, "b")]
    ratios = {r["column"]: r["ratio"] for r in cardinality_ratio(df).collect()}
    assert ratios == {"t": 0.5, "x": 0.5}
    assert category_columns(df) == ()


def test_completeness_of_an_empty_table(spark):
    rows = completeness(spark.createDataFrame([], "a string")).collect()
    assert [tuple(r) for r in rows] == [("a", 0, 0, 0.0)]
