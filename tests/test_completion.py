import json

import numpy as np
import pytest

from gapweave.config import CompletionConfig, ConsolidationConfig
from gapweave.operators.knn import BlockLimits
from gapweave.operators.report import completion_stats, score_stats
from gapweave.plans.complete import complete, run_completion
from gapweave.plans.consolidate import run_consolidation

SCHEMA = "id int, equipment_type string, equipment_description string"
MASTER = [
    (1, "EQERMA", "EQUALIZATION TANK MIXER MOTOR"),
    (2, "EQMRPC", "100A01B-EQUALISATION TANK MIXERS"),
    (3, "PUMP", None),
    (4, None, None),
]
TARGET = [
    (10, None, "mixer motor for equalization tank"),
    (11, "EQMRPC", None),
    (12, "VALVE", "kept as it is"),
    (13, None, None),
    (14, None, "nothing alike"),
]


class ExampleEncoder:
    """Places the documented example's texts; a stand-in for a neural model."""

    def encode(self, texts):
        return np.array([self._one(t) for t in texts])

    @staticmethod
    def _one(text):
        if "EQMRPC" in text:
            return [0.0, 1.0, 0.1]
        if "otor" in text.lower():
            return [1.0, 0.0, 0.2 if "EQERMA" in text else 0.3]
        return [0.0, 0.0, 1.0]


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def filled(spark, threshold=0.75, **options):
    config = CompletionConfig(threshold=threshold)
    master, target = spark.createDataFrame(MASTER, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)
    return complete(master, target, config, "id", "id", **options)


def test_documented_example(spark):
    df = filled(spark, encoder=ExampleEncoder)
    assert df.columns == [
        "equipment_type",
        "equipment_description",
        "id",
        "equipment_type_similarity_score",
        "equipment_description_similarity_score",
    ]
    rows = by_id(df)
    assert rows[10]["equipment_type"] == "EQERMA" and rows[10]["equipment_type_similarity_score"] > 0.9
    assert rows[11]["equipment_description"] == "100A01B-EQUALISATION TANK MIXERS"
    # The score belongs to the field that was filled.
    assert rows[11]["equipment_description_similarity_score"] == 1.0
    assert rows[11]["equipment_type_similarity_score"] is None


def test_unmatched_empty_and_complete_rows_stay(spark):
    rows = by_id(filled(spark, encoder=ExampleEncoder))
    assert len(rows) == len(TARGET)
    assert tuple(rows[12])[:3] == ("VALVE", "kept as it is", 12)
    assert rows[13]["equipment_type"] is None and rows[13]["equipment_description"] is None
    assert rows[13]["equipment_type_similarity_score"] is None


def test_only_the_best_record_is_used_even_if_its_field_is_null(spark):
    master = spark.createDataFrame([(1, None, "red pump"), (2, "PUMP", "red pump x")], SCHEMA)
    target = spark.createDataFrame([(5, None, "red pump")], SCHEMA)
    row = complete(master, target, CompletionConfig(threshold=0.1), "id", "id").first()
    assert row["equipment_type"] is None and row["equipment_type_similarity_score"] is None


def test_ties_go_to_the_smallest_key(spark):
    master = spark.createDataFrame([(9, "B", "red pump"), (3, "A", "red pump"), (7, "C", "red pump")], SCHEMA)
    target = spark.createDataFrame([(5, None, "red pump")], SCHEMA)
    for limits in (BlockLimits(), BlockLimits(block_rows=1, broadcast_rows=0)):
        row = complete(master, target, CompletionConfig(threshold=0.1), "id", "id", limits=limits).first()
        assert row["equipment_type"] == "A"


def test_raising_the_threshold_never_adds_fills(spark):
    before = None
    for threshold in (0.9, 0.6, 0.3, 0.0):
        rows = filled(spark, threshold).collect()
        done = {(r["id"], f) for r in rows for f in ("equipment_type", "equipment_description") if r[f"{f}_similarity_score"] is not None}
        assert before is None or before <= done
        before = done
        for r in rows:
            original = next(t for t in TARGET if t[0] == r["id"])
            assert original[1] in (None, r["equipment_type"]) and original[2] in (None, r["equipment_description"])


def test_texts_are_compared_whole_unless_limited(spark):
    master = spark.createDataFrame([(1, "A", "x y z a a a a a a"), (2, "B", "x y z")], SCHEMA)
    target = spark.createDataFrame([(5, None, "x y z a a a a a a")], SCHEMA)
    whole = complete(master, target, CompletionConfig(threshold=0.1), "id", "id").first()
    first = complete(master, target, CompletionConfig(threshold=0.1, max_tokens=4), "id", "id").first()
    assert whole["equipment_type"] == "A"
    assert first["equipment_type_similarity_score"] < whole["equipment_type_similarity_score"]


def test_keys_are_made_where_none_is_given(spark):
    master = spark.createDataFrame([("PUMP", "red pump")], "ObjectType string, desc string")
    target = spark.createDataFrame([("red pump", 5)], "description string, n int")
    row = complete(master, target, CompletionConfig(threshold=0.5)).first()
    assert row.asDict()["equipment_type"] == "PUMP"
    assert "_target_row" not in row.asDict()


def test_scores_can_be_left_out(spark):
    master, target = spark.createDataFrame(MASTER, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)
    df = complete(master, target, CompletionConfig(include_scores=False), "id", "id")
    assert df.columns == ["equipment_type", "equipment_description", "id"]


def test_table_without_gaps_comes_back_unchanged(spark):
    master = spark.createDataFrame(MASTER, SCHEMA)
    target = spark.createDataFrame([(1, "a", "b")], SCHEMA)
    df = complete(master, target, CompletionConfig(), "id", "id")
    assert tuple(df.first())[:3] == ("a", "b", 1)
    stats = completion_stats(target, df, ["equipment_type"]).first()
    assert tuple(stats) == ("equipment_type", 0, 0, 0, "0%")


def test_invalid_tables(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    with pytest.raises(ValueError, match="empty"):
        complete(target.limit(0), target)
    with pytest.raises(ValueError, match="equipment_type"):
        complete(target.drop("equipment_type"), target)


@pytest.mark.parametrize("index_type", ["cells", "ivfflat", "hnsw"])
def test_vector_indexes_need_an_encoder_and_work_with_one(spark, index_type):
    master, target = spark.createDataFrame(MASTER, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)
    config = CompletionConfig(index_type=index_type)
    with pytest.raises(ValueError, match="encoder"):
        complete(master, target, config, "id", "id")
    rows = by_id(complete(master, target, config, "id", "id", encoder=ExampleEncoder))
    assert rows[11]["equipment_description"] == "100A01B-EQUALISATION TANK MIXERS"


def test_stats_add_up(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    fields = ["equipment_type", "equipment_description"]
    df = filled(spark, 0.5)
    for r in completion_stats(target, df, fields).collect():
        assert r["originally_missing"] == r["filled_by_pipeline"] + r["still_missing"]
    scores = spark.createDataFrame([(0.5,), (0.7,), (None,), (0.9,), (0.8,)], "my_score double")
    assert tuple(score_stats(scores).first()) == ("my_score", 0.725, 0.75, 0.5, 0.9, 4)


def test_exact_median_over_many_partitions(spark):
    rng = np.random.default_rng(5)
    odd, even = rng.integers(0, 50, 1001) / 7.0, rng.random(1000) * 1e6
    rows = [(float(a), float(b) if i < 1000 else None) for i, (a, b) in enumerate(zip(odd, [*even, 0.0]))]
    df = spark.createDataFrame(rows, "a_score double, b_score double").repartition(5)
    got = {r["column"]: (r["median_score"], r["scores_available"]) for r in score_stats(df).collect()}
    assert got == {
        "a_score": (round(float(np.median(odd)), 6), 1001),
        "b_score": (round(float(np.median(even)), 6), 1000),
    }
    rough = {r["column"]: r["median_score"] for r in score_stats(df, approximate=True).collect()}
    assert abs(rough["b_score"] - np.median(even)) < 2e4


def read_json(spark, path):
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).coalesce(1).collect()))


def test_completion_from_file_to_file(spark, tmp_path):
    (tmp_path / "master.csv").write_text(
        'ObjectType,Description,id\nPUMP,"red pump,\nlarge",0001\nNA,blue valve,0002\n', encoding="utf-8"
    )
    (tmp_path / "target.csv").write_text(
        'equip_type,desc,site\n,"red pump,\nlarge",N/A\nVALVE,,02\n,,\n', encoding="utf-8"
    )
    result = run_completion(spark, f"{tmp_path}/master.csv", f"{tmp_path}/target.csv", config=CompletionConfig(threshold=0.6))
    assert result["output_file"] == f"{tmp_path}/target_completed.csv"
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(result["output_file"])
    assert df.columns[:3] == ["equipment_type", "equipment_description", "site"]
    rows = {(r["equipment_type"], r["equipment_description"], r["site"]) for r in df.collect()}
    assert rows == {("PUMP", "red pump,\nlarge", None), ("VALVE", None, "02"), (None, None, None)}
    report = read_json(spark, result["report_file"])
    assert report["completion"]["equipment_type"]["filled_by_pipeline"] == 1
    assert report["scores"]["equipment_type_similarity_score"]["scores_available"] == 1
    assert (tmp_path / "target_backup.csv").exists()


def test_consolidation_from_files_to_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("Equipment,Created on,ObjectType\n007,2024-01-02,PUMP\n007,2024-01-02,PUMP\n")
    (raw / "b.csv").write_text('Equipment,Equipment description,Extra\n008,"a ""b"", c",x\n009,,y\n')
    (raw / "c.csv").write_text("Equipment,Extra\n")
    result = run_consolidation(spark, str(raw), f"{tmp_path}/out", "*.csv", config=ConsolidationConfig())
    df = spark.read.parquet(result["saved_files"]["parquet"])
    assert sorted(r["equipment_number"] for r in df.collect()) == ["007", "008", "009"]
    assert dict(df.dtypes)["created_on"] == "timestamp_ntz"
    assert {r["Equipment Description"] for r in df.collect()} == {'a "b", c', None}
    report = read_json(spark, result["saved_files"]["report"])
    assert report["sources"]["c"] == {"rows": 0, "rows_rejected": 0, "columns": 2}
    assert report["missing_columns"] == ["Chngd On", "Manufacturer of Asset"]
    assert report["processing_statistics"]["total"]["rows_removed"] == 1


def test_nothing_missing_leaves_the_target_as_it_is(spark):
    rows = [("1", "pump", "water pump"), ("2", "fan", "roof fan")]
    master = spark.createDataFrame(rows, "id string, equipment_type string, equipment_description string")
    done = complete(master, master, CompletionConfig(), target_key="id", master_key="id")
    assert sorted(done.columns) == sorted(master.columns)
    assert sorted(map(tuple, done.select(*master.columns).collect())) == rows
