"""Paths chosen by size give the same answers; nothing is lost with the number of batches or without a shared folder."""

import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stratalake.operators.joins import join_as_of
from stratalake.operators.metrics import aggregate_with_distinct, with_ranks
from stratalake.sources.storage import work_dir
from stratalake.streaming.files import stream_files
from stratalake.streaming.silver import stream_silver

DAY = datetime.date


@pytest.fixture
def versions(spark):
    rows = [(1, DAY(2024, 1, 1), DAY(2024, 1, 31), "a"), (1, DAY(2024, 2, 1), DAY(9999, 12, 31), "b"), (None, DAY(2024, 1, 1), DAY(9999, 12, 31), "n")]
    return spark.createDataFrame(rows, "k int, valid_from date, valid_to date, seg string")


@pytest.mark.parametrize("options", [{}, {"max_versions": 0}, {"max_versions": 0, "max_rows_per_key": 0}])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_timestamp_facts_fall_on_their_day(spark, versions, rows, options, how):
    at = datetime.datetime
    facts = [(1, at(2024, 1, 31, 10)), (1, at(2024, 2, 1, 0)), (1, at(2023, 12, 31, 23)), (2, at(2024, 1, 5)), (None, at(2024, 1, 5))]
    got = rows(join_as_of(spark.createDataFrame(facts, "k int, at timestamp_ntz"), versions, ["k"], "at", ["seg"], how=how, **options))
    found = {f: s for f, s in zip(facts, ["a", "b", None, None, None])}
    assert got == sorted(((*f, s) for f, s in found.items() if s or how == "left"), key=repr)


@pytest.mark.parametrize("most", [64, 0])
def test_overlapping_intervals_are_refused(spark, versions, most):
    over = versions.union(versions.limit(1).withColumn("seg", F.lit("x")))
    with pytest.raises(ValueError, match="overlap"):
        join_as_of(spark.createDataFrame([(1, DAY(2024, 1, 5))], "k int, at date"), over.union(over), ["k"], "at", ["seg"], max_versions=most)


@pytest.mark.parametrize("kind", ["string", "date", "int"])
def test_ranks_of_any_type(spark, rows, kind):
    made = {"string": "concat('v', id % 7)", "date": "date_add(DATE '2024-01-01', CAST(id % 7 AS INT))", "int": "IF(id = 3, -2147483648, CAST(id % 7 AS INT))"}
    df = spark.range(60).selectExpr("id % 2 AS g", f"IF(id % 11 = 0, NULL, {made[kind]}) AS v", "id")
    plain = with_ranks(df, ["g"], "v", "r", "d", None)
    assert rows(plain, "id", "r", "d") == rows(with_ranks(df, ["g"], "v", "r", "d", 0), "id", "r", "d")


def test_counts_of_more_batches_than_a_query_remembers(spark, tmp_path):
    for i in range(105):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i:03d}.json").write_text('{"v": -1}\n')
    stream = stream_files(spark, str(tmp_path / "in"), "json", "v int", max_files=1)
    _, counts = stream_silver(stream, {"v": "v"}, str(tmp_path / "out"), str(tmp_path / "check"), warn={"positive": "v > 0"})
    assert counts == {"positive": 105}


def test_measures_and_distinct_counts_read_once(spark, plan, rows, tmp_path):
    spark.range(40).selectExpr("id % 3 AS g", "id % 5 AS a", "id AS v").write.parquet(str(tmp_path / "t"))
    kpi = aggregate_with_distinct(spark.read.parquet(str(tmp_path / "t")), ["g"], [F.sum("v").alias("s")], {"n": "a"})
    assert rows(kpi) == [(0, 273, 5), (1, 247, 5), (2, 260, 5)]
    text = plan(kpi.filter("g = 1"))
    assert text[text.rfind("Initial Plan") :].count("FileScan") == 1 and "EqualTo(g,1)" in text


def test_rows_are_shuffled_once_for_all_distinct_counts(spark, plan, rows):
    made = "IF(id % 4 = 0, NULL, id % 3) AS g", "IF(id % 5 = 0, NULL, id % 7) AS a", "CAST(id % 2 AS STRING) AS b", "id AS v"
    df = spark.range(60).union(spark.range(20)).selectExpr(*made)

    def kpi(most, rows=df):
        return aggregate_with_distinct(rows, ["g"], [F.sum("v").alias("s")], {"n": "a", "m": "b"}, most)

    want = rows(df.groupBy("g").agg(F.sum("v"), F.countDistinct("a"), F.countDistinct("b")))
    text = plan(kpi(None))
    assert "Expand" not in text and text[text.rfind("Initial Plan") :].count("Exchange") == 1
    assert rows(kpi(None)) == rows(kpi(100)) == rows(kpi(1)) == want
    assert "Expand" in plan(kpi(1))  # a group that no task should hold
    signed = df.withColumn("a", F.when(F.col("a") == 1, -0.0).when(F.col("a") == 2, 0.0).when(F.col("a") < 5, float("nan")))
    assert rows(kpi(None, signed), "n") == [(2,)] * 4


def test_a_cluster_without_a_shared_folder_is_refused():
    far = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(far, "x")
