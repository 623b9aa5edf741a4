"""Histories stay histories; stored tables know their buckets and lose emptied ones; merges prune."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.history import scd2_apply, scd2_init
from stratalake.operators.merge import Insert, Update, merge_partitions
from stratalake.sources.storage import fixed_buckets
from stratalake.streaming.cdc import refresh_scd2, stream_scd2

DAY = datetime.date


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k int, city string, valid_from date")


def test_same_day_correction_keeps_one_version(spark, rows):
    dim = scd2_init(_batch(spark, [(1, "a", DAY(2024, 1, 1)), (2, "b", DAY(2024, 1, 1))]), ["k"], "valid_from")
    dim = scd2_apply(dim, _batch(spark, [(1, "c", DAY(2024, 2, 1))]), ["k"], ["city"])
    dim = scd2_apply(dim, _batch(spark, [(1, "d", DAY(2024, 2, 1))]), ["k"], ["city"])
    assert rows(dim, "k", "city", "valid_from", "valid_to") == [
        (1, "a", DAY(2024, 1, 1), DAY(2024, 1, 31)),
        (1, "d", DAY(2024, 2, 1), DAY(9999, 12, 31)),
        (2, "b", DAY(2024, 1, 1), DAY(9999, 12, 31)),
    ]
    assert dim.select("dim_sk").distinct().count() == 3
    late = scd2_apply(dim, _batch(spark, [(1, "e", DAY(2024, 1, 20))]), ["k"], ["city"])
    with pytest.raises(Exception, match="older than the current version"):
        late.collect()


def test_emptied_bucket_goes(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("log", "target", "progress", "check", "in")}

    def events(name, seq, op, tie):
        spark.createDataFrame([(7, seq, op, tie)], "k int, seq int, op string, tie int").coalesce(1).write.json(f"{paths['in']}/{name}")
        stream = spark.readStream.schema("k int, seq int, op string, tie int").json(f"{paths['in']}/*")
        stream_scd2(stream, ["k"], "seq", "op = 'D'", paths["log"], paths["check"], buckets=4)
        refresh_scd2(spark, paths["log"], paths["target"], paths["progress"], ["k"], tiebreak=["tie"])

    events("one", 5, "I", 1)
    assert spark.read.parquet(paths["target"]).count() == 1
    events("two", 5, "D", 2)
    assert not list((tmp_path / "target").glob("_bucket=*"))
    with pytest.raises(ValueError, match="4 buckets"):
        fixed_buckets(spark, paths["log"], 8)


def test_merge_reads_touched_partitions_only(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(40).selectExpr("id", "id % 4 AS p", "id * 10 AS v").write.partitionBy("p").parquet(path)
    files = {p: sorted(f.name for f in (tmp_path / "t" / f"p={p}").glob("*.parquet")) for p in range(4)}
    source = spark.createDataFrame([(1, 1, -1), (100, 1, -2)], "id bigint, p bigint, v bigint")
    merge_partitions(spark, path, source, ["id", "p"], ["p"], [Update({"v": "s.v"})], [Insert({"id": "s.id", "p": "s.p", "v": "s.v"})])
    after = {p: sorted(f.name for f in (tmp_path / "t" / f"p={p}").glob("*.parquet")) for p in range(4)}
    assert [p for p in range(4) if files[p] != after[p]] == [1]
    assert rows(spark.read.parquet(path).filter(F.col("v") < 0), "id", "v") == [(1, -1), (100, -2)]
