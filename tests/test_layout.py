"""File layout jobs, and the physical plans the operators promise."""

import pytest
from pyspark.sql import functions as F

from stratalake.catalogue import table
from stratalake.operators.joins import join_sort_merge
from stratalake.operators.layout import compact, compact_in_place, files_touched, folder_files, table_detail, zorder
from stratalake.operators.merge import Insert, Update, merge
from stratalake.operators.metrics import top_n_per_group
from stratalake.operators.quality import dedup_latest
from stratalake.plans.reports import in_month

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lines(spark):
    return table(spark, SF_DIR, "lineitem")


def test_compaction(spark, lines, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    lines.repartition(30).write.parquet(small)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    compact(spark, small, packed)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    detail = [table_detail(spark.read.parquet(p)).first() for p in (small, packed)]
    assert (detail[0]["num_files"], detail[1]["num_files"]) == (30, 1) and detail[1]["size_in_bytes"] > 0
    assert spark.read.parquet(packed).exceptAll(lines).isEmpty()


def test_partitioned_compaction(spark, lines, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    lines.repartition(10).write.partitionBy("l_returnflag").parquet(small)
    compact(spark, small, packed, partition_by=["l_returnflag"])
    assert table_detail(spark.read.parquet(small)).first()["num_files"] == 30
    assert table_detail(spark.read.parquet(packed)).first()["num_files"] == 3


def test_compaction_in_place_takes_crowded_partitions_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "01").when(F.col("id") % 3 == 1, "a b:c").alias("p"))
    df.repartition(5).write.partitionBy("p").parquet(path)
    spark.range(600, 700).select("id", F.lit("one").alias("p")).coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before = rows(spark.read.parquet(path), "id", "p")
    single = [r["path"] for r in spark.read.format("binaryFile").load(f"{path}/p=one").select("path").collect()]
    rewritten = compact_in_place(spark, path, ["p"])
    assert len(rewritten) == 3 and "p=01" in rewritten and "p=one" not in rewritten
    assert rows(spark.read.parquet(path), "id", "p") == before and ("01" in {r[1] for r in before})
    assert {r["files"] for r in folder_files(spark, path, 1).collect()} == {1}
    assert [r["path"] for r in spark.read.format("binaryFile").load(f"{path}/p=one").select("path").collect()] == single
    assert compact_in_place(spark, path, ["p"]) == []


def test_compaction_in_place_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(7).write.parquet(path)
    assert compact_in_place(spark, path) == [""]
    assert folder_files(spark, path, 0).first()["files"] == 1 and spark.read.parquet(path).count() == 100


def test_killed_compaction_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    from stratalake.sources import swap

    path = str(tmp_path / "t")
    spark.range(90).select("id", (F.col("id") % 3).alias("p")).repartition(4).write.partitionBy("p").parquet(path)
    plain, calls = swap.swap_folder, []

    def killed(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        plain(*args)

    monkeypatch.setattr(swap, "swap_folder", killed)
    with pytest.raises(KeyboardInterrupt):
        compact_in_place(spark, path, ["p"])
    monkeypatch.undo()
    assert compact_in_place(spark, path, ["p"]) == []  # finished first, and then nothing is crowded
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(90))
    assert [r["files"] for r in folder_files(spark, path, 1).collect()] == [1, 1, 1]


def test_more_files_get_finer_marks(spark, monkeypatch):
    from stratalake.operators import layout

    asked = []
    monkeypatch.setattr(layout, "_cut_points", lambda df, columns, pieces, n: asked.append((pieces, n)) or {c: [] for c in columns})
    for files in (8, 4_096, 10**9):
        zorder(spark.range(10).select("id", F.col("id").alias("n")), ["id", "n"], files)
    assert asked == [(16, 4_000), (256, 16_384), (1_024, 65_536)]


def test_clustering_narrows_both_columns(spark, lines, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "z")
    lines.repartition(16).write.parquet(plain)
    zorder(spark.read.parquet(plain), ["l_partkey", "l_quantity"], files=16).write.parquet(clustered)
    for column, value in (("l_partkey", 777), ("l_quantity", 12.0)):
        assert files_touched(spark.read.parquet(plain), column, value).first()["touched"] == 16
        assert files_touched(spark.read.parquet(clustered), column, value).first()["touched"] <= 9
    assert spark.read.parquet(clustered).exceptAll(lines).isEmpty()


def test_large_files_are_put_together_from_sorted_runs(spark, lines, tmp_path):
    plain = str(tmp_path / "plain")
    lines.repartition(16).write.parquet(plain)
    source = spark.read.parquet(plain)
    most = -(-source.count() // 64)
    made = {}
    for name, options in {"whole": {}, "runs": {"max_rows_per_sort": most}}.items():
        clustered = zorder(source, ["l_partkey", "l_quantity"], files=16, **options)
        if options:  # no task sorts more than a run
            text = clustered._jdf.queryExecution().optimizedPlan().toString()
            assert "ASC NULLS FIRST], 64" in text[text.rfind("RepartitionByExpression") :]
        clustered.write.parquet(str(tmp_path / name))
        made[name] = spark.read.parquet(str(tmp_path / name))
        assert made[name].exceptAll(source).isEmpty() and source.exceptAll(made[name]).isEmpty()
    for column, value in (("l_partkey", 777), ("l_quantity", 12.0)):
        whole, runs = (files_touched(made[x], column, value).first() for x in ("whole", "runs"))
        assert runs["files"] == whole["files"] == 16 and runs["touched"] <= 9


def test_clustering_spreads_copies_and_takes_text(spark, tmp_path):
    same = spark.range(8_000).select(F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")).alias("s"), F.lit(1).alias("n"))
    path = str(tmp_path / "src")
    same.write.parquet(path)
    sizes = zorder(spark.read.parquet(path), ["s", "n"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2_000


def test_sort_merge_by_request(spark, lines, plan):
    part = table(spark, SF_DIR, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    text = plan(join_sort_merge(lines, part, "l_partkey"))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_month_is_pushed_to_the_scan(spark):
    orders = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderdate")
    text = in_month(orders, "o_orderdate", "1996-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "o_totalprice" not in text


@pytest.mark.parametrize("make", [
    lambda df: dedup_latest(df, ["l_returnflag"], "l_shipdate"),
    lambda df: top_n_per_group(df, ["l_returnflag"], "l_extendedprice", 3),
])
def test_row_limits_per_key_apply_before_the_shuffle(lines, make):
    text = make(lines)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_small_merge_does_not_shuffle_the_target(spark, lines, plan):
    source = spark.createDataFrame([(1, 0.5), (-1, 0.1)], "l_orderkey BIGINT, l_discount DOUBLE")
    target = lines.select("l_orderkey", "l_discount")
    text = plan(merge(target, source, ["l_orderkey"], [Update({"l_discount": "s.l_discount"})], [Insert()]))
    final = text.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final
    assert final.count("BroadcastHashJoin") >= 2


def test_withcolumns_is_one_projection(lines):
    chained = lines.withColumn("a", F.col("l_tax") * 2).withColumn("b", F.col("l_tax") + 1)
    at_once = lines.withColumns({"a": F.col("l_tax") * 2, "b": F.col("l_tax") + 1})
    plans = [d._jdf.queryExecution().optimizedPlan().toString().count("Project") for d in (chained, at_once)]
    assert plans == [1, 1]


def test_aqe_joins_small_partitions(lines):
    counts = lines.groupBy("l_returnflag").count()
    assert counts.select(F.spark_partition_id().alias("p")).distinct().count() <= 3


def test_large_merge_splits_a_hot_key(spark):
    """Beyond broadcast size the target's join is a sort-merge join that AQE splits on the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        k = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint")
        target = spark.range(0, 400_000, 1, 8).select(k.alias("k"), F.hash("id").alias("v"))
        source = spark.range(0, 400_000, 2).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        merged = merge(target, source, ["k"], matched=[Update({"v": "s.v"})], source_unique=True)
        assert merged.filter("k = 0 AND v = 1").count() > 130_000
        merged.collect()
        assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
