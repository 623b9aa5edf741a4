"""Stored tables: partitions replaced in repeatable steps, buckets that split, snapshots, open histories, guarded writes."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from stratalake.operators import history, joins
from stratalake.operators.feed import change_feed, initial_feed
from stratalake.operators.merge import Delete, Insert, Update, merge_partitions, touched_partitions
from stratalake.plans.propagation import current_state, propagate, save_snapshots, state_at, write_feed
from stratalake.sources import swap
from stratalake.sources.buckets import Buckets, open_buckets
from stratalake.sources.storage import remove_folder, saved_bucket_counts
from stratalake.sources.tables import write_table
from stratalake.streaming import cdc

CLAUSES = {
    "matched": [Delete("s.gone"), Update({"v": "s.v"})],
    "not_matched": [Insert({"id": "s.id", "p": "s.p", "v": "s.v"}, when="NOT s.gone")],
    "not_matched_by_source": [Delete("t.p = 'x y' AND t.v > 150"), Update({"v": "0"}, when="t.p = 'q=1'")],
}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    names = "element_at(array('a', 'x y', 'q=1', 'é%'), int(id % 4) + 1)"
    spark.range(40).selectExpr("id", f"{names} AS p", "id * 10 AS v").write.partitionBy("p").parquet(path)
    source = spark.createDataFrame(
        [(i, "a", -1, True) for i in range(0, 40, 4)] + [(3, "é%", -3, False), (99, "new/1", 5, False), (98, "a", 5, True)],
        "id bigint, p string, v bigint, gone boolean",
    )
    return path, source


def expected():
    names = ["a", "x y", "q=1", "é%"]
    found = [(i, names[i % 4], i * 10) for i in range(40) if names[i % 4] != "a"]
    found = [(i, p, 0 if p == "q=1" else -3 if i == 3 else v) for i, p, v in found if not (p == "x y" and v > 150)]
    return sorted([*found, (99, "new/1", 5)], key=repr)


def folders(path):
    import pathlib

    return sorted(f.name for f in pathlib.Path(path).iterdir() if f.is_dir())


def test_merge_deletes_and_by_source_clauses(spark, table, rows):
    path, source = table
    for _ in range(2):  # again, the same table
        merge_partitions(spark, path, source, ["id", "p"], ["p"], **CLAUSES)
        assert rows(spark.read.parquet(path), "id", "p", "v") == expected()
        assert len(folders(path)) == 4 and not any(f == "p=a" for f in folders(path))
    assert not [f for f in folders(path + "/..") if f.endswith("-staged")]


@pytest.mark.parametrize("step", (0, 2, 4))
def test_a_killed_merge_is_finished_by_the_next(spark, table, rows, monkeypatch, step):
    path, source = table
    original, seen = swap.swap_folder, []

    def dies(*args):
        seen.append(args)
        if len(seen) > step:
            raise KeyboardInterrupt
        original(*args)

    monkeypatch.setattr(swap, "swap_folder", dies)
    try:
        merge_partitions(spark, path, source, ["id", "p"], ["p"], **CLAUSES)
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(swap, "swap_folder", original)
    merge_partitions(spark, path, source, ["id", "p"], ["p"], **CLAUSES)
    assert rows(spark.read.parquet(path), "id", "p", "v") == expected()


def test_killed_between_delete_and_move(spark, table, rows, monkeypatch):
    path, source = table
    original = swap._move

    def dies(session, source, target):
        if "manifest" not in source:
            raise KeyboardInterrupt
        original(session, source, target)

    monkeypatch.setattr(swap, "_move", dies)
    with pytest.raises(KeyboardInterrupt):
        merge_partitions(spark, path, source, ["id", "p"], ["p"], **CLAUSES)
    monkeypatch.setattr(swap, "_move", original)
    assert swap.finish_replacement(spark, path) and not swap.finish_replacement(spark, path)
    assert rows(spark.read.parquet(path), "id", "p", "v") == expected()


def test_merge_without_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "small")
    spark.range(6).selectExpr("id", "1 AS active").write.parquet(path)
    source = spark.range(4, 9)
    clauses = {"not_matched": [Insert({"id": "s.id", "active": "1"})], "not_matched_by_source": [Update({"active": "0"}), ]}
    merge_partitions(spark, path, source, ["id"], **clauses)
    assert rows(spark.read.parquet(path)) == [(i, int(i > 3)) for i in range(9)]


def test_only_touched_partitions_are_scanned(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(40).selectExpr("id", "id % 4 AS p", "id AS v").write.partitionBy("p").parquet(path)
    target, source = spark.read.parquet(path), spark.createDataFrame([(1, 1)], "id bigint, p bigint")
    text = plan(touched_partitions(target, source, ["p"]))
    assert re.search(r"PartitionFilters: \[.*p#\d+L? = 1\)", text)
    text = plan(touched_partitions(target, source, ["p"], [Delete("t.v = 6")]))
    assert re.search(r"PartitionFilters: \[p#\d+L? IN \(", text) and touched_partitions(target, source, ["p"], [Delete("t.v = 6")]).count() == 20


def test_buckets_split_in_turn(spark):
    keys = spark.range(2000)
    for count in range(3, 30):
        now, after = Buckets(3, count), Buckets(3, count + 1)
        found = keys.select(now.of(["id"]).alias("a"), after.of(["id"]).alias("b")).distinct().collect()
        assert {b for _, b in found} == set(range(count + 1))
        assert {a for a, b in found if b == count} == {after.origin(count, count)} and all(a == b for a, b in found if b < count)


def test_scd1_table_grows_and_ignores_late_events(spark, tmp_path, rows):
    target, events = str(tmp_path / "target"), []
    for batch in range(8):
        new = [(k, batch * 10 + k % 7, "D" if (k + batch) % 11 == 0 else "U", f"{batch}-{k}") for k in range(batch * 40, batch * 40 + 160)]
        events += new
        df = spark.createDataFrame(new, "k int, seq int, op string, v string")
        tagged = df.withColumns({cdc.SEQUENCE: F.col("seq"), cdc.DELETED: F.col("op") == "D"})
        cdc.upsert_newest(tagged, target, ["k"], buckets=4, rows_per_bucket=7)
    assert saved_bucket_counts(spark, target)[0] == 4 and saved_bucket_counts(spark, target)[1] >= 50
    whole = spark.createDataFrame(events, "k int, seq int, op string, v string")
    want = rows(history.scd1(whole, ["k"], "seq", "op = 'D'"), "k", "seq", "v")
    assert rows(cdc.read_scd1_stored(spark, target), "k", "seq", "v") == want
    stored_rows = spark.read.parquet(target)
    placed = stored_rows.select("_bucket", open_buckets(spark, target).of(["k"]).alias("b"))
    assert placed.filter("_bucket <> b").isEmpty() and stored_rows.groupBy("k").count().filter("count > 1").isEmpty()
    # Old events and replays change nothing, and reach their own buckets only.
    before = {f: sorted(p.name for p in (tmp_path / "target" / f).glob("*.parquet")) for f in folders(target)}
    late = spark.createDataFrame([(5, -1, "U", "late")], "k int, seq int, op string, v string")
    touched = cdc.upsert_newest(late.withColumns({cdc.SEQUENCE: F.col("seq"), cdc.DELETED: F.lit(False)}), target, ["k"])
    after = {f: sorted(p.name for p in (tmp_path / "target" / f).glob("*.parquet")) for f in folders(target)}
    assert [f for f in before if before[f] != after[f]] == [f"_bucket={b}" for b in touched] and len(touched) == 1
    assert rows(cdc.read_scd1_stored(spark, target), "k", "seq", "v") == want


def test_scd1_stream_equals_the_log(spark, tmp_path, rows):
    schema = "k int, seq int, op string"
    for i, part in enumerate([[(1, 1, "U"), (2, 5, "U")], [(1, 3, "D"), (3, 1, "U")], [(1, 2, "U"), (2, 4, "D"), (4, 1, "D")]]):
        spark.createDataFrame(part, schema).coalesce(1).write.json(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*")
    target = str(tmp_path / "target")
    for attempt in ("c1", "c2"):  # the second reads all again
        cdc.stream_scd1_stored(stream, ["k"], "seq", "op = 'D'", target, str(tmp_path / attempt), buckets=2)
        assert rows(cdc.read_scd1_stored(spark, target), "k", "seq") == [(2, 5), (3, 1)]


def test_buckets_are_not_guessed(spark, tmp_path):
    spark.range(5).selectExpr("id", "id % 4 AS _bucket").write.partitionBy("_bucket").parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no bucket count"):
        open_buckets(spark, str(tmp_path / "t"))
    assert open_buckets(spark, str(tmp_path / "t"), 4) == Buckets(4, 4)


def test_propagated_table_grows(spark, tmp_path, rows):
    target, progress, feed = (str(tmp_path / n) for n in ("t", "p", "f"))
    states = [spark.range(v * 30, 200 + v * 50).selectExpr("id", f"id * {v} AS v") for v in range(4)]
    write_feed(initial_feed(states[0], 0, "2024-01-01"), feed)
    for v in range(1, 4):
        write_feed(change_feed(states[v - 1], states[v], ["id"], v, "2024-01-01"), feed)
    for v in range(4):
        changes = spark.read.parquet(feed).filter(F.col("_commit_version") <= v)
        propagate(spark, changes, target, progress, "p", ["id"], buckets=4, rows_per_bucket=6)
        assert rows(current_state(spark, target), "id", "v") == rows(states[v])
    assert saved_bucket_counts(spark, target) >= (4, 40)


def test_state_from_snapshots(spark, tmp_path, rows, plan):
    feed, snapshots = str(tmp_path / "feed"), str(tmp_path / "snapshots")
    states = [spark.range(v, 20 + 2 * v).selectExpr("id", f"id % (2 + {v}) AS v") for v in range(6)]
    write_feed(initial_feed(states[0], 0, "2024-01-01"), feed)
    for v in range(1, 6):
        write_feed(change_feed(states[v - 1], states[v], ["id"], v, "2024-01-01"), feed)
    assert rows(state_at(spark, feed, snapshots, 3, ["id"])) == rows(states[3])
    assert save_snapshots(spark, feed, snapshots, ["id"], every=2) == [0, 2, 4]
    assert save_snapshots(spark, feed, snapshots, ["id"], every=2) == []
    for v in range(6):
        assert rows(state_at(spark, feed, snapshots, v, ["id"]), "id", "v") == rows(states[v])
    for version in (0, 1, 2):
        remove_folder(spark, f"{feed}/_commit_version={version}")
    remove_folder(spark, f"{snapshots}/_version=0")
    assert rows(state_at(spark, feed, snapshots, 3, ["id"]), "id", "v") == rows(states[3])
    text = plan(state_at(spark, feed, snapshots, 4, ["id"]))
    assert "_version" in text.split("PartitionFilters: [")[1][:60] and "_commit_version" not in text


def day(n):
    return datetime.date(2024, 1, n)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("options", [{}, {"max_versions": 2}, {"max_versions": 0}, {"max_versions": 2, "max_rows_per_key": 0}])
def test_open_and_exclusive_intervals(spark, rows, monkeypatch, how, options):
    dim = [(1, day(1), day(5), "a"), (1, day(5), day(9), "b"), (1, day(9), None, "c"), (2, day(3), day(4), "x"), (3, day(2), None, "o"), (3, None, None, "bad"), (None, day(1), None, "n")]
    fact = [(i, k, day(d)) for i, (k, d) in enumerate([(1, 1), (1, 4), (1, 5), (1, 8), (1, 9), (1, 30), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2), (None, 3)])]
    fact.append((99, 1, None))

    def state(k, at):
        found = [v for key, a, b, v in dim if k is not None and key == k and a and at and a <= at and (b is None or at < b)]
        return found[0] if found else None

    want = [(i, k, state(k, at)) for i, k, at in fact]
    want = sorted((r for r in want if how == "left" or r[2]), key=repr)
    carried = []
    original = joins._carry_version

    def watched(facts, *args, **named):
        carried.extend(r["k"] for r in facts.select("k").distinct().collect())
        return original(facts, *args, **named)

    monkeypatch.setattr(joins, "_carry_version", watched)
    f = spark.createDataFrame(fact, "i int, k int, at date")
    d = spark.createDataFrame(dim, "k int, vf date, vt date, v string")
    got = joins.join_as_of(f, d, ["k"], "at", ["v"], "vf", "vt", how, end_inclusive=False, **options)
    assert rows(got, "i", "k", "v") == want
    # Only keys above the bound are ordered.
    assert sorted(carried) == {None: [], 2: [1], 0: [1, 2, 3]}[options.get("max_versions")]
    with pytest.raises(ValueError, match="overlap"):
        joins.join_as_of(f, d.union(spark.createDataFrame([(3, day(8), None, "z")], d.schema)), ["k"], "at", ["v"], "vf", "vt", end_inclusive=False)


def test_broadcast_by_measured_bytes(spark, plan):
    left, right = spark.range(1000).withColumn("x", F.lit("l")), spark.range(50).withColumn("y", F.repeat(F.lit("y"), 100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.join_broadcast(left, right, "id"))
        assert "BroadcastHashJoin" not in plan(joins.join_broadcast(left, right, "id", max_bytes=5_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="cannot broadcast"):
        joins.join_broadcast(left, right, "id", "right")


def test_feed_refuses_repeated_keys(spark):
    one, twice = spark.range(3).withColumn("v", F.lit(1)), spark.range(3).union(spark.range(1)).withColumn("v", F.lit(2))
    for before, after in ((one, twice), (twice, one)):
        with pytest.raises(Exception, match="not unique"):
            change_feed(before, after, ["id"], 1).collect()


def test_overwrite_keeps_columns_and_types(spark):
    name = "kept_schema"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_table(spark.sql("SELECT 1 AS a, 'x' AS b"), name)
    for bad in ("SELECT 'z' AS a", "SELECT 1 AS a", "SELECT 'y' AS b, 2L AS a", "SELECT 1 AS a, 'x' AS b, 2 AS c"):
        with pytest.raises(ValueError):
            write_table(spark.sql(bad), name)
    assert spark.table(name).dtypes == [("a", "int"), ("b", "string")] and spark.table(name).count() == 1
    write_table(spark.sql("SELECT 'y' AS b, 2 AS a"), name)
    assert [r["a"] for r in spark.table(name).collect()] == [2]
    write_table(spark.sql("SELECT 'z' AS a"), name, replace_schema=True)
    assert spark.table(name).dtypes == [("a", "string")]
    spark.sql(f"DROP TABLE {name}")


def test_many_buckets_are_written_by_many_tasks_and_listed_once_to_grow(spark, tmp_path, monkeypatch):
    from stratalake.sources import buckets, swap

    asked, listed = [], []
    replace, read = swap.replace_partitions, buckets.read_buckets
    monkeypatch.setattr(buckets, "replace_partitions", lambda *a, **k: asked.append(k.get("tasks")) or replace(*a, **k))
    monkeypatch.setattr(buckets, "read_buckets", lambda *a: listed.append(a) or read(*a))
    path = str(tmp_path / "t")
    begun = buckets.open_buckets(spark, path, 2)
    buckets.write_buckets(spark.range(400).withColumn(buckets.BUCKET, begun.of(["id"])), path, [0, 1])
    grown = buckets.grow(spark, path, ["id"], [0, 1], 10)
    assert grown.count == 40 and len(listed) == 1
    assert asked == [None, 4]  # the two large folders may take several tasks; shuffles of the tests have four
    held = read(spark, path)
    assert sorted(r["id"] for r in held.collect()) == list(range(400))
    assert held.filter(held[buckets.BUCKET] != grown.of(["id"])).isEmpty()
