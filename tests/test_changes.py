"""Upsert semantics, and properties of feeds and histories on random data."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import feed, history
from stratalake.operators.joins import join_as_of
from stratalake.operators.merge import Delete, Insert, Update, insert_rows, merge, update_where
from stratalake.operators.metrics import with_previous, with_ranks, with_running_total
from stratalake.operators.ordering import balanced_buckets
from stratalake.operators.quality import dedup_latest, split, validate

few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def frame(spark):
    return lambda data, schema="k INT, v STRING": spark.createDataFrame(data, schema)


def test_first_clause_that_applies_wins(frame, rows):
    target = frame([(1, "a"), (2, "b"), (3, "c"), (None, "n")])
    source = frame([(1, "del"), (2, "B"), (4, "D"), (5, "del"), (None, "N")])
    got = merge(
        target,
        source,
        ["k"],
        matched=[Delete("s.v = 'del'"), Update(when="s.v <> t.v"), Update({"v": F.lit("never")})],
        not_matched=[Insert(when="s.v <> 'del'")],
        not_matched_by_source=[Update({"v": "concat(t.v, '!')"}, when="t.k = 3")],
    )
    assert rows(got) == sorted([(2, "B"), (3, "c!"), (4, "D"), (None, "n"), (None, "N")], key=repr)


def test_ambiguous_match_fails_even_when_only_counted(frame):
    target, source = frame([(1, "a")]), frame([(1, "x"), (1, "y")])
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source, ["k"], matched=[Update()]).count()


def test_unmatched_repeats_are_all_inserted(frame, rows):
    got = merge(frame([(1, "a")]), frame([(2, "x"), (2, "y")]), ["k"], matched=[Update()], not_matched=[Insert()])
    assert rows(got) == [(1, "a"), (2, "x"), (2, "y")]


def test_null_safe_keys_and_insert_columns(frame, rows):
    target, source = frame([(None, "n")]), frame([(None, "N"), (7, "s")])
    assert rows(merge(target, source, ["k"], [Update()], [Insert()], null_safe=True)) == [(7, "s"), (None, "N")]
    got = merge(frame([(1, "a")]), frame([(2, "b")]), ["k"], not_matched=[Insert({"k": "s.k"})])
    assert rows(got) == [(1, "a"), (2, None)]


def test_update_and_insert_rows(frame, rows):
    df = frame([(1, "a"), (2, None)])
    assert rows(update_where(df, "v = 'a'", {"k": "k + 10", "v": F.lit("z")})) == [(11, "z"), (2, None)]
    assert rows(insert_rows(df, frame([(3,)], "k INT"))) == [(1, "a"), (2, None), (3, None)]


state = st.dictionaries(st.integers(0, 6), st.sampled_from(["a", "b", None]), max_size=6)


@few
@given(before=state, after=state)
def test_applying_a_feed_gives_the_later_state(frame, rows, before, after):
    b, a = frame(list(before.items())), frame(list(after.items()))
    changes = feed.change_feed(b, a, ["k"], version=1)
    assert rows(feed.apply_feed(b, changes, ["k"])) == rows(a)
    again = feed.apply_feed(feed.apply_feed(b, changes, ["k"]), changes, ["k"])
    assert rows(again) == rows(a)
    assert rows(feed.as_of(feed.initial_feed(b).unionByName(changes), 1, ["k"])) == rows(a)


@few
@given(target=state, source=state)
def test_merging_twice_is_merging_once(frame, rows, target, source):
    t, s = frame(list(target.items())), frame(list(source.items()))

    def upsert(df):
        return merge(df, s, ["k"], matched=[Update()], not_matched=[Insert()])

    assert rows(upsert(upsert(t))) == rows(upsert(t))


def test_a_row_and_its_delete_in_one_commit(frame, rows):
    schema = "k INT, v STRING, _change_type STRING, _commit_version BIGINT"
    changes = frame([(1, "old", "delete", 3), (1, "new", "insert", 3), (2, "x", "update_postimage", 2), (2, "x", "delete", 4)], schema)
    assert rows(feed.collapse(changes, ["k"]), "k", "_change_type") == [(1, "insert"), (2, "delete")]


events = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 8), st.sampled_from(["I", "U", "D"])), min_size=1, max_size=12
)
CDC = dict(keys=["k"], sequence_by="ts", delete_when="op = 'D'", except_columns=["ts", "id", "op"], tiebreak=["id"])


@few
@given(data=events, seed=st.integers(0, 99))
def test_histories_do_not_depend_on_arrival_order(frame, rows, data, seed):
    numbered = [(k, ts, op, i, f"v{i}") for i, (k, ts, op) in enumerate(data)]
    shuffled = random.Random(seed).sample(numbered, len(numbered))
    schema = "k INT, ts INT, op STRING, id INT, v STRING"
    one = history.scd2(frame(numbered, schema), **CDC)
    two = history.scd2(frame(shuffled + shuffled[:3], schema), **CDC)  # some delivered twice
    assert rows(one) == rows(two)
    assert rows(history.scd1(frame(shuffled, schema), **CDC)) == rows(history.scd2_current(one), "k", "v")
    by_key = {}
    for r in one.collect():
        by_key.setdefault(r["k"], []).append((r["__START_AT"], r["__END_AT"]))
    for spans in by_key.values():
        spans.sort()
        assert all(end is not None and end <= start for (_, end), (start, _) in zip(spans, spans[1:]))


@few
@given(data=events)
def test_split_is_a_partition(frame, data):
    df = frame([(k, op) for k, _, op in data])
    valid, quarantine = split(validate(df, [("zero", "k = 0"), ("deleted", "v = 'D'")]))
    assert valid.count() + quarantine.count() == df.count()
    reasons = {(r["k"], r["v"]): r["rejection_reason"] for r in quarantine.collect()}
    assert all(reason == ("zero" if k == 0 else "deleted") for (k, _), reason in reasons.items())


# --- one key holds a third of all rows -------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, 10,000 of them with key 0; a thousand exact copies among these."""
    base = spark.range(29_000).select(
        F.when(F.col("id") < 9_000, 0).otherwise(F.col("id") % 500).cast("int").alias("k"),
        (F.hash("id") % 5_000).alias("ts"),
        F.col("id").alias("id"),
        F.when(F.hash("id", F.lit(1)) % 11 == 0, "D").otherwise("U").alias("op"),
        (F.hash("id", F.lit(2)) % 1_000).alias("v"),
    )
    return base.unionByName(spark.range(1_000).select(
        F.lit(0).alias("k"), F.lit(77).alias("ts"), F.lit(99_999).cast("bigint").alias("id"), F.lit("U").alias("op"), F.lit(5).alias("v")))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_history_of_a_hot_key(skewed):
    args = dict(CDC, except_columns=["op"])
    assert same(history.scd2(skewed, **args, max_rows_per_key=2_000), history.scd2(skewed, **args, max_rows_per_key=None))


def test_hot_key_is_spread_over_tasks(skewed):
    from stratalake.operators.ordering import range_chunks

    chunks = range_chunks(skewed, ["k"], ["ts", "id"], partitions=12)
    sizes = [r["count"] for r in chunks.groupBy("_chunk").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * skewed.count() / 12
    assert chunks.filter("k = 0").select("_chunk").distinct().count() >= 4


def test_ranks_and_previous_of_a_hot_group(skewed):
    plain = with_ranks(skewed, ["k"], "v", "r", "d", max_rows_per_group=None)
    assert same(with_ranks(skewed, ["k"], "v", "r", "d", max_rows_per_group=1_000), plain)
    one_each = skewed.select("k", "ts").distinct()
    before = with_previous(one_each, ["k"], "ts", "ts", "p", max_rows_per_group=None)
    assert same(with_previous(one_each, ["k"], "ts", "ts", "p", max_rows_per_group=1_000), before)


def test_only_hot_keys_are_cut_into_chunks(skewed, monkeypatch):
    from stratalake.operators import metrics, ordering

    hottest = skewed.groupBy("k").count().orderBy(F.desc("count")).first()
    seen, plain = [], ordering.range_chunks

    def chunks(df, keys, *args):
        seen.append({r["k"] for r in df.select("k").distinct().collect()})
        return plain(df, keys, *args)

    for module in (metrics, ordering):
        monkeypatch.setattr(module, "range_chunks", chunks)
    with_ranks(skewed, ["k"], "v", "r", "d", max_rows_per_group=hottest["count"] - 1)
    with_previous(skewed, ["k"], ["ts", "id"], "v", "before", hottest["count"] - 1)
    assert seen == [{hottest["k"]}, {hottest["k"]}]


@pytest.mark.parametrize("kind", ["bigint", "decimal(10,2)", "double"])
def test_running_total_of_a_long_group(spark, rows, kind):
    k = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5)
    value = F.when(F.col("id") % 7 > 0, F.col("id") % 100)
    df = spark.range(4_000).select("id", k.alias("k"), (F.col("id") % 1_500).alias("at"), value.cast(kind).alias("x"))
    first = df.filter("id >= 5").unionByName(df.filter("id < 5").withColumn("x", F.lit(None).cast(kind)))
    plain = with_running_total(first, ["k"], "at", "x", "total", "decimal(20,2)", max_steps_per_group=None)
    cut = with_running_total(first, ["k"], "at", "x", "total", "decimal(20,2)", max_steps_per_group=10)
    assert rows(cut, "id", "total") == rows(plain, "id", "total")


def test_running_total_over_ties(frame, rows):
    df = frame([("a", 1, 10), ("a", 1, 5), ("a", 2, 1), ("b", 1, 2), (None, 1, 4)], "g STRING, m INT, x INT")
    got = with_running_total(df, ["g"], "m", "x", "ytd", "bigint")
    assert rows(got, "g", "m", "x", "ytd") == sorted(
        [("a", 1, 10, 15), ("a", 1, 5, 15), ("a", 2, 1, 16), ("b", 1, 2, 2), (None, 1, 4, 4)], key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_point_in_time_join_ways_agree(skewed, spark, how):
    versions = history.scd2_init(spark.range(600).select(F.col("id").cast("int").alias("k"), (F.col("id") % 7).alias("seg"),
                                 F.lit("2024-01-05").alias("since")), ["k"], "since").drop("since")
    later = versions.filter("k % 2 = 0").withColumns({"seg": F.lit(99).cast("bigint"), "valid_from": F.lit("2024-02-01").cast("date")})
    dim = history.scd2_apply(versions, later.select("k", "seg", "valid_from"), ["k"], ["seg"])
    facts = skewed.select("id", F.when(F.col("v") != 3, F.col("k")).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.abs("ts") % 60).cast("int")).alias("day"))
    ways = [
        join_as_of(facts, dim, ["k"], "day", ["seg"], how=how),
        join_as_of(facts, dim, ["k"], "day", ["seg"], how=how, max_versions=0),
        join_as_of(facts, dim, ["k"], "day", ["seg"], how=how, max_versions=0, max_rows_per_key=1_000),
    ]
    assert same(ways[0], ways[1]) and same(ways[0], ways[2])
    if how == "left":
        assert ways[0].count() == facts.count()


@pytest.mark.parametrize("n, buckets", [(10, 3), (2, 5), (1_001, 7), (9, 3)])
def test_balanced_buckets_number_like_ntile(spark, n, buckets):
    from pyspark.sql import Window

    df = spark.range(n).select(F.hash("id").alias("a"), "id")
    got = balanced_buckets(df, ["a", "id"], buckets)
    want = df.withColumn("bucket", F.ntile(buckets).over(Window.orderBy("a", "id")))
    assert same(got.select(want.columns), want)


def test_buckets_of_equal_rows(spark):
    sizes = [r["count"] for r in balanced_buckets(spark.range(1_000).select(F.lit(1).alias("x")), ["x"], 3).groupBy("bucket").count().collect()]
    assert sorted(sizes) == [333, 333, 334]


def test_merge_of_a_hot_key(skewed, frame):
    source = frame([(0, 1), (7, 2), (9_999, 3)], "k INT, v INT")
    target = skewed.select("k", "v")
    got = merge(target, source, ["k"], matched=[Update({"v": "s.v"})], not_matched=[Insert()])
    want = target.withColumn("v", F.expr("CASE k WHEN 0 THEN 1 WHEN 7 THEN 2 ELSE v END")).unionByName(source.filter("k = 9999"))
    assert same(got, want)


def test_dedup_keeps_one_row_per_key(skewed):
    got = dedup_latest(skewed, ["k"], "ts", ["id"])
    assert got.count() == skewed.select("k").distinct().count()


def test_merge_shuffles_only_the_source_columns_in_use(spark, plan, rows, tmp_path):
    spark.range(20).selectExpr("id AS k", "id % 3 AS a", "CAST(id AS STRING) AS wide").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    changes = table.filter("k < 5").withColumn("a", F.col("a") + 10)
    merged = merge(table, changes, ["k"], [Update({"a": "s.a"})], [Insert()])
    text = plan(merged.select("k", "a"))
    assert "wide" not in text[text.rfind("Initial Plan") :]
    assert rows(merged) == rows(table.selectExpr("k", "IF(k < 5, a + 10, a) AS a", "wide"))
