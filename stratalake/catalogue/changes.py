"""Upserts, change feeds and dimension history."""

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.operators import feed, history
from stratalake.operators import merge as dml
from stratalake.operators.joins import join_as_of, valid_on
from stratalake.operators.merge import Delete, Insert, Update, merge
from stratalake.operators.quality import reconcile as reconcile_counts
from stratalake.plans.propagation import current_state, propagate, save_snapshots, state_at, write_feed
from stratalake.sources.storage import stored, work_dir
from stratalake.sources.tables import write_parquet

# Shared blocks. b = target before, s = source, m = merged, a = after deletes, a2 = after a second round.
_UPSERT = """
b AS (SELECT o_orderkey AS k, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS p
      FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
s AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS st,
             CAST(o_totalprice AS DECIMAL(18,2)) AS p
      FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01'),
m AS (SELECT coalesce(b.k, s.k) AS k,
             CASE WHEN s.k IS NOT NULL AND (b.k IS NULL OR b.st <> s.st) THEN s.st ELSE b.st END AS st,
             coalesce(b.p, s.p) AS p
      FROM b FULL OUTER JOIN s ON b.k = s.k),
a AS (SELECT m.* FROM m WHERE m.k NOT IN (
        SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1995-06-01')),
a2 AS (SELECT k, CASE WHEN st = 'F' AND p > 300000 THEN 'Z' ELSE st END AS st, p FROM a WHERE NOT (st = 'X' AND p < 100000))
"""
_FEED = """
f AS (SELECT a.k, a.st, a.p, 'insert' AS ct FROM a LEFT JOIN b ON a.k = b.k WHERE b.k IS NULL
      UNION ALL SELECT b.k, b.st, b.p, 'delete' FROM b LEFT JOIN a ON a.k = b.k WHERE a.k IS NULL
      UNION ALL SELECT b.k, b.st, b.p, 'update_preimage' FROM b JOIN a ON a.k = b.k
                WHERE a.st IS DISTINCT FROM b.st OR a.p IS DISTINCT FROM b.p
      UNION ALL SELECT a.k, a.st, a.p, 'update_postimage' FROM b JOIN a ON a.k = b.k
                WHERE a.st IS DISTINCT FROM b.st OR a.p IS DISTINCT FROM b.p)
"""


def _before(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    return orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("p"),
    )


def _source(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderdate >= TIMESTAMP_NTZ '1997-07-01'")
    return orders.select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus")).alias("st"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("p"),
    )


def _merged(spark, sf_dir):
    return merge(
        _before(spark, sf_dir),
        _source(spark, sf_dir),
        ["k"],
        matched=[Update({"st": "s.st"}, when="t.st <> s.st")],
        not_matched=[Insert()],
    )


def _after(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").filter(
        "o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP_NTZ '1995-06-01'"
    )
    return _merged(spark, sf_dir).join(gone.select(F.col("o_orderkey").alias("k")), "k", "left_anti")


def _after_2(after):
    kept = dml.delete_where(after, "st = 'X' AND p < 100000")
    return dml.update_where(kept, "st = 'F' AND p > 300000", {"st": F.lit("Z")})


def _round_1(spark, sf_dir):
    after = stored(_after(spark, sf_dir), "after")
    return feed.change_feed(_before(spark, sf_dir), after, ["k"], version=1, timestamp="2024-01-01")


# --- upsert and DML --------------------------------------------------------


@query(f"WITH {_UPSERT} SELECT k, st, p FROM m")
def merge_upsert(spark, sf_dir):
    return _merged(spark, sf_dir)


@query(f"""
WITH {_UPSERT} SELECT k, st, p FROM b UNION ALL SELECT k, st, p FROM s WHERE k NOT IN (SELECT k FROM b)
""")
def merge_insert_only(spark, sf_dir):
    return merge(_before(spark, sf_dir), _source(spark, sf_dir), ["k"], not_matched=[Insert()])


@query(f"""
WITH {_UPSERT}
SELECT b.k, CASE WHEN s.k IS NOT NULL THEN s.st ELSE b.st END AS st, b.p FROM b LEFT JOIN s ON b.k = s.k
""")
def merge_update_only(spark, sf_dir):
    return merge(_before(spark, sf_dir), _source(spark, sf_dir), ["k"], matched=[Update({"st": "s.st"})])


@query(f"""
WITH {_UPSERT}
SELECT coalesce(s.k, b.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.st ELSE b.st END AS st,
       CASE WHEN s.k IS NOT NULL THEN s.p ELSE b.p END AS p
FROM b FULL OUTER JOIN s ON b.k = s.k
""")
def merge_star(spark, sf_dir):
    return merge(_before(spark, sf_dir), _source(spark, sf_dir), ["k"], matched=[Update()], not_matched=[Insert()])


@query("""
WITH t AS (SELECT c_custkey AS k, 1 AS active, 7 AS days FROM customer WHERE c_acctbal < 6000),
     s AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal >= 3000)
SELECT coalesce(t.k, s.k) AS k, CAST(CASE WHEN s.k IS NULL THEN 0 WHEN t.k IS NULL THEN 1 ELSE t.active END AS INTEGER) AS active,
       CAST(coalesce(t.days, 14) AS INTEGER) AS days
FROM t FULL OUTER JOIN s ON t.k = s.k
""")
def merge_by_source(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    target = customer.filter("c_acctbal < 6000").select(
        F.col("c_custkey").alias("k"), F.lit(1).alias("active"), F.lit(7).alias("days")
    )
    return merge(
        target,
        customer.filter("c_acctbal >= 3000").select(F.col("c_custkey").alias("k")),
        ["k"],
        not_matched=[Insert({"k": "s.k", "active": "1", "days": "14"})],
        not_matched_by_source=[Update({"active": "0"}, when="t.active = 1")],
    )


_STORED = """
t AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders WHERE o_orderkey % 5 <> 0),
s AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, 'X' AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
             o_orderdate < TIMESTAMP '1993-01-01' OR o_orderpriority = '5-LOW' AS gone
      FROM orders WHERE year(o_orderdate) IN (1992, 1996))
"""


def _stored_orders(spark, sf_dir):
    """Orders by year, and a batch of changes: all of 1992 goes, and of 1996 what has low priority."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.year("o_orderdate").alias("y"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("p"),
        F.expr("o_orderdate < TIMESTAMP_NTZ '1993-01-01' OR o_orderpriority = '5-LOW'").alias("gone"),
    )
    path = work_dir(spark, "orders")
    write_parquet(orders.filter("k % 5 <> 0").drop("gone"), path, partition_by=["y"])
    return path, orders.filter("y IN (1992, 1996)").withColumn("st", F.lit("X"))


@query(f"""
WITH {_STORED}
SELECT t.k, t.y, coalesce(s.st, t.st) AS st, t.p FROM t LEFT JOIN s ON t.k = s.k AND t.y = s.y WHERE s.gone IS NOT TRUE
UNION ALL SELECT k, y, st, p FROM s WHERE NOT gone AND k NOT IN (SELECT k FROM t)
""")
def merge_table_delete(spark, sf_dir):
    """A stored table by year: changed, new and deleted rows; the year that loses all rows loses its folder."""
    path, changes = _stored_orders(spark, sf_dir)
    values = {"k": "s.k", "y": "s.y", "st": "s.st", "p": "s.p"}
    dml.merge_partitions(
        spark, path, changes, ["k", "y"], ["y"],
        matched=[Delete("s.gone"), Update({"st": "s.st"})], not_matched=[Insert(values, when="NOT s.gone")],
    )
    return spark.read.parquet(path).select("k", F.col("y").cast("bigint").alias("y"), "st", "p")


@query(f"""
WITH {_STORED}
SELECT t.k, t.y, CASE WHEN s.k IS NOT NULL THEN s.st WHEN t.y = 1994 THEN 'old' ELSE t.st END AS st, t.p
FROM t LEFT JOIN s ON t.k = s.k AND t.y = s.y WHERE NOT (s.k IS NULL AND t.y = 1995 AND t.p > 100000)
UNION ALL SELECT k, y, st, p FROM s WHERE k NOT IN (SELECT k FROM t)
""")
def merge_table_by_source(spark, sf_dir):
    """The same table with clauses for rows that the source does not have."""
    path, changes = _stored_orders(spark, sf_dir)
    dml.merge_partitions(
        spark, path, changes.drop("gone"), ["k", "y"], ["y"],
        matched=[Update({"st": "s.st"})], not_matched=[Insert()],
        not_matched_by_source=[Delete("t.y = 1995 AND t.p > 100000"), Update({"st": F.lit("old")}, when="t.y = 1994")],
    )
    return spark.read.parquet(path).select("k", F.col("y").cast("bigint").alias("y"), "st", "p")


@query(f"WITH {_UPSERT} SELECT k, st, p FROM a")
def cdc_apply(spark, sf_dir):
    return feed.apply_feed(_before(spark, sf_dir), stored(_round_1(spark, sf_dir), "feed"), ["k"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'S' ELSE o_orderstatus END AS o_orderstatus,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) * 2
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS price, o_orderpriority
FROM orders
""")
def update_where(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority"
    )
    return dml.update_where(
        orders, "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'", {"o_orderstatus": F.lit("S"), "price": "price * 2"}
    )


@query("""
SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality <> 0
""")
def delete_where(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return dml.delete_where(joined, "quality = 0")


# --- change feed -----------------------------------------------------------


@query(f"WITH {_UPSERT}, {_FEED} SELECT k, st, p, ct FROM f")
def change_feed(spark, sf_dir):
    return _round_1(spark, sf_dir).select("k", "st", "p", F.col("_change_type").alias("ct"))


@query(f"""
WITH {_UPSERT}, {_FEED}
SELECT 0 AS version, 'insert' AS ct, count(*) AS row_count FROM b
UNION ALL SELECT 1, ct, count(*) FROM f GROUP BY ct
""")
def feed_counts(spark, sf_dir):
    both = feed.initial_feed(_before(spark, sf_dir)).unionByName(_round_1(spark, sf_dir))
    counts = feed.feed_counts(both, "row_count")
    return counts.select(F.col("_commit_version").cast("int").alias("version"), F.col("_change_type").alias("ct"), "row_count")


@query(f"""
WITH {_UPSERT}, {_FEED}
SELECT CAST(0 AS BIGINT) AS version, (SELECT count(*) FROM b) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted
UNION ALL
SELECT 1, count(*) FILTER (ct = 'insert'), count(*) FILTER (ct = 'update_postimage'), count(*) FILTER (ct = 'delete') FROM f
""")
def feed_history(spark, sf_dir):
    both = feed.initial_feed(_before(spark, sf_dir)).unionByName(_round_1(spark, sf_dir))
    return feed.history(both).withColumnRenamed("_commit_version", "version")


@query(f"WITH {_UPSERT}, {_FEED} SELECT k, st, p, ct FROM f")
def feed_range(spark, sf_dir):
    path = work_dir(spark, "feed")
    write_feed(feed.initial_feed(_before(spark, sf_dir)).unionByName(_round_1(spark, sf_dir)), path)
    selected = feed.feed_range(spark.read.parquet(path), 1, 1)
    return selected.select("k", "st", "p", F.col("_change_type").alias("ct"))


@query(f"WITH {_UPSERT}, {_FEED} SELECT k, st, p, ct FROM f WHERE ct <> 'update_preimage'")
def feed_collapse(spark, sf_dir):
    last = feed.collapse(_round_1(spark, sf_dir), ["k"])
    return last.select("k", "st", "p", F.col("_change_type").alias("ct"))


def _three_versions(spark, sf_dir):
    """A stored feed: first load, round 1, round 2."""
    path = work_dir(spark, "feed")
    write_feed(feed.initial_feed(_before(spark, sf_dir)).unionByName(_round_1(spark, sf_dir)), path)
    after = feed.as_of(spark.read.parquet(path), 1, ["k"])
    write_feed(feed.change_feed(after, _after_2(after), ["k"], version=2, timestamp="2024-01-02"), path)
    return spark.read.parquet(path)


@query(f"""
WITH {_UPSERT}
SELECT 0 AS version, k, st, p FROM b UNION ALL SELECT 1, k, st, p FROM a UNION ALL SELECT 2, k, st, p FROM a2
""")
def as_of_version(spark, sf_dir):
    changes = _three_versions(spark, sf_dir)
    states = [feed.as_of(changes, v, ["k"]).select(F.lit(v).alias("version"), "k", "st", "p") for v in (0, 1, 2)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query(f"""
WITH {_UPSERT} SELECT 0 AS version, k, st, p FROM b UNION ALL SELECT 1, k, st, p FROM a UNION ALL SELECT 2, k, st, p FROM a2
""")
def as_of_snapshot(spark, sf_dir):
    """The same states from a stored feed with a snapshot at every second version: nothing before it is read."""
    path, snapshots = work_dir(spark, "feed"), work_dir(spark, "snapshots")
    write_feed(_three_versions(spark, sf_dir), path)
    save_snapshots(spark, path, snapshots, ["k"], every=2)
    states = [state_at(spark, path, snapshots, v, ["k"]).select(F.lit(v).alias("version"), "k", "st", "p") for v in (0, 1, 2)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query(f"WITH {_UPSERT} SELECT k, st, p FROM a2")
def incremental_growing(spark, sf_dir):
    """Two rounds into a table that begins with two buckets and splits them on the way."""
    changes = _three_versions(spark, sf_dir)
    target, progress = work_dir(spark, "target"), work_dir(spark, "progress")
    for high in (0, 1, 2):
        propagate(spark, feed.feed_range(changes, 0, high), target, progress, "orders", ["k"], buckets=2, rows_per_bucket=2_000)
    return current_state(spark, target)


@query(f"WITH {_UPSERT} SELECT k, st, p FROM a2")
def incremental_two_rounds(spark, sf_dir):
    changes = _three_versions(spark, sf_dir)
    target, progress = work_dir(spark, "target"), work_dir(spark, "progress")
    propagate(spark, feed.feed_range(changes, 0, 1), target, progress, "orders", ["k"], buckets=8)
    propagate(spark, changes, target, progress, "orders", ["k"], buckets=8)
    return current_state(spark, target)


@query(f"""
WITH {_UPSERT}
SELECT coalesce(x.st, y.st) AS st, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b, coalesce(x.n, 0) = coalesce(y.n, 0) AS matches
FROM (SELECT st, count(*) AS n FROM a GROUP BY st) x FULL OUTER JOIN (SELECT st, count(*) AS n FROM b GROUP BY st) y ON x.st = y.st
""")
def reconcile(spark, sf_dir):
    return reconcile_counts(_after(spark, sf_dir), _before(spark, sf_dir), ["st"])


# --- history from events ---------------------------------------------------

_EVENTS = """
e AS (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v, ts, event_id,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events)
"""
# How events read as changes: the key is the user, 'error' deletes, anything else is the new state.
CDC = {"keys": ["user_id"], "sequence_by": "ts", "delete_when": "event_type = 'error'"}


def cdc_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("v"), "ts", "event_id"
    )


def _history(spark, sf_dir, **options):
    return history.scd2(cdc_events(spark, sf_dir), **CDC, except_columns=["ts", "event_id"], tiebreak=["event_id"], **options)


@query(f"WITH {_EVENTS} SELECT user_id, event_type, v FROM e WHERE rn = 1 AND event_type <> 'error'")
def scd1(spark, sf_dir):
    return history.scd1(cdc_events(spark, sf_dir), **CDC, except_columns=["ts", "event_id"], tiebreak=["event_id"])


_SCD2 = f"""
WITH {_EVENTS}
SELECT user_id, event_type, v, ts AS start_at, nx AS end_at FROM e WHERE event_type <> 'error' AND (nx IS NULL OR nx > ts)
"""


@query(_SCD2)
def scd2(spark, sf_dir):
    return _history(spark, sf_dir).withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


@query(_SCD2)
def scd2_hot_keys(spark, sf_dir):
    """The same history with every key treated as too large for one task."""
    rows = _history(spark, sf_dir, max_rows_per_key=0)
    return rows.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


@query(f"""
WITH {_EVENTS} SELECT user_id, event_type, v, ts AS start_at FROM e WHERE event_type <> 'error' AND nx IS NULL
""")
def scd2_current(spark, sf_dir):
    return history.scd2_current(_history(spark, sf_dir)).drop("__END_AT").withColumnRenamed("__START_AT", "start_at")


@query(f"""
WITH {_EVENTS}
SELECT user_id, max(nx) AS deleted_at FROM e WHERE event_type <> 'error' AND (nx IS NULL OR nx > ts)
GROUP BY user_id HAVING sum(CASE WHEN nx IS NULL THEN 1 ELSE 0 END) = 0
""")
def deleted_keys(spark, sf_dir):
    return history.deleted_keys(_history(spark, sf_dir), ["user_id"])


# --- history from batches --------------------------------------------------

# The second batch is a full snapshot in which customers in debt have a new segment.
_DIM = """
d AS (SELECT c_custkey AS k, c_mktsegment AS seg, DATE '1995-01-01' AS vf FROM customer),
n AS (SELECT c_custkey AS k, 'CHANGED' AS seg, DATE '1998-01-01' AS vf FROM customer WHERE c_acctbal < 0),
dim AS (SELECT d.k, d.seg, d.vf, CASE WHEN n.k IS NULL THEN DATE '9999-12-31' ELSE DATE '1997-12-31' END AS vt, n.k IS NULL AS cur
        FROM d LEFT JOIN n ON d.k = n.k
        UNION ALL SELECT k, seg, vf, DATE '9999-12-31', true FROM n)
"""


def _dim_v1(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.lit("1995-01-01").alias("since")
    )
    return history.scd2_init(customer, ["k"], "since").drop("since")


def _dim_batch(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.when(F.col("c_acctbal") < 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("seg"),
        F.lit("1998-01-01").cast("date").alias("valid_from"),
    )


def customer_dimension(spark, sf_dir):
    return history.scd2_apply(_dim_v1(spark, sf_dir), _dim_batch(spark, sf_dir), ["k"], ["seg"])


@query(f"""
WITH {_DIM}
SELECT k, seg, vf AS valid_from, vt AS valid_to, cur AS is_current,
       sha256(concat_ws('|', CAST(k AS VARCHAR), CAST(vf AS VARCHAR))) AS dim_sk
FROM dim
""")
def scd2_two_step(spark, sf_dir):
    return customer_dimension(spark, sf_dir)


@query(f"WITH {_DIM} SELECT k, seg, vf AS valid_from FROM n")
def scd2_changes(spark, sf_dir):
    current = _dim_v1(spark, sf_dir).filter("is_current")
    return history.detect_changes(current, _dim_batch(spark, sf_dir), ["k"], ["seg"])


@query(f"""
WITH {_DIM} SELECT k, seg, vf AS valid_from FROM dim WHERE vf <= DATE '1998-06-30' AND vt >= DATE '1998-06-30'
""")
def scd2_as_of_date(spark, sf_dir):
    return valid_on(customer_dimension(spark, sf_dir), "1998-06-30").select("k", "seg", "valid_from")


_PIT = f"""
WITH {_DIM}
SELECT o_orderkey, o_custkey AS k, dim.seg FROM orders JOIN dim ON o_custkey = k AND CAST(o_orderdate AS DATE) BETWEEN vf AND vt
"""


def _pit(spark, sf_dir, **options):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("k"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    return join_as_of(orders, customer_dimension(spark, sf_dir), ["k"], "day", ["seg"], **options)


@query(f"""
WITH {_DIM}
SELECT dim.seg, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders JOIN dim ON o_custkey = k AND CAST(o_orderdate AS DATE) BETWEEN vf AND vt GROUP BY dim.seg
""")
def pit_join(spark, sf_dir):
    joined = _pit(spark, sf_dir)
    return joined.groupBy("seg").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("decimal(28,2)").alias("total")
    )


@query(_PIT)
def pit_join_ordered(spark, sf_dir):
    """Every fact row, by the way taken where the dimension is too large to broadcast."""
    return _pit(spark, sf_dir, max_versions=0).select("o_orderkey", "k", "seg")


@query(_PIT)
def pit_join_hot_keys(spark, sf_dir):
    """The same with every key treated as too large for one task."""
    return _pit(spark, sf_dir, max_versions=0, max_rows_per_key=0).select("o_orderkey", "k", "seg")


@query(f"""
WITH {_EVENTS},
h AS (SELECT user_id, event_type AS state, v, ts AS vf, nx AS vt FROM e WHERE event_type <> 'error' AND (nx IS NULL OR nx > ts)),
f AS (SELECT event_id, user_id, ts + INTERVAL 30 MINUTE AS moment FROM events)
SELECT event_id, f.user_id, state, v FROM f JOIN h ON f.user_id = h.user_id AND moment >= vf AND (vt IS NULL OR moment < vt)
""")
def pit_join_open(spark, sf_dir):
    """What each user's state was half an hour after each event, from a history whose last versions have no end.

    Users with more than eight versions take the ordered way, all others the join by range.
    """
    facts = table(spark, sf_dir, "events").select("event_id", "user_id", F.expr("ts + INTERVAL 30 MINUTES").alias("at"))
    versions = stored(_history(spark, sf_dir), "history").withColumnRenamed("event_type", "state")
    joined = join_as_of(
        facts, versions, ["user_id"], "at", ["state", "v"], history.START, history.END, end_inclusive=False, max_versions=8
    )
    return joined.select("event_id", "user_id", "state", "v")


@query("""
SELECT 'l_orderkey' AS key, count(*) > count(DISTINCT l_orderkey) AS refused FROM lineitem
UNION ALL SELECT 'o_orderkey', count(*) > count(DISTINCT o_orderkey) FROM orders
""")
def merge_ambiguous(spark, sf_dir):
    """Lines as a source match an order several times, which is refused; orders match once."""
    target = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("p"))
    out = None
    for key, source in (("l_orderkey", lines), ("o_orderkey", target)):
        try:
            merge(target, source, ["k"], matched=[Update({"p": "s.p"})]).agg(F.sum("p")).collect()
            refused = False
        except PySparkException as error:
            if "several source rows" not in str(error):
                raise
            refused = True
        row = source.agg(F.lit(key).alias("key"), F.lit(refused).alias("refused"))
        out = row if out is None else out.unionByName(row)
    return out
