import datetime
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import history
from stratalake.plans import schemas
from stratalake.sources.files import read_lots
from stratalake.streaming import cdc
from stratalake.streaming.files import run_append, stream_evolving, stream_files, stream_rescued
from stratalake.streaming.silver import stream_silver


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_restart_reads_only_new_files(spark, tmp_path, rows):
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    put(src, "1.csv", "a,b\n1,x\n")

    def run():
        return run_append(stream_files(spark, str(src), "csv", "a INT, b STRING"), out, ckpt)

    run()
    put(src, "2.csv", "a,b\n2,y\n")
    query = run()
    assert sum(p.numInputRows for p in query.recentProgress) == 1
    run()
    got = spark.read.parquet(out)
    assert rows(got, "a", "b", "_source_file") == [(1, "x", "1.csv"), (2, "y", "2.csv")]
    assert got.filter("_ingestion_timestamp IS NULL").count() == 0


def test_append_to_a_catalog_table(spark, tmp_path, rows):
    src = tmp_path / "src"
    put(src, "1.csv", "a\n1\n")
    stream = stream_files(spark, str(src), "csv", "a INT").select("a")
    run_append(stream, "streamed", str(tmp_path / "ckpt"), table=True)
    assert rows(spark.table("streamed")) == [(1,)]
    # and from that table on to the next one
    query, _ = stream_silver(spark.readStream.table("streamed"), {"twice": "a * 2"}, str(tmp_path / "silver"), str(tmp_path / "ckpt2"))
    assert rows(spark.read.parquet(str(tmp_path / "silver"))) == [(2,)]
    spark.sql("DROP TABLE streamed")


def test_new_columns_in_later_lots(spark, tmp_path, rows):
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    schema = "orden_id STRING, cantidad INT"
    put(src, "lote1.csv", "orden_id,cantidad\nO1,1\n")
    stream_evolving(spark, str(src), out, ckpt, schema)
    put(src, "lote2.csv", "cantidad,prioridad_envio,orden_id\n2,EXPRESS,O2\n")
    put(src / "sub", "lote2b.csv", "orden_id,cantidad\nO3,3\n")
    stream_evolving(spark, str(src), out, ckpt, schema)
    stream_evolving(spark, str(src), out, ckpt, schema)
    got = read_lots(spark, out)
    assert rows(got, "orden_id", "cantidad", "prioridad_envio", "_source_file") == [
        ("O1", 1, None, "lote1.csv"), ("O2", 2, "EXPRESS", "lote2.csv"), ("O3", 3, None, "lote2b.csv")]


def test_fixed_schema_rescues_the_rest(spark, tmp_path, rows):
    src, out = tmp_path / "src", str(tmp_path / "out")
    names = [c.split()[0] for c in schemas.ORDER_LOTS.replace("\n", " ").split(", ")]
    values = ["1" if "INT" in c or "DOUBLE" in c else "t" for c in schemas.ORDER_LOTS.replace("\n", " ").split(", ")]
    put(src, "lote3.csv", ",".join([*names, "prioridad_envio", "campo_extra_inesperado"]) + "\n" + ",".join([*values, "URGENTE", "x"]) + "\n")
    put(src, "plain.csv", ",".join(names) + "\n" + ",".join(values) + "\n")
    stream_rescued(spark, str(src), schemas.ORDER_LOTS, out, str(tmp_path / "ckpt"))
    got = spark.read.parquet(out)
    assert rows(got, "_source_file", "_rescued_data") == [
        ("lote3.csv", '{"prioridad_envio":"URGENTE","campo_extra_inesperado":"x"}'), ("plain.csv", None)]


def test_silver_drops_and_counts(spark, tmp_path):
    """150 rows: 3 without a positive total, 2 in the future."""
    src = tmp_path / "src"
    lines = [f"V{i},2024-01-{1 + i % 28:02},{-1 if i < 3 else 10}.5,{'' if i == 9 else 'Norte'}" for i in range(148)]
    lines += ["V148,2999-01-01,5,Sur", "V149,2999-01-01,5,Sur"]
    for part in range(3):
        put(src, f"{part}.csv", "venta_id,fecha,total,region\n" + "\n".join(lines[part * 50 : part * 50 + 50]) + "\n")
    bronze = stream_files(spark, str(src), "csv", "venta_id STRING, fecha STRING, total STRING, region STRING", max_files=1)
    columns = {"venta_id": "venta_id", "fecha": "to_date(fecha)", "total": "try_cast(total AS DECIMAL(12,2))", "region": "region"}
    target = str(tmp_path / "silver")
    _, counts = stream_silver(
        bronze, columns, target, str(tmp_path / "ckpt"),
        drop={"total_positivo": "total > 0", "fecha_valida": "fecha <= current_date()"},
        warn={"region_no_nula": "region IS NOT NULL"})
    assert spark.read.parquet(target).count() == 145
    assert counts == {"total_positivo": 3, "fecha_valida": 2, "region_no_nula": 1}
    with pytest.raises(Exception, match="expectation violated"):
        stream_silver(bronze, columns, str(tmp_path / "s2"), str(tmp_path / "c2"), fail={"total_positivo": "total > 0"})


EVENTS = "cliente_id STRING, plan STRING, operation STRING, event_ts TIMESTAMP, evento_id INT"
ARGS = dict(sequence_by="event_ts", delete_when="operation = 'DELETE'")
HIDDEN = ["operation", "event_ts", "evento_id"]


def test_out_of_order_events_and_replay(spark, tmp_path, rows):
    """100 events of 35 customers, in five shuffled files."""
    rng = random.Random(4)
    start = datetime.datetime(2024, 1, 1)
    data = [
        (f"CLI-{i % 35:03}", rng.choice("ABC"), "INSERT" if i < 35 else rng.choice(["UPDATE", "UPDATE", "DELETE"]), start + datetime.timedelta(hours=i), i)
        for i in range(100)
    ]
    rng.shuffle(data)
    src = str(tmp_path / "src")
    for part in range(5):
        spark.createDataFrame(data[part::5], EVENTS).coalesce(1).write.mode("append").parquet(src)
    whole = spark.createDataFrame(data, EVENTS)
    batch = dict(ARGS, keys=["cliente_id"], except_columns=HIDDEN, tiebreak=["evento_id"])

    def stream():
        return stream_files(spark, src, "parquet", EVENTS, max_files=1).select(*whole.columns)

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    cdc.stream_scd1(stream(), ["cliente_id"], **ARGS, log=one, checkpoint=str(tmp_path / "c1"), tiebreak=["evento_id"])
    cdc.stream_scd2(stream(), ["cliente_id"], **ARGS, log=two, checkpoint=str(tmp_path / "c2"), buckets=4)
    for attempt in ("first", "replayed"):
        assert rows(cdc.read_scd1(spark, one, ["cliente_id"], HIDDEN, ["evento_id"])) == rows(history.scd1(whole, **batch)), attempt
        full = cdc.read_scd2(spark, two, ["cliente_id"], HIDDEN, ["evento_id"])
        assert rows(full) == rows(history.scd2(whole, **batch)), attempt
        # Lost checkpoints: every file is delivered again, in batches of the same numbers.
        cdc.stream_scd1(stream(), ["cliente_id"], **ARGS, log=one, checkpoint=str(tmp_path / f"{attempt}1"), tiebreak=["evento_id"])
        cdc.stream_scd2(stream(), ["cliente_id"], **ARGS, log=two, checkpoint=str(tmp_path / f"{attempt}2"), buckets=4)
    full = cdc.read_scd2(spark, two, ["cliente_id"], HIDDEN, ["evento_id"])
    assert full.count() > 35
    folded = str(tmp_path / "folded")
    cdc.fold_scd1(spark, one, folded, ["cliente_id"], ["evento_id"])
    assert rows(cdc.read_scd1(spark, folded, ["cliente_id"], HIDDEN, ["evento_id"])) == rows(history.scd1(whole, **batch))
    some = spark.createDataFrame([("CLI-001",)], "cliente_id STRING")
    part = cdc.read_scd2(spark, two, ["cliente_id"], HIDDEN, ["evento_id"], only_keys=some)
    assert rows(part) == rows(full.filter("cliente_id = 'CLI-001'"))


def test_late_update_does_not_revive_a_deleted_key(spark, tmp_path):
    day = lambda d: datetime.datetime(2024, 1, d)
    src = str(tmp_path / "src")
    for events in ([("A", "x", "INSERT", day(1), 1)], [("A", None, "DELETE", day(5), 3)], [("A", "late", "UPDATE", day(3), 2)]):
        spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(src)
        stream = stream_files(spark, src, "parquet", EVENTS).select("cliente_id", "plan", *HIDDEN)
        cdc.stream_scd1(stream, ["cliente_id"], **ARGS, log=str(tmp_path / "log"), checkpoint=str(tmp_path / "ckpt"))
    assert cdc.read_scd1(spark, str(tmp_path / "log"), ["cliente_id"]).count() == 0


def test_stored_history_rewrites_only_touched_buckets(spark, tmp_path, rows):
    src, log, target, progress = (str(tmp_path / n) for n in ("src", "log", "target", "progress"))
    start = datetime.datetime(2024, 1, 1)

    def deliver(events):
        spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(src)
        stream = stream_files(spark, src, "parquet", EVENTS).select("cliente_id", "plan", *HIDDEN)
        cdc.stream_scd2(stream, ["cliente_id"], **ARGS, log=log, checkpoint=str(tmp_path / "ckpt"), buckets=8)
        return cdc.refresh_scd2(spark, log, target, progress, ["cliente_id"], HIDDEN, ["evento_id"])

    def written():
        return {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "target").glob("_bucket=*")}

    first = [(f"CLI-{i:03}", "A", "INSERT", start + datetime.timedelta(days=10, hours=i), i) for i in range(40)]
    assert deliver(first) == 0
    before = written()
    late = [("CLI-007", "Z", "UPDATE", start, 99)]  # earlier than what is known
    assert deliver(late) == 1
    after = written()
    assert sum(before[b] != after[b] for b in before) == 1
    assert cdc.refresh_scd2(spark, log, target, progress, ["cliente_id"], HIDDEN, ["evento_id"]) is None
    want = history.scd2(spark.createDataFrame(first + late, EVENTS), ["cliente_id"], **ARGS, except_columns=HIDDEN, tiebreak=["evento_id"])
    assert rows(spark.read.parquet(target).select(want.columns)) == rows(want)
