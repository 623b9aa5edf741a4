import datetime
import json

import pytest
from pyspark.sql import functions as F

from stratalake.operators.drift import evolve, rescue, typed, with_audit
from stratalake.plans import schemas
from stratalake.plans.ingest import ingest_file, record
from stratalake.sources import storage
from stratalake.sources.files import (
    read_csv,
    read_csv_lots,
    read_csv_strings,
    read_json,
    read_lots,
    with_source_file,
)
from stratalake.sources.tables import append_lot, checked_write, publish, register, write_parquet, write_table


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_schema_binds_by_name_and_missing_column_is_null(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "b,a\nx,1\ny,2\n")
    df = read_csv(spark, path, "a INT, currency STRING, b STRING")
    assert rows(df) == [(1, None, "x"), (2, None, "y")]
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "string"]


def test_differing_headers_in_one_scan_raise(spark, tmp_path):
    write(tmp_path / "d/1.csv", "a,b\n1,2\n")
    write(tmp_path / "d/2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path / "d"), "a INT, b INT").collect()


@pytest.mark.parametrize("mode, expected", [("PERMISSIVE", 3), ("DROPMALFORMED", 2)])
def test_count_sees_malformed_rows(spark, tmp_path, mode, expected):
    path = write(tmp_path / "a.csv", "a,b\n1,2\nx,3\n4,5\n")
    assert read_csv(spark, path, "a INT, b INT", mode=mode).count() == expected


def test_failfast_fails_on_count_alone(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_csv(spark, path, "a INT, b INT", mode="FAILFAST").count()


def test_inference_dates_and_encoding(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "id,nombre,fecha\n1,Muñoz,05/02/2024\n", encoding="iso-8859-1")
    df = read_csv(spark, path, "id INT, nombre STRING, fecha DATE", date_format="dd/MM/yyyy", encoding="ISO-8859-1")
    assert rows(df) == [(1, "Muñoz", datetime.date(2024, 2, 5))]
    assert dict(read_csv(spark, path).dtypes)["id"] == "int"


def test_multiline_and_nested_json(spark, tmp_path, rows):
    people = [{"id": 1, "activo": True}, {"id": 2, "activo": False}]
    path = write(tmp_path / "p.json", json.dumps(people, indent=2))
    assert rows(read_json(spark, path, "id INT, activo BOOLEAN", multiline=True)) == [(1, True), (2, False)]
    event = {"evento_id": "e1", "lectura": {"valor": 1.5, "estado": "ALERTA"}, "tags": {"turno": "A"}}
    lines = write(tmp_path / "e.json", json.dumps(event) + "\n")
    df = read_json(spark, lines, schemas.SENSOR_EVENTS)
    assert rows(df, "evento_id", "lectura.valor", "lectura.estado", "tags.turno") == [("e1", 1.5, "ALERTA", "A")]
    assert read_json(spark, lines).select("lectura.valor").first()[0] == 1.5


def test_lots_with_new_columns(spark, tmp_path, rows):
    one = write(tmp_path / "lot1.csv", "orden_id,total\nO1,10\n")
    two = write(tmp_path / "lot2.csv", "total,prioridad,orden_id\n20,EXPRESS,O2\n")
    df = read_csv_lots(spark, [one, two], "orden_id STRING, total INT")
    assert rows(df, "orden_id", "total", "prioridad") == [("O1", 10, None), ("O2", 20, "EXPRESS")]
    assert evolve([df, df]).count() == 4


def test_rescue_keeps_everything(spark, tmp_path):
    path = write(tmp_path / "lot3.csv", "id,qty,extra\n1,5,\n2,many,note\nT3,7,\n")
    got = {r["id"]: r for r in rescue(read_csv_strings(spark, path), "id STRING, qty INT, gone DATE").collect()}
    assert got["1"]["_rescued_data"] is None and got["1"]["qty"] == 5 and got["1"]["gone"] is None
    assert json.loads(got["2"]["_rescued_data"]) == {"qty": "many", "extra": "note"}
    assert got["T3"]["qty"] == 7 and got["T3"]["_rescued_data"] is None


def test_typed_is_null_where_text_does_not_parse(spark, rows):
    df = spark.createDataFrame([("12.345", "2024-02-30"), ("x", "2024-02-28")], "m STRING, d STRING")
    got = typed(df, {"m": "decimal(10,2)", "d": "date:yyyy-MM-dd"}).collect()
    assert [str(r["m"]) for r in got] == ["12.35", "None"]
    assert [r["d"] for r in got] == [None, datetime.date(2024, 2, 28)]


def test_audit_and_source_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a\n1\n")
    df = with_audit(spark.read.csv(path, header=True), "erp", "b1")
    row = df.first()
    assert (row["source_file"], row["source_system"], row["batch_id"]) == ("a.csv", "erp", "b1")
    assert row["ingestion_date"] is not None
    full = with_source_file(spark.read.csv(path, header=True), full_path=True).first()["_source_file"]
    assert full.endswith("/a.csv") and "/" in full


def test_table_sinks(spark, tmp_path, rows):
    one = spark.createDataFrame([(1, "a")], "id INT, x STRING")
    write_table(one, "sink_t")
    write_table(spark.createDataFrame([("b", 2)], "x STRING, id INT"), "sink_t", mode="append")  # by name
    assert rows(spark.table("sink_t")) == [(1, "a"), (2, "b")]
    wider = spark.createDataFrame([(3, True)], "id INT, flag BOOLEAN")
    with pytest.raises(ValueError, match="flag"):
        write_table(wider, "sink_t", mode="append")
    write_table(wider, "sink_t", mode="append", merge_schema=True)
    assert rows(spark.table("sink_t")) == [(1, "a", None), (2, "b", None), (3, None, True)]
    write_table(spark.createDataFrame([(9.5,)], "only DOUBLE"), "sink_t", replace_schema=True)
    assert rows(spark.table("sink_t")) == [(9.5,)]
    spark.sql("DROP TABLE sink_t")

    where = str(tmp_path / "external")
    write_table(one, "sink_ext", path=where, partition_by=["x"])
    spark.sql("DROP TABLE sink_ext")  # an external table leaves its files
    assert rows(spark.read.parquet(where), "id", "x") == [(1, "a")]


def test_partition_overwrite_replaces_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "id INT, p STRING"), path, partition_by=["p"])
    write_parquet(spark.createDataFrame([(3, "b")], "id INT, p STRING"), path, partition_by=["p"])
    assert rows(spark.read.parquet(path), "id", "p") == [(1, "a"), (3, "b")]


def test_widened_append(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    append_lot(spark.createDataFrame([(1,)], "id INT"), path, "a")
    append_lot(spark.createDataFrame([(2, "n")], "id INT, extra STRING"), path, "b")
    assert rows(read_lots(spark, path), "id", "extra") == [(1, None), (2, "n")]


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_checked_write_is_all_or_nothing(spark, tmp_path, rows, mode):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([("a", 5.0), ("b", None)], "sk STRING, total DOUBLE")
    bad = spark.createDataFrame([("c", 7.0), ("d", -50.0)], "sk STRING, total DOUBLE")
    checked_write(good, {"positive": "total > 0"}, path, not_null=["sk"])
    with pytest.raises(Exception, match="positive|violate"):
        checked_write(bad, {"positive": "total > 0"}, path, mode=mode)
    with pytest.raises(Exception, match="NOT NULL|violate"):
        checked_write(bad.withColumn("sk", F.lit(None).cast("string")), {}, path, mode=mode, not_null=["sk"])
    assert rows(spark.read.parquet(path), "sk") == [("a",), ("b",)]


def test_views_and_publication(spark, rows):
    df = spark.createDataFrame([(1, 2.345, "secret"), (2, 99999.0, "x")], "a INT, m DOUBLE, internal STRING")
    register(df, "v_local")
    register(df, "v_global", global_=True)
    assert spark.table("v_local").count() == spark.table("global_temp.v_global").count() == 2
    public = publish(df, {"Id": "a", "Monto": ("m", "decimal(5,2)")})
    assert [tuple(map(str, r)) for r in public.collect()] == [("1", "2.35"), ("2", "None")]


def test_versions_and_progress(spark, tmp_path, rows):
    root = str(tmp_path / "state")
    assert storage.load_version(spark, root) is None
    for v in (1, 2):
        storage.save_version(spark.createDataFrame([(v,)], "x INT"), root, v)
    assert rows(storage.load_version(spark, root)) == [(2,)] and rows(storage.load_version(spark, root, 1)) == [(1,)]
    log = str(tmp_path / "progress")
    assert storage.read_progress(spark, log, "p", default=-1) == -1
    storage.save_progress(spark, log, "p", "src", 4)
    storage.save_progress(spark, log, "q", "src", 9)
    assert storage.read_progress(spark, log, "p") == 4


def test_batch_ingest_logs_a_retry_once(spark, tmp_path, rows):
    header = "producto_id,sku,nombre_producto,categoria,laboratorio,unidades_stock,precio_unitario,fecha_vencimiento,lote,almacen_id\n"
    first = write(tmp_path / "inventario_batch01.csv", header + "P001,S,N,C,L,2400,1.5,2026-01-31,A,W1\nP002,S,N,C,L,10,2,2026-01-31,A,W1\n")
    second = write(tmp_path / "inventario_batch02.csv", header + "P001,S,N,C,L,2650,1.5,2026-01-31,A,W1\n")
    target, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    for version, (path, batch) in enumerate([(first, "b1"), (second, "b2"), (second, "b2")]):
        entry = ingest_file(spark, path, schemas.INVENTORY, target, "erp", batch)
        state = record(spark, log, entry, version)
    assert rows(state, "batch_id", "file", "rows_read", "status") == [
        ("b1", "inventario_batch01.csv", 2, "COMPLETADO"),
        ("b2", "inventario_batch02.csv", 1, "COMPLETADO"),
    ]
    stock = spark.read.parquet(target).filter("producto_id = 'P001'")
    assert set(rows(stock, "unidades_stock")) == {(2400,), (2650,)}  # bronze keeps every delivery
    bad = write(tmp_path / "bad.csv", header + "P003,S,N,C,L,many,1.5,2026-01-31,A,W1\n")
    before = spark.read.parquet(target).count()
    with pytest.raises(Exception):
        ingest_file(spark, bad, schemas.INVENTORY, target, "erp", "b3")
    assert spark.read.parquet(target).count() == before
