"""The facts the reference data sets are known by, on synthesized rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators import history
from stratalake.operators.joins import valid_on
from stratalake.operators.quality import assert_unique, batch_metrics, split
from stratalake.plans import kpi, propagation, reports, retail, reviews, sales, schemas
from stratalake.operators import feed
from stratalake.operators.merge import delete_where, update_where
from stratalake.operators.quality import reconcile
from stratalake.sources.storage import read_progress


def sale(order, product="PROD-101", total=100.0, state="completada", at="2024-01-15T08:00:00Z", channel="ecommerce"):
    return (order, 1, product, "CLI-1", 1, abs(total), total, "2024-01-10", channel, state, at, "ventas.csv")


@pytest.fixture
def bronze_sales(spark):
    lines = [
        sale("ORD-001", channel=" Ecommerce "),
        sale("ORD-002", channel="MAYORISTA"),
        sale("ORD-003", "PROD-103", 600.0, "pendiente"),
        sale("ORD-004", total=-50.0),
        sale("ORD-005", product=None),
        sale("ORD-006", total=80.0),
        sale("ORD-006", total=85.0, at="2024-01-16T08:00:00Z"),
        sale("ORD-007"),
        sale("ORD-008"),
        sale("ORD-009", "PROD-104"),
    ]
    return spark.createDataFrame(lines, schemas.SALES_LINES)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("PROD-101", None, "Calzado", "SportMax"), ("PROD-103", "Bicicleta", "Ciclismo", "VeloCity")], schemas.PRODUCTS
    )


def test_sales_lines(spark, bronze_sales, products, rows):
    validated = sales.validated(bronze_sales)
    valid, quarantine = split(validated, "b1")
    assert rows(quarantine, "orden_id", "rejection_reason") == [
        ("ORD-004", "monto_no_positivo"),
        ("ORD-005", "producto_id_nulo"),
    ]
    metrics = batch_metrics(validated, ["orden_id", "linea_id"], "b1").first().asDict()
    assert (metrics["total_rows"], metrics["valid_rows"], metrics["duplicates_removed"], metrics["final_rows"]) == (10, 8, 1, 7)
    assert metrics["rejected_pct"] == 20.0

    silver = sales.silver(valid, products)
    assert_unique(silver, "venta_sk")
    assert silver.count() == 7
    assert rows(silver.filter("orden_id = 'ORD-006'"), "monto_total") == [(85.0,)]
    # PROD-101 has no name, yet it is in the catalogue.
    assert rows(silver.filter("_join_status = 'unmatched'"), "orden_id") == [("ORD-009",)]

    staging = (
        silver.filter("orden_id = 'ORD-003'")
        .withColumn("estado", F.lit("completada"))
        .unionByName(
            silver.filter("orden_id = 'ORD-001'").withColumns(
                {"orden_id": F.lit("ORD-010"), "venta_sk": F.sha2(F.lit("ORD-010|1"), 256)}
            )
        )
    )
    once = sales.merge_increment(silver, staging)
    twice = sales.merge_increment(once, staging)
    assert once.count() == 8
    assert rows(once.filter("orden_id = 'ORD-003'"), "estado") == [("completada",)]
    assert rows(twice, "venta_sk", "estado") == rows(once, "venta_sk", "estado")


def test_empty_batch_has_no_rejected_share(spark, bronze_sales):
    empty = sales.validated(bronze_sales.limit(0))
    assert batch_metrics(empty, ["orden_id", "linea_id"], "b1").first()["rejected_pct"] is None


def test_customer_history(spark, rows):
    v1 = spark.createDataFrame(
        [("CLI-001", "Ana", "Lima", "oro", "2024-01-01"), ("CLI-002", "Luis", "Cusco", "plata", "2024-01-01"),
         ("CLI-003", "Eva", None, "oro", "2024-01-01")], schemas.CUSTOMERS)
    v2 = spark.createDataFrame(
        [("CLI-001", "Ana", "Piura", "oro", "2024-03-01"), ("CLI-002", "Luis", "Cusco", "oro", "2024-03-01"),
         ("CLI-003", "Eva", None, "oro", "2024-03-01")], schemas.CUSTOMERS)
    dim = history.scd2_init(v1, ["cliente_id"], "fecha_inicio").drop("fecha_inicio")
    batch = v2.withColumnRenamed("fecha_inicio", "valid_from").withColumn("valid_from", F.col("valid_from").cast("date"))
    tracked = ["ciudad", "segmento"]
    assert rows(history.detect_changes(dim, batch, ["cliente_id"], tracked), "cliente_id") == [("CLI-001",), ("CLI-002",)]
    after = history.scd2_apply(dim, batch, ["cliente_id"], tracked)
    assert after.count() == 5 and after.filter("is_current").count() == 3
    day = datetime.date
    assert rows(after.filter("cliente_id = 'CLI-001'"), "ciudad", "valid_from", "valid_to", "is_current") == [
        ("Lima", day(2024, 1, 1), day(2024, 2, 29), False),
        ("Piura", day(2024, 3, 1), day(9999, 12, 31), True),
    ]
    assert rows(valid_on(after, "2024-02-15").filter("cliente_id = 'CLI-001'"), "ciudad") == [("Lima",)]
    assert_unique(after, "dim_sk")
    again = history.scd2_apply(after, batch, ["cliente_id"], tracked)
    assert rows(again) == rows(after)
    new_key = batch.limit(1).withColumn("cliente_id", F.lit("CLI-009"))
    assert history.scd2_apply(after, new_key, ["cliente_id"], tracked).count() == 6
    assert history.detect_changes(dim, new_key, ["cliente_id"], tracked, strict_reference=True).count() == 0
    with pytest.raises(Exception, match="several batch rows"):
        history.scd2_apply(dim, batch.unionByName(batch), ["cliente_id"], tracked).collect()


def test_product_catalogue_events(spark, rows):
    """20 inserts, 38 updates, 2 deletes leave 18 products."""
    events = [(f"E{i:03}", f"PRD-{i:03}", 100.0 + i, "INSERT", f"2024-01-01T00:{i:02}:00") for i in range(1, 21)]
    events += [(f"E{20 + i:03}", f"PRD-{1 + i % 10:03}", 200.0 + i, "UPDATE", f"2024-01-02T00:{i:02}:00") for i in range(38)]
    events[-8] = ("E050", "PRD-001", 4199.0, "UPDATE", "2024-01-05T00:00:00")
    events += [(f"E{59 + i}", key, None, "DELETE", "2024-01-03T00:00:00") for i, key in enumerate(["PRD-011", "PRD-016"])]
    df = spark.createDataFrame(events, "evento_id STRING, producto_id STRING, precio DOUBLE, operation STRING, event_ts STRING")
    df = df.withColumn("event_ts", F.to_timestamp("event_ts"))
    args = dict(keys=["producto_id"], sequence_by="event_ts", delete_when="operation = 'DELETE'",
                except_columns=["evento_id", "operation", "event_ts"])
    one = history.scd1(df, **args)
    assert df.count() == 60 and one.count() == 18
    assert rows(one.filter("producto_id = 'PRD-001'"), "precio") == [(4199.0,)]
    two = history.scd2(df, **args)
    assert two.count() > 18
    assert rows(history.scd2_current(two), "producto_id", "precio") == rows(one, "producto_id", "precio")
    assert rows(history.deleted_keys(two, ["producto_id"]), "producto_id") == [("PRD-011",), ("PRD-016",)]


def test_retail_layers(spark, rows):
    base = ("2024-01-01", "T1", "C1", "p", " ropa ", 2, 50.0, 10.0, 90.0, "efectivo")
    raw = [(f"R{i}", *base, "completado") for i in range(33)] + [("R90", *base, "devuelto"), (None, *base, "completado")]
    df = spark.createDataFrame([(r[0], datetime.date.fromisoformat(r[1]), *r[2:]) for r in raw], schemas.RETAIL)
    bronze = retail.bronze(df, "s1", "x.csv")
    silver = retail.silver(bronze)
    assert bronze.count() == 35 and silver.count() == 33
    assert {"bronze_ts"} <= set(silver.columns) and "_source_file" not in silver.columns
    assert rows(silver.limit(1), "categoria", "tiene_descuento", "monto_descuento") == [("ROPA", True, 10.0)]
    gold = retail.gold(silver)
    assert rows(gold, "num_transacciones", "ingresos_total", "unidades_vendidas") == [(33, 2970.0, 66)]


def test_kpi_job(spark, rows):
    def line(i, month, amount, country="PE"):
        return (f"V{i}", 2024, 1, month, "Electronica", "TV", "Norte", country, "web", "A", f"C{i % 2}", "T1", 1, str(amount), "0.1", str(amount), str(amount), "1", str(amount / 4))

    names = ("venta_id anio trimestre mes categoria subcategoria region pais canal_venta segmento_cliente cliente_id "
             "tienda_id unidades precio_unitario descuento_pct monto_bruto monto_neto costo_unitario margen_bruto").split()
    raw = spark.createDataFrame([line(1, 1, 100.0), line(2, 1, 300.0), line(3, 2, 500.0), line(4, 2, 0.0, None)], names)
    gold = kpi.analytic(kpi.sales_kpi(kpi.typed_silver(raw)))
    got = {(r["mes"], r["pais"]): r for r in gold.collect()}
    first, second, free = got[1, "PE"], got[2, "PE"], got[2, None]
    assert (first["total_transacciones"], first["clientes_unicos"], str(first["margen_pct"])) == (2, 2, "25.00")
    assert (str(second["venta_neta_ytd"]), str(free["venta_neta_ytd"])) == ("900.00", "900.00")
    assert float(second["variacion_mes_pct"]) == 25.0 and first["variacion_mes_pct"] is None
    assert free["margen_pct"] is None  # zero base
    assert (second["rank_categoria_region_mes"], free["rank_categoria_region_mes"]) == (1, 2)
    # A NULL dimension is part of the key: nothing is inserted twice.
    redone = gold.withColumn("venta_neta", (F.col("venta_neta") * 2).cast("decimal(18,2)"))
    merged = kpi.merge_recalculated(gold, redone)
    assert merged.count() == 3 and float(merged.agg(F.sum("venta_neta")).first()[0]) == 1800.0
    view = kpi.bi_view(merged)
    assert "Venta_Neta_USD" in view.columns and "dw_updated_at" not in view.columns


def test_two_rounds_of_subscription_changes(spark, tmp_path, rows):
    def sub(i, plan, state, country, channel="Web"):
        return (f"S{i}", f"U{i}", plan, state, None, None, channel, country)

    v0 = spark.createDataFrame(
        [sub(1, "Básico", "Activo", "Perú", "Referido"), sub(2, "Premium", "Activo", "Perú"), sub(3, "Básico", "Cancelado", "Chile"),
         sub(4, "Estándar", "Cancelado", "México"), sub(5, "Premium", "Suspendido", "México"), sub(6, "Premium", "Activo", "Colombia")],
        schemas.SUBSCRIPTIONS).withColumn("monto_mensual", F.lit("100.00").cast("decimal(8,2)"))
    v1 = update_where(v0, "plan = 'Básico' AND canal_adquisicion = 'Referido'", {"plan": F.lit("Premium"), "monto_mensual": "199.99"})
    v2 = update_where(v1, "pais = 'Perú' AND estado = 'Activo'", {"estado": F.lit("Suspendido")})
    v3 = delete_where(v2, "estado = 'Cancelado' AND pais = 'Chile'")
    v4 = update_where(v3, "plan = 'Premium' AND pais = 'Colombia'", {"monto_mensual": "round(monto_mensual * 1.10, 2)"})
    v5 = update_where(v4, "pais = 'México' AND estado = 'Suspendido'", {"estado": F.lit("Activo")})
    v6 = delete_where(v5, "plan = 'Estándar' AND estado = 'Cancelado'")
    versions = [v0, v1, v2, v3, v4, v5, v6]
    path, target, progress = (str(tmp_path / n) for n in ("feed", "silver", "progress"))
    keys = ["suscripcion_id"]

    def commit(lo, hi):
        for v in range(lo, hi + 1):
            change = feed.initial_feed(v0) if v == 0 else feed.change_feed(versions[v - 1], versions[v], keys, v)
            propagation.write_feed(change, path)

    def run():
        return propagation.propagate(spark, spark.read.parquet(path), target, progress, "subs", keys, buckets=4)

    commit(0, 3)
    assert run() == 3 and run() is None  # nothing new the second time
    commit(4, 6)
    assert run() == 6 and read_progress(spark, progress, "subs") == 6
    silver = propagation.current_state(spark, target).select(*v6.columns)
    assert rows(silver) == rows(v6) and silver.count() == 4
    assert reconcile(v6, silver, ["plan", "estado"]).filter("NOT matches").count() == 0
    # Lost progress: all versions are applied once more.
    assert propagation.propagate(spark, spark.read.parquet(path), target, str(tmp_path / "p2"), "subs", keys, buckets=4) == 6
    assert rows(propagation.current_state(spark, target).select(*v6.columns)) == rows(v6)
    changes = spark.read.parquet(path)
    for v, state in enumerate(versions):
        assert rows(feed.as_of(changes, v, keys).select(*v0.columns)) == rows(state)
    kinds = rows(feed.feed_counts(feed.feed_range(changes, 1, 1)), "_change_type", "changes")
    assert kinds == [("update_postimage", 1), ("update_preimage", 1)]


def test_reviews(spark, rows):
    business = spark.createDataFrame(
        [("b1", "Bar", "x", "y", None, (None, "loud", None, "False"), 1, 3, 4.5)],
        "business_id STRING, name STRING, address STRING, city STRING, hours STRING, "
        "attributes STRUCT<WiFi: STRING, NoiseLevel: STRING, DogsAllowed: STRING, Open24Hours: STRING>, "
        "is_open INT, review_count INT, stars DOUBLE")
    review = spark.createDataFrame(
        [(f"r{s}", "b1", "u", "2024-01-01", "t", float(s)) for s in range(1, 6)] + [("rx", "zz", "u", "d", "t", 1.0)],
        "review_id STRING, business_id STRING, user_id STRING, date STRING, text STRING, stars DOUBLE")
    got = reviews.feedback(reviews.silver_business(business), reviews.silver_review(review))
    assert rows(got, "review_id", "review_sentiment", "dogsallowed") == [
        ("r1", "very negative", "False"), ("r2", "negative", "False"), ("r3", "neutral", "False"),
        ("r4", "positive", "False"), ("r5", "very positive", "False")]


def test_reports(spark, rows):
    sold = spark.createDataFrame([("a", 2, 10.0, datetime.date(2024, 2, 29)), ("a", 1, 5.0, datetime.date(2024, 3, 1)),
                                  ("b", 1, 7.0, datetime.date(2024, 2, 1))], "categoria STRING, cantidad INT, precio_unitario DOUBLE, f DATE")
    assert rows(reports.revenue_by_category(sold)) == [("a", 25.0), ("b", 7.0)]
    assert reports.in_month(sold, "f", "2024-02-01").count() == 2
    staff = spark.createDataFrame([("x", 10.0), ("y", 30.0)], "nombre STRING, salario DOUBLE")
    assert rows(reports.top_earner(staff), "nombre") == [("y",)]


def test_propagation_rewrites_only_touched_buckets(spark, tmp_path, rows):
    path, target, progress = (str(tmp_path / n) for n in ("feed", "silver", "progress"))
    v0 = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    v1 = delete_where(update_where(v0, "k = 7", {"v": F.lit("b")}), "k = 8")
    v2 = delete_where(v1, "k < 50")

    def run(changes):
        propagation.write_feed(changes, path)
        before = files()
        propagation.propagate(spark, spark.read.parquet(path), target, progress, "p", ["k"], buckets=16)
        return sum(before[b] != now for b, now in files().items() if b in before)

    def files():
        return {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "silver").glob("_bucket=*")}

    run(feed.initial_feed(v0))
    assert run(feed.change_feed(v0, v1, ["k"], 1)) <= 2
    assert rows(propagation.current_state(spark, target)) == rows(v1)
    run(feed.change_feed(v1, v2, ["k"], 2))  # every bucket is emptied
    assert propagation.current_state(spark, target).count() == 0
    run(feed.change_feed(v2, v1, ["k"], 3))  # and filled again
    assert rows(propagation.current_state(spark, target)) == rows(v1)
