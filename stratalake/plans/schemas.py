"""Input contracts of the jobs: column names and types of the source files, as DDL. Fixed values."""

SALES_TRANSACTIONS = """transaction_id STRING, fecha STRING, cliente_id STRING, cliente_nombre STRING, region STRING,
producto_id STRING, producto_nombre STRING, categoria STRING, cantidad INT, precio_unitario DOUBLE,
descuento_pct DOUBLE, monto_total DOUBLE, canal STRING, estado STRING"""

SENSOR_EVENTS = """evento_id STRING, timestamp STRING, device_id STRING, device_name STRING, ubicacion STRING,
tipo_sensor STRING, fabricante STRING, lectura STRUCT<valor: DOUBLE, unidad: STRING, estado: STRING>,
bateria_pct INT, senial_rssi INT, firmware_version STRING, tags STRUCT<linea_produccion: STRING, turno: STRING>"""

ORDER_LOTS = """orden_id STRING, lote_proceso STRING, fecha_orden STRING, cliente_id STRING, cliente_nombre STRING,
ciudad_destino STRING, producto_sku STRING, producto_nombre STRING, categoria STRING, almacen_origen STRING,
cantidad INT, precio_unitario DOUBLE, descuento_pct INT, precio_final_unitario DOUBLE, total_linea DOUBLE,
canal_venta STRING, estado_orden STRING, dias_entrega_prometidos INT"""

INVENTORY = """producto_id STRING, sku STRING, nombre_producto STRING, categoria STRING, laboratorio STRING,
unidades_stock INT, precio_unitario DOUBLE, fecha_vencimiento DATE, lote STRING, almacen_id STRING"""

WAREHOUSES = """almacen_id STRING, nombre_almacen STRING, ciudad STRING, region STRING, tipo_almacen STRING,
temperatura_controlada STRING, capacidad_m3 INT"""

SALES_LINES = """orden_id STRING, linea_id INT, producto_id STRING, cliente_id STRING, cantidad INT,
precio_unitario DOUBLE, monto_total DOUBLE, fecha_venta STRING, canal STRING, estado STRING,
ingestion_timestamp STRING, source_file STRING"""

PRODUCTS = "producto_id STRING, nombre_producto STRING, categoria STRING, marca STRING"

CUSTOMERS = "cliente_id STRING, nombre STRING, ciudad STRING, segmento STRING, fecha_inicio STRING"

SUBSCRIPTIONS = """suscripcion_id STRING, usuario_id STRING, plan STRING, estado STRING, fecha_inicio DATE,
monto_mensual DECIMAL(8,2), canal_adquisicion STRING, pais STRING"""

CONTRACTS = """contrato_id STRING, proveedor_id STRING, proveedor_nombre STRING, categoria STRING,
monto_anual DECIMAL(12,2), moneda STRING, fecha_inicio DATE, fecha_vencimiento DATE, estado STRING,
responsable STRING"""

RETAIL = """order_id STRING, fecha DATE, tienda_id STRING, cliente_id STRING, producto STRING, categoria STRING,
cantidad INT, precio_unit DOUBLE, descuento_pct DOUBLE, total DOUBLE, metodo_pago STRING, estado STRING"""

EMPLOYEES = """empleado_id STRING, nombre STRING, apellido STRING, email STRING, telefono STRING,
departamento STRING, cargo STRING, salario DOUBLE, fecha_ingreso STRING, pais STRING"""

TRANSFERS = """transaccion_id STRING, cuenta_origen STRING, cuenta_destino STRING, monto DOUBLE,
tipo_transaccion STRING, fecha STRING, hora STRING, pais STRING, estado STRING"""

SALES_DETAIL = """venta_id STRING, fecha_venta STRING, cliente_id STRING, producto_id STRING, cantidad INT,
precio_unitario DOUBLE, descuento_pct DOUBLE, region STRING, canal STRING, estado_pedido STRING,
vendedor_id STRING"""

CATALOGUE = """producto_id STRING, nombre_producto STRING, categoria STRING, subcategoria STRING,
costo_unitario DOUBLE, precio_lista DOUBLE, proveedor STRING, activo STRING"""
