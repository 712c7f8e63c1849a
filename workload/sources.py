"""Snapshots, extracts, sinks, catalogue, layer metrics."""

from __future__ import annotations

import uuid

from litmark import fixed_values as V
from litmark.operators.runs import layer_metrics as metrics_of_layers
from litmark.plans import medallion as M
from litmark.session import scratch_folder
from litmark.sources import catalog, lines, sinks
from litmark.sources import snapshots as S
from pyspark.sql import functions as F
from workload import fixtures as X
from workload.gold import AFTER, BEFORE, EVOLUTION_SQL, INDICATOR_SQL, TARGETS_SQL, comparison_sql, indicator_frame
from workload.quality import GOLD_SQL
from workload.registry import plain, query, table, view

ORDERS_YEARLY = "SELECT *, CAST(year(o_orderdate) AS INT) AS ano FROM {orders}"
COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _yearly(spark, folder):
    return view(spark, folder, ORDERS_YEARLY).drop("o_orderdate")


@query("SELECT * FROM customer")
def full_extract(spark, folder):
    return S.extract(spark, f"{folder}/customer.parquet")


@query(f"SELECT {COLUMNS}, ano FROM ({plain(ORDERS_YEARLY)}) WHERE ano = 1997")
def year_extract(spark, folder):
    return S.extract_year(_yearly(spark, folder), 1997)


@query(f"SELECT {COLUMNS}, ano FROM ({plain(ORDERS_YEARLY)}) WHERE ano = 1998")
def year_extract_sql(spark, folder):
    return S.query_year(spark, _yearly(spark, folder), 1998)


@query(f"SELECT {COLUMNS} FROM orders WHERE o_orderstatus <> 'O'")
def latest_snapshot(spark, folder):
    """Three dated snapshots, the second one rewritten on the same day; the newest is read."""
    root = scratch_folder(spark, "snapshots")
    orders = table(spark, folder, "orders").drop("o_orderdate")
    for date, rows in [
        ("2026-01-31", orders),
        ("2026-02-01", orders.where("o_orderstatus = 'F'")),
        ("2026-02-01", orders.where("o_orderstatus <> 'O'")),
        ("2025-12-31", orders.where("o_orderstatus = 'P'")),
    ]:
        S.write_snapshot(rows, root, date)
    return S.read_latest(spark, root)


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN ano >= 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority, ano
    FROM ({plain(ORDERS_YEARLY)})"""
)
def latest_per_year(spark, folder):
    """A second snapshot of the later years only; each year is read from its own newest snapshot."""
    root = scratch_folder(spark, "snapshots")
    orders = _yearly(spark, folder)
    S.write_yearly_snapshot(orders, root, "2026-01-01")
    later = orders.where("ano >= 1998").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    S.write_yearly_snapshot(later, root, "2026-01-02")
    S.write_yearly_snapshot(later, root, "2026-01-02")
    return S.read_latest_per(spark, root)


@query(
    """SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderstatus FROM orders WHERE o_orderpriority < '3'
    UNION ALL SELECT o_orderkey, NULL::DOUBLE, o_orderstatus FROM orders WHERE o_orderpriority >= '3'"""
)
def union_by_name(spark, folder):
    """Files with different columns, united by name."""
    root = scratch_folder(spark, "uniao")
    orders = table(spark, folder, "orders")
    first = orders.where("o_orderpriority < '3'").select("o_orderkey", "o_totalprice")
    second = orders.where("o_orderpriority >= '3'").select("o_orderstatus", "o_orderkey")
    S.write_snapshot(first, root, "2026-01-01")
    S.write_snapshot(second, root, "2026-01-02")
    return S.read_by_name(spark, root)


@query(
    """SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS c_name FROM orders
    UNION ALL SELECT NULL, NULL, c_name FROM customer"""
)
def union_frames(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return S.union_by_name(orders, table(spark, folder, "customer").select("c_name"))


@query("SELECT count(*) AS linhas, TRUE AS limitadas FROM orders")
def bounded_files(spark, folder):
    """A snapshot in files of bounded row count; the counts come from the file footers."""
    root = scratch_folder(spark, "partes")
    S.write_snapshot(table(spark, folder, "orders"), root, "2026-01-01", rows_per_file=5_000)
    counted = lines.count_parquet_rows(spark, root)
    return counted.agg(F.sum("registros").alias("linhas"), (F.max("registros") <= 5_000).alias("limitadas"))


@query(
    """SELECT 'parquet' AS tipo, count(*) AS registros FROM orders UNION ALL SELECT 'json', count(*) FROM customer
    UNION ALL SELECT 'csv', count(*) FROM part"""
)
def rows_by_file_type(spark, folder):
    root = scratch_folder(spark, "arquivos")
    sinks.write_counted(table(spark, folder, "orders"), f"{root}/parquet")
    table(spark, folder, "customer").write.json(f"{root}/json")
    table(spark, folder, "part").write.option("header", True).csv(f"{root}/csv")
    kind = F.regexp_extract("arquivo", "/(parquet|json|csv)/", 1)
    counted = lines.count_rows_by_file(spark, root).groupBy(kind.alias("tipo"))
    return counted.agg(F.sum("registros").alias("registros"))


def _medallion(spark, folder):
    """Bronze to Gold over the fixtures, in a new folder."""
    layers = M.Layers(scratch_folder(spark, "camadas"))
    M.ingest_table(view(spark, folder, X.RESULTS), layers, V.SILVER_RESULTS, "2026-01-01")
    M.ingest_table(view(spark, folder, X.TARGETS_WIDE), layers, V.SILVER_TARGETS, "2026-01-01")
    for name in (V.SILVER_RESULTS, V.SILVER_TARGETS):
        M.refine_table(spark, layers, name, "2026-01-02")
    M.build_gold(spark, layers, "2026-01-03", (BEFORE, AFTER))
    return layers


@query(GOLD_SQL)
def medallion_gold_report(spark, folder):
    """The Gold checks over tables written and read back layer by layer."""
    return M.check_gold(spark, _medallion(spark, folder))


_rows = {
    "bronze": f"(SELECT count(*) FROM ({plain(X.RESULTS)})) + (SELECT count(*) FROM ({plain(X.TARGETS_WIDE)}))",
    "silver": f"(SELECT count(*) FROM (SELECT DISTINCT * FROM ({plain(X.RESULTS)}))) "
    f"+ (SELECT count(*) FROM (SELECT DISTINCT * FROM ({plain(X.TARGETS_WIDE)})))",
    "gold": f"(SELECT count(*) FROM ({INDICATOR_SQL})) + (SELECT count(*) FROM ({TARGETS_SQL})) "
    f"+ (SELECT count(*) FROM ({comparison_sql()})) + (SELECT count(*) FROM ({EVOLUTION_SQL}))",
    "ausente": "0",
}


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS camada, CAST({rows} AS BIGINT) AS registros, {str(n != 'ausente').upper()} AS tem_arquivos"
    for n, rows in _rows.items()
))
def layer_metrics(spark, folder):
    layers = _medallion(spark, folder)
    counted = metrics_of_layers(spark, layers.root, list(_rows))
    full = (F.col("arquivos") > 0) & (F.col("bytes") > 0)
    refused = F.raise_error(F.concat(F.lit("files that could not be read in layer "), "camada")).cast("long")
    rows = F.when(F.col("ilegiveis") == 0, F.col("registros")).otherwise(refused)
    return counted.select("camada", rows.alias("registros"), full.alias("tem_arquivos"))


def _load(spark, folder):
    database = f"litmark_{uuid.uuid4().hex}"
    frames = {
        "indicador": indicator_frame(spark, folder),
        "pedidos": _yearly(spark, folder),
    }
    M.load_layer(
        frames,
        database,
        "gold",
        descriptions={"indicador": "Indicador por município", "pedidos": "Pedidos de 'teste'"},
        clustering={"indicador": V.GOLD_CLUSTERING},
        labels={"ambiente": "teste", catalog.RETENTION_PROPERTY: "5184000000"},
        location=scratch_folder(spark, database),
    )
    return database


@query(f"SELECT * FROM ({INDICATOR_SQL})")
def clustered_load(spark, folder):
    """A table loaded in clustered order, reconciled with its source, and read from the catalogue."""
    return spark.table(f"{_load(spark, folder)}.indicador")


@query(
    f"""SELECT 'indicador' AS tabela, 'MANAGED' AS tipo, (SELECT count(*) FROM ({INDICATOR_SQL})) AS linhas, FALSE AS particionada,
    'id_uf, codigo_rede' AS clusterizacao, TRUE AS tem_bytes, 60::DOUBLE AS expiracao_padrao_dataset_dias
    UNION ALL SELECT 'pedidos', 'MANAGED', (SELECT count(*) FROM orders), FALSE, 'Não', TRUE, 60::DOUBLE
    UNION ALL SELECT 'por_ano', 'MANAGED', (SELECT count(*) FROM orders), TRUE, 'Não', TRUE, 60::DOUBLE"""
)
def table_inventory(spark, folder):
    database = _load(spark, folder)
    catalog.load_table(_yearly(spark, folder), f"{database}.por_ano", partitioning=["ano"])
    catalog.refresh_statistics(spark, database)
    size = F.col("bytes_ativos") + F.col("bytes_longo_prazo")
    return catalog.inventory(spark, [database]).select(
        "tabela",
        "tipo",
        "linhas",
        "particionada",
        "clusterizacao",
        ((F.col("bytes_totais") > 0) & (size == F.col("bytes_totais"))).alias("tem_bytes"),
        "expiracao_padrao_dataset_dias",
    )


@query(
    """SELECT 'indicador' AS objeto, 'OK' AS situacao, (SELECT count(*) FROM orders) AS linhas
    UNION ALL SELECT 'ausente', 'NÃO ENCONTRADA', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'pedidos', 'OK', (SELECT count(*) FROM orders)"""
)
def expected_objects(spark, folder):
    database = _load(spark, folder)
    loaded = spark.table(f"{database}.pedidos").count()
    listed = catalog.expected_objects(
        spark, ["indicador", "ausente", "pedidos"], catalog.tables_of(spark, database), "tableName"
    )
    return listed.withColumn("linhas", F.lit(loaded).cast("long"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_file_load(spark, folder):
    """JSON line files loaded strictly into a table and reconciled; an absent source is skipped."""
    root = scratch_folder(spark, "linhas")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_json_lines(customers, f"{root}/in")
    database = f"litmark_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, location=f"{root}/db")
    assert not M.load_json_files(spark, f"{root}/ausente", customers.schema, "*", f"{database}.ausente")
    M.load_json_files(spark, f"{root}/in", customers.schema, "part-*", f"{database}.clientes")
    return spark.table(f"{database}.clientes")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) IN (1997, 1998)")
def pattern_scan(spark, folder):
    """Files found by a path pattern over year and date folders."""
    root = scratch_folder(spark, "padrao")
    S.write_yearly_snapshot(_yearly(spark, folder), root, "2026-01-01")
    return S.read_by_name(spark, f"{root}/ano=199[78]/data_ingestao=*").select("o_orderkey", "o_totalprice")


@query("SELECT 'pedidos' AS tabela, count(*) AS na_origem, count(*) AS carregadas, count(*) + 1 AS apos_recarga FROM orders")
def load_counts(spark, folder):
    """Rows of the source, rows loaded, and rows after the table is replaced."""
    database = f"litmark_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, location=scratch_folder(spark, database))
    orders = table(spark, folder, "orders").drop("o_orderdate")
    loaded = catalog.load_table(orders, f"{database}.pedidos", ["o_orderstatus"])
    more = orders.unionAll(orders.agg(*[F.max(c).alias(c) for c in orders.columns]))
    again = catalog.load_table(more, f"{database}.pedidos", ["o_orderstatus"])
    return orders.agg(F.lit("pedidos").alias("tabela"), F.count("*").alias("na_origem")).select(
        "*", F.lit(loaded).cast("long").alias("carregadas"), F.lit(again).cast("long").alias("apos_recarga")
    )


@query(
    f"""SELECT 'indicador' AS tabela, 'Indicador por município' AS comentario, 'gold' AS camada, 'teste' AS ambiente,
    (SELECT count(*) FROM ({INDICATOR_SQL})) AS linhas
    UNION ALL SELECT 'pedidos', 'Pedidos de ''teste''', 'gold', 'teste', (SELECT count(*) FROM orders)"""
)
def table_notes(spark, folder):
    """Comment and labels of loaded tables, read back from the catalogue."""
    database = _load(spark, folder)
    noted = []
    for name in ("indicador", "pedidos"):
        properties = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect()}
        comment = spark.catalog.getTable(f"{database}.{name}").description
        noted.append((name, comment, properties["camada"], properties["ambiente"], spark.table(f"{database}.{name}").count()))
    return spark.createDataFrame(noted, "tabela string, comentario string, camada string, ambiente string, linhas long")


@query(
    f"""SELECT 'indicador' AS tabela, 'MANAGED' AS tipo, CAST((SELECT count(*) FROM ({INDICATOR_SQL})) AS VARCHAR) AS linhas,
    'false' AS particionada, 'id_uf, codigo_rede' AS clusterizacao, '60.0' AS expiracao_padrao_dataset_dias, TRUE AS tem_bytes
    UNION ALL SELECT 'pedidos', 'MANAGED', CAST((SELECT count(*) FROM orders) AS VARCHAR), 'false', 'Não', '60.0', TRUE"""
)
def inventory_report(spark, folder):
    """The inventory of a loaded database, written as a report and read back as text."""
    path = scratch_folder(spark, "inventario")
    sinks.write_csv_report(catalog.inventory(spark, [_load(spark, folder)]), path)
    report = spark.read.option("header", True).csv(path)
    return report.select(
        "tabela", "tipo", "linhas", "particionada", "clusterizacao", "expiracao_padrao_dataset_dias",
        (F.col("bytes_totais").cast("long") > 0).alias("tem_bytes"),
    )
