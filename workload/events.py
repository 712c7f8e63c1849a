"""Change events: encode, parse, validate, keep last, idempotent storage, stream."""

from __future__ import annotations

from litmark import fixed_values as V
from litmark.session import scratch_folder
from litmark.sources.lines import read_numbered_lines, read_strict_json
from litmark.sources.sinks import write_json_lines
from litmark.streaming import consumer as K
from litmark.streaming import events as E
from pyspark.sql import functions as F
from pyspark.sql import types as T
from workload import fixtures as X
from workload.gold import INDICATOR_SQL, indicator_frame
from workload.registry import plain, query, table, view

EVENT_JSON = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp_utc", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("ano", T.IntegerType()),
                    T.StructField("id_municipio", T.StringType()),
                    T.StructField("id_uf", T.StringType()),
                    T.StructField("codigo_rede", T.IntegerType()),
                    T.StructField("rede", T.StringType()),
                    T.StructField("taxa_alfabetizacao_anterior", T.DoubleType()),
                    T.StructField("taxa_alfabetizacao_atualizada", T.DoubleType()),
                    T.StructField("variacao_pp", T.DoubleType()),
                ]
            ),
        ),
    ]
)


def event_lines(spark, folder):
    """The events as lines: ``linha``, ``grupo`` and the text, some of it broken or blank."""
    e = view(spark, folder, X.EVENTS)
    payload = F.struct(
        "ano",
        "id_municipio",
        "id_uf",
        "codigo_rede",
        "rede",
        F.col("anterior").alias("taxa_alfabetizacao_anterior"),
        F.col("atualizada").alias("taxa_alfabetizacao_atualizada"),
        F.col("variacao").alias("variacao_pp"),
    )
    moment = F.when(F.col("sem_data") == 1, "12/07/2026").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
    head = [
        F.col("chave").alias("event_id"),
        F.col("tipo").alias("event_type"),
        moment.alias("event_timestamp_utc"),
        F.col("versao").alias("schema_version"),
        F.col("fonte").alias("source"),
    ]
    text = (
        F.when(F.col("forma") == "quebrada", "{bad")
        .when(F.col("forma") == "vazia", "  ")
        .when(F.col("forma") == "sem payload", F.to_json(F.struct(*head, F.lit("x").alias("payload"))))
        .otherwise(F.to_json(F.struct(*head, payload.alias("payload"))))
    )
    return e.select("linha", "grupo", text.alias("value"))


def parsed_events(spark, folder):
    """The lines as one file, numbered from 1."""
    lines = event_lines(spark, folder).select(
        F.lit("eventos.jsonl").alias("arquivo_origem"),
        (F.col("linha") + 1).alias("numero_linha_origem"),
        "grupo",
        "value",
    )
    return E.parse_events(lines)


def _problem_sql() -> str:
    rules = [
        ("forma = 'quebrada'", V.EVENT_NOT_OBJECT),
        ("trim(chave) = ''", V.EVENT_FIELD_EMPTY.format(field="event_id")),
        ("tipo <> 'indicador_alfabetizacao_atualizado'", V.EVENT_WRONG_TYPE + "outro."),
        ("versao <> '1.0'", V.EVENT_WRONG_VERSION + "2.0."),
        ("sem_data = 1", V.EVENT_BAD_TIMESTAMP),
        ("forma = 'sem payload'", V.EVENT_BAD_PAYLOAD),
        ("ano NOT IN (2023, 2024)", None),
        ("codigo_rede > 6", V.EVENT_BAD_NETWORK + "7."),
        ("NOT starts_with(id_municipio, id_uf)", V.EVENT_BAD_PREFIX),
        ("anterior < 0 OR anterior > 100", V.EVENT_OUT_OF_RANGE.format(field="taxa_alfabetizacao_anterior")),
        ("atualizada < 0 OR atualizada > 100", V.EVENT_OUT_OF_RANGE.format(field="taxa_alfabetizacao_atualizada")),
        (
            "abs(round(variacao, 2) - round(round(atualizada, 2) - round(anterior, 2), 2)) > 0.01::DOUBLE",
            V.EVENT_WRONG_VARIATION,
        ),
        ("trim(fonte) = ''", V.EVENT_FIELD_EMPTY.format(field="source")),
    ]
    year = f"'{V.EVENT_BAD_YEAR}' || CAST(ano AS VARCHAR) || '.'"
    cases = []
    for test, text in rules:
        quoted = year if text is None else "'" + text.replace("'", "''") + "'"
        cases.append(f"WHEN {test} THEN {quoted}")
    return f"CASE {' '.join(cases)} END"


PARSED_SQL = f"""
SELECT linha + 1 AS numero_linha_origem, grupo, chave AS event_id, tipo AS event_type, epoch_us(ts) AS micros,
  versao AS schema_version, trim(fonte) AS source, ano, id_municipio, id_uf, codigo_rede, rede,
  round(anterior, 2) AS taxa_alfabetizacao_anterior, round(atualizada, 2) AS taxa_alfabetizacao_atualizada,
  round(round(atualizada, 2) - round(anterior, 2), 2) AS variacao_pp, {_problem_sql()} AS erro
FROM ({plain(X.EVENTS)}) WHERE forma <> 'vazia'
"""
STORED = "event_id event_type micros schema_version source ano id_municipio id_uf codigo_rede rede taxa_alfabetizacao_anterior taxa_alfabetizacao_atualizada variacao_pp".split()
STORED_SQL = ", ".join(STORED)


def _comparable(events, *more):
    return events.withColumn("micros", F.unix_micros("event_timestamp_utc")).select(*STORED, *more)


@query(f"""SELECT ano, id_municipio, id_uf, codigo_rede, rede, taxa_alfabetizacao AS anterior,
  round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, taxa_alfabetizacao + round(media_portugues / 100 - 4, 2))), 2) AS atualizada,
  round(round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, taxa_alfabetizacao + round(media_portugues / 100 - 4, 2))), 2)
    - taxa_alfabetizacao, 2) AS variacao,
  'indicador_alfabetizacao_atualizado' AS event_type, '1.0' AS schema_version
FROM ({INDICATOR_SQL}) WHERE taxa_alfabetizacao IS NOT NULL""")
def event_encode(spark, folder):
    base = indicator_frame(spark, folder)
    change = F.col("media_portugues") / 100 - 4
    lines = E.to_lines(
        E.encode_events(
            base.select(*E.BASE_COLUMNS, "media_portugues").na.drop(subset=E.BASE_REQUIRED),
            change,
            event_id=F.md5(F.concat_ws("|", "id_municipio", "ano")),
        )
    )
    event = F.from_json("value", EVENT_JSON)
    return lines.select(event.alias("e")).select(
        *[F.col(f"e.payload.{c}") for c in ("ano", "id_municipio", "id_uf", "codigo_rede", "rede")],
        F.col("e.payload.taxa_alfabetizacao_anterior").alias("anterior"),
        F.col("e.payload.taxa_alfabetizacao_atualizada").alias("atualizada"),
        F.col("e.payload.variacao_pp").alias("variacao"),
        "e.event_type",
        "e.schema_version",
    )


@query(f"SELECT ano, id_municipio, id_uf, codigo_rede, rede, taxa_alfabetizacao FROM ({INDICATOR_SQL}) "
       "WHERE taxa_alfabetizacao IS NOT NULL")  # fmt: skip
def event_base(spark, folder):
    return E.event_base(indicator_frame(spark, folder))


@query(f"SELECT {STORED_SQL}, numero_linha_origem FROM ({PARSED_SQL}) WHERE erro IS NULL")
def event_valid(spark, folder):
    return _comparable(E.valid_events(parsed_events(spark, folder)), "numero_linha_origem")


@query(
    f"""SELECT 'eventos.jsonl' AS arquivo_origem, numero_linha_origem,
    'eventos.jsonl, linha ' || CAST(numero_linha_origem AS VARCHAR) || ': ' || erro AS mensagem
    FROM ({PARSED_SQL}) WHERE erro IS NOT NULL"""
)
def event_errors(spark, folder):
    return E.invalid_events(parsed_events(spark, folder))


KEPT_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY numero_linha_origem DESC) AS n
  FROM ({PARSED_SQL}) WHERE erro IS NULL) WHERE n = 1"""


@query(f"SELECT {STORED_SQL}, numero_linha_origem FROM ({KEPT_SQL})")
def event_keep_last(spark, folder):
    return _comparable(K.keep_last(E.valid_events(parsed_events(spark, folder))), "numero_linha_origem")


# Two batches: first the events of three groups, then all of them again.
FIRST_GROUPS = ["view", "click", "error"]
_first = "grupo IN ('view', 'click', 'error')"
MERGED_SQL = f"""
WITH validos AS ({PARSED_SQL}),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY numero_linha_origem DESC) AS n
  FROM validos WHERE erro IS NULL AND {_first}) WHERE n = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY numero_linha_origem DESC) AS n
  FROM validos WHERE erro IS NULL) WHERE n = 1)
SELECT {STORED_SQL} FROM a
UNION ALL SELECT {STORED_SQL} FROM b WHERE event_id NOT IN (SELECT event_id FROM a)
"""


@query(MERGED_SQL)
def event_idempotent(spark, folder):
    parsed = parsed_events(spark, folder)
    events = E.valid_events(parsed, "grupo")
    return _comparable(K.merge_batches(events, F.col("grupo").isin(FIRST_GROUPS)))


@query(
    f"""WITH validos AS ({PARSED_SQL}), a AS (SELECT DISTINCT event_id FROM validos WHERE erro IS NULL AND {_first}),
    t AS (SELECT count(*) FILTER (WHERE erro IS NULL) AS validos, count(*) FILTER (WHERE erro IS NOT NULL) AS invalidos,
      count(DISTINCT event_id) FILTER (WHERE erro IS NULL) AS unicos FROM validos)
    SELECT validos, invalidos, validos - unicos AS duplicados_no_lote, (SELECT count(*) FROM a) AS ja_processados,
      unicos - (SELECT count(*) FROM a) AS novos FROM t"""
)
def event_counters(spark, folder):
    return K.counters(parsed_events(spark, folder), F.col("grupo").isin(FIRST_GROUPS))


def _write_lines(lines, path):
    """Line files in event order: file names and line numbers follow ``linha``."""
    ordered = lines.repartitionByRange("linha").sortWithinPartitions("linha")
    ordered.select("value").write.mode("append").text(path)


@query(MERGED_SQL)
def event_stream(spark, folder):
    """Two runs of the stream over a folder that gets a second load of files in between."""
    root = scratch_folder(spark, "eventos")
    store = K.EventStore(f"{root}/silver")
    lines = event_lines(spark, folder)
    for part in (lines.where(F.col("grupo").isin(FIRST_GROUPS)), lines):
        _write_lines(part, f"{root}/bronze")
        K.start_stream(spark, f"{root}/bronze", store, f"{root}/checkpoint").awaitTermination()
    return _comparable(K.stored_events(spark, store))


@query(
    f"""SELECT 'validos' AS contador, count(*) FILTER (WHERE erro IS NULL) AS total FROM ({PARSED_SQL})
    UNION ALL SELECT 'invalidos', count(*) FILTER (WHERE erro IS NOT NULL) FROM ({PARSED_SQL})
    UNION ALL SELECT 'novos', count(DISTINCT event_id) FILTER (WHERE erro IS NULL) FROM ({PARSED_SQL})
    UNION ALL SELECT 'novos na repetição', 0
    UNION ALL SELECT 'rejeitados', count(*) FILTER (WHERE erro IS NOT NULL) FROM ({PARSED_SQL})"""
)
def event_replay(spark, folder):
    """Batch mode run twice over the same files: the second run finds nothing new."""
    root = scratch_folder(spark, "eventos")
    store = K.EventStore(f"{root}/silver")
    _write_lines(event_lines(spark, folder), f"{root}/bronze")
    first = K.replay_all(spark, f"{root}/bronze", store, "1")
    again = K.replay_all(spark, f"{root}/bronze", store, "2")
    counted = spark.read.parquet(store.counters).where(F.col(K.BATCH).cast("string") == "1")
    rejected = spark.read.parquet(store.rejected).where(F.col(K.BATCH).cast("string") == "1")
    assert counted.first()["validos"] == first["validos"]
    named = counted.select(F.explode(F.create_map(*[x for c in ("validos", "invalidos", "novos") for x in (F.lit(c), F.col(c))])))
    repeated = counted.select(F.lit("novos na repetição"), F.lit(again["novos"]).cast("long"))
    return (
        named.toDF("contador", "total")
        .unionAll(repeated)
        .unionAll(rejected.agg(F.lit("rejeitados"), F.count("*")))
    )


@query("SELECT event_id AS linha, CAST(0 AS BIGINT) AS desvio FROM events WHERE event_id % 70 <> 10")
def event_line_numbers(spark, folder):
    """Line numbers of files written in event order: each line stands where its event id says it must."""
    root = scratch_folder(spark, "linhas")
    e = view(spark, folder, X.EVENTS)
    line = F.when(F.col("forma") == "vazia", " ").otherwise(F.col("linha").cast("string"))
    _write_lines(e.select("linha", line.alias("value")), root)
    numbered = read_numbered_lines(spark, root).select(
        "arquivo", F.col("value").cast("long").alias("linha"), "numero_linha_origem"
    )
    first = numbered.groupBy("arquivo").agg(F.min(F.col("linha") - F.col("numero_linha_origem")).alias("_base"))
    return numbered.join(first, "arquivo").select(
        "linha", (F.col("linha") - F.col("numero_linha_origem") - F.col("_base")).alias("desvio")
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def strict_json(spark, folder):
    root = scratch_folder(spark, "json")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    write_json_lines(orders, root)
    return read_strict_json(spark, root, orders.schema)



@query(
    f"""SELECT '01' AS lote, count(*) AS novos FROM ({KEPT_SQL}) UNION ALL SELECT '1', 0 UNION ALL SELECT '2026-01-01', 0
    UNION ALL SELECT 'fluxo', 0 UNION ALL SELECT 'total', count(DISTINCT event_id) FROM ({KEPT_SQL})"""
)
def event_batch_names(spark, folder):
    """Replays named like numbers and dates, and a stream, on one store: the first one stores every key, the others none."""
    root = scratch_folder(spark, "eventos")
    store = K.EventStore(f"{root}/silver")
    _write_lines(event_lines(spark, folder), f"{root}/bronze")
    new = {name: K.replay_all(spark, f"{root}/bronze", store, name)["novos"] for name in ("01", "1", "2026-01-01")}
    seen: list[dict[str, int]] = []
    K.start_stream(spark, f"{root}/bronze", store, f"{root}/checkpoint", after_batch=seen.append).awaitTermination()
    new["fluxo"] = sum(s["novos"] for s in seen)
    counted = spark.createDataFrame(list(new.items()), "lote string, novos long")
    return counted.unionAll(K.stored_events(spark, store).agg(F.lit("total"), F.count("*")))
