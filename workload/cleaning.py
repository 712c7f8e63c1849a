"""Cleaning, scalar expressions, predicates, duplicates, orphans."""

from __future__ import annotations

from litmark.fixed_values import SHORT_UNITS, WHITESPACE_CODEPOINTS
from litmark.functions import labels, numbers, text, times
from litmark.operators import cleaning as C
from litmark.operators import keys as K
from pyspark.sql import functions as F
from workload import fixtures as X
from workload.gold import label_sql
from workload.registry import plain, query, table, view

CHARS_SQL = " || ".join(f"chr({p})" for p in WHITESPACE_CODEPOINTS)


def clean_sql(column: str) -> str:
    stripped = f"trim({column}, {CHARS_SQL})"
    return f"CASE WHEN {stripped} NOT IN ('', 'nan', 'None', 'null') THEN {stripped} END"


def long_sql(column: str) -> str:
    value = f"TRY_CAST({column} AS DOUBLE)"
    return f"CASE WHEN {value} = floor({value}) THEN TRY_CAST({value} AS BIGINT) END"


STUDENT_TEXT = (
    "id_municipio id_escola id_aluno caderno serie rede presenca preenchimento_caderno alfabetizado".split()
)
STUDENTS_SQL = f"""
SELECT {long_sql("ano")} AS ano, {", ".join(f"{clean_sql(c)} AS {c}" for c in STUDENT_TEXT)},
  TRY_CAST(proficiencia AS DOUBLE) AS proficiencia, TRY_CAST(peso_aluno AS DOUBLE) AS peso_aluno
FROM ({plain(X.STUDENTS_RAW)})
"""

DOCUMENTS = """
SELECT doc_id, ' ' || chr(9) || text || chr(10) || ' 　' AS text,
  CASE WHEN doc_id % 4 = 0 THEN ' nan' WHEN doc_id % 4 = 1 THEN 'null ' WHEN doc_id % 4 = 2 THEN 'NaN' ELSE lang END AS lang,
  source FROM {documents}
"""


@query(
    """SELECT c_custkey AS chave_cliente, c_name AS nome_cliente, c_nationkey AS na_o, c_acctbal AS saldo_r,
    c_mktsegment AS segmento_mercado FROM customer"""
)
def rename_snake(spark, folder):
    odd = ["Chave Cliente", "  Nome/Cliente ", "Nação", "Saldo (R$)", "SEGMENTO__Mercado_"]
    return C.rename_columns(table(spark, folder, "customer").toDF(*odd))


@query("SELECT p_partkey AS chave, p_name AS nome, p_brand AS marca, p_size AS tamanho FROM part")
def rename_lower(spark, folder):
    odd = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return C.rename_columns(odd.toDF(" CHAVE", "Nome ", "MARCA", "tamanho"), text.lower_name)


@query(f"SELECT doc_id, {clean_sql('text')} AS text, {clean_sql('lang')} AS lang, source FROM ({plain(DOCUMENTS)})")
def clean_text(spark, folder):
    return C.clean_all_text(view(spark, folder, DOCUMENTS))


@query(
    f"""SELECT ano, {clean_sql("id_municipio")} AS id_municipio, id_escola, {clean_sql("presenca")} AS presenca
    FROM ({plain(X.STUDENTS_RAW)})"""
)
def clean_named_columns(spark, folder):
    raw = view(spark, folder, X.STUDENTS_RAW).select("ano", "id_municipio", "id_escola", "presenca")
    return C.clean_text(raw, ["id_municipio", "presenca", "coluna_ausente"])


@query(
    f"""SELECT id_aluno, {long_sql("ano")} AS ano, TRY_CAST(proficiencia AS DOUBLE) AS proficiencia,
    TRY_CAST(peso_aluno AS DOUBLE) AS peso_aluno FROM ({plain(X.STUDENTS_RAW)})"""
)
def coerce_numeric(spark, folder):
    raw = view(spark, folder, X.STUDENTS_RAW).select("id_aluno", "ano", "proficiencia", "peso_aluno")
    return C.coerce_numbers(raw, ["ano"], ["proficiencia", "peso_aluno"])


@query(f"SELECT DISTINCT * FROM ({STUDENTS_SQL})")
def silver_students(spark, folder):
    raw = view(spark, folder, X.STUDENTS_RAW)
    return C.clean_students(raw.toDF(*[f" {c.upper()}" for c in raw.columns]))


@query(
    f"""SELECT DISTINCT {clean_sql("text")} AS texto, {clean_sql("lang")} AS l_ngua, source AS fonte,
    'base_dos_dados' AS _fonte, 'bronze' AS _camada_origem FROM ({plain(DOCUMENTS)})"""
)
def silver_reference(spark, folder):
    raw = view(spark, folder, DOCUMENTS).drop("doc_id").toDF("Texto", " Língua", "FONTE")
    return C.add_lineage(C.clean_reference(raw)).drop("_processado_em_utc")


@query("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedup_rows(spark, folder):
    return C.drop_exact_duplicates(table(spark, folder, "documents").drop("doc_id"))


@query(f"SELECT ano, id_municipio, rede, taxa_alfabetizacao FROM ({plain(X.RESULTS)}) "
       "WHERE id_municipio IS NOT NULL AND taxa_alfabetizacao IS NOT NULL")  # fmt: skip
def drop_incomplete(spark, folder):
    rows = view(spark, folder, X.RESULTS).select("ano", "id_municipio", "rede", "taxa_alfabetizacao")
    return C.drop_incomplete(rows, ["ano", "id_municipio", "taxa_alfabetizacao"])


@query(f"SELECT p_partkey, CAST(p_size % 9 AS INTEGER) AS codigo, {label_sql('p_size % 9')} AS rotulo, "
       "substr(p_brand, 1, 2) AS prefixo FROM part")  # fmt: skip
def code_to_label(spark, folder):
    code = (F.col("p_size") % 9).cast("int")
    label, prefix = labels.network_label(code).alias("rotulo"), labels.state_of(F.col("p_brand")).alias("prefixo")
    return table(spark, folder, "part").select("p_partkey", code.alias("codigo"), label, prefix)


@query(
    """SELECT o_orderkey, round(o_totalprice / 7, 2) AS arredondado,
    least(100.0::DOUBLE, greatest(0.0::DOUBLE, o_totalprice / 1000 - 50)) AS limitado,
    abs(o_totalprice / 1000 - floor(o_totalprice / 1000)) > 0.01::DOUBLE AS difere FROM orders"""
)
def scalar_numbers(spark, folder):
    price = F.col("o_totalprice")
    thousands = price / 1000
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.round2(price / 7).alias("arredondado"),
        numbers.clamp(thousands - 50).alias("limitado"),
        numbers.differs(thousands, F.floor(thousands), 0.01).alias("difere"),
    )


def _sizes_sql(units: list[str]) -> str:
    cases = [
        f"WHEN tamanho / {float(1024**p)}::DOUBLE < 1024 THEN printf('%.2f {u}', tamanho / {float(1024**p)}::DOUBLE)"
        for p, u in enumerate(units[:-1])
    ]
    last = f"printf('%.2f {units[-1]}', tamanho / {float(1024 ** (len(units) - 1))}::DOUBLE)"
    return f"CASE {' '.join(cases)} ELSE {last} END"


SIZES = """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)
  * CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4096 ELSE 250000 END AS tamanho FROM {orders}"""


@query(
    f"""SELECT o_orderkey, {_sizes_sql(["B", "KiB", "MiB", "GiB", "TiB"])} AS binario,
    {_sizes_sql(SHORT_UNITS)} AS curto, tamanho / 1073741824::DOUBLE AS gib, tamanho / 1099511627776::DOUBLE AS tib
    FROM ({plain(SIZES)})"""
)
def byte_sizes(spark, folder):
    size = F.col("tamanho")
    return view(spark, folder, SIZES).select(
        "o_orderkey",
        numbers.readable_bytes(size).alias("binario"),
        numbers.readable_bytes(size, SHORT_UNITS).alias("curto"),
        numbers.gib(size).alias("gib"),
        numbers.tib(size).alias("tib"),
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'view' THEN epoch_us(ts) WHEN 'click' THEN epoch_us(ts) + 10800000000
    WHEN 'error' THEN epoch_us(date_trunc('day', ts)) WHEN 'signup' THEN epoch_us(ts) END AS micros,
    ts >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY AS recente FROM events"""
)
def iso_timestamps(spark, folder):
    ts, kind = F.col("ts"), F.col("event_type")
    written = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-03:00'"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy"))
    )
    now = F.timestamp_micros(F.lit(1707523200000000))
    return table(spark, folder, "events").select(
        "event_id",
        F.unix_micros(times.iso_timestamp(written)).alias("micros"),
        times.within_days(ts.cast("timestamp"), 30, now).alias("recente"),
    )


@query(
    f"""SELECT count(*) FILTER (WHERE id_municipio IS NULL) AS municipio_vazio,
    count(*) FILTER (WHERE taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100) AS taxa_fora,
    count(*) FILTER (WHERE rede NOT IN ('0','1','2','3','4','5','6') OR rede IS NULL) AS rede_fora,
    count(*) FILTER (WHERE ano = 2000) AS no_ano FROM ({plain(X.RESULTS)})"""
)
def violations(spark, folder):
    codes = [str(code) for code in range(7)]
    return view(spark, folder, X.RESULTS).agg(
        F.count_if(text.blank(F.col("id_municipio"))).alias("municipio_vazio"),
        F.count_if(numbers.out_of_range(F.col("taxa_alfabetizacao"))).alias("taxa_fora"),
        F.count_if(numbers.out_of_domain(F.col("rede"), codes)).alias("rede_fora"),
        F.count_if(F.col("ano") == 2000).alias("no_ano"),
    )


@query(
    f"""SELECT ano, id_aluno, id_municipio FROM ({plain(X.STUDENTS_RAW)})
    WHERE presenca IS NULL OR trim(alfabetizado) = '' OR id_aluno IS NULL"""
)
def blank_rows(spark, folder):
    tests = [text.blank(F.col(c)) for c in ("presenca", "alfabetizado", "id_aluno")]
    rows = view(spark, folder, X.STUDENTS_RAW)
    return rows.where(tests[0] | tests[1] | tests[2]).select("ano", "id_aluno", "id_municipio")


@query(
    f"""SELECT ano, id_municipio, taxa_alfabetizacao FROM ({plain(X.RESULTS)})
    WHERE taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100"""
)
def range_rows(spark, folder):
    rows = view(spark, folder, X.RESULTS).select("ano", "id_municipio", "taxa_alfabetizacao")
    return rows.where(numbers.out_of_range(F.col("taxa_alfabetizacao")))


DUPLICATE_KEYS_SQL = f"""SELECT ano, id_aluno, count(*) AS quantidade FROM ({plain(X.STUDENTS_RAW)})
  GROUP BY ano, id_aluno HAVING count(*) > 1"""


@query(DUPLICATE_KEYS_SQL)
def dup_keys(spark, folder):
    return K.duplicate_keys(view(spark, folder, X.STUDENTS_RAW), ["ano", "id_aluno"])


@query(f"SELECT count(*) AS chaves_repetidas FROM ({DUPLICATE_KEYS_SQL})")
def dup_key_count(spark, folder):
    return K.count_duplicate_keys(view(spark, folder, X.STUDENTS_RAW), ["ano", "id_aluno"])


@query(
    """SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars
    FROM documents)) AS linhas_excedentes"""
)
def dup_rows(spark, folder):
    return K.count_excess_rows(table(spark, folder, "documents").drop("doc_id"))


@query(
    f"""SELECT DISTINCT {clean_sql("id_municipio")} AS id_municipio FROM ({plain(X.STUDENTS_RAW)})
    WHERE {clean_sql("id_municipio")} NOT IN (SELECT id_municipio FROM ({plain(X.PUBLISHED)}))"""
)
def orphan_keys(spark, folder):
    students = C.clean_text(view(spark, folder, X.STUDENTS_RAW), ["id_municipio"])
    return K.orphan_keys(students, view(spark, folder, X.PUBLISHED), ["id_municipio"])


@query(
    f"""SELECT a.id_municipio, count(*) AS quantidade_registros, min(a.ano) AS primeiro_ano, max(a.ano) AS ultimo_ano
    FROM ({STUDENTS_SQL}) a LEFT JOIN ({plain(X.PUBLISHED)}) m ON a.id_municipio = m.id_municipio
    WHERE a.id_municipio IS NOT NULL AND m.id_municipio IS NULL
    GROUP BY a.id_municipio ORDER BY quantidade_registros DESC, a.id_municipio"""
)
def orphan_profile(spark, folder):
    raw = view(spark, folder, X.STUDENTS_RAW).select("ano", "id_municipio")
    students = C.coerce_numbers(C.clean_text(raw, ["id_municipio"]), ["ano"])
    return K.orphan_profile(students, view(spark, folder, X.PUBLISHED), "id_municipio", "ano")


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1"""
)
def latest_per_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    latest = K.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")
