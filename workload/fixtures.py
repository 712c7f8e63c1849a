"""The given tables reshaped into the engine's input tables. Each text runs in Spark and as plain ANSI SQL.

All of them grow with the given tables: a customer is a municipality, a line item is a student, an event is a change
event. They contain the cases the operators must handle: absent years, NULL rates, values out of range, codes out of the
domain, untidy labels, repeated reference years, null tokens, broken event lines, and one event key with a third of all
rows.
"""

from __future__ import annotations

MUNICIPALITY = (
    "CASE WHEN c.c_custkey % 97 = 5 THEN NULL "
    "ELSE CAST(11 + c.c_nationkey AS VARCHAR(10)) || lpad(CAST(c.c_custkey AS VARCHAR(20)), 12, '0') END"
)
CENTS = "CAST(sum(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT)"
YEARS = range(1995, 2002)

_proportions = ",\n  ".join(
    f"CAST(100 * sum(CASE WHEN o.o_orderkey % 9 = {n} THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) "
    f"AS proporcao_aluno_nivel_{n}"
    for n in range(9)
)

# Results per municipality, year and grade.
RESULTS = f"""
SELECT CAST(year(o.o_orderdate) AS INT) AS ano,
  {MUNICIPALITY} AS id_municipio,
  CASE WHEN o.o_orderkey % 5 = 0 THEN '3' ELSE '2' END AS serie,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '0' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
    WHEN 'HOUSEHOLD' THEN '5' ELSE '9' END AS rede,
  CASE WHEN c.c_custkey % 7 = 3 AND year(o.o_orderdate) = 2000 THEN NULL
    ELSE CAST({CENTS} % 101000 AS DOUBLE) / 1000 END AS taxa_alfabetizacao,
  CAST({CENTS} % 900000 AS DOUBLE) / 1000 AS media_portugues,
  {_proportions}
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
GROUP BY year(o.o_orderdate), c.c_custkey, c.c_nationkey, c.c_mktsegment, CASE WHEN o.o_orderkey % 5 = 0 THEN '3' ELSE '2' END
"""

_targets = ",\n  ".join(
    f"CASE WHEN (c.c_custkey + year(o.o_orderdate) + {y}) % 4 = 0 THEN NULL "
    f"ELSE CAST(({CENTS} + {y}) % 101000 AS DOUBLE) / 1000 END AS meta_alfabetizacao_{y}"
    for y in YEARS
)

# Targets per municipality, network and reference year, one column per target year.
TARGETS_WIDE = f"""
SELECT CAST(year(o.o_orderdate) AS INT) AS ano,
  {MUNICIPALITY} AS id_municipio,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN ' Total geral' WHEN 'BUILDING' THEN 'ESTADUAL '
    WHEN 'FURNITURE' THEN '3' WHEN 'HOUSEHOLD' THEN ' 5.0 ' ELSE 'Rede desconhecida' END AS rede,
  {_targets}
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
GROUP BY year(o.o_orderdate), c.c_custkey, c.c_nationkey, c.c_mktsegment, o.o_orderstatus
"""

# Raw student rows, all text.
STUDENTS_RAW = """
SELECT CASE WHEN l_linenumber = 7 THEN 'sem ano' ELSE CAST(CAST(year(l_shipdate) AS INT) AS VARCHAR(10)) END AS ano,
  chr(9) || ' 21' || lpad(CAST(l_orderkey AS VARCHAR(20)), 12, '0') || ' ' AS id_municipio,
  'E' || CAST(l_suppkey AS VARCHAR(20)) || chr(10) AS id_escola,
  CASE WHEN l_tax = 0.08 THEN NULL ELSE CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(10)) END AS id_aluno,
  CASE WHEN l_returnflag = 'N' THEN 'null' ELSE l_returnflag END AS caderno,
  CASE WHEN l_linestatus = 'F' THEN '2' ELSE ' 3' END AS serie,
  CAST(l_partkey % 8 AS VARCHAR(10)) AS rede,
  CASE l_returnflag WHEN 'A' THEN ' 1' WHEN 'N' THEN '0 ' ELSE ' nan ' END AS presenca,
  CASE WHEN l_discount = 0.05 THEN 'None' WHEN l_discount = 0.06 THEN 'NONE' ELSE '1' END AS preenchimento_caderno,
  CASE WHEN l_quantity > 25 THEN '1' ELSE '' END AS alfabetizado,
  CASE WHEN l_linenumber = 5 THEN 'x' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(30)) END AS proficiencia,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR(30)) AS peso_aluno
FROM {lineitem}
"""

# Municipalities with a published result, and with targets, in the students' code space. Some have codes of another state, so the students
# of these orders are orphans.
PUBLISHED = """
SELECT CASE WHEN o_orderstatus = 'P' THEN '29' ELSE '21' END || lpad(CAST(o_orderkey AS VARCHAR(20)), 12, '0') AS id_municipio, CAST(year(o_orderdate) AS INT) AS ano,
  o_orderstatus AS rede, o_totalprice AS taxa_alfabetizacao
FROM {orders}
"""
PLANNED = """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '28' ELSE '21' END || lpad(CAST(o_orderkey AS VARCHAR(20)), 12, '0') AS id_municipio, o_orderpriority AS rede
FROM {orders}
"""

# Targets of states and of the country, with repeated rows.
PLANNED_STATES = "SELECT s_nationkey AS uf, 2020 + s_suppkey % 3 AS ano, s_suppkey % 5 AS rede FROM {supplier}"
PLANNED_COUNTRY = "SELECT 2020 + n_regionkey AS ano, n_nationkey % 3 AS rede, 50 + n_regionkey AS meta FROM {nation}"

# Change events before encoding; every kind of broken event occurs.
EVENTS = """
SELECT event_id AS linha,
  CASE WHEN event_id % 59 = 12 THEN ' ' WHEN event_id % 3 = 1 THEN 'e-frequente'
    ELSE 'e' || CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR(20)) END AS chave,
  CASE WHEN event_id % 61 = 4 THEN 'outro' ELSE 'indicador_alfabetizacao_atualizado' END AS tipo,
  ts,
  CASE WHEN event_id % 73 = 20 THEN 1 ELSE 0 END AS sem_data,
  CASE WHEN event_id % 50 = 7 THEN '2.0' ELSE '1.0' END AS versao,
  CASE WHEN event_id % 71 = 8 THEN '' ELSE 'sistema ' END AS fonte,
  CAST(2023 + CASE WHEN event_id % 40 = 3 THEN 2 ELSE event_id % 2 END AS INT) AS ano,
  CAST(user_id % 8 AS INT) AS codigo_rede,
  CASE WHEN event_id % 53 = 6 THEN '12' ELSE '11' END || lpad(CAST(user_id AS VARCHAR(20)), 12, '0') AS id_municipio,
  '11' AS id_uf,
  'R' || CAST(user_id % 8 AS VARCHAR(10)) AS rede,
  value AS anterior,
  value + CAST((event_id % 9) - 4 AS DOUBLE) / 10 AS atualizada,
  CAST((event_id % 9) - 4 AS DOUBLE) / 10 + CASE WHEN event_id % 60 = 5 THEN 0.5E0 ELSE 0E0 END AS variacao,
  CASE WHEN event_id % 70 = 9 THEN 'quebrada' WHEN event_id % 70 = 10 THEN 'vazia'
    WHEN event_id % 67 = 11 THEN 'sem payload' ELSE 'normal' END AS forma,
  event_type AS grupo
FROM {events}
"""

# Finished and unfinished warehouse jobs.
JOBS = """
SELECT ts AS creation_time,
  CASE WHEN event_type = 'error' THEN 'LOAD' ELSE 'QUERY' END AS job_type,
  CASE WHEN value < 1 THEN 'RUNNING' ELSE 'DONE' END AS state,
  CASE event_type WHEN 'click' THEN 'SCRIPT' WHEN 'view' THEN NULL ELSE 'SELECT' END AS statement_type,
  CASE WHEN user_id % 11 = 3 THEN 'falhou' END AS error_result,
  CASE WHEN event_type = 'view' THEN user_id % 2 = 0 END AS cache_hit,
  CAST(CAST(value AS DECIMAL(18,2)) * 100000000 AS BIGINT) AS total_bytes_processed,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) * 110000000 AS BIGINT) END AS total_bytes_billed
FROM {events}
"""

# A table inventory: one table per return flag, line status and shipping year, sized by its line items.
INVENTORY = """
SELECT 'base_' || lower(l_returnflag) AS dataset,
  't_' || lower(l_linestatus) || '_' || CAST(CAST(year(l_shipdate) AS INT) AS VARCHAR(10)) AS tabela,
  CAST(count(*) AS BIGINT) AS linhas,
  CAST(sum(CAST(l_quantity AS BIGINT)) * 20000 AS BIGINT) AS bytes_totais,
  CAST(sum(CASE WHEN l_linenumber < 5 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) * 20000 AS BIGINT) AS bytes_ativos,
  CAST(sum(CASE WHEN l_linenumber < 5 THEN 0 ELSE CAST(l_quantity AS BIGINT) END) * 20000 AS BIGINT) AS bytes_longo_prazo,
  year(l_shipdate) % 2 = 0 AS particionada,
  CASE WHEN l_linestatus = 'F' THEN 'Não' ELSE 'id_uf, codigo_rede' END AS clusterizacao,
  CASE WHEN l_returnflag = 'A' THEN 60E0 END AS expiracao_padrao_dataset_dias
FROM {lineitem}
GROUP BY l_returnflag, l_linestatus, year(l_shipdate)
"""

# Run records: one run per event, its stages judged by the event's value.
RUNS = """
SELECT 'r' || CAST(event_id AS VARCHAR(20)) AS run_id,
  CASE WHEN event_id % 2 = 0 THEN 'completo' ELSE 'gold' END AS perfil,
  CAST(user_id AS BIGINT) AS registros, CAST(event_id AS BIGINT) AS tamanho,
  CASE WHEN value > 60 THEN 'FALHA' ELSE 'SUCESSO' END AS etapa_1,
  CASE WHEN user_id % 9 = 4 THEN 'FALHA' ELSE 'SUCESSO' END AS etapa_2,
  value AS duracao
FROM {events}
"""
