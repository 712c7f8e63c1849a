"""Codes, labels, names and messages that results must carry exactly as written here."""

from __future__ import annotations

# School-network codes and their labels.
NETWORK_LABELS = {
    0: "Total",
    1: "Federal",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Pública (Estadual e Municipal)",
    6: "Pública (Federal, Estadual e Municipal)",
}
NETWORK_UNKNOWN = "Não identificado"

# Spelled-out network names accepted in target tables ("total…" is a prefix).
NETWORK_NAME_CODES = {"federal": 1, "estadual": 2, "municipal": 3, "privada": 4}
NETWORK_TOTAL_PREFIX = "total"

# Texts that mean "no value" after trimming.
NULL_TOKENS = ["", "nan", "None", "null"]

# Characters removed at both ends of a text (Unicode white space and the ASCII separators).
WHITESPACE_CODEPOINTS = (
    [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760]
    + list(range(8192, 8203))
    + [8232, 8233, 8239, 8287, 12288]
)
WHITESPACE = "".join(chr(p) for p in WHITESPACE_CODEPOINTS)

# Outcome of comparing a rate with its target.
STATUS_NO_RESULT = "Sem resultado"
STATUS_NO_TARGET = "Sem meta"
STATUS_REACHED = "Meta atingida"
STATUS_BELOW = "Abaixo da meta"
# Statuses a comparison table may hold.
STATUS_DOMAIN = [STATUS_REACHED, STATUS_BELOW, STATUS_NO_RESULT]

# Direction of change between two years.
TREND_NONE = "Sem comparação"
TREND_UP = "Evolução positiva"
TREND_DOWN = "Queda"
TREND_FLAT = "Estável"
TREND_DOMAIN = [TREND_UP, TREND_DOWN, TREND_FLAT, TREND_NONE]

# Check outcomes.
PASS = "APROVADO"
FAIL = "REPROVADO"
WARN = "AVISO"

# Stage and run outcomes.
RUN_OK = "SUCESSO"
RUN_FAILED = "FALHA"

# Lineage marks.
SOURCE_MARK = "base_dos_dados"
BRONZE_MARK = "bronze"
INDICATOR_SOURCE = "silver.municipio"
TARGETS_SOURCE = "silver.meta_alfabetizacao_municipio"

# Table names.
GOLD_INDICATOR = "indicador_alfabetizacao_municipio"
GOLD_TARGETS = "metas_alfabetizacao_municipio"
GOLD_COMPARISON = "comparacao_meta_resultado_municipio"
GOLD_EVOLUTION = "evolucao_alfabetizacao_municipio"
SILVER_STUDENTS = "alunos"
SILVER_RESULTS = "municipio"
SILVER_TARGETS = "meta_alfabetizacao_municipio"
REFERENCE_TABLES = [
    "uf",
    "municipio",
    "meta_alfabetizacao_brasil",
    "meta_alfabetizacao_uf",
    "meta_alfabetizacao_municipio",
]

# Text and numeric columns of the student table.
STUDENT_TEXT = [
    "id_municipio",
    "id_escola",
    "id_aluno",
    "caderno",
    "serie",
    "rede",
    "presenca",
    "preenchimento_caderno",
    "alfabetizado",
]
STUDENT_INTEGERS = ["ano"]
STUDENT_DOUBLES = ["proficiencia", "peso_aluno"]
STUDENT_REQUIRED = ["ano", "id_municipio", "id_aluno", "presenca"]

# Clustering columns of the loaded tables.
STUDENT_CLUSTERING = ["ano", "id_municipio", "rede"]
GOLD_CLUSTERING = ["id_uf", "codigo_rede"]

# Check names and explanations in the quality reports.
CHECK_RECONCILED = ("Reconciliação Bronze x Silver", "A quantidade de linhas deve ser preservada.")
CHECK_DUPLICATES = "Duplicidades"
DETAIL_DUPLICATE_ROWS = "Não devem existir registros exatamente duplicados."
DETAIL_DUPLICATE_STUDENT = "Não deve existir repetição da chave ano + id_aluno."
CHECK_REQUIRED = ("Nulos na coluna {column}", "A coluna {column} é obrigatória.")
CHECK_YEAR_DOMAIN = ("Domínio de anos", "Somente os anos {years} são esperados.")
CHECK_ROWS_IN_YEAR = ("Quantidade de alunos em {year}", "Comparação com a quantidade da tabela de origem.")
CHECK_STUDENT_ORPHANS = (
    "Municípios sem resultado agregado",
    "A tabela municipio contém resultados agregados, não um cadastro completo. Municípios presentes em alunos "
    "podem não ter resultado municipal publicado. O caso deve ser registrado como aviso, sem excluir os alunos.",
)
CHECK_TARGET_ORPHANS = (
    "Metas sem resultado municipal",
    "Municípios com meta devem possuir resultado agregado na tabela municipio.",
)
CHECK_NOT_EMPTY = ("Tabela não vazia", "A tabela Gold deve possuir pelo menos um registro.")
CHECK_KEY_DUPLICATES = (
    "Duplicidades na chave analítica",
    "Não deve existir mais de um registro para a mesma combinação de chaves.",
)
CHECK_KEY_NULLS = ("Nulos na chave {column}", "A coluna {column} faz parte da chave analítica.")
CHECK_RANGE = ("Faixa válida de {column}", "A coluna {column} deve estar entre 0 e 100.")
CHECK_COMPARISON_RECONCILED = (
    "Reconciliação da comparação",
    "A tabela deve conter todas as combinações compatíveis entre indicador e meta.",
)
CHECK_STATUS_DOMAIN = (
    "Domínio do status da meta",
    "O status deve representar uma comparação válida entre indicador e meta.",
)
CHECK_NULL_TARGETS = (
    "Metas nulas na comparação",
    "Todos os registros da comparação devem possuir uma meta correspondente.",
)
CHECK_TREND_DOMAIN = ("Domínio da tendência", "A tendência deve pertencer ao domínio definido.")
CHECK_NO_COMPARISON = (
    "Municípios sem comparação temporal",
    "Alguns registros não possuem resultado disponível nos dois anos analisados.",
)

# Event contract.
EVENT_TYPE = "indicador_alfabetizacao_atualizado"
EVENT_VERSION = "1.0"
EVENT_YEARS = [2023, 2024]
EVENT_TOLERANCE = 0.01

# Messages of rejected events.
EVENT_NOT_OBJECT = "A linha não representa um objeto JSON."
EVENT_FIELD_ABSENT = "O campo obrigatório '{field}' está ausente."
EVENT_FIELD_EMPTY = "O campo obrigatório '{field}' está vazio."
EVENT_WRONG_TYPE = "Tipo de evento inválido: "
EVENT_WRONG_VERSION = "Versão de esquema não suportada: "
EVENT_BAD_TIMESTAMP = "O campo 'event_timestamp_utc' é inválido."
EVENT_BAD_PAYLOAD = "O campo 'payload' deve ser um objeto JSON."
EVENT_BAD_INTEGERS = "Os campos 'ano' e 'codigo_rede' devem ser inteiros."
EVENT_BAD_YEAR = "Ano inválido no evento: "
EVENT_BAD_NETWORK = "Código de rede inválido: "
EVENT_BAD_PREFIX = "O id_uf não corresponde ao início do id_municipio."
EVENT_NOT_NUMERIC = "O campo '{field}' não possui valor numérico válido."
EVENT_OUT_OF_RANGE = "O campo '{field}' deve estar entre 0 e 100."
EVENT_BAD_VARIATION = "O campo 'variacao_pp' não é válido."
EVENT_WRONG_VARIATION = (
    "A variação informada não corresponde à diferença entre a taxa anterior e a taxa atualizada."
)

# Size units.
BINARY_UNITS = ["B", "KiB", "MiB", "GiB", "TiB"]
SHORT_UNITS = ["B", "KB", "MB", "GB", "TB"]

# List prices (USD) and monthly free tiers.
QUERY_USD_PER_TIB = 6.25
ACTIVE_USD_PER_GIB = 0.02
LONG_TERM_USD_PER_GIB = 0.01
FREE_STORAGE_GIB = 10.0
FREE_QUERY_TIB = 1.0
NOT_CLUSTERED = "Não"

# Thresholds of the cost advice.
PARTITION_ADVICE_BYTES = 50 * 1024 * 1024
CLUSTER_ADVICE_BYTES = 10 * 1024 * 1024
SHORT_RETENTION_DAYS = 60

# Texts of the cost advice.
ADVICE_PARTITION = (
    "Avaliar particionamento nas tabelas maiores: ",
    ". A tabela de alunos pode ser particionada por ano.",
)
ADVICE_CLUSTER = ("Avaliar clusterização nas tabelas: ", ".")
ADVICE_STORAGE_FREE = "O armazenamento atual está dentro dos 10 GiB considerados na faixa gratuita."
ADVICE_STORAGE_PAID = (
    "O armazenamento ultrapassa a faixa gratuita. Avalie expiração de tabelas e remoção de versões antigas."
)
ADVICE_USAGE_FREE = "O uso de consultas dos últimos 30 dias permanece dentro de 1 TiB."
ADVICE_USAGE_PAID = (
    "As consultas ultrapassaram 1 TiB nos últimos 30 dias. Configure cotas e maximum_bytes_billed."
)
ADVICE_USAGE_UNKNOWN = (
    "Não foi possível consultar o histórico de jobs. Verifique as permissões do projeto."
)
ADVICE_SCENARIO_FREE = "O cenário projetado do dashboard permanece dentro da faixa gratuita de consultas."
ADVICE_SCENARIO_PAID = (
    "O cenário projetado ultrapassa a faixa gratuita. Reduza atualizações ou materialize agregações."
)
ADVICE_RETENTION = "Existem datasets com expiração automática igual ou inferior a 60 dias."
ADVICE_ALWAYS = [
    "Utilizar dry run antes de consultas para estimar os bytes processados.",
    "Evitar SELECT * e selecionar apenas as colunas necessárias.",
    "Definir maximum_bytes_billed para limitar consultas inesperadamente caras.",
    "Manter arquivos Parquet com compressão ZSTD e organização por ano.",
    "Consultar preferencialmente a camada Gold, evitando varreduras recorrentes dos microdados.",
]
