"""Change events: encode rows as JSON lines, parse and validate lines. Column expressions only, batch or stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmark import fixed_values as V
from litmark.functions.numbers import clamp, differs, round2
from litmark.functions.text import strip
from litmark.functions.times import iso_timestamp
from litmark.operators.cleaning import drop_incomplete, require_rows

BASE_COLUMNS = ["ano", "id_municipio", "id_uf", "codigo_rede", "rede", "taxa_alfabetizacao"]
BASE_REQUIRED = ["ano", "id_municipio", "codigo_rede", "taxa_alfabetizacao"]

EVENT_COLUMNS = [
    "event_id",
    "event_type",
    "event_timestamp_utc",
    "schema_version",
    "source",
    "ano",
    "id_municipio",
    "id_uf",
    "codigo_rede",
    "rede",
    "taxa_alfabetizacao_anterior",
    "taxa_alfabetizacao_atualizada",
    "variacao_pp",
    "arquivo_origem",
    "numero_linha_origem",
    "processado_em_utc",
]


# The same columns with their types, as stored.
EVENT_SCHEMA = (
    "event_id string, event_type string, event_timestamp_utc timestamp, schema_version string, source string, ano int, "
    "id_municipio string, id_uf string, codigo_rede int, rede string, taxa_alfabetizacao_anterior double, "
    "taxa_alfabetizacao_atualizada double, variacao_pp double, arquivo_origem string, numero_linha_origem long, "
    "processado_em_utc timestamp"
)

# Types the fields are read as. Numbers are accepted as text, numeric text as numbers; anything else is NULL.
EVENT_TYPES = (
    "struct<event_id: string, event_type: string, event_timestamp_utc: string, schema_version: string, source: string, "
    "payload: struct<ano: int, id_municipio: string, id_uf: string, codigo_rede: int, rede: string, "
    "taxa_alfabetizacao_anterior: double, taxa_alfabetizacao_atualizada: double, variacao_pp: double>>"
)


@dataclass(frozen=True)
class EventRules:
    """What a valid event looks like."""

    event_type: str = V.EVENT_TYPE
    schema_version: str = V.EVENT_VERSION
    years: list[int] = field(default_factory=lambda: list(V.EVENT_YEARS))
    networks: list[int] = field(default_factory=lambda: list(V.NETWORK_LABELS))
    tolerance: float = V.EVENT_TOLERANCE


def event_base(indicators: DataFrame) -> DataFrame:
    """The indicator columns an event needs, rows with all required values; an error if there is no such row."""
    return require_rows(drop_incomplete(indicators.select(*BASE_COLUMNS), BASE_REQUIRED), "the base of events")


def encode_events(
    base: DataFrame,
    change: Column,
    event_id: Column | None = None,
    moment: Column | None = None,
    source: str = "litmark",
    rules: EventRules | None = None,
) -> DataFrame:
    """One event per row as nested columns: the new rate is the old one plus ``change``, kept within 0 and 100.

    Without ``event_id`` every evaluation draws new ids; pass a hash of the row key where events may be encoded again.
    ``sinks.write_json_lines(events, folder, "append")`` stores them as new line files.
    """
    rules = rules or EventRules()
    old = F.col("taxa_alfabetizacao").cast("double")
    new = round2(clamp(old + round2(change)))
    when = F.current_timestamp() if moment is None else moment
    return base.select(
        (F.uuid() if event_id is None else event_id).alias("event_id"),
        F.lit(rules.event_type).alias("event_type"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_timestamp_utc"),
        F.lit(rules.schema_version).alias("schema_version"),
        F.lit(source).alias("source"),
        F.struct(
            F.col("ano").cast("int").alias("ano"),
            F.col("id_municipio").cast("string").alias("id_municipio"),
            F.col("id_uf").cast("string").alias("id_uf"),
            F.col("codigo_rede").cast("int").alias("codigo_rede"),
            F.col("rede").cast("string").alias("rede"),
            old.alias("taxa_alfabetizacao_anterior"),
            new.alias("taxa_alfabetizacao_atualizada"),
            round2(new - old).alias("variacao_pp"),
        ).alias("payload"),
    )


def to_lines(events: DataFrame) -> DataFrame:
    """Events as JSON text, one row per line."""
    return events.select(F.to_json(F.struct(*events.columns)).alias("value"))


def _rules(rules: EventRules) -> list[tuple[Column, Column]]:
    """Broken-rule tests over the parsed fields and their messages, in the order that decides which one is reported."""
    c = F.col
    listed: list[tuple[Column, Column]] = []

    def add(test: Column, *message: str | Column) -> None:
        listed.append((test, F.concat(*[F.lit(m) if isinstance(m, str) else m.cast("string") for m in message])))

    def text(name: str) -> None:
        add(c(name).isNull(), V.EVENT_FIELD_ABSENT.format(field=name))
        add(c(name) == "", V.EVENT_FIELD_EMPTY.format(field=name))

    def rate(value: Column, name: str) -> None:
        add(value.isNull() | F.isnan(value), V.EVENT_NOT_NUMERIC.format(field=name))
        add((value < 0) | (value > 100), V.EVENT_OUT_OF_RANGE.format(field=name))

    add(~c("_is_object"), V.EVENT_NOT_OBJECT)
    text("event_id")
    text("event_type")
    add(c("event_type") != rules.event_type, V.EVENT_WRONG_TYPE, c("event_type"), ".")
    text("schema_version")
    add(c("schema_version") != rules.schema_version, V.EVENT_WRONG_VERSION, c("schema_version"), ".")
    add(c("event_timestamp_utc").isNull(), V.EVENT_BAD_TIMESTAMP)
    add(~c("_has_payload"), V.EVENT_BAD_PAYLOAD)
    add(c("ano").isNull() | c("codigo_rede").isNull(), V.EVENT_BAD_INTEGERS)
    add(~c("ano").isin(rules.years), V.EVENT_BAD_YEAR, c("ano"), ".")
    add(~c("codigo_rede").isin(rules.networks), V.EVENT_BAD_NETWORK, c("codigo_rede"), ".")
    text("id_municipio")
    text("id_uf")
    add(~c("id_municipio").startswith(c("id_uf")), V.EVENT_BAD_PREFIX)
    text("rede")
    rate(c("_old"), "taxa_alfabetizacao_anterior")
    rate(c("_new"), "taxa_alfabetizacao_atualizada")
    add(c("_told").isNull() | F.isnan("_told"), V.EVENT_BAD_VARIATION)
    computed = round2(round2(c("_new")) - round2(c("_old")))
    add(differs(round2(c("_told")), computed, rules.tolerance), V.EVENT_WRONG_VARIATION)
    text("source")
    return listed


def parse_events(lines: DataFrame, rules: EventRules | None = None, keep_blank: bool = False, fenced: bool = True) -> DataFrame:
    """Lines with their fields parsed, ``regra``, the number of the first broken rule, and ``erro``, its message.

    Both are NULL for a valid event. All other columns of ``lines`` are kept; ``value`` is replaced by the parsed fields.
    Blank lines are dropped, or with ``keep_blank`` kept and marked in ``em_branco`` (line numbers count them). Without ``fenced`` nothing
    keeps filters on the result from parsing again: for results that are persisted, which are such a fence.
    """
    rules = rules or EventRules()
    kept = [c for c in lines.columns if c != "value"]

    # Inside an array, text after the object is malformed and a second object is a second element.
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    objects = F.try_variant_get(listed, "$", f"array<{EVENT_TYPES}>")
    record, payload = F.col("_record"), F.col("_record.payload")

    fields = [
        record.isNotNull().alias("_is_object"),
        payload.isNotNull().alias("_has_payload"),
        strip(record["event_id"]).alias("event_id"),
        strip(record["event_type"]).alias("event_type"),
        strip(record["event_timestamp_utc"]).alias("event_timestamp_utc"),
        strip(record["schema_version"]).alias("schema_version"),
        strip(record["source"]).alias("source"),
        payload["ano"].alias("ano"),
        strip(payload["id_municipio"]).alias("id_municipio"),
        strip(payload["id_uf"]).alias("id_uf"),
        payload["codigo_rede"].alias("codigo_rede"),
        strip(payload["rede"]).alias("rede"),
        payload["taxa_alfabetizacao_anterior"].alias("_old"),
        payload["taxa_alfabetizacao_atualizada"].alias("_new"),
        payload["variacao_pp"].alias("_told"),
    ]
    # Rows are judged by a rule number; the messages are only built where they are asked for.
    broken = _rules(rules)
    rule, message = F, F
    for number, (test, text) in enumerate(broken, start=1):
        rule = rule.when(test, number)
        message = message.when(F.col("regra") == number, text)
    # Most lines begin with a printable character, so their ends need no look; the time is read from the stripped text, not from its formula.
    empty = F.when(F.ascii("value").between(33, 126), False).otherwise(strip(F.col("value")) == "")
    parsed = (
        lines.select(*kept, objects.alias("_objects"), empty.alias("em_branco"))
        .select(*kept, "em_branco", F.when(F.size("_objects") == 1, F.get("_objects", F.lit(0))).alias("_record"))
        .select(*kept, "em_branco", *fields)
        .withColumn("event_timestamp_utc", iso_timestamp(F.col("event_timestamp_utc")))
        .withColumn("regra", rule)
    )
    # The one-element inline is a fence: a filter on the rule pushed below it would parse and judge again per field.
    names = parsed.columns[len(kept) :]
    judged = parsed.select(*kept, F.inline(F.array(F.struct(*names)))) if fenced else parsed
    judged = judged if keep_blank else judged.where("NOT em_branco")
    old, new = round2(F.col("_old")), round2(F.col("_new"))
    return judged.select(
        *kept,
        *(["em_branco"] if keep_blank else []),
        *EVENT_COLUMNS[:10],
        old.alias("taxa_alfabetizacao_anterior"),
        new.alias("taxa_alfabetizacao_atualizada"),
        round2(new - old).alias("variacao_pp"),
        "regra",
        message.alias("erro"),
    )


def valid_events(parsed: DataFrame, *more: str) -> DataFrame:
    """The valid rows in the 16 event columns, and ``more`` columns of ``parsed``."""
    stamped = parsed.where(F.col("regra").isNull()).withColumn("processado_em_utc", F.current_timestamp())
    return stamped.select(*EVENT_COLUMNS, *more)


def invalid_events(parsed: DataFrame) -> DataFrame:
    """The rejected rows: file, line number and a message that names both."""
    where = F.concat(F.col("arquivo_origem"), F.lit(", linha "), F.col("numero_linha_origem").cast("string"))
    return parsed.where(F.col("regra").isNotNull()).select(
        "arquivo_origem", "numero_linha_origem", F.concat(where, F.lit(": "), F.col("erro")).alias("mensagem")
    )
