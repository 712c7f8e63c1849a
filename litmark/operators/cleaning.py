"""Bronze to Silver: names, text, types, exact duplicates, lineage. One projection per step, no Python UDF."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark import fixed_values as V
from litmark.functions.numbers import coerce_double, coerce_long
from litmark.functions.text import drop_tokens, lower_name, snake_name, strip


def rename_columns(df: DataFrame, rule: Callable[[str], str] = snake_name) -> DataFrame:
    """All columns renamed by ``rule``; two names that become one are an error."""
    names = [rule(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes or "" in names:
        raise ValueError(f"columns cannot be told apart after renaming: {clashes or df.columns}")
    return df.toDF(*names)


def clean_all_text(df: DataFrame) -> DataFrame:
    """Strip and null tokens on every text column."""
    return clean_text(df, [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def clean_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip and null tokens on the named columns; absent ones are skipped, others become text.

    Two projections, so that the tokens are looked up in the stripped text instead of stripping it again.
    """
    present = set(columns) & set(df.columns)
    if not present:
        return df
    named = [c for c in df.columns if c in present]
    stripped = df.withColumns({c: strip(F.col(c).cast("string")) for c in named})
    return stripped.withColumns({c: drop_tokens(F.col(c)) for c in named})


def coerce_numbers(df: DataFrame, integers: Iterable[str] = (), doubles: Iterable[str] = ()) -> DataFrame:
    """Numbers or NULL on the named columns; absent ones are skipped. Each text is parsed once, in a projection of its own."""
    integers, doubles = list(integers), list(doubles)
    parsed = {c: F.col(c).try_cast("double") for c in df.columns if c in integers or c in doubles}
    df = df.withColumns(parsed) if parsed else df
    typed = {c: coerce_long(F.col(c)) for c in integers if c in df.columns}
    typed |= {c: coerce_double(F.col(c)) for c in doubles if c in df.columns}
    return df.withColumns(typed) if typed else df


def drop_nan(df: DataFrame) -> DataFrame:
    """NaN means no value: NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows (NULLs equal). Equal rows already collapse before the shuffle."""
    return df.dropDuplicates()


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with a value in every required column."""
    return df.na.drop(subset=required)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df``, or an error when it has no row (one row is looked for, not all counted)."""
    if df.isEmpty():
        raise ValueError(f"{name} has no valid rows")
    return df


def add_lineage(df: DataFrame, source: str = V.SOURCE_MARK, layer: str = V.BRONZE_MARK) -> DataFrame:
    return df.withColumns(
        {
            "_fonte": F.lit(source),
            "_camada_origem": F.lit(layer),
            "_processado_em_utc": F.current_timestamp(),
        }
    )


def clean_reference(df: DataFrame) -> DataFrame:
    """A reference table: snake-case names, all text cleaned, exact duplicates removed."""
    return drop_exact_duplicates(drop_nan(clean_all_text(rename_columns(df, snake_name))))


def clean_students(df: DataFrame) -> DataFrame:
    """The student table: lower-case names, listed text and number columns, exact duplicates removed."""
    named = rename_columns(df, lower_name)
    typed = coerce_numbers(clean_text(named, V.STUDENT_TEXT), V.STUDENT_INTEGERS, V.STUDENT_DOUBLES)
    return drop_exact_duplicates(typed)
