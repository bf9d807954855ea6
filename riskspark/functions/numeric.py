"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text that a strict decimal parser accepts; keeps Java-only forms such as "1d" out.
_DECIMAL_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def null_safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL where the divisor is zero."""
    return num / F.nullif(den, F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def text_to_double(text: Column) -> Column:
    """Strict decimal parse: NULL for anything else."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_DECIMAL_TEXT), trimmed.try_cast("double"))


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def to_double(df: DataFrame, name: str, types: dict | None = None) -> Column:
    """Column ``name`` as double; unparseable text becomes NULL."""
    kind = (types or column_types(df))[name]
    return text_to_double(F.col(name)) if isinstance(kind, T.StringType) else F.col(name).cast("double")


def coerce_to_zero(df: DataFrame, name: str, types: dict | None = None) -> Column:
    """Column ``name`` as double with missing or unparseable values as 0."""
    return F.coalesce(F.nanvl(to_double(df, name, types), F.lit(None).cast("double")), F.lit(0.0))


def to_timestamp_or_null(df: DataFrame, name: str, types: dict | None = None) -> Column:
    """Column ``name`` as a timestamp; unparseable text becomes NULL."""
    kind = (types or column_types(df))[name]
    return F.col(name).try_cast("timestamp_ntz") if isinstance(kind, T.StringType) else F.col(name)


def fill_non_finite(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace infinities, NaN and NULL by zero in numeric columns (text: ``'0'``)."""
    chosen = set(columns or df.columns)
    out = []
    for field in df.schema.fields:
        name, kind = f"`{field.name}`", field.dataType
        if field.name not in chosen:
            out.append(name)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            # NaN sorts above infinity, so one comparison rules out all three.
            out.append(f"if(abs({name}) < double('Infinity'), {name}, CAST(0 AS {kind.simpleString()})) AS {name}")
        elif isinstance(kind, T.NumericType):
            out.append(f"coalesce({name}, CAST(0 AS {kind.simpleString()})) AS {name}")
        elif isinstance(kind, T.StringType):
            out.append(f"coalesce({name}, '0') AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)
