"""The model's input contract: which columns, in which order, of which kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from riskspark import schemas


def project_contract(df: DataFrame, columns: list[str] = schemas.FEATURE_COLUMNS, keep: list[str] | None = None) -> DataFrame:
    """Contract columns present in ``df``, in contract order; absent ones are listed in ``missing_features``."""
    have = set(df.columns)
    present = [n for n in columns if n in have]
    absent = [n for n in columns if n not in have]
    listed = F.array(*[F.lit(n) for n in absent]).cast("array<string>")
    return df.select(*[k for k in keep or [] if k not in present], *present, listed.alias("missing_features"))


def column_kinds(df: DataFrame, exclude: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type; dates and times are neither."""
    skip = set(exclude or [])
    fields = [f for f in df.schema.fields if f.name not in skip]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if isinstance(f.dataType, T.StringType)]


def prepare_matrices(df: DataFrame, label: str = "target", keep: list[str] | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """(features and integer label, numeric columns, categorical columns), service columns dropped."""
    dropped = [n for n in schemas.SERVICE_COLUMNS if n in df.columns and n not in (keep or [])]
    out = df.drop(*dropped).withColumn(label, F.col(label).cast("int"))
    numeric, categorical = column_kinds(out, [label, *(keep or [])])
    return out, numeric, categorical
