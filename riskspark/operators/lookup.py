"""Request validation, feature lookup and payload parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark import schemas
from riskspark.session import cut_lineage

REQUIRED = [f.name for f in schemas.REQUEST.fields]


def reject_reasons(requests: DataFrame, required: list[str] = REQUIRED) -> Column:
    """Names of the required fields that are missing or hold their type's zero value, in contract order."""
    checks = []
    for name in required:
        value = F.col(name)
        kind = requests.schema[name].dataType
        zero = F.lit(False)
        if isinstance(kind, T.StringType):
            zero = value == F.lit("")
        elif isinstance(kind, T.NumericType):
            zero = value == F.lit(0)
        checks.append(F.when(value.isNull() | zero, F.lit(name)))
    return F.array_compact(F.array(*checks))


def mark_requests(requests: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    return requests.withColumn("reject_reasons", reject_reasons(requests, required))


def validate_requests(requests: DataFrame, required: list[str] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(accepted requests, rejected requests with their reasons)."""
    marked = mark_requests(requests, required)
    valid = F.size("reject_reasons") == 0
    return marked.where(valid).drop("reject_reasons"), marked.where(~valid)


def first_per_customer_date(features: DataFrame, order: list[str]) -> DataFrame:
    """One row per (customer, date): the least by ``order``, by partial aggregation."""
    keys = ["cst_dim_id", "transdate"]
    rest = [n for n in features.columns if n not in keys]
    return (
        features.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def lookup_features(requests: DataFrame, features: DataFrame, order: list[str]) -> DataFrame:
    """Requests with the features of their (customer, date) and a ``found`` / ``not_found`` status.

    Feature columns that the request also has are taken from the features.
    """
    keys = ["cst_dim_id", "transdate"]
    dated = requests.withColumn("transdate", F.col("transdate").try_cast("date"))
    # Only the requested keys are aggregated; on a view partitioned by date this also prunes files.
    wanted = features.join(dated.select(*keys), keys, "left_semi")
    # Stored, so that the join below can be split where many requests share a key.
    single = cut_lineage(first_per_customer_date(wanted, order), "lookup")
    payload = [n for n in single.columns if n not in keys]
    packed = single.select(*keys, F.struct(*payload).alias("_found"))
    kept = [n for n in requests.columns if n not in payload]
    return (
        dated.join(packed, keys, "left")
        .select(
            *kept,
            F.col("docno").alias("request_docno"),
            F.when(F.col("_found").isNull(), F.lit("not_found")).otherwise(F.lit("found")).alias("status"),
            "_found.*",
        )
    )


def row_to_map(df: DataFrame, name: str = "features") -> DataFrame:
    """All columns of each row as one JSON object; NULLs are kept as nulls."""
    return df.select("*", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def parse_feature_payload(df: DataFrame, payload: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(feature rows, rejected rows) of a JSON column.

    Accepts an object or an array of objects, bare or below the key
    ``features``. Input columns are kept; ``item`` numbers the objects.
    """
    body = F.coalesce(F.get_json_object(payload, "$.features"), F.col(payload))
    trimmed = F.trim(body)
    as_array = F.when(trimmed.startswith("["), trimmed).when(
        trimmed.startswith("{"), F.concat(F.lit("["), trimmed, F.lit("]"))
    )
    strict = F.from_json(as_array, T.ArrayType(schema), {"mode": "PERMISSIVE"})
    kept = [F.col(n) for n in df.columns]
    parsed = df.select(*kept, strict.alias("_rows"))
    usable = F.col("_rows").isNotNull() & (F.size("_rows") > 0) & ~F.exists("_rows", lambda r: r.isNull())
    usable = usable & F.exists("_rows", lambda r: F.size(F.map_filter(F.from_json(F.to_json(r), "map<string,string>"), lambda k, v: v.isNotNull())) > 0)
    good = parsed.where(usable).select(*kept, F.posexplode("_rows").alias("item", "_row")).select(*kept, "item", "_row.*")
    bad = parsed.where(~F.coalesce(usable, F.lit(False))).select(*kept, F.lit("payload is not an object or a list of objects").alias("error"))
    return good, bad


def parse_prediction(response: Column, model: str) -> Column:
    """First prediction of one model in a scoring response."""
    return F.get_json_object(response, f"$.results.{model}.prediction[0]").try_cast("double")
