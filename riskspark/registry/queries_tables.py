"""Registered queries: sources, sinks, cleaning, lookups, payloads, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from riskspark import schemas
from riskspark.functions.cleaning import clean_id, clean_numeric
from riskspark.operators import lookup, ranking
from riskspark.registry.core import Inputs, query
from riskspark.registry.features_sql import WITH_ONLINE, shown
from riskspark.registry.sqlparts import TX, sig, with_
from riskspark.session import scratch_path
from riskspark.sources import csv, tables

# --- cleaning: a messy export printed from the customer table ---------------------------------


def messy(i: Inputs):
    """All-text export: padded ids, decimal commas in quotes, a mixed column, plain text."""
    key = F.col("c_custkey")
    return i.table("customer").select(
        F.concat(F.lit(" "), key.cast("string"), F.lit(".0")).alias("cst_dim_id"),
        F.concat(F.lit('"'), F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ","), F.lit('"')).alias("balance"),
        F.when(key % 10 < 4, key.cast("string")).otherwise(F.lit("n/a")).alias("mixed"),
        F.col("c_mktsegment").alias("segment"),
    )


def export(i: Inputs) -> str:
    """The messy table as CSV files, a sub-header as first data row."""

    def write() -> str:
        path = scratch_path(i.spark, "raw-export")
        head = i.spark.createDataFrame([("id", "amount", "mixed", "text")], "cst_dim_id string, balance string, mixed string, segment string")
        head.coalesce(1).unionByName(messy(i)).write.option("header", True).option("quote", '"').option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
        return path

    return i._once("raw_export", write)


_MESSY = """mx AS (
  SELECT ' ' || c_custkey || '.0' AS cst_dim_id, '"' || replace(CAST(c_acctbal AS VARCHAR), '.', ',') || '"' AS balance,
         CASE WHEN c_custkey % 10 < 4 THEN CAST(c_custkey AS VARCHAR) ELSE 'n/a' END AS mixed, c_mktsegment AS segment,
         c_custkey, c_acctbal FROM customer)"""
_RAW_COLS = "cst_dim_id, balance, mixed, segment"


@query("E1_read_raw_csv", f"WITH {_MESSY} SELECT {_RAW_COLS} FROM mx UNION ALL SELECT 'id', 'amount', 'mixed', 'text'")
def _(i):
    return csv.read_raw_csv(i.spark, export(i))


@query("E2_drop_subheader", f"WITH {_MESSY} SELECT {_RAW_COLS} FROM mx")
def _(i):
    return csv.drop_subheader(csv.read_raw_csv(i.spark, export(i), "_number"), number="_number")


@query("E3_clean_id", f"WITH {_MESSY} SELECT cst_dim_id AS raw, c_custkey AS cleaned FROM mx")
def _(i):
    return messy(i).select(F.col("cst_dim_id").alias("raw"), clean_id(F.col("cst_dim_id")).alias("cleaned"))


_LIKE = "regexp_full_match({c}, '[0-9\\s.,\\-]+')"


@query(
    "E4_detect_numeric_like",
    f"WITH {_MESSY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {sig('avg(CAST(' + _LIKE.format(c=c) + ' AS INT))')} AS share, "
        f"CASE WHEN avg(CAST({_LIKE.format(c=c)} AS INT)) > 0.3 THEN 1 ELSE 0 END AS is_numeric FROM mx"
        for c in ("balance", "mixed", "segment")
    ),
)
def _(i):
    shares = csv.numeric_shares(messy(i))
    return shares.withColumn("is_numeric", (F.col("share") > csv.NUMERIC_SHARE).cast("int"))


@query(
    "E5_clean_numeric",
    f"""WITH {_MESSY} SELECT c_custkey, {sig('c_acctbal')} AS balance,
    {sig('CASE WHEN c_custkey % 10 < 4 THEN c_custkey END')} AS mixed FROM mx""",
)
def _(i):
    return messy(i).select(clean_id(F.col("cst_dim_id")).alias("c_custkey"), clean_numeric(F.col("balance")).alias("balance"), clean_numeric(F.col("mixed")).alias("mixed"))


@query(
    "E6_convert_raw",
    f"""WITH {_MESSY} SELECT c_custkey AS cst_dim_id, balance, {sig('CASE WHEN c_custkey % 10 < 4 THEN c_custkey END')} AS mixed, segment FROM mx""",
)
def _(i):
    target = scratch_path(i.spark, "clean-export")
    csv.convert_raw(i.spark, export(i), target)
    return csv.read_raw_csv(i.spark, target).select(
        F.col("cst_dim_id").cast("bigint"), "balance", F.col("mixed").cast("double"), "segment"
    )


@query(
    "E7_load_table",
    with_(TX) + f"SELECT cst_dim_id, CAST(transdate AS VARCHAR) AS transdate, docno, direction, target, {sig('amount')} AS amount, CAST(epoch_us(transdatetime) AS BIGINT) AS us FROM tx",
)
def _(i):
    path = scratch_path(i.spark, "transactions-csv")
    i.tx.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    loaded = csv.load_table(i.spark, path, schemas.TRANSACTIONS)
    return loaded.select(
        "cst_dim_id", F.col("transdate").cast("string"), "docno", "direction", "target", "amount", F.unix_micros(F.col("transdatetime").cast("timestamp")).alias("us")
    )


@query("E8_read_training_csv", with_(TX) + f"SELECT docno, 'Клиент №' || cst_dim_id AS client, {sig('amount')} AS amount, target FROM tx")
def _(i):
    path = scratch_path(i.spark, "training-csv")
    named = i.tx.select("docno", F.concat(F.lit("Клиент №"), F.col("cst_dim_id").cast("string")).alias("client"), "amount", "target")
    csv.write_training_csv(named, path)
    back = csv.read_training_csv(i.spark, path)
    return back.select(F.col("docno").cast("bigint"), "client", F.col("amount").cast("double"), "target")


@query("E10_write_feature_view", WITH_ONLINE + f"SELECT CAST(transdate AS VARCHAR) AS transdate, docno, {shown('amount_log')}, {shown('is_night')} FROM onf")
def _(i):
    tables.write_feature_view(i.online(), scratch_path(i.spark, "feature-view"), "transaction_features")
    return i.spark.table("transaction_features").select(F.col("transdate").cast("string"), "docno", "amount_log", "is_night")


_SNAP = "SELECT c_mktsegment AS model_name, avg(c_acctbal) AS amount_mean, max(c_acctbal) AS amount_q99 FROM customer WHERE {w} GROUP BY 1"


@query(
    "E11_upsert_stats",
    f"""WITH o AS ({_SNAP.format(w='c_nationkey < 12')}), n AS ({_SNAP.format(w="c_mktsegment IN ('BUILDING', 'MACHINERY')")})
    SELECT model_name, {sig('amount_mean')} AS amount_mean, {sig('amount_q99')} AS amount_q99
    FROM (SELECT * FROM n UNION ALL SELECT * FROM o WHERE model_name NOT IN (SELECT model_name FROM n))""",
)
def _(i):
    def snapshot(condition):
        found = i.table("customer").where(condition).groupBy(F.col("c_mktsegment").alias("model_name"))
        found = found.agg(F.avg("c_acctbal").alias("amount_mean"), F.max("c_acctbal").alias("amount_q99"))
        missing = [n for n in schemas.STATS_COLUMNS if n not in found.columns]
        return found.withColumns({n: F.lit(0.0) for n in missing}).select("model_name", *schemas.STATS_COLUMNS)

    first = scratch_path(i.spark, "stats-1")
    tables.upsert_stats(i.spark, None, snapshot(F.col("c_nationkey") < 12), first)
    merged = tables.upsert_stats(i.spark, first, snapshot(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), scratch_path(i.spark, "stats-2"))
    return merged.select("model_name", "amount_mean", "amount_q99")


# --- requests ------------------------------------------------------------------------------------


def requests(i: Inputs):
    """A request per transaction; every tenth asks for a date without transactions."""
    day = F.when(F.col("docno") % 10 == 0, F.date_add("transdate", 400)).otherwise(F.col("transdate"))
    return i.tx.select(
        "cst_dim_id",
        day.cast("string").alias("transdate"),
        F.date_format("transdatetime", "yyyy-MM-dd HH:mm:ss").alias("transdatetime"),
        F.col("amount").cast("double").alias("amount"),
        F.col("docno").cast("string").alias("docno"),
        F.lit(1).alias("direction"),
        F.col("direction").alias("target"),
    )


_ORDER = ["transdatetime", "docno"]


@query(
    "J6_lookup_features",
    WITH_ONLINE
    + f""", one AS (SELECT * FROM onf QUALIFY row_number() OVER (PARTITION BY cst_dim_id, transdate ORDER BY transdatetime, docno) = 1),
    rq AS (SELECT cst_dim_id, CASE WHEN docno % 10 = 0 THEN transdate + 400 ELSE transdate END AS transdate, docno AS request_docno FROM tx)
    SELECT CAST(request_docno AS VARCHAR) AS request_docno, CASE WHEN docno IS NULL THEN 'not_found' ELSE 'found' END AS status, docno,
    {shown('amount_log')}, {shown('is_high_burst')} FROM rq LEFT JOIN one USING (cst_dim_id, transdate)""",
)
def _(i):
    view = i.online(keep=["transdatetime"])
    return lookup.lookup_features(requests(i), view, _ORDER).select("request_docno", "status", "docno", "amount_log", "is_high_burst")


@query(
    "W2_first_per_key_date",
    WITH_ONLINE + f"SELECT cst_dim_id, CAST(transdate AS VARCHAR) AS transdate, docno, {shown('amount_clipped')} FROM onf QUALIFY row_number() OVER (PARTITION BY cst_dim_id, transdate ORDER BY transdatetime, docno) = 1",
)
def _(i):
    view = i.online(keep=["transdatetime"]).select("cst_dim_id", "transdate", "transdatetime", "docno", "amount_clipped")
    one = lookup.first_per_customer_date(view, _ORDER)
    return one.select("cst_dim_id", F.col("transdate").cast("string"), "docno", "amount_clipped")


@query(
    "J7_validate_requests",
    with_(TX)
    + """SELECT CAST(docno AS VARCHAR) AS request,
    concat_ws(',', CASE WHEN cst_dim_id = 0 THEN 'cst_dim_id' END, CASE WHEN docno % 11 = 0 THEN 'transdate' END,
      CASE WHEN docno % 5 = 0 OR amount = 0 THEN 'amount' END, CASE WHEN docno % 7 = 0 THEN 'docno' END) AS reasons,
    CASE WHEN cst_dim_id <> 0 AND docno % 11 <> 0 AND docno % 5 <> 0 AND amount <> 0 AND docno % 7 <> 0 THEN 1 ELSE 0 END AS accepted FROM tx""",
)
def _(i):
    n = F.col("docno").cast("bigint")
    broken = requests(i).withColumn("request", F.col("docno")).withColumns(
        {
            "transdate": F.when(n % 11 != 0, F.col("transdate")),
            "amount": F.when(n % 5 == 0, F.lit(0.0)).otherwise(F.col("amount")),
            "docno": F.when(n % 7 == 0, F.lit("")).otherwise(F.col("docno")),
        }
    )
    good, bad = lookup.validate_requests(broken)
    accepted = good.select("request", F.lit("").alias("reasons"), F.lit(1).alias("accepted"))
    return accepted.unionByName(bad.select("request", F.concat_ws(",", "reject_reasons").alias("reasons"), F.lit(0).alias("accepted")))


@query("J8_row_to_map", with_(TX) + "SELECT docno, to_json({'cst_dim_id': cst_dim_id, 'docno': docno, 'direction': direction, 'target': NULLIF(target, 0)})::VARCHAR AS features FROM tx")
def _(i):
    rows = i.tx.select("cst_dim_id", "docno", "direction", F.nullif("target", F.lit(0)).alias("target"))
    return lookup.row_to_map(rows).select("docno", "features")


# --- payloads ------------------------------------------------------------------------------------

_PAYLOAD = T.StructType([T.StructField("docno", T.LongType()), T.StructField("target", T.IntegerType())])


def payloads(i: Inputs):
    one = F.to_json(F.struct("docno", "target"))
    body = (
        F.when(F.col("docno") % 5 == 0, F.concat(F.lit('{"features":'), one, F.lit("}")))
        .when(F.col("docno") % 5 == 1, F.concat(F.lit('{"features":['), one, F.lit(","), one, F.lit("]}")))
        .when(F.col("docno") % 5 == 2, one)
        .when(F.col("docno") % 5 == 3, F.lit('{"features": 7}'))
        .otherwise(F.lit("not json"))
    )
    return i.tx.select(F.col("docno").alias("request"), body.alias("payload"), "docno", "target").select("request", "payload")


@query(
    "N1_parse_feature_payload",
    with_(TX)
    + """SELECT docno AS request, 0 AS item, docno, target, 0 AS rejected FROM tx WHERE docno % 5 IN (0, 1, 2)
    UNION ALL SELECT docno, 1, docno, target, 0 FROM tx WHERE docno % 5 = 1
    UNION ALL SELECT docno, NULL, NULL, NULL, 1 FROM tx WHERE docno % 5 IN (3, 4)""",
)
def _(i):
    good, bad = lookup.parse_feature_payload(payloads(i), "payload", _PAYLOAD)
    kept = good.select("request", "item", "docno", "target", F.lit(0).alias("rejected"))
    return kept.unionByName(bad.select("request", F.lit(1).alias("rejected")), allowMissingColumns=True)


@query(
    "N2_parse_prediction",
    with_(TX) + f"SELECT docno, {sig('CASE WHEN docno % 4 <> 0 THEN CAST(amount AS DOUBLE) END')} AS prediction FROM tx",
)
def _(i):
    response = F.when(
        F.col("docno") % 4 != 0,
        F.concat(F.lit('{"results":{"m":{"role":"decision","prediction":['), F.col("amount").cast("string"), F.lit("]}}}")),
    ).otherwise(F.lit('{"results":{"m":{"role":"decision","error":"x"}}}'))
    return i.tx.select("docno", lookup.parse_prediction(response, "m").alias("prediction"))


@query("N3_date_format", with_(TX) + "SELECT docno, strftime(transdatetime, '%Y-%m-%d %H:%M:%S') AS stamp FROM tx")
def _(i):
    return i.tx.select("docno", F.date_format("transdatetime", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


# --- configuration versions, sampling --------------------------------------------------------------

_VERSIONS_SQL = """WITH v AS (
  SELECT 'cfg' || (o_custkey % 40) AS key, o_orderkey AS id, o_orderdate AS m, o_orderstatus = 'F' AS stable, o_orderkey % 3 <> 0 AS valid, o_orderpriority AS body
  FROM orders),
n AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY key ORDER BY m DESC, id DESC) = 1),
s AS (SELECT * FROM v WHERE stable QUALIFY row_number() OVER (PARTITION BY key ORDER BY m DESC, id DESC) = 1)
SELECT n.key, CASE WHEN n.valid THEN 'latest' WHEN s.valid THEN 'stable' ELSE 'error' END AS status,
  CASE WHEN n.valid THEN n.id WHEN s.valid THEN s.id END AS version_id, CASE WHEN n.valid THEN n.body WHEN s.valid THEN s.body END AS body
FROM n LEFT JOIN s USING (key)"""


@query("W5_usable_version", _VERSIONS_SQL)
def _(i):
    versions = i.table("orders").select(
        F.concat(F.lit("cfg"), (F.col("o_custkey") % 40).cast("string")).alias("key"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_orderdate").alias("last_modified"),
        (F.col("o_orderstatus") == "F").alias("stable"),
        (F.col("o_orderkey") % 3 != 0).alias("valid"),
        F.col("o_orderpriority").alias("body"),
    )
    return ranking.usable_version(versions)


@query("W6_sample_rows", with_(TX) + "SELECT docno, target FROM tx ORDER BY CAST(('0x' || substr(md5(docno || '|42'), 1, 13)) AS BIGINT), docno LIMIT 500")
def _(i):
    return ranking.sample_rows(i.tx.select("docno", "target"), "docno", 500)
