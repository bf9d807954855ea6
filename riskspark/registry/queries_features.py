"""Registered queries: as-of join, statistics, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.functions import numeric as num
from riskspark.operators import ranking, snapshots, stats
from riskspark.operators.asof import asof_join
from riskspark.operators.quantiles import exact_quantiles, long_metric, order_statistics
from riskspark.plans import catalogue, contract, features
from riskspark.registry.core import Inputs, query
from riskspark.registry.features_sql import (
    OFFLINE_STATS, ONLINE_STATS, SPLIT, TEXT_FEATURES, WITH_BOTH, WITH_OFFLINE, WITH_ONLINE, shown,
)
from riskspark.registry.sqlparts import BEH, MERGED, TX, sig, with_

BEH_SHOWN = ", ".join(
    [f"{n} AS {n}" for n in schemas.BEHAVIOUR_COUNTS + schemas.BEHAVIOUR_LABELS] + [f"{sig(n)} AS {n}" for n in schemas.BEHAVIOUR_MEASURES]
)
_ASOF_SQL = with_(TX, BEH, MERGED) + f"SELECT docno, {BEH_SHOWN} FROM mg"


def _asof(i: Inputs, hot_rows):
    snapshots = i.behaviour.withColumnRenamed("transdate", "snapshot_ts")
    return asof_join(i.tx, snapshots, "cst_dim_id", "transdatetime", "snapshot_ts", schemas.BEHAVIOUR_COLUMNS, hot_rows=hot_rows).select(
        "docno", *schemas.BEHAVIOUR_COLUMNS
    )


@query("J1_asof_join", _ASOF_SQL)
def _(i):
    return _asof(i, 2_000_000)


@query("J1_asof_join_hot_keys", _ASOF_SQL)
def _(i):
    return _asof(i, 30)


_VOLUME_SQL = """WITH r AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL),
l AS (SELECT o.o_custkey, l.l_shipdate, l.l_extendedprice FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l.o_custkey, CAST(l.l_shipdate AS VARCHAR) AS shipdate, {price} AS price, r.o_orderkey AS matched_order
FROM l ASOF LEFT JOIN r ON l.o_custkey = r.o_custkey AND l.l_shipdate >= r.o_orderdate""".format(price=sig("l.l_extendedprice"))


@query("J2_asof_tie_rule", _VOLUME_SQL)
def _(i):
    orders = i.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = i.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_shipdate", "l_extendedprice")
    matched = asof_join(lines, orders, "o_custkey", "l_shipdate", "o_orderdate", ["o_orderkey"], tie_break=["o_orderkey"])
    return matched.select(
        "o_custkey",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipdate"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderkey").alias("matched_order"),
    )


CUST = ["cust_amount_mean", "cust_amount_std", "cust_amount_max", "cust_txn_count"]
CUST_SQL = ", ".join(f"{sig(n)} AS {n}" for n in CUST)


@query("J3_customer_join", with_(TX, BEH, ONLINE_STATS) + f"SELECT docno, {CUST_SQL} FROM tx LEFT JOIN on_cust USING (cst_dim_id)")
def _(i):
    return features.attach_customers(i.tx, stats.stored_customers(stats.customer_agg_online(i.tx))).select("docno", *CUST)


STAT_NAMES = ["amount_q99", "amount_high_thresh", "amount_mean", "amount_std", "burst_q90", "cust_txn_q75", "cust_txn_q90"]
STATS_SQL = ", ".join(f"{sig(n)} AS {n}" for n in STAT_NAMES)


@query("J4_global_stats_join", with_(TX, BEH, ONLINE_STATS) + f"SELECT docno, {STATS_SQL} FROM tx CROSS JOIN on_stats")
def _(i):
    row = i.online_stats.row(i.spark, "online")
    return features.attach_globals(i.tx, row, STAT_NAMES).select("docno", *STAT_NAMES)


@query("J5_shared_clip", WITH_ONLINE + f"SELECT docno, {shown('amount_clipped')}, {shown('amount_log')}, {shown('is_high_amount')} FROM onf")
def _(i):
    return i.online().select("docno", "amount_clipped", "amount_log", "is_high_amount")


_RARE_SQL = """WITH r AS (SELECT CAST(p_size AS VARCHAR) AS v FROM part GROUP BY 1 HAVING count(*) < 40)
SELECT p_partkey, CASE WHEN CAST(p_size AS VARCHAR) IN (SELECT v FROM r) THEN 'OTHER' ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part"""


@query("J9_rare_membership", _RARE_SQL)
def _(i):
    parts = i.table("part").select("p_partkey", "p_size")
    return features.group_rare(parts, "p_size", stats.rare_values(parts, "p_size", 40))


@query(
    "J10_train_stats_on_test",
    with_(TX, BEH, MERGED, SPLIT, OFFLINE_STATS)
    + "SELECT t.docno, "
    + ", ".join(f"{sig(f'coalesce({n}, 0)')} AS {n}" for n in CUST)
    + " FROM tx t JOIN sp USING (docno) LEFT JOIN off_cust c ON t.cst_dim_id = c.cst_dim_id WHERE is_test = 1",
)
def _(i):
    joined = features.attach_customers(i.test, stats.stored_customers(stats.customer_agg_offline(i.train)))
    return joined.select("docno", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in CUST])


# --- statistics ------------------------------------------------------------------------------

W_ON = with_(TX, BEH, ONLINE_STATS)
W_OFF = with_(TX, BEH, MERGED, SPLIT, OFFLINE_STATS)


@query("A1_customer_agg_online", W_ON + f"SELECT cst_dim_id, {CUST_SQL} FROM on_cust")
def _(i):
    return stats.customer_agg_online(i.tx)


@query("A2_customer_agg_offline", W_OFF + f"SELECT cst_dim_id, {CUST_SQL} FROM off_cust")
def _(i):
    return stats.customer_agg_offline(i.train)


def _scalars(i, values: dict, names: list[str]):
    row = [float(values[n]) for n in names]
    return i.spark.createDataFrame([row], ", ".join(f"{n} double" for n in names))


AMOUNT_NAMES = STAT_NAMES[:4]


@query("A3_amount_stats_online", W_ON + "SELECT " + ", ".join(f"{sig(n)} AS {n}" for n in AMOUNT_NAMES) + " FROM on_stats")
def _(i):
    return _scalars(i, stats.fit_online(i.tx, i.behaviour).scalars, AMOUNT_NAMES)


@query("A4_amount_stats_offline", W_OFF + "SELECT " + ", ".join(f"{sig(n)} AS {n}" for n in AMOUNT_NAMES) + " FROM off_stats")
def _(i):
    return _scalars(i, stats.fit_offline(i.train.select("amount")).scalars, AMOUNT_NAMES)


@query("A5_amount_bins", W_OFF + f"SELECT edge_no, {sig('e[edge_no]')} AS edge FROM off_stats CROSS JOIN range(1, 7) r(edge_no)")
def _(i):
    edges = stats.fit_offline(i.train.select("amount")).amount_bins
    return i.spark.createDataFrame([(n, e) for n, e in enumerate(edges, 1)], "edge_no long, edge double")


@query(
    "A6_burst_q90",
    with_(TX, BEH, MERGED, ONLINE_STATS, SPLIT, OFFLINE_STATS)
    + f"SELECT {sig('(SELECT burst_q90 FROM on_stats)')} AS online, {sig('(SELECT burst_q90 FROM off_stats)')} AS offline",
)
def _(i):
    values = {"online": stats.fit_online(i.tx, i.behaviour).scalars["burst_q90"]}
    values["offline"] = stats.fit_offline(i.train.select("burstiness_login_interval")).scalars["burst_q90"]
    return _scalars(i, values, ["online", "offline"])


@query(
    "A7_customer_count_quantiles",
    with_(TX, BEH, MERGED, ONLINE_STATS, SPLIT, OFFLINE_STATS)
    + "SELECT "
    + ", ".join(f"{sig(f'{t}.cust_txn_q{q}')} AS {n}_q{q}" for n, t in (("online", "on_stats"), ("offline", "off_stats")) for q in (75, 90))
    + " FROM on_stats CROSS JOIN off_stats",
)
def _(i):
    values = {}
    for name, frame, method in (("online", i.tx, "disc"), ("offline", i.train, "linear")):
        long = long_metric(stats.customer_counts(frame), "n", F.col("n"))
        found = order_statistics(long, {"n": [(method, 0.75), (method, 0.90)]})["n"]
        pick = found.discrete if method == "disc" else found.linear
        values.update({f"{name}_q75": pick(0.75), f"{name}_q90": pick(0.90)})
    return _scalars(i, values, ["online_q75", "online_q90", "offline_q75", "offline_q90"])


@query(
    "A8_rare_set",
    W_OFF + "SELECT coalesce(last_phone_model_categorical, 'nan') AS value, count(*) AS n FROM tr GROUP BY 1 HAVING count(*) < 250",
)
def _(i):
    return stats.rare_values(i.train, "last_phone_model_categorical", 250)


def merged_snapshot(i):
    """Three snapshots of disjoint rows, merged one after the other."""
    parts = [snapshots.StatsSnapshot.of(i.tx.where(f"docno % 3 = {k}"), i.behaviour.where(f"cst_dim_id % 3 = {k}")).stored() for k in range(3)]
    return i._once("merged_snapshot", lambda: parts[0].merge(parts[1]).stored().merge(parts[2]).stored())


@query("A1_merged_customers", W_ON + f"SELECT cst_dim_id, {CUST_SQL} FROM on_cust")
def _(i):
    return merged_snapshot(i).customer_table()


@query("A3_merged_amount_stats", W_ON + "SELECT " + ", ".join(f"{sig(n)} AS {n}" for n in AMOUNT_NAMES) + " FROM on_stats")
def _(i):
    return _scalars(i, merged_snapshot(i).fit().scalars, AMOUNT_NAMES)


@query("A9_fit_feature_stats", W_OFF + f"SELECT {STATS_SQL} FROM off_stats")
def _(i):
    return _scalars(i, stats.fit_offline(i.train).scalars, STAT_NAMES)


@query(
    "A10_class_balance",
    with_(TX)
    + f"""SELECT sum(1 - target)::BIGINT AS negatives, sum(target)::BIGINT AS positives, {sig('avg(target)')} AS positive_share,
    {sig('sum(1 - target) / sum(target)::DOUBLE')} AS scale_pos_weight FROM tx""",
)
def _(i):
    return stats.class_balance(i.tx)


_PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@query(
    "A11_exact_quantiles_disc",
    " UNION ALL ".join(f"SELECT {sig(str(p))} AS p, {sig(f'quantile_disc(l_extendedprice, {p})')} AS value FROM lineitem" for p in _PS),
)
def _(i):
    return exact_quantiles(i.table("lineitem"), F.col("l_extendedprice"), _PS, "disc")


@query(
    "A11_exact_quantiles_linear",
    " UNION ALL ".join(f"SELECT {sig(str(p))} AS p, {sig(f'quantile_cont(l_extendedprice, {p})')} AS value FROM lineitem" for p in _PS),
)
def _(i):
    return exact_quantiles(i.table("lineitem"), F.col("l_extendedprice"), _PS, "linear")


# --- single features, both profiles ------------------------------------------------------------

# The catalogue's derived features in contract order, after the 19 passthrough columns.
DERIVED = schemas.FEATURE_COLUMNS[19:]


def _register_feature(number: int, name: str) -> None:
    off = shown(name, "b.", f"{name}_offline", offline=True)
    sql = WITH_BOTH + f"SELECT a.docno, {shown(name, 'a.', f'{name}_online')}, {off} FROM onf a JOIN offf b USING (docno)"

    @query(f"F{number}_{name}", sql)
    def _(i: Inputs):
        offline = F.col(name)
        if name == "amount_bin":  # the label text is checked against pandas in the tests
            offline = catalogue.amount_bin_index(F.col("amount_clipped"), i.offline_stats.amount_bins)
        return i.paired_table.select("docno", F.col(f"online.{name}").alias(f"{name}_online"), offline.alias(f"{name}_offline"))


for _n, _name in enumerate(DERIVED, 1):
    _register_feature(_n, _name)


# --- whole profiles ------------------------------------------------------------------------------

ALL = [n for n in schemas.FEATURE_COLUMNS if n != "docno"]


@query(
    "P1_features_online",
    WITH_ONLINE + "SELECT cst_dim_id, CAST(transdate AS VARCHAR) AS transdate, docno, " + ", ".join(shown(n) for n in ALL) + " FROM onf",
)
def features_online_query(i):
    view = features.features_online(i.tx, i.behaviour)
    return view.withColumn("transdate", F.col("transdate").cast("string"))


@query("P2_features_offline", WITH_OFFLINE + "SELECT docno, " + ", ".join(shown(n, offline=True) for n in ALL) + " FROM offf")
def _(i):
    fitted = stats.fit_offline(i.train)
    built = features.features_offline(i.merged, fitted)
    return built.withColumn("amount_bin", catalogue.amount_bin_index(F.col("amount_clipped"), fitted.amount_bins)).select("docno", *ALL)


_TEXT_TS = "CASE WHEN event_id % 7 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"


@query(
    "P3_datetime_coercion",
    f"""SELECT event_id, coalesce(hour(TRY_CAST({_TEXT_TS} AS TIMESTAMP)), -1) AS hour,
    coalesce((dayofweek(TRY_CAST({_TEXT_TS} AS TIMESTAMP)) + 6) % 7, -1) AS weekday FROM events""",
)
def _(i):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = i.table("events").select("event_id", text.alias("transdatetime"))
    ts = num.to_timestamp_or_null(rows, "transdatetime")
    return rows.select("event_id", catalogue.OFFLINE.hour(ts).alias("hour"), catalogue.OFFLINE.weekday(ts).alias("weekday"))


@query(
    "P4_numeric_coercion",
    f"SELECT event_id, {sig('CASE WHEN event_id % 5 = 0 THEN 0 ELSE value END')} AS value FROM events",
)
def _(i):
    text = F.when(F.col("event_id") % 10 == 0, F.lit("1d")).when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("value").cast("string"))
    rows = i.table("events").select("event_id", text.alias("value"))
    return rows.select("event_id", num.coerce_to_zero(rows, "value").alias("value"))


@query(
    "P5_fill_non_finite",
    f"""SELECT event_id, {sig('CASE WHEN event_id % 4 < 3 THEN 0 ELSE value END')} AS value,
    CASE WHEN event_id % 6 = 0 THEN '0' ELSE event_type END AS event_type FROM events""",
)
def _(i):
    broken = (
        F.when(F.col("event_id") % 4 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 4 == 1, F.lit(float("nan")))
        .when(F.col("event_id") % 4 == 2, F.lit(None))
        .otherwise(F.col("value"))
    )
    kind = F.when(F.col("event_id") % 6 != 0, F.col("event_type"))
    return num.fill_non_finite(i.table("events").select("event_id", broken.alias("value"), kind.alias("event_type")))


@query("P6_null_safe_division", f"SELECT event_id, {sig('value / NULLIF(CAST(event_id % 3 AS DOUBLE), 0)')} AS ratio FROM events")
def _(i):
    return i.table("events").select("event_id", num.null_safe_ratio(F.col("value"), (F.col("event_id") % 3).cast("double")).alias("ratio"))


@query(
    "P7_default_flags",
    with_(TX) + "SELECT docno, -1 AS hour, -1 AS weekday, 0 AS is_night, 0 AS is_weekend, 'ALL' AS amount_bin, 0 AS is_high_amount, 0.0::DOUBLE AS amount_clipped, 0 AS cust_is_heavy_q75 FROM tx",
)
def _(i):
    bare = i.tx.select("docno", "direction")
    built = features.features_offline(bare, stats.fit_offline(bare))
    return built.select("docno", "hour", "weekday", "is_night", "is_weekend", "amount_bin", "is_high_amount", "amount_clipped", "cust_is_heavy_q75")


@query(
    "P8_feature_contract",
    with_(TX) + f"SELECT docno, {sig('amount')} AS amount, 'hour,iforest_score' AS missing FROM tx",
)
def _(i):
    frame = i.tx.select("docno", F.col("amount").cast("double").alias("amount"), "direction")
    out = contract.project_contract(frame, ["amount", "docno", "hour", "iforest_score"])
    return out.select("docno", "amount", F.concat_ws(",", "missing_features").alias("missing"))


@query(
    "P9_column_kinds",
    with_(TX)
    + "SELECT name, kind, (SELECT count(*) FROM tx) AS n_rows FROM (VALUES "
    + ", ".join(f"('{n}', '{'categorical' if n in TEXT_FEATURES else 'numeric'}')" for n in schemas.FEATURE_COLUMNS)
    + ") t(name, kind)",
)
def _(i):
    view = i.online_table
    numeric, text = contract.column_kinds(view, ["cst_dim_id", "transdate"])
    kinds = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for k, ns in (("numeric", numeric), ("categorical", text)) for n in ns])
    return view.select(F.inline(kinds)).groupBy("name", "kind").agg(F.count("*").alias("n_rows"))


@query(
    "P10_prepare_matrices",
    WITH_OFFLINE + f"SELECT docno, target, {shown('amount_log')}, {shown('is_high_burst')}, 77 AS n_features FROM offf JOIN sp USING (docno) WHERE is_test = 1",
)
def _(i):
    matrix, numeric, text = contract.prepare_matrices(i.offline(i.test))
    return matrix.select("docno", "target", "amount_log", "is_high_burst", F.lit(len(numeric) + len(text)).alias("n_features"))


SKEW = [n for n in ALL if n not in TEXT_FEATURES]


def _skew_sql(name: str) -> str:
    differs = f"abs(a.{name} - b.{name}) > 1e-9 * greatest(1, abs(a.{name}))"
    unequal = f"coalesce({differs}, NOT (a.{name} IS NULL AND b.{name} IS NULL))"
    return (
        f"SELECT '{name}' AS feature, count(*) AS n_rows, count(*) FILTER (WHERE {unequal}) AS n_different, "
        f"{sig(f'count(*) FILTER (WHERE {unequal}) / count(*)::DOUBLE')} AS share_different FROM onf a JOIN offf b USING (docno)"
    )


@query("P11_skew_report", WITH_BOTH.replace("onf AS (", "onf AS MATERIALIZED (").replace("offf AS (", "offf AS MATERIALIZED (") + " UNION ALL ".join(_skew_sql(n) for n in SKEW))
def _(i):
    return features.skew_report(i.paired_table, SKEW).drop("mean_abs_diff")


# --- windows and top-k ----------------------------------------------------------------------------


@query(
    "W1_latest_per_key",
    with_(BEH) + f"SELECT cst_dim_id, CAST(transdate AS VARCHAR) AS transdate, {BEH_SHOWN} FROM bh QUALIFY row_number() OVER (PARTITION BY cst_dim_id ORDER BY transdate DESC) = 1",
)
def _(i):
    latest = ranking.latest_per_key(i.behaviour, "cst_dim_id", ["transdate"])
    return latest.withColumn("transdate", F.date_format("transdate", "yyyy-MM-dd HH:mm:ss"))
