"""SQL text shared by the oracles: the input adapters as CTEs, in DuckDB dialect."""

from __future__ import annotations

from riskspark import schemas
from riskspark.sources.fixtures import EWM_DECAY, MODEL_SEEDS

TX = """tx AS (
  SELECT user_id AS cst_dim_id, CAST(ts AS DATE) AS transdate, ts AS transdatetime,
         CAST(value * 100 AS DECIMAL(18,2)) AS amount, event_id AS docno, md5(props) AS direction,
         CASE WHEN (hour(ts) <= 6 AND event_id % 7 = 0) OR value > 200 THEN 1 ELSE 0 END AS target
  FROM events WHERE event_type = 'purchase')"""

BEH = f"""lg AS (
  SELECT user_id, event_id, ts, epoch_us(ts) AS us, CAST(ts AS DATE) AS day,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events WHERE event_type IN ('click', 'view')),
lgap AS (
  SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM lg),
dly AS (
  SELECT user_id, day, count(*) AS logins, count(gap) AS gaps, coalesce(sum(gap), 0) AS gap_sum,
         coalesce(sum(CAST(gap AS HUGEINT) * CAST(gap AS HUGEINT)), 0) AS gap_sq,
         arg_max(k, CAST(us AS HUGEINT) * 100000000 + event_id) AS last_k
  FROM lgap GROUP BY user_id, day),
roll AS (
  SELECT d.user_id, d.day, d.last_k,
         sum(p.logins) FILTER (WHERE p.day >= d.day - 6) AS l7, sum(p.logins) AS l30,
         sum(p.gaps) AS n30, CAST(sum(p.gap_sum) AS DOUBLE) AS s30, CAST(sum(p.gap_sq) AS DOUBLE) AS q30,
         sum(p.gaps) FILTER (WHERE p.day >= d.day - 6) AS n7,
         CAST(sum(p.gap_sum) FILTER (WHERE p.day >= d.day - 6) AS DOUBLE) AS s7,
         sum(pow({EWM_DECAY}, d.day - p.day) * CAST(p.gap_sum AS DOUBLE)) FILTER (WHERE p.day >= d.day - 6) AS ew,
         sum(pow({EWM_DECAY}, d.day - p.day) * p.gaps) FILTER (WHERE p.day >= d.day - 6) AS en
  FROM dly d JOIN dly p ON p.user_id = d.user_id AND p.day BETWEEN d.day - 29 AND d.day
  GROUP BY d.user_id, d.day, d.last_k),
kinds AS (
  SELECT d.user_id, d.day, count(DISTINCT l.k % 5) AS oses, count(DISTINCT l.k % 7) AS phones
  FROM dly d JOIN lg l ON l.user_id = d.user_id AND l.day BETWEEN d.day - 29 AND d.day GROUP BY d.user_id, d.day),
meas AS (
  SELECT r.*, k.oses, k.phones, s30 / NULLIF(CAST(n30 AS DOUBLE), 0) / 1e6 AS avg_i,
         CASE WHEN n30 = 1 THEN 0.0::DOUBLE WHEN n30 > 1 THEN
           greatest(q30 / CAST(n30 AS DOUBLE) - (s30 / CAST(n30 AS DOUBLE)) * (s30 / CAST(n30 AS DOUBLE)), 0.0) / 1e12 END AS var_i,
         s7 / NULLIF(CAST(n7 AS DOUBLE), 0) / 1e6 AS avg7, ew / NULLIF(en, 0) / 1e6 AS ewm,
         l7 / 7.0::DOUBLE AS f7, l30 / 30.0::DOUBLE AS f30
  FROM roll r JOIN kinds k USING (user_id, day)),
bh AS (
  SELECT CAST(day + 1 AS TIMESTAMP) AS transdate, user_id AS cst_dim_id,
         CAST(oses - 1 AS INTEGER) AS monthly_os_changes, CAST(phones - 1 AS INTEGER) AS monthly_phone_model_changes,
         'phone_' || (last_k % 7) AS last_phone_model_categorical, 'os_' || (last_k % 5) AS last_os_categorical,
         CAST(l7 AS INTEGER) AS logins_last_7_days, CAST(l30 AS INTEGER) AS logins_last_30_days,
         f7 AS login_frequency_7d, f30 AS login_frequency_30d,
         (f7 - f30) / NULLIF(f30, 0) AS freq_change_7d_vs_mean,
         CAST(l7 AS DOUBLE) / NULLIF(CAST(l30 AS DOUBLE), 0) AS logins_7d_over_30d_ratio,
         avg_i AS avg_login_interval_30d, sqrt(var_i) AS std_login_interval_30d, var_i AS var_login_interval_30d,
         ewm AS ewm_login_interval_7d,
         (sqrt(var_i) - avg_i) / NULLIF(sqrt(var_i) + avg_i, 0) AS burstiness_login_interval,
         var_i / NULLIF(avg_i, 0) AS fano_factor_login_interval,
         (avg7 - avg_i) / NULLIF(sqrt(var_i), 0) AS zscore_avg_login_interval_7d
  FROM meas)"""

# Transactions with the latest snapshot at or before them (unfilled).
MERGED = """mg AS (
  SELECT t.*, b.* EXCLUDE (cst_dim_id, transdate)
  FROM tx t ASOF LEFT JOIN bh b ON t.cst_dim_id = b.cst_dim_id AND t.transdatetime >= b.transdate)"""

PRED = """pr AS (
  SELECT docno, m.model, target AS y_true,
         round((CAST(('0x' || substr(md5(docno || '|' || m.seed), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE + target) / 2, 2) AS y_proba
  FROM tx CROSS JOIN (VALUES %s) AS m(model, seed))""" % ", ".join(f"('{m}', '{s}')" for m, s in MODEL_SEEDS.items())

FILLED = ", ".join(
    [f"coalesce({n}, 0) AS {n}" for n in schemas.BEHAVIOUR_COUNTS if not n.startswith("logins_")]
    + [f"CAST(coalesce({n}, 0) AS DOUBLE) AS {n}" for n in schemas.BEHAVIOUR_COUNTS if n.startswith("logins_")]
    + [f"CAST(coalesce({n}, 0.0) AS DOUBLE) AS {n}" for n in schemas.BEHAVIOUR_MEASURES]
    + schemas.BEHAVIOUR_LABELS
)
KEYS = "cst_dim_id, transdate, transdatetime, CAST(amount AS DOUBLE) AS amount, docno, direction, target"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sig(expression: str) -> str:
    """Round to single precision, so that summation order does not show."""
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"
