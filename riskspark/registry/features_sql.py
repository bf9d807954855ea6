"""Oracle SQL of the two feature profiles."""

from __future__ import annotations

from riskspark import schemas
from riskspark.operators.stats import BIN_EDGES
from riskspark.registry.sqlparts import BEH, FILLED, KEYS, MERGED, TX, sig, with_

D = "::DOUBLE"
INT_FEATURES = """monthly_os_changes monthly_phone_model_changes hour weekday is_night is_evening is_morning is_weekend
is_high_amount cust_is_heavy_q75 cust_is_heavy_q90 is_high_burst night_and_high_amount weekend_and_high_amount
night_and_high_burst weekend_and_high_burst high_amount_and_no_logins30 cust_heavy_q75_x_night cust_heavy_q75_x_burst
atypical_amount_vs_mean atypical_amount_vs_max high_amount_z_flag high_burst_and_high_amount docno""".split()
TEXT_FEATURES = schemas.BEHAVIOUR_LABELS + ["amount_bin"]


def _flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def derived(online: bool) -> list[str]:
    """Select lists, one per level, over a frame with inputs, customer columns and statistics."""

    def ratio(a: str, b: str, offset: str = "1e-6") -> str:
        return f"({a}) / NULLIF({b}, 0)" if online else f"({a}) / ({b} + {offset}{D})"

    hour = "hour(transdatetime)" if online else "coalesce(hour(transdatetime), -1)"
    weekday = "dayofweek(transdatetime)" if online else "coalesce((dayofweek(transdatetime) + 6) % 7, -1)"
    level1 = {
        "hour": hour,
        "weekday": weekday,
        "amount_clipped": f"least(greatest(coalesce(amount, 0{D}), 0{D}), amount_q99)",
        "freq_change_7d_vs_mean_abs": "abs(freq_change_7d_vs_mean)",
        "burstiness_abs": "abs(burstiness_login_interval)",
        "zscore_login_abs": "abs(zscore_avg_login_interval_7d)",
        "logins_7d_per_day": f"logins_last_7_days / 7{D}",
        "logins_30d_per_day": f"logins_last_30_days / 30{D}",
        "login_freq_ratio_7_30": ratio("login_frequency_7d", "login_frequency_30d"),
        "logins_ratio_7_30": ratio("logins_last_7_days", "logins_last_30_days", "1.0"),
        "interval_cv_30d": ratio("std_login_interval_30d", "avg_login_interval_30d"),
        "interval_fano_30d": ratio("var_login_interval_30d", "avg_login_interval_30d"),
        "ewm_vs_avg_interval": ratio("ewm_login_interval_7d", "avg_login_interval_30d"),
        "cust_is_heavy_q75": _flag("cust_txn_count >= cust_txn_q75"),
        "cust_is_heavy_q90": _flag("cust_txn_count >= cust_txn_q90"),
        "iforest_score": f"0{D}",
        "lof_score": f"0{D}",
    }
    level2 = {
        "is_night": _flag("hour BETWEEN 0 AND 6"),
        "is_evening": _flag("hour BETWEEN 18 AND 23"),
        "is_morning": _flag("hour BETWEEN 6 AND 11"),
        "is_weekend": _flag("weekday >= 5"),
        "amount_log": "ln(1 + amount_clipped)",
        "amount_bin": "'ALL'" if online else "CASE WHEN amount_clipped BETWEEN e[1] AND e[2] THEN 0 WHEN amount_clipped > e[2] AND amount_clipped <= e[3] THEN 1 WHEN amount_clipped > e[3] AND amount_clipped <= e[4] THEN 2 WHEN amount_clipped > e[4] AND amount_clipped <= e[5] THEN 3 WHEN amount_clipped > e[5] AND amount_clipped <= e[6] THEN 4 END",
        "is_high_amount": _flag("amount_clipped >= amount_high_thresh"),
        "amount_z_overall": ratio("amount_clipped - amount_mean", "amount_std"),
        "amount_per_login_30d": f"amount_clipped / (1{D} + logins_last_30_days)",
        "amount_vs_cust_mean": ratio("amount_clipped", "cust_amount_mean"),
        "amount_vs_cust_max": ratio("amount_clipped", "cust_amount_max"),
        "is_high_burst": _flag("burstiness_abs >= burst_q90"),
        "amount_x_burst": "amount_clipped * burstiness_abs",
        "amount_x_fano": "amount_clipped * fano_factor_login_interval",
        "amount_x_logins_7d": "amount_clipped * logins_last_7_days",
        "amount_x_logins_30d": "amount_clipped * logins_last_30_days",
        "burst_x_logins_7d": "burstiness_abs * logins_last_7_days",
        "burst_x_logins_30d": "burstiness_abs * logins_last_30_days",
        "login_spiky_ratio_max": "burstiness_abs * logins_7d_over_30d_ratio",
    }
    both = lambda a, b: _flag(f"{a} = 1 AND {b} = 1")
    gated = lambda a: f"CASE WHEN {a} = 1 THEN amount_log ELSE 0 END"
    level3 = {
        "amountlog_x_freqchange_abs": "amount_log * freq_change_7d_vs_mean_abs",
        "amount_x_login_freq7": "amount_log * login_frequency_7d",
        "amount_x_login_freq30": "amount_log * login_frequency_30d",
        "night_and_high_amount": both("is_night", "is_high_amount"),
        "weekend_and_high_amount": both("is_weekend", "is_high_amount"),
        "night_and_high_burst": both("is_night", "is_high_burst"),
        "weekend_and_high_burst": both("is_weekend", "is_high_burst"),
        "high_burst_and_high_amount": both("is_high_burst", "is_high_amount"),
        "high_amount_and_no_logins30": _flag("is_high_amount = 1 AND logins_last_30_days = 0"),
        "night_x_amount_log": gated("is_night"),
        "weekend_x_amount_log": gated("is_weekend"),
        "evening_x_amount_log": gated("is_evening"),
        "cust_heavy_q75_x_amount": gated("cust_is_heavy_q75"),
        "cust_heavy_q75_x_night": both("cust_is_heavy_q75", "is_night"),
        "cust_heavy_q75_x_burst": both("cust_is_heavy_q75", "is_high_burst"),
        "atypical_amount_vs_mean": _flag("amount_vs_cust_mean > 3.0"),
        "atypical_amount_vs_max": _flag("amount_vs_cust_max > 1.5"),
        "high_amount_z_flag": _flag("amount_z_overall > 2.0"),
    }
    return [", ".join(f"{v} AS {k}" for k, v in level.items()) for level in (level1, level2, level3)]


ONLINE_STATS = """on_cust AS (
  SELECT cst_dim_id, avg(CAST(amount AS DOUBLE)) AS cust_amount_mean, coalesce(stddev_pop(CAST(amount AS DOUBLE)), 0) AS cust_amount_std,
         max(CAST(amount AS DOUBLE)) AS cust_amount_max, CAST(count(*) AS DOUBLE) AS cust_txn_count
  FROM tx GROUP BY cst_dim_id),
on_stats AS (
  SELECT (SELECT quantile_disc(CAST(amount AS DOUBLE), 0.99) FROM tx) AS amount_q99,
         (SELECT quantile_disc(CAST(amount AS DOUBLE), 0.90) FROM tx) AS amount_high_thresh,
         (SELECT avg(CAST(amount AS DOUBLE)) FROM tx) AS amount_mean,
         (SELECT coalesce(stddev_pop(CAST(amount AS DOUBLE)), 1) FROM tx) AS amount_std,
         (SELECT quantile_disc(abs(burstiness_login_interval), 0.90) FROM bh) AS burst_q90,
         (SELECT quantile_disc(cust_txn_count, 0.75) FROM on_cust) AS cust_txn_q75,
         (SELECT quantile_disc(cust_txn_count, 0.90) FROM on_cust) AS cust_txn_q90)"""

_ON = derived(True)
ONLINE = f"""on_base AS (SELECT {KEYS}, {FILLED} FROM mg),
on0 AS (SELECT b.*, c.* EXCLUDE (cst_dim_id), s.* FROM on_base b LEFT JOIN on_cust c ON b.cst_dim_id = c.cst_dim_id CROSS JOIN on_stats s),
on1 AS (SELECT *, {_ON[0]} FROM on0), on2 AS (SELECT *, {_ON[1]} FROM on1), onf AS (SELECT *, {_ON[2]} FROM on2)"""

# Rows are split by the rank of a hash inside each label; sizes by largest remainder.
SPLIT = """sp_h AS (
  SELECT docno, target, CAST(('0x' || substr(md5(docno || '|42'), 1, 13)) AS BIGINT) AS h FROM tx),
sp_n AS (
  SELECT target, count(*) AS n, ceil((SELECT count(*) FROM tx) * 0.2) AS w, (SELECT count(*) FROM tx) AS t FROM tx GROUP BY target),
sp_f AS (SELECT target, n, w, n * w / t AS exact, floor(n * w / t) AS lo FROM sp_n),
sp_k AS (
  SELECT target, lo + CASE WHEN row_number() OVER (ORDER BY exact - lo DESC, target) <= w - sum(lo) OVER () THEN 1 ELSE 0 END AS k FROM sp_f),
sp AS (
  SELECT docno, CASE WHEN row_number() OVER (PARTITION BY h.target ORDER BY h.h) <= k THEN 1 ELSE 0 END AS is_test
  FROM sp_h h JOIN sp_k k ON h.target = k.target)"""

_EDGE = ", ".join(f"quantile_cont(a_clip, {p})" for p in BIN_EDGES)
OFFLINE_STATS = f"""tr AS (SELECT m.* FROM mg m JOIN sp USING (docno) WHERE is_test = 0),
off_q AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.99) AS amount_q99 FROM tr),
off_clip AS (SELECT least(greatest(CAST(amount AS DOUBLE), 0), amount_q99) AS a_clip, amount_q99 FROM tr CROSS JOIN off_q),
off_amt AS (
  SELECT any_value(amount_q99) AS amount_q99, quantile_cont(a_clip, 0.9) AS amount_high_thresh, avg(a_clip) AS amount_mean,
         CASE WHEN stddev_pop(a_clip) > 0 THEN stddev_pop(a_clip) ELSE 1 END AS amount_std, [{_EDGE}] AS e FROM off_clip),
off_cust AS (
  SELECT cst_dim_id, avg(CAST(amount AS DOUBLE)) AS cust_amount_mean, coalesce(stddev_samp(CAST(amount AS DOUBLE)), 0) AS cust_amount_std,
         max(CAST(amount AS DOUBLE)) AS cust_amount_max, CAST(count(*) AS DOUBLE) AS cust_txn_count FROM tr GROUP BY cst_dim_id),
off_stats AS (
  SELECT a.*, (SELECT quantile_cont(abs(coalesce(burstiness_login_interval, 0)), 0.9) FROM tr) AS burst_q90,
         (SELECT quantile_cont(cust_txn_count, 0.75) FROM off_cust) AS cust_txn_q75,
         (SELECT quantile_cont(cust_txn_count, 0.90) FROM off_cust) AS cust_txn_q90 FROM off_amt a),
rare_phone AS (SELECT coalesce(last_phone_model_categorical, 'nan') AS v FROM tr GROUP BY 1 HAVING count(*) < 30),
rare_os AS (SELECT coalesce(last_os_categorical, 'nan') AS v FROM tr GROUP BY 1 HAVING count(*) < 30)"""

_LABELS = ", ".join(
    f"CASE WHEN coalesce({n}, 'nan') IN (SELECT v FROM {t}) THEN 'OTHER' ELSE coalesce({n}, 'nan') END AS {n}"
    for n, t in (("last_phone_model_categorical", "rare_phone"), ("last_os_categorical", "rare_os"))
)
_NUMBERS = ", ".join(f"CAST(coalesce({n}, 0) AS DOUBLE) AS {n}" for n in schemas.BEHAVIOUR_NUMERIC)
_OFF = derived(False)
OFFLINE = f"""off_base AS (SELECT {KEYS}, {_NUMBERS}, {_LABELS} FROM mg),
off0 AS (
  SELECT b.*, coalesce(c.cust_amount_mean, 0) AS cust_amount_mean, coalesce(c.cust_amount_std, 0) AS cust_amount_std,
         coalesce(c.cust_amount_max, 0) AS cust_amount_max, coalesce(c.cust_txn_count, 0) AS cust_txn_count, s.*
  FROM off_base b LEFT JOIN off_cust c ON b.cst_dim_id = c.cst_dim_id CROSS JOIN off_stats s),
off1 AS (SELECT *, {_OFF[0]} FROM off0), off2 AS (SELECT *, {_OFF[1]} FROM off1), offf AS (SELECT *, {_OFF[2]} FROM off2)"""

WITH_ONLINE = with_(TX, BEH, MERGED, ONLINE_STATS, ONLINE)
WITH_OFFLINE = with_(TX, BEH, MERGED, SPLIT, OFFLINE_STATS, OFFLINE)
WITH_BOTH = with_(TX, BEH, MERGED, ONLINE_STATS, ONLINE, SPLIT, OFFLINE_STATS, OFFLINE)


def shown(name: str, prefix: str = "", alias: str | None = None, offline: bool = False) -> str:
    """A feature as the registry prints it."""
    exact = name in TEXT_FEATURES or (name in INT_FEATURES and not (offline and name.startswith("monthly_")))
    value = f"{prefix}{name}" if exact else sig(f"{prefix}{name}")
    return f"{value} AS {alias or name}"
