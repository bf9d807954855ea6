"""The feature catalogue: each derived feature is declared once.

The warehouse profile (``ONLINE``) and the training profile (``OFFLINE``) differ
in a few rules only - divisors, calendar, missing values, amount labels - which
a ``Profile`` holds; the declarations call those rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from riskspark.functions.numeric import flag, null_safe_ratio

# The divisor offset of the training profile and the alert levels.
EPSILON = 1e-6
MEAN_MULTIPLE = 3.0
MAX_MULTIPLE = 1.5
Z_LEVEL = 2.0

c = F.col


@dataclass(frozen=True)
class Profile:
    """The rules in which the two feature definitions differ."""

    name: str
    hour: Callable[[Column], Column]
    weekday: Callable[[Column], Column]
    log: Callable[[Column], Column]
    ratio: Callable[..., Column]
    amount_bin: Callable[[Column, list[float]], Column]


def _offset_ratio(num: Column, den: Column, offset: float = EPSILON) -> Column:
    return num / (den + F.lit(offset))


def _plain_ratio(num: Column, den: Column, offset: float = EPSILON) -> Column:
    return null_safe_ratio(num, den)


def bin_labels(edges: list[float], precision: int = 3) -> list[str]:
    """Interval labels as pandas prints them: ``(a, b]``, the first edge lowered to include it."""

    def rounded(x: float, digits: int) -> float:
        if x == 0 or not math.isfinite(x):
            return x
        whole, fraction = int(x), abs(x - int(x))
        if whole == 0:
            digits = -math.floor(math.log10(fraction)) - 1 + digits
        return round(x, digits)

    digits = next((p for p in range(precision, 20) if len({rounded(e, p) for e in edges}) == len(edges)), precision)
    shown = [rounded(e, digits) for e in edges]
    shown[0] -= 10.0**-digits
    return [f"({a}, {b}]" for a, b in zip(shown, shown[1:])]


def amount_bin_index(clipped: Column, edges: list[float]) -> Column:
    """Right-closed bin number from 0, the lowest edge included; NULL outside the edges."""
    index = F.when(clipped == edges[0], F.lit(0))
    for i, upper in enumerate(edges[1:]):
        index = index.when((clipped > edges[0]) & (clipped <= upper), F.lit(i))
    return index


def _binned_label(clipped: Column, edges: list[float]) -> Column:
    edges = sorted(set(edges))
    if len(edges) < 2:
        return F.lit("ALL")
    labels = F.array(*[F.lit(t) for t in bin_labels(edges)])
    return F.coalesce(F.get(labels, amount_bin_index(clipped, edges)), F.lit("nan"))


ONLINE = Profile(
    name="online",
    hour=lambda ts: F.hour(ts),
    weekday=lambda ts: F.dayofweek(ts) - 1,
    log=lambda x: F.log(F.lit(1.0) + x),
    ratio=_plain_ratio,
    amount_bin=lambda clipped, edges: F.lit("ALL"),
)
OFFLINE = Profile(
    name="offline",
    hour=lambda ts: F.coalesce(F.hour(ts), F.lit(-1)),
    weekday=lambda ts: F.coalesce(F.weekday(ts), F.lit(-1)),
    log=lambda x: F.log1p(x),
    ratio=_offset_ratio,
    amount_bin=_binned_label,
)


def derived_layers(profile: Profile, scalars: dict[str, float | None], edges: list[float]) -> list[dict[str, Column]]:
    """Derived features in layers; a layer refers to passthrough columns and earlier layers."""
    ratio = profile.ratio

    def known(name: str) -> Column:
        return F.lit(scalars.get(name)).cast("double")

    calendar_and_amount = {
        "hour": profile.hour(c("transdatetime")),
        "weekday": profile.weekday(c("transdatetime")),
        "amount_clipped": F.least(F.greatest(F.coalesce(c("amount"), F.lit(0.0)), F.lit(0.0)), known("amount_q99")),
        "freq_change_7d_vs_mean_abs": F.abs("freq_change_7d_vs_mean"),
        "burstiness_abs": F.abs("burstiness_login_interval"),
        "zscore_login_abs": F.abs("zscore_avg_login_interval_7d"),
        "logins_7d_per_day": c("logins_last_7_days") / F.lit(7.0),
        "logins_30d_per_day": c("logins_last_30_days") / F.lit(30.0),
        "login_freq_ratio_7_30": ratio(c("login_frequency_7d"), c("login_frequency_30d")),
        "logins_ratio_7_30": ratio(c("logins_last_7_days"), c("logins_last_30_days"), 1.0),
        "interval_cv_30d": ratio(c("std_login_interval_30d"), c("avg_login_interval_30d")),
        "interval_fano_30d": ratio(c("var_login_interval_30d"), c("avg_login_interval_30d")),
        "ewm_vs_avg_interval": ratio(c("ewm_login_interval_7d"), c("avg_login_interval_30d")),
        "cust_is_heavy_q75": flag(c("cust_txn_count") >= known("cust_txn_q75")),
        "cust_is_heavy_q90": flag(c("cust_txn_count") >= known("cust_txn_q90")),
        "iforest_score": F.lit(0.0),
        "lof_score": F.lit(0.0),
    }
    clip, burst = c("amount_clipped"), c("burstiness_abs")
    flags_and_ratios = {
        "is_night": flag(c("hour").between(0, 6)),
        "is_evening": flag(c("hour").between(18, 23)),
        "is_morning": flag(c("hour").between(6, 11)),
        "is_weekend": flag(c("weekday") >= 5),
        "amount_log": profile.log(clip),
        "amount_bin": profile.amount_bin(clip, edges),
        "is_high_amount": flag(clip >= known("amount_high_thresh")),
        "amount_z_overall": ratio(clip - known("amount_mean"), known("amount_std")),
        "amount_per_login_30d": clip / (F.lit(1.0) + c("logins_last_30_days")),
        "amount_vs_cust_mean": ratio(clip, c("cust_amount_mean")),
        "amount_vs_cust_max": ratio(clip, c("cust_amount_max")),
        "is_high_burst": flag(burst >= known("burst_q90")),
        "amount_x_burst": clip * burst,
        "amount_x_fano": clip * c("fano_factor_login_interval"),
        "amount_x_logins_7d": clip * c("logins_last_7_days"),
        "amount_x_logins_30d": clip * c("logins_last_30_days"),
        "burst_x_logins_7d": burst * c("logins_last_7_days"),
        "burst_x_logins_30d": burst * c("logins_last_30_days"),
        "login_spiky_ratio_max": burst * c("logins_7d_over_30d_ratio"),
    }
    log, high, spiky, heavy = c("amount_log"), c("is_high_amount"), c("is_high_burst"), c("cust_is_heavy_q75")
    night, weekend, evening = c("is_night"), c("is_weekend"), c("is_evening")
    interactions = {
        "amountlog_x_freqchange_abs": log * c("freq_change_7d_vs_mean_abs"),
        "amount_x_login_freq7": log * c("login_frequency_7d"),
        "amount_x_login_freq30": log * c("login_frequency_30d"),
        "night_and_high_amount": night * high,
        "weekend_and_high_amount": weekend * high,
        "night_and_high_burst": night * spiky,
        "weekend_and_high_burst": weekend * spiky,
        "high_burst_and_high_amount": spiky * high,
        "high_amount_and_no_logins30": high * flag(c("logins_last_30_days") == 0),
        "night_x_amount_log": night * log,
        "weekend_x_amount_log": weekend * log,
        "evening_x_amount_log": evening * log,
        "cust_heavy_q75_x_amount": heavy * log,
        "cust_heavy_q75_x_night": heavy * night,
        "cust_heavy_q75_x_burst": heavy * spiky,
        "atypical_amount_vs_mean": flag(c("amount_vs_cust_mean") > MEAN_MULTIPLE),
        "atypical_amount_vs_max": flag(c("amount_vs_cust_max") > MAX_MULTIPLE),
        "high_amount_z_flag": flag(c("amount_z_overall") > Z_LEVEL),
    }
    return [calendar_and_amount, flags_and_ratios, interactions]
