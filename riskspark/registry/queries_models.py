"""Registered queries: evaluation, decisions, scenarios, sampling, anomalies, training, streaming."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.operators import anomaly, decision, metrics, oversample, ranking, sampling, scenarios
from riskspark.operators.knn import as_points, knn_join
from riskspark.operators.target_means import mean_column, ordered_target_means
from riskspark.plans import contract, scoring, training, trees
from riskspark.registry.core import Inputs, query
from riskspark.registry.features_sql import SPLIT, TEXT_FEATURES, WITH_OFFLINE
from riskspark.registry.sqlparts import BEH, MERGED, PRED, TX, sig, with_
from riskspark.session import cut_lineage, scratch_path
from riskspark.sources import csv, fixtures
from riskspark.streaming import score_stream as streaming

BY = ["model"]

# --- evaluation ------------------------------------------------------------------------------------


def grid_values(grid) -> str:
    return "gr AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(grid)) + ") t(thr_index, thr))"


_SWEEP = """sw AS (
  SELECT model, thr_index, thr, count(*) FILTER (WHERE y_true = 0 AND y_proba < thr) AS tn, count(*) FILTER (WHERE y_true = 0 AND y_proba >= thr) AS fp,
         count(*) FILTER (WHERE y_true = 1 AND y_proba < thr) AS fn, count(*) FILTER (WHERE y_true = 1 AND y_proba >= thr) AS tp
  FROM pr CROSS JOIN gr GROUP BY ALL),
sf AS (SELECT *, coalesce(5 * tp / NULLIF(CAST(5 * tp + 4 * fn + fp AS DOUBLE), 0), 0) AS fbeta FROM sw),
best AS (SELECT * FROM sf QUALIFY row_number() OVER (PARTITION BY model ORDER BY fbeta DESC, thr_index) = 1),
auc AS (
  SELECT a.model, sum(CASE WHEN a.y_proba > b.y_proba THEN a.n * b.n WHEN a.y_proba = b.y_proba THEN a.n * b.n / 2.0 ELSE 0 END) / sum(a.n * b.n) AS roc_auc
  FROM (SELECT model, y_proba, count(*) AS n FROM pr WHERE y_true = 1 GROUP BY ALL) a
  JOIN (SELECT model, y_proba, count(*) AS n FROM pr WHERE y_true = 0 GROUP BY ALL) b ON a.model = b.model GROUP BY a.model)"""


def _with_sweep(grid) -> str:
    return with_(TX, PRED, grid_values(grid), _SWEEP)


_RATES = {
    "precision": "coalesce(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0)",
    "recall": "coalesce(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0)",
    "fpr": "coalesce(fp / NULLIF(CAST(fp + tn AS DOUBLE), 0), 0)",
    "accuracy": "(tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE)",
}
_RATES_SQL = ", ".join(f"{sig(v)} AS {k}" for k, v in _RATES.items())
_F1 = "coalesce(2 * tp / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0)"


@query("V1_roc_auc", _with_sweep(metrics.GRID_EVALUATE) + f"SELECT model, {sig('roc_auc')} AS roc_auc FROM auc")
def _(i):
    return metrics.roc_auc(i.predictions, BY)


for _name, _grid in (("train", metrics.GRID_TRAIN), ("evaluate", metrics.GRID_EVALUATE), ("weighted", metrics.GRID_WEIGHTED)):

    def _sweep(i: Inputs, grid=_grid):
        return metrics.threshold_sweep(i.predictions, grid, BY).drop("thr")

    query(f"V2_threshold_sweep_{_name}", _with_sweep(_grid) + f"SELECT model, thr_index, tn, fp, fn, tp, {sig('fbeta')} AS fbeta FROM sf")(_sweep)


@query("V2_best_threshold", _with_sweep(metrics.GRID_TRAIN) + f"SELECT model, thr_index, {sig('thr')} AS best_thr, tn, fp, fn, tp, {sig('fbeta')} AS fbeta FROM best")
def _(i):
    return metrics.best_threshold(metrics.threshold_sweep(i.predictions, metrics.GRID_TRAIN, BY), BY)


_AT_HALF = """cf AS (
  SELECT model, count(*) FILTER (WHERE y_true = 0 AND y_proba < 0.5) AS tn, count(*) FILTER (WHERE y_true = 0 AND y_proba >= 0.5) AS fp,
         count(*) FILTER (WHERE y_true = 1 AND y_proba < 0.5) AS fn, count(*) FILTER (WHERE y_true = 1 AND y_proba >= 0.5) AS tp FROM pr GROUP BY model)"""
W_CF = with_(TX, PRED, _AT_HALF)


def _at_half(i: Inputs):
    return metrics.confusion(i.predictions, 0.5, BY)


@query("V3_confusion", W_CF + "SELECT model, tn, fp, fn, tp FROM cf")
def _(i):
    return _at_half(i)


@query("V4_derived_metrics", W_CF + f"SELECT model, {_RATES_SQL}, {sig('fp / (fp + tn + 1e-9::DOUBLE)')} AS fpr_smooth FROM cf")
def _(i):
    rates = metrics.derived_metrics()
    return _at_half(i).select("model", *[rates[k].alias(k) for k in _RATES], metrics.false_positive_rate(smooth=True).alias("fpr_smooth"))


@query("V5_f1_and_detected", W_CF + f"SELECT model, {sig(_F1)} AS f1, tp + fp AS positives_detected FROM cf")
def _(i):
    return _at_half(i).select("model", metrics.fbeta(1.0).alias("f1"), (F.col("tp") + F.col("fp")).alias("positives_detected"))


_CURVE = """cv AS (
  SELECT model, y_proba, sum(sum(y_true)) OVER w AS cp, sum(sum(1 - y_true)) OVER w AS cn, sum(sum(y_true)) OVER g AS p, sum(sum(1 - y_true)) OVER g AS n
  FROM pr GROUP BY model, y_proba WINDOW w AS (PARTITION BY model ORDER BY y_proba DESC), g AS (PARTITION BY model))"""
_ROC = with_(TX, PRED, _CURVE) + f"SELECT model, {sig('y_proba')} AS thr, {sig('cn / n')} AS fpr, {sig('cp / p')} AS tpr FROM cv"
_PRC = with_(TX, PRED, _CURVE) + f"SELECT model, {sig('y_proba')} AS thr, {sig('cp / (cp + cn)')} AS precision, {sig('cp / p')} AS recall FROM cv"


@query("V6_roc_curve", _ROC)
def _(i):
    return metrics.roc_curve(i.predictions, BY)


@query("V7_pr_curve", _PRC)
def _(i):
    return metrics.pr_curve(i.predictions, BY)


@query(
    "V11_model_curves",
    with_(TX, PRED, _CURVE)
    + f"SELECT model, {sig('y_proba')} AS thr, {sig('cn / n')} AS fpr, {sig('cp / p')} AS tpr, {sig('cp / (cp + cn)')} AS precision FROM cv",
)
def _(i):
    return metrics.both_curves(i.predictions, BY).drop("recall")


def _report_sql() -> str:
    def row(label, tp, fp, fn):
        p = f"coalesce({tp} / NULLIF(CAST({tp} + {fp} AS DOUBLE), 0), 0)"
        r = f"coalesce({tp} / NULLIF(CAST({tp} + {fn} AS DOUBLE), 0), 0)"
        f = f"coalesce(2 * {tp} / NULLIF(CAST(2 * {tp} + {fp} + {fn} AS DOUBLE), 0), 0)"
        return f"SELECT model, '{label}' AS label, {p} AS precision, {r} AS recall, {f} AS f1, CAST({tp} + {fn} AS DOUBLE) AS support FROM cf"

    per_class = f"pc AS ({row('0', 'tn', 'fn', 'fp')} UNION ALL {row('1', 'tp', 'fp', 'fn')})"
    parts = ("precision", "recall", "f1")
    acc = "(tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE)"
    macro = ", ".join(f"avg({p}) AS {p}" for p in parts)
    weighted = ", ".join(f"sum({p} * support) / sum(support) AS {p}" for p in parts)
    rows = f"""SELECT * FROM pc UNION ALL SELECT model, 'accuracy', {acc}, {acc}, {acc}, CAST(tp + tn + fp + fn AS DOUBLE) FROM cf
    UNION ALL SELECT model, 'macro avg', {macro}, sum(support) FROM pc GROUP BY model
    UNION ALL SELECT model, 'weighted avg', {weighted}, sum(support) FROM pc GROUP BY model"""
    shown = ", ".join(f"{sig(p)} AS {p}" for p in (*parts, "support"))
    return with_(TX, PRED, _AT_HALF, per_class) + f"SELECT model, label, {shown} FROM ({rows})"


@query("V8_classification_report", _report_sql())
def _(i):
    return metrics.classification_report(_at_half(i), BY)


@query(
    "V9_normalised_confusion",
    W_CF
    + " UNION ALL ".join(
        f"SELECT model, {a} AS actual, {p} AS predicted, {sig(f'coalesce({n} / NULLIF(CAST({n} + {o} AS DOUBLE), 0), 0)')} AS share FROM cf"
        for a, p, n, o in ((0, 0, "tn", "fp"), (0, 1, "fp", "tn"), (1, 0, "fn", "tp"), (1, 1, "tp", "fn"))
    ),
)
def _(i):
    return metrics.normalised_confusion(_at_half(i), BY)


_RECORD_SQL = (
    _with_sweep(metrics.GRID_EVALUATE)
    + f"""SELECT model, 'all' AS scenario, {sig('thr')} AS best_thr, {sig('fbeta')} AS "Fbeta", 2.0::DOUBLE AS beta, {sig('roc_auc')} AS roc_auc,
    {_RATES_SQL}, tn, fp, fn, tp FROM best JOIN auc USING (model)"""
)


def _records(i: Inputs):
    return metrics.evaluate(i.predictions.withColumn("scenario", F.lit("all")))


@query("V10_evaluate", _RECORD_SQL)
def _(i):
    return _records(i)


@query("E9_write_metrics_csv", _RECORD_SQL)
def _(i):
    path = scratch_path(i.spark, "metrics-csv")
    records = _records(i)
    csv.write_metrics_csv(records, path)
    return csv.load_table(i.spark, path, records.schema)


# --- ranking and decisions ---------------------------------------------------------------------------

_RANK = _with_sweep(metrics.GRID_TRAIN)


def _f2(i: Inputs):
    best = metrics.best_threshold(metrics.threshold_sweep(i.predictions, metrics.GRID_TRAIN, BY), BY)
    return best.select("model", F.col("fbeta").alias("F2"))


@query("W3_rank_models", _RANK + f'SELECT model, {sig("fbeta")} AS "F2" FROM best ORDER BY fbeta DESC, model')
def _(i):
    return ranking.rank_models(_f2(i))


@query("T10_champion", _RANK + f'SELECT model, {sig("fbeta")} AS "F2" FROM best ORDER BY fbeta DESC, model LIMIT 1')
def _(i):
    return ranking.champion(_f2(i))


_NUMERIC = [n for n in schemas.FEATURE_COLUMNS if n not in TEXT_FEATURES]


@query(
    "W4_top_attributions",
    WITH_OFFLINE.replace("offf AS (", "offf AS MATERIALIZED (")
    + ", att AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, avg(abs({n})) AS mean_abs FROM offf" for n in _NUMERIC)
    + f") SELECT feature, {sig('mean_abs')} AS mean_abs FROM att ORDER BY att.mean_abs DESC, feature LIMIT 25",
)
def _(i):
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("value")) for n in _NUMERIC])
    return ranking.top_attributions(i.offline_table.select(F.inline(cells)))


@query(
    "T4_ensemble_scores",
    with_(TX, PRED)
    + f"""SELECT a.docno, 'ensemble' AS model, a.y_true, {sig('0.7 * a.y_proba + 0.3 * b.y_proba')} AS y_proba
    FROM pr a JOIN pr b USING (docno) WHERE a.model = 'balanced_trees' AND b.model = 'numeric_trees'""",
)
def _(i):
    return decision.ensemble_scores(i.predictions, "balanced_trees", "numeric_trees", "docno")


_ROLES = {"balanced_trees": "decision", "numeric_trees": "shadow", "ensemble": "shadow"}
_ROLE_SQL = "CASE model WHEN 'balanced_trees' THEN 'decision' ELSE 'shadow' END"


@query("T6_model_roles", with_(TX, PRED) + f"SELECT docno, model, {sig('y_proba')} AS y_proba, {_ROLE_SQL} AS role FROM pr")
def _(i):
    return decision.with_roles(i.predictions, _ROLES).drop("y_true")


@query("T6_decision_view", with_(TX, PRED) + f"SELECT docno, {sig('y_proba')} AS y_proba FROM pr WHERE model = 'balanced_trees'")
def _(i):
    return decision.decision_scores(decision.with_roles(i.predictions, _ROLES)).select("docno", "y_proba")


@query(
    "T7_route_decision",
    with_(TX, PRED)
    + """SELECT docno, model, CASE WHEN y_proba = 1 THEN 'APPROVE' ELSE 'DECLINE' END AS reference,
    CASE WHEN y_proba >= 0.7 THEN 'DECLINE' WHEN y_proba >= 0.4 THEN 'REVIEW' ELSE 'APPROVE' END AS threshold FROM pr""",
)
def _(i):
    p = F.col("y_proba")
    return i.predictions.select(
        "docno", "model", decision.route_decision(p, "reference").alias("reference"), decision.route_decision(p, "threshold", 0.4, 0.7).alias("threshold")
    )


# --- scenarios ------------------------------------------------------------------------------------------


@query("X1_amount_x3", with_(TX) + f"SELECT docno, {sig('CAST(amount AS DOUBLE) * 3')} AS amount FROM tx")
def _(i):
    return scenarios.amount_x3(i.tx).select("docno", "amount")


@query("X2_all_at_night", with_(TX) + "SELECT docno, strftime(transdate, '%Y-%m-%d') || ' 02:00:00' AS transdatetime FROM tx")
def _(i):
    return scenarios.all_at_night(i.tx).select("docno", "transdatetime")


@query("X3_burst_x3", with_(TX, BEH, MERGED) + f"SELECT docno, {sig('coalesce(burstiness_login_interval, 0) * 3')} AS burstiness_login_interval FROM mg")
def _(i):
    return scenarios.burst_x3(i.merged).select("docno", "burstiness_login_interval")


# --- splitting and weighting --------------------------------------------------------------------------------


@query("S1_stratified_split", with_(TX, SPLIT) + "SELECT docno, target, is_test FROM sp JOIN tx USING (docno)")
def _(i):
    train, test = sampling.stratified_split(i.tx.select("docno", "target"), "target", "docno")
    return train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))


_WEIGHTS = """wq AS (SELECT quantile_cont(amount_clipped, 0.9) AS a, quantile_cont(cust_txn_count, 0.75) AS c FROM offf),
wt AS (
  SELECT docno, CASE WHEN target = 1 THEN 3.0::DOUBLE ELSE 1 END
    * CASE WHEN target = 1 AND amount_clipped >= a AND cust_txn_count >= c THEN 2 ELSE 1 END
    * CASE WHEN target = 1 AND amount_clipped >= a AND (logins_last_30_days <= 2 OR is_high_burst = 1 OR is_night = 1) THEN 2 ELSE 1 END
    * CASE WHEN target = 0 AND amount_clipped < a AND cust_txn_count > c AND logins_last_30_days > 20 THEN 0.5 ELSE 1 END AS weight
  FROM offf CROSS JOIN wq)"""


@query("S2_scenario_weights", WITH_OFFLINE + f", {_WEIGHTS} SELECT docno, {sig('weight')} AS weight FROM wt")
def _(i):
    return sampling.scenario_weights(i.offline_table).select("docno", "weight")


@query(
    "S3_weight_summary",
    WITH_OFFLINE + f", {_WEIGHTS} SELECT {sig('min(weight)')} AS min_weight, {sig('max(weight)')} AS max_weight, {sig('avg(weight)')} AS mean_weight FROM wt",
)
def _(i):
    return sampling.weight_summary(sampling.scenario_weights(i.offline_table))


@query(
    "S5_class_weights",
    with_(TX)
    + f"""SELECT docno, {sig('CASE WHEN target = 1 THEN (SELECT sum(1 - target) / sum(target)::DOUBLE FROM tx) ELSE 1 END')} AS class_weight,
    {sig('(SELECT count(*) FROM tx) / (2.0::DOUBLE * count(*) OVER (PARTITION BY target))')} AS balanced FROM tx""",
)
def _(i):
    rows = i.tx.select("docno", "target")
    both = sampling.class_weights(sampling.class_weights(rows, mode="balanced").withColumnRenamed("class_weight", "balanced"))
    return both.select("docno", "class_weight", "balanced")


# --- neighbours and anomalies ---------------------------------------------------------------------------------

_VEC = "vc AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_KNN = """nn AS (
  SELECT a.vec_id AS query_id, b.vec_id AS base_id, list_distance(a.v, b.v) AS distance
  FROM vc a CROSS JOIN vc b QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) <= 10)"""
_KNN_SQL = with_(_VEC, _KNN) + f"SELECT query_id, base_id, {sig('distance')} AS distance FROM nn"


def _knn(i: Inputs, **options):
    points = as_points(fixtures.vectors(i.spark, i.sf_dir), "vec_id", F.col("embedding"))
    return knn_join(points, points, 10, **options).drop("weight")


@query("M3_knn_join", _KNN_SQL)
def _(i):
    return _knn(i)


@query("M3_knn_join_partitioned", _KNN_SQL)
def _(i):
    return _knn(i, broadcast_values=0)


LOF_K = anomaly.LOF_NEIGHBOURS
_LOF = f"""cand AS (SELECT a.vec_id AS q, b.vec_id AS b, list_distance(a.v, b.v) AS d FROM vc a CROSS JOIN vc b),
fit AS (SELECT q, b, d FROM cand WHERE q <> b QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, b) <= {LOF_K}),
rad AS (SELECT q AS b, max(d) AS r FROM fit GROUP BY q),
lrd AS (SELECT q, 1 / (avg(greatest(d, r)) + 1e-10::DOUBLE) AS lrd FROM fit JOIN rad USING (b) GROUP BY q),
nof AS (SELECT f.q, -avg(n.lrd) / any_value(o.lrd) AS nof FROM fit f JOIN lrd n ON n.q = f.b JOIN lrd o ON o.q = f.q GROUP BY f.q),
off AS (SELECT quantile_cont(nof, 0.01) AS o FROM nof),
new AS (SELECT q, b, d FROM cand QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, b) <= {LOF_K}),
nlrd AS (SELECT q, 1 / (avg(greatest(d, r)) + 1e-10::DOUBLE) AS lrd FROM new JOIN rad USING (b) GROUP BY q),
lof AS (SELECT f.q, avg(n.lrd) / any_value(o.lrd) AS lof FROM new f JOIN lrd n ON n.q = f.b JOIN nlrd o ON o.q = f.q GROUP BY f.q)"""


@query("M2_local_outlier_factor", with_(_VEC, _LOF) + f"SELECT q AS vec_id, {sig('lof + o')} AS lof_score FROM lof CROSS JOIN off")
def _(i):
    vectors = fixtures.vectors(i.spark, i.sf_dir)
    (scored,) = anomaly.local_outlier_factor(vectors, [vectors], "vec_id", F.col("embedding"), LOF_K)
    return scored.select("vec_id", "lof_score")


def _spread(i: Inputs, dims: int = 64):
    cells = [F.col("embedding")[d].cast("double").alias(f"e{d}") for d in range(dims)]
    return fixtures.vectors(i.spark, i.sf_dir).select("vec_id", "label", *cells), [f"e{d}" for d in range(dims)]


@query("M1_isolation_forest")
def _(i):
    frame, columns = _spread(i)
    (scored,) = anomaly.isolation_forest(frame, [frame], "vec_id", columns)
    return scored.select("vec_id", "iforest_score")


@query("M4_add_anomaly_features")
def _(i):
    train, test = anomaly.add_anomaly_features(i.train_features, i.test_features, "docno", "target", TEXT_FEATURES)
    flagged = train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))
    return flagged.select("docno", "is_test", "iforest_score", "lof_score")


_SMOTE_DIMS = 64
_SD = [f"e{d}" for d in range(_SMOTE_DIMS)]
_HASH = "CAST(('0x' || substr(md5({t}), 1, 13)) AS BIGINT)"
_SMOTE = f"""sv AS (SELECT vec_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS target, CAST(label % 3 AS VARCHAR) || '/' || (vec_id % 4) AS kind,
  CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
mi AS (SELECT * FROM sv WHERE target = 1),
cs AS (SELECT median(s) AS c FROM (SELECT stddev_pop(v[d]) AS s FROM mi CROSS JOIN range(1, {_SMOTE_DIMS + 1}) r(d) GROUP BY d)),
sz AS (SELECT count(*) FILTER (WHERE target = 0) - count(*) FILTER (WHERE target = 1) AS missing, count(*) FILTER (WHERE target = 1) AS m FROM sv),
near AS (
  SELECT a.vec_id AS q, b.vec_id AS b, b.v AS bv, b.kind AS bk,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt(list_distance(a.v, b.v) ** 2 + CASE WHEN a.kind <> b.kind THEN c * c ELSE 0 END), b.vec_id) - 1 AS place
  FROM mi a JOIN mi b ON a.vec_id <> b.vec_id CROSS JOIN cs QUALIFY place < 5),
md AS (SELECT q, bk FROM (SELECT q, bk, count(*) AS n FROM near GROUP BY q, bk) QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, bk) = 1),
cp AS (SELECT vec_id, v, missing // m + CASE WHEN row_number() OVER (ORDER BY {_HASH.format(t="vec_id || '|42'")}) <= missing % m THEN 1 ELSE 0 END AS copies FROM mi CROSS JOIN sz),
ex AS (SELECT vec_id, v, unnest(range(1, copies + 1)) AS copy FROM cp),
dr AS (SELECT *, CAST(floor({_HASH.format(t="vec_id || '#' || copy || '|42|place'")} / 4503599627370496.0::DOUBLE * 5) AS BIGINT) AS place,
  {_HASH.format(t="vec_id || '#' || copy || '|42|gap'")} / 4503599627370496.0::DOUBLE AS gap FROM ex)"""


@query(
    "S4_smotenc",
    with_(_SMOTE)
    + "SELECT vec_id, target, kind, 0 AS is_synthetic, "
    + ", ".join(f"{sig(f'v[{d + 1}]')} AS e{d}" for d in range(_SMOTE_DIMS))
    + " FROM sv UNION ALL SELECT NULL, 1, md.bk, 1, "
    + ", ".join(sig(f"dr.v[{d + 1}] + gap * (near.bv[{d + 1}] - dr.v[{d + 1}])") for d in range(_SMOTE_DIMS))
    + " FROM dr JOIN near ON near.q = dr.vec_id AND near.place = dr.place JOIN md ON md.q = dr.vec_id",
)
def _(i):
    frame, columns = _spread(i, _SMOTE_DIMS)
    kind = F.concat((F.col("label") % 3).cast("string"), F.lit("/"), (F.col("vec_id") % 4).cast("string"))
    rows = frame.select("vec_id", (F.col("label") == 0).cast("int").alias("target"), kind.alias("kind"), *columns)
    return oversample.smotenc(rows, "vec_id", "target", columns, ["kind"])


# --- training and scoring -------------------------------------------------------------------------------------

_ORDERED = ["direction", "last_phone_model_categorical", "last_os_categorical"]


def _kinds(i: Inputs):
    return contract.prepare_matrices(i.model_frames[0])


def model(i: Inputs, which: str):
    def fit():
        train, numeric, text = _kinds(i)
        if which == "balanced":
            return training.train_balanced(train, numeric, text)
        if which == "numeric":
            return training.train_numeric(train, numeric)
        return training.train_weighted(train, numeric, text)

    return i._once(f"model_{which}", fit)


def _trained(which: str, i: Inputs):
    test, _, _ = contract.prepare_matrices(i.model_frames[1])
    return training.positive_probability(model(i, which), test).select("docno", "target", "y_proba")


for _key, _which in (("T1_train_balanced", "balanced"), ("T2_train_numeric", "numeric"), ("T3_train_weighted", "weighted")):
    query(_key)(functools.partial(_trained, _which))


def variants(i: Inputs) -> list[scoring.ModelVariant]:
    return [
        scoring.ModelVariant("fraud_balanced", "decision", model(i, "balanced"), schemas.FEATURE_COLUMNS),
        scoring.ModelVariant("fraud_numeric", "shadow", model(i, "numeric"), schemas.FEATURE_COLUMNS),
    ]


@query("T5_score_batch")
def _(i):
    broken = scoring.ModelVariant("fraud_missing", "shadow", scratch_path(i.spark, "no-such-model"), schemas.FEATURE_COLUMNS)
    scored = scoring.score_batch(i.model_frames[1], [*variants(i), broken])
    return scored.select("docno", "model", "role", "score", F.col("error").isNotNull().cast("int").alias("failed"))


@query("T8_feature_importance")
def _(i):
    return training.feature_importance(model(i, "balanced"), i.spark)


@query("T9_permutation_importance")
def _(i):
    test, numeric, text = contract.prepare_matrices(i.model_frames[1])
    lost = training.permutation_importance(model(i, "balanced"), test, [*numeric, *text])
    return ranking.top_attributions(lost)


def trained_scores(i: Inputs):
    """(model, y_true, y_proba) of the three trained models and the blend of the first two, side by side on every test row."""
    test, _, _ = contract.prepare_matrices(i.model_frames[1])
    names = ["balanced", "numeric", "weighted"]
    scored = training.score_models(test, [model(i, n) for n in names], ["target"])
    cells = [F.struct(F.lit(n).alias("model"), F.col(f"_score_{k}").alias("y_proba")) for k, n in enumerate(names)]
    cells.append(F.struct(F.lit("ensemble").alias("model"), decision.ensemble_score(F.col("_score_0"), F.col("_score_1")).alias("y_proba")))
    return scored.select(F.col("target").alias("y_true"), F.inline(F.array(*cells)))


@query("T10_trained_champion")
def _(i):
    """Models by F-beta on the test rows, best first; the first one is the champion."""
    return ranking.rank_models(metrics.evaluate(trained_scores(i), BY), "Fbeta")


@query("T9_row_attributions")
def _(i):
    test, _, _ = contract.prepare_matrices(i.model_frames[1])
    parts = trees.attributions(model(i, "balanced"), test, "docno")
    names = F.array(*[F.lit(n) for n in model(i, "balanced").features])
    return parts.select("docno", F.inline(F.arrays_zip(names.alias("feature"), F.col("values").alias("value"))))


@query("W4_model_attributions")
def _(i):
    test, _, _ = contract.prepare_matrices(i.model_frames[1])
    means = trees.mean_attributions(model(i, "balanced"), test, "docno")
    return means.orderBy(F.col("mean_abs").desc(), "feature").limit(25)


@query(
    "T1_ordered_means",
    with_(TX, BEH, MERGED)
    + f"""SELECT docno, {", ".join(
        sig(f"(coalesce(sum(target) OVER {w}, 0) + 1.0::DOUBLE) / (coalesce(count(*) OVER {w}, 0) + 10)") + f" AS {c}__mean"
        for c in _ORDERED for w in [f"(PARTITION BY {c} ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"]
    )} FROM (SELECT *, {_HASH.format(t="docno || '|42'")} AS h FROM mg)""",
)
def _(i):
    rows = i.merged.select("docno", "target", *_ORDERED)
    means = ordered_target_means(rows, _ORDERED, "target", "docno", prior=0.1, block_rows=500)
    return means.select("docno", *[mean_column(c) for c in _ORDERED])


@query("X4_stress_suite")
def _(i):
    return scoring.stress_suite(i.test, i.offline_stats, variants(i), add_scores=i.with_anomaly_scores)


# --- streaming -----------------------------------------------------------------------------------------------------


def _versions(i: Inputs, batch: int):
    """Versions of one configuration as the stream goes on: v2 appears with the third batch, then one that does not validate."""
    rows = [("risk", "v1", 1, True, True, "0.4;0.7")]
    rows += [("risk", "v2", 2, True, True, "0.3;0.6")] if batch >= 2 else []
    rows += [("risk", "v3", 3, False, False, "broken")] if batch >= 3 else []
    return i.spark.createDataFrame(rows, "key string, version_id string, last_modified int, stable boolean, valid boolean, body string")


def _bundle(i: Inputs, version: str, body: str) -> streaming.Bundle:
    low, high = (float(x) for x in body.split(";"))
    return streaming.Bundle(version, i.online_stats, variants(i), low, high)


#: Rows as they arrive, with the part of the stream: one third comes late, behind rows of all later dates. Every ninth row has no
#: amount, all others arrive twice, and every fifth document number comes again with another amount.
ARRIVALS = """arr AS (
  SELECT cst_dim_id, docno, CASE WHEN docno % 9 <> 0 THEN amount END AS amount, CASE WHEN docno % 3 = 0 THEN 'v2' ELSE 'v1' END AS part, 0 AS second FROM tx
  UNION ALL SELECT cst_dim_id, docno, amount + 1, 'v2', 1 FROM tx WHERE docno % 5 = 0 AND docno % 9 <> 0)"""
_GOOD = "cst_dim_id <> 0 AND docno <> 0 AND amount IS NOT NULL AND amount <> 0"


def arrivals(i: Inputs):
    """The rows of ARRIVALS, ``part`` telling which come first."""
    first = i.tx.withColumn("amount", F.when(F.col("docno") % 9 != 0, F.col("amount"))).withColumn("part", F.when(F.col("docno") % 3 == 0, "v2").otherwise("v1"))
    again = i.tx.where("docno % 5 = 0 AND docno % 9 <> 0").withColumns({"amount": (F.col("amount") + 1).cast("decimal(18,2)"), "part": F.lit("v2")})
    return first.unionByName(first.where("amount IS NOT NULL")).unionByName(again)


def run_stream(i: Inputs) -> tuple[str, str]:
    """Write the arriving rows in two parts of two files, and score the files as a stream, a file for each batch."""

    def run() -> tuple[str, str]:
        source, out, rejects, marks = (scratch_path(i.spark, n) for n in ("stream-in", "stream-out", "stream-rejects", "stream-marks"))
        rows = cut_lineage(arrivals(i), "arrivals")
        for part in ("v1", "v2"):
            rows.where(F.col("part") == part).drop("part").repartition(2).write.mode("append").parquet(source)
        batches = itertools.count()
        swap = streaming.HotSwap(lambda: _versions(i, next(batches)), functools.partial(_bundle, i), "risk")
        stream = streaming.read_transactions(i.spark, source, files_per_trigger=1)
        streaming.score_stream(stream, lambda: i.behaviour, swap, out, rejects, marks).awaitTermination()
        return out, rejects

    return i._once("stream", run)


@query("R1_score_stream")
def _(i):
    out, _ = run_stream(i)
    return streaming.final_decisions(i.spark, out).select("docno", "model", "score", "decision", "config_version", "request")


@query("R1_answered_rows", with_(TX, ARRIVALS) + f"SELECT count(*) AS arrived, count(*) AS answered FROM (SELECT unnest(range(CASE WHEN amount IS NULL OR second = 1 THEN 1 ELSE 2 END)) FROM arr)")
def _(i):
    """Rows in equal decisions plus rejects: late rows, repeats and second rows of a document number included."""
    out, rejects = run_stream(i)
    answered = i.spark.read.parquet(out).where("role = 'decision'").select("docno").unionByName(i.spark.read.parquet(rejects).select("docno"))
    return arrivals(i).agg(F.count("*").alias("arrived")).crossJoin(answered.agg(F.count("*").alias("answered")))


@query("R2_config_hot_swap", with_(TX, ARRIVALS) + f"SELECT part AS config_version, count(*) AS n FROM arr WHERE {_GOOD} GROUP BY part")
def _(i):
    out, _ = run_stream(i)
    return streaming.final_decisions(i.spark, out).groupBy("config_version").agg(F.count("*").alias("n"))


@query(
    "R3_reject_sink",
    with_(TX, ARRIVALS)
    + f"""SELECT docno, concat_ws(',', CASE WHEN cst_dim_id = 0 THEN 'cst_dim_id' END, CASE WHEN amount IS NULL OR amount = 0 THEN 'amount' END,
    CASE WHEN docno = 0 THEN 'docno' END) AS reasons FROM (SELECT *, unnest(range(CASE WHEN amount IS NULL OR second = 1 THEN 1 ELSE 2 END)) FROM arr) WHERE NOT coalesce({_GOOD}, false)""",
)
def _(i):
    _, rejects = run_stream(i)
    return i.spark.read.parquet(rejects).select("docno", F.concat_ws(",", "reject_reasons").alias("reasons"))
