"""Table schemas."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("cst_dim_id", T.LongType()),
        T.StructField("transdate", T.DateType()),
        T.StructField("transdatetime", T.TimestampNTZType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("docno", T.LongType()),
        T.StructField("direction", T.StringType()),
        T.StructField("target", T.IntegerType()),
    ]
)

# Behaviour columns, by how they are stored.
BEHAVIOUR_COUNTS = [
    "monthly_os_changes",
    "monthly_phone_model_changes",
    "logins_last_7_days",
    "logins_last_30_days",
]
BEHAVIOUR_LABELS = ["last_phone_model_categorical", "last_os_categorical"]
BEHAVIOUR_MEASURES = [
    "login_frequency_7d",
    "login_frequency_30d",
    "freq_change_7d_vs_mean",
    "logins_7d_over_30d_ratio",
    "avg_login_interval_30d",
    "std_login_interval_30d",
    "var_login_interval_30d",
    "ewm_login_interval_7d",
    "burstiness_login_interval",
    "fano_factor_login_interval",
    "zscore_avg_login_interval_7d",
]
BEHAVIOUR_NUMERIC = BEHAVIOUR_COUNTS + BEHAVIOUR_MEASURES
BEHAVIOUR_COLUMNS = BEHAVIOUR_NUMERIC + BEHAVIOUR_LABELS

# The stored order of the behaviour table's columns.
BEHAVIOUR = T.StructType(
    [T.StructField("transdate", T.TimestampNTZType()), T.StructField("cst_dim_id", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in BEHAVIOUR_COUNTS[:2]]
    + [T.StructField(c, T.StringType()) for c in BEHAVIOUR_LABELS]
    + [T.StructField(c, T.IntegerType()) for c in BEHAVIOUR_COUNTS[2:]]
    + [T.StructField(c, T.DoubleType()) for c in BEHAVIOUR_MEASURES]
)

STATS_COLUMNS = [
    "amount_q99",
    "amount_high_thresh",
    "amount_mean",
    "amount_std",
    "burst_q90",
    "cust_txn_q75",
    "cust_txn_q90",
    "best_thr",
]
GLOBAL_STATS = T.StructType(
    [T.StructField("model_name", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in STATS_COLUMNS]
)

REQUEST = T.StructType(
    [
        T.StructField("cst_dim_id", T.LongType()),
        T.StructField("transdate", T.StringType()),
        T.StructField("transdatetime", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("docno", T.StringType()),
        T.StructField("direction", T.IntegerType()),
        T.StructField("target", T.StringType()),
    ]
)

# The scoring contract, in its configured order.
FEATURE_COLUMNS = """
amount docno monthly_os_changes monthly_phone_model_changes last_phone_model_categorical last_os_categorical
logins_last_7_days logins_last_30_days login_frequency_7d login_frequency_30d freq_change_7d_vs_mean
logins_7d_over_30d_ratio avg_login_interval_30d std_login_interval_30d var_login_interval_30d
ewm_login_interval_7d burstiness_login_interval fano_factor_login_interval zscore_avg_login_interval_7d
hour weekday is_night is_evening is_morning is_weekend amount_clipped amount_log amount_bin is_high_amount
amount_z_overall logins_7d_per_day logins_30d_per_day amount_per_login_30d freq_change_7d_vs_mean_abs
login_freq_ratio_7_30 logins_ratio_7_30 interval_cv_30d interval_fano_30d ewm_vs_avg_interval burstiness_abs
zscore_login_abs amountlog_x_freqchange_abs cust_amount_mean cust_amount_std cust_amount_max cust_txn_count
amount_vs_cust_mean amount_vs_cust_max cust_is_heavy_q75 cust_is_heavy_q90 is_high_burst night_and_high_amount
weekend_and_high_amount night_and_high_burst weekend_and_high_burst amount_x_burst amount_x_fano
amount_x_login_freq7 amount_x_login_freq30 amount_x_logins_7d amount_x_logins_30d burst_x_logins_7d
burst_x_logins_30d high_amount_and_no_logins30 night_x_amount_log weekend_x_amount_log evening_x_amount_log
cust_heavy_q75_x_amount cust_heavy_q75_x_night cust_heavy_q75_x_burst atypical_amount_vs_mean
atypical_amount_vs_max high_amount_z_flag high_burst_and_high_amount login_spiky_ratio_max iforest_score lof_score
""".split()
CATEGORICAL_FEATURES = ["last_phone_model_categorical", "last_os_categorical", "amount_bin"]
SERVICE_COLUMNS = ["cst_dim_id", "transdate", "transdatetime", "transdate_clean", "transdatetime_parsed", "direction"]
