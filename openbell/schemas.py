"""Table contracts as Spark DDL strings."""

BARS = (
    "symbol STRING, ts TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, load_seq BIGINT"
)
BARS_FIXED_POINT = (
    "symbol STRING, ts TIMESTAMP_NTZ, open BIGINT, high BIGINT, low BIGINT, "
    "close BIGINT, volume BIGINT, load_seq BIGINT"
)
SOURCE_CFG = "source STRING, symbol STRING, fixed_point BOOLEAN, invert_sign BOOLEAN"
EVENT_DATES = "event STRING, date DATE"
ARTICLES_RAW = (
    "title STRING, description STRING, published_at TIMESTAMP_NTZ, load_seq BIGINT"
)
ARTICLES_LANDING = "title STRING, description STRING, published_at STRING, source STRING, url STRING"
ARTICLE_SCORES = (
    "text_hash STRING, Date DATE, published_at TIMESTAMP_NTZ, prob_pos DOUBLE, "
    "prob_neg DOUBLE, prob_neu DOUBLE, is_neutral BOOLEAN, relevance DOUBLE, "
    "novelty DOUBLE, subjectivity DOUBLE, tier2_scored BOOLEAN, embedding ARRAY<FLOAT>"
)
PREDICTIONS = (
    "symbol STRING, date DATE, predicted_range DOUBLE, actual_range DOUBLE, abs_error DOUBLE, "
    "prediction_timestamp STRING, model_mode STRING, model_trained_at STRING, "
    "model_train_rows BIGINT, last_search STRING"
)
LOAD_MANIFEST = "load_date DATE, ok BOOLEAN, error STRING"
METRICS = (
    "STRUCT<rmse: DOUBLE, mae: DOUBLE, r2: DOUBLE, pred_std: DOUBLE, coverage_at_mae: DOUBLE>"
)
MODEL_META = (
    "mode STRING, target STRING, feature_names ARRAY<STRING>, best_params MAP<STRING, DOUBLE>, "
    f"best_iter INT, val_metrics MAP<STRING, {METRICS}>, test_metrics MAP<STRING, {METRICS}>, "
    "importance MAP<STRING, DOUBLE>, trained_at TIMESTAMP, last_search TIMESTAMP, "
    "train_rows BIGINT, train_start DATE, train_end DATE, model_path STRING"
)

OHLCV = ["open", "high", "low", "close", "volume"]

PREMARKET = ["overnight_gap", "premarket_trend", "macro_vol_830", "macro_dir_830"]

TECHNICALS = [
    "dist_sma_50", "dist_sma_200", "rsi_14", "pct_atr", "bb_pct_b", "relative_volume",
    "adx_14", "dmp_14", "dmn_14", "stoch_k", "stoch_d", "pct_macd", "pct_macd_hist",
    "pct_macd_signal", "prev_rth_momentum", "prev_day_range",
]

IMPACT_LAGS = [f"impact_lag_{k}" for k in range(1, 6)]
PCA_COLUMNS = [f"context_pca_{k}" for k in range(1, 6)]

DAILY_SENTIMENT = [
    "prob_pos_mean", "prob_neg_mean", "prob_neu_mean", "relevance_mean", "novelty_mean",
    "subjectivity_mean", "article_count", "weighted_impact", "sentiment_entropy",
    "buzz_factor", "sentiment_momentum", "sentiment_ewma_5d",
    *IMPACT_LAGS, *PCA_COLUMNS,
]
