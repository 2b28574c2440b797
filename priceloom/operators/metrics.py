"""Model scores as one-row frames, each from a single pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions import adjusted_r2, expm1_price, mae, r2, rmse
from priceloom.operators.schema import LOG_TARGET

PREDICTION = "prediction"
EXP_PREDICTION = "exp_prediction"


def with_exp_prediction(df: DataFrame) -> DataFrame:
    """Bring the log-scale prediction back to the price scale."""
    return df.withColumn(EXP_PREDICTION, expm1_price(PREDICTION))


def regression_metrics(df: DataFrame, label: str = LOG_TARGET, prediction: str = PREDICTION) -> DataFrame:
    """One row: (n, r2, rmse, mae)."""
    return df.agg(
        F.count("*").alias("n"),
        r2(label, prediction).alias("r2"),
        rmse(label, prediction).alias("rmse"),
        mae(label, prediction).alias("mae"),
    )


def all_metrics(df: DataFrame, target: str, features: int) -> DataFrame:
    """One row with the log-scale and price-scale scores, the adjusted R2 and
    the feature count. Scores that need the same rows share the same pass."""
    base = df.agg(
        F.count("*").alias("n"),
        r2(LOG_TARGET, PREDICTION).alias("r2_log"),
        rmse(LOG_TARGET, PREDICTION).alias("rmse_log"),
        mae(LOG_TARGET, PREDICTION).alias("mae_log"),
        r2(target, EXP_PREDICTION).alias("r2_original"),
        rmse(target, EXP_PREDICTION).alias("rmse_original"),
    )
    return with_adjusted_r2(base, features, score="r2_log")


def with_adjusted_r2(metrics: DataFrame, features: int, score: str = "r2", rows: str = "n") -> DataFrame:
    count = F.lit(features).cast("bigint")
    return metrics.withColumns(
        {
            "feature_count": count,
            "adjusted_r2": adjusted_r2(F.col(score), F.col(rows), count),
        }
    )


def relative_score(scores: DataFrame, score: str, model: str, baseline: str, by: str = "model") -> DataFrame:
    """One row: ``score`` of one model as a share of another's. ``scores`` holds
    one row per model, so the conditional aggregates see a handful of rows."""

    def of(name: str):
        return F.max(F.when(F.col(by) == name, F.col(score)))

    return scores.agg(
        of(model).alias("model_score"),
        of(baseline).alias("baseline_score"),
        F.try_divide(of(model), of(baseline)).alias("relative_score"),
    )
