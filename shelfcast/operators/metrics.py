"""Forecast error metrics over long forecasts (model, id, step, y, yhat, scale).

Pooled metrics are one aggregate per model; RMSSE needs one aggregate per
(model, id) first.  The input is hash-partitioned by ``id`` already (it comes
out of the per-series window), so the per-series aggregate adds no shuffle,
and the per-model aggregate is combined map-side (five groups).
NaN of the reference is null here.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import round_half_even, round_half_up

METRICS = ["MAE", "RMSE", "MAPE", "sMAPE", "RMSSE", "WRMSSE"]


def _per_series(forecasts: DataFrame) -> DataFrame:
    """One row per (model, id) with the sums every metric needs, so pooled and
    per-series metrics come from a single pass over the forecasts."""
    y, yhat = F.col("y"), F.col("yhat")
    err = y - yhat
    den = (F.abs(y) + F.abs(yhat)) / 2
    return forecasts.groupBy("model", "id").agg(
        F.count(err).alias("n"),
        F.sum(F.abs(err)).alias("abs_err"),
        F.sum(err * err).alias("sq_err"),
        F.sum(F.when(y != 0, F.abs(err / y))).alias("ape"),
        F.count(F.when(y != 0, 1)).alias("n_ape"),
        F.sum(F.when(den != 0, F.abs(err) / den)).alias("sape"),
        F.count(F.when(den != 0, 1)).alias("n_sape"),
        F.first("scale", ignorenulls=True).alias("scale"),
    )


def evaluate_models(forecasts: DataFrame, weights: DataFrame | None = None,
                    digits: int = 6) -> DataFrame:
    """One row per model: MAE, RMSE, MAPE (points with y != 0, null if none),
    sMAPE (points with a zero denominator skipped, 0 if none), mean RMSSE
    (nulls ignored) and, with weights, WRMSSE = sum(w * rmsse) / sum(w) over
    the scorable series.  One aggregate per (model, id) - on data already
    partitioned by id - then one per model (five groups, combined map-side)."""
    per = _per_series(forecasts)
    rmsse = F.sqrt(F.try_divide(F.col("sq_err") / F.col("n"), F.col("scale")))
    per = per.withColumn("rmsse", rmsse)
    if weights is not None:
        per = per.join(weights.select("id", "weight"), "id", "left")
    aggs = [
        (F.sum("abs_err") / F.sum("n")).alias("MAE"),
        F.sqrt(F.sum("sq_err") / F.sum("n")).alias("RMSE"),
        (F.try_divide(F.sum("ape"), F.sum("n_ape")) * 100).alias("MAPE"),
        F.coalesce(F.try_divide(F.sum("sape"), F.sum("n_sape")) * 100, F.lit(0.0)).alias("sMAPE"),
        F.avg("rmsse").alias("RMSSE"),
    ]
    if weights is not None:
        ok = F.col("rmsse").isNotNull()
        aggs.append(F.try_divide(F.sum(F.when(ok, F.col("weight") * F.col("rmsse"))),
                                 F.sum(F.when(ok, F.col("weight")))).alias("WRMSSE"))
    out = per.groupBy("model").agg(*aggs)
    names = [c for c in METRICS if c in out.columns]
    return out.select("model", *[round_half_up(c, digits).alias(c) for c in names])


def comparison_table(evaluated: DataFrame) -> DataFrame:
    """All models with metrics rounded to 4 decimals (half-even, as pandas);
    ``rank`` orders by RMSSE (nulls last, then model name)."""
    from pyspark.sql import Window
    names = [c for c in METRICS if c in evaluated.columns]
    # at most a handful of rows (one per model): a global window is bounded
    w = Window.orderBy(F.col("RMSSE").asc_nulls_last(), F.col("model"))
    return evaluated.select("model", *[round_half_even(c, 4).alias(c) for c in names],
                            F.row_number().over(w).alias("rank"))


def best_model(table: DataFrame) -> DataFrame:
    """Top-1 by RMSSE (null RMSSE last, ties by model name)."""
    return table.orderBy(F.col("RMSSE").asc_nulls_last(), F.col("model")).limit(1)
