"""Forecast baselines, revenue weights, the gradient-boosted demand model,
the served forecasts table and its lookup.

Silver is bucketed by ``id``: the per-series statistics (last value, moving means,
last ``period`` values, RMSSE scale) are one aggregate by ``id`` over the training
rows, joined to the test rows by ``id``; neither needs an exchange.
"""
from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents, money
from shelfcast.operators import boosting
from shelfcast.operators.series import DateAxis, date_axis

# functions of this module travel to the executors with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HORIZON = 28
PERIOD = 7
MA_WINDOWS = (7, 28)
BASELINE_MODELS = ["zero", "naive", "seasonal_naive_7", "moving_average_7", "moving_average_28"]


def baseline_frame(silver: DataFrame, horizon: int = HORIZON, period: int = PERIOD,
                   windows=MA_WINDOWS, axis: DateAxis | None = None) -> DataFrame:
    """Test rows (id, step, date, y) with every per-series statistic attached:
    ``last``, ``ma_w``, ``seas`` (seasonal-naive value of this step) and
    ``scale`` = mean squared first difference over train (null if flat)."""
    axis = axis or date_axis(silver)
    if axis.n_dates <= horizon:
        raise ValueError(f"need more than {horizon} dates, have {axis.n_dates}")
    n_train = axis.n_dates - horizon
    if n_train < period:
        raise ValueError(f"train ({n_train} days) shorter than the period {period}")
    require_complete(silver, axis)
    df = axis.with_index(silver.select("id", "date", "units"))
    idx, units = F.col("day_index"), F.col("units")
    train = idx < n_train
    d = (units - F.lag(units, 1).over(Window.partitionBy("id").orderBy("day_index"))).cast("bigint")
    stats = df.withColumn("_d2", d * d).where(train).groupBy("id").agg(
        F.max(F.when(idx == n_train - 1, units)).cast("double").alias("last"),
        *[F.avg(F.when(idx >= n_train - w, units)).alias(f"ma_{w}") for w in windows],
        *[F.max(F.when(idx == n_train - period + k, units)).alias(f"_s{k}") for k in range(period)],
        F.avg("_d2").alias("_scale"),
    )
    step = F.col("day_index") - n_train + 1
    season = F.array(*[F.col(f"_s{k}") for k in range(period)])
    return df.where(~train).join(stats, "id").select(
        "id", step.cast("int").alias("step"), "date", F.col("units").alias("y"), "last",
        *[f"ma_{w}" for w in windows],
        F.element_at(season, ((step - 1) % period + 1).cast("int")).cast("double").alias("seas"),
        F.when(F.col("_scale") != 0, F.col("_scale")).alias("scale"),
    )


def require_complete(silver: DataFrame, axis: DateAxis) -> None:
    """Raise unless every series has one row for each date of the axis and no null units:
    scores over different points could not be compared, and lags would step over gaps."""
    per_id = silver.groupBy("id").agg(F.count("units").alias("n"), F.count(F.lit(1)).alias("rows"))
    bad = per_id.where((F.col("n") != axis.n_dates) | (F.col("rows") != axis.n_dates)).limit(3).collect()
    if bad:
        raise ValueError(f"incomplete series (need {axis.n_dates} days each): "
                         + ", ".join(f"{r['id']} has {r['n']} of {r['rows']} rows" for r in bad))


def baseline_forecasts(frame: DataFrame, windows=MA_WINDOWS, period: int = PERIOD) -> DataFrame:
    """Long forecasts (model, id, step, date, y, yhat, scale): one Generate, no join."""
    models = [("zero", F.lit(0.0)), ("naive", F.col("last")), (f"seasonal_naive_{period}", F.col("seas"))]
    models += [(f"moving_average_{w}", F.col(f"ma_{w}")) for w in windows]
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), e.cast("double").alias("yhat")) for m, e in models])
    return frame.select("id", "step", "date", "y", "scale", F.inline(pairs)).select(
        "model", "id", "step", "date", "y", "yhat", "scale")


def revenue_weights(silver: DataFrame, horizon: int = HORIZON, last_days: int = 28,
                    axis: DateAxis | None = None) -> DataFrame:
    """Revenue per series in ``(max_date - horizon - last_days, max_date - horizon]``,
    absent -> 0, divided by the total; uniform ``1/n`` when the total is 0.

    The total is a scalar (one aggregate) read on the driver; no cross join.
    """
    axis = axis or date_axis(silver)
    end = axis.last - dt.timedelta(days=horizon)
    start = end - dt.timedelta(days=last_days)
    in_window = (F.col("date") > F.lit(start)) & (F.col("date") <= F.lit(end))
    per_id = silver.groupBy("id").agg(
        F.coalesce(F.sum(F.when(in_window, cents("revenue"))), F.lit(0).cast("long")).alias("rev"))
    tot = per_id.agg(F.sum("rev").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total, n = tot["t"], tot["n"]
    if total is not None and total > 0:
        weight = money("rev") / (F.lit(total).cast("long") / F.lit(100.0))
    else:
        weight = F.lit(1.0) / F.lit(float(max(n, 1)))
    return per_id.select("id", money("rev").alias("revenue"), weight.alias("weight"))


# ------------------------------------------------------------- ML model ---

FEATURES = ["lag_7", "lag_14", "lag_28", "rolling_mean_7", "rolling_mean_28", "wday", "snap_flag"]


def demand_features(silver: DataFrame) -> DataFrame:
    """Lags and previous-days means per series, plus calendar columns."""
    from shelfcast.operators.series import lag_features, rolling_mean_features
    base = silver.select("id", "date", "units", "wday", F.col("snap_flag").cast("int").alias("snap_flag"))
    return rolling_mean_features(lag_features(base))


def train_demand_model(train: DataFrame, features=FEATURES, max_iter: int = 200, step_size: float = 0.05,
                       leaves: int = 31, least: int = 20) -> boosting.BoostedTrees:
    """Gradient-boosted trees on every feature row; nulls in features -> 0.

    The settings of the reference's booster: ``max_iter`` rounds, rate ``step_size``, trees grown
    leaf by leaf up to ``leaves`` leaves of ``least`` rows or more.  Nothing is sampled, so there is no seed."""
    return boosting.fit(train, list(features), "units", rounds=max_iter, rate=step_size, leaves=leaves, least=least)


def predict_demand(model, rows: DataFrame) -> DataFrame:
    """id, date, units, predicted_units of feature rows."""
    return model.transform(rows).select("id", "date", "units", F.col("prediction").alias("predicted_units"))


def _shifted(past: np.ndarray, k: int) -> np.ndarray:
    return past[:, -k] if past.shape[1] >= k else np.full(len(past), np.nan)


def _mean(past: np.ndarray, w: int) -> np.ndarray:
    """Mean of the last ``w`` values as in training: half up at six decimals, missing until there are ``w``."""
    return np.floor(past[:, -w:].mean(axis=1) * 1e6 + 0.5) / 1e6 if past.shape[1] >= w else np.full(len(past), np.nan)


def recursive_forecasts(silver: DataFrame, model, horizon: int, calendar: DataFrame | None = None,
                        axis: DateAxis | None = None) -> DataFrame:
    """Steps 1..horizon after the last date by a model of ``train_demand_model``: (item_id, store_id,
    step, predicted_units).

    Each step's lags and means are over what lies before it, and from the second step on that
    includes the predictions of the steps before.  A series needs its last 28 values only: they are
    one row per series (an aggregate by ``id``, which Silver's buckets need no exchange for), and the
    fold over the steps runs on many series at a time.  ``calendar``: days behind the last
    date with the raw calendar's SNAP columns; without it no day counts as a SNAP day."""
    axis = axis or date_axis(silver)
    require_complete(silver, axis)
    n, keep = axis.n_dates, min(28, axis.n_dates)
    ahead = [axis.last + dt.timedelta(days=k) for k in range(1, horizon + 1)]
    snap: dict = {}
    if calendar is not None:                                 # at most one row per step
        days = calendar.where(F.col("date").between(F.lit(ahead[0]), F.lit(ahead[-1])))
        columns = [c for c in calendar.columns if c.startswith("snap_")]
        for r in days.select("date", *columns).dropDuplicates(["date"]).collect():
            snap.update({(c.removeprefix("snap_"), r["date"]): int(r[c] or 0) for c in columns})
    df = axis.with_index(silver.select("id", "item_id", "store_id", "state_id", "date", "units"))
    past = F.array(*[F.max(F.when(F.col("day_index") == n - keep + j, F.col("units"))).cast("double") for j in range(keep)])
    series = df.groupBy("id", "item_id", "store_id", "state_id").agg(past.alias("past"))
    wday = [(d.isoweekday() % 7 + 1) % 7 + 1 for d in ahead]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            past, out = np.array(b["past"].tolist()), []
            for k, day in enumerate(ahead):
                flags = [snap.get((s, day), 0) for s in b["state_id"]]
                x = {"lag_7": _shifted(past, 7), "lag_14": _shifted(past, 14), "lag_28": _shifted(past, 28),
                     "rolling_mean_7": _mean(past, 7), "rolling_mean_28": _mean(past, 28),
                     "wday": np.full(len(b), wday[k], dtype=float), "snap_flag": np.array(flags, dtype=float)}
                out.append(model.predict(np.stack([x[f] for f in model.features], axis=1)))
                past = np.hstack([past, out[-1][:, None]])[:, -28:]
            yield pd.DataFrame({
                "item_id": np.repeat(b["item_id"].to_numpy(), horizon), "store_id": np.repeat(b["store_id"].to_numpy(), horizon),
                "step": np.tile(np.arange(1, horizon + 1), len(b)), "predicted_units": np.stack(out, axis=1).ravel()})

    return series.mapInPandas(fold, "item_id string, store_id string, step int, predicted_units double")


# ------------------------------------------------------------- serving ---

MAX_SERVED_HORIZON = 90


def forecasts_table(silver: DataFrame, models=("moving_average_28",), horizon: int = MAX_SERVED_HORIZON,
                    period: int = PERIOD, trained=None, calendar: DataFrame | None = None) -> DataFrame:
    """Forecasts for every series, steps 1..horizon after the last date, from all
    history: (item_id, store_id, model, step, date, predicted_units).

    ``models``: baseline names, and ``gbt`` with a model of ``train_demand_model`` as
    ``trained`` (see ``recursive_forecasts``).  Steps come from ``sequence``."""
    axis = date_axis(silver)
    n = axis.n_dates
    df = axis.with_index(silver.select("id", "item_id", "store_id", "date", "units"))
    idx, units = F.col("day_index"), F.col("units")
    values = []
    for m in models:
        kind, _, k = m.rpartition("_")
        if m == "zero":
            value = F.lit(0.0)
        elif m == "naive":
            value = F.max(F.when(idx == n - 1, units))
        elif kind == "moving_average":
            value = F.avg(F.when(idx >= n - int(k), units))
        elif kind == "seasonal_naive":
            value = F.array(*[F.max(F.when(idx == n - int(k) + j, units)).cast("double") for j in range(int(k))])
        elif m == "gbt" and trained is not None:
            continue
        else:
            raise ValueError(f"unknown served model {m}")
        values.append(F.struct(F.lit(m).alias("model"), (value if kind == "seasonal_naive" else F.array(value.cast("double")))
                               .alias("cycle")))
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    cols = ["item_id", "store_id", "model", "step"]
    parts = []
    if values:
        per_series = df.groupBy("id", "item_id", "store_id").agg(F.array(*values).alias("v"))
        parts.append(per_series.select("item_id", "store_id", F.inline("v")).select("item_id", "store_id", "model", "cycle", step).select(
            *cols, F.element_at("cycle", ((F.col("step") - 1) % F.size("cycle") + 1).cast("int")).alias("predicted_units")))
    if "gbt" in models:
        parts.append(recursive_forecasts(silver, trained, horizon, calendar, axis).select(
            "item_id", "store_id", F.lit("gbt").alias("model"), "step", "predicted_units"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*cols, F.date_add(F.lit(axis.last), F.col("step")).alias("date"), "predicted_units")


def write_forecasts(silver: DataFrame, path: str, models=tuple(BASELINE_MODELS), trained=None,
                    horizon: int = MAX_SERVED_HORIZON) -> DataFrame:
    """The stored forecasts table (Parquet by model) that look-ups read."""
    forecasts_table(silver, models, horizon, trained=trained).write.mode("overwrite").partitionBy("model").parquet(path)
    return silver.sparkSession.read.parquet(path)


def forecast_lookup(forecasts: DataFrame, item_id: str | None = None, store_id: str | None = "CA_1",
                    horizon: int = 28, model: str | None = None) -> DataFrame:
    """A served forecast as a filter of the stored table: the horizon is at least 1 and
    at most 90; ``None`` for item/store means every one."""
    if horizon < 1 or horizon > MAX_SERVED_HORIZON:
        raise ValueError(f"horizon {horizon} is outside 1 to {MAX_SERVED_HORIZON}")
    cond = F.col("step") <= horizon
    if model is not None:
        cond = cond & (F.col("model") == model)
    if item_id is not None:
        cond = cond & (F.col("item_id") == item_id)
    if store_id is not None:
        cond = cond & (F.col("store_id") == store_id)
    return forecasts.where(cond).select(
        "item_id", "store_id", F.lit(horizon).alias("horizon_days"), "date", "predicted_units")
