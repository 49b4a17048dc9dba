"""Leaf-wise boosting against trees grown by brute force, and the recursive forecast against a plain loop."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.operators import boosting as bo
from shelfcast.operators import forecast as fc

COLS = ["a", "b", "c"]


def table(seed=3, n=400):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.integers(0, 40, n)], axis=1).astype(float)
    y = (x[:, 0] > 5) * 3.0 + (x[:, 1] == 2) * x[:, 2] * 0.25 + rng.integers(0, 3, n)
    return x, y


def brute_boost(x, y, rounds, rate, leaves, least):
    """Every split of every leaf tried on the rows themselves, the best one made, again and again."""
    total, out = np.full(len(y), y.mean()), []
    for _ in range(rounds):
        rest = np.rint((y - total) * bo.UNIT) / bo.UNIT
        parts, made = [np.arange(len(y))], []
        while len(parts) < leaves:
            best = None
            for p, rows in enumerate(parts):
                g = rest[rows]
                for f in range(x.shape[1]):
                    for v in np.unique(x[rows, f])[:-1]:
                        low = x[rows, f] <= v
                        n = low.sum()
                        if min(n, len(rows) - n) < least:
                            continue
                        gain = g[low].sum() ** 2 / n + g[~low].sum() ** 2 / (len(rows) - n) - g.sum() ** 2 / len(rows)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, p, f, v)
            if best is None:
                break
            _, p, f, v = best
            rows = parts.pop(p)
            made.append((f, round(best[0], 6)))
            parts += [rows[x[rows, f] <= v], rows[x[rows, f] > v]]
        for rows in parts:
            total[rows] = total[rows] + rate * rest[rows].mean()
        out.append(made)
    return total, out


@pytest.mark.parametrize("leaves,least", [(31, 5), (6, 20), (2, 1)])
def test_trees_equal_brute_force(spark, leaves, least):
    x, y = table()
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = bo.fit(df.repartition(3), COLS, "y", rounds=5, rate=0.3, leaves=leaves, least=least, refresh=2)
    want, made = brute_boost(x, y, 5, 0.3, leaves, least)
    assert [t.leaves() for t in model.trees] == [len(m) + 1 for m in made]
    assert [sorted(f for f in t.feature if f >= 0) for t in model.trees] == [sorted(f for f, _ in m) for m in made]
    assert np.abs(model.predict(x) - want).max() < 1e-4
    again = bo.fit(df.repartition(1), COLS, "y", rounds=5, rate=0.3, leaves=leaves, least=least)
    assert [(t.feature, t.bin, t.left) for t in again.trees] == [(t.feature, t.bin, t.left) for t in model.trees]
    got = model.transform(df).select(*COLS, "prediction").collect()
    assert all(abs(r.prediction - float(model.predict(np.array([[r.a, r.b, r.c]]))[0])) < 1e-12 for r in got)


def test_defined_cases(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, 1.0, 5.0), (None, None, None), (4.0, 0.0, 9.0)], "a double, b double, y double")
    model = bo.fit(df, ["a", "b"], "y", rounds=3, least=1)
    assert model.rows == 3 and model.transform(df).where("prediction IS NULL").count() == 0
    flat = bo.fit(df.withColumn("y", F.lit(2.0)), ["a", "b"], "y", rounds=9)
    assert len(flat.trees) == 1 and flat.predict(np.array([[0.0, 0.0]]))[0] == 2.0       # nothing to lower: it stops
    with pytest.raises(ValueError):
        bo.fit(df.limit(0), ["a", "b"], "y")
    wide = spark.range(5000).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("y"))
    cuts = bo.feature_cuts(wide, ["a"], 255)[0]
    assert 200 <= len(cuts) <= 254 and bo.feature_cuts(wide.where("a < 200"), ["a"], 255)[0].tolist() == list(range(199))


def plain_loop(model, past, first, horizon, snap):
    """One series, one step at a time, each feature spelt out."""
    past, out = [float(v) for v in past], []
    for k in range(horizon):
        day = first + dt.timedelta(days=k)
        lag = lambda d: past[-d] if len(past) >= d else 0.0
        mean = lambda w: np.floor(sum(past[-w:]) / w * 1e6 + 0.5) / 1e6 if len(past) >= w else 0.0
        wday = {5: 1, 6: 2, 0: 3, 1: 4, 2: 5, 3: 6, 4: 7}[day.weekday()]
        x = np.array([[lag(7), lag(14), lag(28), mean(7), mean(28), wday, snap(day)]])
        out.append(float(model.predict(x)[0]))
        past.append(out[-1])
    return out


def test_recursive_forecast_equals_a_loop(spark):
    rng = np.random.default_rng(1)
    series = {f"S{i}_X_1": [int(v) for v in rng.poisson(2 + 3 * (np.arange(90) % 7 == i), 90)] for i in range(4)}
    s = silver_df(spark, series)
    model = fc.train_demand_model(fc.demand_features(s), max_iter=8, least=5)
    first = dt.date(2000, 1, 1) + dt.timedelta(days=90)
    calendar = spark.createDataFrame([(first + dt.timedelta(days=k), int(k % 3 == 0), 0, 0) for k in range(90)],
                                     "date date, snap_CA int, snap_TX int, snap_WI int")
    for cal, snap in ((None, lambda d: 0), (calendar, lambda d: int((d - first).days % 3 == 0))):
        got = {}
        for r in fc.forecasts_table(s, ("gbt",), 90, trained=model, calendar=cal).collect():
            got.setdefault(r.item_id, {})[r.step] = (r.predicted_units, r.date)
        for sid, units in series.items():
            mine = got[sid.rsplit("_", 2)[0]]
            want = plain_loop(model, units, first, 90, snap)
            assert [mine[k + 1][0] for k in range(90)] == pytest.approx(want, abs=1e-9)
            assert [mine[k + 1][1] for k in range(90)] == [first + dt.timedelta(days=k) for k in range(90)]
    one = model.transform(fc.demand_features(silver_df(spark, {k: [*v, 0] for k, v in series.items()}))).where(F.col("date") == F.lit(first))
    assert {r.id.split("_")[0]: r.prediction for r in one.collect()} == {
        i: pytest.approx(fc.forecasts_table(s, ("gbt",), 1, trained=model).where(F.col("item_id") == i).first().predicted_units) for i in got}
