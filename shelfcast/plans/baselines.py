"""Silver -> baseline forecasts -> metrics -> comparison table."""
from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.operators import forecast as fc
from shelfcast.operators import metrics as m
from shelfcast.operators.series import date_axis
from shelfcast.session import checkpoint_root


def run_baselines(silver: DataFrame, horizon: int = fc.HORIZON, with_weights: bool = True):
    """Returns (evaluated, comparison, best) DataFrames."""
    axis = date_axis(silver)
    frame = fc.baseline_frame(silver, horizon=horizon, axis=axis)
    forecasts = fc.baseline_forecasts(frame)
    weights = fc.revenue_weights(silver, horizon=horizon, axis=axis) if with_weights else None
    # five rows; written once to the shared checkpoint folder so that the table
    # and the best model do not each recompute the whole evaluation
    checkpoint_root(silver.sparkSession)
    evaluated = m.evaluate_models(forecasts, weights).checkpoint(eager=True)
    table = m.comparison_table(evaluated)
    return evaluated, table, m.best_model(table)
