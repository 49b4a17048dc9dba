"""Silver -> demand profile (the reference's diagnose step as tables)."""
from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.operators import diagnostics as dg
from shelfcast.operators.series import date_axis
from shelfcast.session import checkpoint_root


def diagnose(silver: DataFrame) -> dict[str, DataFrame]:
    axis = date_axis(silver)
    # the per-series table feeds five outputs: written once to the shared
    # checkpoint folder (one row per series, a fraction of Silver)
    checkpoint_root(silver.sparkSession)
    stats = dg.series_stats(silver, axis).checkpoint(eager=True)
    demand = dg.demand_stats(stats)
    return {
        "intermittency_profile": dg.intermittency_profile(silver),
        "series_lifecycle": dg.series_lifecycle(stats),
        "launch_delay": dg.launch_delay(stats),
        "pre_launch_zeros": dg.pre_launch_zeros(stats),
        "demand_class_summary": dg.demand_class_summary(demand),
        "weekday_seasonality": dg.weekday_seasonality(silver),
        "weekday_spread": dg.weekday_spread(silver),
        "snap_lift": dg.snap_lift(silver),
        "modelling_hints": dg.modelling_hints(silver, stats, demand),
    }
