"""shelfcast: retail demand analytics (medallion pipeline, ABC, series diagnostics,
forecast baselines, scaled error metrics and data-quality checks) expressed as
Spark DataFrame / SQL jobs."""

__all__ = ["session"]
