"""Bronze -> Silver -> Gold as one job with restart points.

Layers talk only through Parquet files in the work folder, so ``start_at``
can resume from any layer.  Each layer is one lazy plan cut at its write.  A complete layer has
a manifest (rows and fingerprint of each table, observed while it was written); a restart
compares the layer that it builds on with it first.
"""
from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from shelfcast.plans import manifest
from shelfcast.plans.gold import write_gold
from shelfcast.plans.silver import open_silver, publish_silver, silver_buckets, silver_sales_daily
from shelfcast.sources.bronze import ingest_bronze

LAYERS = ["bronze", "silver", "gold"]


@dataclass
class PipelineResult:
    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)

    @property
    def total_seconds(self) -> float:
        return sum(self.seconds.values())


class PipelineError(RuntimeError):
    def __init__(self, layer: str, cause: Exception):
        super().__init__(f"layer {layer} failed: {cause}")
        self.layer = layer
        self.cause = cause


def silver_path(work_dir: str) -> str:
    return f"{work_dir.rstrip('/')}/silver/silver_sales_daily.parquet"


def silver_table(work_dir: str) -> str:
    """Catalog name of a pipeline's Silver table (one per work folder)."""
    import hashlib
    return "silver_" + hashlib.sha1(work_dir.encode()).hexdigest()[:12]


def run_silver(spark: SparkSession, bronze_dir: str, out_path: str, table: str) -> dict:
    """Write Silver; its row count and fingerprint."""
    read = lambda n: spark.read.parquet(f"{bronze_dir.rstrip('/')}/{n}.parquet")
    sales = read("bronze_sales")
    n = silver_buckets(sales)
    silver, seen = manifest.observed(silver_sales_daily(sales, read("bronze_calendar"), read("bronze_prices"), partitions=n))
    publish_silver(silver, out_path, table, n)
    return seen.get


def load_silver(spark: SparkSession, work_dir: str) -> DataFrame:
    """The pipeline's Silver as a bucketed table (registered again if needed)."""
    work = work_dir.rstrip("/")
    return open_silver(spark, silver_path(work), silver_table(work))


def run_pipeline(spark: SparkSession, raw_dir: str, work_dir: str, start_at: str = "bronze",
                 cat: str | None = None, store: str | None = None,
                 on_missing: str = "error", null_tokens: list[str] | None = None) -> PipelineResult:
    """Run the layers from ``start_at`` on; stop at the first failure
    (``PipelineError`` names the layer).  Returns per-layer seconds, rows and
    output paths.  ``null_tokens``: texts of the raw files that mean null; by default
    those that pandas reads so."""
    if start_at not in LAYERS:
        raise ValueError(f"start_at must be one of {LAYERS}")
    work = work_dir.rstrip("/")
    bronze_dir, gold_dir, s_path = f"{work}/bronze", f"{work}/gold", silver_path(work)
    res = PipelineResult()
    first = LAYERS.index(start_at)
    if first:
        base = LAYERS[first - 1]
        try:
            manifest.check(spark, work, base)
        except Exception as exc:
            raise PipelineError(base, exc) from exc
    for layer in LAYERS[first:]:
        t0 = time.perf_counter()
        try:
            manifest.forget(spark, work, layer)
            if layer == "bronze":
                b = ingest_bronze(spark, raw_dir, bronze_dir, cat, store, on_missing, null_tokens)
                facts, paths = b.facts, b.paths
            elif layer == "silver":
                facts = {"silver_sales_daily": run_silver(spark, bronze_dir, s_path, silver_table(work))}
                paths = {"silver_sales_daily": s_path}
            else:
                facts = write_gold(spark, load_silver(spark, work), gold_dir)
                paths = {n: f"{gold_dir}/{n}.parquet" for n in facts}
            manifest.record(spark, work, layer, {n: (paths[n], f) for n, f in facts.items()})
            res.rows.update({n: f["rows"] for n, f in facts.items()})
            res.paths.update(paths)
        except Exception as exc:  # stop on the first failing layer
            raise PipelineError(layer, exc) from exc
        res.seconds[layer] = time.perf_counter() - t0
    return res
