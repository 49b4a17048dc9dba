"""What a layer's tables held when they were written, and whether they still do.

Row count and an order-independent fingerprint are observed in the pass that writes a table,
so they cost no scan.  A restart compares them with what it finds, before it builds on it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.reshape import day_columns, day_values
from shelfcast.sources import storage

PARTS = 3            # of a row's hash, 20 bits each: their sums stay within 64 bits up to 2**43 rows


def _metrics(df: DataFrame) -> list[Column]:
    days = day_columns(df)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in set(days)]
    # thousands of day columns are hashed as one array; a null and an absent value differ by place
    h = F.xxhash64(*rest, *([F.transform(day_values(days, "string"), lambda v: F.coalesce(v, F.lit("")))] if days else []),
                   *[c.isNull() for c in rest])
    part = lambda k: F.sum(F.shiftright(h, 20 * k).bitwiseAND(F.lit((1 << 20) - 1)))
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(part(k), F.lit(0)).cast("long").alias(f"f{k}") for k in range(PARTS)]]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its facts once it has been written."""
    seen = Observation()
    return df.observe(seen, *_metrics(df)), seen


def facts(df: DataFrame) -> dict[str, int]:
    """The same facts of a table, by one scan."""
    return {k: int(v) for k, v in df.agg(*_metrics(df)).first().asDict().items()}


def path(work_dir: str, layer: str) -> str:
    return f"{work_dir.rstrip('/')}/_layers/{layer}.json"


def forget(spark: SparkSession, work_dir: str, layer: str) -> None:
    """Before a layer is written again: until it is complete it has no manifest."""
    storage.delete(spark, path(work_dir, layer))


def record(spark: SparkSession, work_dir: str, layer: str, tables: dict[str, tuple[str, dict]]) -> None:
    """``tables``: name -> (path, facts)."""
    storage.write_json(spark, path(work_dir, layer), {
        n: {"path": p, "facts": {k: int(v) for k, v in f.items()}} for n, (p, f) in tables.items()}, replace=True)


def check(spark: SparkSession, work_dir: str, layer: str) -> None:
    """Raise, naming the layer and the table, unless the layer is complete and as it was written."""
    noted = storage.read_json(spark, path(work_dir, layer))
    if noted is None:
        raise ValueError(f"layer {layer} is not complete: it has no manifest")
    for name, table in noted.items():
        if not storage.exists(spark, table["path"]):
            raise ValueError(f"layer {layer}: table {name} is gone")
        try:
            now = facts(spark.read.parquet(table["path"]))
        except Exception as e:
            raise ValueError(f"layer {layer}: table {name} can't be read") from e
        if now != table["facts"]:
            raise ValueError(f"layer {layer}: table {name} is not as it was written "
                             f"({now['rows']} rows, {table['facts']['rows']} noted)")
