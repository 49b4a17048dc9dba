"""Bronze: raw CSV files -> Parquet, with subset filters and guards."""
from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.storage import exists
from shelfcast.sources.files import PANDAS_NULL_TOKENS, read_raw_csv, write_csv

log = logging.getLogger(__name__)

# logical Bronze table -> raw file name (the M5 names)
RAW_FILES = {
    "bronze_calendar": "calendar.csv",
    "bronze_prices": "sell_prices.csv",
    "bronze_sales": "sales_train_validation.csv",
}


def bronze_tables(raw_dir: str) -> dict[str, str]:
    return {name: f"{raw_dir.rstrip('/')}/{fname}" for name, fname in RAW_FILES.items()}


def write_raw(tables: dict[str, DataFrame], raw_dir: str) -> dict[str, str]:
    """Write Bronze-shaped frames as the raw headed CSV files."""
    paths = bronze_tables(raw_dir)
    for name, df in tables.items():
        write_csv(df, paths[name])
    return paths


def subset_filter(df: DataFrame, name: str, cat: str | None = None, store: str | None = None) -> DataFrame:
    """Sales: cat_id == cat and store_id == store; prices: store only;
    calendar: unfiltered.  A falsy filter means all.  The predicate is pushed
    into the scan."""
    if name == "bronze_sales":
        if cat:
            df = df.where(F.col("cat_id") == cat)
        if store:
            df = df.where(F.col("store_id") == store)
    elif name == "bronze_prices" and store:
        df = df.where(F.col("store_id") == store)
    return df


def nonempty_guard(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raise if any table is empty - checked for all before any is written,
    so a failure never leaves half a layer behind."""
    for name, df in tables.items():
        if df.isEmpty():
            raise ValueError(f"{name} is empty after filtering; check the subset filters")
    return tables


@dataclass
class BronzeResult:
    paths: dict[str, str]
    rows: dict[str, int]
    skipped: list[str]
    facts: dict[str, dict]


def read_bronze_sources(spark: SparkSession, raw_dir: str, cat: str | None = None,
                        store: str | None = None, on_missing: str = "error",
                        null_tokens: list[str] | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """Lazy frames of the raw tables, filtered.  ``on_missing``: "error"
    raises when a file (or the folder) is missing, "skip" logs and skips it."""
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing must be 'error' or 'skip'")
    if on_missing == "error" and not exists(spark, raw_dir):
        raise FileNotFoundError(f"raw folder {raw_dir} does not exist")
    frames, skipped = {}, []
    for name, path in bronze_tables(raw_dir).items():
        if not exists(spark, path):
            if on_missing == "error":
                raise FileNotFoundError(path)
            log.warning("raw file %s missing, skipped", path)
            skipped.append(name)
            continue
        frames[name] = subset_filter(read_raw_csv(spark, path, null_tokens=null_tokens), name, cat, store)
    return frames, skipped


def ingest_bronze(spark: SparkSession, raw_dir: str, bronze_dir: str, cat: str | None = None,
                  store: str | None = None, on_missing: str = "error",
                  null_tokens: list[str] | None = None) -> BronzeResult:
    """Raw files to Parquet.  Texts that pandas reads as missing are null, unless
    ``null_tokens`` says otherwise (an empty list: only empty fields)."""
    from shelfcast.plans.gold import write_tables

    tokens = PANDAS_NULL_TOKENS if null_tokens is None else null_tokens
    frames, skipped = read_bronze_sources(spark, raw_dir, cat, store, on_missing, tokens)
    nonempty_guard(frames)
    facts = write_tables(spark, frames, bronze_dir, parallel=len(frames))
    paths = {name: f"{bronze_dir.rstrip('/')}/{name}.parquet" for name in frames}
    return BronzeResult(paths, {n: f["rows"] for n, f in facts.items()}, skipped, facts)
