"""Data-quality checks as queries: each returns rows (check, n_violations, passed).

The reference runs these as pytest assertions over the written tables; here
each is a Spark aggregate that any job can run (and ``dq_report`` runs them
all, the value rules of Silver sharing one scan).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents_sum
from shelfcast.schemas import FLAG_COLS, SILVER_CONTRACT

KEY_COLS = ["id", "item_id", "store_id", "date"]


def _result(df: DataFrame, name: str, violations: Column) -> DataFrame:
    return df.agg(violations.cast("bigint").alias("n_violations")).select(
        F.lit(name).alias("check"), "n_violations", (F.col("n_violations") == 0).alias("passed"))


def _from_count(df: DataFrame, name: str) -> DataFrame:
    """Check whose violations are the rows of ``df``."""
    return _result(df, name, F.count(F.lit(1)))


def dq_no_fanout(silver: DataFrame) -> DataFrame:
    """rows = distinct ids x distinct dates (violations = the difference).

    Three scalar counts instead of two ``countDistinct`` in one aggregate
    (which would Expand every row twice): distinct ids come straight from the
    id buckets of Silver, distinct dates are a tiny map-side aggregate."""
    n = silver.count()
    ids = silver.select("id").where(F.col("id").isNotNull()).distinct().count()
    dates = silver.select("date").where(F.col("date").isNotNull()).distinct().count()
    bad = abs(n - ids * dates)
    return silver.sparkSession.createDataFrame(
        [("no_fanout", bad, bad == 0)], "check string, n_violations bigint, passed boolean")


def dq_unique_grain(silver: DataFrame, keys=("id", "date")) -> DataFrame:
    """Rows beyond the first per (id, date)."""
    per = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _result(per, "unique_grain", F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def dq_keys_not_null(silver: DataFrame, keys=KEY_COLS) -> DataFrame:
    """One row per key column: its null count."""
    counts = silver.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    stacked = counts.select(F.inline(F.array(*[
        F.struct(F.lit(f"keys_not_null:{k}").alias("check"), F.col(k).cast("bigint").alias("n_violations"))
        for k in keys])))
    return stacked.select("check", "n_violations", (F.col("n_violations") == 0).alias("passed"))


def dq_units_non_negative(silver: DataFrame) -> DataFrame:
    """units >= 0; a null fails too."""
    return _result(silver, "units_non_negative",
                   F.count_if(~F.coalesce(F.col("units") >= 0, F.lit(False))))


def dq_price_positive(silver: DataFrame) -> DataFrame:
    """sell_price > 0 whenever present."""
    return _result(silver, "price_positive", F.count_if(F.col("sell_price") <= 0))


def dq_revenue_consistent(silver: DataFrame, tol: float = 1e-6) -> DataFrame:
    """abs(revenue - units * price) < tol on priced rows; a null revenue fails."""
    priced = F.col("sell_price").isNotNull()
    ok = F.coalesce(F.abs(F.col("revenue") - F.col("units") * F.col("sell_price")) < tol, F.lit(False))
    return _result(silver, "revenue_consistent", F.count_if(priced & ~ok))


def dq_complete_series(silver: DataFrame) -> DataFrame:
    """Every id has the same number of days (violations = distinct lengths - 1)."""
    per = silver.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return _result(per, "complete_series", F.greatest(F.countDistinct("n") - 1, F.lit(0)))


def dq_binary_flags(silver: DataFrame, flags=FLAG_COLS) -> DataFrame:
    """Flags in {0, 1}; null fails."""
    bad = [~F.coalesce(F.col(c).isin(0, 1), F.lit(False)) for c in flags]
    return _result(silver, "binary_flags", F.count_if(reduce(lambda a, b: a | b, bad)))


def dq_fact_matches_silver(fact: DataFrame, silver: DataFrame) -> DataFrame:
    """Equal row counts (violations = absolute difference)."""
    a = fact.agg(F.count(F.lit(1)).alias("a")).first()["a"]
    b = silver.agg(F.count(F.lit(1)).alias("b")).first()["b"]
    return fact.sparkSession.createDataFrame(
        [("fact_matches_silver", abs(a - b), a == b)],
        "check string, n_violations bigint, passed boolean")


def dq_dim_product_unique(dim: DataFrame) -> DataFrame:
    """item_id appears once in dim_product (violations = extra rows)."""
    per = dim.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return _result(per, "dim_product_unique", F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def dq_weekly_reconciles(weekly: DataFrame, silver: DataFrame) -> DataFrame:
    """Sum of the weekly table = sum of the daily rows: units within 1,
    revenue within 0.01 (sums in exact cents).  Two scalar aggregates."""
    w = weekly.agg(F.sum("total_units").alias("u"), cents_sum("total_revenue").alias("r")).first()
    d = silver.agg(F.sum("units").alias("u"), cents_sum("revenue").alias("r")).first()
    bad = int(abs((w["u"] or 0) - (d["u"] or 0)) >= 1) + int(abs((w["r"] or 0) - (d["r"] or 0)) >= 1)
    return weekly.sparkSession.createDataFrame(
        [("weekly_reconciles", bad, bad == 0)], "check string, n_violations bigint, passed boolean")


def dq_abc_covers_products(abc: DataFrame, dim: DataFrame) -> DataFrame:
    """Same row count as dim_product and classes within {A, B, C}."""
    a = abc.agg(F.count(F.lit(1)).alias("n"),
                F.count_if(~F.coalesce(F.col("abc_class").isin("A", "B", "C"), F.lit(False))).alias("bad")).first()
    n_dim = dim.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    bad = abs(a["n"] - n_dim) + a["bad"]
    return abc.sparkSession.createDataFrame(
        [("abc_covers_products", bad, bad == 0)], "check string, n_violations bigint, passed boolean")


def dq_abc_shares_sum_one(abc: DataFrame, tol: float = 1e-6) -> DataFrame:
    """abs(sum of revenue shares - 1) < tol."""
    return _result(abc, "abc_shares_sum_one",
                   F.when(F.abs(F.sum("revenue_share") - 1) < tol, 0).otherwise(1))


def dq_abc_sorted(abc: DataFrame, parts: int | None = None) -> DataFrame:
    """Revenue never increases along the class order (cumulative share, then
    revenue descending, then item).  A sequence is non-increasing iff no
    element exceeds the minimum of the elements before it, so the violations
    are the items whose revenue is above that running minimum - computed
    with the bucketed running aggregate, not a single-task global window."""
    from shelfcast.operators.prefix import running
    ordered = running(abc.select("item_id", "total_revenue", "cumulative_share"),
                      [("cumulative_share", True), ("total_revenue", False), ("item_id", True)],
                      {"_min_before": ("min", "total_revenue")}, parts=parts, exclusive=True)
    return _result(ordered, "abc_sorted", F.count_if(F.col("total_revenue") > F.col("_min_before")))


def dq_schema_contract(silver: DataFrame, contract=SILVER_CONTRACT) -> DataFrame:
    """Column present with its type; not-null columns hold no null; minimum
    values respected.  Extra columns are allowed.  One aggregate pass."""
    rows = []
    aggs = []
    fields = {f.name: f.dataType for f in silver.schema.fields}
    for col, (dtype, nullable, minimum) in contract.items():
        if col not in fields:
            rows.append((f"schema:{col}:present", 1))
            continue
        rows.append((f"schema:{col}:type", 0 if fields[col] == dtype else 1))
        if not nullable:
            aggs.append(F.count_if(F.col(col).isNull()).alias(f"{col}:not_null"))
        if minimum is not None:
            aggs.append(F.count_if(F.col(col) < minimum).alias(f"{col}:min"))
    spark = silver.sparkSession
    static = spark.createDataFrame(rows, "check string, n_violations bigint")
    if aggs:
        counts = silver.agg(*aggs)
        dynamic = counts.select(F.inline(F.array(*[
            F.struct(F.lit(f"schema:{c}").alias("check"), F.col(f"`{c}`").cast("bigint").alias("n_violations"))
            for c in counts.columns])))
        static = static.unionByName(dynamic)
    return static.select("check", "n_violations", (F.col("n_violations") == 0).alias("passed"))


class ContractError(ValueError):
    pass


def validate_contract(silver: DataFrame, contract=SILVER_CONTRACT) -> DataFrame:
    """Raise ``ContractError`` listing the failed rules; return the input."""
    failed = [r["check"] for r in dq_schema_contract(silver, contract).where(~F.col("passed")).collect()]
    if failed:
        raise ContractError("contract violated: " + ", ".join(failed))
    return silver


def dq_row_count_positive(df: DataFrame, name: str = "row_count_positive") -> DataFrame:
    """At least one row (``isEmpty`` stops at the first row found)."""
    empty = df.isEmpty()
    return df.sparkSession.createDataFrame([(name, 1 if empty else 0, not empty)],
                                           "check string, n_violations bigint, passed boolean")


def dq_silver_values(silver: DataFrame) -> DataFrame:
    """The row-level Silver rules in one scan: keys not null, units >= 0,
    price > 0, revenue consistent, binary flags."""
    priced = F.col("sell_price").isNotNull()
    rev_ok = F.coalesce(F.abs(F.col("revenue") - F.col("units") * F.col("sell_price")) < 1e-6, F.lit(False))
    flags_bad = reduce(lambda a, b: a | b, [~F.coalesce(F.col(c).isin(0, 1), F.lit(False)) for c in FLAG_COLS])
    rules = {f"keys_not_null:{k}": F.col(k).isNull() for k in KEY_COLS}
    rules.update({
        "units_non_negative": ~F.coalesce(F.col("units") >= 0, F.lit(False)),
        "price_positive": F.col("sell_price") <= 0,
        "revenue_consistent": priced & ~rev_ok,
        "binary_flags": flags_bad,
    })
    counts = silver.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    stacked = counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").cast("bigint").alias("n_violations")) for n in rules])))
    return stacked.select("check", "n_violations", (F.col("n_violations") == 0).alias("passed"))


def _rows(df: DataFrame, *checks: tuple[str, int]) -> DataFrame:
    """Check rows from violations that are known already."""
    return df.sparkSession.createDataFrame([(n, int(v), not v) for n, v in checks],
                                           "check string, n_violations bigint, passed boolean")


def dq_silver_totals(silver: DataFrame, fact: DataFrame, weekly: DataFrame) -> DataFrame:
    """The rules on counts and sums, from one aggregate by id (no exchange on the buckets,
    distinct dates included, since the dates of an id lie together), one count of dates, one
    of the fact's rows and one sum of the weekly table."""
    per_id = silver.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("date").alias("d"), F.count_if(F.col("date").isNull()).alias("z"),
        F.sum("units").alias("u"), cents_sum("revenue").alias("r"))
    spare = F.col("n") - F.col("d") - F.least(F.col("z"), F.lit(1))
    t = per_id.agg(F.sum("n").alias("n"), F.count("id").alias("ids"), F.sum(spare).alias("spare"),
                   F.countDistinct("n").alias("lengths"), F.sum("u").alias("u"), F.sum("r").alias("r")).first()
    n = t["n"] or 0
    dates = silver.select("date").where(F.col("date").isNotNull()).distinct().count()
    w = weekly.agg(F.sum("total_units").alias("u"), cents_sum("total_revenue").alias("r")).first()
    off = sum(abs((w[c] or 0) - (t[c] or 0)) >= 1 for c in ("u", "r"))
    return _rows(silver, ("no_fanout", abs(n - t["ids"] * dates)), ("unique_grain", t["spare"] or 0),
                 ("complete_series", max(t["lengths"] - 1, 0)), ("fact_matches_silver", abs(fact.count() - n)),
                 ("weekly_reconciles", off), ("row_count_positive:silver", int(n == 0)))


def dq_report(silver: DataFrame, fact: DataFrame, dim: DataFrame, weekly: DataFrame,
              abc: DataFrame) -> DataFrame:
    """All checks of Silver and Gold in one table; Silver is scanned for its row rules, for its
    totals and for its contract."""
    parts = [
        dq_silver_values(silver), dq_silver_totals(silver, fact, weekly), dq_dim_product_unique(dim),
        dq_abc_covers_products(abc, dim), dq_abc_shares_sum_one(abc), dq_abc_sorted(abc), dq_schema_contract(silver),
    ]
    return reduce(DataFrame.unionByName, parts)
