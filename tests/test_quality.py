import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.operators import gold
from shelfcast.operators import quality as dq


def good(spark):
    return silver_df(spark, {"A_X_1": [1, 0, 2], "B_X_1": [0, 3, 1]}, price=2.0)


def passed(df):
    return all(r.passed for r in df.collect())


def test_all_checks_pass_on_good_data(spark):
    s = good(spark)
    abc = gold.abc_classification(s, parts=1)
    rep = dq.dq_report(s, gold.fact_sales(s), gold.dim_product(s), gold.weekly_category_sales(s), abc)
    bad = [r.check for r in rep.collect() if not r.passed]
    assert bad == []


@pytest.mark.parametrize("check,mutate", [
    (dq.dq_units_non_negative, lambda s: s.withColumn("units", F.when(F.col("units") == 3, -5).otherwise(F.col("units")))),
    (dq.dq_units_non_negative, lambda s: s.withColumn("units", F.when(F.col("units") == 3, None).otherwise(F.col("units")))),
    (dq.dq_price_positive, lambda s: s.withColumn("sell_price", F.lit(0.0))),
    (dq.dq_revenue_consistent, lambda s: s.withColumn("revenue", F.col("revenue") + 1)),
    (dq.dq_revenue_consistent, lambda s: s.withColumn("revenue", F.lit(None).cast("double"))),
    (dq.dq_binary_flags, lambda s: s.withColumn("is_active", F.lit(2).cast("tinyint"))),
    (dq.dq_binary_flags, lambda s: s.withColumn("snap_flag", F.lit(None).cast("tinyint"))),
    (dq.dq_keys_not_null, lambda s: s.withColumn("item_id", F.lit(None).cast("string"))),
    (dq.dq_complete_series, lambda s: s.where(~((F.col("id") == "A_X_1") & (F.col("units") == 0)))),
    (dq.dq_unique_grain, lambda s: s.unionByName(s.limit(1))),
    (dq.dq_no_fanout, lambda s: s.unionByName(s.limit(1))),
])
def test_planted_defect_fails(spark, check, mutate):
    s = good(spark)
    assert passed(check(s))
    assert not passed(check(mutate(s)))


def test_duplicate_price_key_fans_out(spark):
    """A duplicated (store, item, week) price doubles rows: dq_no_fanout fails."""
    from shelfcast.operators.joins import join_prices
    s = good(spark).drop("sell_price")
    prices = spark.createDataFrame([("CA_1", "A", 11101, 2.0), ("CA_1", "A", 11101, 2.5)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    assert not passed(dq.dq_no_fanout(join_prices(s, prices)))


def test_gold_checks_fail_on_defects(spark):
    s = good(spark)
    dim = gold.dim_product(s)
    assert not passed(dq.dq_dim_product_unique(dim.unionByName(dim.withColumn("dept_id", F.lit("X")))))
    weekly = gold.weekly_category_sales(s)
    assert not passed(dq.dq_weekly_reconciles(weekly.withColumn("total_units", F.col("total_units") + 5), s))
    abc = gold.abc_classification(s, parts=1)
    assert not passed(dq.dq_abc_covers_products(abc.withColumn("abc_class", F.lit("D")), dim))
    assert not passed(dq.dq_abc_shares_sum_one(abc.withColumn("revenue_share", F.lit(0.9))))
    unsorted = abc.withColumn("cumulative_share", -F.col("cumulative_share"))
    assert not passed(dq.dq_abc_sorted(unsorted, parts=1))
    assert not passed(dq.dq_fact_matches_silver(gold.fact_sales(s).limit(1), s))


def test_contract(spark):
    s = good(spark)
    assert passed(dq.dq_schema_contract(s))
    dq.validate_contract(s)
    neg = s.withColumn("units", F.when(F.col("units") == 3, -5).otherwise(F.col("units")))
    with pytest.raises(dq.ContractError, match="units:min"):
        dq.validate_contract(neg)
    with pytest.raises(dq.ContractError, match="date:type"):
        dq.validate_contract(s.withColumn("date", F.col("date").cast("string")))
    assert passed(dq.dq_schema_contract(s.withColumn("extra", F.lit(1))))   # extra columns allowed
    assert passed(dq.dq_row_count_positive(s)) and not passed(dq.dq_row_count_positive(s.limit(0)))
