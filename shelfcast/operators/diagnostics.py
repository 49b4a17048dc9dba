"""Series diagnostics before modelling: intermittency, life cycle,
Syntetos-Boylan demand classes, weekly seasonality and SNAP lift.

The reference loops over series in Python; here one aggregate per series
(a single shuffle on ``id``) yields the first-sale index and the demand
statistics, and every summary is an aggregate over that per-series table.
Medians are exact and distributed (``prefix.exact_median``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import weekday_mon0
from shelfcast.functions.numeric import round_half_even, round_half_up
from shelfcast.operators.prefix import exact_median
from shelfcast.operators.series import DateAxis, date_axis

# Syntetos-Boylan cut-offs and class names (strict "<").
ADI_CUT = "1.32"
CV2_CUT = "0.49"
CLASSES = ["smooth", "erratic", "intermittent", "lumpy", "sin_demanda"]
DEAD_WINDOW = 90
SPREAD_RELEVANT = 1.15

def _every():
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def intermittency_profile(silver: DataFrame, axis: DateAxis | None = None) -> DataFrame:
    """Series, days, cells, share of zero cells, mean and median of units (one row).

    Cells are counted per series first (no exchange on the buckets); the days are
    those of the date axis, so nothing is expanded for distinct counts."""
    axis = axis or date_axis(silver)
    per_id = silver.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("units") == 0).alias("z"),
        F.sum("units").alias("u"), F.count("units").alias("c"))
    one = per_id.agg(F.count("id").alias("n_series"), F.sum("n").alias("n_cells"), F.sum("z").alias("z"),
                     F.sum("u").alias("u"), F.sum("c").alias("c"))
    med = exact_median(silver, "units", out="m").first()
    return one.select(
        "n_series", F.lit(axis.n_dates).cast("long").alias("n_days"), "n_cells",
        round_half_up(F.try_divide("z", "n_cells"), 6).alias("zero_share"),
        round_half_up(F.try_divide("u", "c"), 6).alias("mean_units"),
        F.lit(med["m"] if med else None).cast("double").alias("median_units"))


def series_stats(silver: DataFrame, axis: DateAxis | None = None, dead_window: int = DEAD_WINDOW) -> DataFrame:
    """Per series: first-sale index (-1 never sold), sales in the last
    ``dead_window`` days, and - from the first sale on - days to the end of the axis, days with
    sales, n * sum(x^2) and (sum x)^2 over the non-zero units (integers, so the
    demand statistics below are exact)."""
    axis = axis or date_axis(silver)
    df = axis.with_index(silver.select("id", "date", "units"))
    idx, u = F.col("day_index"), F.col("units")
    first = df.groupBy("id").agg(
        F.coalesce(F.min(F.when(u > 0, idx)), F.lit(-1)).alias("first_sale_index"),
        F.sum(F.when(idx >= axis.n_dates - dead_window, u)).alias("recent_units"),
        F.count(F.lit(1)).alias("n_days"),
        F.sum(F.when(u > 0, 1).otherwise(0)).alias("sale_days"),
        F.sum(F.when(u > 0, u.cast("bigint"))).alias("s1"),
        F.sum(F.when(u > 0, u.cast("bigint") * u.cast("bigint"))).alias("s2"),
    )
    # active days = days from the first sale to the end of the date axis
    active = F.when(F.col("first_sale_index") >= 0, F.lit(axis.n_dates) - F.col("first_sale_index"))
    return first.select("id", "first_sale_index", "recent_units", "n_days", "sale_days",
                        active.alias("active_days"), "s1", "s2")


def syntetos_boylan(adi_num, adi_den, cv_num, cv_den):
    """Class of ADI = adi_num / adi_den and CV^2 = cv_num / cv_den, compared without
    dividing (exact for integers and decimals); strict ``<`` cuts, null -> ``sin_demanda``."""
    exact = lambda c: c.cast("decimal(38,0)")
    return _classes(exact(adi_num) * 100 < exact(adi_den) * 132, exact(cv_num) * 100 < exact(cv_den) * 49)


def _classes(low_adi, low_cv):
    return (F.when(low_adi.isNull() | low_cv.isNull(), "sin_demanda")
            .when(low_adi & low_cv, "smooth").when(low_adi, "erratic")
            .when(low_cv, "intermittent").otherwise("lumpy"))


def classify_syntetos_boylan(adi, cv2):
    """The same rule for given (ADI, CV^2) numbers."""
    a, c = F.col(adi) if isinstance(adi, str) else adi, F.col(cv2) if isinstance(cv2, str) else cv2
    low = lambda x, cut: F.when(~F.isnan(x), x < F.lit(float(cut)))
    return _classes(low(a, ADI_CUT), low(c, CV2_CUT))


def demand_stats(stats: DataFrame) -> DataFrame:
    """ADI = active days / days with sales; CV^2 = (population std / mean)^2
    of the non-zero units = (n*sum x^2 - (sum x)^2) / (sum x)^2, in decimals of 38
    digits; class by ``syntetos_boylan``; never sold -> ``sin_demanda``."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cv_num = big("sale_days") * big("s2") - big("s1") * big("s1")
    cv_den = big("s1") * big("s1")
    n, act = F.col("sale_days"), F.col("active_days")
    sold = F.col("first_sale_index") >= 0
    return stats.select(
        "id", "first_sale_index",
        F.when(sold, act.cast("double") / n.cast("double")).alias("adi"),
        F.when(sold, cv_num.cast("double") / cv_den.cast("double")).alias("cv2"),
        F.when(sold, syntetos_boylan(act, n, cv_num, cv_den)).otherwise("sin_demanda").alias("demand_class"),
    )


def series_lifecycle(stats: DataFrame) -> DataFrame:
    """Never sold (index -1), born late (index > 0), no sales in the last 90
    days (never-sold series included)."""
    f = F.col("first_sale_index")
    return stats.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(f == -1).alias("never_sold"),
        F.count_if(f > 0).alias("born_late"),
        F.count_if(F.coalesce(F.col("recent_units"), F.lit(0)) == 0).alias("dead_90"),
    )


def launch_delay(stats: DataFrame) -> DataFrame:
    """Median and maximum first-sale index among series born late."""
    late = stats.where(F.col("first_sale_index") > 0)
    med = exact_median(late, "first_sale_index", out="m").first()
    return late.agg(F.max("first_sale_index").alias("max_delay")).select(
        F.lit(med["m"] if med else None).cast("double").alias("median_delay"), "max_delay")


def pre_launch_zeros(stats: DataFrame) -> DataFrame:
    """Zeros before the first sale of late series: count and share of all cells."""
    f = F.col("first_sale_index")
    return stats.agg(
        F.coalesce(F.sum(F.when(f > 0, f.cast("bigint"))), F.lit(0).cast("bigint")).alias("pre_launch_zeros"),
        F.sum("n_days").alias("_cells"),
    ).select("pre_launch_zeros",
             round_half_up(F.col("pre_launch_zeros") / F.col("_cells"), 6).alias("pre_launch_share"))


def demand_class_summary(demand: DataFrame) -> DataFrame:
    """Series per class, percent (1 decimal, half-even), the median ADI and CV^2 of the
    series in the class, and those of all series (the same in each row)."""
    counts = demand.groupBy("demand_class").agg(F.count(F.lit(1)).alias("n_series"))
    counts = counts.select("demand_class", "n_series", round_half_even(
        F.col("n_series") / F.sum("n_series").over(_every()) * 100, 1).alias("pct_series"))  # <= 5 rows
    med_adi = exact_median(demand, "adi", ["demand_class"], out="median_adi")
    med_cv2 = exact_median(demand, "cv2", ["demand_class"], out="median_cv2")
    overall = {}
    for c in ("adi", "cv2"):
        row = exact_median(demand, c, out="m").first()
        overall[c] = F.lit(row["m"] if row else None).cast("double")
    return counts.join(med_adi, "demand_class", "left").join(med_cv2, "demand_class", "left").select(
        "demand_class", "n_series", "pct_series",
        round_half_up("median_adi", 6).alias("median_adi"), round_half_up("median_cv2", 6).alias("median_cv2"),
        round_half_up(overall["adi"], 6).alias("overall_median_adi"),
        round_half_up(overall["cv2"], 6).alias("overall_median_cv2"))


def weekday_means(silver: DataFrame) -> DataFrame:
    """Total units per date, then the mean of those totals per weekday (Mon=0).
    Both aggregates are combined map-side; the result has 7 rows."""
    daily = silver.groupBy("date").agg(F.sum("units").alias("daily_units"))
    return daily.groupBy(weekday_mon0("date").alias("weekday")).agg(F.avg("daily_units").alias("mean_units"))


def weekday_seasonality(silver: DataFrame) -> DataFrame:
    """Index = weekday mean / unweighted mean of the seven weekday means x 100."""
    m = weekday_means(silver)
    return m.select("weekday", round_half_up("mean_units", 6).alias("mean_units"),
                    round_half_up(F.try_divide(F.col("mean_units"), F.avg("mean_units").over(_every())) * 100, 6)
                    .alias("seasonal_index"))


def weekday_spread(silver: DataFrame) -> DataFrame:
    """max / min of the weekday means; relevant when above 1.15."""
    m = weekday_means(silver)
    spread = F.try_divide(F.max("mean_units"), F.min("mean_units"))
    return m.agg(spread.alias("_s")).select(
        round_half_up("_s", 6).alias("spread"),
        F.coalesce(F.col("_s") > SPREAD_RELEVANT, F.lit(False)).alias("weekly_seasonality"))


def snap_lift(silver: DataFrame) -> DataFrame:
    """Mean units with and without SNAP; lift in percent only when both exist."""
    s = F.col("snap_flag")
    out = silver.agg(
        F.avg(F.when(s == 0, F.col("units"))).alias("m0"),
        F.avg(F.when(s == 1, F.col("units"))).alias("m1"),
    )
    return out.select(
        round_half_up("m0", 6).alias("mean_no_snap"), round_half_up("m1", 6).alias("mean_snap"),
        round_half_up((F.try_divide(F.col("m1"), F.col("m0")) - 1) * 100, 6).alias("lift_pct"))


def modelling_hints(silver: DataFrame, stats: DataFrame, demand: DataFrame) -> DataFrame:
    """One row of the facts that steer the model design (four one-row aggregates; three
    of them are read as scalars)."""
    cls = demand.agg((F.count_if(F.col("demand_class").isin("intermittent", "lumpy")) / F.count(F.lit(1)))
                     .alias("share")).first()
    life = stats.agg(F.count_if(F.col("first_sale_index") > 0).alias("late"),
                     F.count_if(F.coalesce(F.col("recent_units"), F.lit(0)) == 0).alias("dead")).first()
    season = weekday_spread(silver).first()
    return silver.agg(F.avg(F.when(F.col("units") == 0, 1.0).otherwise(0.0)).alias("z")).select(
        round_half_up("z", 6).alias("zero_share"),
        round_half_up(F.lit(cls["share"]).cast("double"), 6).alias("intermittent_lumpy_share"),
        F.lit(life["late"] > 0).alias("has_pre_launch_zeros"), F.lit(life["dead"]).cast("long").alias("dead_series"),
        F.lit(season["weekly_seasonality"]).alias("weekly_seasonality"))
