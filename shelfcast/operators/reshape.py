"""Wide <-> long reshaping of the daily sales series."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import DAY_PREFIX, ID_COLS


def day_columns(df: DataFrame, prefix: str = DAY_PREFIX) -> list[str]:
    """Value columns of a wide sales table: names starting with ``d_``.

    ``dept_id`` does not start with ``d_`` and stays an id column."""
    return [c for c in df.columns if c.startswith(prefix)]


def day_values(days: list[str], dtype: str = "int"):
    """Array of the day columns.  One SQL text: thousands of column objects made one by one
    would take far longer to plan than the query to run."""
    return F.expr("array(" + ", ".join(f"CAST(`{d}` AS {dtype})" for d in days) + ")")


def literals(values: list):
    """Array of literal numbers or plain names."""
    return F.expr("array(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values) + ")")


def unpivot_sales(sales: DataFrame, id_cols: list[str] | None = None,
                  include_nulls: bool = True, prefix: str = DAY_PREFIX) -> DataFrame:
    """Wide ``id.. | d_1 .. d_N`` to long ``id.. | d | units``.

    ``posexplode`` of one array per row; the day name is looked up by position
    in a literal array, so gaps in the numbering (d_1, d_3) survive.  Null cells
    are kept (the local path) unless ``include_nulls`` is False (SQL UNPIVOT).
    A Generate keeps the child's partitioning, so no shuffle is added here.
    """
    id_cols = list(id_cols or ID_COLS)
    days = day_columns(sales, prefix)
    if not days:
        raise ValueError("no day columns to unpivot")
    names, values = literals(days), day_values(days)
    long_df = sales.select(*id_cols, F.posexplode(values).alias("_pos", "units")).select(
        *id_cols, F.element_at(names, F.col("_pos") + 1).alias("d"), "units"
    )
    if not include_nulls:
        long_df = long_df.where(F.col("units").isNotNull())
    return long_df


def unpivot_sales_sql(sales: DataFrame) -> DataFrame:
    """The SQL path: UNPIVOT drops null cells and the projection drops dept_id."""
    ids = [c for c in ID_COLS if c != "dept_id"]
    return unpivot_sales(sales, ids, include_nulls=False)


def series_matrix(long_df: DataFrame, dates: list, index: str = "id",
                  column: str = "date", value: str = "units") -> DataFrame:
    """Export-only pivot ``index x date -> units`` (computation stays long).

    Raises if (index, date) repeats: a cell holds one value.
    ``dates`` are the pivot values (the small, bounded date list); a series' cells, at most one
    per date, are gathered once with their places in that list, and places without a cell are
    filled in (looking every date up in a map would take the square of the dates).  The columns
    come out of a generator: as a projection they would be merged into what a caller makes of
    them, and an expression over all of them be compiled, on the driver, as one method of
    thousands of variables.
    """
    dup = long_df.groupBy(index, column).count().where(F.col("count") > 1).limit(1)
    if dup.count() > 0:
        raise ValueError(f"duplicate ({index}, {column}) rows: cannot pivot")
    at = {d: i for i, d in enumerate(dict.fromkeys(f"{d}" for d in dates))}
    wanted = F.expr("array(" + ", ".join(f"DATE'{d}'" for d in at) + ")")
    place = long_df.sparkSession.range(1).select(F.posexplode(wanted).alias("_at", "_date"))
    placed = (long_df.where(F.col(column).isNotNull()).select(index, F.col(column).alias("_on"), F.col(value).alias("_v"))
              .join(F.broadcast(place), F.col("_on") == F.col("_date"), "left"))
    cells = placed.groupBy(index).agg(
        F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_v"))).alias("_cells"))
    empty = F.lit(None).cast(long_df.schema[value].dataType)
    gaps = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(len(at) - 1)), F.col("_cells._at")),
                       lambda i: F.struct(i.alias("_at"), empty.alias("_v")))
    row = cells.select(index, F.sort_array(F.concat("_cells", gaps))["_v"].alias("_row"))
    days = ", ".join(f"'{d}', get(_row, {at[f'{d}']})" for d in dates)
    return row.selectExpr(index, f"inline(array(named_struct({days})))")
