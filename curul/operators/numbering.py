"""Counters, islands and neighbours over ordered rows.

Every operator takes the columns that part the rows: a window without them would put all rows into one task. ``order``
must decide every tie; where it doesn't, the result among tied rows is not defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curul.functions.calendar import legislative_year, period, term_start


def change_flag(keys: list[Column], window: object) -> Column:
    """1 where any key differs from the row before (nulls are equal), and on the first row."""
    same = None
    for k in keys:
        s = k.eqNullSafe(F.lag(k).over(window))
        same = s if same is None else same & s
    first = F.row_number().over(window) == 1
    return F.when(first | ~same, 1).otherwise(0)


def run_numbers(rows: DataFrame, part: list[str], order: list[str | Column], keys: list[str], run_col: str = "run", number_col: str = "number") -> DataFrame:
    """Number of the run of equal keys a row is in, and the row's number within it, both from 1."""
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    r = rows.withColumns({"__flag": change_flag([F.col(k) for k in keys], w), "__k": F.row_number().over(w)})
    r = r.withColumns({run_col: F.sum("__flag").over(upto), number_col: _since_change("__flag", upto)})
    return r.drop("__flag", "__k")


def _since_change(flag: str, upto: object) -> Column:
    """Rows since the last change: the place less that of the change, so no second shuffle by run is needed."""
    return F.col("__k") - F.max(F.when(F.col(flag) == 1, F.col("__k"))).over(upto) + 1


def folios(rows: DataFrame, part: list[str], order: list[str | Column], date_col: str) -> DataFrame:
    """Adds term, legislative_year, period, folio_term and folio_period.

    The first counter starts anew when the term differs from the row before, the second also when the year or the
    period does. Rows without a date get null folios and don't disturb the others: they count as their own run.
    """
    d = F.col(date_col)
    r = rows.withColumns({"term": term_start(d), "legislative_year": legislative_year(d), "period": period(d)})
    r = r.withColumn("__dated", F.col("term").isNotNull())
    w = Window.partitionBy(*part, "__dated").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumns({"__t": change_flag([F.col("term")], w), "__p": change_flag([F.col("term"), F.col("legislative_year"), F.col("period")], w), "__k": F.row_number().over(w)})
    r = r.withColumns({"folio_term": F.when(F.col("__dated"), _since_change("__t", upto)), "folio_period": F.when(F.col("__dated"), _since_change("__p", upto))})
    return r.drop("__dated", "__t", "__p", "__k")


def folios_by_key(rows: DataFrame, order: list[str | Column], date_col: str, part: list[str] | None = None) -> DataFrame:
    """The same numbers for rows whose order is by date: then a run is a key, and the window parts by it.

    Terms, years and periods follow one another without return, so no window spans more than one term."""
    d = F.col(date_col)
    r = rows.withColumns({"term": term_start(d), "legislative_year": legislative_year(d), "period": period(d)})
    p = part or []
    n = lambda *k: F.when(F.col("term").isNotNull(), F.row_number().over(Window.partitionBy(*p, *k).orderBy(*order)))
    return r.withColumns({"folio_term": n("term"), "folio_period": n("term", "legislative_year", "period")})


def ordinal(rows: DataFrame, keys: list[str], order: list[str | Column], out: str = "ordinal") -> DataFrame:
    """1, 2, 3 within the keys."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def forward_fill(rows: DataFrame, part: list[str], order: list[str | Column], col: str, out: str | None = None) -> DataFrame:
    """The last known value up to the row."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out or col, F.last(col, ignorenulls=True).over(w))


def slices(rows: DataFrame, part: list[str], start_col: str, text_col: str, out: str = "slice") -> DataFrame:
    """The text from each start (from 1) to the next one, the last to the end."""
    w = Window.partitionBy(*part).orderBy(start_col)
    end = F.coalesce(F.lead(start_col).over(w), F.length(text_col) + 1)
    return rows.withColumn(out, F.substring(text_col, F.col(start_col), end - F.col(start_col)))


def out_of_order(rows: DataFrame, part: list[str], order: list[str | Column], date_col: str, out: str = "out_of_order") -> DataFrame:
    """Whether the date is before the last dated row's."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.col(date_col) < F.last(date_col, ignorenulls=True).over(w), F.lit(False)))


def first_seen_row(rows: DataFrame, key: list[str], order: list[str | Column], row_col: str, out: str = "first_row") -> DataFrame:
    """The row number at which a repeated key was seen first; null on that row itself."""
    first = F.first(row_col).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, F.when(first != F.col(row_col), first))


def merge_fragments(rows: DataFrame, part: list[str], order: list[str | Column], keys: list[str], closed: str, text_col: str) -> DataFrame:
    """One row per fragment chain: consecutive rows of equal keys are joined while the one before isn't closed."""
    w = Window.partitionBy(*part).orderBy(*order)
    new = (change_flag([F.col(k) for k in keys], w) == 1) | F.coalesce(F.lag(closed).over(w), F.lit(True))
    r = rows.withColumn("__new", new.cast("int")).withColumn("chain", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("__k", F.row_number().over(w))
    return r.groupBy(*part, "chain", *keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__k", F.col(text_col).alias("t")))), lambda x: x["t"]), "\n").alias(text_col), F.count("*").alias("fragments"), F.bool_or(closed).alias(closed))
