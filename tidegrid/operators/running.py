"""Running values along one order that no single task has to walk: within days, and from day to day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.timeutil import DAY


def running(rows: DataFrame, at: str, values: dict[str, tuple[str, Column]], keys: tuple[str, ...] = ()) -> DataFrame:
    """rows with further columns by name: ("max", c) and ("last", c) are the greatest and the last non-null c so far, the
    row's own included; ("lag", c) is c of the row before. at (ms) tells the order of each key's rows and doesn't repeat in it.

    Days are worked on apart; what each hands on is one row a day, and only these (365 a year) meet in one window.
    """
    made = rows.withColumns({"_day": F.expr(f"{at} div {DAY}"), **{f"_{n}": c for n, (_, c) in values.items()}})
    of_day = {"max": lambda c: F.max(c), "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))), "lag": lambda c: F.struct(F.max_by(c, at).alias("x"))}
    days = made.groupBy(*keys, "_day").agg(*[of_day[kind](f"_{n}").alias(n) for n, (kind, _) in values.items()])
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    over = {"max": lambda c: F.max(c).over(before), "last": lambda c: F.last(c, ignorenulls=True).over(before), "lag": lambda c: F.last(c).over(before)["x"]}
    days = days.select(*keys, "_day", *[over[kind](n).alias(f"_b_{n}") for n, (kind, _) in values.items()])
    own = Window.partitionBy(*keys, "_day").orderBy(at)
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    within = {
        "max": lambda n: F.greatest(F.max(f"_{n}").over(so_far), F.col(f"_b_{n}")), "last": lambda n: F.coalesce(F.last(f"_{n}", ignorenulls=True).over(so_far), F.col(f"_b_{n}")),
        "lag": lambda n: F.when(F.row_number().over(own) == 1, F.col(f"_b_{n}")).otherwise(F.lag(f"_{n}").over(own)),
    }
    both = made.join(days, [*keys, "_day"]).select(*rows.columns, *[within[kind](n).alias(n) for n, (kind, _) in values.items()])
    return both
