"""Grouped, generated, conditional and pivoted aggregations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Aggregate = Callable[[Column], Column]


def exact_sum(column: Column | str, scale: int) -> Column:
    """Sum of values with at most ``scale`` decimal places that does not depend on the order of the rows.

    Added up as whole numbers of the last place, values too large for those as decimals of
    38 digits. A value with more places stops the query instead of being rounded; NaN and
    infinities add up as doubles do. NULLs are left out. For sums that may depend on the
    order in the last bits, use ``F.sum``.
    """
    column = (F.col(column) if isinstance(column, str) else column).cast("double")
    step, exact = float(10 ** scale), f"decimal(38,{scale})"
    finite = F.abs(column) < F.lit(float("inf"))
    # up to here a double tells neighbouring last places apart, and the quotient of a whole number is the value itself
    small = F.abs(column) < F.lit(2.0 ** 52 / step if scale <= 9 else 0.0)
    units = F.rint(column * F.lit(step))
    refused = F.raise_error(F.lit(f"a value has more than {scale} decimal places"))
    counted = F.when(small, F.when(units / F.lit(step) == column, units.cast("bigint")).otherwise(refused.cast("bigint")))
    large = column.cast(exact)
    rest = F.when(finite & ~small, F.when(large.cast("double") == column, large).otherwise(refused.cast(exact)))
    last = F.lit(1).cast(f"decimal({scale + 1},0)") if scale == 0 else F.expr(f"CAST('{10 ** -scale:.{scale}f}' AS decimal({scale},{scale}))")
    known = F.sum(counted.cast("decimal(18,0)")).cast("decimal(28,0)") * last
    # a digit less than the sums, so that adding the two keeps all places
    known, rest = (x.cast(f"decimal(37,{scale})") for x in (known, F.sum(rest)))
    return F.coalesce(F.sum(F.when(~finite, column)), F.coalesce(known + rest, known, rest).cast("double"))


def exact_mean(column: Column | str, scale: int) -> Column:
    """Mean of the known values, from the exact sum."""
    column = F.col(column) if isinstance(column, str) else column
    return exact_sum(column, scale) / F.nullif(F.count(column), F.lit(0))


def rounded_mean(digits: int = 6) -> Aggregate:
    """Mean as an aggregate whose result, not its input, is rounded."""
    return lambda column: F.round(F.avg(column), digits)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), id_suffix: str | None = None) -> list[str]:
    """Numeric columns by schema, without the excluded ones and those with an id suffix."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [name for name, kind in df.dtypes
            if (kind in kinds or kind.startswith("decimal"))
            and name not in exclude
            and not (id_suffix and name.lower().endswith(id_suffix.lower()))]


def build_aggregates(columns: Sequence[str], functions: Mapping[str, Aggregate],
                     conditions: Mapping[str, Column | None] | None = None) -> list[Column]:
    """All combinations of column, function and condition as named aggregates.

    The list is not bound to any data, and goes into one ``agg`` call. A
    condition of ``None`` takes every row.
    """
    built = []
    for label, condition in (conditions or {"": None}).items():
        for name in columns:
            value = F.col(name) if condition is None else F.when(condition, F.col(name))
            for kind, function in functions.items():
                built.append(function(value).alias("_".join(p for p in (name, kind, label) if p)))
    return built


def group_aggregate(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column] | Mapping[str, str]
                    ) -> DataFrame:
    """Aggregate per group, or over the whole frame when there are no keys."""
    grouped = df.groupBy(*keys)
    return grouped.agg(dict(aggregates)) if isinstance(aggregates, Mapping) else grouped.agg(*aggregates)


def group_all_numeric(df: DataFrame, keys: Sequence[str], kind: str, function: Aggregate) -> DataFrame:
    """One function over every numeric column that is not a key."""
    columns = numeric_columns(df, exclude=keys)
    return df.groupBy(*keys).agg(*build_aggregates(columns, {kind: function}))


def frequencies(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per group, most frequent first, ties in key order."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), *[F.asc_nulls_last(k) for k in keys])


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Rows and distinct values per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.count_distinct(column).alias(name))


def pivot_values(df: DataFrame, column: str, most: int = 1000) -> list:
    """The values of a column for a pivot, in order; more than ``most`` are an error, none is left out."""
    found = [r[0] for r in df.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; use the long form")
    return sorted(found, key=lambda v: (v is None, v))


def pivot_aggregate(df: DataFrame, keys: Sequence[str], column: str, values: Sequence,
                    aggregates: Sequence[Column]) -> DataFrame:
    """Pivot over given values; naming them saves the pass that would look for them."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(*aggregates)


def collect_joined(df: DataFrame, keys: Sequence[str], column: str, name: str, separator: str = "|",
                   distinct: bool = True) -> DataFrame:
    """Values of a group as one sorted string.

    For groups with a bound, such as the words of one document; each task merges
    equal values before the shuffle when ``distinct``.
    """
    collect = F.collect_set if distinct else F.collect_list
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(collect(column)), separator).alias(name))


def first_by(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], order: Column) -> DataFrame:
    """Per group, the columns of the row that comes first in ``order``."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), order).alias(n) for n, c in columns.items()])
