"""Numeric expressions that keep missing values as NULL and never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Smaller magnitudes count as zero in skewness: the cube of their variance underflows, and Spark then
# fails with a division by zero.
TINY = 1e-34


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: Column | str) -> Column:
    """Double, with unreadable text and NaN turned into NULL.

    A final letter is not part of a number, though Java reads "12f" and "12d" as one; "inf" and "infinity" are. The test
    is for text only: the type is known when a plan is made, and the test of other columns vanishes from it.
    """
    column = as_column(value)
    parsed = column.try_cast("double")
    is_text = F.typeof(column) == "string"
    suffixed = is_text & F.lower(F.trim(column.cast("string"))).rlike("[0-9.][fd]$")
    return F.when(~F.isnan(parsed) & ~suffixed, parsed)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is 0 or missing."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a partial sum and a partial count."""
    return ratio(total, count.cast("double"))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows where both are present; NULL if either is constant."""
    x, y = as_column(x), as_column(y)
    spread_x = F.stddev_pop(F.when(y.isNotNull(), x))
    spread_y = F.stddev_pop(F.when(x.isNotNull(), y))
    return ratio(F.covar_pop(x, y), spread_x * spread_y)


def bias_corrected(skew: Column, n: Column, low: Column, high: Column) -> Column:
    """Sample skewness from the population form: NULL below three values, 0 for a constant column."""
    n = n.cast("double")
    corrected = skew * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.when(low == high, F.lit(0.0)).otherwise(F.coalesce(corrected, F.lit(0.0))))


def sample_skewness(value: Column | str) -> Column:
    """Bias-corrected skewness of a column, as an aggregate."""
    value = as_column(value)
    visible = F.when(F.abs(value) < TINY, F.lit(0.0)).otherwise(value)
    return bias_corrected(F.skewness(visible), F.count(value), F.min(value), F.max(value))


def half_even(value: Column | str, digits: int) -> Column:
    """Round half to even."""
    return F.bround(as_column(value), digits)


def any_true(*conditions: Column) -> Column:
    """OR over conditions in which a missing comparison counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def by_label_order(label: Column | str, labels: tuple[str, ...]) -> Column:
    """Sort key that follows a given list of labels; labels outside the list come last."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), as_column(label))
    return F.when(position > 0, position).otherwise(F.lit(len(labels) + 1)).cast("int")
