"""Column functions: casts, text normalisation, dates, ratios, correlation, bands, clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip_names(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Trim column names, then rename by `mapping`."""
    trimmed = df.toDF(*[c.strip() for c in df.columns])
    return trimmed.withColumnsRenamed(mapping or {})


def coerce(column, kind: str) -> Column:
    """Cast where bad text becomes null instead of an error."""
    return _c(column).try_cast(kind)


def title_case(column) -> Column:
    """Upper-case the first letter of each run of letters, lower-case the others.

    `initcap` only looks at blanks; here any non-letter starts a new word.
    """
    # a mark and a blank in front of each inner word start, taken out again afterwards
    opened = F.regexp_replace(_c(column), r"(?<=\P{L})(?=\p{L})", "\u0001 ")
    return F.replace(F.initcap(opened), F.lit("\u0001 "), F.lit(""))


def month_start(year, month) -> Column:
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Quarter, ISO week, last-quarter flag and progress through the year (0 in January, 1 in December)."""
    month = F.month(date)
    return df.withColumns(
        {
            "quarter": F.quarter(date),
            "week": F.weekofyear(date),
            "is_q4": (F.quarter(date) == 4).cast("int"),
            "year_progress": (month - 1) / F.lit(11.0),
        }
    )


def length_of_stay(start, end) -> Column:
    """Whole days, never below zero; null when the end is unknown."""
    days = F.datediff(_c(end), _c(start))
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0)))


def money(column, places: int = 2) -> Column:
    """Round half to even after scaling, as array libraries do."""
    return F.rint(_c(column) * F.lit(10.0**places)) / F.lit(10.0**places)


def ratio_features(
    df: DataFrame, price="price", range_="range_km", battery="battery_kwh", made="production",
    sold="deliveries", stations="stations",
) -> DataFrame:
    """Products and ratios of the delivery measures; a zero divisor gives null."""
    return df.withColumns(
        {
            "price_x_range": F.col(price) * F.col(range_),
            "battery_x_range": F.col(battery) * F.col(range_),
            "range_per_kwh": F.try_divide(F.col(range_), F.col(battery)),
            "made_minus_sold": F.col(made) - F.col(sold),
            "stations_per_sale": F.col(stations) / (F.col(sold) + 1),
        }
    )


def number_band(column, small: float = 10) -> Column:
    """Sign and size class of a number."""
    c = _c(column)
    return (
        F.when(c < 0, "negative")
        .when(c == 0, "zero")
        .when(c <= small, "small positive")
        .when(c.isNotNull(), "large positive")
    )


def safe_divide(df: DataFrame, a: str, b: str, name: str = "ratio") -> DataFrame:
    """a / b, null on a zero divisor. Columns that are not numeric are refused when the plan is built."""
    for c in (a, b):
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise TypeError(f"column {c} is {df.schema[c].dataType.simpleString()}, not a number")
    return df.withColumn(name, F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")))


def correlation(x, y) -> Column:
    """Pearson r of two columns as an aggregate: NaN where one of them is constant, null without rows.

    `corr` stops with a division by zero on a constant column.
    """
    own, other, both = F.regr_sxx(_c(y), _c(x)), F.regr_syy(_c(y), _c(x)), F.regr_sxy(_c(y), _c(x))
    return F.when(both.isNotNull(), F.coalesce(F.try_divide(both, F.sqrt(own * other)), F.lit(float("nan"))))


def clip(column, low=None, high=None) -> Column:
    """Bound values; nulls stay null."""
    c = _c(column)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def month_label(column) -> Column:
    return F.date_format(_c(column), "MMM yyyy")


def fixed_text(column, places: int = 2) -> Column:
    return F.format_string(f"%.{places}f", _c(column).cast("double"))
