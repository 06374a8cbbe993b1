"""Calendar, trading, price-change and commodity attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.series import carry_last
from pricelake.reference_values import COMMODITY_ATTRIBUTES, HOLIDAYS


def add_date_dimensions(df: DataFrame, *, date: str = "date") -> DataFrame:
    """Year, month, quarter, day name, ISO week and weekend flag; NULL for text that is no date."""
    day = F.col(date)
    if dict(df.dtypes)[date] == "string":
        day = F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(day, F.lit("yyyy-M-d"))).cast("date")
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "day_of_week": F.date_format(day, "EEEE"),
            "week_of_year": F.weekofyear(day),
            "is_weekend": F.weekday(day) >= 5,
        }
    )


def add_trading_flags(df: DataFrame, *, date: str = "date", holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Holiday flag and trading status."""
    closed = F.coalesce(F.col(date).cast("string").isin(*holidays), F.lit(False))
    return df.withColumns(
        {"is_holiday": closed, "trading_status": F.when(closed, "halted").otherwise("active")}
    )


def add_price_changes(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "price", **limits
) -> DataFrame:
    """Change against the previous known price, rounded to cents; a zero base gives 0 percent."""
    previous = F.col("__previous")
    seen = carry_last(df, keys, order_by, {"__previous": price}, include_current=False, **limits)
    change = F.col(price) - previous
    return seen.withColumns(
        {
            "price_change": F.round(change, 2),
            "price_change_pct": F.round(
                F.when(previous == 0, F.when(change.isNotNull(), 0.0)).otherwise(
                    F.try_divide(change, previous) * 100
                ),
                2,
            ),
        }
    ).drop("__previous")


def add_commodity_attributes(
    df: DataFrame, *, commodity: str = "commodity",
    attributes: Mapping[str, Mapping[str, str]] = COMMODITY_ATTRIBUTES,
) -> DataFrame:
    """Attributes of a small fixed map as ``commodity_<name>`` columns, by exact name."""
    names = list(dict.fromkeys(k for entry in attributes.values() for k in entry))
    out = {}
    for name in names:
        pairs = [
            part for k, v in attributes.items() if name in v for part in (F.lit(k), F.lit(v[name]))
        ]
        out[f"commodity_{name}"] = F.try_element_at(F.create_map(*pairs), F.col(commodity))
    return df.withColumns(out)


def add_commodity_attributes_by_table(
    df: DataFrame, attributes: DataFrame, *, commodity: str = "commodity"
) -> DataFrame:
    """The same from a table keyed by ``commodity``; Spark broadcasts it when it is small."""
    renamed = attributes.select(
        F.col("commodity").alias("__name"),
        *[F.col(c).alias(f"commodity_{c}") for c in attributes.columns if c != "commodity"],
    )
    return df.join(renamed, F.col(commodity) == F.col("__name"), "left").drop("__name")
