"""Currency, unit, date and precision normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.scalars import parse_date
from pricelake.operators.timeline import asof_join
from pricelake.reference_values import EXCHANGE_RATES, UNIT_FACTORS


def _factor(code: Column, factors: Mapping[str, float]) -> Column:
    """Factor of a code out of a small fixed map; 1.0 for unknown codes."""
    entries = F.create_map(*[part for k, v in factors.items() for part in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(entries, code), F.lit(1.0))


def normalize_prices(
    df: DataFrame, *, price: str = "price", currency: str = "currency", base: str = "USD",
    rates: Mapping[str, float] = EXCHANGE_RATES,
) -> DataFrame:
    """Convert to the base currency and name it in ``<price>_base_currency`` where converted."""
    differs = F.col(currency).isNotNull() & (F.col(currency) != base)
    converted = F.col(price) * _factor(F.col(currency), rates) / F.lit(float(rates.get(base, 1.0)))
    return df.withColumns(
        {
            price: F.when(differs, converted).otherwise(F.col(price)),
            f"{price}_base_currency": F.when(differs, F.lit(base)),
        }
    )


def normalize_prices_by_table(
    df: DataFrame, rates: DataFrame, *, price: str = "price", currency: str = "currency", base: str = "USD",
) -> DataFrame:
    """The same with rates in a table ``(currency, rate)``, rates quoted to one common currency."""
    base_rate = F.coalesce(F.max(F.when(F.col("currency") == base, F.col("rate"))), F.lit(1.0))
    relative = rates.select(
        F.col("currency").alias("__cur"), (F.col("rate") / rates.agg(base_rate).scalar()).alias("__rate")
    )
    joined = df.join(relative, F.col(currency) == F.col("__cur"), "left")
    differs = F.col(currency).isNotNull() & (F.col(currency) != base)
    return joined.withColumns(
        {
            price: F.when(differs, F.col(price) * F.coalesce("__rate", F.lit(1.0))).otherwise(F.col(price)),
            f"{price}_base_currency": F.when(differs, F.lit(base)),
        }
    ).drop("__cur", "__rate")


def normalize_prices_asof(
    df: DataFrame, rates: DataFrame, *, price: str = "price", currency: str = "currency", date: str = "date", base: str = "USD",
) -> DataFrame:
    """Convert with the latest rate of the currency on or before the row's date; adds ``rate_date`` and ``rate``.

    ``rates`` has ``(currency, rate_date, rate)``, one row per currency and day, in units of the base. A row whose
    currency has no rate yet gets a NULL price, since nothing is known of its value.
    """
    quotes = rates.select(F.col("currency").alias(currency), "rate_date", "rate")
    told = asof_join(df, quotes, keys=[currency], time=date, right_time="rate_date", columns=["rate"])
    differs = F.col(currency).isNotNull() & (F.col(currency) != base)
    return told.withColumns(
        {
            price: F.when(differs, F.col(price) * F.col("rate")).otherwise(F.col(price)),
            f"{price}_base_currency": F.when(differs & F.col("rate").isNotNull(), F.lit(base)),
        }
    )


def normalize_units(
    df: DataFrame, *, quantity: str = "quantity", unit: str = "unit", target: str = "ton",
    factors: Mapping[str, float] = UNIT_FACTORS,
) -> DataFrame:
    """Convert quantities to the target unit; an unknown unit keeps its number."""
    name = F.lower(F.col(unit))
    differs = name.isNotNull() & (name != target)
    converted = F.col(quantity) * _factor(name, factors) / F.lit(float(factors.get(target, 1.0)))
    return df.withColumns(
        {
            quantity: F.when(differs, converted).otherwise(F.col(quantity)),
            unit: F.when(differs, F.lit(target)).otherwise(F.col(unit)),
        }
    )


def normalize_timestamps(df: DataFrame, *, column: str = "date", output_format: str = "yyyy-MM-dd") -> DataFrame:
    """Rewrite recognised dates in one format; anything else stays as it was."""
    kind = dict(df.dtypes)[column]
    if kind != "string":
        return df.withColumn(column, F.date_format(F.col(column), output_format))
    parsed = parse_date(F.col(column))
    return df.withColumn(column, F.coalesce(F.date_format(parsed, output_format), F.col(column)))


def round_values(df: DataFrame, *, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), decimals) for c in columns})


def normalization_report(
    df: DataFrame, *, currency: str = "currency", unit: str = "unit", date: str = "date",
    base: str = "USD", target: str = "ton",
) -> DataFrame:
    """Conversions and parse errors a normalisation of ``df`` makes, one row per operation."""
    name = F.lower(F.col(unit))
    text = F.col(date).cast("string")
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(currency) != base).alias("normalize_prices"),
        F.count_if(name != target).alias("normalize_units"),
        F.count_if(text.isNotNull() & parse_date(text).isNull()).alias("normalize_timestamps"),
    )
    return counts.select(
        "rows",
        F.explode(
            F.create_map(
                *[
                    part
                    for c in ("normalize_prices", "normalize_units", "normalize_timestamps")
                    for part in (F.lit(c), F.col(c))
                ]
            )
        ).alias("operation", "affected"),
    )
