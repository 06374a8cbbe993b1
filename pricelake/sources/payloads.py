"""Landed exchange-rate payloads and futures quotes turned into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import safe_number
from pricelake.operators.series import over_series

FX_ITEM = (
    "struct<base_currency:string,quote_currency:string,rate:double,buy_rate:double,sell_rate:double,"
    "rate_type:string,source_timestamp:string>"
)


def _items(payload: Column) -> Column:
    """Elements of a JSON list as raw texts; anything but a list has no elements."""
    is_list = F.ltrim(payload).startswith("[")
    return F.when(is_list, F.from_json(payload, "array<string>"))


def _fx_item(base, quote, rate, buy, sell, kind: str, stamp) -> Column:
    nothing = F.lit(None)
    return F.struct(
        base.alias("base_currency"), quote.alias("quote_currency"), rate.alias("rate"),
        (nothing if buy is None else buy).cast("double").alias("buy_rate"),
        (nothing if sell is None else sell).cast("double").alias("sell_rate"),
        F.lit(kind).alias("rate_type"),
        (nothing if stamp is None else stamp).cast("string").alias("source_timestamp"),
    )


def official_list_rates(payload: Column) -> Column:
    """Array of rates from ``[{cc, rate, exchangedate}]``; items lacking code or rate are left out."""
    parsed = F.transform(_items(payload), lambda t: F.from_json(t, "cc string, rate string, exchangedate string"))
    rows = F.transform(
        parsed,
        lambda i: _fx_item(
            i["cc"], F.lit("UAH"), safe_number(i["rate"]), None, None, "official", i["exchangedate"]
        ),
    )
    return F.filter(rows, lambda r: r["base_currency"].isNotNull() & r["rate"].isNotNull())


def cash_market_rates(payload: Column) -> Column:
    """Array of rates from ``[{ccy, base_ccy, buy, sale}]``; the rate is the middle of both sides."""
    parsed = F.transform(
        _items(payload), lambda t: F.from_json(t, "ccy string, base_ccy string, buy string, sale string")
    )

    def row(item: Column) -> Column:
        buy, sell = safe_number(item["buy"]), safe_number(item["sale"])
        return _fx_item(item["ccy"], item["base_ccy"], (buy + sell) / 2, buy, sell, "cash_market", None)

    named = lambda c: c.isNotNull() & (c != "")
    return F.filter(
        F.transform(parsed, row),
        lambda r: named(r["base_currency"]) & named(r["quote_currency"])
        & (r["buy_rate"].isNotNull() | r["sell_rate"].isNotNull()),
    )


def reference_map_rates(payload: Column) -> Column:
    """Array of rates from ``{base, date, rates: {code: rate}}``; unparseable rates are left out."""
    is_object = F.ltrim(payload).startswith("{")
    body = F.when(is_object, F.from_json(payload, "base string, date string, rates map<string,string>"))
    base = F.coalesce(body["base"], F.lit("USD"))
    rows = F.transform(
        F.map_entries(body["rates"]),
        lambda e: _fx_item(
            base, e["key"], safe_number(e["value"]), None, None, "daily_reference", body["date"]
        ),
    )
    return F.filter(rows, lambda r: r["rate"].isNotNull())


FX_PARSERS = {
    "NBU": official_list_rates,
    "PrivatBank": cash_market_rates,
    "ExchangeRateAPI": reference_map_rates,
}


def fx_rates(payloads: DataFrame) -> DataFrame:
    """Rates of every landed payload ``(provider, source_endpoint, payload, extracted_at)``.

    One narrow pass: each payload becomes its rates, or one placeholder row whose note
    says why there are none.
    """
    provider, payload = F.col("provider"), F.col("payload")
    rates = F.lit(None).cast(f"array<{FX_ITEM}>")
    for name, parse in FX_PARSERS.items():
        rates = F.when(provider == name, parse(payload)).otherwise(rates)
    supported = provider.isin(*FX_PARSERS)
    found = F.coalesce(F.size("__rates") > 0, F.lit(False))
    note = (
        F.when(payload.isNull(), ref.NOTE_PROVIDER_UNAVAILABLE)
        .when(~supported, ref.NOTE_UNSUPPORTED)
        .when(found, ref.NOTE_OK)
        .otherwise(ref.NOTE_NO_ROWS)
    )
    return (
        payloads.withColumn("__rates", rates)
        .withColumn("note", note)
        .withColumn("__rate", F.explode_outer(F.when(found, F.col("__rates"))))
        .select("provider", "source_endpoint", "__rate.*", "note", "extracted_at")
    )


def fx_rates_of(payloads: DataFrame, provider: str) -> DataFrame:
    """Rows of one provider only, without placeholders."""
    rates = FX_PARSERS[provider](F.col("payload"))
    return payloads.filter(F.col("provider") == provider).select(
        "provider", "source_endpoint", F.inline(rates), F.lit(ref.NOTE_OK).alias("note"), "extracted_at"
    )


def instrument_array(instruments: Sequence[tuple] = tuple(ref.INSTRUMENTS)) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit(ticker).alias("ticker"), F.lit(category).alias("category"),
                F.lit(unit).alias("unit"), F.lit(text).alias("description"),
                F.lit(kg).cast("double").alias("kg_per_unit"), F.lit(float(scale)).alias("per_dollar"),
            )
            for name, ticker, unit, kg, scale, category, text in instruments
        ]
    )


def futures_prices(quotes: DataFrame, instruments: Sequence[tuple] = tuple(ref.INSTRUMENTS)) -> DataFrame:
    """Dollar and dollar-per-ton prices of quotes ``(extracted_at, ticker, raw_price)``.

    Every extraction lists every instrument; one without a quote gets a placeholder row.
    """
    expected = quotes.select("extracted_at").distinct().select(
        "extracted_at", F.inline(instrument_array(instruments))
    )
    given = quotes.select(F.col("extracted_at").alias("__at"), F.col("ticker").alias("__ticker"), "raw_price")
    joined = expected.join(
        given, (F.col("extracted_at") == F.col("__at")) & (F.col("ticker") == F.col("__ticker")), "left"
    )
    dollars = F.col("raw_price") / F.col("per_dollar")
    return joined.select(
        "name", "ticker", "category", "unit", "description", "raw_price",
        dollars.alias("price_in_dollars"),
        (dollars * (F.lit(1000.0) / F.col("kg_per_unit"))).alias("usd_per_ton"),
        F.when(F.col("raw_price").isNull(), ref.NOTE_PRICE_UNAVAILABLE).otherwise(ref.NOTE_OK).alias("note"),
        "extracted_at",
    )


def replace_spikes(
    history: DataFrame, *, ticker: str = "ticker", date: str = "date", close: str = "close",
    instruments: Sequence[str] | None = ref.SPIKE_CHECKED_TICKERS, threshold: float = 0.5, **limits,
) -> DataFrame:
    """Use the previous close where a close is more than half off the mean of up to 4 earlier ones."""
    def build(window):
        return {
            "__mean": F.avg(close).over(window.rowsBetween(-4, -1)),
            "__previous": F.lag(close, 1).over(window),
        }

    seen = over_series(history, [ticker], [date], build, before=4, **limits)
    gap = F.try_divide(F.abs(F.col(close) - F.col("__mean")), F.col("__mean"))
    checked = F.lit(True) if instruments is None else F.col(ticker).isin(*instruments)
    spiked = checked & F.coalesce(gap > threshold, F.lit(False))
    return seen.withColumn(close, F.when(spiked, F.col("__previous")).otherwise(F.col(close))).drop(
        "__mean", "__previous"
    )


def latest_close(
    history: DataFrame, *, ticker: str = "ticker", date: str = "date", close: str = "close",
    instruments: Sequence[str] | None = ref.SPIKE_CHECKED_TICKERS, threshold: float = 0.5,
) -> DataFrame:
    """Latest close per instrument, with the spike rule applied to its last five closes.

    ``row_number() <= 5`` is cut to five rows per instrument before the shuffle.
    """
    ranked = history.withColumn(
        "__rn", F.row_number().over(Window.partitionBy(ticker).orderBy(F.col(date).desc()))
    ).filter("__rn <= 5")
    latest = F.max(F.when(F.col("__rn") == 1, F.col(close)))
    previous = F.max(F.when(F.col("__rn") == 2, F.col(close)))
    mean = F.avg(F.when(F.col("__rn") > 1, F.col(close)))
    gap = F.try_divide(F.abs(latest - mean), mean)
    checked = F.lit(True) if instruments is None else F.col(ticker).isin(*instruments)
    return ranked.groupBy(ticker).agg(
        F.max(date).alias(date),
        F.when(checked & F.coalesce(gap > threshold, F.lit(False)), previous).otherwise(latest).alias(close),
    )
