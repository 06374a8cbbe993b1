"""Landed rows to clean silver rows to the star schema, each step one lazy plan per sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import date_key
from pricelake.operators import cleaning, enrich, normalize, warehouse
from pricelake.session import freed_shuffles, lookup, scratch_copy


def to_silver(
    raw: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], series: Sequence[str] = ("commodity", "market"),
    required: Sequence[str] = ("date", "commodity", "market", "close_price"),
    name_map: Mapping[str, str] = ref.COMMODITY_NAMES, outlier_threshold: float = 1.5, base_currency: str = "USD",
    known: DataFrame | None = None,
) -> DataFrame:
    """Clean, normalise and enrich price rows.

    De-duplicates by ``keys``, drops rows lacking a required value, standardises names,
    converts prices, units and dates, removes price outliers per commodity and adds
    calendar, trading, price-change and commodity columns.  ``known`` are silver rows of earlier loads
    (see ``known_prices``): they count as previous prices and are not returned.
    """
    tidy = (
        raw.transform(lambda d: cleaning.drop_duplicates(d, keys=keys, order_by=order_by))
        .transform(lambda d: cleaning.drop_missing(d, list(required)))
        .transform(lambda d: cleaning.standardize_names(d, mapping=name_map))
    )
    converted = tidy
    for price in ("open_price", "high_price", "low_price", "close_price"):
        converted = normalize.normalize_prices(converted, price=price, base=base_currency).drop(
            f"{price}_base_currency"
        )
    converted = converted.withColumn("currency", F.lit(base_currency))
    converted = normalize.normalize_units(converted, quantity="volume")
    converted = normalize.normalize_timestamps(converted).withColumn("date", F.to_date("date"))
    kept = cleaning.remove_outliers(
        converted, column="close_price", keys=["commodity"], threshold=outlier_threshold
    )
    dated = enrich.add_trading_flags(enrich.add_date_dimensions(kept))
    if known is not None:
        earlier = known.select(*[c for c in known.columns if c in dated.columns]).withColumn("__known", F.lit(True))
        dated = dated.unionByName(earlier, allowMissingColumns=True)
    changed = enrich.add_price_changes(dated, keys=list(series), order_by=order_by, price="close_price")
    if known is not None:
        changed = changed.filter(F.col("__known").isNull()).drop("__known")
    return enrich.add_commodity_attributes(changed.withColumnRenamed("unit", "volume_unit")).withColumn(
        "date_key", date_key(F.col("date"))
    )


def known_prices(
    silver: DataFrame, first: str, last: str, *, keys: Sequence[str], order_by: Sequence[str],
    series: Sequence[str] = ("commodity", "market"),
) -> DataFrame:
    """What the price changes of a batch of these dates need of earlier loads.

    The stored rows of the dates themselves, and per series the last row before them: one partial aggregate over
    the price columns, no history is sorted.
    """
    columns = list(dict.fromkeys([*series, *order_by, *keys, "date", "close_price"]))
    narrow = silver.select(*columns)
    ahead = narrow.filter((F.col("date") < F.lit(first).cast("date")) & F.col("close_price").isNotNull())
    latest = ahead.groupBy(*series).agg(F.max(F.struct(*order_by, *[c for c in columns if c not in (*series, *order_by)])).alias("r"))
    latest = latest.select(*series, "r.*").select(*columns)
    return latest.unionByName(narrow.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))))


def load_gold(
    spark: SparkSession, silver: DataFrame, dims: Mapping[str, DataFrame], base: str, *,
    natural_key: Sequence[str], grain: str = "day", grow_dimensions: bool = False,
) -> dict[str, str]:
    """Merge a batch of silver rows, its facts and the summaries of its dates, in that order.

    Rows loaded before stay unless the batch has their natural key, so batches of one day may come one by one
    and late.  With ``grow_dimensions`` new commodities, markets, sources, currencies and dates of the batch are
    added to the dimensions and all five are written as snapshots; the paths are in the result.
    """
    base = base.rstrip("/")
    paths = {"silver": f"{base}/silver", "fact": f"{base}/commodity_prices_fact"}
    with freed_shuffles(spark), scratch_copy(silver, "batch") as batch:
        warehouse.merge_partitions(batch, paths["silver"], keys=natural_key, part="date_key")
        if grow_dimensions:
            dims = warehouse.dimensions_with(dims, batch)
            for name, dim in dims.items():
                paths[name] = f"{base}/{name}"
                warehouse.write_snapshot(dim, paths[name])
            dims = {name: warehouse.read_snapshot(spark, paths[name]) for name in dims}
        resolved = warehouse.resolve_fact_keys(batch.drop("date_key"), dims)
        fact = warehouse.fact_rows(resolved, natural_key=natural_key)
        warehouse.write_fact(fact, paths["fact"], grain=grain)
        touched = lookup(fact.select("date_key").distinct())
    with freed_shuffles(spark):
        for name in warehouse.refresh_summaries(
            spark, paths["fact"], base, order_by=["date_key", "price_id"], touched=touched, grain=grain
        ):
            paths[name] = f"{base}/{name}"
    return paths
