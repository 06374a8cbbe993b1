"""Declared schemas of the silver and gold tables, quality rows and operation logs."""

from __future__ import annotations

from pyspark.sql import SparkSession

TABLES = {
    "dim_date": (
        "date_key int, calendar_date date, year int, quarter int, month int, day int, week_of_year int, "
        "day_of_week string, is_weekend boolean, is_holiday boolean, trading_status string, "
        "created_at timestamp"
    ),
    "dim_commodity": (
        "commodity_key int, commodity_name string, commodity_type string, category string, unit string, "
        "grade string, origin_country string, is_active boolean, created_at timestamp, ended_at timestamp, "
        "effective_date date, end_date date, is_current boolean, version int"
    ),
    "dim_market": (
        "market_key int, market_name string, exchange string, country string, timezone string, "
        "trading_hours string, is_active boolean, created_at timestamp, ended_at timestamp"
    ),
    "dim_source": (
        "source_key int, source_name string, parser_type string, data_type string, reliability_rating int, "
        "update_frequency string, api_endpoint string, is_active boolean, created_at timestamp, "
        "ended_at timestamp"
    ),
    "dim_currency": (
        "currency_key int, currency_code string, currency_name string, country string, created_at timestamp"
    ),
    "commodity_prices_fact": (
        "price_id bigint, date_key int, commodity_key int, market_key int, source_key int, currency_key int, "
        "open_price decimal(10,2), close_price decimal(10,2), high_price decimal(10,2), "
        "low_price decimal(10,2), volume decimal(15,2), created_at timestamp, updated_at timestamp"
    ),
    "daily_price_summary": (
        "summary_id bigint, date_key int, commodity_key int, market_key int, open_price decimal(10,2), "
        "high_price decimal(10,2), low_price decimal(10,2), close_price decimal(10,2), "
        "volume decimal(15,2), price_change decimal(10,2), price_change_pct decimal(12,2), "
        "source_count int, record_count int, created_at timestamp"
    ),
    "weekly_commodity_summary": (
        "summary_id bigint, year int, week_of_year int, commodity_key int, avg_price decimal(10,2), "
        "min_price decimal(10,2), max_price decimal(10,2), total_volume decimal(15,2), created_at timestamp"
    ),
    "monthly_commodity_summary": (
        "summary_id bigint, year int, month int, commodity_key int, avg_price decimal(10,2), "
        "min_price decimal(10,2), max_price decimal(10,2), total_volume decimal(15,2), "
        "price_volatility decimal(12,2), created_at timestamp"
    ),
}

PARTITIONS = {"commodity_prices_fact": ["date_key"], "daily_price_summary": ["date_key"]}

FX_ROWS = (
    "provider string, source_endpoint string, base_currency string, quote_currency string, rate double, "
    "buy_rate double, sell_rate double, rate_type string, source_timestamp string, note string, "
    "extracted_at string"
)
QUOTE_ROWS = (
    "name string, ticker string, category string, unit string, description string, raw_price double, "
    "price_in_dollars double, usd_per_ton double, note string, extracted_at string"
)
OFFER_ROWS = (
    "source_url string, page int, offer_date string, company string, offer_type string, crop string, "
    "volume_tons string, price_raw string, price_value double, currency string, delivery_term string, "
    "basis string, location string, details string, detail_url string, note string, extracted_at string"
)
ELEVATOR_ROWS = (
    "company_slug string, company_name string, storage_type string, storage_location string, "
    "address_region string, culture_ua string, category_name string, price string, "
    "price_uah_per_ton double, source_url string, note string, extracted_at string"
)
CHECK_ROWS = "check_name string, passed boolean, row_count bigint, null_count bigint, error_message string"
OPLOG_ROWS = "timestamp timestamp, operation string, status string, details map<string,string>, level string"
ALERT_ROWS = (
    "timestamp timestamp, title string, message string, level string, metadata map<string,string>, "
    "sent boolean"
)


def create_tables(spark: SparkSession, database: str = "default", location: str | None = None) -> list[str]:
    """Create the empty gold tables; partitioned where a load replaces single dates."""
    for name, columns in TABLES.items():
        parts = PARTITIONS.get(name)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet"
            + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")
            + (f" LOCATION '{location.rstrip('/')}/{name}'" if location else "")
        )
    return list(TABLES)
