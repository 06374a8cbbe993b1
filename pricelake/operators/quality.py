"""Data-quality checks; every check is one row of (name, passed, rows, bad cells, message)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.scalars import pct_change, safe_number
from pricelake.operators.cleaning import flag_outliers
from pricelake.operators.series import join_null_safe, over_series

def _rows() -> Column:
    return F.count(F.lit(1))


def _check(name: str | Column, bad: Column, rows: Column, message: Column, passed: Column | None = None) -> list[Column]:
    passed = bad == 0 if passed is None else passed
    label = F.lit(name) if isinstance(name, str) else name
    return [
        label.alias("check_name"),
        passed.alias("passed"),
        rows.cast("long").alias("row_count"),
        bad.cast("long").alias("null_count"),
        F.when(~passed, message).alias("error_message"),
    ]


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def check_row_count(df: DataFrame, *, minimum: int = 0) -> DataFrame:
    counted = df.agg(_rows().alias("rows"))
    rows = F.col("rows")
    message = _text(f"Expected min {minimum} rows, got ", rows)
    return counted.select(*_check("row_count", F.lit(0), rows, message, rows >= minimum))


def check_missing_values(df: DataFrame, *, required: Sequence[str]) -> DataFrame:
    """Counts NULL cells over the required columns; an absent column misses every row."""
    cells = [F.count_if(F.col(c).isNull()) if c in df.columns else _rows() for c in required]
    total = reduce(lambda a, b: a + b, cells, F.lit(0))
    counted = df.agg(_rows().alias("rows"), total.alias("bad"))
    message = _text("Found ", F.col("bad"), " null values in required columns")
    return counted.select(*_check("missing_values", F.col("bad"), F.col("rows"), message))


def check_duplicates(df: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key tuple; NULL keys are equal.

    Counting per key first lets every map task collapse a hot key to one row.
    """
    groups = df.groupBy(*keys).agg(_rows().alias("n"))
    counted = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("bad")
    )
    message = _text("Found ", F.col("bad"), " duplicate records")
    return counted.select(*_check("duplicates", F.col("bad"), F.col("rows"), message))


def check_range(df: DataFrame, *, column: str, low=None, high=None) -> DataFrame:
    value = F.col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    counted = df.agg(_rows().alias("rows"), F.count_if(outside).alias("bad"))
    message = _text("Found ", F.col("bad"), f" anomalies in {column}")
    return counted.select(*_check(f"anomalies_{column}", F.col("bad"), F.col("rows"), message))


def check_std_dev(
    df: DataFrame, *, column: str, keys: Sequence[str] = (), threshold: float = 3.0
) -> DataFrame:
    """Values further than ``threshold`` population deviations from their group's mean."""
    flagged = flag_outliers(df, column=column, keys=keys, method="zscore", threshold=threshold)
    counted = flagged.agg(_rows().alias("rows"), F.count_if("is_outlier").alias("bad"))
    message = _text("Found ", F.col("bad"), f" anomalies in {column}")
    return counted.select(*_check(f"anomalies_{column}", F.col("bad"), F.col("rows"), message))


def quality_report(checks: DataFrame, *, source: str) -> DataFrame:
    """One row: counts, overall status and the passed and failed checks."""
    item = F.struct(
        F.col("check_name").alias("name"), F.col("row_count").alias("rows"),
        F.col("null_count").alias("nulls"), F.col("error_message").alias("error"),
    )
    failed = F.count_if(~F.col("passed"))
    return checks.agg(
        F.lit(source).alias("source"),
        F.count_if("passed").alias("checks_passed"),
        failed.alias("checks_failed"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("overall_status"),
        F.array_sort(F.collect_list(F.when(F.col("passed"), item))).alias("passed_checks"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), item))).alias("failed_checks"),
    )


DATA_TYPES = {
    "string": "string", "integer": "bigint", "float": "double", "decimal": "decimal(38,10)",
    "date": "date", "datetime": "timestamp", "boolean": "boolean",
}


def schema_errors(df: DataFrame, schema: Mapping[str, Mapping]) -> DataFrame:
    """Violations per column: ``(column_name, issue, violations)``; no rows means valid.

    ``schema`` maps a column to ``{'type': name, 'nullable': bool}``; text columns are
    checked to hold values of the declared type.  One pass over the data.
    """
    metrics = {"empty": _rows() == 0}
    labels = {"empty": ("", "Data is empty")}
    for number, (name, spec) in enumerate(schema.items()):
        if name not in df.columns:
            labels[f"missing_{number}"] = (name, "Missing required column")
            metrics[f"missing_{number}"] = _rows() > 0
            if not spec.get("nullable", False):
                labels[f"absent_{number}"] = (name, "Non-nullable column is missing")
                metrics[f"absent_{number}"] = _rows()
            continue
        value = F.col(name)
        if not spec.get("nullable", False):
            labels[f"null_{number}"] = (name, "Non-nullable column is null")
            metrics[f"null_{number}"] = F.count_if(value.isNull())
        declared = spec.get("type")
        if declared and declared != "string":
            typed = (
                safe_number(value).isNotNull() if declared == "float"
                else value.try_cast(DATA_TYPES[declared]).isNotNull()
            )
            labels[f"type_{number}"] = (name, f"Not a {declared}")
            metrics[f"type_{number}"] = F.count_if(value.isNotNull() & ~typed)
    counted = df.agg(*[m.cast("long").alias(k) for k, m in metrics.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"), F.lit(issue).alias("issue"),
                F.col(k).alias("violations"),
            )
            for k, (column, issue) in labels.items()
        ]
    )
    return counted.select(F.inline(rows)).filter("violations > 0")


def range_violations(
    df: DataFrame, *, rules: Mapping[str, Mapping[str, float]], row_key: Sequence[str]
) -> DataFrame:
    """One row per value outside its rule, identified by ``row_key``; NULL values pass."""
    entries = []
    for name, limits in rules.items():
        if name not in df.columns:
            continue
        value = F.col(name).cast("double")
        low, high = limits.get("min"), limits.get("max")
        for bound, broken, issue in (
            (low, None if low is None else value < low, "below_minimum"),
            (high, None if high is None else value > high, "above_maximum"),
        ):
            if bound is None:
                continue
            entries.append(
                F.when(
                    broken,
                    F.struct(
                        F.lit(name).alias("column"), value.alias("value"),
                        F.lit(float(bound) if issue == "below_minimum" else None).cast("double").alias("min_allowed"),
                        F.lit(float(bound) if issue == "above_maximum" else None).cast("double").alias("max_allowed"),
                        F.lit(issue).alias("issue"),
                    ),
                )
            )
    return df.select(*row_key, F.inline(F.array_compact(F.array(*entries))))


def check_freshness(
    df: DataFrame, *, source: str, timestamp: str, as_of: Column, hours: int = 24,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Latest row per source compared with ``as_of``; an expected source without rows is stale."""
    latest = df.groupBy(F.col(source).alias("source")).agg(F.max(timestamp).alias("last_seen"))
    if expected is not None:
        latest = join_null_safe(expected.select(F.col(source).alias("source")).distinct(), latest, ["source"])
    limit = as_of - F.make_interval(hours=F.lit(hours))
    return latest.withColumn("is_fresh", F.coalesce(F.col("last_seen") >= limit, F.lit(False)))


def check_completeness(
    df: DataFrame, *, required: Sequence[str], expected: Mapping[str, DataFrame]
) -> DataFrame:
    """Required cells present, plus one check per expected value list (column -> values)."""
    checks = [check_missing_values(df, required=required)]
    for column, values in expected.items():
        wanted = values.select(column).distinct()
        present = df.select(F.col(column).alias("__have"), F.lit(1).alias("__hit")).distinct()
        missing = wanted.join(present, F.col(column) == F.col("__have"), "left").agg(
            _rows().alias("rows"), F.count_if(F.col("__hit").isNull()).alias("bad")
        )
        message = _text("Missing ", F.col("bad"), f" expected values of {column}")
        checks.append(missing.select(*_check(f"expected_{column}", F.col("bad"), F.col("rows"), message)))
    return union_checks(checks)


def duplicate_keys(df: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(_rows().alias("row_count")).filter("row_count > 1")


def referential_orphans(fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One check per foreign key: ``{fact column: (dimension, key column)}``.

    Fact keys are counted before the join, so a hot key joins as one row.
    """
    checks = []
    for column, (dimension, key) in dimensions.items():
        counted = fact.groupBy(F.col(column).alias("__fk")).agg(_rows().alias("n"))
        known = dimension.select(F.col(key).alias("__pk")).distinct().withColumn("__hit", F.lit(1))
        joined = counted.join(known, F.col("__fk") == F.col("__pk"), "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("n"))), F.lit(0)).alias("bad"),
        )
        message = _text("Found ", F.col("bad"), f" rows without a match for {column}")
        checks.append(joined.select(*_check(f"fk_{column}", F.col("bad"), F.col("rows"), message)))
    return union_checks(checks)


def price_spikes(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    volume: str = "volume", rows: int = 30, threshold: float = 3.0, **limits,
) -> DataFrame:
    """Flags price changes and volumes far from the mean of the previous ``rows`` rows.

    The rolling deviation of the changes is returned as the volatility.
    """
    def changes(window):
        return {"price_change_pct": pct_change(F.col(price), F.lag(price, 1).over(window))}

    def scores(window):
        frame = window.rowsBetween(-rows, -1)
        out = {"volatility": F.stddev_pop("price_change_pct").over(frame)}
        for label, column in (("price", "price_change_pct"), ("volume", volume)):
            mean, spread = F.avg(column).over(frame), F.stddev_pop(column).over(frame)
            ready = F.count(column).over(frame) == rows
            out[f"{label}_zscore"] = F.when(ready, F.try_divide(F.col(column) - mean, spread))
        return out

    moved = over_series(df, keys, order_by, changes, before=1, **limits)
    scored = over_series(moved, keys, order_by, scores, before=rows, **limits)
    return scored.withColumns(
        {
            f"is_{label}_spike": F.coalesce(F.abs(F.col(f"{label}_zscore")) > threshold, F.lit(False))
            for label in ("price", "volume")
        }
    )


def check_ranges(df: DataFrame, *, rules: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """One check per rule, all counted in one pass."""
    metrics, names = [_rows().alias("rows")], []
    for name, limits in rules.items():
        value = F.col(name)
        bad = F.lit(False)
        if limits.get("above") is not None:
            bad = bad | (value <= limits["above"])
        if limits.get("min") is not None:
            bad = bad | (value < limits["min"])
        if limits.get("max") is not None:
            bad = bad | (value > limits["max"])
        metrics.append(F.count_if(bad).alias(f"bad_{name}"))
        names.append(name)
    counted = df.agg(*metrics)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(f"bad_{n}").alias("bad")) for n in names]
    )
    rows = counted.select("rows", F.inline(pairs))
    message = F.concat(F.lit("Found "), F.col("bad").cast("string"), F.lit(" values out of range in "), F.col("name"))
    return rows.select(*_check(F.concat(F.lit("range_"), F.col("name")), F.col("bad"), F.col("rows"), message))


def daily_quality_report(checks: Sequence[DataFrame]) -> DataFrame:
    """Overall status over all checks and whether an alert is due."""
    failed = F.count_if(~F.col("passed"))
    return union_checks(checks).agg(
        _rows().alias("checks"),
        failed.alias("failed"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("overall_status"),
        (failed > 0).alias("alert_needed"),
    )


def run_integrity_checks(spark: SparkSession, checks: Sequence[Mapping]) -> DataFrame:
    """Runs ``{name, query, expected}`` entries over temp views; each query yields one value.

    A query that cannot be analysed counts as failed.
    """
    results = []
    for check in checks:
        try:
            answer = spark.sql(check["query"])
        except AnalysisException:
            answer = spark.range(0).select(F.lit(None).cast("string").alias("no_answer"))
            results.append(
                answer.agg(F.first("no_answer").alias("actual")).select(
                    F.lit(check["name"]).alias("check_name"), "actual",
                    F.lit(str(check["expected"])).alias("expected"), F.lit(False).alias("passed"),
                )
            )
            continue
        value = F.col(answer.columns[0])
        results.append(
            answer.agg(F.first(value).alias("v")).select(
                F.lit(check["name"]).alias("check_name"),
                F.col("v").cast("string").alias("actual"),
                F.lit(str(check["expected"])).alias("expected"),
                F.col("v").eqNullSafe(F.lit(check["expected"])).alias("passed"),
            )
        )
    return union_checks(results)


def missing_dates(
    df: DataFrame, *, keys: Sequence[str], date: str, start: Column, end: Column, expected: DataFrame | None = None
) -> DataFrame:
    """Days between ``start`` and ``end`` on which a series has no row.

    ``expected`` names the series that ought to be there; by default those of ``df``.
    """
    observed = df.select(*keys, F.col(date).alias("date")).distinct()
    series = (observed if expected is None else expected).select(*keys).distinct()
    calendar = series.withColumn("date", F.explode(F.sequence(start, end)))
    scope = [*keys, "date"]
    seen = observed.withColumn("__seen", F.lit(True))
    return join_null_safe(calendar, seen, scope).filter(F.col("__seen").isNull()).drop("__seen")


def backfill_summary(
    df: DataFrame, *, keys: Sequence[str], date: str, start: Column, end: Column, expected: DataFrame | None = None
) -> DataFrame:
    """Rows, days present and days missing per expected series over the backfilled range.

    A series without any row in the range has all its days missing; by default the series of ``df`` are expected.
    """
    days = F.datediff(end, start) + 1
    present = (
        df.filter(F.col(date).between(start, end))
        .groupBy(*keys, F.col(date).alias("__d")).agg(_rows().alias("n"))
        .groupBy(*keys).agg(F.sum("n").alias("row_count"), _rows().alias("days_present"))
    )
    series = (df if expected is None else expected).select(*keys).distinct()
    none = F.lit(0).cast("long")
    return join_null_safe(series, present, keys).select(
        *keys, F.coalesce("row_count", none).alias("row_count"), F.coalesce("days_present", none).alias("days_present"),
        (days.cast("long") - F.coalesce("days_present", none)).alias("days_missing"),
    )
