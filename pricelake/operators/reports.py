"""Row-count reports of processing steps.

``observed`` counts while a frame is consumed elsewhere and costs no job of its own;
``operation_report`` builds the report as a query when nothing else consumes the frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The frame with an observation of its row count and further aggregates."""
    observation = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
    return df.observe(observation, *columns), observation


def observed_report(steps: Sequence[tuple[str, Observation]]) -> dict:
    """Number of operations and their observed metrics, in order; valid after an action."""
    operations = [{"operation": name, **observation.get} for name, observation in steps]
    return {"operations_count": len(operations), "operations": operations}


def operation_report(steps: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Per ``(operation, input, output)``: rows read, rows produced and the difference."""
    size = lambda frame: frame.agg(F.count(F.lit(1))).scalar()
    rows = []
    for number, (name, source, result) in enumerate(steps):
        before, after = size(source), size(result)
        rows.append(
            F.struct(
                F.lit(number).alias("step"), F.lit(name).alias("operation"),
                before.alias("rows_in"), after.alias("rows_out"), (before - after).alias("rows_removed"),
            )
        )
    return steps[0][1].sparkSession.range(1).select(F.inline(F.array(*rows)))
