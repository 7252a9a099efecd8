"""Counts of a run as a table (part, name, n), one pass over the narrow columns of each table.

The passes read stored tables and are lazy: a run that does not ask for its counts pays nothing.
Counters that ride on the writes (`DataFrame.observe`) would save them, but in Spark 4.1 a session
that has observed can no longer be shipped by the model fits of a train run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(table: DataFrame, counters: Mapping[tuple[str, str], Column]) -> DataFrame:
    """All counters, aggregates by (part, name), in one pass; names are free text."""
    names = list(counters)
    totals = table.agg(*[counters[key].cast("bigint").alias(f"c{i}") for i, key in enumerate(names)])
    rows = [
        F.struct(F.lit(part).alias("part"), F.lit(name).alias("name"), F.col(f"c{i}").alias("n"))
        for i, (part, name) in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))
