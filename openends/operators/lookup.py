"""Joining rows to a lookup when single keys may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
ROWS_PER_SLICE = 1_000_000
# Places over which rows of one key that cannot match are dealt.
SPREAD = 65_536


def attach_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    row_hash: Column,
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
    sizes: DataFrame | None = None,
    may_match: Column | None = None,
) -> DataFrame:
    """Join `rows` to `lookup` (unique on `on`), spreading hot keys.

    `lookup` carries `n_rows`, the number of rows of its key on the other side,
    which its own pre-aggregation knows. A key with n rows gets
    ceil(n / rows_per_slice) slices: the lookup row is copied once per slice and
    each row picks its slice by `row_hash`, so no task sees more than about
    `rows_per_slice` rows of one key.

    Rows for which `may_match` is not true cannot have a partner. They are dealt out by
    `row_hash` whatever their key, so a hot key that the lookup leaves out, such as an
    empty text, is spread as well; a left join keeps them.

    Only keys with more than one slice are broadcast, to tell the rows their
    number of slices; `sizes` gives keys and `n_rows` for that where the lookup
    itself is costly to compute. There are fewer than N / rows_per_slice such keys for N
    rows, whatever the data: below 10^6 narrow rows for 10^12 rows.
    """
    on = list(on)
    slices = F.ceil(F.col("n_rows") / F.lit(rows_per_slice)).cast("int").alias("_slices")
    hot = (lookup if sizes is None else sizes).filter(F.col("n_rows") > rows_per_slice)
    place = F.pmod(row_hash, F.coalesce(F.col("_slices"), F.lit(1))).cast("int")
    if may_match is not None:
        elsewhere = (-1 - F.pmod(row_hash, F.lit(SPREAD))).cast("int")
        place = F.when(may_match, place).otherwise(elsewhere)
    spread_rows = rows.join(F.broadcast(hot.select(*on, slices)), on, "left").withColumn(
        "_slice", place
    )
    spread_lookup = (
        lookup.select("*", slices)
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_slices", "n_rows")
    )
    return spread_rows.drop("_slices").join(spread_lookup, [*on, "_slice"], how).drop("_slice")
