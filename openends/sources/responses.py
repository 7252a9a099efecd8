"""Response tables: read, check against the contract, clean, append."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openends import config
from openends.errors import ContractError
from openends.functions import text as tx

log = logging.getLogger("openends")

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# Folder column of the batches of a response table.
BATCH = "openends_batch"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a raw table; CSV is read as text and typed by the contract later.

    The column that tells the batches of `append_responses` apart is left out.
    """
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).drop(BATCH)


def check_columns(columns: list[str], themes: Mapping[str, Mapping]) -> list[str]:
    """Required columns in contract order; raises if one is missing."""
    required = config.required_columns(themes)
    missing = [c for c in required if c not in columns]
    if missing:
        raise ContractError(
            f"Missing required column(s): {missing}. Found: {list(columns)}. "
            "Names must match exactly; switch a theme off if it was not asked."
        )
    extra = [c for c in columns if c not in required]
    if extra:
        log.info("ignoring extra column(s) %s", extra)
    return required


def order_number(value: Column) -> Column:
    """Whole number from text such as '2' or '1.7' (cut to 1); NULL if it is none."""
    as_text = value.cast("string")
    number = F.when(as_text.rlike(NUMBER), F.trim(as_text).try_cast("double"))
    return F.when(F.abs(number) < 2147483648.0, number.cast("int"))


def order_problems(raw: DataFrame) -> DataFrame:
    """Rows whose order is not a number."""
    return raw.filter(order_number(F.col("Order Shown")).isNull()).select(
        tx.clean_key(F.col("Respondent ID")).alias("respondent_id"),
        F.col("Order Shown").cast("string").alias("order_shown"),
    )


def check_order(raw: DataFrame) -> None:
    """Raise, naming up to five respondents, if an order is not a number."""
    bad = order_problems(raw).limit(5).collect()
    if bad:
        raise ContractError(
            "'Order Shown' has values that are not numbers, e.g. respondent(s) "
            f"{[r.respondent_id for r in bad]}"
        )


def _or_nothing(column: str) -> Column:
    """Text of a column with a mark for NULL, which a hash would skip: the same answer in
    another column is another row."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("\u0000"))


def _keys_present() -> Column:
    return (F.col("respondent_id") != "") & (F.col("ad_id") != "")


def _cleaned(raw: DataFrame, themes: Mapping[str, Mapping], row_order: str | None) -> DataFrame:
    required = check_columns(raw.columns, themes)
    texts = config.text_columns(themes)
    order = order_number(F.col("Order Shown"))
    # The order must be known per row: the plan itself fails on a bad value.
    checked = F.coalesce(
        order,
        F.raise_error(
            F.concat(
                F.lit("'Order Shown' is not a number for respondent "),
                F.coalesce(F.col("Respondent ID").cast("string"), F.lit("?")),
            )
        ).cast("int"),
    )
    # Files have no row order. A column of the input may give one; otherwise a
    # hash of the row's content does, which no repartitioning can change.
    sequence = (
        F.col(f"`{row_order}`").cast("bigint")
        if row_order
        else F.xxhash64(*[_or_nothing(c) for c in required])
    )
    return raw.select(
        tx.clean_key(F.col("`Respondent ID`")).alias("respondent_id"),
        tx.clean_key(F.col("`Ad ID`")).alias("ad_id"),
        tx.clean_text(F.col("Brand")).alias("brand"),
        tx.clean_text(F.col("`Ad / Platform`")).alias("platform"),
        checked.alias("order_shown"),
        sequence.alias("row_seq"),
        *[tx.clean_text(F.col(f"`{c}`")).alias(c) for c in texts],
    )


def load_responses(
    raw: DataFrame, themes: Mapping[str, Mapping], row_order: str | None = None
) -> DataFrame:
    """Contract columns only, cleaned and typed, rows without a key dropped."""
    return _cleaned(raw, themes, row_order).filter(_keys_present())


def key_counters(
    raw: DataFrame, themes: Mapping[str, Mapping]
) -> tuple[DataFrame, dict[tuple[str, str], Column]]:
    """Rows read, kept, and dropped for a blank key: the cleaned rows and the counters on them."""
    present = _keys_present()
    return _cleaned(raw, themes, None), {
        ("responses", "rows"): F.count(F.lit(1)),
        ("responses", "blank_keys"): F.count_if(~present),
        ("responses", "kept"): F.count_if(present),
    }


def blank_key_count(raw: DataFrame, themes: Mapping[str, Mapping]) -> DataFrame:
    """How many rows lack a respondent or ad key."""
    return _cleaned(raw, themes, None).agg(
        F.count_if(~_keys_present()).alias("n_blank_keys"), F.count(F.lit(1)).alias("n_rows")
    )


def response_counts(responses: DataFrame) -> DataFrame:
    """Rows, distinct respondents and distinct ads in one pass."""
    return responses.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("respondent_id").alias("n_respondents"),
        F.count_distinct("ad_id").alias("n_ads"),
    )


def repeated_pairs(responses: DataFrame) -> DataFrame:
    """Respondent and ad pairs with more than one row, which break the contract."""
    return (
        responses.groupBy("respondent_id", "ad_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def combine_responses(
    existing: DataFrame | None, new_rows: DataFrame, themes: Mapping[str, Mapping]
) -> DataFrame:
    """Old and new rows together, contract columns only, both sides checked."""
    required = [f"`{c}`" for c in check_columns(new_rows.columns, themes)]
    if existing is None:
        return new_rows.select(*required)
    check_columns(existing.columns, themes)
    return existing.select(*required).unionByName(new_rows.select(*required))


def batch_name(rows: DataFrame) -> str:
    """A name that depends on the rows only, in whatever order they come."""
    values = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in rows.columns])
    n, total = rows.agg(F.count(F.lit(1)), F.sum(values.cast("decimal(38,0)"))).first()
    return f"b{n}x{int(total or 0) % (1 << 64):016x}"


def append_responses(
    new_rows: DataFrame, path: str, themes: Mapping[str, Mapping], batch: str | None = None
) -> None:
    """Add checked rows to a parquet response table as one batch, without rewriting it.

    A batch has a folder of its own, named by `batch` or by its rows, which the write replaces as
    a whole. So a batch that is added again, or after a write that failed halfway, is there
    once. A table that was written without batches goes on without them.
    """
    required = [f"`{c}`" for c in check_columns(new_rows.columns, themes)]
    check_order(new_rows)
    batched = True
    try:
        found = new_rows.sparkSession.read.parquet(path).columns
        check_columns(found, themes)
        batched = BATCH in found
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    rows = new_rows.select(*required)
    if batched:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch or batch_name(rows)}")
    else:
        rows.write.mode("append").parquet(path)
