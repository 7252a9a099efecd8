"""Documents as ids in coded files, written and read back by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openends.llm import coder
from openends.llm.bpe import column_ids, encoder, packed_ids
from openends.llm.common import texts
from openends.sources.shared import new_folder

END = 0
# Distinct words kept by a worker; files need their packed ids only.
CACHED = 400_000
# A file ends at this many ids: enough blocks to code side by side, at about 20 bytes an id in a worker.
FILE_IDS = 7_000_000
# Bytes of text whose words are looked up together; rows that come to a writer at once; ids a reader gives out at once.
SLICE = 8 << 20
ROWS = 1_500
GIVEN = 1_000_000
# Files whose places (16 bytes each) may be sent to every task; beyond that they are joined by a shuffle.
MAX_BROADCAST_FILES = 500_000
FILES = "part int, number int, first_doc bigint, n_ids bigint, doc_ids binary, lengths binary, body binary"


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE bytes of text; a longer text is a run of its own or ends one."""
    if not len(batch):
        return
    size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    before = np.cumsum(size, dtype=np.int64) - size
    starts = np.flatnonzero(np.diff(before // SLICE, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(batch)], strict=True):
        yield batch.slice(start, end - start)


def write_token_files(
    docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of every document and an end id, in ascending doc_id order.

    Documents are dealt to ranges of ids and ordered there; a range becomes one or more files.
    A file is a row of a Parquet table in `folder`, so that any store Spark can write will
    do: its ids coded in `body`, and which documents it holds with how many ids each. Files
    in the order of `first_doc` hold all documents in ascending order.

    Null texts are empty (one end id). Rows without an id are left out, rows that repeat an id count once.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, packed_ids, CACHED)
        doc_ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        size = number = part = 0

        def file() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            parts.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([doc_ids[0][0]], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([np.concatenate(doc_ids).tobytes()], pa.binary()),
                    pa.array([np.concatenate(lengths).tobytes()], pa.binary()),
                    pa.array([coder.encode(ids)], pa.binary()),
                ],
                names=["part", "number", "first_doc", "n_ids", "doc_ids", "lengths", "body"],
            )

        for batch in batches:
            for some in slices(batch):
                part = some.column("part")[0].as_py()
                ids, n = column_ids(ids_of, some.column("text"), END)
                doc_ids.append(some.column("doc_id").to_numpy())
                lengths.append(n)
                parts.append(ids)
                size += len(ids)
                if size >= FILE_IDS:
                    yield file()
                    doc_ids, lengths, parts, size, number = [], [], [], 0, number + 1
        if parts:
            yield file()

    ordered = texts(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    # Whole texts are large rows: with the usual 10,000 a batch takes much of a worker's memory.
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = conf.get(key)
    conf.set(key, str(min(ROWS, int(usual)) if int(usual) > 0 else ROWS))
    try:
        ordered.mapInArrow(write, FILES).write.parquet(folder)
    finally:
        conf.set(key, usual)


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), and its packed ids."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids = coder.decode(row.body)
                lengths = np.frombuffer(row.lengths, dtype=np.int64)
                ends = np.cumsum(lengths)
                numbers = np.frombuffer(row.doc_ids, dtype=np.int64)
                starts = ends - lengths
                cuts = np.flatnonzero(np.diff(starts // GIVEN, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(ends)], strict=True):
                    some = zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)
                    yield pd.DataFrame(
                        {
                            "doc_id": numbers[a:b],
                            "start": row.before + starts[a:b],
                            "ids": [ids[start:end].tobytes() for start, end in some],
                        }
                    )

    # One narrow row per file, some ten million ids each.
    order = Window.orderBy("first_doc")
    before = files.select(
        "part", "number", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("before")
    )
    small = files.count() <= MAX_BROADCAST_FILES
    placed = files.join(F.broadcast(before) if small else before, ["part", "number"])
    return placed.select("before", "doc_ids", "lengths", "body").mapInPandas(
        read, "doc_id bigint, start bigint, ids binary"
    )


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the files to the shared folder, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    write_token_files(docs, path, folder, id_col, text_col)
    back = read_token_files(spark.read.schema(FILES).parquet(folder))
    return back.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
