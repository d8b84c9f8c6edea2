"""Tables that cut a lineage: written to the folder that the cluster shares, and read again."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, as in tests, one is made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows, written once; a lost executor costs no recomputation of what led to them."""
    path = fresh(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20


def stream_texts(df: DataFrame) -> DataFrame:
    """df, to be handed to mapInArrow. Ten thousand texts a batch, Spark's default, are tens of megabytes,
    which the JVM holds several times over; here a batch ends after BATCH_BYTES or its first row beyond."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Memory that was freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, after whose last batch the worker gives back what it has freed. Workers serve many tasks, and would
    hold the most that any of them ever needed."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as a long, and the text; whatever else docs has, and however it is called, stays out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that none can clash with those that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def zipped(docs: DataFrame) -> DataFrame:
    """doc_id, and the text compressed by itself, for plans that exchange whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [None if t is None else pack(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return stream_texts(id_and_text(docs)).mapInArrow(run, "doc_id long, text binary")


def unzipped(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batch with its texts as they were, some rows at a time."""
    at = batch.schema.names.index("text")
    unpack = zstandard.ZstdDecompressor().decompress
    for begin in range(0, batch.num_rows, rows):
        part = batch.slice(begin, rows)
        texts = [None if t is None else unpack(t) for t in part.column(at).to_pylist()]
        yield part.set_column(at, "text", pa.array(texts, pa.binary()))
