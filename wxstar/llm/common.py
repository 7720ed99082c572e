"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.session import scratch_dir

ID = "doc_id"
TEXT = "text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = TEXT) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def enveloped(docs: DataFrame) -> DataFrame:
    """(__doc, id, text): all columns of a document in one struct, so that none, whatever its name, meets a working column."""
    return docs.select(F.struct("*").alias("__doc"), F.col(ID), F.col(TEXT))


def crc_fold(col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return (F.crc32(col.cast("string").cast("binary")) % folds).cast("int")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, runs a
    costly pass only once, and survives the loss of executors."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def with_row_ids(df: DataFrame, id_col: str = ID, out: str = "__rid") -> DataFrame:
    """Adds ``out``, a bigint unique to each row and ordered as ``id_col``.

    Where the ids are unique and not null they serve as they are (one small aggregate
    checks it). Else the rows are sorted by id (nulls last), numbered and written once to
    the shared folder, so that the numbers stay the same however often they are read.
    """
    ids = df.select(F.col(id_col).cast("bigint").alias("i"))
    n, known, distinct = ids.agg(F.count(F.lit(1)), F.count("i"), F.count_distinct("i")).first()
    if n == known == distinct:
        return df.withColumn(out, F.col(id_col).cast("bigint"))
    return materialize(
        df.sort(F.col(id_col).asc_nulls_last()).withColumn(out, F.monotonically_increasing_id()), "rows")


def by_bytes(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes, so that memory goes by bytes and not by rows; a larger row is a slice of its own."""
    rows = max(1, batch.num_rows * most // max(batch.nbytes, 1))
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        while n > 1 and batch.slice(at, n).nbytes > 2 * most:
            n //= 2
        yield batch.slice(at, n)
        at += n


def release() -> None:
    """Hands the memory back that the process no longer needs: Python workers live on between tasks, beside those of other
    stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library that has it
        pass


def lean(run: Callable) -> Callable:
    """``run`` for ``mapInArrow`` or an iterator UDF, with a :func:`release` at its end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return wrapped


MARK_BITS = 1 << 24


def marks(ids: DataFrame, id_col: str) -> DataFrame:
    """A bitmap of ``MARK_BITS`` with the bits of the hashed ids set: 2 MB, however many ids there are."""
    return materialize(ids.select(_mark(id_col).alias("__place")).groupBy(F.bitmap_bucket_number("__place").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__bits")), "marks")


def _mark(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(MARK_BITS))


def by_marks(df: DataFrame, bitmap: DataFrame, id_col: str, marked: bool) -> DataFrame:
    """The rows of ``df`` whose id's bit is set (or, with ``marked`` false, is not).

    The bitmap is broadcast. With more ids more rows count as marked; a row whose id is among
    them always does, so the join that decides needs the marked rows alone."""
    at = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    bit = F.coalesce(F.getbit(byte, (at % 8).cast("int")), F.lit(0))
    placed = df.withColumn("__place", _mark(id_col)).withColumn("__bucket", F.bitmap_bucket_number("__place"))
    return placed.join(F.broadcast(bitmap), "__bucket", "left").where(bit == int(marked)).select(*df.columns)


def only_marked(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``df`` that may have one of ``ids``, before a join that decides."""
    return by_marks(df, marks(ids, id_col), id_col, True)
