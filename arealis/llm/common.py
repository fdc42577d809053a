"""Small helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.scratch import stored

#: The white space of every word-based contract here, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"

#: Bits that stand for keys in ``may_match``.
MARKS = 1 << 22

#: Bytes of text that a Python worker looks at in one step; Spark bounds the bytes of its batches.
STEP_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def no_collection() -> Iterator[None]:
    """Inside, large caches without cycles are not searched for garbage; a reused worker gets its setting back."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task with all that its last one has held."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for ``mapInArrow``, whose worker gives back at its end what the task has held."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Inside, plans that run hand Python workers batches of this size at most; the session gets its setting back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def by_bytes(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[list[str]]:
    """The texts (null: empty) in lists of about this many bytes, so that no step holds many long ones."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and size + n > limit:
            yield [t or "" for t in texts.slice(start, i - start).to_pylist()]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield [t or "" for t in texts.slice(start).to_pylist()]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def is_fold(id_column: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text has this remainder; a null id has none of them."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def may_match(rows: DataFrame, key: Column, keyed: DataFrame, keyed_key: Column) -> DataFrame:
    """Adds ``__may``: false only where no row of ``keyed`` has this 64-bit key, so that the others need no shuffle.

    The bits of the keys, a table of at most ``MARKS`` / 64 rows whatever the input, are broadcast; the more keys there
    are, the more rows are let through.
    """
    bit = F.pmod(keyed_key, F.lit(MARKS))
    bits = keyed.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("__word"))
    bits = stored(bits.agg(F.bit_or(F.expr("shiftleft(1L, int(_bit & 63))")).alias("__bits")), "marks", keep=True)
    marked = rows.withColumn("__bit", F.pmod(key, F.lit(MARKS))).withColumn("__word", F.shiftright("__bit", 6))
    may = F.expr("coalesce(shiftrightunsigned(__bits, int(__bit & 63)) & 1, 0) = 1")
    return marked.join(F.broadcast(bits), "__word", "left").withColumn("__may", may).drop("__bit", "__bits", "__word")


def spread_join(rows: DataFrame, keyed: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Inner join of rows with one row for each of their keys, where ``keyed._n`` counts the rows of a key.

    A key with more rows than a partition should hold is dealt over as many
    partitions as it needs, by a hash of the columns ``by``: such keys are at
    most as many as there are partitions, so that they can be broadcast, and
    their copies on the other side are at most twice as many. ``keyed`` should
    be a stored table, as it is read three times.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = keyed.agg(F.sum("_n")).first()[0] or 0
    salts = F.ceil(F.col("_n") * parts / max(total, 1)).cast("int")
    hot = keyed.where(salts > 1).select(*keys, salts.alias("_salts"))
    dealt = rows.join(F.broadcast(hot), keys, "left")
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*by), F.col("_salts"))).cast("int")
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return dealt.withColumn("_salt", salt).drop("_salts").join(copies.drop("_n"), [*keys, "_salt"]).drop("_salt")
