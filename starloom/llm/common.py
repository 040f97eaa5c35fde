"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The letters that folding touches; all other characters stay as they are.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bits of one bitmap row (fixed by Spark's bitmap functions: 4096 bytes).
BLOCK_BITS = 32768


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only; null becomes the empty string.

    ``lower`` is right, and much faster, where a text is pure ASCII.
    """
    text = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def slots(key: Column, bits: int, hashes: int) -> list[Column]:
    """The positions of a key in a Bloom filter; each hash function has its own part of the ``bits``."""
    part = bits // hashes
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(part)) + F.lit(i * part) for i in range(hashes)]


def bitmap_rows(positions: DataFrame, slot: str) -> DataFrame:
    """Set bits as rows (block, bits) of 4096 bytes each.

    The table has at most ``bits / 32768 + 1`` rows, however many positions come
    in, which bounds its size: 2 ** 27 bits are 16 MB.
    """
    return positions.groupBy(F.bitmap_bucket_number(F.col(slot)).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(slot))).alias("bits")
    )


def bit_is_set(bits: Column, slot: Column) -> Column:
    """Whether the bit of ``slot`` is set in its bitmap row (false for a missing row)."""
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def share(df: DataFrame, thing) -> Broadcast:
    """Broadcast the fields of an object; executors need no copy of its class."""
    return df.sparkSession.sparkContext.broadcast(SimpleNamespace(**vars(thing)))


def schema_of(fields: list[tuple[str, str | T.DataType]]) -> T.StructType:
    """A schema from (name, type) pairs; types as objects or as text."""
    out = T.StructType()
    for name, kind in fields:
        out = out.add(name, kind if isinstance(kind, T.DataType) else T.DataType.fromDDL(kind))
    return out


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], fields: list[tuple[str, str | T.DataType]]) -> DataFrame:
    """Run ``work`` over each record batch that has rows."""

    def task(batches):
        for b in batches:
            if b.num_rows:
                yield work(b)

    return df.mapInArrow(task, schema_of(fields))


def arrow_pieces(batches: Iterator[pa.RecordBatch], most_bytes: int, step: int = 64) -> Iterator[pa.RecordBatch]:
    """Regroup record batches into ones of about ``most_bytes`` (a single longer row stays whole)."""
    held, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, step):
            held.append(b.slice(i, step))
            size += held[-1].nbytes
            if size >= most_bytes:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
