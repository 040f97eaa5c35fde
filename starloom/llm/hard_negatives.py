"""Hard-negative mining by exact inner products in a residue number system.

Vectors are whole numbers.  Their components are reduced modulo several small
primes, so that the products of a prime fit the whole numbers that float32 holds
exactly and fast matrix products can be used; Chinese remaindering puts the
residues of a score together again, sign included.

The anchors are taken in blocks of bounded size.  A block is broadcast, every
task multiplies it with its own rows and returns, per anchor, only the rows that
can be among the first; windows over these choose.  The vectors never move.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.centroids import finite
from starloom.llm.common import schema_of, share
from starloom.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 10

# Bounds of a negative's score as hundredths of the positive's.
LOWEST, HIGHEST = 30, 90

# Residues lie within half a prime of 0, so 1024 products of residues sum up to less than 2 ** 24, which float32 holds exactly.
PRIMES = [251, 241, 239, 233, 229, 227, 223, 211]
CHUNK = 1024

# Bytes of anchor vectors that are broadcast at a time, and scores that a task holds at a time.
BLOCK_BYTES = 16 << 20
SCORES = 4 << 20


def primes_for(bound: int) -> list[int]:
    """The first primes whose product covers all whole numbers from -bound to bound."""
    product = 1
    for n, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound:
            return PRIMES[: n + 1]
    raise ValueError(f"scores up to {bound} are too large")


def residues(v: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo ``p``, as the float32 numbers within half of ``p`` of 0."""
    return ((v + p // 2) % p - p // 2).astype(np.float32)


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo ``p``, from residues, as whole numbers in [0, p)."""
    out = np.zeros((len(a), len(b)), np.float32)
    for k in range(0, a.shape[1], CHUNK):
        part = a[:, k : k + CHUNK] @ b[:, k : k + CHUNK].T
        # exact: the parts are whole numbers below 2 ** 24; those of several chunks are reduced before they are added
        out += part if a.shape[1] <= CHUNK else np.mod(part, np.float32(p))
    return np.mod(out, np.float32(p)).astype(np.int64)


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed inner products from the residues of both sides, one array per prime.

    Chinese remaindering in mixed radix: the digits are found prime by prime, all
    numbers on the way stay below the product of the primes.
    """
    score, product = residue_product(a[0], b[0], primes[0]), primes[0]
    for p, x, y in zip(primes[1:], a[1:], b[1:]):
        digit = (residue_product(x, y, p) - score) % p * pow(product, -1, p) % p
        score += product * digit
        product *= p
    score[score > product // 2] -= product
    return score


def first_columns(score: np.ndarray, ok: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (row, column) of the ``most`` allowed columns of each row with the highest scores; earlier columns win ties."""
    if score.shape[1] > most:
        masked = np.where(ok, score, np.iinfo(np.int64).min)
        least = np.partition(masked, -most, axis=1)[:, -most, None]
        above = masked > least
        ok = ok & (masked >= least)
        # rows with more ties than places: the first of the ties
        for i in np.flatnonzero(ok.sum(axis=1) > most):
            ties = np.flatnonzero(ok[i] & ~above[i])
            ok[i, ties[most - above[i].sum() :]] = False
    return np.nonzero(ok)


def matrix(vectors: pa.ListArray, dimensions: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    size = vectors.value_lengths().to_numpy()
    flat = vectors.flatten().to_numpy()
    if (size == dimensions).all():
        return flat.reshape(len(size), dimensions)
    out = np.zeros((len(size), dimensions), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def best_of(found: dict[str, np.ndarray], most: int) -> dict[str, np.ndarray]:
    """Of candidates (slot, score, no_id, vec_id) the first ``most`` of each slot."""
    order = np.lexsort((found["vec_id"], found["no_id"], -found["score"], found["slot"]))
    slot = found["slot"][order]
    order = order[np.arange(len(slot)) - np.searchsorted(slot, slot, side="left") < most]
    return {k: v[order] for k, v in found.items()}


def candidates(rows: DataFrame, shared: Broadcast, dimensions: int, primes: list[int], most: int, allowed) -> DataFrame:
    """Rows (slot, score, vec_id): for each slot of the shared anchors, the first rows of every task.

    ``allowed(anchors, range, score, label, row)`` yields (slot numbers, mask)
    for a range of anchors.  A task holds a batch of its rows, the scores of that
    batch with some anchors, and ``most`` candidates per slot.
    """

    def task(batches):
        block = shared.value
        left = [residues(block.vectors, p) for p in primes]
        found: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            vec_id = b.column("vec_id").fill_null(0).to_numpy()
            no_id = b.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            order = np.lexsort((vec_id, no_id))
            vec_id, no_id = vec_id[order], no_id[order]
            label, row = b.column("label").to_numpy()[order], b.column("row").to_numpy()[order]
            values = matrix(b.column("v"), dimensions)[order]
            right = [residues(values, p) for p in primes]
            parts = [found] if found else []
            step = max(1, SCORES // b.num_rows)
            for k in range(0, len(block.row), step):
                at = slice(k, k + step)
                score = exact_scores([x[at] for x in left], right, primes)
                for slot, ok in allowed(block, at, score, label, row):
                    i, j = first_columns(score, ok, most)
                    parts.append({"slot": slot[i], "score": score[i, j], "no_id": no_id[j], "vec_id": vec_id[j]})
            found = best_of({c: np.concatenate([x[c] for x in parts]) for c in parts[0]}, most) if parts else {}
        if found:
            ids = pa.array(found["vec_id"], pa.int64(), mask=found["no_id"])
            yield pa.RecordBatch.from_arrays([pa.array(found["slot"], pa.int64()), pa.array(found["score"], pa.int64()), ids], ["slot", "score", "vec_id"])

    return rows.mapInArrow(task, schema_of([("slot", "long"), ("score", "long"), ("vec_id", "long")]))


def first_of_all(found: DataFrame, most: int) -> DataFrame:
    """Add ``rank`` and keep the first ``most`` rows of every slot; Spark limits the rows of each task before they are shuffled."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    return found.withColumn("rank", F.row_number().over(W.partitionBy("slot").orderBy(*order))).where(F.col("rank") <= most)


def same_label(block, at, score, label, row):
    """Rows of the anchor's label, itself left out; a slot per anchor."""
    yield np.arange(len(block.row))[at], (block.label[at, None] == label) & (block.row[at, None] != row)


def within_bounds(block, at, score, label, row):
    """Rows of other labels whose score lies within the bounds of a positive; a slot per anchor and positive."""
    other = block.label[at, None] != label
    numbers = np.arange(len(block.row))[at] * block.positive.shape[1]
    hundred = 100 * score
    for k in range(block.positive.shape[1]):
        p = block.positive[at, k, None]
        ok = other & block.has_positive[at, k, None] & (block.lowest * p <= hundred) & (hundred <= block.highest * p)
        yield numbers + k, ok


def hard_negatives(
    rows: DataFrame, anchors: Column, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null label, a null vector or any null or non-finite component
    take no part; components become floor(scale * component).  A score is the
    inner product with the anchor, shorter vectors counting as filled up with
    zeros.  Higher scores come first, ties by the smaller id, null ids last.
    ``anchors`` says which rows are anchors (null: not).  An anchor's positives are its
    first ``positives`` other rows of the same label; for each, the first
    ``negatives`` rows of other labels are returned whose score is between
    ``lowest`` and ``highest`` per cent of the positive's, ends included.

    Every row counts for itself: rows that repeat an id or a vector are anchors,
    positives and negatives of their own.  An empty table gives an empty table.
    Scores beyond 2 ** 56 are refused.
    """
    col = F.col(f"`{vector}`")
    kept = rows.where(F.col(f"`{label}`").isNotNull() & finite(col)).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(col, lambda x: F.floor(x.cast("double") * scale)).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    kept = materialize(kept)
    largest = F.max(F.greatest(F.coalesce(F.array_max("v"), F.lit(0)), -F.coalesce(F.array_min("v"), F.lit(0))))
    size = kept.agg(F.max(F.size("v")).alias("d"), largest.alias("m"), F.count_if("anchor").alias("n")).first()
    out = None
    if size.n:
        dimensions = max(1, size.d)
        bound = dimensions * size.m * size.m
        if bound > 1 << 56:
            raise ValueError(f"scores up to {bound} are too large")
        primes = primes_for(max(1, bound))
        blocks = -(-8 * dimensions * size.n // block_bytes)
        slim = kept.select("row", "vec_id", "label", "v")
        for k in range(blocks):
            block = Block(kept.where(F.col("anchor") & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)), dimensions)
            if len(block.row):
                found = mine_block(slim, block, dimensions, primes, positives, negatives, lowest, highest)
                out = found if out is None else out.unionByName(found)
    if out is None:
        return kept.sparkSession.createDataFrame([], SCHEMA)
    return out


SCHEMA = T.StructType(
    [T.StructField(n, T.IntegerType() if n == "rank" else T.LongType()) for n in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
)


class Block:
    """Anchors of bounded size as arrays."""

    def __init__(self, anchors: DataFrame, dimensions: int):
        held = anchors.select("row", "vec_id", "label", "v").toArrow().combine_chunks()
        column = {c: held[c].combine_chunks() for c in held.column_names}
        self.row, self.label = column["row"].to_numpy(), column["label"].to_numpy()
        self.ids = column["vec_id"].to_pylist()
        self.vectors = matrix(column["v"], dimensions) if len(self.row) else np.zeros((0, dimensions), np.int64)


def mine_block(rows: DataFrame, block: Block, dimensions: int, primes: list[int], positives: int, negatives: int, lowest: int, highest: int) -> DataFrame:
    """The result for the anchors of one block; written, since the next block replaces what is broadcast."""
    spark = rows.sparkSession
    sent = share(rows, block)
    near = first_of_all(candidates(rows, sent, dimensions, primes, positives, same_label), positives).collect()
    sent.unpersist()
    shape = (len(block.row), positives)
    block.positive, block.has_positive, block.lowest, block.highest = np.zeros(shape, np.int64), np.zeros(shape, bool), lowest, highest
    pairs = []
    for r in near:
        block.positive[r.slot, r.rank - 1], block.has_positive[r.slot, r.rank - 1] = r.score, True
        pairs.append((r.slot * positives + r.rank - 1, block.ids[r.slot], r.vec_id, r.score))
    if not pairs:
        return spark.createDataFrame([], SCHEMA)
    sent = share(rows, block)
    found = materialize(first_of_all(candidates(rows, sent, dimensions, primes, negatives, within_bounds), negatives))
    sent.unpersist()
    # at most ``positives`` rows per anchor of the block
    pairs = spark.createDataFrame(pairs, "slot long, anchor_id long, positive_id long, positive_score long")
    found = found.select("slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return materialize(found.join(pairs, "slot").select(*SCHEMA.names))
