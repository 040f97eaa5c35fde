"""Exact duplicate documents: two passes over a Bloom filter, Spark functions only.

Pass one counts, for each filter position, the keys that set it; positions set
more than once form a bitmap.  Pass two looks each row up in the bitmap: a row
with a position that nobody else set is certainly unique and passes straight
through; only the other rows, possibly repeated, are grouped by their full hash.
False alarms cost a little shuffle and change no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import BLOCK_BITS, ascii_lower, bit_is_set, bitmap_rows, slots
from starloom.session import materialize

# Size of the filter.  2 ** 27 bits are at most 16 MB as a broadcast table, whatever the input.
FILTER_BITS = 1 << 27
HASHES = 2


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Slim rows (doc_id, row_id, sha): SHA-256 of the folded text, and a number for each row.

    Written once, so texts are read once and the row numbers stay fixed.
    """
    sha = F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))
    return materialize(docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row_id"), sha.alias("sha")))


def repeated_bits(rows: DataFrame, key: str = "sha", bits: int = FILTER_BITS, hashes: int = HASHES) -> DataFrame:
    """Pass one: the filter positions that more than one row sets, as a broadcast table of bitmap rows."""
    if bits < BLOCK_BITS or hashes < 1:
        raise ValueError(f"bits must be at least {BLOCK_BITS} and hashes at least 1")
    at = F.explode(F.array(*slots(F.col(key), bits, hashes))).alias("slot")
    crowded = rows.select(at).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return F.broadcast(materialize(bitmap_rows(crowded, "slot")))


def flag_possible(rows: DataFrame, filled: DataFrame, key: str = "sha", bits: int = FILTER_BITS, hashes: int = HASHES) -> DataFrame:
    """Pass two: add ``maybe``, false only where no other row has the same key.

    The lookup is a broadcast join on the number of the bitmap row, so no row of
    the input moves.
    """
    out, names, maybe = rows, list(rows.columns), F.lit(True)
    for i, s in enumerate(slots(F.col(key), bits, hashes)):
        block = filled.select(F.col("block").alias(f"__block{i}"), F.col("bits").alias(f"__bits{i}"))
        out = out.join(F.broadcast(block), F.bitmap_bucket_number(s) == F.col(f"__block{i}"), "left")
        maybe = maybe & bit_is_set(F.col(f"__bits{i}"), s)
    return out.select(*names, maybe.alias("maybe"))


def group_winners(maybe: DataFrame) -> DataFrame:
    """Per hash: keep_id, keep_row, group_size.  Partial sums come before the shuffle, so a group of any size arrives as one row per task."""
    best = F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("row_id").alias("keep_row"))).alias("k")
    return maybe.groupBy("sha").agg(best, F.count(F.lit(1)).alias("group_size")).select(
        F.col("sha").alias("g_sha"), "k.keep_id", "k.keep_row", "group_size"
    )


def decide(rows: DataFrame, bits: int = FILTER_BITS, hashes: int = HASHES) -> DataFrame:
    """Per row of ``keyed``: keep_id, group_size, kept."""
    flagged = flag_possible(rows, repeated_bits(rows, "sha", bits, hashes), "sha", bits, hashes)
    alone = flagged.where(~F.col("maybe")).select(
        "doc_id", "row_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    maybe = flagged.where("maybe").select("doc_id", "row_id", "sha")
    # written, so that both sides of the join come from shuffles and a hot group can be split
    groups = materialize(group_winners(maybe))
    joined = maybe.join(groups, F.col("sha") == F.col("g_sha")).select(
        "doc_id", "row_id", "sha", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept")
    )
    return alone.unionByName(joined)


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = FILTER_BITS, hashes: int = HASHES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the
    empty text.  Of equal texts the largest doc_id stays (null ids lose to all
    others); where equal rows share that id, exactly one of them is kept.  An
    empty table gives an empty table.
    """
    out = decide(keyed(docs, text, doc_id), bits, hashes)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = FILTER_BITS, hashes: int = HASHES) -> DataFrame:
    """The kept rows with the columns of ``docs``.

    Rows that the filter clears pass straight through; the others are joined
    with the winners of their groups.  Rows that share doc_id and text are
    interchangeable, and one of them stays.
    """
    names = docs.columns
    wide = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.unhex(F.sha2(ascii_lower(F.col(f"`{text}`")).cast("binary"), 256)).alias("sha"),
        F.col(f"`{doc_id}`").alias("doc_id"),
    )
    slim = keyed(docs, text, doc_id)
    filled = repeated_bits(slim, "sha", bits, hashes)
    groups = group_winners(flag_possible(slim, filled, "sha", bits, hashes).where("maybe")).select("g_sha", "keep_id")
    flagged = flag_possible(wide, filled, "sha", bits, hashes)
    alone = flagged.where(~F.col("maybe")).select("row")
    # the id is part of the join key, so a large group of copies does not meet in one task
    chosen = flagged.where("maybe").join(groups, (F.col("sha") == F.col("g_sha")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    chosen = chosen.groupBy("sha").agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(chosen).select("row.*")
