"""Best-fit packing of documents into training sequences, with conflicts.

Every bin is a sequence of fixed capacity.  A bin never holds two documents of
one source, nor two of one cluster of duplicates: it carries a bitmap of its
sources and one of its clusters.  Documents go in by decreasing size; the bins
are ordered by what is left in them, and the search starts at the smallest one
that fits and goes on to the next larger until a compatible bin is found.

Documents are dealt to packing groups of bounded size by a hash of their
contents and row number, and each group is packed by itself; only ids, sizes, sources and clusters move, no texts.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, schema_of

# Bytes of a sequence, the end mark of each document included.
CAPACITY = 8192

# Mean number of documents that are packed together.
GROUP_DOCS = 4096


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item; items come in the order in which they are to be packed.

    None as source or cluster conflicts with nothing.
    """
    bit_of: dict = {}
    # a value that occurs once can conflict with nothing and needs no bit
    for kind, values in (("s", sources), ("c", clusters)):
        for v, n in Counter(values).items():
            if n > 1 and v is not None:
                bit_of[kind, v] = 1 << len(bit_of)
    order: list[tuple[int, int]] = []  # (room left, bin), ascending
    taken: list[int] = []  # the source and cluster bitmaps of each bin, side by side
    keys: list[list] = []  # the same marks, one by one
    open_with: Counter = Counter()  # bins in ``order`` that hold a mark
    out = []
    for size, s, c in zip(sizes, sources, clusters):
        own = [m for m in (("s", s), ("c", c)) if m in bit_of]
        marks = sum(bit_of[m] for m in own)
        at = bisect.bisect_left(order, (size, -1))
        if any(open_with[m] == len(order) for m in own):
            at = len(order)  # every open bin conflicts
        while at < len(order) and taken[order[at][1]] & marks:
            at += 1
        if at < len(order):
            room, k = order.pop(at)
            open_with.subtract(keys[k])
        else:
            room, k = capacity, len(taken)
            taken.append(0)
            keys.append([])
        taken[k] |= marks
        keys[k] += own
        out.append((k, capacity - room))
        if room > size:
            bisect.insort(order, (room - size, k))
            open_with.update(keys[k])
    return out


def pack_group(group: pa.Table, capacity: int) -> pa.Table:
    """Pieces of one group: documents larger than a bin fill bins of their own, their rest is packed like a small document."""
    group = group.take(pc.sort_indices(group, [("doc_id", "ascending"), ("n_bytes", "ascending"), ("cluster", "ascending")])).combine_chunks()
    size = group["n_bytes"].to_numpy() + 1  # the end mark
    full, rest = size // capacity, size % capacity
    # the rests by decreasing size, then by id
    items = np.flatnonzero(rest > 0)
    items = items[np.argsort(-rest[items], kind="stable")]
    placed = best_fit(rest[items].tolist(), group["source"].take(items).to_pylist(), group["cluster"].take(items).to_pylist(), capacity)
    used = max((k for k, _ in placed), default=-1) + 1
    whole = np.repeat(np.arange(len(size)), full)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
    bins = np.concatenate([np.array([k for k, _ in placed], np.int64), used + np.arange(len(whole))])
    piece = np.concatenate([full[items], nth])
    columns = {
        "bin_id": (group["pack"][0].as_py() << 32) + bins,
        "bin_offset": np.concatenate([np.array([o for _, o in placed], np.int64), np.zeros(len(whole), np.int64)]),
        "piece": piece,
        "piece_size": np.concatenate([rest[items], np.full(len(whole), capacity, np.int64)]),
        "piece_start": piece * capacity,
    }
    ids = group["doc_id"].take(np.concatenate([items, whole]))
    return pa.table({"doc_id": ids, **{k: pa.array(v, pa.int64()) for k, v in columns.items()}})


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    cluster: Column | None = None,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece of a document: doc_id, bin_id, bin_offset, piece, piece_start, piece_size.

    A document's size is its UTF-8 bytes plus one for the end mark, so a null or
    empty text still takes one place.  Sizes beyond ``capacity`` are cut into
    full bins, numbered from 0, and a rest.  No bin holds two documents of one
    source or of one ``cluster`` (by default, equal texts after lower-casing
    A-Z); null sources conflict with nothing.  Rows that share a doc_id are
    packed as documents of their own.  An empty table gives an empty table.
    """
    if capacity < 2:
        raise ValueError("capacity must be at least 2")
    if cluster is None:
        cluster = F.xxhash64(ascii_lower(F.col(f"`{text}`")))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(f"`{source}`").cast("string").alias("source"), cluster.cast("long").alias("cluster"),
    )
    groups = max(1, -(-docs.count() // group_docs))
    # the row's number spreads repeated rows over the groups
    rows = rows.withColumn("pack", F.pmod(F.xxhash64("doc_id", "n_bytes", "cluster", F.monotonically_increasing_id()), F.lit(groups)))
    schema = schema_of([("doc_id", rows.schema["doc_id"].dataType), *[(c, "long") for c in ("bin_id", "bin_offset", "piece", "piece_size", "piece_start")]])
    return rows.groupBy("pack").applyInArrow(lambda g: pack_group(g, capacity), schema)
