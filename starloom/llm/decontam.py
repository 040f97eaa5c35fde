"""Benchmark passages in training documents, by suffix arrays of the training text.

Each task makes a suffix array over the words of its documents (a shard) and
looks every benchmark suffix up in it by binary search; the range of suffixes
that share a window of words with it gives the places.  A place and the item's
place lie on a diagonal, and the windows that follow each other on it are one
verbatim match, whose length is thus the true one.  Only document suffixes that
begin with two words that stand together in a benchmark item enter the array: no
other suffix can match.  Nothing is shuffled.

The benchmark goes to the tasks in blocks of a bounded size, one pass over the
documents per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import arrow_pieces, share
from starloom.llm.license_scan import FOLD

WINDOW = 10

MATCHES = "array<struct<item:string,start:int,item_start:int,length:int>>"

# Most bytes of benchmark text that go to the tasks in one block.
BLOCK_BYTES = 64 << 20

# Bytes of document text in one suffix array.
SHARD_BYTES = 8 << 20


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


@dataclass
class Block:
    """One block of the benchmark, ready for the tasks."""

    vocabulary: dict[bytes, int]  # word -> number from 1
    pairs: np.ndarray  # sorted codes of two words that begin a window
    singles: np.ndarray  # sorted numbers of words that are a whole item
    windows: np.ndarray  # (n, WINDOW) word numbers, 0 past the end of short items, sorted
    lengths: np.ndarray  # words of each window
    owner_at: np.ndarray  # where the owners of each window begin in the next two
    owner: np.ndarray  # number of the item row
    owner_start: np.ndarray  # where in the item the window begins
    ids: list[str]  # id of each item row


def make_block(items: list[tuple[str, bytes]], window: int = WINDOW) -> Block:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for number, (_, raw) in enumerate(items):
        w = [vocabulary.setdefault(x, len(vocabulary) + 1) for x in words_of(raw)]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i : i + window]), []).append((number, i))
    rows = sorted(owners)
    matrix = np.zeros((len(rows), window), np.int32)
    for k, r in enumerate(rows):
        matrix[k, : len(r)] = r
    lengths = np.array([len(r) for r in rows], np.int32)
    base = len(vocabulary) + 1
    pairs = np.unique(matrix[lengths > 1, 0].astype(np.int64) * base + matrix[lengths > 1, 1]) if window > 1 else np.zeros(0, np.int64)
    flat = np.array([o for r in rows for o in owners[r]], np.int32).reshape(-1, 2)
    owner_at = np.cumsum([0, *(len(owners[r]) for r in rows)])
    return Block(vocabulary, pairs, np.unique(matrix[lengths == 1, 0]), matrix, lengths, owner_at, flat[:, 0], flat[:, 1], [i for i, _ in items])


def rank_keys(rows: np.ndarray) -> np.ndarray:
    """Fixed-width byte strings of word numbers that sort like the rows of numbers."""
    big = np.ascontiguousarray(rows.astype(">i4"))
    return big.view(f"S{4 * rows.shape[1]}").ravel() if len(rows) else np.zeros(0, f"S{4 * rows.shape[1]}")


def member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def find_in_shard(block: Block, codes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Matches (place, window number) of a block in one shard.

    ``codes`` are the word numbers of all documents of the shard, 0 for words
    that the benchmark lacks and between documents.
    """
    base = len(block.vocabulary) + 1
    padded = np.concatenate([codes, np.zeros(window, codes.dtype)])
    start = member(block.pairs, padded[: len(codes)].astype(np.int64) * base + padded[1 : len(codes) + 1]) | member(block.singles, codes)
    suffixes = np.flatnonzero(start & (codes > 0))
    if not len(suffixes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.zeros((len(suffixes), window), np.int32)
    alive = np.ones(len(suffixes), bool)
    for j in range(window):
        c = padded[suffixes + j]
        alive &= c > 0
        keys[:, j] = np.where(alive, c, 0)
    ranked = rank_keys(keys)
    order = np.argsort(ranked, kind="stable")
    array, ranked = suffixes[order], ranked[order]
    # binary search: a window's range of suffixes lies between its own words and its words followed by the largest number
    low = np.searchsorted(ranked, rank_keys(block.windows), side="left")
    upper = block.windows.copy()
    upper[np.arange(window)[None, :] >= block.lengths[:, None]] = np.iinfo(np.int32).max
    high = np.searchsorted(ranked, rank_keys(upper), side="right")
    n = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(n)), n)
    place = array[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    return place, which


def longest_matches(block: Block, place: np.ndarray, which: np.ndarray) -> dict[str, tuple[int, int, int]]:
    """Per item id the longest verbatim match of a document: (length, place, place in the item); the earliest of equals.

    ``place`` and ``which`` are the document's window matches.
    """
    n = block.owner_at[which + 1] - block.owner_at[which]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.owner_at[which], n)
    place, which = np.repeat(place, n), np.repeat(which, n)
    item, start = block.owner[at], block.owner_start[at]
    order = np.lexsort((place, place - start, item))
    item, start, place, which = item[order], start[order], place[order], which[order]
    # a run goes on while item and diagonal stay and the place moves by one
    new = np.ones(len(item), bool)
    new[1:] = (np.diff(item) != 0) | (np.diff(place) != 1) | (np.diff(start) != 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(item))) - 1 + block.lengths[which[first]]
    out: dict[str, tuple[int, int, int]] = {}
    for k, size in zip(first.tolist(), length.tolist()):
        match, name = (-size, int(place[k]), int(start[k])), block.ids[item[k]]
        out[name] = min(out.get(name, match), match)
    return {name: (-size, p, q) for name, (size, p, q) in out.items()}


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, longest, contaminated, hits, matches.

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  A document word inside any occurrence of a
    window is hit; ``hits`` are the runs of hit words (start, end).  ``matches``
    has one entry per item with an occurring window, in the order of the ids as
    strings: its longest verbatim match (item, start, item_start, length, in
    words), the earliest of equally long ones; matches are at least a window long.  ``items_sha256`` is the
    hash of the ids joined by commas (of the empty string for none), ``longest``
    the length of the longest match (0 without one).  Null texts have no
    words; items with null text or id are read alike, a null id as ``null``; rows
    that share an id are one item.  Empty tables on either side are fine.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0)).cast("long")
    ids = F.transform("matches", lambda m: m["item"])
    return matched(slim, benchmark, "text", item_text, item_id, window, block_bytes).select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size("matches").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), longest.alias("longest"), (hit > 0).alias("contaminated"), "hits", "matches",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with their columns."""
    return matched(docs, benchmark, text, item_text, item_id, window, block_bytes).where(F.size("hits") == 0).select("row.*")


def matched(docs: DataFrame, benchmark: DataFrame, text: str, item_text: str, item_id: str, window: int, block_bytes: int) -> DataFrame:
    """Rows (row, hits, matches, n_words): each document with its hit word intervals and the longest match of each item, gathered block by block."""
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("hits"),
        F.expr(f"cast(array() as {MATCHES})").alias("matches"), F.lit(0).cast("long").alias("n_words"),
    )
    at = docs.columns.index(text)
    for block in blocks_of(benchmark, item_text, item_id, window, block_bytes):
        out = with_block(out, at, share(docs, block), window)
    return out


def blocks_of(benchmark: DataFrame, item_text: str, item_id: str, window: int, block_bytes: int) -> Iterator[Block]:
    """Collect the benchmark in blocks whose text stays below ``block_bytes``; larger ones are dealt over several by hash."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item_id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).cast("binary").alias("raw")
    )
    size = items.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield make_block([(r["item_id"], bytes(r["raw"])) for r in part.toLocalIterator()], window)


def with_block(rows: DataFrame, text_at: int, shared, window: int) -> DataFrame:
    """Add the matches of one block to ``hits`` and ``matches``.  Rows of one item id are in one block."""
    hit_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    match_kind = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))

    def task(batches):
        yield from map(shard, arrow_pieces(batches, SHARD_BYTES))

    def shard(t: pa.RecordBatch) -> pa.RecordBatch:
        block = shared.value
        numbers, get = [], block.vocabulary.get
        for raw in pc.struct_field(t.column("row"), text_at).cast(pa.binary()):
            w = words_of(raw.as_py())
            numbers.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
        lens = np.array([len(c) for c in numbers], np.int64)
        # one 0 after each document keeps matches inside it
        begin = np.cumsum(lens + 1) - (lens + 1)
        codes = np.zeros(int((lens + 1).sum()), np.int32)
        for s, c in zip(begin, numbers):
            codes[s : s + len(c)] = c
        place, which = find_in_shard(block, codes, window)
        hits, matches = t.column("hits"), t.column("matches")
        if len(place):
            hits, matches = hits.to_pylist(), matches.to_pylist()
            doc = np.searchsorted(begin, place, side="right") - 1
            order = np.lexsort((place, doc))
            doc, place, which = doc[order], place[order], which[order]
            cuts = np.flatnonzero(np.diff(doc)) + 1
            for a, e in zip([0, *cuts], [*cuts, len(doc)]):
                d = doc[a]
                first = place[a:e] - begin[d]
                hits[d] = merge(hits[d], first, first + block.lengths[which[a:e]])
                best = longest_matches(block, first, which[a:e])
                own = [{"item": i, "start": p, "item_start": q, "length": n} for i, (n, p, q) in best.items()]
                matches[d] = sorted(matches[d] + own, key=lambda m: m["item"])
            hits, matches = pa.array(hits, hit_kind), pa.array(matches, match_kind)
        return pa.RecordBatch.from_arrays([t.column("row"), hits, matches, pa.array(lens)], ["row", "hits", "matches", "n_words"])

    return rows.mapInArrow(task, rows.schema)


def merge(old: list[dict], lo: np.ndarray, hi: np.ndarray) -> list[dict]:
    """Union of word intervals, ascending."""
    lo = np.concatenate([np.array([h["start"] for h in old], np.int64), lo])
    hi = np.concatenate([np.array([h["end"] for h in old], np.int64), hi])
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    ends = reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])]
    return [{"start": int(a), "end": int(e)} for a, e in zip(lo[new], ends)]
