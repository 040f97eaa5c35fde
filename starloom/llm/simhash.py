"""Near-duplicate documents by SimHash fingerprints.

Distinct fingerprints are compared inside buckets that two close fingerprints
must share: the bits are cut into more blocks than bits may differ, so any two
close fingerprints agree on several whole blocks.  Inside a bucket a table of
Hamming distances to many reference fingerprints (pivots) is computed once per
fingerprint.  By the triangle inequality two fingerprints differ in at least as
many bits as any coordinate of their rows does, so pairs with a larger
coordinate difference are discarded and only the survivors are verified.

A bucket emits a spanning forest of its links, not all pairs: the links lost are
those between texts that other links already connect.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import arrow_map, bitmap_rows, slots
from starloom.llm.components import components
from starloom.llm.exact_dedup import FILTER_BITS, HASHES, flag_possible
from starloom.session import materialize

BITS = 64

# Fingerprints with at most this many differing bits are linked.
MAX_BITS = 4

# Blocks beyond those that differences can spoil: this many whole blocks agree and form the bucket key.
AGREE = 2

# Reference fingerprints of the distance table.
PIVOTS = 16

# Larger buckets are dealt to smaller ones by further blocks of the remaining bits.
BUCKET_ROWS = 2000

SEED = 42


def shingle_hashes(raw: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, in text order; fewer words make one run, no words none."""
    # bytes.lower folds A-Z only; bytes.split cuts at space and \\x09-\\x0d only
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stop = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], SEED) for a, b in zip(begin, stop)), np.uint64, n)


def fingerprint(raw: bytes, shingle: int, distinct: bool = False) -> int:
    """SimHash of a text given as UTF-8: a bit is 1 if set in over half of the shingles' hashes, each shingle once if ``distinct``."""
    h = shingle_hashes(raw, shingle)
    return majority(np.unique(h) if distinct else h)


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(h)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        part = h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


def hash_of(text: Column) -> Column:
    """A 64-bit hash of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, distinct: bool = False) -> DataFrame:
    """Rows (doc_id, text_hash, fp): a hash of the text and the fingerprint, as signed 64-bit numbers; fp is 0 where a text is null or has no words."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), hash_of(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").cast("binary").alias("raw"))

    def work(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(r.as_py() or b"", shingle, distinct) for r in b.column("raw")], np.uint64)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return arrow_map(rows, work, [("doc_id", rows.schema["doc_id"].dataType), ("text_hash", "long"), ("fp", "long")])


def cut(bits: list[int], n: int) -> list[list[int]]:
    """``n`` nearly equal parts of a list of bit numbers."""
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


def block_masks(bits: list[int], max_bits: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks out of ``max_bits + agree``; two close fingerprints agree on one of them."""
    blocks = cut(bits, max_bits + agree)
    return [sum(1 << b for block in chosen for b in block) for chosen in combinations(blocks, agree)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def keyed(points: DataFrame, keys: list[str], masks: list[int]) -> DataFrame:
    """Each point once per mask, with the mask's number and the masked fingerprint added to the bucket key."""
    rest = ["node", "fp"]
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for i, m in enumerate(masks)])).alias("c")
    return points.select(*rest, *keys, choice).select(*rest, F.xxhash64(*keys, "c.i", "c.k").alias("bucket"))


def pivot_table(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances (rows, pivots)."""
    return np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)


def reference_points(n: int) -> np.ndarray:
    """Fixed pseudo-random fingerprints."""
    return np.array([xxhash.xxh64_intdigest(f"pivot-{i}".encode(), SEED) for i in range(n)], np.uint64)


def close_forest(bucket: np.ndarray, fp: np.ndarray, pivots: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within buckets with at most ``max_bits`` differing bits, just enough to connect all close ones.

    Rows are ordered by bucket and distance to the first pivot.  Shifts of this
    order give the pairs; a row drops out once its partner lies in another
    bucket or too far in the first coordinate, since later ones lie further.
    Pairs that earlier links connect are not looked at again, and a shift holds
    one pair per row at most, so memory follows the rows and not the pairs.
    """
    table = pivot_table(fp, pivots)
    order = np.lexsort((table[:, 0], bucket))
    b, f, t = bucket[order], fp[order], table[order]
    parent, live, left, right = np.arange(len(f)), np.arange(len(f)), [], []
    step = 1
    while len(live):
        live = live[live + step < len(f)]
        other = live + step
        near = (b[live] == b[other]) & (t[other, 0] - t[live, 0] <= max_bits)
        live = live[near]
        x, y = live, live + step
        apart = parent[x] != parent[y]
        x, y = x[apart], y[apart]
        # largest coordinate difference first, then the exact count
        for lo in range(1, t.shape[1], 5):
            ok = (np.abs(t[x, lo : lo + 5] - t[y, lo : lo + 5]) <= max_bits).all(axis=1)
            x, y = x[ok], y[ok]
        ok = np.bitwise_count(f[x] ^ f[y]) <= max_bits
        x, y = x[ok], y[ok]
        if len(x):
            new = join(parent, x, y)
            left.append(order[x[new]])
            right.append(order[y[new]])
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def join(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[int]:
    """Numbers of the pairs that connect something new; ``parent`` names the root of every row, before and after."""
    above: dict[int, int] = {}

    def root(k: int) -> int:
        while k in above:
            if above[k] in above:
                above[k] = above[above[k]]
            k = above[k]
        return k

    new = []
    for i, (a, b) in enumerate(zip(parent[x].tolist(), parent[y].tolist())):
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)
            new.append(i)
    moved = np.arange(len(parent))
    moved[list(above)] = [root(k) for k in above]
    parent[:] = moved[parent]
    return new


def bucket_links(rows: DataFrame, max_bits: int, pivots: int) -> DataFrame:
    """Links (u, v) found inside the buckets of (node, fp, bucket).

    Rows are dealt by bucket and sorted, so a task sees each bucket as one run;
    the last run of a batch waits for the next batch.
    """
    refs = reference_points(pivots)
    columns = ["bucket", "node", "fp"]

    def link(bucket, node, fp):
        i, j = close_forest(bucket, fp.view(np.uint64), refs, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], ["u", "v"])

    def task(batches):
        held: list[tuple] = []
        for batch in batches:
            now = tuple(batch.column(c).to_numpy() for c in columns)
            if not len(now[0]):
                continue
            held.append(now)
            if now[0][0] == now[0][-1] and held[0][0][0] == now[0][0]:
                continue  # one run goes on
            parts = [np.concatenate(x) for x in zip(*held)]
            end = int(np.searchsorted(parts[0], parts[0][-1], side="left"))
            yield link(*(x[:end] for x in parts))
            held = [tuple(x[end:] for x in parts)]
        if held:
            yield link(*(np.concatenate(x) for x in zip(*held)))

    dealt = rows.select(*columns).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(task, T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())]))


def split_buckets(rows: DataFrame, sizes: DataFrame, block_rows: int) -> DataFrame:
    """Deal the points of a large bucket to parts of about ``block_rows`` and put every pair of parts into a bucket of its own.

    Any two points still meet; a bucket holds two parts at most.
    """
    sizes = sizes.select(F.col("bucket").alias("s_bucket"), F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    dealt = rows.join(sizes, F.col("bucket") == F.col("s_bucket")).withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    dealt = dealt.select("node", "fp", "bucket", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return dealt.select("node", "fp", F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("bucket"))


def fingerprint_links(points: DataFrame, max_bits: int = MAX_BITS, agree: int = AGREE, pivots: int = PIVOTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) between points (node, fp) with distinct fingerprints, enough of them to connect all close ones.

    Buckets with more than ``bucket_rows`` points (as near copies of one text
    make) are dealt anew by further blocks of all bits, twice.  What is large even
    then holds points that agree on most bits; it is compared part against part.
    """
    masks = block_masks(list(range(BITS)), max_bits, agree)
    rows, links = keyed(points, [], masks), None
    for level in range(3):
        rows = materialize(rows)
        large = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows))
        if not large.limit(1).count():
            found = bucket_links(rows, max_bits, pivots)
            return found if links is None else links.union(found)
        found = bucket_links(rows.join(large, "bucket", "left_anti"), max_bits, pivots)
        links = found if links is None else links.union(found)
        if level == 2:
            return links.union(bucket_links(split_buckets(rows, large, bucket_rows), max_bits, pivots))
        # interleaved bit order, so that the new blocks cut across the old ones
        mixed = [b for k in range(level + 2) for b in range(k, BITS, level + 2)]
        rows = keyed(rows.join(large, "bucket", "left_semi"), ["bucket"], block_masks(mixed, max_bits, 1 + level))


def fingerprint_groups(prints: DataFrame, max_bits: int, agree: int, pivots: int) -> DataFrame:
    """Rows (g_fp, component, n, first_id): per fingerprint of (doc_id, fp) its component, its rows and their smallest id."""
    # copies meet here first: one point per fingerprint, whatever their number
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    points = materialize(points.select("fp", "first_id", "n", F.col("fp").alias("node")))
    found = components(fingerprint_links(points.select("node", "fp"), max_bits, agree, pivots))
    return points.join(found, "node", "left").select(F.col("fp").alias("g_fp"), F.coalesce("component", "fp").alias("component"), "n", "first_id")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, max_bits: int = MAX_BITS, agree: int = AGREE, pivots: int = PIVOTS,
    distinct: bool = False,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs of characters other than space and x09-x0D, after lower-casing
    A-Z; a text with fewer words than a shingle is one shingle, a text without
    words (or null) has fingerprint zero and is linked like any other.  With
    ``distinct`` a shingle counts once however often it occurs.
    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits.  Rows with a null doc_id take part: their
    component is that of their fingerprint, and its id is null if it holds no
    other id.  Ids are integers.  An empty table gives an empty table.
    """
    prints = materialize(fingerprints(docs, text, doc_id, shingle, distinct))
    groups = fingerprint_groups(prints, max_bits, agree, pivots)
    least = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    groups = groups.join(least, "component").select("g_fp", "component_id")
    out = prints.join(groups, F.col("fp") == F.col("g_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, max_bits: int = MAX_BITS, agree: int = AGREE, pivots: int = PIVOTS,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """One document of each component of ``near_duplicates``, with the columns of ``docs``.

    The one with the smallest id stays, null ids after all others; of texts that
    share that id the one with the smallest 64-bit hash, of equal rows exactly one.
    Documents without a near copy pass straight through: a Bloom filter of fixed
    size holds the members of larger components, and only the rows that it cannot
    clear are shuffled.  An empty table gives an empty table.
    """
    prints = materialize(fingerprints(docs, text, doc_id, shingle))
    groups = materialize(fingerprint_groups(prints, max_bits, agree, pivots).select("g_fp", "component", "n"))
    large = groups.groupBy("component").agg(F.sum("n").alias("rows")).where(F.col("rows") > 1).select(F.col("component").alias("l_component"))
    groups = materialize(groups.join(large, F.col("component") == F.col("l_component")).select("g_fp", "component"))
    members = materialize(prints.join(groups, F.col("fp") == F.col("g_fp")).select("component", F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).distinct())
    first = F.min(F.struct(F.col("m_id").isNull(), "m_id", "m_hash")).alias("first")
    winners = members.groupBy("component").agg(first).select(F.col("component").alias("w_component"), F.col("first.m_id").alias("w_id"), F.col("first.m_hash").alias("w_hash"))
    wins = F.col("m_id").eqNullSafe(F.col("w_id")) & (F.col("m_hash") == F.col("w_hash"))
    members = materialize(members.join(winners, F.col("component") == F.col("w_component")).select("m_id", "m_hash", wins.alias("wins")))
    slot = F.explode(F.array(*slots(F.xxhash64("m_id", "m_hash"), bits, HASHES))).alias("slot")
    filled = materialize(bitmap_rows(members.select(slot), "slot"))
    # the documents travel in one column, so that none of their names can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), hash_of(F.col(f"`{text}`")).alias("text_hash"))
    rows = flag_possible(rows.withColumn("key", F.xxhash64("doc_id", "text_hash")), filled, "key", bits)
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
    held = rows.where("maybe").join(members, same, "left")
    clear = rows.where(~F.col("maybe")).select("row").unionByName(held.where("wins is null").select("row"))
    stay = held.where("wins").groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
    return clear.unionByName(stay.select("row")).select("row.*")
