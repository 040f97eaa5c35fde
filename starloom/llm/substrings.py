"""Repeated passages, removed exactly: suffix arrays by induced sorting over the places that can match.

A passage of ``length`` bytes that occurs twice shares, in both places, the same
anchors: short grams that are the smallest by hash among all grams of a window
as long as the passage allows.  So

1. equal texts are settled by their hash; each distinct text goes on once;
2. each text's anchors go to the bucket of their hash, with hashes of what is
   around them.  Anchors with the same surroundings as an earlier one repeat
   whole; those that share part of their surroundings with others stay open, all
   others are done;
3. the surroundings of open anchors are read from the texts and dealt to shards
   by the part they share; each shard builds its suffix array and the permuted
   common prefixes, and finds every passage that also starts earlier;
4. the starts found meet their document again, which drops the covered bytes.

Texts move only where anchors stay open or bytes go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import arrow_pieces, bitmap_rows, schema_of, slots
from starloom.llm.exact_dedup import FILTER_BITS, flag_possible, repeated_bits
from starloom.llm.suffix import permuted_lcp, suffix_array
from starloom.operators.ordered import ordered
from starloom.session import materialize

LENGTH = 100

# Bytes of an anchor gram; the other bytes of a passage are the window that must hold one.
GRAM = 32

# The window is cut into zones by the distance from a passage's start to its anchor.
ZONES = 4

# Bytes of text in one step of the anchor search and in one suffix array.
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 2 << 20

# Bytes of text per anchor bucket; the number of buckets follows the input.
BUCKET_TEXT = 1 << 20

# Anchors that share a gram and a zone beyond this number are settled by the hashes of their passages, spread by hash.
HOT_ANCHORS = 20_000

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _Q
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each place, by doubling."""
    h, factor, step = data.astype(np.uint64) + np.uint64(1), _P, 1
    while step < size:
        n = len(h) - step
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = h[:n] * factor + h[step:]
        factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
        step *= 2
    return mix(h)


def sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest of every ``width`` neighbours."""
    step = 1
    while step * 2 <= width:
        a = pick(a[:-step], a[step:])
        step *= 2
    rest = width - step
    return pick(a[:-rest], a[rest:]) if rest else a


def zones(length: int, gram: int, n: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of the distance between a passage's start and its anchor."""
    window = length - gram + 1
    cuts = [window * i // n for i in range(n + 1)]
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:]) if a < b]


def anchors_of(data: np.ndarray, begin: np.ndarray, lens: np.ndarray, length: int, gram: int, parts: list[tuple[int, int]]):
    """Anchors of the texts laid one after another in ``data``.

    Returns (hash, text number, position, zone keys, whole): a zone key is a hash
    of the bytes that all passages of that zone share, 0 where the zone has no
    passage; ``whole`` is a hash of all surroundings (random at a text's ends,
    where surroundings are cut, so that those never count as equal).
    """
    window = length - gram + 1
    none = np.zeros(0, np.int64)
    h = gram_hashes(data, gram)
    if len(h) < window:
        return none.astype(np.uint64), none, none, np.zeros((len(parts), 0), np.uint32), none.astype(np.uint64)
    order = (h >> np.uint64(32)).astype(np.uint32)
    least = sliding(order, window, np.minimum)
    edge = np.zeros(window - 1, np.uint32)
    at = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), window, np.maximum) == order)
    text = np.searchsorted(begin, at, side="right") - 1
    fits = at + gram <= begin[text] + lens[text]
    at, text = at[fits], text[fits]
    pos, size = at - begin[text], lens[text]
    keys = np.zeros((len(parts), len(at)), np.uint32)
    whole = np.zeros(len(at), np.uint64)
    last = len(h) - 1
    for z, (a, b) in enumerate(parts):
        inside = (pos >= a) & (pos - b + length <= size)
        lo, hi = np.where(inside, at - a, 0), np.where(inside, at - b + length, length)
        k = h[np.minimum(lo, last)] * np.uint64(3)
        for s in range(gram, length - (b - a) - gram, gram):
            k = mix(k) + h[np.minimum(lo + s, last)]
        k = mix(mix(k) + h[np.clip(hi - gram, 0, last)])
        keys[z] = np.where(inside, (k >> np.uint64(40)).astype(np.uint32) | np.uint32(1), 0)
    reach = length + window - 1
    left = np.maximum(at - (window - 1), 0)
    for s in [*range(0, reach - gram, gram), reach - gram]:
        whole = mix(whole + h[np.minimum(left + s, last)])
    cut = (pos < window - 1) | (pos + length > size)
    whole = np.where(cut, mix(whole + h[np.minimum(at, last)] + (text.astype(np.uint64) + np.uint64(1)) * _P + pos.astype(np.uint64) * _Q), whole)
    return h[at], text, pos, keys, whole


def first_of(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns: where a new combination begins."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def squeeze(columns: list[np.ndarray]) -> bytes:
    """Number columns as compressed bytes; bytes of equal weight stand together."""
    flat = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    raw = np.int64(len(columns[0])).tobytes() + b"".join(flat)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(blob: bytes, kinds: list[type]) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), "zstd", asbytes=True)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def anchor_rows(texts: DataFrame, buckets: int, length: int, gram: int, parts: list[tuple[int, int]]) -> DataFrame:
    """Rows (bucket, blob, ord, found): anchors of several texts packed by bucket, or starts found at once.

    Of anchors with the same surroundings within one step only the first goes to
    its bucket; the passages of the others start earlier, which settles them.
    """
    window = length - gram + 1
    shift = np.uint64(64 - (buckets - 1).bit_length()) if buckets > 1 else None
    found_kind = pa.list_(pa.int64())

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        b = b.take(pc.sort_indices(b, [("ord", "ascending")]))
        ords = b.column("ord").to_numpy()
        raw = [r.as_py() for r in b.column("raw")]
        lens = np.array([len(r) for r in raw], np.int64)
        h, text, pos, keys, whole = anchors_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lens) - lens, lens, length, gram, parts)
        by = np.lexsort((pos, text, whole, h))
        h, text, pos, keys, whole = h[by], text[by], pos[by], keys[:, by], whole[by]
        first = first_of(h, whole)
        again = np.flatnonzero(~first)
        out: list[list] = [[], [], [], []]
        if len(again):
            again = again[np.lexsort((pos[again], text[again]))]
            cuts = np.flatnonzero(np.diff(text[again])) + 1
            for part in np.split(again, cuts):
                o = int(ords[text[part[0]]])
                for v, x in zip(out, (o % buckets, None, o, pos[part].tolist())):
                    v.append(x)
        h, text, pos, keys, whole = h[first], text[first], pos[first], keys[:, first], whole[first]
        bucket = (h >> shift).astype(np.int64) if shift is not None else np.zeros(len(h), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(h)]
        for s, e in zip(cuts, cuts[1:]):
            if s < e:
                blob = squeeze([h[s:e], whole[s:e], ords[text[s:e]], pos[s:e].astype(np.uint32), *keys[:, s:e]])
                for v, x in zip(out, (int(bucket[s]), blob, None, None)):
                    v.append(x)
        kinds = (pa.int64(), pa.binary(), pa.int64(), found_kind)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["bucket", "blob", "ord", "found"])

    def task(batches):
        yield from map(step, arrow_pieces(batches, CHUNK_BYTES, 16))

    return texts.mapInArrow(task, schema_of([("bucket", "long"), ("blob", "binary"), ("ord", "long"), ("found", "array<long>")]))


def settle(rows: DataFrame, parts: list[tuple[int, int]], hot: int) -> DataFrame:
    """Rows (ord, pos, open, hot) per anchor that matters: ``open`` has a bit per zone that texts must decide, 0 if all passages repeat.

    ``hot`` has the bits of those zones that very many anchors share.
    """
    kinds = [np.uint64, np.uint64, np.int64, np.uint32, *[np.uint32] * len(parts)]

    def bucket(blobs: list[bytes]) -> pa.RecordBatch:
        h, whole, ords, pos, *keys = (np.concatenate(c) for c in zip(*(unsqueeze(b, kinds) for b in blobs)))
        by = np.lexsort((pos, ords, whole, h))
        h, whole, ords, pos, keys = h[by], whole[by], ords[by], pos[by], [k[by] for k in keys]
        first = first_of(h, whole)
        mask, hots = np.zeros(len(h), np.int32), np.zeros(len(h), np.int32)
        lead = np.flatnonzero(first)
        for z, k in enumerate(keys):
            k = k[lead]
            order = np.lexsort((k, h[lead]))
            new = first_of(h[lead][order], k[order])
            size = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
            mates = np.repeat(size, size)
            mask[lead[order]] |= np.where((mates > 1) & (k[order] > 0), 1 << z, 0).astype(np.int32)
            hots[lead[order]] |= np.where((mates > hot) & (k[order] > 0), 1 << z, 0).astype(np.int32)
        keep = ~first | (mask > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(ords[keep]), pa.array(pos[keep].astype(np.int64)), pa.array(mask[keep]), pa.array(hots[keep])], ["ord", "pos", "open", "hot"]
        )

    def task(batches):
        now, blobs = None, []
        for b in batches:
            if own := [i for i, v in enumerate(b.column("blob").is_null().to_pylist()) if v]:
                ords, found = b.column("ord").to_pylist(), b.column("found").to_pylist()
                pos = np.concatenate([np.array(found[i], np.int64) for i in own])
                o = np.repeat(np.array([ords[i] for i in own], np.int64), [len(found[i]) for i in own])
                zero = np.zeros(len(o), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(o), pa.array(pos), pa.array(zero), pa.array(zero)], ["ord", "pos", "open", "hot"])
            for k, blob in zip(b.column("bucket").to_pylist(), b.column("blob")):
                if not blob.is_valid:
                    continue
                if k != now and blobs:
                    yield bucket(blobs)
                    blobs = []
                now = k
                blobs.append(blob.as_py())
        if blobs:
            yield bucket(blobs)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(task, schema_of([("ord", "long"), ("pos", "long"), ("open", "int"), ("hot", "int")]))


def surroundings(texts: DataFrame, length: int, parts: list[tuple[int, int]]) -> DataFrame:
    """Rows (key, ord, start, text, last) from (ord, raw, open anchors).

    With a ``text``: the bytes around an open zone, to be compared under ``key``.
    Without: passages from ``start`` to ``last`` that repeat something earlier.
    Equal surroundings within a task go out once, with their earliest place.
    """

    def emit(seen: dict, done: list) -> pa.RecordBatch:
        rows = [(k, o, s, t, None) for (k, t), (o, s) in seen.items()] + [(o, o, s, None, e) for o, s, e in done]
        key, ords, start, text, last = zip(*rows) if rows else ((),) * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((key, ords, start, text, last), kinds)], ["key", "ord", "start", "text", "last"])

    def task(batches):
        seen, done, size = {}, [], 0
        for b in batches:
            for o, raw, anchors in zip(b.column("ord").to_pylist(), b.column("raw"), b.column("anchors")):
                raw, n = raw.as_py(), len(raw.as_buffer())
                for pos, zone in zip(*(c.to_pylist() for c in anchors.values.flatten()[:2])):
                    for z, (near, far) in enumerate(parts):
                        if zone >> z & 1:
                            lo, hi = max(0, pos - far), min(n, pos - near + length)
                            if hi - lo < length:
                                continue
                            key = (xxhash.xxh64_intdigest(raw[pos - near : pos - far + length], z) ^ (1 << 63)) - (1 << 63)
                            mine, text = (o, lo), raw[lo:hi]
                            best = seen.get((key, text))
                            if best is None:
                                seen[key, text] = mine
                                size += hi - lo
                            elif best != mine:
                                seen[key, text] = min(best, mine)
                                done.append((*max(best, mine), max(best, mine)[1] + hi - lo - length))
                if size >= 16 * SHARD_BYTES or len(done) > 200_000:
                    yield emit(seen, done)
                    seen, done, size = {}, [], 0
        yield emit(seen, done)

    return texts.mapInArrow(task, schema_of([("key", "long"), ("ord", "long"), ("start", "long"), ("text", "binary"), ("last", "long")]))


def shard_starts(keys: list[int], ords: list[int], starts: list[int], texts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(ord, first, last) of passages that also start earlier, among texts that share keys; sorted by key."""
    best: dict = {}
    out = []
    for k, o, s, t in zip(keys, ords, starts, texts):
        have = best.get((k, t))
        if have is None or have == (o, s):
            best[k, t] = (o, s)
        else:
            best[k, t] = min(have, (o, s))
            o, s = max(have, (o, s))
            out.append((o, s, s + len(t) - length))
    sizes: dict = {}
    for k, _ in best:
        sizes[k] = sizes.get(k, 0) + 1
    kept = [(t, o, s) for (k, t), (o, s) in best.items() if sizes[k] > 1]
    if not kept:
        return out
    lens = np.array([len(t) for t, _, _ in kept], np.int64)
    # bytes become 2 to 257, a 1 ends each text, a 0 ends the whole
    joined = np.frombuffer(b"\n".join(t for t, _, _ in kept) + b"\n\n", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(lens + 1) - 1
    joined[ends] = 1
    joined[-1] = 0
    array = suffix_array(joined, 258, length)
    own = np.repeat(np.arange(len(kept)), lens + 1)
    room = np.concatenate([ends[own] - np.arange(len(own)), [0]])
    common = permuted_lcp(joined, array, room)
    # neighbours in the array with a whole passage in common are one class
    same = common[array] >= length
    whole = np.flatnonzero(same | np.concatenate([same[1:], [False]]))
    if not len(whole):
        return out
    group = np.cumsum(~same)[whole]
    place = array[whole]
    text = own[place]
    ord_ = np.array([o for _, o, _ in kept], np.int64)[text]
    start = np.array([s for _, _, s in kept], np.int64)[text] + place - (ends[text] - lens[text])
    by = np.lexsort((start, ord_, group))
    group, ord_, start = group[by], ord_[by], start[by]
    new = first_of(group)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    later = (ord_ != ord_[lead]) | (start != start[lead])
    o, s = ord_[later], start[later]
    by = np.lexsort((s, o))
    o, s = o[by], s[by]
    head = np.ones(len(o), bool)
    head[1:] = (o[1:] != o[:-1]) | (s[1:] > s[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.concatenate([first[1:] - 1, [len(o) - 1]]) if len(o) else first
    out += zip(o[first].tolist(), s[first].tolist(), s[last].tolist())
    return out


def compare(rows: DataFrame, length: int) -> DataFrame:
    """Rows (ord, first, last): runs of passage starts that repeat, from the suffix arrays of the shards."""
    kinds = schema_of([("ord", "long"), ("first", "long"), ("last", "long")])

    def pack(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["ord", "first", "last"])

    def task(batches):
        held: list[list] = [[], [], [], []]
        size = 0
        for b in batches:
            settled = []
            for k, o, s, t, e in zip(*(b.column(c).to_pylist() for c in ("key", "ord", "start", "text", "last"))):
                if t is None:
                    settled.append((o, s, e))
                    continue
                # a shard ends between two keys only
                if size >= SHARD_BYTES and k != held[0][-1]:
                    yield pack(shard_starts(*held, length))
                    held, size = [[], [], [], []], 0
                for v, x in zip(held, (k, o, s, t)):
                    v.append(x)
                size += len(t)
            yield pack(settled)
        if size:
            yield pack(shard_starts(*held, length))

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(task, kinds)


def hot_starts(texts: DataFrame, length: int, parts: list[tuple[int, int]]) -> DataFrame:
    """Rows (ord, first, last) for zones that very many anchors share: each passage by a hash of 128 bits.

    The earliest place of each passage is a combining aggregate, so a passage
    that a third of all texts hold arrives as one row per task.
    """

    def task(batches):
        for b in batches:
            out: list[list] = [[], [], []]
            for o, raw, anchors in zip(b.column("ord").to_pylist(), b.column("raw"), b.column("anchors")):
                raw = raw.as_py()
                places = {
                    s for a in anchors.as_py() for z, (near, far) in enumerate(parts) if a["zones"] >> z & 1
                    for s in range(max(0, a["pos"] - far), min(len(raw) - length, a["pos"] - near) + 1)
                }
                for s in sorted(places):
                    for v, x in zip(out, (xxhash.xxh128_digest(raw[s : s + length]), o, s)):
                        v.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["passage", "ord", "first"])

    rows = materialize(texts.mapInArrow(task, schema_of([("passage", "binary"), ("ord", "long"), ("first", "long")])))
    least = materialize(rows.groupBy("passage").agg(F.min(F.struct("ord", "first")).alias("least")))
    least = least.select(F.col("passage").alias("p"), "least")
    later = rows.join(least, F.col("passage") == F.col("p")).where(F.struct("ord", "first") > F.col("least"))
    return later.select("ord", "first", F.col("first").alias("last"))


def clean(rows: DataFrame, length: int) -> DataFrame:
    """Rows (ord, n_removed, spans, kept_sha256, kept) from (ord, raw, starts)."""

    def task(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for raw, starts in zip(b.column("raw"), b.column("starts")):
                raw = raw.as_py()
                lo, hi = (np.asarray(c) for c in starts.values.flatten()[:2])
                lo, hi = np.maximum(lo, 0), np.minimum(hi + length, len(raw))
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(hi[order])
                new = np.concatenate([[True], lo[1:] > reach[:-1]])
                begin = lo[new]
                end = reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])]
                kept = b"".join(raw[s:e] for s, e in zip([0, *end.tolist()], [*begin.tolist(), len(raw)]))
                spans = [{"start": s, "end": e} for s, e in zip(begin.tolist(), end.tolist())]
                for v, x in zip(out, (len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    v.append(x)
            kinds = (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("ord"), *[pa.array(v, k) for v, k in zip(out, kinds)]], ["ord", "n_removed", "spans", "kept_sha256", "kept"])

    fields = [("ord", "long"), ("n_removed", "long"), ("spans", "array<struct<start:long,end:long>>"), ("kept_sha256", "string"), ("kept", "binary")]
    return rows.mapInArrow(task, schema_of(fields))


def only(texts: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The texts that may be among ``ids``, by a Bloom filter of bounded size; it only saves shuffle."""
    at = slots(F.col("ord"), bits, 1)[0]
    filled = F.broadcast(materialize(bitmap_rows(ids.select(at.alias("slot")), "slot")))
    return flag_possible(texts, filled, "ord", bits, 1).where("maybe").drop("maybe")


def remove_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT_ANCHORS, with_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and kept if ``with_text``.

    Each byte covered by a ``length``-byte string that also starts earlier goes:
    in a document with a smaller id, or in the same one at an earlier place.
    Strings never reach over documents and are judged on the input.  Null counts
    as the empty text.  ``spans`` are the removed runs, ``kept`` the remaining
    bytes.  Documents that share an id come in the order of their SHA-256; of
    equal rows one counts as the first; null ids come before all others.  Ids
    must be integers.  An empty table gives an empty table.  Results rest on
    64-bit hashes (128 bits for passages that very many documents share).
    """
    if gram & (gram - 1) or gram * 2 > length:
        raise ValueError("gram must be a power of two and at most half of length")
    parts = zones(length, gram, ZONES)
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    wide = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), raw.alias("raw")).withColumn("sha", F.unhex(F.sha2("raw", 256)))
    slim = materialize(wide.select("doc_id", "sha", F.octet_length("raw").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row_id")))

    # equal texts: the smallest id stands for all of them
    filled = repeated_bits(slim)
    least = F.min(F.struct(F.col("doc_id").alias("id"), F.col("row_id").alias("row"))).alias("k")
    groups = materialize(flag_possible(slim, filled).where("maybe").groupBy("sha").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("sha").alias("g_sha"), "k.id", "k.row"))
    slim = slim.join(groups, F.col("sha") == F.col("g_sha"), "left")
    slim = slim.select("doc_id", "row_id", "sha", "n_bytes", (F.col("g_sha").isNotNull() & (F.col("row") != F.col("row_id"))).alias("copy"))
    flagged = flag_possible(wide, filled)
    again = flagged.where("maybe").join(groups, F.col("sha") == F.col("g_sha"), "left")
    again = again.where(F.col("g_sha").isNull() | F.col("id").eqNullSafe(F.col("doc_id"))).select("doc_id", "raw", "sha")
    texts = flagged.where(~F.col("maybe")).select("doc_id", "raw", "sha").union(again).where(F.octet_length("raw") >= length)

    odd = slim.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    if odd:
        # ids that do not tell rows apart: number the distinct texts instead
        slim = materialize(slim)
        numbered = ordered(slim.where("not copy").select("doc_id", "sha", F.lit(0).alias("one")), ["one"], ["doc_id", "sha"], rank="ord")
        numbered = materialize(numbered.select(F.col("doc_id").alias("o_id"), F.col("sha").alias("o_sha"), "ord"))
        match = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("sha") == F.col("o_sha"))
        slim = slim.join(numbered, match & ~F.col("copy"), "left").drop("o_id", "o_sha")
        texts = texts.join(numbered, match).select("ord", "raw").dropDuplicates(["ord"])
    else:
        slim = slim.withColumn("ord", F.when(~F.col("copy"), F.col("doc_id")))
        texts = texts.select(F.col("doc_id").alias("ord"), "raw")

    total = slim.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = 1 << max(10, (total // BUCKET_TEXT).bit_length())
    seen = materialize(settle(anchor_rows(texts, buckets, length, gram, parts), parts, hot))
    starts = seen.where("open = 0").select("ord", (F.col("pos") - (length - gram)).alias("first"), F.col("pos").alias("last"))

    def with_anchors(zone_bits) -> DataFrame:
        found = seen.where(zone_bits > 0).select("ord", F.struct("pos", zone_bits.alias("zones")).alias("a"))
        ids = found.groupBy(F.col("ord").alias("a_ord")).agg(F.collect_list("a").alias("anchors"))
        return only(texts, found).join(ids, F.col("ord") == F.col("a_ord")).select("ord", "raw", "anchors")

    starts = starts.union(compare(surroundings(with_anchors(F.col("open").bitwiseAND(F.bitwise_not("hot"))), length, parts), length))
    if seen.where("hot > 0").limit(1).count():
        starts = starts.union(hot_starts(with_anchors(F.col("open").bitwiseAND(F.col("hot"))), length, parts))
    starts = materialize(starts.groupBy("ord").agg(F.collect_list(F.struct("first", "last")).alias("starts")).select(F.col("ord").alias("s_ord"), "starts"))
    changed = clean(only(texts, starts.select(F.col("s_ord").alias("ord"))).join(starts, F.col("ord") == F.col("s_ord")).select("ord", "raw", "starts"), length)
    changed = changed.withColumnRenamed("ord", "c_ord").withColumnRenamed("kept_sha256", "c_sha")
    if not with_text:
        changed = changed.drop("kept")

    out = slim.join(changed, F.col("ord") == F.col("c_ord"), "left")
    gone = F.col("copy") & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.expr("cast(array() as array<struct<start:long,end:long>>)")
    spans = F.when(gone, all_of_it).otherwise(F.coalesce("spans", nothing))
    columns = [
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("c_sha", F.lower(F.hex("sha")))).alias("kept_sha256"), spans.alias("spans"),
    ]
    if with_text:
        columns.append(F.when(gone, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))
    return out.select(*columns)
