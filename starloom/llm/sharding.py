"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns many points (virtual nodes) on a ring.  A row hashes to a place
on the ring and belongs to the next point clockwise.  No shard takes more than
its bound; where a shard is full, the rows beyond it go on clockwise to the next
point whose shard has room.  The bound makes the balance certain, and only rows
near a full point move.

The rows per point are counted with a combining aggregate.  What overflows
where is then worked out on those counts alone: as many numbers as there are
virtual nodes, however many rows there are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordered import ordered

# Points on the ring per shard.
VNODES = 64
RING = 1 << 62


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Sorted (place, shard) of all virtual nodes; a shard's points do not depend on the number of shards."""
    points = []
    for s in range(shards):
        for v in range(vnodes):
            h = hashlib.sha256(f"shard-{s}-point-{v}".encode()).digest()
            points.append((int.from_bytes(h[:8], "big") % RING, s))
    return sorted(points)


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """Most rows per shard.  Without slack the bounds add up to the total, so counts differ by one at most."""
    if slack:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def overflow_plan(counts: dict[int, int], points: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Who goes where: rows (arc, first rank, end rank, shard, first slot).

    ``counts`` are the rows that hash to each arc (the stretch that ends at a
    point).  First every arc fills its own shard, in ring order; then what is
    left walks clockwise to points whose shard still has room.
    """
    room, used, plan, rest = list(room), [0] * len(room), [], []

    def place(arc: int, start: int, n: int, shard: int) -> int:
        k = min(n, room[shard])
        if k > 0:
            plan.append((arc, start, start + k, shard, used[shard]))
            used[shard] += k
            room[shard] -= k
        return k

    for arc in range(len(points)):
        n = counts.get(arc, 0)
        k = place(arc, 0, n, points[arc][1])
        if k < n:
            rest.append((arc, k, n - k))
    for arc, start, n in rest:
        step = arc
        while n:
            step = (step + 1) % len(points)
            k = place(arc, start, n, points[step][1])
            start, n = start + k, n - k
    return plan


def with_arc(rows: DataFrame, places: list[int]) -> DataFrame:
    """Add ``arc``, the number of the next point clockwise from ``place``; past the last point the ring begins anew.

    The ring is cut into equal cells, a small broadcast table with the few points
    of each, so a row compares with those and not with the whole ring.
    """
    shift = 62 - max(1, len(places).bit_length())
    inside: list[list[int]] = [[] for _ in range(RING >> shift)]
    for p in places:
        inside[p >> shift].append(p)
    cells, before = [], 0
    for i, c in enumerate(inside):
        cells.append((i, before, c))
        before += len(c)
    cells = F.broadcast(rows.sparkSession.createDataFrame(cells, "cell long, before int, points array<long>"))
    passed = F.size(F.filter("points", lambda p: p < F.col("place")))
    out = rows.join(cells, F.shiftright("place", shift) == F.col("cell"))
    return out.select(*rows.columns, F.pmod(F.col("before") + passed, F.lit(len(places))).alias("arc"))


def consistent_shards(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", vnodes: int = VNODES, slack: float = 0.0
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, home_shard, moved.

    size is the UTF-8 bytes of the text plus 16; a null text counts as none and
    has checksum 0.  ``slot`` numbers the rows of a shard without gaps from 0.
    ``home_shard`` is the owner of the row's place on the ring, ``moved`` says
    that it was full.  With ``slack`` 0 the counts of shards differ by one at
    most; otherwise no shard has more than (1 + slack) times the mean.  Rows
    with a null doc_id are placed by their text.  Rows that share a doc_id are
    ordered by size and checksum.  An empty table gives an empty table.
    """
    if shards < 1 or vnodes < 1 or slack < 0:
        raise ValueError("shards and vnodes must be positive and slack not negative")
    points = ring_points(shards, vnodes)
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.pmod(F.xxhash64(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.concat(F.lit("null "), F.hex(F.unhex(F.md5(raw)))))), F.lit(RING)).alias("place"),
    )
    rows = with_arc(rows, [p for p, _ in points])
    counts = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = overflow_plan(counts, points, bounds(sum(counts.values()), shards, slack))
    plan = [(*p, points[p[0]][1]) for p in plan]
    # at most two entries per virtual node and shard: bounded by the ring, not by the rows
    plan_rows = F.broadcast(docs.sparkSession.createDataFrame(plan, "p_arc int, lo long, hi long, shard int, base long, home_shard int"))
    ranked = ordered(rows, ["arc"], ["place", "doc_id", "size", "text_crc32"], rank="rank", biggest=max(counts.values(), default=0))
    out = ranked.join(plan_rows, (F.col("arc") == F.col("p_arc")) & (F.col("rank") - 1 >= F.col("lo")) & (F.col("rank") - 1 < F.col("hi")))
    return out.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1 - F.col("lo")).alias("slot"),
        "home_shard", (F.col("home_shard") != F.col("shard")).alias("moved"),
    )
