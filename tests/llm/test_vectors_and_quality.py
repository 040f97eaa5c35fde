"""Hard negatives, centroid clusters and quality rules on small hostile inputs, against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from starloom.llm import centroids, hard_negatives, quality_rules

# names that the operators use inside
CLASH = "vec_id long, embedding array<float>, label int, row long, v long, anchor long, cluster long, distance long, near long, slot long, score long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[k] * 9) for k, r in enumerate(rows)], CLASH).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    """(id, vector, label): ties, repeated rows, a null id, nulls and numbers that are not finite, a very common vector."""
    rng = random.Random(4)
    rows = [(k, [rng.choice([-1.5, -0.25, 0.0, 0.3, 1.0, 2.7]) for _ in range(6)], rng.randint(0, 3)) for k in range(90)]
    rows += [(k, [0.5] * 6, rng.randint(0, 3)) for k in range(90, 140)] + [rows[10], rows[20], rows[20]]
    rows += [(None, [0.5, 1.0, 2.0, 0.0, 1.0, 1.0], 1), (200, None, 1), (201, [1.0] * 6, None), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1)]
    return rows + [(203, [math.nan] * 6, 2), (210, [math.inf] * 6, 2), (205, [], 2), (220, [2.0, 1.0], 0), (206, [0.1] * 9, 1)]


def usable(rows):
    return [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def brute_negatives(rows, positives, negatives, lowest, highest):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in usable(rows)]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (anchor, u, mine) in enumerate(rows):
        if anchor is None or anchor % 10:
            continue
        scores = [(sum(x * y for x, y in zip(u, v)), i, label) for k, (i, v, label) in enumerate(rows) if k != a]
        for p in sorted((s for s in scores if s[2] == mine), key=key)[:positives]:
            fit = sorted((s for s in scores if s[2] != mine and lowest * p[0] <= 100 * s[0] <= highest * p[0]), key=key)[:negatives]
            out += [(anchor, p[1], n + 1, s[1], p[0], s[0]) for n, s in enumerate(fit)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_hard_negatives(spark, vectors, monkeypatch, block_bytes):
    monkeypatch.setattr(hard_negatives, "SCORES", 300)
    df = frame(spark, vectors)
    out = hard_negatives.hard_negatives(df, hard_negatives.F.col("vec_id") % 10 == 0, positives=3, negatives=4, block_bytes=block_bytes)
    want = brute_negatives(vectors, 3, 4, 30, 90)
    assert len(want) > 100
    assert sorted(map(tuple, out.collect()), key=str) == want
    if block_bytes > 200:
        assert hard_negatives.hard_negatives(df.limit(0), hard_negatives.F.lit(True)).count() == 0
        assert hard_negatives.hard_negatives(df, hard_negatives.F.lit(None).cast("boolean")).count() == 0


def test_residue_scores_are_exact():
    rng = np.random.default_rng(3)
    for size, dimensions in ((40, 5), (5000, 64), (70_000, 1500), (1 << 20, 3000)):
        a, b = rng.integers(-size, size + 1, (7, dimensions)), rng.integers(-size, size + 1, (11, dimensions))
        a[0], b[0], b[1] = size, size, -size
        primes = hard_negatives.primes_for(dimensions * size * size)
        got = hard_negatives.exact_scores([hard_negatives.residues(a, p) for p in primes], [hard_negatives.residues(b, p) for p in primes], primes)
        assert (got == a @ b.T).all()
    with pytest.raises(ValueError):
        hard_negatives.primes_for(1 << 63)


def brute_clusters(rows, dimensions, clusters, rounds):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centers = [v for _, v in sorted(kept, key=mark)[:clusters]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(centers))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        centers = [
            [sum(col) // len(col) for col in zip(*(v for (_, v), a in zip(kept, at) if a == k))] if k in at else c for k, c in enumerate(centers)
        ]
    found = [(i, *near(v)) for i, v in kept]
    return sorted(
        (
            (i, k, d, sum(x[1] for x in found if x[2] == k), sum(x[1] for x in found), hashlib.sha256(",".join(map(str, centers[k])).encode()).hexdigest())
            for i, d, k in found
        ),
        key=str,
    )


@pytest.mark.parametrize("clusters", [5, 400])
def test_centroid_clusters(spark, vectors, clusters):
    df = frame(spark, vectors if clusters == 5 else vectors[:6] + vectors[90:94])
    out = centroids.with_centroid_sha(centroids.cluster_vectors(df, dimensions=6, clusters=clusters, rounds=3))
    rows = vectors if clusters == 5 else vectors[:6] + vectors[90:94]
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(tuple, out.select(*names).collect()), key=str) == brute_clusters(rows, 6, clusters, 3)
    if clusters == 5:
        assert centroids.cluster_vectors(df.limit(0)).count() == 0 and centroids.cluster_vectors(df, dimensions=7).count() == 0
        with pytest.raises(ValueError):
            centroids.cluster_vectors(frame(spark, [(1, [1e9] * 6, 0)]), dimensions=6)


def base_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(wins)
    again = {i + j for i, x in enumerate(wins) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return w, (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def grams(w, buckets):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    ones = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    chain = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    return [signed(x) % buckets for x in ones + [chain(a, b) for a, b in zip(ones, ones[1:])]]


def test_quality_rules(spark):
    rng = random.Random(8)
    good, bad = [f"w{k}é" for k in range(40)], [f"#{k}|" for k in range(40)]
    texts = [" ".join(rng.choices(good, k=rng.randint(40, 120))) for _ in range(40)]
    texts += [" \n".join(rng.choices(bad, k=rng.randint(60, 90))) for _ in range(12)]
    texts += [None, "", " \t\n\x0b\x0c\r ", "a", "a b", "a b c", "a b c a b c", "x " * 300, "l one\nl one\n\n\nl one \n" * 9, " q r s", texts[3] + "\n" + texts[3]]
    texts.append(" ".join(rng.choices(good, k=20_000)))
    ids = [None if k == 5 else k - (k == 9) for k in range(len(texts))]
    rows = [(i, t, *[k] * 6) for k, (i, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words long, ones long, raw long, t_id long, kept long, bucket long").repartition(3)
    labels = [(i, int(k < 40), None if k % 2 else 0) for k, i in enumerate(ids) if k % 3] + [(1, 1, 1), (None, 1, 0), (2, None, None), (4, 1, 0), (4, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    buckets = 512
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic and r.doc_id is not None}
    raw, target, every = [0] * buckets, [0] * buckets, []
    for i, t in zip(ids, texts):
        g = grams(base_counts(t)[0], buckets)
        every.append(g)
        for b in g:
            raw[b] += 1
            target[b] += i in trusted
    weight = [
        round(math.log((t + 1) / (sum(target) + buckets) * (sum(raw) + buckets) / (r + 1)) * 65536) if r else 0 for r, t in zip(raw, target)
    ]
    want = []
    for i, t, g in zip(ids, texts, every):
        counts = base_counts(t)[1]
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        total = sum(weight[b] for b in g)
        want.append((i, *counts, failed, not failed and total >= round(quality_rules.LEAST_RATIO * 65536) * len(g), len(g), total / (len(g) * 65536) if g else 0.0))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_grams", "ratio")
    out = quality_rules.score_quality(docs, labels, buckets=buckets)
    assert sorted(map(tuple, out.select(*names).collect()), key=str) == sorted(want, key=str)
    assert {w[7] for w in want[40:52]} == {False} and sum(w[7] for w in want[:40]) > 25
    # without trusted documents the base rules alone decide
    alone = quality_rules.score_quality(docs, labels.limit(0), buckets=buckets)
    assert all(r.kept == (not r.base_failed) and r.ratio == 0 for r in alone.collect())
    assert quality_rules.score_quality(docs.limit(0), labels).count() == 0
    few = quality_rules.trusted_ids(labels, 5).collect()
    assert len(few) == 5 and {r.t_id for r in few} <= trusted


def test_quality_separates_labels(spark):
    """On the given table the verdict agrees with the labels, and good documents stay."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    out = quality_rules.score_quality(docs, labels).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in out if r.quality == 1], [r.kept for r in out if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)
