"""Operators on small hostile inputs: nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""

import random
import time
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from starloom.llm import decontam, exact_dedup, language_id, license_scan, packing, sharding, simhash, substrings, token_counts, url_filter
from starloom.llm.suffix import permuted_lcp, suffix_array

SYLLABLES = ["ti", "wh", "énn", "dst", "onn", "dble", "es", "th", "x"]
# names that the operators use inside
CLASH = "doc_id long, text string, lang string, source string, n_chars long, row int, sha string, fp long, hits int, items int, part int, ord int, gone_id long, maybe int, pack int"


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    passage, out = prose(rng, 40), []
    for _ in range(90):
        t, r = rng.choice(base), rng.random()
        if r < 0.25:
            k = rng.randint(0, len(t))
            t = t[:k] + "Q" + t[k + 1 :]
        elif r < 0.4:
            t = prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 9)
        elif r < 0.5:
            t = rng.choice([None, "", " \t\n", "é", "a" * 100, "A" * 100, "ab" * 90, "1234 !!"])
        elif r < 0.55:
            t = t.upper()
        out.append(t)
    return out + [prose(rng, 20_000)]


@pytest.fixture(scope="module")
def rows(texts):
    """(id, text): ids with gaps, a null id, a repeated row, an id with two texts."""
    plain = [(7 * i - 40, t) for i, t in enumerate(texts)]
    return plain + [(None, texts[3]), (None, None), plain[5], (plain[6][0], "another text with the same id")]


def frame(spark, rows, sources=("a", "a", None, "b", "c")):
    wide = [(i, t, None if k % 5 == 0 else "en", sources[k % len(sources)], None, k, None, k, k, k, k, k, k, k, k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, CLASH).repartition(3)


def empty(spark):
    return spark.createDataFrame([], CLASH)


def got(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_exact_duplicates(spark, rows):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(exact_dedup.exact_duplicates(frame(spark, rows)), *names) == brute.exact(rows)
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0
    # a filter so small that all rows look repeated changes nothing
    assert got(exact_dedup.exact_duplicates(frame(spark, rows), bits=32768, hashes=1), *names) == brute.exact(rows)


def test_drop_exact_duplicates(spark, rows):
    df = frame(spark, rows)
    out = exact_dedup.drop_exact_duplicates(df)
    assert out.columns == df.columns
    kept = sorted(((i, s) for i, _, _, k, s in brute.exact(rows) if k), key=str)
    assert sorted(((r.doc_id, brute.sha(brute.fold(r.text))) for r in out.collect()), key=str) == kept
    assert exact_dedup.drop_exact_duplicates(empty(spark)).count() == 0


def test_filter_clears_unique_rows(spark):
    """The first pass finds nearly all unique rows, so few rows shuffle."""
    df = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 19000 AS string) AS text")
    slim = exact_dedup.keyed(df)
    flagged = exact_dedup.flag_possible(slim, exact_dedup.repeated_bits(slim))
    assert 2000 <= flagged.where("maybe").count() <= 2050


def test_near_duplicates(spark, rows):
    rows = [(i, t) for i, t in rows if i is not None]
    out = simhash.near_duplicates(frame(spark, rows))
    prints = [brute.simhash(t, 4) for _, t in rows]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, brute.linked([i for i, _ in rows], prints, 4))]
    assert got(out, "doc_id", "fingerprint", "component_id") == sorted(want, key=str)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    nulls = simhash.near_duplicates(frame(spark, [(None, "one text"), (None, "one text")]))
    assert [r.component_id for r in nulls.collect()] == [None, None]


@pytest.mark.parametrize("bucket_rows", [2000, 3])
def test_links_of_close_fingerprints(spark, bucket_rows):
    """Planted pairs at each distance, a large group around one fingerprint, and small buckets."""
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        q = p
        for b in rng.sample(range(64), rng.randint(1, 6)):
            q ^= 1 << b
        prints.add(q)
    center = rng.getrandbits(64)
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(0, 64, 4) for b in range(1, 64, 7)} | {0}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash.signed(p), simhash.signed(p)) for p in prints], "node long, fp long")
    links = simhash.fingerprint_links(df, bucket_rows=bucket_rows)
    found = {r.node: r.component for r in simhash.components(links).collect()}
    ids = [simhash.signed(p) for p in prints]
    assert [found.get(i, i) for i in ids] == brute.linked(ids, prints, 4)


def test_forest_connects_all_close_pairs():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    fp[200:] = fp[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    fp[50:80] = fp[0] ^ (np.uint64(1) << np.arange(30, dtype=np.uint64))
    bucket = np.repeat([0, 1], 200)
    i, j = simhash.close_forest(bucket, fp, simhash.reference_points(16), 4)
    assert all(int(fp[a] ^ fp[b]).bit_count() <= 4 and bucket[a] == bucket[b] for a, b in zip(i, j))
    for k in (0, 200):
        part = [int(x) for x in fp[k : k + 200]]
        want = brute.linked(list(range(200)), part, 4)
        least = list(range(200))
        links = [(a - k, b - k) for a, b in zip(i.tolist(), j.tolist()) if k <= a < k + 200]
        assert len(links) == 200 - len(set(want))
        for a, b in links:
            least = [min(least[a], least[b]) if g in (least[a], least[b]) else g for g in least]
        assert least == want


def test_many_close_fingerprints_take_little_memory():
    """20 000 fingerprints within 4 bits of each other hold 2e8 close pairs; the forest has one link fewer than rows."""
    import tracemalloc

    rng = np.random.default_rng(2)
    fp = np.unique([sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(9000)]).astype(np.uint64)
    fp = np.unique(np.concatenate([fp, *[fp ^ np.uint64(1 << k) for k in range(0, 64, 6)]]))[:20_000]
    near = fp[np.bitwise_count(fp) <= 2]
    tracemalloc.start()
    i, j = simhash.close_forest(np.zeros(len(fp), np.int64), fp, simhash.reference_points(16), 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(near) * (len(near) - 1) // 2 > 1_000_000 and len(i) == len(fp) - 1
    assert peak < 100e6


def test_large_buckets_are_split(spark):
    df = spark.createDataFrame([(k, k, k % 2) for k in range(100)], "node long, fp long, bucket long")
    sizes = df.groupBy("bucket").count().withColumnRenamed("count", "n")
    groups = {}
    for r in simhash.split_buckets(df, sizes, 10).collect():
        groups.setdefault(r.bucket, []).append(r.node)
    assert max(map(len, groups.values())) < 50
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    assert met == {(a, b) for a in range(100) for b in range(a + 2, 100, 2)}


def one_per_component(rows):
    """Of (id, text) rows the one with the smallest id of each SimHash component; null ids last."""
    ids = list(range(len(rows)))
    groups = brute.linked(ids, [brute.simhash(t, 4) for _, t in rows], 4)
    best = {}
    for g, (i, t) in zip(groups, rows):
        best[g] = min(best.get(g, (i, t)), (i, t), key=lambda r: (r[0] is None, r[0] or 0))
    return sorted(best.values(), key=str)


def test_drop_near_duplicates(spark):
    rng = random.Random(5)
    base = [prose(rng, 300) for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k, t in enumerate(base[:6]):
        w = t.split()
        w[70] = "changed"
        rows.append((100 + k, " ".join(w)))
    # one large group, repeated rows, an id that texts share, null ids
    rows += [(200 + k, base[0] + f" tail{k}") for k in range(40)]
    rows += [(None, base[1]), (500, None), (501, ""), (3, base[3]), (3, base[3]), (None, base[7] + " x"), (None, prose(rng, 90)), (0, prose(rng, 90))]
    df = frame(spark, rows)
    for bits in (1 << 27, 32768):
        out = simhash.drop_near_duplicates(df, bits=bits)
        assert out.columns == df.columns
        assert got(out, "doc_id", "text") == one_per_component(rows)
    assert len(one_per_component(rows)) < 22
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_sharding_by_rows(spark, rows):
    out = sharding.consistent_shards(frame(spark, rows), 7).collect()
    counts = Counter(r.shard for r in out)
    assert len(out) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=str) == want
    assert sharding.consistent_shards(empty(spark), 7).count() == 0


def test_overflow_walks_clockwise():
    points = sharding.ring_points(5, 8)
    rng = random.Random(2)
    for slack in (0.0, 0.25):
        counts = {a: rng.randint(0, 30) for a in range(len(points))}
        total = sum(counts.values())
        room = sharding.bounds(total, 5, slack)
        plan = sharding.overflow_plan(counts, points, room)
        # every rank of every arc has one place, no shard is over its bound
        for a, n in counts.items():
            parts = sorted((lo, hi) for arc, lo, hi, _, _ in plan if arc == a)
            assert sum(hi - lo for lo, hi in parts) == n and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
        load = Counter()
        for _, lo, hi, s, base in plan:
            load[s] += hi - lo
        assert all(load[s] <= room[s] for s in range(5))


def test_little_moves_when_a_shard_is_added(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'x' AS text")
    a = {r.doc_id: r.home_shard for r in sharding.consistent_shards(df, 10, slack=0.1).collect()}
    b = {r.doc_id: r.home_shard for r in sharding.consistent_shards(df, 11, slack=0.1).collect()}
    assert all(b[i] in (a[i], 10) for i in a)


def brute_tokens(model, text):
    if not text:
        return 0
    s = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0)]
    for e in range(1, len(s) + 1):
        options = []
        for b in range(max(0, e - model.longest), e):
            if s[b:e] in model.scores:
                options.append((best[b][0] + model.scores[s[b:e]], -(best[b][1] + 1)))
        if s[e - 1] not in model.scores:
            n = len(s[e - 1].encode())
            options.append((best[e - 1][0] + n * model.unknown, -(best[e - 1][1] + n)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_token_counts(spark, rows, monkeypatch):
    model = token_counts.load_pieces()
    some = [(i, t[:600] if t else t) for i, t in rows] + [(900, "日本 語  \n two  spaces "), (901, " ")]
    want = sorted(((i, brute_tokens(model, t)) for i, t in some), key=str)
    assert got(token_counts.count_tokens(frame(spark, some), model), "doc_id", "n_tokens") == want
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 500)
    assert got(token_counts.count_tokens(frame(spark, some), model), "doc_id", "n_tokens") == want
    assert token_counts.count_tokens(empty(spark), model).count() == 0


def test_best_fit_agrees_with_a_scan():
    rng = random.Random(4)
    for _ in range(30):
        n = rng.randint(0, 60)
        sizes = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
        sources = [rng.choice(["a", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.choice([1, 2, 3, 4, 5, None]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 50) == brute.best_fit(sizes, sources, clusters, 50)


def test_packing(spark, rows):
    out = packing.pack(frame(spark, rows), capacity=300, group_docs=40).collect()
    assert sum(r.piece_size for r in out) == sum(len((t or "").encode()) + 1 for _, t in rows)
    bins = {}
    for r in out:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert b[0].bin_offset == 0 and sum(r.piece_size for r in b) <= 300
        assert all(x.bin_offset + x.piece_size == y.bin_offset for x, y in zip(b, b[1:]))
    source = {i: ("a", "a", None, "b", "c")[k % 5] for k, (i, _) in enumerate(rows) if i is not None and [x for x, _ in rows].count(i) == 1}
    text = {i: brute.fold(t) for i, t in rows}
    for b in bins.values():
        known = [r.doc_id for r in b if r.doc_id in source]
        named = [source[i] for i in known if source[i]]
        assert len(named) == len(set(named))
        assert len({text[i] for i in known}) == len(known)
    assert packing.pack(empty(spark)).count() == 0


def test_language(spark):
    rng = random.Random(1)
    speech = {"xx": ["alpha", "beta", "gamma", "delta"], "yy": ["omikron", "sigma", "tau", "ypsilon"], "zz": ["ñandú", "año", "niño", "mañana"]}
    rows = [(k, " ".join(rng.choices(speech[l], k=30)), l) for k, l in enumerate(["xx", "yy", "zz"] * 20)]
    odd = [(100, None, "xx"), (101, "", "xx"), (102, "123 !!", None), (103, "alpha " * 5000, None), (None, "tau sigma tau", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "1 AS row", "'q' AS lang_pred", "0 AS score")
    out = language_id.identify(df).selectExpr("row.doc_id AS doc_id", "lang_pred", "score", "held_out").collect()
    pred = {r.doc_id: r.lang_pred for r in out}
    assert all(pred[k] == l for k, _, l in rows)
    assert [pred[k] for k in (100, 101, 102, 103, None)] == ["und", "und", "und", "xx", "yy"]
    assert all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert language_id.identify(df.limit(0)).count() == 0
    # nothing labelled: nothing can be told
    assert {r.lang_pred for r in language_id.identify(df.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()} == {"und"}


def test_cross_parsing_counts_longest_phrases():
    model = language_id.Model({"a": "abracadabra", "b": "banana band"})
    docs = ["abrabandana", "", "zzz", "ban ban", "abracadabrabanana"]
    codes = [model.code_of[np.frombuffer(d.encode("utf-32-le"), np.uint32)] for d in docs]

    def phrases(text, source):
        n, i = 0, 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in source:
                k += 1
            n, i = n + 1, i + k
        return n

    want = [[phrases(d, s) for s in ("abracadabra", "banana band")] for d in docs]
    assert language_id.parse(model, codes).tolist() == want


def test_languages_of_all_scripts_are_parsed_by_their_own_letters():
    """Many Latin letters beside small scripts: each character counts, above 0x3000 too."""
    rng = random.Random(31)
    letters = {
        "la": [chr(c) for c in range(0xE0, 0x17F)], "ru": list("абвгдежзийклмнопрстуфхцчшщъыьэюя"), "uk": list("абвгґдеєжзиіїйклмнопрстуфхцчшщьюя"),
        "ja": [chr(c) for c in range(0x3041, 0x3097)] + [chr(c) for c in range(0x4E00, 0x4F00, 2)], "zh": [chr(c) for c in range(0x4E00, 0x5000)],
        "ko": [chr(c) for c in range(0xAC00, 0xAD00)], "go": [chr(c) for c in range(0x10330, 0x1034A)],
    }
    texts = {k: " ".join("".join(rng.choices(v, k=rng.randint(1, 6))) for _ in range(5000 if k == "la" else 120)) for k, v in letters.items()}
    model = language_id.Model(texts)
    docs = [(k, t[i : i + 60] + "ξ" + t[i + 40 : i + 45]) for k, t in texts.items() for i in (0, 100, 301)]
    codes = [model.code_of[np.frombuffer(d.encode("utf-32-le"), np.uint32)] for _, d in docs]
    source = {k: "".join(map(language_id.fold, t)) for k, t in texts.items()}

    def phrases(text, learned):
        text, n, i = "".join(map(language_id.fold, text)), 0, 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in learned:
                k += 1
            n, i = n + 1, i + k
        return n

    got = language_id.parse(model, codes)
    assert got.tolist() == [[phrases(d, source[k]) for k in model.languages] for _, d in docs]
    assert [model.languages[i] for i in got.argmin(axis=1)] == [k for k, _ in docs]
    assert len(np.unique(model.code_of[[ord(c) for c in source["ja"]]])) == len(set(source["ja"]))


def test_licenses(spark, rows):
    extra = [
        (900, "The GNU General-Public License, v3; GNU General Public License"), (901, "licensed under the Apache Licence"),
        (902, "gnu genral publc license"), (903, "cc by. CC BY cc by by"), (904, "admit license mit licenses"), (905, "x " * 30_000 + "MIT License"),
    ]
    out = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, extra)).collect()}
    a = out[900]
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (10, 2, 1, 6, "gpl")
    assert (out[901].n_base, out[901].first_word, out[901].labels, out[901].base_labels) == (0, None, "apache-like", "")
    assert out[902].labels == "gpl-like" and 0.9 < out[902].score < 1
    assert (out[903].n_base, out[903].last_word) == (3, 4)
    assert out[904].n_base == 0 and (out[905].n_words, out[905].first_word) == (30_002, 30_000)
    assert {(s.start, s.end, s.edits) for s in out[901].spans if s.label == "apache-like"} >= {(19, 33, 1)}
    plain = got(license_scan.scan_licenses(frame(spark, rows)), "doc_id", "n_words", "n_base")
    assert plain == sorted(((i, len(brute.words(t)), 0) for i, t in rows), key=str)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def distances(notice, text):
    """For each end in ``text`` the least edits of the notice against any part that ends there, and the longest such part's start (Sellers)."""
    row = [(0, j) for j in range(len(text) + 1)]
    for c in notice:
        new = [(row[0][0] + 1, 0)]
        for j, d in enumerate(text, 1):
            new.append(min((row[j - 1][0] + (c != d), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    return row


def test_all_spans_of_neighbouring_notices():
    """Every part of a text within the edits of a notice meets a span of it, and every span is within its edits."""
    rng = random.Random(12)
    notices = license_scan.compile_notices([("apache license", "a", 1), ("gnu general public license", "g", 3), ("mit license", "m", 1)])
    texts = [b" apache licence apache license ", b" mit licence mit license mitlicense ", b" apache license apache license apache licens "]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            t = list(rng.choice(["apache license", "gnu general public license", "mit license", "of the", "licens"]))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(t))
                t[k] = rng.choice(["", "x", t[k] + "y", " "])
            parts.append("".join(t))
        texts.append((" " + " ".join(parts) + " ").encode())
    found = 0
    for flat in texts:
        for notice in notices:
            text, edits = {"a": b"apache license", "g": b"gnu general public license", "m": b"mit license"}[notice[2]], notice[3]
            spans = license_scan.fuzzy_spans(flat, notice)
            assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
            for a, b, n in spans:
                assert n <= edits and min(d for d, _ in distances(text, flat[max(0, a - 1) : b + 1])) <= n
            for end, (d, start) in enumerate(distances(text, flat)):
                assert d > edits or any(a < end and start < b for a, b, _ in spans), (flat, notice[2], start, end, spans)
            found += len(spans)
    assert found > 80
    assert [x[:2] for x in license_scan.fuzzy_spans(texts[0], notices[0])] == [(1, 15), (16, 30)]


def test_urls(spark):
    urls = {
        "http://example.net/en/1": ("block-or-allow", "example.net/en/", "allow"),
        "https://A.Example.NET/de/x?y=/en/": (None, "net/", "block"),
        "http://badexample.net": (None, None, "allow"),
        "http://notnet/": (None, None, "allow"),
        "ftp://www.example.com/de/": (None, "example.com/de/", "block"),
        "http://x.org/fr/": (None, "org/fr/", "allow"),
        "http://x.org/frx": (None, None, "allow"),
        "http://b.io/a.net/": (None, None, "allow"),
        "http://b.io/z/ads/1": (None, None, "block"),
        "http://net/": (None, "net/", "block"),
        "no scheme": (None, None, "allow"),
        None: (None, None, "allow"),
        "http://h.io#/ads/": (None, None, "allow"),
        "http://long.io/" + "a/" * 5000 + "setup.exe": (None, None, "block"),
    }
    df = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    out = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    for k, (_, rule, verdict) in enumerate(urls.values()):
        assert (out[k].rule, out[k].verdict) == (rule, verdict), list(urls)[k]
    assert (out[1].host, out[1].path) == ("a.example.net", "/de/x")
    assert (out[10].host, out[10].path, out[11].host) == ("", "", "")
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_globs_agree_with_patterns():
    import re

    rng = random.Random(6)
    globs = ["".join(rng.choices(["a", "b", "/", "*", "**", "?"], k=rng.randint(1, 7))) for _ in range(60)]
    texts = ["".join(rng.choices("ab/", k=rng.randint(0, 9))) for _ in range(200)]

    def pattern(g):
        out = re.sub(r"\*\*|\*|\?", lambda m: {"**": ".*", "*": "[^/]*", "?": "[^/]"}[m[0]], g)
        return re.compile(out + r"\Z", re.S)

    offsets = np.cumsum([0, *map(len, texts)])
    hit = url_filter.match_globs(url_filter.compile_globs(globs), np.frombuffer("".join(texts).encode(), np.uint8), offsets)
    assert hit.tolist() == [[bool(pattern(g).match(t)) for g in globs] for t in texts]


def longest_common(w, items, window=10):
    """Per item id (length, start, item start) of the longest run of words in both, if it holds a window."""
    out = {}
    for i, t in items:
        v, best = brute.words(t), None
        run = [0] * (len(v) + 1)
        for a, x in enumerate(w):
            run = [0] + [run[b] + 1 if x == y else 0 for b, y in enumerate(v)]
            for b, n in enumerate(run):
                if n >= min(window, max(1, len(v))):
                    key = (-n, a + 1 - n, b - n)
                    best = min(best or key, key)
        if best:
            out["null" if i is None else str(i)] = (-best[0], best[1], best[2])
    return out


def test_many_equal_rows_pack_in_bounded_time(spark):
    """100 000 equal rows: no two share a bin, and no group takes them all."""
    df = spark.range(100_000).selectExpr("cast(null as long) AS doc_id", "'' AS text", "cast(null as string) AS source").repartition(4)
    out = packing.pack(df)
    per_group = out.groupBy((packing.F.col("bin_id") / (1 << 32)).cast("long")).count().agg(packing.F.max("count"), packing.F.sum("count")).first()
    assert per_group[0] < 2 * packing.GROUP_DOCS and per_group[1] == 100_000
    assert out.select("bin_id").distinct().count() == 100_000
    # one group of equal items needs no scan of the bins
    t0 = time.perf_counter()
    placed = packing.best_fit([1] * 20_000, [None] * 20_000, [7] * 20_000, 8192)
    assert len({k for k, _ in placed}) == 20_000 and time.perf_counter() - t0 < 5


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_decontamination(spark, rows, texts, block_bytes):
    items = [(1, " ".join((texts[-1].split())[50:70])), (20, "énnti"), (3, texts[40]), (4, None), (5, ""), (6, "ti wh"), (11, texts[-1][:300]), (None, texts[2])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = brute.windows([("null" if i is None else i, t) for i, t in items])
    want = []
    for i, t in rows:
        w, hit, own = brute.hits(t, wins)
        want.append((i, len(w), sum(hit), len(own), brute.sha(",".join(own).encode()), any(hit)))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    df = frame(spark, rows)
    assert got(decontam.decontaminate(df, bench, block_bytes=block_bytes), *names) == sorted(want, key=str)
    matches = {str(r.doc_id) + str(r.n_words): r for r in decontam.decontaminate(df, bench, block_bytes=block_bytes).collect()}
    for i, t in rows:
        w, r = brute.words(t), matches[str(i) + str(len(brute.words(t)))]
        assert {m.item: (m.length, m.start, m.item_start) for m in r.matches} == longest_common(w, items)
        assert r.longest == max([m.length for m in r.matches], default=0)
    kept = decontam.drop_contaminated(df, bench, block_bytes=block_bytes)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(x[0]) for x in want if not x[5])
    assert decontam.decontaminate(empty(spark), bench).count() == 0
    assert got(decontam.decontaminate(df, bench.limit(0)), "n_hit") == [(0,)] * len(rows)


def test_suffix_arrays(monkeypatch):
    from starloom.llm import suffix

    rng = np.random.default_rng(1)
    for trial in range(120):
        monkeypatch.setattr(suffix, "MOST_BUCKETS", 300 if trial % 2 else 2)
        k = int(rng.integers(1, 5))
        t = rng.integers(1, k + 1, int(rng.integers(1, 50)))
        t = np.concatenate([np.tile(t, 3) if trial % 3 == 0 else t, [0]]).astype(np.uint16)
        array = suffix_array(t, k + 1, 1000)
        assert array.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        room = np.arange(len(t), 0, -1)
        common = permuted_lcp(t, array, room)
        for a, b in zip(array[1:], array[:-1]):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert common[a] == n


@pytest.mark.parametrize("hot,odd", [(20_000, True), (2, False)])
def test_repeated_passages(spark, rows, hot, odd):
    rows = rows if odd else [(i, t) for k, (i, t) in enumerate(rows) if i is not None and i not in [x for x, _ in rows[:k]]]
    rows = rows[:-1] if not odd else rows
    out = substrings.remove_repeats(frame(spark, rows), hot=hot, with_text=True)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(rows)
    for r in out.where("kept is not null").collect():
        assert brute.sha(bytes(r.kept)) == r.kept_sha256
    assert substrings.remove_repeats(empty(spark)).count() == 0
