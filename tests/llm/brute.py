"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

import xxhash

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def fold(text):
    return (text or "").encode().translate(FOLD)


def words(text):
    return WORD.findall(fold(text))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def exact(rows):
    """rows (id, text) -> sorted (id, keep, size, kept, sha); equal rows share one keep."""
    groups = {}
    for i, t in rows:
        groups.setdefault(fold(t), []).append(i)
    key = lambda v: (v is not None, v or 0)
    out = []
    for raw, ids in groups.items():
        ids.sort(key=key)
        for n, i in enumerate(ids):
            out.append((i, ids[-1], len(ids), n == len(ids) - 1, sha(raw)))
    return sorted(out, key=str)


def shingles(text, n):
    w = BLANK.findall(fold(text))
    return [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def simhash(text, n, distinct=False):
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, n)]
    h = set(h) if distinct else h
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(ids, prints, bits):
    """Smallest id reachable from each."""
    least = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = least[a], least[b]
                if x != y:
                    least = [min(x, y) if v in (x, y) else v for v in least]
    names = {}
    for i, g in zip(ids, least):
        names[g] = min(names.get(g, i), i)
    return [names[g] for g in least]


def windows(items, n=10):
    out = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            out.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    return out


def hits(text, wins):
    w, owners = words(text), set()
    hit = [False] * len(w)
    for size in {len(k) for k in wins}:
        for k in range(len(w) - size + 1):
            own = wins.get(tuple(w[k : k + size]))
            if own:
                hit[k : k + size] = [True] * size
                owners |= own
    return w, hit, sorted(owners)


def repeats(rows, size=100):
    """rows (id, text) -> sorted (id, bytes, removed, spans, sha)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, sha((rows[k][1] or "").encode())))
    seen, out = set(), []
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - size + 1):
            if raw[p : p + size] in seen:
                gone[p : p + size] = [True] * size
            seen.add(raw[p : p + size])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((rows[k][0], len(raw), sum(gone), spans, sha(kept)))
    return sorted(out, key=str)


def best_fit(sizes, sources, clusters, capacity):
    """Scan of all bins for the fullest compatible one, the oldest of equals."""
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fit = [
            (b["room"], k) for k, b in enumerate(bins)
            if b["room"] >= size and (s is None or s not in b["s"]) and (c is None or c not in b["c"])
        ]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append({"room": capacity, "s": set(), "c": set()})
        b = bins[k]
        out.append((k, capacity - b["room"]))
        b["room"] -= size
        b["s"].add(s)
        b["c"].add(c)
    return out
