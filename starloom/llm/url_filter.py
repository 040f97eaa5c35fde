"""URL rules as a bit-parallel wildcard automaton.

All glob rules are packed into one bit vector of several 64-bit words.  Reading
a character moves every rule at once (Shift-And): a shift, a mask of the places
where the character fits, and a mask of the wildcards that may swallow it.  A
batch of addresses is read side by side, one character of each per step.

In a glob, ``*`` stands for any run without ``/``, ``**`` for any run, ``?`` for
one character other than ``/``; all else stands for itself.  A rule fits an
address as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import UPPER, arrow_map

# Fixed rules of the query: verdict, host, start of the path.
SITE_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# The method's own rules, for addresses that no site rule fits: advertising, trackers, logins, binaries.
BLOCK_GLOBS = ["*.ads.*/**", "*.doubleclick.*/**", "**/ads/**", "**/track?ng/**", "**/wp-login.php", "**/login", "**/signin", "**.exe", "**.zip", "**.apk"]

_SLASH = ord("/")


@dataclass
class GlobSet:
    """Masks of a list of globs: ``fits`` and ``loops`` per byte, ``start`` and the end bit of each glob."""

    fits: np.ndarray
    loops: np.ndarray
    start: np.ndarray
    ends: np.ndarray


def compile_globs(globs: list[str]) -> GlobSet:
    """Lay the globs one after another; each takes one bit more than it has single characters."""
    bits: list[tuple[object, set]] = []  # what enters the place, which runs it may swallow
    starts, ends = [], []
    for g in globs:
        raw = g.encode()
        starts.append(len(bits))
        bits.append((None, set()))
        i = 0
        while i < len(raw):
            if raw[i : i + 2] == b"**":
                bits[-1][1].add("any")
                i += 2
            elif raw[i : i + 1] == b"*":
                bits[-1][1].add("part")
                i += 1
            else:
                bits.append((raw[i], set()))
                i += 1
        ends.append(len(bits) - 1)
    words = max(1, -(-len(bits) // 64))
    fits, loops = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    start = np.zeros(words, np.uint64)
    for s in starts:
        start[s >> 6] |= np.uint64(1 << (s & 63))
    for k, (enters, runs) in enumerate(bits):
        w, one = k >> 6, np.uint64(1 << (k & 63))
        if enters == ord("?"):
            fits[:, w] |= one
            fits[_SLASH, w] &= ~one
        elif enters is not None:
            fits[enters, w] |= one
        if "any" in runs:
            loops[:, w] |= one
        elif "part" in runs:
            loops[:, w] |= one
            loops[_SLASH, w] &= ~one
    return GlobSet(fits, loops, start, np.array(ends, np.int64))


def match_globs(g: GlobSet, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Boolean matrix (strings, globs).  ``data`` holds the bytes of all strings, ``offsets`` their bounds."""
    lens = np.diff(offsets)
    order = np.argsort(-lens, kind="stable")
    begin, sizes = offsets[:-1][order], lens[order]
    state = np.repeat(g.start[None, :], len(lens), axis=0)
    one, top = np.uint64(1), np.uint64(63)
    live, t = len(sizes), 0
    while True:
        live = int(np.searchsorted(-sizes[:live], -t, side="left")) if live else 0
        if not live:
            break
        c = data[begin[:live] + t]
        d = state[:live]
        moved = d << one
        if moved.shape[1] > 1:
            moved[:, 1:] |= d[:, :-1] >> top
        state[:live] = (moved & g.fits[c]) | (d & g.loops[c])
        t += 1
    out = np.empty((len(lens), len(g.ends)), bool)
    for k, e in enumerate(g.ends):
        out[order, k] = (state[:, e >> 6] >> np.uint64(e & 63)) & one > 0
    return out


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    page_id: str = "page_id",
    site_rules: list[tuple[str, str, str]] = SITE_RULES,
    block_globs: list[str] = BLOCK_GLOBS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, own_rule.

    host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; path is the rest up to ``?``, ``#`` or the end.  Null, or no
    ``://``, gives both empty.  ``rule`` is the longest site rule that fits (of
    equal length, the first in the list), ``own_rule`` the first of the method's own
    rules that fits; the verdict is the site rule's, else block where one
    fits, else allow.  Repeated rows are judged alike; an empty table gives an
    empty table.
    """
    address = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.translate(F.regexp_extract(address, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower()).alias("host"),
        F.regexp_extract(address, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )
    # a leading dot stands before every host, so "*.net" fits net itself and all below it
    ranked = sorted(site_rules, key=lambda r: -len(r[1] + r[2]))
    globs = [f"*.{host}{path}**" for _, host, path in ranked] + list(block_globs)
    masks, n = compile_globs(globs), len(ranked)
    names = np.array([host + path for _, host, path in ranked] + [None], object)
    verdicts = np.array([v for v, _, _ in ranked] + [None], object)
    own = np.array([*block_globs, None], object)

    def judge(b: pa.RecordBatch) -> pa.RecordBatch:
        host, path = b.column("host").to_pylist(), b.column("path").to_pylist()
        full = [f".{h}{p}".encode() for h, p in zip(host, path)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in full])]).astype(np.int64)
        hit = match_globs(masks, np.frombuffer(b"".join(full), np.uint8), offsets)
        site = np.where(hit[:, :n].any(axis=1), hit[:, :n].argmax(axis=1) if n else 0, n)
        more = hit[:, n:]
        glob = np.where(more.any(axis=1), more.argmax(axis=1) if more.shape[1] else 0, len(block_globs))
        rule, said, why = names[site], verdicts[site], own[glob]
        verdict = [v or ("block" if w else "allow") for v, w in zip(said, why)]
        return pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("host"), b.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(why, pa.string())],
            ["page_id", "host", "path", "rule", "verdict", "own_rule"],
        )

    kind = rows.schema["page_id"].dataType
    return arrow_map(rows, judge, [("page_id", kind), *[(n, "string") for n in ("host", "path", "rule", "verdict", "own_rule")]])
