"""License phrases in texts: exact places, and misspelt notices by bounded-error search.

Exact phrases are found as runs of whole words.  For notices with a few wrong
letters, a notice with ``k`` allowed edits is split into ``k + 1`` pieces: at
least one piece must occur unharmed (pigeonhole).  Plain searches for the pieces
give the candidate places; around each, the ``regex`` library's bounded-error
matching verifies the edits and reports the span.
"""

from __future__ import annotations

import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map

# Fixed phrases and labels of the base scan.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# The method's own notices: words of the text, label, edits allowed (insertions, deletions, substitutions together).
# Phrases of the licenses themselves.
NOTICES = [
    ("gnu general public license", "gpl-like", 3),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl-like", 6),
    ("this program is distributed in the hope that it will be useful but without any warranty", "gpl-like", 6),
    ("gnu lesser general public license", "lgpl-like", 3),
    ("gnu affero general public license", "agpl-like", 3),
    ("apache license", "apache-like", 1),
    ("licensed under the apache license version 2 0", "apache-like", 4),
    ("you may not use this file except in compliance with the license", "apache-like", 5),
    ("mit license", "mit-like", 1),
    ("permission is hereby granted free of charge", "mit-like", 4),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit-like", 8),
    ("mozilla public license", "mpl-like", 2),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-like", 5),
    ("creative commons attribution", "cc-by-like", 3),
    ("redistribution and use in source and binary forms", "bsd-like", 4),
    ("redistributions of source code must retain the above copyright notice", "bsd-like", 5),
    ("eclipse public license", "epl-like", 2),
    ("permission to use copy modify and or distribute this software for any purpose", "isc-like", 6),
    ("this is free and unencumbered software released into the public domain", "unlicense-like", 5),
    ("all rights reserved", "reserved-like", 2),
]

# Every ASCII byte that is neither digit nor letter separates words; A-Z are folded.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def pieces(notice: str, edits: int) -> list[tuple[bytes, int]]:
    """``edits + 1`` consecutive pieces of a notice with their starts."""
    raw, n = notice.encode(), edits + 1
    cuts = [len(raw) * i // n for i in range(n + 1)]
    return [(raw[a:b], a) for a, b in zip(cuts, cuts[1:])]


def compile_notices(notices: list[tuple[str, str, int]]) -> list[tuple[list[tuple[bytes, int]], str, str, int, int]]:
    """Per notice: pieces, pattern source, label, edits, length."""
    out = []
    for text, label, edits in notices:
        if not text or edits >= len(text):
            raise ValueError("a notice must be longer than its edits")
        out.append((pieces(text, edits), rf"(?b)(?:{re.escape(text)}){{e<={edits}}}", label, edits, len(text.encode())))
    return out


def exact_places(flat: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase starts; ``flat`` is the words with one space before and after each."""
    out, at, words, last = [], flat.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        words += flat.count(b" ", last, at)
        last = at
        out.append(words)
        at = flat.find(b" " + phrase + b" ", at + 1)
    return out


def fuzzy_spans(flat: bytes, notice) -> list[tuple[int, int, int]]:
    """Places (start, end, edits) in ``flat`` where the notice stands with at most its edits, ascending, none inside another.

    Each seed gives a window of bounded size, so the work follows the seeds.
    Windows are taken from left to right, each from the end of the last span.  In a window the
    best match counts first, then what lies before and after it is searched in the
    same way, so notices side by side are all found.
    """
    parts, pattern, _, edits, length = notice
    spots = set()
    for piece, offset in parts:
        at = flat.find(piece)
        while at >= 0:
            spots.add(at - offset)
            at = flat.find(piece, at + 1)
    found: list[tuple[int, int, int]] = []
    for s in sorted(spots):
        lo = max(0, s - edits, found[-1][1] if found else 0)
        found += best_matches(flat, pattern, lo, min(len(flat), s + length + 2 * edits), length - edits)
    return found


def best_matches(flat: bytes, pattern: str, lo: int, hi: int, least: int) -> list[tuple[int, int, int]]:
    """Matches within flat[lo:hi], the best one first and then those beside it; spaces at their ends are left out."""
    if hi - lo < least:
        return []
    m = regex.search(pattern, flat[lo:hi].decode("latin-1"))
    if not m:
        return []
    a, b = lo + m.start(), lo + m.end()
    before, after = best_matches(flat, pattern, lo, a, least), best_matches(flat, pattern, b, hi, least)
    while flat[a : a + 1] == b" ":
        a += 1
    while flat[b - 1 : b] == b" ":
        b -= 1
    return [*before, (a, b, sum(m.fuzzy_counts)), *after]


def scan_licenses(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str, int]] = NOTICES
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are runs of digits, letters a-z (A-Z folded) and all non-ASCII
    characters; null counts as the empty text.  ``n_base`` counts all places of
    all phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start (null without a place).  ``labels`` adds the method's own labels.
    ``score`` is the best agreement, 1 for an exact phrase, else 1 - edits /
    length, 0 without a match.  ``spans`` lists the bounded-error matches:
    label, first byte and end in the normalised text (words joined by single
    spaces), edits.  Texts are read whole; nothing else is kept in memory.  An
    empty table gives an empty table; repeated rows are scanned alike.
    """
    base = [(p.encode(), label) for p, label in phrases.items()]
    own = compile_notices(notices)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))

    def scan(b: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(8)]
        for raw in b.column("text").cast(pa.binary()):
            words = (raw.as_py() or b"").translate(FOLD).split()
            flat = b" " + b" ".join(words) + b" "
            starts, labels = [], set()
            for phrase, label in base:
                if got := exact_places(flat, phrase):
                    starts += got
                    labels.add(label)
            spans, best = [], 1.0 if starts else 0.0
            for notice in own:
                for a, e, edits in fuzzy_spans(flat, notice):
                    spans.append({"label": notice[2], "start": a - 1, "end": e - 1, "edits": edits})
                    best = max(best, 1.0 - edits / notice[4])
            every = labels | {s["label"] for s in spans}
            row = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), best, spans)
            for o, v in zip(out, row):
                o.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(o, k) for o, k in zip(out, kinds)]], ["doc_id", *names])

    return arrow_map(
        rows, scan,
        [
            ("doc_id", kind), *[(n, "long") for n in ("n_words", "n_base", "first_word", "last_word")], ("base_labels", "string"), ("labels", "string"),
            ("score", "double"), ("spans", "array<struct<label:string,start:long,end:long,edits:int>>"),
        ],
    )
