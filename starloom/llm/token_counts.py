"""Token counts under a unigram model, with one forward pass per shared prefix.

A text is cut into pre-tokens, a run of spaces with the word after it; no piece
of the vocabulary reaches over such a cut, so a text's best segmentation is made
of the best segmentations of its pre-tokens.  A task inserts the distinct
pre-tokens it meets into a trie and walks it depth first: the best score and its
token count are computed once per trie node, so pre-tokens with a common prefix
share that part of the work, and the counts at their ends are kept for all
further texts.
"""

from __future__ import annotations

import math
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import arrow_pieces, schema_of, share

SPACE = "▁"

# Folder of the vocabulary files; a parameter, since the files are not part of this repository.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

# Counts that a task remembers, and characters of pre-tokens worth remembering.
REMEMBERED = 500_000
LONGEST_KEPT = 64

BATCH_BYTES = 8 << 20


class Unigram:
    """Piece scores.  ``unknown`` is the score of each byte of a character without a piece."""

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        self.longest = max(map(len, scores), default=1)


def load_pieces(path: str = VOCABULARY) -> Unigram:
    """Pieces of a sentencepiece file, with log-probabilities from their ranks (the frequency of the r-th piece goes as 1 / r).

    Control, unknown and byte pieces are left out; a character without a piece
    costs one token per byte, as byte fallback does.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.expanduser(path))
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    order = sorted(ids, key=lambda i: (-sp.get_score(i), i))
    scores = {sp.id_to_piece(i): -math.log(r + 2) for r, i in enumerate(order)}
    return Unigram(scores, -math.log(len(order) + 2) - 10.0)


def trie_counts(model: Unigram, words: list[str]) -> dict[str, int]:
    """Token count of each word.

    In sorted order the words are a depth-first walk of their trie: what two
    neighbours share is the path from the root that both lie on, and the stack
    holds the forward scores along the present path.
    """
    scores, longest, unknown = model.scores, model.longest, model.unknown
    best, count, last, out = [0.0], [0], "", {}
    for w in sorted(words):
        shared = len(os.path.commonprefix((last, w)))
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(w) + 1):
            top, n = -math.inf, 0
            for start in range(max(0, end - longest), end):
                s = scores.get(w[start:end])
                if s is not None:
                    s += best[start]
                    k = count[start] + 1
                    # the better score, of equal ones the shorter segmentation
                    if s > top or s == top and k < n:
                        top, n = s, k
            if w[end - 1] not in scores:
                size = len(w[end - 1].encode("utf-8", "surrogatepass"))
                s, k = best[end - 1] + size * unknown, count[end - 1] + size
                if s > top or s == top and k < n:
                    top, n = s, k
            best.append(top)
            count.append(n)
        out[w] = count[len(w)]
        last = w
    return out


_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text: one space is put before it, spaces become the space mark."""
    if not text:
        return []
    return _UNITS.findall(SPACE + text.replace(" ", SPACE))


def count_tokens(docs: DataFrame, model: Unigram, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_pretokens, n_bytes.

    Null and empty texts have no tokens.  Whole texts are counted; a pre-token of
    any length is handled in time linear in it.  No rows move; a task's memory
    holds one batch and at most ``REMEMBERED`` counts.  An empty table gives an
    empty table; repeated rows are counted alike.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shared = share(docs, model)

    def task(batches):
        known: dict[str, int] = {}
        for b in arrow_pieces(batches, BATCH_BYTES):
            texts = [pretokens(x.as_py()) for x in b.column("text")]
            fresh = set().union(*texts).difference(known)
            counts = trie_counts(shared.value, list(fresh))
            if len(known) + len(counts) > REMEMBERED:
                counts.update((w, known[w]) for w in set().union(*texts).intersection(known))
                known = {}
            counts.update(known)
            n_tokens = [sum(map(counts.__getitem__, t)) for t in texts]
            known = counts if len(counts) <= REMEMBERED else {}
            if known:
                known = {w: n for w, n in known.items() if len(w) <= LONGEST_KEPT}
            n_bytes = [len(x.as_py().encode("utf-8", "surrogatepass")) if x.is_valid else 0 for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(np.array(v, np.int64)) for v in (n_tokens, [len(t) for t in texts], n_bytes)]],
                ["doc_id", "n_tokens", "n_pretokens", "n_bytes"],
            )

    return rows.mapInArrow(task, schema_of([("doc_id", rows.schema["doc_id"].dataType), ("n_tokens", "long"), ("n_pretokens", "long"), ("n_bytes", "long")]))
