"""Language of a text by cross-parsing against labelled text.

For each language a suffix automaton of labelled text is built: it knows every
substring of that text.  A document is parsed greedily into the longest phrases
that occur in a language's text; the language that needs the fewest phrases per
character wins.

Tasks parse many documents side by side: one table holds the automata of all
languages, the few transitions of each state laid between those of others, so
its size follows the learned text and not the number of distinct characters.
Each character is one lookup there, and one in the start row for where a phrase
ends, for all lanes and languages at once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starloom.llm.common import arrow_pieces, schema_of, share

# Bounds of the labelled sample that the automata learn from: documents per
# language, characters per document and characters per language.
SAMPLE_DOCS = 200
SAMPLE_DOC_CHARS = 1000
SAMPLE_CHARS = 40_000

# Places that a state with several transitions tries before the search moves on.
PLACES = 64

# Characters parsed together and lanes they are dealt to.
BATCH_CHARS = 16 << 20
LANES = 1024


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a string; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in codes:
        new = len(go)
        go.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


def lay_out(go: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, state, target): transition ``c`` of state ``s`` stands at ``first[s] + c``, where ``state`` is ``s``.

    No two states have the same first place, so it can name the state.  The
    start state has a full row at 0, with -1 as target of what it never had.
    """
    edges = sum(map(len, go))
    room = 2 * (width + edges + len(go)) + PLACES
    first, state, target = np.zeros(len(go), np.int64), np.full(room, -1, np.int64), np.full(room, -1, np.int64)
    free, named = np.ones(room, bool), np.zeros(room, bool)

    def put(s: int, at: int) -> None:
        first[s], named[at] = at, True
        for c, to in go[s].items():
            free[at + c], state[at + c], target[at + c] = False, s, to

    put(0, 0)
    free[:width], state[:width] = False, 0
    many = sorted((s for s in range(1, len(go)) if len(go[s]) > 1), key=lambda s: (-len(go[s]), s))
    low = width
    for s in many:
        codes = np.array(sorted(go[s]), np.int64)
        while True:
            if low + 2 * width + 2 * PLACES > len(free):
                more = len(free)
                free, named = np.concatenate([free, np.ones(more, bool)]), np.concatenate([named, np.zeros(more, bool)])
                state, target = (np.concatenate([x, np.full(more, -1, np.int64)]) for x in (state, target))
            at = np.arange(low, low + PLACES)
            ok = ~named[at] & free[at[:, None] + codes[None, :]].all(axis=1)
            if ok.any():
                put(s, int(at[ok.argmax()]))
                break
            low += PLACES
    # one transition fits wherever a place is free; states without any only need a name
    single = [s for s in range(1, len(go)) if len(go[s]) == 1]
    none = [s for s in range(1, len(go)) if not go[s]]
    more = 2 * width + 2 * len(single) + len(none)
    free, named = np.concatenate([free, np.ones(more, bool)]), np.concatenate([named, np.zeros(more, bool)])
    state, target = (np.concatenate([x, np.full(more, -1, np.int64)]) for x in (state, target))
    places = iter(np.flatnonzero(free[width:]) + width)
    for s in single:
        c = next(iter(go[s]))
        put(s, next(int(p) - c for p in places if not named[p - c]))
    for s, at in zip(none, np.flatnonzero(~named)):
        put(s, int(at))
    size = int(max(first.max() + width, np.flatnonzero(~free).max() + 1))
    return first, state[:size], target[:size]


def fold(ch: str) -> str:
    """Lower case of a character where that is one character."""
    low = ch.lower()
    return low if len(low) == 1 else ch


class Model:
    """Automata of all languages in one table.

    A state is a place in the table; the entry for a character is at state +
    code and holds if ``owner`` there is the state.  ``table`` is four times the
    next state plus the phrases that this character closes: one in the start
    row if the language never had it.  Where the state has no entry the phrase
    before ends, which is one more than the start row says.
    """

    def __init__(self, texts: dict[str, str]):
        seen: dict[str, int] = {}
        for t in texts.values():
            for ch in t:
                ch = fold(ch)
                seen[ch] = seen.get(ch, 0) + 1
        letters = sorted(seen, key=lambda ch: (-seen[ch], ch))
        # code 0: characters that no language has
        number = {ch: i + 1 for i, ch in enumerate(letters)}
        width = len(letters) + 1
        self.languages = sorted(texts)
        every = [chr(i) for i in range(0x110000)]
        self.code_of = np.array([number.get(fold(ch), 0) for ch in every], np.min_scalar_type(width))
        self.is_letter = np.array([ch.isalpha() for ch in every])
        owners, tables, base, self.starts = [], [], 0, []
        for name in self.languages:
            go = automaton([number[fold(ch)] for ch in texts[name]])
            first, state, target = lay_out(go, width)
            full = state >= 0
            closed = full & (target < 0)
            owners.append(np.where(full, base + first[state], -1).astype(np.int32))
            tables.append(((base + np.where(closed, 0, first[target])) * 4 + closed).astype(np.int32))
            self.starts.append(base)
            base += len(state)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)


def parse(model: Model, codes: list[np.ndarray]) -> np.ndarray:
    """Phrases per (document, language) for the code arrays of documents."""
    n, k = len(codes), len(model.languages)
    lens = np.array([len(c) for c in codes], np.int64)
    phrases = np.zeros((n, k), np.int64)
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    if not len(order) or not k:
        return phrases
    # whole documents are dealt to lanes, the next one always to the shortest lane
    lanes: list[list[int]] = [[] for _ in range(min(LANES, len(order)))]
    heap = [(0, i) for i in range(len(lanes))]
    for d in order:
        have, i = heapq.heappop(heap)
        lanes[i].append(int(d))
        heapq.heappush(heap, (have + int(lens[d]), i))
    total = np.array([sum(lens[d] for d in lane) for lane in lanes], np.int64)
    by = np.argsort(-total, kind="stable")
    lanes, total = [lanes[i] for i in by], total[by]
    joined = np.concatenate([codes[d] for lane in lanes for d in lane]).astype(np.int32)
    begin = np.cumsum(total) - total
    # by lane: steps at which a new document starts
    first = np.concatenate([np.cumsum([0, *[lens[d] for d in lane[:-1]]]) for lane in lanes]).astype(np.int64)
    owner = np.concatenate([np.array(lane, np.int64) for lane in lanes])
    in_lane = np.repeat(np.arange(len(lanes)), [len(lane) for lane in lanes])
    at_step = np.argsort(first, kind="stable")
    steps, step_lane, step_doc = first[at_step], in_lane[at_step], owner[at_step]
    starts = np.array(model.starts, np.int32)[:, None]
    state = np.repeat(starts, len(lanes), axis=1)
    count = np.zeros((k, len(lanes)), np.int32)
    running = np.full(len(lanes), -1, np.int64)
    table, home, nxt = model.table, model.owner, 0
    alive = np.searchsorted(-total, -np.arange(int(total[0])), side="left")
    for t in range(int(total[0])):
        m = alive[t]
        while nxt < len(steps) and steps[nxt] == t:
            lane = step_lane[nxt]
            if running[lane] >= 0:
                phrases[running[lane]] = count[:, lane] + (state[:, lane] != starts[:, 0])
            running[lane] = step_doc[nxt]
            count[:, lane] = 0
            state[:, lane] = starts[:, 0]
            nxt += 1
        c = joined[begin[:m] + t]
        at = state[:, :m] + c
        v = np.where(home.take(at) == state[:, :m], table.take(at), table.take(starts + c) + 1)
        count[:, :m] += v & 3
        state[:, :m] = v >> 2
    # a phrase may still be open at the end
    phrases[running] = (count + (state != starts)).T
    return phrases


def labelled_sample(docs: DataFrame, text: str, lang: str, doc_id: str, where, n_docs: int, doc_chars: int, chars: int) -> dict[str, str]:
    """Text per language from a bounded sample, the documents with the smallest hash of their id.

    The driver receives at most ``n_docs`` times ``doc_chars`` characters per language.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(where & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.substring("text", 1, doc_chars).alias("text"), F.xxhash64(F.col("doc_id").cast("string")).alias("h")
    )
    w = W.partitionBy("lang").orderBy("h", "text")
    picked = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n_docs).orderBy("lang", "r").collect()
    out: dict[str, str] = {}
    for r in picked:
        have = out.get(r["lang"], "")
        if len(have) < chars:
            out[r["lang"]] = (have + r["text"] + "\n")[:chars]
    return {k: v for k, v in out.items() if v.strip()}


def held_out(doc_id: str = "doc_id"):
    """The documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS,
    sample_doc_chars: int = SAMPLE_DOC_CHARS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """Add lang_pred, score, phrase_chars and held_out to the rows of ``docs``, each in a struct: (row, lang_pred, ...).

    ``lang_pred`` is ``und`` for a null text, a text without letters, or where no
    labelled text exists.  ``score`` is 1 - fewest / second fewest phrases (1 if
    only one language was learned, 0 for ``und``); ties go to the first language
    by name.  ``phrase_chars`` is the mean phrase length in the chosen language
    (0 for ``und``).  Whole texts are parsed.  Rows with a null doc_id or lang
    are judged like all others.  An empty table gives an empty table.
    """
    model = Model(labelled_sample(docs, text, lang, doc_id, ~held_out("doc_id"), sample_docs, sample_doc_chars, sample_chars))
    shared = share(docs, model)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    at = names.index(text)

    def judge(t: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        codes, known = [], []
        for x in pc.struct_field(t.column("row"), at):
            points = np.frombuffer((x.as_py() or "").encode("utf-32-le", "surrogatepass"), np.uint32)
            has = bool(model.is_letter[points].any()) if len(points) else False
            known.append(has)
            codes.append(model.code_of[points] if has else np.zeros(0, np.uint8))
        phrases = parse(model, codes)
        pred, score, mean = ["und"] * len(codes), np.zeros(len(codes)), np.zeros(len(codes))
        for i, c in enumerate(codes):
            if known[i] and model.languages:
                row = phrases[i]
                best = int(row.argmin())
                pred[i] = model.languages[best]
                second = np.partition(row, 1)[1] if len(row) > 1 else 0
                score[i] = 1.0 - row[best] / second if second else 1.0
                mean[i] = len(c) / row[best]
        return pa.RecordBatch.from_arrays([t.column("row"), pa.array(pred, pa.string()), pa.array(score), pa.array(mean)], ["row", "lang_pred", "score", "phrase_chars"])

    def task(batches):
        yield from map(judge, arrow_pieces(batches, BATCH_CHARS))

    schema = schema_of([("row", rows.schema["row"].dataType), ("lang_pred", "string"), ("score", "double"), ("phrase_chars", "double")])
    out = rows.mapInArrow(task, schema)
    return out.withColumn("held_out", held_out(f"row.`{doc_id}`"))
