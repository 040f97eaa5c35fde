"""Quality rules: counts per text, and a likelihood ratio between trusted text and the raw corpus.

Words and pairs of adjacent words are hashed to buckets.  One multinomial over
the buckets is fitted to trusted documents (labelled good), one to all
documents.  A document's score is the mean logarithm of the ratio of its grams'
probabilities under the two, so it does not depend on length.  Weights are
rounded to integers before they are added: the sum is exact in any order, and the
verdict does not depend on how Spark splits the work.

Only Spark functions are used.  Every text is handled within its row, so nothing
but counts per bucket is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

# Character classes of the patterns: space and x09-x0D end a word.
WHITE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"

# Base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

# Buckets of the hashed grams: bounds the counts, the weights and what the driver sees of them.
BUCKETS = 1 << 14

# Labelled documents that the trusted multinomial is fitted to, at most.
TRUSTED_DOCS = 20_000

# Weights are kept as multiples of 1 / SCALE.
SCALE = 1 << 16

# A document stays if its mean log-likelihood ratio per gram is at least this.
LEAST_RATIO = -0.075


def words_of(text: Column) -> Column:
    """The words of a text without nulls, as an array."""
    return F.array_remove(F.split(text, f"[{WHITE}]+"), "")


def tail(array: str) -> Column:
    """An array without its first element."""
    return F.slice(array, 2, F.greatest(F.size(array), F.lit(1)))


def with_grams(rows: DataFrame) -> DataFrame:
    """Add ``ones`` and ``twos``: 64-bit hashes of the words and of the pairs of adjacent words, in text order.

    Arrays that a later expression reads more than once are columns of their
    own, so that they are computed once and not for each element.
    """
    rows = rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    pairs = F.zip_with("ones", tail("ones"), lambda a, b: F.xxhash64(a, b))
    return rows.withColumn("twos", F.slice(pairs, 1, F.greatest(F.size("ones") - 1, F.lit(0))))


def trusted_ids(labels: DataFrame, most: int = TRUSTED_DOCS, doc_id: str = "doc_id") -> DataFrame:
    """Distinct ids of documents labelled good and not toxic, at most ``most``: those with the smallest hashes.  Null ids name nothing."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(f"`{doc_id}`").isNotNull())
    return good.select(F.col(f"`{doc_id}`").alias("t_id")).distinct().orderBy(F.xxhash64("t_id"), "t_id").limit(most)


def bucket_counts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, buckets: int, trusted: int) -> DataFrame:
    """Rows (bucket, n_raw, n_trusted) over the grams of all documents; at most one row per bucket leaves a task."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), words_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("words"))
    # at most ``trusted`` ids of eight bytes
    rows = rows.join(F.broadcast(trusted_ids(labels, trusted, doc_id)), F.col("doc_id") == F.col("t_id"), "left")
    rows = with_grams(rows.select("words", F.col("t_id").isNotNull().cast("long").alias("good")))
    grams = rows.select("good", F.explode(F.concat("ones", "twos")).alias("gram"))
    return grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n_raw"), F.sum("good").alias("n_trusted"))


def weights(counts: DataFrame, buckets: int) -> list[int]:
    """The weight of every bucket: log of trusted over raw probability, with one added to each count, times ``SCALE``.

    The counts come to the driver, at most one row per bucket.  Without trusted
    grams nothing is known, and all weights are 0.
    """
    rows = counts.collect()
    raw, good = sum(r.n_raw for r in rows), sum(r.n_trusted for r in rows)
    out = [0] * buckets
    if not good:
        return out
    for r in rows:
        ratio = (r.n_trusted + 1) / (good + buckets) * (raw + buckets) / (r.n_raw + 1)
        out[r.bucket] = round(math.log(ratio) * SCALE)
    return out


def text_counts(rows: DataFrame) -> DataFrame:
    """Add the base counts to rows with ``raw`` (the text), ``words`` and ``twos``.

    Windows of three words are equal if their 64-bit hashes are.  Only texts in
    which a hash occurs twice sort their windows to find the places.
    """
    rows = rows.select(
        "*", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("raw", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.filter(F.split("raw", "\n"), lambda line: line.rlike(f"[^{WHITE}]")).alias("lines"),
        F.zip_with("twos", tail("twos"), lambda a, b: F.xxhash64(a, b)).alias("threes"),
    )
    rows = rows.withColumn("threes", F.slice("threes", 1, F.greatest(F.size("words") - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("threes")) < F.size("threes")
    windows = F.sort_array(F.transform("threes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(
        "*", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, windows).alias("sorted"),
    )
    same = lambda x, k: F.coalesce(F.get("sorted", k)["h"] == x["h"], F.lit(False))
    again = F.filter("sorted", lambda x, k: same(x, k + 1) | same(x, k - 1))
    places = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return rows.withColumn("n_repeat_words", F.when(F.col("sorted").isNull(), 0).otherwise(F.size(F.array_distinct(places))).cast("long"))


def score_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, trusted: int = TRUSTED_DOCS,
    least_ratio: float = LEAST_RATIO, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_grams, ratio.

    Words are runs of characters other than space and x09-x0D; a null text has
    none.  ``word_chars`` counts code points inside words, ``n_symbols`` the
    characters of ``SYMBOLS``, ``n_dup_lines`` lines with a word that equal an
    earlier line, ``n_repeat_words`` the words inside windows of three words that
    occur twice or more in the text.  ``base_failed`` holds for fewer than
    ``least_words`` words or more than ``most_repeated`` per cent of repeated ones.

    ``ratio`` is the mean log-likelihood ratio per gram (words and pairs of
    adjacent ones, as they stand), 0 for a text without words or where
    no trusted document is there.  A document is kept if it passes the base rules and
    its ratio is at least ``least_ratio``.  The raw counts cover all documents; the
    trusted ones come from at most ``trusted`` documents that ``labels`` (columns
    doc_id, quality, toxic) calls good.  Labels with a null id or quality name no
    document; rows that share a doc_id share its label.  An empty table gives an
    empty table.
    """
    found = weights(bucket_counts(docs, labels, text, doc_id, buckets, trusted), buckets)
    table = F.split(F.lit(",".join(map(str, found))), ",").cast("array<long>")
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), raw.alias("raw"), words_of(raw).alias("words"))
    rows = text_counts(with_grams(rows))
    total = F.aggregate(F.concat("ones", "twos"), F.lit(0).cast("long"), lambda s, h: s + F.get(table, F.pmod(h, F.lit(buckets)).cast("int")))
    n_grams = (F.size("ones") + F.size("twos")).cast("long")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = rows.select(*names, failed.alias("base_failed"), n_grams.alias("n_grams"), total.alias("total"))
    # whole numbers on both sides: the verdict is exact
    kept = ~F.col("base_failed") & (F.col("total") >= round(least_ratio * SCALE) * F.col("n_grams"))
    ratio = F.when(F.col("n_grams") > 0, F.col("total") / (F.col("n_grams") * SCALE)).otherwise(0.0)
    # written: a filter on the verdict must not be pushed below the arrays, where lambdas would compute them for each element
    return materialize(rows.select(*names, "base_failed", kept.alias("kept"), "n_grams", ratio.alias("ratio")))
