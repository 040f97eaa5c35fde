"""The pipeline and the registered queries on small tables, against plain Python and DuckDB."""

import random

import brute
import duckdb
import pytest

import corpus_pipeline
from starloom.llm import simhash
from starloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
SYLLABLES = ["ti", "wh", "énn", "dst", "onn", "dble", "es", "th", "x"]


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    base = [prose(rng, rng.randint(40, 200)) for _ in range(25)]
    item = prose(rng, 14)
    texts = list(base)
    texts += [base[0], base[0].upper().lower(), base[1], base[1].replace("a", "A")]
    texts += [" ".join(w if k != 20 else "changed" for k, w in enumerate(t.split())) for t in base[2:8]]
    texts += [prose(rng, 30) + " " + item + " " + prose(rng, 30), "Q " + item.upper(), None, "", "12 34 !!", prose(rng, 4000)]
    rows = [(7 * k % 101 if k else None, t, ["en", None, "fr"][k % 3], ["a", "a", "b", None][k % 4], len(t or ""), k) for k, t in enumerate(texts)]
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long").repartition(3).write.parquet(str(out / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None), (3, prose(rng, 20))], "item_id long, text string").write.parquet(str(out / "benchmark.parquet"))
    return str(out)


def survivors(rows, items):
    """(id, text) that the first four stages keep, in plain Python."""
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    key = lambda i: (i is not None, i or 0)
    best = {}
    for i, t in rows:
        k = brute.fold(t)
        if k not in best or key(i) > key(best[k][0]):
            best[k] = (i, t)
    # null ids last: the smallest id of a group stays
    rows = sorted(best.values(), key=lambda r: (r[0] is None, r[0] or 0))
    groups = brute.linked(list(range(len(rows))), [brute.simhash(t, 4) for _, t in rows], 4)
    rows = [r for k, r in enumerate(rows) if groups[k] == k]
    wins = brute.windows(items)
    return [r for r in rows if not any(brute.hits(r[1], wins)[1])]


def test_pipeline_equals_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = survivors(rows, items)
    assert 20 < len(want) < len(rows) - 8
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = simhash.materialize(stage(spark, docs, folder))
        assert docs.columns == names, name
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted(want, key=str)
    packed = corpus_pipeline.run(spark, folder).collect()
    sizes = {}
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.piece_size
    assert sizes == {i: len(t.encode()) + 1 for i, t in want}


def test_pipeline_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracles(spark, key):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    df = QUERIES[key](spark, SMALL)
    rel = con.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(str, map(tuple, df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))


def test_queries_return_one_row_per_document(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len({k.split("_")[0] for k in QUERIES}) == 13
    for key, q in QUERIES.items():
        if key.startswith(("op11_", "op12_")):
            continue
        df = q(spark, SMALL)
        if key.startswith("op8_"):
            assert df.count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
        else:
            assert df.select("doc_id").distinct().count() == n, key
            if not key.startswith("op5_"):
                assert df.count() == n, key


def test_op10_on_a_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = QUERIES["op10_suffix_array_dedup"](spark, SMALL)
    got = sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == brute.repeats(rows)
