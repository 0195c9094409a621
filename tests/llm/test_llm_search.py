"""License scans, BM25 and vector search against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import bm25, vectors
from lakeops.llm.licenses import NOTICES, WORDS, scan_licenses
from llm_edges import EDGES

SMALL = "/root/testdata/sf0.001"


def brute_licenses(text, containment=0.8):
    words, found = WORDS((text or "").lower()), set()
    for name, notice in NOTICES.items():
        own = WORDS(notice.lower())
        of = min(5, len(own))
        shingles = {tuple(own[i : i + of]) for i in range(len(own) - of + 1)}
        span = len(own) - of + 1
        here = [tuple(words[i : i + of]) for i in range(len(words) - of + 1)]
        if any(len(set(here[k : k + span]) & shingles) / len(shingles) >= containment for k in range(len(here))):
            found.add(name)
    return found


def test_licenses(spark, small_docs):
    rng = random.Random(6)
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    for n, notice in enumerate(NOTICES.values()):  # planted whole, near, cut short, at the ends
        words = notice.split()
        noise = lambda k: " ".join(f"n{rng.randint(0, 999)}" for _ in range(k))
        texts[1000 + 4 * n] = f"{noise(200)} {notice.upper()} {noise(50)} {notice}"
        texts[1001 + 4 * n] = notice
        texts[1002 + 4 * n] = " ".join([*words[:-1], "other"])
        texts[1003 + 4 * n] = " ".join(words[: len(words) // 2])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in scan_licenses(df).collect():
        got.setdefault(r.doc_id, []).append(r)
        words = WORDS(texts[r.doc_id].lower())[r.start_word : r.end_word]
        own = WORDS(NOTICES[r.template].lower())
        assert set(words) & set(own) and r.containment >= 0.8
    assert {i: {r.template for r in rows} for i, rows in got.items()} == {i: b for i, t in texts.items() if (b := brute_licenses(t))}
    assert all(len([r for r in got[1000 + 4 * n] if r.template == name]) == 2 for n, name in enumerate(NOTICES))


def test_license_edges(edge_docs, no_docs):
    assert scan_licenses(edge_docs).collect() == [] and scan_licenses(no_docs).count() == 0
    with_notice = edge_docs.withColumn("text", F.concat("text", F.lit(" Released under the MIT License.")))
    assert sorted(r.doc_id or -1 for r in scan_licenses(with_notice).collect()) == sorted(i or -1 for i, t in EDGES if t is not None)


def test_bm25_equals_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.execute(E.oracle_sql()["op9_bm25"]).df().sort_values(["query_id", "rank"])
    got = E.queries()["op9_bm25"](spark, SMALL).toPandas().sort_values(["query_id", "rank"])
    assert len(got) == len(want) == 40 and (got.doc_id.values == want.doc_id.values).all()
    assert np.allclose(got.score.values, want.score.values, atol=2e-6)


def test_block_max_wand_is_exact():
    """Random lists, with ties and blocks of unlike height, against full scoring."""
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(1, 900))
        lengths = rng.integers(1, 60, n)
        lists, score = [], np.zeros(n)
        for _ in range(rng.integers(1, 8)):
            docs = np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3, 0.9])).astype("i4")
            if not len(docs):
                continue
            counts = rng.integers(1, 4, len(docs)).astype("i4")
            p = bm25._Postings(docs, counts, lengths, float(rng.choice([0.1, 1.0, 3.0])), float(lengths.mean()))
            score[docs] += p.scores
            lists.append(p)
        if lists:
            hit = np.flatnonzero(score > 0)
            want = sorted(((-score[d], d) for d in hit))[:10]
            got = bm25.block_max_wand(lists, 10)
            assert [d for _, d in got] == [int(d) for _, d in want] and np.allclose([s for s, _ in got], [-s for s, _ in want])


def test_bm25_shards_merge_exactly(spark, small_docs, monkeypatch):
    asked = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("item_id < 6")
    one = bm25.search(bm25.build_index(small_docs.coalesce(1)), asked, k=7).collect()
    many = bm25.search(bm25.build_index(small_docs.repartition(9)), asked, k=7, block_terms=30).collect()
    key = lambda r: (r.query_id, r["rank"])
    assert [(key(r), r.doc_id) for r in sorted(one, key=key)] == [(key(r), r.doc_id) for r in sorted(many, key=key)]
    assert np.allclose([r.score for r in sorted(one, key=key)], [r.score for r in sorted(many, key=key)])


def test_bm25_edges(spark, edge_docs, no_docs):
    asked = spark.createDataFrame([(0, "same text"), (20, None), (40, ""), (None, "same"), (60, "漢字 word1")], "item_id long, text string")
    index = bm25.build_index(edge_docs)
    rows = sorted(bm25.search(index, asked, k=3).collect(), key=lambda r: (r.query_id, r["rank"]))
    assert [(r.query_id, r.doc_id) for r in rows if r.query_id == 0] == [(0, 6), (0, 6), (0, 10)]  # equal scores: smaller ids first
    assert {r.doc_id for r in rows if r.query_id == 60} == {5, 8} and {r.query_id for r in rows} == {0, 60}
    assert bm25.search(bm25.build_index(no_docs), asked).count() == 0
    assert bm25.search(index, asked.limit(0)).count() == 0


def brute_nearest(ids, x, asked, k):
    out = {}
    for q in asked:
        v = x[list(ids).index(q)]
        rows = sorted((-float((v * w).sum()), i) for i, w in zip(ids, x) if i != q)[:k]
        out[q] = [i for _, i in rows]
    return out


def test_recall_of_the_index(spark):
    import __spark_entry__ as E
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    want = brute_nearest(rows.vec_id.tolist(), np.array(rows.embedding.tolist(), "f8"), rows.vec_id[rows.vec_id % 20 == 0].tolist(), 20)
    got = {}
    for r in E.queries()["op10_nearest"](spark, SMALL).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q].values()} & set(w)) for q, w in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    at = dict(zip(rows.vec_id, np.array(rows.embedding.tolist(), "f8")))
    for q, ranked in got.items():
        assert sorted(ranked) == list(range(1, len(ranked) + 1))
        assert all(abs(s - float(at[q] @ at[i])) < 1e-12 for i, s in ranked.values())
        order = [(-ranked[k][1], ranked[k][0]) for k in sorted(ranked)]
        assert order == sorted(order)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (500, 4)).astype("u1")
    index = vectors.SubstringIndex(codes)
    for radius in range(0, 20):
        for code in codes[:20]:
            apart = np.unpackbits(codes ^ code, axis=1).sum(1)
            assert index.within(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_vector_edges(spark):
    """Unlike norms, ties, copies, nulls, zero and non-finite vectors, other lengths, extra columns."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 12)) * rng.choice([0.5, 1, 5], (300, 1))
    x[20] *= 60 / np.linalg.norm(x[20])
    x[100:140] = x[20]  # copies of a query, longer than all others
    rows = [(i, [float(v) for v in np.float32(x[i])], "a") for i in range(300)]
    bad = [(400, None, "b"), (420, [0.0] * 12, "b"), (440, [None] + [1.0] * 11, "b"), (460, [float("nan")] + [1.0] * 11, "b"),
           (480, [float("inf")] + [1.0] * 11, "b"), (500, [1.0] * 5, "b"), (None, [1.0] * 12, "b"), (520, [], "b")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], "vec_id long, embedding array<float>, label string, id string, vec string")
    found = vectors.search(df, F.col("id") % 20 == 0, k=20, shard_rows=64, block_rows=4).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute_nearest(range(300), np.float32(x).astype("f8"), range(0, 300, 20), 20)
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(w)) for q, w in want.items()) / 300 >= 0.9
    assert got[20] == list(range(100, 120))  # the copies are nearest or tie: smaller ids first
    few = df.where("vec_id in (0, 1, 2, 420)")
    assert sorted((r.query_id, r.vec_id) for r in vectors.search(few, F.col("id") % 20 == 0).collect()) == [(0, 1), (0, 2)]
    assert vectors.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_every_query_has_its_rows(spark):
    """Most vectors in tight groups of copies, and outliers that ask."""
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((12, 16))
    x = np.concatenate([np.repeat(centres, 60, axis=0) + 1e-4 * rng.standard_normal((720, 16)), 3 * rng.standard_normal((12, 16))])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = vectors.search(df, (F.col("id") >= 720) | (F.col("id") % 100 == 0), k=20, shard_rows=200).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == dict.fromkeys([*range(0, 720, 100), *range(720, 732)], 20)


def test_edited_notices_equal_brute_force(spark):
    """Hundreds of copies with words changed at random, about the least containment."""
    rng = random.Random(31)
    noise = lambda k: [f"n{rng.randint(0, 99_999)}" for _ in range(k)]
    texts = {}
    for notice in NOTICES.values():
        for _ in range(90):
            words = WORDS(notice.lower())
            for k in rng.sample(range(len(words)), min(len(words) // 20 + 1, rng.randint(0, 2))):
                words[k] = "other"
            texts[len(texts)] = " ".join([*noise(rng.randint(60, 200)), *words, *noise(rng.randint(60, 200))])
    got = {i: set() for i in texts}
    for r in scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        got[r.doc_id].add(r.template)
    assert got == {i: brute_licenses(t) for i, t in texts.items()}
