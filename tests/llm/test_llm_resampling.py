"""Importance resampling against brute force."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from lakeops.llm.queries import QUERIES
from lakeops.llm.resampling import Features, frequent, last_drawn, numbered, resample, words_of
from llm_edges import EDGES, SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, most):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [crc32(" ".join(words[i : i + n]).encode()) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, most=1, buckets=10_000, seed=2024, least=20):
    found = [(i, *runs(t, most)) for i, t in docs]
    s = Counter(x % buckets for _, _, f in found for x in f)
    t = Counter(x % buckets for text in target for x in runs(text, most)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, n_words, f in found:
        weight = sum(gain(x % buckets) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    may = [r for r in rows if r[4] >= least]
    order = sorted(may, key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[2], r[1]))
    ranks = {id(r): k + 1 for k, r in enumerate(order[: len(may) * percent // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_words_are_those_of_the_pattern():
    texts = ["A-b c_d 12é İ日本 x\x00y\x7fz", "", "ÀÉ Ab", *(t or "" for _, t in EDGES)]
    for t in texts:
        assert [w.decode() for w in words_of(t)] == WORD.findall(t.translate(LOWER))


@pytest.mark.parametrize("most", [1, 2, 3])
def test_head_and_tail_give_the_same_buckets(most):
    texts = ["a b c a b", "", "x", "a b", "b a b c é a"]
    want = [Counter(x % 1000 for x in runs(t, most)[1]) for t in texts]
    for head in ([], [b"a"], [b"a", b"b", "é".encode()]):
        pairs = [(x, y) for x in head for y in head]
        found = Features(head, pairs, most, 1000).of([words_of(t) for t in texts])
        assert [Counter(f.tolist()) for f in found] == want


@pytest.mark.parametrize("most,buckets", [(1, 10_000), (2, 70_000), (3, 50)])
def test_rows_equal_brute_force(spark, most, buckets):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample(df, aim, percent=30, max_words=most, buckets=buckets, head_words=50)
    assert got(out) == brute(docs, target, percent=30, most=most, buckets=buckets)


def test_the_head_is_counted_over_all_rows(spark):
    df = spark.createDataFrame([("common " * 30 + f"rare{i} pair one",) for i in range(300)], "text string").repartition(7)
    words = frequent(df, "text", 2, 40)
    assert words[0] == (b"common", None) and (b"common", b"common") in words and (b"pair", b"one") in words
    assert len(words) <= 80 and not any(w[0].startswith(b"rare") for w in words)


def test_edges(spark, edge_docs, no_docs):
    aim = spark.createDataFrame([("hello world",), (None,), ("",)], "text string")
    want = brute(EDGES, ["hello world"], percent=60, least=0)
    out = resample(edge_docs, aim, percent=60, least_words=0)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in out.schema} == {"bigint"}
    assert got(out) == want
    assert resample(no_docs, aim).count() == 0
    none = aim.limit(0)
    assert got(resample(edge_docs, none, percent=50, least_words=0)) == brute(EDGES, [], percent=50, least=0)


def test_ranks_go_on_over_tasks_and_ties(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "score bigint, id bigint").repartition(9)
    from pyspark.sql import functions as F
    out = [tuple(r) for r in numbered(df, F.desc("score"), "id").select("rank", "score", "id").orderBy("rank").collect()]
    assert [r[0] for r in out] == list(range(1, 501)) and out == sorted(out, key=lambda r: (-r[1], r[2]))


def test_last_drawn(spark):
    scores = np.random.default_rng(3).integers(-3000, 3000, 700).tolist() + [-1000] * 50
    df = spark.createDataFrame([(x,) for x in scores], "score bigint")
    down = sorted(scores, reverse=True)
    for n in (1, 2, 350, 749, 750):
        assert last_drawn(df, n) == down[n - 1]
    assert last_drawn(df, 0) is None


def test_query_draws_a_tenth(spark):
    rows = QUERIES["op12_resampling"](spark, SMALL).collect()
    may = sum(r.n_features >= 20 for r in rows)
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, may * 10 // 100 + 1))
