"""The pipeline's stages against brute force, on the small documents."""

import numpy as np
import pytest

import corpus_pipeline as P
from lakeops.llm.bpe import WordBPE, read_spec
from lakeops.llm.common import tokenizer
from lakeops.llm.language import fit_language
from lakeops.llm.simhash import fingerprint
from lakeops.llm.toxicity import fit_toxicity
from lakeops.session import materialize

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in P.STAGES:
        docs = out[name] = materialize(stage(spark, docs, SMALL), f"test-{name}")
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "language_id", "simhash_dedup", "substring_dedup", "packing"]
    for name, _ in P.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_filters(spark, stages):
    docs, labels = stages["documents"], spark.read.parquet(f"{SMALL}/labels.parquet")
    model = fit_toxicity(docs, labels)
    want = {i for i, r in rows(docs).items() if model.score_many([r.text])[0] < 0.7}
    assert set(rows(stages["toxicity"])) == want
    languages = fit_language(stages["toxicity"], tokenizer("piece_bpe_32k.model"))
    want = {i for i, r in rows(stages["toxicity"]).items() if (s := languages.score_many([r.text])[0])[0] != "und" and s[1] >= 0.5}
    assert set(rows(stages["language_id"])) == want


def test_simhash_keeps_one_of_each_group(stages):
    before = rows(stages["language_id"])
    ids = sorted(before)
    fps = [fingerprint(before[i].text) & (1 << 64) - 1 for i in ids]
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    after = rows(stages["simhash_dedup"])
    assert set(after) == {ids[g] for g in group}
    assert all(after[i] == before[i] for i in after)


def test_passages_are_left_once_and_clean_documents_alone(stages):
    before, after = rows(stages["simhash_dedup"]), rows(stages["substring_dedup"])
    runs = lambda t: {tuple(w[k : k + 50]) for w in [t.lower().split()] for k in range(len(w) - 49)}
    shingles = lambda t: {tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(len(w) - 4)}
    seen = {}
    for i in sorted(after):
        for r in runs(after[i].text):
            assert seen.setdefault(r, i) == i
    every = {i: shingles(r.text) for i, r in before.items()}
    for i, r in before.items():
        if i not in after or after[i].text != r.text:
            # something was cut: a good part of 46 shingles stands in one earlier document
            assert max(len(every[i] & every[j]) for j in before if j < i) >= 36
        else:
            assert after[i] == r
    assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)
    assert set(before) - set(after) <= {i for i, r in before.items() if len(r.text.split()) >= 50}


def test_packing_holds_every_token_once(stages):
    bpe = WordBPE(read_spec(tokenizer("word_bpe_49k.json")))
    docs, got = rows(stages["substring_dedup"]), {}
    for r in sorted(stages["packing"].collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, []))
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert got == {i: bpe.encode(r.text) + [1] for i, r in docs.items()}


def test_edges(spark, edge_docs):
    """Odd documents pass through every stage without failing."""
    docs = edge_docs.select("*").withColumnRenamed("start", "n_chars").selectExpr("* except (n_chars)", "length(text) as n_chars")
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SMALL), f"test-edges-{name}")
    assert {r.doc_id for r in docs.collect()} == {1, 5, 6, 8, None}


def test_no_documents(spark, tmp_path):
    """Empty tables pass through every stage, with or without labels to learn from."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in P.STAGES:
        for at in (SMALL, str(tmp_path)):
            out = materialize(stage(spark, docs, at), f"test-none-{name}")
            assert out.count() == 0
            if name != "packing":
                assert out.columns == docs.columns


def test_repeated_ids_and_clashing_columns(spark):
    """Rows that share an id but not their text each stay; columns of any name go through."""
    a, b = (f"the quick brown fox number {i} jumps over lazy dogs and reads a long book about rivers" for i in (1, 2))
    b = b.replace("brown fox", "old grey wolf").replace("rivers", "distant mountains and their weather")
    rows = [(7, a, "en", 1.0, "x"), (7, b, "en", 2.0, "y"), (None, a + " again today", "en", 3.0, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double, _row string")
    kept = materialize(P.simhash_dedup(spark, docs, SMALL), "test-ids")
    assert kept.columns == docs.columns and {r.text for r in kept.collect()} >= {a, b}
    cut = materialize(P.substring_dedup(spark, kept, SMALL), "test-ids-cut")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)


def test_registered(spark):
    import __spark_entry__ as E
    queries = E.queries()
    assert {q.split("_")[0] for q in queries if q.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in queries and "pipeline" not in E.oracle_sql()
