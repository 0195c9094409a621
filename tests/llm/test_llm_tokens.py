"""BPE, token counts and packing against the tokenizers library and brute force."""

import hashlib
import unicodedata
import zlib
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm.bpe import WordBPE, bpe_decode, bpe_encode, read_spec
from lakeops.llm.common import tokenizer
from lakeops.llm.packing import hilbert_key, pack
from lakeops.llm.tokencount import START, LongestMatch, count_tokens, read_vocabulary
from llm_edges import EDGES

WORD_BPE, PIECES = tokenizer("word_bpe_49k.json"), tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def coder():
    return WordBPE(read_spec(WORD_BPE))


def test_encode_equals_the_library(library, coder, small_docs):
    texts = [r.text for r in small_docs.select("text").limit(60).collect()]
    texts += [t for _, t in EDGES if t] + ["a<|endoftext|>b <|startoftext|>", "<|EndOfText|>", "x" * 3000, "ab" * 1000 + "!" * 500, "é" * 90]
    for t, ids in zip(texts, coder.encode_many(texts)):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0xFFFF), max_size=60).filter(lambda t: all(unicodedata.category(c) != "Cn" for c in t)))
def test_any_text_equals_the_library(text):
    from tokenizers import Tokenizer
    lib = test_any_text_equals_the_library.__dict__.setdefault("lib", Tokenizer.from_file(WORD_BPE))
    own = test_any_text_equals_the_library.__dict__.setdefault("own", WordBPE(read_spec(WORD_BPE)))
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_scan_and_heap_agree(coder):
    words = ["the" * n for n in (1, 5, 20)] + ["internationalisation", "q", "zzzzzzzz"]
    for w in words:
        b = w.encode()
        parts = [*coder.inner[list(b[:-1])].tolist(), int(coder.last[b[-1]])]
        assert coder.encode(w) == coder._heap(parts)


def test_bpe_rows(spark, edge_docs, no_docs, library):
    got = bpe_encode(edge_docs, WORD_BPE, decode=True).collect()
    assert len(got) == len(EDGES)
    by = {(r.doc_id, len(r.ids)): r for r in got}
    for i, t in EDGES:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert by[i, len(ids)].ids == ids and by[i, len(ids)].decoded == library.decode(ids, skip_special_tokens=False)
    again = bpe_decode(bpe_encode(edge_docs, WORD_BPE), WORD_BPE).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in got)
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe_decode(null, WORD_BPE).first().decoded == ""
    assert bpe_encode(no_docs, WORD_BPE).count() == 0


def test_op1_digests(spark, library):
    import __spark_entry__ as E
    got = {r.doc_id: r for r in E.queries()["op1_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def greedy(word, pieces):
    n, i = 0, 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return 0
        n, i = n + 1, j
    return n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=12), st.text("abcd", min_size=1, max_size=14))
def test_automaton_is_greedy_longest_match(pieces, word):
    assert LongestMatch(pieces).count(word) == greedy(word, set(pieces))


def test_count_tokens(edge_docs, no_docs, small_docs):
    pieces = set(read_vocabulary(PIECES))
    for df in (edge_docs, small_docs.limit(40)):
        want = sorted((d.doc_id or -1, len((d.text or "").split()), sum(greedy(START + w, pieces) or 1 for w in (d.text or "").split() if len(w) < 99))
                      for d in df.collect() if len(d.text or "") < 99_999)
        got = sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in count_tokens(df, PIECES).collect() if r.n_words < 50_000)
        assert got == want
    assert count_tokens(no_docs, PIECES).count() == 0


def test_hilbert_key_walks_the_grid():
    """Every cell once, and neighbours along the curve are neighbours in space."""
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(keys)].astype(int)
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_pack(spark, edge_docs, no_docs, small_docs, library):
    for df in (edge_docs, small_docs):
        docs = df.select("doc_id", "text").collect()
        rows = pack(df, WORD_BPE, end_id=1, length=128).collect()
        want = sorted((d.doc_id or -1, tuple(library.encode(d.text or "", add_special_tokens=False).ids) + (1,)) for d in docs)
        assert all(r.length == len(r.ids) // 4 for r in rows)
        # pieces in the order of their start give each document's ids; equal ids are told apart by their place
        got = []
        for _, same in groupby(sorted(rows, key=lambda r: (r.doc_id or -1, r.sequence_id, r.offset)), key=lambda r: r.doc_id):
            ids = ()
            for r in same:
                assert r.start == len(ids)
                ids += tuple(np.frombuffer(r.ids, "<u4").tolist())
                if len(ids) == r.doc_tokens:
                    got.append((r.doc_id or -1, ids))
                    ids = ()
            assert not ids
        assert sorted(got) == want
        full = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert full.get(r.sequence_id, 0) == r.offset
            full[r.sequence_id] = r.offset + r.length
        tasks = {s >> 40 for s in full}
        assert max(full.values()) <= 128 and sum(n < 128 for n in full.values()) <= len(tasks)
    assert pack(no_docs, WORD_BPE, end_id=1).count() == 0


def test_op6_checksums(spark, library):
    import __spark_entry__ as E
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in E.queries()["op6_packing"](spark, "/root/testdata/sf0.001").collect():
        ids = np.array(library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
