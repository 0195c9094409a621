"""Best-fit packing: the tokenizers library's ids, whole and gapless sequences, few of them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm.bestfit import ByteBPE, pack_best_fit, plan
from lakeops.llm.common import tokenizer
from lakeops.llm.queries import QUERIES
from llm_edges import EDGES, SMALL

BYTE_BPE = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def coder():
    with open(BYTE_BPE, encoding="utf-8") as fh:
        return ByteBPE(fh.read())


def test_ids_are_the_library_s(library, coder, small_docs):
    rng = random.Random(2)
    letters = [*map(chr, range(0x250)), *" \n\t" * 60, *"'" * 40, *"stremvldabc" * 5]
    texts = [r.text or "" for r in small_docs.select("text").limit(80).collect()] + [t or "" for _, t in EDGES]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "  two  spaces \n\n", "don't DON'T 'll", "日本 mixed", "½² ª ǅʰ", "a" * 4000]
    texts += ["".join(rng.choices(letters, k=80)) for _ in range(500)]
    for text, ids in zip(texts, coder.encode_many(texts)):
        assert np.frombuffer(ids, coder.width).tolist() == library.encode(text, add_special_tokens=False).ids


def laid(counts):
    """Every piece's place by the plan: sequence -> [(offset, length)]."""
    runs, sequences = plan(counts)
    bins = defaultdict(list)
    for length in range(1, len(counts)):
        of = runs[runs[:, 0] == length]
        for number in range(int(counts[length])):
            _, first, sequence, offset, beside = of[np.searchsorted(of[:, 1], number, "right") - 1]
            bins[int(sequence + (number - first) // beside)].append((int(offset + (number - first) % beside * length), length))
    assert set(bins) == set(range(sequences))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= len(counts) - 1
    return sequences


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_lays_every_piece_once(lengths):
    assert laid(np.bincount(lengths, minlength=41)[:41]) >= -(-sum(lengths) // 40)


def test_exact_complements_are_found():
    for parts in ([7, 3], [5, 5], [6, 2, 2], [4, 3, 2, 1], [10], [4, 2, 2, 2]):
        assert laid(np.bincount(parts * 50, minlength=11)) == 50


def test_few_sequences():
    """At most a hundredth over the least that the total or the long pieces allow."""
    rng = np.random.default_rng(4)
    for draw in (rng.integers(1, 1025, 20_000), np.minimum(1024, rng.lognormal(5, 1, 20_000).astype(int) + 1), rng.choice([340, 341, 343, 680, 1024], 6000)):
        counts = np.bincount(draw, minlength=1025)
        least = max(-(-int(draw.sum()) // 1024), int(counts[513:].sum()))
        assert plan(counts)[1] <= 1.01 * least + 1


def check(rows, docs, library, length=1024, end_id=2):
    """Pieces against the documents; returns how many sequences there are."""
    want, got, bins = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        at, to, pieces = 0, len(ids) % length or length, []
        while at < len(ids):
            pieces.append((len(pieces), at, to - at, np.array(ids[at:to], "<u4").tobytes()))
            at, to = to, to + length
        want[i] += pieces
    for r in rows:
        got[r[0]].append((r.piece, r.start, r.length, bytes(r.ids)))
        bins[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= length
    return len(bins)


def test_pieces(spark, small_docs, library):
    docs = [(r.doc_id, r.text) for r in small_docs.select("doc_id", "text").collect()]
    rows = pack_best_fit(small_docs.repartition(5), BYTE_BPE, end_id=2).collect()
    n = check(rows, docs, library)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_edges(spark, edge_docs, no_docs, library):
    check(pack_best_fit(edge_docs, BYTE_BPE, end_id=2, length=64).collect(), EDGES, library, length=64)
    empty = pack_best_fit(no_docs, BYTE_BPE, end_id=2)
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"] and empty.count() == 0


def test_many_copies(spark, library):
    docs = [(k // 3, "the same words " * 40) for k in range(600)]
    check(pack_best_fit(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6), BYTE_BPE, end_id=2).collect(), docs, library)


def test_query_digests(spark, small_docs, library):
    rows = QUERIES["op13_best_fit"](spark, SMALL).collect()
    text = dict(small_docs.select("doc_id", "text").collect())
    for r in rows[:40]:
        ids = library.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
