"""SimHash components and near-duplicate passages against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from lakeops.llm.components import connected_components
from lakeops.llm.passages import common_passages, compact_windows, drop_passages, duplicate_passages
from lakeops.llm.simhash import covering_masks, fingerprint, keep_one, near_duplicates, near_links
from llm_edges import EDGES


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(x, low.get(find(i), x))
    return [low.get(find(i)) for i in range(len(ids))]


def test_fingerprint():
    for text in ["", None, "one", "One two THREE", "a b c d e f g", "a\x0bb  c d e \x1f f", "é É ß A-Z", EDGES[4][1]]:
        assert fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    masks = [m & (1 << 64) - 1 for m in covering_masks(4)]
    assert len(masks) == 31 and all(24 <= bin(m).count("1") <= 40 for m in masks)
    for _ in range(3000):
        apart = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & apart == 0 for m in masks)


@pytest.mark.parametrize("crowd", [1, 5, 16_384])
def test_components_are_those_of_all_pairs(spark, crowd):
    """Dense balls, chains of four-bit steps and strangers; small buckets by
    comparison, crowded ones by midpoints."""
    rng = random.Random(5)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(12)}
        for _ in range(6):
            centre ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.add(centre)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(30)} | {0, 1, 3})
    signed = np.array(fps, "u8").view("i8").tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.root for r in connected_components(near_links(df, 4, crowd)).collect()}
    want = plain_components(signed, fps)
    assert [got.get(x, x) for x in signed] == want


def test_components_of_links(spark):
    path = [(i, i + 1) for i in range(60)]
    links = spark.createDataFrame(path + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(links.limit(0)).count() == 0


def test_near_duplicates_of_documents(spark, edge_docs, no_docs, small_docs):
    for df in (edge_docs, small_docs):
        docs = df.select("doc_id", "text").collect()
        fps = [plain_fingerprint(d.text) if len(d.text or "") < 30_000 else fingerprint(d.text) & (1 << 64) - 1 for d in docs]
        want = sorted((d.doc_id or -1, f, c) for d, f, c in zip(docs, fps, plain_components([d.doc_id for d in docs], fps)))
        got = sorted((r.doc_id or -1, r.fp & (1 << 64) - 1, r.component_id) for r in near_duplicates(df).collect())
        assert got == want
    assert near_duplicates(no_docs).count() == 0
    kept = keep_one(edge_docs, near_duplicates(edge_docs))
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 5, 6, 8, 9]


def brute_windows(h, width):
    """Centre -> (l, r): the runs of ``width`` or more of which it is the first least."""
    out = {}
    for i in range(len(h)):
        for j in range(i + width - 1, len(h)):
            c = i + int(np.argmin(h[i : j + 1]))
            l, r = out.get(c, (i, j))
            out[c] = min(l, i), max(r, j)
    return out


def test_compact_windows_are_the_cartesian_trees_nodes():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 1 << 60, n).astype("u8") << np.uint64(3) for n in (40, 3, 0, 25, 60)]
    docs[3][5:15] = docs[3][20]  # repeated tokens
    first = np.cumsum([0, *map(len, docs)])
    l, c, r = compact_windows(np.concatenate(docs), first, 8)
    for d, h in enumerate(docs):
        own = (c >= first[d]) & (c < first[d + 1])
        place = np.uint64((1 << 26) - 1)
        got = {int(x - first[d]): (int(a - first[d]), int(b - first[d])) for a, x, b in zip(l[own], c[own], r[own])}
        assert got == brute_windows(h & ~place, 8)


def prose(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def test_common_passages():
    rng = random.Random(3)
    number = {}
    code = lambda words: np.array([number.setdefault(w, len(number) * 7919 % 65_521) for w in words], "u8")
    shared = prose(rng, 80)
    a, b = prose(rng, 30) + shared + prose(rng, 40), prose(rng, 10) + shared[:40] + ["new"] + shared[41:] + prose(rng, 5)
    (x,) = common_passages(code(a), code(b), 50, 0.8)
    assert (x[0], x[1], x[2], x[3]) == (30, 110, 10, 90) and x[4] >= 0.8
    assert common_passages(code(a), code(prose(rng, 30) + shared[:45] + prose(rng, 30)), 50, 0.8) == []


def test_passages_repeat_across_documents(spark):
    """Exact and near passages, passages at both ends, one that many documents
    share, a very common line, a document's own repeats, copies."""
    rng = random.Random(9)
    line = prose(rng, 9)
    exact, near, common = prose(rng, 55), prose(rng, 120), prose(rng, 60)
    near2 = [w if i % 40 != 20 else "changed" for i, w in enumerate(near)]
    texts = {i: line + prose(rng, 60) for i in range(20)}
    texts[1] += exact
    texts[4] = exact + texts[4]
    texts[2] += near
    texts[7] = texts[7][:30] + near2 + texts[7][30:]
    for i in range(30, 60):
        texts[i] = prose(rng, rng.randint(0, 30)) + common + prose(rng, rng.randint(0, 30))
    own = prose(rng, 60)
    texts[70] = own + prose(rng, 20) + own
    texts[80] = texts[81] = prose(rng, 100)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    rows = duplicate_passages(df).collect()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add(r.source_id)
        words, source = texts[r.doc_id][r.start : r.end], texts[r.source_id][r.source_start : r.source_end]
        assert r.end - r.start >= 50 and r.source_id < r.doc_id and r.similarity >= 0.8 and len(set(words) & set(source)) >= 40
    assert set(found) == {4, 7, 81, *range(31, 60)} and found[4] == {1} and found[7] == {2}
    kept = {r.doc_id: r.text for r in drop_passages(df, duplicate_passages(df)).collect()}
    assert 81 not in kept and set(kept) == set(texts) - {81}
    for i, t in texts.items():
        if i not in found:
            assert kept[i] == " ".join(t)
    assert kept[4] == " ".join(line + texts[4][55 + 9 :])
    assert sum(" ".join(common[5:-5]) in t for t in kept.values()) == 1


def test_passage_edges(spark, edge_docs, no_docs):
    rows = duplicate_passages(edge_docs).collect()
    assert rows == []
    assert duplicate_passages(no_docs).count() == 0
    again = edge_docs.unionByName(edge_docs.where("doc_id = 5").selectExpr("doc_id + 10 as doc_id", *edge_docs.columns[1:]))
    found = duplicate_passages(again)
    assert {r.doc_id for r in found.collect()} == {15}
    kept = drop_passages(again, found)
    assert kept.columns == again.columns and kept.count() == again.count() - 1 + (kept.where("doc_id = 15").count())
    assert {r.text for r in kept.where("doc_id <> 15 or doc_id is null").select("text").collect()} == {t for _, t in EDGES}


def test_exact_passages_of_the_test_data(spark, small_docs):
    """Every document that repeats 50 words of an earlier one is found."""
    seen, later = {}, set()
    for d in sorted(small_docs.collect(), key=lambda d: d.doc_id):
        words = (d.text or "").lower().split()
        runs = {tuple(words[k : k + 50]) for k in range(len(words) - 49)}
        if any(r in seen for r in runs):
            later.add(d.doc_id)
        seen.update(dict.fromkeys(runs, d.doc_id))
    assert later <= {r.doc_id for r in duplicate_passages(small_docs).collect()}


def spans(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id, r.source_id].append((r.start, r.end))
    return out


def test_frequent_lines_inside_shared_passages(spark):
    """Passages that are made of, or hold, lines that stand alone in many other documents between."""
    rng = random.Random(21)
    lines = [prose(rng, rng.randint(12, 24)) for _ in range(6)]
    texts, want = {}, set()
    for k in range(8):
        x, y = rng.sample(lines, 2)
        shared = [*x, *y, *rng.choice(lines)] if k % 2 else [*prose(rng, 20), *x, *prose(rng, 16)]
        shared += prose(rng, max(0, 50 - len(shared)))
        for i in (k, 900 + k):
            texts[i] = prose(rng, 30) + shared + prose(rng, 30)
        want.add((900 + k, k))
    for i in range(100, 400):
        texts[i] = [w for x in rng.sample(lines, 3) for w in prose(rng, 40) + x]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    assert want <= set(spans(duplicate_passages(df).collect()))


def test_every_copy_inside_a_document(spark):
    """A later document with three copies, also beside a refrain that stands before, within and after the passage."""
    rng = random.Random(22)
    passage, refrain = prose(rng, 60), prose(rng, 8)
    held = prose(rng, 30) + refrain + prose(rng, 30)
    texts = {1: prose(rng, 40) + passage + prose(rng, 40), 2: [w for _ in range(3) for w in prose(rng, 70) + passage],
             3: refrain + prose(rng, 60) + held + prose(rng, 60) + refrain, 4: refrain + prose(rng, 20) + refrain + held + prose(rng, 90) + refrain}
    got = spans(duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect())
    assert got.keys() == {(2, 1), (4, 3)}
    assert all(any(a <= at and at + 60 <= b for a, b in got[2, 1]) for at in (70, 200, 330))
    assert any(a <= 36 and 104 <= b for a, b in got[4, 3])


@pytest.mark.parametrize("edit", ["changed", "inserted", "deleted"])
def test_recall_of_edited_passages(spark, edit):
    """Passages of 50 to 60 words with similarity 0.8 or little more."""
    rng = random.Random(23)
    texts, n = {}, 400
    for k in range(n):
        size = rng.randint(51, 60)
        shared = prose(rng, size)
        at = rng.randint(8, size - 9)
        edited = shared[:at] + ([] if edit == "deleted" else ["new"]) + shared[at + (edit != "inserted") :]
        texts[k], texts[1000 + k] = prose(rng, 20) + shared + prose(rng, 20), prose(rng, 30) + edited + prose(rng, 10)
    got = spans(duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect())
    assert sum((1000 + k, k) in got for k in range(n)) >= 0.99 * n


@pytest.mark.parametrize("beside", [0, 25, 300])
def test_edited_passages_whose_halves_are_crowded(spark, beside):
    """Pairs of 52 words with one changed in the middle; either half also stands in other documents, few or many."""
    rng = random.Random(beside)
    texts, at = {}, 0
    pairs = 20 if beside < 100 else 4
    for k in range(pairs):
        left, right = prose(rng, 26), prose(rng, 26)
        shared = left + right
        edited = left[:-1] + ["changed"] + right
        lines = [prose(rng, 20) + half + prose(rng, 20) for half in (left, right) for _ in range(beside)]
        rng.shuffle(lines)
        texts[k] = prose(rng, 20) + shared + prose(rng, 20)
        for line in lines:
            texts[10_000 + at] = line
            at += 1
        texts[1_000_000 + k] = prose(rng, 20) + edited + prose(rng, 20)
    got = spans(duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect())
    assert {(1_000_000 + k, k) for k in range(pairs)} <= set(got)


def test_a_repeated_word_is_one_window(spark):
    """Texts that repeat a word or a line are found, and don't multiply."""
    rng = random.Random(5)
    line = prose(rng, 7)
    texts = {1: ["la"] * 900, 2: prose(rng, 60) + ["la"] * 300, 3: line * 80, 4: prose(rng, 30) + line * 20 + prose(rng, 30), 5: ["la"] * 900}
    rows = duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect()
    got = spans(rows)
    assert set(got) == {(2, 1), (4, 3), (5, 1)} and got[5, 1] == [(0, 900)]
    assert any(a <= 64 and b >= 355 for a, b in got[2, 1]) and any(a <= 34 and b >= 165 for a, b in got[4, 3])


def test_crowded_groups_keep_every_kind_of_link():
    """In one large group: copies of two passages around a centre, an edited one, and strangers."""
    import pyarrow as pa
    from lakeops.llm.passages import WINDOW, near_windows
    rng = np.random.default_rng(7)
    code = lambda n=50: rng.integers(0, 1 << 16, n).astype("<u2")
    left, right, line = code(), code(55), code(5)
    around = [[code(), line, right] for _ in range(10)] + [[left, line, code(55)] for _ in range(10)] + [[code(), line, code(55)] for _ in range(10)]
    edited = right.copy()
    edited[9] ^= 1
    around.append([code(), line, edited])
    n = len(around)
    cols = [[5] * n, list(range(n)), [0] * n, [100] * n, [50] * n, [55] * n, [np.concatenate(x).tobytes() for x in around]]
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [*WINDOW, "words"])
    got = set(zip(*(x.tolist() for x in near_windows(batch, None, 46, 0.8))))
    assert {(0, k) for k in range(1, 10)} <= got and {(10, k) for k in range(11, 20)} <= got
    assert not any(a in range(1, 10) and b in range(1, 10) for a, b in got)  # copies: not all pairs
    assert any(b == 30 for _, b in got) and not any(20 <= x < 30 for pair in got for x in pair)
    # dealt into shares: the pairs of different shares, and those within each, are all pairs
    share = np.arange(n) % 2
    across = set(zip(*(x.tolist() for x in near_windows(batch, share, 46, 0.8))))
    assert across and all(a % 2 != b % 2 for a, b in across)


def test_links_of_near_copies_grow_with_the_windows():
    """Near copies with an edit at any place: each is linked, by few links, not by all pairs."""
    import pyarrow as pa
    from lakeops.llm.passages import WINDOW, near_windows

    def linked(n):
        rng = np.random.default_rng(11)
        base, around = rng.integers(0, 1 << 16, 197).astype("<u2"), []
        for _ in range(n):
            copy = base.copy()
            copy[[*rng.integers(0, 90, 2), *rng.integers(110, 197, 2)]] ^= rng.integers(1, 1 << 16, 4).astype("<u2")
            around.append(copy.tobytes())
        cols = [[5] * n, list(range(n)), [0] * n, [200] * n, [96] * n, [96] * n, around]
        types = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [*WINDOW, "words"])
        return list(zip(*(x.tolist() for x in near_windows(batch, None, 46, 0.8))))

    for n in (100, 400):
        got = linked(n)
        assert len(got) <= 6 * n and {x for pair in got for x in pair} == set(range(n))


def longer_beside_a_line(rng, others):
    """Documents 1000 + k and 2000 + k share 60 words that hold a line of 45, as many earlier documents do."""
    line, texts = prose(rng, 45), {}
    for i in range(others):
        texts[i] = prose(rng, 60) + line + prose(rng, 60)
    for k in range(12):
        shared = prose(rng, 8) + line + prose(rng, 7)
        for i in (1000 + k, 2000 + k):
            texts[i] = prose(rng, 60) + shared + prose(rng, 60)
    return texts


@pytest.mark.parametrize("others, block", [(3, 1024), (60, 1024), (200, 32)])
def test_a_longer_passage_around_a_common_line(spark, monkeypatch, others, block):
    """The first documents with the line have too little in common with the
    later ones; those that share more are found all the same, in groups of any size and any number of shares."""
    from lakeops.llm import passages
    monkeypatch.setattr(passages, "BLOCK", block)
    texts = longer_beside_a_line(random.Random(31), others)
    got = spans(duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect())
    want = {(2000 + k, 1000 + k) for k in range(12)}
    assert want <= set(got)
    assert all(any(a <= 60 and 120 <= b for a, b in got[x]) for x in want)


def test_keep_one_goes_by_the_row(spark):
    """Rows that share an id but not their text are told apart; null ids too; equal rows are one."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(prose(rng, 40)) for _ in range(4))
    rows = [(7, a, "x"), (7, b, "y"), (8, c, "z"), (9, a, "copy"), (None, b, "copy"), (None, d, "only"), (None, d, "only"), (8, c, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root string").repartition(4)
    kept = keep_one(df, near_duplicates(df))
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(7, a, "x"), (7, b, "y"), (8, c, "z"), (None, d, "only")], key=str)


def test_links_cover_what_all_pairs_cover():
    """Every place of a window that is in a passage with any earlier window is in one with a window
    it is linked with: edits near each other, between two passages, moved stretches, repeated words."""
    import pyarrow as pa
    from lakeops.llm.passages import REACH, SHINGLE, WINDOW, _cut, _grid, _place, near_windows
    rng = np.random.default_rng(3)
    code = lambda n: rng.integers(0, 1 << 16, n).astype("<u2")
    base, line, around = code(2 * REACH + SHINGLE), code(8), []
    for k in range(60):
        one = base.copy()
        for at in rng.integers(0, len(one), rng.integers(1, 9)):
            if abs(at - REACH - 2) > 8:
                one[at] = code(1)[0]
        if k % 5 == 1:
            one[:40] = code(40)
        if k % 5 == 2:
            one[150:] = np.roll(one[150:], 3)
        if k % 5 == 3:
            one[10:18], one[30:38], one[170:178] = line, line, line
        around.append(one.tobytes())
    n = len(around)
    cols = [[5] * n, list(range(n)), [0] * n, [200] * n, [REACH] * n, [REACH] * n, around]
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [*WINDOW, "words"])
    grid, links = _grid(batch), set(zip(*(x.tolist() for x in near_windows(batch, None, 46, 0.8))))
    for b in range(n):
        every, linked = np.zeros(grid.shape[1], bool), np.zeros(grid.shape[1], bool)
        for a in range(b):
            for _, _, x, y, _ in _cut(*_place(grid[a], grid[b], 0), grid[a], grid[b], 46, 0.8):
                every[x : y - SHINGLE + 1] = True
                linked[x : y - SHINGLE + 1] |= (a, b) in links
        assert (every == linked).all()
    assert len(links) <= 6 * n


def test_no_passage_is_lost_to_a_wider_stretch():
    """Stray words in common beside a passage don't make the cut go through the passage's own edit."""
    rng = random.Random(6)
    number = {}
    code = lambda words: np.array([number.setdefault(w, len(number) * 7919 % 65_521) for w in words], "u8")
    shared, stray = prose(rng, 56), prose(rng, 6)
    a = shared + prose(rng, 1) + stray + prose(rng, 40)
    b = shared[:27] + ["new"] + shared[28:] + prose(rng, 1) + stray + prose(rng, 40)
    got = common_passages(code(a), code(b), 50, 0.8, 0)
    assert any(lo <= 0 and hi >= 56 for _, _, lo, hi, _ in got)
