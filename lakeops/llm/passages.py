"""Near-duplicate passages by compact windows.

Tokens are shingles of five lower-cased words. For each of several hash
functions a text's subsequences of at least ``width`` tokens fall into compact
windows (l, c, r): all subsequences [i, j] with l <= i <= c <= j <= r have the
same min-hash, that of the token at c. The windows are the nodes of the
Cartesian tree of the tokens' hashes that span ``width`` tokens or more; their
centres are the tokens that are least in some run of ``width``, and a stack
over those gives the extents. Two passages that are near duplicates share a
min-hash with the probability of their similarity, so windows of two
documents with one min-hash, whose extents leave room for a common
subsequence, are joined, and every document pair joined by one of the
functions is verified: word sequences (32-bit hashes) aligned by their
shingles, intervals of at least ``min_words`` words and Jaccard similarity 0.8.
A pair of similarity 0.8 is joined by one of four functions with probability
1 - 0.2^4 = 0.998.

Scale: equal texts are searched once, by the smallest id, and their copies are
reported whole. Centres that follow each other at less than a window's length
with one token (a text that repeats a word or a line over and over) are one
window. Windows are range sorted by (min-hash, id); of a key's windows all pairs
are joined in place if they are at most ``few``.

The windows of larger keys, of any size, get the words around their centres
from the texts, and each is compared with all earlier ones of its key; what is
joined is a cover: the passages of a window's links cover every word that is in
a passage with any earlier window, so that the links grow with the windows, not
with their pairs. A comparison is left out only if it can't show more: if the two
hold fewer shingles in common (counted by the buckets they fall into) than any
passage has, or if the passages shown already cover all that the earlier one
holds, and what lies between. Equal runs of ``width`` shingles are linked with the first that
has them; of the others those with most in common come first, and all that are
left are aligned together by columns (only windows that repeat a shingle, or
hold some in another order, one by one). The comparisons, but not the rows, may grow with
the square of a key's windows.
Keys of more than ``BLOCK`` windows are dealt into shares; each two shares
meet in one task, where only the first of an equal run is linked with the other
share's, so that a task holds two shares at any size.
For verification only the joined stretches travel, one for each offset between
two documents; what is no longer needed is deleted on the way.

Defined results: texts that are null, empty or shorter than ``min_words`` have
no passage; a null id is a document like any other and comes first; of a
document's own repeats none is reported; equal texts are one document, of
which all but the smallest id repeat the whole; equal rows (id and text) are one
row; rows with one id and different texts are different ones; an empty
table gives an empty table. Only the named columns are read, so extra columns
of any name are ignored. Texts are taken whole.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import gathered, id_text, slices
from lakeops.session import materialize, scratch_path
from lakeops.sources import fs

SHINGLE = 5
WORDS = re.compile(r"\S+").finditer
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], "u8")
#: Bits of a position within a slice, packed under a hash so that the least is the leftmost.
PLACE = np.uint64(26)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Memo: word -> 64-bit hash, the same in every process."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode())
        return h


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each run of five word hashes."""
    n = max(0, len(words) - SHINGLE + 1)
    out = np.zeros(n, "u8")
    for k in range(SHINGLE):
        out = out * _MUL[0] + words[k : k + n]
    return _mix(out)


def compact_windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of the windows of documents laid end to end; ``first`` holds
    the documents' starts and the total length."""
    n = len(hashes)
    if n < width:
        return (np.empty(0, "i8"),) * 3
    place = np.uint64((1 << int(PLACE)) - 1)
    packed = (hashes & ~place) | np.arange(n, dtype="u8")
    low, span = packed, 1
    while span < width:  # least of each run of ``span``, by doubling
        step = min(span, width - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = doc[: len(low)] == doc[width - 1 :]
    centres = np.unique(low[inside] & place).astype("i8")
    # extents: nearest lesser centre on either side, or the document's end
    value, at, ends = packed[centres].tolist(), centres.tolist(), first[doc[centres] + 1].tolist()
    starts = first[doc[centres]].tolist()
    left, right, stack = [0] * len(at), [0] * len(at), []
    for k in range(len(at)):
        while stack and (starts[stack[-1]] != starts[k] or value[stack[-1]] > value[k]):
            top = stack.pop()
            right[top] = at[k] - 1 if starts[top] == starts[k] else ends[top] - 1
        left[k] = at[stack[-1]] + 1 if stack else starts[k]
        stack.append(k)
    for top in stack:
        right[top] = ends[top] - 1
    return np.array(left), centres, np.array(right)


#: Shingles kept of a window on either side: a longer common passage has further centres.
REACH = 96
#: Windows of a share of a large group.
BLOCK = 8192
#: Windows from which on a group's candidates are counted by a matrix product first.
MANY = 64
#: Buckets that the shingles around a centre are hashed to.
BUCKETS = 2048
_WINDOW = "key long, id {k}, sub int, c int, before int, after int"
WINDOW = [c.split()[0] for c in _WINDOW.split(", ")]


def _ahead(base: np.ndarray, first: np.ndarray, c: np.ndarray, row: np.ndarray, m: int) -> np.ndarray:
    """Hashes of the ``m`` shingles from the centres on; zero where the document has fewer."""
    block = np.zeros(max(len(base) - m + 1, 0), "u8")
    for k in range(m):
        block = block * _MUL[1] + base[k : k + len(block)]
    none = c + m > first[row + 1]
    return np.where(none, np.uint64(0), (_mix(block) & np.uint64(0xFFFFFFFF))[np.where(none, 0, c)])


def merged_windows(key: np.ndarray, row: np.ndarray, l: np.ndarray, c: np.ndarray, r: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Windows of one document that follow each other with one min-hash at
    less than a window's length, as one: (first index, c, before, after)."""
    go_on = (key[1:] == key[:-1]) & (row[1:] == row[:-1]) & (np.diff(c) <= width)
    first = np.flatnonzero(np.append(True, ~go_on))
    last = np.append(first[1:], len(c)) - 1
    return first, c[first], np.minimum(c[first] - l[first], REACH), c[last] - c[first] + np.minimum(r[last] - c[last], REACH)


def windows(df: DataFrame, kind: str, hashes: int, width: int) -> DataFrame:
    """(id, sub, text) -> (key, id, sub, c, before, after): a window's
    min-hash (its lowest bits name the function), centre and extents."""

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            for part in slices(batch):
                words = [np.array([memo[w] for w in t.lower().split()], "u8") for t in part.column(2).to_pylist()]
                tokens = [shingle_hashes(w) for w in words]
                first = np.cumsum([0, *map(len, tokens)])
                base = np.concatenate(tokens) if tokens else np.empty(0, "u8")
                if len(base) < width:
                    continue
                for f in range(hashes):
                    h = _mix(base * _MUL[f] + np.uint64(f))
                    l, c, r = compact_windows(h, first, width)
                    if not len(c):
                        continue
                    row = np.searchsorted(first, c, side="right") - 1
                    ahead = _ahead(base, first, c, row, max(1, min(SHINGLE, width // 9)))
                    # a token's next occurrence is the same window if the same shingles follow
                    at, c, before, after = merged_windows(h[c] ^ (ahead << PLACE), row, l, c, r, width)
                    row, key = pa.array(row[at]), ((h[c] & ~np.uint64(7)) | np.uint64(f)).view("i8")
                    yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0).take(row), part.column(1).take(row), *(pa.array(x.astype("i4")) for x in (c - first[row.to_numpy()], before, after))], WINDOW)

    return df.mapInArrow(run, _WINDOW.format(k=kind))


_PAIR = "a_id {k}, a_sub int, b_id {k}, b_sub int, a_from int, a_to int, b_from int, b_to int"
PAIR = [c.split()[0] for c in _PAIR.split(", ")]


def _schema(spark, text: str):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = spark.createDataFrame([], text).schema
    return schema, to_arrow_schema(schema)


def _beside(left: pa.RecordBatch | None, right: pa.RecordBatch | None, arrow: pa.Schema, n: int) -> pa.RecordBatch:
    """Rows of either kind, the other kind's columns null; ``n`` are the first's."""
    rows = (left if left is not None else right).num_rows
    none = lambda fields: [pa.nulls(rows, f.type) for f in fields]
    fields = list(arrow)
    cols = [*(none(fields[:n]) if left is None else left.columns), *(none(fields[n:]) if right is None else right.columns)]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, fields)], arrow.names)


def _pairs_of(rows: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    c, before, after = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("c", "before", "after"))
    before, after = np.minimum(before[a], before[b]), np.minimum(after[a], after[b])
    ia, ib = pa.array(a), pa.array(b)
    ends = [x.astype("i4") for x in (c[a] - before, c[a] + after + SHINGLE, c[b] - before, c[b] + after + SHINGLE)]
    return pa.RecordBatch.from_arrays([rows.column("id").take(ia), rows.column("sub").take(ia), rows.column("id").take(ib), rows.column("sub").take(ib), *map(pa.array, ends)], PAIR)


def _codes(column: pa.Array) -> np.ndarray:
    """Numbers that are equal where neighbouring values are (null is a value)."""
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _join_groups(rows: pa.RecordBatch, size: np.ndarray, width: int) -> pa.RecordBatch | None:
    """All pairs of windows of different documents within the groups, which
    lie end to end."""
    key, sub, before, after = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("key", "sub", "before", "after"))
    ids, at, got = _codes(rows.column("id")), np.arange(rows.num_rows), []
    for step in range(1, int(size.max(initial=0))):
        at = at[at + step < rows.num_rows]
        at = at[(size[at] > step) & (key[at] == key[at + step])]
        a, b = at, at + step
        room = np.minimum(before[a], before[b]) + np.minimum(after[a], after[b]) + 1
        ok = ((ids[a] != ids[b]) | (sub[a] != sub[b])) & (room >= width)
        got.append((a[ok], b[ok]))
    if not sum(len(a) for a, _ in got):
        return None
    return _pairs_of(rows, *(np.concatenate(c) for c in zip(*got)))


def _whole_keys(batches, most: float = np.inf):
    """Batches of whole keys, as far as a key's rows are no more than ``most``."""
    kept = None
    for batch in gathered(batches):
        if kept is not None:
            batch = pa.concat_batches([kept, batch])
        key = batch.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        cut = batch.num_rows if batch.num_rows - cut > most else cut
        kept = batch.slice(cut) if cut < batch.num_rows else None
        if cut:
            yield batch.slice(0, cut)
    if kept is not None:
        yield kept


def _group_sizes(rows: pa.RecordBatch) -> np.ndarray:
    key = rows.column("key").to_numpy()
    return np.searchsorted(key, key, "right") - np.searchsorted(key, key, "left")


def joined_windows(found: DataFrame, kind: str, width: int, few: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, windows of keys of more than ``few``), by a range sort over
    (key, id). Keys at a seam between tasks or batches are joined by themselves."""
    spark = found.sparkSession
    ordered = found.repartitionByRange("key", "id", "sub").sortWithinPartitions("key", "id", "sub", "c")
    pair = _PAIR.format(k=kind)
    other = ", ".join(f"w_{c}" for c in _WINDOW.format(k=kind).split(", "))
    schema, arrow = _schema(spark, f"{pair}, {other}")

    def small(batches):
        first, held, open_key = None, None, None
        for rows in _whole_keys(batches, few):
            if held is not None:
                yield from parts(held, first, None, open_key)
                open_key = held.column("key")[-1].as_py()
            else:
                first = rows.column("key")[0].as_py()
            held = rows
        if held is not None:
            yield from parts(held, first, held.column("key")[-1].as_py(), open_key)

    def parts(rows, first, last, before):
        key, size = rows.column("key").to_numpy(), _group_sizes(rows)
        # keys that another task, or an earlier batch, may hold too are left like large ones
        full = size > few
        for k in (first, last, before):
            if k is not None:
                full |= key == k
        if full.any():
            yield _beside(None, rows.filter(pa.array(full)), arrow, len(PAIR))
        several = ~full & (size > 1)
        if several.any():
            got = _join_groups(rows.filter(pa.array(several)), size[several], width)
            if got is not None:
                yield _beside(got, None, arrow, len(PAIR))

    both = materialize(ordered.mapInArrow(small, schema), "passages-pairs")
    return both.where("a_to is not null").select(*PAIR), both.where("w_key is not null").select(*(F.col(f"w_{n}").alias(n) for n in WINDOW))


def _joined_by_key(rows: DataFrame, kind: str, width: int, few: int) -> DataFrame:
    """Pairs of the windows of each key; keys of at most ``few`` windows."""

    def run(batches):
        for part in _whole_keys(batches, few):
            got = _join_groups(part, _group_sizes(part), width)
            if got is not None:
                yield got

    return rows.select(*WINDOW).repartition("key").sortWithinPartitions("key", "id", "sub", "c").mapInArrow(run, _PAIR.format(k=kind))


def surroundings(crowded: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """The windows (with ``n``, how many their group has) and the words around
    their centres, as far as ``REACH`` and the window go, 16 bits each."""
    of = crowded.groupBy(F.col("id").alias("_id"), F.col("sub").alias("_sub")).agg(F.collect_list(F.struct("key", "c", "before", "after", "n")).alias("at"))
    # both sides grow with the data: no broadcast, at any size
    held = of.hint("merge").join(texts, of["_id"].eqNullSafe(texts["id"]) & (of["_sub"] == texts["sub"])).select("id", "sub", "text", "at")

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            for part in slices(batch):
                words = [np.array([memo[w] & 0xFFFF for w in t.lower().split()], "<u2") for t in part.column(2).to_pylist()]
                at = part.column(3)
                row = np.repeat(np.arange(part.num_rows), np.diff(at.offsets.to_numpy()))
                flat = at.flatten()
                c, before, after = (flat.field(n).to_numpy() for n in ("c", "before", "after"))
                lo, hi = (c - before).tolist(), (c + np.minimum(after, REACH) + SHINGLE).tolist()
                around = [words[k][x:y].tobytes() for k, x, y in zip(row.tolist(), lo, hi)]
                doc = pa.array(row)
                yield pa.RecordBatch.from_arrays([flat.field("key"), part.column(0).take(doc), part.column(1).take(doc), *(flat.field(n) for n in ("c", "before", "after", "n")), pa.array(around, pa.binary())], [*WINDOW, "n", "words"])

    return held.mapInArrow(run, _WINDOW.format(k=kind) + ", n long, words binary")


def _grid(rows: pa.RecordBatch) -> np.ndarray:
    """The windows' shingles by their distance to the centre (which stands at
    ``REACH``); zero where a window has none."""
    words, before = rows.column("words").to_pylist(), rows.column("before").to_numpy()
    size = np.array([len(w) // 2 for w in words])
    shingles = (shingle_hashes(np.frombuffer(b"".join(words), "<u2").astype("u8") + np.uint64(1)) >> np.uint64(32)).astype("u4") | np.uint32(1)
    start = np.cumsum(np.append(0, size[:-1]))
    have = np.maximum(size - SHINGLE + 1, 0)
    row = np.repeat(np.arange(len(size)), have)
    k = np.arange(len(row)) - np.repeat(np.cumsum(have) - have, have)
    out = np.zeros((len(size), 2 * REACH + 1), "u4")
    out[row, k - before[row] + REACH] = shingles[start[row] + k]
    return out


def _hashed(grid: np.ndarray, some: np.ndarray) -> np.ndarray:
    """A row of ones and zeros per window: which buckets the shingles marked in ``some`` fall into."""
    row, at = np.nonzero(some)
    out = np.zeros((len(grid), BUCKETS), bool)
    out[row, grid[row, at] >> np.uint32(1) & np.uint32(BUCKETS - 1)] = True
    return out


def _bits(hashed: np.ndarray) -> np.ndarray:
    return np.packbits(hashed, axis=1).view("u8")


_PLACES = _mix(np.arange(1, 2 * REACH + 2, dtype="u8"))


def _runs(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in order of value, starts of runs of equal values, run of each
    place), places of a run in order. Values go by their upper bits."""
    low = np.uint64((1 << max(int(at[-1]).bit_length(), 1)) - 1) if len(at) else np.uint64(0)
    packed = np.sort((values & ~low) | at.astype("u8"))
    first = np.flatnonzero(np.append(True, np.diff(packed & ~low) != 0)[: len(packed)])
    return (packed & low).astype("i8"), first, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(packed))))


def _equal_runs(grid: np.ndarray, group: np.ndarray, before: np.ndarray, after: np.ndarray, width: int):
    """For each place ``l`` of the centre in a run of ``width`` shingles:
    (l, the first window of the group with a run, each that has it)."""
    cum = np.zeros((len(grid), grid.shape[1] + 1), "u8")
    np.cumsum(grid * _PLACES, axis=1, out=cum[:, 1:])
    salt = group.astype("u8") * _MUL[4]
    for l in range(max(width - 1 - REACH, 0), min(width - 1, REACH) + 1):
        at = np.flatnonzero((before >= l) & (after >= width - 1 - l))
        if len(at) > 1:
            x = REACH - l
            places, first, run = _runs(_mix(cum[at, x + width] - cum[at, x] + salt[at]), np.arange(len(at)))
            yield l, at[places[first[run]]], at[places]


def _held(grid: np.ndarray, group: np.ndarray, who: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles of the windows ``who`` are held, at any place, by another
    document's window of their group, and which by an earlier document's."""
    near = grid[who]
    at = np.flatnonzero(near.ravel())
    row = (at // grid.shape[1]).astype("i4")
    value = _mix(near.ravel()[at] * _MUL[6] + group[who].astype("u8")[row] * _MUL[7])
    out = np.zeros((2, near.size), bool)
    if len(at):
        places, first, run = _runs(value, np.arange(len(at)))
        d = doc[who[row[places]]]
        least = np.minimum.reduceat(d, first)
        out[0, at[places]] = (least != np.maximum.reduceat(d, first))[run]
        out[1, at[places]] = least[run] < d
    return tuple(out.reshape(2, *near.shape))


def _apart(held: np.ndarray) -> np.ndarray:
    """From the first that is held to the last."""
    return held.shape[1] - held[:, ::-1].argmax(axis=1) - held.argmax(axis=1)


def near_windows(rows: pa.RecordBatch, share: np.ndarray | None, width: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b), a before b, between the windows of each key, in order of
    documents: the passages of a window's links cover all that is in a passage
    with any earlier window. With ``share`` only windows of different shares are linked."""
    n = rows.num_rows
    sub, before, after = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("sub", "before", "after"))
    ids, grid, key = _codes(rows.column("id")), _grid(rows), rows.column("key").to_numpy()
    before, after = np.minimum(before, REACH), np.minimum(after, REACH)
    new_group = np.append(False, key[1:] != key[:-1])
    group, doc = np.cumsum(new_group), np.cumsum(new_group | np.append(False, (ids[1:] != ids[:-1]) | (sub[1:] != sub[:-1])))
    marks, links = np.zeros((n, grid.shape[1] + 1), "i2"), [np.empty(0, "i8")]
    for l, a, b in _equal_runs(grid, group, before, after, width):
        ok = np.flatnonzero(doc[a] != doc[b])
        a, b = a[ok], b[ok]
        marks[b, REACH - l] += 1
        marks[b, REACH - l + width] -= 1
        if share is not None:  # a share's windows are linked with its own first: that one is enough
            ok = np.flatnonzero(share[a] != share[b])
            ok = ok[np.unique(a[ok], return_index=True)[1]]
            a, b = a[ok], b[ok]
        links.append(a * n + b)
    links = np.unique(np.concatenate(links))
    shown = np.cumsum(marks, axis=1)[:, :-1] > 0
    # a passage has at least so many different shingles, of which the other holds similarity
    least, repeats = _different(grid, width)
    least = np.maximum(np.ceil(similarity * least - 1e-6), 1)
    # windows that hold enough of what others hold, counted among those windows until few more go
    some = np.arange(n)
    while True:
        held, earlier = _held(grid, group, some, doc)
        enough = (held.sum(axis=1) >= least[some]) & (_apart(held) >= width)
        if not len(some) or enough.mean() > 0.9:
            break
        some = some[enough]
    compared = _Compared(grid[some], held, earlier, shown[some], repeats[some], width, similarity)
    mine = np.searchsorted(some, links // n), np.searchsorted(some, links % n)
    there = [np.append(some, -1)[x] == y for x, y in zip(mine, (links // n, links % n))]
    compared.show(*(x[there[0] & there[1]] for x in mine))
    todo = enough & (earlier.sum(axis=1) >= least[some]) & ((earlier | compared.between) & ~compared.shown).any(axis=1)
    more = []
    for a, b, common in _candidates(compared, group[some], todo, least[some]):
        x, y = some[a], some[b]
        room = np.minimum(before[x], before[y]) + np.minimum(after[x], after[y]) + 1
        ok = (doc[x] != doc[y]) & (room >= width) & (True if share is None else share[x] != share[y])
        more += compared.links(a[ok], b[ok], common[ok])
    a, b = (some[np.concatenate(x)] for x in zip(*more)) if more else (some[:0], some[:0])
    links = np.unique(np.concatenate([links, a * n + b]))
    return links // n, links % n


def _different(grid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least number of different shingles in ``width`` places
    that follow each other, and how many of its places repeat a shingle."""
    n = grid.shape[1]
    order = np.argsort(grid, axis=1, kind="stable")
    ordered = np.take_along_axis(grid, order, axis=1)
    row, k = np.nonzero((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] > 0))
    was, now = order[row, k], order[row, k + 1]
    less, near = np.zeros((len(grid), n + 1), "i2"), now - was < width
    np.add.at(less, (row[near], np.maximum(now[near] - width + 1, 0)), 1)
    np.add.at(less, (row[near], was[near] + 1), -1)
    there = grid > 0
    first, last = there.argmax(axis=1), n - there[:, ::-1].argmax(axis=1)
    at = np.arange(n + 1)
    less = np.where((at >= first[:, None]) & (at <= (last - width)[:, None]), np.cumsum(less, axis=1), 0)
    return width - less.max(axis=1), np.bincount(row, minlength=len(grid))


def _candidates(of: "_Compared", group: np.ndarray, todo: np.ndarray, least: np.ndarray):
    """Pairs (a, b, buckets in common) of a group's windows, a before b and ``b``
    to do, that may have shingles enough in common for a passage: as many
    buckets, less those in which a window's own shingles meet."""
    enough = least - of.lost
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    size = np.diff(np.append(first, len(group)))
    few = np.repeat(size <= MANY, size)
    at = np.flatnonzero(few)
    for step in range(1, MANY):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        a, b = at[todo[at + step]], at[todo[at + step]] + step
        common = np.bitwise_count(of.bits[a] & of.bits[b]).sum(axis=1, dtype="i4")
        ok = common >= np.maximum(enough[a], enough[b])
        if ok.any():
            yield a[ok], b[ok], common[ok]
    for lo, n in zip(first[size > MANY].tolist(), size[size > MANY].tolist()):
        theirs = _hashed(of.grid[lo : lo + n], of.held[lo : lo + n]).astype("f4")
        these = np.flatnonzero(todo[lo : lo + n])
        for k in range(0, len(these), 128):
            b = these[k : k + 128]
            common = theirs[b] @ theirs[: b[-1]].T
            ok = (common >= np.maximum(enough[lo + b][:, None], enough[None, lo : lo + b[-1]])) & (np.arange(b[-1])[None, :] < b[:, None])
            y, x = np.nonzero(ok)
            if len(x):
                yield lo + x, lo + b[y], common[y, x].astype("i4")


class _Compared:
    """Windows, and which of their places are in a passage with a window
    they are linked with (``shown``)."""

    def __init__(self, grid: np.ndarray, held: np.ndarray, earlier: np.ndarray, shown: np.ndarray, repeats: np.ndarray, width: int, similarity: float):
        self.grid, self.held, self.earlier, self.shown, self.repeats, self.width, self.similarity = grid, held, earlier, shown, repeats, width, similarity
        #: places that no earlier window holds, between such that one does
        self.between = ~earlier & np.maximum.accumulate(earlier, axis=1) & np.maximum.accumulate(earlier[:, ::-1], axis=1)[:, ::-1]
        hashed = _hashed(grid, held)
        self.bits = _bits(hashed)
        row, place = np.nonzero(held)
        named = row.astype("u8") << np.uint64(32) | grid[row, place]
        order = np.argsort(named)
        self.named, self.place = named[order], place[order]
        #: shingles that meet another one of their window in a bucket
        self.lost = np.bincount(row[order][np.append(True, self.named[1:] != self.named[:-1])[: len(row)]], minlength=len(grid)) - hashed.sum(axis=1)

    def show(self, a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            np.logical_or.at(self.shown, y, self.covered(x, y)[0])

    def fresh(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs may have in common what the second's links don't show yet,
        or what stands on both sides of that."""
        of, row = np.unique(b, return_inverse=True)
        left = ~self.shown[of]
        bits = _bits(_hashed(self.grid[of], self.earlier[of] & left))
        gap = (left & self.between[of]).any(axis=1)
        return gap[row] | (self.bits[a] & bits[row]).any(axis=1)

    def links(self, a: np.ndarray, b: np.ndarray, common: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Links by whose passages all is shown that the pairs' passages cover.
        Pairs that have most in common come first; one is left out only if all it may show is shown."""
        out, order = [], np.lexsort((a, -common, b))
        a, b = a[order], b[order]
        for turn in range(4):
            ok = np.concatenate([np.empty(0, bool), *(self.fresh(a[at : at + 65536], b[at : at + 65536]) for at in range(0, len(a), 65536))])
            a, b = a[ok], b[ok]
            best = np.append(True, b[1:] != b[:-1])[: len(b)] if turn < 3 else np.ones(len(b), bool)
            x, y = a[best], b[best]
            for at in range(0, len(x), 4096):
                out += self._taken(x[at : at + 4096], y[at : at + 4096])
            a, b = a[~best], b[~best]
        return out

    def _taken(self, a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        covers, first, last = self.covered(a, b)
        out = self._chosen(a, b, covers)
        # shingles that repeat or stand in another order are aligned one by one
        odd = np.flatnonzero(last - first >= self.width)
        odd = odd[self._open(b[odd], first[odd], last[odd])]
        a, b, first, last = a[odd], b[odd], first[odd], last[odd]
        ok = self._may_hold(a, b)
        a, b, first, last = a[ok], b[ok], first[ok], last[ok]
        while len(a):
            best = np.append(True, b[1:] != b[:-1])
            covers = np.zeros((best.sum(), self.grid.shape[1]), bool)
            for k, (x, y) in enumerate(zip(a[best].tolist(), b[best].tolist())):
                for lo, hi in _spans(self.grid[x], self.grid[y], self.width, self.similarity):
                    covers[k, lo:hi] = True
            out += self._chosen(a[best], b[best], covers)
            left = np.flatnonzero(~best)
            left = left[self._open(b[left], first[left], last[left])]
            a, b, first, last = a[left], b[left], first[left], last[left]
        return out

    def _open(self, b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which windows have a place between the two that isn't shown yet."""
        count = np.cumsum(np.pad(~self.shown[b], ((0, 0), (1, 0))), axis=1, dtype="i2")
        row = np.arange(len(b))
        return count[row, last] > count[row, first]

    def _chosen(self, a: np.ndarray, b: np.ndarray, covers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Links of these pairs: for each window the one that shows most, until none shows more."""
        out = []
        while True:
            gain = (covers & ~self.shown[b]).sum(axis=1)
            ok = gain > 0
            if not ok.any():
                return out
            a, b, covers, gain = a[ok], b[ok], covers[ok], gain[ok]
            order = np.lexsort((a, -gain, b))
            best = order[np.append(True, b[order][1:] != b[order][:-1])]
            self.shown[b[best]] |= covers[best]
            out.append((a[best], b[best]))

    def covered(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the windows ``b`` that are in a passage which ``a`` holds too;
        and for pairs with shingles that repeat or stand in another order, of
        which only equal runs are taken, between which places of ``b`` there may be more."""
        ours, theirs = self.grid[b], self.grid[a]
        same = (ours == theirs) & (ours > 0)
        to = np.where(same, np.arange(ours.shape[1], dtype="i2"), np.int16(-1))
        k, p = np.nonzero((to < 0) & self.held[b])
        if len(k):
            want = a[k].astype("u8") << np.uint64(32) | ours[k, p]
            at = np.minimum(np.searchsorted(self.named, want), len(self.named) - 1)
            hit = self.named[at] == want
            to[k[hit], p[hit]] = self.place[at[hit]]
        there = to >= 0
        odd = (self.repeats[a] > 0) | (self.repeats[b] > 0)
        odd |= (there[:, 1:] & (to[:, 1:] <= np.maximum.accumulate(to, axis=1)[:, :-1])).any(axis=1)
        out = np.zeros(ours.shape, bool)
        some = np.flatnonzero(~odd & (there.sum(axis=1) >= self.similarity * self.width))
        out[some] = _cover(to[some], self.width, self.similarity)
        odd = np.flatnonzero(odd)
        out[odd] = _long_runs(same[odd], self.width)
        # an earlier window's shingles that are all at their own places are aligned with nothing else
        astray = (self.found(theirs[odd], b[odd]) & ~same[odd]).any(axis=1)
        hull = np.where(astray[:, None], there[odd], same[odd])
        first, last = np.zeros(len(a), "i8"), np.zeros(len(a), "i8")
        first[odd], last[odd] = hull.argmax(axis=1), np.where(hull.any(axis=1), hull.shape[1] - hull[:, ::-1].argmax(axis=1), 0)
        return out, first, last

    def _may_hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have shingles enough in common, at any place, for ``_cut``."""
        ours, theirs = self.grid[b], self.grid[a]
        held, placed = self.found(ours, a), self.found(theirs, b)
        return ((placed.sum(axis=1) >= self.similarity * self.width) & _may_hold(held, ours, self.repeats[b], self.width, self.similarity)
                & _may_hold(placed, theirs, self.repeats[a], self.width, self.similarity))

    def found(self, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Which shingles of the rows the windows ``which`` hold."""
        out, (k, p) = np.zeros(rows.shape, bool), np.nonzero(rows)
        want = which[k].astype("u8") << np.uint64(32) | rows[k, p]
        out[k, p] = self.named[np.minimum(np.searchsorted(self.named, want), len(self.named) - 1)] == want
        return out


def _long_runs(same: np.ndarray, width: int) -> np.ndarray:
    """Places in runs of ``width`` or more."""
    count = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1, dtype="i2")
    full = count[:, width:] - count[:, :-width] == width
    ends = np.zeros(count.shape, "i2")
    ends[:, : full.shape[1]] += full
    ends[:, width:] -= full
    return np.cumsum(ends, axis=1)[:, :-1] > 0


def _cover(to: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Places in a passage, of rows that say for each place which one it is
    aligned with (-1: none; in order, none twice). Of a passage from s to e with
    ``m`` aligned places the similarity is m / (both lengths - m), so it is similar
    enough if a sum that grows with the aligned and falls with the lengths is at e no less than at s."""
    ratio, n = (1 + similarity) / similarity, to.shape[1]
    there = to >= 0
    level = np.float32(ratio) * np.cumsum(there, axis=1, dtype="f4") - np.arange(n, dtype="f4") - to
    high = np.where(there, level, -np.inf)
    low = np.where(there, level + np.float32(2 - ratio - 1e-3), np.inf)
    high = np.maximum.accumulate(high[:, ::-1], axis=1)[:, ::-1]
    begin = np.zeros(to.shape, bool)
    begin[:, : n - width + 1] = high[:, width - 1 :] >= low[:, : n - width + 1]
    out = np.zeros((len(to), n + 1), "i2")
    rows = np.flatnonzero(begin.any(axis=1))
    while len(rows):
        s = begin[rows].argmax(axis=1)
        least = low[rows, s]
        e = (high[rows] >= least[:, None]).sum(axis=1) - 1  # the furthest
        ok = to[rows, e] - to[rows, s] >= width - 1
        np.add.at(out, (rows[ok], s[ok]), 1)
        np.add.at(out, (rows[ok], e[ok] + 1), -1)
        begin[rows] &= low[rows] < least[:, None]  # others end no further
        rows = rows[begin[rows].any(axis=1)]
    return np.cumsum(out, axis=1)[:, :-1] > 0


def _may_hold(held: np.ndarray, rows: np.ndarray, repeats: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Which rows of the grid have ``width`` places or more that follow each
    other, of whose shingles (less those that may repeat) the other holds similarity."""
    if not len(rows):
        return np.zeros(0, bool)
    level = np.cumsum(np.pad(held - similarity * (rows > 0), ((0, 0), (1, 0))), axis=1)
    return (level[:, width:] - np.minimum.accumulate(level, axis=1)[:, :-width]).max(axis=1) >= -similarity * repeats - 1e-6


def _spans(a: np.ndarray, b: np.ndarray, width: int, similarity: float) -> list[tuple[int, int]]:
    """Passages of a row ``b`` of the grid that the row ``a`` holds too."""
    x, y = np.flatnonzero(a)[0], np.flatnonzero(b)[0]
    sa, sb = a[a > 0], b[b > 0]
    return [(y + lo, y + hi - SHINGLE + 1) for _, _, lo, hi, _ in _cut(*_place(sa, sb, int(x - y)), sa, sb, width, similarity)]


def crowded_pairs(crowded: DataFrame, texts: DataFrame, kind: str, width: int, few: int, similarity: float) -> DataFrame:
    """Pairs of the windows of large keys (and of keys at seams, which may
    turn out to be small)."""
    count = crowded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = crowded.join(count, "key")
    small = _joined_by_key(met.where(F.col("n") <= few), kind, width, few)
    rows = surroundings(met.where(F.col("n") > few), texts, kind)
    shares = F.ceil(F.col("n") / BLOCK)
    rows = rows.withColumn("share", F.pmod(F.xxhash64("id", "sub", "c"), shares)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)))
    # two shares of a group are a group of their own
    rows = rows.withColumn("key", F.xxhash64("key", F.least("share", "other"), F.greatest("share", "other")))
    rows = rows.select(*WINDOW, "share", (F.col("share") == F.col("other")).alias("within"), "words")

    def run(batches):
        for part in _whole_keys(batches):
            within = part.column("within").to_numpy(zero_copy_only=False).astype(bool)
            for w in (False, True):
                for group in _some_keys(part.filter(pa.array(within == w))):
                    x, y = near_windows(group, None if w else group.column("share").to_numpy(), width, similarity)
                    if len(x):
                        yield _pairs_of(group, x, y)

    return small.unionAll(rows.repartition("key").sortWithinPartitions("key", "id", "sub", "c").mapInArrow(run, _PAIR.format(k=kind)))


def _some_keys(rows: pa.RecordBatch, most: int = 8192):
    """The rows in parts of whole keys, of about ``most`` rows."""
    key = rows.column("key").to_numpy()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    at = np.unique(first[np.searchsorted(first, np.arange(0, len(key), most), "right") - 1]) if len(first) else first
    for x, y in zip(at.tolist(), [*at[1:].tolist(), len(key)]):
        yield rows.slice(x, y - x)


def _place(tokens: np.ndarray, among: np.ndarray, offset: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the tokens that occur among the others, and where: of all
    occurrences the nearest to the offset (the usual one, if none is given)."""
    order = np.argsort(among, kind="stable")
    first = np.searchsorted(among, tokens, "left", sorter=order)
    last = np.searchsorted(among, tokens, "right", sorter=order)
    at = np.flatnonzero(last > first)
    first, last = first[at], last[at]
    if offset is None:
        offset = np.median(order[first] - at) if len(at) else 0
    # (value, place) as one number: the group's start, then the place
    n, group = len(among) + 1, np.zeros(len(among), "i8")
    if len(among):
        group = np.searchsorted(among, among[order], "left", sorter=order)
    want = np.searchsorted(group * n + order, first * n + np.clip(np.rint(at + offset), 0, n - 1).astype("i8"))
    after, before = np.minimum(want, last - 1), np.maximum(want - 1, first)
    near = lambda k: np.abs(order[k] - at - offset)
    return at, order[np.where(near(before) <= near(after), before, after)] if len(at) else at


def _cut(at: np.ndarray, to: np.ndarray, sa: np.ndarray, sb: np.ndarray, width: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """Passages of shingles ``at`` aligned with ``to``, cut at the widest
    break (on either side) until a piece is similar enough or too short, and
    those that such cuts go through."""
    if len(at) < similarity * width:
        return []
    # shingles as small numbers, so that sets are counts
    number, codes = np.unique(np.concatenate([sa, sb]), return_inverse=True)
    ca, cb, n = codes[: len(sa)], codes[len(sa) :], len(number)
    breaks = np.maximum(np.diff(at), np.abs(np.diff(to)))
    todo, out = [(0, len(at))], []
    while todo:
        s, e = todo.pop()
        if e - s < similarity * width:
            continue
        x, y, lo, hi = int(at[s]), int(at[e - 1]) + 1, int(to[s:e].min()), int(to[s:e].max()) + 1
        if y - x >= width and hi - lo >= width:
            ours, theirs = np.bincount(ca[x:y], minlength=n) > 0, np.bincount(cb[lo:hi], minlength=n) > 0
            like = np.count_nonzero(ours & theirs) / np.count_nonzero(ours | theirs)
            if like >= similarity:
                out.append((x, y + SHINGLE - 1, lo, hi + SHINGLE - 1, like))
                continue
        if e - s > 1:
            k = s + int(breaks[s : e - 1].argmax()) + 1
            todo += [(s, k), (k, e)]
    if len(out) == 1 and out[0][2] <= to.min() and out[0][3] - SHINGLE >= to.max():
        return out
    # what the cuts left out of any passage, as far as it is in none of ``out``
    cut = np.zeros(len(sb), bool)
    for _, _, lo, hi, _ in out:
        cut[lo : hi - SHINGLE + 1] = True
    for s, e in _similar_pieces(at, to, width, similarity):
        x, y, lo, hi = int(at[s]), int(at[e]) + 1, int(to[s]), int(to[e]) + 1
        if not cut[lo:hi].all():
            ours, theirs = np.bincount(ca[x:y], minlength=n) > 0, np.bincount(cb[lo:hi], minlength=n) > 0
            like = np.count_nonzero(ours & theirs) / np.count_nonzero(ours | theirs)
            if like >= similarity:
                out.append((x, y + SHINGLE - 1, lo, hi + SHINGLE - 1, like))
                cut[lo:hi] = True
    return out


def _similar_pieces(at: np.ndarray, to: np.ndarray, width: int, similarity: float) -> list[tuple[int, int]]:
    """First and last of the aligned shingles of each passage that none goes beyond
    (by the sum of ``_cover``, that is without regard to repeats, and where the order is the same on both sides)."""
    if len(at) < 2 or (np.diff(to) <= 0).any():
        return []
    ratio = (1 + similarity) / similarity
    level = ratio * np.arange(len(at)) - at - to
    high = np.maximum.accumulate(level[::-1])[::-1]
    last = np.searchsorted(-high, ratio - 2 + 1e-6 - level, "right") - 1
    ok = np.flatnonzero((at[last] - at >= width - 1) & (to[last] - to >= width - 1) & (last > np.maximum.accumulate(np.append(-1, last[:-1]))))
    return list(zip(ok.tolist(), last[ok].tolist()))


def common_passages(a: np.ndarray, b: np.ndarray, min_words: int, similarity: float, offset: int | None = None) -> list[tuple[int, int, int, int, float]]:
    """(a_from, a_to, b_from, b_to, similarity) in words, of two word-hash
    sequences aligned by their shingles."""
    sa, sb = (shingle_hashes(x.astype("u8") + np.uint64(1)) for x in (a, b))
    return _cut(*_place(sa, sb, offset), sa, sb, min_words - SHINGLE + 1, similarity)


def verified(ours: list[bytes], theirs: list[bytes], min_words: int, similarity: float) -> list[tuple[int, int, int, int, int, float]]:
    """(pair, a_from, a_to, b_from, b_to, similarity) of stretches that lie at
    their offset, as ``common_passages`` finds them. All pairs are compared
    together; only those with shingles that meet at another offset and not at
    their own are aligned one by one."""
    width, out = min_words - SHINGLE + 1, []
    size = np.array([len(x) // 4 for x in ours], "i8")
    even = size == [len(x) // 4 for x in theirs]
    for k in np.flatnonzero(~even).tolist():
        out += [(k, *x) for x in common_passages(np.frombuffer(ours[k], "<u4"), np.frombuffer(theirs[k], "<u4"), min_words, similarity, 0)]
    of = np.flatnonzero(even & (size >= min_words))
    if not len(of):
        return out
    a, b = (np.frombuffer(b"".join([x[k] for k in of.tolist()]), "<u4") for x in (ours, theirs))
    pair = np.repeat(np.arange(len(of)), size[of])
    inside = pair[: len(pair) - SHINGLE + 1] == pair[SHINGLE - 1 :]
    sa, sb = (shingle_hashes(x.astype("u8") + np.uint64(1)) for x in (a, b))
    same = (sa == sb) & inside
    # shingles that the offset leaves over on both sides but that meet at another one
    left = np.flatnonzero(inside & ~same)
    salt = (pair[left].astype("u8") + np.uint64(1)) * _MUL[2]
    theirs_left = np.sort(sb[left] ^ salt)
    at = np.minimum(np.searchsorted(theirs_left, sa[left] ^ salt), max(len(left) - 1, 0))
    astray = np.zeros(len(of), bool)
    if len(left):
        astray[pair[left[theirs_left[at] == sa[left] ^ salt]]] = True
    start = np.cumsum(np.append(0, size[of]))
    at = np.flatnonzero(same)
    ends = np.searchsorted(at, start)
    runs = np.add.reduceat(np.append(True, (np.diff(at) > 1) | (pair[at[1:]] != pair[at[:-1]])), np.minimum(ends[:-1], max(len(at) - 1, 0))) if len(at) else np.zeros(len(of), int)
    for k in range(len(of)):
        mine = at[ends[k] : ends[k + 1]]
        if astray[k]:
            x, y = slice(start[k], start[k + 1]), slice(start[k], start[k + 1])
            out += [(int(of[k]), *p) for p in common_passages(a[x], b[y], min_words, similarity, 0)]
        elif len(mine) >= similarity * width:
            mine = mine - start[k]
            if runs[k] == 1:  # one gapless run: equal words
                if len(mine) >= width:
                    out.append((int(of[k]), int(mine[0]), int(mine[-1]) + SHINGLE, int(mine[0]), int(mine[-1]) + SHINGLE, 1.0))
            else:
                n = size[of[k]] - SHINGLE + 1
                out += [(int(of[k]), *p) for p in _cut(mine, mine, sa[start[k] : start[k] + n], sb[start[k] : start[k] + n], width, similarity)]
    return out


#: Stretches that are cut from one copy of a text.
CUTS = 2000


def _stretches(sides: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """(pair, offset, side, id, sub, lo, hi) -> the same with the words of the
    stretch. A text travels once for up to ``CUTS`` of its stretches: texts and
    stretches are sorted together, a text before its own."""
    asked = sides.groupBy("id", "sub").agg((F.floor((F.count(F.lit(1)) - 1) / CUTS) + 1).cast("int").alias("parts"))
    asked = materialize(asked, "passages-asked")
    several = asked.where("parts > 1").select(F.col("id").alias("_id"), F.col("sub").alias("_sub"), "parts")
    same = lambda df: df["id"].eqNullSafe(F.col("_id")) & (df["sub"] == F.col("_sub"))
    part = F.pmod(F.xxhash64("pair", "offset"), F.coalesce("parts", F.lit(1))).cast("int")
    of = sides.join(several, same(sides), "left").select("id", "sub", part.alias("part"), F.lit(1).alias("kind"), "pair", "side", "offset", "lo", "hi", F.lit(None).cast("string").alias("text"))
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("pair", "long"), ("side", "string"), ("offset", "int"), ("lo", "int"), ("hi", "int"))}
    # both sides grow with the data: no broadcast, at any size
    held = texts.join(asked.select(F.col("id").alias("_id"), F.col("sub").alias("_sub"), "parts").hint("merge"), same(texts))
    held = held.select("id", "sub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), *none.values(), "text")
    keys = ["id", "sub", "part"]
    rows = held.unionAll(of).repartition(*keys).sortWithinPartitions(*keys, "kind").select("kind", "pair", "side", "id", "sub", "lo", "offset", "hi", "text")

    def run(batches):
        memo, words = WordHashes(), None
        for batch in batches:
            for part in slices(batch):
                kinds, lo, hi, texts_ = (part.column(n).to_pylist() for n in ("kind", "lo", "hi", "text"))
                at, out = [], []
                for k, (is_cut, a, b, t) in enumerate(zip(kinds, lo, hi, texts_)):
                    if is_cut:
                        at.append(k)
                        out.append(words[a:b].tobytes())
                    else:
                        words = np.array([memo[w] & 0xFFFFFFFF for w in t.lower().split()], "<u4")
                cut = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(cut.column(n) for n in ("pair", "side", "id", "sub", "lo", "offset")), pa.array(out, pa.binary())], ["pair", "side", "id", "sub", "lo", "offset", "words"])

    return rows.mapInArrow(run, f"pair long, side string, id {kind}, sub int, lo int, offset int, words binary")


def _copies(src: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(texts, copies): each text once, under its smallest id, and the rows
    of the other ids with the first one's id and the number of words."""
    smallest = F.min(F.struct(F.col("id").isNotNull().alias("there"), "id"))["id"]
    groups = src.groupBy("h", "sub").agg(F.count("*").alias("n"), smallest.alias("first")).where("n > 1")
    groups = materialize(groups, "passages-copies").select(F.col("h").alias("_h"), F.col("sub").alias("_sub"), "n", "first")
    marked = src.join(groups, (F.col("h") == F.col("_h")) & (F.col("sub") == F.col("_sub")), "left")
    several = marked.where("n is not null")

    def count(batches):
        for batch in batches:
            for part in slices(batch):
                n = [len(t.split()) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int32())], ["h", "sub", "id", "text", "words"])

    firsts = several.groupBy("h", "sub").agg(F.any_value("first").alias("id"), F.any_value("text").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    firsts = materialize(firsts.mapInArrow(count, f"h long, sub int, id {kind}, text string, words int"), "passages-firsts")
    texts = marked.where("n is null").select("id", "sub", "text").unionAll(firsts.select("id", "sub", "text"))
    others = several.where(~F.col("id").eqNullSafe(F.col("first"))).select("h", "sub", "id", "first").distinct()
    long_ = firsts.where(F.col("words") >= min_words).select("h", "sub", "words")
    return texts, others.join(long_, ["h", "sub"]).select("id", "sub", "first", "words")


def duplicate_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, similarity: float = 0.8, hashes: int = 4, few: int = 4) -> DataFrame:
    """(id, start, end, source_id, source_start, source_end, similarity): a
    passage of a document, in words, that nearly repeats one of an earlier
    document (smaller id)."""
    spark = df.sparkSession
    width = min_words - SHINGLE + 1
    src = id_text(df, id_col, text_col).where("text is not null")
    src = src.select("id", F.hash("text").alias("sub"), F.xxhash64("text").alias("h"), "text")
    kind = src.schema[0].dataType.simpleString()
    src, copies = _copies(src, min_words)
    path = scratch_path(spark, "passages-windows")
    windows(src, kind, hashes, width).write.parquet(path)
    joined, crowded = joined_windows(spark.read.parquet(path), kind, width, few)
    fs.delete_dir(spark, path)  # the largest intermediate: all that is needed of it was written on
    joined = joined.unionAll(crowded_pairs(crowded, src, kind, width, few, similarity))
    # a stretch for each offset: a document's other copies of a passage are stretches of their own
    pairs = joined.withColumn("offset", F.col("b_from") - F.col("a_from"))
    pairs = pairs.groupBy("a_id", "a_sub", "b_id", "b_sub", "offset").agg(*((F.min if e.endswith("from") else F.max)(e).alias(e) for e in ("a_from", "a_to", "b_from", "b_to")))
    pair = F.xxhash64("a_id", "a_sub", "b_id", "b_sub").alias("pair")
    sides = pairs.select(pair, "offset", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_id").alias("id"), F.col(f"{s}_sub").alias("sub"), F.col(f"{s}_from").alias("lo"), F.col(f"{s}_to").alias("hi")) for s in "ab"))).alias("x")).select("pair", "offset", "x.*")
    sides = _stretches(materialize(sides, "passages-sides"), src, kind)
    one = lambda side, *cols: F.any_value(F.when(F.col("side") == side, F.struct(*cols)), True).alias(side)
    # both sides of a stretch in one row (equal rows give equal ones)
    two = sides.groupBy("pair", "offset").agg(one("a", F.col("id").alias("source_id"), F.col("lo").alias("source_lo"), F.col("words").alias("source_words")),
                                              one("b", "id", "sub", "lo", "words")).select("a.*", "b.*", "offset", "pair")

    def verify(batches):
        names = ["pair", "id", "sub", "start", "end", "source_id", "source_start", "source_end", "similarity"]
        for batch in batches:
            for part in slices(batch):
                cols = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                lo_a, a, lo_b, b = (cols[n].to_pylist() for n in ("source_lo", "source_words", "lo", "words"))
                # both sides begin at the same place before the windows that met: at their offset
                out = [(k, lo_b[k] + x[2], lo_b[k] + x[3], lo_a[k] + x[0], lo_a[k] + x[1], x[4]) for k, *x in verified(a, b, min_words, similarity)]
                if out:
                    k, start, end, s_start, s_end, like = zip(*out)
                    rows = pa.array(k, pa.int64())
                    yield pa.RecordBatch.from_arrays([cols["pair"].take(rows), cols["id"].take(rows), cols["sub"].take(rows), pa.array(start, pa.int32()), pa.array(end, pa.int32()), cols["source_id"].take(rows), pa.array(s_start, pa.int32()), pa.array(s_end, pa.int32()), pa.array(like, pa.float64())], names)

    out = two.mapInArrow(verify, f"pair long, id {kind}, sub int, start int, end int, source_id {kind}, source_start int, source_end int, similarity double")
    # one row for a passage that several offsets found
    out = out.dropDuplicates(["pair", "start", "end", "source_start", "source_end"]).drop("pair")
    whole = copies.select("id", "sub", F.lit(0).alias("start"), F.col("words").alias("end"), F.col("first").alias("source_id"), F.lit(0).alias("source_start"), F.col("words").alias("source_end"), F.lit(1.0).alias("similarity"))
    out = out.unionAll(whole)
    return out.select(F.col("id").alias(id_col), F.col("sub").alias("text_hash"), "start", "end", "source_id", "source_start", "source_end", "similarity")


def drop_passages(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with their repeated passages cut out of the text; all other
    columns, and texts without such a passage, stay as they are. A row goes
    if nothing of its text is left."""
    spare = lambda name: name if name not in df.columns else spare(f"_{name}")
    its_id, its_hash, its_spans, was_cut = map(spare, ("_id", "_hash", "_spans", "_cut"))
    spans = found.groupBy(F.col(id_col).alias(its_id), F.col("text_hash").alias(its_hash)).agg(F.collect_set(F.struct("start", "end")).alias(its_spans))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(text, spans):
            if t is None or found is None or not len(found):
                out.append(t)
                continue
            words = [m.span() for m in WORDS(t)]
            kept, at = [], 0
            for s in sorted((x["start"], x["end"]) for x in found):
                a, b = words[s[0]][0], words[min(s[1], len(words)) - 1][1]
                if b > at:
                    kept.append(t[at : max(a, at)])
                    at = b
            out.append("".join([*kept, t[at:]]).strip())
        return pd.Series(out, dtype=object)

    joined = df.join(spans, df[id_col].eqNullSafe(spans[its_id]) & (F.hash(df[text_col]) == spans[its_hash]), "left")
    has = spans[its_spans].isNotNull()
    text = F.when(has, cut(df[text_col].cast("string"), spans[its_spans])).otherwise(df[text_col])
    rows = joined.select(*(text.alias(c) if c == text_col else df[c] for c in df.columns), has.alias(was_cut))
    return rows.where(~F.col(was_cut) | (F.col(text_col) != "")).drop(was_cut)
