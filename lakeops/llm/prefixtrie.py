"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns (role, text). The nodes of the trie are
the distinct sequences of first turns; a node's name is its depth with its
smallest member, which is exact: a conversation has one prefix of each length.

Method: ``conversation_pieces`` puts turns in order and names each by a
128-bit hash. ``prefix_trie`` cuts the sequences of a tree of height 2^k at
half depth. Equal upper halves are one cut prefix, named by the smallest
member and carrying the number of members: these are the upper tree's
sequences. The lower halves belong to the forest below, each to the tree that
hangs from its cut prefix. Upper tree and lower forests are cut again
together, all trees of one height in one pass, until trees are one turn high
and every row is a node. The cuts are kept: they lead from a cut node to its
tree's root, and from a tree's bottom to the cut above it. Totals are then
grafted upward along them: sums of the lower trees, from the smallest trees to
the largest, are passed to the cut nodes, and from the largest cut down to the
nodes on the way (halving the way each time). That is one join and one sum for
each doubling of the depth, over a geometric number of rows.

Scale: texts are read once and leave as 24 bytes a turn. Turns are sorted by
ranges of (conversation, turn), so a conversation of any length is spread over
tasks, and kept in pieces of at most ``chunk`` turns; longer conversations are
first cut between pieces (a piece counts as one element), then within. Equal
sequences and shared prefixes are counted before anything is gathered, so a
first turn that all conversations share is one row of an upper tree. Members
that end at a node are hashed as a sorted stream, in parts made by many tasks;
SHA-256 itself reads the joined parts of a node in order, with constant memory.

Defined results: rows with a null conversation id belong to none and take no
part; a null turn comes first, turns with one number go by their content's
hash; null role and text are empty; a repeated row is a turn of its own; an
empty table gives an empty table (a root would have no member). Only the named
columns are read, so extra columns of any name are ignored. Texts are taken
whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import gathered
from lakeops.session import materialize

#: Turns of one piece of a conversation (a power of two).
CHUNK = 4096
#: Members joined to one part of a node's hashed text.
PART = 8192
_TURNS = "array<struct<name:binary,words:bigint>>"


def _short(text) -> F.Column:
    return F.unhex(F.left(F.sha2(text, 256), F.lit(32)))


def _none() -> F.Column:
    return F.array().cast(_TURNS)


# -- sequences --------------------------------------------------------------


def conversation_pieces(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(conv, at, whole, turns): the conversations' turns in order, in pieces
    of at most ``chunk`` that start at position ``at``; ``whole`` pieces are
    all of their conversation. A turn is its name and its number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        _short(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("name"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    named = materialize(named, "trie-turns")
    order = ["conv", F.asc_nulls_first("turn"), "name"]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "name", "words")

    def run(batches):
        task, first, last, last_at, kept = TaskContext.get().partitionId(), None, None, 0, None

        def cut(rows, more):
            """Pieces of the rows; ``more``: the last conversation may go on."""
            nonlocal last, last_at
            conv = rows.column(0).to_numpy()
            new = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            size = np.diff(np.append(new, len(conv)))
            n = -(-size // chunk)  # pieces of each run
            run = np.repeat(np.arange(len(new)), n)
            within = (np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)) * chunk
            begin = new[run] + within
            at = within + np.where((run == 0) & (conv[0] == last), last_at, 0)
            whole = (n[run] == 1) & (at == 0) & (conv[begin] != first)
            if more:
                whole &= run != len(new) - 1
            ends = np.append(begin, len(conv)).astype("i4")
            last, last_at = conv[-1], int(at[-1] + ends[-1] - ends[-2])
            turns = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([rows.column(1), rows.column(2)], ["name", "words"]))
            return pa.RecordBatch.from_arrays([pa.array(conv[begin]), pa.array(np.full(len(run), task)), pa.array(at), pa.array(whole), turns], ["conv", "task", "at", "whole", "turns"])

        for batch in gathered(batches, 20_000):
            rows = batch if kept is None else pa.concat_batches([kept, batch])
            conv = rows.column(0).to_numpy()
            first = conv[0] if first is None else first
            open_ = int(np.searchsorted(conv, conv[-1]))
            ready = open_ + (rows.num_rows - open_) // chunk * chunk
            kept = rows.slice(ready)
            if open_:
                yield cut(rows.slice(0, open_), False)
            if ready > open_:
                yield cut(rows.slice(open_, ready - open_), True)
        if kept is not None and kept.num_rows:
            yield cut(kept, True)

    pieces = materialize(ordered.mapInArrow(run, f"conv long, task long, at long, whole boolean, turns {_TURNS}"), "trie-pieces")
    # conversations at a seam between tasks: their places go on from the tasks before
    part = pieces.where(~F.col("whole"))
    sizes = part.groupBy("conv", "task").agg(F.sum(F.size("turns")).alias("n"))
    before = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("conv", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    part = part.join(ahead, ["conv", "task"]).select("conv", (F.col("at") + F.col("ahead")).alias("at"), "whole", "turns")
    return pieces.where("whole").select("conv", "at", "whole", "turns").unionAll(part)


def share_heads(pieces: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations rebuilt with a shared head: the first h turns are those
    of conversation c - c % ``every`` (all if it has fewer, none if it is
    absent), with h the CRC32 of c's decimal text modulo ``most`` + 1."""
    first = pieces.where((F.col("conv") % every == 0) & (F.col("at") < most)).select("conv", "at", F.posexplode("turns").alias("i", "turn"))
    first = first.withColumn("at", F.col("at") + F.col("i")).where(F.col("at") < most)
    heads = first.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "turn"))).alias("head")).select(F.col("conv").alias("base"), F.col("head.turn").alias("head"))
    h = F.crc32(F.col("conv").cast("string")) % (most + 1)
    own = pieces.withColumn("h", h.cast("int")).withColumn("base", F.col("conv") - F.col("conv") % every)
    own = own.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", _none()), F.lit(1), F.col("h")))
    gone = F.greatest(F.col("h") - F.col("at"), F.lit(0)).cast("int")  # of this piece's first turns
    rest = F.when(gone < F.size("turns"), F.slice("turns", gone + 1, F.size("turns"))).otherwise(_none())
    starts = F.col("at") == 0
    return own.select("conv", F.when(starts, F.lit(0)).otherwise(F.greatest(F.col("at") - F.col("h"), F.lit(0)) + F.size("head")).cast("long").alias("at"),
                      "whole", F.when(starts, F.concat("head", rest)).otherwise(rest).alias("turns"))


def _aligned(pieces: DataFrame, chunk: int) -> DataFrame:
    """(conv, no, turns): piece ``no`` holds the turns from no * chunk on."""
    fits = F.col("whole") & (F.size("turns") <= chunk)
    others = pieces.where(~fits)
    turns = others.select("conv", "at", F.posexplode("turns").alias("i", "turn")).withColumn("at", F.col("at") + F.col("i"))
    again = turns.groupBy("conv", F.floor(F.col("at") / chunk).alias("no")).agg(F.sort_array(F.collect_list(F.struct("at", "turn"))).alias("turns"))
    # a conversation left without any turn is a member of the root
    bare = others.groupBy("conv").agg(F.sum(F.size("turns")).alias("n")).where("n = 0").select("conv", F.lit(0).cast("long").alias("no"), _none().alias("turns"))
    return pieces.where(fits).select("conv", F.lit(0).cast("long").alias("no"), "turns").unionAll(again.select("conv", "no", F.col("turns.turn").alias("turns"))).unionAll(bare)


# -- members that end at a node -----------------------------------------------


def _ends(sequences: DataFrame) -> DataFrame:
    """(seq, conv, length) -> (low, n, length, sha) for each distinct sequence:
    its smallest member, how many there are, the hash of their ids in order."""
    out = "seq binary, length long, low long, n long, sha string, text string"
    names = [c.split()[0] for c in out.split(", ")]
    ordered = sequences.repartitionByRange("seq", "conv").sortWithinPartitions("seq", "conv").select("seq", "conv", "length")

    def run(batches):
        first, seq, held, length = True, None, [], 0
        cols: list[list] = [[] for _ in names]

        def close(seam):
            text = ",".join(map(str, held))
            for col, value in zip(cols, (seq, length, held[0], len(held), None if seam else hashlib.sha256(text.encode()).hexdigest(), text if seam else None)):
                col.append(value)

        for batch in gathered(batches):
            for s, c, n in zip(*(col.to_pylist() for col in batch.columns)):
                if s != seq:
                    if held:
                        close(first)
                        first = False
                    elif seq is not None:
                        first = False
                    seq, held, length = s, [], n
                held.append(c)
                if len(held) == PART:  # of a long run, and all that follows of it
                    close(True)
                    held, first = [], True
            yield _batch(cols, out)
            cols = [[] for _ in names]
        if held:
            close(True)
            yield _batch(cols, out)

    found = materialize(ordered.mapInArrow(run, out), "trie-ends")

    def join(batches):
        seq, digest, low, total, length = None, None, 0, 0, 0
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for s, n_turns, first, n, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5))):
                if s != seq:
                    if seq is not None:
                        for col, value in zip(cols, (seq, length, low, total, digest.hexdigest(), None)):
                            col.append(value)
                    seq, digest, low, total, length = s, hashlib.sha256(text.encode()), first, n, n_turns
                else:
                    digest.update(b"," + text.encode())
                    total += n
            yield _batch(cols, out)
        if seq is not None:
            yield _batch([[x] for x in (seq, length, low, total, digest.hexdigest(), None)], out)

    parts = found.where("sha is null").repartition("seq").sortWithinPartitions("seq", "low").mapInArrow(join, out)
    return found.where("sha is not null").unionAll(parts).select("low", "n", "length", "sha")


def _batch(cols: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types)], list(names))


# -- the recursion --------------------------------------------------------------


class _Cuts:
    """Rows of trees (root_depth, root, turns, n, low, ended, level), cut level
    by level; ``ended`` names the sequence that ends with the row, if one does.
    A tree of level k is 2^k elements high, an element ``unit`` turns; a row
    waits in ``tables`` until the level at which it reaches a cut."""

    def __init__(self, items: DataFrame, height: int, unit: int):
        self.unit, self.height, self.tables = unit, height, [items.withColumn("level", self._level(height))]
        #: Level -> cut nodes with their tree's root; bottoms with the cut above them.
        self.roots: dict[int, DataFrame] = {}
        self.above: dict[int, DataFrame] = {}
        for level in range(height, 0, -1):
            self._cut(level)

    @staticmethod
    def _level(most: int) -> F.Column:
        # size s reaches the cut of level k if 2^(k-1) <= s
        return F.least(F.length(F.bin(F.size("turns"))), F.lit(most)).cast("int")

    def at(self, level: int) -> DataFrame:
        found = None
        for t in self.tables:
            rows = t.where(F.col("level") == level)
            found = rows if found is None else found.unionAll(rows)
        return found

    def _cut(self, level: int) -> None:
        half = 1 << (level - 1)
        deep = half * self.unit
        rows = self.at(level).withColumn("head", F.slice("turns", 1, half))
        upper = rows.groupBy("root_depth", "root", F.col("head").alias("turns")).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.when(F.size("turns") == half, F.col("ended"))).alias("ended"))
        upper = materialize(upper.withColumn("level", F.lit(level - 1)), f"trie-upper-{level}")
        cut = upper.select(F.col("root_depth").alias("_depth"), F.col("root").alias("_root"), F.col("turns").alias("_head"), F.col("low").alias("cut"))
        longer = rows.where(F.size("turns") > half).join(cut, (F.col("root_depth") == F.col("_depth")) & (F.col("root") == F.col("_root")) & (F.col("head") == F.col("_head")))
        lower = longer.select((F.col("root_depth") + deep).alias("root_depth"), F.col("cut").alias("root"), F.slice("turns", F.lit(half + 1), F.size("turns")).alias("turns"), "n", "low", "ended")
        lower = materialize(lower.withColumn("level", self._level(level - 1)), f"trie-lower-{level}")
        self.tables += [upper, lower]
        key = level + self.unit.bit_length() - 1
        self.roots[key] = upper.select((F.col("root_depth") + deep).alias("depth"), "low", F.col("root_depth").alias("to_depth"), F.col("root").alias("to"))
        self.above[key] = lower.where(F.size("turns") == half).select((F.col("root_depth") + deep).alias("depth"), "low", F.col("root_depth").alias("to_depth"), F.col("root").alias("to"))


def _height(longest: int) -> int:
    return max(0, longest - 1).bit_length()


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("depth", "low").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _moved(sums: DataFrame, way: DataFrame) -> DataFrame:
    """Sums at nodes, moved to where the nodes lead."""
    return sums.join(way, ["depth", "low"]).select(F.col("to_depth").alias("depth"), F.col("to").alias("low"), "leaves", "saved")


def _grafted(own: DataFrame, roots: dict[int, DataFrame], above: dict[int, DataFrame]) -> DataFrame:
    """(depth, low, leaves, saved): what lies below each node, from each node's own."""
    top = max(roots, default=0)
    # sums of the tree of height 2^level below each root of one, from the lowest trees up
    below = {0: materialize(_summed(own.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("low"), "leaves", "saved")), "trie-below-0")}
    for level in range(1, top + 1):
        tall = 1 << level
        kept = below[level - 1].where(F.col("depth") % tall == 0)
        hung = below[level - 1].where(F.col("depth") % tall != 0)
        below[level] = materialize(_summed(kept.unionAll(_moved(hung, roots[level]))), f"trie-below-{level}")
    # a cut node's lower tree counts for all on its way to the root: the way is halved at each level
    passed = below[0].limit(0)
    for level in range(top, 0, -1):
        hung = below[level - 1].where(F.col("depth") % (1 << level) != 0)
        passed = materialize(_summed(hung.unionAll(passed).unionAll(_moved(passed, above[level]))), f"trie-passed-{level - 1}")
    return passed.unionAll(below[top].where("depth = 0"))


def prefix_trie(pieces: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256), a node named by its smallest member."""
    if chunk < 1 or chunk & (chunk - 1):
        raise ValueError("chunk is a power of two")
    pieces = materialize(pieces, "trie-sequences")
    chunks = materialize(_aligned(pieces, chunk).withColumn("key", _short(F.concat_ws("", F.transform("turns", lambda t: F.hex(t["name"]))))), "trie-chunks")
    several = chunks.agg(F.max("no")).first()[0] or 0
    # a sequence's key: its only piece's, or that of its pieces' keys in order
    if several:
        listed = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("no", "key"))).alias("keys"), F.sum(F.size("turns")).cast("long").alias("length"))
        listed = materialize(listed.select("conv", F.col("keys.key").alias("keys"), "length"), "trie-listed")
        sequences = listed.select(_short(F.concat_ws("", F.transform("keys", F.hex))).alias("seq"), "conv", "length")
    else:
        sequences = chunks.select(F.col("key").alias("seq"), "conv", F.size("turns").cast("long").alias("length"))
    ends = materialize(_ends(sequences), "trie-distinct")
    low, total, longest = ends.agg(F.min("low"), F.sum("n"), F.max("length")).first()
    root = (F.lit(0).cast("long").alias("root_depth"), F.lit(low).cast("long").alias("root"))
    distinct = ends.where("length > 0").select(F.col("low").alias("conv"), "n")
    trees = []
    if several:
        # elements are whole pieces, a piece's key its name
        items = distinct.join(listed, "conv").select(*root, F.transform("keys", lambda k: F.struct(k.alias("name"), F.lit(0).cast("long").alias("words"))).alias("turns"), "n", F.col("conv").alias("low"), F.col("conv").alias("ended"))
        items = materialize(items, "trie-outer")
        trees.append(_Cuts(items, _height(-(-longest // chunk)), chunk))
        # trees one piece high: the smallest member's piece at that depth
        last = trees[0].at(0).select("root_depth", "root", "n", "low", "ended", F.col("low").alias("conv"), F.floor(F.col("root_depth") / chunk).alias("no"))
        items = materialize(last.join(chunks, ["conv", "no"]).select("root_depth", "root", "turns", "n", "low", "ended"), "trie-inside")
        height = _height(chunk)
    else:
        items = distinct.join(chunks, "conv").select(*root, "turns", "n", F.col("conv").alias("low"), F.col("conv").alias("ended"))
        items = materialize(items, "trie-items")
        height = _height(longest or 0)
    trees.append(_Cuts(items, height, 1))
    nodes = trees[-1].at(0).select((F.col("root_depth") + 1).alias("depth"), "low", F.col("root").alias("parent"), "n", F.col("turns")[0]["words"].alias("words"), "ended")

    null = F.lit(None).cast("long")
    top = ends.groupBy().agg(F.min("low").alias("low"), F.sum("n").alias("n"), F.max(F.when(F.col("length") == 0, F.col("low"))).alias("ended")).where("n > 0")
    top = top.select(F.lit(0).cast("long").alias("depth"), "low", null.alias("parent"), "n", F.lit(0).cast("long").alias("words"), "ended")
    rows = nodes.unionAll(top).select("*", F.lit(0).cast("long").alias("children"))
    children = nodes.groupBy((F.col("depth") - 1).alias("above"), "parent").agg(F.count("*").alias("children"))
    children = children.select(F.col("above").alias("depth"), F.col("parent").alias("low"), *(null.alias(c) for c in ("parent", "n", "words", "ended")), "children")
    own = rows.unionAll(children).groupBy("depth", "low").agg(*(F.max(c).alias(c) for c in ("parent", "n", "words", "ended")), F.sum("children").alias("children"))
    own = own.join(ends.select(F.col("low").alias("ended"), "sha"), "ended", "left")
    own = own.withColumn("leaves", (F.col("children") == 0).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("words"))
    own = materialize(own, "trie-own")
    below = _grafted(own, {k: v for t in trees for k, v in t.roots.items()}, {k: v for t in trees for k, v in t.above.items()})
    below = below.select("depth", "low", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    nothing = hashlib.sha256(b"").hexdigest()
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return own.join(below, ["depth", "low"], "left").select(
        F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        plus("leaves", "more_leaves").alias("n_leaves"), plus("saved", "more_saved").alias("saved_tokens"), F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))
