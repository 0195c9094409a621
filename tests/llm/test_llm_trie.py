"""The conversation prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from lakeops.llm import prefixtrie
from lakeops.llm.prefixtrie import conversation_pieces, prefix_trie, share_heads
from lakeops.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn int, role string, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, heads=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        made[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in sorted(made.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        saved[node] = own_saved + sum(saved[k] for k in children[node])
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
    return sorted((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in members[n] if len(made[c]) == len(n)).encode()).hexdigest()) for n in members)


def trie(spark, rows, heads=True, chunk=4096, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    pieces = conversation_pieces(df, chunk=chunk)
    got = prefix_trie(share_heads(pieces) if heads else pieces, chunk=chunk)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {f.dataType.simpleString() for f in got.schema.fields[:-1]} == {"bigint"}
    return sorted(map(tuple, got.collect()))


def made_up(seed, convs, longest, kinds):
    """Conversations over few turns, many alike; some share long beginnings."""
    rng, rows, before = random.Random(seed), [], []
    for c in range(convs):
        n = rng.randint(1, longest)
        ts = (before[: rng.randint(0, len(before))] if rng.random() < 0.4 else []) + [rng.choice(kinds) for _ in range(n)]
        before = ts = ts[:longest]
        rows += [(c, i, *t) for i, t in enumerate(ts)]
    rng.shuffle(rows)
    return rows


KINDS = [("user", "one two"), ("assistant", "three"), ("user", None), (None, "four five six")]


@pytest.mark.parametrize("chunk,longest", [(4096, 9), (4, 23), (2, 7), (1, 5)])
def test_equals_brute_force(spark, chunk, longest):
    rows = made_up(chunk, 60, longest, KINDS[: 2 if chunk == 4 else 4])
    assert trie(spark, rows, chunk=chunk) == brute(rows)


def test_without_shared_heads(spark):
    rows = made_up(5, 40, 6, KINDS[:2])
    assert trie(spark, rows, heads=False) == brute(rows, heads=False)


def test_one_conversation_holds_most_turns(spark):
    rows = [(7, i, "user", f"turn {i % 3}") for i in range(150)] + [(c, 0, "user", "turn 0") for c in range(20, 60)]
    assert trie(spark, rows, chunk=8, parts=6) == brute(rows)


def test_many_members_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PART", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 4000, 20) for t in range(2)]
    assert trie(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, "user", "x" * 100_000), (None, 1, "user", "nobody's"), (20, 3, "a", "b"), (20, None, "c", "d e"),
            (23, 0, "q", None), (-5, 1, "user", "minus"), (41, 0, "only", "own")]
    # a turn of 41's base is missing; the order of -5's base follows SQL's remainder
    want = brute([r for r in rows if r[0] != -5])
    assert trie(spark, [r for r in rows if r[0] != -5]) == want
    assert len(trie(spark, rows)) >= len(want)


def test_root_only_and_empty(spark):
    # a head of three turns comes from an absent base, and no turn is left
    left = next(c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(left, t, "user", "gone") for t in range(3)]
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, rows)[0][:6] == (left, 0, None, 1, 0, 1)
    assert trie(spark, []) == []


def test_clashing_columns_are_ignored(spark):
    rows = made_up(9, 20, 4, KINDS)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", depth int, low string, name string")
    got = sorted(map(tuple, prefix_trie(share_heads(conversation_pieces(df))).collect()))
    assert got == brute(rows)


def test_query_equals_brute_force(spark):
    from llm_edges import SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_prefix_trie"](spark, SMALL).collect())) == brute(rows)
