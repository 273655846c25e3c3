"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefixes
from tidemark.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows, group=100, most=6):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in said.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = own.get(c - int(np.fmod(c, group)), [])
        out[c] = tuple(base[:h] + v[h:])
    return out


def expected(sequences):
    if not sequences:
        return []
    members = defaultdict(list)
    for c, v in sequences.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        saved[p] = own + sum(saved[x] for x in children[p])
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(sequences[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, limit=prefixes.LIMIT):
    nodes = prefixes.trie(prefixes.with_starts(prefixes.turns(df)), limit).nodes
    return sorted((tuple(r[c] for c in COLUMNS) for r in nodes.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def made(n, turns, words, seed=1):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(words))
        for c in rng.sample(range(-50, 3 * n), n) for t in range(rng.randrange(1, turns))
    ]


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_trie_against_brute_force(spark, limit):
    rows = made(120, 9, ["a", "b", "hello é", None], seed=limit)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, limit) == expected(rebuilt(rows))


def test_ties_repeats_nulls_and_other_columns(spark):
    rows = [(1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "a", "x"), (1, None, None, None), (None, 1, "u", "lost"),
            (2, 5, "u", "x"), (2, 5, "u", ""), (100, 0, "u", "y" * 100_000), (101, 0, "u", "z"), (7, 3, "", "u"), (8, 3, "u", "")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA + ", key string, digest string, `a.b` long")
    assert found(df) == expected(rebuilt(rows))
    assert found(df.filter("conv_id is null")) == [] and found(df.limit(0)) == []
    assert found(df.filter("conv_id = 100")) == expected(rebuilt(rows[7:8]))


def test_conversations_left_without_turns(spark):
    # Without a first one in the group, what is shorter than its h has nothing left.
    rows = [(c, 0, "u", "x") for c in range(1, 30)]
    due = expected(rebuilt(rows))
    assert any(r[1] == 0 and r[3] > 1 and r[7] != hashlib.sha256(b"").hexdigest() for r in due)
    assert found(spark.createDataFrame(rows, SCHEMA)) == due


def test_long_conversations_shared_starts_and_copies(spark, monkeypatch):
    rows = [(c, t, "u", f"t{t}" if c < 40 or t < 30 else f"{c}") for c in (0, 1, 2, 39, 150, 151, 260) for t in range(90)]
    rows += [(c, t, "u", f"same {t}") for c in range(300, 390) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    due = expected(rebuilt(rows))
    for part, table, ids in ((8, 5, 3), (1024, 100_000, 512)):
        monkeypatch.setattr(prefixes, "PART", part)
        monkeypatch.setattr(prefixes, "TABLE", table)
        monkeypatch.setattr(prefixes, "IDS", ids)
        assert found(df, 50) == due


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        digests = rng.integers(0, 2**63, (n, 2), dtype=np.uint64)
        slots = prefixes.Slots(digests)
        assert sorted(slots(digests).tolist()) == list(range(n))
        assert (slots(rng.integers(0, 2**63, (100, 2), dtype=np.uint64)) == -1).all()


def test_query_on_all_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_prefix_trie"](spark, folder)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rebuilt(rows))
