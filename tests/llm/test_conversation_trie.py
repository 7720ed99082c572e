"""Conversation prefix trie against a plain dictionary of prefixes and SQL, for any cut into blocks."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from wxstar.llm import conversation_trie as ct
from wxstar.llm import queries

SF = "/root/testdata/sf0.001"
DDL = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """All nodes by definition, from (conv_id, turn, role, text) rows without equal turns of different content."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])  # SQL's %, also of negative ids
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    def below(node):
        leaves, saved = (0 if node in children else 1), (len(members[node]) - 1) * words(node)
        for child in children.get(node, []):
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ms if rebuilt[c] == node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children.get(node, [])), *below(node),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(df, block_rows=ct.ROWS):
    seqs = ct.rebuilt(ct.sequences(df), 20, queries.crc_fold(queries.F.col("conv_id"), 4))
    return sorted((tuple(r) for r in ct.trie(seqs, block_rows).collect()), key=str)


@pytest.mark.parametrize("block_rows", [1, 2, 5, 4096])
def test_cuts_into_blocks_change_nothing(spark, block_rows):
    """Few texts, so many prefixes are shared; half of the conversations are copies of one, or start alike."""
    rng = random.Random(3)
    rows = []
    for c in range(160):
        if c % 4 == 0:
            turns = [("user", "the hot one"), ("assistant", "a b c"), ("user", "")]
        elif c % 4 == 1:
            turns = [("user", "the hot one")] + [("u", rng.choice("ab")) for _ in range(rng.randint(0, 4))]
        else:
            turns = [(rng.choice("ux"), rng.choice(["a", "b c", None])) for _ in range(rng.randint(1, 6))]
        rows += [(c, t if t else None, *turn) for t, turn in enumerate(turns)]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    assert built(df, block_rows) == plain(rows)


def test_extents_by_binary_search():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 8, 9, 40):
        lcp = rng.integers(0, 4, n)
        table = ct.sparse_table(lcp)
        at, depth = (g.ravel() for g in np.meshgrid(np.arange(n), np.arange(5)))
        for r, d, e, s in zip(at, depth, ct.right_end(table, at, depth), ct.left_end(table, at, depth)):
            assert e == next((x - 1 for x in range(r + 1, n) if lcp[x] < d), n - 1)
            assert s == next((x for x in range(r, 0, -1) if lcp[x] < d), 0)


def test_nulls_repeats_long_texts_and_extra_columns(spark):
    rows = [(0, None, None, None), (0, 1, "user", "x " * 200_000), (0, 2, "user", ""), (7, 5, "user", "x " * 200_000),
            (7, 5, "user", "x " * 200_000), (-3, 0, "a", "b"), (2**60, 0, "a", "日本 語"), (21, 0, "u", "one"), (None, 0, "u", "lost")]
    df = spark.createDataFrame([(*r, 1, "k", "w") for r in rows], DDL + ", depth int, key string, words string")
    assert built(df) == plain(rows)


def test_turnless_conversations_and_empty_table(spark):
    c = next(i for i in range(1, 500) if zlib.crc32(str(i).encode()) % 4 == 3 and i % 20)  # its head is absent
    rows = [(c, 0, "u", "gone"), (c, 1, "u", "gone")]
    assert built(spark.createDataFrame(rows, DDL)) == plain(rows)
    assert len(plain(rows)) == 1
    assert built(spark.createDataFrame([], DDL)) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.execute(queries.ORACLE_SQL["op11_conversation_trie"]).fetchall()
    got = queries.op11_conversation_trie(spark, SF)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
