"""Merkle manifest: closed-form positions, builders and proofs against plain Python and SQL."""

import hashlib
import zlib

import duckdb
import pytest

from wxstar.llm import merkle, queries
from wxstar.llm.merkle import ARITY, levels, position

SF = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree_of(leaves):
    """Levels of a tree, and for each leaf its siblings, low to high and left to right."""
    layers = [list(leaves)]
    while len(layers[-1]) > 1:
        low = layers[-1]
        layers.append([sha(*low[i:i + ARITY]) for i in range(0, len(low), ARITY)])
    paths = []
    for r in range(len(leaves)):
        path = []
        for layer in layers[:-1]:
            first = r // ARITY * ARITY
            path.append((r - first, [layer[i] for i in range(first, min(first + ARITY, len(layer))) if i != r]))
            r //= ARITY
        paths.append(path)
    return layers[-1][0], paths


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted result rows of the query."""
    leaf = lambda r, text: sha(part(r[0]), part(r[1]), part(r[2]), part(r[3]), part(text))
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        docs = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[s] = docs, *tree_of([leaf(r, r[4]) for r in docs])
    if not order:
        return []
    root, tops = tree_of([trees[s][1] for s in order])
    out = []
    for k, s in enumerate(order):
        docs, subroot, paths = trees[s]
        for r, path in zip(docs, paths):
            steps = path + tops[k]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, lower(r[4]) if tampered else r[4])
            for slot, others in steps:
                folded = sha(*others[:slot], folded, *others[slot:])
            out.append((r[0], leaf(r, r[4]), subroot, root, sha(*[d for _, others in steps for d in others]), folded, folded == root))
    return sorted(out, key=str)


def through_query(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op13_merkle(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4096, 4097, 5000])
def test_positions_are_the_order_of_completion(n):
    log = []
    for r in range(n):
        log.append((0, r))
        for h in range(1, levels(n) + 1):
            if (r + 1) % ARITY ** h and r < n - 1:
                break
            log.append((h, r // ARITY ** h))
    assert [position(n, h, i) for h, i in log] == list(range(len(log)))


DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def test_hot_source_and_many_small_ones(spark, tmp_path):
    """One source of three levels, single-leaf sources and more sources than one run."""
    rows = [(i, "hot", "en", 3, f"Text {i % 7}") for i in range(4500)]
    rows += [(5000 + i, f"s{i}", None, None, "ABC" if i % 2 else "") for i in range(290)]
    df = spark.createDataFrame(rows, DDL).repartition(7)
    assert through_query(spark, df, tmp_path) == plain(rows)


def test_log_is_gapless(spark):
    rows = [(i, "a" if i % 3 else "b", "en", 1, str(i)) for i in range(900)]
    leaves = merkle.leaves_of(spark.createDataFrame(rows, DDL))
    log = merkle.append_log(leaves, "test").collect()
    for tree in ("=a", "=b"):
        at = sorted(r.position for r in log if r.tree == tree)
        assert at == list(range(len(at))) and sum(r.is_root for r in log if r.tree == tree) == 1


def test_nulls_ties_repeats_long_text_and_extra_columns(spark, tmp_path):
    rows = [(1, "s", "en", 5, "Same"), (1, "s", "en", 5, "Same"), (1, "s", "en", 5, "Other"), (None, "s", None, None, None),
            (None, None, "en", 0, ""), (2, None, "de", 1, "Ä"), (40, "", "en", 7, "X" * 3_000_000), (25, "s", "en", 4, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL + ", tree string, position int, digest string")
    got = through_query(spark, df, tmp_path)
    assert got == plain(rows) and [r[-1] for r in got].count(False) >= 1


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], DDL)
    out = through_query(spark, df, tmp_path)
    assert out == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(queries.ORACLE_SQL["op13_merkle"]).fetchall()
    got = queries.op13_merkle(spark, SF)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, got.collect())) == sorted(want)
