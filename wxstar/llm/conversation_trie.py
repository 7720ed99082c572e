"""Prefix trie of conversations: member intervals from range minima over sorted common prefixes.

A conversation is its sequence of turns (role, text); every distinct sequence of the first d turns of
some conversation is a node of depth d, and the conversations that start with it are its members.

Method. Turns are digested (16 bytes), so a conversation is a byte string, and the strings are sorted over range
partitions, copies in the order of their ids. A node's members are then an interval of rows, the longest around
any of them in which neighbours share d turns or more. Rows stream in blocks of bounded size; for a block the
lengths of the common prefixes of neighbours (LCP) get a **sparse table of range minima**, and each
candidate prefix (row, depth) finds its right end, and its parent's left end, by **binary search** over the table's powers of
two, all candidates at once and independently of each other: no stack, no order of evaluation. Counts over an interval are
differences of running sums.

A node whose interval reaches over a block's end is *open*: each block gives its share of it, under a digest of the prefix, and
shares are summed. A block has at most as many open nodes as its first and last row have turns, so the shares are few
even for a first turn, or a whole conversation, that a third of all rows have; the ids of a group of copies that reaches
over blocks are hashed from one string a block, in order, without holding them.

Input: (conv_id, turn, role, text), other columns are ignored whatever their names. Turns go by turn, null first; equal turns by role
and text digest; repeated rows stay turns of their own. Null role or text counts as empty. Rows with a null conv_id belong to
no conversation and are left out. An empty table has no nodes, not even a root. Very long texts are only digested and their words counted,
in the JVM. One conversation, as digests (24 bytes a turn), is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxstar.llm.common import lean, materialize
from wxstar.llm.ranking import AT, PART, sorted_rows

WIDTH = 16                  # bytes of a turn's digest
WORD = r"[^\x20\x09-\x0D]+"
ROWS = 4096                 # rows of a block
BYTES = 8 << 20             # digests of a block: a block ends where either is reached
FLUSH = 20_000              # nodes of an output batch


# -- conversations as byte strings ------------------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, key, words): the turns' digests, joined in order, and their numbers of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_digest = F.substring(F.unhex(F.sha2(F.concat(
        F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, WIDTH)
    turn = F.col("turn").cast("bigint")
    one = F.struct(turn.isNotNull().alias("k"), turn.alias("t"), role.alias("r"), turn_digest.alias("d"),
                   F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("w"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), one.alias("one"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    return whole.select("conv_id", F.concat_ws("", F.transform("turns", lambda t: F.hex(t["d"]))).alias("hex"),
                        F.col("turns.w").alias("words")).select("conv_id", F.unhex("hex").alias("key"), "words")


def rebuilt(seqs: DataFrame, group: int, head: Column) -> DataFrame:
    """Every conversation c with the first ``head`` turns of conversation c - c % ``group`` in place of its own (all, if that has
    fewer; none, if there is none)."""
    first = F.col("conv_id") - F.col("conv_id") % group
    # a head is at most as long as the conversation it is from; one of `group` rows joins each
    heads = seqs.where(F.col("conv_id") == first).select(
        F.col("conv_id").alias("first"), F.col("key").alias("first_key"), F.col("words").alias("first_words"))
    n = head.cast("int")
    own = seqs.withColumns({"first": first, "n": n})
    return own.join(heads, "first", "left").select(
        "conv_id",
        F.concat(F.coalesce(F.substring("first_key", F.lit(1), F.col("n") * WIDTH), F.lit(b"")),
                 F.substring("key", F.col("n") * WIDTH + 1, F.octet_length("key"))).alias("key"),
        F.concat(F.coalesce(F.slice("first_words", F.lit(1), F.col("n")), F.array().cast("array<bigint>")),
                 F.slice("words", F.col("n") + 1, F.greatest(F.size("words"), F.lit(1)))).alias("words"))


# -- one block ----------------------------------------------------------------------------------------------

def common_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns that two conversations share from the start; -1 where one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // WIDTH
    x, y = (np.frombuffer(k, np.uint8, n * WIDTH).reshape(n, WIDTH) for k in (a, b))
    differs = (x != y).any(axis=1)
    return int(differs.argmax()) if differs.any() else n


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of the 2**k values from each place on."""
    levels = [values]
    while 2 ** len(levels) <= len(values):
        low, half = levels[-1], 2 ** (len(levels) - 1)
        levels.append(np.minimum(low[:-half], low[half:]))
    return levels


def right_end(levels: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each (row, depth) the last row e with min(lcp[row + 1 .. e]) >= depth; levels are those of the whole lcp."""
    end, n = rows.copy(), len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        fits = end + 2 ** k < n
        at = np.minimum(end + 1, len(levels[k]) - 1)
        fits &= levels[k][at] >= depths
        end = np.where(fits, end + 2 ** k, end)
    return end


def left_end(levels: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each (row, depth) the first row s with min(lcp[s + 1 .. row]) >= depth."""
    start = rows.copy()
    for k in range(len(levels) - 1, -1, -1):
        at = start - 2 ** k + 1  # the 2**k values that end at `start`
        fits = (at >= 1) & (at < len(levels[k]))
        fits &= levels[k][np.clip(at, 0, len(levels[k]) - 1)] >= depths
        start = np.where(fits, start - 2 ** k, start)
    return start


def prefix_key(key: bytes, depth: int) -> bytes:
    return hashlib.sha256(key[:depth * WIDTH]).digest()[:WIDTH] + depth.to_bytes(8, "big")


def nodes_of(convs: np.ndarray, keys: list[bytes], words: np.ndarray, before: bytes | None, after: bytes | None) -> list[tuple]:
    """The nodes of a block of sorted rows between the rows ``before`` and ``after``: in the order of ``SHARES`` (without the block).

    A node's ``spared`` is the sum over its subtree of words times members, less the words of each node once:
    members' words from the node's own turn on, less the words of the nodes that begin in the block."""
    n = len(keys)
    size = np.fromiter((len(k) for k in keys), np.int64, n) // WIDTH
    starts = np.concatenate(([0], np.cumsum(size)))
    flat = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    lcp = np.zeros(n, np.int64)
    live, t = np.arange(1, n), 0
    while len(live):  # turn by turn, the rows that still agree with the row before
        live = live[(size[live] > t) & (size[live - 1] > t)]
        live = live[(flat[starts[live] + t] == flat[starts[live - 1] + t]).all(axis=1)]
        t += 1
        lcp[live] = t
    lcp[0], last = common_turns(before, keys[0]), common_turns(keys[-1], after)
    table = sparse_table(lcp)
    convs_table = sparse_table(convs)

    # candidates: the prefixes that begin at a row; at the first row also those that it shares with the row before
    low = lcp + 1
    low[0] = 0
    count = size - low + 1
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(n), count)
    depth = np.arange(first[-1]) - first[row] + low[row]
    end = right_end(table, row, depth)
    left_open = (row == 0) & (depth <= lcp[0])
    is_open = left_open | ((end == n - 1) & (depth <= last))

    parent_row = left_end(table, row, np.maximum(depth - 1, 0))
    parent = first[parent_row] + depth - 1 - low[parent_row]
    parent[depth == 0] = -1
    children = np.bincount(parent[(depth > 0) & ~left_open], minlength=len(row))

    sums = np.concatenate(([0], np.cumsum(words)))            # words of turns, over all rows
    own = sums[starts[1:]] - sums[starts[:-1]]
    fresh = sums[starts[1:]] - sums[starts[:-1] + np.maximum(lcp, 0)]  # words of the nodes that begin at a row
    ends_here = np.append(lcp[1:], last) < size               # the row's last copy, and nothing continues it
    run = lambda v: np.concatenate(([0], np.cumsum(v)))
    own_run, fresh_run, leaf_run = run(own), run(fresh), run(ends_here)
    upper = sums[starts[row] + np.maximum(depth - 1, 0)] - sums[starts[row]]  # words before the node's own turn
    members = end - row + 1
    spared = own_run[end + 1] - own_run[row] - members * upper
    here = np.where(left_open, fresh[row], own[row] - upper)  # at its first row the node and what is below begin
    spared -= here + fresh_run[end + 1] - fresh_run[row + 1]
    leaves = leaf_run[end + 1] - leaf_run[row]

    k = np.frexp(members)[1] - 1
    smallest = np.empty(len(row), np.int64)
    for level in np.unique(k):
        some = k == level
        mins = convs_table[level]
        smallest[some] = np.minimum(mins[row[some]], mins[end[some] + 1 - 2 ** level])

    same = np.flatnonzero(np.append(True, (lcp[1:] != size[1:]) | (lcp[1:] != size[:-1])))  # first copies
    stop = dict(zip(same.tolist(), np.append(same[1:], n).tolist()))
    out = []
    for c, (r, d, e, o, p) in enumerate(zip(row.tolist(), depth.tolist(), end.tolist(), is_open.tolist(), parent.tolist())):
        ids = ",".join(map(str, convs[r:stop[r]].tolist())) if size[r] == d else ""
        parent_open = p >= 0 and bool(is_open[p])
        out.append((
            prefix_key(keys[r], d) if o else None, o, d, int(smallest[c]),
            prefix_key(keys[r], d - 1) if parent_open else None, None if p < 0 or parent_open else int(smallest[p]),
            int(members[c]), int(children[c]), int(leaves[c]), int(spared[c]),
            ids if o else None, None if o else hashlib.sha256(ids.encode()).hexdigest()))
    return out


SHARES = pa.schema([
    ("node", pa.binary()), ("open", pa.bool_()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent", pa.binary()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ids", pa.string()), ("ends_sha256", pa.string()), ("block", pa.int64())])
SHARES_DDL = ("node binary, open boolean, depth bigint, conv_id bigint, parent binary, parent_conv_id bigint, n_convs bigint, "
              "n_children bigint, n_leaves bigint, saved_tokens bigint, ids string, ends_sha256 string, block bigint")


def _blocks(most: int):
    """Nodes and shares of blocks of ``most`` rows. A partition's rows come in order, after its neighbour's last row
    (kind -1) and before the next one's first (kind 1)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        convs, keys, words = [], [], []
        part, held, number, before = None, 0, 0, None

        def end_block(after: bytes | None) -> None:
            nonlocal before, held, number
            if keys:
                flat = np.fromiter((w for ws in words for w in ws), np.int64)
                block = (part << 33) + number
                done.extend((*node, block) for node in nodes_of(np.array(convs, np.int64), keys, flat, before, after))
                before, held, number = keys[-1], 0, number + 1
                convs.clear()
                keys.clear()
                words.clear()

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), SHARES)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=SHARES)

        for batch in batches:
            for p, kind, conv, key, w in zip(*(batch.column(c).to_pylist() for c in (PART, "kind", "conv_id", "key", "words"))):
                if p != part:
                    end_block(None)
                    part, number, before = p, 0, None
                if kind < 0:
                    before = key
                elif kind > 0:
                    end_block(key)
                else:
                    if len(keys) == most or held > BYTES:
                        end_block(key)
                    convs.append(conv)
                    keys.append(key)
                    words.append(w)
                    held += len(key)
                if len(done) >= FLUSH:
                    yield flushed()
        end_block(None)
        if done:
            yield flushed()

    return blocks


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 over the ids of a node, from strings that come in the order of node and block."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, hasher, done = None, None, []
    for batch in batches:
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, hasher.hexdigest()))
                node, hasher = key, hashlib.sha256()
            else:
                hasher.update(b",")
            hasher.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([hasher.hexdigest()])], schema=schema)


# -- all blocks -----------------------------------------------------------------------------------------------

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(seqs: DataFrame, block_rows: int = ROWS) -> DataFrame:
    """The nodes (``NODE``) of the conversations (conv_id, key, words); conv_ids are unique. The result does not depend on
    ``block_rows``."""
    rows = sorted_rows(seqs, ["key", "conv_id"], "conversations")
    # the last and first row of every partition go to its neighbours: a row a partition
    ends = rows.groupBy(PART).agg(F.min_by("key", AT).alias("low"), F.max_by("key", AT).alias("high"))
    order = Window.orderBy(PART)
    near = ends.select(PART, F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    borders = near.select(PART, F.explode(F.array(
        F.struct(F.lit(-1).alias("kind"), F.col("before").alias("key")),
        F.struct(F.lit(1).alias("kind"), F.col("after").alias("key")))).alias("b")).select(PART, "b.*").where("key is not null")
    dealt = (
        rows.withColumn("kind", F.lit(0)).unionByName(borders, allowMissingColumns=True)
        .repartition(PART).sortWithinPartitions(PART, "kind", AT)
        .select(PART, "kind", "conv_id", "key", "words")
    )
    shares = materialize(dealt.mapInArrow(lean(_blocks(block_rows)), SHARES_DDL), "shares")

    pieces = shares.where("open")
    ends_of = pieces.where(F.col("ids") != "").select("node", "block", "ids").repartition("node").sortWithinPartitions(
        "node", "block").mapInArrow(lean(_hash_ids), "node binary, ends_sha256 string")
    merged = materialize(pieces.groupBy("node", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ).join(ends_of, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))), "open-nodes")

    named = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("open_parent"))
    # a closed node with an open parent asks its own block's share of the parent, so no key is hot
    of_block = pieces.select("block", F.col("node").alias("parent")).join(named, "parent")
    closed = shares.where("NOT open")
    inner = closed.where("parent IS NULL").select(*NODE)
    under = closed.where("parent IS NOT NULL").drop("parent_conv_id").join(of_block, ["block", "parent"]).withColumnRenamed(
        "open_parent", "parent_conv_id").select(*NODE)
    outer = merged.join(named, "parent", "left").withColumnRenamed("open_parent", "parent_conv_id").select(*NODE)
    return inner.unionByName(under).unionByName(outer)
