"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprint: the text with A-Z lower-cased, its words, all 3-word shingles (repeats
count); a bit is 1 if it is set in over half of the shingles' XXH64 values (seed 42).

Links (``max_bits`` = 2 or fewer differing bits) are found on distinct fingerprints. The
64 bits are dealt into three parts; two fingerprints that differ in at most 2 bits agree
on one part, so each fingerprint goes to three groups. A group above ``GROUP``
fingerprints is dealt again by three parts of the bits that are still free, and so on: after four
such steps 13 bits are free, so no group can exceed 2^13. Inside a group the fingerprints are sorted
by Gray rank and packed, eight to a node, into a tree whose nodes carry the bits that all
their members share (mask and pattern). A descent over pairs of nodes accumulates the
differences on bits that both sides share and drops a whole pair of subtrees once they
exceed ``max_bits``; leaves are compared in full. Each group gives a spanning forest of
its links, never all pairs.

Defined results: a null text counts as empty; texts without words have fingerprint zero and
link like any other; fewer than three words are one shingle. A null id takes no part in
the choice of a component's smallest id (null if there is no other). Repeated rows are
linked as copies. An empty table gives no rows. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm.common import ID, TEXT, by_marks, enveloped, lean, marks, materialize, release, text_or_empty, with_row_ids
from wxstar.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
GROUP = 20_000
PARTS = MAX_BITS + 1
FANOUT = 8
BATCH = 1 << 18  # node pairs or shingles looked at together


# --- fingerprints -----------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    # bytes.lower() and bytes.split() know exactly A-Z and \x20 \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    count, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, BATCH):
        h = np.array([
            xxhash.xxh64_intdigest(joined[a:b - 1], SEED)
            for a, b in zip(starts[at:min(at + BATCH, n)], ends[at + shingle - 1:at + shingle - 1 + BATCH])], np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * count > n).tolist())


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) bigint."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        out = pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
        del texts
        release()
        return out

    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- groups that agree on some bits -----------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(mask: int, parts: int) -> list[int]:
    """``mask`` with a ``parts``-th of its free bits added, for each such part."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cut, cut[1:])]


def agreeing_groups(fps: DataFrame, parts: int, most: int) -> DataFrame:
    """(mask, pattern, fp): groups of fingerprints equal on the mask, none larger than
    ``most`` as long as free bits are left to deal. Singles are dropped."""
    masks, rows, done = [0], fps.select(F.lit(0).cast("bigint").alias("mask"), "fp"), None
    while True:
        dealt = {m: _deal(m, parts) for m in masks}
        masks = sorted({c for cs in dealt.values() for c in cs})
        child = F.create_map(*itertools.chain.from_iterable(
            (F.lit(_signed(m)), F.lit([_signed(c) for c in cs])) for m, cs in dealt.items()))
        rows = rows.select("fp", F.explode(child[F.col("mask")]).alias("mask")).select(
            "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp").distinct()
        rows = materialize(rows, "fp-groups")
        sizes = rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("__n"))
        large = materialize(sizes.where(F.col("__n") > most).select("mask", "pattern"), "fp-large")
        small = rows.join(sizes.where(F.col("__n").between(2, most)).select("mask", "pattern"), ["mask", "pattern"], "left_semi")
        free = 64 - min(m.bit_count() for m in masks)
        if free <= 13 or large.isEmpty():
            last = rows.join(large, ["mask", "pattern"], "left_semi") if free <= 13 else None
            found = small if last is None else small.unionByName(last)
            return found if done is None else done.unionByName(found)
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, ["mask", "pattern"], "left_semi")


# --- the Gray-order tree ----------------------------------------------------------------


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _node_level(low: np.ndarray, high: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)


def tree_links(fp: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (a, b) of the links inside each group; ``group`` numbers ascend.

    Levels of the tree never mix groups. AND and OR of a node's members give its shared
    bits: the mask is ~(AND ^ OR), the pattern is AND on the mask.
    """
    order = np.lexsort((gray_rank(fp), group))
    fp, group = fp[order], group[order]
    levels = [(fp, fp, np.arange(len(fp) + 1), group)]  # AND, OR, bounds of children below, group
    while len(np.unique(levels[-1][3])) < len(levels[-1][3]):
        low, high, _, g = levels[-1]
        start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        place = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
        first = np.flatnonzero(place % FANOUT == 0)
        levels.append((*_node_level(low, high, first), np.append(first, len(g)), g[first]))
    label = np.arange(len(fp))
    top = np.arange(len(levels[-1][0]))
    # within a level pairs (a, b) with a <= b; work is a stack of bounded pieces
    work = [(len(levels) - 1, top[i:i + BATCH], top[i:i + BATCH]) for i in range(0, len(top), BATCH)]
    while work:
        level, a, b = work.pop()
        low, high, bounds, _ = levels[level]
        shared = ~(low[a] ^ high[a]) & ~(low[b] ^ high[b])
        near = np.bitwise_count((low[a] ^ low[b]) & shared) <= max_bits
        a, b = a[near], b[near]
        if level == 0:
            _unite(label, a, b)
            continue
        for at in range(0, len(a), BATCH // FANOUT ** 2):
            pa_, pb = a[at:at + BATCH // FANOUT ** 2], b[at:at + BATCH // FANOUT ** 2]
            na, nb = bounds[pa_ + 1] - bounds[pa_], bounds[pb + 1] - bounds[pb]
            n = na * nb
            pair = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            ca, cb = bounds[pa_][pair] + k // nb[pair], bounds[pb][pair] + k % nb[pair]
            fit = ca <= cb if level > 1 else ca < cb
            work.append((level - 1, ca[fit], cb[fit]))
    child = np.flatnonzero(label != np.arange(len(fp)))
    return fp[child], fp[label[child]]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of a and b; labels point at the least member."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _group_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (mask, pattern): complete groups are gathered up to a bounded
        number of rows, then linked."""
        held: list[np.ndarray] = []

        def linked(rows: np.ndarray):
            new = np.append(False, (rows[1:, :2] != rows[:-1, :2]).any(1))
            a, b = tree_links(rows[:, 2].copy().view(np.uint64), np.cumsum(new), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1))
            if sum(map(len, held)) >= GROUP * 4:
                rows = np.concatenate(held)
                same = (rows[:, :2] == rows[-1, :2]).all(1)
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if cut:
                    yield linked(rows[:cut])
                held = [rows[cut:]]
        if held and len(rows := np.concatenate(held)):
            yield linked(rows)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, most: int = GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all within ``max_bits``."""
    groups = agreeing_groups(fps.select("fp").distinct(), max_bits + 1, most)
    dealt = groups.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.select("mask", "pattern", "fp").mapInArrow(lean(_group_links(max_bits)), "a bigint, b bigint")


# --- documents --------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """One row per input row: (id, fp bigint, component_id: the smallest id reachable)."""
    marked = materialize(
        docs.select(F.col(id_col).cast("bigint").alias(id_col), fingerprint_column(text_or_empty(text_col), shingle).alias("fp")), "fp")
    least = marked.groupBy("fp").agg(F.min(id_col).alias("__least"))
    roots = connected_components(fingerprint_links(least, max_bits)).withColumnRenamed("node", "fp")
    placed = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("__least").alias("component_id"))
    # components of one fingerprint need no second look
    by_fp = placed.join(smallest, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest id of each group, with all columns of ``docs``."""
    rows = with_row_ids(enveloped(docs))
    found = near_duplicates(rows, shingle, max_bits, "__rid")
    gone = materialize(found.where("__rid <> component_id").select("__rid"), "gone")
    # a row that surely stays needs no join: only those that may go are dealt by row
    bitmap = marks(gone, "__rid")
    stays = by_marks(rows, bitmap, "__rid", False)
    return by_marks(rows, bitmap, "__rid", True).join(gone, "__rid", "left_anti").unionByName(stays).select("__doc.*")
