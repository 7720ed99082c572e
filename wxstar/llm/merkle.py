"""Merkle manifest of a dataset: a postorder append log of the trees, and proofs from it.

Every row is a leaf; the leaves of one source, in order of their ids, form a tree in which every
``ARITY`` consecutive nodes become one, level by level, until one is left (its subroot); the subroots,
in order of the sources, form a tree of the same kind with the dataset's root.

Method. A tree's log holds its nodes in the order of their completion: a node follows its last
child, so it is the postorder. With n leaves of rank 0 to n-1, all at one depth, the subtrees complete
before leaf r are known, so positions have a closed form: leaf r stands at r + sum(r // ARITY**h),
and the node of level h over the leaves up to e stands h places after leaf e. A node's siblings are
therefore addressed by arithmetic alone, without any pointers.

* **Aligned builders.** Leaves are dealt in blocks of ``ARITY ** SPAN`` aligned ranks. A builder streams
  a block in rank order, keeps one open run of nodes a level, and writes every node as soon as it is
  complete. Blocks' top nodes are the leaves of the next round (each leaves one node of ``ARITY ** SPAN``).
  One block is all that a task holds, however many rows one source has.
* **Proofs.** A block's own nodes lie in one stretch of the log, which gives the lowest ``SPAN`` levels of siblings
  of all its leaves; the siblings above are the same for the whole block and are fetched by position once a block.

Input: any columns; ``FIELDS`` make the leaf, of which ``SOURCE`` names the tree. Results for odd input: a null
field counts as null, not as empty; a null source is a source of its own, the first; null ids come first; rows with equal
ids are ordered by their leaves, and equal rows stay leaves of their own; extra columns, whatever their names, are neither
part of a leaf nor returned; an empty table has no rows and no root. Very long texts are hashed in the JVM as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wxstar.llm.common import ID, TEXT, lean, materialize
from wxstar.llm.ranking import RANK, TOTAL, ranked

ARITY = 16
SPAN = 2            # levels that one builder completes: blocks of 256 leaves
BLOCK = ARITY ** SPAN
SOURCE = "source"
FIELDS = (ID, SOURCE, "lang", "n_chars", TEXT)
TOP = "sources"     # the name of the tree over the subroots
HEX = 64            # characters of a digest
TAMPER = 5          # the check tampers with one row in so many, by crc32 of its id
FLUSH = 4096        # rows of an output batch


def digest(run: str) -> str:
    """H: lower-case hexadecimal SHA-256 of concatenated digests."""
    return hashlib.sha256(run.encode("ascii")).hexdigest()


def levels(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


def position(n: int, level: int, index: int) -> int:
    """Place in the postorder log of a tree of ``n`` leaves of the ``index``-th node of ``level``."""
    last = min((index + 1) * ARITY ** level, n) - 1
    return last + sum(last // ARITY ** h for h in range(1, levels(n) + 1)) + level


def siblings(n: int, rank: int, lowest: int = 0) -> list[tuple[int, list[int]]]:
    """For leaf ``rank`` and each of its ancestors from level ``lowest`` up: its own slot in its run, and the log
    positions of the run's others, left to right."""
    out = []
    for h in range(lowest, levels(n)):
        own, count = rank // ARITY ** h, -(-n // ARITY ** h)
        first = own // ARITY * ARITY
        out.append((own - first, [position(n, h, i) for i in range(first, min(first + ARITY, count)) if i != own]))
    return out


def field(value: Column) -> Column:
    """A field's part of a leaf: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest of a row whose text is ``text``."""
    return F.sha2(F.concat(*[field(F.col(c)) for c in FIELDS[:-1]], field(text)).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def leaves_of(docs: DataFrame, **carried: Column) -> DataFrame:
    """(tree, id, digest, index, leaves) of every row, and the ``carried`` columns. The tree's name is the source after an
    ``=``, or empty for a null source, so that it is never null and orders as the sources do."""
    source = F.col(SOURCE).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"), F.col(ID).alias("id"),
        leaf(F.col(TEXT)).alias("digest"), *[c.alias(n) for n, c in carried.items()])
    # digested before they are sorted: finding the ranges would read and hash every text once more
    return _numbered(materialize(rows, "leaf-digests"), ["id", "digest"], "leaves")


def _numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Written, as the ranks are read by every later step."""
    return materialize(
        ranked(rows, "tree", keys, name).withColumnsRenamed({RANK: "index", TOTAL: "leaves"}), f"{name}-ranked")


# -- the log -------------------------------------------------------------------------------------------

NODES = pa.schema([
    ("tree", pa.string()), ("leaves", pa.int64()), ("block", pa.int64()), ("level", pa.int32()), ("index", pa.int64()),
    ("position", pa.int64()), ("digest", pa.string()), ("is_root", pa.bool_())])
NODES_DDL = ("tree string, leaves bigint, block bigint, level int, index bigint, position bigint, digest string, "
             "is_root boolean")


def _builder(base: int):
    """Completes the nodes of levels ``base`` + 1 to ``base`` + ``SPAN`` over nodes of level ``base``, which come
    block by block and in order."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        block, tops, runs, index = None, 0, [], 0

        def complete(h: int, closing: bool) -> None:
            """Writes the node over run ``h``; with ``closing`` the runs above end too."""
            (tree, number, n), level = block, base + h + 1
            node = digest("".join(runs[h]))
            runs[h].clear()
            at = index // ARITY ** (h + 1)
            done.append((tree, n, number, level, at, position(n, level, at), node, level == tops))
            if h + 1 < len(runs):
                runs[h + 1].append(node)
                if closing or len(runs[h + 1]) == ARITY:
                    complete(h + 1, closing)

        def close() -> None:
            """Ends a block that its tree does not fill: every run from the lowest open one up is completed."""
            for h, run in enumerate(runs):
                if run:
                    complete(h, True)
                    return

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), NODES)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=NODES)

        for batch in batches:
            for tree, number, n, at, value in zip(
                    *(batch.column(c).to_pylist() for c in ("tree", "block", "leaves", "index", "digest"))):
                if (tree, number, n) != block:
                    close()
                    block, tops = (tree, number, n), levels(n)
                    runs = [[] for _ in range(min(SPAN, tops - base))]
                index = at
                if runs:
                    runs[0].append(value)
                    if len(runs[0]) == ARITY:
                        complete(0, False)
                if len(done) >= FLUSH:
                    yield flushed()
        close()
        if done:
            yield flushed()

    return build


def append_log(leaves: DataFrame, name: str) -> DataFrame:
    """Every node of every tree, the leaves included, with its position in its tree's log. ``block`` is the aligned
    block of the builder that wrote it."""
    at = F.col("index")
    for h in range(1, 16):  # beyond a tree's own levels the quotients are 0
        at = at + F.floor(F.col("index") / F.lit(ARITY ** h))
    block = F.floor(F.col("index") / F.lit(BLOCK)).alias("block")
    log = leaves.select("tree", "leaves", block, F.lit(0).alias("level"), "index", at.cast("bigint").alias("position"), "digest",
                        (F.col("leaves") == 1).alias("is_root"))
    current, most = log, leaves.agg(F.max("leaves")).first()[0] or 0
    for base in range(0, levels(most), SPAN):
        dealt = current.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        built = materialize(dealt.mapInArrow(lean(_builder(base)), NODES_DDL), f"{name}-{base}")
        log = log.unionByName(built)
        # those whose trees go on; the others' tops are roots
        current = built.where((F.col("level") == base + SPAN) & ~F.col("is_root")).withColumn("block", block)
    return log


def roots(log: DataFrame) -> DataFrame:
    """(tree, root): the last entry of each tree's log."""
    return log.where("is_root").select("tree", F.col("digest").alias("root"))


# -- proofs --------------------------------------------------------------------------------------------

STEP = "array<struct<slot:int,digests:string>>"  # one per level: the own slot in the run, the others' concatenated digests


WANTED = "array<struct<level:int,slot:int,place:int,position:bigint>>"


def _above(n, block):
    """What to fetch for the path above a block of leaves; a run of one has no others, but its level counts."""
    return [(h, slot, i, p) for h, (slot, others) in enumerate(siblings(n, block * BLOCK, SPAN), SPAN)
            for i, p in (enumerate(others) if others else [(-1, -1)])]


def upper_paths(leaves: DataFrame, log: DataFrame) -> DataFrame:
    """(tree, block, leaves, path): the siblings above each block of leaves, fetched by their positions in the log."""
    blocks = leaves.where(F.col("index") % BLOCK == 0).select(
        "tree", F.floor(F.col("index") / F.lit(BLOCK)).alias("block"), "leaves")
    addresses = F.udf(_above, WANTED)
    wanted = blocks.select("tree", "block", F.explode(addresses("leaves", "block")).alias("w")).select("tree", "block", "w.*")
    found = wanted.join(
        log.where(F.col("level") >= SPAN).select("tree", "position", "digest"), ["tree", "position"], "left")
    runs = found.groupBy("tree", "block", "level", "slot").agg(
        F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run"))  # at most ARITY - 1
    paths = runs.groupBy("tree", "block").agg(F.array_sort(F.collect_list(F.struct(
        "level", "slot", F.concat_ws("", F.col("run.digest")).alias("digests")))).alias("path"))
    steps = F.transform("path", lambda s: F.struct(s["slot"].alias("slot"), s["digests"].alias("digests")))
    return blocks.join(paths, ["tree", "block"], "left").withColumn(
        "path", F.coalesce(steps, F.array().cast(STEP)))


def _extract(out_schema: pa.Schema, of_head: list[str]):
    """Paths of the leaves of each block from its stretch of the log; a block's head row (position -1) comes first and
    gives the columns ``of_head``."""
    keep = [f.name for f in out_schema if f.name not in (*of_head, "path")]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, stretch, rows, done = None, [], [], []

        def prove() -> None:
            number, n, upper, common = head
            first = number * BLOCK
            start = position(n, 0, first)
            runs = []
            for h in range(min(SPAN, levels(n))):
                low, high = first // ARITY ** h, -(-min(first + BLOCK, n) // ARITY ** h)
                nodes = [stretch[position(n, h, i) - start] for i in range(low, high)]
                runs.append(["".join(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)])
            for rank, row in enumerate(rows):
                path = []
                for h, run in enumerate(runs):
                    group, slot = divmod(rank // ARITY ** h, ARITY)
                    whole = run[group]
                    path.append({"slot": slot, "digests": whole[:slot * HEX] + whole[(slot + 1) * HEX:]})
                done.append((*row, *common, path + upper))

        def flushed() -> pa.RecordBatch:
            columns = dict(zip([*keep, *of_head, "path"], zip(*done)))
            batch = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out_schema], schema=out_schema)
            done.clear()
            return batch

        for batch in batches:
            names = ("block", "position", "leaves", "path", "digest", "is_leaf")
            given, common = ([batch.column(c).to_pylist() for c in some] for some in (keep, of_head))
            for i, (number, at, n, path, value, is_leaf) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                if at < 0:
                    if head is not None:
                        prove()
                    head, stretch, rows = (number, n, path, [c[i] for c in common]), [], []
                else:
                    stretch.append(value)
                    if is_leaf:
                        rows.append([c[i] for c in given])
                if len(done) >= FLUSH:
                    yield flushed()
        if head is not None:
            prove()
        if done:
            yield flushed()

    return extract


def proofs(leaves: DataFrame, log: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """The rows of ``leaves`` with their ``path``: a step (own slot, the others' digests) for each level up to the
    tree's root, then the steps of ``above`` (tree, path_above), if any, whose other columns the rows get too."""
    heads, of_head = upper_paths(leaves, log), []
    if above is not None:
        of_head = [c for c in above.columns if c not in ("tree", "path_above")]
        heads = heads.join(above, "tree").withColumn("path", F.concat("path", "path_above")).drop("path_above")
    carried = leaves
    block = F.floor(F.col("index") / F.lit(BLOCK)).alias("block")
    own = log.where(F.col("level") == 0).select("tree", "index", "position").join(
        carried, ["tree", "index"]).withColumn("block", block).withColumn("is_leaf", F.lit(True))
    inner = log.where((F.col("level") > 0) & (F.col("level") < SPAN)).select("tree", "block", "position", "leaves", "digest")
    stretch = (
        own.unionByName(inner, allowMissingColumns=True)
        .unionByName(heads.withColumn("position", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        .repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    )
    out = stretch.select(*carried.columns, *of_head, "path").schema
    return stretch.mapInArrow(lean(_extract(to_arrow_schema(out), of_head)), out)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""

    def up(value: Column, step: Column) -> Column:
        left = step["slot"] * HEX
        return F.sha2(F.concat(F.substring(step["digests"], F.lit(1), left), value,
                               F.substring(step["digests"], left + 1, F.length(step["digests"]))).cast("binary"), 256)

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """Every row's id, leaf, subroot, root and whole proof path; and the ``carried`` columns."""
    leaves = leaves_of(docs, **carried)
    log = append_log(leaves, "merkle")
    subroots = _numbered(
        roots(log).select(F.lit(TOP).alias("tree"), F.col("tree").alias("id"), F.col("root").alias("digest")), ["id"], "subroots")
    top = append_log(subroots, "merkle-top")
    above = proofs(subroots, top).join(F.broadcast(roots(top)), "tree").select(  # one root
        F.col("id").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("path_above"))
    return proofs(leaves, log, above).select(
        F.col("id").alias(ID), F.col("digest").alias("leaf"), "subroot", "root", "path", *carried)
