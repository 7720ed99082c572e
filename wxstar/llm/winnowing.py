"""Document fingerprints by winnowing, in DataFrame functions alone.

Units are runs of up to 16 characters without white space (words; long unbroken runs are
cut), so positions and the guarantee count units, not characters. Every k-gram of units has a hash modulo a 32-bit prime, built
from its neighbours' hashes by doubling (k = 5 = 4 + 1): of polynomial form, but for the pairs' coefficient, which is cut to
30 bits so that products stay in a bigint. In every window of 8 k-grams
the least hash is chosen, the rightmost on ties: hash and reversed position share one bigint, and window minima
are taken by doubling as well. Distinct choices with their positions are the fingerprint. Guarantee:
two texts that share a run of ``K + WINDOW - 1`` = 12 units share a choice from that run.

Defined results: a null text counts as empty and has an empty fingerprint; under five units
make one gram; fewer than eight grams make one window. A very long text is one row of arrays, some 100 bytes a unit. Two empty fingerprints have likeness 1.
Repeated rows and repeated or null ids are fingerprinted each for itself (nulls come last in the id order);
a lone document is its own next one. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxstar.llm.common import ID, TEXT, materialize, text_or_empty, with_row_ids

K, WINDOW = 5, 8
PRIME, BASE = 4294967291, 1000003  # products stay below 2^63
_PLACE = 1 << 31


def _pairs(a: Column, shift: int, f) -> Column:
    """f(a[i], a[i + shift]) for every i that has both."""
    n = F.size(a) - shift
    return F.zip_with(F.slice(a, 1, n), F.slice(a, 1 + shift, n), f)


def with_marks(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the chosen grams as bigints, hash in the upper 32 bits, then 2^31 - 1 - position."""
    own = df.columns
    mod = lambda x: x % F.lit(PRIME)
    lesser = lambda a, b: F.least(a, b)
    df = df.withColumn("__u", F.regexp_extract_all(F.col(text), F.lit(r"(\S{1,16})"), F.lit(1)))
    df = df.withColumn("__x", F.transform("__u", lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME))))
    x = F.col("__x")
    df = df.withColumn("__g2", F.when(F.size(x) >= K, _pairs(x, 1, lambda a, b: mod(a * BASE + b))))
    df = df.withColumn("__g4", _pairs(F.col("__g2"), 2, lambda a, b: mod(a * F.lit(BASE * BASE % PRIME % (1 << 30)) + b)))
    last = F.slice(x, K, F.size(x) - K + 1)
    rolled = F.zip_with(F.slice("__g4", 1, F.size(x) - K + 1), last, lambda a, b: mod(a * BASE + b))
    short = F.when(F.size(x) == 0, F.array().cast("array<bigint>")).otherwise(
        F.array(F.pmod(F.xxhash64(F.array_join("__u", " ")), F.lit(PRIME))))
    grams = F.when(F.size(x) >= K, rolled).otherwise(short)
    df = df.withColumn("__k", F.transform(grams, lambda h, i: h * F.lit(_PLACE) + (F.lit(_PLACE - 1) - i)))
    k = F.col("__k")
    full = F.size(k) >= WINDOW
    df = df.withColumn("__m2", F.when(full, _pairs(k, 1, lesser)))
    df = df.withColumn("__m4", _pairs(F.col("__m2"), 2, lesser))
    one = F.when(F.size(k) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.array_min(k)))
    df = df.withColumn(out, F.array_distinct(F.when(full, _pairs(F.col("__m4"), 4, lesser)).otherwise(one)))
    return df.select(*own, out)


def positions(marks: Column) -> Column:
    """The marks as structs (hash, position), position counted in k-grams from 0."""
    return F.transform(marks, lambda m: F.struct(
        F.shiftright(m, 31).alias("hash"), (F.lit(_PLACE - 1) - m.bitwiseAND(F.lit(_PLACE - 1))).alias("position")))


def hashes(marks: Column) -> Column:
    """The distinct hashes of the marks."""
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, 31)))


def digest(marks: Column) -> Column:
    """16 hex digits of the whole fingerprint, positions included."""
    return F.lower(F.lpad(F.hex(F.xxhash64(marks, F.size(marks))), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of hashes."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def fingerprints(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """(id, marks): the fingerprint with positions of every row."""
    return with_marks(docs.select(id_col, text_or_empty(text_col).alias("__text")), "__text", "__marks").select(
        id_col, positions(F.col("__marks")).alias("marks"))


def neighbours(lengths: DataFrame) -> DataFrame:
    """Adds ``__to`` (the row before) and ``__need`` (half its length) to (__rid, __n), in the
    order of __rid, round from the first to the last.

    Rows are dealt into id ranges; each range finds its own neighbours, and the ranges'
    first and last rows (one row a range) settle the seams.
    """
    dealt = materialize(lengths.repartitionByRange("__rid").withColumn("__range", F.spark_partition_id()), "ranges")
    order = Window.partitionBy("__range").orderBy("__rid")
    ends = dealt.groupBy("__range").agg(F.max("__rid").alias("__last"), F.max_by("__n", "__rid").alias("__last_n"))
    seam = Window.orderBy("__range")
    whole = seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seams = ends.select(
        "__range",
        F.coalesce(F.lag("__last").over(seam), F.last("__last").over(whole)).alias("__last_before"),
        F.coalesce(F.lag("__last_n").over(seam), F.last("__last_n").over(whole)).alias("__before_n"))
    return dealt.withColumn("__before_rid", F.lag("__rid").over(order)).withColumn("__before", F.lag("__n").over(order)).join(
        seams, "__range").select(
        *lengths.columns, F.coalesce("__before_rid", "__last_before").alias("__to"),
        F.floor(F.coalesce("__before", "__before_n") / 2).cast("int").alias("__need"))


def compare_edited(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the last half replaced
    by the next document's start) and likenesses to the edited and the next text.

    The texts are dealt by row once; each row sends the row before it only what that needs, the start
    of its text and its hashes.
    """
    rows = with_row_ids(docs.select(F.col(id_col).alias(id_col), text_or_empty(text_col).alias("__text")), id_col)
    places = materialize(neighbours(rows.select("__rid", id_col, F.length("__text").alias("__n"))), "places")
    texts = rows.select("__rid", "__text")
    sent = with_marks(texts.join(places.select("__rid", "__to", "__need"), "__rid"), "__text", "__m").select(
        F.col("__to").alias("__rid"), F.expr("left(__text, __need)").alias("__start"), hashes(F.col("__m")).alias("__next_hashes"))
    own = texts.join(places.select("__rid", id_col, "__n"), "__rid").join(sent, "__rid")
    own = own.withColumn("__edited", F.concat(F.expr("left(__text, cast(__n - floor(__n / 2) as int))"), "__start"))
    own = with_marks(with_marks(own, "__text", "__m"), "__edited", "__e")
    own = own.withColumn("__h", hashes(F.col("__m")))
    return own.select(
        id_col, F.col("__n").cast("bigint").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
        digest(F.col("__m")).alias("fingerprint"), digest(F.col("__e")).alias("edited_fingerprint"),
        likeness(F.col("__h"), hashes(F.col("__e"))).alias("near_edited"),
        likeness(F.col("__h"), F.col("__next_hashes")).alias("near_next"))
