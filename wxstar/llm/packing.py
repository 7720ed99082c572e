"""Best-fit packing of documents into fixed-length training sequences.

Documents are cut into pieces of at most ``size`` tokens. The lengths' histogram (at most
``size`` numbers, whatever the corpus) defines a configuration linear program: how often to
use each multiset of lengths that fits a sequence, so that every piece is covered by as
few sequences as can be. Multiplicative weights solve it: each round prices the lengths, a knapsack by dynamic
programming finds the best-paying configuration, and the lengths it serves lose weight.

Rounding. Configurations without lost room are used as often as the solution says, rounded down. That leaves a residual
program, of few pieces a length, in which all uses are fractions; its rounds go on with whole uses: lengths are priced by what
they fill, the less served and the longer ones somewhat more, the knapsack (within the counts left, over a part of the lengths,
or over all where that part doesn't fill a sequence) gives a configuration, and it is used until one of its lengths is spent, so there are
no more rounds than lengths, whatever the counts. Best fit, longest first, packs only the last two sequences' worth; where lengths
can't fill sequences, so that this misses the tokens' bound, the program's own prices and best fit for all of the residual are tried
as well, and the fewest sequences count. The plan
(ranges of equal-length pieces by configuration) is joined back to the pieces; ``Plan`` tells the program's value, the bound
and what came from where.

Pieces of one length get their numbers from counts by (length, salt) and a window inside
each, so a length that a third of all pieces have is never one group.

Defined results: a null text counts as empty; an empty text is one piece, the closing id
alone. Repeated rows and repeated or null ids are packed each for itself. An empty table gives no rows. Only id and
text are read, so other columns can't clash. Texts of any length are cut whole; a long one is encoded in parts that the
tokenizer's own split can't join, where it has such places.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from wxstar.llm.common import ID, TEXT, by_bytes, lean, materialize, text_or_empty

SIZE = 2048
ROUNDS = 200
SALT_ROWS = 200_000  # pieces of one length and salt that one window numbers
PARTIAL = 224  # lengths that a round of the residual program prices, the 32 longest among them
CACHE = 64 << 20  # bytes of words and ids that a Python worker keeps
SLICE = 8 << 20  # bytes of text whose pieces are made together
PART = 1 << 20  # characters of a long text that are encoded together


# --- tokens -----------------------------------------------------------------------------


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit numbers, encoded when first met. Two generations of words are kept, of
    about ``CACHE`` bytes together: a full one replaces the older, from which words in use come back, so frequent words stay."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        self.alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.held = 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            tokens = self.model.tokenize(self.alphabet.pre_tokenize_str(word)[0][0])
            found = struct.pack(f"<{len(tokens)}I", *(t.id for t in tokens))
        self.held += 200 + len(word)  # about: two small objects and a place in the table
        if self.held > CACHE // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[word] = found
        return found


@functools.cache
def _tokenizer(path: str) -> tuple[Tokenizer, WordIds | None]:
    """The tokenizer; the ids of single words, if its normalizer is the one that ``_PLAIN`` is cut for."""
    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    parts = json.loads(whole.to_str())
    normalizer, split = (parts.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
    known = (
        [n["type"] for n in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        and [(p["type"], p.get("pattern"), p.get("behavior"), p.get("invert"), p.get("add_prefix_space"), p.get("use_regex"))
             for p in split.get("pretokenizers", [])] == _KNOWN_SPLIT)
    return whole, WordIds(whole) if known else None


#: Printable Latin-1 text: NFC leaves it alone and lower() is the tokenizer's.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ÿ]*")
#: The tokenizer's own split for such text, after lower-casing (the soft hyphen is left to the whole tokenizer).
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


#: What the two patterns above stand for; any other tokenizer encodes whole texts by itself.
_KNOWN_SPLIT = [
    ("Split", {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "Removed", True, None, None),
    ("ByteLevel", None, None, None, False, False)]
#: A place where white space that the split removes stands between two plain letters: nothing reaches over it.
_CUT = re.compile("(?<=[a-zA-Z]) (?=[a-zA-Z])")


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        cut = _CUT.search(text, at + PART)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def token_bytes(text: str, path: str) -> bytes:
    """The text's token ids as little-endian unsigned 32-bit numbers."""
    whole, words = _tokenizer(path)
    if words is None or "<|" in text:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return b"".join(
        b"".join(map(words.__getitem__, _SPLIT.findall(part.lower()))) if _PLAIN.fullmatch(part)
        else np.array(whole.encode(part, add_special_tokens=False).ids, "<u4").tobytes() for part in _parts(text))


def pieces_of(texts: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False, id_col: str = ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) from (id, __text)."""
    columns = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = ", ".join(f"{c} {'int' if c == 'piece' else 'binary' if c == 'ids' else 'bigint'}" for c in columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_bytes(whole, SLICE)):
            rows = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_bytes(text.as_py(), tokenizer) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    rows.append((own, piece, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ()))
            types = [pa.int32() if c == "piece" else pa.binary() if c == "ids" else pa.int64() for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * len(columns), types)], names=columns)

    return texts.select(id_col, "__text").mapInArrow(lean(cut), kinds)


# --- the plan, from the histogram alone ---------------------------------------------------


def knapsack(value: np.ndarray, size: int, counts: np.ndarray | None = None) -> np.ndarray:
    """Counts by length of the best-paying multiset of lengths with a sum of at most ``size``, within ``counts``.

    ``value[l]`` pays for a piece of length l (0: not on offer). Several pieces of a length are offered as 1, 2, 4, ... of them;
    each offer is one step over all sums."""
    offers = []
    for length in np.flatnonzero(value > 0)[::-1].tolist():
        most, n = size // length, 1
        if counts is not None:
            most = min(most, int(counts[length]))
        while most > 0:
            n = min(n, most)
            offers.append((length, n))
            most, n = most - n, 2 * n
    best, took = np.zeros(size + 1), np.zeros((len(offers), size + 1), bool)
    for i, (length, n) in enumerate(offers):
        room = length * n
        paid = best[:size + 1 - room] + value[length] * n
        took[i, room:] = better = paid > best[room:]
        best[room:] = np.where(better, paid, best[room:])
    out, room = np.zeros(len(value), np.int64), size
    for i in range(len(offers) - 1, -1, -1):
        if took[i, room]:
            length, n = offers[i]
            out[length] += n
            room -= length * n
    return out


class Plan(list):
    """(uses, {length: pieces}) covering a histogram exactly. ``bound``: sequences that the tokens fill; ``value``: sequences of the
    fractional solution; ``solved``, ``residual``, ``fitted``: sequences from its configurations, from those of the residual program,
    and from best fit. Full-length pieces, a sequence each, are in none of them."""

    bound = solved = residual = fitted = 0
    value = 0.0


def plan(histogram: dict[int, int], size: int = SIZE, rounds: int = ROUNDS) -> Plan:
    """The work depends on ``size``, not on the counts."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = Plan()
    if left[size]:
        out.append((int(left[size]), {size: 1}))
        left[size] = 0
    if left.any():
        out.bound = -(-int(left @ np.arange(size + 1)) // size)
        fractional, prices = solve(left, size, rounds)
        out.value = sum(uses for _, uses in fractional)
        # where sequences can be filled, a length's price is what it fills, and what does not fill one is only unsettled;
        # where they cannot, the program's prices tell what goes together
        length = np.arange(size + 1)
        full = [(c, uses) for c, uses in fractional if c @ length == size]
        ways = []
        for chosen, price in ((full, length), (fractional, prices), (fractional, None)):
            solved, rest = rounded(left, chosen)
            residual, rest = ([], rest) if price is None else served_whole(rest, size, price)
            ways.append((solved, residual, best_fit(rest, size)))
            if sum(n for part in ways[-1] for n, _ in part) <= out.bound + 1:
                break
        best = min(ways, key=lambda way: sum(n for part in way for n, _ in part))
        out.solved, out.residual, out.fitted = (sum(n for n, _ in part) for part in best)
        out += [use for part in best for use in part]
    return out


def solve(left: np.ndarray, size: int, rounds: int) -> tuple[list[tuple[np.ndarray, float]], np.ndarray]:
    """A fractional cover of the counts, most used first, and the prices of the lengths: the average over the second half of
    the multiplicative-weights rounds (in the first half the prices still settle). Weights start at the tokens of each
    length: what a length fills is its price wherever sequences can be filled."""
    need = left.astype(float)
    there = need > 0
    log_w = np.log(np.maximum(need * np.arange(size + 1), 1))
    configs: dict[bytes, float] = {}
    served, prices = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(rounds):
        w = np.where(there, np.exp(log_w - log_w[there].max()), 0)
        price = np.where(there, w / np.maximum(need, 1), 0)
        c = knapsack(price, size)
        used = c > 0
        step = float((need[used] / c[used]).min())  # uses that just meet the scarcest length
        log_w[used] -= 0.5 * step * c[used] / need[used]
        if 2 * k >= rounds:
            configs[c.tobytes()] = configs.get(c.tobytes(), 0) + step
            served += step * c
            prices += price / (price @ c)
    scale = float((served[there] / need[there]).mean())
    cover = [(np.frombuffer(key, np.int64), uses / scale) for key, uses in sorted(configs.items(), key=lambda kv: (-kv[1], kv[0]))]
    return cover, prices / prices.max()


def _use(c: np.ndarray, n: int) -> tuple[int, dict[int, int]]:
    return n, {int(k): int(c[k]) for k in np.flatnonzero(c)}


def rounded(left: np.ndarray, fractional: list[tuple[np.ndarray, float]]) -> tuple[list[tuple[int, dict[int, int]]], np.ndarray]:
    """Whole uses, rounded down and never beyond the counts; and the counts left."""
    left, out = left.copy(), []
    for c, uses in fractional:
        n = int(min(np.floor(uses), (left[c > 0] // c[c > 0]).min()))
        if n > 0:
            left -= n * c
            out.append(_use(c, n))
    return out, left


def served_whole(
    left: np.ndarray, size: int, prices: np.ndarray, keep: int = 2,
) -> tuple[list[tuple[int, dict[int, int]]], np.ndarray]:
    """Rounds of the residual program with whole uses, until less than ``keep`` sequences' worth is left; and the counts left."""
    left, out, length = left.copy(), [], np.arange(size + 1)
    whole = np.maximum(left, 1)
    random = np.random.default_rng(size)
    while left @ length >= keep * size:
        # by tokens, the extra price of a sequence's pieces sums to less than one token: it only chooses among the fullest
        extra = 0.5 * (left / whole) + 0.5 * length / size
        price = np.where(left > 0, prices * (1 + extra / (2 * size)), 0)
        there = np.flatnonzero(left)
        c = np.zeros(size + 1, np.int64)
        if len(there) > PARTIAL:
            longest, others = there[-32:], there[:-32]
            offered = np.concatenate([longest, random.choice(others, PARTIAL - 32, replace=False)])
            part = np.zeros(size + 1)
            part[offered] = price[offered]
            c = knapsack(part, size, left)
        if c @ length < size:
            c = knapsack(price, size, left)
        n = int((left[c > 0] // c[c > 0]).min())
        left -= n * c
        out.append(_use(c, n))
    return out, left


def best_fit(left: np.ndarray, size: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, on counts: a sequence takes the longest piece left, then the
    set that fills its room best (subset sums over the lengths left); it is repeated as often as the counts allow."""
    left, out = left.copy(), []
    while left.any():
        c = np.zeros(len(left), np.int64)
        longest = int(np.flatnonzero(left)[-1])
        c[longest], room = 1, size - longest
        while room > 0:
            fits = np.flatnonzero((left - c)[:room + 1] > 0)
            if not len(fits):
                break
            take = int(fits[-1])
            rest = room - take
            if rest and not (left - c)[rest:rest + 1].any():  # a pair that fills exactly beats the longest
                a = fits[(room - fits) > 0]
                pair = a[(left - c)[room - a] > (a == room - a)]
                if len(pair):
                    take = int(pair[-1])
            c[take] += 1
            room -= take
        n = int((left[c > 0] // c[c > 0]).min())
        left -= n * c
        out.append(_use(c, n))
    return out


# --- pieces to sequences ------------------------------------------------------------------


def numbered(pieces: DataFrame, total: int) -> DataFrame:
    """Adds ``__rank``: 0, 1, ... among the pieces of the same length."""
    salts = max(1, total // SALT_ROWS)
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("__uid"), F.lit(salts)))
    counts = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("__uid")) - 1
    return salted.withColumn("__in", inside).join(starts, ["length", "__salt"]).withColumn(
        "__rank", F.col("__before") + F.col("__in")).drop("__salt", "__in", "__before")


def slots(configs: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies in a sequence, first sequence, offset) by configuration and length."""
    rows, rank, sequence = [], {}, 0
    for uses, counts in configs:
        offset = 0
        for length in sorted(counts, reverse=True):
            n, first = counts[length], rank.get(length, 0)
            rows.append((length, first, first + n * uses, n, sequence, offset))
            rank[length] = first + n * uses
            offset += n * length
        sequence += uses
    return rows


def pack_pieces(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to pieces (__uid, length, ...)."""
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``size`` rows
    spark = pieces.sparkSession
    table = spark.createDataFrame(
        slots(plan(histogram, size)),
        "length bigint, __first bigint, __end bigint, __copies bigint, __sequence bigint, __offset bigint")
    # the plan's size depends on ``size`` alone: it may be broadcast
    inside = F.col("__rank") - F.col("__first")
    return numbered(pieces, sum(histogram.values())).join(F.broadcast(table), "length").where(
        "__rank >= __first AND __rank < __end").withColumn(
        "sequence_id", F.col("__sequence") + F.floor(inside / F.col("__copies")).cast("bigint")).withColumn(
        "offset", F.col("__offset") + inside % F.col("__copies") * F.col("length")).drop(
        "__rank", "__first", "__end", "__copies", "__sequence", "__offset")


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    texts = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_or_empty(text_col).alias("__text"))
    pieces = pieces_of(texts, tokenizer, size, with_ids, id_col)
    # numbered where they are made: the table is written once, so the numbers stay
    pieces = materialize(pieces.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    ids = ["ids"] * with_ids
    return pack_pieces(pieces, size).select(
        id_col, "piece", "start", "length", "ids_crc32", *ids, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): each sequence's token ids as bytes, from ``pack(..., with_ids=True)``; ``size`` tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
