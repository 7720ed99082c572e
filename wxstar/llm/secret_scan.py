"""Secret scans: fixed patterns, and a battery of randomness tests with control of false discoveries.

Spans are in code points, the end exclusive. The fixed patterns (``assign``, ``access``, ``hex``) are found leftmost and
without overlap, each kind by itself. Beside them every **candidate** is judged: each run of ``MIN_SYMBOLS`` or more symbols of
base64 or base64url, wherever it stands, that holds a letter and a digit (numbers alone are phone, card and serial numbers, words
alone no keys).

1. *Encoding.* The smallest of ``ENCODINGS`` that holds all its symbols (trailing ``=`` are padding) gives each symbol its value.
2. *Battery.* Under "the symbols are drawn uniformly": the chi-squared of the alphabet's counts (its exact mean and variance for this
   length, not the limit, as counts are small), the runs above and below the middle of the alphabet, and the serial correlation of
   neighbours' values. Fisher's method combines the three; a candidate below ``BATTERY`` is structured and out. This bounds
   the loss of random strings, not the false ones: a short string of any kind passes.
3. *Evidence by length.* The likelihood of the symbols drawn uniformly from the encodings, over their likelihood as text: a model of
   symbol pairs counted over the whole table, but for candidates that the battery takes for random. It grows with every symbol, so length decides as far as it may. Under
   the text model its mean is at most 1: it is an e-value.
4. *False discoveries.* Over all candidates of the table, the k with the largest e-values are reported, for the largest k whose
   smallest is at least m / (k x ``FDR``) (m candidates: the e-value form of the Benjamini-Hochberg procedure, valid under any
   dependence, as with copies of documents). Only a histogram of rounded-down logarithms reaches the driver.

A reported candidate is a span ``random``, unless one of the fixed spans covers it. Results for odd input: a null text is empty and
has no spans; null and repeated ids keep a row each; other columns are carried by nobody and may have any name; an empty table has
no rows. Texts are scanned whole; a very long one costs memory of a few times its own size and its pairs are counted in chunks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm.common import ID, lean, materialize, text_or_empty

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGNED = 6                                 # characters of what is assigned, at least
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")    # 20 characters in all
HEX = re.compile(r"[0-9a-f]{24,}")

MIN_SYMBOLS = 16
BATTERY = 0.001
FDR = 0.01
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % MIN_SYMBOLS)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Symbols in the order of their values; the first that holds a candidate is its encoding.
ENCODINGS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER, "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_"}
SYMBOLS = _UPPER + _LOWER + _DIGITS + "+/-_"
OTHER = len(SYMBOLS)                         # anything else, in the pair counts
STATES = OTHER + 1
CHUNK = 1 << 20
STEP = 0.01                                  # of the histogram of logarithms
MOST = 1000.0                                # logarithms beyond are alike


def _table() -> np.ndarray:
    out = np.full(128, OTHER, np.int64)
    out[[ord(c) for c in SYMBOLS]] = range(OTHER)
    return out


_STATE = _table()
_VALUE = np.full((len(ENCODINGS), 128), -1, np.int64)
for _e, _letters in enumerate(ENCODINGS.values()):
    _VALUE[_e, [ord(c) for c in _letters]] = range(len(_letters))
_SIZE = np.array([len(v) for v in ENCODINGS.values()])


# -- the text model -----------------------------------------------------------------------------------------

def states(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _STATE[np.minimum(codes, 127)], OTHER)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring states, of the whole task; candidates that look random teach nothing about text."""
    total = np.zeros(STATES * STATES, np.int64)
    flat = np.zeros((STATES, OTHER))
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            runs = candidates(text, [])
            random = judge([text[a:b] for a, b in runs], flat)[1] if runs else []
            skip = [run for run, r in zip(runs, random) if r]
            for at in range(0, len(text), CHUNK):
                s = states(text[at:at + CHUNK + 1])  # one more: the pair over the border
                for a, b in skip:
                    if a < at + len(s) and b > at:
                        s[max(a - at, 0):b - at] = -1
                pairs = s[:-1] * STATES + s[1:]
                total += np.bincount(pairs[(s[:-1] >= 0) & (s[1:] >= 0)] if skip else pairs, minlength=STATES * STATES)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])


def text_model(docs: DataFrame) -> np.ndarray:
    """log P(next symbol | symbol) for symbols in runs, from the pairs of all texts (at most ``STATES`` ** 2 counts).

    The row ``OTHER`` is for a run's first symbol. Columns are renormalised to symbols, as a candidate is a run of them."""
    counted = docs.select(text_or_empty()).mapInArrow(lean(_count), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(STATES * STATES)
    for pair, n in counted.collect():
        counts[pair] = n
    after = counts.reshape(STATES, STATES)[:, :OTHER]
    return np.log((after + 0.5) / (after + 0.5).sum(axis=1, keepdims=True))


# -- the battery ----------------------------------------------------------------------------------------------

_erfc = np.vectorize(math.erfc, otypes=[float])


def normal_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2))


def gamma_tail(x: np.ndarray, mean: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """Upper tail of the gamma distribution of this mean and variance (Wilson and Hilferty's cube root)."""
    shape = mean * mean / variance
    root = np.cbrt(np.maximum(x, 0) / mean)
    return normal_tail((root - (1 - 1 / (9 * shape))) * 3 * np.sqrt(shape))


def encoding_of(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The first encoding that holds all symbols of each string; -1 where none does."""
    found = np.full(n, -1)
    for e in range(len(ENCODINGS) - 1, -1, -1):
        outside = np.bincount(owner[_VALUE[e, codes] < 0], minlength=n)
        found[outside == 0] = e
    return found


def battery(values: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Combined p-value of each string under uniform symbols: ``values`` of all strings in a row, ``lengths`` (3 or more) of the
    strings and ``sizes`` of their alphabets."""
    n, k = lengths.astype(float), sizes.astype(float)
    count = len(lengths)
    owner = np.repeat(np.arange(count), lengths)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))

    most = int(sizes.max())
    squares = np.zeros(count)
    step = max(1, (1 << 22) // most)  # strings at a time
    for low in range(0, count, step):
        high = min(low + step, count)
        a, b = starts[low], starts[high - 1] + lengths[high - 1]
        cells = np.bincount((owner[a:b] - low) * most + values[a:b], minlength=(high - low) * most)
        squares[low:high] = (cells.reshape(-1, most).astype(float) ** 2).sum(axis=1)
    chi = k / n * squares - n
    p_uniform = gamma_tail(chi, k - 1, 2 * (k - 1) * (n - 1) / n)

    inside = np.ones(len(values), bool)
    inside[starts] = False                  # neighbours within one string
    high_half = values * 2 >= sizes[owner]
    turns = np.zeros(len(values), bool)
    turns[1:] = (high_half[1:] != high_half[:-1]) & inside[1:]
    changes = np.bincount(owner[turns], minlength=count)
    z = (np.abs(changes - (n - 1) / 2) - 0.5) / np.sqrt((n - 1) / 4)
    p_runs = np.minimum(1, 2 * normal_tail(z))

    x = values.astype(float)
    add = lambda w: np.add.reduceat(w, starts)
    total, square = add(x), add(x * x)
    following = np.empty_like(x)
    following[:-1] = x[1:]
    following[starts + lengths - 1] = x[starts]  # round the end
    spread = n * square - total * total
    r = np.where(spread > 0, (n * add(x * following) - total * total) / np.where(spread > 0, spread, 1), 1.0)
    z = np.abs(r + 1 / (n - 1)) / np.sqrt(n * n / ((n - 1) ** 2 * (n - 2)))
    p_serial = np.minimum(1, 2 * normal_tail(z))

    half = -np.log(np.maximum(np.stack([p_uniform, p_runs, p_serial]), 1e-300)).sum(axis=0)
    return np.exp(-half) * (1 + half + half * half / 2)  # Fisher: chi-squared of 6 degrees


def log_evidence(codes: np.ndarray, owner: np.ndarray, lengths: np.ndarray, model: np.ndarray) -> np.ndarray:
    """log of (likelihood under a mixture of uniform encodings / likelihood as text) of each string."""
    count = len(lengths)
    s = _STATE[codes]
    before = np.concatenate(([OTHER], s[:-1]))
    before[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = OTHER
    as_text = np.bincount(owner, model[before, s], minlength=count)
    mixture = np.full(count, -np.inf)
    for e, size in enumerate(_SIZE):
        fits = np.bincount(owner[_VALUE[e, codes] < 0], minlength=count) == 0
        mixture = np.where(fits, np.logaddexp(mixture, -lengths * math.log(size)), mixture)
    return mixture - math.log(len(_SIZE)) - as_text


# -- scanning -------------------------------------------------------------------------------------------------

FOUND = "array<struct<kind:string,start:bigint,end:bigint,log_e:double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log_e", pa.float64())])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans, by start and kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGNED]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Runs with a letter and a digit that no fixed span covers."""
    out = []
    for m in RUN.finditer(text):
        run = m.group()
        if any(c.isdigit() for c in run) and any(c.isalpha() for c in run):
            a, b = m.span()
            if not any(s <= a and b <= e for _, s, e in base):
                out.append((a, b))
    return out


def judge(runs: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log e-value, whether the battery takes it for random) of each candidate; those of no encoding have -inf."""
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    codes = np.frombuffer("".join(runs).encode("ascii"), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(runs)), lengths)
    encoding = encoding_of(codes, owner, len(runs))
    log_e, random = np.full(len(runs), -np.inf), np.zeros(len(runs), bool)
    some = encoding >= 0
    if some.any():
        mine = some[owner]
        new = np.cumsum(some) - 1
        values = _VALUE[encoding[owner[mine]], codes[mine]]
        random[some] = battery(values, lengths[some], _SIZE[encoding[some]]) >= BATTERY
        log_e[some] = log_evidence(codes[mine], new[owner[mine]], lengths[some], model)
    return log_e, random


def _scan(model: np.ndarray):
    schema = pa.schema([("row", pa.int64()), ("found", pa.list_(_SPAN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, runs, at = [], [], []
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                base = base_spans(text)
                found.append([{"kind": k, "start": s, "end": e, "log_e": None} for k, s, e in base])
                for a, b in candidates(text, base):
                    runs.append(text[a:b])
                    at.append((i, a, b))
            if runs:
                log_e, random = judge(runs, model)
                for (i, a, b), e, ok in zip(at, np.where(random, log_e, -np.inf).tolist(), random.tolist()):
                    found[i].append({"kind": "random", "start": a, "end": b, "log_e": max(-MOST, min(MOST, e))})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], names=[batch.schema.names[0], "found"])

    return scan


def threshold(scanned: DataFrame) -> float:
    """The least reported log e-value: e-BH over all candidates, on logarithms rounded down to ``STEP``."""
    grid = F.floor(F.col("c.log_e") / STEP).cast("int")
    rows = (
        scanned.select(F.explode("found").alias("c")).where("c.kind = 'random'")
        .groupBy(grid.alias("g")).count().collect()  # at most 2 * MOST / STEP rows
    )
    m = sum(r["count"] for r in rows)
    k, least = 0, math.inf
    for g, n in sorted(((r["g"], r["count"]) for r in rows), reverse=True):
        k += n
        if g * STEP >= math.log(m) - math.log(k) - math.log(FDR):
            least = g * STEP
    return least


def scan(docs: DataFrame, id_col: str = ID) -> DataFrame:
    """(``id_col``, spans): all spans of every text as an array of (kind, start, end), by start and kind."""
    model = text_model(docs)
    scanned = materialize(docs.select(F.col(id_col), text_or_empty().alias("__text")).mapInArrow(
        lean(_scan(model)), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, found {FOUND}"), "spans")
    least = threshold(scanned)
    kept = F.filter("found", lambda s: s["log_e"].isNull() | (F.floor(s["log_e"] / STEP) * STEP >= F.lit(least)))
    order = F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["kind"].alias("kind"),
        s["end"].alias("end")))
    spans = F.transform(F.array_sort(order), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.select(id_col, spans.alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
