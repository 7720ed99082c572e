"""Vectorised text features (numpy), and bounded samples of labelled rows for fitting."""

from __future__ import annotations

import functools

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxstar.llm.common import ID, TEXT, crc_fold

CHUNK = 1 << 20  # code points handled at a time, so that a huge text needs bounded memory
MAX_FIT_CHARS = 20_000  # longer texts are left out of the fitting sample, never out of scoring
LETTER = regex.compile(r"\p{L}")

_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def word_chars() -> np.ndarray:
    """For each code point, whether it is a letter or digit."""
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def word_codes(text: str):
    """Chunks of the lower-cased text's code points; each run of other characters is one
    space, and a space stands at both ends."""
    known = word_chars()
    for at in range(0, len(text), CHUNK):
        c = np.frombuffer(text[at:at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        word = known[c]
        c = np.where(word, c, 32)
        keep = word.copy()
        keep[1:] |= word[:-1]
        yield np.concatenate(([32], c[keep], [32])).astype(np.uint64)


def ngram_buckets(codes: np.ndarray, n: int, bits: int, within_words: bool) -> np.ndarray:
    """Hash buckets (``bits`` wide) of all n-grams; ``within_words`` drops those that reach
    over a space."""
    k = len(codes) - n + 1
    if k <= 0:
        return np.zeros(0, np.int64)
    h = np.full(k, n, np.uint64)
    crosses = np.zeros(k, bool)
    for j in range(n):
        part = codes[j:j + k]
        h = (h ^ part) * _MIX
        h ^= h >> np.uint64(31)
        if within_words and 0 < j < n - 1:
            crosses |= part == 32
    h = ((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64)
    return h[~crosses] if within_words else h


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, id_col: str = ID,
) -> list[tuple[str, object]]:
    """(text, label) of at most ``most`` labelled documents outside the held-out fold.

    The rows with the smallest id hash are taken, from ids and labels alone; then the
    documents are read once against those ids (a list of ``most`` rows at most, so it may
    be broadcast). Null ids, labels or texts and very long texts don't enter.
    """
    fold = crc_fold(F.col(id_col), folds)
    picked = (
        labels.select(F.col(id_col).cast("bigint").alias(id_col), F.col(label).alias("__label"))
        .where(F.col(id_col).isNotNull() & F.col("__label").isNotNull() & (fold != held_out))
        .orderBy(F.xxhash64(id_col), id_col, "__label").limit(most)
    )
    texts = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(TEXT).cast("string").alias("__text")).where(
        F.col("__text").isNotNull() & (F.length("__text") <= MAX_FIT_CHARS))
    rows = texts.join(F.broadcast(picked), id_col).select(id_col, "__text", "__label").take(2 * most)
    return [(r[1], r[2]) for r in sorted(rows, key=lambda r: (r[0], r[1], str(r[2])))]
