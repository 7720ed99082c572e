"""Toxicity: subword-bag embeddings averaged into a linear softmax, fitted jointly in numpy.

A text is the bag of its words' character 3- to 5-grams (words are padded with a space on
both sides) and of its whole words. Each hash bucket has an embedding; the mean of a
text's embeddings goes into a two-class softmax. Embeddings and softmax are learned
together by stochastic gradient steps, so a misspelt word that was never seen
shares most of its n-gram vectors with the word it stands for.

Defined results: null and empty texts and texts without a letter or digit get the softmax
of the bias alone (the fitted prior). Without labelled rows, or with one class only, the score is the
share of label 1 in the sample (0 for none). Every row is scored by itself: repeated rows, null ids, ties and extra columns
change nothing. Texts of any length are scored whole, a bounded chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm import features
from wxstar.llm.common import release

BITS = 17
DIM = 8
MAX_ROWS = 6000  # documented bound of the fitting sample
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
NEUTRAL = 200  # zero vectors averaged in with each bag, so that a few grams alone weigh little


@dataclass
class SubwordModel:
    """For scoring, embeddings and softmax fold into one number per bucket."""

    contribution: np.ndarray  # buckets
    bias: float


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the text's subwords and words, and their shares."""
    found = []
    for codes in features.word_codes(text or ""):
        found += [features.ngram_buckets(codes, n, BITS, True) for n in (3, 4, 5)]
        found.append(word_buckets(codes))
    if not found or not sum(map(len, found)):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    u, n = np.unique(np.concatenate(found), return_counts=True)
    return u, (n / (n.sum() + NEUTRAL)).astype(np.float32)


def word_buckets(codes: np.ndarray) -> np.ndarray:
    """One bucket for each word: a sum of position-weighted code points, hashed."""
    space = codes == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(starts):
        return starts
    place = np.arange(len(codes), dtype=np.uint64)
    place -= np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(codes)])))).astype(np.uint64)
    power = (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = np.add.reduceat(np.where(space, 0, (codes ^ (codes << np.uint64(13))) * (power ^ (power >> np.uint64(29)))), starts)
    h ^= h >> np.uint64(32)
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


def fit(rows: list[tuple[str, int]], epochs: int = 8, rate: float = 0.5, seed: int = 11) -> SubwordModel:
    """Stochastic gradient steps with per-bucket step sizes (AdaGrad); both classes weigh the same."""
    bags = [(*bag(t), int(y)) for t, y in rows if y is not None]
    ones = sum(y for *_, y in bags)
    if not ones or ones == len(bags):
        share = ones / len(bags) if bags else 0.0
        return SubwordModel(np.zeros(1 << BITS, np.float32), 40.0 if share else -40.0)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen, seen_out = np.full(1 << BITS, 1e-3, np.float32), 1e-3
    weight = (len(bags) / (2 * (len(bags) - ones)), len(bags) / (2 * ones))
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            u, share, y = bags[i]
            if not len(u):
                continue
            mean = share @ emb[u]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y] -= 1
            g *= weight[y]
            into = out @ g
            d_out = np.outer(mean, g)
            seen_out += float((d_out ** 2).mean())
            out -= rate * d_out / np.sqrt(seen_out)
            bias -= 0.05 * g
            seen[u] += share ** 2 * float((into ** 2).mean())
            emb[u] -= rate * (share / np.sqrt(seen[u]))[:, None] * into
    return SubwordModel((emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def logit(model: SubwordModel, text: str) -> float:
    total, n = 0.0, 0
    for codes in features.word_codes(text or ""):
        for found in (*(features.ngram_buckets(codes, k, BITS, True) for k in (3, 4, 5)), word_buckets(codes)):
            total += float(model.contribution[found].sum(dtype=np.float64))
            n += len(found)
    return model.bias + total / (n + NEUTRAL)


def score(text: Column, model: SubwordModel) -> Column:
    """Probability of label 1 of a text column (0 to 1)."""

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            z = np.array([logit(model, t) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        release()

    return judge(text)


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> SubwordModel:
    """Fits on at most ``max_rows`` labelled documents outside the held-out fold."""
    return fit(features.labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_rows))


def reject_toxic(docs: DataFrame, model: SubwordModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns."""
    return docs.where(score(F.col("text").cast("string"), model) < threshold)
