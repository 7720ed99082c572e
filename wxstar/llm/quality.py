"""Quality: attention-based multiple-instance learning over a document's passages.

A document is a bag of passages of 64 words. Every passage is encoded (shape features of
its characters and repetition of its words, then one dense layer); gated attention
(tanh and sigmoid branches, softmax over the document's passages) weighs the encodings,
and a logistic unit scores the weighted passage representation. All weights are learned
from document labels alone, with the gradient taken through the attention.

Defined results: null, empty and blank texts are one passage without words. Without
labelled rows, or with one class only, the score is the share of label 1 (1 for no rows: nothing
speaks against a document). Each row is scored by itself: repeated rows, null ids, ties and extra
columns change nothing. Every passage of a text of any length counts.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm import features

WORDS = 64
CLASSES = 6  # lower case, upper case, digit, space, sentence mark, other
HIDDEN, ATTENTION = 16, 8
MAX_ROWS = 4000  # documented bound of the fitting sample
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
WIDTH = CLASSES ** 3 + 6


def _char_classes() -> np.ndarray:
    kind = np.full(0x110000, 5, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isupper():
            kind[i] = 1
        elif c.isalpha():
            kind[i] = 0
        elif c.isdigit():
            kind[i] = 2
        elif c.isspace():
            kind[i] = 3
    kind[[ord(c) for c in ".,;:'\"?-"]] = 4
    return kind


_kinds: list[np.ndarray] = []


def encode_text(text: str) -> np.ndarray:
    """A feature row for each passage (64 words; one row for a text without words): class
    trigram shares, repeated and distinct words, word length."""
    if not _kinds:
        _kinds.append(_char_classes())
    words = (text or "").split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    first = range(0, len(words), WORDS)
    c = _kinds[0][np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    bounds = np.append(ends[WORDS - 1::WORDS], ends[-1]) if len(words) % WORDS else ends[WORDS - 1::WORDS]
    chars = np.diff(bounds, prepend=0).astype(np.float32)
    row = np.repeat(np.arange(len(first)), np.diff(bounds, prepend=0))
    tri = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
    x = np.zeros((len(first), WIDTH), np.float32)
    cells = np.bincount(row[:len(tri)] * CLASSES ** 3 + tri, minlength=len(first) * CLASSES ** 3)
    x[:, :-6] = np.sqrt(cells.reshape(len(first), -1) / chars[:, None])
    n = np.minimum(len(words) - np.arange(len(first)) * WORDS, WORDS).astype(np.float32)
    x[:, -6] = 1 - np.array([len(set(words[i:i + WORDS])) for i in first], np.float32) / n
    x[:, -5] = np.array([sum(map(operator.eq, words[i:i + WORDS - 1], words[i + 1:i + WORDS])) for i in first], np.float32) / n
    x[:, -4] = np.minimum(chars / n / 10, 3)
    x[:, -3] = n / WORDS
    c = c[1:-1]
    x[:, -2] = np.bincount(row[:len(c)], c == 5, len(first)) / chars
    x[:, -1] = np.bincount(row[:len(c)], c == 1, len(first)) / chars
    return x


@dataclass
class MilModel:
    """Dense layer (w, b), attention (v, u, a), output (o, c), feature centre and scale."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    o: np.ndarray
    c: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.b, self.v, self.u, self.a, self.o, self.c]


def forward(m: MilModel, x: np.ndarray, starts: np.ndarray):
    """Bag logits and what the gradient needs; passages of a bag are contiguous from its start."""
    sizes = np.diff(np.append(starts, len(x)))
    bag = np.repeat(np.arange(len(starts)), sizes)
    h = np.tanh((x - m.centre) / m.scale @ m.w + m.b)
    t, s = np.tanh(h @ m.v), 1 / (1 + np.exp(-np.clip(h @ m.u, -30, 30)))
    e = (t * s) @ m.a
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    att = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(att[:, None] * h, starts, axis=0)
    return z @ m.o + m.c[0], (bag, h, t, s, att, z)


def gradients(m: MilModel, x: np.ndarray, starts: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """Gradients of all parts for d = dLoss/dlogit by bag."""
    _, (bag, h, t, s, att, z) = forward(m, x, starts)
    dz = d[:, None] * m.o
    d_att = (h * dz[bag]).sum(1)
    de = att * (d_att - np.add.reduceat(att * d_att, starts)[bag])
    dt, ds = de[:, None] * m.a * s * (1 - t * t), de[:, None] * m.a * t * s * (1 - s)
    dh = (att[:, None] * dz[bag] + dt @ m.v.T + ds @ m.u.T) * (1 - h * h)
    xs = (x - m.centre) / m.scale
    return [xs.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d, np.array([d.sum()])]


def fit(rows: list[tuple[str, int]], epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 5) -> MilModel | float:
    """Adam over mini-batches of bags; both classes weigh the same. A constant for one class."""
    rows = [(t, int(y)) for t, y in rows if y is not None]
    ones = sum(y for _, y in rows)
    if not ones or ones == len(rows):
        return ones / len(rows) if rows else 1.0
    bags = [encode_text(t) for t, _ in rows]
    y = np.array([y for _, y in rows], np.float32)
    every = np.concatenate(bags)
    centre, scale = every.mean(0), every.std(0) + 0.02
    rng = np.random.default_rng(seed)
    g = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    m = MilModel(g(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), g(HIDDEN, ATTENTION), g(HIDDEN, ATTENTION),
                 g(ATTENTION), g(HIDDEN), np.zeros(1, np.float32), centre, scale)
    mean, square, k = [np.zeros_like(p) for p in m.parts()], [np.zeros_like(p) for p in m.parts()], 0
    weight = np.where(y == 1, len(y) / (2 * ones), len(y) / (2 * (len(y) - ones)))
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            x = np.concatenate([bags[i] for i in part])
            starts = np.cumsum([0, *(len(bags[i]) for i in part[:-1])])
            z, _ = forward(m, x, starts)
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)
            k += 1
            for p, a, b, d_p in zip(m.parts(), mean, square, gradients(m, x, starts, d)):
                a += 0.1 * (d_p - a)
                b += 0.01 * (d_p * d_p - b)
                p -= rate * (a / (1 - 0.9 ** k)) / (np.sqrt(b / (1 - 0.99 ** k)) + 1e-8)
    return m


def score(text: Column, model: MilModel | float) -> Column:
    """Probability of label 1 of a text column (0 to 1)."""

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if not isinstance(model, MilModel):
                yield pd.Series(np.full(len(texts), float(model)))
                continue
            z = np.empty(len(texts))
            for at in range(0, len(texts), 64):
                bags = [encode_text(t) for t in texts.iloc[at:at + 64]]
                starts = np.cumsum([0, *map(len, bags[:-1])])
                z[at:at + 64] = forward(model, np.concatenate(bags), starts)[0]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return judge(text)


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> MilModel | float:
    """Fits on at most ``max_rows`` labelled documents outside the held-out fold."""
    return fit(features.labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, max_rows))
