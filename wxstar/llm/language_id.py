"""Language identification with error-correcting output codes.

Each language gets a codeword of +1/-1 bits. One binary character-n-gram classifier
per bit is fitted by logistic regression; a text's predicted bits are compared with every
codeword by a weighted logistic loss (the weight of a bit for a language is how often
that classifier was right on the language's fitting rows), and the nearest codeword wins.

Defined results: null texts and texts without a letter get ``und`` and score 0; with no
labelled row at all every text gets ``und``; with one language every text with a letter
gets it. Ties go to the language that sorts first. Repeated rows, null ids and extra
columns are kept apart: the operator looks at one text at a time. Texts of any length are
scored whole, a bounded chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm import features

BITS = 12  # 4096 buckets of letter 2- and 3-grams
MAX_ROWS = 3000  # documented bound of the fitting sample
FOLDS, HELD_OUT = 3, 1
AMBIGUOUS_MARGIN = 0.2  # share of the summed evidence by which the best must lead the second


@dataclass
class CodedClassifier:
    languages: list[str]
    codewords: np.ndarray  # languages x bits, +1/-1
    weights: np.ndarray  # bits x buckets
    bias: np.ndarray  # bits
    trust: np.ndarray  # languages x bits


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords: of many random +-1 matrices the one with the largest least distance
    between rows, then with the fewest equal or constant columns."""
    bits = max(15, 10 * int(np.ceil(np.log2(max(n, 2)))))
    rng, best, found = np.random.default_rng(seed), None, (-1, 0)
    for _ in range(400):
        m = rng.choice([-1, 1], (n, bits))
        d = (bits - m @ m.T) // 2
        least = int(d[np.triu_indices(n, 1)].min()) if n > 1 else bits
        plain = int((np.abs(m.sum(0)) == n).sum()) if n > 1 else 0
        if (least, -plain) > found:
            best, found = m, (least, -plain)
    return best


def vector(text: str) -> np.ndarray:
    """Square roots of the bucket counts, scaled to length 1."""
    x = np.zeros(1 << BITS, np.float32)
    for codes in features.word_codes(text or ""):
        digit = (codes >= 48) & (codes <= 57)
        codes = codes[~digit]
        for n in (2, 3):
            x += np.bincount(features.ngram_buckets(codes, n, BITS, False), minlength=1 << BITS)
    x = np.sqrt(x)
    return x / max(float(np.linalg.norm(x)), 1e-9)


def fit(rows: list[tuple[str, str]], steps: int = 150, rate: float = 0.5, decay: float = 1e-5) -> CodedClassifier | None:
    """Fits the bit classifiers together by full-batch Adam; classes weigh the same."""
    rows = [(t, str(y)) for t, y in rows if features.LETTER.search(t)]
    if not rows:
        return None
    langs = sorted({y for _, y in rows})
    x = np.stack([vector(t) for t, _ in rows])
    y = np.array([langs.index(lang) for _, lang in rows])
    code = codewords(len(langs))
    target = code[y].astype(np.float32)
    row_w = (1 / np.bincount(y, minlength=len(langs)))[y].astype(np.float32)
    row_w /= row_w.sum()
    w, b = np.zeros((code.shape[1], x.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, vw, mb, vb = (np.zeros_like(a) for a in (w, w, b, b))
    for k in range(1, steps + 1):
        g = -target / (1 + np.exp(np.clip(target * (x @ w.T + b), -30, 30))) * row_w[:, None]
        for p, m, v, d in ((w, mw, vw, g.T @ x + decay * w), (b, mb, vb, g.sum(0))):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    right = (np.sign(x @ w.T + b) == target)
    trust = np.stack([right[y == i].mean(0) for i in range(len(langs))]) + 1e-3
    return CodedClassifier(langs, code, w, b, trust / trust.sum(1, keepdims=True))


def decode(model: CodedClassifier, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index, score (softmax of the negative weighted losses) and margin per row of bit outputs."""
    loss = np.stack([
        (model.trust[i] * np.log1p(np.exp(np.clip(-model.codewords[i] * z, -30, 30)))).sum(1)
        for i in range(len(model.languages))], 1)
    e = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
    p = e / e.sum(1, keepdims=True)
    ranked = np.sort(p, 1)
    margin = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0)
    return loss.argmin(1), p.max(1), margin


def predict(text: Column, model: CodedClassifier | None) -> Column:
    """Struct (lang, score, ambiguous) of a text column."""

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang = np.full(len(texts), "und", object)
            score, unsure = np.zeros(len(texts)), np.ones(len(texts), bool)
            known = [i for i, t in enumerate(texts) if t and features.LETTER.search(t)] if model else []
            for at in range(0, len(known), 256):
                part = known[at:at + 256]
                z = np.stack([vector(texts.iat[i]) for i in part]) @ model.weights.T + model.bias
                best, p, margin = decode(model, z)
                lang[part], score[part], unsure[part] = [model.languages[i] for i in best], p, margin < AMBIGUOUS_MARGIN
            yield pd.DataFrame({"lang": lang, "score": score, "ambiguous": unsure})

    return judge(text)


def identify(docs: DataFrame, model: CodedClassifier | None, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, lang_pred, score, ambiguous."""
    return docs.select(F.col(id_col), predict(F.col("text").cast("string"), model).alias("__p")).select(
        id_col, F.col("__p.lang").alias("lang_pred"), F.col("__p.score").alias("score"), F.col("__p.ambiguous").alias("ambiguous"))


def fit_on(docs: DataFrame, max_rows: int = MAX_ROWS) -> CodedClassifier | None:
    """Fits on text and non-null lang of documents outside the held-out fold."""
    labels = docs.select("doc_id", F.col("lang").alias("__lang"))
    return fit(features.labelled_sample(docs, labels, "__lang", FOLDS, HELD_OUT, max_rows))
