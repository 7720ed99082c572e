"""Mixing to target weights with soft domain membership, in DataFrame functions alone.

A labelled table teaches a naive Bayes classifier which domain a text
belongs to. A domain is a set of parts, separated by commas ("quality=1,toxic=0"); each part is learned from all domains that have it, so
a small domain leans on larger ones. Features are a text's distinct whole words, its distinct runs of other signs, its length
and its variety (hashed to ``BUCKETS``). A feature that a part's texts have more or less often than expected from the part's size, by
``DEVIATIONS`` or more, counts: its presence by the logarithm of the two frequencies, and the lack of it likewise; the others, which are
the many that all share, would only add noise. Features of one text are far from
independent: evidence is scaled by ``a * tokens ** -b``, what is absent by c, all three chosen for the least log loss on a fold of the labelled
rows that taught nothing. All of a text is read, however long it is. Then nonnegative document rates are fitted whose expected token
total of each domain meets its target: projected gradient steps on the least-squares
gap, measured in tokens (a document's step is weighed by its tokens, the gap by the inverse of sum tokens * p p^T over the
documents that are not at the least rate). A step needs the domains' totals alone: each iteration is one aggregate over all documents, and a document's rate is
recomputed from its posteriors and the short list of past steps. Nothing of the size of the corpus is
kept, sent or broadcast between iterations. Steps end at a gap of ``TOLERANCE``, or where they no longer make it smaller (targets out of
reach: then a warning tells the gap). Tokens are words here, whatever tokenizer follows.

Rates become whole copies: the integer part, and one more with the fraction's
probability, decided by a hash of the row's id.

Defined results: a null or blank text has no tokens, the prior as posterior and a rate like
any other. Null and unknown labels don't teach. A domain without a target has target 0; a target without a
labelled row is left out and the rest is scaled up; without any labelled row every rate is 1. Repeated rows and repeated or null ids are
rated each for itself. An empty table gives no rows. Columns other than id and text are carried, never read.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.llm.common import ID, TEXT, enveloped, materialize, text_or_empty, with_row_ids

BUCKETS = 1 << 18
MAX_ROWS = 20_000  # documented bound of the labelled sample
DEVIATIONS = 6  # standard deviations from its expected count that a word's count must lie to tell a domain
FOLDS = 5  # one labelled row in so many sets the scale of the evidence
SCALES = [(a, b, c) for a in (0.1, 0.25, 0.5, 1.0, 2.0, 4.0) for b in (0.0, 0.25, 0.5) for c in (0.0, 0.1, 0.2, 0.3, 0.5, 1.0)]
STALLED, TOLERANCE = 8, 1e-4  # steps without a gap smaller by a hundredth; share of the tokens
#: After the toxic documents have gone.
CLEAN_TARGETS = {"quality=1,toxic=0": 0.9, "quality=0,toxic=0": 0.1}
TARGETS = {"quality=1,toxic=0": 0.88, "quality=1,toxic=1": 0.03, "quality=0,toxic=0": 0.08, "quality=0,toxic=1": 0.01}


def label_domains(labels: DataFrame, id_col: str = ID) -> DataFrame:
    """(id, domain) from the labels table; rows with a null in either label teach nothing."""
    return labels.where("quality IS NOT NULL AND toxic IS NOT NULL").select(
        F.col(id_col).cast("bigint").alias(id_col), F.format_string("quality=%d,toxic=%d", "quality", "toxic").alias("domain"))


def words_of(text: str) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def features(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """A row for each feature of a text: its bucket ``__b``, the text's words as ``tokens``, and the columns to keep.

    Features are a text's distinct words and runs of other signs, the power of two of its length and the tenth of its words that
    are distinct; each counts once, as a word that a text repeats is no new evidence. Every text has the last two."""
    words, other = words_of(text), F.array_remove(F.split(text, r"[\p{L}\p{N}_\s]+"), "")
    made = df.select(*keep, words.alias("__words"), other.alias("__other"))
    sized = made.select(*keep, F.size("__words").cast("bigint").alias("tokens"), F.array_distinct("__words").alias("__words"), F.array_distinct("__other").alias("__other"))
    length = F.floor(F.log2(F.col("tokens") + 1)).cast("string")
    variety = F.round(F.size("__words") * 10 / F.greatest("tokens", F.lit(1))).cast("string")
    mark = lambda sign: lambda x: F.concat(F.lit(sign), x)
    every = F.concat("__words", F.transform("__other", mark("\t")), F.array(mark("\n#")(length), mark("\n%")(variety)))
    return sized.select(*keep, "tokens", F.explode(every).alias("__f")).select(
        *keep, "tokens", F.pmod(F.xxhash64("__f"), F.lit(BUCKETS)).cast("int").alias("__b"))


@dataclass
class Classifier:
    """``weights`` (__b, __w0, __w1, ...): what a feature says for each of the ``parts``; ``absent``: what the lack of all features
    says. A domain is a set of parts: ``members``, by part and domain."""

    names: list[str]
    priors: list[float]
    parts: list[str]
    members: list[list[bool]]
    weights: DataFrame
    absent: list[float]
    scale: tuple[float, float, float] = (1.0, 0.0, 1.0)

    def posteriors(self, scale: tuple[Column, Column, Column] | None = None) -> list[Column]:
        """Of each domain, from ``tokens`` and the evidence ``__w0``, ``__w1``, ..."""
        a, b, c = scale or [F.lit(float(x)) for x in self.scale]
        temper = a * F.pow(F.greatest(F.col("tokens"), F.lit(1)).cast("double"), -b)
        parts = [F.col(f"__w{j}") * temper + c * F.lit(self.absent[j]) for j in range(len(self.parts))]
        z = [sum((parts[j] for j in range(len(parts)) if self.members[j][i]), F.lit(prior)) for i, prior in enumerate(self.priors)]
        top = F.greatest(*z) if len(z) > 1 else z[0]
        e = [F.exp(x - top) for x in z]
        return [x / sum(e[1:], e[0]) for x in e]


def fit_classifier(docs: DataFrame, domains: DataFrame, max_rows: int = MAX_ROWS, id_col: str = ID) -> Classifier:
    """At most ``max_rows`` labelled ids (the smallest id hashes) are broadcast to the documents."""
    picked = domains.where(F.col(id_col).isNotNull() & F.col("domain").isNotNull()).orderBy(F.xxhash64(id_col), id_col, "domain").limit(max_rows)
    picked = picked.withColumn("__fold", F.pmod(F.xxhash64(id_col, F.lit("fold")), F.lit(FOLDS)))
    taught = materialize(docs.select(F.col(id_col).cast("bigint").alias(id_col), text_or_empty().alias("__text")).join(
        F.broadcast(picked), id_col).select("__text", "domain", "__fold"), "taught")
    texts = taught.where("__fold > 0")
    met = {r[0]: r[1] for r in texts.groupBy("domain").count().collect()}
    names, total = sorted(met), sum(met.values())
    parts = sorted({part for d in names for part in d.split(",")})
    members = [[part in d.split(",") for d in names] for part in parts]
    size = [sum(met[d] for i, d in enumerate(names) if members[j][i]) for j in range(len(parts))]
    count = lambda of: F.count(F.when(F.col("domain").isin(of), 1))
    counts = features(texts, "__text", "domain").groupBy("__b").agg(F.count(F.lit(1)).alias("__all"), *(
        count([d for i, d in enumerate(names) if members[j][i]]).alias(f"__c{j}") for j in range(len(parts))))

    def weighed(j: int) -> list[Column]:
        """What the presence of a feature says for part j, beside what its absence says; 0 where it tells nothing."""
        seen, share = F.col(f"__c{j}"), size[j] / total
        expected = F.col("__all") * F.lit(share)
        tells = F.abs(seen - expected) >= DEVIATIONS * F.sqrt(expected + 1)
        present, absent = F.log((seen + 1) / (expected + 1)), F.log((size[j] - seen + 1) / (size[j] - expected + 1))
        return [F.when(tells, x).otherwise(0.0).alias(n) for n, x in ((f"__w{j}", present - absent), (f"__o{j}", absent))]

    table = counts.select("__b", *(x for j in range(len(parts)) for x in weighed(j)))
    if parts:
        table = table.where(F.greatest(*(F.abs(f"__w{j}") for j in range(len(parts))), F.lit(0.0)) > 0)
    table = materialize(table, "bayes-weights")
    absent = list(table.agg(*(F.coalesce(F.sum(f"__o{j}"), F.lit(0.0)) for j in range(len(parts)))).first()) if parts else []
    made = Classifier(names, [float(np.log(met[d] / total)) for d in names], parts, members, table.drop(*(f"__o{j}" for j in range(len(parts)))), absent)
    if names:
        made.scale = _best_scale(taught.where("__fold = 0"), made)
    return made


def evidence(rows: DataFrame, made: Classifier, *keep: str) -> DataFrame:
    """(keep, tokens, __w0, __w1, ...) summed over a text's features; the weight table has ``BUCKETS`` rows at most, so it may
    be broadcast."""
    return features(rows, "__text", *keep).join(F.broadcast(made.weights), "__b", "left").groupBy(*keep, "tokens").agg(
        *(F.coalesce(F.sum(f"__w{j}"), F.lit(0.0)).alias(f"__w{j}") for j in range(len(made.parts))))


def _best_scale(held: DataFrame, made: Classifier) -> tuple[float, float, float]:
    """The scale with the least log loss on the held rows: each of them with each of ``SCALES``, in one aggregate."""
    rows = evidence(held.withColumn("__row", F.monotonically_increasing_id()), made, "__row", "domain").withColumn(
        "__s", F.explode(F.array(*(F.struct(*(F.lit(float(x)).alias(n) for n, x in zip("abc", s))) for s in SCALES)))).select("*", "__s.*")
    own = F.coalesce(*(F.when(F.col("domain") == d, p) for d, p in zip(made.names, made.posteriors((F.col("a"), F.col("b"), F.col("c"))))))
    losses = rows.groupBy("a", "b", "c").agg(F.sum(-F.log(F.greatest(own, F.lit(1e-12)))).alias("loss")).collect()
    return min(((round(r.loss, 6), r.a, r.b, r.c) for r in losses if r.loss is not None), default=(0, 1.0, 0.0, 1.0))[1:]


def posteriors(rows: DataFrame, made: Classifier) -> DataFrame:
    """(__rid, tokens, p0, p1, ...) from (__rid, __text)."""
    return evidence(rows, made, "__rid").select("__rid", "tokens", *(p.alias(f"p{i}") for i, p in enumerate(made.posteriors())))


def rate_column(steps: list[np.ndarray], n: int, floor: float) -> Column:
    """The rate after all steps: 1, then max(floor, rate - p . step) again and again."""
    if not steps:
        return F.lit(1.0)
    parts = [F.split(F.lit(",".join(repr(float(s[i])) for s in steps)), ",").cast("array<double>") for i in range(n)]

    def one(r, k):
        move = sum((F.col(f"p{i}") * F.element_at(parts[i], k) for i in range(1, n)), F.col("p0") * F.element_at(parts[0], k))
        return F.greatest(F.lit(float(floor)), r - move)

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(steps))), F.lit(1.0), one)


def fit_rates(table: DataFrame, target: np.ndarray, floor: float = 0.0) -> list[np.ndarray]:
    """Projected gradient steps, up to the one with the least gap. Each is one aggregate: the domains' totals, and the sum of
    tokens * p p^T over the rows above the floor, whose inverse scales the step (rows at the floor don't move, and
    scaling by them too would shorten steps for ever)."""
    n = len(target)
    cells = [(i, j) for i in range(n) for j in range(i, n)]
    steps: list[np.ndarray] = []
    best, least, since, whole = 0, np.inf, 0, None
    while True:
        r = rate_column(steps, n, floor)
        rated = table.select("tokens", *(f"p{i}" for i in range(n)), r.alias("__r"))
        free = F.when(F.col("__r") > floor, F.col("tokens"))
        sums = rated.agg(*(F.sum(F.col("tokens") * F.col(f"p{i}") * F.col("__r")) for i in range(n)), *(
            F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in cells)).first()
        gap = np.array([v or 0.0 for v in sums[:n]]) - target
        size = float(np.abs(gap).sum() / max(target.sum(), 1e-300))
        since = 0 if size < 0.99 * least else since + 1
        if size < least:
            best, least = len(steps), size
        if least <= TOLERANCE or since >= STALLED:
            break
        h = np.zeros((n, n))
        for (i, j), v in zip(cells, sums[n:]):
            h[i, j] = h[j, i] = v or 0.0
        if whole is None and not steps and floor >= 1:  # all rows start at the floor
            h = _gram(table, n)
        whole = h if whole is None else whole
        h = h if h.trace() > 1e-6 * whole.trace() else whole
        steps.append(np.linalg.pinv(h + np.eye(n) * 1e-9 * max(whole.trace(), 1e-300)) @ gap)
    if least > TOLERANCE:
        warnings.warn(f"token totals miss the targets by {least:.2%} of the tokens", stacklevel=2)
    return steps[:best]


def _gram(table: DataFrame, n: int) -> np.ndarray:
    """The sum of tokens * p p^T."""
    return np.array([v or 0.0 for v in table.agg(*(
        F.sum(F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in range(n) for j in range(n))).first()]).reshape(n, n)


def rates(
    docs: DataFrame, domains: DataFrame, weights: dict[str, float], floor: float = 0.0, cover: bool = False, id_col: str = ID,
    text_col: str = TEXT, rid: str | None = None,
) -> DataFrame:
    """(id, __rid, tokens, domain, posteriors, rate, copies) of every row.

    The total is the corpus's own; with ``cover`` it is the least at which no domain as a
    whole shrinks. ``floor`` is the least rate a document may get (1: each is kept). ``rid`` names
    a column with numbers of the rows, where there is one.
    """
    known = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_or_empty(text_col).alias("__text"), *(
        [F.col(rid).alias("__rid")] if rid else []))
    rows = known if rid else with_row_ids(known, id_col)
    made = fit_classifier(rows.withColumnRenamed("__text", TEXT), domains, id_col=id_col)
    names = made.names
    ids = rows.select("__rid", id_col)
    if not names:
        return rows.select(
            id_col, "__rid", F.size(words_of("__text")).cast("bigint").alias("tokens"),
            F.lit(None).cast("string").alias("domain"), F.array().cast("array<double>").alias("posteriors"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"))
    scored = materialize(posteriors(rows.select("__rid", "__text"), made), "posteriors")
    share = np.array([max(weights.get(d, 0.0), 0.0) for d in names])
    share = share / share.sum() if share.sum() else np.full(len(names), 1 / len(names))
    own = np.array([v or 0.0 for v in scored.agg(*(F.sum(F.col("tokens") * F.col(f"p{i}")) for i in range(len(names)))).first()])
    total = float((own[share > 0] / share[share > 0]).max()) if cover else float(own.sum())
    r = rate_column(fit_rates(scored, share * total, floor), len(names), floor)
    p = F.array(*(f"p{i}" for i in range(len(names))))
    best = F.element_at(F.array(*(F.lit(d) for d in names)), F.array_position(p, F.array_max(p)).cast("int"))
    chance = F.pmod(F.xxhash64("__rid", F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = scored.withColumn("rate", r).select(
        "__rid", "tokens", best.alias("domain"), p.alias("posteriors"), "rate",
        (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"))
    return rated.join(ids, "__rid").select(id_col, "__rid", "tokens", "domain", "posteriors", "rate", "copies")


def mix(docs: DataFrame, domains: DataFrame, weights: dict[str, float], floor: float = 0.0, cover: bool = False) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as its copies say."""
    rows = with_row_ids(enveloped(docs))
    copies = rates(rows, domains, weights, floor, cover, rid="__rid").select("__rid", "copies").where("copies > 0")
    return rows.join(copies, "__rid").select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__doc.*")
