"""Winnowing and mixing: plans without Python, guarantees, brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from wxstar.llm import mixing, queries, winnowing
from wxstar.llm.common import table

SF = "/root/testdata/sf0.001"


def marks_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return {r[0]: [(m.hash, m.position) for m in r[1]] for r in winnowing.fingerprints(df).collect()}


def test_marks_are_window_minima(spark):
    text = " ".join(f"w{i % 23}" for i in range(90))
    units = text.split()
    df = spark.createDataFrame([(u,) for u in units], "u string").select(F.pmod(F.xxhash64("u"), F.lit(winnowing.PRIME)))
    x = dict(zip(units, [r[0] for r in df.collect()]))
    p, b = winnowing.PRIME, winnowing.BASE
    grams = []
    for i in range(len(units) - 4):
        a = [x[u] for u in units[i:i + 5]]
        four = ((a[0] * b + a[1]) % p * (b * b % p % (1 << 30)) + (a[2] * b + a[3]) % p) % p
        grams.append((four * b + a[4]) % p)
    want = []
    for s in range(len(grams) - 7):
        least = min(grams[s:s + 8])
        at = max(i for i in range(s, s + 8) if grams[i] == least)  # the rightmost of equals
        if (least, at) not in want:
            want.append((least, at))
    assert marks_of(spark, [text])[0] == want


def test_shared_run_guarantee(spark):
    rng = np.random.default_rng(0)
    run = [f"r{i}" for i in rng.integers(0, 999, winnowing.K + winnowing.WINDOW - 1)]
    a = [f"a{i}" for i in rng.integers(0, 999, 40)] + run
    b = run + [f"b{i}" for i in rng.integers(0, 999, 40)]
    m = marks_of(spark, [" ".join(a), " ".join(b)])
    assert {h for h, _ in m[0]} & {h for h, _ in m[1]}


def test_short_and_odd_texts(spark, odd_docs, no_docs):
    m = marks_of(spark, [None, "", " \n", "one", "one two three four", "a b c d e", "z" * 50_000])
    assert m[0] == m[1] == m[2] == [] and len(m[3]) == len(m[4]) == len(m[5]) == 1 and m[6]
    got = winnowing.compare_edited(odd_docs).toPandas()
    assert len(got) == odd_docs.count() and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert winnowing.compare_edited(no_docs).count() == 0
    one = winnowing.compare_edited(odd_docs.where("text = 'an unnamed text'")).first()
    assert one.edited_sha256 == hashlib.sha256(b"an unnaman unna").hexdigest()


def test_query_against_python(spark):
    docs = sorted((r[0], r[1] or "") for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in queries.op3_winnowing(spark, SF).collect()}
    texts = [t for _, t in docs]
    edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, texts[1:] + texts[:1])]
    marks = marks_of(spark, texts + edited)
    hashes = {i: {h for h, _ in m} for i, m in marks.items()}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    n = len(docs)
    for i, (d, t) in enumerate(docs):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited[i].encode()).hexdigest())
        assert abs(r.near_edited - like(hashes[i], hashes[n + i])) < 1e-12
        assert abs(r.near_next - like(hashes[i], hashes[(i + 1) % n])) < 1e-12
    by_text = {}
    for d, t in docs:
        assert by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint


def test_no_python_in_the_plans(spark):
    for q in (queries.op3_winnowing, queries.op4_mixing):
        plan = plan_text(q(spark, SF))
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "BatchEval"))


# --- mixing -------------------------------------------------------------------------------


def shares(got):
    p, tokens = np.stack(got.posteriors), got.tokens.to_numpy().astype(float)
    return p, tokens, (p * (tokens * got.rate.to_numpy())[:, None]).sum(0) / tokens.sum()


def test_expected_tokens_meet_targets_in_reach(spark):
    """Soft memberships bound what rates can do: these targets lie between the corpus's own shares and reachable ones."""
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    domains = mixing.label_domains(labels)
    names = sorted(mixing.TARGETS)
    wanted = dict(zip(names, (0.10, 0.014, 0.816, 0.07)))
    got = mixing.rates(docs, domains, wanted).toPandas()
    p, tokens, share = shares(got)
    assert np.allclose(p.sum(1), 1) and (got.rate >= 0).all()
    assert np.allclose(share, [wanted[d] for d in names], atol=1e-3)
    assert (np.abs(got.copies - got.rate) < 1).all()
    assert abs((got.copies * got.tokens).sum() / tokens.sum() - 1) < 0.15


def test_targets_out_of_reach_are_neared_and_told(spark):
    with pytest.warns(UserWarning, match="miss the targets"):
        got = queries.op4_mixing(spark, "/root/testdata/sf0.01").toPandas()
    p, tokens, share = shares(got)
    target = np.array([mixing.TARGETS[d] for d in sorted(mixing.TARGETS)])
    rate, h = np.ones(len(p)), np.linalg.inv((p * tokens[:, None]).T @ p)
    for _ in range(300):
        rate = np.maximum(0, rate - p @ (h @ ((p * tokens[:, None]).T @ rate - target * tokens.sum())))
    least = np.abs((p * (tokens * rate)[:, None]).sum(0) / tokens.sum() - target).sum()
    assert np.abs(share - target).sum() <= least + 1e-3


def test_held_out_domains(spark):
    """Rows that taught nothing: their own domain gets well more than its share of all, and confidence is earned."""
    sf = "/root/testdata/sf0.1"
    docs, domains = table(spark, sf, "documents"), mixing.label_domains(table(spark, sf, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    made = mixing.fit_classifier(docs, domains.where(~held))
    rows = docs.where(held).select(F.col("doc_id").alias("__rid"), F.coalesce("text", F.lit("")).alias("__text"))
    got = mixing.posteriors(rows, made).join(domains.withColumnRenamed("doc_id", "__rid"), "__rid").toPandas()
    p = got[[f"p{i}" for i in range(len(made.names))]].to_numpy()
    own = np.array([made.names.index(d) for d in got.domain])
    for i, prior in enumerate(np.exp(made.priors)):
        assert p[own == i, i].mean() > min(4 * prior, 0.8), made.names[i]
    best = p.argmax(1)
    assert (best == own).mean() > 0.9 and abs(p.max(1).mean() - (best == own).mean()) < 0.05
    assert p[own == made.names.index("quality=1,toxic=1")].argmax(1).tolist().count(made.names.index("quality=1,toxic=1")) > 0.6 * (
        own == made.names.index("quality=1,toxic=1")).sum()


def test_rates_equal_a_local_projected_gradient(spark):
    rng = np.random.default_rng(1)
    p, tokens = rng.dirichlet([0.4] * 3, 200), rng.integers(1, 500, 200)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(tokens, p))], "__rid bigint, tokens bigint, p0 double, p1 double, p2 double")
    target = np.array([0.55, 0.3, 0.15]) * tokens.sum()
    steps = mixing.fit_rates(df, target)
    got = np.array([r[0] for r in df.select(mixing.rate_column(steps, 3, 0.0)).collect()])
    rate = np.ones(200)
    for _ in steps:
        free = rate > 0
        h = (p[free] * tokens[free, None]).T @ p[free]
        rate = np.maximum(0, rate - p @ np.linalg.solve(h, (p * tokens[:, None]).T @ rate - target))
    assert np.allclose(got, rate, atol=1e-5)
    assert np.allclose((p * tokens[:, None]).T @ got, target, rtol=2e-2)


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, "a"), (6, "b"), (5, "b"), (None, "a"), (3, None)], "doc_id bigint, domain string")
    got = mixing.rates(odd_docs, labels, {"a": 0.5, "b": 0.5}).collect()
    assert len(got) == odd_docs.count()
    assert mixing.mix(odd_docs, labels, {"a": 1.0}).columns == odd_docs.columns
    kept = mixing.rates(odd_docs, labels, {"a": 0.9, "b": 0.1}, floor=1.0, cover=True).collect()
    assert all(r.rate >= 1 and r.copies >= 1 for r in kept)
    assert mixing.rates(no_docs, labels, {"a": 1.0}).count() == 0
    none = mixing.rates(odd_docs, labels.limit(0), {"a": 1.0}).collect()
    assert {r.rate for r in none} == {1.0} and len(none) == odd_docs.count()
