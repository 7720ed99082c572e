"""URL rules, exact top-k and packing against brute force."""

import zlib

import numpy as np
import pytest

from wxstar.llm import packing, queries, topk, url_filter
from wxstar.llm.common import table

SF = "/root/testdata/sf0.001"


# --- urls -----------------------------------------------------------------------------------


def slow_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, action in rules:
        h, _, p = rule.partition("/")
        p = rule[len(h):]
        if host and (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[0])):
            best = (rule, action)
    return (host, path, best and best[0], best[1] if best else default)


ODD_URLS = [
    None, "", "no scheme", "http://", "http://Example.NET/en/x", "https://a.example.net/en", "http://notexample.net/en/1", "http://x.org/fr/?q=1#z",
    "http://x.org/fr", "http://net/", "http://net", "http://a.net?x=/en/", "ftp://a.com://b/de/", "http://example.com/de/\nx", "http://example.com/DE/",
    "http://.net/", "http://a..net/x", "http://ÉX.net/", "http://example.net./en/", "x" * 5000 + "://a.net/" + "y" * 5000,
]


@pytest.mark.parametrize("most", [100, 0])
def test_urls_against_brute_force(spark, most):
    rules = url_filter.CONTRACT_RULES + [("a.com:/", "block"), ("x.org", "block"), ("b/de", "block"), ("ÉX.net/", "allow")]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(ODD_URLS)], "page_id int, url string, rule string")
    df = spark.createDataFrame(rules + [(None, "block"), ("", "block"), ("x.org", "allow")], "rule string, action string")
    got = {r[0]: tuple(r)[1:] for r in url_filter.judge(pages, df, max_rules=most).collect()}
    assert got == {i: slow_verdict(u, [("É".join(r.split("É")), a) for r, a in rules]) for i, u in enumerate(ODD_URLS)}


def test_url_query(spark):
    urls = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    got = {r[0]: tuple(r)[1:] for r in queries.op1_url_filter(spark, SF).collect()}
    assert got == {i: slow_verdict(u, url_filter.CONTRACT_RULES) for i, u in urls.items()}


def test_no_rules_and_no_pages(spark):
    none = url_filter.contract_rules(spark).limit(0)
    pages = table(spark, SF, "pages")
    assert url_filter.judge(pages, none, default="block").where("verdict <> 'block' or rule is not null").count() == 0
    assert url_filter.judge(pages.limit(0), url_filter.contract_rules(spark)).count() == 0


def test_digest_collisions_are_confirmed(spark):
    rules = url_filter.DigestArray.__new__(url_filter.DigestArray)
    import xxhash

    key = xxhash.xxh64_intdigest(b"b/")
    text = b"a/b/"
    rules.keys, rules.ends = np.array([key, key], np.uint64), np.array([0, 2, 4])
    rules.strings = np.frombuffer(text, np.uint8)
    assert rules.probe([b"b/", b"c/"]).tolist() == [1, -1]


# --- top-k ----------------------------------------------------------------------------------


def slow_top(rows, queries_, k):
    out = set()
    for q, c in queries_:
        near = sorted((int(c ^ d).bit_count(), i) for i, d in rows)[:k]
        out |= {(q, n + 1, i, dist) for n, (dist, i) in enumerate(near)}
    return out


def test_top_k_with_ties_and_hot_codes(spark):
    rng = np.random.default_rng(3)
    codes = [int(x) for x in rng.integers(0, 1 << 62, 300)]
    codes += [codes[0]] * 150 + [codes[1] ^ 1 << int(b) for b in rng.integers(0, 60, 40)]
    rows = list(enumerate(codes))
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    asked = df.where("id % 20 = 0 or id in (0, 1)")
    got = {tuple(r) for r in topk.top_k(df, asked, 7).collect()}
    assert got == slow_top(rows, [r for r in rows if r[0] % 20 == 0 or r[0] < 2], 7)


def test_fewer_rows_than_k_and_odd_vectors(spark):
    good = [float(i % 3 - 1) for i in range(64)]
    rows = [(0, good), (20, [-x for x in good]), (21, good), (40, None), (None, good), (60, [1.0] * 5), (80, [float("nan")] * 63 + [None]), (20, [-x for x in good])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, code string")
    got = topk.search(df, k=10).collect()
    assert {r.query_id for r in got} == {0, 20, 80}
    assert sorted(r.neighbor_id for r in got if r.query_id == 0) == [0, 20, 21, 80]
    assert topk.search(df.limit(0)).count() == 0


def test_top_k_query(spark):
    rows = [(r.vec_id, sum(1 << i for i, x in enumerate(r.embedding) if x > 0)) for r in table(spark, SF, "embeddings").collect()]
    got = {tuple(r) for r in queries.op9_topk(spark, SF).select("query_id", "rank", "neighbor_id", "distance").collect()}
    assert got == slow_top(rows, [r for r in rows if r[0] % 20 == 0], 10)


# --- packing --------------------------------------------------------------------------------


def test_packing_query_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    got = queries.op6_packing(spark, SF).toPandas()
    for d, own in got.groupby("doc_id"):
        ids = tok.encode(texts[d], add_special_tokens=False).ids + [0]
        own = own.sort_values("piece")
        assert own.piece.tolist() == list(range(len(own)))
        assert own.start.tolist() == list(range(0, len(ids), 2048))
        for r in own.itertuples():
            part = ids[r.start:r.start + 2048]
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert set(got.doc_id) == set(texts)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 2


@pytest.mark.parametrize("text", [
    "", " ", "It's l'été — 12½ <|endoftext|> x", "a­b \x85c\xa0d", "İstanbul ΣΑΣ ﬁ 日本", "don't!!'s 'tis ªº µm", "ÀÉ" * 300, "x" * 9000, "\x00\x1f ok"])
def test_token_bytes_equal_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert packing.token_bytes(text, path) == np.array(want, "<u4").tobytes()


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 65), 30, False), rng.integers(1, 4000, 30))} | {64: 5000}
    made, total = {}, sum(n * c for n, c in histogram.items())
    uses, found = 0, packing.plan(histogram, 64, 60)
    for n, counts in found:
        assert sum(k * v for k, v in counts.items()) <= 64
        uses += n
        for k, v in counts.items():
            made[k] = made.get(k, 0) + n * v
    assert made == histogram
    bins, rooms = 0, {}  # first fit, longest first, by room
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        room = min((r for r in rooms if r >= n and rooms[r]), default=0)
        if room:
            rooms[room] -= 1
        else:
            bins, room = bins + 1, 64
        rooms[room - n] = rooms.get(room - n, 0) + 1
    assert -(-total // 64) <= uses <= bins


@pytest.mark.parametrize("seed", range(3))
def test_sequences_come_from_configurations(seed):
    """Lengths like those of documents: few pieces a length, so the program's own uses are fractions."""
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(6, 1, 1500).astype(int), 1, 2047)
    found = packing.plan(dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)))), 2048)
    total = found.solved + found.residual + found.fitted
    assert found.bound <= total <= found.bound + 1 and found.fitted <= 3 and found.value > 0
    assert sum(n for n, _ in found) == total


def test_knapsack_within_counts():
    value, counts = np.array([0, 0, 2.0, 3.5, 0, 0, 0, 0, 0]), np.array([0, 0, 2, 1, 0, 0, 0, 0, 0])
    assert packing.knapsack(value, 8, counts).tolist() == [0, 0, 2, 1, 0, 0, 0, 0, 0]


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    for text in ("Some words, it's  fine\n" * 40, "Ünï 日本 cafe\u0301 a b " * 40, "x" * 500 + " end of it", "a <|endoftext|> b " * 30):
        want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert packing.token_bytes(text, path) == np.array(want, "<u4").tobytes()


def test_knapsack_against_all_multisets():
    value = np.array([0, 0, 3.0, 0, 0, 8.1, 0, 11.0])
    c = packing.knapsack(value, 12)
    assert (c @ np.arange(8)) <= 12
    best = max(a * 3 + b * 8.1 + d * 11 for a in range(7) for b in range(3) for d in range(2) if 2 * a + 5 * b + 7 * d <= 12)
    assert abs(float(c @ value) - best) < 1e-9


def test_packing_odd_rows_and_sequences(spark, odd_docs, no_docs):
    got = packing.pack(odd_docs, queries.tokenizer_path(), size=64, with_ids=True)
    rows = got.collect()
    assert sum(r.piece == 0 for r in rows) == odd_docs.count()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(got).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(no_docs, queries.tokenizer_path()).count() == 0
