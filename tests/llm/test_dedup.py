"""SimHash near-dedup, components and passage dedup against brute force."""

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from wxstar.llm import components, queries, simhash, substring_dedup as sub
from wxstar.llm.common import table

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def slow_components(fps):
    """{index: least index reachable} over links of 2 bits or fewer."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_query_against_brute_force(spark):
    docs = sorted(table(spark, SF, "documents").select("doc_id", "text").collect())
    fps = [slow_fingerprint(t) for _, t in docs]
    want = {(d[0], f"{f:016x}", docs[r][0]) for d, f, r in zip(docs, fps, slow_components(fps))}
    assert {tuple(r) for r in queries.op8_simhash(spark, SF).collect()} == want


@pytest.mark.parametrize("text", ["", None, "One", "One two", "ÉCOLE Été x", "a b\x0bc\x1cd\x85e f g", "w " * 500, "A b A b A b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(map(str, range(300)))
    monkeypatch.setattr(simhash, "BATCH", 7)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def planted_fps(n=300, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    near = [b ^ np.uint64((1 << int(rng.integers(64))) | (1 << int(rng.integers(64)))) for b in base[:200] for _ in range(3)]
    return np.unique(np.concatenate([base, np.array(near, np.uint64)]))


def test_tree_finds_every_link():
    fps = planted_fps()
    label = np.arange(len(fps))
    a, b = simhash.tree_links(fps, np.zeros(len(fps), np.int64), 2)
    at = {int(f): i for i, f in enumerate(fps)}
    simhash._unite(label, np.array([at[int(x)] for x in a]), np.array([at[int(x)] for x in b]))
    assert label.tolist() == slow_components([int(f) for f in fps])


def test_tree_work_in_small_pieces(monkeypatch):
    fps = planted_fps(80)
    whole = simhash.tree_links(fps, np.zeros(len(fps), np.int64), 2)
    monkeypatch.setattr(simhash, "BATCH", 64)
    assert {*map(int, simhash.tree_links(fps, np.zeros(len(fps), np.int64), 2)[0])} == {*map(int, whole[0])}


@pytest.mark.parametrize("most", [2, 20_000])
def test_links_when_groups_are_dealt_again(spark, most):
    rng = np.random.default_rng(9)
    top = np.uint64(0xABCDE) << np.uint64(44)  # a third of the rows agree on their upper bits
    fps = np.unique(np.concatenate([planted_fps(60), top | rng.integers(0, 1 << 44, 60, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp bigint")
    found = simhash.fingerprint_links(df, 2, most).collect()
    at, label = {int(f): i for i, f in enumerate(fps.view(np.int64))}, np.arange(len(fps))
    if found:
        simhash._unite(label, np.array([at[r[0]] for r in found]), np.array([at[r[1]] for r in found]))
    assert label.tolist() == slow_components([int(f) for f in fps])


def test_gray_rank_neighbours_differ_in_one_bit():
    gray = np.array([i ^ i >> 1 for i in range(256)], np.uint64)
    assert simhash.gray_rank(gray).tolist() == list(range(256))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = {r[0]: r[1] for r in components.connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = {r.component_id for r in got if r.fp == 0}
    assert zero == {2}  # null, empty and blank texts link; the least id that is not null
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.where("text = 'a plain text of a few words'").count() == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    assert sub.remove_repeats(odd_docs).exceptAll(odd_docs).count() == 0
    assert sub.repeats(no_docs).count() == 0


# --- passages -----------------------------------------------------------------------------


def words(rng, n):
    return [f"w{i}" for i in rng.integers(0, 5000, n)]


def test_windows_are_all_minhash_groups():
    rng = np.random.default_rng(4)
    for n, width in ((60, 7), (200, 16), (9, 9), (8, 9)):
        h = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        left, centre, right = sub.compact_windows(h, width)
        cells = {}
        for a, c, b in zip(left, centre, right):
            for i in range(a, c + 1):
                for j in range(max(c, i + width - 1), b + 1):
                    assert (i, j) not in cells
                    cells[i, j] = c
        assert cells == {(i, j): i + int(h[i:j + 1].argmin()) for i in range(n) for j in range(i + width - 1, n)}


def test_equal_values_in_windows():
    h = np.array([5, 9, 5, 9, 5, 9, 5, 9], np.uint64) << np.uint64(40)
    left, centre, right = sub.compact_windows(h, 3)
    assert len(centre) and all(h[c] == h.min() or b - a >= 2 for a, c, b in zip(left, centre, right))
    assert set(zip(left, centre, right)) == {(0, 0, 7)}
    assert len(sub.compact_windows(np.full(5000, 7 << 40, np.uint64), 46)[0]) == 1


def make_docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_planted_passages(spark):
    rng = np.random.default_rng(8)
    passage, other = words(rng, 70), words(rng, 120)
    near = list(other)
    near[60] = "changed"  # one word in 120: similarity 111/121
    far = [w if i % 8 else "changed" + w for i, w in enumerate(words(rng, 1) * 0 + passage)]  # every eighth word: no near-duplicate
    texts = [
        words(rng, 90) + passage + words(rng, 100), words(rng, 30) + passage + words(rng, 20), words(rng, 200), passage,
        words(rng, 40) + other, near + words(rng, 60), far, words(rng, 30) + passage[:40] + words(rng, 30),
    ]
    docs = make_docs(spark, [" ".join(t) for t in texts])
    got = {(r.doc_id, r.other_id): r for r in sub.repeats(docs).collect()}
    assert {(1, 0), (3, 0), (5, 4)} <= set(got) <= {(1, 0), (3, 0), (3, 1), (5, 4)}
    r = got[1, 0]
    assert (r.start_word, r.end_word, r.other_start, r.other_end, r.similarity) == (30, 100, 90, 160, 1.0)
    assert (got[5, 4].start_word, got[5, 4].end_word) == (0, 120) and 0.8 <= got[5, 4].similarity < 1
    left = {r.doc_id: r.text for r in sub.remove_repeats(docs).collect()}
    assert set(left) == {0, 1, 2, 4, 5, 6, 7}  # 3 was nothing but the passage
    assert left[1].split() == texts[1][:30] + texts[1][100:] and left[0] == " ".join(texts[0])
    assert left[5].split() == texts[5][120:]


@pytest.mark.parametrize("n", [50, 60, 70, 80, 90])
def test_one_edit_in_a_short_passage(n):
    for seed, at in enumerate((3, n // 3, n // 2, n - 4)):
        rng = np.random.default_rng(n + seed)
        passage = [f"p{i}" for i in range(n)]
        edited = passage[:at] + ["changed"] + passage[at + 1:]
        a = sub.shingle_hashes(" ".join(words(rng, 200) + edited + words(rng, 200)))
        b = sub.shingle_hashes(" ".join(words(rng, 100) + passage + words(rng, 200)))
        got = sub.verified(a, b, [(150, 300 + n, -100, -100)], 46, 0.8)
        assert len(got) == 1 and got[0][4] >= 0.8
        assert 195 <= got[0][0] <= 205 and got[0][1] <= 200 + n and got[0][1] - got[0][0] >= 46


def test_inserted_words_count_on_one_side():
    rng = np.random.default_rng(5)
    passage, extra = words(rng, 80), words(rng, 8)
    a = sub.shingle_hashes(" ".join(words(rng, 60) + passage[:40] + extra + passage[40:] + words(rng, 60)))
    b = sub.shingle_hashes(" ".join(words(rng, 60) + passage + words(rng, 60)))
    assert [x[:4] for x in sub.verified(a, b, [(30, 170, -8, 0)], 46, 0.8)] == [(60, 144, 60, 136)]


def test_too_short_or_too_different_passages_fail():
    rng = np.random.default_rng(6)
    for n, step in ((41, 99), (44, 99), (80, 16)):
        passage = words(rng, n)
        near = [w if i % step != step - 1 else "changed" for i, w in enumerate(passage)]
        a = sub.shingle_hashes(" ".join(words(rng, 90) + near + words(rng, 90)))
        b = sub.shingle_hashes(" ".join(words(rng, 90) + passage + words(rng, 90)))
        assert sub.verified(a, b, [(40, 130 + n, 0, 0)], 46, 0.8) == []


@pytest.mark.parametrize("near", [0, 440])
def test_earlier_document_holds_part_of_the_passage_twice(near):
    rng = np.random.default_rng(11)
    passage, between = words(rng, 90), words(rng, 500 - 30 - near)
    line = passage[20:50]
    texts = [words(rng, near) + line + between + passage + words(rng, 80), words(rng, 150) + passage + words(rng, 100)]
    b, a = (sub.shingle_hashes(" ".join(x)) for x in texts)
    # a window centred in the line is linked to the line's first copy, the others to the passage
    first, second = near - 170, 500 - 150
    found = np.array([(0, 140, 110, first), (1, 150, 86, second), (2, 145, 92, second), (3, 160, 76, first)])
    got = sub.verified(a, b, sub.agreed_stretches(found, 2), 46, 0.8)
    assert [x[:4] for x in got] == [(150, 236, 500, 586)] and got[0][4] == 1


def test_clusters_of_shifts():
    found = np.array([(0, 10, 80, 5), (1, 12, 80, 7), (2, 10, 90, 400)])
    assert sub.agreed_stretches(found, 2) == [(10, 92, 5, 400), (10, 92, 5, 7), (10, 92, 400, 400), (10, 90, 5, 5), (12, 92, 7, 7)]
    assert sub.agreed_stretches(found[:1].repeat(2, 0) + [[0, 0, 0, 0], [1, 0, 0, 0]], 2) == [(10, 90, 5, 5)]


def test_one_sure_link_is_enough():
    whole = (0, sub._END, 7, 7)
    assert sub.agreed_stretches(np.array([(sub.SURE, 3, 50, 7)]), 2) == [whole, (3, 53, 7, 7)]
    assert sub.agreed_stretches(np.array([(sub.SURE, 3, 50, 7), (1, 90, 50, 7)]), 2) == [whole, (3, 53, 7, 7)]
    assert sub.agreed_stretches(np.array([(1, 3, 50, 7)]), 2) == []


def test_longest_segment():
    rng = np.random.default_rng(7)
    for _ in range(50):
        total = np.concatenate([[0], np.cumsum(np.where(rng.random(60) < 0.8, 1, -4))])
        a, b = sub.longest_segment(total)
        assert total[b] >= total[a] and b - a == max(j - i for i in range(61) for j in range(i, 61) if total[j] >= total[i])


def test_passage_shared_by_most_documents(spark, monkeypatch):
    rng = np.random.default_rng(2)
    passage = words(rng, 80)
    docs = make_docs(spark, [" ".join(words(rng, 20) + (passage if i % 3 else []) + words(rng, 20)) for i in range(300)])
    got = sub.repeats(docs).collect()
    assert {r.doc_id for r in got} == {i for i in range(300) if i % 3} - {1}
    assert len(got) < 4 * 300  # no all-pairs
    assert all(r.end_word - r.start_word >= 80 for r in got)


def linked_pairs(texts, flush=None):
    """Verified (later, earlier) of the texts, without Spark; ``flush`` rows are linked together."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([" ".join(t) for t in texts])], names=["__rid", "__text"])
    rows = sub._windows_of(batch, 46, 6)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    met, lead = {}, None
    for i in range(0, len(rows), flush or len(rows)):
        made, lead = sub._links(rows[i:i + (flush or len(rows))], lead, 46)
        for later, earlier, *link in made.tolist():
            met.setdefault((later, earlier), []).append(link)
    shingles = [sub.shingle_hashes(" ".join(t)) for t in texts]
    return {(a, b) for (a, b), found in met.items()
            if sub.verified(shingles[a], shingles[b], sub.agreed_stretches(np.array(found), 2), 46, 0.8)}


def test_links_when_the_lead_is_like_only_one_of_two():
    found = shared = 0
    for seed in range(20):
        rng = np.random.default_rng(seed)
        first = [f"{seed}p{i}" for i in range(60)]
        second = first[:15] + ["changed"] + first[16:]
        third = second[:45] + ["altered"] + second[46:]  # 0.8 like the second, not like the first
        found += (2, 1) in linked_pairs([words(rng, 50) + p + words(rng, 50) for p in (first, second, third)])
        line, rest = words(rng, 40), words(rng, 15)
        texts = [words(rng, 50) + line + words(rng, 50)] + [words(rng, 50) + line + rest + words(rng, 50) for _ in range(2)]
        shared += (2, 1) in linked_pairs(texts)
    assert found >= 19 and shared == 20


def test_every_two_windows_of_a_group_are_linked():
    rows = np.zeros((40, 6), np.int64)
    rows[:, 0], rows[:, 2], rows[:, 4] = 77 * 8, np.arange(40) // 2, (30 << 32) | 30
    rows[:, 3], rows[:, 5] = (np.arange(40) << 32) | np.arange(40), np.arange(40)  # no two with the same text beside the centre
    made = sub._links(rows, None, 46)[0]
    assert {(a, b) for a, b, *_ in made.tolist()} == {(a, b) for a in range(20) for b in range(a)} and len(made) == 4 * 190


def test_pairs_are_made_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    rows = np.zeros((300, 5), np.int64)
    rows[:, 0], rows[:, 2], rows[:, 3], rows[:, 4] = np.sort(rng.integers(0, 9, 300)), rng.integers(0, 90, 300), rng.integers(0, 99, 300) << 32, (40 << 32) | 9
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 0]))]
    whole = sub._links(rows, None, 46)[0]
    monkeypatch.setattr(sub, "PAIRS", 7)
    assert np.array_equal(sub._links(rows, None, 46)[0], whole)


def in_blocks(rows, near):
    """Links of the rows of hot keys, dealt and sorted."""
    order = np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))
    return [m for r, n in sub._cut(rows[order], [near[i] for i in order]) for m in sub._block_links(r, n, 46, 0.8)]


def dealt_hot(texts):
    """Rows and shingles of the texts' windows with every key hot."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([" ".join(t) for t in texts])], names=["__rid", "__text"])
    rows, places, flat = sub._located(batch, 46, 6)
    hot, sizes = np.unique(rows[:, 0], return_counts=True)
    parts = list(sub._dealt(rows, places, flat, hot, sizes, sub.least_shared(46, 0.8)[1]))
    return np.concatenate([p for p, _ in parts]), [x for _, n in parts for x in n.to_pylist()]


@pytest.mark.parametrize("block", [4096, 7])
def test_blocks_link_what_shares_enough_and_fold_copies(block, monkeypatch):
    monkeypatch.setattr(sub, "BLOCK", block)
    rng = np.random.default_rng(9)
    line, other = words(rng, 45), words(rng, 60)
    texts = [words(rng, int(rng.integers(20, 60))) + (line if i % 2 else line[:20]) + (other if i % 3 else other[:i % 7 * 8]) + words(rng, 50)
             for i in range(40)]
    rows, near = dealt_hot(texts)
    sets = {}
    for r, n in zip(rows.tolist(), near):
        sets.setdefault(r[0], {})[r[2], r[3]] = set(np.frombuffer(n, np.uint32).tolist())
    least, pairs, made = sub.least_shared(46, 0.8)[0], 0, 0
    for key, group in sets.items():
        own = rows[:, 0] == key
        linked = {tuple(x) for m in in_blocks(rows[own], [n for n, o in zip(near, own) if o]) for x in m[:, :2].tolist()}
        made += len(linked)
        stands = {d: d for d, _ in group}
        for a, b in linked:
            top = stands[a], stands[b]
            stands = {d: min(top) if x in top else x for d, x in stands.items()}
        for (a, _), x in group.items():
            for (b, _), y in group.items():
                if b < a and len(x & y) >= least:
                    pairs += 1
                    assert stands[a] == stands[b]
    assert pairs > 100 and made < pairs


def test_near_copies_in_a_hot_group_are_all_linked(spark, monkeypatch):
    monkeypatch.setattr(sub, "SAMPLE", 1)
    monkeypatch.setattr(sub, "BLOCK", 20)
    rng = np.random.default_rng(12)
    passage, texts = words(rng, 110), []
    for i in range(24):  # each has a change of its own: two texts are 0.82 alike, none is a copy
        own = list(passage)
        own[5 + 4 * i] = f"changed{i}"
        texts.append(" ".join(words(rng, 30) + own + words(rng, 30)))
    rows = spark.createDataFrame(list(enumerate(texts)), "__rid bigint, __text string")
    got = {(r.later, r.earlier) for r in sub.repeated_passages(rows).select("later", "earlier").collect()}
    assert got == {(a, b) for a in range(24) for b in range(a)}


@pytest.mark.parametrize("hot", [False, True])
def test_links_between_members_of_different_classes(hot):
    found = 0
    for seed in range(5):  # the first is like the second, the third like the second alone, among others that have the middle
        rng = np.random.default_rng(seed)
        first = [f"{seed}p{i}" for i in range(60)]
        second = first[:15] + ["changed"] + first[16:]
        third = second[:45] + ["altered"] + second[46:]
        texts = [words(rng, 50) + p + words(rng, 50) for p in (first, *[words(rng, 9) + first[16:45] for _ in range(9)], second, third)]
        if hot:
            met = {}
            for made in in_blocks(*dealt_hot(texts)):
                for later, earlier, *link in made.tolist():
                    met.setdefault((later, earlier), []).append(link)
            a, b = (sub.shingle_hashes(" ".join(texts[i])) for i in (11, 10))
            found += bool((11, 10) in met and sub.verified(a, b, sub.agreed_stretches(np.array(met[11, 10]), 2), 46, 0.8))
        else:
            found += (11, 10) in linked_pairs(texts)
    assert found == 5


def test_rows_of_near_copies_grow_with_their_number(spark, monkeypatch):
    monkeypatch.setattr(sub, "SAMPLE", 1)
    rng = np.random.default_rng(12)
    passage, texts = words(rng, 110), []
    for i in range(48):  # any two are near-duplicates, none is a copy
        own = list(passage)
        own[5 + 2 * i] = f"changed{i}"
        texts.append(" ".join(words(rng, 30) + own + words(rng, 30)))
    got = sub.repeats(make_docs(spark, texts)).collect()
    assert len(got) < 10 * 48  # of 1,128 pairs
    root, covered = list(range(48)), [set() for _ in texts]
    for r in got:
        a, b = root[r.doc_id], root[r.other_id]
        root = [min(a, b) if x in (a, b) else x for x in root]
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert root == [0] * 48
    assert all(covered[i] >= set(range(30, 140)) for i in range(3, 48))  # the first ones may end at a change


def test_query_and_stage_make_every_link_of_a_hot_group(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sub, "SAMPLE", 1)
    rng = np.random.default_rng(12)
    passage, texts = words(rng, 110), []
    for i in range(24):  # each has a change of its own: two texts are 0.82 alike, none is a copy
        own = list(passage)
        own[5 + 4 * i] = f"changed{i}"
        texts.append(" ".join(words(rng, 30) + own + words(rng, 30)))
    make_docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_substring_dedup(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(a, b) for a in range(24) for b in range(a)}
    left = {r.doc_id: r.text for r in sub.remove_repeats(table(spark, str(tmp_path), "documents")).collect()}
    for i, text in enumerate(texts):
        assert left[i] == sub.without_words(text, [(r.start_word, r.end_word) for r in got if r.doc_id == i])


def test_spanning_links_keep_the_only_like_one():
    found = 0
    for seed in range(5):  # as above: the third is like the second alone
        rng = np.random.default_rng(seed)
        first = [f"{seed}p{i}" for i in range(60)]
        second = first[:15] + ["changed"] + first[16:]
        third = second[:45] + ["altered"] + second[46:]
        texts = [words(rng, 50) + p + words(rng, 50) for p in (first, *[words(rng, 9) + first[16:45] for _ in range(9)], second, third)]
        met, (rows, near) = {}, dealt_hot(texts)
        order = np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))
        for r, n in sub._cut(rows[order], [near[i] for i in order]):
            for later, earlier, *link in chain.from_iterable(m.tolist() for m in sub._block_links(r, n, 46, 0.8, False)):
                met.setdefault((later, earlier), []).append(link)
        a, b = (sub.shingle_hashes(" ".join(texts[i])) for i in (11, 10))
        found += bool((11, 10) in met and sub.verified(a, b, sub.agreed_stretches(np.array(met[11, 10]), 2), 46, 0.8))
    assert found == 5


def test_least_shared_shingles():
    assert sub.least_shared(46, 0.8) == (28, 68)
    rng = np.random.default_rng(1)
    least, around = sub.least_shared(46, 0.8)
    for _ in range(200):  # a stretch of 46 to 91 with the misses next to the centre
        n = int(rng.integers(46, 92))
        missed = int(0.2 * n + 1e-9)
        match = np.ones(n, bool)
        at = int(rng.integers(0, n - missed + 1))
        match[at:at + missed] = False
        centre = int(rng.choice(np.flatnonzero(match)))
        begin = int(rng.integers(max(0, centre - 45), min(centre, n - 46) + 1))
        assert match[begin:begin + 46].sum() >= least


@pytest.mark.parametrize("flush", [None, 300])
def test_hot_line_in_a_passage_of_two(flush):
    found = 0
    for seed in range(4):
        rng = np.random.default_rng(seed)
        line, rest = words(rng, 40), words(rng, 15)
        texts = [words(rng, 50) + line + words(rng, 50) for _ in range(90)]
        for i in (30, 89):
            texts[i] = words(rng, 50) + line + rest + words(rng, 50)
        found += (89, 30) in linked_pairs(texts, flush=flush)
        rows, near = dealt_hot(texts)
        assert (89, 30) in {(a, b) for made in in_blocks(rows, near) for a, b in made[:, :2].tolist()}
    assert found == 4


def test_kept_rows_link_like_one_flush():
    rng = np.random.default_rng(3)
    rows = np.zeros((400, 6), np.int64)
    rows[:, 0], rows[:, 2], rows[:, 4] = 77 * 8, np.sort(rng.integers(0, 200, 400)), (30 << 32) | 30
    rows[:, 3], rows[:, 5] = (rng.integers(0, 500, 400) << 32) | rng.integers(0, 9, 400), rng.integers(0, 9, 400)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2]))]
    held, parts = None, []
    for i in range(0, 400, 50):
        made, held = sub._links(rows[i:i + 50], held, 46)
        parts.append(made)
    assert np.array_equal(np.unique(np.concatenate(parts), axis=0), sub._links(rows, None, 46)[0])


def test_hot_numbers_of_a_sample(spark, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(sub, "SAMPLE", 1)
    passage = words(rng, 80)
    rows = spark.createDataFrame([(i, " ".join(words(rng, 20) + passage + words(rng, 20))) for i in range(80)], "__rid bigint, __text string")
    hot, sizes = sub.hot_numbers(rows, 46, 6)
    assert len(hot) and (np.diff(hot) > 0).all() and sizes.min() >= sub.HOT and sizes.max() >= 80
    assert sub.repeated_passages(rows).select("later").distinct().count() == 79


def test_texts_go_to_tiles_and_not_to_pairs(spark, monkeypatch):
    rng = np.random.default_rng(12)
    passage, texts = words(rng, 110), []
    for i in range(40):
        own = list(passage)
        own[5 + 2 * i] = f"changed{i}"
        texts.append(" ".join(words(rng, 30) + own + words(rng, 30 + i)))
    rows = spark.createDataFrame(list(enumerate(texts)), "__rid bigint, __text string")
    whole = sorted(map(tuple, sub.repeated_passages(rows).collect()))
    assert len(whole) >= 700  # of 780 pairs
    for tile in (64, 1 << 20):
        monkeypatch.setattr(sub, "TILE", tile)
        assert sorted(map(tuple, sub.repeated_passages(rows).collect())) == whole
        with monkeypatch.context() as m:
            m.setattr(sub, "_verify", lambda *a: ((lambda x: x), "tile bigint, kind int, rid bigint, data binary, stretches binary"))
            sent = sub.repeated_passages(rows).where("kind = 0")
            assert sent.count() == sent.distinct().count() < 780 // 2


def test_covered_words_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(sub, "TILE", 50)
    rng = np.random.default_rng(4)
    parts = [words(rng, 70) for _ in range(4)]
    texts = []
    for _ in range(60):  # edited, cut and repeated parts in any order
        text = words(rng, int(rng.integers(0, 30)))
        for k in rng.integers(0, 4, int(rng.integers(1, 5))).tolist():
            part = parts[k][:int(rng.integers(40, 71))]
            for at in rng.integers(0, len(part), int(rng.integers(0, 3))).tolist():
                part = part[:at] + ["edited"] + part[at + int(rng.integers(0, 2)):]
            text += part + words(rng, int(rng.integers(0, 9)))
        texts.append(" ".join(text))
    rows = spark.createDataFrame(list(enumerate(texts)), "__rid bigint, __text string")
    whole, covered = set(), set()
    for out, found in ((whole, sub.repeated_passages(rows)), (covered, sub.covered_words(rows))):
        for r in found.collect():
            out |= {(r.later, w) for w in range(r.start_word, r.end_word)}
    assert whole == covered and len(whole) > 3000


def test_reach_holds_every_segment_that_is_tried():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(46, 200))
        match = np.repeat(rng.random(n // 5 + 1) < rng.random(), 5)[:n] ^ (rng.random(n) < 0.1)
        reach, tried = sub.reach_of(match, 46, 0.8), []
        for a, b in ((0, n), (n // 4, n), (0, n - n // 4)):
            sub.near_segments(match[a:b], 46, 0.8, lambda s, e: tried.append((s + a, e + a)))
        assert all(reach[s:e].all() for s, e in tried)


def test_removing_words_keeps_the_rest():
    assert sub.without_words("a b\nc  d e", [(1, 3)]) == "a d e"
    assert sub.without_words("a b c", [(0, 2), (1, 3)]) == ""
    assert sub.without_words(" a b ", []) == " a b "
    assert sub.without_words("a b c d", [(2, 4), (0, 1)]) == "b "
