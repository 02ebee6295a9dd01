import random
import re

import numpy as np
import pytest

import corpus_pipeline
from logvigil.llm import graph, minhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_same_as_all_pairs(spark, corpus, width, percent):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    got = minhash.classed(docs, minhash.Params(width, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(corpus, width, percent)


def test_links_that_no_star_shows(spark, monkeypatch):
    """A chain of near copies: the first class of a bucket is not linked with most others."""
    monkeypatch.setattr(minhash, "X_BLOCK", 3)
    monkeypatch.setattr(minhash, "Y_BLOCK", 4)
    rng = random.Random(3)
    row, rows = [f"w{rng.randrange(10**6)}" for _ in range(100)], []
    for i in range(30):
        rows.append((i, " ".join(row)))
        row = list(row)
        for _ in range(2):
            row[rng.randrange(100)] = f"n{rng.randrange(10**6)}"
    rng.shuffle(rows)
    got = minhash.classed(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Params(3, 85)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(sorted(rows), 3, 85)


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    other = base[:300] + [f"v{rng.randrange(10**6)}" for _ in range(100)]
    docs = spark.createDataFrame([(0, " ".join(base)), (1, " ".join(other))], "doc_id long, text string")
    a, b = minhash.sketches(docs, minhash.Params(3, 85)).orderBy("doc_id").collect()
    pair = spark.createDataFrame([(a.low_bits, b.low_bits)], "low_a array<long>, low_b array<long>")
    value = pair.select(minhash.estimate().alias("e")).head().e
    x, y = shingles(" ".join(base), 3), shingles(" ".join(other), 3)
    assert abs(value - len(x & y) / len(x | y)) < 0.15


def test_bands_reach_the_threshold():
    for params in (minhash.Params(3, 85), minhash.Params(5, 80)):
        bands = minhash.MINIMA // params.rows
        assert (1 - (params.percent / 100) ** params.rows) ** bands <= minhash.MISS


def test_long_words_that_differ_far_apart(spark):
    """Two letters of a word without spaces change places 4,096 letters apart."""
    word = ["abcdefghij"[i % 10] for i in range(9000)]
    word[100], word[4196] = "x", "y"
    other = list(word)
    other[100], other[4196] = "y", "x"
    rows = spark.createDataFrame([(1, "".join(word)), (2, "".join(other)), (3, "".join(word))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.classed(rows).collect()} == {1: 1, 2: 2, 3: 1}


def test_odd_rows(odd_docs, no_docs):
    got = minhash.classed(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by_id[1] + by_id[2] + by_id[3]] == [1, 2, 3]
    assert {r.component_id for r in by_id[5] + by_id[6]} == {5}
    assert {r.component_id for r in by_id[None]} == {None}
    assert minhash.classed(no_docs).count() == 0
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 3, 4, 5, 7, 8, None, None]
    assert minhash.deduplicated(no_docs).count() == 0


def test_deduplicated_keeps_one_of_each_group(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    kept = {r.doc_id for r in minhash.deduplicated(docs).collect()}
    assert kept == {i for i, (_, c) in brute(corpus, 5, 80).items() if i == c}


def test_groups_do_not_depend_on_keys(spark):
    """A third of the rows without a key and a third under one key, with texts of their own but for one copy and one near copy."""
    rng = random.Random(6)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(60)]
    copies = [(None, rows[0][1]), (3, rows[1][1] + " end")]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    want = sorted(rows[:1] + copies[1:] + rows[2:], key=str)
    assert sorted(map(tuple, minhash.deduplicated(docs, one_per_key=False).collect()), key=str) == want
    kept = minhash.deduplicated(docs).collect()
    assert sum(r.doc_id is None for r in kept) == 20 and sum(r.doc_id == 7 for r in kept) == 1
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    assert sorted(map(tuple, stage(spark, docs, "").collect()), key=str) == want


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 6), (9, 9), (2, 1)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4} | {i: 100 for i in range(100, 161)} | {i: 200 for i in range(200, 260)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_set_digests_ignore_order_and_tell_sets_apart():
    texts = ["a b c d", "A B C D", "d c b a", "", "a", "a a"]
    digests = minhash.set_digests(*minhash.shingle_sets(texts, 3))
    assert digests[0] == digests[1] and digests[3] is None
    assert len(set(digests)) == 5
    assert np.array_equal(np.diff(minhash.shingle_sets(texts, 3)[1]), [2, 2, 2, 0, 1, 1])


def test_likely_members_of_blocks_that_span_batches(spark):
    """Against every pair, with batches that cut blocks."""
    from logvigil.llm.tables import small_batches

    rng = np.random.default_rng(5)
    params = minhash.Params()
    base = rng.integers(0, 1 << 62, (6, 8))
    bands = rng.integers(0, 50, (40, 25)) + np.arange(25) * 100
    classes = [(bytes([i]), bytes([int(rng.integers(0, 5))]), (base[i % 6] ^ (1 if i % 4 else 0)).tolist(), bands[i].tolist()) for i in range(40)]
    rows = [(int(b), 0, 0, side, n, c, low, own) for n, c, low, own in classes for b in own for side in ("x", "y")]
    blocks = spark.createDataFrame(rows, "bucket long, xb int, yb int, side string, node binary, comp binary, low_bits array<long>, bands array<long>")
    with small_batches(spark, 7):
        got = {(r.bucket, r.side, bytes(r.node)) for r in minhash.likely_members(blocks, params).collect()}
    want = set()
    for n, c, low, own in classes:
        for m, d, other, theirs in classes:
            shared = [a for a, b in zip(own, theirs) if a == b]
            differ = sum(bin((x ^ y) >> (4 * k) & 15).count("1") > 0 for x, y in zip(low, other) for k in range(16))
            estimate = ((1 - differ / minhash.MINIMA) - 2.0**-minhash.BITS) / (1 - 2.0**-minhash.BITS)
            if shared and c != d and estimate >= params.least_estimate:
                want |= {(shared[0], "x", n), (shared[0], "y", m)}
    assert got == want and want
