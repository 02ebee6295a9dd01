import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from logvigil.llm import importance, wordbytes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def runs(text, longest):
    words = WORD.findall(lowered(text))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, p):
    bucket = lambda f: zlib.crc32(f.encode()) % p.buckets
    s, t = [0] * p.buckets, [0] * p.buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f in runs(text, p.longest)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + p.buckets) / ((s[b] + 1) * (sum(t) + p.buckets)))) for b in range(p.buckets)]
    out = []
    for key, text in rows:
        words, found = runs(text, p.longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{p.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(words), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= p.least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for rank, row in enumerate(able[: len(able) * p.percent // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=str)


def got(rows):
    return sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in rows.collect()), key=str)


@pytest.mark.parametrize("params", [importance.Params(), importance.Params(buckets=97, longest=2, least_words=1, percent=60, seed=7)])
def test_same_as_brute_force(spark, corpus, params):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    target = [text for _, text in corpus[30:45]]
    want = brute(corpus, target, params)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(importance.resampled(docs, wanted, params)) == want
    assert sum(r[5] is not None for r in want) > 1


def test_odd_rows(spark, odd_docs, no_docs):
    params = importance.Params(least_words=1, percent=70)
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], [None, "same row"], params)
    out = importance.resampled(odd_docs, spark.createDataFrame([(None,), ("same row",)], "text string"), params)
    assert got(out) == want
    assert set(odd_docs.columns) - {"text"} <= set(out.columns)
    assert importance.resampled(no_docs, no_docs).count() == 0
    empty = importance.resampled(odd_docs, no_docs, params).select("weight", "rank").collect()
    assert len(empty) == odd_docs.count() and any(r["rank"] == 1 for r in empty)


def test_select_the_kth_among_many_ties(spark):
    rows = [(i % 3, i % 5 or None, i) for i in range(300)]
    keys = spark.createDataFrame(rows, "a long, b long, c long")
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    for k in (1, 2, 150, 299, 300):
        last = importance.kth_row(keys, k, pivots=4)
        assert keys.where(F.struct("a", "b", "c") <= last).count() == k
        assert tuple(keys.where(F.struct("a", "b", "c") == last).first()) == order[k - 1]
    assert importance.kth_row(keys, 301, pivots=4) is None and importance.kth_row(keys, 0) is None


def test_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "SORT_ROWS", 10)
    values = random.Random(3).sample(range(10_000), 95)
    rows = importance.ranked(spark.createDataFrame([(v,) for v in values], "v long"), ["v"], 95).collect()
    assert [r["v"] for r in sorted(rows, key=lambda r: r["rank"])] == sorted(values)
    assert sorted(r["rank"] for r in rows) == list(range(1, 96))


def test_checksums_of_long_words():
    import numpy as np

    for first, second in ((1, 1), (63, 64), (64, 65), (500, 70), (3, 5000), (8192, 40_000)):
        a, b = b"a" * first, bytes(97 + i % 20 for i in range(second))
        crc = lambda x: np.array([zlib.crc32(x)], np.uint32)
        assert wordbytes.joined(wordbytes.spaced(crc(a)), crc(b), np.array([second]))[0] == zlib.crc32(a + b" " + b)
