import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logvigil.llm import ranked, wordbytes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    held = [(key, Counter(terms(text))) for key, text in rows]
    lengths = [sum(c.values()) for _, c in held]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (key, c), length in zip(held, lengths):
            if not length:
                continue
            m = 10 + (90 * length * n) // total
            weight = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def got(rows):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_DOCS": 7, "BLOCK_POSTINGS": 200, "CELLS": 30, "FIRST_PART": 4}, {"GROUP_ITEMS": 3, "MOST_TERMS": 0}])
def test_same_as_all_scores(spark, monkeypatch, corpus, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ranked, name, value)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    items = [(i, text[:400]) for i, text in corpus[::6]] + [(900, "w1 w2 nowhere"), (901, ""), (902, None)]
    found = ranked.top_documents(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == brute(corpus, items)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(None, "same row and no id"), (1, "SAME odd lorem"), (1, "ipsum row"), (2, "!!!")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked.top_documents(odd_docs, asked)) == brute(rows, items)
    assert ranked.top_documents(no_docs, asked).count() == 0
    assert ranked.top_documents(odd_docs, asked.limit(0)).count() == 0


def test_many_ties_and_fewer_places(spark):
    rows = [(i, "alpha beta" if i % 2 else "alpha gamma") for i in range(60)] + [(None, "alpha beta")]
    items = [(0, "alpha beta"), (1, "gamma")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, F.rand(1))
    for k in (1, 3, 200):
        assert got(ranked.top_documents(docs, spark.createDataFrame(items, "item_id long, text string"), k)) == brute(rows, items, k)


def test_reading_ends_early():
    """A short text that holds all rare terms settles the query before the long tail of a common term is read."""
    rng = random.Random(2)
    term = np.array([0, 1] + [2] * 20_000)
    impact = np.array([900_000, 800_000] + sorted((rng.randrange(1, 1000) for _ in range(20_000)), reverse=True))
    slot = np.array([5, 5] + [i % 2000 for i in range(20_000)])
    slot[2] = 5
    keep = np.unique(np.stack([term, slot]), axis=1, return_index=True)[1]
    keep = np.sort(keep)
    term, slot, impact = term[keep], slot[keep], impact[keep]
    queries = ranked.Queries(np.array([3]), np.array([0, 1, 2]), np.array([1000, 1000, 1]))
    query, doc, score, read = ranked.read_block(queries, 0, 1, 2000, term, slot, impact, np.zeros(1, np.int64), 1)
    assert (query.tolist(), doc.tolist(), score.tolist()) == ([0], [5], [int(impact[slot == 5].sum())])
    assert read < len(term)


def test_terms_are_counted_per_text():
    texts = ["a B b é", "", "b b-b 7"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    found = ranked.terms_of(raw, offsets)
    assert found.n.tolist() == [4, 0, 4] and np.bincount(found.text, minlength=3).tolist() == [3, 0, 2]
    assert sorted(found.tf[found.text == 2].tolist()) == [1, 3]
    assert wordbytes.LETTERS.sum() == 128 + 62
