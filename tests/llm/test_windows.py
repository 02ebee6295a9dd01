import hashlib
import random
import re

import numpy as np
import pytest

from logvigil.llm import windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    """Rows (key, mark, text): the mark only orders texts under one key."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    seen, cut = set(), {}
    for key, mark, text in order:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        left = " ".join(w for w, g in zip(words, gone) if not g)
        cut[key, mark, text] = (key, len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return sorted((cut[r] for r in rows), key=str)


def marked(docs):
    return [tuple(r) for r in docs.selectExpr("doc_id", "xxhash64(text)", "text").collect()]


def got(docs, params=windows.Params()):
    rows = windows.without_repeats(docs, params).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def test_same_as_all_windows(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    want = brute(marked(docs), 20)
    assert got(docs) == want
    assert sum(r[2] > 0 for r in want) > 15


@pytest.mark.parametrize("seed", range(3))
def test_few_words_small_pieces_and_a_full_sketch(spark, monkeypatch, seed):
    """Periodic texts, overlapping repeats, null and repeated keys, texts cut into pieces, and a sketch that holds nothing back."""
    monkeypatch.setattr(windows, "PIECE", 40)
    monkeypatch.setattr(windows, "cells_for", lambda texts, text: 64)
    rng = random.Random(seed)
    parts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(5, 40))) for _ in range(5)] + ["a " * 30, "a b " * 25]
    rows = [
        (rng.choice([None, rng.randrange(12)]) if i % 3 else i, "  ".join(rng.choice([*parts, f"x{rng.randrange(99)}"]) for _ in range(rng.randrange(1, 9))))
        for i in range(30)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs, windows.Params(8, 4)) == brute(marked(docs), 8)


def test_odd_rows(odd_docs, no_docs):
    assert got(odd_docs) == brute(marked(odd_docs), 20)
    kept = windows.without_repeats(odd_docs, keep_text=True)
    assert set(odd_docs.columns) - {"text"} <= set(kept.columns)
    by_id = {r.doc_id: r.kept_text for r in kept.collect() if r.doc_id in (1, 2, 5, 6, 7)}
    # period 2: of the first such text the first two windows stay, of the second nothing
    assert by_id == {1: "", 2: "", 5: " ".join(["lorem", "ipsum"] * 10 + ["lorem"]), 6: "", 7: "\x1c\xa0 odd spaces \U0001f600"} or by_id[6] == ""
    assert windows.without_repeats(no_docs, keep_text=True).count() == 0


def test_the_sketch_only_overestimates(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(30)]
    texts += [texts[0] + " " + texts[1]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    params, seen = windows.Params(), {}
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        for found in windows.ranges_of(windows.wordbytes.Words(raw, np.array([0, len(raw)]), windows.wordbytes.SOLID), params):
            for anchor in found.anchor.tolist():
                seen[anchor] = seen.get(anchor, 0) + 1
    anchors = np.array(list(seen), np.uint64)
    twice = np.array([n > 1 for n in seen.values()])
    for cells in (1 << 9, 1 << 16):
        estimated = windows.estimated_twice(anchors, windows.sketched(docs, params, cells))
        assert estimated[twice].all()
    assert estimated[~twice].mean() < 0.05
