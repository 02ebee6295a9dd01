import hashlib
import random
import re
from collections import Counter

import pytest

from logvigil.llm import suffixes


def brute(rows, whole, least_words=0):
    seen = Counter(b[s : s + whole] for _, b in rows for s in range(len(b) - whole + 1))
    out = []
    for key, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - whole + 1):
            if seen[b[s : s + whole]] > 1:
                gone[s : s + whole] = b"\1" * whole
        for run in re.finditer(b"\1+", bytes(gone)):
            if len(re.findall(rb"[^\x20\x09-\x0D]+", b[run.start() : run.end()])) < least_words:
                gone[run.start() : run.end()] = bytes(run.end() - run.start())
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def cut(docs, depth=suffixes.Depth(), least_words=0):
    rows = suffixes.cleaned(docs, depth, least_words=least_words).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


def test_same_as_all_strings(spark, corpus):
    assert cut(spark.createDataFrame(corpus, "doc_id long, text string")) == brute([(i, t.encode()) for i, t in corpus], 400)


@pytest.mark.parametrize("seed", range(4))
def test_few_letters_and_small_pieces(spark, monkeypatch, seed):
    """Periodic and overlapping repeats, at another depth, with texts cut into pieces."""
    monkeypatch.setattr(suffixes, "PIECE", 200)
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(30, 90))) for _ in range(6)] + ["a" * 80, "ab" * 50]
    rows = [(i, "".join(rng.choice(parts + ["x%d" % rng.randrange(99)]) for _ in range(rng.randrange(1, 12)))) for i in range(25)]
    assert cut(spark.createDataFrame(rows, "doc_id long, text string"), suffixes.Depth(40, 10)) == brute([(i, t.encode()) for i, t in rows], 40)


@pytest.mark.parametrize("least_words", [1, 12, 25, 60, 91])
def test_short_passages_stay(spark, corpus, least_words):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    want = brute([(i, t.encode()) for i, t in corpus], 120, least_words)
    assert cut(docs, suffixes.Depth(120, 30), least_words) == want


def test_few_strings_are_spread(spark, monkeypatch):
    """A string is compared by itself only if it lies near the end of what two texts share."""
    rng, spread, real = random.Random(7), [], suffixes.written

    def counting(df, settings=None):
        table = real(df, settings)
        if {"pointer", "low"} <= set(table.columns):
            spread.append(table.count())
        return table

    monkeypatch.setattr(suffixes, "written", counting)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, passage = some(300), some(3000)
    rows = [(i, some(900) + line + some(900)) for i in range(20)]  # strings of 100 bytes in common, none of 400
    assert cut(spark.createDataFrame(rows, "doc_id long, text string")) == brute([(i, t.encode()) for i, t in rows], 400)
    assert spread.pop() == 0
    rows += [(20 + i, some(900) + passage[at:] + some(900)) for i, at in enumerate([0, 11, 200, 1500])]
    assert cut(spark.createDataFrame(rows, "doc_id long, text string")) == brute([(i, t.encode()) for i, t in rows], 400)
    assert 0 < spread.pop() <= 4 * 2 * 2 * 32  # two pieces at either end of four passages


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    assert cut(odd_docs) == brute(rows, 400)
    got = suffixes.cleaned(odd_docs, keep_text=True)
    assert set(odd_docs.columns) - {"text"} <= set(got.columns)
    assert {r.doc_id: r.kept_text for r in got.collect() if r.doc_id in (1, 2, 5, 7)} == {1: "", 2: "", 5: "", 7: " \x1c\xa0 odd spaces \U0001f600"}
    assert suffixes.cleaned(no_docs, keep_text=True).count() == 0


def test_least_in_windows():
    import numpy as np

    rng = np.random.default_rng(0)
    values = rng.integers(0, 1000, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 64, 199):
        assert suffixes.least_in_windows(values, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]
