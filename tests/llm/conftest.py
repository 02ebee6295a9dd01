import random

import pytest

CLASHING = ("node", "__node", "__row", "score", "kept", "slot", "shard", "mix_slot", "n_tokens", "ids", "t", "z", "mark", "key", "bucket", "label")


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text) with copies, near copies, shared passages, a long text and a short alphabet of words."""
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    base = words(rng, 150, 5000)
    for i in range(12):
        row = base.split()
        for _ in range(i % 5):
            row[rng.randrange(len(row))] = f"x{rng.randrange(999)}"
        texts.append(" ".join(row))
    passage = words(rng, 90, 9000)
    texts += [words(rng, 30) + " " + passage + " " + words(rng, 30) for _ in range(4)]
    texts += [texts[3]] * 5 + [texts[3].upper()] + ["é" * 450, "aé" * 400, "a", "", " \n", words(rng, 9000)]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    long_text = "lorem ipsum " * 9000
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "no id at all"), (None, None), (4, "same row"), (4, "same row"), (4, "other row, same id"),
            (5, long_text), (6, long_text), (7, " \x1c\xa0 odd spaces \U0001f600"), (8, "#" * 3000)]
    return spark.createDataFrame(
        [(*r, "en", None if i % 3 == 0 else "web", i, *["extra"] * len(CLASHING)) for i, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING),
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
