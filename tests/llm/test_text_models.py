import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logvigil.llm import grams, linear, noise, pu, quality, samples
from logvigil.llm.catalog import QUERIES
from logvigil.llm.tables import crc_share

GOOD = [f"word{i}" for i in range(300)]
BAD = [f"JUNK{i}!!" for i in range(40)]
TOXIC = ["worthless", "moron", "idiot", "scum", "loser"]


def prose(rng, pool, n):
    return " ".join(rng.choice(pool) for _ in range(n))


@pytest.fixture(scope="module")
def judged():
    rng = random.Random(9)
    rows = []
    for i in range(400):
        good = i % 4 > 0
        rows.append((i, prose(rng, GOOD if good else BAD + GOOD[:50], rng.randrange(55, 200)), int(good)))
    return rows


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if found[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_base_counts():
    rng = random.Random(0)
    parts = ["a", "b", "ä", "😀", " ", "  ", "\n", "\t", "\r", "\xa0", "\x1c", "#", "$%", "|", "cd"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(80))) for _ in range(400)] + ["", " ", "a b c a b c", "x\n" * 500]
    assert np.array(quality.base_counts(texts)).T.tolist() == [brute_base(t) for t in texts]


def test_chunks_hold_every_text_once():
    texts = ["x" * n for n in (5, 0, 30, 2, 2, 2, 0)]
    ranges = list(grams.chunks(texts, 6))
    assert [i for low, high in ranges for i in range(low, high)] == list(range(7))
    assert list(grams.chunks([])) == []


def test_features_stay_inside_their_text():
    alone = [grams.features(grams.Chars([t])) for t in ("ab cd ef", "", "x", "cd ef ab")]
    together = grams.features(grams.Chars(["ab cd ef", "", "x", "cd ef ab"]))
    for f in (0, 1):
        at, bounds = together[f]
        for i, single in enumerate(alone):
            assert sorted(at[bounds[i] : bounds[i + 1]]) == sorted(single[f][0])


def test_quality_model_holds_out(spark, judged):
    docs = spark.createDataFrame([r[:2] for r in judged], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in judged], "doc_id long, quality int, toxic int")
    rows = crc_share("doc_id", 5) != 0
    truth = {i: q for i, _, q in judged}
    model = quality.quality_model(docs, labels, rows)
    got = quality.ruled(docs, model).collect()
    assert sum(r.kept != bool(truth[r.doc_id]) for r in got) <= 4
    model = quality.pu_model(docs, labels, rows)
    scored = quality.scored(docs, model).withColumn("held", ~rows).collect()
    held = [r for r in scored if r.held]
    assert len(held) > 50 and sum((r.score >= 0.3) != bool(truth[r.doc_id]) for r in held) <= len(held) * 0.1


def test_prior_is_near_the_share_of_positives():
    rng = random.Random(1)
    positive = [prose(rng, GOOD, 80) for _ in range(200)]
    unlabelled = [prose(rng, GOOD if i % 10 < 7 else BAD, 80) for i in range(300)]
    assert abs(pu.class_prior(positive, unlabelled) - 0.7) < 0.12


def test_prior_and_calibration_read_all_documents(spark, judged, monkeypatch):
    docs = spark.createDataFrame([r[:2] for r in judged] + [(None, judged[0][1]), (None, None)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in judged], "doc_id long, quality int, toxic int")
    read = []
    for name in ("prior_of", "calibrated"):
        inner = getattr(pu, name)
        monkeypatch.setattr(pu, name, lambda *args, inner=inner: read.append([a for a in args if isinstance(a, pu.Histogram)][0].counts.sum()) or inner(*args))
    assert quality.pu_model(docs, labels, most=60) is not None
    first_of_the_sample = 60
    assert read == [first_of_the_sample, len(judged) + 2, len(judged) + 2]


def shares(text):
    """Feature shares of one text, feature by feature, and a 1 for the bias."""
    row = np.zeros((2 << grams.FEATURE_BITS) + 1)
    for f, (at, _) in enumerate(grams.features(grams.Chars([text]))):
        for feature in at.tolist():
            row[(f << grams.FEATURE_BITS) + feature] += 1 / (len(at) + grams.SMOOTH)
    row[-1] = 1
    return row


@pytest.fixture(scope="module")
def small_model():
    return linear.logistic(["a b c good"] * 3 + ["x y z junk"] * 3, np.array([1, 1, 1, 0, 0, 0]), 20)


def test_gradient_over_the_corpus_is_the_sum_over_all_texts(spark, judged, small_model):
    texts = [t for _, t, _ in judged[:40]] + [None, "", "x"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    histogram, found = quality.over_corpus(docs, [small_model], {}, small_model)
    rows = np.stack([shares(t or "") for t in texts])
    margins = rows @ linear.stacked(small_model)
    assert found.risk == pytest.approx(np.logaddexp(0, margins).mean(), rel=1e-6)
    assert np.allclose(found.gradient, rows.T @ linear.sigmoid(margins) / len(texts), atol=1e-9)
    assert (histogram.counts == np.bincount(pu.Histogram.of(margins), minlength=pu.CELLS)).all()
    assert quality.over_corpus(docs, [small_model], {})[1] is None
    assert quality.over_corpus(docs.limit(0), [small_model], {}, small_model)[0].counts.sum() == 0


def test_risk_of_the_fit_is_the_brute_force_risk(monkeypatch, judged, small_model):
    """At the weights that the corpus's gradient was taken at, the fit goes down the risk over all texts, worked out one by one."""
    positive, sample, corpus = ([t for _, t, _ in judged[a:b]] for a, b in ((0, 8), (8, 20), (0, 60)))
    total, risk = pu.risk_sums(corpus, small_model)
    seen, w = {}, linear.stacked(small_model)

    def once(rows, slopes_of, more_of):
        margin = rows.margins(w[:-1]) + w[-1]
        slopes = slopes_of(margin, w)
        seen["g"] = np.append(rows.gradient(slopes), slopes.sum()) + more_of(margin, w)

    monkeypatch.setattr(linear, "descended", once)
    for prior in (0.1, 0.95):
        pu.fitted(positive, sample, prior, pu.Unlabelled(small_model, risk / len(corpus), total / len(corpus)))
        p, u = (np.stack([shares(t) for t in texts]) for texts in (positive, corpus))
        negative = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        gradient_u, gradient_p = linear.sigmoid(u @ w) @ u / len(u), linear.sigmoid(p @ w) @ p / len(p)
        want = gradient_u - prior * p.mean(0) if negative >= 0 else prior * gradient_p - gradient_u
        assert np.allclose(seen["g"], want, atol=1e-6)


def test_a_kind_that_the_sample_misses_moves_the_weights(judged):
    good = [t for _, t, q in judged if q][:60]
    rare = [prose(random.Random(i), [f"odd{k}" for k in range(30)], 80) for i in range(40)]
    plain = pu.fitted(good[:20], good[20:40], 0.9)
    total, risk = pu.risk_sums(good[20:60] + rare, plain)
    whole = pu.fitted(good[:20], good[20:40], 0.9, pu.Unlabelled(plain, risk / 80, total / 80))
    assert whole.margins(rare).max() < whole.margins(good[40:]).min()
    gap = lambda model: model.margins(good[40:]).mean() - model.margins(rare).mean()
    assert gap(whole) > gap(plain)


@pytest.mark.parametrize(("name", "label", "precision", "recall"), [("op9_quality_pu", "quality", 0.95, 0.95), ("op8_toxicity", "toxic", 0.85, 0.75)])
def test_held_out_labels(spark, name, label, precision, recall):
    """The registered query on rows whose labels it has not seen."""
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").where(F.col(label).isNotNull()).collect()}
    rows = [(r.predicted, truth[r.doc_id]) for r in QUERIES[name](spark, sf).where("held_out").collect() if r.doc_id in truth]
    both = sum(p and t for p, t in rows)
    assert len(rows) > 60 and both / max(1, sum(p for p, _ in rows)) >= precision and both / sum(t for _, t in rows) >= recall


@pytest.mark.parametrize("name", ["op8_toxicity", "op9_quality_pu", "op6_quality_rules"])
def test_queries_without_labels(spark, tmp_path, name):
    spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 2


def test_platt_recovers_a_logistic_curve():
    rng = np.random.default_rng(0)
    margin = rng.normal(0, 2, 20000)
    labels = (rng.random(20000) < linear.sigmoid(1.5 * margin - 0.5)).astype(int)
    slope, shift = linear.platt(margin, labels)
    assert abs(slope - 1.5) < 0.1 and abs(shift + 0.5) < 0.1


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    for model in (None, linear.logistic(["a b c"] * 3 + ["x y z"] * 3, np.array([1, 1, 1, 0, 0, 0]))):
        got = quality.ruled(odd_docs, model)
        assert dict(got.dtypes)["kept"] == "boolean" and got.columns.count("score") == 1
        rows = got.collect()
        assert len(rows) == odd_docs.count()
        assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
        assert all(0 <= r.score <= 1 for r in quality.scored(odd_docs, model).collect())
        assert quality.ruled(no_docs, model).count() == 0 and quality.scored(no_docs, model).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_model(odd_docs, no_labels) is None and quality.pu_model(odd_docs, no_labels) is None


def test_samples_are_bounded_and_the_same_every_time(spark):
    docs = spark.createDataFrame([(i % 50, f"t{i}") for i in range(200)] + [(None, "x"), (60, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(70)] + [(2, 1, None), (None, 1, None)], "doc_id long, quality int, toxic int")
    good = samples.labelled_texts(docs, labels, "quality", 1)
    assert len(good) == 25 and good == samples.labelled_texts(docs.repartition(7), labels, "quality", 1)
    assert "" in samples.labelled_texts(docs, labels, "quality", 0) and "t2" not in samples.labelled_texts(docs, labels, "quality", 0)
    assert len(samples.unlabelled_texts(docs, 10)) == 10


@pytest.fixture(scope="module")
def detector():
    rng = random.Random(2)
    clean = [prose(rng, GOOD + ["stress", "assess", "book", "committee"], 60) for _ in range(300)]
    toxic = [prose(rng, GOOD, 50) + " " + rng.choice(TOXIC) + " " + prose(rng, GOOD, 10) for _ in range(300)]
    counts = np.zeros(noise.SYMBOLS**3)
    s = noise.symbols(np.frombuffer("  ".join(clean).lower().encode("utf-32-le"), "<u4"))
    counts += np.bincount((s[:-2] * noise.SYMBOLS + s[1:-1]) * noise.SYMBOLS + s[2:], minlength=noise.SYMBOLS**3)
    return noise.learned(toxic, clean, counts)


@pytest.mark.parametrize(
    "text", ["m0r0n", "W0RTHL3SS", "an i d i o t here", "s.c.u.m", "$cum", "l-o-s-e-r", "mmmoron", "idiooot!", "1diot,", "w o r t h l e s s", "Moron"]
)
def test_disguises_are_seen_through(detector, text):
    assert detector.score(text) >= 0.7


@pytest.mark.parametrize(
    "text",
    ["!diot", "|oser", "(!diot!)", "\"|oser\",", "you !d!ot!!", "$(um $cum", "s c u m.", "(l o s e r)", "\"m, o, r, o, n!\"", "id i o t", "an id i o t to me",
     "m o ro n", "l o s er.", "! d i o t", "s . c . u . m"],
)
def test_signs_at_edges_and_pairs_of_letters_hide_nothing(detector, text):
    assert detector.score(text) >= 0.7


def test_the_decoded_path_is_the_best_of_all(detector):
    """Against every path through the lattice, one by one."""
    rng = random.Random(11)
    number = lambda c: int(noise.symbols(np.array([ord(c)], np.uint32))[0])

    def cost(path):
        total, a, b = sum(c for c, _ in path), noise.BLANK, noise.BLANK
        for _, letter in path:
            if letter:
                total, a, b = total + detector.log_p[a][b][number(letter)], b, number(letter)
        return total + detector.log_p[a][b][noise.BLANK]

    for _ in range(60):
        apart = rng.random() < 0.5
        stretch = "".join(rng.choice("ab10$3!. mm") for _ in range(rng.randrange(2, 8)))
        lattice = []
        for char, again in noise._runs(stretch):
            if char in noise.SIGNS and not (apart and char == "*"):
                lattice.append([(noise.SWAP, c) for c in noise.LEET[char]])
            elif char.isalpha():
                lattice.append([(0.0, char), (noise.DROP, "")] if again else [(0.0, char)])
            else:
                lattice.append([(noise.DROP, ""), (noise.KEEP_GAP, " ")] if apart else [(0.0, " ")])
        paths = list(itertools.product(*lattice))
        said = detector.restored(stretch, apart)
        mine = max(cost(p) for p in paths if "".join(letter for _, letter in p) == said)
        assert mine == pytest.approx(max(map(cost, paths)))


def test_tokens_of_signs_alone_are_decoded():
    rng = random.Random(3)
    clean = [prose(rng, GOOD, 60) for _ in range(100)]
    toxic = [prose(rng, GOOD, 50) + " " + rng.choice(["ass", "slit"]) for _ in range(100)]
    found = noise.learned(toxic, clean, np.ones(noise.SYMBOLS**3))
    assert min(map(found.score, ["455", "$117", "word 455.", "4 5 5"])) >= 0.7 > max(map(found.score, ["1999", "12:30", "$20", "000", "44 55", "*****"]))


@pytest.mark.parametrize("text", ["so it is a", "a 1 b 22 c", "1. 2. 3. 10.", "i, o, u", "!!! *** ###", "12345 $100", "#" * 30000, "*1" * 3000])
def test_clean_texts_with_signs_stay_clean(detector, text):
    assert detector.score(text) < 0.7


@pytest.mark.parametrize("text", ["", "word1 word2", "book committee stress", "a b c", "1 2 3 4", "2024-01-01", "c0ffee", "aaaaargh", "$$$ %%% !!!", "a" * 3000, "0" * 3000])
def test_clean_texts_stay_clean(detector, text):
    assert detector.score(text) < 0.7


def test_trigram_counts_cover_whole_texts(spark):
    docs = spark.createDataFrame([(1, "abab"), (2, None), (3, ""), (4, "AB" * 50000)], "doc_id long, text string")
    counts = noise.trigram_counts(docs).reshape(noise.SYMBOLS, noise.SYMBOLS, noise.SYMBOLS)
    assert counts[1, 2, 1] == 1 + 49999 and counts[2, 1, 2] == 1 + 49999 and counts[0, 1, 2] == 2


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, detector):
    for model in (None, detector):
        rows = noise.scored(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert noise.scored(no_docs, model).count() == 0
    assert noise.detector(odd_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None


def test_one_reading_gives_margins_and_risk(monkeypatch):
    """Features of a text are taken once for its margin and for the risk, and both are as if taken apart."""
    rng = np.random.default_rng(3)
    size = 1 << grams.FEATURE_BITS
    models = [linear.Linear(rng.normal(size=size), rng.normal(size=size), b) for b in (0.25, -1.0, 0.0)]
    texts = ["", "one two three", "ein Satz mit mehr Worten", "x", "one two three four five six " * 9]
    own = np.array([0, 1, 2, 1, 0])
    taken, plain = [], grams.features
    monkeypatch.setattr(grams, "features", lambda chars: taken.append(1) or plain(chars))
    margins, gradient, risk = pu.margins_and_risk(texts, pu.side_by_side(models), own, models[2])
    assert len(taken) == len(list(grams.chunks(texts)))
    assert margins == pytest.approx([models[k].margins([t])[0] for k, t in zip(own, texts, strict=True)], abs=1e-9)
    other = pu.risk_sums(texts, models[2])
    assert gradient == pytest.approx(other[0]) and risk == pytest.approx(other[1])
