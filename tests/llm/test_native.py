import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logvigil.llm import mixing, shards, urls
from logvigil.llm.queries_native import URL_RULES
from logvigil.llm.registry import QUERIES

PYTHON = re.compile(r"Python|Pandas|Arrow")


def no_python(df):
    return not PYTHON.search(df._jdf.queryExecution().executedPlan().toString())


# shards


def test_shards_are_even_and_slots_without_gaps(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i * 37 % 400)) for i in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "map")
    listed = shards.records(docs)
    start = shards.first_map(8)
    shards.store_map(spark, path, 1, start)
    edited = shards.rebalanced(start, shards.slot_bytes(listed), 8)
    shards.store_map(spark, path, 2, edited)
    assert 0 < sum(edited[s] != start[s] for s in start) < len(start) / 4
    placed = shards.placed(listed, shards.load_map(spark, path))
    assert no_python(placed)
    rows = placed.collect()
    assert len(rows) == 3000 and {r.map_version for r in rows} == {2}
    size = Counter()
    for shard in range(8):
        mine = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        size[shard] = sum(r.size for r in mine)
    assert max(size.values()) - min(size.values()) <= 400
    assert {r.shard for r in shards.placed(listed, shards.load_map(spark, path, 1)).where("virtual_slot = 9").collect()} <= {1}


def test_a_new_shard_only_takes(spark):
    load = {s: 1 + s % 7 for s in range(500)}
    old = shards.rebalanced(shards.first_map(4, 500), load, 4)
    new = shards.rebalanced(old, load, 5)
    assert all(new[s] in (old[s], 4) for s in old)
    fewer = shards.rebalanced(old, load, 3)
    assert set(fewer.values()) == {0, 1, 2}


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    slot_map = spark.createDataFrame([(1, s, s % 8) for s in range(shards.SLOTS)], shards.MAP)
    rows = shards.placed(shards.records(odd_docs), slot_map).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.size for r in rows)[:3] == [1, 1, 1]
    assert {r.text_crc32 for r in rows if r.size == 1} == {0}
    assert shards.placed(shards.records(no_docs), slot_map).count() == 0
    assert shards.rebalanced(shards.first_map(8), shards.slot_bytes(shards.records(no_docs)), 8) == shards.first_map(8)


def test_a_third_of_the_rows_without_id_or_text(spark, monkeypatch):
    """Equal rows spread over the slots like others, so the bytes stay even and no slot stands out."""
    monkeypatch.setattr(shards, "COPIES", 100)
    docs = spark.createDataFrame([(None, "same " * 20) if i % 3 == 0 else (i, "x" * (i * 37 % 200)) for i in range(9000)], "doc_id long, text string")
    listed = shards.records(docs, slots=256).cache()
    assert listed.count() == 9000 and listed.where("doc_id IS NULL").count() == 3000
    counts = sorted(r["n"] for r in listed.groupBy("virtual_slot").agg(F.count("*").alias("n")).collect())
    assert len(counts) == 256 and counts[-1] <= 2 * counts[128]
    load = shards.slot_bytes(listed)
    assert sum(load.values()) == docs.agg(F.sum(shards.text_size())).first()[0]
    slot_map = shards.rebalanced(shards.first_map(8, 256), load, 8)
    size = Counter()
    for slot, shard in slot_map.items():
        size[shard] += load.get(slot, 0)
    assert max(size.values()) - min(size.values()) <= max(load.values())  # no shard is a slot ahead
    rows = shards.placed(listed, spark.createDataFrame([(1, s, k) for s, k in slot_map.items()], shards.MAP)).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(k, i) for k in range(8) for i in range(sum(r.shard == k for r in rows))]


def test_op3_recomputed(spark):
    """The registered query, row by row."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_virtual_slots"](spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {k: (len(t) + 1, zlib.crc32(t)) for k, t in docs.items()}
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    largest = max(len(t) + 1 for t in docs.values())
    assert set(size) == set(range(8)) and max(size.values()) - min(size.values()) <= largest
    assert sorted((r.shard, r.slot) for r in rows) == [(k, i) for k in range(8) for i in range(sum(r.shard == k for r in rows))]


# mixing


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 3, "b": 2}, {"a": 500, "b": 300, "c": 199, "d": 1}, {"a": 7, "b": 7, "c": 7}])
def test_period_keeps_every_source_within_a_block(shares):
    ticks, period = mixing.edf_period(shares), sum(shares.values())
    assert sorted(t for ts in ticks.values() for t in ts) == list(range(period))
    for key, share in shares.items():
        given = 0
        for t in range(period):
            given += t in set(ticks[key])
            assert abs(given * period - (t + 1) * share) < period


def simulated(blocks, shares):
    """Phase by phase, block by block."""
    order, left, done = [], dict(blocks), Counter()
    while any(left.values()):
        active = {k: shares[k] for k, n in left.items() if n}
        ticks, period = mixing.edf_period(active), sum(active.values())
        at = {t: k for k, ts in ticks.items() for t in ts}
        tick = 0
        while all(left[k] for k in active):
            key = at[tick % period]
            order.append((key, done[key]))
            done[key] += 1
            left[key] -= 1
            tick += 1
    return order


def test_mix_is_the_simulated_schedule(spark):
    rows = [(i, ["a", "b", "c", None][min(3, i % 11 // 3)]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    shares = {"a": 5, "b": 3, "c": 2, None: 1}
    mixed = mixing.mixed(docs, shares, block_rows=4, bucket_rows=60)
    assert no_python(mixed)
    got = mixed.orderBy("mix_slot", "mix_row").collect()
    assert sorted(r.doc_id for r in got) == list(range(2000))
    assert len({(r.mix_slot, r.mix_row) for r in got}) == 2000
    name = lambda s: "" if s is None else f"={s}"
    counts = Counter(name(s) for _, s in rows)
    want = simulated({k: -(-n // 4) for k, n in counts.items()}, {name(k): n for k, n in shares.items()})
    seen = []
    for r in got:
        if not seen or seen[-1][0] != r.mix_slot:
            seen.append((r.mix_slot, name(r.source)))
    assert [s for _, s in seen] == [k for k, _ in want] and [t for t, _ in seen] == list(range(len(want)))


def test_a_third_of_the_rows_without_id_in_the_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 50)
    docs = spark.createDataFrame([(None, "a") if i % 3 == 0 else (i, "ab"[i % 2]) for i in range(3000)], "doc_id long, source string")
    mixed = mixing.mixed(docs, bucket_rows=100)
    assert no_python(mixed)
    rows = mixed.collect()
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == 3000
    assert Counter((r.doc_id, r.source) for r in rows) == Counter(tuple(r) for r in docs.collect())
    ranks = mixing._ranks(docs.select(mixing.source_key("source").alias("key"), F.struct(F.xxhash64("doc_id").alias("a")).alias("h")), 20)
    assert ranks.count() == 2002 - 1 and sorted(r["rank"] for r in ranks.where("key = '=b'").collect()) == list(range(1000))


def test_too_many_sources_are_refused(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "cast(id AS string) AS source")
    with pytest.raises(ValueError, match="600 sources"):
        mixing.mixed(docs)


def test_mix_of_odd_rows(odd_docs, no_docs):
    mixed = mixing.mixed(odd_docs)
    assert mixed.count() == odd_docs.count()
    assert set(odd_docs.columns) <= set(mixed.columns) and dict(mixed.dtypes)["mix_slot"] == "bigint"
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.planned({}, {}).phases == []


# urls

CASES = [
    ("https://WWW.Example.ORG/es/1?x=1", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12#a", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://badexample.org/es/2", "badexample.org", "/es/2", "org/", "allow"),
    ("x://a.com/fr/?q=://b.com/de/", "a.com", "/fr/", "com/fr/", "allow"),
    ("http://a.com/de/#://", "a.com", "/de/", "com/de/", "block"),
    ("http://org", "org", "", None, "allow"),
    ("no scheme.com/de/", "", "", None, "allow"),
    ("http://É.NET/de\n/", "É.net", "/de\n/", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_host_path_and_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(CASES)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in urls.filtered(pages, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if rule:
            assert got[i].verdict == verdict
    assert urls.filtered(pages.limit(0), URL_RULES).count() == 0


def brute_rules(baskets, support, confidence):
    from itertools import combinations

    n = len(baskets)
    sets = Counter(c for tokens, _ in baskets for k in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), k))
    both = Counter((c, v) for tokens, v in baskets for k in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), k))
    found = {cv: m / sets[cv[0]] for cv, m in both.items() if m / n >= support and m / sets[cv[0]] >= confidence}

    def needless(c, v):
        return any((p, v) in found and found[p, v] >= found[c, v] for t in c if (p := tuple(x for x in c if x != t)))

    return {(c, v): conf for (c, v), conf in found.items() if not needless(c, v)}


def test_mined_rules_and_matches_are_those_of_brute_force(spark):
    import random

    rng = random.Random(2)
    baskets = []
    for _ in range(300):
        tokens = tuple(sorted({f"t{rng.randrange(6)}" for _ in range(rng.randrange(1, 5))}))
        baskets.append((tokens, "block" if "t1" in tokens and ("t2" in tokens or rng.random() < 0.5) else "allow"))
    labelled = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    rules = urls.mined(labelled, support=0.02, confidence=0.8)
    want = brute_rules(baskets, 0.02, 0.8)
    got = {(tuple(r.antecedent), r.said): r.confidence for r in rules.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    best = {}
    for tokens, _ in baskets:
        fits = [(conf, c, v) for (c, v), conf in want.items() if set(c) <= set(tokens)]
        if fits:
            best[tokens] = max(f[0] for f in fits)
    matched = {tuple(r.tokens): r.confidence for r in urls.matched(labelled, rules).collect()}
    assert matched.keys() == best.keys() and all(abs(matched[k] - best[k]) < 1e-9 for k in best)
    assert urls.mined(labelled.limit(0)).count() == 0


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.example.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(50)], "page_id long, url string")
    assert no_python(urls.filtered(pages, URL_RULES))
