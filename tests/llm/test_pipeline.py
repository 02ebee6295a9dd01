"""The pipeline, stage by stage, against what each stage has to give for its own input."""

import hashlib
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_minhash import brute as near_duplicates
from test_text_models import brute_base
from test_suffixes import brute as repeated_strings

import __spark_entry__ as spark_entry
import corpus_pipeline
from logvigil.llm import bpe, mixing, quality
from logvigil.llm.queries_text import RANKS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the documents and after each stage; each result is written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "suffix_array_dedup", "mixing_to_weights", "byte_bpe",
    ]
    assert all(t.dtypes == stages[0].dtypes for t in stages[1:5])


def test_quality_keeps_what_passes_both_parts(spark, stages):
    docs = stages[0].collect()
    model = quality.quality_model(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in stages[1].collect()}
    scores = [1.0] * len(docs) if model is None else model.scores([r.text or "" for r in docs])
    for row, score in zip(docs, scores):
        base = brute_base(row.text or "")
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert (row.doc_id in kept) == (not failed and score >= quality.THRESHOLD)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    long_enough = [r.doc_id for r in docs if labels.get(r.doc_id) == 1 and brute_base(r.text)[0] >= 50]
    assert len(set(long_enough) - kept) <= 1


def test_one_of_each_group_stays(stages):
    groups = near_duplicates(sorted((r.doc_id, r.text) for r in stages[1].collect()), 5, 80)
    assert {r.doc_id for r in stages[2].collect()} == {i for i, (_, first) in groups.items() if i == first}


def test_repeated_strings_go(stages):
    want = {key: sha for key, _, _, _, sha in repeated_strings([(r.doc_id, r.text.encode()) for r in stages[2].collect()], 240, 50)}
    rows = stages[3].collect()
    assert {r.doc_id for r in rows} == set(want)
    for r in rows:
        assert r.n_chars == len(r.text)
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]


def test_mix_keeps_all_and_decides_the_order(stages):
    before, after = stages[3], stages[4]
    assert sorted(before.collect()) == sorted(after.collect())
    place = {r.doc_id: (r.mix_slot, r.mix_row) for r in mixing.mixed(before).collect()}
    files = after.select("doc_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).orderBy("f", "i").collect()
    assert [r.doc_id for r in files] == sorted(place, key=place.get)


def test_tokens_of_what_is_left(stages):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in stages[5].collect()}
    for r in stages[4].collect():
        ids = known.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_is_the_stages_in_a_row(spark, stages):
    got = spark_entry.queries()["pipeline"](spark, SF)
    assert sorted(got.collect()) == sorted(stages[5].collect())


def test_stages_take_odd_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.collect()
