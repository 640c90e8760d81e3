"""Registered queries against SQL, libraries and brute force on the smallest test tables."""

import hashlib
import zlib
from collections import Counter

import oracle_check
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from batchloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def rows(spark, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert oracle_check.differences(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLE[name]) == []


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(queries.ORACLE) <= set(registered.oracle_sql())


def test_op1_equals_the_library(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = rows(spark, "op1_bpe")
    assert set(found) == set(documents)
    for i, d in documents.items():
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert tuple(found[i]) == (i, len(ids), digest(",".join(map(str, ids))), digest(decoded))


def test_op6_law_of_rows(spark, documents):
    found = rows(spark, "op6_sharding")
    sizes = Counter(r.shard for r in found.values())
    assert set(found) == set(documents) and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8
    for i, r in found.items():
        body = (documents[i].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)


def test_op7_held_out_accuracy(spark, documents):
    found = rows(spark, "op7_language")
    held = [r for i, r in found.items() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    right = sum(r.lang_pred == documents[r.doc_id].lang for r in held)
    assert right / len(held) > 0.95


def test_op10_beats_the_base_on_held_out_texts(spark):
    held = [r for r in rows(spark, "op10_lm").values() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_pipeline_stages_follow_their_operators(spark, documents):
    """Each stage holds exactly the documents that its operator keeps, of those that came in."""
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != names[-1]:
            assert docs.columns == before.columns
    quality = {i for i, r in rows(spark, "op2_quality").items() if r.kept}
    assert kept[names[0]] == quality
    assert kept[names[4]] == kept[names[3]] <= kept[names[2]] <= kept[names[1]] <= kept[names[0]]
    assert not docs.where("NOT round_trip").count()
    again = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert again == kept[names[4]]
