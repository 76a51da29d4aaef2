"""Registered text queries against SQL, public libraries and brute force; the pipeline stage by stage."""

from __future__ import annotations

import base64
import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from lossgrid.llm import quality_classifier, queries
from tests.llm import reference
from tools.check_oracles import differences, oracle_connection


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in queries.documents(spark, sf_dir).select("doc_id", "text").collect()]


def run(spark, sf_dir, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}


def test_all_queries_are_registered():
    found = contract.queries()
    assert set(queries.QUERIES) <= set(found) and "pipeline" in found
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    answer = oracle_connection(sf_dir).execute(queries.ORACLES[name])
    types = [(d[0], d[1]) for d in answer.description]
    assert differences(df.dtypes, df.collect(), types, answer.fetchall()) is None


def test_classifier_ranks_held_out_documents(spark):
    """Fitted on two thirds of the labels of a larger table; judged on the rest."""
    sf_dir = "/root/testdata/sf0.1"
    docs = queries.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels.filter("doc_id % 3 > 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    held = labels.filter("doc_id % 3 = 0").withColumn("grade", quality_classifier.grade_of(F.col("quality"), F.col("toxic")))
    graded = quality_classifier.grade(docs, model).join(held, "doc_id")
    kept = {r.grade: r.share for r in graded.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[2] > 0.97 and kept[1] < 0.3 and kept[0] < 0.3


def test_near_duplicates(spark, sf_dir, docs):
    expected = reference.near_components(docs, 85)
    found = run(spark, sf_dir, "op4_near_dedup")
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == expected
    assert all(r.kept == (r.component_id == d) for d, r in found.items())


def test_quality_rules(spark, sf_dir, docs):
    found = run(spark, sf_dir, "op5_quality_rules")
    for doc_id, text in docs:
        r = found[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == reference.base_rules(text)
        assert not (r.base_failed and r.kept)


def test_licenses(spark, sf_dir, docs):
    found = run(spark, sf_dir, "op6_license_scan")
    for doc_id, text in docs:
        r = found[doc_id]
        assert (r.n_matches > 0) == bool(re.search("licen[sc]e", text, re.I))
        for span in filter(None, r.spans.split(",")):
            _, start, end = span.rsplit(":", 2)
            assert "licen" in text[int(start) : int(end)].lower()


def test_secret_patterns(spark, sf_dir, docs):
    patterns = (
        ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
    )
    found = run(spark, sf_dir, "op7_secret_scan")
    for doc_id, text in docs:
        spans = sorted(
            (m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(patterns) for m in p.finditer(text) if len(m[g]) >= n
        )
        listed = [f"{patterns[k][0]}:{a}:{b}" for a, k, b in spans]
        r = found[doc_id]
        assert r.base_sha256 == sha(",".join(listed))
        assert set(listed) <= set(filter(None, r.spans.split(",")))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple([s[1] for s in spans].count(k) for k in range(3))


def test_codec_is_the_library_s(spark, sf_dir, docs):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path(queries.BYTE_BPE)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = run(spark, sf_dir, "op8_bpe_codec")
    for doc_id, text in docs:
        ids = library.encode_ordinary(text)
        r = found[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text))


def test_token_counts_are_the_library_s(spark, sf_dir, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_BPE))
    found = run(spark, sf_dir, "op9_token_counts")
    for doc_id, text in docs:
        n = len(library.encode(text))
        assert (found[doc_id].n_bytes, found[doc_id].n_tokens, found[doc_id].over_limit) == (len(text.encode()), n, n > 4096)


def test_pipeline(spark, sf_dir):
    """Every stage against what it should leave of its own input."""
    now = queries.documents(spark, sf_dir)
    columns = now.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, sf_dir)
        assert now.columns == columns
        rows = now.collect()
        now = spark.createDataFrame(rows, now.schema)
        kept.append(rows)
    good, unique, apart, mixed = kept
    last = {}
    for r in good:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in unique) == sorted(last.values())
    components = reference.near_components([(r.doc_id, r.text) for r in unique], 80)
    assert sorted(r.doc_id for r in apart) == sorted(d for d, (_, c) in components.items() if c == d)
    size = {r.doc_id: len(reference.words(r.text)) for r in apart}
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(reference.words(r.text))
    assert all(n <= 3 * size[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - sum(size.values())) <= len({r.source for r in apart})
    final = corpus_pipeline.STAGES[4][1](spark, now, sf_dir).collect()
    assert len(final) == len(mixed) and all(r.round_trip and r.n_tokens == len(r.ids) for r in final)
