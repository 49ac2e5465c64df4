"""The pipeline, stage by stage, against brute force on the small tables."""

import hashlib

import duckdb
import pytest
from test_decontaminate import brute as hits_of
from test_minhash import brute as components_of
from test_secrets import brute as secrets_of

import corpus_pipeline
from symgrid.llm import packing, queries
from symgrid.llm.common import staged

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "secrets", "packing"]

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLE['op3_quality_rules']}) WHERE kept").fetchall()}
    good = staged(stages["quality_rules"](spark, docs, SF_DIR), "test")
    assert good.columns == columns and {r.doc_id for r in good.collect()} == kept

    texts = [(r.doc_id, r.text) for r in good.collect()]
    single = staged(stages["near_duplicates"](spark, good, SF_DIR), "test")
    assert {r.doc_id for r in single.collect()} == {i for i, (_, root) in components_of(texts, 5).items() if i == root}

    texts = {r.doc_id: r.text for r in single.collect()}
    clean = staged(stages["decontamination"](spark, single, SF_DIR), "test")
    windows = {w for _, text in benchmark for w in _windows(text)}
    assert {r.doc_id for r in clean.collect()} == {i for i, text in texts.items() if not windows & _windows(text)}
    assert clean.columns == columns

    texts = {r.doc_id: r.text for r in clean.collect()}
    redacted = staged(stages["secrets"](spark, clean, SF_DIR), "test")
    after = {r.doc_id: r.text for r in redacted.collect()}
    assert set(after) == set(texts) and redacted.columns == columns
    for i, text in texts.items():
        assert bool(secrets_of(text)) <= (after[i] != text)
        assert not secrets_of(after[i].replace("[SECRET]", ""))

    known = packing.WordTokens(packing.byte_bpe("byte_bpe_50k.tiktoken"))
    pieces = {}
    for r in stages["packing"](spark, redacted, SF_DIR).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    whole = {i: b"".join(ids for _, ids in sorted(parts)) for i, parts in pieces.items()}
    assert whole == {i: packing.token_bytes(text, known) + b"\1\0\0\0" for i, text in after.items()}


def _windows(text):
    from test_decontaminate import words_of

    words = words_of(text)
    return {tuple(words[i : i + 10]) for i in range(len(words) - 9)}


def test_brute_force_of_windows_agrees():
    words = " ".join(f"w{i}" for i in range(30))
    assert hits_of(words, [(1, words[:60])], 10)[2] == {1}


def test_run_gives_the_packed_rows(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(rows.columns)
    by = {}
    for r in rows.collect():
        by.setdefault((r.sequence_id, r.sequence_length), []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    assert all(sum(n for _, n in parts) == size for (_, size), parts in by.items())


@pytest.mark.parametrize("name", ["op4_pii", "op5_secrets"])
def test_digest_columns(spark, name):
    import test_pii

    brute = test_pii.brute if name == "op4_pii" else secrets_of
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in queries.QUERIES[name](spark, "/root/testdata/sf0.01").collect():
        spans = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        for kind in {k for k, _, _ in spans}:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
