"""Registered queries: oracles on small data, contracts, and the pipeline against a plain version."""

import re

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from marketlake.llm import decontaminate, queries, sentence_dedup, trie_bpe
from marketlake.llm.common import py_crc_mod, table

from .test_duplicates import plain_components, plain_dedup, plain_fingerprint


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(
        map(str, want.select(*columns).fetchall()))


def test_contract_columns(spark, sf_dir):
    want = {
        "op1": "doc_id n_words n_hit n_items items_sha256 contaminated", "op2": "doc_id held_out score predicted",
        "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op6": "doc_id n_bytes n_tokens over_limit",
        "op7": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op8": "page_id payload_bytes payload_digest record_type refers_to",
        "op9": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "doc_id fingerprint component_id"}
    for name in queries.QUERIES:
        n = re.match("op[0-9]+", name)[0]
        if n in ("op4", "op7", "op10", "op6"):
            df = queries.QUERIES[name](spark, sf_dir)
            assert df.columns[:len(want[n].split())] == want[n].split()
            assert df.count() == 200
    held = {r.doc_id: r.held_out for r in queries.op4_katz(spark, sf_dir).collect()}
    assert all(h == (py_crc_mod(i, 10) == 0) for i, h in held.items())


def test_language_model_beats_the_base_on_held_out_rows(spark, sf_dir):
    rows = [r for r in queries.op4_katz(spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_pipeline_stages_equal_a_plain_version(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    tox, sim, sent, dec, enc = kept
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    assert not [i for i, t in labels.items() if not t and i not in tox], "a clean document was rejected"
    groups = plain_components([(i, plain_fingerprint(r.text)) for i, r in tox.items()], 2)
    assert set(sim) == {d for d, _, c in groups if d == c}
    want = plain_dedup([(i, r.text) for i, r in sim.items()], sentence_dedup.RUN, sentence_dedup.MIN_WORDS)
    assert set(sent) == {i for i, (n, gone) in want.items() if not gone or len(gone) < n}
    assert all((sent[i].text == sim[i].text) == (not want[i][1]) for i in sent)
    items = {r.item_id: r.text for r in table(spark, sf_dir, "benchmark").collect()}
    hit = decontaminate.brute_force({i: r.text for i, r in sent.items()}, items)
    assert set(dec) == {i for i, (_, n, _) in hit.items() if not n}
    bpe = trie_bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    assert {i: r.n_tokens for i, r in enc.items()} == {i: bpe.run([r.text])[0][0] for i, r in dec.items()}
