"""The registered queries on the smallest tables, and the pipeline against its parts."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, canonical
from inciscope.llm import catalog, secret_scan, toxicity
from inciscope.session import materialise
from test_llm_bpe_packing import check_pieces
from test_llm_ngram_join import plain_groups

SF = entry.SMOKE_DIR
COLUMNS = {
    "op1_order_minhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_concatenate_and_cut": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_weak_supervision": "doc_id held_out score predicted",
    "op4_zstd_novelty": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_checked_patterns": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_t_occurrence": "doc_id n_shingles component_id",
    "op7_hidden_markov": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op8_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_multi_index_hashing": "query_id rank vec_id distance",
    "op10_url_filter": "page_id host path rule verdict",
    "op11_max_sketches": "item_id rank doc_id score",
    "op12_incremental_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_wrapper_inference": "page_id url text n_chars",
}


def test_all_are_registered():
    assert set(COLUMNS) == set(catalog.QUERIES) and {*COLUMNS, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    found = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in found.collect()]
    assert set(COLUMNS[name].split()) <= set(found.columns) and rows
    if "doc_id" in found.columns and name not in ("op2_concatenate_and_cut", "op11_max_sketches"):
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name in entry.oracle_sql():
        db = duckdb.connect()
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        result = db.execute(entry.oracle_sql()[name])
        assert canonical(found.columns, rows) == canonical([c[0] for c in result.description], result.fetchall())


def test_pipeline_against_its_parts(spark):
    """Each stage on what the one before kept: the classifier's verdicts, brute-force groups, plain redaction, pieces."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).withColumns({"doc_id": F.col("doc_id") + 10**6})  # copies
    docs = materialise(docs.union(extra), "pipeline-test")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "secret_scan", "packing"]
    stages, kept = dict(corpus_pipeline.STAGES), {}
    for name in names:
        docs = materialise(stages[name](spark, docs, SF), f"pipeline-test-{name}")
        kept[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    start = spark.read.parquet(f"{SF}/documents.parquet").union(extra)
    verdicts = toxicity.score(start, labels).where("predicted = 0")
    assert sorted(r.doc_id for r in kept["toxicity"].collect()) == sorted(r.doc_id for r in verdicts.collect())

    rows = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    found, _ = plain_groups(rows)
    assert sorted(r.doc_id for r in kept["ngram_join"].collect()) == sorted(i for i, _, c in found if i == c)

    before = {r.doc_id: r for r in kept["ngram_join"].collect()}
    spans = {r.doc_id: r.spans for r in secret_scan.scan(kept["ngram_join"]).collect()}
    after = {r.doc_id: r for r in kept["secret_scan"].collect()}
    assert set(before) == set(after)
    for key, row in after.items():
        want = secret_scan.redacted(before[key].text, [(s.start, s.end) for s in spans[key]], "[SECRET]")
        assert row.text == want and row.n_chars == (len(want) if spans[key] else before[key].n_chars)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {str(k): [*library.encode(r.text, add_special_tokens=False).ids, 2] for k, r in after.items()}
    pieces = kept["packing"].collect()
    check_pieces(pieces, want, 4096)
    assert {str(p.doc_id) for p in pieces} == set(want)


def test_pipeline_runs_on_empty_tables_and_nulls(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "x y z", "de", None, 5)]
    for k, data in enumerate(([], rows)):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        pieces = corpus_pipeline.run(spark, folder).collect()
        assert sorted(str(p.doc_id) for p in pieces) == (sorted(["1", "None", "2", "2", "3"]) if data else [])
        assert np.sum([p.length for p in pieces]) == sum(p.doc_tokens for p in pieces)
