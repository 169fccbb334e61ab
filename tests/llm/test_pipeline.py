"""The registered queries on small tables, and the pipeline's stages against brute force."""

from __future__ import annotations

import hashlib
import zlib
from pathlib import Path

import pytest
import sentencepiece
from test_pii import base_spans
from test_similar import brute_overlap, joined, shingle_set

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from waybill.llm import pii, toxicity
from waybill.llm.queries import QUERIES, TOKENIZERS, remainder
from waybill.sources.tables import read_table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

CONTRACT = {
    "op1_lm_score": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op2_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op3_decontaminate": {"doc_id", "item_id"},
    "op4_piece_codec": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op5_id_store": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op6_vector_dups": {"vec_id", "n_links", "component_id", "kept"},
    "op7_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op8_quality": {"doc_id", "held_out", "score", "predicted"},
    "op9_paragraph_dups": {"doc_id"},
    "op10_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op11_main_text": {"page_id", "url", "text", "n_chars"},
    "op12_conversation_trie": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op13_periodic_runs": {
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    },
}
HELD_OUT = {"op1_lm_score": (7, 2), "op2_toxicity": (3, 1), "op8_quality": (5, 0)}


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in read_table(spark, FOLDER, "documents").collect()}


@pytest.mark.parametrize("name", list(CONTRACT))
def test_query(spark, documents, name):
    assert queries()[name] is QUERIES[name]
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    assert CONTRACT[name] <= set(frame.columns)
    if name not in ("op3_decontaminate", "op6_vector_dups", "op9_paragraph_dups", "op11_main_text", "op12_conversation_trie"):
        assert sorted(r.doc_id for r in rows) == sorted(documents)
    if name in HELD_OUT:
        modulus, rest = HELD_OUT[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    if name == "op7_pii":
        for r in rows:
            want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(documents[r.doc_id]))
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_registry():
    assert set(QUERIES) == set(CONTRACT) and "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "benchmark", "personal_data", "piece_ids"]


def test_stages_against_brute_force(spark):
    docs = read_table(spark, FOLDER, "documents")
    stages = dict(corpus_pipeline.STAGES)

    def texts(frame):
        assert frame.columns == docs.columns
        return {r.doc_id: r.text for r in frame.collect()}

    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    model = toxicity.train(docs, read_table(spark, FOLDER, "labels"), remainder(3) != 1)
    rejected = {r.doc_id for r in toxicity.score(docs, model).collect() if r.toxicity.toxic}
    kept = texts(clean)
    assert set(kept) == {r.doc_id for r in docs.collect()} - rejected

    sets = {i: shingle_set(t, 5) for i, t in kept.items()}
    order = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(order) for b in order[k + 1:] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = joined(sets, links)
    single = stages["near_copies"](spark, clean, FOLDER).cache()
    assert set(texts(single)) == {i for i in sets if least[i] == i}

    items = [r.text.lower().split() for r in read_table(spark, FOLDER, "benchmark").collect()]
    fair = stages["benchmark"](spark, single, FOLDER).cache()
    gone = set(texts(single)) - set(texts(fair))
    heads = {tuple(item[k:k + 7]) for item in items for k in range(len(item) - 6)}
    for i, t in texts(single).items():
        words = t.lower().split()
        # a run of seven equal words is needed for the slow search to be worth it; every removal has one here
        near = any(tuple(words[k:k + 7]) in heads for k in range(len(words) - 6))
        held = near and any(brute_overlap(words, item, 0.8, 13) for item in items if len(words) < 3_000)
        assert held == (i in gone) or len(words) >= 3_000

    hidden = stages["personal_data"](spark, fair, FOLDER).cache()
    before, after = texts(fair), texts(hidden)
    for i, t in before.items():
        spans = base_spans(t)
        assert (after[i] == t) == (not spans)
        assert not any(k in pii.BASE for *_, k in base_spans(after[i]))
    assert all(r.n_chars == len(r.text) for r in hidden.collect() if r.text != before[r.doc_id])

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    for r in stages["piece_ids"](spark, hidden, FOLDER).collect():
        assert list(r.ids) == sp.encode(after[r.doc_id]) + [2] and r.decoded == sp.decode(list(r.ids))


def test_stages_on_odd_and_empty_input(spark, table, odd):
    for docs in (table(odd), table([]).limit(0)):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, FOLDER).cache()
            if name != "piece_ids":
                assert out.columns == rows.columns
                rows = out
        ids = sorted((r.doc_id for r in out.collect()), key=lambda i: (i is not None, i or 0))
        # of equal texts the least id stays, repeated rows count once; texts without words are never copies
        assert ids == ([None, 1, 2, 3, 4, 5, 7, 8, 9] if docs.count() else [])
