"""Token ids: against the libraries on whole texts, and round trips through the files."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from waybill.llm import id_store, piece_codec
from waybill.llm.queries import TOKENIZERS
from waybill.session import fresh_dir

PIECES, WORDS = f"{TOKENIZERS}/piece_bpe_32k.model", f"{TOKENIZERS}/word_bpe_49k.json"
TRICKY = [
    "", " ", "  a  b ", "a\tb\nc  d", "ﬁ①", "a　b\xa0c", "x▁y ▁▁ z", "é é", "日本語 テキスト\x00 q", "</s> <s> <unk>x",
    "a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|> It's ÀÉ don't", "İ ǅ K 12 3,4!! \x1c z\x85q", "end ", "\n\n",
]


def test_pieces_equal_the_library(table, odd):
    rows = [*odd, *((100 + i, t) for i, t in enumerate(TRICKY))]
    got = piece_codec.decode(piece_codec.encode(table(rows), PIECES), PIECES).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for i, t in rows:
        ids = sp.encode(t or "") + [2]
        want.append((i, ids, sp.decode(ids)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in got), key=key) == sorted(want, key=key)


def test_decode_of_any_ids(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cases = [[], [2], [1, 28705, 264], [264, 0, 264], [3 + 0xE2], [3 + 0x20, 264], [28705, 28705], [3 + 0xC3, 3 + 0xA9]]
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.decoded for r in piece_codec.decode(frame, PIECES).collect()}
    assert got == {i: sp.decode(c) for i, c in enumerate(cases)}


def test_a_full_table_starts_anew():
    from waybill.llm.chunks import SeenTable

    seen = []
    table = SeenTable(lambda words: [seen.append(w) or w.upper() for w in words], entries=3)
    for words in (["a", "b"], ["b", "c"], ["d", "a"]):
        table.cover(words)
        assert [table[w] for w in words] == [w.upper() for w in words]
        assert len(table) <= 3


def stored(spark, frame):
    folder = fresh_dir(spark, "store")
    id_store.write(frame, folder, WORDS, 1)
    return folder


def test_store_equals_the_library_and_its_own_files(spark, table, odd, prose, monkeypatch):
    monkeypatch.setattr(id_store, "BLOCK_BYTES", 2_000)
    rows = [*odd, *((100 + i, t) for i, t in enumerate(TRICKY)), *((1000 + i, prose(i, 300)) for i in range(200))]
    folder = stored(spark, table(rows))
    tok = Tokenizer.from_file(WORDS)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    got = id_store.read(spark, folder).collect()
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted(ids and [i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    at = 0
    for r in order:
        assert r.start == at and list(r.ids) in ids[r.doc_id]
        at += len(r.ids)
    digests = {(r.doc_id, r.start): r for r in id_store.read(spark, folder, digest=True).collect()}
    for r in got:
        d = digests[r.doc_id, r.start]
        assert d.n_tokens == len(r.ids) and d.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    one = id_store.read(spark, folder, only=[1003]).collect()
    assert [list(r.ids) for r in one] == ids[1003]


def test_store_refuses_another_dictionary(spark, table, prose):
    folder = stored(spark, table([(i, prose(i, 50)) for i in range(5)]))
    other = fresh_dir(spark, "store")
    spark.read.parquet(f"{folder}/blocks").selectExpr("* except (dictionary_sha256)", "'0' dictionary_sha256").write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{folder}/dictionary").write.parquet(f"{other}/dictionary")
    with pytest.raises(Exception, match="needs the dictionary"):
        id_store.read(spark, other).collect()


def test_empty_tables(spark, table):
    none = table([]).limit(0)
    assert piece_codec.decode(piece_codec.encode(none, PIECES), PIECES).collect() == []
    assert id_store.read(spark, stored(spark, none)).collect() == []
