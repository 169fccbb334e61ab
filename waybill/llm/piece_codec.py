"""SentencePiece ids of whole texts through a table of distinct chunks, and texts of ids.

Where no piece holds a white-space marker after another character, no merge can cross the start of a marked word: each
marked word (its run of markers and what follows up to the next) is segmented on its own, once per table, and the ids are
joined back by position. The table of a task is bounded; a word met again after it was emptied is segmented again. Nothing
is shuffled: the words of a text stay where the text is. Decoding joins the surfaces of the ids; texts with bytes of
longer characters, unknown ids or a control id in front go through the library.

Null and empty texts have no ids but the end id, and decode to an empty text. Rows come back one to one, repeated rows
and null ids included; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .chunks import SeenTable, lists_of, slices, utf8

MARK = "▁"
SLICE = 4 << 20
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


@lru_cache(maxsize=2)
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(model: str) -> None:
    """Refuses a model whose pieces cross markers, or that rewrites white space or characters."""
    sp = processor(model)
    crossing = [p for p in (sp.id_to_piece(i) for i in range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white-space markers: {crossing[:3]}")
    probe = " a  b\t ﬁ "
    if sp.id_to_piece(sp.piece_to_id(MARK)) != MARK or sp.decode(sp.encode(probe)) != probe or sp.encode(MARK + "x") != sp.encode(" x"):
        raise ValueError("the model changes white space or characters before segmentation")


def marked_words(text: str) -> list[str]:
    """The marked words in order, each without its first marker (the library adds that one back as its own prefix)."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    words = text.split(" ")
    if "" not in words:
        return words
    return [run[1:] for run in _RUNS.findall(MARK + text.replace(" ", MARK))]


def surfaces(sp: sentencepiece.SentencePieceProcessor) -> tuple[list[str], np.ndarray]:
    """What each id decodes to after a text's first, and which ids need the library: the bytes of longer characters."""
    texts, rest = [], np.zeros(sp.get_piece_size(), bool)
    for i in range(len(rest)):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[1:-1], 16)
            texts.append(chr(value) if value < 128 else "")
            rest[i] = value >= 128 or value == 32
        elif sp.is_control(i):
            texts.append("")
        else:
            texts.append(piece.replace(MARK, " "))
            rest[i] = sp.is_unknown(i) or sp.is_unused(i)
    return texts, rest


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: bool = True) -> DataFrame:
    """(id, ids array<int>) of each row's whole text."""
    check_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        table = SeenTable(lambda words: [array("i", x).tobytes() for x in sp.encode(words, num_threads=1)])
        # a marker on its own; the library has no ids for an empty text
        alone = array("i", [sp.piece_to_id(MARK)]).tobytes()
        end = np.array([sp.eos_id()] if end_id else [], dtype="<i4").tobytes()
        for batch in slices(batches, "text", SLICE):
            texts = [marked_words(t.decode()) for t in utf8(batch.column("text"))]
            table.cover([w for words in texts for w in words])
            if "" in table:
                table[""] = alone
            found = [b"".join(map(table.__getitem__, words)) + end for words in texts]
            yield pa.record_batch([batch.column("id"), lists_of(found, pa.int32())], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded) of each row's ids. Null ids decode to an empty text."""
    check_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        surface, rest = surfaces(sp)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column("ids")
                flat = lists.flatten().fill_null(sp.unk_id()).to_numpy(zero_copy_only=False)
                sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                odd = np.concatenate([[0], np.cumsum(rest[flat])])
                texts = []
                for a, b in zip(ends.tolist(), ends[1:].tolist()):
                    ids = flat[a:b].tolist()
                    if odd[a] != odd[b] or (ids and sp.is_control(ids[0])):
                        texts.append(sp.decode(ids))
                    else:
                        text = "".join(map(surface.__getitem__, ids))
                        texts.append(text[1:] if text[:1] == " " else text)
                yield pa.record_batch([part.column("id"), lists, pa.array(texts, pa.string())], names=["id", "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
