"""SentencePiece encoding and decoding by a distinct-chunk table (operator 4).

No piece of the model holds a white-space marker after another character,
so no merge crosses from one marked word to the next: a text is cut in
front of each run of markers, every distinct chunk is segmented and decoded
once, and ids and text are joined back by position.  The table lives in the
task (a vocabulary grows with the corpus, so it is not broadcast) and starts
afresh when it holds ``TABLE_ROWS`` chunks; that changes no result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from godown.llm.common import out_batch, slices

MARK = "▁"
TABLE_ROWS = 300_000
RUNS = re.compile(r" +[^ ]*")


def chunk_keys(text: str) -> list[str]:
    """The chunks of a text, each without the first of its markers."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return [c[1:] for c in RUNS.findall(" " + text)]
    return text.split(" ")


def check_model(sp) -> None:
    """The chunk rule needs a model without normalisation and without pieces across words."""
    for i in range(sp.get_piece_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a white-space marker")
    probe = "a  Ａﬁ 　b "
    if sp.decode(sp.encode(probe)) != probe:
        raise ValueError("the model normalises its input; chunks can't be encoded on their own")


def encoder(model_file: str, table_rows: int = TABLE_ROWS):
    """keys of some chunks -> {key: (ids, decoded without its first space)}, remembered."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    check_model(sp)
    lone = sp.encode("x ")[len(sp.encode("x")):]          # a marker with nothing behind it
    end = sp.eos_id()
    table: dict = {}

    def fill(keys) -> dict:
        new = [k for k in keys if k not in table]
        if len(table) + len(new) > table_rows:
            table.clear()
            new = list(keys)
        ids = sp.encode(new, num_threads=1)
        ids = [lone if k == "" else i for k, i in zip(new, ids)]
        table.update(zip(new, zip(ids, sp.decode(ids, num_threads=1) if ids else [])))
        return table

    return fill, end


def encode_texts(texts, fill, end):
    """For each text its ids (with the end id) and its decoded text."""
    cut = [chunk_keys(t or "") for t in texts]
    table = fill(set().union(*cut))
    for keys in cut:
        ids = [i for k in keys for i in table[k][0]]
        ids.append(end)
        yield ids, " ".join([table[k][1] for k in keys])


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string; null text counts as empty (only the end id)."""
    def run(batches):
        fill, end = encoder(model_file)
        for b in slices(batches):
            got = list(encode_texts(b.column(1).to_pylist(), fill, end))
            yield out_batch(["doc_id", "ids", "decoded"],
                            [b.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.string())])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode`` with the digests taken in the same task."""
    def run(batches):
        fill, end = encoder(model_file)
        said: dict = {}
        for b in slices(batches):
            cut = [chunk_keys(t or "") for t in b.column(1).to_pylist()]
            keys = set().union(*cut)
            table = fill(keys)
            if len(said) > TABLE_ROWS:
                said.clear()
            said.update((k, (" ".join(map(str, table[k][0])), len(table[k][0]))) for k in keys if k not in said)
            n, a, d = [], [], []
            for row in cut:
                words = [said[k] for k in row]
                n.append(sum([w[1] for w in words]) + 1)
                a.append(hashlib.sha256(" ".join([w[0] for w in words] + [str(end)]).encode()).hexdigest())
                d.append(hashlib.sha256(" ".join([table[k][1] for k in row]).encode()).hexdigest())
            yield out_batch(["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                            [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
                               "ids_sha256 string, decoded_sha256 string")
