"""Operators 4 and 5 against the libraries, and packing against best fit row by row."""

import bisect
import hashlib
import random
import zlib

import numpy as np
import pytest

from godown.llm import packing, sentencepiece_chunks
from godown.llm.queries import tokenizer_file
from helpers import frame, messy

ODD = "aAbéÉñ ß'sStT dDllmLveRE019.,!?-_<|>endoftext\n\t  İΣς日本語̈ 　\u0085\x00\x1cﬁⅧ½²ªµº×÷ÿŸ▁👍🏽"


def odd_texts(n=400):
    rng = random.Random(1)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        "<|endoftext|>", "a<|endoftext|>b", "don't I'LL we've", "   ", " a", "a ", "a  b", "▁a▁ b▁▁"]


def test_chunks_encode_and_decode_like_the_library(spark):
    import sentencepiece
    path = tokenizer_file("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = odd_texts() + messy()
    rows = sentencepiece_chunks.encode(frame(spark, texts), path).collect()
    digests = {r["doc_id"]: r for r in sentencepiece_chunks.encode_digests(frame(spark, texts), path).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = sp.encode(texts[r["doc_id"]] or "", add_eos=True)
        assert r["ids"] == want and r["decoded"] == sp.decode(want)
        d = digests[r["doc_id"]]
        assert (d["n_tokens"], d["ids_sha256"]) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())
        assert d["decoded_sha256"] == hashlib.sha256(sp.decode(want).encode()).hexdigest()


def test_a_full_chunk_table_changes_nothing():
    path = tokenizer_file("piece_bpe_32k.model")
    texts = odd_texts(60)
    small, large = (sentencepiece_chunks.encoder(path, n) for n in (5, 10_000))
    for t in texts:
        assert list(sentencepiece_chunks.encode_texts([t], *small)) == list(sentencepiece_chunks.encode_texts([t], *large))


def test_a_model_that_normalises_is_refused():
    class Model:
        def get_piece_size(self): return 1
        def id_to_piece(self, i): return "a▁b"
    with pytest.raises(ValueError):
        sentencepiece_chunks.check_model(Model())


def test_pieces_have_the_library_s_ids(spark):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = odd_texts() + messy()
    got = {}
    for r in packing.pieces(frame(spark, texts), path, 64, 1).collect():
        got[r["doc_id"], r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    want = {}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[a:a + 64], "<u4")
            want[i, p] = (a, len(part), zlib.crc32(part.tobytes()))
    assert got == want


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        gap = gaps.pop(k) if k < len(gaps) else None
        bisect.insort(gaps, (capacity if gap is None else gap) - n)
        yield gap is None


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_gapless_and_as_good_as_best_fit(spark, seed, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 33, 33, 33, rng.randint(1, 100), 100]) for _ in range(700)]
    parts = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    rows = packing.pack(parts, 100).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == list(enumerate(lengths))
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for seq in held.values():
        at = 0
        for offset, n in sorted(seq):
            assert offset == at
            at += n
        assert at <= 100
    assert len(held) == sum(best_fit_decreasing(lengths, 100))


def test_packing_edges(spark):
    path = tokenizer_file("word_bpe_49k.json")
    assert packing.pack_documents(frame(spark, []), path).collect() == []
    rows = packing.pack_documents(frame(spark, [None, "", "a b"], [4, 4, 5]).withColumnRenamed("source", "length"), path).collect()
    assert sorted((r["doc_id"], r["length"], r["sequence_id"]) for r in rows) == [(4, 1, 0), (4, 1, 0), (5, 3, 0)]
    assert sorted(r["offset"] for r in rows) == [0, 3, 4]


def test_packing_encoder_equals_the_library(monkeypatch):
    """Plain, odd and mixed texts, special tokens, very long words, and memos that start over all the time."""
    import numpy as np
    from tokenizers import Tokenizer

    from godown.llm import packing
    from godown.llm.queries import tokenizer_file
    file = tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(file)
    rng = random.Random(6)
    texts = ["a\tb c", "İstanbul ß ñ Œuvre x", "日本 語テスト abc", "<|startoftext|> hi it's", "é café e\u0301", "x" * 5000 + " y", "",
             " \n ", "don't 12 3.4, é×÷ 'LL", "日" * 3000 + " ok", "A.B-C_D", "\x00 \x7f ok"]
    texts += [" ".join(rng.choice(["Word", "ord%d" % rng.randrange(99), "née,", "œ", "it's"]) for _ in range(40)) for _ in range(60)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for rows, chars, call in ((packing.TABLE_ROWS, packing.TABLE_CHARS, packing.CALL_ROWS), (7, 10 ** 6, 3), (10 ** 6, 60, 2)):
        monkeypatch.setattr(packing, "TABLE_ROWS", rows)
        monkeypatch.setattr(packing, "TABLE_CHARS", chars)
        monkeypatch.setattr(packing, "CALL_ROWS", call)
        ids_of = packing.text_encoder(file)
        got = [x for i in range(0, len(texts), 9) for x in ids_of(texts[i:i + 9])]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_packing_encoder_calls_are_bounded_by_characters():
    from godown.llm import packing
    items = ["x" * n for n in (5, packing.CALL_CHARS + 1, 10)] + ["y"] * (packing.CALL_ROWS + 1)
    got = list(packing.calls(items))
    assert [x for c in got for x in c] == items
    assert all(len(c) == 1 or sum(map(len, c)) <= packing.CALL_CHARS and len(c) <= packing.CALL_ROWS for c in got)


def test_packing_tasks_of_a_worker_share_the_encoder(tmp_path):
    import shutil
    path = str(tmp_path / "words.json")
    shutil.copy(tokenizer_file("word_bpe_49k.json"), path)
    first = packing.text_encoder(path)
    assert packing.text_encoder(path) is first                   # loaded once, remembers from task to task
    with open(path, "a") as f:
        f.write("\n")
    assert packing.text_encoder(path) is not first               # another file under the same name


def test_packing_keeps_the_order_of_its_columns(spark):
    got = packing.pack(spark.createDataFrame([(7, 0, 3), (8, 0, 3)], "doc_id long, piece int, length long"), 4)
    assert got.columns == ["doc_id", "piece", "length", "sequence_id", "offset"]
