"""Operators 2, 3 and 6: parts against brute force, whole ones by held-out accuracy."""

import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_MID
from godown.llm import ppm_language, subword_quality, toxic_segments
from godown.llm.common import crc_mod, table
from godown.llm.queries import QUERIES
from helpers import frame, messy


def test_code_lengths_of_the_table_are_those_of_the_trees():
    rng = random.Random(5)
    langs = [Counter("".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode() for _ in range(200)) for _ in range(3)]
    trees = [ppm_language.grow(w, 4) for w in langs]
    arrays = ppm_language.TreeTable.arrays([ppm_language.frozen(t) for t in trees], 4)
    probe = ["".join(rng.choice("abcéxy") for _ in range(rng.randint(1, 80))).encode() for _ in range(100)]
    got = ppm_language.TreeTable(*arrays).code(probe)
    for w, bits in zip(probe, got):
        want = [sum(ppm_language.cost(t, c, b) for c, b in ppm_language.contexts(w, 4)) for t in trees]
        assert np.allclose(bits, want)
        known = [ppm_language.word_bits(w, *ppm_language.frozen(t), 4) for t in trees]
        assert np.allclose(bits, known)


def test_escape_probabilities_sum_to_at_most_one():
    tree = ppm_language.grow(Counter({b"abab": 3, b"abc": 1}), 3)
    for ctx in (b" ", b" a", b"ab", b"zz"):
        assert sum(2 ** -ppm_language.cost(tree, ctx, b) for b in range(256)) <= 1.0 + 1e-9


def test_language_held_out(spark):
    rows = QUERIES["op3_ppm_language"](spark, SF_MID).join(table(spark, SF_MID, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_language_edges(spark):
    docs = frame(spark, ["hello there", None, "", "123 ...", "hello " * 5000, "x" * 5000])
    model = ppm_language.train(docs)
    got = {r["doc_id"]: r for r in ppm_language.identify(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["en", "und", "und", "und", "en", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert ppm_language.train(frame(spark, [])) == {}
    assert ppm_language.identify(docs, {}).where("lang_pred != 'und'").count() == 0
    assert ppm_language.identify(frame(spark, []), model).count() == 0


def test_quality_held_out(spark):
    rows = QUERIES["op2_subword_quality"](spark, SF_MID).join(table(spark, SF_MID, "labels"), "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_quality_edges(spark):
    docs = frame(spark, ["good text here"] * 8 + ["BAD!! BAD!!"] * 8 + [None, "", " "]).withColumnRenamed("source", "quality")
    labels = spark.createDataFrame([(i, 1 if i < 8 else 0) for i in range(16)] + [(99, None)], "doc_id long, quality int")
    model = subword_quality.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in subword_quality.score(docs, model).collect()}
    assert len(got) == 19 and got[0] > 0.7 > 0.3 > got[8] and got[16] == got[17] == got[18]
    assert sorted(subword_quality.keep(docs, model, 0.5).columns) == sorted(docs.columns)
    one_class = subword_quality.train(docs, labels.where("quality = 1"))
    assert one_class is None
    assert {r["score"] for r in subword_quality.score(docs, None).collect()} == {0.5}
    assert subword_quality.score(frame(spark, []), model).count() == 0


def slow_segments(scores):
    """Maximal scoring segments by recursion: the best contiguous run, then both sides."""
    best = max(((sum(scores[i:j]), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    i, j = best[2], best[3]
    return slow_segments(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in slow_segments(scores[j:])]


@pytest.mark.parametrize("seed", range(20))
def test_segments_are_the_maximal_ones(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-2.0, -1.1, -0.37, 0.53, 1.7, 2.9]) + rng.random() / 100 for _ in range(rng.randint(0, 25))]
    got = toxic_segments.segments(scores)
    for a, b, s in got:
        assert s == pytest.approx(sum(scores[a:b]))
        assert s > 0 and all(sum(scores[a:k]) > 0 for k in range(a + 1, b + 1))
    assert max((s for _, _, s in got), default=0) == pytest.approx(max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]))
    merged = [(a, b) for a, b, _ in got]
    assert all(x[1] <= y[0] for x, y in zip(merged, merged[1:]))
    assert merged == slow_segments(scores)


def test_karlin_lambda_solves_its_equation():
    values, weights = [-1.0, 2.0], [0.9, 0.1]
    lam = toxic_segments.karlin(values, weights)
    assert sum(w * np.exp(lam * v) for v, w in zip(values, weights)) == pytest.approx(1, abs=1e-6)


def test_toxicity_held_out(spark):
    rows = QUERIES["op6_toxic_segments"](spark, SF_MID).join(table(spark, SF_MID, "labels"), "doc_id").collect()
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert sum(clean) <= 0.03 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_toxicity_edges(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["vile"] if i < 40 and k % 6 == 0 else ["word%d" % rng.randrange(300)]) for k in range(30)) for i in range(80)]
    texts += [None, "", " ", "calm " * 20000 + "vile vile vile vile"]
    docs = frame(spark, texts).withColumnRenamed("lang", "toxic")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, toxic int")
    model = toxic_segments.train(docs, labels)
    got = {r["doc_id"]: r for r in toxic_segments.score(docs, model).collect()}
    assert len(got) == 84 and got[0]["score"] >= 0.5 > got[60]["score"]
    assert got[80]["score"] == got[81]["score"] == got[82]["score"] < 0.5
    first = got[0]["passages"][0]
    assert "vile" in texts[0].split()[first["first"]:first["end"]]
    assert toxic_segments.train(docs, labels.where("toxic = 0")) is None
    assert {r["score"] for r in toxic_segments.score(docs, None).collect()} == {0.0}
    assert toxic_segments.score(frame(spark, messy()), model).count() == len(messy())


def test_split_of_rows(spark):
    import zlib
    got = {r["doc_id"]: r["m"] for r in spark.range(300).withColumnRenamed("id", "doc_id").select("doc_id", crc_mod("doc_id", 5).alias("m")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(300)}
