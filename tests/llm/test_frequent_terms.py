"""Operator 7 on a group of near copies that holds a third of the rows."""

import random

from godown.llm import imatch
from helpers import frame, words


def test_near_copies_keep_their_entries_when_they_lift_their_own_terms(spark):
    rng = random.Random(6)
    base = words(rng, 150, 6000)
    texts = [" ".join(words(rng, 150, 6000)) for _ in range(160)]
    for _ in range(80):
        near = list(base)
        near[rng.randrange(150)] = "w%d" % rng.randrange(6000)
        texts.append(" ".join(near))
    docs = frame(spark, texts)
    rows = imatch.edited_fingerprints(docs, imatch.lexicons(docs)).orderBy("doc_id").collect()
    group = [r["near_next"] for r in rows[160:-1]]
    assert sum(group) / len(group) > 0.7
    assert sum(r["near_next"] for r in rows[:159]) / 159 < 0.2
    old = imatch.edited_fingerprints(docs, imatch.lexicon(docs)).orderBy("doc_id").collect()
    assert sum(r["near_next"] for r in old[160:-1]) / 79 < 0.2
