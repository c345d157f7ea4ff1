"""Small document tables with everything that real ones hold."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in zip(ids, texts)], DOCS)


def words(rng: random.Random, n: int, vocab: int = 4000) -> list[str]:
    return ["w%d" % rng.randrange(vocab) for _ in range(n)]


def messy(seed: int = 3, n: int = 60) -> list:
    """Texts with near and exact copies, shared passages, repeated words, odd white space, nulls and a very long one."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([2, 4, 7, 30, 80, 200])) for _ in range(n)]
    passage = words(rng, 40)
    for i in range(0, n, 4):
        base[i] = base[i] + passage[:rng.choice([13, 20, 40])] + words(rng, 5)
    for i in range(1, n, 5):
        near = list(base[i - 1])
        if len(near) > 20:
            near[rng.randrange(len(near))] = "edited"
        base[i] = near
    texts = [" ".join(b) for b in base]
    texts += [texts[5], texts[5].replace(" ", "\n\t "), texts[7].upper(), None, None, "", "   ", "　", "one", "ONE"]
    texts += ["line again " * 40, "line again " * 60, "é ñ 日本 " * 20, " ".join(words(rng, 6000)), " ".join(passage)]
    return texts
