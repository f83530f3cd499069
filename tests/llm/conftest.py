import random

import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use inside; they must not get in the way.
EXTRA = ["mark", "digest", "n", "label", "words", "anchor", "ids", "entry", "component", "size", "score"]


def make_texts(seed: int, n: int, vocabulary: int = 60) -> list[str | None]:
    """Short texts from few words, with copies, near copies, shared passages, repeated lines and odd ones."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["Éa", "ß", "the", "THE"]

    def prose(k):
        return [rng.choice(words) for _ in range(k)]

    passage = prose(40)
    texts: list[str | None] = [None, "", "   \n\t", "one", "A b", "a B", "w1 " * 70, "\x0bx\x0cy\x1cz q "]
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.3 or len(texts) < 12:
            texts.append(" ".join(prose(rng.randrange(1, 120))))
        elif kind < 0.45:
            texts.append(rng.choice(texts))
        elif kind < 0.75:
            t = (rng.choice(texts) or "x").split(" ")
            for _ in range(rng.randrange(1, 4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n"]).join(t))
        else:
            cut = rng.randrange(0, 15)
            texts.append("  ".join(prose(rng.randrange(0, 40)) + passage[cut:cut + 25] + prose(rng.randrange(0, 40))))
    return texts


@pytest.fixture(scope="session")
def doc_frame(spark):
    """Makes a documents table of (doc_id, text) pairs, with columns whose names clash with those used inside."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in EXTRA])

    def make(pairs):
        return spark.createDataFrame([(i, t, None, "s", *[c for c in EXTRA]) for i, t in pairs], schema)

    return make


@pytest.fixture(scope="session")
def corpus():
    return list(enumerate(make_texts(7, 160)))
