import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, Text string, key string, component long, gone long, rank int"


def frame(spark, rows):
    """Documents from (doc_id, text) with extra columns whose names operators use inside, one clashing by case."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "other", "k", 7, 8, 9) for i, t in rows], DOCS)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture
def edge_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = prose(99, 30_000)
    return [(None, prose(1, 40)), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, long), (5, prose(2, 60)), (6, prose(2, 60)), (7, prose(3, 60)), (7, prose(3, 60)), (8, "one"), (9, "Ünï çödé 日本 <|endoftext|> x\x00y"), (10, "don't  stop\n\nnow ")]
