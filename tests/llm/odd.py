"""Documents that are hard to get right, and small helpers of these tests."""

import random

WORDS = ["the", "of", "Ander", "é", "l'ête", "don't", "x1", "12", "!?", "  ", "\n", "漢字", "", "a.", "b,", "'s", "\t"]


def texts(seed=3, n=60):
    r = random.Random(seed)
    made = [" ".join(r.choices(WORDS, k=r.randint(0, 40))) for _ in range(n)]
    return [*made, "", " ", "\n", "\n\n", None, "a" * 5000, "word " * 3000, "x", "é" * 40, "tail \n", *made[:5]]


def twins(n=2048, signs="ab"):
    """Two different words whose polynomial hashes modulo 2**64 are equal for every odd base."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join(signs[b] for b in bits), "".join(signs[1 - b] for b in bits)


def rows(seed=3, n=60):
    """(doc_id, text): NULL ids, a repeated id with other texts, and rows that repeat as a whole."""
    made = [(i, t) for i, t in enumerate(texts(seed, n))]
    return [*made, (None, "no id"), (None, None), (7, "same id"), (7, "same id"), (7, made[3][1]), made[4]]


def frame(spark, data=None):
    """With extra columns whose names clash with those inside the operators."""
    data = rows() if data is None else data
    schema = "doc_id long, text string, key string, row string, kept string, digest long, part int, n_tokens long, ids string, fingerprint string"
    return spark.createDataFrame([(i, t, None, "r", "k", 1, None, 5, "i", "f") for i, t in data], schema).repartition(3)


def plain(rows):
    """Rows in an order of their own, binaries as bytes."""
    return sorted((tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r) for r in rows), key=str)
