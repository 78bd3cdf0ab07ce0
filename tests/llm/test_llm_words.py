"""BPE with word ends against the library itself."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import odd
from loomtab.llm import queries, wordbpe  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables

SIGNS = ["'", "s", "t", "re", "ve", "l", " ", " ", "\n", "\t", "\r", "\x0b", "\x85", "\u00a0", "\u3000", "1", "\u00b2", "\u00e9", "!", ",", ".",
         "\u6f22", "\u0301", "\x1c", "\U0001d518", "'ll", "'S", "\u03a3", "\u0130", "<|endoftext|>", "<|startoftext|>", "<|", "\x01", "\u00d7", "The", "ing", "\u0378"]


@pytest.fixture(scope="module")
def path(vocabulary):
    return vocabulary("word_bpe_49k.json")


def test_ids_as_the_library(path):
    library, encoder = Tokenizer.from_file(path), wordbpe.WordEncoder(path)
    r = random.Random(0)
    texts = ["".join(r.choices(SIGNS, k=r.randint(0, 40))) for _ in range(4000)] + [t or "" for t in odd.texts()] + [*odd.twins()] * 2
    texts += ["".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)])), "a" * 63, "a" * 64, "a" * 65, "ab" * 3000 + "\u00e9" * 500, "ab, " * 400_000]
    ids, bounds = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def plain_merge(word, ranks, made):
    """Joins the leftmost pair of lowest rank, one at a time."""
    word = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        rank, i = min(found)
        word[i:i + 2] = [made[rank]]


def test_rows_and_heap_merge_alike(path):
    merges = wordbpe.Merges(path)
    ranks = {(int(k) // merges.size, int(k) % merges.size): int(r) for k, r in zip(merges.keys, merges.ranks)}
    r = random.Random(1)
    words = ["".join(r.choices("abeinrst" if i % 2 else "aab", k=r.randint(1, 64))).encode() for i in range(400)]
    got = merges.merge(words)
    for word, ids in zip(words, got):
        want = plain_merge(merges.parts(word).tolist(), ranks, merges.made)
        assert ids == want == merges.merge_long(merges.parts(word))


def test_round_trip_of_odd_rows(spark, path):
    library, df = Tokenizer.from_file(path), odd.frame(spark)
    ids = wordbpe.encode(df, path)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in odd.rows()]
    assert odd.plain((r[0], r[1]) for r in ids.collect()) == odd.plain(want)
    back = wordbpe.decode(ids, path).collect()
    assert odd.plain(back) == odd.plain((i, library.decode(w, skip_special_tokens=False)) for i, w in want)
    assert wordbpe.encode(df.limit(0), path).count() == 0 and wordbpe.decode(ids.limit(0), path).count() == 0
    nulls = wordbpe.decode(spark.createDataFrame([(1, None), (2, [49407, 320])], "doc_id long, ids array<int>"), path).collect()
    assert odd.plain(nulls) == [(1, ""), (2, library.decode([49407, 320], skip_special_tokens=False))]


def test_other_vocabularies_are_refused(vocabulary):
    with pytest.raises((ValueError, KeyError, TypeError)):
        wordbpe.Merges(vocabulary("byte_bpe_50k.json"))


def test_op13_whole_table(spark, sf_dir, path):
    library = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in QUERIES["op13_word_bpe"](spark, sf_dir).collect()}
    rows = Tables(spark, sf_dir).documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        found = got[r["doc_id"]]
        assert (found["n_tokens"], found["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert found["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert np.mean([r["n_tokens"] for r in got.values()]) > 1
