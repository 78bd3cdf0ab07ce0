"""BPE, token files and packing against the libraries themselves."""

import hashlib
import random
import signal
import zlib

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

import odd
from loomtab.llm import ans, bpe, chunks, hashing, packing, queries  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables


def engine(path):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


@pytest.fixture(scope="module")
def multi(vocabulary):
    return vocabulary("byte_bpe_multi_50k.tiktoken")


def test_pattern_is_that_of_the_rank_files():
    import public_tokenizers

    assert public_tokenizers.PATTERN == bpe.PATTERN


def test_boundaries_and_merges_as_the_engine(multi):
    own, splitter, pieces = engine(multi), bpe.Splitter(bpe.code_classes()), bpe.Pieces(bpe.read_ranks(multi))
    r = random.Random(0)
    signs = ["'", "s", "t", "r", "e", "v", "l", "d", "m", " ", " ", "\n", "1", "²", "é", "!", "漢", "́", "\x1c", "𝔘", "'ll", "'re", "S"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(map(chr, [*range(0x0D7FF), *range(0xE000, 0x30000)])), "a" * 3000 + "xyz" * 700, "", "'s"]
    ids, offsets, bounds = bpe.encode_texts(texts, splitter, pieces)
    for i, text in enumerate(texts):
        mine = ids[bounds[i]:bounds[i + 1]].tolist()
        assert mine == own.encode_ordinary(text)
        ends = np.cumsum([len(own.decode_single_token_bytes(t)) for t in mine])
        assert offsets[bounds[i]:bounds[i + 1]].tolist() == [0, *ends[:-1].tolist()][:len(mine)]


def test_transition_functions_compose():
    to, _ = bpe.automaton()
    product, functions, number = bpe.monoid(to)
    for a in range(len(to)):
        for b in range(len(to)):
            assert functions[product[number[a], number[b]]].tolist() == [to[b][to[a][s]] for s in range(to.shape[1])]


def test_round_trip_of_odd_rows(spark, multi):
    df = odd.frame(spark)
    back = bpe.decode(bpe.encode(df, multi), multi)
    assert odd.plain((r[0], bytes(r[1]).decode()) for r in back.collect()) == odd.plain((i, t or "") for i, t in odd.rows())
    assert bpe.encode(df.limit(0), multi).count() == 0
    nulls = bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), multi).collect()
    assert bytes(nulls[0]["decoded"]) == b""


def test_op1_whole_table(spark, sf_dir, multi):
    own = engine(multi)
    got = {r["doc_id"]: r for r in QUERIES["op1_bpe_round_trip"](spark, sf_dir).collect()}
    for r in Tables(spark, sf_dir).documents.collect():
        ids = own.encode_ordinary(r["text"] or "")
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_as_the_library(vocabulary, name):
    library = Tokenizer.from_file(vocabulary(name))
    library.encode_special_tokens = True
    encoder = chunks.ChunkEncoder(vocabulary(name))
    r = random.Random(0)
    signs = ["'", "s", "t", "re", "ve", "l", " ", " ", "\n", "\t", "\r", "\x0b", "\x85", "　", "1", "²", "é", "!", ",", ".", "漢", "́", "\x1c", "𝔘", "'ll", "Σ", "İ", "<|endoftext|>", "\x01", "×"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(5000)] + [t or "" for t in odd.texts()] + ["ab, " * 400_000]
    for end in (None, 9):
        ids, bounds = encoder.encode(texts, end)
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids + ([] if end is None else [end])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_with_every_white_space(vocabulary, name):
    library = Tokenizer.from_file(vocabulary(name))
    encoder = chunks.ChunkEncoder(vocabulary(name))
    r = random.Random(0)
    white = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    texts = ["a \u00a0 \u00a0 b", *["".join(r.choices(["a", "é", ".", "漢", " ", " ", "\n", "\u00a0", "\u00a0", "\u200b", r.choice(white)], k=r.randint(0, 40))) for _ in range(5000)]]
    texts += ["a" + w + " " + w + " " + w + " b" for w in white] + ["ab\u00a0 \u00a0 " * 150_000]
    ids, bounds = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_as_in_a_plain_call(spark, vocabulary, tmp_path, name):
    library = Tokenizer.from_file(vocabulary(name))
    r = random.Random(0)
    signs = ["<|endoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|endof", "text|>", "|>", "<", " ", "  ", "\n", "\u00a0", "a", "B", "é", "Σ", ".", "'s", "1", "́", "\x01"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", *["".join(r.choices(signs, k=r.randint(0, 20))) for _ in range(1500)], "ab, <|endoftext|>" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    got = ans.token_files(df, str(tmp_path / "a"), vocabulary(name), 2).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == want
    found = {}
    for r in packing.token_pieces(df, vocabulary(name), 2).collect():
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == {i: len(w) for i, w in want.items()}


@pytest.fixture
def soon():
    """A call that never ends fails."""
    def stop(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(30)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


def test_more_new_slices_in_a_step_than_places(vocabulary, multi, soon):
    text = " ".join(f"{i:x}!" for i in range(3000))
    pieces, own = bpe.Pieces(bpe.read_ranks(multi)), engine(multi)
    pieces.known = hashing.Known(bits=6)
    splitter = bpe.Splitter(bpe.code_classes())
    for texts in (["some words"], [text], ["then others", text[:50]], [text]):
        ids, _, bounds = bpe.encode_texts(texts, splitter, pieces)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == own.encode_ordinary_batch(texts)
    encoder, library = chunks.ChunkEncoder(vocabulary("byte_bpe_50k.json")), Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    encoder.known = hashing.Known(bits=6)
    for texts in (["some words"], [text] * 3, ["then others", text[:50]], [text]):
        ids, bounds = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("signs", ["ab", "éè", "12", "!?"])
def test_slices_of_equal_polynomial_hash(vocabulary, multi, signs):
    texts = [t for n in (2048, 1024, 4096) for t in odd.twins(n, signs)] * 2
    own, splitter, pieces = engine(multi), bpe.Splitter(bpe.code_classes()), bpe.Pieces(bpe.read_ranks(multi))
    ids, _, bounds = bpe.encode_texts(texts, splitter, pieces)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == own.encode_ordinary_batch(texts)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder, library = chunks.ChunkEncoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
        ids, bounds = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_slices_of_every_length_keep_their_number():
    r = random.Random(2)
    words = [bytes(r.choices(b"ab\x00\xff", k=n)) for n in range(40) for _ in range(30)]
    known, numbers = hashing.Known(bits=5), {}
    for _ in range(3):
        drawn = r.choices(words, k=500)
        data = np.frombuffer(b"".join(drawn), np.uint8)
        ends = np.cumsum([len(w) for w in drawn])
        starts = ends - [len(w) for w in drawn]
        found = known.numbers(data, starts, ends, lambda fresh: known.add([[int(i)] for i in fresh]))
        for w, n in zip(drawn, found.tolist()):
            assert numbers.setdefault(w, n) == n
    assert len(set(numbers.values())) == len(numbers)


def test_blocks_round_trip_and_damage():
    rng = np.random.default_rng(0)
    blocks = [rng.zipf(1.3, n).clip(0, 49_000).astype(np.uint32) for n in (1, 5, 63, 64, 65, 8191, 8192, 8193, 40_000)] + [np.full(300, 7, np.uint32)]
    frequency = ans.scaled(np.bincount(np.concatenate(blocks), minlength=50_000))
    assert frequency.sum() == 1 << ans.BITS
    payloads = ans.encode_blocks(blocks, frequency)
    for a, b in zip(ans.decode_blocks(payloads, frequency), blocks):
        assert (a == b).all()
    assert (ans.decode_blocks(payloads[-2:-1], frequency)[0] == blocks[-2]).all()  # alone as well
    broken = bytearray(payloads[3])
    broken[-1] ^= 1
    with pytest.raises(ValueError):
        ans.decode_blocks([bytes(broken)], frequency)


def test_token_files_of_odd_rows(spark, vocabulary, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    got = ans.token_files(odd.frame(spark), str(tmp_path / "a"), path, 2).collect()
    want = {(i, t) for i, t in odd.rows()}
    assert len(got) == len(odd.rows())
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert odd.plain((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == odd.plain(
        (i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in odd.rows()) and want
    assert ans.token_files(odd.frame(spark).limit(0), str(tmp_path / "b"), path, 2).count() == 0


def test_best_fill_is_optimal():
    r = random.Random(1)
    for _ in range(200):
        counts = {r.randint(1, 30): r.randint(1, 4) for _ in range(r.randint(0, 6))}
        room = r.randint(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        fill = packing.best_fill(counts, room)
        assert all(k <= counts[n] for n, k in fill.items())
        assert sum(n * k for n, k in fill.items()) == max(s for s in sums if s <= room)


def packed(rows, capacity):
    """Padding of placed (length, sequence, offset); fails if a sequence has a gap."""
    padding, by = 0, {}
    for n, s, o in rows:
        by.setdefault(s, []).append((o, n))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert sorted(by) == list(range(len(by)))
    return padding


def test_packing_of_many_ties(spark):
    lengths = [random.Random(5).choice([1, 7, 7, 7, 7, 300, 512, 700, 1024]) for _ in range(3000)]
    df = spark.createDataFrame([(None if i % 9 == 0 else i // 2, n, "x") for i, n in enumerate(lengths)], "doc_id long, length int, rank string").repartition(5)
    got = packing.pack(df).collect()
    assert odd.plain((r["doc_id"], r["length"]) for r in got) == odd.plain((None if i % 9 == 0 else i // 2, n) for i, n in enumerate(lengths))
    assert packed([(r["length"], r["sequence_id"], r["offset"]) for r in got], 1024) < 1024 + sum(lengths) * 0.12
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df.limit(1).withColumn("length", df["length"] + 2000))


def test_op8_whole_table(spark, sf_dir, vocabulary):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    got = QUERIES["op8_packed_sequences"](spark, sf_dir).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    total = 0
    for d in Tables(spark, sf_dir).documents.collect():
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by.pop(d["doc_id"]), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    assert not by
    assert packed([(r["length"], r["sequence_id"], r["offset"]) for r in got], 1024) < 0.02 * total + 1024
