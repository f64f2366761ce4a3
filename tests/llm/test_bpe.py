"""Operator 9 against the tokeniser library it must agree with."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from meeple.llm import bpe


@pytest.fixture(scope="module")
def codec():
    with open(bpe.default_ranks(), "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_match_the_library(codec, library):
    rng = random.Random(1)
    letters = " \n\t 'strevmldaZé中9½.!,' 　\0\U0001f600́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "   ", " \n", "a" * 5000, "ab'" * 400, "é" * 3000 + " " * 500, "x's 're 'll''s I'm we'd"]
    assert codec.encode(texts) == [library.encode_ordinary(t) for t in texts]


def test_decoding_and_offsets(codec):
    for text in ["", "déjà vu", "日本 \n x"]:
        (ids,) = codec.encode([text])
        assert codec.decode(ids) == text.encode()
        offsets = codec.offsets(ids)
        assert offsets[0] == 0 and offsets[-1] == len(text.encode())


def test_every_code_point_is_classed_as_in_the_library(codec, library):
    """Each code point between a letter, a digit, a mark and a blank."""
    for plane in range(0, 0x110000, 0x10000):
        points = [c for c in range(plane, plane + 0x10000) if not 0xD800 <= c < 0xE000]
        texts = ["".join(f"x{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
        for text, ids in zip(texts, codec.encode(texts)):
            assert ids == library.encode_ordinary(text), hex(ord(text[1]))


def test_a_full_cache_changes_nothing(library):
    with open(bpe.default_ranks(), "rb") as f:
        small = bpe.Codec(f.read(), cache_entries=50)
    rng = random.Random(2)
    for _ in range(20):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
        assert small.encode([text, text]) == [library.encode_ordinary(text)] * 2
        assert len(small._young) <= 50 + 120 and len(small._old) <= 50 + 120


@pytest.mark.parametrize("hashes", [lambda s, e: s * 0, lambda s, e: (e - s) % 3, lambda s, e: e - s])
def test_equal_hashes_of_different_pieces(library, hashes, monkeypatch):
    class Poor:
        def __init__(self, codes):
            pass

        def __call__(self, starts, ends):
            return hashes(starts, ends).astype("uint64")

    monkeypatch.setattr(bpe, "SpanHasher", Poor)
    with open(bpe.default_ranks(), "rb") as f:
        poor = bpe.Codec(f.read(), cache_entries=40)
    texts = ["the cat sat on the mat's end, in 1999", "Ünï 中文 zzzqqq the the zqzqz", "", "end in the cat zqzqz"]
    for _ in range(3):
        assert poor.encode(texts) == [library.encode_ordinary(t) for t in texts]


def test_digests_of_many_texts_equal_the_ids(codec, library):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "Γάμμα", "", "x" * 60, "7"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += ["", "a"]
    n, ids, decoded = codec.digests(texts)
    for k, text in enumerate(texts):
        want = library.encode_ordinary(text)
        assert n[k] == len(want)
        assert ids[k] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert decoded[k] == hashlib.sha256(text.encode()).hexdigest()


def test_query(docs, library):
    rows = [(1, "Hello world's end"), (2, None), (3, ""), (3, ""), (None, "a b")]
    got = sorted(bpe.op9_bpe(docs(rows)).collect(), key=str)
    assert len(got) == 5
    want = ",".join(map(str, library.encode_ordinary("Hello world's end")))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["ids_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert by_id[1]["decoded_sha256"] == hashlib.sha256(b"Hello world's end").hexdigest()
    assert by_id[2]["n_tokens"] == 0 and by_id[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.op9_bpe(docs([])).count() == 0


def test_encode_then_decode_frames(docs):
    encoded = bpe.encode(docs([(1, "one two"), (2, None)]))
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(encoded).collect()}
    assert decoded == {1: b"one two", 2: b""}
