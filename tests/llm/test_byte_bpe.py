import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from chronicell.llm import byte_bpe as B

PATH = public_tokenizers.path(B.RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(4)
    pick = [lambda: rng.randrange(32, 127), lambda: rng.randrange(9, 33), lambda: rng.randrange(0x80, 0x300), lambda: rng.randrange(0x300, 0xD7FF), lambda: rng.randrange(0x10000, 0x10FFFF), lambda: rng.choice([0x1C, 0x85, 0xA0, 0x2028])]
    out = ["".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(60))) for _ in range(300)]
    return [*out, "", "a" * 3000, "日本語" * 900, " " * 2000, "\n\n  x", "don't I'll WE'RE", "ab" * 40, "thethethethe" * 30, "a\U00016eb4b \u0c5cx 1\U00011de0", "\U0001246f9"]


def test_like_the_library_and_back(spark, docs_of, library):
    rows = list(enumerate(texts())) + [(1000, None)]
    ids = B.encode_documents(docs_of(rows), PATH)
    assert ids.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    both = B.decode_documents(ids, PATH)
    assert sorted(map(str, both.collect())) == sorted(map(str, B.encode_and_decode(docs_of(rows), PATH).collect()))
    for r in both.collect():
        text = r.text or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r.ids)).hexdigest()


def test_query_columns_and_clashing_names(spark, docs_of, tmp_path, library):
    docs_of([(1, "hello world"), (1, "hello world"), (None, None)]).withColumnsRenamed({"lang": "ids", "source": "decoded"}).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.op2_byte_bpe(spark, str(tmp_path)).collect()}
    ids = library.encode_ordinary("hello world")
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {(1, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(b"hello world").hexdigest()), (None, 0, empty, empty)}


def test_forgetting_does_not_change_ids(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_PIECES", 5)
    own = B.Encoder(PATH, public_tokenizers.PATTERN)
    for t in texts()[:60]:
        assert own.encode([t])[0].tolist() == library.encode_ordinary(t)


def test_one_and_many_agree():
    vocab, rng = B.vocabulary(PATH), random.Random(2)
    pieces = [bytes(rng.choice(b"thean iours") for _ in range(rng.randint(2, 64))) for _ in range(300)]
    ids, counts = B.merge_many(pieces, vocab, 64)
    at = 0
    for p, n in zip(pieces, counts):
        assert ids[at : at + n].tolist() == B.merge_one(p, vocab)
        at += n


def test_every_range_of_younger_letters_is_that_of_the_library(library):
    """At both ends of each range, just outside of it, and at random places, alone and beside letters and digits."""
    rng = random.Random(9)
    points = {c for a, b in B._YOUNGER for c in (a - 1, a, (a + b) // 2, b, b + 1)} | {rng.randrange(0x80, 0x110000) for _ in range(3000)}
    texts = [f"a{c}b1{c} {c}{c}x" for c in (chr(c) for c in sorted(points) if not 0xD800 <= c <= 0xDFFF)]
    own = B.Encoder(PATH, public_tokenizers.PATTERN)
    ids, counts = own.encode(texts)
    at = 0
    for t, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == library.encode_ordinary(t), [hex(ord(c)) for c in t]
        at += n


def test_long_pieces_do_not_stay(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_CHARS", 1000)
    own = B.Encoder(PATH, public_tokenizers.PATTERN)
    for k in range(20):
        text = "x" * (900 + k)
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text) and own.chars < 2000
