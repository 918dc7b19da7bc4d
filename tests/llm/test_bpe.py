import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from voxelflow.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, P.PATTERN)


def test_hash_is_minimal_and_perfect(codec):
    assert sorted(map(codec.hash.slot, codec.token.values())) == list(range(len(codec.token)))
    assert all(codec.rank(t) == r for r, t in codec.token.items())
    assert codec.rank(b"not in any vocabulary, surely") == -1


def test_ids_equal_the_library(codec, reference):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "a", "I'm", "'s", "'LL", "été", "日本語", "12", "٣",
             "!?", "--", "​", "🙂", "é", "\r\n", "zzzzqqq", "x" * 300, "<|endoftext|>"]
    for _ in range(5000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 12)))
        assert codec.encode(s) == reference.encode_ordinary(s), repr(s)
        assert codec.decode(codec.encode(s)) == s.encode()


def test_long_pretoken_and_bounded_tables(codec, reference, monkeypatch):
    s = "ab" * 20_000
    assert codec.encode(s) == reference.encode_ordinary(s)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 2)
    monkeypatch.setattr(bpe, "KEPT_TOKENS", 2)
    t = "one two three, four five six one two"
    assert codec.encode(t) == reference.encode_ordinary(t)


def test_rows(spark, odd_docs, no_docs, reference):
    rows = odd_docs.select("doc_id", "text").collect()
    got = bpe.round_trip(odd_docs, PATH, P.PATTERN).collect()
    want = sorted((str(r.doc_id), len(i := reference.encode_ordinary(r.text or "")),
                   hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    enc = bpe.encode(odd_docs, PATH, P.PATTERN)
    back = {(r.doc_id, bytes(r.bytes)) for r in bpe.decode(enc, PATH, P.PATTERN).collect()}
    assert back == {(r.doc_id, (r.text or "").encode()) for r in rows}
    assert bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0
