import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from lexloom.llm import bpe
from tests.llm.cases import frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_on_odd_texts():
    own, lib = bpe.codec(PATH, public_tokenizers.PATTERN), library()
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "a", "é", "日", "١", "!", "'s", "'ll", "don't", "12", "\U0001f600", "\u0301", "x" * 30, "aaaa", "Word,", "ÿ", "×"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        ids = own.encode(text)
        assert ids == lib.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_long_pieces_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own, lib = bpe.ByteBpe(PATH, public_tokenizers.PATTERN), library()
    for text in ["x" * 20_000, "ab" * 5000, "é" * 3000, *[r[1] or "" for r in rows()]]:
        assert own.encode(text) == lib.encode_ordinary(text)


def test_digests_encode_and_decode(spark):
    lib, args = library(), (PATH, public_tokenizers.PATTERN)
    texts = {r[0]: r[1] or "" for r in rows()}
    out = bpe.bpe_round_trip(frame(spark), *args).collect()
    assert len(out) == len(rows())
    for r in out:
        ids = lib.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    both = bpe.bpe_decode(bpe.bpe_encode(frame(spark), *args), *args).collect()
    assert all(bytes(r.decoded) == texts[r.doc_id].encode() for r in both)
    assert bpe.bpe_round_trip(frame(spark, []), *args).count() == 0
