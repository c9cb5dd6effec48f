"""op11: the two-tier encoder against tiktoken itself, and decoding as a round trip."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from waybill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", "  hello  world\n\n", "don't 'S 123456 ü漢字  x\t\r\n", "a" * 5000, "<|endoftext|> again", "%%% &&& ###",
         "Ontiontion thhaheti    zzzzqqqq" * 50, "emoji 🙂🙂 mixed123abc"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("ref", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(3000)] + [bytes([i]) for i in range(256)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot_key) == list(range(len(keys)))  # n keys, n slots, all used
    assert all(table.index(k) == i for i, k in enumerate(keys))


def test_encoder_equals_tiktoken(reference):
    vocab = bpe.vocabulary(PATH)
    cut = regex.compile(public_tokenizers.PATTERN)
    for text in TEXTS:
        assert bpe.encode_text(text, vocab, cut) == reference.encode_ordinary(text or "")
    assert bpe.encode_texts(TEXTS, vocab, cut) == [reference.encode_ordinary(t or "") for t in TEXTS]
    assert vocab.merged(b" thhaheti") == reference.encode_ordinary(" thhaheti")


class Counted:
    """A pattern that counts the characters it is asked to match."""

    def __init__(self, pattern):
        self.compiled, self.pattern, self.flags, self.chars = regex.compile(pattern), pattern, 0, 0

    def findall(self, text):
        self.chars += len(text)
        return self.compiled.findall(text)


def test_repeated_chunks_are_matched_once(reference):
    vocab = bpe.vocabulary(PATH)
    texts = ["thhaheti, onttsha. " * 500, "onttsha. thhaheti," * 500, None]
    cut = Counted(public_tokenizers.PATTERN)
    assert bpe.encode_texts(texts, vocab, cut) == [reference.encode_ordinary(t or "") for t in texts]
    assert cut.chars < sum(len(t or "") for t in texts) // 10


def test_merging_asks_no_hash(reference, monkeypatch):
    vocab = bpe.Vocabulary(PATH)
    monkeypatch.setattr(vocab, "fast_rank", None)  # ranks of pairs are in the table already
    for piece in (" thhaheti", "z" * 300, "\u6f22\u5b57\u00fc", "q"):
        assert vocab.merged(piece.encode()) == reference.encode_ordinary(piece)


def test_chunks_of_odd_white_space(reference):
    vocab = bpe.vocabulary(PATH)
    spaces = "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000"
    others = "ab's1.-\x00\x7f\xa9\u00e9\u1681\u2014\u200b\u2060\u3001\u6f22\u0301\uff11\U0001f642"
    pick = random.Random(7)
    texts = ["".join(pick.choice([" ", pick.choice(spaces), pick.choice(others)]) for _ in range(pick.randrange(12))) for _ in range(8000)]
    for pattern in (public_tokenizers.PATTERN, r"\w+|\W"):
        cut = regex.compile(pattern)
        assert bpe.encode_texts(texts, vocab, cut) == [bpe.encode_text(t, vocab, cut) for t in texts]
    assert bpe.encode_texts(texts, vocab, regex.compile(public_tokenizers.PATTERN)) == [reference.encode_ordinary(t) for t in texts]


def test_encode_decode_frames(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, TEXTS[3], "repeat")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = bpe.decode(bpe.encode(frame, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        want = reference.encode_ordinary(r.text or "")
        assert r.ids == want
        assert bytes(r.decoded) == (r.text or "").encode("utf-8")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_query_digests(spark, tmp_path, reference):
    import pandas as pd

    from waybill.llm import queries

    texts = ["", None, "plain words here", "x" * 3000]
    pd.DataFrame({"doc_id": range(len(texts)), "text": texts}).to_parquet(tmp_path / "documents.parquet")
    got = {r.doc_id: r for r in queries.op11_bpe(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
