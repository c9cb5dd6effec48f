"""op10: ids put together from chunks against the tokenizer on whole texts, and the memory that stays."""

import random

import numpy as np
import pyarrow as pa
import tokenizers

from waybill.llm import packing

PATH = packing.tokenizer_file("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "  Hello,  WORLD\n\tx ", "<|endoftext|> hi", "a<|startoftext|>b", "\u039f\u0394\u039f\u03a3 \u03a3", "\u0130stanbul",
    "a\x1cb c\x85d", "e\u0301 \u0301x", "x\xa0y\u3000z", "it's we'll 'S", "12\xbd _a_", "x" * 5000, "\U0001f44d\U0001f3fd ok", "\u1100 \u1161",
]


def test_ids_of_chunks_are_the_tokenizers(monkeypatch):
    """With so few chunks kept, most are met again and encoded anew."""
    monkeypatch.setattr(packing, "_KEPT", 500)
    monkeypatch.setattr(packing, "_BATCH", 64)
    monkeypatch.setitem(tokenizers.__dict__, "kept_ids", {})
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choices("aAbe\u0301 \u03a3's\xdf\n.,<|>1\xbd_\xa0\x85 ll", k=rnd.randint(0, 30))) for _ in range(2_000)]
    encode, whole = packing.encoder(PATH), tokenizers.Tokenizer.from_file(PATH)
    for _ in range(2):
        for text, ids in zip(texts, encode(pa.array(texts, pa.string())), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids
    assert len(tokenizers.kept_ids[PATH][0]) == 500


def test_what_a_worker_keeps_is_small(monkeypatch):
    monkeypatch.setitem(tokenizers.__dict__, "kept_ids", {})
    packing.encoder(PATH)(pa.array([" ".join(f"word{i}" for i in range(20_000))], pa.string()))
    assert sum(x.nbytes for x in tokenizers.kept_ids[PATH]) < 60 * 20_000
