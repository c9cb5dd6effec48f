"""Hashes of words: their values, and memory that does not grow with the texts."""

import tracemalloc

import numpy as np
import pyarrow as pa

from waybill.llm import arrays


def plain(word: str, values: np.ndarray) -> int:
    total, power = 0, 1
    for byte in word.encode():
        total += int(values[byte]) * power
        power = power * arrays._BASE % 2**64
    return int(arrays.mixed(np.array([total % 2**64], np.uint64))[0])


def test_hashes_are_those_of_each_word_alone():
    texts = [" ab cd\tab ", None, "", "x" * 200_000 + " ab", "ä " * 70_000, "end"]  # a word and a text longer than a block
    words, values = arrays.Words(pa.array(texts), arrays.spaces()), arrays.byte_values(lower=False)
    got = words.hashes(values).tolist()
    flat = [w for t in texts for w in (t or "").split()]
    known = {w: plain(w, values) for w in set(flat)}
    assert got == [known[w] for w in flat]
    assert not len(arrays.Words(pa.array([None, " "]), arrays.spaces()).hashes(values))


def test_hashes_need_no_table_as_long_as_the_texts(monkeypatch):
    monkeypatch.setattr(arrays, "_POWERS", [])
    words, values = arrays.Words(pa.array(["some words " * 100] * 4_000), arrays.spaces()), arrays.byte_values(lower=False)
    tracemalloc.start()
    words.hashes(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 8 * len(words)  # 4.4 MB of text; sums and powers of all bytes would be 140 MB


def test_memory_is_given_back_after_the_last_table(monkeypatch):
    told = []
    monkeypatch.setattr(arrays, "released", lambda: told.append(True), raising=False)
    batches = [pa.RecordBatch.from_pydict({"text": ["some words"] * 10})] * 3
    tables = []
    for rows in arrays.gathered(iter(batches), "text", 150):
        assert not told
        tables.append(rows.num_rows)
    assert sum(tables) == 30 and told == [True]
