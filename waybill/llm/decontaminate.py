"""Benchmark decontamination with an FM-index of each shard of the training text.

A shard is some million words of whole documents inside one task. Its words are numbered, its
suffixes sorted, and its Burrows-Wheeler transform kept in a wavelet matrix of packed bits. All
benchmark windows (runs of ten words; a shorter item is one window) are sought together by backward
search, a step being two ranks for each window; the occurrences found are located by walking back to
sampled suffix positions, and their word spans are merged in each document. Documents are not
shuffled. The windows are broadcast in blocks of bounded size, each block a pass of its own, so a
benchmark of any size can be sought.

Words are lower-case runs of ASCII letters and digits and of all other non-ASCII characters.

Cases: null and empty texts have no words and no hits; null, empty and word-less items are sought
nowhere; an item given twice counts as its item_ids; a null item_id is left out of the list but its
windows hit. Repeated rows are judged each. Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.arrays import Words, byte_values, column_of, cut_out, gathered, merged, non_alphanumeric
from waybill.sources.scratch import stored

WINDOW = 10
SAMPLED = 8
_SHARD_BYTES = 4 << 20


class WaveletMatrix:
    """Ranks of symbols in a sequence: a row of packed bits for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.n = bits, len(symbols)
        self.rows, self.sums, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level & 1).astype(bool)
            packed = np.zeros(self.n // 64 + 1, np.uint64)
            raw = np.packbits(ones, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            sums = np.zeros(len(packed) + 1, np.int32)
            np.cumsum(np.bitwise_count(packed), out=sums[1:])
            self.rows.append(packed)
            self.sums.append(sums)
            self.zeros.append(self.n - int(sums[-1]))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _ones(self, row: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[row][word] + np.bitwise_count(self.rows[row][word] & below)

    def rank(self, symbol: np.ndarray, at: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """How often each symbol stands before each position."""
        low = np.zeros(len(at), np.int64) if start is None else start
        for row in range(self.bits):
            one = (symbol >> (self.bits - 1 - row) & 1).astype(bool)
            a, b = self._ones(row, low), self._ones(row, at)
            low = np.where(one, self.zeros[row] + a, low - a)
            at = np.where(one, self.zeros[row] + b, at - b)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before it."""
        low, symbol = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for row in range(self.bits):
            one = (self.rows[row][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            a, b = self._ones(row, low), self._ones(row, at)
            symbol = symbol << 1 | one
            low = np.where(one, self.zeros[row] + a, low - a)
            at = np.where(one, self.zeros[row] + b, at - b)
        return symbol, at - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    base = int(symbols.max()) + 2
    padded = np.concatenate([symbols + 1, np.zeros(2, np.int64)])
    key = (padded[:n] * base + padded[1 : n + 1]) if base < 2**31 else padded[:n]
    done = 2 if base < 2**31 else 1
    order = np.argsort(key)
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]  # rank of a suffix: where its group starts
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = group, -1
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied):
        held = order[tied]
        key = rank[held] * (n + 1) + rank[np.minimum(held + done, n)] + 1
        by = np.argsort(key)
        held, key = held[by], key[by]
        order[tied] = held
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[held] = tied[new][np.cumsum(new) - 1]
        tied = tied[~(new & np.append(new[1:], True))]
        done *= 2
    return order


class FMIndex:
    """Counts and places of word sequences in a shard."""

    def __init__(self, symbols: np.ndarray, firsts: np.ndarray, alphabet: int) -> None:
        """symbols: 1 and above; firsts: where documents start, kept as samples so that no walk leaves one."""
        n = len(symbols)
        text = np.append(symbols, 0)
        order = suffix_array(text)
        last = text[order - 1]  # of the suffix at 0 the closing 0
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet + 1))]).astype(np.int64)
        self.tree = WaveletMatrix(last, max(1, int(alphabet).bit_length()))
        kept = order % SAMPLED == 0
        start = np.zeros(n + 1, bool)
        start[firsts] = True
        kept |= start[order]
        self.kept = np.flatnonzero(kept)
        self.places = order[self.kept]
        self.n = n + 1

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern; a row's symbols stand at its end, 0 before them."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1]):
            live = np.flatnonzero((step < sizes) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, patterns.shape[1] - 1 - step]
            a = self.less[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.less[symbol] + self.tree.rank(symbol, high[live])
            low[live] = a
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of suffixes given by their rank."""
        out, walked = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            sample = np.minimum(np.searchsorted(self.kept, at), len(self.kept) - 1)
            hit = self.kept[sample] == at
            out[live[hit]] = self.places[sample[hit]] + walked[live[hit]]
            live, at = live[~hit], at[~hit]
            symbol, rank = self.tree.symbol_and_rank(at)
            at = self.less[symbol] + rank
            walked[live] += 1
        return out


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of every item, (item_id, words as 64-bit hashes); derived where the items are."""
    parting, values = non_alphanumeric(), byte_values(lower=True)

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(frames, "text", 1 << 20):
            words = Words(column_of(rows, "text"), parting)
            hashes = words.hashes(values).view(np.int64)
            ids, out = column_of(rows, "item_id").to_pylist(), ([], [])
            for i, item in enumerate(ids):
                own = hashes[words.first[i] : words.first[i + 1]]
                for at in range(max(1, len(own) - WINDOW + 1) if len(own) else 0):
                    out[0].append(item)
                    out[1].append(own[at : at + WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], names=["item_id", "words"])

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, "item_id string, words binary")


def _sought(index: FMIndex, known: np.ndarray, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every occurrence in the shard; known: its words' hashes in order."""
    at = np.minimum(np.searchsorted(known, windows), len(known) - 1)
    symbols = np.where(known[at] == windows, at + 1, 0)
    inside = np.arange(WINDOW) >= WINDOW - sizes[:, None]
    there = np.flatnonzero(((symbols > 0) | ~inside).all(axis=1))  # a word that the shard lacks ends it
    low, high = index.search(symbols[there], sizes[there])
    n = high - low
    rows = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(there, n), index.locate(rows)


def spans_of(
    documents: DataFrame, benchmark: DataFrame, block_windows: int = 500_000, text: str = "text"
) -> DataFrame:
    """The rows with n_words, spans (merged word ranges that benchmark windows cover) and items (ids found).

    At most ``block_windows`` distinct windows (below 100 MB) are broadcast at a time; a benchmark with
    more is sought in so many passes, whose spans and items are put together row by row.
    """
    spark = documents.sparkSession
    # Only item ids are listed by window; the windows are numbered by a hash so that blocks are even.
    windows = stored(
        item_windows(benchmark).groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items")), "windows"
    )
    blocks = max(1, -(-windows.count() // block_windows))
    parting, values = non_alphanumeric(), byte_values(lower=True)
    kept = [name for name in documents.columns if name.lower() not in ("n_words", "spans", "items")]
    own = T.StructType([
        *(field for field in documents.schema if field.name in kept), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ])
    out = documents.select(*(F.col(f"`{name}`") for name in kept)).withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<low: bigint, high: bigint>>"), "items": F.array().cast("array<string>"),
    })
    for block in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).toPandas()
        sizes = np.array([len(x) // 8 for x in part["words"]], np.int64)
        table = np.zeros((len(part), WINDOW), np.uint64)
        for i, x in enumerate(part["words"]):
            table[i, WINDOW - sizes[i] :] = np.frombuffer(x, np.uint64)
        shipped = spark.sparkContext.broadcast((table, sizes, [list(x) for x in part["items"]]))

        def found(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            sought, lengths, items = shipped.value
            for rows in gathered(batches, text, _SHARD_BYTES):
                words = Words(column_of(rows, text), parting)
                n_rows = rows.num_rows
                spans = rows.column("spans").to_pylist()
                seen = [set(x) for x in rows.column("items").to_pylist()]
                if len(words) and len(sought):
                    known, symbols = np.unique(words.hashes(values), return_inverse=True)
                    # Each document is closed by a symbol above all words, so no occurrence runs over its end.
                    ends = words.first[1:] + np.arange(n_rows)
                    text_of = np.full(len(words) + n_rows, len(known) + 1, np.int64)
                    at = np.arange(len(words)) + words.row
                    text_of[at] = symbols + 1
                    firsts = words.first[:-1] + np.arange(n_rows)
                    index = FMIndex(text_of, firsts, len(known) + 2)
                    window, place = _sought(index, known, sought, lengths)
                    row = np.searchsorted(ends, place)
                    order = np.lexsort((place, row))
                    low, size, row, window = (place - firsts[row])[order], lengths[window][order], row[order], window[order]
                    for r in np.unique(row):
                        a, b = np.searchsorted(row, [r, r + 1])
                        pairs = [*((x["low"], x["high"]) for x in spans[r]), *zip(low[a:b].tolist(), (low[a:b] + size[a:b]).tolist(), strict=True)]
                        spans[r] = [{"low": x, "high": y} for x, y in merged(pairs)]
                        for w in np.unique(window[a:b]):
                            seen[r].update(items[w])
                fields = [rows.column(name) for name in kept]
                yield from pa.table(
                    [*fields, pa.array(np.diff(words.first)), pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), pa.array([sorted(x) for x in seen], pa.list_(pa.string()))],
                    names=[*kept, "n_words", "spans", "items"],
                ).to_batches()

        out = out.mapInArrow(found, own)
    return out


def without_hits(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the words that benchmark windows cover cut out of their texts.

    A span goes with the characters between its words; what stands before and after it stays.
    """
    own = documents.schema
    parting = non_alphanumeric()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in gathered(iter([batch]), text, _SHARD_BYTES):
                spans = [[(x["low"], x["high"]) for x in own_spans] for own_spans in rows.column("spans").to_pylist()]
                column = cut_out(column_of(rows, text), spans, parting)
                yield from pa.table([column if name == text else rows.column(name) for name in own.names], names=own.names).to_batches()

    return spans_of(documents, benchmark, text=text).mapInArrow(cut, own)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = spans_of(documents.select("doc_id", "text"), benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["high"] - x["low"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
