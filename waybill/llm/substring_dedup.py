"""Removal of word windows that occur more than once in the corpus, behind a count-min sketch.

1. Each task counts seeds in a sketch of two rows of 2^31 cells, kept as sorted cell numbers: a
   window's seed is the least hash of its runs of eight words, so the windows of a text have about a
   fourteenth as many seeds as there are words. Equal windows have equal seeds at different places,
   so a seed's count is never below the count of a window that has it, and a cell's never below the
   seed's. The tasks' sketches are added up by ranges of cells; which cells reach two is kept as a
   bitmap, folded to sixteen bits a reached cell and at most ``most_bits`` (folding only raises
   estimates). Its size is checked that way before it is broadcast.
2. A second pass takes the windows whose estimate is at least two, and only those, as 96-bit digests.
   A task keeps one entry for equal windows of its own (they are repeated for certain), so a window
   that occurs everywhere is one entry a task; entries meet by seed and are grouped exactly by digest.
3. Ranges of repeated windows are joined to their documents and cut out.

No window is lost: whatever the sketch overestimates is only grouped in vain.

Cases: null and empty texts, and texts of fewer words than a window, lose nothing. Repeated rows are
occurrences like any others: both lose all of a text of at least a window's length. A window that
overlaps an equal one in the same text counts as repeated. Rows need no unique doc_id; extra columns
stay, columns that begin with ``_sd_`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.arrays import Words, byte_values, column_of, cut_out, gathered, merged, mixed, rolling, sliding, spaces
from waybill.sources.scratch import stored

WINDOW = 35
SEED = 8
CELLS = 31
_SLICES = 9  # bits of a cell that number its range
_CHUNK = 3 << 20
_SEED_BASE, _DIGEST_BASES = 0xD6E8FEB86659FD93, (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)
_ENTRY = np.dtype([("digest", "<u8"), ("more", "<u4"), ("doc", "<u4"), ("at", "<u4")])
_KEY = np.dtype([("k1", "<i8"), ("k2", "<i4")])
_MANY = 0xFFFFFFFF


class Windows:
    """The windows of some texts: their seeds, which of them lie within one text, their digests."""

    def __init__(self, column: pa.Array, width: int) -> None:
        self.words = Words(column, spaces())
        self.width = width
        self.hashes = self.words.hashes(byte_values(lower=False))
        self.n = max(0, len(self.words) - width + 1)
        self.seeds = mixed(rolling(self.hashes, SEED, _SEED_BASE))
        row = self.words.row
        self.valid = row[: self.n] == row[width - 1 :] if self.n else np.zeros(0, bool)
        self.seed = sliding(self.seeds, width - SEED + 1, np.minimum) if self.n else np.zeros(0, np.uint64)

    def occurrences(self) -> np.ndarray:
        """Seeds of the windows, once for each place in the text."""
        if not self.n:
            return np.zeros(0, np.uint64)
        pad = np.zeros(self.width - SEED, np.uint64)
        best = sliding(np.concatenate([pad, np.where(self.valid, self.seed, np.uint64(0)), pad]), self.width - SEED + 1, np.maximum)
        return self.seeds[(best == self.seeds) & (self.seeds > 0)]

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = (rolling(self.hashes, self.width, base)[at] for base in _DIGEST_BASES)
        return mixed(first), (mixed(second) >> np.uint64(32)).astype(np.uint32)


def cells(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A seed's cell in either row of the sketch."""
    shift = np.uint64(64 - CELLS)
    return (seeds * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.uint32), (mixed(seeds ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> shift).astype(np.uint32)


def sketch(documents: DataFrame, text: str, width: int, most_bits: int) -> tuple[int, list[np.ndarray]]:
    """Bits (as a power of two) and the two bitmaps of cells that count two or more."""
    spark = documents.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, text, _CHUNK):
            seeds = Windows(column_of(rows, text), width).occurrences()
            if not len(seeds):
                continue
            out = ([], [], [])
            for number, own in enumerate(cells(seeds)):
                cell, n = np.unique(own, return_counts=True)
                bounds = np.searchsorted(cell >> (CELLS - _SLICES), np.arange((1 << _SLICES) + 1))
                for s in np.flatnonzero(np.diff(bounds)):
                    part = slice(bounds[s], bounds[s + 1])
                    out[0].append((number << _SLICES) + int(s))
                    out[1].append(np.diff(cell[part], prepend=np.uint32(0)).astype("<u4").tobytes())
                    out[2].append(np.packbits(n[part] > 1).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["range", "cells", "more"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of each range, one range after another."""
        now, total, found = None, np.zeros(1 << (CELLS - _SLICES), np.uint8), []

        def reached() -> pa.RecordBatch:
            twice = np.unique(np.concatenate(found)).astype("<u4")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(twice)], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["range", "n", "cells"])

        for batch in batches:
            for number, packed, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number != now:
                    if now is not None:
                        yield reached()
                        total[:] = 0
                    now, found = number, []
                cell = np.cumsum(np.frombuffer(packed, "<u4"), dtype=np.uint32) & np.uint32((1 << (CELLS - _SLICES)) - 1)
                sums = total[cell] + np.unpackbits(np.frombuffer(more, np.uint8), count=len(cell)) + 1
                total[cell] = np.minimum(sums, 2)
                found.append(cell[(sums > 1)])
        if now is not None:
            yield reached()

    reached = stored(
        documents.select(F.col(f"`{text}`").cast("string").alias(text)).mapInArrow(counted, "range int, cells binary, more binary")
        .repartition("range").sortWithinPartitions("range").mapInArrow(added, "range int, n long, cells binary"),
        "sketch",
    )
    most = reached.groupBy((F.col("range") >= 1 << _SLICES).alias("row")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(most_bits, max(16, int(16 * most).bit_length()))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed in batch.column("cells").to_pylist():
                own = np.zeros(1 << (bits - _SLICES), bool)
                own[np.frombuffer(packed, "<u4") >> (CELLS - bits)] = True
                out.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("range"), pa.array(out, pa.binary())], names=["range", "bitmap"])

    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(2)]
    size = 1 << (bits - _SLICES - 3)
    for row in reached.select("range", "cells").mapInArrow(folded, "range int, bitmap binary").toLocalIterator():
        number, s = divmod(row["range"], 1 << _SLICES)
        maps[number][s * size : (s + 1) * size] = np.frombuffer(row["bitmap"], np.uint8)
    return bits, maps


def _estimated(seed: np.ndarray, bits: int, maps: list[np.ndarray]) -> np.ndarray:
    """Whether the sketch counts each seed twice or more; looked up once for equal neighbours."""
    new = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]])) if len(seed) else np.zeros(0, np.int64)
    hit = np.ones(len(new), bool)
    for cell, bitmap in zip(cells(seed[new]), maps, strict=True):
        at = cell >> np.uint32(CELLS - bits)
        hit &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return np.repeat(hit, np.diff(np.append(new, len(seed))))


def _ranges(key: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (document number, first word) as merged word ranges of documents."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] > at[:-1] + width)])) if len(at) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(at)) - 1 if len(at) else new
    return key[new], at[new], at[last] + width


def repeated_ranges(documents: DataFrame, text: str = "text", width: int = WINDOW, most_bits: int = 28) -> DataFrame:
    """(_sd_k1, _sd_k2, low, high): word ranges of documents, by key, that repeated windows cover.

    ``documents`` has the key columns; see ``keyed``.
    """
    spark = documents.sparkSession
    bits, maps = sketch(documents, text, width, most_bits)
    shipped = spark.sparkContext.broadcast(maps)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [("bucket", pa.int32()), ("entries", pa.binary()), ("docs", pa.binary()), ("ranges", pa.binary())]
    schema = pa.schema(parts)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, text, _CHUNK):
            windows = Windows(column_of(rows, text), width)
            at = np.flatnonzero(windows.valid & _estimated(windows.seed, bits, shipped.value))
            if not len(at):
                continue
            keys = np.zeros(rows.num_rows, _KEY)
            keys["k1"], keys["k2"] = (column_of(rows, x).to_numpy(zero_copy_only=False) for x in ("_sd_k1", "_sd_k2"))
            digest, more = windows.digests(at)
            order = np.lexsort((more, digest))
            at, digest, more = at[order], digest[order], more[order]
            doc = windows.words.row[at]
            place = at - windows.words.first[doc]
            new = np.concatenate([[True], (digest[1:] != digest[:-1]) | (more[1:] != more[:-1])])
            once = new & np.append(new[1:], True)
            entries = np.zeros(int(new.sum()), _ENTRY)
            entries["digest"], entries["more"] = digest[new], more[new]
            entries["doc"], entries["at"] = np.where(once, doc, 0)[new], np.where(once, place, _MANY)[new]
            # By seed, so that neighbouring windows go to the same bucket and their ranges merge there.
            bucket = (mixed(windows.seed[at[new]]) % np.uint64(buckets)).astype(np.int32)
            by = np.lexsort((entries["at"], entries["doc"], bucket))
            entries, bucket = entries[by], bucket[by]
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            out: tuple[list, ...] = ([], [], [], [])
            for low, high in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
                own = entries[low:high].copy()
                known, own["doc"] = np.unique(own["doc"], return_inverse=True)
                for column, value in zip(out, (int(bucket[low]), own.tobytes(), keys[known].tobytes(), None), strict=True):
                    column.append(value)
            key, first, end = _ranges(doc[~once], place[~once], width)  # repeated here, known already
            if len(key):
                own = np.zeros(len(key), [("key", _KEY), ("low", "<u4"), ("high", "<u4")])
                own["key"], own["low"], own["high"] = keys[key], first, end
                for column, value in zip(out, (int(first.sum() + len(key) * 7919) % buckets, None, None, own.tobytes()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(out, parts, strict=True)], schema=schema)

    def grouped(rows: pa.Table) -> pa.Table:
        docs, entries, ranges, base = [], [], [], 0
        for own, known, done in zip(*(rows.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if done is not None:
                ranges.append(np.frombuffer(done, [("key", _KEY), ("low", "<u4"), ("high", "<u4")]))
                continue
            keys, part = np.frombuffer(known, _KEY), np.frombuffer(own, _ENTRY).copy()
            part["doc"] += base
            base += len(keys)
            docs.append(keys)
            entries.append(part)
        low, high, keys = [x["low"] for x in ranges], [x["high"] for x in ranges], [x["key"] for x in ranges]
        if entries:
            all_keys, every = np.concatenate(docs), np.concatenate(entries)
            every = every[np.lexsort((every["more"], every["digest"]))]
            new = np.concatenate([[True], (every["digest"][1:] != every["digest"][:-1]) | (every["more"][1:] != every["more"][:-1])])
            alone = new & np.append(new[1:], True)
            found = every[~alone & (every["at"] != _MANY)]
            doc, first, end = _ranges(found["doc"], found["at"], width)
            keys.append(all_keys[doc])
            low.append(first)
            high.append(end)
        key = np.concatenate(keys)
        return pa.table([
            pa.array(np.ascontiguousarray(key["k1"])), pa.array(np.ascontiguousarray(key["k2"])),
            pa.array(np.concatenate(low).astype(np.int64)), pa.array(np.concatenate(high).astype(np.int64)),
        ], names=["_sd_k1", "_sd_k2", "low", "high"])

    return (
        documents.select(F.col(f"`{text}`").cast("string").alias(text), "_sd_k1", "_sd_k2")
        .mapInArrow(suspects, "bucket int, entries binary, docs binary, ranges binary")
        .groupBy("bucket").applyInArrow(grouped, "_sd_k1 long, _sd_k2 int, low long, high long")
    )


def keyed(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds 96 bits that tell rows apart; rows of the same id and text share them, and their windows' fate."""
    own = [F.col(f"`{x}`") for x in (doc_id, text)]
    return documents.withColumns({"_sd_k1": F.xxhash64(*own), "_sd_k2": F.hash(*own)})


def with_spans(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WINDOW) -> DataFrame:
    """The rows with ``_sd_spans``, the merged word ranges that repeated windows cover (null: none)."""
    rows = keyed(documents.select(*(F.col(f"`{x}`") for x in documents.columns if not x.startswith("_sd_"))), text, doc_id)
    ranges = repeated_ranges(rows, text, width).groupBy("_sd_k1", "_sd_k2").agg(F.collect_set(F.struct("low", "high")).alias("_sd_spans"))
    return rows.join(ranges, ["_sd_k1", "_sd_k2"], "left").drop("_sd_k1", "_sd_k2")


def _spans(column: pa.Array) -> list[list[tuple[int, int]]]:
    return [merged([(x["low"], x["high"]) for x in own]) if own else [] for own in column.to_pylist()]


def without_repeats(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the words that repeated windows cover; other characters stay."""
    own = T.StructType([field for field in documents.schema if not field.name.startswith("_sd_")])
    parting = spaces()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, text, _CHUNK):
            column = cut_out(column_of(rows, text), _spans(column_of(rows, "_sd_spans")), parting)
            yield from pa.table([column if name == text else rows.column(name) for name in own.names], names=own.names).to_batches()

    return with_spans(documents, text, doc_id).mapInArrow(cut, own)


def report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by blanks."""
    import hashlib

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for text, spans in zip(batch.column("text").to_pylist(), _spans(batch.column("_sd_spans")), strict=True):
                words = (text or "").encode().split()
                kept, at = [], 0
                for low, high in spans:
                    kept += words[at:low]
                    at = high
                kept += words[at:]
                for column, value in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_spans(documents.select("doc_id", "text")).mapInArrow(told, "doc_id long, n_words long, n_removed long, kept_sha256 string")
