"""Packing of token sequences by minimum bin slack.

Every document becomes its token ids and a closing 0; one longer than a sequence is cut into full
pieces and a rest. Sequences are filled one after another: of the longest length still there, the
fullest combination with it is sought by dynamic programming over subset sums, a bitset of reachable
totals for each further length (an integer whose bit t says that total t can be made), and taken away.

Only lengths matter for that, and there are at most ``capacity`` different ones, so the program runs
on a table of at most that many (length, count) rows, whatever the number of documents, and repeats
a combination as often as its lengths last. Documents are then dealt to the combinations' slots by
their rank within their length; ranks are counted apart for each task that cut pieces, so that no group
is larger than one task's input, whatever copies the corpus holds, and the slots are a broadcast table
whose size depends on ``capacity``.

Cases: null and empty texts are a piece of one closing id. Repeated rows are packed each. A text of
any length is cut. An empty table gives an empty plan. Rows need no unique doc_id.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.arrays import column_of, gathered
from waybill.sources.scratch import stored

CAPACITY = 2048
#: Chunks whose ids a Python worker keeps, the first met, as arrays: some 45 bytes each, idle or not.
_KEPT = 1_000_000
#: New chunks encoded at once, and bytes of text whose distinct chunks are looked up.
_BATCH = 4096
_SLICE = 4 << 20


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Chunks that must not be encoded apart from their neighbours, and characters that part words here or there.
_ODD = "<\\||[\u03a3\u0130\x1c-\x1f\x85]"


def encoder(path: str) -> Callable[[pa.Array], list[bytes]]:
    """Ids of texts (null: empty) as little-endian 32-bit integers.

    The tokenizer parts texts at blanks and encodes each part by itself, so each distinct chunk of
    the texts given at once is encoded once, many in a call, and the ids are put together as arrays;
    a text with a chunk that this cutting could treat otherwise (special tokens, context-dependent
    lower case, control characters) goes to the tokenizer whole. The first chunks' ids are kept as
    long as the Python worker.
    """
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = tokenizers.Tokenizer.from_file(path)

    none = [pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)]
    kept = tokenizers.__dict__.setdefault("kept_ids", {}).setdefault(path, none)  # chunks, ids, where each chunk's begin

    def of_chunks(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each chunk's run of them begins and its length."""
        known, flat, at = kept
        place = pc.fill_null(pc.index_in(chunks, value_set=known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = chunks.take(pa.array(new))
        place[new] = len(known) + np.arange(len(new))
        ids, ends = [flat], [at]
        for low in range(0, len(fresh), _BATCH):
            own = fresh.slice(low, _BATCH).to_pylist()
            encoded = tokenizer.encode(" ".join(own), add_special_tokens=False)
            ids.append(np.asarray(encoded.ids, "<u4"))
            starts = np.fromiter((x for x, _ in encoded.offsets), np.int64, len(ids[-1]))
            last = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)  # past the blank behind it
            ends.append(np.searchsorted(starts, last) + ends[-1][-1])
        flat, at = np.concatenate(ids), np.concatenate(ends)
        n = min(_KEPT, len(known) + len(fresh))  # grows until it is full: frequent chunks come early
        if n > len(known):
            kept[:] = pa.concat_arrays([known, fresh.slice(0, n - len(known))]), flat[: at[n]].copy(), at[: n + 1].copy()
        return flat, at[place], np.diff(at)[place]

    def encode(texts: pa.Array) -> list[bytes]:
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        chunks, which = coded.dictionary, coded.indices.to_numpy()
        flat, at, lengths = of_chunks(chunks)
        at, sizes = at[which], lengths[which]
        # Ids of all texts: each chunk's run of ids, moved to its place.
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(at - before[:-1], sizes) + np.arange(before[-1])]
        first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
        out = [ids[low:high].tobytes() for low, high in itertools.pairwise(before[first].tolist())]
        odd = pc.match_substring_regex(chunks, _ODD).to_numpy(zero_copy_only=False)
        if odd.any():
            for row in np.unique(np.searchsorted(first, np.flatnonzero(odd[which]), "right") - 1).tolist():
                encoded = tokenizer.encode(texts[row].as_py(), add_special_tokens=False)
                out[row] = np.asarray(encoded.ids, "<u4").tobytes()
        return out

    return encode


_PIECES = "doc_id long, part int, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document with their lengths and checksums; a pass without a shuffle.

    ``part`` is the number of the task that cut the piece.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        for rows in gathered(batches, "text", _SLICE):
            out: list[tuple] = []
            encoded = encode(column_of(rows, "text"))
            for doc_id, ids in zip(column_of(rows, "doc_id").to_pylist(), encoded, strict=True):
                ids += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    out.append((doc_id, part, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, _PIECES)


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """Lengths, the longest first, whose sum is the greatest that is at most the capacity."""
    lengths = sorted((x for x, n in counts.items() if n), reverse=True)
    first = lengths[0]
    room = capacity - first
    full = (1 << (room + 1)) - 1
    reach = [(0, 0, 1)]  # (length, copies, totals reachable with this and all before)
    bits = 1
    for length in lengths:
        if length > room:
            continue
        n = min(counts[length] - (length == first), room // length)
        step = 1
        while n > 0 and not bits >> room & 1:
            take = min(step, n)  # 1, 2, 4, … copies at once
            bits |= (bits << (take * length)) & full
            reach.append((length, take, bits))
            n -= take
            step *= 2
        if bits >> room & 1:
            break
    total = bits.bit_length() - 1
    out = [first]
    for i in range(len(reach) - 1, 0, -1):
        length, take, _ = reach[i]
        if not reach[i - 1][2] >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how often each is used, until no length is left."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        chosen = fullest(left, capacity)
        need: dict[int, int] = {}
        for length in chosen:
            need[length] = need.get(length, 0) + 1
        times = min(left[length] // n for length, n in need.items())
        out.append((chosen, times))
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


def slots(combinations: Iterable[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): ranks of a length in a combination's place."""
    out, sequence, used = [], 0, {}
    for chosen, times in combinations:
        offset = 0
        for length in chosen:
            low = used.get(length, 0)
            out.append((length, low, low + times, sequence, offset))
            used[length] = low + times
            offset += length
        sequence += times
    return out


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece.

    Tokenizes once: the pieces are written to the shared folder and read for the counts and the plan.
    """
    spark = documents.sparkSession
    cut = stored(pieces(documents, tokenizer, capacity), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first_rank = by_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = {row["length"]: row["n"] for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(sorted(slots(minimum_slack(counts, capacity))), np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast(table)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = plan.value
        top = int(slot[:, 2].max()) + 1 if len(slot) else 1
        keys = slot[:, 0] * top + slot[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.names.index(x)).to_numpy(zero_copy_only=False), np.int64) for x in ("length", "rank"))
            at = slot[np.searchsorted(keys, length * top + rank, "right") - 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(x)) for x in names), pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])],
                names=[*names, "sequence_id", "offset"],
            )

    order = Window.partitionBy("length", "part").orderBy("ids_crc32", "doc_id", "piece")
    ranked = (
        cut.withColumn("_row", F.row_number().over(order))
        .join(first_rank, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("_row") - 1)
    )
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
