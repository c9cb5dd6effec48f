r"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are cut into pre-tokens by the tokenizer's pattern (one match at a time, as tiktoken's
``encode_ordinary`` does; special tokens are plain text). Each pre-token's UTF-8 bytes then go
through two tiers:

1. **Minimal perfect hash.** The vocabulary's byte strings are placed by hash-and-displace: a key's
   bucket picks a displacement ``d = a n + b`` and its slot is ``(h1 + a h2 + b) mod n`` for ``n`` keys
   in ``n`` slots (``a`` moves the bucket's keys apart, ``b`` reaches every free slot). Buckets are placed largest first, each with the first displacement whose slots are free and
   distinct. A lookup is one 64-bit xxhash (cut into bucket, h1 and h2 bits), one displacement and one comparison with the stored
   string (a miss compares unequal), so a pre-token that is itself a token costs no merging at all.
2. **Heap over linked bytes.** Other pre-tokens start as single bytes in a linked list; a heap holds
   (rank of the merged pair, position) for every adjacent pair that is a token. The least rank, and
   among equal ranks the leftmost pair, is merged; entries whose pair has changed since are skipped,
   and the merged node's new pairs with its neighbours are pushed. Pair ranks come from the same
   hash, asked once for every cut of a vocabulary string into two when the table is built.

The table is built once on the driver from the ranks file (its path is a parameter) and broadcast;
its size is bounded by the vocabulary's. Pre-tokens and their ids are kept in a per-worker memo that
is emptied when it holds ``MEMO`` entries or ``MEMO_CHARS`` characters; it changes no result.

Texts are cut into chunks before the pattern sees them, each distinct chunk of a slice is matched and
encoded once, and the texts' ids are put together from the chunks' as arrays. With a pattern of
``BLANK_PARTED`` a chunk begins at every blank before a character that is no white space: no match
runs over such a place, and the matches on either side do not depend on the other side. (Outside white
space, only the first character of a match may be a blank; white space before the blank is matched up to
it either way, as ``\s+(?!\S)`` leaves the blank to the word.) With other patterns a text is one chunk.

Decoding takes the byte strings of the ids from an Arrow array, whose buffer is the joined bytes.

Defined results for odd input: a null text encodes as no ids (like the empty text); a null id list
decodes to empty bytes; ids outside the vocabulary are an error. Every column of the input is kept;
an input column with the output's name is replaced. Very long texts are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waybill.llm.arrays import column_of, flat, gathered

MEMO = 1_000_000
MEMO_CHARS = 16 * MEMO
SLICE_BYTES = 4 << 20
#: Patterns whose matches never run over a blank before a character that is no white space.
BLANK_PARTED = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}
_TABLES: dict[str, "Vocabulary"] = {}


def read_ranks(path: str) -> tuple[list[bytes], list[int]]:
    """Byte strings and their ranks from a ``base64 rank`` file, in file order."""
    keys, ranks = [], []
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                keys.append(base64.b64decode(token))
                ranks.append(int(rank))
    return keys, ranks


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: n keys, n slots, one probe a lookup."""

    def __init__(self, keys: list[bytes], per_bucket: float = 4.0) -> None:
        self.n = len(keys)
        self.buckets = max(1, int(self.n / per_bucket))
        for seed in range(64):
            self.seed = seed
            placed = self._place(keys)
            if placed is not None:
                displacement, slot_key = placed
                self.displacement, self.slot_key = displacement.tolist(), slot_key.tolist()
                return
        raise ValueError("no perfect hash found")

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        return (h & 0x1FFFFF) % self.buckets, ((h >> 21) & 0x1FFFFF) % self.n, (h >> 42) % max(self.n - 1, 1) + 1

    def _place(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        n = self.n
        parts = np.array([self._parts(k) for k in keys], dtype=np.int64).reshape(-1, 3)
        order = np.argsort(parts[:, 0], kind="stable")
        bounds = np.searchsorted(parts[order, 0], np.arange(self.buckets + 1))
        sizes = np.diff(bounds)
        free = np.ones(n, bool)
        displacement = np.zeros(self.buckets, np.int64)
        slot_key = np.full(n, -1, np.int64)
        for bucket in np.argsort(-sizes, kind="stable"):
            size = sizes[bucket]
            if size == 0:
                break
            members = order[bounds[bucket] : bounds[bucket + 1]]
            h1, h2 = parts[members, 1][:, None], parts[members, 2][:, None]
            found = None
            for start in range(0, 64 * n, 1024):
                d = np.arange(start, start + 1024, dtype=np.int64)[None, :]
                slots = (h1 + (d // n) * h2 + d % n) % n
                ok = free[slots].all(axis=0)
                if size > 1:
                    s = np.sort(slots, axis=0)
                    ok &= (s[1:] != s[:-1]).all(axis=0)
                hits = np.flatnonzero(ok)
                if len(hits):
                    found = int(d[0, hits[0]])
                    break
            if found is None:
                return None
            slots = (h1[:, 0] + (found // n) * h2[:, 0] + found % n) % n
            free[slots] = False
            slot_key[slots] = members
            displacement[bucket] = found
        return displacement, slot_key

    def index(self, key: bytes) -> int:
        """The index of the key's slot's string: the key's own index if it is one of the keys."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        n = self.n
        a, c = divmod(self.displacement[(h & 0x1FFFFF) % self.buckets], n)
        return self.slot_key[(((h >> 21) & 0x1FFFFF) % n + a * ((h >> 42) % max(n - 1, 1) + 1) + c) % n]


class Vocabulary:
    """Byte strings by id and the perfect hash from byte strings to ids."""

    def __init__(self, path: str) -> None:
        keys, ranks = read_ranks(path)
        self.keys = keys
        self.ranks = ranks
        self.table = PerfectHash(keys)
        self.pairs = self._pairs()
        self._ready()

    def __getstate__(self) -> dict:
        """What a task needs: the strings, their ranks, the hash's arrays and the pairs (no memo, no closures)."""
        return {"keys": self.keys, "ranks": self.ranks, "table": self.table, "pairs": self.pairs}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def _ready(self) -> None:
        self.by_id: list[bytes | None] = [None] * (max(self.ranks, default=-1) + 1)
        for key, rank in zip(self.keys, self.ranks):
            self.by_id[rank] = key
        self.words = pa.array(self.by_id, pa.large_binary())
        self.memo: dict[str, bytes] = {}
        self.memo_chars = 0
        self.fast_rank = self.ranker()
        self.byte_ids = [self.rank(bytes([b])) for b in range(256)]
        if None in self.byte_ids:
            raise ValueError("not every byte is a token, so this is no byte-level vocabulary")
        self.byte_pairs = [self.pairs.get(a << 20 | b, -1) for a in self.byte_ids for b in self.byte_ids]

    def _pairs(self) -> dict[int, int]:
        """Ranks by pairs of ids whose strings join to a token: every cut of every string into two tokens."""
        rank, out = self.ranker(), {}
        for key, joined in zip(self.keys, self.ranks):
            for k in range(1, len(key)):
                left = rank(key[:k])
                right = None if left is None else rank(key[k:])
                if right is not None:
                    out[left << 20 | right] = joined
        return out

    def rank(self, piece: bytes) -> int | None:
        i = self.table.index(piece)
        return self.ranks[i] if self.keys[i] == piece else None

    def ranker(self):
        """``rank`` as one closure over local names: the heap's inner loop calls it most."""
        table, keys, ranks = self.table, self.keys, self.ranks
        seed, n, buckets, displacement, slot_key = table.seed, table.n, table.buckets, table.displacement, table.slot_key
        step = max(n - 1, 1)
        digest = xxhash.xxh3_64_intdigest

        def rank(piece: bytes) -> int | None:
            h = digest(piece, seed)
            a, c = divmod(displacement[(h & 0x1FFFFF) % buckets], n)
            i = slot_key[(((h >> 21) & 0x1FFFFF) % n + a * ((h >> 42) % step + 1) + c) % n]
            return ranks[i] if keys[i] == piece else None

        return rank

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token: least-rank adjacent pairs merged first, leftmost on ties.

        Nodes are linked by ``after`` and ``before``; a node merged away has the id -1. ``now`` holds the
        rank of the pair that begins at a node (-1: none). The heap holds rank and position of candidate
        pairs in one integer, so the least rank and then the leftmost pair comes first; a popped entry
        counts only if the pair now at its position still has that rank.
        """
        n = len(piece)
        shift = n.bit_length()
        mask = (1 << shift) - 1
        ranks, byte_ids, byte_pairs = self.pairs.get, self.byte_ids, self.byte_pairs
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ids = [byte_ids[b] for b in piece]
        now = [byte_pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        now.append(-1)
        heap = [r << shift | i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            i, r = top & mask, top >> shift
            if now[i] != r:
                continue
            middle = after[i]
            stop = after[i] = after[middle]
            now[middle] = ids[middle] = -1
            ids[i] = r
            if stop < n:
                before[stop] = i
                found = now[i] = ranks(r << 20 | ids[stop], -1)
                if found >= 0:
                    push(heap, found << shift | i)
            else:
                now[i] = -1
            p = before[i]
            if p >= 0:
                found = now[p] = ranks(ids[p] << 20 | r, -1)
                if found >= 0:
                    push(heap, found << shift | p)
        return [i for i in ids if i >= 0]

    def encode_piece(self, piece: bytes) -> list[int]:
        r = self.fast_rank(piece)
        return self.merged(piece) if r is None else [r]

    def runs(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token as 32-bit integers; one met before is taken from the memo."""
        memo = self.memo
        if len(memo) >= MEMO or self.memo_chars >= MEMO_CHARS:
            memo.clear()
            self.memo_chars = 0
        out = list(map(memo.get, pieces))
        for i in [i for i, run in enumerate(out) if run is None]:
            piece = pieces[i]
            run = memo.get(piece)
            if run is None:
                run = memo[piece] = array("i", self.encode_piece(piece.encode("utf-8"))).tobytes()
                self.memo_chars += len(piece)
            out[i] = run
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.by_id[i] for i in ids)


def vocabulary(path: str) -> Vocabulary:
    """The table for this ranks file, built on first use in this process."""
    if path not in _TABLES:
        _TABLES[path] = Vocabulary(path)
    return _TABLES[path]


def encode_text(text: str | None, vocab: Vocabulary, pattern: regex.Pattern) -> list[int]:
    """Ids of one text, pre-token by pre-token."""
    out: list[int] = []
    for piece in pattern.findall(text or ""):
        out.extend(vocab.encode_piece(piece.encode("utf-8")))
    return out


def _no_space() -> np.ndarray:
    """By two bytes (the first one the higher): True if no white space character begins with them."""
    out = np.ones((256, 256), bool)
    for c in map(chr, range(0x3001)):  # the last white space character is U+3000
        if regex.match(r"\s", c):
            raw = c.encode("utf-8")
            out[raw[0], raw[1] if len(raw) > 1 else slice(None)] = False
    return out.ravel()


_NO_SPACE = _no_space()


def _parting(data: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places of blanks before a character that is no white space; none at the last byte of a text."""
    blank = np.flatnonzero(data[:-1] == 32)
    blank = blank[~last[blank]]
    behind = np.minimum(blank + 2, len(data) - 1)  # the second byte says something of longer characters only
    return blank[_NO_SPACE[data[blank + 1].astype(np.int64) << 8 | data[behind]]]


def _chunks(texts: pa.Array, parted: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of the texts, the number of each chunk met, and where each text's chunks begin."""
    data, rows_at = flat(texts)
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[rows_at] = True
    begins = edge[:n].copy()
    if parted:
        begins[_parting(data, edge[1:])] = True
    starts = np.append(np.flatnonzero(begins), n)
    chunks = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
    coded = chunks.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, rows_at)


def _matches(chunks: pa.Array, parted: bool, pattern: regex.Pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pre-tokens of the chunks, where each chunk's begin and how many they are.

    Chunks that begin at a parting blank are matched in one string: no match runs over their bounds.
    """
    data, at = flat(chunks)
    loose = np.zeros(len(chunks), bool)
    if parted:
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        here = _parting(data, edge[1:])
        loose = np.isin(at[:-1], here, assume_unique=True)
    texts = chunks.to_pylist()
    own = [texts[i] for i in np.flatnonzero(loose).tolist()]
    pieces = pattern.findall("".join(own))
    first, count = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    upto = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, own), np.int64, len(own))), "right")
    count[loose] = np.diff(upto, prepend=0)
    first[loose] = upto - count[loose]
    for i in np.flatnonzero(~loose).tolist():
        found = pattern.findall(texts[i])
        first[i], count[i] = len(pieces), len(found)
        pieces += found
    return pieces, first, count


def _spread(values: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of so many values from these places, one after another, and where each begins (and the last ends)."""
    before = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=before[1:])
    return values[np.repeat(at - before[:-1], sizes) + np.arange(before[-1])], before


def encode_flat(texts: pa.Array, vocab: Vocabulary, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of all texts; a chunk met several times in the call is matched and encoded once."""
    parted = pattern.pattern in BLANK_PARTED
    chunks, which, rows = _chunks(texts, parted)
    pieces, first, count = _matches(chunks, parted, pattern)
    runs = vocab.runs(pieces)
    ids = np.frombuffer(b"".join(runs), np.int32)
    at = np.zeros(len(runs) + 1, np.int64)  # of each pre-token's ids
    np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)) >> 2, out=at[1:])
    low, high = at[first], at[first + count]
    ids, before = _spread(ids, low[which], (high - low)[which])
    return before[rows], ids


def encode_texts(texts: list[str | None], vocab: Vocabulary, pattern: regex.Pattern) -> list[list[int]]:
    """Ids of each text, as lists."""
    offsets, ids = encode_flat(pa.array(texts, pa.large_string()), vocab, pattern)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def _decoded(offsets: np.ndarray, ids: np.ndarray, vocab: Vocabulary) -> pa.Array:
    words = vocab.words.take(pa.array(ids))  # an id out of range is an error
    if words.null_count:
        raise ValueError("an id is not in the vocabulary")
    _, at, data = words.buffers()
    at = np.frombuffer(at, np.int64)[offsets] if len(ids) else np.zeros(len(offsets), np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(at), data])


def encode(
    frame: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """The frame with ``out``, the text's token ids (array of int), and with ``decoded`` (their bytes) if named.

    The vocabulary and its perfect hash are built once on the driver (size bounded by the vocabulary)
    and broadcast. Rows are handled in slices of about ``SLICE_BYTES`` of text, so a task's memory
    does not grow with Arrow's batch size; a single text is never cut.
    """
    names = [out] + ([decoded] if decoded else [])
    base = frame.drop(*[c for c in names if c in frame.columns])
    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.BinaryType())] if decoded else [])
    schema = T.StructType([*base.schema.fields, *fields])
    shared = base.sparkSession.sparkContext.broadcast(vocabulary(ranks_path))
    text_name = text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        cut = regex.compile(pattern)
        for table in gathered(batches, text_name, SLICE_BYTES):
            offsets, ids = encode_flat(column_of(table, text_name), vocab, cut)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
            extra = [lists] + ([_decoded(offsets, ids, vocab).cast(pa.binary())] if decoded else [])
            columns = [column_of(table, c) for c in table.column_names] + extra
            yield pa.RecordBatch.from_arrays(columns, names=[*table.column_names, *names])

    return base.mapInArrow(run, schema)


def decode(frame: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with ``out``: the bytes that the ids stand for (binary); null ids give empty bytes."""
    base = frame.drop(out) if out in frame.columns else frame
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.BinaryType())])
    shared = base.sparkSession.sparkContext.broadcast(vocabulary(ranks_path))
    position = base.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            lists = [v or [] for v in batch.column(position).to_pylist()]
            offsets = np.cumsum([0] + [len(v) for v in lists])
            flat = np.fromiter((i for v in lists for i in v), np.int64, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(offsets, flat, vocab).cast(pa.binary())], names=[*batch.schema.names, out])

    return base.mapInArrow(run, schema)
