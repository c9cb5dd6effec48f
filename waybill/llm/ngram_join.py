"""Similarity join on word 5-grams with a MinHash LSH forest and exact verification.

1. Texts with equal shingle sets are a class; only one text of a class goes on, with its MinHash
   signature cut into the trees of a forest. A tree is the classes sorted by their piece of the
   signature, so classes with a common prefix stand together. The prefix begins at full depth and is
   shortened until a pair at the threshold shares it in some tree with the target recall; pairs that
   agree further are among those.
2. Within a prefix, signatures are compared; pairs that may reach the threshold (agreement of at
   least four and a half standard errors below it) tie classes into components.
3. Within a component all pairs are compared exactly: shared shingles of a block of classes are a
   product of 0/1 matrices. Only each class's number of links and an edge to the least linked class
   leave a task, never the pairs. Prefixes and components of more than ``block`` classes are dealt
   into blocks, and every two blocks are a group of their own.
4. Components of the verified links are the classes of the result.

So links are lost only where a pair at the threshold shares no prefix (below 0.1 % of such pairs, far
less above it) or where 120 minima miss it by 4.5 errors.

Cases: null and empty texts have no shingles, no links and are their own class; a text of one to four
words is one shingle. Repeated rows and rows of one doc_id are documents each. class_id is the least
doc_id of the class, null if all are null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.arrays import Words, byte_values, column_of, gathered, mixed, rolling, spaces
from waybill.llm.bitmap import among, marked
from waybill.llm.components import components
from waybill.sources.scratch import stored

WORDS = 5
TREES, DEPTH = 20, 6
LEAST, RECALL = 0.8, 0.999
BLOCK = 700
_CHUNK = 1 << 20
_BASE = 0x8CB92BA72F3D8DD7


def prefix_depth(least: float = LEAST, recall: float = RECALL) -> int:
    """Shortens the prefix from the full depth until a pair at the threshold is found often enough."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - least**depth) ** TREES < recall:
        depth -= 1
    return depth


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, row after row, and where each row's begin."""
    words = Words(column, spaces())
    hashes, n_rows = words.hashes(byte_values(lower=False)), len(column)
    runs = mixed(rolling(hashes, WORDS, _BASE))
    whole = words.row[: len(runs)] == words.row[WORDS - 1 :] if len(runs) else np.zeros(0, bool)
    value, row = runs[whole], words.row[: len(runs)][whole]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < WORDS))
    if len(short):
        sums = np.zeros(len(short), np.uint64)
        for j in range(WORDS - 1):
            there = size[short] > j
            sums[there] = sums[there] * np.uint64(_BASE) + hashes[words.first[short[there]] + j]
        value = np.concatenate([value, mixed(sums + size[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    if not len(value):
        return value, np.zeros(n_rows + 1, np.int64)
    order = np.argsort(mixed(value + mixed(row.astype(np.uint64))))  # equal pairs of row and hash side by side
    value, row = value[order], row[order]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])
    value, row = value[new], row[new]
    by = np.argsort(row, kind="stable")
    return value[by], np.searchsorted(row[by], np.arange(n_rows + 1))


def set_keys(value: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits for each row's set of shingles, whatever their order; None for an empty set."""
    there = np.flatnonzero(np.diff(first))
    out: list[bytes | None] = [None] * (len(first) - 1)
    if len(there):
        at = first[:-1][there]
        sums = np.stack([np.add.reduceat(mixed(value ^ np.uint64(salt)), at) for salt in (0x1234567, 0x89ABCDEF01)], 1)
        for row, key in zip(there.tolist(), sums, strict=True):
            out[row] = key.tobytes()
    return out


def _first_bits(keys: list[bytes]) -> np.ndarray:
    """The first 64 bits of each key."""
    return np.array([int.from_bytes(x[:8], "little") for x in keys], np.uint64)


def _features(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    draw = np.random.default_rng(5).integers(1, 2**63, (2, TREES * DEPTH), dtype=np.uint64)
    factor, flip = draw[0] * np.uint64(2) + np.uint64(1), draw[1]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text", _CHUNK):
            value, first = shingles_of(column_of(rows, "text"))
            there, keys = np.flatnonzero(np.diff(first)), set_keys(value, first)
            least = np.zeros((len(there), TREES * DEPTH), np.uint64)
            for k in range(TREES * DEPTH if len(there) else 0):
                least[:, k] = np.minimum.reduceat((value ^ flip[k]) * factor[k], first[:-1][there])
            least = mixed(least)
            trees = least.reshape(-1, TREES, DEPTH)[:, :, :depth]
            prefix = np.zeros((len(there), TREES), np.uint64)
            for j in range(depth):
                prefix = mixed(prefix * np.uint64(_BASE) + trees[:, :, j])
            prefix = mixed(prefix + np.arange(TREES, dtype=np.uint64)).view(np.int64)
            minima = (least & np.uint64(255)).astype(np.uint8)
            signature: list[bytes | None] = [None] * rows.num_rows
            prefixes: list[list[int] | None] = [None] * rows.num_rows
            for i, row in enumerate(there.tolist()):
                signature[row], prefixes[row] = minima[i].tobytes(), prefix[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [column_of(rows, "doc_id"), pa.array(keys, pa.binary()), pa.array(signature, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "key", "signature", "prefixes"],
            )

    return made


def _dealt(members: DataFrame, group: str, block: int) -> DataFrame:
    """Adds ``low``, ``high`` and ``side``: groups of more than ``block`` rows are dealt into blocks.

    Every two blocks meet in one group (low, high), a block with itself in (b, b).
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    return (
        members.join(sizes, group).withColumn("_parts", parts)
        .withColumn("side", F.pmod(F.xxhash64("key", F.lit(17)), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumns({"low": F.least("side", "_other"), "high": F.greatest("side", "_other")})
        .drop("_n", "_parts", "_other")
    )


def _in_groups(df: DataFrame, group: str, worked: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """Works on whole groups (group, low, high), many small ones at a time."""
    names = [group, "low", "high"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(x).to_pylist() for x in names), strict=True))
            cut = len(keys) - 1  # the last group may go on in the next batch
            while cut > 0 and keys[cut - 1] == keys[-1]:
                cut -= 1
            if held and tuple(held[0].column(x)[0].as_py() for x in names) != keys[0]:
                yield worked(pa.Table.from_batches(held).combine_chunks())
                held = []
            if cut:
                yield worked(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks())
                held = []
            held.append(batch.slice(cut))
        if held:
            yield worked(pa.Table.from_batches(held).combine_chunks())

    return df.repartition(*names).sortWithinPartitions(*names).mapInArrow(each, schema)


def _bounds(rows: pa.Table, group: str) -> np.ndarray:
    """Where each group of sorted rows begins, and the end."""
    number = np.unique(np.array([hash(x) for x in zip(*(rows.column(x).to_pylist() for x in (group, "low", "high")), strict=True)], np.int64), return_inverse=True)[1]
    return np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [rows.num_rows]])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row that each row is tied to."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _compared(rows: pa.Table, group: str, least: float) -> pa.RecordBatch:
    """Edges between classes whose signatures agree enough, at most one for each row of a group."""
    signature = np.frombuffer(b"".join(column_of(rows, "signature").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    side, bounds = column_of(rows, "side").to_numpy(), _bounds(rows, group)
    same = column_of(rows, "low").to_numpy() == column_of(rows, "high").to_numpy()
    rate = least + (1 - least) / 256
    need = signature.shape[1] * (rate - 4.5 * np.sqrt(rate * (1 - rate) / signature.shape[1]))
    first, second = [], []
    size = np.diff(bounds)
    for n in np.unique(size[size > 1]):
        starts = bounds[:-1][size == n]
        i, j = np.triu_indices(n, 1)
        for at in range(0, len(starts), max(1, 200_000 // len(i))):
            group_at = starts[at : at + max(1, 200_000 // len(i))]
            for part in range(0, len(i), 200_000):
                a = (group_at[:, None] + i[None, part : part + 200_000]).ravel()
                b = (group_at[:, None] + j[None, part : part + 200_000]).ravel()
                apart = same[a] | (side[a] != side[b])
                a, b = a[apart], b[apart]
                hit = (signature[a] == signature[b]).sum(1) >= need
                first.append(a[hit])
                second.append(b[hit])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second))
    root = _roots(rows.num_rows, a, b)
    tied = np.flatnonzero(root != np.arange(rows.num_rows))
    keys = column_of(rows, "key")
    return pa.RecordBatch.from_arrays([keys.take(pa.array(tied)), keys.take(pa.array(root[tied]))], names=["a", "b"])


def _shared(values: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share."""
    row = np.repeat(np.arange(len(values)), [len(x) for x in values])
    _, column, n = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    often = n > 1
    column, row = (np.cumsum(often) - 1)[column[often[column]]], row[often[column]]
    out = np.zeros((len(values), len(values)), np.float64)
    width = max(64, min(8192, 16_000_000 // len(values)))
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for low in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        there = np.zeros((len(values), width), np.float32)
        there[row[a:b], column[a:b] - low] = 1
        out += there @ there.T
    return out


def _verified(rows: pa.Table, group: str, least: float) -> pa.RecordBatch:
    """For each class of a group: rows linked to it, and the least class it is tied to."""
    sets = [np.frombuffer(x, np.uint64) for x in column_of(rows, "shingles").to_pylist()]
    weight, side = column_of(rows, "weight").to_numpy(), column_of(rows, "side").to_numpy()
    same = column_of(rows, "low").to_numpy() == column_of(rows, "high").to_numpy()
    share = round(least * 10_000)
    links, root = np.zeros(rows.num_rows, np.int64), np.arange(rows.num_rows)
    bounds = _bounds(rows, group)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        if high - low < 2:
            continue
        shared = _shared(sets[low:high])
        size = np.array([len(x) for x in sets[low:high]], np.float64)
        linked = 10_000 * shared >= share * (size[:, None] + size[None, :] - shared)
        np.fill_diagonal(linked, False)
        if not same[low]:
            linked &= side[low:high, None] != side[None, low:high]
        links[low:high] = linked @ weight[low:high]
        a, b = np.nonzero(np.triu(linked))
        root[low:high] = low + _roots(high - low, a, b)
    keys = column_of(rows, "key")
    return pa.RecordBatch.from_arrays([keys, pa.array(links), keys.take(pa.array(root))], names=["key", "links", "tied"])


def with_keys(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``_key``, the 128 bits of their shingle set."""
    names = [x for x in documents.columns if x != "_key"]
    own = T.StructType([*(documents.schema[x] for x in names), T.StructField("_key", T.BinaryType())])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, text, _CHUNK):
            keys = set_keys(*shingles_of(column_of(rows, text)))
            yield from pa.table([*(rows.column(x) for x in names), pa.array(keys, pa.binary())], names=[*names, "_key"]).to_batches()

    return documents.select(*(F.col(f"`{x}`") for x in names)).mapInArrow(added, own)


def join(documents: DataFrame, least: float = LEAST, recall: float = RECALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every row, and (key, class_key, class_id, n_links) of every shingle set."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(source.mapInArrow(_features(prefix_depth(least, recall)), "doc_id long, key binary, signature binary, prefixes array<long>"), "minhash")
    classes = stored(
        made.where("key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("weight"), F.first("signature").alias("signature"), F.first("prefixes").alias("prefixes")
        ), "classes",
    )
    entries = classes.select("key", F.explode("prefixes").alias("prefix"))
    near = _dealt(entries, "prefix", block).join(classes.select("key", "signature"), "key")
    candidates = _in_groups(near, "prefix", lambda rows: _compared(rows, "prefix", least), "a binary, b binary")
    groups = components(candidates).select(F.col("node").alias("key"), F.col("root").alias("component"))

    grouped = stored(groups.join(classes.select("key", "least_id", "weight"), "key"), "groups")
    bits, bitmap = marked(grouped.select("key"), lambda batch: _first_bits(batch.column("key").to_pylist()))  # the join by key is exact
    shipped = documents.sparkSession.sparkContext.broadcast(bitmap)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text", _CHUNK):
            value, first = shingles_of(column_of(rows, "text"))
            keys = set_keys(value, first)
            there = [i for i, key in enumerate(keys) if key is not None]
            hit = among(_first_bits([keys[i] for i in there]), bits, shipped.value)
            own = {keys[there[i]]: there[i] for i in np.flatnonzero(hit)}  # one of equal sets
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.binary()), pa.array([value[first[i] : first[i + 1]].tobytes() for i in own.values()], pa.binary())], names=["key", "shingles"]
            )

    content = source.select("text").mapInArrow(sets, "key binary, shingles binary").groupBy("key").agg(F.first("shingles").alias("shingles"))
    members = _dealt(grouped.select("key", "component", "weight"), "component", block).join(content, "key")
    checked = stored(
        _in_groups(members, "component", lambda rows: _verified(rows, "component", least), "key binary, links long, tied binary"), "links"
    )
    roots = components(checked.select(F.col("key").alias("a"), F.col("tied").alias("b")))
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    of_class = (
        classes.select("key", "least_id", "weight")
        .join(links, "key", "left").join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
        .select("key", "least_id", F.coalesce("root", "key").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    least_id = of_class.groupBy("class_key").agg(F.min("least_id").alias("class_id"))
    return made.select("doc_id", "key"), of_class.join(least_id, "class_key").select("key", "class_key", "class_id", "n_links")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links (other rows with a similarity of at least 0.8) of every document."""
    rows, classes = join(documents)
    return rows.join(classes, "key", "left").select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The document with the least doc_id of every class; texts without words stay."""
    columns = documents.columns
    rows, classes = join(documents)
    best = (
        rows.join(classes, "key").groupBy("class_key")
        .agg(F.min(F.struct("doc_id", "key")).alias("kept")).select(F.col("kept.doc_id").alias("_id"), F.col("kept.key").alias("_kept"))
    )
    keyed = with_keys(documents)
    found = keyed.join(best, (keyed["_key"] == best["_kept"]) & keyed["doc_id"].eqNullSafe(best["_id"]))
    one = found.dropDuplicates(["_key", "doc_id"]).select(*(keyed[x] for x in columns))
    return one.unionByName(keyed.where("_key IS NULL").select(*columns))
