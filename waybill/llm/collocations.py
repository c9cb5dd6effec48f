"""Phrase collocation mining by the stripes pattern.

Texts are lower-cased in A-Z only, cut into pieces at ``[.,;:!?\\n\\x0b\\x0c\\r]`` and the pieces into
words ``[^ \\t]+``; phrases never cross a piece.

1. **Stripes in the mapper.** For every word, the task's stripe of that word (a prefix of one word)
   counts the words after it in its piece; another pass builds the stripes of two-word prefixes (third
   words), and a first one the totals of the words. Stripes are built per slice of about
   ``SLICE_BYTES`` of text: words are numbered by Arrow's dictionary encoding of their lower-cased
   bytes, and a slice's stripes are its sorted (prefix, next) numbers with their counts, so memory is
   bounded per task. Entries whose parts are too rare are pruned exactly, before they are made: see
   ``merged_stripes``.
2. **Elementwise merge.** Stripe entries are keyed by (lang, prefix, next) and summed by Spark, which
   combines them map-side first; a frequent prefix's stripe is spread over reducers by its next words,
   so no prefix is ever one task's work.
3. **Three answers.** The words and the merged entries that reach ``min_count`` are written once to
   the shared folder (so a lost executor repeats no text work and every later step reads them, not
   the texts). Entries give f of every two- and three-word phrase that matters, as a candidate's parts
   are no rarer than it is; totals give f of every word (and n), and the largest extension of a
   two-word prefix that is a candidate, with the same maximum taken over the candidates' suffixes,
   decides subsumption.
4. Candidates (2 or 3 words, ``a >= min_count``) are scored exactly: ``floor(10^6 a^2 / (l r))`` in
   38-digit decimals, the least-scoring cut and on ties the smallest k. Two-word candidates inside a
   three-word candidate with ``2 f(longer) >= a`` are dropped. Each language's first ``top`` by score
   descending, a descending, phrase ascending (bytes of UTF-8) are returned: first the first ``top``
   of each of ``SALTS`` parts of a language (by the phrase's hash), then of the survivors, so no task
   ranks all of a language's candidates.

Words travel as 64-bit ids (xxh64 of their bytes) from the mappers on; each word's text is in its
total's row and is joined back to the candidates only. Two words with one id in a
language stop the run with an error instead of merging their counts.

Defined results for odd input: null text counts as empty, null lang as ``und``; texts without words
give nothing; repeated rows count every time; columns of the input other than the text and language
are ignored, so their names cannot clash. Texts longer than a slice are cut between pieces, never
inside one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.arrays import Words, column_of, gathered, mixed
from waybill.llm.bitmap import among, marked
from waybill.sources.scratch import stored

SLICE_BYTES = 4 << 20
#: Rows of a batch that goes back to Spark.
_ROWS = 100_000
SALTS = 64
PIECES = re.compile(r"[.,;:!?\n\x0b\x0c\r]")
WORDS = "lang string, p1 long, word string, cnt long"
ONES = "lang string, p1 long, next long, cnt long"
TWOS = "lang string, p1 long, p2 long, next long, cnt long"
#: Bits of a bitmap (as a power of two) and the broadcast bitmap.
Marks = tuple[int, Broadcast]
_BASE = 0x9E3779B97F4A7C15

_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_PARTS = _ENDS_PIECE.copy()
_PARTS[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _ids(words: list[str]) -> np.ndarray:
    """A 64-bit id for each word (xxh64 of its UTF-8 bytes, signed). Collisions are checked later."""
    return np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), np.uint64, len(words)).view(np.int64)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def _hashes(lang: np.uint64 | np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """64 bits for each word, or two words, of a language; lang: xxh64 of its name."""
    out = mixed(first.view(np.uint64) ^ lang)
    return out if second is None else mixed(out * np.uint64(_BASE) + second.view(np.uint64))


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _frequent(entries: DataFrame, columns: list[str]) -> Marks:
    """A bitmap of the words or pairs of words in the entries, broadcast."""

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        langs = batch.column("lang").dictionary_encode()
        lang = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
        return _hashes(lang, *(batch.column(c).to_numpy() for c in columns))

    bits, bitmap = marked(entries.select("lang", *columns), hashes)
    return bits, entries.sparkSession.sparkContext.broadcast(bitmap)


def _stripes(texts: pa.Array, width: int, lang: str, frequent: Marks | None) -> list[pa.Array]:
    """The stripes of some texts of one language, in order of their prefixes, words by 64-bit ids.

    Width 1: each word's id, text and total. Width 2: the stripe of each word, the words after it.
    Width 3: the stripe of each two-word prefix, the third words. ``frequent`` leaves out entries with
    a word (width 2) or a pair (width 3) that is not marked."""
    words = Words(texts, _PARTS)
    inside = ~_PARTS[words.data]
    bounds = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    plain = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(bounds), pa.py_buffer(_LOWER[words.data[inside]]))
    coded = plain.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    at, ids, n = coded.indices.to_numpy().astype(np.int64), _ids(distinct), max(1, len(distinct))
    if width == 1:
        return [pa.array(ids), coded.dictionary.cast(pa.string()), pa.array(np.bincount(at, minlength=len(distinct)))]
    # The number of piece ends before a word; the end of a row is one, too.
    piece = np.concatenate([np.zeros(1, np.int32), np.cumsum(_ENDS_PIECE[words.data], dtype=np.int32)])[words.starts] + words.row
    joined = piece[1:] == piece[:-1]
    if frequent:
        bits, bitmap = frequent[0], frequent[1].value
        if width == 2:
            often = among(_hashes(_lang_hash(lang), ids), bits, bitmap)[at]
            joined &= often[1:] & often[:-1]
        else:
            pairs = np.flatnonzero(joined)
            joined[pairs] = among(_hashes(_lang_hash(lang), ids[at[pairs]], ids[at[pairs + 1]]), bits, bitmap)
    if width == 2:
        codes, counts = _counted((at[:-1] * n + at[1:])[joined])
        return [pa.array(ids[codes // n]), pa.array(ids[codes % n]), pa.array(counts)]
    both = joined[1:] & joined[:-1]
    prefixes, which = np.unique((at[:-2] * n + at[1:-1])[both], return_inverse=True)
    codes, counts = _counted(which * n + at[2:][both])
    prefix = prefixes[codes // n]
    return [pa.array(ids[prefix // n]), pa.array(ids[prefix % n]), pa.array(ids[codes % n]), pa.array(counts)]


def _cut(text: str) -> Iterator[str]:
    """A text in parts of about a slice, cut between pieces only."""
    at = 0
    while len(text) - at > SLICE_BYTES and (end := PIECES.search(text, at + SLICE_BYTES)):
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def _cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, those of texts longer than a slice cut into several."""
    for batch in batches:
        if (pc.max(pc.binary_length(batch.column(0))).as_py() or 0) > SLICE_BYTES:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            parts = [(part, lang) for text, lang in rows for part in _cut(text or "")]
            batch = pa.RecordBatch.from_pylist([{"text": t, "lang": l} for t, l in parts], schema=batch.schema)
        yield batch


def _mapper(width: int, names: list[str], frequent: Marks | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(_cut_long(batches), "text", SLICE_BYTES):
            langs = pc.fill_null(column_of(rows, "lang"), "und")
            for lang in pc.unique(langs):
                stripes = _stripes(column_of(rows, "text").filter(pc.equal(langs, lang)), width, lang.as_py(), frequent)
                for at in range(0, len(stripes[0]), _ROWS):
                    own = [x.slice(at, _ROWS) for x in stripes]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(own[0])), *own], names=names)

    return run


def _source(documents: DataFrame, text: str, lang: str) -> DataFrame:
    return documents.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))


def merged_stripes(
    documents: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 1
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The words (lang, p1, word, cnt), the merged one-word stripes (lang, p1, next, cnt) and two-word
    stripes (lang, p1, p2, next, cnt) with entries of at least ``min_count``, words by 64-bit ids,
    each written once to the shared folder. Two words with one id in a language raise an error: no
    count is merged silently.

    A phrase can reach ``min_count`` only if its words and both two-word parts of it do. So the words
    that do are marked in a bitmap of bounded size that the second pass looks words up in, and the
    two-word phrases that do in another, for the third pass; entries with an unmarked part are not
    even made. A phrase marked in vain is counted like the others and dropped by its count, so the
    kept counts are exact.
    """
    source = _source(documents, text, lang)

    def merged(width: int, schema: str, frequent: Marks | None = None) -> DataFrame:
        names = [x.split()[0] for x in schema.split(", ")]
        return source.mapInArrow(_mapper(width, names, frequent), schema)

    def summed(entries: DataFrame) -> DataFrame:
        keys = [c for c in entries.columns if c != "cnt"]
        return entries.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))

    words = stored(summed(merged(1, WORDS)), "stripes")
    if words.groupBy("lang", "p1").count().where("count > 1").limit(1).count():
        raise ArithmeticError("two words share a 64-bit id; counts would merge")
    frequent = _frequent(words.where(F.col("cnt") >= min_count), ["p1"]) if min_count > 1 else None
    ones = stored(summed(merged(2, ONES, frequent)).where(F.col("cnt") >= min_count), "stripes")
    frequent = _frequent(ones, ["p1", "next"]) if min_count > 1 else None
    twos = stored(summed(merged(3, TWOS, frequent)).where(F.col("cnt") >= min_count), "stripes")
    return words, ones, twos


def _score(a: str, l: str, r: str):
    """``floor(10^6 a^2 / (l r))`` exactly: 38-digit decimals and an integral division."""
    return F.expr(
        f"(cast({a} as decimal(38,0)) * cast({a} as decimal(38,0)) * cast(1000000 as decimal(38,0)))"
        f" div (cast({l} as decimal(38,0)) * cast({r} as decimal(38,0)))"
    )


def mine(documents: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score (all numbers long)."""
    words, ones, twos = merged_stripes(documents, text, lang, min_count)
    words = words.select("lang", "p1", F.col("cnt").alias("f"), "word")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = ones.select("lang", "p1", F.col("next").alias("p2"), F.col("cnt").alias("f"))
    triples = twos.select("lang", "p1", "p2", F.col("next").alias("p3"), F.col("cnt").alias("f"))
    long_candidates = triples
    # subsumption maxima: over the extensions of a two-word prefix, and over the two-word suffixes
    right = long_candidates.groupBy("lang", "p1", "p2").agg(F.max("f").alias("right_max"))
    left = long_candidates.groupBy("lang", F.col("p2").alias("p1"), F.col("p3").alias("p2")).agg(F.max("f").alias("left_max"))

    def word(k: int) -> DataFrame:
        return words.select("lang", F.col("p1").alias(f"w{k}"), F.col("f").alias(f"f{k}"), F.col("word").alias(f"t{k}"))

    def pair(i: int, j: int) -> DataFrame:
        return pairs.select("lang", F.col("p1").alias(f"w{i}"), F.col("p2").alias(f"w{j}"), F.col("f").alias(f"f{i}{j}"))

    short = (
        pairs.join(right, ["lang", "p1", "p2"], "left")
        .join(left, ["lang", "p1", "p2"], "left")
        .where((F.coalesce("right_max", F.lit(0)) * 2 < F.col("f")) & (F.coalesce("left_max", F.lit(0)) * 2 < F.col("f")))
        .select("lang", F.col("p1").alias("w1"), F.col("p2").alias("w2"), "f")
        .join(word(1), ["lang", "w1"])
        .join(word(2), ["lang", "w2"])
        .select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
        .withColumn("score", _score("a", "l", "r"))
    )
    three = (
        long_candidates.select("lang", F.col("p1").alias("w1"), F.col("p2").alias("w2"), F.col("p3").alias("w3"), "f")
        .join(word(1), ["lang", "w1"])
        .join(word(3), ["lang", "w3"])
        .join(pair(1, 2), ["lang", "w1", "w2"])
        .join(pair(2, 3), ["lang", "w2", "w3"])
        .join(word(2).select("lang", "w2", "t2"), ["lang", "w2"])
        .withColumn("s1", _score("f", "f1", "f23"))
        .withColumn("s2", _score("f", "f12", "f3"))
        .select(
            "lang",
            F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"),
            F.col("f").alias("a"),
            F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
            F.when(F.col("s1") <= F.col("s2"), F.col("f23")).otherwise(F.col("f3")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )
    # Top ``top`` per language in two steps: per (language, one of SALTS parts by the phrase's hash),
    # then over the at most SALTS * top survivors; a language's first rows are first in their part.
    ranking = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    candidates = short.unionByName(three).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    survivors = candidates.withColumn("_in_part", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*ranking))).where(
        F.col("_in_part") <= top
    )
    ranked = survivors.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*ranking))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    )
