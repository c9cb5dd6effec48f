"""Toxicity by a noisy channel: disguised words are decoded, then the restored text is scored.

Language model: letter trigrams counted over every document (the alphabet is bounded, so the counts
are at most 64^3 rows). Channel: a digit or sign may stand for the letters it looks like, a star for
any, a letter written three times or more for one or two, and single letters with blanks or marks
between them for a word. Each suspicious stretch is a lattice of these choices; Viterbi finds the
letters that are most probable under model and channel. Anything else is its own only reading.

Scorer: words of restored texts whose presence speaks for the toxic label. For each word the labelled
training documents that hold it are counted by label (exact copies once). A word is kept if so many
toxic ones would come by chance with probability below ``chance`` and it is at least ``ratio`` times
as frequent in toxic texts. A score is the posterior: the odds of texts without any such word, times
the likelihood ratio of each word present. It reads nothing but the text.

Training labels: at most ``most_labels`` rows, chosen by a hash of doc_id, whose crc32 of doc_id as
text is not 2 modulo 4.

Cases: null and empty texts get the score of a text without indicating words. A text of any length is
read whole. Repeated rows are scored each. A doc_id labelled twice is toxic if one label says so; null
labels and ids do not count. Without labels of both kinds every score is the prior (a half without
any). Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrays import column_of, gathered
from waybill.sources.scratch import stored

LETTERS = " abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("÷", "")
_OTHER = len(LETTERS)
_SIZE = 64
_CODE = {c: i for i, c in enumerate(LETTERS)}
#: Letters that a sign is written for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "abcdefghijklmnopqrstuvwxyz"}
_SWAP, _ANY, _DROP, _STUTTER, _SPACED = -1.0, -3.5, -9.0, -0.5, 0.0
_LETTER = r"[^\W\d_]"
_WORD = re.compile(rf"{_LETTER}+")
_SIGN = r"[01345789@$!|+*]"
_SPACED_OUT = re.compile(rf"(?<![^\W_])(?:{_LETTER}[ .\-_*]){{3,}}{_LETTER}(?![^\W_])")  # single letters, something between
_TRIPLE = re.compile(rf"({_LETTER})\1\1")
_PART = re.compile(rf"(?:{_LETTER}|{_SIGN})+")
_RIGHT, _LEFT = ".,;:()[]{}\"'?&%#*!|+$@-_", ".,;:()[]{}\"'?&%#*|+-_"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _classes() -> np.ndarray:
    """Class of a code point below 0x250: 0 parts words, then the letters, then any other letter."""
    return np.array([_CODE.get(chr(i).lower(), _OTHER if chr(i).isalpha() else 0) for i in range(0x250)], np.int64)


def language_model(documents: DataFrame) -> np.ndarray:
    """log P(third letter | two before) from the letters of all documents."""
    table = _classes()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, np.int64)
        for rows in gathered(batches, "text", 1 << 21):
            code = code_points("\n\n".join(x or "" for x in column_of(rows, "text").to_pylist()))
            kind = np.where(code < 0x250, table[np.minimum(code, 0x24F)], _OTHER)
            if len(kind) > 2:
                total += np.bincount((kind[:-2] * _SIZE + kind[1:-1]) * _SIZE + kind[2:], minlength=_SIZE**3)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], names=["gram", "n"])

    counts = np.zeros(_SIZE**3)
    grams = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in grams.collect():  # at most 64^3 rows
        counts[row["gram"]] = row["n"]
    cube = counts.reshape(_SIZE, _SIZE, _SIZE)
    pairs = cube.sum(0) + 0.5  # backs off to the letter before
    backed = pairs / pairs.sum(1, keepdims=True)
    return np.log((cube + 5 * backed[None]) / (cube.sum(2, keepdims=True) + 5)).astype(np.float32)


class Decoder:
    """Most probable letters of a suspicious stretch."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def lattice(self, text: str) -> list[list[tuple[str, float]]]:
        """For each place the strings that may stand there and the channel's log probability."""
        out: list[list[tuple[str, float]]] = []
        spaced = bool(re.fullmatch(rf"(?:{_LETTER}[ .\-_*])+{_LETTER}", text))
        i = 0
        while i < len(text):
            c, j = text[i], i
            while j < len(text) and text[j] == c:
                j += 1
            if spaced and not c.isalpha():
                out.append([("", _SPACED)])
            elif c.isalpha():
                out.append([(c, 0.0)] if j - i == 1 else [(c * 2, 0.0)] if j - i == 2 else [(c, _STUTTER), (c * 2, _STUTTER)])
                i = j - 1
            elif c == "*":
                out.append([*((x, _ANY) for x in LOOKS[c]), ("", _DROP)])
            else:
                out.append([*((x, _SWAP) for x in LOOKS.get(c, "")), ("", _DROP)])
            i += 1
        return out

    def decode(self, text: str) -> str:
        found = self.known.get(text)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            found = self.known[text] = self._best(text)
        return found

    def _best(self, text: str) -> str:
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for choices in self.lattice(text):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, back) in paths.items():
                for letters, cost in choices:
                    now, x, y = score + cost, a, b
                    for letter in letters:
                        z = _CODE.get(letter, _OTHER)
                        now += self.model[x][y][z]
                        x, y = y, z
                    if (x, y) not in after or now > after[x, y][0]:
                        after[x, y] = (now, (back, letters) if letters else back)
            paths = after
        _, back = max(((score + self.model[a][b][0], back) for (a, b), (score, back) in paths.items()), key=lambda p: p[0])
        parts = []
        while back:
            back, letters = back
            parts.append(letters)
        return "".join(reversed(parts))


def restored_words(text: str | None, decoder: Decoder) -> set[str]:
    """Lower-case words of a text, and those that its suspicious stretches decode to."""
    lower = (text or "").lower()
    tokens = lower.split()
    words, odd = set(), []
    for token in set(tokens):
        if token.isalpha():
            words.add(token)
            continue
        core = token.rstrip(_RIGHT).lstrip(_LEFT)  # signs at the end are marks, not letters
        (words.add if core.isalpha() else odd.append)(core)
    for core in odd:
        words.update(_WORD.findall(core))
        if _SPACED_OUT.search(core):
            words.update(decoder.decode(found[0]) for found in _SPACED_OUT.finditer(core))
        words.update(decoder.decode(part) for part in _PART.findall(core) if not part.isalpha() and _WORD.search(part))
    if _TRIPLE.search(lower):
        words.update([decoder.decode(word) for word in words if _TRIPLE.search(word)])
    if sum(len(token) == 1 for token in tokens) > 3:
        words.update(decoder.decode(found[0]) for found in _SPACED_OUT.finditer(lower))
    return words


class Model:
    """Weights of indicating words, and the log odds of a text without any."""

    def __init__(self, bias: float, weights: dict[str, float]) -> None:
        self.bias, self.weights = bias, weights

    def score(self, words: set[str]) -> float:
        odds = self.bias + sum(self.weights[x] for x in words & self.weights.keys())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def _tail(n: np.ndarray, k: np.ndarray, rate: float) -> np.ndarray:
    """Upper bound of P(X >= k), X binomial (n, rate): Chernoff's, by relative entropy."""
    share = np.clip(k / n, 1e-12, 1 - 1e-12)
    return np.where(share <= rate, 1.0, np.exp(-n * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))))


def train(
    documents: DataFrame, labels: DataFrame, lm: np.ndarray, most_labels: int = 60_000, chance: float = 1e-4, ratio: float = 6.0, unseen: float = 0.06
) -> Model:
    """``unseen``: the part of toxic texts that hold none of the words, for the scores of such texts."""
    spark = documents.sparkSession
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = max(1, math.ceil(usable.count() / most_labels))
    chosen = {row["doc_id"]: row["toxic"] for row in usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0).collect()}
    shipped = spark.sparkContext.broadcast((chosen, lm))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, model = shipped.value
        decoder = Decoder(model)
        for rows in gathered(batches, "text", 1 << 22):
            out: Counter[tuple[str, int]] = Counter()
            for doc_id, text in zip(column_of(rows, "doc_id").to_pylist(), column_of(rows, "text").to_pylist(), strict=True):
                if doc_id in label:
                    toxic = label[doc_id]
                    out["", toxic] += 1
                    for word in restored_words(text, decoder):
                        out[word, toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in out], pa.string()), pa.array([t for _, t in out], pa.int32()), pa.array(out.values(), pa.int64())], names=["word", "toxic", "n"]
            )

    once = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    counts = stored(
        once.mapInArrow(read, "word string, toxic int, n long").groupBy("word")
        .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
        .where((F.col("word") == "") | (F.col("bad") >= 3)), "words"
    )
    total = counts.where("word = ''").first()
    if total is None or not 0 < total["bad"] < total["n"]:
        share = 0.5 if total is None else (total["bad"] + 0.5) / (total["n"] + 1)
        return Model(math.log(share / (1 - share)), {})
    bad, every = total["bad"], total["n"]
    rate = bad / every
    # Only words that lean to toxic texts leave the executors, the 20,000 of most such texts.
    rows = counts.where((F.col("word") != "") & (F.col("bad") >= 3) & (F.col("bad") > F.col("n") * F.lit(min(0.9, 3 * rate)))).orderBy(F.desc("bad"), "word").limit(20_000).collect()
    weights = {}
    if rows:
        n, k = (np.array([row[x] for row in rows], float) for x in ("n", "bad"))
        lift = ((k + 0.5) / (bad + 1)) / ((n - k + 0.5) / (every - bad + 1))
        for i in np.flatnonzero((_tail(n, k, rate) < chance) & (lift >= ratio)):
            weights[rows[i]["word"]] = math.log(lift[i])
    share = unseen * rate
    return Model(math.log(share / (1 - share)), weights)


def score(documents: DataFrame, model: Model, lm: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; one pass, no shuffle."""
    shipped = documents.sparkSession.sparkContext.broadcast((model.bias, model.weights, lm))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, table = shipped.value
        own, decoder = Model(bias, weights), Decoder(table)
        for rows in gathered(batches, "text", 1 << 22):
            values = [own.score(restored_words(x, decoder)) for x in column_of(rows, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(rows, "doc_id"), column_of(rows, "held_out"), pa.array(values, pa.float64())], names=["doc_id", "held_out", "score"])

    found = documents.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        scored, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
