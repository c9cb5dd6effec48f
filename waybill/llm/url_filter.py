"""URL filter over a sorted digest array.

Rules (``host/path prefix``) become files of sorted 64-bit xxhash keys with their full strings beside
them. ``SparkContext.addFile`` hands the files to the executors, where they are memory-mapped, so
that a list far larger than a task's memory costs only the pages it touches. A URL's possible rules
(its host and parent domains, each with the path prefixes of the lengths that rules have) are probed
by a vectorised binary search; a hit counts only if the stored string is the probed one.

Cases: a null URL, or one without ``://``, has empty host and path and no rule. A rule given twice
counts once; rules that block and allow the same string block. An empty list leaves every URL with
the default verdict. Other columns of the input stay, also if named like ours (then ours win).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class DigestFile:
    """One segment: a header, sorted keys, string ends, verdicts, strings; read through a memory map."""

    def __init__(self, path: str) -> None:
        n, size = (int(x) for x in np.fromfile(path, np.int64, 2))
        at = 16
        self.keys = np.memmap(path, np.uint64, "r", at, (n,)) if n else np.zeros(0, np.uint64)
        at += 8 * n
        self.ends = np.memmap(path, np.int64, "r", at, (n + 1,))
        at += 8 * (n + 1)
        self.blocks = np.memmap(path, np.uint8, "r", at, (n,)) if n else np.zeros(0, np.uint8)
        at += n
        self.strings = np.memmap(path, np.uint8, "r", at, (size,)) if size else np.zeros(0, np.uint8)

    @staticmethod
    def write(path: str, rules: dict[str, str]) -> None:
        rows = sorted((digest(rule), rule.encode("utf-8", "surrogatepass"), verdict) for rule, verdict in rules.items())
        strings = b"".join(rule for _, rule, _ in rows)
        with open(path, "wb") as out:
            np.array([len(rows), len(strings)], np.int64).tofile(out)
            np.array([key for key, _, _ in rows], np.uint64).tofile(out)
            np.cumsum([0, *(len(rule) for _, rule, _ in rows)], dtype=np.int64).tofile(out)
            np.array([verdict == BLOCK for _, _, verdict in rows], np.uint8).tofile(out)
            out.write(strings)

    def find(self, keys: np.ndarray, texts: list[str]) -> np.ndarray:
        """Position of each text, -1 where it is not listed."""
        at = np.searchsorted(self.keys, keys)
        out = np.full(len(keys), -1, np.int64)
        for i in np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys)) if len(self.keys) else ():
            wanted, k = texts[i].encode("utf-8", "surrogatepass"), int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:  # equal digests stand side by side
                if self.strings[self.ends[k] : self.ends[k + 1]].tobytes() == wanted:
                    out[i] = k
                    break
                k += 1
        return out


class RuleIndex:
    """Names of the segments that the executors hold, and the path lengths that rules have."""

    def __init__(self, names: list[str], lengths: list[int]) -> None:
        self.names, self.lengths = names, lengths


def build_index(spark: SparkSession, rules: Iterable[tuple[str, str]], segment_rules: int = 5_000_000) -> RuleIndex:
    """Writes rules (string, verdict) to segments of at most ``segment_rules`` and hands them out.

    The iterable is read once, so a long list can come from ``toLocalIterator``; the driver holds one
    segment at a time. A string whose verdicts differ between segments is blocked by either.
    """
    names: list[str] = []
    lengths: set[int] = set()
    folder = os.path.realpath(tempfile.mkdtemp(prefix="rules-"))  # the driver's; Spark copies from it

    def put(part: dict[str, str]) -> None:
        name = f"rules-{uuid.uuid4().hex}.bin"
        DigestFile.write(os.path.join(folder, name), part)
        spark.sparkContext.addFile(os.path.join(folder, name))
        names.append(name)

    part: dict[str, str] = {}
    for rule, verdict in rules:
        if rule is None or "/" not in rule:
            raise ValueError(f"a rule needs a host and a path: {rule!r}")
        if verdict not in (BLOCK, ALLOW):
            raise ValueError(f"verdict of {rule!r} must be {BLOCK} or {ALLOW}")
        host, _, path = rule.partition("/")
        text = f"{host.translate(str.maketrans(_UPPER, _LOWER))}/{path}"
        lengths.add(len(path) + 1)
        part[text] = BLOCK if BLOCK in (verdict, part.get(text)) else ALLOW
        if len(part) >= segment_rules:
            put(part)
            part = {}
    if part or not names:
        put(part)
    return RuleIndex(names, sorted(lengths))


def judge(pages: DataFrame, index: RuleIndex, url: str = "url", default: str = ALLOW) -> DataFrame:
    """Adds host, path, rule and verdict; one pass over the rows, no shuffle."""
    names, lengths = index.names, index.lengths

    @F.pandas_udf("rule string, verdict string")
    def probed(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        files = [DigestFile(SparkFiles.get(name)) for name in names]
        for hosts, paths in parts:
            rows, texts, ranks = [], [], []
            for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                if not host:
                    continue
                at = 0
                while True:
                    domain = host[at:]
                    for size in lengths:
                        if size > len(path):
                            break
                        rows.append(row)
                        texts.append(domain + path[:size])
                        ranks.append((len(domain) + size, len(domain)))
                    dot = host.find(".", at)
                    if dot < 0:
                        break
                    at = dot + 1
            keys = np.fromiter((digest(text) for text in texts), np.uint64, len(texts))
            best: dict[int, tuple[tuple[int, int], str, int]] = {}
            for file in files:
                found = file.find(keys, texts)
                for i in np.flatnonzero(found >= 0):
                    hit = (ranks[i], texts[i], int(file.blocks[found[i]]))
                    best[rows[i]] = max(best.get(rows[i], hit), hit)
            out = [best.get(row) for row in range(len(hosts))]
            yield pd.DataFrame({
                "rule": [x[1] if x else None for x in out],
                "verdict": [(BLOCK if x[2] else ALLOW) if x else default for x in out],
            })

    taken = [name for name in pages.columns if name.lower() not in ("host", "path", "rule", "verdict", "_hit")]
    source = F.col(f"`{url}`").cast("string")
    return (
        pages.select(*(F.col(f"`{name}`") for name in taken), host_of(source).alias("host"), path_of(source).alias("path"))
        .withColumn("_hit", probed("host", "path"))
        .select(*(F.col(f"`{name}`") for name in taken), "host", "path", "_hit.rule", "_hit.verdict")
    )
