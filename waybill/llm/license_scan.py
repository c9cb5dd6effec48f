"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

A text's shingles are its runs of five words (lower-case letters and digits; other ASCII characters
part words). Templates of c to 2c - 1 shingles (c a power of two) are sought in windows of 3c - 2
shingles that start every c: every such run of shingles lies whole in one of them, so a window that
holds a template has a Jaccard similarity of at least c / (3c - 2) > 1/3 with it. Each of 20 bands is
one MinHash value, so such a window misses all bands of its template with probability below
(2/3)^20 < 0.0004; for c = 1 window and template are the same shingle and never miss. Texts
with a window that shares a band value with a template of its class are compared with it window by
window, shingle by shingle; at least ``contained`` of the template must be in one. A text without
a single shingle of any template cannot hold enough of one, so its bands are not computed. Only Spark
SQL functions are used, within the row: nothing is exploded or shuffled.

Cases: null, empty and short texts have no shingles and no licence. A template of fewer than five
words cannot be sought and is refused. A template given twice counts once. Repeated rows are each
reported. Without templates no text has a licence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
BANDS = 20
#: Notices by which licences are declared, with their usual names.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)
def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; every other ASCII character parts words."""
    body = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(body, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


_SHINGLES = (
    f"CASE WHEN size(_words) < {WORDS} THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(_words) - {WORDS}),"
    f" i -> xxhash64({', '.join(f'get(_words, i + {j})' for j in range(WORDS))})) END"
)


def _band(b: int) -> str:
    """Shingle hashes hashed anew for band b."""
    return f"transform(_shingles, x -> xxhash64(x, {b}))"


def templates_of(spark: SparkSession, notices: Sequence[tuple[str, str]]) -> list[tuple[str, list[int], list[int]]]:
    """Name, distinct shingle hashes and band values of each template; a short list, the driver's."""
    if not notices:
        return []
    rows = (
        spark.createDataFrame(list(notices), "license string, text string")
        .select("license", "text", words_of(F.col("text")).alias("_words"))
        .select("license", "text", F.array_distinct(F.expr(_SHINGLES)).alias("_shingles"))
        .select("license", "text", "_shingles", F.array(*(F.expr(f"array_min({_band(b)})") for b in range(BANDS))).alias("least"))
        .collect()
    )
    for row in rows:
        if not row["_shingles"]:
            raise ValueError(f"a template needs {WORDS} words: {row['text']!r}")
    return list({(row["license"], *row["_shingles"]): (row["license"], list(row["_shingles"]), list(row["least"])) for row in rows}.values())


def _class(shingles: list[int]) -> int:
    """The power of two at or below a template's number of shingles."""
    return 1 << (len(shingles).bit_length() - 1)


def scan(
    documents: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, contained: float = 0.8, text: str = "text", most_templates: int = 5_000
) -> DataFrame:
    """Adds licenses (sorted names) and n_hits (templates found); one row for each given row.

    Templates are literals of the plan; more than ``most_templates`` are refused: scan in parts then.
    The whole scan of a row is one expression of named steps, so the input's columns keep their
    names whatever they are (``_words``, ``_b0`` and the like included).
    """
    spark = documents.sparkSession
    templates = templates_of(spark, notices)
    if len(templates) > most_templates:
        raise ValueError(f"{len(templates)} templates; scan for at most {most_templates} at a time")
    kept = [name for name in documents.columns if name.lower() not in ("licenses", "n_hits")]
    columns = [F.col(f"`{name}`") for name in kept]
    if not templates:
        return documents.select(*columns, F.array().cast("array<string>").alias("licenses"), F.lit(0).alias("n_hits"))
    classes = sorted({_class(shingles) for _, shingles, _ in templates})
    every = ", ".join(f"{x}L" for x in sorted({x for _, shingles, _ in templates for x in shingles}))
    bands = BANDS if classes[-1] > 1 else 1

    def values(c: int, b: int) -> str:
        if c == 1:
            return f"get(_bands, {b})"
        return (
            f"CASE WHEN size(_shingles) = 0 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(_shingles) - 1, {c}),"
            f" i -> array_min(slice(get(_bands, {b}), i + 1, {3 * c - 2}))) END"
        )

    def verified(shingles: list[int], c: int) -> str:
        """Some window of the class holds enough of the template, exactly compared."""
        literal = ", ".join(f"{x}L" for x in shingles)
        need = -(-len(shingles) * round(contained * 1000) // 1000)
        at = "i" if c == 1 else f"i * {c}"
        return (
            f"exists(sequence(0, cast((size(_shingles) - 1) / {c} AS int)), i ->"
            f" size(array_intersect(slice(_shingles, {at} + 1, {3 * c - 2}), array({literal}))) >= {need})"
        )

    found = []
    for name, shingles, _ in templates:
        c = _class(shingles)
        hit = f"array_contains(_hits{c}, true)"
        quoted = name.replace("\\", "\\\\").replace("'", "\\'")
        found.append(f"CASE WHEN ({hit}) AND {verified(shingles, c)} THEN '{quoted}' END")
    # Every step is a name bound once (``_let``), innermost last: a filter on the result that Spark
    # pushes below repeats the whole expression once, never a step within it.
    body = f"array_compact(array({', '.join(found)}))"
    for c in reversed(classes):
        own = [least for _, shingles, least in templates if _class(shingles) == c]
        hits = [f"arrays_overlap({values(c, b)}, array({', '.join(f'{least[b]}L' for least in own)}))" for b in range(1 if c == 1 else BANDS)]
        body = _let(f"_hits{c}", f"array({', '.join(hits)})", body)  # band by band: shares a value with a template
    body = _let("_bands", f"transform(sequence(0, {bands - 1}), b -> transform(_shingles, x -> xxhash64(x, b)))", body)
    body = _let("_shingles", f"CASE WHEN arrays_overlap(_all, array({every})) THEN _all ELSE cast(array() AS array<bigint>) END", body)
    body = _let("_all", _SHINGLES, body)
    words = r"array_remove(split(lower(coalesce(cast(`" + text.replace("`", "``") + r"` AS string), '')), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), '')"
    body = _let("_words", words, body)
    found_col = "_names"
    while found_col.lower() in {name.lower() for name in kept}:
        found_col = f"_{found_col}"
    named = documents.select(*columns, F.expr(body).alias(found_col))
    return named.select(*columns, F.array_sort(F.array_distinct(found_col)).alias("licenses"), F.size(found_col).alias("n_hits"))


def _let(name: str, value: str, body: str) -> str:
    """SQL in which a name stands for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
