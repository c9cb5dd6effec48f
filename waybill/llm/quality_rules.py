"""Quality rules whose cutoffs have a certified false rejection rate.

A rule rejects a text when one of its ratios exceeds a cutoff. The cutoffs are not chosen by eye: for
each stratum (language) and rule, every cutoff of a fixed grid is tested on labelled texts that no
model was fitted on. Of n good texts the cutoff rejects k; it is certified if a true rejection rate
of ``limit / rules`` would reject so few with probability at most ``error / tests`` (the exact
binomial tail, which is the Clopper-Pearson upper bound; the division by the number of strata, rules
and cutoffs tested is Bonferroni's correction). The least certified cutoff holds. So with probability
``1 - error`` no stratum loses more than ``limit`` of its good texts to all its rules together.
A stratum with too few labels has no certified cutoff and its texts pass these rules.

Only Spark SQL functions are used. Per text no rows are exploded: word windows are arrays of
(hash, position), sorted, in which equal neighbours are repeats.

Cases: null and empty texts have zero counts and fail the base rule; a null language is a stratum of
its own (``?``); labels of unknown texts, or with null quality, do not count, and a text labelled
twice counts as good only if every label says so. Repeated rows are judged each. Without labels no
cutoff is certified. Other columns stay; those named like ours are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
GRID = tuple(round(0.02 * 1.35**i, 4) for i in range(13))
RULES = ("symbols", "marks", "repeats", "dup_lines")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _number(text: Column, characters: str) -> Column:
    """How many of these ASCII characters a text holds: bytes that go when each is replaced by nothing."""
    total = F.lit(0)
    for c in characters:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return total.cast("long")


def _let(name: str, value: str, body: str) -> str:
    """SQL in which a name stands for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


#: One expression, so that a filter above it that Spark pushes down repeats it, but no step within it.
_MEASURES = _let("w", r"array_remove(split(_body, '[\\x20\\x09-\\x0D]+'), '')", _let(
    "l", r"filter(split(_body, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')", _let(
        "h", "CASE WHEN size(w) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(w) - 3),"
        " i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))) END", _let(
            # Only where some window repeats are they sorted, by hash and place.
            "s", "CASE WHEN size(array_distinct(h)) = size(h) THEN cast(array() AS array<struct<h: bigint, p: int>>)"
            " ELSE sort_array(transform(h, (x, p) -> named_struct('h', x, 'p', p))) END", _let(
                "f", "sort_array(transform(filter(s, (x, i) -> (i > 0 AND get(s, i - 1).h = x.h)"
                " OR (i + 1 < size(s) AND get(s, i + 1).h = x.h)), x -> x.p))",
                "named_struct('n_words', size(w), 'n_lines', size(l), 'n_dup_lines', size(l) - size(array_distinct(l)), 'n_repeat_words',"
                " aggregate(transform(f, (p, i) -> CASE WHEN i + 1 < size(f) THEN least(3, get(f, i + 1) - p) ELSE 3 END), 0L, (a, x) -> a + x))",
            ),
        ),
    ),
))


def measured(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds the counts, the rule ratios ``_symbols`` … and ``_stratum``; no shuffle."""
    own = {*COUNTS, "_stratum", *(f"_{rule}" for rule in RULES)}
    kept = [name for name in documents.columns if name.lower() not in own]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = documents.select(
        *(F.col(f"`{name}`") for name in kept), body.alias("_body"), F.coalesce(F.col(f"`{lang}`"), F.lit("?")).alias("_stratum")
    )
    df = df.withColumn("_of", F.expr(_MEASURES)).select(
        *(F.col(f"`{name}`") for name in kept), "_body", "_stratum",
        F.col("_of.n_words").cast("long").alias("n_words"),
        (F.length("_body") - _number(F.col("_body"), BLANKS)).cast("long").alias("word_chars"),
        _number(F.col("_body"), SYMBOLS).alias("n_symbols"),
        F.col("_of.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("_of.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("_of.n_lines").alias("_n_lines"),
    )
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    characters = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    ratios = {
        "symbols": F.col("n_symbols") / characters,
        "marks": _number(F.col("_body"), "!?") / words,
        "repeats": F.col("n_repeat_words") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)).cast("double"),
    }
    return df.select(
        *(F.col(f"`{name}`") for name in kept),
        *COUNTS,
        *(ratios[rule].alias(f"_{rule}") for rule in RULES),
        "_stratum",
    )


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial (n, rate), summed as logarithms; 1 where k is not below its mean."""
    odds = F.log(F.lit(rate / (1 - rate)))
    first = n * F.log1p(F.lit(-rate))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + odds
        return F.struct(term.alias("term"), (term + F.log1p(F.exp(a["total"] - term))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k < n * rate, F.exp(F.aggregate(steps, start, step)["total"])).otherwise(F.lit(1.0))


def cutoffs(features: DataFrame, labels: DataFrame, limit: float = 0.05, error: float = 0.05, doc_id: str = "doc_id") -> DataFrame:
    """Certified cutoffs: a row (stratum, rule, cutoff, n, k) for each stratum and rule that has one."""
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality")).where("_quality = 1")
    )
    held = (
        features.where(~base_failed()).join(good, features[doc_id] == good["_id"])
        .groupBy("_stratum")
        .agg(F.count(F.lit(1)).alias("n"), *(F.count(F.when(F.col(f"_{rule}") > cut, 1)).alias(f"{rule}_{i}") for rule in RULES for i, cut in enumerate(GRID)))
    )
    tests = held.select(
        "_stratum", "n", F.explode(F.array(*(
            F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cutoff"), F.col(f"{rule}_{i}").alias("k"))
            for rule in RULES for i, cut in enumerate(GRID)
        ))).alias("test"),
    ).select("_stratum", "n", "test.*")
    strata = held.select(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("strata"))
    return (
        tests.join(F.broadcast(strata))  # one row
        .where(_tail(F.col("n"), F.col("k"), limit / len(RULES)) <= error / (len(RULES) * len(GRID)) / F.col("strata"))
        .groupBy(F.col("_stratum").alias("stratum"), "rule")
        .agg(F.min_by(F.struct("cutoff", "n", "k"), "cutoff").alias("best"))
        .select("stratum", "rule", "best.*")
    )


def judged(features: DataFrame, certified: DataFrame) -> DataFrame:
    """Adds base_failed and kept. ``certified`` has at most one row per rule and some hundred labels."""
    by_stratum = certified.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    over = [F.coalesce(F.col(f"_{rule}") > F.col(rule), F.lit(False)) for rule in RULES]
    rejected = over[0]
    for x in over[1:]:
        rejected = rejected | x
    kept = [name for name in features.columns if name not in ("base_failed", "kept")]
    return (
        features.join(F.broadcast(by_stratum), features["_stratum"] == by_stratum["stratum"], "left")
        .select(*(features[name] for name in kept), base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"))
    )
