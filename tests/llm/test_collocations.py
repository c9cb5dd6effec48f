"""op12: collocations against plain Python counting, with odd rows."""

import re
from collections import Counter

import pyarrow as pa

from waybill.llm import collocations
from waybill.sources.scratch import stored

SCHEMA = "doc_id long, text string, lang string, p1 string, cnt string, f string"


def brute(rows, least=3, top=5):
    """The contract in plain Python: counts per language, exact scores, subsumption, ranking."""
    per = {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        c = per.setdefault(lang, Counter())
        lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall(r"[^ \t]+", piece)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    c[tuple(w[i : i + k])] += 1
    out = []
    for lang, c in per.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        cands = {k: v for k, v in c.items() if len(k) in (2, 3) and v >= least}
        found = []
        for p, a in cands.items():
            if len(p) == 2 and any(len(q) == 3 and (q[:2] == p or q[1:] == p) and 100 * f >= 50 * a for q, f in cands.items()):
                continue
            cuts = [((10**6 * a * a) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n, score))
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, *r[1:]) for i, r in enumerate(found[:top]) if r[0] == lang]
    return sorted(out)


ROWS = [
    ("New York is big. new york is old; NEW york IS new", "en"),
    ("new york is big, really big", "en"),
    ("new york is big! new york is big", "en"),
    (None, "en"), ("", None), ("a b c a b c a b c. a b c", None), ("a b c a b c a b c. a b c", None),
    ("x\ty  z\xa0w x\ty x\ty", "en"), ("Über Straße über straße über straße", "de"),
    ("tie one tie two tie one tie two", "de"),
]


def test_collocations_match_brute(spark):
    frame = spark.createDataFrame([(i, t, l, "c", "c", "c") for i, (t, l) in enumerate(ROWS)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(frame, min_count=3, top=5).collect())
    assert got == brute(ROWS, 3, 5)
    assert got  # the fixture has candidates


def test_collocations_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.mine(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None, None), (2, ". ,;", "en", None, None, None)], SCHEMA)
    assert collocations.mine(blank, min_count=1).count() == 0


def test_slices_are_cut_between_pieces(monkeypatch):
    """Tiny slices in one process: every phrase is counted once, none over a cut."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 16)
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang} for t, lang in ROWS])
    whole = [sum(c[-1] for c in brute_phrases(k)) for k in (1, 2, 3)]
    for width, schema in ((1, collocations.WORDS), (2, collocations.ONES), (3, collocations.TWOS)):
        names = [x.split()[0] for x in schema.split(", ")]
        out = list(collocations._mapper(width, names)(iter([batch])))
        assert len(out) > 3  # more slices than languages
        assert sum(sum(x.column("cnt").to_pylist()) for x in out) == whole[width - 1]


def brute_phrases(k):
    for text, _ in ROWS:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text or ""):
            words = re.findall(r"[^ \t]+", piece)
            yield (max(0, len(words) - k + 1),)


def test_entries_are_merged_by_hash_and_rare_ones_not_stored(spark, monkeypatch):
    plans, tables = [], []

    def kept(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        tables.append(stored(df, purpose))
        return tables[-1]

    monkeypatch.setattr(collocations, "stored", kept)
    frame = spark.createDataFrame([(i, t, lang, "c", "c", "c") for i, (t, lang) in enumerate(ROWS)], SCHEMA)
    collocations.merged_stripes(frame, min_count=3)
    assert len(plans) == 3 and not any("SortAggregate" in x for x in plans)
    assert all(x.where("cnt < 3").count() == 0 for x in tables[1:])


def test_rare_parts_are_pruned_in_the_mapper(spark, monkeypatch):
    """No pair or triple with a rare part leaves a mapper, and no table of pairs is joined for that."""
    plans, made = [], []
    mapper = collocations._mapper

    def kept(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, purpose)

    def noted(width, names, frequent=None):
        made.append((width, names, frequent))
        return mapper(width, names, frequent)

    monkeypatch.setattr(collocations, "stored", kept)
    monkeypatch.setattr(collocations, "_mapper", noted)
    rows = [*ROWS, *[(f"rare{i} next{i} last{i} new york is rare{i}", "en") for i in range(50)]]
    frame = spark.createDataFrame([(i, t, lang, "c", "c", "c") for i, (t, lang) in enumerate(rows)], SCHEMA)
    words, ones, _ = collocations.merged_stripes(frame, min_count=3)
    assert not any("Broadcast" in x for x in plans)
    often = {(r["lang"], r["p1"]) for r in words.where("cnt >= 3").collect()}
    pairs = {(r["lang"], r["p1"], r["next"]) for r in ones.collect()}
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang} for t, lang in rows])
    for width, names, frequent in made[1:]:
        out = [r for x in mapper(width, names, frequent)(iter([batch])) for r in x.to_pylist()]
        assert out
        for r in out:
            if width == 2:
                assert {(r["lang"], r["p1"]), (r["lang"], r["next"])} <= often
            else:
                assert {(r["lang"], r["p1"], r["p2"]), (r["lang"], r["p2"], r["next"])} <= pairs
    got = sorted(tuple(r) for r in collocations.mine(frame, min_count=3, top=5).collect())
    assert got == brute(rows, 3, 5)


def test_batches_for_spark_are_bounded(monkeypatch):
    monkeypatch.setattr(collocations, "_ROWS", 3, raising=False)
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang} for t, lang in ROWS])
    out = list(collocations._mapper(1, ["lang", "p1", "word", "cnt"])(iter([batch])))
    assert max(x.num_rows for x in out) == 3
