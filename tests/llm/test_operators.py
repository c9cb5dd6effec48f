"""The text operators against plain Python, on small tables with every odd case."""

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from waybill.llm import (  # noqa: E402
    decontaminate, html_text, license_scan, ngram_join, packing, quality_rules, substring_dedup, token_counts, toxicity, url_filter,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, low string, key string"


def words(seed, n):
    rng = random.Random(seed)
    return [f"{rng.choice(['ab', 'éc', 'zu', 'Or'])}{rng.randrange(400)}" for _ in range(n)]


def rows():
    base = words(1, 120)
    near = [*base[:60], "other", *base[61:]]
    passage = words(2, 40)
    out = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (3, " ".join(base)),
        (4, None), (5, ""), (None, "no id here"), (None, None), (6, "one two"), (7, "a " * 100),
        (8, " ".join([*words(3, 50), *passage, *words(4, 9)])), (9, "x\n\t" + "\n".join(passage) + "\xa0tail\x1cend"),
        (10, " ".join(words(5, 6000))), (11, "same line\nsame line\n \nother"), (12, "wide space parts nothing<|endoftext|>"),
        (13, "Café ÄÖ, don't #*$ 12 3"),
    ]
    return [(i, t, "en", "s", None if t is None else len(t), "clash", "clash") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


PAIRS = [(r[0], r[1]) for r in rows()]


def test_substring_dedup(docs, none):
    found = Counter(tuple(r) for r in substring_dedup.report(docs).collect())
    assert found == Counter(brute.substring_dedup(PAIRS))
    assert substring_dedup.report(none).count() == 0
    kept = substring_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(PAIRS)
    assert {r.doc_id: r.text.split() for r in kept.where("doc_id = 8").collect()}[8] == [*words(3, 50), words(2, 40)[-1], *words(4, 9)]  # row 9 ends the passage otherwise


def test_a_small_sketch_loses_nothing(docs):
    keyed = substring_dedup.keyed(docs)
    ranges = [substring_dedup.repeated_ranges(keyed, most_bits=bits).count() for bits in (16, 28)]
    assert ranges[0] == ranges[1] > 0


def test_decontaminate(spark, docs, none):
    items = [(1, " ".join(words(2, 40)[5:25])), (2, "One, two!"), (2, None), (None, " ".join(words(1, 12))), (3, "?!"), (4, "not there at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = Counter(brute.decontaminate(PAIRS, items))
    assert Counter(tuple(r) for r in decontaminate.report(docs, benchmark).collect()) == wanted
    assert decontaminate.report(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(none, benchmark).count() == 0
    in_blocks = decontaminate.spans_of(docs.select("doc_id", "text"), benchmark, block_windows=3)
    assert sum(y.high - y.low for r in in_blocks.collect() for y in r.spans) == sum(n * x[2] for x, n in wanted.items())
    assert "one two" not in [r.text for r in decontaminate.without_hits(docs, benchmark).collect()]


def test_ngram_join(docs, none):
    for block in (700, 2):
        found, classes = ngram_join.join(docs, block=block)
        got = found.join(classes, "key", "left").selectExpr("doc_id", "class_id", "coalesce(n_links, 0) n").collect()
        by_row = brute.jaccard_join(PAIRS)
        ids = [x[0] for x in PAIRS]
        wanted = Counter((ids[i], None if not PAIRS[i][1] else ids[c], n) for i, (c, n) in enumerate(by_row))
        assert Counter((r.doc_id, r.class_id, r.n) for r in got) == wanted
    assert ngram_join.report(none).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id <= 3").collect()) == [1]


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    path = packing.tokenizer_file("word_bpe_49k.json")
    n = brute.check_packing(PAIRS, packing.pack(docs, path).collect(), Tokenizer.from_file(path))
    total = sum(r.length for r in packing.pack(docs, path).collect())
    assert n == -(-total // 2048)
    assert packing.pack(none, path).count() == 0


def test_fullest_is_optimal():
    rng = random.Random(3)
    for _ in range(60):
        counts = Counter(rng.randrange(1, 60) for _ in range(rng.randrange(1, 12)))
        chosen = packing.fullest(dict(counts), 64)
        assert not Counter(chosen) - counts
        first, rest = max(counts), counts - Counter([max(counts)])
        sums = {0}
        for x in rest.elements():
            sums |= {s + x for s in sums}
        assert sum(chosen) == first + max(s for s in sums if s <= 64 - first)


def test_token_counts(docs, none):
    path = packing.tokenizer_file("piece_bpe_32k.model")
    scores = token_counts.scores_of(path)

    def pieces(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode())
            own = [(best[end - 1][0] + size * token_counts.BYTE_SCORE, -(-best[end - 1][1] + size))]
            own += [(scores[word[s:end]] + best[s][0], best[s][1] - 1) for s in range(end) if word[s:end] in scores]
            best.append(max(own))
        return -best[-1][1]

    wanted = Counter()
    for doc_id, text in PAIRS:
        own = brute.BLANK.findall(text or "")
        wanted[doc_id, len(own), sum(pieces(token_counts.MARK + x) for x in own)] += 1
    found = token_counts.count_tokens(docs, path)
    assert Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in found.collect()) == wanted
    assert token_counts.count_tokens(none, path).count() == 0


def test_quality_rules(spark, docs, none):
    found = quality_rules.measured(docs)
    assert Counter((r.doc_id, *(r[x] for x in quality_rules.COUNTS)) for r in found.collect()) == Counter((i, *brute.quality(t)) for i, t in PAIRS)
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (99, 0)], "doc_id long, quality int")
    certified = quality_rules.cutoffs(found, labels)
    assert certified.count() == 0  # one good text certifies nothing
    judged = quality_rules.judged(found, certified)
    assert judged.where("kept = base_failed").count() == 0 and judged.count() == len(PAIRS)
    assert quality_rules.measured(none).count() == 0


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    rate = 0.0125
    rows = spark.range(0, 12).selectExpr("id k", "cast(1200 AS bigint) n").withColumn("p", quality_rules._tail(F.col("n"), F.col("k"), rate)).collect()
    for r in rows:
        exact = sum(comb(r.n, j) * rate**j * (1 - rate) ** (r.n - j) for j in range(r.k + 1))
        assert r.p == pytest.approx(exact, rel=1e-9)


def test_cutoffs_reject_junk_and_keep_most_good(spark):
    rng = random.Random(9)
    texts = [(i, " ".join(words(i, 60)) if i % 4 else " ".join(x + "###" for x in words(i, 60)), "en", "s", 1, "", "") for i in range(4000)]
    docs = spark.createDataFrame(texts, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 > 0 or rng.random() < 0.002)) for i in range(4000)], "doc_id long, quality int")
    found = quality_rules.measured(docs)
    kept = {r.doc_id for r in quality_rules.judged(found, quality_rules.cutoffs(found, labels)).where("kept").collect()}
    assert all(i in kept for i in range(4000) if i % 4) and not any(i in kept for i in range(0, 4000, 4))


def test_url_filter(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?q#f"), (2, "https://net/x"), (3, "http://sub.example.com/de/1"), (4, "http://x.org/fr/"), (5, "http://x.net"),
        (6, None), (7, "no scheme"), (8, "a://b://c.net/p"), (9, "http://xexample.com/de/1"), (10, "http://example.com/de"), (10, "http://example.com/de"), (11, ""), (12, "http://é.net/ü#"),
    ]
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("net/", "block")]

    def judge(url):
        if not url or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = rest[:end].translate(brute.UP)
        tail = rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        best = None
        for rule, verdict in rules:
            domain, _, prefix = rule.partition("/")
            if ("." + host).endswith("." + domain) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[0])):
                best = rule, verdict
        return host, path, *(best or (None, "allow"))

    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "'x' AS host")
    for size in (100, 2):  # in one segment, in three
        index = url_filter.build_index(spark, rules, segment_rules=size)
        found = url_filter.judge(pages, index).collect()
        assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == Counter((i, *judge(u)) for i, u in urls)
    assert url_filter.judge(pages, url_filter.build_index(spark, [])).where("verdict = 'block'").count() == 0
    with pytest.raises(ValueError):
        url_filter.build_index(spark, [("no path", "block")])


def test_license_scan(spark, docs, none):
    rng = random.Random(2)
    texts = [(i, " ".join([*words(i, rng.randrange(0, 90)), notice, *words(-i, rng.randrange(0, 90))])) for i, (_, notice) in enumerate(license_scan.NOTICES)]
    found = license_scan.scan(spark.createDataFrame([*texts, (98, None), (99, "")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licenses for r in found} == {**{i: [name] for i, (name, _) in enumerate(license_scan.NOTICES)}, 98: [], 99: []}
    assert license_scan.scan(docs).where("n_hits > 0").count() == 0
    assert license_scan.scan(docs, []).count() == len(PAIRS) and license_scan.scan(none).count() == 0


def test_toxicity(spark, docs, none):
    rng = random.Random(4)
    texts = [(i, " ".join([*words(i, 30), *(["badword"] if i % 5 == 0 else [])])) for i in range(600)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    lm = toxicity.language_model(frame)
    model = toxicity.train(frame, labels, lm)
    assert set(model.weights) == {"badword"}
    tried = spark.createDataFrame([(1, "so b4dw0rd!"), (2, "so b a d w o r d it is"), (3, "baaaadword"), (4, "fine words"), (5, None), (6, ""), (6, "")], "doc_id long, text string")
    got = toxicity.score(tried, model, lm).collect()
    assert {r.doc_id: r.predicted for r in got} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0} and len(got) == 7
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0), lm), lm).count() == len(PAIRS)
    assert toxicity.score(none, model, toxicity.language_model(none)).count() == 0


def test_html_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a href=/>menu</a></nav><div class=ad>buy now and here</div>"
        "<article><h1>Head &amp; line</h1><p><b>First  one<br>two.<p>Second\n para, with some more words in it.</p><div class='comments'><p>I liked it a lot, thanks.</p></div></article>"
        "<footer>&copy; foot of the page</footer></body></html>"
    )
    pages = spark.createDataFrame([(i, f"u{i}", page) for i in range(40)] + [(90, None, None), (91, "u", ""), (92, "u", "<p>" * 3000 + "deep")], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_text.extract(pages, html_text.train(pages)).collect()}
    assert got[0].text == "Head & line First one two. Second para, with some more words in it."
    assert got[0].n_chars == len(got[0].text) and got[90].text == "" == got[91].text and len(got) == 43
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).count() == 0
