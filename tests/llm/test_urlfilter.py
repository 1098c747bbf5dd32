"""URL parts and rules against plain code, the model against labels it has not seen."""

import re

import pytest
from pyspark.sql import functions as F

from fraudtide.llm import urlfilter
from fraudtide.llm.labelled_urls import LABELLED

URLS = [
    None, "", "no scheme", "://", "https://", "https://A.Example.ORG", "http://a.example.org/es/x?y#z", "http://example.org/en/1", "http://notexample.org/en/1",
    "http://x.org/en/12", "ftp://EXAMPLE.org/en/1?://b.com/de/", "http://a.com/FR/", "http://b.a.com/fr/", "http://com/de/1", "http://a.net#://x.org/",
    "http://a.com?x=/de/", "http://a.com/de/é漢\n?q", "a://b://c/d", "http://ÄB.com/de/", "http://x.com./de/", "http://" + "a." * 50_000 + "org/" + "p" * 900_000,
]


def plain(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def plain_rule(host, path):
    fits = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def checked(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        host, path = plain(urls[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.score >= 0.5 else "allow")


def test_parts_and_rules(spark, sf_dir):
    odd = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumns({n: F.lit(-7) for n in ("host", "path", "rule", "score")})
    checked(urlfilter.verdicts(odd).collect(), dict(enumerate(URLS)))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    checked(urlfilter.verdicts(pages).collect(), {r.page_id: r.url for r in pages.collect()})


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "http://a.org/"), (1, "http://a.org/"), (None, "http://a.org/"), (None, None)]
    found = urlfilter.verdicts(spark.createDataFrame(rows, "page_id int, url string"))
    assert found.schema["page_id"].dataType.simpleString() == "int"
    assert [r.rule for r in found.collect()] == ["org/", "org/", "org/", None]
    assert urlfilter.verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_longest_rule_of_many_wins():
    book = urlfilter.RuleBook.of([urlfilter.Rule("allow", "b.c", "/x"), urlfilter.Rule("block", "a.b.c"), urlfilter.Rule("block", "c", "/xyzzy")])
    assert book.fitting("a.b.c", "/xy").name == "a.b.c/"
    assert book.fitting("a.b.c", "/xyzzy").name == "c/xyzzy"
    assert book.fitting("z.b.c", "/xyz").name == "b.c/x"
    assert book.fitting("bc", "/x") is None and book.fitting("", "/x") is None
    assert urlfilter.RuleBook.of([]).fitting("a.b", "/") is None


def test_labels_not_seen_are_told_apart(spark):
    right = []
    for fold in range(4):
        known = [r for i, r in enumerate(LABELLED) if i % 4 != fold]
        model = urlfilter.trained(spark.createDataFrame(known, "url string, label int"))
        for url, label in LABELLED[fold::4]:
            right.append((model.block([plain(url)[0]], [plain(url)[1]], urlfilter.Filter())[0] >= 0.5) == bool(label))
    assert sum(right) / len(right) >= 0.8


def test_odd_labelled_tables(spark):
    for rows, block in (([], 0), ([(None, 1), ("http://a.com/", None)], 0), ([("http://a.com/", 1)] * 3, 1), ([("x", 0)], 0)):
        model = urlfilter.trained(spark.createDataFrame(rows, "url string, label int"))
        assert model.block(["b.com", ""], ["/", ""], urlfilter.Filter()) == pytest.approx([block] * 2)


def test_reruns_agree(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    once, again = (sorted(tuple(map(str, r)) for r in urlfilter.verdicts(p).collect()) for p in (pages, pages.repartition(5)))
    assert once == again
