import re

import oracle
import pytest

from millrace.llm import url_rules as U
from millrace.llm.catalog import queries

FOLDER = "/root/testdata/sf0.001"


def test_same_result_as_sql(spark):
    assert oracle.differences(spark, oracle.duck(FOLDER), queries()["op7_url_rules"], FOLDER) is None


CASES = {
    "http://Example.com/en/x": ("example.com", "/en/x", "example.com/en/", "block"),
    "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://x.com": ("x.com", "", None, "allow"),
    "http://x.com?a=/b": ("x.com", "", None, "allow"),
    "http://x.net/es/1?q": ("x.net", "/es/1", "net/es/", "block"),
    "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
    "http://www.spam-farm.org/a": ("www.spam-farm.org", "/a", None, "block"),
    "http://x.org/not-spam-farm.html": ("x.org", "/not-spam-farm.html", None, "allow"),
    "x://y://z.com/": ("y:", "//z.com/", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://a.org/x\n/casino/": ("a.org", "/x\n/casino/", None, "block"),
}


def test_cases(spark):
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(CASES)] * 2, "page_id int, url string, host int")
    found = U.filter_urls(df).collect()
    assert len(found) == 2 * len(CASES)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == list(CASES.values())[row.page_id]


def test_patterns_equal_brute_force(spark):
    urls = [r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("url").collect()]
    urls += ["http://cheap-pills.org/?casino=1", "http://a.org/casino/", "http://m.x.org/?utm_source=1"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").distinct()
    found = {r.url: r.pattern_rule for r in U.pattern_verdicts(df, U.PATTERN_RULES).collect()}
    for url in urls:
        expected = next((r.name for r in U.PATTERN_RULES if re.search(r.pattern, url.lower())), None)
        assert found.get(url) == expected, url


def test_rules_need_tokens():
    with pytest.raises(ValueError):
        U.PatternRule("x", ".*", ())
    with pytest.raises(ValueError):
        U.PatternRule("x", "a-b", ("a-b",))


def test_empty(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0
