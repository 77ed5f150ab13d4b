import pytest
from pyspark.sql import functions as F

from plantmetrics.llm.url_cascade import (
    CascadeSettings,
    UrlRule,
    build_cascade,
    judge_urls,
    listed_hosts,
)

PAGES = "page_id long, url string, verdict string, listed int, key string"


def _pages(spark, urls):
    return spark.createDataFrame([(k, url, "x", 7, "y") for k, url in enumerate(urls)], PAGES)


def test_hosts_paths_rules_and_odd_rows(spark):
    urls = [
        "http://A.Example.NET/EN/1", "https://a.example.net/en/1?x#y", "http://net", "http://net/", "ftp://x.net?q/",
        "http://example.com/de/", "http://notexample.com/de/", "http://b.org/fr/2", "http://borg/fr/2", None, "", "no scheme/x",
        "http://a://b.net/", "://cheap-pills.example.com", "http://m.cheap-pills.example.com/de/1", "http://xcheap-pills.example.com/",
    ]
    pages = _pages(spark, urls)
    rows = judge_urls(pages.union(pages), listed_hosts(spark, ["cheap-pills.example.com"])).collect()
    assert len(rows) == 2 * len(urls)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got == {
        0: ("a.example.net", "/EN/1", "net/", "block"),
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"),
        2: ("net", "", None, "allow"),
        3: ("net", "/", "net/", "block"),
        4: ("x.net", "", None, "allow"),
        5: ("example.com", "/de/", "example.com/de/", "block"),
        6: ("notexample.com", "/de/", None, "allow"),
        7: ("b.org", "/fr/2", "org/fr/", "allow"),
        8: ("borg", "/fr/2", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("", "", None, "allow"),
        12: ("a:", "//b.net/", None, "allow"),
        13: ("cheap-pills.example.com", "", None, "block"),
        14: ("m.cheap-pills.example.com", "/de/1", "example.com/de/", "block"),
        15: ("xcheap-pills.example.com", "/", None, "allow"),
    }
    assert judge_urls(pages.limit(0), listed_hosts(spark, ["a.b"])).count() == 0
    assert {r.verdict for r in judge_urls(pages, listed_hosts(spark, []), rules=()).collect()} == {"allow"}


def test_ties_between_rules(spark):
    rules = [UrlRule("allow", "b.c", "/xy"), UrlRule("block", "a.b.c", "/"), UrlRule("block", "b.c", "/xy")]
    rows = judge_urls(_pages(spark, ["h://a.b.c/xy", "h://z.b.c/xyz"]), listed_hosts(spark, []), rules).collect()
    assert [(r.rule, r.verdict) for r in sorted(rows)] == [("a.b.c/", "block"), ("b.c/xy", "allow")]


@pytest.mark.parametrize("max_bits", [1 << 20, 1])
def test_long_list_is_exact_with_and_without_cascade(spark, max_bits):
    """6,000 urls under 2,000 hosts, a third of them of one host; 700 listed keys, some with paths, some unseen."""
    hosts = [f"h{k % 2000}.site{k % 7}.example" if k % 3 else "hot.example" for k in range(6000)]
    urls = [f"http://{host}/p{k % 11}/x" for k, host in enumerate(hosts)]
    keys = [(f"h{k}.site{k % 7}.example", "") for k in range(0, 2000, 4)]
    keys += [("hot.example", "/p3/"), ("site5.example", "/p1"), (None, "/"), ("unseen.example", None), ("unseen.example", None)]
    listed = spark.createDataFrame(keys, "host string, path string")
    rows = judge_urls(_pages(spark, urls), listed, (), CascadeSettings(max_bits=max_bits)).collect()
    exact = {(h, p or "") for h, p in keys if h}

    def blocked(host, path):
        labels = host.split(".")
        return any(
            (".".join(labels[i:]), path[:j]) in exact for i in range(len(labels)) for j in range(len(path) + 1)
        )

    assert len(rows) == len(urls)
    assert all((r.verdict == "block") == blocked(r.host, r.path) for r in rows)
    assert 0 < sum(r.verdict == "block" for r in rows) < len(rows)


def test_levels_alternate_and_end(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 9 == 0).alias("listed"))
    cascade = build_cascade(universe)
    keys = [level.keys for level in cascade.levels]
    assert len(keys) >= 3 and keys[0] == 2223 and keys[1] < 17_777
    wrong = universe.where(cascade.holds(F.col("key")) != F.col("listed"))
    assert wrong.count() == 0
    assert build_cascade(universe.where("listed")).levels[0].keys == 2223
    assert build_cascade(universe.where("NOT listed")).levels == ()


def test_native(spark):
    plan = judge_urls(_pages(spark, ["http://a.net/"]), listed_hosts(spark, ["a.net"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Join", "Exchange"))
