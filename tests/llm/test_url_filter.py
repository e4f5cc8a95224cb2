"""URL rules: the cascade is exact, odd URLs, other rule lists."""

from starloom.llm import url_filter


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:end].lower(), rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best and best[1], best[2] if best else "allow"


def test_odd_urls(spark):
    urls = [None, "", "no scheme/org/", "http://", "https://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://badexample.org/en/12",
            "x://org/", "x://org", "x://.org/a", "x://org./a", "a://b://c.com/de/", "http://q.com?/de/", "http://q.com#/fr/", "http://com/fr/1/de/",
            "http://" + "a." * 3000 + "com/de/" + "x" * 5000, "http://w.example.org/es"]
    frame = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = url_filter.judge(frame, url_filter.rule_table(spark, url_filter.RULES)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [plain(u, url_filter.RULES) for u in urls]
    assert url_filter.judge(frame.limit(0), url_filter.rule_table(spark, url_filter.RULES)).count() == 0


def test_cascade_is_exact_over_a_large_universe(spark):
    universe = spark.range(20_000).selectExpr("concat('key', id) as key")
    listed = spark.range(0, 20_000, 37).selectExpr("concat('key', id) as key")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    held = universe.filter(cascade.holds(url_filter.F.col("key")))
    assert held.count() == listed.count() and held.join(listed, "key", "left_anti").count() == 0
    bits = sum(level.size for level in cascade.levels)
    assert bits < 40 * listed.count()


def test_many_rules(spark):
    rules = [(f"h{i % 40}.net", f"/p{i}/", ("allow", "block")[i % 2]) for i in range(300)]
    urls = [f"http://www.h{i % 45}.net/p{i % 320}/x" for i in range(700)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge(frame, url_filter.rule_table(spark, rules)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [plain(u, rules) for u in urls]
