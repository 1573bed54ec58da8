from lexloom.llm import urls


def slow(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


def slow_rule(host, path):
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


URLS = [None, "", "no scheme", "http://A.Example.NET/en/1?x#y", "http://example.net", "https://x.net?q=/en/", "http://b.org/fr/2", "http://xorg/fr/", "http://a.example.com/de/", "ftp://é.example.com/DE/x", "http://a://b/c", "http://h/\nx", "http://net/"]


def test_parts_and_rules(spark):
    frame = spark.createDataFrame([(i, u, "p") for i, u in enumerate(URLS)], "page_id long, url string, path string")
    for r in urls.filter_urls(frame).collect():
        host, path = slow(URLS[r.page_id])
        rule, verdict = slow_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert urls.filter_urls(frame.limit(0)).count() == 0


def judged(spark, rules, paths, host="site.example.com", **tree):
    frame = spark.createDataFrame([(i, p if "://" in p else f"http://{host}{p}") for i, p in enumerate(paths)], "page_id long, url string")
    got = urls.filter_urls(frame, rules, **tree).collect()
    assert len(got) == len(paths)
    return {paths[r.page_id]: r for r in got}


def test_tree_generalises_and_rejects_by_purity(spark):
    rules = (("block", "site.example.com", "/ads/a"), ("block", "site.example.com", "/ads/b"), ("block", "site.example.com", "/ads/c"), ("allow", "site.example.com", "/news/"))
    news = [f"/news/{w}" for w in ("x", "y")] + [f"/news/{i}/x" for i in range(60)]
    got = judged(spark, rules, [f"/ads/{c}{i}" for c in "abc" for i in range(30)] + ["/ads/zeta", *news, "/other/7"], fanout=3)
    # unlabelled /ads/zeta is like the other ads, /other is like the host, whose pages are of both kinds
    assert got["/ads/zeta"].rule is None and got["/ads/zeta"].template == "/ads/*" and got["/ads/zeta"].verdict == "block"
    assert got["/other/7"].verdict == "allow" and got["/other/7"].template == "/*/*" and got["/news/5/x"].template == "/news/*/*"


def test_shapes_of_variable_segments(spark):
    paths = ["/a/2024", "/a/my-long-title.html", "/a/0123456789abcdef01", "/a/one-two", "/a/"]
    frame = spark.createDataFrame([(p,) for p in paths], "p string").select("p", urls.shape_of(urls.F.col("p")).alias("s"))
    assert [r.s for r in frame.collect()] == ["a/0", "a/{slug}.html", "a/{id}", "a/one-two", "a/"]


def test_pages_without_a_rule_follow_the_nearest_labels(spark):
    """Pages shaped as in the test tables: one host's few pages are judged with the domain's, a mixed host's by branch."""
    paths = [f"http://h{i}.example.com/{lang}/{i}.html" for i in range(40) for lang in ("de", "en")]
    paths += [f"http://h{i}.example.org/{lang}/{i}" for i in range(40) for lang in ("fr", "es")]
    paths += ["http://new.example.com/en/1", "http://new.example.org/en/1", "http://other.test/x", None, "no scheme"]
    frame = spark.createDataFrame(list(enumerate(paths)), "page_id long, url string")
    got = {paths[r.page_id]: r for r in urls.filter_urls(frame).collect()}
    assert got["http://h3.example.com/en/3.html"].verdict == "block" and got["http://new.example.com/en/1"].verdict == "block"
    assert got["http://h3.example.org/es/3"].verdict == "allow" and got["http://new.example.org/en/1"].verdict == "allow"
    assert {got[p].verdict for p in ("http://other.test/x", None, "no scheme")} == {"allow"}


def test_repeated_rows_stay(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x")] * 3 + [(None, "http://a.org/x")], "page_id long, url string")
    assert urls.filter_urls(frame).count() == 4
