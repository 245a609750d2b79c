from devmetrics.llm import url_filter

RULES = [(r.host, r.path, r.verdict) for r in url_filter.RULES]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return host, tail[:end]


def rule(host, path):
    fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fit, key=lambda r: len(r[0] + r[1]), default=None) if host else None


def test_rules(spark):
    urls = [
        None, "", "no host", "http://", "http://Org/x", "http://a.example.org/es/1?q", "https://a.EXAMPLE.org/en/12#f",
        "http://example.org/en/2", "http://badexample.org/es/", "x://www.b.com/fr/", "x://b.com/de/x", "x://b.com/en",
        "http://a.org", "http://a.org?x=/y", "http://u.net/a://b", "http://a.com/fr/\n\u00e9", "http://..com/fr/",
    ]
    df = spark.createDataFrame([(i, u, None, "r") for i, u in enumerate(urls)], "page_id bigint, url string, html string, rule string")
    got = {r["page_id"]: r for r in url_filter.url_verdicts(df).collect()}
    for i, u in enumerate(urls):
        host, path = parts(u)
        best = rule(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (best and best[0] + best[1])
        if best:
            assert got[i]["verdict"] == best[2]


def walk(edges, seeds):
    """Personalised PageRank by plain iteration; what reaches a host without links goes back to the seeds."""
    total = {}
    for (a, _), w in edges.items():
        total[a] = total.get(a, 0) + w
    mass = sum(seeds.values())
    score = dict(seeds)
    for _ in range(400):
        lost = sum(s for h, s in score.items() if h not in total)
        new = {h: (0.15 + 0.85 * lost / mass) * m for h, m in seeds.items()}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + 0.85 * score.get(a, 0) * w / total[a]
        score = new
    assert abs(sum(score.values()) - mass) < 1e-9
    return score


def test_many_hosts_without_links(spark):
    """Trust leaks into dead ends much more than distrust does; the proportions must not show it."""
    pages = [(i, f"http://dead{i}.net/", "") for i in range(30)]
    pages += [(100, "http://a.org/", " ".join(f'<a href="http://dead{i}.net/">' for i in range(30)) + '<a href="http://mixed.net">')]
    pages += [(101, "http://mixed.net/", '<a href="http://evil.com/de/">'), (102, "http://evil.com/de/", '<a href="http://mixed.net">')]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["host"]: r for r in url_filter.url_verdicts(df, tolerance=1e-12).collect()}
    edges = {("a.org", f"dead{i}.net"): 1 for i in range(30)} | {("a.org", "mixed.net"): 1, ("mixed.net", "evil.com"): 1, ("evil.com", "mixed.net"): 1}
    trust, distrust = walk(edges, {"a.org": 0.5}), walk({(b, a): w for (a, b), w in edges.items()}, {"evil.com": 0.5})
    for host, r in got.items():
        assert abs(r["trust"] - trust.get(host, 0)) < 1e-9 and abs(r["distrust"] - distrust.get(host, 0)) < 1e-9


def test_a_host_has_one_name_in_the_graph(spark):
    pages = [
        (1, "http://a.org/", '<a href="http://B.net:80/x"> <a href="http://b.net/"> <a href=//u@b.NET:8080/y> <a href="http://c.net">'),
        (2, "http://u@b.net:8080/", '<a href="https://evil.com:443/de/">'), (3, "http://evil.com/de/", ""), (4, "http://evil.com:8443/x", ""),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    links = url_filter.host_links(df.withColumn("host", url_filter.url_parts(df.url)[0]))
    assert sorted(map(tuple, links.collect())) == [("a.org", "b.net", 1.0), ("a.org", "c.net", 1.0), ("b.net", "evil.com", 1.0)]
    got = {r["page_id"]: r for r in url_filter.url_verdicts(df).collect()}
    assert got[2]["host"] == "u@b.net:8080" and got[2]["trust"] > 0 and got[2]["distrust"] > 0
    assert got[4]["host"] == "evil.com:8443" and got[4]["verdict"] == "block"


def test_trust_and_distrust_spread(spark):
    pages = [
        (1, "http://a.org/x", '<a href="http://good.net/">'), (2, "http://good.net/en/", "<a href=//ok.net:80/p>"),
        (3, "http://ok.net/", ""), (4, "https://evil.example.org/es/1", ""),
        (5, "http://shady.net/", '<a HREF="https://EVIL.example.org/es/1"> <a href="http://u@good.net/">'),
        (6, "http://plain.net/", '<a href="/en">'), (6, "http://plain.net/", '<a href="/en">'),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["host"]: r for r in url_filter.url_verdicts(df, tolerance=1e-12, max_steps=200).collect()}
    edges = {("a.org", "good.net"): 1, ("good.net", "ok.net"): 1, ("shady.net", "evil.example.org"): 1, ("shady.net", "good.net"): 1}
    trust = walk(edges, {"a.org": 0.5})
    distrust = walk({(b, a): w for (a, b), w in edges.items()}, {"evil.example.org": 0.5})
    for host, r in got.items():
        assert abs(r["trust"] - trust.get(host, 0)) < 1e-9 and abs(r["distrust"] - distrust.get(host, 0)) < 1e-9
    assert got["ok.net"]["verdict"] == got["good.net"]["verdict"] == got["plain.net"]["verdict"] == "allow"
    assert got["shady.net"]["verdict"] == "block"
    assert url_filter.url_verdicts(df.limit(0)).count() == 0


def test_many_small_hosts_are_judged_as_in_a_small_table(spark):
    """The registered query's own tolerance, on small scores some links from a seed."""
    far = 5
    links = [("shady.net", "evil.example.org"), ("behind.net", "shady.net")]
    links += [("far1.net", "evil.example.org")] + [(f"far{i}.net", f"far{i - 1}.net") for i in range(2, far + 1)]
    pages = [(i, f"http://{a}/", f'<a href="http://{b}/">') for i, (a, b) in enumerate(links)]
    pages += [(900, "http://evil.example.org/es/1", "")]
    schema = "page_id bigint, url string, html string"
    small = spark.createDataFrame(pages, schema)
    many = spark.range(1000, 400_000).selectExpr("id AS page_id", "concat('http://h', id, '.org/') AS url", "'' AS html")
    distrust = walk({(b, a): 1 for a, b in links}, {"evil.example.org": 1 / 399_001})
    for pages, scale in ((small, 399_001), (small.unionByName(many), 1)):
        got = {r["host"]: r for r in url_filter.url_verdicts(pages).filter("page_id < 1000").collect()}
        for host in distrust:
            assert got[host]["verdict"] == "block"
            assert abs(got[host]["distrust"] - scale * distrust[host]) < 1e-4 * scale * distrust[host]
