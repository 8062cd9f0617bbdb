import re

import pytest
from pyspark.sql import functions as F

from matchstream.llm import link_graph as G

SCHEMA = "page_id long, url string, html string, host string"


def ruled(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in G.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def brute_rank(edges, seeds):
    """Personalised PageRank by plain iteration."""
    total = sum(seeds.values())
    if not total:
        return {}
    restart = {h: w / total for h, w in seeds.items()}
    out = {}
    for (a, _), n in edges.items():
        out[a] = out.get(a, 0) + n
    rank = dict(restart)
    for _ in range(300):
        flow = {}
        for (a, b), n in edges.items():
            if a in rank:
                flow[b] = flow.get(b, 0) + rank[a] * n / out[a]
        back = 1 - 0.85 * sum(flow.values())
        rank = {h: 0.85 * flow.get(h, 0) + back * restart.get(h, 0) for h in {*flow, *restart}}
    return rank


def test_hosts_paths_and_rules(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    urls = {r.page_id: r.url for r in rows}
    odd = [None, "", "no host", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://a.com", "x://com/?q", "x://com?a/", "a://xcom/", "a://net/es/", "a://b.net/es", "://q.net/fr/1://r",
           "http://É.com/", "http://example.com/en/#f", "http://sub.www.example.com/en/", "a://u@b.com:80/"]
    pages = spark.createDataFrame([(-i, u, None, "old") for i, u in enumerate(odd, 1)], SCHEMA)
    urls |= {-i: u for i, u in enumerate(odd, 1)}
    found = G.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict").collect() + [
        r for r in G.op5_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", "verdict").collect()
    ]
    assert len(found) == len(urls)
    for r in found:
        host, path, rule, verdict = ruled(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def test_ranks_and_verdicts(spark):
    def page(i, url, *links):
        return (i, url, "".join(f'<a class=x HREF="{x}">t</a> <img src=\'/own.png\'>' for x in links), "old")

    rows = [
        page(1, "http://good.com/a", "http://near.org/x", "https://near.org/y", "/local"), page(2, "http://near.org/", "//far.org/z", "http://GOOD.com"),
        page(3, "http://far.org/", "http://bad.net/es/1"), page(4, "http://bad.net/es/1", "http://spam.org/"), page(5, "http://farm.org/", "http://bad.net/", "http://bad.net/b", "http://spam.org"),
        page(6, "http://spam.org/", "http://farm.org/"), page(7, "http://alone.org/"), page(7, "http://alone.org/"), (8, None, None, None), (None, "http://farm.org/q", None, None),
        page(9, "http://bad.net/en/", "http://good.com/"), page(10, "http://dead.org/", "http://nowhere.org/"),
    ]
    pages = spark.createDataFrame(rows, SCHEMA)
    edges = {}
    for _, url, html, _ in rows:
        host = ruled(url)[0]
        for dst in {x.lower() for x in re.findall(r'HREF="(?:https?:)?//([^/"]+)', html or "")}:
            if dst != host:
                edges[host, dst] = edges.get((host, dst), 0) + 1
    placed = pages.select(G.host_of(F.col("url")).alias("host"), F.col("html"))
    assert {(r.src, r.dst): r.links for r in G.host_edges(placed).collect()} == edges
    seeds = [{}, {}]
    for _, url, *_ in rows:
        host, _, _, verdict = ruled(url)
        if verdict:
            own = seeds[verdict == "block"]
            own[host] = own.get(host, 0) + 1
    trust, distrust = brute_rank(edges, seeds[0]), brute_rank({(b, a): n for (a, b), n in edges.items()}, seeds[1])
    found = G.filter_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=2e-3) and r.distrust == pytest.approx(distrust.get(r.host, 0), abs=2e-3)
        want = ruled(r.url)[3] or ("block" if distrust.get(r.host, 0) > trust.get(r.host, 0) else "allow")
        assert r.verdict == want
    verdicts = {r.host: r.verdict for r in found if r.rule is None}
    assert verdicts["farm.org"] == "block" and verdicts["near.org"] == "allow" and verdicts["alone.org"] == "allow"
    assert G.filter_urls(pages.where("false")).count() == 0


def test_links_and_pages_have_one_rule_for_hosts(spark):
    """Ports, user names and capitals: a link names the host that its page has."""
    rows = [(1, "http://A.org:8080/x", '<a href="http://me@mid.org:9090/y?z">', ""), (2, "http://me@mid.org:9090/y", "<img src='//END.org:1'>", ""),
            (3, "http://end.org:1?q", "z" * 300_000 + '<a href=https://a.org:8080#f>', ""), (4, None, '<a href="http://a.org:8080">', ""), (5, "http://b.org", None, "")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("host", G.host_of(F.col("url")))
    got = {(r.src, r.dst, r.links) for r in G.host_edges(pages).collect()}
    assert got == {("a.org:8080", "me@mid.org:9090", 1), ("me@mid.org:9090", "end.org:1", 1), ("end.org:1", "a.org:8080", 1)}
