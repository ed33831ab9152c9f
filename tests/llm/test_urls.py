import re
from collections import defaultdict

import duckdb

from kindred.llm import urls
from tests.conftest import rows

PAGES = [
    (1, "http://A.Example.NET/en/x?y=1", '<a href="http://good.test/a">'),
    (2, "https://a.example.net/de/", "<a href=https://bad.test>"),
    (3, "https://hub.test/", '<a href="http://bad.test/1"><a href="http://Bad.test/2"><A HREF="ftp://evil.net/">'),
    (4, "https://bad.test/x#frag", '<a href="/local">'),
    (5, "https://evil.net/", '<a href="https://hub.test/">'),
    (6, "https://evil.net", None),
    (7, "https://sub.evil.net/a?://b", ""),
    (8, None, None),
    (9, "no scheme here/en/", "x"),
    (10, "", "x"),
    (11, "http://example.com/de/1", '<a href="http://example.com/2">'),
    (12, "http://example.com/en/1", None),
    (13, "http://www.example.com/en/1", None),
    (14, "http://notexample.com/de/1", None),
    (15, "http://x.org/fr/", '<a href="http://notexample.com/">'),
    (15, "http://x.org/fr/", '<a href="http://notexample.com/">'),
    (None, "http://x.org/es/\nhttp://y", None),
    (16, "http://org/fr/", None),
    (17, "x://y://z/en/", None),
    (18, "http://net:80/", None),
    (19, "http://?q", None),
]


def frame(spark, pages):
    full = [(i, u, h, "n", 1) for i, u, h in pages]
    return spark.createDataFrame(full, "page_id long, url string, html string, host string, mass int").repartition(3)


def expected(pages, rounds=urls.ROUNDS, threshold=urls.THRESHOLD):
    parts = []
    for page_id, url, html in pages:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        parts.append((page_id, host, path, best, html or ""))
    hosts = defaultdict(list)
    for _, host, _, rule, _ in parts:
        if host:
            hosts[host].append(rule.verdict if rule else "")
    edges = {(h, d.lower()) for _, h, _, _, html in parts for d in re.findall(urls.LINK, html)}
    for h in list(hosts):
        while h.count(".") >= 2:
            parent = h.partition(".")[2]
            edges |= {(h, parent), (parent, h)}
            h = parent
    edges = {(a, b) for a, b in edges if a != b and a and b}
    total = defaultdict(int)
    for sign, verdict, arcs in ((-1, "allow", edges), (1, "block", {(b, a) for a, b in edges})):
        degree = defaultdict(int)
        for a, _ in arcs:
            degree[a] += 1
        seed = {h: urls.UNIT * v.count(verdict) // len(v) for h, v in hosts.items()}
        mass = {h: m * 15 // 100 for h, m in seed.items()}
        for _ in range(rounds):
            new = {h: m * 15 // 100 for h, m in seed.items()}
            for a, b in arcs:
                new[b] = new.get(b, 0) + mass.get(a, 0) // degree[a] * 85 // 100
            mass = new
        for h, m in mass.items():
            total[h] += sign * m
    return sorted(
        ((i, h, p, r and r.host + r.path, r.verdict if r else "block" if total[h] > threshold else "allow") for i, h, p, r, _ in parts),
        key=repr,
    )


def test_equals_brute_force(spark):
    got = rows(urls.judge(frame(spark, PAGES)))
    assert got == expected(PAGES)
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[3] == "block" and verdicts[4] == "allow" and verdicts[1] == "allow"


def test_links_without_a_scheme_and_hosts_that_share_a_name(spark):
    pages = [(1, "http://net/", None), (2, "http://blog.x.test/", '<a href="//net/a">'), (3, "http://m.x.test/", None)]
    pages += [(4, "http://far.test/", '<a href="/net">'), (5, "http://a.far.test/", None), (6, "http://b.c.d.e.test/", None)]
    got = rows(urls.judge(frame(spark, pages), threshold=1_000_000))
    assert got == expected(pages, threshold=1_000_000)
    # distrust of net reaches the page that links there, and through x.test, which has no page, its sibling
    assert {r[0] for r in got if r[4] == "block"} == {1, 2, 3}


def test_sql_equals_the_operator_on_linked_hosts(spark):
    hosts = ["blocked.net"] + [f"c{i}.test" for i in range(1, 14)]
    chain = [(0, "http://blocked.net/", "")] + [(i, f"http://{hosts[i]}/", f'<a href="http://{hosts[i - 1]}/">') for i in range(1, 14)]
    pages = [p for p in PAGES if p[0] is not None] + [(100 + i, u, h) for i, u, h in chain]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = sorted(con.sql(urls.oracle()).fetchall(), key=repr)
    assert rows(urls.judge(frame(spark, pages))) == want


def test_distrust_fades_along_a_chain(spark):
    hosts = ["blocked.net"] + [f"c{i}.test" for i in range(1, 13)]
    chain = [(0, "http://blocked.net/", None)]
    chain += [(i, f"http://{hosts[i]}/", f'<a href="http://{hosts[i - 1]}/">') for i in range(1, 13)]
    verdicts = {r[0]: r[4] for r in rows(urls.judge(frame(spark, chain)))}
    # 15 million times 0.85 to the power of the hops
    assert verdicts == {i: "block" if 15e6 * 0.85**i > urls.THRESHOLD else "allow" for i in range(13)}


def test_no_python_in_the_plan(spark):
    plan = urls.judge(frame(spark, PAGES))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty_table(spark):
    assert rows(urls.judge(frame(spark, []))) == []
