"""URL filters against a plain reading of rules and links (operator 11)."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from conftest import SF001
from llm_fixtures import docs, nothing  # noqa: F401
from roomrate.llm import urls
from roomrate.llm.queries import ORACLE, QUERIES, URL_RULES


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    return lower(host), rest[len(host):].split("?", 1)[0].split("#", 1)[0]


def rule_of(url, rules):
    host, path = parts(url)
    best = None
    for action, r in rules:
        rh, _, rp = r.partition("/")
        if (host == lower(rh) or host.endswith("." + lower(rh))) and path.startswith("/" + rp):
            key = (len(r), len(rh), action == "allow")
            best = max(best, (key, lower(rh) + "/" + rp, action)) if best else (key, lower(rh) + "/" + rp, action)
    return best[1:] if best else (None, None)


def node(url):
    host, path = parts(url)
    query = url.split("#", 1)[0].partition("?")[2]
    return host + (path or "/") + ("?" + query if query else "")


def brute(rows, edges, rules):
    """rows: (id, url); edges: (url, url) of all links."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(node(a))] = find(node(b))
    said = {}
    for n in list(root):
        said.setdefault(find(n), set()).add(rule_of("x://" + n, rules)[1])
    out = []
    for i, url in rows:
        rule, action = rule_of(url, rules)
        if action is None:
            known = said.get(find(node(url)), set()) if parts(url)[0] or (url and "://" in url) else set()
            action = "block" if "block" in known and "allow" not in known else "allow"
        out.append((i, *parts(url), rule, action))
    return sorted(out, key=repr)


def tuples(df):
    return sorted((tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in df.collect()), key=repr)


def page(*links):
    return "<html><head>" + "".join(links) + "</head><body>text</body></html>"


def canonical(href):
    return f'<link rel="canonical" href="{href}">'


def refresh(to):
    return f"<META content='5; URL={to}' HTTP-EQUIV=Refresh>"


RULES = URL_RULES + [("block", "Bad.net/"), ("allow", "good.bad.net/ok/"), ("block", "w.x.y.z.net/a/b/"),
                     ("allow", "tie.net/q"), ("block", "tie.net/q")]
PAGES = [
    (1, "http://a.net/1", page(canonical("http://bad.net/home"))),
    (2, "https://b.net/2?q=1#top", page(refresh("/other"))),
    (3, "http://b.net/other", page(canonical("HTTP://A.net/1"))),
    (4, "http://ok.org/x", page(canonical("http://c.net/4"))),               # allowed: c.net/4 stays allowed
    (5, "http://c.net/4", page(canonical("http://bad.net/z"))),
    (6, "http://w.bad.net/", page()),
    (7, "http://good.bad.net/ok/1", page()),
    (8, "http://w.x.y.z.net/a/b/c", page()),
    (9, "http://d.net/dir/p?x", page("<!-- " + canonical("http://bad.net/") + " -->", "<script>'" + canonical("http://bad.net/") + "'</script>")),
    (10, "http://e.net/dir/p", page("<link\nhref='sub?a=1&amp;b=2' rel='ALTERNATE canonical'>")),
    (11, "http://e.net/dir/sub?a=1&b=2", page(canonical("//bad.net/q"))),
    (12, None, page(canonical("http://bad.net/"))),
    (13, "no scheme", page(canonical("http://bad.net/"))),
    (14, "http://f.net", None),
    (15, "ftp://g.com/de/x://y", ""),
    (16, "http://com/fr/", page()),
    (17, "http://xcom/fr/", page()),
    (18, "http://tie.net/q1", page()),
    (19, "http://h.net/?", page(canonical("mailto:x@bad.net"), canonical(""))),
    (20, "http://i.net/a", page(canonical("?p=2"), canonical("#here"))),
    (21, "http://i.net/a?p=2", page(canonical("http://bad.net/"))),
    (1, "http://a.net/1", page(canonical("http://bad.net/home"))),
    (None, "http://EXAMPLE.org/es/É", page()),
    (22, "http://" + "." * 3000 + "com/de/1", page()),
    (23, "http://j.net/" + "a/" * 30000, page()),
    (24, "://", page()),
]


def links():
    """Edges written out by hand beside the pages, targets joined by urllib."""
    of = {1: ["http://bad.net/home"], 2: ["/other"], 3: ["HTTP://A.net/1"], 4: ["http://c.net/4"],
          5: ["http://bad.net/z"], 10: ["sub?a=1&b=2"], 11: ["//bad.net/q"], 20: ["?p=2", "#here"],
          21: ["http://bad.net/"]}
    return [(u, urljoin(u, t)) for i, u, _ in PAGES for t in of.get(i, [])]


def frames(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for c in ("host", "rule", "node", "u", "component", "action", "id", "src"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_links_rules_and_aliases(spark):
    got = tuples(urls.judge(frames(spark), urls.rule_table(spark, RULES)))
    want = brute([(i, u) for i, u, _ in PAGES], links(), RULES)
    assert got == want
    verdict = {r[0]: r[4] for r in want}
    assert [verdict[i] for i in (1, 2, 3, 4, 5, 9, 10, 20)] == ["block"] * 3 + ["allow", "allow", "allow", "block", "block"]


def test_redirect_table_and_hot_component(spark):
    rows = [(i, f"http://hot.net/{i}", None) for i in range(600)] + [(1000, "http://cold.net/1", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    hops = spark.createDataFrame([(f"http://hot.net/{i}", "http://hub.net/") for i in range(600)]
                                 + [("http://hub.net/", "https://BAD.net/x#y"), (None, "http://cold.net/1"),
                                    ("http://cold.net/1", None)], "src string, dst string")
    judged = urls.judge(df, urls.rule_table(spark, RULES), hops)
    assert {(r.verdict, r.propagated, r.page_id < 600) for r in judged.collect()} == {
        ("block", True, True), ("allow", False, False)}


def test_query_is_its_sql(spark, duck):
    got = tuples(QUERIES["op11_url_filter"](spark, SF001))
    assert got == sorted(duck.execute(f"select page_id, host, path, rule, verdict from ({ORACLE['op11_url_filter']})").fetchall(), key=repr)
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    assert got == brute(rows, [], URL_RULES)
    assert {r[3] for r in got} > {"org/", "com/de/", None}


def test_sql_with_links(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    some = [(i, u, h) for i, u, h in PAGES if i != 24]
    con.executemany("insert into pages values (?, ?, ?)", some)
    got = sorted(con.execute(f"select page_id, host, path, rule, verdict from ({ORACLE['op11_url_filter']})").fetchall(), key=repr)
    assert got == brute([(i, u) for i, u, _ in some], links(), URL_RULES)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(df, urls.rule_table(spark, RULES)).count() == 0
    none = urls.judge(frames(spark), urls.rule_table(spark, [])).collect()
    assert len(none) == len(PAGES) and {(r.rule, r.verdict) for r in none} == {(None, "allow")}
