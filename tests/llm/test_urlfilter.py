from collections import Counter
from urllib.parse import quote

from conftest import SF_SMALL
from pyspark.sql import functions as F
from quarry.llm import queries, urlfilter
from tools_compare import same_rows

RULES = "host string, path string, verdict string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, stops: s[:min([s.find(c) for c in stops if c in s], default=len(s))]
    host = cut(rest, "/?#")
    return host.translate(LOW), cut(rest[len(host):], "?#")


def brute(urls, rules):
    out = []
    for u in urls:
        host, path = split(u)
        fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and p is not None and v
               and (host == h or host.endswith("." + h)) and path.startswith(p)]
        out.append((u, host, path, *(max(fit)[:1:-1] if fit else (None, None))))
    return out


def run(spark, urls, rules, listed=()):
    pages = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(urls)], "page_id long, url string, key string, block int")
    return [(r.page.url, r.host, r.path, r.rule, r.verdict, r.listed) for r in
            urlfilter.filter_urls(pages, spark.createDataFrame(rules, RULES),
                                  spark.createDataFrame([(x,) for x in listed], "url string")).collect()]


def test_query_equals_sql(spark, duck):
    df = queries.op12_url_filter(spark, SF_SMALL)
    rel = duck.execute(urlfilter.SQL)
    ok, why = same_rows(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in rel.description], rel.fetchall())
    assert ok, why


URLS = [None, "", "no scheme", "http://", "http://X.example.COM/en/1", "http://x.example.com", "https://example.com/en/",
        "https://www.example.com/en/a?b#c", "https://awww.example.com/en/a", "ftp://a.b.net/fr/x", "http://net/es/", "http://net",
        "http://anet/es/1", "http://a..net/es/1", "http://.net/es/1", "http://h/p://q", "http://example.com?x=/en/",
        "http://example.com#/en/", "http://example.com/EN/1", "http://www.example.com/en/\n", "http://u@example.com:80/en/1",
        "http://" + ".".join(["a"] * 5000) + ".net/es/" + "p" * 200_000, "http://é.example.com/en/é", "http://example.com/en/1"]


def test_rules(spark):
    rules = queries.URL_RULES
    found = run(spark, URLS + URLS[:4], rules)
    want = [(u, h, p, r, v or "allow", False) for u, h, p, r, v in brute(URLS + URLS[:4], rules)]
    assert Counter(found) == Counter(want)


def test_odd_rules(spark):
    rules = [("a.net", "/x", "allow"), ("a.net", "/x", "block"), ("net", "/x/yyy", "allow"), (None, "/", "block"), ("", "/", "block"),
             ("net", None, "block"), ("org", "", "block"), ("com", "/", None), ("B.Org", "", "allow"), ("b.a.net", "/", "allow")]
    low = [(h and h.lower(), p, v) for h, p, v in rules]
    urls = ["http://a.net/x/yyyy", "http://b.a.net/x/yyy", "http://q.org", "http://b.org", "http://c.b.org/z", "http://z.com/",
            "http://b.a.net/x", "http://a.net/xx"]
    want = [(u, h, p, r, v or "allow", False) for u, h, p, r, v in brute(urls, low)]
    assert Counter(run(spark, urls, rules)) == Counter(want)


def test_listed_addresses(spark):
    listed = ["https://www.site.org/a.html?utm_source=x&b=2&a=1#f", None, "http://site.org/a?a=1&b=2", "http://t.com/x"]
    urls = ["http://site.org/a/?b=2&a=1&ref=z", "http://site.org/a", "http://SITE.org:443/a?a=1&b=2", "http://t.com/x/", "http:///a"]
    rows = {r[0]: (r[3], r[4], r[5]) for r in run(spark, urls, [("com", "/", "allow")], listed)}
    assert rows[urls[0]] == rows[urls[2]] == (None, "block", True)
    assert rows[urls[1]] == rows[urls[4]] == (None, "allow", False)
    assert rows[urls[3]] == ("com/", "allow", True)  # a rule comes before the list


def test_empty(spark):
    assert run(spark, [], queries.URL_RULES) == []
    assert run(spark, ["http://a.net/es/"], []) == [("http://a.net/es/", "a.net", "/es/", None, "allow", False)]


def test_filter_loses_nothing_and_drops_most(spark):
    keys = spark.range(4000).select(F.concat(F.lit("=k"), F.col("id").cast("string")).alias("key"))
    blocks = 4000 * urlfilter.BITS_PER_KEY // urlfilter.BLOCK_BITS
    filter_ = urlfilter.bloom(keys, blocks)
    assert urlfilter.possible(keys, filter_, blocks).count() == 4000
    other = spark.range(40_000).select(F.concat(F.lit("=o"), F.col("id").cast("string")).alias("key"))
    assert urlfilter.possible(other, filter_, blocks).count() < 800  # under 2 %


def test_large_lists_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", 0)
    urls = URLS + [f"http://h{i}.example.net/{quote('é')}/{i % 9}" for i in range(200)]
    want = Counter((u, h, p, r, v or "allow", False) for u, h, p, r, v in brute(urls, queries.URL_RULES))
    assert Counter(run(spark, urls, queries.URL_RULES)) == want


def test_dotted_column_names_and_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/", 2, 3)], ["page_id", "url", "a.b", "x`y"])
    out = urlfilter.filter_urls(pages, spark.createDataFrame(queries.URL_RULES, RULES), spark.createDataFrame([], "url string"))
    assert out.first().page.asDict() == {"page_id": 1, "url": "http://a.net/es/", "a.b": 2, "x`y": 3}
    plan = queries.op12_url_filter(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
