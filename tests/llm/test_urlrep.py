import re

import duckdb

from clickscope.llm import urlrep as U

from .conftest import SF_MID


def test_matches_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    got = sorted(map(tuple, U.op1_url_filter(spark, SF_MID).collect()), key=str)
    assert got == sorted(con.execute(U.OP1_SQL).fetchall(), key=str)


URLS = [None, "", "no scheme/x", "http://EXAMPLE.org/es/a", "http://sub.Example.org/en/12?x=/es/",
        "https://a.com/fr/", "https://a.com/de/#x", "http://com/de/", "http://notcom/de/", "ftp://x.org",
        "http://x.org/", "a://b.org?p=1", "http://\u00c9t\u00c9.COM/fr/x", "x://y://z.org/q", "http:///p",
        "http://q.example.org/es\n/x", "http://" + "l" * 50000 + ".org/" + "p" * 50000]


#: The rules as the contract has them.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(r), r, v) for r, v in RULES
            if (("." + host).endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path) + (max(fits)[1:] if fits else (None, None))


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, host int")
    votes = spark.createDataFrame([], "page_id long, good int")
    got = {r.page_id: r for r in U.judge(pages, votes).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")  # no labels: nothing is blocked


def test_contract_rules(spark):
    urls = {"http://example.org/en/1/x": "block", "http://a.example.org/en/123": "block", "http://example.org/en/2": "allow",
            "http://b.example.org/es/": "block", "http://x.com/fr/1": "allow", "http://x.com/de/1": "block"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = U.judge(pages, spark.createDataFrame([], "page_id long, good int")).orderBy("page_id").collect()
    assert [r.verdict for r in got] == list(urls.values())


def test_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")] * 3, "page_id long, url string")
    votes = spark.createDataFrame([(1, 1)] * 2, "page_id long, good int")
    assert [r.verdict for r in U.judge(pages, votes).collect()] == ["allow"] * 3


def test_reputation_shrinks_and_blocks(spark):
    pages, votes = [], []
    for host, n, good in (("bad.spam.net", 60, 3), ("new.spam.net", 1, 1), ("fine.net", 80, 75),
                          ("www.good.net", 200, 195), ("rare.net", 1, 0)):
        for i in range(n):
            votes.append((len(pages), int(i < good)))
            pages.append((len(pages), f"http://{host}/{i}"))
    pages.append((len(pages), "http://unseen.good.net/"))
    votes += [(0, None), (None, 1)]
    df = U.judge(spark.createDataFrame(pages, "page_id long, url string"),
                 spark.createDataFrame(votes, "page_id long, good int"))
    by = {r.host: r for r in df.collect()}
    assert by["bad.spam.net"].verdict == "block"
    assert by["rare.net"].verdict == "allow"  # one bad vote proves little
    assert by["fine.net"].verdict == by["www.good.net"].verdict == "allow"
    assert by["bad.spam.net"].reputation < by["new.spam.net"].reputation < by["unseen.good.net"].reputation
    assert by["bad.spam.net"].reputation > 3 / 60


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(pages, spark.createDataFrame([], "page_id long, good int")).count() == 0
