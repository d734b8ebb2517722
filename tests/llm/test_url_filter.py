import re

from strata.llm import url_filter as U

URLS = [None, "", "no scheme", "http://example.org/es/1", "http://EXAMPLE.ORG/en/12?x=1", "https://a.example.org/en/2", "ftp://notexample.org/es/x",
        "http://org/", "http://org", "http://x.com/fr/1#a", "http://com/de/", "http://y.com/de", "http://y.com/DE/1", "http://z.net/login",
        "http://z.net/login2", "http://z.net/a?utm_source=feed", "http://z.net/search?q=a&lang=de", "http://z.net/search?q=a",
        "http://ads.z.net/banner/1", "http://z.net/casino-x/1", "http://z.net/f.exe", "http://z.net/f.exe?a", "x://://a", "http://z.net/\n/login\n",
        "http://a.b?c=/x://y", "http:///path", "http://z.net/wp-admin/", "a://b.org:80/es/", "http://example.org/es/1"]


def brute(url, rules):
    host, path, rest = "", "", ""
    if url and "://" in url:
        tail = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", tail)[0]
        path = re.match(r"[^?#]*", tail[len(host):])[0]
        rest = tail[len(host) + len(path):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    subject = host + path + rest
    hits = [r for r in rules if subject and re.search(r.regex.replace(r"\z", r"\Z"), subject)]
    listed = [r for r in hits if r.listed]
    best = max(listed or hits, key=lambda r: (r.size, -rules.index(r)), default=None)
    return (host, path, best.name if listed else None, best.verdict if best else "allow")


def check(pages, rules, given=None):
    rows = U.judge_urls(pages, given).collect()
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows), key=repr)
    want = sorted(((r["page_id"], *brute(r["url"], rules)) for r in pages.select("page_id", "url").collect()), key=repr)
    assert got == want


def test_default_rules_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    check(pages, U.default_rules())


def test_rules_without_a_token_and_no_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    rules = [U.compile_pattern("block", "*n"), U.compile_pattern("allow", "||z.net^"), U.host_rule("block", "org", "/e")]
    assert rules[0].tokens == () and rules[1].tokens == ("z", "net")
    check(pages, rules, rules)
    assert {r["verdict"] for r in U.judge_urls(pages, []).collect()} == {"allow"}


def test_hosts_by_the_letter(spark):
    pages = spark.createDataFrame([(1, "http://example.org/es/1"), (2, "http://sub.example.org/en/1x"), (3, "http://badexample.org/en/1"),
                                   (4, "http://org.com/fr/"), (5, "http://x.com/de/")], "page_id long, url string")
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge_urls(pages).collect()}
    assert out == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: ("com/fr/", "allow"), 5: ("com/de/", "block")}


def test_repeated_rows_and_an_empty_table(spark):
    pages = spark.createDataFrame([(1, URLS[3]), (1, URLS[3]), (None, URLS[4]), (None, None)], "page_id long, url string")
    assert U.judge_urls(pages).count() == 4
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_whole_table_matches_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), U.default_rules())
