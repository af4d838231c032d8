import re

from cratewise.llm.urls import LABELLED, RULES, split_url, train, url_verdicts

URLS = [
    None,
    "",
    "no scheme/path",
    "http://",
    "http:///only/path",
    "HTTP://WWW.Example.ORG",
    "http://Example.org/es/x?y=/de/",
    "http://m.example.org/en/17#a?b",
    "http://example.org/en/2/1",
    "http://notexample.org/es/1",
    "https://a.b.com/fr/1",
    "https://com/de/1?x=://org/",
    "https://x.com/De/1",
    "ftp://host.net?query",
    "ftp://host.net#part/x",
    "http://İ.org/ü\n/x",
    "http://x.example.org/es/" + "y" * 100_000,
    "a://b://c/d",
]


def brute(url):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (match[1], match[2]) if match else ("", "")
    host = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), host)
    fits = [
        (f"{h}{p}", v)
        for h, p, v in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None))


def test_hosts_paths_and_rules(spark):
    rows = [(i % 15, url, "x", 1) for i, url in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, score int")
    found = url_verdicts(pages.drop("host", "score")).collect()
    assert len(found) == len(URLS)
    by_place = sorted((r.page_id, r.host, r.path, r.rule or "") for r in found)
    want = sorted((i % 15, *brute(url)[:2], brute(url)[2] or "") for i, url in enumerate(URLS))
    assert by_place == want
    verdicts = {(r.host, r.path): r for r in found}
    for url in URLS:
        host, path, _, verdict = brute(url)
        row = verdicts[host, path]
        assert row.verdict == (verdict or ("block" if row.score >= 0.5 else "allow"))
        assert split_url(url) == (host, path)


def test_extra_columns_do_not_matter(spark):
    schema = "page_id bigint, url string, host string, path int, rule int, score int, verdict int"
    pages = spark.createDataFrame([(1, "http://spam-farm.net/x", "h", 1, 2, 3, 4)], schema)
    row = url_verdicts(pages).first()
    assert (row.host, row.path, row.rule, row.verdict) == ("spam-farm.net", "/x", None, "block")


def test_unseen_hosts_are_judged_by_their_parts(spark):
    bad = ["casino-royal.example.net", "spam-farms.example.net", "adult-x.example.com", "cheap-pills.example.net"]
    good = ["tionsh.example.net", "library.example.net", "news.other.net", "the-river.example.net"]
    rows = [(i, f"http://{host}/en/5") for i, host in enumerate(bad + good)]
    found = url_verdicts(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert {r.host: r.verdict for r in found if not r.rule} == {
        **dict.fromkeys(bad, "block"), **dict.fromkeys(good, "allow")
    }


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_verdicts(none).count() == 0
    pages = spark.createDataFrame([(1, "http://spam-farm.net/")], "page_id bigint, url string")
    assert url_verdicts(pages, labelled=[]).first().verdict == "allow"
    assert abs(train(LABELLED).offset) < 5
