from tidemark.llm import urls

CASES = [
    ("https://www.Example.NET/en/5?x=1", "www.example.net", "/en/5", "example.net/en/", "allow"),
    ("https://www.example.net/fr/5", "www.example.net", "/fr/5", "net/", "block"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://casino.org/fr/1", "casino.org", "/fr/1", "org/fr/", "allow"),
    ("http://casino.org/en/1", "casino.org", "/en/1", None, "block"),
    ("http://casinos.org/en/1", "casinos.org", "/en/1", None, "allow"),
    ("http://free.example.com/free", "free.example.com", "/free", None, "allow"),
    ("http://free.example.com/x?WIN=1", "free.example.com", "/x", None, "block"),
    ("http://freewin.example.com/", "freewin.example.com", "/", None, "allow"),
    ("http://example.net?q=/en/", "example.net", "", None, "allow"),
    ("http://a.net#/x", "a.net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("ftp://ÄB.net:80/x://y", "Äb.net:80", "/x://y", None, "allow"),
    ("no scheme/porn", "", "", None, "block"),
    ("http://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_cases(spark):
    frame = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)], "page_id int, url string, verdict string")
    got = {r.page_id: r for r in urls.judge(frame).collect()}
    for i, (_, *want) in enumerate(CASES):
        assert [got[i].host, got[i].path, got[i].rule, got[i].verdict] == want, CASES[i]


def test_weights(spark):
    frame = spark.createDataFrame([("http://x.com/free-free-cheap/spam?ads",), ("http://x.com/" + "a" * 100_000,)], "url string")
    rows = urls.judge(frame).collect()
    assert [(r.strict_terms, r.soft_terms) for r in rows] == [(1, 3), (0, 0)]
    assert urls.judge(frame.limit(0)).count() == 0
