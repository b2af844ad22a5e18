import re

from tidewater.llm import url_rules as u

URLS = [None, "", "no scheme", "http://A.Example.NET/en/x?utm_source=a", "http://example.net/EN/", "https://x.example.com/de/1",
        "https://example.com", "https://notexample.com/de/", "http://a.org/fr/1?utm_source=feed", "http://a.org/es?utm_source=feed",
        "http://a.org/utm/source", "ftp://net/", "x://net?y", "http://a.com/x://b.net/", "http://ads.foo.com/", "http://foo.com/login",
        "http://foo.com/Login?x", "http://foo.com/xlogin", "http://foo.com/a\nb/c?d", "http://\u00c9.org/fr/", "http://foo.com/" + "a/" * 50_000]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    h, p = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [r for r in u.HOST_RULES if (h == r[1] or h.endswith("." + r[1])) and p.startswith(r[2])]
    best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    low = re.sub("[A-Z]", lambda x: x[0].lower(), url or "")
    hits = ",".join(sorted(r.rule_id for r in u.PATTERNS if url is not None and re.search(r.pattern, low)))
    return h, p, best and best[1] + best[2], best[0] if best else "block" if hits else "allow", hits


def test_same_as_running_every_rule(spark):
    urls = URLS + URLS[3:5] * 3
    df = spark.createDataFrame([(i, x, "h") for i, x in enumerate(urls)] + [(None, URLS[3], "h")], "page_id long, url string, host string")
    rows = u.judge(df).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        if r.page_id is not None:
            assert tuple(r)[1:] == brute(urls[r.page_id])
    assert u.judge(df.limit(0)).count() == 0


def test_rules_lie_under_their_rarest_token(spark):
    df = spark.createDataFrame([("http://a/source",), ("http://b/source?utm=1",)], "url string")
    index = {r: t for t, r, _ in u.rule_index(df)}
    assert index["tracking"] == "utm" and index["print"] == "print"
