"""Page parsing and injected-model scoring."""

from tidewater.operators import scoring
from tidewater.sources import pages as P


def test_parse_page_rules():
    html = ("<html><head><title>T</title><script>var x='</p>';</script></head><body>"
            "<div class='meta'><a class='author'>Editorial Team</a></div><h1>Head &amp; line</h1>"
            "<p>one <b>bold</b> two<br>three<p class='x'>skip</p><p> </p><div class='sub-paywall-container'></div>"
            "<a href='/rel'>r</a></body></html>")
    r = P.parse_page("https://gcaptain.com/news/1", html)
    assert r["title_raw"] == "Head & line"
    assert r["nodes"] == ["one ", " two", "three", " "]
    assert r["author"] == "Editorial Team" and r["paywalled"] is True


def test_assemble_filters(spark):
    pages = spark.createDataFrame([
        (1, "https://gcaptain.com/a", "<h1>A</h1><div class='meta'><a class='author'>Editorial</a></div><p>x</p>"),
        (2, "https://gcaptain.com/b", "<h1>B</h1><p>body  text</p><p></p><p>more</p>"),
        (3, "https://maritime-executive.com/editorial/c", "<h1>C</h1><p>x</p>"),
        (4, "https://tradewinds.com/d", "<h1 class='article-title'>D</h1><div class='sub-paywall-container'></div>")],
        "page_id long, url string, html string")
    arts = P.assemble_articles(P.parse_pages(pages)).collect()
    assert [(a["_id"], a["headline"], a["description"]) for a in arts] == \
        [("https://gcaptain.com/b", "B", "body text more")]


def test_infer_batch_errors_are_rows(spark):
    df = spark.createDataFrame([("ok",), ("boom",)], "p string")

    def fn(p):
        if p == "boom":
            raise RuntimeError("quota")
        return p.upper()
    out = {r["p"]: (r["response"], r["response_error"]) for r in scoring.infer_batch(df, "p", fn).collect()}
    assert out["ok"] == ("OK", None) and out["boom"][0] == "Error occurred" and "quota" in out["boom"][1]
