"""Operator 1 on pages with several redirect links."""

from godown.llm import url_filter


def test_all_links_of_a_page_and_quoted_refresh_urls_count(spark):
    link, refresh = "<link rel='canonical' href='%s'>", '<meta http-equiv="refresh" content="0; url=%s">'
    bad = "http://b.net/es/1"
    pages = [("http://one.org/", link % "http://x.org/" + link % bad),
             ("http://two.org/", refresh % "http://y.org/" + refresh % bad),
             ("http://quoted.org/", refresh % f"'{bad}'"),
             ("http://double.org/", f"""<meta http-equiv=refresh content='0; URL="{bad}"'>"""),
             ("http://free.org/", link % "http://z.org/"), ("http://none.org/", None), (bad, "")]
    rows = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(rows).collect()}
    assert [got[i] for i in range(7)] == ["block"] * 4 + ["allow"] * 2 + ["block"]
