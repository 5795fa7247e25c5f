"""Equal page rows are worked once and all returned; null and empty addresses stay apart."""

from strata.llm.html_extract import extract


def test_equal_rows_keep_their_number(spark):
    html = "<body><nav>Menu</nav><article><p>One &amp; two</p><p>three</p></article></body>"
    rows = [(1, "http://a.b/x", html)] * 40 + [(1, None, html), (1, "", html), (None, None, None), (None, None, None)]
    found = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = "One & two\nthree"
    assert sorted(map(repr, found)) == sorted(
        f"Row(page_id={i}, url={u!r}, text={t!r}, n_chars={len(t)})" for i, u, h in rows for t in [text if h else ""])
