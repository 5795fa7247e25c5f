"""op3_html: copies of a page without an article keep their text, and so do passages that only two of several pages share."""

from strata.llm.html_extract import extract

TOP, END = "<html><body><div>Site line</div>", "<div>All rights reserved</div></body></html>"


def texts(spark, pages):
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in extract(table).collect()}


def test_copies_at_neighbouring_addresses_keep_their_text(spark):
    one = TOP + "<p>First text</p><p>goes on</p>" + END
    pages = [(1, "http://h/a", one), (2, "http://h/a?print=1", one), (3, "http://h/a/", one)]
    pages += [(4 + i, f"http://h/b{i}", TOP + f"<p>Text {i}</p>" + END) for i in range(20)]
    got = texts(spark, pages)
    assert got[1] == got[2] == got[3] == "First text\ngoes on"
    assert [got[4 + i] for i in range(20)] == [f"Text {i}" for i in range(20)]
    # nothing but copies: nothing to tell template from text
    only = texts(spark, pages[:2])
    assert only[1] == only[2] == "Site line\nFirst text\ngoes on\nAll rights reserved"


def test_passage_of_two_pages_stays_where_others_tell_the_template(spark):
    pages = [(i, f"http://h/{i}", TOP + f"<p>Text {i}</p>" + ("<p>A passage of both</p>" if i < 3 else "") + END) for i in range(1, 6)]
    got = texts(spark, pages)
    assert got[1] == "Text 1\nA passage of both" and got[2] == "Text 2\nA passage of both" and got[4] == "Text 4"


def test_print_version_of_an_article_keeps_its_text(spark):
    body = "<p>One line</p><p>two lines</p>"
    pages = [(1, "http://h/x", f"<body><div>Site line</div><article>{body}</article></body>"),
             (2, "http://h/x/print", f"<body><div>Site line</div>{body}</body>")]
    assert texts(spark, pages) == {1: "One line\ntwo lines", 2: "One line\ntwo lines"}
