"""op3_html: pages with an article go through the differencing as well."""

from strata.llm.html_extract import edges_of, extract

LONG = "Some more of the text that only this page has, "


def texts(spark, articles, url="http://h/a{}"):
    pages = [(i, url.format(i), f"<body><nav>Menu</nav><article>{''.join(f'<p>{x}</p>' for x in lines)}</article><div>Foot</div></body>") for i, lines in enumerate(articles)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    return [got[i].split("\n") for i in range(len(articles))]


def test_lines_of_all_neighbours_at_the_edges_of_an_article_are_template(spark):
    own = [[LONG + str(i), "Same in all", f"Words of page {i}, which go on for a while"] for i in range(20)]
    assert texts(spark, [["By the staff", *x, "Read on", "Send a letter"] for x in own]) == own


def test_lines_of_some_neighbours_stay(spark):
    pages = [["A heading" if i < 7 else f"Heading {i}", LONG + str(i), "Released under a licence" if i % 2 else f"End {i}"] for i in range(8)]
    assert texts(spark, pages) == pages
    # two articles: only one neighbour to tell
    pages = [["By the staff", LONG + str(i), "Read on"] for i in range(2)]
    assert texts(spark, pages) == pages


def test_versions_and_copies_of_an_article_keep_their_text(spark):
    body = [LONG + str(i) for i in range(6)]
    pages = [["By the staff", *body, f"Version {i}"] for i in range(5)] + [["By the staff", *body, "Version 0"]] * 3
    assert texts(spark, pages) == pages
    # beside pages of other text, which tell
    versions = [["By the staff", *body, f"Version {i}"] for i in range(3)]
    others = [["By the staff", LONG + f"of {i}", f"and {i}"] for i in range(10, 13)]
    assert texts(spark, versions + others) == [x[1:] for x in versions + others]


def test_edges_end_at_the_first_own_line():
    assert edges_of([{0, 1, 3, 5}, {0, 1, 3, 5, 4}], 6) == {0, 1, 5}
    assert edges_of([{0}], 6) == edges_of([], 3) == edges_of([set(), {0}], 1) == set()
