"""op3_html: elements without an end tag and names that only begin like a skipped element take nothing else with them."""

import pytest

from strata.llm.html_extract import main_text, page_lines


def text(html):
    return main_text(*page_lines(html), set())


@pytest.mark.parametrize("html, expected", [
    ('<article><p>one <svg-icon n="x"></svg-icon> two</p><p>three</p></article>', "one two\nthree"),
    ("<article><p>one</p><select-box><p>two</p></select-box><object-card>three</object-card></article>", "one\ntwo\nthree"),
    ('<article><p>one <svg width="1" /> two</p><math/><p>three</p></article>', "one two\nthree"),
    ('<article><p>one <svg a=">"><title>no</title></svg> two</p><canvas><p>three</p></article>', "one two\nthree"),
    ("<article><p>one</p><script>if (a<b) x = '</p>'</script><style>p > a</style><p>two</p></article>", "one\ntwo"),
    ("<body><div class=menu><a>Home</a><article><p>one</p></article></body>", "one"),
    ("<body><nav><ul><li>Home</ul><main><p>one</p></main></body>", "one"),
    ("<body><div><div class=ad>buy<article><p>one</p></article></div></body>", "one"),
    ("<article><section><div class=ad>buy</section><p>one</p></article>", "one"),
    ("<article><p>one</p><span class=share>x<section>y</section></article><article><p>two</p></article>", "one\ntwo"),
    ("<div class=comments><article><p>no</p></article></div><article><p>one</p></article>", "one"),
    ("<article><p>one</p></article><div class=comments><article><p>no</p></article>", "one"),
    ("<article><ul><li class=menu><ul><li>no</ul>no</li><li>one</ul></article>", "one"),
    ("<article><ul><li class=ad>no<li>one</ul></article>", "one"),
])
def test_nothing_else_is_dropped(html, expected):
    assert text(html) == expected


def test_many_elements_without_end_take_no_longer_than_their_text():
    assert text("<article>" + "<svg><p>x" * 20_000 + "<div class=ad><div>" * 2_000).count("x") == 20_000


@pytest.mark.parametrize("attrs, kept", [
    ('section id="related-work"', True), ('section id="search"', True), ('h2 id="notice-period"', True), ('h3 id="sharing-data"', True),
    ('div class="form-factor"', True), ('p class="menu-engineering"', True),
    ('div class="related-posts"', False), ('div class="search-form"', False), ('div class="share__buttons"', False), ('section class="comments"', False),
    ('div class="ad-box"', False), ('section class="newsletter-signup"', False),
])
def test_slugs_inside_an_article_mark_nothing(attrs, kept):
    tag = attrs.split()[0]
    assert text(f"<article><p>one</p><{attrs}>two</{tag}><p>three</p></article>") == ("one\ntwo\nthree" if kept else "one\nthree")
