"""op3_html: inline template elements, attribute names that end like others, stray quotes, many open tags."""

import time

import pytest

from strata.llm.html_extract import main_text, page_lines


def text(html):
    return main_text(*page_lines(html), set())


@pytest.mark.parametrize("html, expected", [
    ('<article><p data-id="comment">one</p><p data-role="navigation">two</p><p data-testid=share>three</p></article>', "one\ntwo\nthree"),
    ('<article><p data-id="x" id="comment">one</p><p title="t"class="share">no</p><p>two</p></article>', "two"),
    ("<article><p>one <button>Share</button> two</p></article>", "one two"),
    ("<article><p>one <span class=share>a <b>b</b> <span>c</span></span> two</p><p>three</p></article>", "one two\nthree"),
    ("<article><p>one <span class=share>a<div>b</div>c</span> two</p></article>", "one two"),
    ("<article><p>one <button>Share</button></p><p><button>Share</button>two</p></article>", "one\ntwo"),
    ("<article><section><p>one <span class=ad>buy</section><p>two</p></article>", "one\ntwo"),
    ("<article><p>one <button>Share", "one"),
    ('<article><p title="5" tall">one</p><p>two</p></article>', "one\ntwo"),
    ("<article><p title='a>b' class=\"x>y\">one</p><p title=a\"b>two</p><p title = 'c > d'>three</p></article>", "one\ntwo\nthree"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
])
def test_blocks_keep_their_own_text(html, expected):
    assert text(html) == expected


@pytest.mark.parametrize("piece", ["<p title=\"x ", "<p a='x \" ", "<! x ", "<svg a=\" ", "<p ", "<!-- "])
def test_open_tags_take_time_in_proportion(piece):
    began = time.process_time()
    for _ in range(3):
        page_lines("<article><p>one</p>" + piece * 40_000)
    assert time.process_time() - began < 6
