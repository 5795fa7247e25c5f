"""HTML extraction by nearest-URL page differencing (operator 3).

A page becomes its text lines, one per block element, in page order. Its main candidates are the lines inside
``<article>`` (or ``<main>``, or the whole body where a page has neither), without the elements that hold menus,
notices, forms, comments and the like.

The differencing tells template from text, on every page. Pages of one host with equal candidates (reposts, print
versions, one page under several ids) are one class and get equal text: a copy tells nothing of what is template. The
classes of a host are numbered by the URL path of their first page and compared in blocks of eight neighbours (one or
two at the end join the block before), pair by pair by their longest common subsequence of lines: those inside an
article with those inside an article, the others with the others.

* Without an article, a candidate shared with two neighbours is template text and is deleted; where only one neighbour
  shares any candidate, that one decides.
* In an article the page's author has said what is text, so more is asked for: template are the lines at its head and
  its end that all neighbours with an article share, two at least. A neighbour that shares more than half of an
  article's characters is a version of it and tells nothing, so an article never loses half of its text.

Pages are compared by the hashes of their lines; only these and the places of deleted lines move between tasks.

Defined results: a null html is empty and gives empty text; a null url belongs to a host of its own (empty); pages of
equal host and path are ordered by query, page_id and html hash; equal rows get equal results. A host's only class has
nothing to be compared with. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Tables, map_rows
from strata.operators.sequence import row_number_by
from strata.session import cut

#: What may stand in a tag: a quote opens a value only behind "=", and only if it is closed somewhere.
GIVEN = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|select|object|canvas)(?=[\s/>])(?P<given>{GIVEN})>|<[!?][^>]*+(?:>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{GIVEN})(?:>|\Z)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|aria-label|hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

#: Elements whose text is skipped up to their end tag; of the first four all that follows is theirs where it is missing.
RAW = {x: re.compile(rf"</{x}\s*>", re.I) for x in "script style textarea iframe noscript template svg math select object canvas".split()}
RAW_TEXT = frozenset("script style textarea iframe".split())

#: Elements that begin a block, elements without an end tag, and elements that never hold main text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot
    th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the next one of their name ends.
IMPLIED = frozenset("li dt dd td th tr option".split())
ASIDE = frozenset("aside button dialog footer form head menu nav title".split())
#: Words of a class, id or role that mark what is not main text.
MARKS = frozenset("""ad ads advert advertisement adverts advertising adbox adslot banner bannerad billboard breadcrumb breadcrumbs byline comment
    commentlist comments complementary consent contentinfo cookie cookies disqus footer form gdpr hidden masthead menu modal nav navbar navigation
    newsletter notice notices overlay pager paginate pagination paywall popup promo promoted promotion related recommended replies reply
    respond search share sharing sidebar signup site-footer site-header skip social sponsor sponsored subscribe subscription tagcloud
    toc toolbar topbar widget widgets""".split())

#: Inside an article a compound word marks only if all its parts do or if it is one of these.
COMPOUNDS = frozenset(f"{head}-{tail}" for heads, tails in (
    ("ad ads advert advertisement banner", "area banner block box container frame holder label link placeholder slot space text unit wrap wrapper zone"),
    ("article banner content google inline sidebar side text top bottom", "ad ads advert advertisement"),
    ("related recommended promoted sponsored", "articles box content items links list news pages posts reading stories topics videos"),
    ("share sharing social", "bar box buttons button icons links list media tools widget this"),
    ("article content page post entry", "share sharing comments navigation nav pagination footer related"),
    ("search", "bar box button field input results"),
    ("comment comments", "area box count item link links list section thread title body content"),
    ("newsletter subscribe subscription signup", "bar block box button section wrapper"),
    ("cookie cookies consent gdpr", "bar box message policy popup"),
    ("nav menu navigation breadcrumb breadcrumbs pagination pager", "bar item items link links list next prev previous trail wrapper container"),
    ("widget sidebar toc", "area box container content list title wrapper"),
    ("main site page footer header", "nav menu navigation footer sidebar"),
) for head in heads.split() for tail in tails.split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup section".split())


def marked(word: str, in_article: bool) -> bool:
    parts = re.split(r"[-_:]+", word)
    if word in MARKS:
        return True
    if in_article and len(parts) > 1:
        return all(x in MARKS for x in parts) or "-".join(parts) in COMPOUNDS
    return parts[0] in MARKS or parts[-1] in MARKS


def off_topic(tag: str, attrs: str, in_article: bool) -> bool:
    """Does this element hold something other than main text?"""
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(r"""=\s*("[^"]*"|'[^']*')""", "", attrs)):
        return True
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        value = (a or b or c).lower()
        if name.lower() == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif name.lower() == "id" and in_article and tag in HEADINGS:
            continue  # a slug of the heading's words
        elif name.lower() in ("class", "id", "role", "itemprop"):
            for word in value.split():
                if marked(word, in_article) or tag == "article" and re.split(r"[-_:]+", word)[0] in ("teaser", "card"):
                    return True
    return False


def tokens(html: str) -> Iterator[tuple[re.Match, int]]:
    """Comments, tags and raw elements with the place where they end."""
    at, endless = 0, set()
    while m := TOKEN.search(html, at):
        at, raw = m.end(), (m["raw"] or "").lower()
        if raw and not (raw in ("svg", "math") and m["given"].endswith("/")) and raw not in endless:
            if end := RAW[raw].search(html, at):
                at = end.end()
            elif raw in RAW_TEXT:
                at = len(html)
            else:
                endless.add(raw)  # no end tag: only the tag itself is left out
        yield m, at


def without_end(html: str) -> tuple[set[int], dict[int, int]]:
    """Places of the elements whose end tag is missing, and the nearest open element of the same name around each."""
    stack: list[tuple[str, int]] = []
    missing, closed, around = set(), set(), {}
    opened: dict[str, list[int]] = {}
    for m, _ in tokens(html):
        tag = (m["tag"] or "").lower()
        if not tag or tag in VOID or (m["attrs"] or "").endswith("/"):
            continue
        if not m["close"]:
            places = opened.setdefault(tag, [])
            if places:
                around[m.start()] = places[-1]
            places.append(m.start())
            stack.append((tag, m.start()))
        elif opened.get(tag):
            closed.add(opened[tag].pop())
            if tag in BLOCKS:
                while stack[-1][1] not in closed or stack[-1][0] != tag:
                    name, place = stack.pop()
                    if place not in closed:
                        opened[name].pop()
                        missing.add(place)
                stack.pop()
    return missing | {place for _, place in stack if place not in closed}, around


def page_lines(html: str) -> tuple[list[str], list[int]]:
    """Lines of a page and where each lies: 0 template element, 1 body, 2 main, 3 article."""
    lines, places, buffer = [], [], []
    off: list[str] = []        # the template element that we are in, and the open elements inside it
    off_at = 0
    held: list[str] = []       # text of the block before an inline template element, which goes on behind it
    around: list[str] = []     # open block elements outside of it
    missing = None
    seen: set[str] = set()
    main = article = 0
    at = 0

    def flush() -> None:
        text = " ".join(unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            lines.append(text)
            places.append(0 if off else 3 if article else 2 if main else 1)

    def leave() -> None:
        """End the template element at the border of a block."""
        off.clear()
        buffer.extend(held)
        held.clear()
        flush()

    def unclosed() -> bool:
        """Is the end tag missing of the template element, or of one of its name around it that may have taken its place?"""
        nonlocal missing
        missing = missing or without_end(html)
        place: int | None = off_at
        while place is not None and place not in missing[0]:
            place = missing[1].get(place)
        return place is not None

    for m, end in tokens(html):
        if m.start() > at:
            buffer.append(html[at:m.start()])
        at = end
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        closing = bool(m["close"])
        if tag in BLOCKS:
            flush()
        if off:
            if closing and tag in off:
                if tag in BLOCKS or tag == off[0]:
                    flush()
                    while off.pop() != tag:  # what is still open inside ends with it
                        pass
                    if not off:
                        buffer.extend(held)
                        held.clear()
                continue
            if closing and tag in BLOCKS and (tag in around or off[0] in IMPLIED or off[0] == "p"):
                leave()  # an element whose end tag was left out ends with its parent
            elif off[0] == "p" and tag in BLOCKS and not closing:
                leave()
            elif off[0] == "head" and tag == "body":
                leave()
            elif tag in ("article", "main") and not closing and tag not in seen and unclosed():
                leave()
            elif len(off) == 1 and tag == off[0] in IMPLIED:
                leave()
            else:
                if not closing and (tag in BLOCKS or tag == off[0]) and tag not in VOID and tag != "p":
                    off.append(tag)
                continue
        if closing:
            article -= article > 0 and tag == "article"
            main -= main > 0 and tag == "main"
            if tag in around:
                while around.pop() != tag:
                    pass
        elif off_topic(tag, m["attrs"], article > 0):
            if tag not in VOID and not (m["attrs"] or "").endswith("/"):
                if tag in BLOCKS:
                    flush()
                held.extend(buffer)
                buffer.clear()
                off.append(tag)
                off_at = m.start()
        else:
            article += tag == "article"
            main += tag == "main"
            seen.add(tag)
            if tag in BLOCKS and tag not in VOID and tag != "p":
                around.append(tag)
    if at < len(html):
        buffer.append(html[at:])
    flush()
    leave()
    return lines, places


def shared(a: list, b: list) -> tuple[set[int], set[int]]:
    """Places of a longest common subsequence in both, by the bit-parallel recurrence over the rows of ``a``.

    Equal heads and tails are taken first; lines that occur on one side only can't be shared.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    in_a, in_b = set(range(head)), set(range(head))
    in_a.update(range(len(a) - tail, len(a)))
    in_b.update(range(len(b) - tail, len(b)))
    both = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    left = [i for i in range(head, len(a) - tail) if a[i] in both]
    right = [j for j in range(head, len(b) - tail) if b[j] in both]
    if not left or not right:
        return in_a, in_b
    where: dict[int, int] = {}
    for k, j in enumerate(right):
        where[b[j]] = where.get(b[j], 0) | 1 << k
    full, rows, v = (1 << len(right)) - 1, [], (1 << len(right)) - 1
    for i in left:
        u = v & where[a[i]]
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    k = len(right) - 1
    for r in range(len(left) - 1, -1, -1):  # a zero bit in row r: column k ends a longer match
        while k >= 0 and rows[r] >> k & 1:
            k -= 1
        if k < 0:
            break
        if r == 0 or rows[r - 1] >> k & 1:
            in_a.add(left[r])
            in_b.add(right[k])
            k -= 1
    return in_a, in_b


def line_hash(line: str) -> bytes:
    return blake2b(line.encode("utf-8", "replace"), digest_size=8).digest()


def packed(lines: list[str], places: list[int]) -> bytes:
    """Hashes, lengths and places of a page's lines, all that a comparison needs."""
    return b"".join([line_hash(x) for x in lines]) + array("I", map(len, lines)).tobytes() + bytes(places)


def unpacked(z: bytes) -> tuple[list[bytes], list[int], list[int]]:
    n = len(z) // 13
    return [z[i:i + 8] for i in range(0, 8 * n, 8)], array("I", z[8 * n:12 * n]).tolist(), list(z[12 * n:])


def edges_of(voices: list[set[int]], n: int) -> set[int]:
    """Of an article's ``n`` lines those at its head and its end that all voices share."""
    if len(voices) < 2:
        return set()
    common = set.intersection(*voices)
    head = next((k for k in range(n) if k not in common), n)
    tail = next((k for k in range(n) if n - 1 - k not in common), n)
    return {*range(head), *range(n - tail, n)}


def template(pages: list[tuple[list[bytes], list[int], list[int]]], article: list[bool]) -> list[set[int]]:
    """Template lines of each page, counted among its candidates and told by the other pages of its block (none has the
    same candidates)."""
    inside = [[k for k, p in enumerate(places) if p == 3] for _, _, places in pages]
    outside = [[k for k, p in enumerate(places) if p < 3] for _, _, places in pages]
    best = [max(places, default=0) for _, _, places in pages]
    said: list[list[set[int]]] = [[] for _ in pages]
    for i in range(len(pages)):
        for j in range(i):
            both = article[i] and article[j]
            own = [(inside if both else outside)[at] for at in (i, j)]
            found = shared(*([pages[at][0][k] for k in lines] for at, lines in zip((i, j), own)))
            for at, lines, hit in zip((i, j), own, found):
                if both:
                    lengths = pages[at][1]
                    if 2 * sum(lengths[lines[k]] for k in hit) <= sum(lengths[k] for k in lines):
                        said[at].append(hit)
                elif not article[at]:
                    lines = {lines[k] for k in hit if pages[at][2][lines[k]] == best[at] > 0}
                    if lines:
                        said[at].append(lines)
    out = []
    for at, found in enumerate(said):
        if article[at]:
            out.append(edges_of(found, len(inside[at])))
        else:
            times = Counter(k for lines in found for k in lines)
            number = {k: i for i, k in enumerate(k for k, p in enumerate(pages[at][2]) if p == best[at])}
            out.append({number[k] for k, n in times.items() if n >= min(2, len(found))})
    return out


def main_text(lines: list[str], places: list[int], deleted: set[int]) -> str:
    """The candidates (those of the best place) without the deleted ones."""
    best = max(places, default=0)
    own = [x for x, p in zip(lines, places) if p == best and p > 0]
    return "\n".join(x for i, x in enumerate(own) if i not in deleted)


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"


BLOCK = 8


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", F.col("html"), F.xxhash64(url, html, F.col("url").isNull()).alias("rk"))

    def parsed(h: bytes | None) -> tuple[list[str], list[int]]:
        return page_lines((h or b"").decode("utf-8", "replace"))

    def keys_of(c: dict) -> dict:
        """Pages whose main candidates are equal are one class."""
        out: dict[str, list] = {"article": [], "same": []}
        for h in c["html"]:
            lines, places = parsed(h)
            own, text = 3 in places, main_text(lines, places, set())
            out["article"].append(own)
            out["same"].append(int.from_bytes(blake2b(f"{own}{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True))
        return {k: c[k] for k in ("page_id", "rk", "url")} | out

    def lines_of(c: dict) -> dict:
        return {k: c[k] for k in ("page_id", "rk")} | {"z": [packed(*parsed(h)) for h in c["html"]]}

    def texts_of(c: dict) -> dict:
        return {k: c[k] for k in ("page_id", "rk", "url")} | {"text": [main_text(*parsed(h), set()) for h in c["html"]]}

    address = F.coalesce("url", F.lit(""))
    found = map_rows(rows, keys_of, "page_id bigint, rk bigint, url string, article boolean, same bigint", 64)
    keys = cut(found.select("page_id", "rk", "url", "article", "same", F.lower(F.regexp_extract(address, HOST, 1)).alias("host"))
               .distinct().withColumn("cid", F.xxhash64("host", "same")))
    first = F.min(F.struct(F.regexp_extract(address, PATH, 1).alias("path"), address.alias("whole"), "page_id", "rk")).alias("first")
    classes = keys.groupBy("host", "cid", "article").agg(first).select("host", "cid", "article", "first.*")
    numbered = row_number_by(classes, ["host"], ["path", "whole", "page_id", "rk", "cid"], "n")
    sizes = cut(numbered.groupBy("host").agg(F.max("n").alias("classes")))
    last = F.greatest(F.floor((F.col("classes") - 3) / BLOCK), F.lit(0))  # one or two at the end go with the block before
    placed = cut(numbered.join(sizes, "host").select(
        F.col("page_id").alias("pid"), F.col("rk").alias("prk"), "cid", "article", F.col("n").cast("bigint"),
        F.xxhash64("host", F.least(F.floor((F.col("n") - 1) / BLOCK), last)).alias("block")))
    # a block's only class has nothing to be compared with
    several = placed.groupBy("block").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("block")
    placed = placed.join(several, "block", "left_semi")
    lines = map_rows(rows, lines_of, "page_id bigint, rk bigint, z binary", 64)
    joined = lines.join(placed, F.col("page_id").eqNullSafe(F.col("pid")) & (F.col("rk") == F.col("prk"))).select(
        "cid", "article", "n", "block", "z")

    def difference(c: dict) -> dict:
        """Blocks of neighbours, one page of each class: the lines that a class loses, if any."""
        out: dict[str, list] = {"cid": [], "gone": []}
        for group in c["pages"]:
            group = sorted(group, key=lambda p: p["n"])
            for p, gone in zip(group, template([unpacked(p["z"]) for p in group], [p["article"] for p in group])):
                if gone:
                    out["cid"].append(p["cid"])
                    out["gone"].append(sorted(gone))
        return out

    blocks = joined.groupBy("block").agg(F.collect_set(F.struct("n", "cid", "article", "z")).alias("pages"))
    gone = map_rows(blocks, difference, "cid bigint, gone array<int>", 16)
    # written, so that its size is known: where few pages lose lines the texts are not dealt out for the join
    gone = Tables(pages.sparkSession).put(keys.join(gone, "cid").select(F.col("page_id").alias("pid"), F.col("rk").alias("prk"), "gone"))
    texts = map_rows(rows, texts_of, "page_id bigint, rk bigint, url string, text string", 64)
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    whole = texts.join(gone, F.col("page_id").eqNullSafe(F.col("pid")) & (F.col("rk") == F.col("prk")), "left")
    return (whole.select("page_id", "url", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"))
            .withColumn("n_chars", F.length("text").cast("bigint")))
