"""op7_fingerprint: equal roots mean equal texts, however short the written leaves are."""

from strata.llm import fingerprint as fp


def test_texts_whose_short_digests_were_equal():
    a, b = (fp.tree(f"doc {n}") for n in (1373255, 1459548))
    assert fp.written(a) != fp.written(b) and fp.likeness(a, b) < 1


def test_roots_tell_texts_apart_that_written_leaves_do_not(monkeypatch):
    monkeypatch.setattr(fp, "LEAF_BYTES", 1)
    texts = [f"text {n}" for n in range(2000)]
    trees = [fp.tree(t) for t in texts]
    assert len({t[0] for t in trees}) == len(texts) and len({str(t[1]) for t in trees}) <= 256
    twin = next(i for i in range(1, 2000) if trees[i][1] == trees[0][1])
    assert fp.likeness(trees[0], trees[twin]) == 0 and fp.likeness(trees[0], fp.tree(texts[0])) == 1
    assert fp.likeness(fp.tree(""), trees[0]) == 0 and fp.likeness(fp.tree(""), fp.tree("")) == 1


def test_the_root_follows_the_order_of_sections_and_leaves():
    lines = [f"line {n}" for n in range(40)]
    roots = {fp.tree("\n".join(x))[0] for x in (lines, lines[::-1], lines[1:], [*lines, ""], [lines[0] + lines[1], *lines[2:]])}
    assert len(roots) == 5
    whole = fp.tree("\n".join(lines))
    assert fp.read(fp.written(whole)) == whole
