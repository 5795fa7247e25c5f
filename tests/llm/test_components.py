"""Classes of links, and classes after further links, against union-find."""

import random

from strata.llm.components import components, merged


def union_find(links):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {x: top(x) for x in up}


def test_classes_after_further_links(spark):
    draw = random.Random(3)
    first, more = ([(a, b) for a, b in ((draw.randrange(60), draw.randrange(60)) for _ in range(n)) if a != b] for n in (20, 15))
    table = lambda links: spark.createDataFrame(links, "a bigint, b bigint")
    labels = components(table(first))
    assert {r.node: r.label for r in labels.collect()} == union_find(first)
    for links in (more, []):
        rows = merged(labels, table(links)).collect()
        want = union_find(first + links)
        assert len(rows) == len(want) and {r.node: r.label for r in rows} == want
