"""H2/H5: small groups are judged within one array, larger ones by joins; both give the same rows."""

import random

from strata.operators import hierarchy as H
from strata.operators import jump, peel

HIER = "tenant_id string, dimension_id string, hierarchy_id string, hierarchy_name string, from_level string, to_level string"
DIMS = "dimension_id string, child string, parent string"


def tables(spark):
    rng = random.Random(7)
    level = lambda n: None if rng.random() < 0.04 else f"L{rng.randrange(n)}"
    dims = [(f"D{d}", level(9), level(9)) for d in range(40) for _ in range(rng.randrange(9))]
    dims += [(f"D{d}", f"L{a}", f"L{b}") for d in range(40, 70) for a in range(9) for b in range(a + 1, 9)] + [(None, "L1", "L2")]
    hier = []
    for k in range(400):
        key = ("1", None if rng.random() < 0.03 else f"D{rng.randrange(72)}", f"H{k}", None if rng.random() < 0.03 else "h")
        chain = rng.sample(range(9), 5)
        if rng.random() < 0.6:
            chain = sorted(chain)
        hier += [(*key, f"L{a}", f"L{b}") for a, b in zip(chain, chain[1:])] if k % 2 else [(*key, level(5), level(5)) for _ in range(rng.randrange(1, 5))]
    return spark.createDataFrame(hier + hier[:50], HIER), spark.createDataFrame(dims, DIMS)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_small_and_large_groups_agree(spark, monkeypatch):
    hier, dims = tables(spark)
    for strict, limits in ((True, ((40, 10_000), (6, 20))), (False, ((40, 10_000),))):
        judged = H._validate_large(hier, dims, H.HIER_KEYS, strict)
        want = rows(judged)
        edges = rows(H.path_edges(hier).join(judged.filter("valid").select(*H.HIER_KEYS), H.HIER_KEYS, "left_semi"))
        assert len({x.split("reason=")[1] for x in want}) >= 6 and edges
        for small, bound in limits:
            monkeypatch.setattr(H, "SMALL", small)
            monkeypatch.setattr(H, "BOUND", bound)
            assert rows(H.validate(hier, dims, require_valid_dimension=strict)) == want
            assert rows(H.valid_hierarchies(hier, dims, require_valid_dimension=strict)) == edges


def test_small_groups_take_no_rounds(spark, monkeypatch):
    def none(*_, **__):
        raise AssertionError("a round over small groups")
    hier, dims = tables(spark)
    monkeypatch.setattr(H, "SMALL", 40)
    monkeypatch.setattr(peel, "peel", none)
    monkeypatch.setattr(jump, "jump", none)
    assert H.valid_hierarchies(hier, dims).count() > 0


def test_empty_tables(spark):
    hier, dims = tables(spark)
    assert H.validate(hier.limit(0), dims).count() == H.valid_hierarchies(hier.limit(0), dims.limit(0)).count() == 0
    assert {r.reason for r in H.validate(hier, dims.limit(0)).collect()} == {"EMPTY", "UNKNOWN_DIMENSION"}
