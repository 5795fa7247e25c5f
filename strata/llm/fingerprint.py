"""Document fingerprints: Merkle trees over paragraphs and sections (operator 7).

Leaves end 80 to 160 characters on: of the ends of sentences there, behind the one before which the hash of the last 12
characters is least; where there is none, with the first sentence that ends within 400 characters; else behind white
space, else behind a character, again where the hash is least. Paragraphs are lines, and a section ends behind a
paragraph whose digest says so. Borders follow from the text near them, so behind an edit they soon fall where they
fell before. A paragraph's digest is that of its leaves, a section's that of its paragraphs, the root that of the
sections. The fingerprint is written as

    ROOT:LEAF.LEAF,LEAF;LEAF...      leaves by ".", paragraphs by ",", sections by ";"

The root follows from leaf digests of 16 bytes, so equal roots mean equal texts; the leaves are written by their first
5 bytes. Where roots differ, equal sections and paragraphs are matched whole and only differing branches are opened,
down to the leaves: ``likeness`` is twice the matched leaves over all leaves of both trees (one leaf of each is taken as
different if none shows in what is written), and ``differing`` lists the leaf ranges that have no equal in the other tree.

Neighbours are found by a range partitioning on (doc_id, hash of the text): texts move once, each partition is read in
order, and only its first and last row meet their neighbours in another partition.

Defined results: a null text is empty; an empty text has a root and no leaf; two empty texts are alike (1). Null ids
come first; rows of one id are ordered by the hash of their text; equal rows follow one another; the only document is
its own next one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Tables, keyed, map_rows

#: Where a leaf can end, the best first, and what the hash of such a border reads.
SENTENCE = re.compile(r"[.!?|]\s+")
SPACE = re.compile(r"\s+")
LEAST, USUAL, GREATEST, SEEN = 80, 160, 400, 12
FULL_BYTES, LEAF_BYTES, SECTION_OF = 16, 5, 4

Tree = tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]


def digest(text: bytes, size: int = FULL_BYTES) -> str:
    return blake2b(text, digest_size=size).hexdigest()


def leaves_of(line: str) -> list[str]:
    """The line cut at borders that its text sets; less than two of the least length stay whole."""
    out, at = [], 0
    while at < len(line):
        first, last = at + LEAST, min(at + USUAL, len(line))
        if ends := [m.end() for m in SENTENCE.finditer(line, first, last)]:
            pass
        elif m := SENTENCE.search(line, first, at + GREATEST):
            ends = [m.end()]
        elif len(line) - at < 2 * LEAST:
            ends = [len(line)]
        else:
            ends = [m.end() for m in SPACE.finditer(line, first, last)] or range(first, last + 1)
        end = ends[0] if len(ends) == 1 else min(ends, key=lambda p: crc32(line[p - SEEN:p].encode("utf-8")))
        out.append(line[at:end])
        at = end
    return out


def tree(text: str) -> Tree:
    """Root, and sections of paragraphs of written leaves, each with the digest that ``read`` gives it."""
    sections, section, above, inside = [], [], [], []
    for line in text.split("\n") if text else []:
        full = [digest(x.encode("utf-8")) for x in leaves_of(line)]
        leaves = [x[:2 * LEAF_BYTES] for x in full]
        name = digest("".join(leaves).encode(), 8)
        section.append((name, leaves))
        inside.append(digest("".join(full).encode()))
        if int(name[:2], 16) % SECTION_OF == 0:
            sections.append((digest("".join(p for p, _ in section).encode(), 8), section))
            above.append(digest("".join(inside).encode()))
            section, inside = [], []
    if section:
        sections.append((digest("".join(p for p, _ in section).encode(), 8), section))
        above.append(digest("".join(inside).encode()))
    return digest("".join(above).encode()), sections


def written(t: Tree) -> str:
    return t[0] + ":" + ";".join(",".join(".".join(leaves) for _, leaves in section) for _, section in t[1])


def read(fingerprint: str) -> Tree:
    """The tree of a written fingerprint; inner digests follow from the leaves."""
    root, _, rest = fingerprint.partition(":")
    sections = []
    for s in rest.split(";") if rest else []:
        paragraphs = []
        for p in s.split(","):
            leaves = p.split(".") if p else []
            paragraphs.append((digest("".join(leaves).encode(), 8), leaves))
        sections.append((digest("".join(p for p, _ in paragraphs).encode(), 8), paragraphs))
    return root, sections


def unmatched(a: list, b: list) -> tuple[list, list]:
    """What is left of both when equal digests are matched one to one."""
    common = Counter(x for x, _ in a) & Counter(x for x, _ in b)
    out = []
    for side in (a, b):
        left, rest = Counter(common), []
        for x in side:
            if left[x[0]]:
                left[x[0]] -= 1
            else:
                rest.append(x)
        out.append(rest)
    return out[0], out[1]


def likeness(a: Tree, b: Tree) -> float:
    if a[0] == b[0]:
        return 1.0
    size = sum(len(p[1]) for t in (a, b) for s in t[1] for p in s[1])
    left_a, left_b = unmatched(a[1], b[1])
    left_a, left_b = unmatched([p for s in left_a for p in s[1]], [p for s in left_b for p in s[1]])
    leaves_a, leaves_b = (Counter(x for p in side for x in p[1]) for side in (left_a, left_b))
    differ = leaves_a.total() + leaves_b.total() - 2 * (leaves_a & leaves_b).total()
    differ = max(differ, min(size, 2))  # roots differ, so a leaf does
    return (size - differ) / size if size else 0.0


def differing(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Ranges of leaves of ``a`` (first, end) in branches without an equal in ``b``."""
    if a[0] == b[0]:
        return []
    sections = Counter(s for s, _ in b[1])
    paragraphs = Counter(p for _, s in b[1] for p, _ in s)
    leaves = Counter(x for _, s in b[1] for _, p in s for x in p)
    at, out = 0, []
    for name, section in a[1]:
        for paragraph, own in section:
            for leaf in own:
                if not (sections[name] or paragraphs[paragraph] or leaves[leaf]):
                    out.append((out.pop()[0], at + 1) if out and out[-1][1] == at else (at, at + 1))
                at += 1
    return out


def edited(text: str, following: str) -> str:
    """The last half replaced by the first half's worth of the next text."""
    m = len(text) // 2
    return text[:len(text) - m] + following[:m]


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [x.split()[0] for x in RESULT.split(", ")]


def compare(doc_id: int | None, text: str, own: Tree, following: str, next_tree: Tree) -> tuple:
    changed = edited(text, following)
    other = tree(changed)
    return (doc_id, len(text), sha256(changed.encode("utf-8")).hexdigest(), written(own), written(other), likeness(own, other), likeness(own, next_tree))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row."""
    rows = keyed(docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")))
    ordered = rows.repartitionByRange("doc_id", "rk").sortWithinPartitions("doc_id", "rk")
    extra = "part_id bigint, part_rk bigint, edge string, text string"
    schema = pa.schema([(n, pa.float64() if n.startswith("near") else pa.int64() if n in ("doc_id", "n_chars", "part_id", "part_rk") else pa.string())
                        for n in [*NAMES, "part_id", "part_rk", "edge", "text"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is complete when the next one is seen; the first and the last also come as edges with their text."""
        first = last = None
        blank = (None,) * (len(NAMES) - 1)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, out = batch.slice(at, 128), []
                ids, texts, keys = (part.column(part.schema.get_field_index(n)) for n in ("doc_id", "text", "rk"))
                for doc_id, text, rk in zip(ids.to_pylist(), texts.to_pylist(), keys.to_pylist()):
                    t = tree(text)
                    if first is None:
                        first = (doc_id, rk)
                        out.append((doc_id, *blank, *first, "first", text))
                    else:
                        out.append((*compare(last[0], last[1], last[2], text, t), *first, None, None))
                    last = (doc_id, text, t)
                if out:
                    yield batch_of(out)
        if last is not None:
            yield batch_of([(last[0], *blank, *first, "last", last[1])])

    # written, as range bounds that are drawn anew would move the edges between two readers
    done = Tables(docs.sparkSession).put(ordered.mapInArrow(run, f"{RESULT}, {extra}"), compression="zstd")
    edges = done.filter(F.col("edge").isNotNull())
    # one row for each partition: which one follows, the first one after the last
    parts = edges.filter("edge = 'first'").select("part_id", "part_rk")
    order, every = Window.orderBy(F.col("part_id").asc_nulls_first(), "part_rk"), F.struct("part_id", "part_rk")
    following = parts.select("part_id", "part_rk", F.coalesce(F.lead(every).over(order), F.first(every).over(order)).alias("following"))
    heads = edges.filter("edge = 'first'").select(F.struct("part_id", "part_rk").alias("head"), F.col("text").alias("next_text"))
    lasts = edges.filter("edge = 'last'").select("doc_id", "text", F.struct("part_id", "part_rk").alias("own"))
    pairs = (lasts.join(following, F.col("own").eqNullSafe(every)).join(heads, F.col("following").eqNullSafe(F.col("head")))
             .select("doc_id", "text", "next_text"))

    def finish(c: dict) -> dict:
        out = []
        for doc_id, text, other in zip(c["doc_id"], c["text"], c["next_text"]):
            text, other = text.decode("utf-8"), other.decode("utf-8")
            out.append(compare(doc_id, text, tree(text), other, tree(other)))
        return dict(zip(NAMES, zip(*out))) if out else {n: [] for n in NAMES}

    return done.filter(F.col("edge").isNull()).select(*NAMES).unionByName(map_rows(pairs, finish, RESULT, 16))
