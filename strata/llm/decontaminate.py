"""Benchmark decontamination with a positional inverted index (operator 1).

Test items become windows of ``width`` consecutive words (an item of fewer words is one window). The index stores, for
every document and test word, the word's positions; a document gets postings only for the words of windows all of
whose words it has, which no other document could match. Matching starts from each window's rarest word by the index's
own counts, shifts its list by the word's place in the window, and intersects with the other words' lists:

* phrase: every word stands at its place;
* near: every word stands within ``within`` words of the rarest one, in any order.

Words are runs of letters, digits and everything beyond ASCII, lower-cased in ASCII. The vocabulary goes to the
executors in blocks of at most ``block`` windows; each block is one pass over the texts, so any benchmark is matched in
whole.

Defined results: null texts have no words; an item without words has no window; items of null id hit words but are not
listed; items of equal id count once; equal documents get equal results. Empty tables give no rows or no hits. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import document_rows, keyed, map_rows
from strata.session import cut

#: Bytes to words: ASCII upper case to lower case, other ASCII but letters and digits to a space.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

POSTINGS = "array<struct<term:string,positions:array<int>>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TO_WORDS).split() if text else []


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``item_id, win, terms``: the distinct windows of each item; ``win`` is a digest of the words."""
    def work(c: dict) -> dict:
        items, wins = [], []
        for item, text in zip(c["item_id"], c["text"]):
            words = words_of(text)
            for win in dict.fromkeys(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else ():
                items.append(item)
                wins.append([w.decode("utf-8", "replace") for w in win])
        return {"item_id": items, "terms": wins}

    rows = map_rows(benchmark.select(F.col("item_id").cast("string"), "text"), work, "item_id string, terms array<string>")
    return cut(rows.distinct().select("item_id", F.md5(F.array_join("terms", " ")).alias("win"), "terms"))


def postings_of(text: bytes | None, vocabulary: frozenset, gate: dict[bytes, list[frozenset]]) -> tuple[int, list]:
    """Number of words, and the positions of the words of windows that the document could hold."""
    words = words_of(text)
    present = vocabulary.intersection(words)
    wanted: set[bytes] = set()
    for w in present:
        for terms in gate.get(w, ()):
            if terms <= present:
                wanted |= terms
    places: dict[bytes, list[int]] = {}
    if wanted:
        for i, w in enumerate(words):
            if w in wanted:
                places.setdefault(w, []).append(i)
    return len(words), [{"term": w.decode("utf-8", "replace"), "positions": at} for w, at in places.items()]


def build_index(docs: DataFrame, windows: DataFrame, block: int = 50_000) -> DataFrame:
    """``doc, n_words, block, postings``: one row per document and block of windows; ``doc`` is (doc_id, text hash)."""
    wins = windows.select("win", "terms").distinct()
    blocks = max(1, -(-wins.count() // block))
    index = None
    for b in range(blocks):
        own = wins.filter(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b)
        terms = [frozenset(t.encode() for t in r["terms"]) for r in own.collect()]  # about ``block`` windows
        often: dict[bytes, int] = {}
        for win in terms:
            for t in win:
                often[t] = often.get(t, 0) + 1
        gate: dict[bytes, list[frozenset]] = {}
        for win in set(terms):
            gate.setdefault(min(win, key=lambda t: (-len(t), often[t], t)), []).append(win)
        shared = docs.sparkSession.sparkContext.broadcast((frozenset(often), gate))

        def work(c: dict, shared=shared) -> dict:
            got = [postings_of(t, *shared.value) for t in c["text"]]
            return {"doc_id": c["doc_id"], "rk": c["rk"], "n_words": [n for n, _ in got], "postings": [p for _, p in got]}

        rows = map_rows(keyed(docs.select(F.col("doc_id").cast("bigint"), "text")), work, f"doc_id bigint, rk bigint, n_words bigint, postings {POSTINGS}")
        rows = rows.select(F.struct("doc_id", "rk").alias("doc"), "n_words", F.lit(b).alias("block"), "postings")
        index = rows if index is None else index.unionByName(rows)
    return cut(index)


def match(index: DataFrame, windows: DataFrame, within: int = 20) -> DataFrame:
    """``doc, win, start, words, phrase, near``: one row per place of a window's rarest word that matches either way.

    ``start`` is where the window begins in the document if ``phrase``.
    """
    lists = (index.filter(F.size("postings") > 0).dropDuplicates(["doc", "block"])
             .select("doc", F.explode("postings").alias("p")).select("doc", "p.term", "p.positions").dropDuplicates(["doc", "term"]))
    counts = lists.groupBy("term").agg(F.sum(F.size("positions")).alias("n"))
    slots = (windows.select("win", "terms").distinct().select("win", F.size("terms").alias("words"), F.posexplode("terms").alias("offset", "term"))
             .join(counts, "term"))
    order = Window.partitionBy("win").orderBy("n", "term", "offset")
    slots = slots.withColumn("rank", F.row_number().over(order)).withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("win")))
    slots = cut(slots.filter(F.col("found") == F.col("words")).select("win", "words", "offset", "term", "rank"))
    rarest = slots.filter("rank = 1").select("win", "words", F.col("offset").alias("first"), "term")
    found = (lists.join(rarest, "term").select("doc", "win", "words", "first", F.explode("positions").alias("at"))
             .select("doc", "win", "words", "at", (F.col("at") - F.col("first")).alias("start")))
    there = F.array_contains("positions", F.col("start") + F.col("offset"))
    close = F.exists("positions", lambda x: F.abs(x - F.col("at")) <= within)
    second = slots.filter("rank = 2").select("win", "offset", "term")
    alone = found.filter("words = 1").select("doc", "win", "words", "at", "start", F.lit(True).alias("phrase"), F.lit(True).alias("near"))
    pairs = (found.filter("words > 1").join(second, "win").join(lists, ["doc", "term"])
             .select("doc", "win", "words", "at", "start", there.alias("phrase"), close.alias("near")).filter("phrase OR near"))
    rest = slots.filter("rank > 2").select("win", "offset", "term")
    others = (pairs.filter("words > 2").join(rest, "win").join(lists, ["doc", "term"])
              .select("doc", "win", "words", "at", "start", (F.col("phrase") & there).alias("phrase"), (F.col("near") & close).alias("near"))
              .groupBy("doc", "win", "words", "at", "start")
              .agg(F.count(F.lit(1)).alias("n"), F.every("phrase").alias("phrase"), F.every("near").alias("near"))
              .filter((F.col("n") == F.col("words") - 2) & (F.col("phrase") | F.col("near"))).drop("n"))
    return alone.unionByName(pairs.filter("words = 2")).unionByName(others)


def report(docs: DataFrame, benchmark: DataFrame, width: int = 10, within: int = 20) -> DataFrame:
    """``doc_id, rk, n_words, n_hit, n_items, items_sha256, contaminated, n_near`` of every row; ``n_near`` counts the
    items one of whose windows has all its words close together in the document, as a phrase or not."""
    windows = item_windows(benchmark, width)
    index = build_index(docs, windows)
    found = cut(match(index, windows, max(within, width)))
    hit = (found.filter("phrase").select("doc", F.explode(F.sequence("start", F.col("start") + F.col("words") - 1)).alias("at"))
           .distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit")))
    items = (found.join(windows.filter(F.col("item_id").isNotNull()).select("win", "item_id"), "win")
             .groupBy("doc", "item_id").agg(F.max("phrase").alias("phrase")).groupBy("doc")
             .agg(F.count_if("phrase").alias("n_items"), F.count(F.lit(1)).alias("n_near"),
                  F.array_join(F.sort_array(F.collect_list(F.when(F.col("phrase"), F.col("item_id")))), ",").alias("items")))
    per_doc = (hit.join(items, "doc", "full")
               .select(F.col("doc").alias("hit_doc"), "n_hit", "n_items", "n_near", "items"))
    zero = F.lit(0).cast("bigint")
    # a document's row is that of its first block
    return (index.filter("block = 0").select("doc", "n_words").join(per_doc, F.col("doc") == F.col("hit_doc"), "left")
            .select("doc.doc_id", "doc.rk", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", zero) > 0).alias("contaminated"), F.coalesce("n_near", zero).alias("n_near")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no window of an item occurs."""
    windows = item_windows(benchmark, width)
    hit = match(build_index(docs, windows), windows).filter("phrase").select("doc").distinct()
    rows = document_rows(docs).withColumn("rk", F.xxhash64("text"))
    return rows.join(hit.select("doc.*").toDF("hit_id", "hit_rk"), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("rk") == F.col("hit_rk")), "left_anti").drop("rk")


ORACLE = r"""
WITH it AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS v FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM it WHERE len(w) > 0)),
dt AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w
       FROM documents),
dw AS (SELECT doc_id, i, w[i:i + n - 1] AS v FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
       FROM dt, (SELECT DISTINCT len(v) AS n FROM win) WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, win.item_id, i, len(dw.v) AS n FROM dw JOIN win ON dw.v = win.v),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT dt.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dt LEFT JOIN h ON dt.doc_id = h.doc_id LEFT JOIN q ON dt.doc_id = q.doc_id
"""
