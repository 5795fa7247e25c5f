"""Log-likelihood of documents under a gated recurrent language model (operator 12).

Tokens are the words of the text with A-Z lowered, then one end. Three passes over the texts' tokens:

1. Every word is counted over all documents and over the training ones (a Counter a task, then a shuffle by word).
   ``FREQUENT`` words at most, the most frequent of all, come to the driver: the bound is found from a histogram of the
   counts. ``WORDS`` of these have tokens of their own; every other word is written by its shape (its last bytes and its
   length), of which there are ``SHAPES``. Given its shape, a word is as likely as its exact training count says.
2. Every document is encoded once: token numbers, and the words that are not among the frequent ones. These words meet
   their counts in a join by word; none of them has more than about 1 / FREQUENT of all tokens, so no key is hot.
3. The network (``recurrent``) learns by truncated backpropagation. It starts from the counts, is warmed up on a bounded
   sample (``WARM_DOCS`` documents of at most ``WARM_TOKENS`` tokens), then every task goes on from there over all
   training documents of its part, and the tasks' parameters are averaged by tokens in a shuffle. Scoring carries the
   state through whole documents.

The averaged network depends on how the tables are split into tasks; with the same split reruns agree.

Defined results: a null text is an empty one, whose only token is the end; a null doc_id counts as empty text in the
held-out rule; equal rows count each; without training documents every count is 0 and the base score 0. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import recurrent as R
from strata.llm.common import Tables, crc_mod

WORDS = 1024
SHAPES = 32
FREQUENT = 1 << 17
#: Words that a task counts before it passes the counts on.
HELD_WORDS = 800_000
WARM_DOCS, WARM_TOKENS = 1000, 4000
#: Tokens that a task trains on or scores at once (whole documents).
TRAIN_TOKENS, SCORE_TOKENS = 600_000, 1_500_000
#: Columns in which parameters are added up.
WIDE = 64
LN10 = float(np.log(10))


def words_of(text: bytes | None) -> list[bytes]:
    """``bytes.lower`` lowers A-Z alone and ``bytes.split`` cuts at 0x20 and 0x09-0x0D alone."""
    return (text or b"").lower().split()


def shape_of(word: bytes) -> int:
    return (crc32(word[-2:]) + min(len(word), 12) // 3) % SHAPES


def shape_column() -> Column:
    """``shape_of`` of a binary column ``word``."""
    return ((F.crc32(F.expr("right(word, 2)")) + F.floor(F.least(F.length("word"), F.lit(12)) / 3)) % SHAPES).cast("int")


def held_out_rule() -> Column:
    return crc_mod(F.col("doc_id"), 5) == 1


def binary_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


# -- counts -----------------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n_train, n_all`` over all documents; the end is the empty word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, held = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(train.keys() | held.keys())
            out = pa.RecordBatch.from_pydict({
                "word": pa.array(words, pa.binary()), "n_train": pa.array([train[w] for w in words], pa.int64()),
                "n_all": pa.array([train[w] + held[w] for w in words], pa.int64())})
            train.clear()
            held.clear()
            return out

        for batch in batches:
            for text, is_held in zip(binary_texts(batch, "text"), batch.column("held").to_pylist()):
                into = held if is_held else train
                into.update(words_of(text))
                into[b""] += 1
                if len(train) + len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select("text", held_out_rule().alias("held")).mapInArrow(count, "word binary, n_train bigint, n_all bigint")
    return rows.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def size_class() -> Column:
    """Eighths of a power of two of a word's count."""
    return F.floor(F.log2(F.col("n_all").cast("double")) * 8).cast("int")


def frequent_class(counts: DataFrame, most: int) -> int:
    """The least size class such that no more than ``most`` words are of it or a larger one."""
    found = sorted(((r["size"], r["words"]) for r in counts.groupBy(size_class().alias("size")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    total, least = 0, 64 * 8
    for size, words in found:
        total += words
        if total > most:
            break
        least = size
    return least


@dataclass
class Vocabulary:
    """What a task needs to know of words. Frequent words by number: token, training count, own token or not."""
    words: list[bytes]
    count: np.ndarray        # training counts of the frequent words
    token: np.ndarray        # their tokens: below n_words their own, else their shape's
    token_counts: np.ndarray  # training count by token, the end last
    n_words: int
    shape_log: np.ndarray    # log10 of the sum that the counts of a shape's words are divided by
    n_tokens: int            # N
    n_distinct: int          # V

    @property
    def base_log(self) -> float:
        return log10(self.n_tokens + 0.5 * (self.n_distinct + 1))

    def numbers(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def vocabulary(counts: DataFrame, words: int = WORDS, frequent: int = FREQUENT) -> tuple[Vocabulary, int]:
    """The vocabulary, and the size class from which words are frequent."""
    least = frequent_class(counts, frequent)
    rows = counts.filter((size_class() >= least) & (F.col("word") != F.lit(b""))).collect()  # at most ``frequent``
    rows = sorted(((bytes(r["word"]), shape_of(bytes(r["word"])), r["n_train"]) for r in rows), key=lambda r: (-r[2], r[0]))
    own = [r for r in rows if r[2] > 0][:words]
    n_words = max(R.CLASS_WORDS, -(-len(own) // R.CLASS_WORDS) * R.CLASS_WORDS)
    known = F.col("n_train") > 0
    totals = {r["shape"]: (r["n"], r["v"]) for r in counts.filter(known & (F.col("word") != F.lit(b"")))
              .groupBy(shape_column().alias("shape")).agg(F.sum("n_train").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    end = counts.filter(F.col("word") == F.lit(b"")).select("n_train").collect()
    n_end = end[0][0] if end else 0
    shape_n, shape_v = np.zeros(SHAPES), np.zeros(SHAPES)
    for s, (n, v) in totals.items():
        shape_n[s], shape_v[s] = n, v
    n_tokens, n_distinct = int(shape_n.sum()) + n_end, int(shape_v.sum()) + (n_end > 0)
    for _, s, n in own:
        shape_n[s] -= n
        shape_v[s] -= 1
    token = np.array([i if i < len(own) else n_words + s for i, (_, s, _) in enumerate(rows)], np.int64)
    first = np.zeros(n_words)
    first[:len(own)] = [r[2] for r in own]
    return Vocabulary([r[0] for r in rows], np.array([r[2] for r in rows], np.int64), token, np.concatenate([first, shape_n, [n_end]]), n_words,
                      np.log10(shape_n + 0.5 * (shape_v + 1)), n_tokens, n_distinct), least


# -- documents as token numbers -----------------------------------------------------

ENCODED = ("doc_id bigint, held_out boolean, n_tokens bigint, tokens binary, n_known bigint, base_log double, shape_log double, rare binary")


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Per row: token numbers; of the frequent words, how many are known, and log10(count + 0.5) over all and over those
    written by shape, less the shapes' divisors; the other words, separated by spaces."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # at most FREQUENT words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        number, end = v.numbers().get, v.n_words + SHAPES
        logs = np.append(np.log10(v.count + 0.5), 0.0)
        own = np.append(v.token, 0)
        known = np.append(v.count > 0, False)
        shape_log = v.shape_log
        end_log, end_known = log10(v.token_counts[-1] + 0.5), int(v.token_counts[-1] > 0)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: dict[str, list] = {k: [] for k in ("n_tokens", "tokens", "n_known", "base_log", "shape_log", "rare")}
                for text in binary_texts(part, "text"):
                    words = words_of(text)
                    at_ = np.fromiter(map(number, words, repeat(-1)), np.int64, len(words))
                    tokens = own[at_]
                    missing = np.flatnonzero(at_ < 0)
                    rare = [words[i] for i in missing]
                    tokens[missing] = [v.n_words + shape_of(w) for w in rare]
                    by_shape = tokens >= v.n_words
                    part_logs = logs[at_]
                    out["n_tokens"].append(len(words) + 1)
                    out["tokens"].append(np.append(tokens, end).astype(np.uint16).tobytes())
                    out["n_known"].append(int(known[at_].sum()) + end_known)
                    out["base_log"].append(float(part_logs.sum()) + end_log)
                    out["shape_log"].append(float(part_logs[by_shape].sum() - shape_log[tokens[by_shape] - v.n_words].sum()))
                    out["rare"].append(b" ".join(rare))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(out["n_tokens"], pa.int64()), pa.array(out["tokens"], pa.binary()),
                     pa.array(out["n_known"], pa.int64()), pa.array(out["base_log"]), pa.array(out["shape_log"]), pa.array(out["rare"], pa.binary())],
                    names=["doc_id", "held_out", "n_tokens", "tokens", "n_known", "base_log", "shape_log", "rare"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out_rule().alias("held_out"))
    return rows.mapInArrow(work, ENCODED).withColumn("key", F.monotonically_increasing_id())


def rare_sums(encoded: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """``key, rare_known, rare_log`` of the documents with words that are not frequent."""
    each = encoded.filter(F.length("rare") > 0).select("key", F.explode(F.split(F.col("rare").cast("string"), " ")).alias("word"))
    known = counts.filter((size_class() < least) & (F.col("n_train") > 0)).select(F.col("word").cast("string").alias("word"), "n_train")
    n = F.coalesce("n_train", F.lit(0))
    return each.join(known, "word", "left").groupBy("key").agg(
        F.sum((n > 0).cast("bigint")).alias("rare_known"), F.sum(F.log10(n + F.lit(0.5))).alias("rare_log"))


def token_arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int64) for x in column.to_pylist()]


# -- the network ----------------------------------------------------------------------

def warmed(encoded: DataFrame, net: R.Network, n_docs: int) -> R.Network:
    """``net`` after a pass over about WARM_DOCS short training documents, in one task."""
    share = min(1.0, WARM_DOCS / max(1, n_docs))
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    sample = encoded.filter(~F.col("held_out") & (F.col("n_tokens") <= WARM_TOKENS) & (chance < share)).select("tokens").limit(2 * WARM_DOCS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = token_arrays(pa.array(sorted(x for b in batches for x in b.column(0).to_pylist()), pa.binary()))
        trainer = R.Trainer(net)
        trainer.feed(docs)
        yield pa.RecordBatch.from_pydict({"flat": pa.array([trainer.net.flat().tobytes()], pa.binary())})

    found = sample.coalesce(1).mapInArrow(learn, "flat binary").collect()
    return net.like(np.frombuffer(found[0][0], np.float32)) if found else net  # an empty table has no task


def trained(encoded: DataFrame, net: R.Network) -> R.Network:
    """``net`` after every task trained it over all its training documents, averaged by tokens."""
    names = [f"c{i}" for i in range(WIDE)]
    shared = encoded.sparkSession.sparkContext.broadcast(net)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, docs, held = R.Trainer(shared.value), [], 0
        for batch in batches:
            for tokens in token_arrays(batch.column(0)):
                docs.append(tokens)
                held += len(tokens)
                if held >= TRAIN_TOKENS:
                    trainer.feed(docs)
                    docs, held = [], 0
        trainer.feed(docs)
        if trainer.tokens:
            flat = np.append(trainer.net.flat().astype(np.float64), 1.0) * trainer.tokens
            wide = np.pad(flat, (0, -len(flat) % WIDE)).reshape(-1, WIDE)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wide), dtype=np.int32)), *(pa.array(c) for c in wide.T)], names=["block", *names])

    rows = encoded.filter(~F.col("held_out")).select("tokens").mapInArrow(learn, "block int, " + ", ".join(f"{c} double" for c in names))
    total = rows.groupBy("block").agg(*[F.sum(c).alias(c) for c in names]).collect()  # the size of the network
    if not total:
        return net
    flat = np.array([tuple(r)[1:] for r in sorted(total)]).ravel()
    n = len(net.flat())
    return net.like(flat[:n] / flat[n])


def network_scores(encoded: DataFrame, net: R.Network) -> DataFrame:
    """Every encoded row with ``net_log``, the log10 probability of its tokens, in place of the tokens and rare words."""
    shared = encoded.sparkSession.sparkContext.broadcast(net)
    kept = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_log", "shape_log"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(parts: list[pa.RecordBatch], docs: list[np.ndarray]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            return pa.RecordBatch.from_arrays([*(rows.column(c).chunk(0) for c in kept), pa.array(R.score(shared.value, docs) / LN10)], names=[*kept, "net_log"])

        parts, docs, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = token_arrays(part.column("tokens"))
                parts.append(part.select(kept))
                docs += own
                held += sum(map(len, own))
                if held >= SCORE_TOKENS:
                    yield done(parts, docs)
                    parts, docs, held = [], [], 0
        if docs:
            yield done(parts, docs)

    return encoded.select(*kept, "tokens").mapInArrow(
        work, "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_log double, shape_log double, net_log double")


# -- the operator -----------------------------------------------------------------------

@dataclass
class LanguageModel:
    vocab: Vocabulary
    least: int
    net: R.Network


def fit(docs: DataFrame, tables: Tables) -> tuple[LanguageModel, DataFrame, DataFrame]:
    """The model, the word counts and the encoded documents (kept in ``tables``)."""
    counts = tables.put(word_counts(docs))
    vocab, least = vocabulary(counts)
    encoded = tables.put(encode(docs, vocab))
    start = R.Network.start(vocab.token_counts, vocab.n_words)
    net = trained(encoded, warmed(encoded, start, int(vocab.token_counts[-1])))
    return LanguageModel(vocab, least, net), counts, encoded


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    tables, result = Tables(spark), Tables(spark)
    model, counts, encoded = fit(docs, tables)
    rare = rare_sums(encoded, counts, model.least)
    joined = network_scores(encoded, model.net).join(rare, "key", "left")
    known, log = F.coalesce("rare_known", F.lit(0)), F.coalesce("rare_log", F.lit(0.0))
    out = result.put(joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(model.vocab.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_log") + log - F.col("n_tokens") * F.lit(model.vocab.base_log)).alias("base_score"),
        (F.col("net_log") + F.col("shape_log") + log).alias("score")))
    tables.clear()
    return out
