"""What the operators of this subpackage share: table readers, row keys, and Arrow batches as plain lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables:
    """Tables that one run writes, in a folder of their own below the session's checkpoint folder.

    ``put`` writes a frame as Parquet and returns the table read again: its lineage is cut, its small files are read
    several to a task, and its size is known to the planner. ``clear`` deletes what the run needs no more; what a result
    still reads goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.n = spark, 0
        self.path = f"{checkpoint_dir(spark)}/tables-{uuid4().hex}"
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.folder)
        self.files.deleteOnExit(self.folder)

    def put(self, df: DataFrame, **options: str) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.path}/{self.n}", **options)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.n}")

    def clear(self) -> None:
        self.files.delete(self.folder, True)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def hash_share(col: Column, salt: str) -> Column:
    """A uniform number in [0, 1) that depends on the value and the salt only."""
    return F.pmod(F.xxhash64(col, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def document_rows(docs: DataFrame) -> DataFrame:
    """The columns of the documents table, in its order and types; others are left out."""
    return docs.select(F.col("doc_id").cast("bigint"), "text", "lang", "source", F.col("n_chars").cast("bigint"))


DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, rk``: ``rk`` tells texts of one id apart; equal rows share it, so their results are equal too."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("rk"))


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in t.fields])
    return ARROW[t.simpleString()]


def map_rows(df: DataFrame, work: Callable[[dict], dict], schema: str | T.StructType, chunk: int = 256) -> DataFrame:
    """Run ``work`` over lists of at most ``chunk`` rows: {column: values} in, {column: values} out.

    Strings come as UTF-8 bytes (null: None). ``chunk`` bounds what Python holds at once; rows stay whole.
    """
    spark_schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow_schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in spark_schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                columns = {}
                for name, col in zip(part.schema.names, part.columns):
                    if pa.types.is_string(col.type):
                        col = col.cast(pa.binary())
                    elif pa.types.is_large_string(col.type):
                        col = col.cast(pa.large_binary())
                    columns[name] = col.to_pylist()
                out = work(columns)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow_schema], schema=arrow_schema)

    return df.mapInArrow(run, spark_schema)


#: Key of a document row, without nulls.
KEY = ["did", "rk"]


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``did``, the id or 0, and ``rk``, which tells texts and nulls apart: only equal rows share a key."""
    doc_id = F.col("doc_id")
    return docs.withColumns({"did": F.coalesce(doc_id, F.lit(0)), "rk": F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull(), doc_id.isNull())})


def rows_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text, did, rk`` of every row."""
    return with_key(docs.select(F.col("doc_id").cast("bigint"), "text"))


def squeezed(docs: DataFrame) -> DataFrame:
    """``doc_id, did, rk, z``: the text compressed (null as empty), dealt out by key once for all joins with it."""
    def work(c: dict) -> dict:
        z = zstandard.ZstdCompressor(level=3)
        return {k: c[k] for k in ("doc_id", *KEY)} | {"z": [z.compress(t or b"") for t in c["text"]]}

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(rows_of(docs), work, "doc_id bigint, did bigint, rk bigint, z binary").repartition(n, *KEY).persist(StorageLevel.MEMORY_AND_DISK)


def plain(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)
