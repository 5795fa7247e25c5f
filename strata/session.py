"""Session helpers.

Library code never creates a session; it receives one. The only setting it
needs is a reliable checkpoint folder for the iterative operators (peel,
expansion, level push-down), which cut their lineage once per round.
"""

from __future__ import annotations

import os
import re
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, setting it if needed.

    Order: a folder already set on the context, then the session's
    ``spark.checkpoint.dir``, then, on a local master only, a folder in the
    session's warehouse. Elsewhere a session without the setting is an error:
    the default warehouse is a folder of the driver's machine, which executors
    don't share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    sc.setCheckpointDir(configured or fallback_dir(sc.master, spark.conf.get("spark.sql.warehouse.dir")))
    return sc.getCheckpointDir()


def fallback_dir(master: str, warehouse: str) -> str:
    """Checkpoint folder of a session that names none; local masters only."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors share (master {master})")
    return f"{warehouse}/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scope:
    """Frames persisted while an operator runs, released when its result is cut.

    Operators return results that depend only on checkpoint files, so the
    memory and disk held by their intermediate rounds can be freed at once."""

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def persist(self, df: DataFrame) -> DataFrame:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.frames.append(out)
        return out

    def adopt(self, frames) -> None:
        self.frames.extend(frames)

    def finish(self, result: DataFrame) -> DataFrame:
        """Checkpoint ``result``, then release everything held."""
        out = cut(result)
        self.release()
        return out

    def release(self) -> None:
        for df in self.frames:
            df.unpersist(blocking=False)
        self.frames = []


class Rounds:
    """State of an iterative operator: persist each round, write every
    ``every``-th round to the reliable checkpoint folder (cutting the lineage)
    and release the rounds before it, unless ``keep_all``."""

    def __init__(self, every: int, keep_all: bool = False):
        self.every = max(1, every)
        self.keep_all = keep_all
        self.held: list[DataFrame] = []
        self.step = 0

    def materialise(self, df: DataFrame) -> DataFrame:
        self.step += 1
        if self.step % self.every == 0:
            out = cut(df)
            if not self.keep_all:
                self.release()
        else:
            out = df.persist(StorageLevel.MEMORY_AND_DISK)
            self.held.append(out)
        return out

    def release(self) -> None:
        for df in self.held:
            df.unpersist()
        self.held = []


class Store:
    """Tables that one run of an operator writes, in a folder of its own below the
    session's checkpoint folder.

    A frame that is written and read again has no lineage (a lost executor costs
    the task it ran) and a plan of one scan, however many rounds came before.
    ``add`` appends a round's rows to a table, so rows are written once and a
    loop ends without a union of its rounds. The folder is deleted by ``clear``,
    else when the driver ends; both go through the JVM gateway, which a Spark
    Connect session does not have."""

    def __init__(self, spark: SparkSession):
        self.spark, self.n = spark, 0
        self.path = f"{checkpoint_dir(spark)}/store-{uuid4().hex}"
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.folder)
        self.files.deleteOnExit(self.folder)
        self.schemas: dict[str, object] = {}

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """Append ``df`` to table ``name``; returns the rows of this round alone."""
        self.n += 1
        self.schemas.setdefault(name, df.schema)
        at = f"{self.path}/{name}/{self.n}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def put(self, df: DataFrame) -> DataFrame:
        """``df`` as a table of its own."""
        return self.add(df, f"one-{self.n}")

    def all(self, name: str) -> DataFrame:
        """Every row added to table ``name``; at least one round must have been."""
        return self.spark.read.schema(self.schemas[name]).option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}")

    def clear(self) -> None:
        self.files.delete(self.folder, True)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """Session for tests and the bench: local master, AQE on, no UI."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
