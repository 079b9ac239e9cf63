"""Session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: HotSpot never compiles a method with more bytes of code than this; it stays in the interpreter.
COMPILED_BELOW = 8_000


def keep_compiled(spark: SparkSession) -> None:
    """Let stages whose generated method is too large for HotSpot run operator by operator, which is compiled.

    Wide projections of texts give methods of 10,000 to 25,000 bytes. A limit that is lower already stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > COMPILED_BELOW:
        spark.conf.set(limit, str(COMPILED_BELOW))


def local_session(cpus: int | str = "*", app: str = "clausewise", memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    partitions = 8 if cpus == "*" else max(int(cpus), 1)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A new folder name in the shared space the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="clausewise-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/clausewise-{uuid.uuid4().hex}"


def materialise(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write a frame that several parts of a job start from, and read it back.

    The table survives lost executors, and its size is known to the planner. The codec is the session's unless one is named.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
