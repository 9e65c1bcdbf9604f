"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are runtime SQL settings, so they can be
# applied to a session somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sorts and groupings hold many times what a task reads, so a task reads little, however large the input is.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # A Python worker holds few long texts at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Month folders stay text: type inference would read 2024-01 as a date.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app: str = "soukwise", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit if not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return settle(builder.getOrCreate())


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: Bytes of input for each part that a shuffle is dealt into, before Spark puts small parts together.
PART_BYTES = 4 << 20


def deal(spark: SparkSession, size: int) -> SparkSession:
    """Shuffles of jobs over ``size`` bytes of input start with so many parts that a part does not grow with the input.

    A larger number that the session has already is kept.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual, stated = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get(key, None)
    parts = max(-(-size // PART_BYTES), usual, int(stated or 0))
    if parts > int(stated or usual):
        spark.conf.set(key, str(parts))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="soukwise-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root or context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a Parquet table in the shared folder and read it back.

    This survives lost executors and cuts the lineage. Unlike an RDD checkpoint the
    table can be read by column, and its size is known to the join planning after it.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped_to: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions given to ``mapInPandas`` and the like are pickled by reference, so a
    worker has to be able to import the module they live in.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="soukwise-code-")) / "soukwise_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped_to.add(context.applicationId)
