"""Session settings the library expects, and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "casemill", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for written intermediate tables.

    It is the one the session names in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    scratch folder; a cluster without it is an error, since a machine-local folder dies with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="casemill-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and go on from there: later steps read the columns they need.
    ``options`` are those of the Parquet writer."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
