"""Session defaults shared by tests, the benchmark and interactive use."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of a small table that go into one file.
ROWS_PER_FILE = 20_000


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vellum")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints that spark.checkpoint.dir names (all executors share it).

    Only a local session, whose executors are the driver, gets a folder of its own where it names none."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith(("local[", "local-cluster[")) and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="vellum-"))
    return context._jsc.sc().getCheckpointDir().get()


def keep(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage: written to the shared folder. rows: a bound of its rows, by which a small table is written in few files.

    Spark removes the files once the table is no longer referred to, where spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_folder(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
