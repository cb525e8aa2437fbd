"""Session set-up and the shared folder that intermediate results are cut at."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus="8", app="speechframe", shuffle_partitions="8"):
    """Session for tests and the bench. A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context, so that Python functions can import it there.

    Spark's own file server hands the archive out; nothing need be installed on the workers.
    """
    context = spark.sparkContext
    if getattr(context, "_has_speechframe", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="speechframe-"), "speechframe.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._has_speechframe = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="speechframe-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the part that belongs to this application."""
    return f"{shared_dir(spark)}/speechframe/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Compute ``df`` once into a table in the shared folder, so that every later reader sees the same rows.

    The table outlives the executors that wrote it, and a reader that needs few columns reads only those.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` returned, once nothing will read it again."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._written)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_workspace(spark: SparkSession) -> None:
    """Delete what this application has left in the shared folder, once its results are no longer needed."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/speechframe/{spark.sparkContext.applicationId}")
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
