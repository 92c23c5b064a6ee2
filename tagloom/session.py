"""Session helpers: a local test session and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", app: str = "tagloom", driver_memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent on a single machine (tests, notebooks) a temporary
    folder is used; a cluster without it is an error, as its machines share no such folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = tempfile.mkdtemp(prefix="tagloom-")
    return _FOLDERS[app]


_FOLDERS: dict[str, str] = {}


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call has."""
    return f"{shared_folder(spark)}/tagloom-{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``durable``, as a table in the shared folder: unlike a checkpoint its size is
    known to the planner, which then broadcasts it, or doesn't, by that."""
    spark = df.sparkSession
    path = fresh_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """Round-robin a frame over the cluster when its scan has too few splits.

    Used before Python stages whose cost is far above that of moving the rows;
    frames that already have a split per core are left alone.
    """
    want = max(1, df.sparkSession.sparkContext.defaultParallelism) * per_core
    return df if df.rdd.getNumPartitions() >= want // per_core else df.repartition(want)


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partitioned by columns into a fixed number of parts before a Python stage.

    Such a stage costs far more than its bytes tell, so the parts must not be merged by
    size; a grouped Python function on the same columns needs no further shuffle.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *columns)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python stages
    find it wherever they run."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tagloom-ship-"), "tagloom.zip")  # on the driver, which serves it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("tagloom", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
