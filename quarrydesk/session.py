"""Session helpers: where shared intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[tuple[str, str], str] = {}


def build_session(app: str = "quarrydesk", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    Only a local master may run without one; it then gets a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="quarrydesk-")
    return _LOCAL_ROOTS[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/quarrydesk/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    Survives executor loss, and later reads prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged(spark: SparkSession, key: str, name: str, build) -> DataFrame:
    """``build()`` written once per application and key, then read from there."""
    slot = (f"{spark.sparkContext.applicationId}|{shared_dir(spark)}|{key}", name)
    if slot not in _STAGED:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _STAGED[slot] = path
    return spark.read.parquet(_STAGED[slot])
