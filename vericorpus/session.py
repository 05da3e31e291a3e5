"""Sessions, the shared folder of a job, and tables written to cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: list[str] = []
_STAGED: list[str] = []


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("vericorpus")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    Only where the session names none and runs on one machine (tests, a laptop) is a temporary folder taken instead; it goes when
    the driver ends. A cluster without a shared folder is an error, since its executors would write to disks of their own.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        given = context._jsc.sc().getCheckpointDir()
        named = given.get() if given.isDefined() else None
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("no folder that all executors share: set spark.checkpoint.dir")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="vericorpus-"))
    return f"file://{_OWN_FOLDER[0]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and no executor's loss costs it.

    The files stay until ``release`` or the driver's end, since results are lazy until then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vericorpus-{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Deletes all staged tables: for long drivers, when the results that read them are written."""
    while _STAGED:
        _delete(_STAGED.pop())


def _delete(path: str) -> None:
    if path.startswith(("/", "file:")):
        shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
        return
    try:  # another file system: through Hadoop, while the JVM lives
        spark = SparkSession.getActiveSession()
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:
        pass


@atexit.register
def _sweep() -> None:
    release()
    for path in _OWN_FOLDER:
        _delete(path)
