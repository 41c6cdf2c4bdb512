"""Sessions, and the package on the executors' Python path."""

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))


def local_session(app: str = "lineara", cpus: str = "8", **more: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.sql.adaptive.enabled": "true",
    } | more
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_lineara_shipped", None) != sc.applicationId:
        to = os.path.join(tempfile.mkdtemp(prefix="lineara-"), "lineara_package.zip")
        with zipfile.ZipFile(to, "w") as z:
            for folder, _, names in os.walk(PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        at = os.path.join(folder, name)
                        z.write(at, os.path.join("lineara", os.path.relpath(at, PACKAGE)))
        sc.addPyFile(to)
        sc._lineara_shipped = sc.applicationId
    return spark


#: Folders made under spark.checkpoint.dir, which go when the program ends or earlier by discard(), and what deletes them
#: when the session has been stopped by then: the JVM outlives it.
MADE: list = []
HADOOP: list = []
#: Spark's folders of checkpoints, which only the end of the program deletes.
CHECKPOINTS: list = []


def _remember(sc) -> None:
    if not HADOOP:
        atexit.register(_at_end)
    HADOOP[:] = [sc._jvm, sc._jsc.hadoopConfiguration()]


def shared_dir(spark: SparkSession, what: str = "") -> str:
    """A new folder, named under spark.checkpoint.dir, that driver and executors share.

    Where the setting is absent a temporary folder serves, but only for a local master: on a cluster each
    machine would have its own.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="lineara-shared-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
    top = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    made = f"{top.rstrip('/')}/{uuid.uuid4().hex}{what and '-' + what}"
    _remember(spark.sparkContext)
    MADE.append(made)
    return made


def _delete(made: str) -> None:
    jvm, conf = HADOOP
    path = jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(conf).delete(path, True)


def discard(spark: SparkSession, since: int = 0, but: tuple = ()) -> None:
    """Delete the folders made after the first ``since`` of MADE, except those named in ``but`` and that of checkpoints, which Spark goes on writing to."""
    now = spark.sparkContext.getCheckpointDir() or ""
    for made in [m for m in MADE[since:] if m not in but and not now.startswith(m)]:
        _delete(made)
        MADE.remove(made)


def _at_end() -> None:
    for made in MADE + CHECKPOINTS:
        try:
            _delete(made)
        except Exception:  # the JVM is gone, or the folder system: nothing is left to ask
            return


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back, for what is used more than once or must not be done twice."""
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the shared folder. Spark's own folder there, one for each application, goes with the others at the end."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    elif sc.getCheckpointDir() not in CHECKPOINTS:
        _remember(sc)
        CHECKPOINTS.append(sc.getCheckpointDir())
    return df.checkpoint()
