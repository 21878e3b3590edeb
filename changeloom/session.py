"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Work folders of this driver process, below one name so that they can go together.
_RUN = uuid.uuid4().hex[:12]


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("changeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only where it is unset and
    the master is this machine (as in tests) a temporary folder is made and set."""
    path = spark.conf.get(_CHECKPOINT_KEY, None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="changeloom-")
        atexit.register(shutil.rmtree, local, True)
        path = f"file://{local}"
        spark.conf.set(_CHECKPOINT_KEY, path)
    return path.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet. The folders of
    this process go when its driver ends (its file system is told to), or
    earlier by :func:`release`."""
    root = f"{shared_dir(spark)}/changeloom-{_RUN}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        fs, target = _file(spark, root)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_ROOTS: set[str] = set()


def release(spark: SparkSession) -> None:
    """Delete every work folder of this process: results that were read from
    them can no longer be used."""
    root = f"{shared_dir(spark)}/changeloom-{_RUN}"
    _ROOTS.discard(root)
    remove_path(spark, root)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`work_path`."""
    fs, target = _file(spark, path)
    fs.delete(target, True)


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file below the shared folder, in place of an older one."""
    fs, target = _file(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _file(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file; the folder of the target is made."""
    fs, a = _file(spark, source)
    _, b = _file(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    fs, target = _file(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(target)] if fs.exists(target) else []


def materialize(df, name: str):
    """Write ``df`` below the shared folder and read it again: cuts the lineage
    and survives the loss of executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
