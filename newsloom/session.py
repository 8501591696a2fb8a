"""Session settings and the one way this package cuts lineage: a written table."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def build_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="newsloom-")
    return _local_dirs[app]


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers of a cluster; a local master needs nothing."""
    context = spark.sparkContext
    if context.master.startswith("local[") or context.master == "local" or getattr(context, "_newsloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The archive is code for the driver's file server, not data that executors would look for.
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="newsloom-"), "newsloom"), "zip", root, "newsloom")
    context.addPyFile(archive)
    context._newsloom_shipped = True


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/newsloom/{label}-{uuid.uuid4().hex}"


#: Shuffle files of a write are of no use after it; Spark keeps them until the driver collects garbage, or removes them at once.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_STORED = re.compile(r"/newsloom/([^/]+-[0-9a-f]{32})/")
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table survives lost executors, gives the next plan real file sizes, and keeps columnar pruning. It stays until
    the innermost `scratch` around the call ends, or for good if there is none.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    for scope in _scopes.get()[-1:]:
        scope.append(path)
    usual = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if usual is None else spark.conf.set(SHUFFLE_CLEANUP, usual)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes, at the end of the block, the tables that `materialize` wrote inside it.

    The block calls the given function with every frame that is used after it; the tables such a frame reads stay, and
    belong to the block around this one. A frame that was written anew no longer reads what it was made from, so a lost
    executor never sends Spark back to a table that is gone.
    """
    written: list[str] = []
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    outer = _scopes.get()
    token = _scopes.set((*outer, written))
    try:
        yield keep
    finally:
        _scopes.reset(token)
        read = {name for df in kept for name in _folders(df)}
        for path in written:
            if path.rsplit("/", 1)[-1] not in read:
                remove_folder(spark, path)
            elif outer:
                outer[-1].append(path)


def discard(df: DataFrame) -> None:
    """Removes the tables of `materialize` that ``df`` reads. Only for a table whose last reader has been written."""
    spark = df.sparkSession
    for name in _folders(df):
        remove_folder(spark, f"{shared_dir(spark)}/newsloom/{name}")


def _folders(df: DataFrame) -> set[str]:
    """Names of the folders of `materialize` that a frame reads; each is unique by its random part."""
    return {name for file in df.inputFiles() for name in _STORED.findall(file)}


def write_pointer(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file that takes the place of the former one in a single step, so a reader sees one or the other."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, fresh = hadoop.Path(path), hadoop.Path(f"{path}-{uuid.uuid4().hex}")
    out = fresh.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, target, how)


def read_pointer(spark: SparkSession, path: str) -> list[str]:
    """Lines of such a file; none when there is no file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return []
    return spark.read.text(path, wholetext=True).first()["value"].split("\n")


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
