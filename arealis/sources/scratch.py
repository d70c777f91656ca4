"""Where intermediate tables go: the shared folder the cluster names, never a node's own disk."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_seen: set[str] = set()


class _Stages(threading.local):
    """The open and the last stage of each application, per driver thread, so that threads do not mix their tables."""

    def __init__(self) -> None:
        self.open: dict[str, str] = {}
        self.last: dict[str, str] = {}


_stages = _Stages()


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/arealis-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, else under the warehouse folder.

    Both are shared by all executors of a cluster. ``clear_scratch`` removes what one application
    wrote there; it also runs when the driver's interpreter ends.
    """
    root = _root(spark)
    if root not in _seen:
        _seen.add(root)
        atexit.register(_clear_at_exit, spark)
    return f"{_stages.open.get(root, root)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write a table once and read it back, for several later passes.

    Losing an executor costs a re-read of files, not the plan behind them.
    """
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stage(spark: SparkSession, keep: bool = True) -> Iterator[None]:
    """Collect the intermediate tables that this thread writes inside.

    They go when the thread's next stage begins, its result being written by then, or at the end without ``keep``.
    Tables written outside any stage stay.
    """
    root = _root(spark)
    if root in _stages.last:
        remove(spark, _stages.last.pop(root))
    mine = _stages.open[root] = f"{root}/stage-{uuid.uuid4().hex}"
    try:
        yield
    finally:
        del _stages.open[root]
        if keep:
            _stages.last[root] = mine
        else:
            remove(spark, mine)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; frames that read them end here."""
    remove(spark, _root(spark))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clear_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        clear_scratch(spark)
