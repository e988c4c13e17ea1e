"""Tables in the shared folder: where loops cut their lineage and numbering keeps its order."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


_made: dict[str, DataFrame] = {}


def shared_folder(df: DataFrame) -> str:
    """The folder named by ``spark.checkpoint.dir``; on one machine without it a temporary one."""
    spark = df.sparkSession
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    held = sc._jsc.sc().getCheckpointDir()
    if not where and held.isDefined():
        return held.get()
    if not where:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors share no folder")
        where = tempfile.mkdtemp(prefix="lodestone-graph-")
    if not held.isDefined():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back.

    The lineage ends, a lost executor costs one step, and the next plan sees real
    sizes: a checkpoint hands on its plan's estimate, which squares with every
    self-join of a loop.
    """
    path = f"{shared_folder(df).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    _made[path] = out
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``cut`` has made and nothing reads any more; other frames are left alone."""
    for df in tables:
        path = vars(df).get("_cut_path")
        if path and _made.pop(path, None) is not None:
            sc = df.sparkSession.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def sweep() -> int:
    """Deletes every table that ``cut`` has made and that is still there: once results are written.  Returns how many."""
    left = list(_made.values())
    discard(*left)
    return len(left)
