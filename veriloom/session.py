"""What a session needs of a cluster: a shared folder, and this package on its workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", f"{64 << 20}b"
#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 4 << 20
#: Of Parquet's writer: rows until it looks at a page's size and at a row group's, which are a hundred and up to ten thousand elsewhere, and bytes of repeated values that it keeps once.
_LONG_ROWS = {"parquet.page.size.row.check.min": "4", "parquet.block.size.row.check.min": "4", "parquet.block.size.row.check.max": "8", "parquet.dictionary.page.size": str(64 << 20)}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, the folder that all machines of a cluster share.

    Where that setting is absent, a local master (tests, one machine) gets a folder of this process, set for the session;
    on a cluster, whose executors don't see such a folder, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="veriloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/veriloom/{name}-{uuid.uuid4().hex}"


def long_rows(spark: SparkSession) -> None:
    """Have Parquet's writer expect rows of several MB: a page of a hundred of them, or a row group of ten thousand, is no bound on its memory.

    Holds for the session, whose owner writes the result; what the session says already stays.
    """
    for key, value in _LONG_ROWS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once a SparkContext: a zip of its sources goes through Spark's own file server.

    Batches that workers get end at BATCH_BYTES too, unless the session says otherwise: ten thousand long texts are no bound on their memory.
    """
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_veriloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="veriloom-code-"), "veriloom_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.join("veriloom", os.path.relpath(os.path.join(folder, name), root)))
    sc.addPyFile(path)
    sc._veriloom_shipped = True
