"""Intermediate tables of an operator, deleted as soon as nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tamarind.session import freeze

__all__ = ["freeze", "release"]


def release(*frozen: DataFrame) -> None:
    """Delete the files of frozen tables. Only for tables whose readers have been frozen themselves or collected."""
    for df in frozen:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
