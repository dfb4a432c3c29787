"""Reading inputs and cutting lineage through tables in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemart.workspace import fresh_folder


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    spark = rows.sparkSession
    files = fresh_folder(spark, label)
    rows.write.parquet(files)
    # What was shuffled for it is not needed any more, but stays on the executors' disks until the
    # driver's JVM finds that out. An operator of many steps would pile up all of them.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(rows.schema).parquet(files)


def dropped(*tables: DataFrame) -> None:
    """Delete settled tables that nothing will read again."""
    for rows in tables:
        jvm, context = rows.sparkSession._jvm, rows.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, as ``--py-files`` would, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark
