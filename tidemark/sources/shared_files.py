"""Files in any file system that Spark knows: pointers, manifests and documents of the driver, and tables that a run keeps for itself.

Tables that a run writes for itself lie in one folder an application, below the one that ``spark.checkpoint.dir`` names;
``clean`` takes it away when nothing reads them any more.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application that the driver and all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, by the default file system where it names none: tasks and Spark then mean the same place."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def shared(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Rows as a table of their own: what reads them plans and computes nothing before it again."""
    path = shared(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Removes what this application wrote for itself. Results that still read those tables are lost."""
    remove(spark, shared_folder(spark))


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(found.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    context, found = _at(spark, path)
    return context.util().exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    context, found = _at(spark, path)
    if not context.util().exists(found):
        return []
    return sorted(status.getPath().getName() for status in context.util().listStatus(found))


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes the file under another name and renames it over what is there: a reader sees the old text or the new."""
    jvm = spark._jvm
    context, final = _at(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}-{uuid.uuid4().hex[:8]}")
    system = draft.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(draft, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    over = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, final, over)


def remove(spark: SparkSession, path: str) -> None:
    context, found = _at(spark, path)
    context.delete(found, True)


def write_json(spark: SparkSession, path: str, row: Row | dict) -> None:
    """One JSON document, indented by two, letters of any script as they are."""
    value = row.asDict(recursive=True) if isinstance(row, Row) else row
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, default=str))


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))
