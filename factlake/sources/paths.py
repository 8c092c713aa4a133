"""Names of files below a folder."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def uri(root: str) -> str:
    """A folder's URI, with its spaces encoded."""
    return root.replace(" ", "%20")


def decoded(path: Column) -> Column:
    """A file's path as it is named, from the URI that Spark gives."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def _opened(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    system, found = _opened(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(found)) if system.exists(found) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all in it, if it is there."""
    system, found = _opened(spark, path)
    system.delete(found, True)


def below(path: Column, root: str) -> Column:
    """A file's path below the root, either of which may be given with or without a scheme."""
    base = root.rstrip("/") + "/"
    if ":" in base:
        base = base.split(":", 1)[1]
    return F.replace(F.regexp_replace(path, "^[a-z0-9]+:/*", "/"), F.lit("/" + base.lstrip("/")), F.lit(""))
