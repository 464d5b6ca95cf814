"""Look-up CSV files (role groups, expense codes).

Read with an explicit all-text schema and the missing-value words of the
pandas CSV reader. Look-ups are reference data; the size of the files is
checked before a caller broadcasts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.text import na_to_null, strip_ws



def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_lookup_csv(spark: SparkSession, path: str, columns: Sequence[str],
                    keep: Sequence[str] | None = None) -> DataFrame:
    """Read a header CSV whose columns are ``columns``; keep ``keep`` of them.

    Values are not trimmed and not typed; NA words become null, a field of
    blanks stays as it is.
    """
    df = (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    df = df.select(*[na_to_null(c).alias(c) for c in columns])
    if keep is not None:
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return df


def write_lookup_csv(df: DataFrame, path: str) -> None:
    """Write a look-up as header CSV, keeping blanks around values."""
    (
        df.write.mode("error")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def path_size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` on its file system (HDFS, object store or local)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(conf).getContentSummary(p).getLength())


def publish_lookup(df: DataFrame, key: str) -> DataFrame:
    """Reference-data landing: trim every text field, drop rows without a key,
    remove repeated rows. The distinct is a hash aggregate with a map-side
    partial step, so repeated rows are merged before the shuffle."""
    cleaned = df.select(*[strip_ws(c).alias(c) for c in df.columns])
    return cleaned.filter(F.col(f"`{key}`").isNotNull()).distinct()
