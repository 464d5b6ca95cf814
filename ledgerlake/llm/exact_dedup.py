"""Exact dedup as a stateful stream.

Documents are logged with the digest of their normalised text, their id and
their place (table, file and row). A streaming aggregation without watermark
keeps, per digest, how many came and which one stays, in RocksDB state that
never expires; a later run of the same folder takes in new log files only. A
place is logged once, so a run that is repeated, or started again after a
crash, adds nothing. Hits are then checked byte by byte, rows of earlier runs
too: the text of every dropped row is read at its place and compared with that
of the row that stays. Rows whose digests agree but whose texts do not are
grouped again by the texts themselves.

DataFrame, SQL and Structured Streaming only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, stage
from ledgerlake.session import scratch_path

PLACE = ["_file", "_row"]
LOGGED = "_digest string, _id long, _file string, _row long, _table string"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every partition takes 4 MB of disk at once
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Sets ``conf`` for the block and puts the former values back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The table with the place of each row: its file and its row in the file."""
    return spark.read.parquet(path).withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def texts_of(spark: SparkSession, tables: list[str], text: str) -> DataFrame:
    """(_file, _row, _text) of all rows of the tables that were taken in (one path a table reaches the driver)."""
    parts = [placed(spark, t).select(*PLACE, F.coalesce(F.col(text), F.lit("")).alias("_text")) for t in sorted(tables)]
    return reduce(DataFrame.unionByName, parts)


class DigestState:
    """Keyed state of all digests seen, under ``folder``: log, checkpoint, and the changes of every batch."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def seen(self) -> DataFrame | None:
        """The log, or None before the first run."""
        log = f"{self.folder}/log"
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(LOGGED).parquet(log)

    def log(self, keys: DataFrame) -> None:
        """Appends rows (_digest, _id, _file, _row, _table) for the stream to take in, but those of places that it holds.

        The write is all or nothing; after a crash behind it, the next run logs nothing and the stream goes on.
        """
        before = self.seen()
        if before is not None:
            keys = keys.join(before.select(*PLACE), PLACE, "left_anti").select(keys.columns)
        keys.write.mode("append").parquet(f"{self.folder}/log")

    def take_in(self) -> None:
        """Runs the stream over what is new in the log. A batch that is replayed writes the same folder again."""
        def save(changes: DataFrame, batch: int) -> None:
            changes.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={batch}")

        with settings(self.spark, STATE_CONF):
            stream = self.spark.readStream.schema(LOGGED).parquet(f"{self.folder}/log")
            kept = F.max(F.struct("_id", "_file", "_row")).alias("keeper")
            (stream.groupBy("_digest").agg(F.count("*").alias("n"), kept)
             .writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{self.folder}/state")
             .trigger(availableNow=True).start().awaitTermination())

    def now(self) -> DataFrame:
        """(_digest, n, keeper): the state as of the last batch. Counts only grow, so the largest is the latest."""
        changes = self.spark.read.parquet(f"{self.folder}/changes")
        if changes.select("batch").distinct().count() == 1:
            return changes.drop("batch")
        return changes.groupBy("_digest").agg(F.max(F.struct("n", "keeper")).alias("x")).select("_digest", "x.n", "x.keeper")


def collisions(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests under which rows with different bytes meet.

    ``hits``: place, digest and _stays of all rows of groups. Each dropped
    row's normalised text is compared with that of the row that stays.
    """
    texts = texts.join(hits, PLACE)
    stays = texts.where("_stays").select("_digest", F.col("_text").alias("_kept"))
    other = texts.where("not _stays").join(stays, "_digest")
    same = (F.col("_text") == F.col("_kept")) | (ascii_lower(F.col("_text")) == ascii_lower(F.col("_kept")))
    return other.where(~same).select("_digest").distinct()


def dedup(spark: SparkSession, path: str, *, text: str = "text", doc_id: str = "doc_id", folder: str | None = None,
          digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical after lower-casing A-Z (null counts as
    empty); of equal texts the row with the largest id stays (null ids last;
    of equal ids the one furthest in file order). ``kept`` marks exactly one
    row a group. Other columns of the table are not looked at. An empty table
    gives no rows. Ids are long numbers.
    """
    docs = placed(spark, path)
    state = DigestState(spark, folder or scratch_path(spark, "exact-dedup"))
    keys = docs.select(digest(normalised(text)).cast("string").alias("_digest"), F.col(doc_id).cast("long").alias("_id"), *PLACE, F.lit(path).alias("_table"))
    state.log(keys)
    state.take_in()
    log = state.seen()
    if not log.limit(1).count():
        return log.select(F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                          F.lit(True).alias("kept"), F.col("_digest").alias("digest"))
    judged = stage(log.join(state.now(), "_digest").select(
        "_id", "_digest", *PLACE, F.col("keeper._id").alias("_keep"), "n",
        ((F.col("keeper._file") == F.col("_file")) & (F.col("keeper._row") == F.col("_row"))).alias("_stays")), "exact-judged")
    hits = judged.where("n > 1").select(*PLACE, "_digest", "_stays")
    texts = texts_of(spark, [r["_table"] for r in log.select("_table").distinct().collect()], text)
    bad = stage(collisions(texts, hits), "exact-collisions")
    if bad.limit(1).count():
        judged = _by_text(texts, judged, bad)
    return judged.select(F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("n").alias("group_size"), F.col("_stays").alias("kept"), F.col("_digest").alias("digest"))


def _by_text(texts: DataFrame, judged: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows of the ``bad`` digests judged again, grouped by their whole texts."""
    again = stage(judged.join(bad, "_digest", "left_semi").select("_id", "_digest", *PLACE)
                  .join(texts.select(*PLACE, ascii_lower(F.col("_text")).alias("_norm")), PLACE), "exact-again")
    groups = again.groupBy("_norm").agg(F.count("*").alias("n"), F.max(F.struct("_id", *PLACE)).alias("keeper"))
    fixed = again.join(groups, "_norm").select(
        "_id", "_digest", *PLACE, F.col("keeper._id").alias("_keep"), "n",
        ((F.col("keeper._file") == F.col("_file")) & (F.col("keeper._row") == F.col("_row"))).alias("_stays"))
    return judged.join(bad, "_digest", "left_anti").unionByName(fixed)
