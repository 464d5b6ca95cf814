"""A report table in the catalog, bucketed by its key.

The target of a delete-and-append upsert is far larger than a batch, so its
rows should not move for it. Here they are stored bucketed by one text column
that spells the whole key (nulls included, so plain equality is the null-safe
match and the bucketing serves it). The delete half joins bucket by bucket: the
distinct batch keys are dealt to the buckets, the target is read in place and
written in place. The batch is then appended, dealt to the same buckets.

Each upsert writes a new catalog table beside the last one; a view names the
current one and is replaced at the end, so readers see whole loads only and
the previous table stays as the back-up.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import encode_sql
from ledgerlake.operators.upsert import align_to

KEY = "__key"
PROPERTY = "ledgerlake.state"


class BucketedTable:
    """``name``: the view; ``root``: the folder of the tables' files."""

    def __init__(self, spark: SparkSession, name: str, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.name, self.root, self.keys, self.buckets = spark, name, root.rstrip("/"), list(keys), buckets

    def state(self) -> dict:
        """Version and batches done, kept with the view."""
        if not self.spark.catalog.tableExists(self.name):
            return {"version": -1, "batches": {}}
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return json.loads(found[PROPERTY])

    def stored(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def kept(self, keys: DataFrame) -> DataFrame:
        """Stored rows whose key is not among ``keys`` (column ``__key``)."""
        return self.spark.table(self.stored(self.state()["version"])).join(keys.select(KEY).distinct(), KEY, "left_anti")

    def keyed(self, batch: DataFrame) -> DataFrame:
        """With the key's spelling; a null part and the text of one differ (see :func:`encode_sql`)."""
        return batch.withColumn(KEY, F.expr(encode_sql(self.keys)))

    def upsert(self, batch: DataFrame, batch_id: tuple[str, int] | None = None) -> int | None:
        """Delete the batch's keys, append the batch; returns the version (None when the batch was done).

        All batch rows stay, repeated keys too; a null key replaces the null
        key's rows; an empty batch changes nothing; missing columns are null
        and a column the table lacks is an error. One writer at a time.
        """
        state = self.state()
        if batch_id is not None and state["batches"].get(batch_id[0], -1) >= batch_id[1]:
            return None
        version = state["version"] + 1
        if state["version"] >= 0:
            batch = align_to(self.read(), batch)
        columns = batch.columns
        rows = self.keyed(batch)
        if state["version"] >= 0:
            self._write(self.kept(rows), version, "overwrite")
            self._write(rows.repartition(self.buckets, KEY), version, "append")
        else:
            self._write(rows.repartition(self.buckets, KEY), version, "overwrite")
        state = {"version": version, "batches": state["batches"] | ({batch_id[0]: batch_id[1]} if batch_id else {})}
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{PROPERTY}' = '{json.dumps(state)}') AS "
                       f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {self.stored(version)}")
        return version

    def _write(self, rows: DataFrame, version: int, mode: str) -> None:
        """A task holds rows of its own bucket only, so every bucket gets one file a write."""
        (rows.write.mode(mode).option("path", f"{self.root}/v{version}").format("parquet")
            .bucketBy(self.buckets, KEY).saveAsTable(self.stored(version)))
