"""Which keys a table holds: a bucketed, sorted index of 128-bit key digests.

A table whose key does not hold its day would be searched as a whole by every
insert.  The index has 16 bytes for each stored key, in as many buckets as the
session has shuffle partitions when it is made; an insert's keys are dealt into
the same buckets and each bucket is compared where it lies, so neither the table
nor the index is ever shuffled.

The index follows the table: an insert first notes its days, then writes the
table, then the index, then removes the note.  A note that is found later stands
for an insert that broke off; the keys of its days are then compared with the
table.  Other writers leave a note for all days, and the index is made anew.
One writer at a time, as for the tables.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.schemas import Table
from moodtape.sources.files import Files


def key_digest(keys: tuple[str, ...]) -> Column:
    """Sixteen bytes for the key; null where a part of it is null.  Lengths keep neighbouring parts apart."""
    parts = [F.col(k).cast("string") for k in keys]
    whole = F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.unhex(F.md5(whole.cast("binary")))


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, table: Table):
        self.spark, self.table, self.files = spark, table, Files(spark)
        self.folder = f"{root}/_keys"
        self.note = f"{self.folder}/{table.name}.inserting"
        made = [n for n in self.files.names(self.folder) if n.startswith(f"{table.name}-")]
        self.made = bool(made)
        buckets = made[0].rsplit("-", 1)[1] if made else spark.conf.get("spark.sql.shuffle.partitions")
        self.buckets = int(buckets)
        self.path = f"{self.folder}/{table.name}-{buckets}"

    def _name(self) -> str:
        """The index as a table of this session, so that Spark knows its buckets."""
        name = f"moodtape_keys_{hashlib.md5(self.path.encode()).hexdigest()}"
        where = self.path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (key BINARY) USING parquet"
            f" CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )
        return name

    def keys(self) -> DataFrame:
        return self.spark.table(self._name())

    def add(self, rows: DataFrame) -> None:
        """Keys of rows with a ``_key``, one file a bucket."""
        keys = rows.select(F.col("_key").alias("key")).where("key IS NOT NULL")
        name = self._name()
        keys.repartition(self.buckets, "key").write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def outdated(self) -> None:
        """Note that the table was written by other means than an insert."""
        if self.made:
            self.files.mark(self.note, json.dumps(None))

    def begin(self, days: list) -> None:
        self.files.mark(self.note, json.dumps([d.isoformat() for d in days]))

    def end(self) -> None:
        self.files.delete(self.note)

    def up_to_date(self, stored: DataFrame) -> "KeyIndex":
        """Make the index hold the table's keys, whatever broke off before."""
        noted = self.files.exists(self.note)
        days = json.loads(self.files.text(self.note)) if noted else None
        if self.made and not noted:
            return self
        keyed = stored.select(self.table.day, key_digest(self.table.key).alias("_key"))
        if self.made and days is not None:
            recent = keyed.where(F.col(self.table.day).cast("string").isin(days)).select("_key").distinct()
            self.add(self.not_held(recent))
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name()}")
            self.files.delete(self.path)
            self.add(keyed.select("_key").distinct())
            self.made = True
        self.end()
        return self

    def not_held(self, rows: DataFrame) -> DataFrame:
        """The rows whose ``_key`` is not in the index; rows without one never conflict."""
        held = self.keys()
        return rows.join(held, rows["_key"] == held["key"], "left_anti")
