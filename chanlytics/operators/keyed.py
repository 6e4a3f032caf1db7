"""Tables that hold a key at most once, stored so that the key can be looked up.

A keyed table is a Parquet table in Spark's own buckets of its key, below
partitions of key blocks (``key_block``).  An insert-if-absent batch meets
the stored keys bucket by bucket: only the batch is shuffled, into the
table's buckets, and only the partitions that hold a block of the batch are
read.  A block is made from the key alone; where ids grow with time, as
message ids do, a day's batch lies in few blocks.  Parquet Bloom filters
are written for the key columns, sized by the keys that a file has.

A load writes a file for each bucket of each of its blocks.  How many blocks
a table tells apart goes by its first batch, so ids that lie far apart do
not make files of a few rows.

The folder is the table: the numbers of buckets and blocks are kept in it,
and a session whose catalog does not know the table registers it from the
folder.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCK = "key_block"
#: Blocks of a table at most: later ones share the folders of earlier ones.
BLOCKS = 512
BLOCK_IDS = 100_000
#: Files of the first batch, or one for so many rows; where there would be more, blocks share folders.
FILES, FILE_ROWS = 2048, 500
#: Sizes of Bloom filter that a file may choose from, halved each time from Parquet's 1 MB.
BLOOM_SIZES = 12


def id_block(expression: str, ids: int = BLOCK_IDS) -> str:
    """SQL of the block of a numeric id: so many successive ids share one; NULL is block 0."""
    return f"CAST(coalesce(pmod(({expression}) div {ids}, {BLOCKS}), 0) AS INT)"


def _folder(block: int, blocks: int) -> int:
    """The folder of a block in a table of so many: its own, or one that it shares by its hash."""
    return block if blocks >= BLOCKS else zlib.crc32(str(block).encode()) % blocks


def _folder_sql(block: str, blocks: int) -> str:
    return block if blocks >= BLOCKS else f"CAST(crc32(CAST({block} AS STRING)) % {blocks} AS INT)"


def _observed(metrics: Observation, name: str) -> int:
    """A count; 0 where the optimizer has found the frame empty and left the metrics out."""
    return metrics.get[name] if metrics._jo.getRow().size() else 0


@dataclass(frozen=True)
class KeyedTable:
    """A stored table with a key; ``block``: SQL over the key columns, an int from 0 to BLOCKS - 1."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    block: str
    buckets: int | None = None  # of a new table; by default the session's shuffle partitions

    @property
    def name(self) -> str:
        return "default.keyed_" + hashlib.md5(self.path.rstrip("/").encode()).hexdigest()

    def _layout(self, rows: int, blocks: int) -> tuple[int, int]:
        """(buckets, blocks) of a new table whose first batch has so many rows in so many blocks; 0: unknown."""
        n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        files = max(FILES, rows // FILE_ROWS)
        return n, BLOCKS if n * blocks <= files else max(1, files // n)

    def _stored_layout(self, rows: int = 0, blocks: int = 0) -> tuple[int, int]:
        """(buckets, blocks) as the folder has them; those of a new table are written to it."""
        from chanlytics.operators.ingest import path_exists

        marker = f"{self.path.rstrip('/')}/_buckets"
        known = path_exists(self.spark, marker)
        if not known and path_exists(self.spark, self.path):
            raise ValueError(f"{self.path} holds a table that is not stored by key")
        row = self.spark.read.text(marker).first() if known else None
        if row is not None:
            n, m = (*map(int, row[0].split()), BLOCKS)[:2]  # before blocks were kept, there were all
            return n, m
        n, m = self._layout(rows, blocks)
        self.spark.range(1).select(F.lit(f"{n} {m}")).coalesce(1).write.mode("overwrite").text(marker)
        return n, m

    def ensure(self) -> int:
        """Registers the table if this session's catalog lacks it; the number of its buckets."""
        return self._ensure()[0]

    def _ensure(self, rows: int = 0, blocks: int = 0) -> tuple[int, int]:
        n, m = self._stored_layout(rows, blocks)
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            own = ", ".join(f"`{k}`" for k in self.keys)
            bloom = ", ".join([f"'parquet.bloom.filter.enabled#{k}'='true'" for k in self.keys]
                              + ["'parquet.bloom.filter.adaptive.enabled'='true'",
                                 f"'parquet.bloom.filter.candidates.number'='{BLOOM_SIZES}'"])
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {BLOCK} INT) USING parquet OPTIONS ({bloom}) "
                f"PARTITIONED BY ({BLOCK}) CLUSTERED BY ({own}) SORTED BY ({own}) INTO {n} BUCKETS LOCATION '{self.path}'")
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return n, m

    def rows(self) -> DataFrame:
        self.ensure()
        return self.spark.table(self.name).select(*self.schema.names)

    def stored_keys(self, folders: list[int]) -> DataFrame:
        """The keys in some blocks' folders, in the table's buckets."""
        self.ensure()
        return self.spark.table(self.name).where(F.col(BLOCK).isin(folders)).select(*self.keys)

    def absent(self, batch: DataFrame, order: list, totals: dict | None = None) -> DataFrame:
        """The batch's rows that the table does not hold: the first of each key under ``order``.

        The batch's distinct blocks, BLOCKS at most, are collected first (and
        its rows observed on the way).  Its first rows per key go to the
        table's buckets; the stored keys stay where they are.
        """
        from chanlytics.operators.ingest import first_rows

        seen = Observation()
        rows = batch.select(F.expr(self.block).alias("b")).observe(seen, F.count(F.lit(1)).alias("rows"))
        blocks = {r[0] for r in rows.distinct().collect()}
        count = _observed(seen, "rows")
        if totals is not None:
            totals["rows"] = count
        n, m = self._ensure(count, len(blocks))
        first = first_rows(batch, list(self.keys), order).repartition(n, *self.keys)
        # an anti join would be moved below the repartition, and the stored keys into the batch's partitions;
        # a key is stored once, so an outer join adds no rows
        stored = self.stored_keys(sorted({_folder(b, m) for b in blocks})).withColumn("__stored", F.lit(True)).hint("merge")
        return first.join(stored, list(self.keys), "left").where("__stored is null").select(*batch.columns)

    def append(self, new: DataFrame, totals: dict | None = None) -> None:
        """Adds rows whose keys the table does not hold; ``totals["recorded"]`` is observed on the write itself."""
        _, m = self._ensure()
        written = Observation()
        (new.select(*self.schema.names, F.expr(_folder_sql(self.block, m)).alias(BLOCK))
         .observe(written, F.count(F.lit(1)).alias("recorded")).write.mode("append").insertInto(self.name))
        if totals is not None:
            totals["recorded"] = _observed(written, "recorded")
