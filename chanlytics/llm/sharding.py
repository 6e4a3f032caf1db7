"""Shard placement by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a prime-sized
table, (offset + j * skip) mod size, from hashes of its name.  Shards take
turns; on its turn a shard claims the first slot of its order that is still
free, until all are claimed.  A key's shard is the entry at its hash modulo
the size.  Shards differ by at most one slot, and taking a shard away moves
little besides its own keys.

The table has `size` entries whatever the data, so it is broadcast; the
placement of a row is one hash join against it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 16381  # prime, about 250 slots a shard at 64 shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: tuple[str, ...], size: int = SLOTS) -> list[int]:
    """The shard number at each slot.

    size: a prime above the number of shards.  Equal names take turns like
    any others, but would want the same slots; names must differ.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("one to `size` shards with different names are needed")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be prime")
    offset = [_number("offset:" + s) % size for s in shards]
    skip = [_number("skip:" + s) % (size - 1) + 1 for s in shards]
    entry = [-1] * size
    turn = [0] * len(shards)
    left = size
    while left:
        for i in range(len(shards)):
            while entry[(offset[i] + turn[i] * skip[i]) % size] >= 0:
                turn[i] += 1
            entry[(offset[i] + turn[i] * skip[i]) % size] = i
            left -= 1
            if not left:
                break
    return entry


def slot(key: Column, size: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its text's MD5, modulo the size; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size).cast("int")


def assign(df: DataFrame, key: Column, shards: tuple[str, ...] = SHARDS, size: int = SLOTS) -> DataFrame:
    """df with columns slot (int) and shard (name), which replace columns of these names; all rows stay."""
    columns = [c for c in df.columns if c not in ("slot", "shard")]
    names = [shards[i] for i in fill(tuple(shards), size)]
    spark = df.sparkSession
    table = spark.range(1).select(F.posexplode(F.lit(names)).alias("__slot", "shard"))  # `size` rows
    keyed = df.select(*columns, slot(key, size).alias("slot"))
    return keyed.join(F.broadcast(table), F.col("slot") == F.col("__slot")).drop("__slot")


def write_shards(df: DataFrame, key: Column, path: str, shards: tuple[str, ...] = SHARDS, files_per_shard: int = 8) -> None:
    """Writes df as Parquet, one folder a shard; a shard's rows are dealt over several tasks."""
    placed = assign(df, key, shards)
    placed.repartition(len(shards) * files_per_shard, "shard", F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard))) \
        .drop("slot").write.partitionBy("shard").parquet(path)


def _oracle() -> str:
    table = ",".join(map(str, fill(SHARDS)))
    return f"""
WITH t AS (SELECT [{table}] AS e),
k AS (SELECT doc_id, source, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {SLOTS} AS p
      FROM documents)
SELECT doc_id, source, CAST(p AS INTEGER) AS slot, 'shard-' || lpad(CAST(e[p + 1] AS VARCHAR), 3, '0') AS shard FROM k, t
"""


ORACLE = _oracle()
