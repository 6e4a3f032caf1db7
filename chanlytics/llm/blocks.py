"""Documents dealt into blocks of bounded text, compressed for the shuffle.

A block is what one group of a grouped map holds: about `block_bytes` of
text.  Documents are dealt by a hash of id and text, so every run of the
plan deals alike and no key or source can crowd a block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlytics.llm import packets as P
from chanlytics.llm.words import buffers, slices

#: Text bytes that a block should hold.  The number of packets is the square
#: of the number of blocks: choose it as large as an executor's memory allows
#: (a task takes about 40 times as much at its peak).
BLOCK_BYTES = 6 << 20


def text_bytes(df: DataFrame, text_col: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def count_for(df: DataFrame, total: int, block_bytes: int) -> int:
    """Blocks for `total` bytes of text: block_bytes each, at least one per shuffle partition."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / block_bytes))


def deal(df: DataFrame, blocks: int, id_col: str, text_col: str, flag: Column | None = None) -> DataFrame:
    """(block, payload): each scan task's documents of a block as one compressed row.

    Null texts become empty, a null flag false; ids are cast to long.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(F.col(id_col), text)
    rows = df.select(F.pmod(key, F.lit(blocks)).cast("int").alias("block"), key.alias("doc_key"),
                     F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                     (F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))).alias("flag"))
    return rows.mapInArrow(_pack, "block int, payload binary")


def _pack(batches):
    for batch in batches:
        for part in slices(batch, "text", 8 << 20):
            number = part.column("block").to_numpy()
            order = np.argsort(number, kind="stable")
            part = part.take(pa.array(order))
            raw, offsets = buffers(part.column("text"))
            number = number[order]
            cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
            null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = part.column("doc_id").fill_null(0).to_numpy()
            keys, flag = part.column("doc_key").to_numpy(), part.column("flag").to_numpy(zero_copy_only=False)
            out = [P.joined([P.pack(keys[a:b]), P.pack(ids[a:b]), P.pack((null[a:b] + 2 * flag[a:b]).astype(np.uint8)),
                             P.pack(np.diff(offsets[a:b + 1])), P.pack(raw[offsets[a]:offsets[b]])])
                   for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict({"block": pa.array(number[cuts[:-1]], pa.int32()),
                                              "payload": pa.array(out, pa.binary())})


def documents(table: pa.Table) -> pa.Table:
    """doc_key, doc_id, text, flag of a block, ordered by doc_key."""
    parts = [P.split(x) for x in table.column("payload").to_pylist()]
    if not parts:
        return pa.table({"doc_key": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()),
                         "text": pa.array([], pa.large_string()), "flag": pa.array([], pa.bool_())})
    keys, ids, bits, sizes, raw = (np.concatenate([P.unpack(p[i], kind) for p in parts]) for i, kind in
                                   enumerate((np.int64, np.int64, np.uint8, np.int64, np.uint8)))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    text = pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(offsets), pa.py_buffer(raw))
    return pa.table({"doc_key": keys, "doc_id": pa.array(ids, mask=bits & 1 > 0), "text": text,
                     "flag": bits & 2 > 0}).take(pa.array(np.argsort(keys, kind="stable")))
