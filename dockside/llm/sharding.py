"""Placement of documents on shards by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, a permutation that its name fixes.  Shards
take turns, and each claims the next slot of its order that is free.  Every shard then holds almost the same number of
slots, and when a shard goes few slots of others change hands.  The table is broadcast: its size is the prime, not the
corpus, and a document's shard is one lookup by the hash of its key.

Edge cases: a null key is a key of its own.  Equal keys get the same shard, whatever else is in the row.  An empty
table gives an empty result.  No shards, a repeated shard, or a table smaller than the shards are an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.llm.columns import free_names

TABLE_SIZE = 65_537
SHARDS = 64
#: Pieces that a shard's rows are written by, so no task writes a whole shard.
WRITERS = 16


def _digest(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """For each slot the index of the shard that holds it; the order of the list does not matter."""
    if not shards or len(set(shards)) < len(shards) or not is_prime(size) or size < len(shards):
        raise ValueError("shards must be distinct, at least one, and not more than the prime table size")
    ranked = sorted(range(len(shards)), key=shards.__getitem__)
    offset = [_digest(shards[k], "offset") % size for k in ranked]
    skip = [_digest(shards[k], "skip") % (size - 1) + 1 if size > 1 else 0 for k in ranked]
    table = np.full(size, -1, np.int32)
    free, turn = size, 0
    while free:
        k = turn % len(ranked)
        slot = offset[k]
        while table[slot] >= 0:
            slot = (slot + skip[k]) % size
        table[slot] = ranked[k]
        offset[k] = (slot + skip[k]) % size
        free, turn = free - 1, turn + 1
    return table


def place(df: DataFrame, shards: list[str], *, key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` (long) and ``shard`` (string); columns of these names are replaced."""
    spark: SparkSession = df.sparkSession
    rows = [(slot, shards[k]) for slot, k in enumerate(lookup_table(shards, size).tolist())]
    at, slot, shard = free_names(df, "at_", "slot_", "shard_")
    table = spark.createDataFrame(rows, f"{slot} long, {shard} string")
    found = df.withColumn(at, F.pmod(F.xxhash64(F.col(key)), F.lit(size))).join(F.broadcast(table), F.col(at) == F.col(slot))
    own = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    return found.select(*own, F.col(slot).alias("slot"), F.col(shard).alias("shard"))


def write_shards(df: DataFrame, path: str, shards: list[str], *, writers: int = WRITERS, **options) -> None:
    """Writes each shard's rows to a folder of its own; several tasks write one shard, dealt by the hash of the row."""
    placed = place(df, shards, **options)
    (writer,) = free_names(placed, "writer_")
    dealt = placed.withColumn(writer, F.pmod(F.xxhash64(*(f"`{c}`" for c in placed.columns)), F.lit(writers)))
    dealt.repartition("shard", writer).drop(writer, "slot").write.partitionBy("shard").parquet(path)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:04d}" for k in range(n)]
