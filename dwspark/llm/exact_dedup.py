"""Exact dedup by an extendible-hash index on shared files.

A directory of 2^g slots, addressed by the leading g bits of a text's 64-bit
key, points at buckets. It starts with one bucket; a bucket over its capacity
is split by one more bit, and the directory doubles when the bucket already
used all of its bits. Keys that occur once need no bytes. Texts of the other
keys go to bucket files in the shared folder. A bucket that no bit can split
any more, such as that of one hot key, is dealt over as many owners as it fills.

One task reads the file of an owner and compares bytes there, without a shuffle:
rows of one key with equal bytes become one entry. Entries of a bucket's owners
are then combined, again by their bytes, and entries of one key with different
bytes form a chain. Rows learn their entry from the first row of their owner's.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

MAX_DEPTH = 16          # 65,536 directory slots at most; a larger bucket has several owners
BUCKET_CAPACITY = 4_000
MAX_FILES = 65_536      # an owner each; beyond that a file has several owners


def grow_directory(cells: dict[int, int], depth: int, capacity: int) -> tuple[int, list[int], dict[int, int]]:
    """Global depth, bucket of each slot, and local depth of each bucket, for
    the row counts of the 2^``depth`` finest cells."""
    size, local, first = {0: sum(cells.values())}, {0: 0}, {0: 0}
    slots, g, todo = [0], 0, [0]
    while todo:
        b = todo.pop()
        if size[b] <= capacity or local[b] == depth:
            continue
        if local[b] == g:                                   # double the directory
            slots, g = [s for s in slots for _ in (0, 1)], g + 1
        local[b] += 1
        new = len(size)
        span = 1 << (depth - local[b])                      # finest cells under each half
        first[new], local[new] = first[b] + span, local[b]
        size[new] = sum(cells.get(c, 0) for c in range(first[new], first[new] + span))
        size[b] -= size[new]
        step = 1 << (depth - g)
        for s in range(first[new] // step, (first[new] + span) // step):
            slots[s] = new
        todo += [b, new]
    return g, slots, local


def bucket_files(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` in ``n`` files of a bucketed table in the shared folder, dealt by ``owner``: what is grouped by
    owner and more is grouped by the task that reads the file, without a shuffle."""
    spark, name = rows.sparkSession, f"bucket_files_{uuid.uuid4().hex}"
    (rows.repartition(n, "owner").write.bucketBy(n, "owner").option("path", scratch_path(spark, "bucket-files"))
     .format("parquet").saveAsTable(name))
    return spark.table(name)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                key: Callable[[Column], Column] = F.xxhash64, capacity: int = BUCKET_CAPACITY,
                max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    and where the entry lies (bucket, chain; null for a key that occurs once).

    Texts are equal when their bytes are; a null text counts as empty. The
    row with the largest id stays, a null id being smaller than any. Of
    several rows with this same id exactly one stays. ``key`` may be any hash
    to a long, however poor: equality is decided by the bytes.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", key(F.col("text")).cast("long"))
    spark = docs.sparkSession

    repeated = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-keys")
    cell = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    cells = {r.cell: r.n for r in repeated.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).collect()}
    g, slots, _ = grow_directory(cells, max_depth, capacity)
    size = Counter()
    for c, n in cells.items():
        size[slots[c >> (max_depth - g)]] += n
    owners = {b: max(1, -(-size[b] // capacity)) for b in dict.fromkeys(slots)}           # in the order of the keys
    first = dict(zip(owners, accumulate(owners.values(), initial=0)))
    directory = spark.createDataFrame([(i, b, first[b], owners[b]) for i, b in enumerate(slots)],
                                      "slot int, bucket int, first long, owners long")
    slot = F.shiftrightunsigned("key", 64 - g).cast("int") if g else F.col("key").bitwiseAND(F.lit(0)).cast("int")

    # rows of the keys that occur more than once; stored, since owners follow from the row numbers
    colliding = stored(rows.join(repeated, "key", "left_semi")
                       .withColumn("slot", slot).join(F.broadcast(directory), "slot")     # 2^max_depth rows at most
                       .withColumn("row", F.monotonically_increasing_id())
                       .select("bucket", (F.col("first") + F.pmod("row", "owners")).alias("owner"), "key", "row", "doc_id", "text"),
                       "colliding")

    # the task of an owner reads its file, compares bytes and names each entry by its first row
    files = bucket_files(colliding, max(1, min(MAX_FILES, sum(owners.values()))))
    own = Window.partitionBy("owner", "key", "text")
    leader = F.min("row").over(own)
    owned = stored(files.select("bucket", "key", "row", "doc_id", leader.alias("leader"), F.count("*").over(own).alias("n"),
                                F.max(F.struct("doc_id", "row")).over(own).alias("keep"),
                                F.when(F.col("row") == leader, F.col("text")).alias("text")), "owned")

    # entries of a bucket's owners, combined by their bytes and chained
    heads = owned.filter("row = leader").select("bucket", "key", "text", "leader", "n", "keep")
    entries = heads.groupBy("bucket", "key", "text").agg(F.sum("n").alias("group_size"), F.max("keep").alias("keep"))
    chain = Window.partitionBy("bucket", "key").orderBy(F.desc("keep"))
    # stored: the join below then deals both sides anew, and a key with many rows can be split
    entries = stored(entries.withColumn("chain", F.row_number().over(chain) - 1), "entries")
    named = (heads.select("bucket", "key", "text", "leader").join(entries, ["bucket", "key", "text"])
             .select("leader", "group_size", "keep", "chain", F.sha2("text", 256).alias("text_sha256")))

    members = (owned.select("bucket", "row", "doc_id", "leader").join(named, "leader")
               .select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("group_size").cast("long"),
                       (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256", "bucket", F.col("chain").cast("int")))
    single = (rows.select("key", "doc_id", F.sha2("text", 256).alias("text_sha256"))
              .join(repeated, "key", "left_anti")
              .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                      F.lit(True).alias("kept"), "text_sha256",
                      F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("int").alias("chain")))
    return members.unionByName(single)
