"""A prefix trie of conversations by whole-sequence collapse.

A node is a distinct sequence of first turns; it is named by a digest that is chained
turn by turn. Identical conversations are collapsed into one weighted
sequence (how many conversations, which is the smallest, which ones end there), so
only one of them goes on. A sequence whose digest is an inner node of another is a proper prefix; the
anti-join with the inner nodes leaves the sequences that are leaves. The
weighted prefixes of the sequences are then aggregated to nodes.

A conversation is read in order, as a stream: its digests need the turn before and
nothing else, so a conversation of any length is held by no task. The ids that end at
a node are put in runs of RUN ids, and runs are hashed in order, also as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, utf8_bytes

PERIOD, MOST_SHARED = 5, 8       # of rebuilt_conversations
RUN_BITS = 12                    # a run holds the ids of one range of 2^12
ROOT = hashlib.blake2b(b"", digest_size=16).digest()
NODES = "conv_id long, depth int, node binary, parent binary, bytes long, last boolean"


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, depth, role, text: conversations that share beginnings, made of ``turns``.

    A conversation c begins with the first h turns of the conversation c - c % 5
    (none if there is no such one), h = crc32(decimal c) % 9, and goes on with its
    own turns after its first h. The row of depth 0 has no turn; each conversation has one, one without turns too.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    own = (turns.filter("conv_id IS NOT NULL")
           .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
           .withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))))
    own = stored(own.drop("turn"), "turns")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    convs = own.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % PERIOD).alias("base"),
                                                    shared.cast("int").alias("h"))
    begin = own.filter(F.col("at") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    head = convs.join(begin, "base").filter("at <= h").select("conv_id", "at", "role", "text")
    tail = own.join(convs, "conv_id").filter("at > h").select("conv_id", "at", "role", "text")
    root = convs.select("conv_id", F.lit(0).alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    whole = root.unionByName(head).unionByName(tail)
    depth = F.row_number().over(Window.partitionBy("conv_id").orderBy("at")) - 1
    return whole.select("conv_id", depth.alias("depth"), "role", "text")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests along each conversation; rows come by (conv_id, depth). A row leaves when the next one shows whether it is the last."""
    names = ["conv_id", "depth", "node", "parent", "bytes", "last"]
    waiting, digest = None, ROOT
    for batch in batches:
        out: list[tuple] = []
        for conv, depth, turn, n in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "depth", "turn", "bytes")), strict=True):
            if waiting is not None:
                out.append((*waiting, conv != waiting[0]))
            parent = None if depth == 0 else digest
            digest = ROOT if depth == 0 else hashlib.blake2b(digest + turn, digest_size=16).digest()
            waiting = (conv, depth, digest, parent, n)
        yield _table(out, names)
    if waiting is not None:
        yield _table([(*waiting, True)], names)


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end at each node, comma-joined; runs come by (node, run)."""
    at, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if node == at:
                state.update(b",")
            else:
                if at is not None:
                    nodes.append(at)
                    digests.append(state.hexdigest())
                at, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["node", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over ``conversations`` (conv_id, depth from 0, role, text).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (what is saved if every prefix is kept once, in UTF-8 bytes), ends_sha256, and node, parent (names).
    A null role or text is empty. Turns are equal if role and text are. Rows of one conversation have
    different depths from 0 up; a conversation with depth 0 alone ends at the root. No conversations: no nodes.
    """
    spark = conversations.sparkSession
    ship(spark)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length tells where the role ends; the digest stands for both
    turn = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select("conv_id", "depth", turn.alias("turn"), utf8_bytes(F.col("text")).alias("bytes"))
    nodes = stored(rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(_chained, NODES), "conversation-nodes")

    # identical conversations are one weighted sequence, known by its smallest conversation
    ends = nodes.filter("last").select(F.col("node").alias("seq"), "conv_id")
    sequences = stored(ends.groupBy("seq").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    prefixes = nodes.join(sequences, "conv_id").select("conv_id", "weight", "depth", "node", "parent", "bytes", "last")
    prefixes = stored(prefixes, "prefixes")
    inner = prefixes.filter("NOT last").select(F.col("node").alias("seq")).distinct()
    leaves = sequences.join(inner, "seq", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))

    # a node's own text is counted once, for its smallest conversation; what a sequence saves from a depth on is a sum along it
    first = stored(prefixes.groupBy("node").agg(F.min("conv_id").alias("first")), "first-conversations")
    saved = F.col("bytes") * (F.col("weight") - F.when(F.col("first") == F.col("conv_id"), 1).otherwise(0))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighted = (prefixes.join(first, "node").withColumn("saved", F.sum(saved).over(below))
                .join(leaves, "conv_id", "left"))
    trie = stored(weighted.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "trie")

    children = trie.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = trie.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    run = F.call_function("shiftright", F.col("conv_id"), F.lit(RUN_BITS))
    runs = (ends.withColumn("run", run).groupBy(F.col("seq").alias("node"), "run")          # 2^RUN_BITS ids at most
            .agg(F.concat_ws(",", F.array_sort(F.collect_list("conv_id")).cast("array<string>")).alias("ids")))
    hashed = (runs.repartition("node").sortWithinPartitions("node", "run").select("node", "ids")
              .mapInArrow(_hashed, "node binary, ends_sha256 string"))
    return (trie.join(children, "node", "left").join(parents, "parent", "left").join(hashed, "node", "left")
            .select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "node", "parent"))
