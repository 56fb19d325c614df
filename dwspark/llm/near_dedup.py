"""MinHash near-dedup by a multi-index Hamming join.

A signature has 64 values of 15 bits (14 in each fourth). Texts of Jaccard similarity s differ in
about 64 (1 - s) values; at 0.75 more than RADIUS = 30 differ with a chance of
about 3 in 100,000. The values are split into 15 chunks of four in which one
value may differ and one chunk of four in which none may: were there two
differences in each of the first and one in the last, that would make 31. So
each pair within the radius agrees in some chunk but for the allowed error, and
meets under one of the 61 keys that stand for a chunk with one value left out
(or none). Every pair within the radius is found; pairs are then confirmed on
the full shingle sets of the texts.

Texts with the same shingle set are one node. A key with many nodes is first
worked off in stars: every node is compared with the head of its keys only, and
linked nodes become one component; heads differ from round to round, and more of them are tried by what
the rounds before have left apart, so a group of n near copies makes about n candidates. What is left are keys
whose nodes lie in different components. They are compared in blocks: a unit holds two blocks
of a key, and what leaves it is no list of pairs: the nodes that are within the radius of another
component's, and edges between components, a forest over those of the unit. The components that such edges
connect form clusters, and the nodes of a cluster that were within the radius are
compared in blocks again, now on the full shingle sets. So no pair within the
radius is missed, and no unit is larger than two blocks. What units emit grows with their nodes and components, not
with pairs; but a key of n nodes is compared in (n / KEY_BLOCK)^2 / 2 units, so a node goes to n / KEY_BLOCK of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_files, row_identity, ship, stored
from .components import components
from .shingles import VALUE_BITS, overlap, overlaps, shingle_sets, signatures

VALUES, PER_CHUNK, RADIUS = 64, 4, 30
STAR_HEADS = (1, 2, 4, 8)       # heads that a node is compared with, by round
KEY_BLOCK, CLUSTER_BLOCK = 1000, 200    # nodes
LABELS = 20_000                 # rows a file, of tables of labels
CARRIES = 0x4000800080008000


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def chunk_keys(sig: Column) -> Column:
    """The 61 keys of a signature: each chunk but the last with each of its values left out, the last whole."""
    chunks = VALUES // PER_CHUNK
    keys = [F.xxhash64(sig[c].bitwiseAND(F.lit(_signed(2**64 - 1 - (0xFFFF << 16 * p)))), F.lit(c * PER_CHUNK + p))
            for c in range(chunks - 1) for p in range(PER_CHUNK)]
    return F.array(*keys, F.xxhash64(sig[chunks - 1], F.lit(chunks * PER_CHUNK)))


def differing_values(a: Column, b: Column) -> Column:
    """Number of values in which two signatures differ. Each value leaves the top bit of its
    16 free, so adding ones to all bits below carries into it just if they aren't all zero."""
    def one(c: int) -> Column:
        return F.bit_count((a[c].bitwiseXOR(b[c]) + F.lit(VALUE_BITS)).bitwiseAND(F.lit(CARRIES)))
    return sum((one(c) for c in range(1, VALUES // PER_CHUNK)), one(0))


def signature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, row (identity), n_shingles, node (128 bits of the shingle set, null if empty), sig."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.iloc[lo:lo + 500]
                sets = list(shingle_sets(part["text"]))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].array, "row": part["row"].array, "n_shingles": [len(s) for s in sets],
                    "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "sig": list(signatures(sets, VALUES))})
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", row_identity(F.col("doc_id"), F.col("text")))
    return rows.mapInPandas(run, f"doc_id {kind}, row string, n_shingles long, node binary, sig array<long>")


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets, from the whole texts, are similar enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 200):
                part = batch.iloc[lo:lo + 200]
                unique = dict(zip(part["a"], part["text_a"], strict=True)) | dict(zip(part["b"], part["text_b"], strict=True))
                sets = dict(zip(unique, shingle_sets(unique.values()), strict=True))
                same = np.array([overlap(sets[a], sets[b]) for a, b in zip(part["a"], part["b"], strict=True)], np.int64)
                sizes = np.array([len(sets[a]) + len(sets[b]) for a, b in zip(part["a"], part["b"], strict=True)], np.int64)
                yield part.loc[100 * same >= percent * (sizes - same), ["a", "b"]]
    both = (pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a binary, b binary")


def _star_pairs(at: DataFrame, r: int, most: int) -> DataFrame:
    """(a, b): the nodes of mixed keys with ``most`` heads of other components at most. These are the first heads of a node in the
    round's order, the same few for a whole group, so that candidates grow with the nodes and components are shallow."""
    heads = (at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                   F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(r))).alias("head"))
             .filter("lo != hi"))
    order = F.struct(F.xxhash64("head.node", F.lit(r)).alias("order"), F.col("head.node").alias("b"))
    return (at.join(heads, "key").filter(F.col("component") != F.col("head.component"))
            .groupBy(F.col("node").alias("a")).agg(F.collect_set(order).alias("heads"))           # one per key at most
            .select("a", F.explode(F.slice(F.array_sort("heads"), 1, most)).alias("h")).select("a", "h.b"))


def linked_nodes(nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of the nodes that are linked with another; None if there is none.
    ``nodes``: node, n, sig, row; ``rows``: row, text."""
    keys = nodes.select("node", F.explode(chunk_keys(F.col("sig"))).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(keys.join(shared.select("key"), "key", "left_semi"), "key-members")
    wanted = nodes.select("node", "row").join(members.select("node").distinct(), "node", "left_semi")
    texts = stored(rows.join(wanted, "row").groupBy("node").agg(F.first("text").alias("text")), "candidate-texts")
    sizes = nodes.select("node", "n", "sig")
    side = lambda x: sizes.withColumnsRenamed({"node": x, "n": f"n_{x}", "sig": f"sig_{x}"})
    within = ((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
              & (differing_values(F.col("sig_a"), F.col("sig_b")) <= RADIUS))

    links, of = None, None
    files = n_files(nodes.count(), LABELS)

    def labelled() -> DataFrame:
        if of is None:
            return members.withColumn("component", F.col("node"))
        return members.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def take(new: DataFrame) -> bool:
        nonlocal links, of
        new = stored(new, "near-links")
        if not new.limit(1).count():
            return False
        links = new if links is None else links.unionByName(new)
        of = components(links, files)
        return True

    for r, most in enumerate(STAR_HEADS):                   # what the heads miss is left to the units
        pairs = _star_pairs(labelled(), r, most)
        near = (pairs.join(side("a"), "a").join(side("b"), "b").filter(within)
                .groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(r))).alias("b")))
        if not take(_confirm(near, texts, percent)):
            break

    at = labelled()
    mixed = (at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("count"))
             .filter("lo != hi").select("key", "count"))
    left = at.join(mixed, "key").join(sizes, "node")
    near = stored(_in_units(left, "key", KEY_BLOCK).mapInPandas(
        lambda batches: _forests(batches, lambda g: _within_radius(g, percent)), FOREST), "radius-forests")
    edges = stored(near.filter("node IS NULL").select("a", "b").distinct(), "component-edges", files)
    if not edges.limit(1).count():
        return of
    clusters = components(edges, files).withColumnsRenamed({"component": "cluster", "node": "component"})
    told = near.filter("node IS NOT NULL").select("node").distinct()
    told = (told.withColumn("component", F.col("node")) if of is None else
            told.join(of, "node", "left").withColumn("component", F.coalesce("component", "node")))
    told = stored(told.join(clusters, "component"), "cluster-nodes")
    count = told.groupBy("cluster").agg(F.count("*").alias("count"))
    told = told.join(count, "cluster").join(texts, "node")
    take(_in_units(told, "cluster", CLUSTER_BLOCK).mapInPandas(
        lambda batches: _forests(batches, lambda g: _similar(g, percent)), FOREST).filter("node IS NULL").select("a", "b").distinct())
    return of


def _in_units(rows: DataFrame, group: str, block: int) -> DataFrame:
    """Deals each group (of ``count`` rows) into blocks and repeats a row for
    every unit, a pair of blocks, that it is part of; a unit's rows lie side by side."""
    blocks = F.ceil(F.col("count") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    units = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    unit = [group, "i", "j"]
    return (rows.withColumn("unit", F.explode(units)).withColumns({"i": F.col("unit.i"), "j": F.col("unit.j")})
            .drop("unit", "count").repartition(*unit).sortWithinPartitions(*unit)
            .withColumn("unit", F.xxhash64(*unit)).drop("i", "j", group))


def _forest(g: pd.DataFrame, linked: Callable[[pd.DataFrame], np.ndarray]) -> list[tuple[bytes | None, bytes | None, bytes | None]]:
    """A unit's rows that ``linked``, a matrix of pairs of different components, links, as (None, None, node), and edges
    (component, component, None) that connect what it connects: one less than the components at most."""
    if len(g) < 2 or not (near := linked(g)).any():
        return []
    of, names = pd.factorize(g["component"])
    linked_rows = np.flatnonzero(near.any(axis=1))
    joined = np.zeros((len(names), len(names)), bool)
    for r in linked_rows:                           # row by row, so that no list of the pairs is made
        joined[of[r], of[near[r]]] = True
    label = np.arange(len(names), dtype=np.int32)
    while True:
        new = np.minimum(label, np.where(joined, label, np.int32(len(names))).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    return ([(names[c], names[k], None) for c, k in enumerate(label.tolist()) if c != k]
            + [(None, None, n) for n in g["node"].to_numpy()[linked_rows]])


FOREST = "a binary, b binary, node binary"


def _forests(batches: Iterator[pd.DataFrame], linked: Callable[[pd.DataFrame], np.ndarray]) -> Iterator[pd.DataFrame]:
    """``_forest`` of each unit."""
    tree = lambda g: _forest(g, linked)
    held = None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        unit = batch["unit"].to_numpy()
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1)]
        found = [e for lo, hi in zip(cuts, cuts[1:], strict=False) for e in tree(batch.iloc[lo:hi])]
        held = batch.iloc[cuts[-1]:]
        if found:
            yield pd.DataFrame(found, columns=["a", "b", "node"])
    if held is not None and (found := tree(held)):
        yield pd.DataFrame(found, columns=["a", "b", "node"])


def _apart(g: pd.DataFrame, percent: int, n: np.ndarray) -> np.ndarray:
    """Pairs of different components whose sizes allow the similarity."""
    of = pd.factorize(g["component"])[0]
    small, large = np.minimum(n[:, None], n), np.maximum(n[:, None], n)
    return (of[:, None] != of) & (100 * small >= percent * large)


def _within_radius(g: pd.DataFrame, percent: int) -> np.ndarray:
    sig = np.stack(g["sig"].to_list())
    apart = _apart(g, percent, g["n"].to_numpy())
    differ = np.zeros((len(g), len(g)), np.uint8)
    if apart.any():
        for w in sig.T:
            differ += np.bitwise_count(((w[:, None] ^ w) + VALUE_BITS) & CARRIES)
    return apart & (differ <= RADIUS)


def _similar(g: pd.DataFrame, percent: int) -> np.ndarray:
    sets = list(shingle_sets(g["text"]))
    n = np.array([len(x) for x in sets])
    apart = _apart(g, percent, n)
    if not apart.any():
        return apart
    same = overlaps(sets)
    return apart & (100 * same >= percent * (n[:, None] + n - same))


def grouped_rows(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Per input row: doc_id, row (identity), n_shingles, and group: what its component shares, null without shingles."""
    ship(docs.sparkSession)
    table = stored(signature_table(docs, id_col, text_col), "signatures")
    nodes = stored(table.filter("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.min("row").alias("row")), "nodes")
    rows = docs.select(row_identity(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    of = linked_nodes(nodes, rows, percent)
    grouped = table.select("doc_id", "row", "n_shingles", F.col("node").alias("group"))
    if of is None:
        return grouped
    return (grouped.join(of.withColumnRenamed("node", "group"), "group", "left")
            .withColumn("group", F.coalesce("component", "group")).drop("component"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * shared >= ``percent`` * all of their five-word
    shingles. component_id is the least id that a row reaches over links and
    equal shingle sets; kept is doc_id = component_id (a null id equals a
    null), so all rows of one kept id are kept. Null, empty and blank texts
    have no shingles and are linked with nothing; a row of them is its own
    component. Null ids count only where a component has no other.
    """
    grouped = grouped_rows(docs, id_col, text_col, percent)
    # stored: the join below then deals both sides anew, and a group with many rows can be split
    least = stored(grouped.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("component_id")), "least-ids")
    return (grouped.join(least, "group", "left")
            .withColumn("component_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The columns of ``docs`` (doc_id and text among them), one row of each
    component: that of the least id, null ids last. Rows without shingles all
    stay. Of exactly repeated rows one stays."""
    grouped = grouped_rows(docs, "doc_id", "text", percent).withColumn("key", F.coalesce(F.hex("group"), "row"))
    keep = grouped.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return (docs.withColumn("_row", row_identity(F.col("doc_id"), F.col("text")))
            .join(keep.select(F.col("first.row").alias("_row")), "_row", "left_semi")
            .dropDuplicates(["_row"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
