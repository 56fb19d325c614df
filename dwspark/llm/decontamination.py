"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is small and a document may be long, so their Jaccard similarity
says little; what counts is the share of the item's shingles that the document
holds. Items are partitioned by size (powers of two). An item's sketch is its
bottom-k MinHash: the k shingles that come first, those in the fewest documents
before others and then by hash, k following from its partition's upper size u
as u - ceil(share * u) + 1. A document that holds the share misses fewer than k
of the item's shingles, so it holds at least one of the sketch, in whatever
order: the search loses no document, however long. Rare shingles first keep a
sentence that many items and documents share out of the sketches. Documents are
partitioned by size too, and one that is too small for an item's share is no
candidate. Candidates are verified by exact containment of the shingle sets.

Items go in blocks, whose distinct shingles are sent to all tasks. One pass over
the documents for a block keeps, of each document, the shingles that some item
has; document frequencies, candidates and their check read only these.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, row_identity, stored, words

BLOCK = 200_000                   # shingles of the items of a block, on average


def with_shingles(df: DataFrame, text: Column, width: int = 5) -> DataFrame:
    """Adds ``shingles``: the distinct hashes of ``width`` words in a row; with fewer words, one of all; with none, empty.

    Don't filter on them or unfold them with an inner explode right away: such
    a filter is pushed below, where the words are split anew for each shingle."""
    df = df.withColumn("_hash", F.transform(words(ascii_lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w)))
    n = F.size("_hash")
    runs = F.transform(F.sequence(F.lit(0), n - width),
                       lambda i: F.xxhash64(*[F.col("_hash")[i + k] for k in range(width)]))
    return df.withColumn("shingles", F.when(n >= width, F.array_distinct(runs))
                         .when(n > 0, F.array(F.xxhash64(F.lit("short"), F.col("_hash"))))
                         .otherwise(F.array().cast("array<long>"))).drop("_hash")


def item_sketches(items: DataFrame, found_in: DataFrame, percent: int) -> DataFrame:
    """(item, need, shingle): the sketches of (item, n, need, shingles), rare shingles
    first; ``found_in`` has (shingle, docs). A shingle that no document holds is left out."""
    part = F.floor(F.log2(F.col("n")))
    upper = F.pow(F.lit(2), part + 1) - 1
    k = F.least(F.col("n"), upper - F.ceil(upper * percent / 100) + 1).cast("int")
    ordered = (items.select("item", "need", k.alias("k"), F.explode("shingles").alias("shingle")).join(found_in, "shingle", "left")
               .groupBy("item", "need", "k").agg(F.array_sort(F.collect_list(F.struct(
                   F.coalesce("docs", F.lit(0)).alias("docs"), F.xxhash64(F.lit(3), "shingle").alias("h"), "shingle"))).alias("all")))
    return (ordered.select("item", "need", F.explode(F.slice("all", F.lit(1), F.col("k"))).alias("x"))
            .filter("x.docs > 0").select("item", "need", "x.shingle"))


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", percent: int = 75,
                    block: int = BLOCK) -> DataFrame:
    """One row per distinct document (id and text) and item of which it holds
    ``percent`` of the five-word shingles or more: row (identity of the
    document), doc_id, item_id, n_item, n_shared, containment.

    Null and blank texts hold and are nothing. An item of fewer than five
    words is found in documents that consist of just these words. Repeated
    documents and repeated items give one row; ids may be null.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"),
                       row_identity(F.col(doc_id), F.col(doc_text)).alias("row"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"),
                         row_identity(F.col(item_id), F.col(item_text)).alias("item")).dropDuplicates(["item"])
    items = stored(with_shingles(items, F.col("text")).drop("text"), "item-shingles")
    items = (items.withColumn("n", F.size("shingles")).filter("n > 0")
             .withColumn("need", F.ceil(F.col("n") * percent / 100).cast("int")))
    entries = items.agg(F.sum("n")).first()[0] or 0
    blocks = entries // block + 1
    found = []
    for b in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        known = some.select(F.explode("shingles").alias("shingle")).distinct()
        held = (with_shingles(rows, F.col("text"))
                .select("row", "doc_id", F.size("shingles").alias("n_doc"), F.explode_outer("shingles").alias("shingle"))
                .join(F.broadcast(known), "shingle"))                                   # BLOCK entries
        held = stored(held.groupBy("row", "doc_id", "n_doc").agg(F.collect_set("shingle").alias("held")), "held-shingles")
        hits = held.select("row", "n_doc", F.explode("held").alias("shingle"))
        sketch = stored(item_sketches(some, hits.groupBy("shingle").agg(F.count("*").alias("docs")), percent), "item-sketches")
        candidates = (hits.join(F.broadcast(sketch), "shingle")                         # BLOCK entries
                      .filter("n_doc >= need").groupBy("row").agg(F.collect_set("item").alias("items")))
        pairs = (held.join(candidates, "row").select("row", "doc_id", "held", F.explode("items").alias("item"))
                 .join(F.broadcast(some.select("item", "item_id", "n", "need", "shingles")), "item"))
        found.append(stored(pairs.select("row", "doc_id", "item_id", F.col("n").cast("long").alias("n_item"), "need",
                                         F.size(F.array_intersect("held", "shingles")).cast("long").alias("n_shared"))
                            .filter("n_shared >= need"), "contained"))
    return (reduce(DataFrame.unionByName, found).dropDuplicates(["row", "item_id", "n_item", "n_shared"])
            .select("row", "doc_id", "item_id", "n_item", "n_shared",
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay as they are."""
    bad = contained_items(docs, items, percent=percent).select(F.col("row").alias("_row")).distinct()
    return (docs.withColumn("_row", row_identity(F.col("doc_id"), F.col("text")))
            .join(bad, "_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))
