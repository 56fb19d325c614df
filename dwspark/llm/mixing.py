"""Mixing sources to target weights, in fixed-length blocks of words.

Each source is one long sequence of words (its documents in a pseudorandom
order), cut into blocks of BLOCK words, the last one shorter. A source's
target decides how many blocks are drawn; the last block drawn is cut so that
the words taken meet the target. The draws of all sources are strata of one
multinomial draw: draw i of n has the uniform (i + 1/2) / n, and a
pseudorandom permutation of 0..n-1 deals the draws to slots. An output shard is
a run of slots, so its source counts are a multinomial draw whose totals over
all shards are exact. Draw j of a source takes block p(j mod its blocks),
p being the source's own pseudorandom permutation; so every pass over a source
takes each block once before any block comes again.

Permutations are swap-or-not shuffles (Hoang, Morris and Rogaway), which
permute a range of any length without a sort, in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_cells, running_sum, stored, word_count, words

BLOCK = 256
BLOCKS_PER_SHARD = 4096
MOST_PASSES = 3
SEED = 20240229
DRAWS_PER_TASK = 50_000
STEPS = 24               # of the swap-or-not shuffle


def permuted(x: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, one for each key."""
    def step(at: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, k), n) - at, n)
        swap = F.pmod(F.xxhash64(key, k, F.greatest(at, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), x.cast("long"), step)


def source_targets(sizes: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """(source, source_size) -> plus target. One row per source, null last.

    Sources weigh 1, 2, 3, 1, ... by code point and share all words; a target
    stops at ``most`` times its source's size and the excess is reshared by
    weight among the others until none is above. In closed form: with sources
    by size per weight, the level t solves sum(min(most * size, t * weight)) =
    all words; the sources below the level are the ones that stop.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    ranked = sizes.withColumn("weight", (rank % 3 + 1).cast("double"))
    by = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    filled = (ranked.withColumn("all", F.sum("source_size").over(whole))
              .withColumn("stopped", F.coalesce(F.sum("source_size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most)
              .withColumn("open", F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("level", (F.col("all") - F.col("stopped")) / F.col("open"))
              .withColumn("holds", most * F.col("source_size") >= F.col("level") * F.col("weight")))
    t = F.min(F.when(F.col("holds"), F.struct(F.col("source_size") / F.col("weight"), "level"))).over(whole)["level"]
    return filled.select("source", "source_size", "weight",
                         F.least(F.lit(float(most)) * F.col("source_size"),
                                 F.coalesce(t, F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, block: int = BLOCK, per_shard: int = BLOCKS_PER_SHARD, seed: int = SEED,
        most: int = MOST_PASSES) -> tuple[DataFrame, DataFrame]:
    """(rows, spans) of a mix of ``docs`` (row long: unique; size long: words; source).

    rows: the columns of ``docs`` plus source_size and target.
    spans: what the mix holds, one row per document and drawn block that
    overlap: shard, slot (its place in the mix), source block, pass, row,
    from and to (words of the document, to exclusive). A null source is a
    source like any other, last in order. Rows of size 0 are in no span.
    The result depends on nothing but the rows, their order keys and the seed.
    ``docs`` is read several times and should be stored; only the targets, a
    row per source, are stored here.
    """
    total = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: its number stands in for its name, nulls included
    targets = stored(source_targets(total, most).withColumn(
        "s", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("int") - 1), "targets")
    n = docs.count()
    rows = (docs.withColumn("cell", F.pmod(F.xxhash64("order", F.lit(seed)), F.lit(n_cells(n))))
            .join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
            .drop("_source", "weight"))

    # each document's place in its source, and the blocks that it is part of
    placed = running_sum(rows.filter("size > 0").select("s", "cell", "order", "row", "size"),
                         ["s"], ["cell"], ["order", "row"], "size", "start")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.select("s", "row", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    pieces = pieces.select("s", "block", "row",
                           F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("from"),
                           F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")).alias("to"),
                           F.greatest(F.col("start") - F.col("block") * block, F.lit(0)).alias("at"))

    # the plan takes what few sources unfold into for small; the hint keeps it from being broadcast
    draws = drawn_blocks(targets, block, per_shard, seed).hint("merge")
    keep = F.least(F.col("to"), F.col("from") + F.col("words") - F.col("at"))
    spans = (pieces.join(draws, ["s", "block"])
             .filter(F.col("at") < F.col("words"))
             .select("shard", "slot", "s", "block", "pass", "row", "from", keep.alias("to")))
    return rows, spans


def drawn_blocks(targets: DataFrame, block: int, per_shard: int, seed: int) -> DataFrame:
    """One row per draw: s, block, pass, words (of the block that are taken), slot, shard."""
    size, want = F.col("source_size"), F.round("target").cast("long")
    per = (targets.filter("source_size > 0").withColumn("want", want)
           .withColumn("blocks", F.ceil(size / block).cast("long"))
           .withColumn("passes", F.floor(F.col("want") / size))
           .withColumn("draws", F.col("passes") * F.col("blocks")
                       + F.ceil((F.col("want") - F.col("passes") * size) / block).cast("long")))
    per = (per.withColumn("base", F.sum("draws").over(Window.orderBy("s")) - F.col("draws"))
           .withColumn("all", F.sum("draws").over(Window.partitionBy()))
           .filter("draws > 0"))
    # draws are made in two steps, so that no row unfolds into more than 4,096
    parts = (per.agg(F.sum("draws")).first()[0] or 0) // DRAWS_PER_TASK + 1
    runs = (per.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("draws") - 1) / 4096))).alias("run"))
            .repartition(parts, "s", "run"))
    each = runs.select("*", F.explode(F.sequence(F.col("run") * 4096, F.least(F.col("run") * 4096 + 4095, F.col("draws") - 1))).alias("draw"))
    nth, pas = F.col("draw") % F.col("blocks"), F.floor(F.col("draw") / F.col("blocks"))
    # the last, shorter block ends each pass; the others are permuted anew in each
    full = F.floor(size / block).cast("long")
    at = F.when(nth < full, permuted(nth, F.greatest(full, F.lit(1)), F.xxhash64(F.lit(seed), "s", pas))).otherwise(nth)
    before = pas * size + nth * block
    length = F.least(F.lit(block), size - at * block, F.col("want") - before)
    return each.select("s", at.alias("block"), pas.alias("pass"), length.alias("words"),
                       permuted(F.col("base") + F.col("draw"), F.col("all"), F.lit(seed)).alias("slot")) \
        .withColumn("shard", F.floor(F.col("slot") / per_shard)).filter("words > 0")


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, order, doc_id, size, source) for ``mix``, stored so that row stays put. Repeated rows stay apart;
    the order of documents in a source comes from a hash of id and text."""
    return stored(docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"),
                              F.col(source_col).alias("source"),
                              F.xxhash64(F.col(id_col), F.col(text_col)).alias("order"))
                  .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def taken_words(spans: DataFrame) -> DataFrame:
    return spans.groupBy("row").agg(F.sum(F.col("to") - F.col("from")).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per document and pass that takes any of it: the columns of
    ``docs`` (row, size, text and others) with text cut to the words taken. A
    document that a pass takes whole keeps its text; otherwise its words taken,
    in order, are joined by spaces."""
    parts = (spans.groupBy("row", "pass").agg(F.sum(F.col("to") - F.col("from")).alias("_took"),
                                              F.sort_array(F.collect_list(F.struct("from", "to"))).alias("_spans")))
    joined = docs.join(parts, "row")
    joined = joined.withColumn("_words", words(F.col("text")))
    some = F.flatten(F.transform("_spans", lambda x: F.slice("_words", x["from"].cast("int") + 1, (x["to"] - x["from"]).cast("int"))))
    return (joined.withColumn("text", F.when(F.col("_took") == F.size("_words"), F.col("text"))
                              .otherwise(F.array_join(some, " ")))
            .drop("_took", "_spans", "_words"))
