"""Ranked lexical search by the Best Position Algorithm.

A term has an impact list: the documents that hold it, by falling impact. A
query reads the lists of its terms from the top, in turn. A document met in one list
is looked up in all others by direct access, which gives its whole score and marks
its position in each list as seen. The best position of a list is the last
one before which every position is seen; a document not met yet lies behind the
best positions of all lists, so the impacts right behind them bound its score. As direct
accesses move best positions on, this bound falls sooner than one from the last positions read.
A query stops when the bound is strictly below its k-th score, so that no document of an equal score
is missed, or at the end of its lists.

Documents are dealt to shards as they are read; a shard holds the impact lists of
its documents and a direct-access table. A task works off its shards one by one and keeps the best k of each
query, whose k-th score already stops the next shard. Postings are not shuffled; a term
that every document holds is a list in every shard. What the tasks found is ranked in two steps.

Counts (documents, lengths, terms' document frequencies) are over all documents. Queries are
worked off in blocks, so that what a block sends to the tasks is bounded.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_cells, running_sum, ship, stored

# FIXED VALUES: of the score
TF_SCALE, TF_PER, M_PER, M_BASE, M_SHARE, W_SCALE = 1_000_000_000, 1000, 8, 10, 90, 1000

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")     # in UTF-8, whose bytes beyond ASCII are all of them above 0x7F
CELLS = 1 << 23             # of a shard's direct-access table: terms x documents
MOST_DOCS, LEAST_DOCS = 8192, 64
BLOCK_TERMS = 200_000       # distinct terms of the queries that are worked off in one pass over the documents
FIRST_STEP, MOST_STEP = 16, 1024     # positions read of each list in a round


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z lower-cased."""
    return TERM.findall((text or "").encode().lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(W_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists and the direct-access table of some documents; impacts without the term's weight."""

    def __init__(self, n_terms: int, n_docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.table = np.zeros((n_terms, n_docs), np.int32)
        self.table[term, doc] = impact

    def best(self, query: np.ndarray, weights: np.ndarray, k: int, floor: int = 0, count: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, all those among the best ``k`` and those of equal score, none below ``floor``."""
        begin, end = self.begin[query], self.begin[query + 1]
        best = begin.copy()                                    # the first position not seen, of each list
        met = np.zeros(self.table.shape[1], bool)              # a document that is met is seen in all its lists
        docs, scores, kth, step = [], [], floor, FIRST_STEP
        while True:
            more = [self.doc[b:min(b + step, e)] for b, e in zip(best.tolist(), end.tolist(), strict=True)]
            new = np.unique(np.concatenate(more)) if more else np.zeros(0, np.int64)
            new = new[~met[new]]
            if len(new):
                met[new] = True
                score = weights @ self.table[query[:, None], new].astype(np.int64)     # direct accesses
                keep = score >= max(kth, 1)
                docs.append(new[keep])
                scores.append(score[keep])
                if count is not None:
                    count.append(len(new))
                so_far = np.concatenate(scores)
                if len(so_far) >= k:
                    kth = max(kth, int(np.partition(so_far, len(so_far) - k)[len(so_far) - k]))
            bound = 0
            for i, (b, e) in enumerate(zip(best.tolist(), end.tolist(), strict=True)):
                while b < e:                                   # go on over what is seen
                    seen = met[self.doc[b:min(b + 256, e)]]
                    if not seen.all():
                        b += int(np.argmin(seen))
                        break
                    b += len(seen)
                best[i] = b
                if b < e:
                    bound += int(weights[i]) * int(self.impact[b])
            if bound < max(kth, 1):                            # 0: the lists are at their end
                break
            step = min(2 * step, MOST_STEP)
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, score = np.concatenate(docs), np.concatenate(scores)
        keep = score >= kth
        return found[keep], score[keep]


COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"


def _count(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per document its number of terms, and which terms of the queries it holds how often."""
    known = vocabulary.keys()
    for batch in batches:
        n, held, counts = [], [], []
        for text in batch.column("text"):
            found = terms(text.as_py())
            by_term = Counter(found)
            hit = known & by_term.keys()
            n.append(len(found))
            held.append([vocabulary[t] for t in hit])
            counts.append([by_term[t] for t in hit])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(held, pa.list_(pa.int32())),
                                          pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "counts"])


def _search(batches: Iterator[pa.RecordBatch], queries: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int,
            total: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each query among a task's documents, shard by shard."""
    size = min(MOST_DOCS, max(LEAST_DOCS, CELLS // max(1, len(weights))))
    last = np.iinfo(np.int64).max
    held = {q: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for q, _ in queries}
    for batch in batches:
        for lo in range(0, batch.num_rows, size):
            part = batch.slice(lo, size)
            null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = part.column("doc_id").fill_null(last).to_numpy()
            n = part.column("n").to_numpy()
            of = part.column("terms")
            doc = np.repeat(np.arange(part.num_rows), of.value_lengths().to_numpy())
            term, tf = of.flatten().to_numpy(), part.column("counts").flatten().to_numpy().astype(np.int64)
            m = M_BASE + (M_SHARE * n * n_docs) // max(1, total)
            shard = Shard(len(weights), part.num_rows, term, doc, (TF_SCALE * tf) // (TF_PER * tf + M_PER * m[doc]))
            for q, query in queries:
                old_ids, old, old_null = held[q]
                floor = int(old[-1]) if len(old) == k else 0
                found, score = shard.best(query, weights[query], k, floor)
                if len(found):
                    all_ids, all_null = np.concatenate((old_ids, ids[found])), np.concatenate((old_null, null[found]))
                    scores = np.concatenate((old, score))
                    top = np.lexsort((all_null, all_ids, -scores))[:k]
                    held[q] = all_ids[top], scores[top], all_null[top]
    out = [(q, *x) for q, found in held.items() for x in zip(*found, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([None if x[3] else int(x[1]) for x in out], pa.int64()),
         pa.array([int(x[2]) for x in out], pa.int64())], names=["query", "doc_id", "score"])


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """query (number), item_id, terms (distinct, as text), block; and how many blocks. A block holds BLOCK_TERMS terms and those of one query more at most."""
    found = F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+)"), F.lit(1)))
    rows = stored(items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
                  .select("item_id", found.alias("terms"), F.monotonically_increasing_id().alias("query"))
                  .withColumn("size", F.size("terms").cast("long")), "queries")
    dealt = (rows.withColumn("one", F.lit(1)).withColumn("cell", F.pmod(F.xxhash64("query"), F.lit(n_cells(rows.count())))))
    dealt = running_sum(dealt, ["one"], ["cell"], ["query"], "size", "before")
    blocked = stored(dealt.select("query", "item_id", "terms", F.floor(F.col("before") / BLOCK_TERMS).alias("block")), "query-blocks")
    return blocked, (blocked.agg(F.max("block")).first()[0] or 0) + 1


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` its ``k`` best rows of ``docs`` with a score above 0.

    Equal scores rank by ascending doc_id, a null id last; rows that repeat an id are documents of their own, and
    items that repeat an id are queries of their own. A null or blank text has no terms: as a document it is found by none and
    not counted, as an item it finds nothing. A text of any length is read whole. Only doc_id, item_id and text are read.
    """
    spark = docs.sparkSession
    ship(spark)
    queries, blocks = _blocks(items)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for block in range(blocks):
        mine = [(r.query, sorted({t.lower() for t in (x.encode() for x in r.terms)}))
                for r in queries.filter(F.col("block") == block).select("query", "terms").collect()]       # BLOCK_TERMS terms
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in mine for t in ts}))}
        if not vocabulary:
            continue
        counted = stored(texts.mapInArrow(lambda b, v=vocabulary: _count(b, v), COUNTED), "counted-documents")
        sums = counted.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
        if not sums.docs:
            continue
        df = {r.term: r.df for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
        weights = np.array([weight(sums.docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        asked = [(q, np.array([vocabulary[t] for t in ts if df.get(vocabulary[t])], np.int64)) for q, ts in mine]
        asked = [x for x in asked if len(x[1])]
        best = counted.filter("size(terms) > 0").mapInArrow(
            lambda b, a=asked, w=weights, s=sums: _search(b, a, w, s.docs, s.total, k), "query long, doc_id long, score long")
        best = stored(best, "best-of-tasks")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "query long, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("query", "cell").orderBy(*order)
    cell = F.pmod(F.xxhash64("doc_id", "score"), F.lit(256))
    found = found.withColumn("cell", cell).withColumn("r", F.row_number().over(some)).filter(F.col("r") <= k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k).join(queries.select("query", "item_id"), "query")
            .select("item_id", "rank", "doc_id", "score"))
