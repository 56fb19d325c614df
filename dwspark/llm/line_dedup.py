"""Line dedup by probing a sharded minimal perfect hash.

Distinct line hashes (128 bits) with the number of documents they are in are
dealt to shards by hash. Each shard gets a minimal perfect hash: cascaded bit
arrays in which a key takes the first level where it alone claims its bit; the
rank of that bit is the key's place in a fingerprint and a count array. The
lines of documents are sent to their shard as hashes and probe the arrays;
no line text and no table of lines is joined.

A line that a large share of documents hold would overload its shard. Lines
with at least 1/HEAVY of all lines each - HEAVY of them at most - have a shard
of their own, which every task holds and probes before anything is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, row_identity, ship, stored

HEAVY = 50_000            # bound on the lines in the shard that all tasks hold
LINES_PER_SHARD = 200_000
LEVELS = 24


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a ^ (b * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64)
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def build_mph(a: np.ndarray, b: np.ndarray, count: np.ndarray, whole: bool = False) -> dict[str, bytes]:
    """Arrays over distinct keys (a, b): level sizes, their bits, fingerprints (the ``whole`` key or 32 bits) and counts by rank.
    What is left after the last level (next to nothing) is kept as a sorted list at the end."""
    left, sizes, bits, order = np.arange(len(a)), [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        m = max(64, 2 * len(left))
        at = (_mix(a[left], b[left], level) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(at, minlength=m) == 1
        won = alone[at]
        sizes.append(m)
        bits.append(np.packbits(alone))
        order.append(left[won][np.argsort(at[won])])
        left = left[~won]
    left = left[np.lexsort((b[left], a[left]))]
    order = np.concatenate([*order, left]).astype(np.int64)
    return {"sizes": np.array(sizes, np.int64).tobytes(), "bits": b"".join(x.tobytes() for x in bits),
            "rest": np.stack([a[left], b[left]]).tobytes(),
            "prints": (np.stack([a[order], b[order]]) if whole else (b[order] >> np.uint64(32)).astype(np.uint32)).tobytes(),
            "counts": np.minimum(count[order], 2**32 - 1).astype(np.uint32).tobytes()}


def probe_mph(index: dict[str, bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Counts of keys (a, b); 0 for a key that the index does not hold."""
    sizes = np.frombuffer(index["sizes"], np.int64)
    counts = np.frombuffer(index["counts"], np.uint32)
    whole = len(index["prints"]) == 16 * len(counts)
    prints = np.frombuffer(index["prints"], np.uint64).reshape(2, -1) if whole else np.frombuffer(index["prints"], np.uint32)
    out, place = np.zeros(len(a), np.int64), np.full(len(a), -1, np.int64)
    left, start, ranks = np.arange(len(a)), 0, 0
    for level, m in enumerate(sizes):
        n = (m + 7) // 8
        alone = np.unpackbits(np.frombuffer(index["bits"], np.uint8, n, start))[:m]
        rank = np.cumsum(alone, dtype=np.int64)
        at = (_mix(a[left], b[left], level) % np.uint64(m)).astype(np.int64)
        hit = alone[at] == 1
        place[left[hit]] = ranks + rank[at[hit]] - 1
        left, start, ranks = left[~hit], start + n, ranks + int(rank[-1])
    rest = np.frombuffer(index["rest"], np.uint64).reshape(2, -1)
    if rest.shape[1] and len(left):
        where = {k: i for i, k in enumerate(zip(*rest.tolist(), strict=True))}
        place[left] = [ranks + where[k] if (k := (int(x), int(y))) in where else -1 for x, y in zip(a[left], b[left], strict=True)]
    found = place >= 0
    if whole:
        found[found] = (prints[0, place[found]] == a[found]) & (prints[1, place[found]] == b[found])
    else:
        found[found] = prints[place[found]] == (b[found] >> np.uint64(32)).astype(np.uint32)
    out[found] = counts[place[found]]
    return out


def _u64(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64)


def _probe_shard(lines: pd.DataFrame, index: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """Lines of one shard whose count, read from the shard's arrays, reaches ``min_docs``."""
    if lines.empty or index.empty:
        return lines[["row", "pos"]].iloc[:0]
    n = probe_mph(index.iloc[0].to_dict(), _u64(lines["a"]), _u64(lines["b"]))
    return lines.loc[n >= min_docs, ["row", "pos"]]


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               min_chars: int = 1, lines_per_shard: int = LINES_PER_SHARD, heavy: int = HEAVY) -> DataFrame:
    """One row per input row: doc_id, text (what is left; null stays null if
    it loses nothing), n_lines, n_dropped.

    A line's key is the line without ASCII white space at its ends, A-Z in
    lower case. Keys of ``min_chars`` code points or more in ``min_docs``
    documents or more lose all their lines. Documents are told apart by id and
    text, so an exactly repeated row is one document; ids may be null or occur
    with several texts. A null or empty text is one empty line. Counts are
    over all documents; nothing is capped.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", row_identity(F.col("doc_id"), F.col("text")))
    key = F.transform(F.split(ascii_lower(F.coalesce("text", F.lit(""))), "\n", -1),
                      lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")))
    lines = stored(rows.select("row", F.posexplode(key).alias("pos", "line")).filter(F.length("line") >= min_chars)
                   .select("row", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
                   .groupBy("row", "a", "b").agg(F.collect_set("pos").alias("pos")), "line-hashes")

    # index: count arrays over all distinct lines, a shard per lines_per_shard lines
    total = lines.count()
    shards = total // lines_per_shard + 1
    counts = stored(lines.groupBy("a", "b").agg(F.count("*").alias("n")), "line-counts")
    shard = F.pmod("b", F.lit(shards)).cast("int")
    head = counts.filter(F.col("n") >= max(min_docs, total / heavy))            # at most ``heavy`` rows
    top = head.toPandas()
    held = build_mph(_u64(top["a"]), _u64(top["b"]), top["n"].to_numpy(), whole=True)     # lines it doesn't hold probe it too

    def build(part: pd.DataFrame) -> pd.DataFrame:
        arrays = build_mph(_u64(part["a"]), _u64(part["b"]), part["n"].to_numpy())
        return pd.DataFrame([{"shard": part["shard"].iloc[0], **arrays}])

    index = stored(counts.withColumn("shard", shard).groupBy("shard").applyInPandas(
        build, "shard int, sizes binary, bits binary, rest binary, prints binary, counts binary"), "line-index")

    @F.pandas_udf("long")
    def held_count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series(probe_mph(held, _u64(a), _u64(b)))

    probed = lines.withColumn("n", held_count("a", "b"))
    rest = probed.filter("n = 0").select(shard.alias("shard"), "row", "pos", "a", "b")
    found = rest.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        lambda x, y: _probe_shard(x, y, min_docs), "row string, pos array<int>")
    drops = (probed.filter(F.col("n") >= min_docs).select("row", "pos").unionByName(found)
             .groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("pos"))).alias("drop")))

    line = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), "drop")
    return (rows.join(drops, "row", "left")
            .withColumn("n_lines", F.size(line).cast("long"))
            .select("doc_id",
                    F.when(F.col("drop").isNull(), F.col("text"))
                    .otherwise(F.array_join(F.transform(stay, lambda i: line[i]), "\n")).alias("text"),
                    "n_lines", F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped")))
