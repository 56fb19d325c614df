"""Substring dedup by super-k-mer partitioning.

A window is ``width`` words in a row. Its minimiser is the least hash of the
``part``-word sequences in it, which only follows from its words: equal windows
of any documents have the same minimiser. Consecutive windows that share one
are a super-k-mer: ``n`` windows that travel as one packed string of
n + width - 1 words.

1. Every text is scanned once; its super-k-mers become rows of numbers, without text.
2. A minimiser that one document alone holds has no window of another document:
   its super-k-mers need not travel.
3. Equal super-k-mers of the others are one (combined before the shuffle), whose string is cut from
   one text and sent to its minimiser's bucket.
4. A bucket sorts its windows and counts exactly: the least document of each distinct
   window. A bucket with many strings is split by salt; the windows of such buckets are combined over the salts.
5. What was found goes back by super-k-mer as a bit per window, and each text drops the words under its bits.

No bucket, document or group is held whole beyond ``BUCKET`` strings or one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .shingles import mix

WIDTH, PART = 50, 8
MOST_WINDOWS = 48           # of a super-k-mer: one bit each in a long
SEGMENT = 1 << 21           # bytes of text scanned at a time
BUCKET = 10_000             # strings of a bucket that are sorted together
NO_ID = 2**63 - 1           # a null id counts as larger than any
U = np.uint64

_codes = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
_letter, _word = 0x9FB21C651E98DF25, 0xA24BAED4963EE407


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(n, b, U)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=U))
    return out[0], out[1]


def _prefix_sums(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, U), np.cumsum(values * powers[:len(values)], dtype=U)))


class Words:
    """The words of texts: where each begins and ends in ``data``, and sums that give the hash of any run of words."""

    def __init__(self, texts: list[list[bytes]]):
        joined = b" ".join(b" ".join(w) for w in texts if w) + b" "
        self.data = joined
        raw = np.frombuffer(joined, np.uint8)
        count = np.array([len(w) for w in texts], np.int64)
        self.stop = np.cumsum(count)                     # end of each text, in words
        n = int(self.stop[-1]) if len(texts) else 0
        self.end = np.flatnonzero(raw == 0x20)[:n]       # a word holds no white space
        self.begin = np.concatenate((np.zeros(1, np.int64), self.end + 1))[:n]
        up, down = _powers(_letter, len(raw) + 1)
        sums = _prefix_sums(_codes[raw], up)
        self.hash = mix((sums[self.end] - sums[self.begin]) * down[self.begin])
        up, self.down = _powers(_word, n + 1)
        self.sums = _prefix_sums(self.hash, up)

    def runs(self, first: np.ndarray, length, seed: int = 0) -> np.ndarray:
        """A hash of ``length`` words from ``first`` on."""
        x = (self.sums[first + length] - self.sums[first]) * self.down[first]
        return mix(x + mix(np.atleast_1d(length).astype(U) + U(seed)))

    def text(self, first: int, length: int) -> bytes:
        return self.data[self.begin[first]:self.end[first + length - 1]]


def split_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return (text or "").encode().split()


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def super_kmers(words: Words, width: int = WIDTH, part: int = PART) -> dict[str, np.ndarray]:
    """text (which one), start (word in the text), n (windows), minimiser, string (hash of the packed words), first (word in all)."""
    empty = {k: np.zeros(0, np.int64) for k in ("text", "start", "n", "minimiser", "string", "first")}
    n = len(words.hash)
    if n < width:
        return empty
    at = np.arange(n - part + 1)
    least = _sliding_least(words.runs(at, part), width - part + 1)
    where = np.arange(len(least))
    owner = np.searchsorted(words.stop, where, side="right")
    inside = where + width <= words.stop[owner]            # the window ends in the text it starts in
    where, owner, least = where[inside], owner[inside], least[inside]
    if not len(where):
        return empty
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])))
    run = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    new |= (np.arange(len(new)) - run) % MOST_WINDOWS == 0
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(new)))
    first, text = where[head], owner[head]
    before = np.concatenate((np.zeros(1, np.int64), words.stop))[text]
    return {"text": text, "start": first - before, "n": count, "minimiser": least[head].view(np.int64),
            "string": words.runs(first, count + width - 1, seed=1 << 32).view(np.int64), "first": first}


def _segments(texts: list[str | None]) -> Iterator[tuple[int, Words]]:
    """Texts of about SEGMENT bytes at a time, with the number of the first."""
    held, size, lo = [], 0, 0
    for i, t in enumerate(texts):
        held.append(split_words(t))
        size += len(t or "")
        if size >= SEGMENT or i + 1 == len(texts):
            yield lo, Words(held)
            held, size, lo = [], 0, i + 1


def _scan(batches: Iterator[pa.RecordBatch], width: int, part: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text").to_pylist()
        for lo, words in _segments(texts):
            found = super_kmers(words, width, part)
            row = pa.array(found["text"] + lo)
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), batch.column("same").take(row), pa.array(found["start"].astype(np.int32)),
                 pa.array(found["n"].astype(np.int32)), pa.array(found["minimiser"]), pa.array(found["string"])],
                names=["id", "same", "start", "n", "minimiser", "string"])


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The packed strings that ``parts`` names in each text."""
    names = ["minimiser", "salt", "salts", "string", "lo", "hi"]
    for batch in batches:
        out: dict[str, list] = {k: [] for k in [*names, "packed"]}
        for text, parts in zip(batch.column("text"), batch.column("parts"), strict=True):
            words = split_words(text.as_py())
            for p in parts.as_py():
                for k in names:
                    out[k].append(p[k])
                out["packed"].append(b" ".join(words[p["start"]:p["start"] + p["n"] + width - 1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["minimiser"], pa.int64()), pa.array(out["salt"], pa.int32()), pa.array(out["salts"], pa.int32()),
             pa.array(out["string"], pa.int64()), pa.array(out["lo"], pa.int64()), pa.array(out["hi"], pa.int64()),
             pa.array(out["packed"], pa.binary())], names=[*names, "packed"])


def least_by_window(strings: list[bytes], lo: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Sorts the windows of packed strings: the string and the first word of each, and the least ``lo`` of the strings that hold its words.

    Windows are sorted by hash; those of one hash are told apart by their bytes."""
    words = Words([s.split(b" ") for s in strings])
    before = np.concatenate((np.zeros(1, np.int64), words.stop[:-1]))
    n = words.stop - before - width + 1
    owner = np.repeat(np.arange(len(strings)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + before[owner]
    h = words.runs(at, width)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(h[order][1:] != h[order][:-1])
    differ = [k for k in same.tolist() if words.text(at[order[k]], width) != words.text(at[order[k + 1]], width)]
    if differ:                                            # one hash for different words: group them by bytes
        for g in set(group[differ].tolist()):
            seen: dict[bytes, int] = {}
            for k in np.flatnonzero(group == g).tolist():
                group[k] = seen.setdefault(words.text(at[order[k]], width), len(order) + k)
        group = np.unique(group, return_inverse=True)[1]
    least = np.full(int(group.max()) + 1 if len(group) else 0, NO_ID, np.int64)
    np.minimum.at(least, group, lo[owner[order]])
    out = np.empty(len(order), np.int64)
    out[order] = least[group]
    return owner, at, out, words


OWNERS = "minimiser long, string long, salts int, hi long, owners array<long>, windows array<binary>"


def _count(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Buckets, in order: per string the least document of each of its windows. Rows of a bucket lie side by side;
    as many whole buckets as give BUCKET strings are sorted at a time. Strings without a smaller document for any
    reader are left out, but for split buckets, whose windows are named so that they can be combined."""
    def work(rows: pa.Table) -> pa.RecordBatch:
        packed, lo, hi = rows["packed"].to_pylist(), rows["lo"].to_numpy(), rows["hi"].to_numpy()
        salts = rows["salts"].to_numpy()
        owner, at, least, words = least_by_window(packed, lo, width)
        cuts = np.searchsorted(owner, np.arange(len(packed) + 1))
        wanted = np.zeros(len(packed), bool)
        np.logical_or.at(wanted, owner, least < hi[owner])
        keep = np.flatnonzero(wanted | (salts > 1))
        owners = [least[cuts[i]:cuts[i + 1]] for i in keep]
        # digests of the words, for the split buckets only
        names = [[hashlib.blake2b(words.text(a, width), digest_size=16).digest() for a in at[cuts[i]:cuts[i + 1]].tolist()]
                 if salts[i] > 1 else None for i in keep]
        some = rows.take(pa.array(keep))
        return pa.RecordBatch.from_arrays(
            [*(some[k].combine_chunks() for k in ("minimiser", "string", "salts", "hi")),
             pa.array(owners, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.binary()))],
            names=["minimiser", "string", "salts", "hi", "owners", "windows"])

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, BUCKET):
            held.append(batch.slice(lo, BUCKET))
            n += held[-1].num_rows
            if n < BUCKET:
                continue
            rows = pa.Table.from_batches(held)
            key = rows["minimiser"].to_numpy()
            salt = rows["salt"].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))
            if len(cut):                                  # the last bucket may go on
                end = int(cut[-1]) + 1
                yield work(rows.slice(0, end))
                held, n = rows.slice(end).to_batches(), rows.num_rows - end
    if n:
        yield work(pa.Table.from_batches(held))


def _drop(batches: Iterator[pa.RecordBatch], width: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, kept, digest = [], [], [], []
        for text, found in zip(batch.column("text"), batch.column("found"), strict=True):
            words = split_words(text.as_py())
            left = words
            if found.is_valid:
                step = np.zeros(len(words) + 1, np.int64)
                for x in found.as_py():
                    bits = x["bits"]
                    for j in range(bits.bit_length()):
                        if bits >> j & 1:
                            step[x["start"] + j] += 1
                            step[x["start"] + j + width] -= 1
                covered = np.cumsum(step)[:-1] > 0
                left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
            whole = b" ".join(left)
            n.append(len(words))
            gone.append(len(words) - len(left))
            kept.append(whole.decode() if with_text else None)
            digest.append(hashlib.sha256(whole).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()),
             pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _in_split_buckets(found: DataFrame) -> DataFrame:
    """Owners of the strings of split buckets, combined over the salts by window."""
    part = (found.filter("salts > 1")
            .select("minimiser", "string", "hi", F.posexplode(F.arrays_zip("owners", "windows")).alias("j", "w"))
            .select("minimiser", "string", "hi", "j", F.col("w.owners").alias("owner"), F.col("w.windows").alias("window")))
    least = part.groupBy("window").agg(F.min("owner").alias("least"))
    return (part.join(least, "window").groupBy("minimiser", "string", "hi")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "least"))), lambda x: x["least"]).alias("owners"))
            .filter(F.exists("owners", lambda x: x < F.col("hi"))))


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                          part: int = PART, bucket: int = BUCKET, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, and kept_text (null unless ``with_text``).

    A word goes if a window of ``width`` words covers it whose words also start a
    window of a document with a smaller id, whatever white space stands between them. Windows are judged on the input.
    Null, empty and blank texts have no words, and texts of fewer words than a window lose none. A null id is larger than any
    other; rows that share an id, equal texts included, take nothing from each other. Other columns
    are not carried along. ``bucket``: strings after which a bucket is split.
    """
    spark = docs.sparkSession
    ship(spark)
    ident: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID).cast("long"))
    texts = docs.select(F.col(id_col).alias("doc_id"), ident.alias("id"), F.xxhash64(text_col).alias("same"),
                        F.col(text_col).alias("text"))
    found = stored(texts.select("id", "same", "text").mapInArrow(
        lambda b: _scan(b, width, part), "id long, same long, start int, n int, minimiser long, string long"), "super-k-mers")

    # stored: the join below then deals both sides anew, and a minimiser with many rows can be split
    shared = stored(found.groupBy("minimiser").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                    .filter("lo < hi").select("minimiser"), "shared-minimisers")
    found = stored(found.join(shared, "minimiser", "left_semi"), "shared-super-k-mers")

    # equal super-k-mers are one; its string is cut from the text of its least document
    strings = found.groupBy("minimiser", "string").agg(
        F.min(F.struct("id", "same", "start", "n")).alias("at"), F.max("id").alias("hi"))
    strings = stored(strings.select("minimiser", "string", "at.*", "hi"), "strings")
    large = stored(strings.groupBy("minimiser").agg(F.ceil(F.count("*") / bucket).cast("int").alias("salts")).filter("salts > 1"), "large-buckets")
    strings = strings.join(large, "minimiser", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    strings = strings.withColumn("salt", F.pmod(F.xxhash64("string"), "salts").cast("int")).withColumn("lo", F.col("id"))
    parts = strings.groupBy("id", "same").agg(
        F.collect_list(F.struct("minimiser", "salt", "salts", "string", "lo", "hi", "start", "n")).alias("parts"))
    held = texts.select("id", "same", "text").join(parts, ["id", "same"]).dropDuplicates(["id", "same"])
    packed = held.select("text", "parts").mapInArrow(
        lambda b: _cut(b, width), "minimiser long, salt int, salts int, string long, lo long, hi long, packed binary")

    owned = stored(packed.repartition("minimiser", "salt").sortWithinPartitions("minimiser", "salt")
                   .mapInArrow(lambda b: _count(b, width), OWNERS), "window-owners")
    owners = (owned.filter("salts = 1").select("minimiser", "string", "owners")
              .unionByName(_in_split_buckets(owned).select("minimiser", "string", "owners")))

    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    bit = F.transform("owners", lambda x, j: F.when(x < F.col("id"), F.call_function("shiftleft", one, j)).otherwise(none))
    bits = F.aggregate(bit, none, lambda a, x: a.bitwiseOR(x))
    hits = (found.join(owners, ["minimiser", "string"]).select("id", "same", "start", bits.alias("bits")).filter("bits != 0")
            .groupBy("id", "same", "start").agg(F.bit_or("bits").alias("bits"))
            .groupBy("id", "same").agg(F.collect_list(F.struct("start", "bits")).alias("found")))
    kind = docs.schema[id_col].dataType.simpleString()
    return (texts.join(hits, ["id", "same"], "left").select("doc_id", "text", "found")
            .mapInArrow(lambda b: _drop(b, width, with_text), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"))
