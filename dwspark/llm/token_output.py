"""Token-id output in bit planes.

Documents are put in ascending id order and dealt to parts by ranges. A part's
task encodes its documents, appends the end id to each, and writes records of
whole documents. A record holds the ids in blocks of BLOCK ids. Each block is
transposed - all lowest bytes, then all second bytes, ... (or bits) - and each
plane is compressed with zstandard. The planes' sizes are the record's chunk
index, so a reader can fetch any block without the ones before it.

Records are rows of Parquet files, whose writer commits tasks atomically on any
file system that Spark writes to; a lost task leaves no half-written record.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship

BLOCK = 65_536             # ids in a block
RECORD = 524_288           # ids after which a record ends with the document at hand
WORDS_HELD = 1_000_000      # bound on the word cache of a Python worker
TEXTS, CHARACTERS = 5000, 8_000_000    # encoded at a time, at most, but for a longer text
RECORD_SCHEMA = ("part int, record int, first long, ids long, doc_ids array<long>, lengths array<long>, "
                 "block int, unit string, planes array<int>, payload binary")

CUT = re.compile(r"(?<=\S) (?=\S)")
OTHER_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"                          # white space but for the space and the line feed
OTHER = OTHER_ASCII + "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(chr(c) for c in range(0x2000, 0x200B))


class Encoder:
    """Ids of texts. The byte-level pre-tokenizer starts a new word at each space that stands between two characters that are
    not white space, and makes a line feed that does so an id of its own; so a text may be cut there, and its pieces
    encode to the same ids as the whole text. A piece that follows a space is held by its text, one that
    follows a line feed by a line feed and its text. Most pieces occur again and again; Arrow numbers the different
    ones of many texts, each is encoded once and its ids are kept as bytes, up to WORDS_HELD pieces. Special tokens in a text count as the
    tokenizer has them; a text that holds one is encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark's tasks use the cores already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.held: dict[str, bytes] = {}
        self.trails: dict[str, bytes] = {}        # ids of a run of punctuation
        # the byte-level pre-tokenizer leaves ASCII letters whole and as they are, a space before them as one letter more
        laws, model = json.loads(self.tokenizer.to_str()), self.tokenizer.model
        kind = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_letters = (laws["normalizer"] is None and laws["model"]["type"] == "BPE" and laws["pre_tokenizer"] is not None
                           and kind.items() <= laws["pre_tokenizer"].items())
        self.of_letters = lambda word: array("I", [t.id for t in model.tokenize(word)]).tobytes()
        line = self._ids(["\n"])[0]
        self.line = int(line[0])
        # the vocabulary is one in which line feeds can be told apart
        self.by_line = len(line) == 1 and [x.tolist() for x in self._ids([" 1a\n b2", "c\nd"])] == [
            [*x, self.line, *y] for x, y in ((self._ids([" 1a"])[0], self._ids([" b2"])[0]), (self._ids(["c"])[0], self._ids(["d"])[0]))]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, text: str) -> str | None:
        """A text whose words are parted by single spaces and line feeds, with spaces between its pieces, the first as after a line feed."""
        if not text or any(c in text for c in (OTHER_ASCII if text.isascii() else OTHER)):
            return None
        marked = text.replace("\n", " \n")
        if "  " in marked or "\n " in marked or marked[0] == " " or marked[-1] in " \n":
            return None
        return "\n" + marked

    def _of_marked(self, texts: list[str]) -> Iterator[np.ndarray]:
        pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        numbered = pieces.flatten().dictionary_encode()
        different = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        held = list(map(self.held.get, different))
        new = [i for i, x in enumerate(held) if x is None]
        self._learn([different[i] for i in new])
        for i in new:
            held[i] = self.held[different[i]]
        ids, n = np.frombuffer(b"".join(held), np.uint32), np.fromiter(map(len, held), np.int64, len(held)) // 4
        at, number = np.cumsum(n) - n, numbered.indices.to_numpy()
        ends = np.cumsum(n[number])
        kind = np.int32 if max(ends[-1], len(ids)) < 2**31 else np.int64
        flat = ids[np.repeat((at[number] - ends + n[number]).astype(kind), n[number]) + np.arange(ends[-1], dtype=kind)]
        last = ends[pieces.offsets.to_numpy()[1:] - 1].tolist()
        return (flat[lo + 1:hi] for lo, hi in zip([0, *last], last, strict=False))     # without the line feed before the first piece

    def _learn(self, pieces: Iterable[str]) -> None:
        """Words are learned without the punctuation behind them, those of ASCII letters by the tokenizer's model itself,
        others many at a time: with line feeds between them they don't touch."""
        new, trailing = set(), {}
        for p in pieces:
            if not p.isalpha():
                word = p.rstrip(string.punctuation)
                if len(word) < len(p) and (word.isalpha() or word[:1] == "\n" and word[1:].isalpha()):
                    trailing[p] = word
                    p = word
            if p not in self.held:
                new.add(p)
        letters = [w for w in new if self.by_letters and w.isascii() and (w.isalpha() or w[:1] == "\n" and w[1:].isalpha())]
        line = np.uint32(self.line).tobytes()
        self.held.update((w, line + self.of_letters(w[1:]) if w[0] == "\n" else self.of_letters("Ġ" + w)) for w in letters)
        new.difference_update(letters)
        after_line = [w for w in new if w[0] == "\n" and w.split() == [w[1:]]]
        after_space = [w for w in new if w.isalpha() or w.split() == [w]]
        for some, first, between in ((after_space, " ", "\n "), (after_line, "", "")):
            for i in range(0, len(some), 10_000):
                self._learn_many(some[i:i + 10_000], first, between)
        rest = [w for w in new if w not in self.held]
        self.held.update(zip(rest, (x.tobytes() for x in self._ids([" " + w for w in rest])), strict=True))
        for p, word in trailing.items():
            trail = p[len(word):]
            if trail not in self.trails:
                self.trails[trail] = self._ids([trail])[0].tobytes()
            self.held[p] = self.held[word] + self.trails[trail]

    def _learn_many(self, words: list[str], first: str, between: str) -> None:
        ids = self._ids([first + between.join(words)])[0]
        at = np.flatnonzero(ids == self.line)
        raw = ids.tobytes()
        if between:                    # the line feeds are no part of the words
            bounds = zip([0, *(at + 1).tolist()], [*at.tolist(), len(ids)], strict=True)
        else:                          # each word begins with its own
            bounds = zip(at.tolist(), [*at[1:].tolist(), len(ids)], strict=True)
        self.held.update((w, raw[4 * lo:4 * hi]) for w, (lo, hi) in zip(words, bounds, strict=True))

    def forget(self) -> None:
        self.held.clear()
        self.trails.clear()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.by_line or any(s in t for s in self.special)]
        left = set(range(len(texts))).difference(whole)
        marked = {i: m for i in left if (m := self._marked(texts[i])) is not None}
        odd = sorted(left.difference(marked))                       # other white space: cut where a single space is
        tails = {i: CUT.split(texts[i]) for i in odd}
        for i, ids in zip([*whole, *odd], self._ids([*(texts[i] for i in whole), *(tails[i][0] for i in odd)]), strict=True):
            out[i] = ids
        if len(self.held) > WORDS_HELD:
            self.forget()
        if marked:
            for i, ids in zip(marked, self._of_marked(list(marked.values())), strict=True):
                out[i] = ids
        self._learn(set().union(*(tails[i][1:] for i in odd)).difference(self.held))
        for i in odd:
            out[i] = np.concatenate((out[i], np.frombuffer(b"".join(map(self.held.__getitem__, tails[i][1:])), np.uint32)))
        return out


def _at_once(texts: list[str]) -> Iterator[slice]:
    """Slices of at most TEXTS texts and CHARACTERS characters, or one longer text."""
    lo, n = 0, 0
    for i, text in enumerate(texts):
        if i > lo and (i - lo == TEXTS or n + len(text) > CHARACTERS):
            yield slice(lo, i)
            lo, n = i, 0
        n += len(text)
    if texts:
        yield slice(lo, len(texts))


_encoders: dict[str, Encoder] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies; the workers find it at the same place."""
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_words() -> None:
    """A Python worker lives on after its tasks and runs other stages; its encoders let go of the words that they hold."""
    for enc in _encoders.values():
        enc.forget()


def to_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """The planes of a block of uint32 ids, lowest first, each compressed."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    by = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [squeeze(by[:, k].tobytes()) for k in range(4)]
    bits = np.unpackbits(by, axis=1, bitorder="little")
    return [squeeze(np.packbits(bits[:, k]).tobytes()) for k in range(32)]


def from_planes(planes: list[bytes], n: int, unit: str = "byte") -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    if unit == "byte":
        by = np.stack([np.frombuffer(expand(p), np.uint8) for p in planes], axis=1)
    else:
        by = np.packbits(np.stack([np.unpackbits(np.frombuffer(expand(p), np.uint8))[:n] for p in planes], axis=1),
                         axis=1, bitorder="little")
    return np.ascontiguousarray(by).view("<u4").reshape(-1)[:n]


def _record(part: int, number: int, first: int, doc_ids: list, ids: list[np.ndarray], unit: str, block: int) -> dict:
    flat = np.concatenate(ids)
    planes = [p for i in range(0, len(flat), block) for p in to_planes(flat[i:i + block], unit)]
    return {"part": part, "record": number, "first": first, "ids": len(flat), "doc_ids": doc_ids,
            "lengths": [len(x) for x in ids], "block": block, "unit": unit,
            "planes": [len(p) for p in planes], "payload": b"".join(planes)}


def write_token_files(docs: DataFrame, vocabulary: str, path: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 0, parts: int | None = None, unit: str = "byte",
                      block: int = BLOCK, record: int = RECORD) -> str:
    """Encode the whole texts (null: empty) and write them; returns the path.

    ``path``/records holds the ids, ``path``/index one row per record (where
    its ids start in the part, how many, its documents). A null id sorts
    first; repeated ids are kept, each as a document of its own. ``unit`` is
    byte or bit. ``end_id`` follows every document, an empty one too.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or scratch_path(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the third key keeps many rows of one id, even equal ones, from sharing a part; equal texts give equal ids in any order
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    keys = ["doc_id", "tie", "row"]
    dealt = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    dealt = dealt.sortWithinPartitions(*keys).select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, number, first, doc_ids, ids, n = encoder(vocabulary), 0, 0, [], [], 0
        part = 0
        for batch in batches:
            part = int(batch["part"].iloc[0]) if len(batch) else part
            texts, names = batch["text"].tolist(), batch["doc_id"].astype("Int64").tolist()
            for some in _at_once(texts):
                for name, x in zip(names[some], enc.encode(texts[some]), strict=True):
                    doc_ids.append(None if name is pd.NA else name)
                    ids.append(np.append(x, np.uint32(end_id)))
                    n += len(x) + 1
                    if n >= record:
                        yield pd.DataFrame([_record(part, number, first, doc_ids, ids, unit, block)])
                        number, first, doc_ids, ids, n = number + 1, first + n, [], [], 0
        if ids:
            yield pd.DataFrame([_record(part, number, first, doc_ids, ids, unit, block)])

    # the payload is compressed already
    dealt.mapInPandas(encode, RECORD_SCHEMA).write.option("compression", "none").parquet(f"{path}/records")
    (spark.read.schema(RECORD_SCHEMA).parquet(f"{path}/records")
     .select("part", "record", "first", "ids", F.size("doc_ids").alias("documents"), F.size("planes").alias("planes"),
             F.element_at("doc_ids", 1).alias("first_doc_id"))
     .write.parquet(f"{path}/index"))
    return path


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, in any order: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (little-endian uint32 ids), and the ids if asked."""
    ship(spark)
    index = spark.read.parquet(f"{path}/index")
    parts = index.groupBy("part").agg(F.sum("ids").alias("n"))          # one row per part
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_words()                 # the files are written
        for batch in batches:
            for r in batch.itertuples():
                ends = np.cumsum(r.planes)
                per = 4 if r.unit == "byte" else 32
                planes = [r.payload[e - n:e] for e, n in zip(ends, r.planes, strict=True)]
                flat = np.concatenate([from_planes(planes[k * per:(k + 1) * per], min(r.block, r.ids - k * r.block), r.unit)
                                       for k in range(len(planes) // per)])
                stop = np.cumsum(r.lengths)
                out = pd.DataFrame({"part": r.part, "doc_id": pd.array([None if pd.isna(d) else int(d) for d in r.doc_ids], "Int64"),
                                    "at": r.first + stop - r.lengths, "n_tokens": r.lengths,
                                    "ids_crc32": [zlib.crc32(flat[e - n:e].tobytes()) for e, n in zip(stop, r.lengths, strict=True)]})
                if with_ids:
                    out["ids"] = [flat[e - n:e].astype(np.int64) for e, n in zip(stop, r.lengths, strict=True)]
                yield out

    rows = spark.read.schema(RECORD_SCHEMA).parquet(f"{path}/records").mapInPandas(decode, schema)
    return rows.join(before, "part").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens",
                                            "ids_crc32", *["ids"] * with_ids)
