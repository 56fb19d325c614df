"""Sharding, mixing, token files, chat windows and decontamination against
plain versions, round trips and the rules of their results."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwspark.llm import token_output
from dwspark.llm.chat_format import CONTROL, conversation_digests, escape, format_windows, read_windows, unescape
from dwspark.llm.decontamination import contained_items, decontaminate, item_sketches, with_shingles
from dwspark.llm.mixing import document_rows, mix, mixed_texts, permuted, source_targets, taken_words
from dwspark.llm.sharding import cut_links, shard_balanced
from dwspark.llm.token_output import Encoder, from_planes, read_token_files, to_planes, vocabulary_path, write_token_files
from dwspark.session import shared_dir

from test_dedup import collected, key, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- sharding

def sharded(spark, rows, n_shards):
    docs = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "row long, size long")
    links = spark.createDataFrame([(i, k) for i, (_, ks) in enumerate(rows) for k in ks], "row long, link string")
    out = shard_balanced(docs.withColumn("shard_name", F.lit("x")), links, n_shards)
    return out, links


def test_shards_are_even_gapless_and_keep_links(spark):
    rng = random.Random(2)
    rows = [(8 + int(rng.paretovariate(1.3) * 100) % 5000, [f"g{i // 4}"] if i < 400 else []) for i in range(1500)]
    rows += [(900, ["hot"])] * 500                                        # a group larger than a shard
    out, links = sharded(spark, rows, 8)
    got = out.select("row", "size", "shard", "slot").collect()
    assert sorted(r.row for r in got) == list(range(len(rows)))
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(load.values()) / 8
    assert set(load) == set(range(8)) and max(abs(x - mean) for x in load.values()) <= 0.02 * mean
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    cut = {r.link: (r.members, r.shards) for r in cut_links(out, links).collect()}
    assert sum(s > 1 for k, (_, s) in cut.items() if k != "hot") <= 10
    assert cut["hot"][1] <= int(np.ceil(500 * 900 / mean))


def test_large_groups_lie_in_as_few_shards_as_they_fill(spark):
    """A group of four shards alone; several large groups that fill all shards; chains of links."""
    for parts in (1, 5):
        rows = [(900, ["hot"])] * 500 + [(10 + i % 7, []) for i in range(34_000)]
        docs = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "row long, size long").repartition(parts)
        links = spark.createDataFrame([(i, k) for i, (_, ks) in enumerate(rows) for k in ks], "row long, link string")
        out = shard_balanced(docs, links, 8)
        load = [r.load for r in out.groupBy("shard").agg(F.sum("size").alias("load")).collect()]
        assert cut_links(out, links).first().shards == int(np.ceil(500 * 900 / (sum(load) / 8)))
        assert max(load) - min(load) <= 2 * 900
    out, links = sharded(spark, [(10, [f"h{i % 3}"]) for i in range(900)], 8)
    assert all(r.shards <= 4 for r in cut_links(out, links).collect())
    rng = random.Random(4)
    out, links = sharded(spark, [(50 + rng.randrange(50), [f"a{i // 5}", f"b{(i + 2) // 5}"] if i < 300 else []) for i in range(900)], 8)
    cuts = cut_links(out, links).filter("members > 1").collect()
    before = 1 - (1 / 8) ** 4                                           # share of groups of five that chance cuts
    assert sum(r.shards > 1 for r in cuts) < 0.4 * before * len(cuts)


def test_shards_carry_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, 5, "c", "1", "h", "p", "mine", -1) for i in range(40)],
                                 "row long, size long, cell string, one string, hub string, pinned string, shard string, slot long")
    links = spark.createDataFrame([(i, None if i % 5 == 0 else "x" if i < 4 else f"g{i % 7}") for i in range(40)], "row long, link string")
    out = shard_balanced(docs, links, 4)
    got = out.collect()
    assert sorted(out.columns) == sorted(docs.columns) and len(got) == 40
    assert all((r.cell, r.one, r.hub, r.pinned) == ("c", "1", "h", "p") and 0 <= r.shard < 4 and r.slot >= 0 for r in got)


def test_shards_of_few_empty_and_equal_rows(spark):
    out, _ = sharded(spark, [(8, [])] * 5, 24)
    assert out.count() == 5
    out, _ = sharded(spark, [], 4)
    assert out.collect() == [] and "slot" in out.columns
    out, _ = sharded(spark, [(100, ["a", "a"])] * 50, 4)
    assert sorted(r["n"] for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect())[-1] <= 14


# -- mixing

def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, stopped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * sizes[s]]
        if not over:
            return {s: 3.0 * sizes[s] if s in stopped else left * weight[s] / sum(weight[x] for x in open_) for s in names}
        stopped |= set(over)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 70, "\U0001F642": 5, "": 400}, {"a": 5}, {"a": 0, "b": 9},
                                   {"a": 1, "b": 1, "c": 10_000}, {None: 0}])
def test_targets_share_and_stop(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_meets_targets_and_bounds(spark, clashing, rows):
    sizes = document_rows(clashing)
    out, spans = mix(sizes, block=16, per_shard=50)
    got = out.join(taken_words(spans), "row", "left").fillna(0, ["taken"]).collect()
    assert len(got) == len(rows)
    by, total = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by[r.source] += r.taken
        total[r.source] += r["size"]
    want = plain_targets(total)
    assert {s: r for s, r in by.items()} == pytest.approx(want, abs=1)
    again = mix(sizes, block=16, per_shard=50)[1]
    assert collected(spans) == collected(again)
    slots = [r.slot for r in spans.select("slot").distinct().collect()]
    assert len(slots) == len(spans.select("s", "block", "pass").distinct().collect())


def test_mix_stores_the_targets_alone(spark, clashing):
    """Each file that a task writes to a local folder costs a process or more on the executor."""
    sizes = document_rows(clashing)
    folder = Path(shared_dir(spark).removeprefix("file:"), "dwspark")
    before = set(folder.iterdir())
    out, spans = mix(sizes, block=16, per_shard=50)
    out.join(taken_words(spans), "row", "left").collect()
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["targets"]


def test_mixed_texts_hold_the_words_taken(spark, docs):
    numbered = _numbered(spark, docs)
    _, spans = mix(numbered.select("row", "order", "size", "source"), block=16)
    words = {r.row: WORD.findall(r.text or "") for r in numbered.collect()}
    want = defaultdict(list)
    for r in spans.collect():
        want[r.row, r["pass"]].append((r["from"], r.to))
    got = mixed_texts(numbered, spans).collect()
    assert len(got) == len(want)
    texts = sorted(" ".join(WORD.findall(r.text)) for r in got)
    assert texts == sorted(" ".join(w for a, b in sorted(s) for w in words[k[0]][a:b]) for k, s in want.items())


def _numbered(spark, docs):
    rows = [(i, hash((r.doc_id, r.text)), len(WORD.findall(r.text or "")), r.source, r.text, r.doc_id) for i, r in enumerate(docs.collect())]
    return spark.createDataFrame(rows, "row long, order long, size long, source string, text string, doc_id long")


def test_mix_of_nothing(spark, empty):
    out, spans = mix(document_rows(empty))
    assert out.collect() == [] and spans.collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    out, spans = mix(document_rows(blank))
    assert [r.target for r in out.collect()] == [0, 0] and spans.collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_permutations_are_permutations(spark, n):
    df = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(5)).alias("a"), permuted(F.col("id"), F.lit(n), F.lit(6)).alias("b"))
    got = df.collect()
    assert sorted(r.a for r in got) == sorted(r.b for r in got) == list(range(n))
    assert n < 50 or [r.a for r in got] != [r.b for r in got] != list(range(n))


# -- token files

@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert (from_planes(to_planes(ids, unit), n, unit) == ids).all()


ODD = ["", " ", "  ", " a", "a  b", "a \n b", "\n\n x", "x\t y z", "<|endoftext|> a <|endoftext|>b", "é ñ    z", "a　 b", "end ",
       "tab\tx y\n", "it's a 'll don't 123 4 5,6 !? ", "\U0001F642 \U0001F642‍\U0001F642 x", "a\x85 b\x1c c", "line\nline two \nthree"]


def plain_tokenizer():
    """The tokenizer as it is in its file, not the object that the operator holds."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def test_pieces_encode_like_whole_texts(rows):
    rng = random.Random(6)
    parts = ["a", "B", " ", "  ", "\n", "\n\n", "é", "\t", "'s", "don't", ".", "...", "1", "23", "\u3000", "\xa0", "\x85", "\x1c", "\u200b", "語",
             "<|endoftext|>", "<|endo", "\U0001F642", "\r\n", "_", "x y", "word", " and", "\nThen"]
    texts = ODD + [r[1] or "" for r in rows] + ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(5000)]
    enc, plain = Encoder(vocabulary_path()), plain_tokenizer()
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert plain.encode("<|endoftext|>", add_special_tokens=False).ids == enc.encode(["<|endoftext|>"])[0].tolist() == [50256]


def test_words_of_letters_are_learned_by_the_model(monkeypatch):
    """Words of ASCII letters, also with punctuation behind them, don't go through the pre-tokenizer; each is learned once."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgXYZ") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts = [f"{w} {v},\n{w}. {v}" for w, v in zip(words, words[1:], strict=False)]
    enc, plain = Encoder(vocabulary_path()), plain_tokenizer()
    seen, ids = [], enc._ids
    monkeypatch.setattr(enc, "_ids", lambda some: seen.extend(some) or ids(some))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert [t for t in seen if any(c.isalpha() for c in t)] == []
    monkeypatch.setattr(enc, "_learn", lambda new: not new or pytest.fail("learned again"))
    assert [x.tolist() for x in enc.encode(texts)] == want


def test_texts_are_encoded_some_at_a_time(monkeypatch):
    monkeypatch.setattr(token_output, "TEXTS", 3)
    monkeypatch.setattr(token_output, "CHARACTERS", 10)
    texts = ["a", "b", "c", "d", "e" * 10, "f" * 30, "", "g" * 6, "h" * 5]
    assert [texts[s] for s in token_output._at_once(texts)] == [["a", "b", "c"], ["d"], ["e" * 10], ["f" * 30], ["", "g" * 6], ["h" * 5]]
    assert list(token_output._at_once([])) == []


def test_workers_hold_no_words_after_files_are_read(spark, docs):
    """A Python worker outlives its task and goes on to other stages."""
    def held(batches):
        from dwspark.llm import token_output
        for _ in batches:
            pass
        yield pd.DataFrame({"n": [len(token_output._encoders)], "words": [sum(len(e.held) + len(e.trails) for e in token_output._encoders.values())]})

    def found():
        return spark.range(0, 64, 1, 64).mapInPandas(held, "n long, words long").collect()

    path = write_token_files(docs, vocabulary_path(), parts=64)
    assert any(r.words for r in found())
    conf = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1k"}       # a task for each file at least
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        read = read_token_files(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(read) == docs.count()
    assert any(r.n for r in found()) and not any(r.words for r in found())


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_token_files_round_trip(spark, clashing, rows, unit):
    enc = plain_tokenizer()
    path = write_token_files(clashing, vocabulary_path(), parts=3, unit=unit, block=64, record=500)
    got = read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids[-1] == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    want = sorted((key((r[0],)), tuple(enc.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted((key((r.doc_id,)), tuple(r.ids[:-1])) for r in got) == want


def test_token_files_of_nothing(spark, empty):
    assert read_token_files(spark, write_token_files(empty, vocabulary_path())).collect() == []


# -- chat windows

TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be brief \\ " + rng.choice(CONTROL)))
        for t in range(1, rng.randrange(2, 40)):
            words = [rng.choice(["ok", "\\", "\\n", "<", "[", "|", "\n", *CONTROL, "é\U0001F642"]) for _ in range(rng.randrange(0, 25))]
            rows.append((c, t, "assistant" if t % 2 == 0 else "user", " ".join(words)))
    rows += [(50, 1, "user", "x " * 3000), (50, 2, "assistant", "y " * 3000), (51, 0, "system", "only"), (None, 1, "user", None), (None, None, None, "a"),
             (52, 1, "odd\nrole\\n<|im_end|>", "t"), (52, 1, "user", "same"), (52, 1, "user", "same"), (53, -5, "assistant", ""), (53, 10**15, "assistant", "z")]
    return rows


def plain_digests(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(said), sha(said))
    return out


def test_windows_read_back_to_the_conversations(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash")).withColumn("pos", F.lit(1))
    windows = format_windows(df, budget=100, history_tokens=30, history_turns=3)
    got = {r.conv_id: tuple(r)[1:5] for r in conversation_digests(windows).collect()}
    assert got == plain_digests(rows)
    assert conversation_digests(windows).agg(F.sum("formatted_chars")).first()[0] == windows.agg(F.sum(F.length("text"))).first()[0]


def test_windows_keep_to_the_budget_and_repeat_context(spark):
    rows = conversations()
    windows = format_windows(spark.createDataFrame(rows, TURNS), budget=100, history_tokens=30, history_turns=3)
    systems = {r[0]: len(WORD.findall(r[3])) + 4 for r in rows if r[2] == "system"}
    for w, r in zip(windows.orderBy("conv", "window").collect(), read_windows(windows).orderBy("conv", "window").collect(), strict=True):
        new = [t for t in r.turns if t.role != "system"]
        alone = sum(len(WORD.findall(t.text)) + 4 for t in new) + systems.get(w.conv_id, 0)
        assert w.n_tokens <= 100 or (len(new) == 1 and w.n_tokens == alone)          # no history beside it
        assert (w.text.startswith("<|im_start|>system\n")) == (w.conv_id in systems)
        assert w.repeated <= 4 and len(r.turns) >= 1
        assert w.text.count("<|im_start|>") == w.repeated + len(r.turns)
        assert [x.start for x in w.loss] == sorted(x.start for x in w.loss)


def test_history_yields_to_a_long_turn(spark):
    """System 24, three turns of 64 and one of 474: within 512, though a full history would make it 562."""
    rows = [(1, 0, "system", "s " * 20), *[(1, t, "user", "w " * 60) for t in (1, 2, 3)], (1, 4, "assistant", "a " * 470), (1, 5, "user", "w " * 5)]
    got = format_windows(spark.createDataFrame(rows, TURNS), budget=512, history_tokens=128).collect()
    assert max(w.n_tokens for w in got) <= 512
    assert sum(n for w in got for n in [len(w.loss)]) == 1


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["\\", "\\\\", "<", "[", "n", "\n", *CONTROL]) for _ in range(rng.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL)


def test_windows_of_nothing(spark):
    assert conversation_digests(format_windows(spark.createDataFrame([], TURNS))).collect() == []


# -- decontamination

def plain_contained(docs, items):
    out = set()
    for d, t in {(r[0], r[1]) for r in docs}:
        for i, x in set(items):
            a, b = shingles(t), shingles(x)
            if b and 100 * len(a & b) >= 75 * len(b):
                out.add((d, i, len(b), len(a & b)))
    return sorted(out, key=key)


def items_of(rows):
    rng = random.Random(5)
    texts = [r[1] for r in rows if r[1]]
    items = [(None, "one two"), (1, None), (2, ""), (3, "ONE  two"), (4, "nowhere to be found in any of these documents at all")]
    for i in range(25):
        w = WORD.findall(rng.choice(texts))
        n = rng.randrange(5, 40)
        at = rng.randrange(max(1, len(w) - n))
        part = w[at:at + n]
        if i % 2 and len(part) > 12:
            part[rng.randrange(len(part))] = "edited"
        items.append((10 + i, " ".join(part).upper() if i % 3 else " ".join(part)))
    long = [r[1] for r in rows if r[0] == 500][0].split(" ")
    return [*items, items[-1], (90, " ".join(long[20_000:20_040])), (91, " ".join(long[5:9_000]))]


@pytest.mark.parametrize("block", [100_000, 2_000])         # one block, and about five
def test_contained_items_are_those_of_a_full_comparison(spark, clashing, rows, block):
    items = items_of(rows)
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("clash")).withColumn("row", F.lit(0))
    got = contained_items(clashing, df, block=block).select("doc_id", "item_id", "n_item", "n_shared")
    assert collected(got) == plain_contained(rows, items)


def test_a_shared_sentence_makes_no_candidates(spark):
    """Items and documents that have one sentence in common: none of it is in a sketch, and the one true pair is found."""
    rng = random.Random(8)
    said = "answer the following question with one of the options given below please"
    own = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    items = [(i, f"{said} {own(25)}") for i in range(60)]
    texts = [(i, f"{own(15)} {said} {own(40)}") for i in range(60)] + [(60, f"{own(9)} {items[7][1]} {own(9)}")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = with_shingles(docs, F.col("text")).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("docs"))
    held = with_shingles(bench, F.col("text")).select(F.col("item_id").alias("item"), F.size("shingles").alias("n"), F.lit(1).alias("need"), "shingles")
    sketch = item_sketches(held, hits, 75)
    assert {r.item for r in sketch.collect()} == {7} and sketch.join(hits.filter("docs > 2"), "shingle").count() == 0
    assert [(r.doc_id, r.item_id, r.containment) for r in contained_items(docs, bench).collect()] == [(60, 7, 1.0)]


def test_decontaminate_drops_just_the_documents_that_hold_an_item(spark, clashing, empty, rows):
    items = items_of(rows)
    bad = {(d, t) for d, t in {r[:2] for r in rows} if plain_contained([(d, t)], items)}
    df = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate(clashing, df)
    assert clean.columns == clashing.columns
    assert collected(clean.select("doc_id", "text")) == sorted((r[:2] for r in rows if r[:2] not in bad), key=key)
    assert decontaminate(empty, df).collect() == [] and contained_items(clashing, df.limit(0)).collect() == []
