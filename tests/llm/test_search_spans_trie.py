"""Ranked search, substring dedup and the prefix trie against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dwspark.llm import lexical_search
from dwspark.llm.lexical_search import Shard, ranked_search, terms
from dwspark.llm.prefix_trie import prefix_trie, rebuilt_conversations
from dwspark.llm.queries import queries
from dwspark.llm.substring_dedup import MOST_WINDOWS, Words, least_by_window, remove_repeated_spans, super_kmers

from test_dedup import collected, key, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BIG = 2**63 - 1


# -- ranked search

def plain_search(docs, items, k=10):
    held = [(d, Counter(TERM.findall(lower(t or "")))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked = set(TERM.findall(lower(text or "")))
        scored = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in asked if c[t])
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=key)


ITEMS = [(1, "birchc1 cedara0 ELMB2; fird1"), (2, "Shared LINE of text"), (2, "hazelh2 hazelh2 ivya0"), (3, None), (4, " .,- "), (5, "ünï çödé nowhere"),
         (None, "two words"), (6, "\U0001F642"), (7, "nothing of this occurs")]


@pytest.mark.parametrize("cells,block_terms", [(1 << 23, 200_000), (1, 200_000), (1 << 23, 3)])
def test_search_is_that_of_a_full_scan(spark, clashing, rows, monkeypatch, cells, block_terms):
    monkeypatch.setattr(lexical_search, "CELLS", cells)                   # shards of 64 documents
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block_terms)       # several blocks of queries
    items = spark.createDataFrame([(*x, "s", 0) for x in ITEMS], "item_id long, text string, score string, rank int")
    got = collected(ranked_search(clashing, items).select("item_id", "rank", "doc_id", "score"))
    assert got == plain_search([r[:2] for r in rows], ITEMS)


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search(empty, items).collect() == []
    assert ranked_search(docs, items.limit(0)).collect() == []


def test_terms_are_those_of_the_definition(rows):
    for _, text, *_ in rows:
        assert [t.decode() for t in terms(text)] == TERM.findall(lower(text or ""))
    assert terms("A_b[c]`d{e}\x7fÉé-É") == [b"a", b"b", b"c", b"d", b"e", "Éé".encode(), "É".encode()]


def test_best_positions_stop_before_last_read_positions():
    rng = np.random.default_rng(5)
    n_terms, n_docs, k = 6, 4000, 10
    present = rng.random((n_terms, n_docs)) < 0.6
    base = rng.pareto(1.2, n_docs) + 0.1                       # good documents are good in all lists
    impact = np.minimum(1_000_000, (base * 20_000 * rng.uniform(0.8, 1.2, (n_terms, n_docs)))).astype(np.int64) + 1
    term, doc = np.nonzero(present)
    shard = Shard(n_terms, n_docs, term, doc, impact[term, doc].astype(np.int32))
    weights, query, met = np.arange(1, n_terms + 1), np.arange(n_terms), []
    found, score = shard.best(query, weights, k, 0, met)
    whole = (weights[:, None] * impact * present).sum(0)
    kth = np.sort(whole)[-k]
    assert sorted(score, reverse=True)[:k] == sorted(whole, reverse=True)[:k] and (whole[found] == score).all()
    assert set(np.flatnonzero(whole >= kth)) <= set(found.tolist())
    assert sum(met) < n_docs / 2
    # the same rounds with last-read positions never stop sooner
    def rounds(best_positions):
        seen, step, at, n = set(), lexical_search.FIRST_STEP, [0] * n_terms, 0
        lists = [shard.doc[shard.begin[t]:shard.begin[t + 1]] for t in range(n_terms)]
        imps = [shard.impact[shard.begin[t]:shard.begin[t + 1]] for t in range(n_terms)]
        while True:
            n += 1
            for t in range(n_terms):
                seen.update(lists[t][at[t]:at[t] + step].tolist())
            at = [min(a + step, len(x)) for a, x in zip(at, lists, strict=True)]
            if best_positions:
                for t, x in enumerate(lists):
                    while at[t] < len(x) and x[at[t]] in seen:
                        at[t] += 1
            bound = sum(int(w) * int(i[a]) for w, i, a in zip(weights, imps, at, strict=True) if a < len(i))
            top = sorted((int(whole[d]) for d in seen), reverse=True)[:k]
            if len(top) == k and bound < top[-1] or not bound:
                return n
            step = min(2 * step, lexical_search.MOST_STEP)
    assert len(met) == rounds(True) <= rounds(False)


def test_equal_scores_are_all_looked_at(spark):
    docs = spark.createDataFrame([(1000 - i, "same words here") for i in range(500)] + [(5, "same other"), (None, "same words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    got = [(r.rank, r.doc_id) for r in ranked_search(docs, items).sort("rank").collect()]
    assert got == [(i + 1, 501 + i) for i in range(10)]


# -- substring dedup

def plain_spans(docs, width):
    texts = [(BIG if d is None else d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in texts:
        for i in range(len(w) - width + 1):
            s = tuple(w[i:i + width])
            first[s] = min(d, first.get(s, BIG))
    out = []
    for (d, w), (shown, _) in zip(texts, docs, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((shown, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=key)


def spans_corpus():
    rng = random.Random(8)
    word = lambda: rng.choice("ab") + rng.choice("xyz")  # noqa: E731   few words, so that short windows repeat by chance
    base = [[word() for _ in range(rng.randrange(0, 60))] for _ in range(40)]
    passage = [word() for _ in range(30)]
    docs = [(i, " ".join(w)) for i, w in enumerate(base)]
    docs += [(100 + i, "\t".join(w[:5] + passage + w[5:])) for i, w in enumerate(base)]
    docs += [(90, " ".join(passage * 3)), (91, " ".join(["ax"] * 400)), (92, "ax\n" * 390), (3, docs[3][1]), (3, docs[3][1]), (3, " ".join(passage)),
             (None, docs[7][1]), (None, docs[8][1] + " " + " ".join(passage)), (None, "only here zz " * 9), (200, None), (201, ""), (202, " \n\t"), (-5, docs[9][1])]
    return docs


@pytest.mark.parametrize("width,part,bucket", [(6, 3, 10_000), (6, 3, 2), (5, 1, 3), (12, 12, 5)])
def test_spans_are_those_of_a_full_comparison(spark, width, part, bucket):
    docs = spans_corpus()
    df = spark.createDataFrame([(*d, "x", 1, "m") for d in docs], "doc_id long, text string, same string, n int, minimiser string").repartition(5)
    got = remove_repeated_spans(df, width=width, part=part, bucket=bucket)
    assert collected(got.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")) == plain_spans(docs, width)


def test_spans_of_a_large_corpus_row_and_nothing(spark, docs, empty, rows):
    got = remove_repeated_spans(docs)
    assert collected(got) == plain_spans([r[:2] for r in rows], 50)
    assert remove_repeated_spans(empty).collect() == []


def test_super_kmers_cover_each_window_once():
    rng = random.Random(1)
    texts = [[rng.choice([b"a", b"bb", "ü".encode()]) for _ in range(n)] for n in (0, 3, 50, 49, 300, 51)] + [[b"z"] * 500]
    words = Words(texts)
    found = super_kmers(words, 50, 8)
    at = [(t, s + j) for t, s, n in zip(found["text"], found["start"], found["n"], strict=True) for j in range(n)]
    assert sorted(at) == [(t, i) for t, w in enumerate(texts) for i in range(len(w) - 49)]
    assert found["n"].max() <= MOST_WINDOWS
    by_window = defaultdict(set)                                 # equal windows share a minimiser
    for t, s, n, m in zip(found["text"], found["start"], found["n"], found["minimiser"], strict=True):
        for j in range(n):
            by_window[tuple(texts[t][s + j:s + j + 50])].add(m)
    assert all(len(x) == 1 for x in by_window.values())
    for f, s, t, n in zip(found["first"], found["start"], found["text"], found["n"], strict=True):
        assert words.text(f, n + 49) == b" ".join(texts[t][s:s + n + 49])


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    strings = [b"a b c d", b"b c d e", b"x y z", b"a b c"]
    right = least_by_window(strings, np.array([5, 3, 9, 4]), 3)[2].tolist()
    assert right == [4, 3, 3, 3, 9, 4]
    monkeypatch.setattr(Words, "runs", lambda self, first, length, seed=0: np.zeros(len(first), np.uint64))
    assert least_by_window(strings, np.array([5, 3, 9, 4]), 3)[2].tolist() == right


# -- prefix trie

def plain_rebuilt(turns):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + v[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], sum(not kids[q] for q in below), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=key)


SHOWN = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_corpus():
    rng = random.Random(4)
    said = ["yes", "no", "ünï", "", "a longer turn of some words", "yes"]
    out = []
    for c in range(120):
        for t in range(rng.randrange(1, 14)):
            out.append((c, t if rng.random() < 0.97 else None, rng.choice(["user", "assistant"]), rng.choice(said) if rng.random() < 0.95 else None))
    out += [(c, t, ["user", "assistant"][t % 2], "hello") for c in range(5000, 5400) for t in range(3)]       # many identical conversations
    out += [(10_003, 0, "user", "own")]                                       # its base is absent, so it may have no turn
    out += [(7777, t, "user", "long") for t in range(600)]
    out += [(3, 0, "user", "yes"), (3, 0, None, None), (None, 0, "user", "no conversation")]
    return out


def test_trie_is_that_of_all_prefixes(spark):
    turns = turns_corpus()
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, node string, depth int").repartition(7)
    convs = plain_rebuilt(turns)
    rebuilt = rebuilt_conversations(df)
    found = defaultdict(dict)
    for r in rebuilt.collect():
        found[r.conv_id][r.depth] = (r.role, r.text)
    assert {c: [x[d] for d in range(1, len(x))] for c, x in found.items()} == convs
    assert any(not s for s in convs.values())
    short = {c: s for c, s in convs.items() if len(s) < 100}
    want = plain_trie(short)
    kept = rebuilt.filter(rebuilt.conv_id.isin([c for c in short]))
    assert collected(prefix_trie(kept).select(SHOWN)) == want


def test_trie_of_one_long_and_no_conversation(spark):
    df = spark.createDataFrame([(7775, t, "user", "long") for t in range(3000)], "conv_id long, turn long, role string, text string")
    got = prefix_trie(rebuilt_conversations(df)).select("depth", "n_convs", "n_leaves", "saved_tokens").collect()
    assert sorted(map(tuple, got)) == [(d, 1, 1, 0) for d in range(3001)]
    assert prefix_trie(rebuilt_conversations(df.limit(0))).collect() == []
    none = spark.createDataFrame([(1, 0, None, None)], "conv_id long, depth int, role string, text string")
    assert [tuple(r) for r in prefix_trie(none).select(SHOWN).collect()] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


# -- the registered queries

@pytest.mark.parametrize("name", ["op11_best_position_search", "op12_super_kmer_substring_dedup", "op13_collapsed_prefix_trie"])
def test_registered_queries_match_their_sql(spark, name):
    from dwspark.llm.queries import oracle_sql
    from dwspark.oracle.compare import compare, duck_connection
    sf = "/root/testdata/sf0.001"
    ok, said = compare(queries()[name](spark, sf), duck_connection(sf), oracle_sql()[name])
    assert ok, said
