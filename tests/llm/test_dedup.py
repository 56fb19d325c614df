"""Exact, near and line dedup against plain Python versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwspark.llm.exact_dedup import bucket_files, exact_dedup, grow_directory
from dwspark.llm.line_dedup import build_mph, line_dedup, probe_mph
from dwspark.llm.near_dedup import RADIUS, VALUES, chunk_keys, differing_values, near_dedup, one_of_each
from dwspark.llm.shingles import shingle_sets, signatures


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def plain_groups(rows):
    """The number of each row's component, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))
    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[top(i)] = top(j)
    return [top(i) for i in range(len(rows))]


def plain_components(rows):
    of, ids = plain_groups(rows), defaultdict(list)
    for r, g in zip(rows, of, strict=True):
        ids[g].append(r[0])
    least = {g: min((d for d in x if d is not None), default=None) for g, x in ids.items()}
    return [(r[0], len(shingles(r[1])), least[g], r[0] == least[g]) for r, g in zip(rows, of, strict=True)]


def key(t):
    return tuple((x is None, x) for x in t)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def plain_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        first = True
        for d in sorted(ids, key=lambda d: (d is None, d)):
            kept = d == keep and first
            first = first and not kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.length(c) % 7, lambda c: F.lit(1)])
def test_exact_dedup_decides_by_bytes_whatever_the_hash(docs, rows, hash_of):
    found = exact_dedup(docs, key=hash_of, capacity=5)
    assert collected(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == plain_exact(rows)
    chains = found.filter("chain IS NOT NULL").groupBy("text_sha256").agg(F.countDistinct("bucket", "chain").alias("n"))
    assert chains.filter("n > 1").count() == 0


def test_exact_dedup_empty_and_clashing(empty, clashing, rows):
    assert exact_dedup(empty).collect() == []
    found = exact_dedup(clashing).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collected(found) == plain_exact(rows)


def test_owner_tasks_read_their_files_without_a_shuffle(spark):
    rows = spark.range(4000).selectExpr("id % 16 AS owner", "id % 3 AS key", "id AS row", "string(id % 5) AS text")
    files = bucket_files(rows, 16)
    own = Window.partitionBy("owner", "key", "text")
    named = files.withColumn("leader", F.min("row").over(own))
    assert "Exchange" not in named._jdf.queryExecution().executedPlan().toString()
    assert files.withColumn("f", F.input_file_name()).groupBy("owner").agg(F.countDistinct("f").alias("n")).filter("n > 1").count() == 0
    assert named.filter("row = leader").count() == 16 * 3 * 5


def test_hot_key_is_dealt_over_owners_and_counted_once(spark):
    rows = [(i, "hot text" if i % 3 else f"text {i // 6}") for i in range(3000)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), capacity=100)
    assert collected(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == plain_exact(rows)


def test_directory_doubles_and_splits():
    cells = {0: 100, 1: 3, 2: 3, 200: 40, 255: 40}
    g, slots, local = grow_directory(cells, 8, 50)
    assert len(slots) == 2 ** g and g == 8               # cell 0 can't be split further: its bucket overflows
    load = Counter()
    for c, n in cells.items():
        load[slots[c >> (8 - g)]] += n
    assert sorted(load.values())[-1] == 100 and all(n <= 50 for n in sorted(load.values())[:-1])
    for b, d in local.items():                           # a bucket of local depth d owns 2^(g-d) slots, side by side
        own = [i for i, s in enumerate(slots) if s == b]
        assert len(own) == 2 ** (g - d) and own == list(range(own[0], own[0] + len(own)))
    assert grow_directory({}, 8, 50) == (0, [0], {0: 0})


def test_near_dedup_finds_the_components_of_a_full_comparison(docs, rows):
    assert collected(near_dedup(docs)) == sorted(plain_components(rows), key=key)


def test_near_dedup_empty_and_clashing(empty, clashing, rows):
    assert near_dedup(empty).collect() == []
    assert collected(near_dedup(clashing)) == sorted(plain_components(rows), key=key)


def test_near_dedup_chains_of_drifting_copies(spark):
    rng = random.Random(8)
    rows = []
    for c in range(6):
        w = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        for step in range(12):
            rows.append((rng.randrange(10**6), " ".join(w)))
            i = rng.randrange(70)
            w[i:i + 3] = [f"n{c}{step}{k}" for k in range(3)]
    found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collected(found) == sorted(plain_components(rows), key=key)


def test_one_of_each_keeps_columns_and_one_row_per_component(docs, clashing, empty, rows):
    kept = one_of_each(clashing)
    assert kept.columns == clashing.columns
    want = {g: c[2] for r, g, c in zip(rows, plain_groups(rows), plain_components(rows), strict=True) if c[1]}
    with_shingles = [r for r in kept.select("doc_id", "text").collect() if shingles(r.text)]
    assert sorted(r.doc_id for r in with_shingles) == sorted(want.values())
    without = {(r[0], r[1]) for r in rows if not shingles(r[1])}
    assert {(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect() if not shingles(r.text)} == without
    assert one_of_each(empty).collect() == []


def test_every_pair_within_the_radius_shares_a_key(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**14, (300, VALUES), dtype=np.uint16)
    b = a.copy()
    for i in range(300):
        at = rng.choice(VALUES, RADIUS, replace=False)
        b[i, at] ^= rng.integers(1, 2**14, RADIUS, dtype=np.uint16)
    pairs = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a.view(np.int64), b.view(np.int64), strict=True)],
                                  "a array<long>, b array<long>")
    r = pairs.select(differing_values(F.col("a"), F.col("b")).alias("d"),
                     F.size(F.array_intersect(chunk_keys(F.col("a")), chunk_keys(F.col("b")))).alias("shared")).collect()
    assert {x.d for x in r} == {RADIUS} and min(x.shared for x in r) >= 1


def test_shingle_sets_and_signatures(rows):
    texts = [r[1] for r in rows]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    a, b = (i for i, r in enumerate(rows) if r[0] in (500, 501))
    want = len(shingles(texts[a]) & shingles(texts[b]))
    assert len(np.intersect1d(sets[a], sets[b])) == want
    sig = signatures(sets, VALUES).view(np.uint16)
    assert (sig[a] != sig[b]).sum() <= 2 and (signatures([np.zeros(0, np.uint64)], VALUES) == 0).all()


def plain_lines(rows, least=10, chars=1):
    strip = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            seen[strip(line)].add(r[:2])
    bad = {k for k, d in seen.items() if len(d) >= least and len(k) >= chars}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if strip(x) not in bad]
        out.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay) if len(stay) < len(lines) else r[1]))
    return sorted(out, key=key)


@pytest.mark.parametrize("options", [{}, {"lines_per_shard": 7, "heavy": 3}, {"min_docs": 2, "lines_per_shard": 5, "heavy": 2}])
def test_line_dedup(clashing, rows, options):
    found = line_dedup(clashing, **options).select("doc_id", "n_lines", "n_dropped", "text")
    assert collected(found) == plain_lines(rows, options.get("min_docs", 10))


def test_line_dedup_empty(empty):
    assert line_dedup(empty).collect() == []


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64)
    n = rng.integers(1, 2**20, 5000)
    index = build_mph(a, b, n)
    assert len(index["counts"]) == 4 * 5000 and (probe_mph(index, a, b) == n).all()
    x, y = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64)
    assert (probe_mph(index, x, y) == 0).all()
    assert (probe_mph(build_mph(a[:0], b[:0], n[:0]), a, b) == 0).all()


def test_held_lines_are_told_from_unknown_ones():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 1, np.uint64) for _ in range(2))
    unknown = rng.integers(0, 2**63, 20_000, np.uint64), b ^ rng.integers(1, 2**32, 20_000, np.uint64)     # the same upper half of b
    held = build_mph(a, b, np.array([7]), whole=True)
    assert probe_mph(held, a, b).tolist() == [7] and not probe_mph(held, *unknown).any()
    assert probe_mph(build_mph(a, b, np.array([7])), a, b).tolist() == [7]


def test_a_large_group_of_near_copies_makes_about_one_star_candidate_a_node(spark, monkeypatch):
    import random

    from dwspark.llm import near_dedup as ND
    draw = random.Random(5)
    base = [f"w{draw.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(400):                                             # one word of each copy differs, and where
        text = list(base)
        text[draw.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(text)))
    made, pairs_of = [], ND._star_pairs
    monkeypatch.setattr(ND, "_star_pairs", lambda *a: made.append(pairs_of(*a)) or made[-1])
    got = ND.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.component_id, r.kept) for r in got} == {(0, True), (0, False)} and len(got) == 400
    assert sum(p.count() for p in made) <= 2 * 400                  # 8 a node before


def test_labels_of_components_lie_in_few_files(spark, tmp_path, monkeypatch):
    """A shuffle partition without more than a few labels makes no file of its own; the components are the same."""
    from dwspark.llm import common
    from dwspark.llm.components import components
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(common, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    links = [(i, i + 1) for i in range(0, 300) if i % 10 != 9]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = sorted(map(tuple, components(spark.createDataFrame(links, "a long, b long"), 3).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [(i, i // 10 * 10) for i in range(300)]
    tables = list(tmp_path.iterdir())
    assert len(tables) > 2 and all(len(list(t.glob("part-*"))) <= 3 for t in tables)
    assert [common.n_files(n, 10) for n in (0, 240, 241, 5000)] == [24, 24, 25, 500]
