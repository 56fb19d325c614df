"""Quality classifier and secret scan on held-out rows, and the pipeline's stages against plain versions."""

import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwspark.llm import quality as Q
from dwspark.llm.secret_scan import dictionary, findings, scan_secrets, with_features

from conftest import SCHEMA, prose
from test_dedup import collected, key, plain_groups, shingles

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def judged(n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randrange(20, 80))
        if bad:
            text = " ".join(w + rng.choice(["$$$", "!!", "###"]) for w in text.upper().split(" "))
        rows.append((i, text, "en", "spam" if bad and i % 3 else f"s{i % 5}", len(text)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_quality_on_held_out_documents(spark):
    rows, labels = judged()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score_", F.lit(1))
    known = [x for x in labels if x[0] % 2]
    known += [(i, y) for i, y in labels if i % 4 == 0 and i % 8]
    got = Q.score_quality(docs, spark.createDataFrame(known, "doc_id long, quality int"))
    assert got.columns == [*docs.columns, "p_content", "p_meta", "score", "accepted"]
    y, seen = dict(labels), {i for i, _ in known}
    right = [r.accepted == bool(y[r.doc_id]) for r in got.collect() if r.doc_id not in seen]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(600) < 0.5).astype(np.float32)
    x, z = (np.stack([y + rng.normal(0, 0.2, 600), rng.normal(0, 1, 600)], 1).astype(np.float32) for _ in range(2))
    held = np.arange(600) % 4 == 0
    few = np.arange(600) < 60
    model = Q.co_train(x[few], z[few], y[few], held[few], x[~few], z[~few])
    assert sum(map(sum, model.pseudo)) > 50
    assert ((model.score(x, z) > 0.5) == y)[~few].mean() > 0.97


def test_quality_edges(spark, clashing, empty, rows):
    rows_, labels = judged(80)
    extra = [(1, None), (None, 1), (3, 0), (3, 1), (10**9, 1)]
    table = spark.createDataFrame([*labels, *extra], "doc_id long, quality int")
    both = clashing.select(COLUMNS).unionByName(spark.createDataFrame([(r[0] + 10**6, *r[1:]) for r in rows_], SCHEMA))
    shifted = table.withColumn("doc_id", F.col("doc_id") + 10**6)
    got = Q.score_quality(both, shifted).collect()
    assert len(got) == len(rows) + 80 and all(0 <= r.score <= 1 and r.accepted == (r.score >= Q.ACCEPT) for r in got)
    assert Q.score_quality(empty, table).collect() == []
    alone = Q.score_quality(clashing, table.limit(0)).collect()                # no labels: nothing is rejected
    assert len(alone) == len(rows) and all(r.accepted and r.score is None for r in alone)
    only_text = both.select("doc_id", "text")
    assert Q.score_quality(only_text, shifted).count() == len(rows) + 80


def test_all_unlabelled_documents_teach(spark):
    rows, labels = judged(6000, 4)
    few = [x for x in labels if x[0] < 400]
    model = Q.fit_quality(spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(few, "doc_id long, quality int"))
    assert max(max(given) for given in model.pseudo) > 4_000
    x, z = Q.content_features([r[1] for r in rows]), Q.meta_features(pd.DataFrame([dict(source=r[3], lang=r[2], n_chars=r[4], n_lines=1) for r in rows]))
    packed = [Q.pack_counts(Q.gram_counts(r[1])) for r in rows[:9]] + [Q.pack_counts(Q.gram_counts("ab" * 999))]
    assert np.allclose(Q.unpacked(packed, [bytes(5)] * 10)[0], np.concatenate([x[:9], Q.content_features(["ab" * 999])]), atol=1e-6)
    assert ((model.score(x, z) > 0.5) == [y for _, y in labels]).mean() > 0.97


def test_labelled_sample_by_class_and_one_row_an_id(spark):
    rows, labels = judged(400)
    rare = [(i, y) for i, y in labels if y or i < 40]                          # 10 bad ones, 300 good ones
    hot = [(1, rows[0][1] + str(i), "en", "s1", 9) for i in range(600)]        # one labelled id with most rows
    known = spark.createDataFrame(rare, "doc_id long, quality int")
    first = Q.fit_quality(spark.createDataFrame(rows + hot, SCHEMA), known, max_labelled=40)
    again = Q.fit_quality(spark.createDataFrame(hot[::-1] + rows[::-1], SCHEMA), known, max_labelled=40)
    assert first is not None and np.allclose(first.content, again.content, atol=1e-3)
    y = np.array([y for _, y in labels])
    x, z = Q.content_features([r[1] for r in rows]), Q.meta_features(pd.DataFrame([dict(source=r[3], lang=r[2], n_chars=r[4], n_lines=1) for r in rows]))
    assert ((first.score(x, z) > 0.5) == y).mean() > 0.9


def test_features_cover_whole_texts():
    a = Q.content_features(["x" * (Q.PIECE + 5) + "yz" * 50])
    b = Q.content_features(["x" * (Q.PIECE + 5)])
    assert (a > 0).sum() > (b > 0).sum() and (Q.content_features([None, ""]) == 0).all()


def secrets(n=300, seed=3):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        words = prose(rng, 30).split(" ")
        run = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        kind = i % 3
        if kind == 0:
            words[10:12] = ["token", "=", f'"{run}"']
            truth[run] = True
        elif kind == 1:
            words[10] = f"user{i}.name@mail{i}.example.com"
            truth[words[10]] = False
        else:
            words[10] = str(rng.randrange(10**15, 10**16))
            truth[words[10]] = False
        rows.append((i, " ".join(words), "en", "src/a", 1))
    return rows, truth


def test_secret_scan_on_held_out_findings(spark):
    rows, truth = secrets()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit("clash")).withColumn("length", F.lit(3))
    known = [(c, int(t)) for k, (c, t) in enumerate(sorted(truth.items())) if k % 2]
    labelled = spark.createDataFrame([*known, ("nothing", None)], "candidate string, label int")
    for given in (labelled, None):
        got = {r.candidate: r for r in scan_secrets(docs, given).collect() if r.candidate in truth}
        assert set(got) == set(truth)
        assert np.mean([got[c].is_secret == t for c, t in truth.items()]) > 0.98


def test_findings_carry_their_place_and_neighbours(spark, docs, empty):
    df = spark.createDataFrame([(1, "a b\tpassword: 'abc123def456ghi7' end", "p/q"), (1, "a b\tpassword: 'abc123def456ghi7' end", "p/q"), (2, None, None),
                                (3, "", None), (4, "123456789012", None), (None, "x 1234567890123", "z")], "doc_id long, text string, source string")
    got = collected(findings(df).select("doc_id", "word_no", "candidate", "before1", "after", "path"))
    assert got == sorted([(1, 3, "abc123def456ghi7", "password:", "end", "p/q"), (4, 0, "123456789012", None, None, None),
                          (None, 1, "1234567890123", "x", None, "z")], key=key)
    assert scan_secrets(empty).collect() == []
    alone = scan_secrets(df.filter("doc_id = 4")).collect()                    # one class at most: every finding stays
    assert [(r.probability, r.is_secret) for r in alone] == [(None, True)]
    assert findings(docs).count() == 0


def test_all_runs_of_a_word_are_candidates(spark):
    df = spark.createDataFrame([(1, 'x api_secret_key="AKIA1234567890ABCD"', None), (2, "client_secret='9f8a7b6c5d4e3f2a1b0c'", None),
                                (3, '{"user_id":"1234567890123","access_token":"ghp_a1b2c3d4e5f6a7b8","session_key":"00ffee11dd22cc33"}', None),
                                (4, "abcd1234efgh5678,9999aaaa8888bbbb", None)], "doc_id long, text string, source string")
    found = findings(df)
    got = {(r.doc_id, r.word_no, r.candidate): r.run_no for r in found.collect()}
    assert got == {(1, 1, "AKIA1234567890ABCD"): 1, (2, 0, "9f8a7b6c5d4e3f2a1b0c"): 1, (3, 0, "1234567890123"): 0, (3, 0, "ghp_a1b2c3d4e5f6a7b8"): 2,
                   (3, 0, "00ffee11dd22cc33"): 3, (4, 0, "abcd1234efgh5678"): 0, (4, 0, "9999aaaa8888bbbb"): 1}
    seen = {r.candidate: (r.named, r.assigned) for r in with_features(found, dictionary(df)).collect()}
    assert seen["AKIA1234567890ABCD"] == seen["9f8a7b6c5d4e3f2a1b0c"] == seen["ghp_a1b2c3d4e5f6a7b8"] == (1, 1) and seen["1234567890123"] == (0, 1)
    out = scan_secrets(df)
    assert out.columns == ["doc_id", "word_no", "run_no", "candidate", "probability", "is_secret"]
    assert {(r.doc_id, r.word_no, r.candidate): r.run_no for r in out.collect()} == got


def test_bare_keys_are_secrets_by_weak_labels(spark):
    rows, truth = secrets()
    rng = random.Random(8)
    bare = {"".join(rng.choice("0123456789abcdef") for _ in range(40)): i for i in range(150)}
    rows += [(1000 + i, f"run it with {k} now" if i % 2 else k, "en", "src/a", 1) for k, i in bare.items()]
    got = {r.candidate: r.is_secret for r in scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert np.mean([got[k] for k in bare]) > 0.98 and np.mean([got[c] == v for c, v in truth.items()]) > 0.98


def test_few_known_secrets_among_many_findings(spark):
    rows, truth = secrets()
    docs = spark.createDataFrame([r for r in rows if r[0] % 3 or r[0] < 30], SCHEMA)     # 10 secrets, 200 others
    labelled = spark.createDataFrame([(c, int(v)) for c, v in truth.items()], "candidate string, label int")
    got = scan_secrets(docs, labelled, max_train=20).collect()
    assert all(r.probability is not None for r in got)
    assert np.mean([r.is_secret == truth[r.candidate] for r in got]) > 0.9


def test_dictionary_counts_all_documents(spark):
    df = spark.createDataFrame([("Alpha beta ab",)] * 3 + [("alpha, gamma",)], "text string")
    assert sorted(r.word for r in dictionary(df, min_count=3).collect()) == ["alpha", "beta"]


# -- pipeline

@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents of both qualities, copies, near copies and benchmark passages, with labels."""
    rng = random.Random(9)
    rows, labels = judged(300, 5)
    rows += [(1000 + i, rows[4 * i + 1][1] + " end", "en", "s1", 1) for i in range(20)]
    rows += [(1100 + i, rows[4 * i + 2][1], "de", None, 1) for i in range(20)]
    items = [(i, " ".join(rows[4 * i + 3][1].split(" ")[2:17])) for i in range(10)]
    rows += [(1200 + i, prose(rng, 20) + " " + t + " " + prose(rng, 30), "en", "s2", 1) for i, t in items]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = corpus_pipeline.stored(stages["quality classifier"](spark, docs, sf_dir), "a")
    assert good.columns == COLUMNS
    ids = {r.doc_id for r in good.collect()}
    clean = {i for i in range(300) if i % 4}
    assert len(clean & ids) >= 0.99 * len(clean) and len(ids & {i for i in range(300) if i % 4 == 0}) <= 5

    rows = [tuple(r) for r in good.collect()]
    single = corpus_pipeline.stored(stages["MinHash near-dedup"](spark, good, sf_dir), "b")
    best = {}
    for r, g in zip(rows, plain_groups(rows), strict=True):
        best[g] = min(best.get(g, r[0]), r[0])
    assert collected(single) == sorted((r for r in rows if r[0] in set(best.values())), key=key)

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = lambda t: any(100 * len(shingles(t) & shingles(x)) >= 75 * len(shingles(x)) for x in items)
    kept = corpus_pipeline.stored(stages["benchmark decontamination"](spark, single, sf_dir), "c")
    assert collected(kept) == sorted((tuple(r) for r in single.collect() if not held(r.text)), key=key)

    mixed = corpus_pipeline.stored(stages["mixing to target weights"](spark, kept, sf_dir), "d")
    sizes, taken, whole = defaultdict(int), defaultdict(int), {r.doc_id: r.text for r in kept.collect()}
    for r in kept.collect():
        sizes[r.source] += len(r.text.split())
    for r in mixed.collect():
        taken[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(whole[r.doc_id].split())
    from test_outputs import plain_targets
    assert dict(taken) == pytest.approx(plain_targets(sizes), abs=1)

    out = stages["token-id output"](spark, mixed, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed.collect())
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_pipeline_of_nothing(spark, sf_dir, empty, clashing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
        assert stage(spark, clashing, sf_dir).columns[:1] == ["doc_id"], name
