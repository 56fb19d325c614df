"""Streams must equal the batch result over several micro-batches, after a lost
checkpoint, a crash, and with events that come twice or late."""
import os

import pytest
from pyspark.sql import functions as F

from dwspark.operators import versions
from dwspark.plans import history
from dwspark.streaming import microbatch as MB


@pytest.fixture
def events(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/events.parquet")


def _deliver(events, folder, *names):
    """Files of the events of some quarters of the month."""
    os.makedirs(folder, exist_ok=True)
    for b in names:
        tmp = f"{folder}/_part{b}"
        events.filter(F.floor((F.dayofmonth(F.col("ts").cast("date")) - 1) / 8) == b).coalesce(1).write.parquet(tmp)
        f = [x for x in os.listdir(tmp) if x.endswith(".parquet")][0]
        os.rename(f"{tmp}/{f}", f"{folder}/events-{b}.parquet")


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def _versions(df):
    return _rows(df.select("user_id", "status", "valid_from", "valid_to", "is_current", "version_key"))


def test_fact_after_a_lost_checkpoint_with_old_and_new_files(spark, events, sf_small, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "fact")
    _deliver(events, src, 0, 1)
    MB.stream_events_to_fact(spark, src, sink, files_per_batch=1, checkpoint=str(tmp_path / "c1"))
    _deliver(events, src, 2, 3)
    MB.stream_events_to_fact(spark, src, sink, files_per_batch=4, checkpoint=str(tmp_path / "c2"))
    want = _rows(MB.event_fact_rows(events))
    assert _rows(MB.event_fact(spark, sink)) == want
    MB.stream_events_to_fact(spark, src, sink, files_per_batch=1, checkpoint=str(tmp_path / "c3"))   # all of it again
    assert _rows(MB.event_fact(spark, sink)) == want


def test_history_after_a_lost_checkpoint_late_events_and_split_buckets(spark, events, sf_small, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "history")
    _deliver(events, src, 2, 0)                                                                       # late ones follow
    MB.stream_scd2_history(spark, src, base, files_per_batch=1, checkpoint=str(tmp_path / "c1"), rows_per_bucket=40)
    _deliver(events, src, 3, 1)
    MB.stream_scd2_history(spark, src, base, files_per_batch=2, checkpoint=str(tmp_path / "c2"), rows_per_bucket=40)
    assert _versions(MB.current_snapshot(spark, base)) == _versions(history.versions(spark, sf_small))
    assert MB.ManifestTable(spark, base).read().settings["buckets"] >= 4


def test_events_twice_in_one_batch_count_once(spark, events, tmp_path):
    sink = str(tmp_path / "fact")
    MB.append_events(spark, sink, events.unionByName(events.limit(20)))
    MB.append_events(spark, sink, events.limit(50))
    assert _rows(MB.event_fact(spark, sink)) == _rows(MB.event_fact_rows(events))


def test_a_crash_before_publishing_leaves_nothing_behind(spark, events, tmp_path, monkeypatch):
    sink, base = str(tmp_path / "fact"), str(tmp_path / "history")
    half = events.filter("event_id % 2 = 0")

    def crash(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(MB.ManifestTable, "publish", crash)
        for step in (lambda: MB.append_events(spark, sink, events), lambda: MB.fold_events(spark, base, events)):
            with pytest.raises(RuntimeError):
                step()
    assert MB.event_fact(spark, sink).count() == 0 and MB.current_snapshot(spark, base).count() == 0
    MB.append_events(spark, sink, half)
    MB.append_events(spark, sink, events)
    MB.fold_events(spark, base, half)
    MB.fold_events(spark, base, events)
    assert _rows(MB.event_fact(spark, sink)) == _rows(MB.event_fact_rows(events))
    log = events.select("user_id", "ts", "event_id", F.col("event_type").alias("status"))
    want = MB.scd.scd2_from_change_log(log, MB.KEYS, MB.ATTRS, F.col("ts").cast("date"), MB.ORDER)
    assert _versions(MB.current_snapshot(spark, base)) == _versions(want)


def _table(spark, tmp_path, **k):
    return MB.ManifestTable(spark, str(tmp_path / "t"), **k)


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    table = _table(spark, tmp_path)
    first = table.read()
    table.publish(first, {"a": "data/a"})
    with pytest.raises(versions.Conflict, match="exist"):
        table.publish(first, {"b": "data/b"})
    assert table.read().parts == {"a": "data/a"}


def test_of_writers_at_once_one_publishes(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    first = _table(spark, tmp_path).read()

    def write(k):
        try:
            return _table(spark, tmp_path).publish(first, {f"p{k}": f"data/{k}"}).parts
        except versions.Conflict:
            return None
    for _ in range(5):                                           # rounds: each follows the last winner
        with ThreadPoolExecutor(8) as pool:
            won = [x for x in pool.map(write, range(8)) if x]
        assert len(won) == 1
        first = _table(spark, tmp_path).read()
        assert first.parts == won[0]


@pytest.mark.parametrize("content", [b"", b"12 ab", b'{"parts": {}, "settings": {}}', b"5 0000\n{\"a\"", "\xff\x00".encode("latin-1")])
def test_torn_and_foreign_manifests_are_passed_over(spark, tmp_path, content):
    table = _table(spark, tmp_path)
    table.publish(table.read(), {"a": "data/a"})
    for name in ("2", "notes.txt", ".3-hidden", "_SUCCESS"):
        (tmp_path / "t" / "_manifest" / name).write_bytes(content)
    last = table.read()
    assert last.version == 1 and last.parts == {"a": "data/a"}
    assert table.publish(last, {"b": "data/b"}).version == 3 and table.read().parts == {"b": "data/b"}


def test_a_stream_goes_on_after_a_torn_manifest(spark, events, tmp_path):
    sink = str(tmp_path / "fact")
    MB.append_events(spark, sink, events.filter("event_id % 3 = 0"))
    (tmp_path / "fact" / "_manifest" / "2").write_bytes(b"")
    MB.append_events(spark, sink, events.filter("event_id % 3 = 1"))
    half_written = (tmp_path / "fact" / "_manifest" / "3").read_bytes()[:-7]
    (tmp_path / "fact" / "_manifest" / "4").write_bytes(half_written)
    MB.append_events(spark, sink, events)
    assert _rows(MB.event_fact(spark, sink)) == _rows(MB.event_fact_rows(events))


def test_the_claim_of_a_writer_holds_for_its_lease(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path)
    first = table.publish(table.read(), {"a": "data/a"})
    assert table._create(f"{table.base}/_claims/2")                # another writer has claimed, and not published
    with pytest.raises(versions.Conflict, match="another writer"):
        table.publish(first, {"b": "data/b"})
    monkeypatch.setattr(versions, "LEASE", 0.0)                    # it died
    assert table.publish(first, {"b": "data/b"}).version == 3


def test_small_parts_are_merged_in_tiers_and_large_ones_stay(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr(MB, "PARTS_PER_TIER", 3)
    monkeypatch.setattr(MB, "LAST_TIER", 1)
    sink = str(tmp_path / "fact")
    large = set()
    for k in range(9):
        MB.append_events(spark, sink, events.filter(f"event_id % 9 = {k}"))
        parts = MB.ManifestTable(spark, sink).read().parts
        now = {f for p, f in parts.items() if p.startswith("1/")}
        assert large <= now                                          # merged once, never again
        large = now
    assert _rows(MB.event_fact(spark, sink)) == _rows(MB.event_fact_rows(events))
    assert len(large) == 3 and len(parts) == 3


def test_folders_expire_by_age(spark, tmp_path, monkeypatch):
    for k in range(versions.KEPT + 3):
        (tmp_path / "t" / "data" / str(k)).mkdir(parents=True)
        table = _table(spark, tmp_path)
        table.publish(table.read(), {"p": f"data/{k}"})
    (tmp_path / "t" / "data" / "open").mkdir()                     # of a writer that has not published yet
    assert len(os.listdir(tmp_path / "t" / "data")) == versions.KEPT + 4
    assert len(table.versions()) == versions.KEPT
    old = [str(k) for k in range(3)]
    for name in old:
        os.utime(tmp_path / "t" / "data" / name, (0, 0))
    table = _table(spark, tmp_path, keep_seconds=3600.0)
    table.publish(table.read(), {"p": "data/7"})
    left = set(os.listdir(tmp_path / "t" / "data"))
    assert "open" in left and not left & set(old)
