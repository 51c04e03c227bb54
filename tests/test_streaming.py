from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_social import TOMBSTONE, message

from tidemark import schemas
from tidemark.operators import messages as msg
from tidemark.operators import metrics, words
from tidemark.operators import topics as tp
from tidemark.plans import topic_report
from tidemark.sources import files, snapshots, streams
from tidemark.sources.store import AppendStore, TableStore
from tidemark.streaming import jobs

TABLES = {"topics": schemas.TOPICS, "users": schemas.USERS, "mentions": schemas.MENTIONS}


def land(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def batch_texts(first, count=20):
    ids = range(first, first + count)
    return [message(i, f"u{i % 7}", [f"t{i % 5}", "x"], [f"u{i % 3}"], text=f"#T{i % 2} hi") for i in ids] + [TOMBSTONE]


def test_history_over_restarts_equals_one_batch(spark, rows, tmp_path):
    landing, store = tmp_path / "landing", TableStore(spark, str(tmp_path / "store"), TABLES)
    progress, reports = str(tmp_path / "progress"), {}

    counter = jobs.InputRows()
    spark.streams.addListener(counter)

    def run(progress=progress):
        lines = streams.text_lines(spark, str(landing), files_per_trigger=1)
        keep = lambda report, batch_id: reports.__setitem__(batch_id, rows(report.as_rows()))
        return jobs.drain(jobs.topic_history(lines, store, progress, n=2, on_interval=keep))

    everything = []
    for k in range(2):
        land(landing, f"{k}.json", batch_texts(100 * k))
        everything += batch_texts(100 * k)
    query = run()
    assert counter.rows(query) == len(everything)
    assert sorted(reports) == [0, 1]
    # A new query takes up where the first one stopped.
    land(landing, "2.json", batch_texts(200))
    everything += batch_texts(200)
    run()
    assert sorted(reports) == [0, 1, 2]

    # A query with a checkpoint of its own adds to the history.
    land(landing, "3.json", batch_texts(300))
    reports.clear()
    run(str(tmp_path / "other"))
    everything += everything + batch_texts(300)
    spark.streams.removeListener(counter)

    m = msg.parse(spark.createDataFrame([(t,) for t in everything], "value string"))
    assert rows(store.read("topics")) == rows(msg.topics(m))
    assert rows(store.read("users")) == rows(msg.users(m))
    assert rows(store.read("mentions")) == rows(msg.mentions(m))
    assert rows(jobs.history_report(store, 3).as_rows()) == rows(topic_report.from_messages(m, 3).as_rows())
    one = msg.parse(spark.createDataFrame([(t,) for t in batch_texts(100)], "value string"))
    assert rows(topic_report.from_messages(one, 2).as_rows()) in reports.values()
    assert spark.range(1).count() == 1


def test_replayed_batch_replaces_itself(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"), TABLES)
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], schemas.TOPICS)
    second = spark.createDataFrame([(3, "c")], schemas.TOPICS)
    store.write_batch(first, "topics", "q", 0)
    store.write_batch(second, "topics", "q", 1)
    store.write_batch(first, "topics", "q", 0)
    assert rows(store.read("topics")) == [(1, "a"), (1, "a"), (2, "b"), (3, "c")]
    assert rows(store.read("topics", with_batch=True).where("batch_id = 1"), "id", "query_id") == [(3, "q")]


def many_batches(spark, n, per_batch=3):
    rows = spark.range(n * per_batch).select(F.col("id"), F.concat(F.lit("t"), F.col("id") % 7).alias("topic"))
    return rows, F.floor(F.col("id") / per_batch)


def test_compaction_bounds_the_files_of_a_thousand_batches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"), TABLES, fan=4)
    history, batch = many_batches(spark, 1000)
    before = 0
    for first in range(0, 1000, 100):
        store.load(history.where(batch.between(first, first + 99)), "topics", "q", batch)
        before = max(before, store.files("topics"))
        assert store.compact("topics")
        assert not store.compact("topics")
        # At most three runs of a level and the newest batch stay.
        assert store.files("topics") <= 3 * 3 * 4 + 4
    assert before >= 100
    assert sorted(store.read("topics").collect()) == sorted(history.collect())
    assert store.read("topics", with_batch=True).where(f"batch_id != floor(id / 3)").isEmpty()
    # Merged folders go one compaction later.
    left = [p for p in (tmp_path / "store/topics/batches/query_id=q").iterdir() if p.name.startswith("batch_id=")]
    assert len(left) <= 101


def test_a_merged_batch_is_final(spark, rows, tmp_path):
    def frame(*pairs):
        return spark.createDataFrame(pairs, schemas.TOPICS)

    store = TableStore(spark, str(tmp_path / "store"), TABLES)
    for b in range(3):
        store.write_batch(frame((b, "a"), (b, "b")), "topics", "q", b)
    store.write_batch(frame((9, "x")), "topics", "other", 0)
    assert store.compact("topics")
    want = rows(store.read("topics"))
    # Another process replays an old batch, the newest batch, and the only one of another query.
    again = TableStore(spark, str(tmp_path / "store"), TABLES)
    again.write_batch(frame((0, "a"), (0, "b")), "topics", "q", 0)
    again.write_batch(frame((2, "a"), (2, "b")), "topics", "q", 2)
    again.write_batch(frame((9, "x")), "topics", "other", 0)
    assert rows(again.read("topics")) == want == rows(store.read("topics"))
    assert len(want) == 7
    again.write_batch(frame((2, "c")), "topics", "q", 2)
    assert rows(again.read("topics").where("id = 2")) == [(2, "c")]
    again.reset("topics")
    assert again.read("topics").isEmpty()


def test_a_compaction_that_fails_changes_nothing(spark, rows, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"), TABLES)
    history, batch = many_batches(spark, 5)
    store.load(history, "topics", "q", batch)
    monkeypatch.setattr(TableStore, "_commit", lambda *_: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        store.compact("topics")
    monkeypatch.undo()
    assert rows(store.read("topics")) == rows(history)
    assert store.compact("topics")
    assert rows(store.read("topics")) == rows(history)
    # The run of the failed attempt is gone.
    assert len(list((tmp_path / "store/topics/runs").iterdir())) == 1


def test_a_lookup_reads_the_files_of_its_range(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"), TABLES)
    history, batch = many_batches(spark, 40, 500)
    store.load(history, "topics", "q", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.compact("topics")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = store.lookup("topics", 100, 140)
    assert rows(found) == rows(history.where("id BETWEEN 100 AND 140"))
    runs = [f for f in found.inputFiles() if "/runs/" in f]
    assert len(runs) == 1 < store.files("topics") - 1
    assert rows(store.lookup("topics", 19_900, 30_000)) == rows(history.where("id >= 19900"))
    assert rows(store.lookup("topics", -5, -1)) == []


def test_states_merge_on_read_and_at_compaction(spark, rows, tmp_path):
    store = jobs.history_store(spark, str(tmp_path / "store"), relations=False)
    for b, pairs in enumerate([[("x", 2), ("y", 1)], [("x", 5)], [("z", 1), ("x", 1)], [("y", 4)]]):
        store.write_batch(spark.createDataFrame(pairs, schemas.TOPIC_COUNTS), "topic_counts", "q", b)
        store.write_batch(spark.createDataFrame([("x", "u"), ("y", f"u{b}")], schemas.USER_TOPICS), "user_topics", "q", b)
        want = rows(store.read("topic_counts"))
        if b:
            store.compact("topic_counts", least=1)
            store.compact("user_topics", least=1)
        assert rows(store.read("topic_counts")) == want
    assert want == [("x", 8), ("y", 5), ("z", 1)]
    assert rows(store.read("user_topics")) == [("x", "u"), *(("y", f"u{b}") for b in range(4))]
    assert rows(store.lookup("topic_counts", "y", "z")) == [("y", 5), ("z", 1)]


def test_the_final_report_reads_states_alone(spark, tmp_path):
    store = jobs.history_store(spark, str(tmp_path / "store"))
    land(tmp_path / "landing", "0.json", batch_texts(0))
    lines = streams.text_lines(spark, str(tmp_path / "landing"))
    jobs.drain(jobs.topic_history(lines, store, str(tmp_path / "progress"), compact_every=1))
    report = jobs.history_report(store, 3)
    read = {f.split("/store/")[1].split("/")[0] for frame in report for f in frame.inputFiles()}
    assert read == {"topic_counts", "user_topics", "mention_topics"}


def test_deleted_messages_leave_the_history(spark, rows, tmp_path):
    def gone(i):
        return json.dumps({"delete": {"status": {"id": i, "id_str": str(i)}}})

    landing = tmp_path / "landing"
    store = jobs.history_store(spark, str(tmp_path / "store"))
    # Before, with and after its message; one for a message that never comes.
    batches = [[gone(25), *batch_texts(0, 20)], [gone(3), gone(22), *batch_texts(20, 20)], [gone(39), gone(999)], batch_texts(40, 5)]
    for k, texts in enumerate(batches):
        land(landing, f"{k}.json", texts)
        lines = streams.text_lines(spark, str(landing))
        jobs.drain(jobs.topic_history(lines, store, str(tmp_path / "progress"), compact_every=3))
    m = msg.parse(spark.createDataFrame([(t,) for b in batches for t in b], "value string"))
    kept = m.where("id NOT IN (3, 9, 22, 25, 39)")
    # The first two batches were merged when all notices had come.
    assert rows(store.read("topics")) == rows(msg.topics(kept))
    assert rows(store.read("topics", live=True)) == rows(msg.topics(kept))
    live = jobs.history_report(store, 3, live=True).as_rows()
    assert rows(live) == rows(topic_report.from_messages(kept, 3).as_rows())
    assert rows(jobs.history_report(store, 3).as_rows()) == rows(topic_report.from_messages(m, 3).as_rows())


def test_any_source_that_appends_keeps_the_last_attempt(spark, rows, tmp_path):
    store = AppendStore(spark, "orc", TABLES, lambda name: {"path": str(tmp_path / name)})
    store.write_batch(spark.createDataFrame([(1, "a"), (1, "b")], schemas.TOPICS), "topics", "q", 0)
    store.write_batch(spark.createDataFrame([(3, "c")], schemas.TOPICS), "topics", "q", 1)
    store.write_batch(spark.createDataFrame([(1, "a"), (1, "a")], schemas.TOPICS), "topics", "q", 0)
    assert rows(store.read("topics")) == [(1, "a"), (1, "a"), (3, "c")]
    assert rows(store.read("topics", with_batch=True).where("batch_id = 1"), "id", "query_id") == [(3, "q")]


def test_reset_and_untouched_tables_read_as_empty(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"), TABLES)
    assert store.read("users").count() == 0
    store.write_batch(spark.createDataFrame([(1, "a")], schemas.USERS), "users", "q", 0)
    store.reset("users")
    assert store.read("users").count() == 0
    store.write_batch(spark.createDataFrame([(2, "b")], schemas.USERS), "users", "q", 0)
    assert rows(store.read("users")) == [(2, "b")]
    with pytest.raises(KeyError):
        store.read("other")


def test_an_error_ends_the_query(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "0.json", batch_texts(0))
    store = TableStore(spark, str(tmp_path / "store"), TABLES)

    def fail(report, batch_id):
        raise RuntimeError("no")

    lines = streams.text_lines(spark, str(landing))
    with pytest.raises(StreamingQueryException):
        jobs.drain(jobs.topic_history(lines, store, str(tmp_path / "progress"), on_interval=fail))


def envelopes(spark, path, points):
    rows = [
        (json.dumps({"Data": [{"g": "g", "k": "k", "v": v, "t": t * 1000}]}).encode(), {"source": "s"}) for t, v in points
    ]
    spark.createDataFrame(rows, schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def test_closed_windows_only(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    envelopes(spark, path, [(0, "1"), (31, "3"), (95, "5"), (200, "7"), (96, "bad")])
    jobs.drain(jobs.metric_averages(streams.envelope_files(spark, path), out, str(tmp_path / "p"), watermark="0 seconds"))
    got = spark.read.parquet(out).select(F.unix_seconds("window_start").alias("s"), "average_value")
    assert {r.s: r.average_value for r in got.collect()} == {-60: 1.0, -30: 2.0, 0: 2.0, 30: 4.0, 60: 5.0, 90: 5.0}


def test_stream_of_averages_equals_the_batch(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    points = [(t, str(t % 13)) for t in range(0, 600, 7)]
    envelopes(spark, path, points[:40])
    # The last point is far ahead and closes all windows of the others.
    envelopes(spark, path, [*points[40:], (90_000, "0")])
    stream = streams.envelope_files(spark, path)
    jobs.drain(jobs.metric_averages(stream, out, str(tmp_path / "p"), "60 seconds", None))
    table = spark.read.schema(schemas.ENVELOPE).parquet(path)
    batch = metrics.windowed_average(metrics.with_time(metrics.metric_rows(table)), "60 seconds", None)
    closed = batch.where(F.unix_seconds("window_start") < 90_000)
    assert rows(spark.read.parquet(out).select(*closed.columns)) == rows(closed)


def test_raw_rows_are_appended_once(spark, rows, tmp_path):
    path, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p")
    for start in (0, 100):
        envelopes(spark, path, [(start, "1"), (start + 1, "x")])
        jobs.drain(jobs.raw_metrics(streams.envelope_files(spark, path, 1), out, progress))
    assert rows(files.read_metric_csv(spark, out), "t", "v") == [
        (0, "1"),
        (1000, "x"),
        (100000, "1"),
        (101000, "x"),
    ]


def test_latest_averages_are_overwritten(spark, rows, tmp_path):
    path, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p")
    seen = []
    # The second batch changes the newest window, the third opens another, the last comes late.
    for t, value in ((80, "1"), (81, "5"), (200, "7"), (10, "9")):
        envelopes(spark, path, [(t, value)])
        jobs.drain(jobs.latest_averages(streams.envelope_files(spark, path), out, progress))
        seen += rows(snapshots.newest(spark, out, schemas.AVERAGES), "k", "average_value", "n")
    assert seen == [("k", 1.0, 1), ("k", 3.0, 2), ("k", 7.0, 1), ("k", 7.0, 1)]


def drop_in(folder, name, texts, second):
    """Land a file that came in at a second of 1970."""
    land(folder, name, texts)
    os.utime(folder / name, (second, second))


def test_polled_tags_forget_what_is_idle(spark, rows, tmp_path):
    landing, progress = tmp_path / "in", str(tmp_path / "p")
    store = jobs.tag_store(spark, str(tmp_path / "store"))

    def run(k, text, second):
        drop_in(landing, f"{k}.txt", [text], second)
        lines = streams.text_lines(spark, str(landing), arrival=True)
        idle = timedelta(seconds=100)
        return jobs.drain(jobs.tag_totals(lines, store, progress, idle, watermark="0 seconds", compact_every=2))

    assert rows(jobs.polled_top_tags(store)) == []
    run(0, "#a #b #b #old", 1_000)
    run(1, "#A #a #c none", 1_050)
    assert rows(jobs.polled_top_tags(store, 2)) == [("#a", 3), ("#b", 2)]
    # The watermark passes 1,100, when #b and #old have been idle for 100 seconds, but not #a and #c.
    query = run(2, "#c", 1_120)
    assert rows(jobs.polled_top_tags(store)) == [("#a", 3), ("#c", 2)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    # A tag that comes back starts from nothing.
    query = run(3, "#b", 1_121)
    assert rows(jobs.polled_top_tags(store)) == [("#a", 3), ("#b", 1), ("#c", 2)]
    query = run(4, "#end", 9_000)
    query = run(5, "#end", 9_001)
    assert rows(jobs.polled_top_tags(store)) == [("#end", 2)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    for k in range(6, 8):
        run(k, "#end", 9_000 + k)
    # Tags that left are gone from the stored table too.
    runs = spark.read.parquet(str(tmp_path / "store/tags/runs/*"))
    assert len(store._manifest("tags").runs) == 1 and runs.where("tag = '#old'").where("count IS NOT NULL").count() <= 1
    merged = store._runs("tags", list(store._manifest("tags").runs))
    assert [r.tag for r in merged.collect()] == ["#end"]


def test_windows_of_arrival_are_the_same_after_a_replay(spark, rows, tmp_path):
    landing = tmp_path / "in"
    for k, second in enumerate([1_000, 1_009, 1_013, 1_031]):
        drop_in(landing, f"{k}.txt", [f"#t{k % 2} #x"], second)
    want = {}
    for k, second in enumerate([1_000, 1_009, 1_013, 1_031]):
        for tag in (f"#t{k % 2}", "#x"):
            for first in (second // 10 * 10, second // 10 * 10 - 10):
                want[first, tag] = want.get((first, tag), 0) + 1
    for name in ("first", "again"):
        out = str(tmp_path / name)
        lines = streams.text_lines(spark, str(landing), 1, arrival=True)
        jobs.drain(jobs.tags_by_arrival(lines, out, str(tmp_path / f"{name}_p")))
        found = jobs.latest(spark, out, ["window_start", "tag"], schemas.WINDOW_TAGS)
        assert rows(found.select(F.unix_seconds("window_start"), "tag", "count")) == rows_of(want)


def rows_of(counts):
    return sorted(((*key, n) for key, n in counts.items()), key=repr)


def test_intake_counts_what_each_batch_held(spark, rows, tmp_path):
    landing = tmp_path / "in"
    tables = {"slim": schemas.SLIM, "intake": schemas.INTAKE}
    store = TableStore(spark, str(tmp_path / "store"), tables)
    batches = [
        [message(1), message(2, created="soon"), TOMBSTONE, "{broken", ""],
        ["nothing", "[1, 2]"],
        [TOMBSTONE],
        [message(3)] * 4,
    ]
    for k, texts in enumerate(batches):
        land(landing, f"{k}.json", texts)
        jobs.drain(jobs.message_intake(streams.text_lines(spark, str(landing)), store, str(tmp_path / "p")))
    held = store.read("intake", with_batch=True)
    want = [(0, 5, 2, 1, 2, 1), (1, 2, 0, 0, 2, 0), (2, 1, 0, 1, 0, 0), (3, 4, 4, 0, 0, 0)]
    assert rows(held, "batch_id", *schemas.INTAKE.fieldNames()) == want
    assert store.read("slim").count() == 6
    # The same measures of a table, in the pass that writes it.
    m = msg.with_time(msg.parse(spark.createDataFrame([(t,) for t in batches[0]], "value string")))
    counts = Observation()
    m.observe(counts, *jobs.intake_measures()).write.format("noop").mode("overwrite").save()
    assert tuple(counts.get.values()) == (5, 2, 1, 2, 1)


def test_authors_and_topics_that_come_apart_are_joined(spark, rows, tmp_path):
    users, topics = str(tmp_path / "users"), str(tmp_path / "topics")

    def at(minute):
        return f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"

    def add(path, name, entries):
        df = spark.createDataFrame([(i, v, at(m)) for i, v, m in entries], f"id bigint, {name} string, t string")
        df.select("id", name, F.to_timestamp("t").alias("ts")).coalesce(1).write.mode("append").parquet(path)

    def run():
        sides = [
            spark.readStream.schema(f"id bigint, {name} string, ts timestamp").parquet(path)
            for path, name in ((users, "user"), (topics, "topic"))
        ]
        jobs.drain(jobs.topic_users(*sides, str(tmp_path / "out"), str(tmp_path / "p"), watermark="30 minutes"))

    add(users, "user", [(1, "u1", 0), (2, "u2", 5), (3, "u3", 6)])
    add(topics, "topic", [(1, "x", 0), (1, "y", 10), (1, "far", 11)])
    run()
    # The topic of 2 comes a batch later, in time; the author of 4 after its topic.
    add(topics, "topic", [(2, "x", 5), (4, "z", 20)])
    add(users, "user", [(5, "u5", 20)])
    run()
    add(users, "user", [(4, "u4", 21), (9, "u9", 300)])
    add(topics, "topic", [(9, "late", 300)])
    run()
    # Both sides are at minute 300, so what is of minute 6 is late.
    add(topics, "topic", [(3, "x", 6), (9, "on", 301)])
    run()
    add(users, "user", [(10, "end", 302)])
    run()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "user", "topic")
    assert got == [("u1", "x"), ("u1", "y"), ("u2", "x"), ("u4", "z"), ("u9", "late"), ("u9", "on")]


def test_sliding_tags_stream_equals_batch(spark, rows, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    texts = [message(i, text=f"#t{i % 2}", created=f"2024-01-01 00:00:{i:02d}") for i in range(0, 50, 4)]
    land(landing, "0.json", texts)
    land(landing, "1.json", [message(99, text="none #end", created="2024-01-02 00:00:00")])
    jobs.drain(jobs.tags_sliding(streams.text_lines(spark, str(landing)), out, str(tmp_path / "p")))
    m = msg.parse(spark.createDataFrame([(t,) for t in texts], "value string"))
    batch = words.tags_sliding(msg.with_time(msg.live(m)), "text")
    assert rows(spark.read.parquet(out).select(*batch.columns)) == rows(batch)


def test_repeated_deliveries_are_dropped(spark, rows, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for k in range(2):
        land(landing, f"{k}.json", [message(1), message(2), TOMBSTONE])
    unique = jobs.unique_messages(streams.text_lines(spark, str(landing), 1)).select("id")
    jobs.drain(jobs.file_sink(unique, out, str(tmp_path / "p")))
    assert rows(spark.read.schema("id bigint").json(out)) == [(1,), (2,)]


def test_slim_messages_and_typed_files(spark, rows, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    land(landing, "0.json", [message(1, "ann", text=" hi\t\r\n"), TOMBSTONE])
    jobs.drain(jobs.slim_messages(streams.text_lines(spark, str(landing)), out, str(tmp_path / "p1")))
    assert rows(spark.read.parquet(out)) == [(1, "ann", "hi")]
    typed = msg.topics(streams.message_files(spark, str(landing)))
    assert typed.isStreaming
    jobs.drain(jobs.file_sink(msg.id_and_time(streams.message_files(spark, str(landing))), out + "t", str(tmp_path / "p2")))
    assert rows(spark.read.schema("id bigint").json(out + "t")) == [(1,)]


def test_word_counts_grow(spark, rows, tmp_path):
    landing = tmp_path / "in"
    land(landing, "0.txt", ["a b a"])
    land(landing, "1.txt", ["b a"])
    jobs.drain(jobs.word_counts(streams.text_lines(spark, str(landing), 1), str(tmp_path / "wc"), str(tmp_path / "p")))
    assert rows(jobs.latest(spark, str(tmp_path / "wc"), ["word"], schemas.WORD_COUNTS)) == [("a", 3), ("b", 2)]


def test_updates_merge_and_read_as_empty_before_the_first(spark, rows, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    assert rows(jobs.latest(spark, out, ["word"], schemas.WORD_COUNTS)) == []
    for k in range(5):
        land(landing, f"{k}.txt", [f"a a{k}"])
    counts = words.word_count(streams.text_lines(spark, str(landing), 1))
    jobs.drain(jobs.updates(counts, out, str(tmp_path / "p"), ["word"], compact_every=2))
    assert rows(jobs.latest(spark, out, ["word"], schemas.WORD_COUNTS)) == [("a", 5), *((f"a{k}", 1) for k in range(5))]
    # The run of the first three batches holds each word once.
    merged = spark.read.parquet(f"{out}/updates/runs/*")
    assert sorted(r.total for r in merged.collect()) == [1, 1, 1, 3]
    assert rows(merged.where("total = 3"), "word") == [("a",)]


def test_bounded_run_stops_and_keeps_the_session(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "0.txt", ["a b a"])
    query = jobs.console(streams.text_lines(spark, str(landing)), str(tmp_path / "p"), interval="1 second")
    jobs.run_for(query, 3)
    assert not query.isActive
    assert spark.range(3).count() == 3


def test_small_results_as_pandas(spark):
    assert len(jobs.to_pandas(spark.range(100), 7)) == 7


def test_kafka_options():
    options = streams.kafka_options("host:1", "t", group="g")
    assert options["subscribe"] == "t"
    assert options["minPartitions"] == "4"
    assert options["kafka.group.id"] == "g"


def test_windows_of_a_stream_equal_the_batch(spark, rows, tmp_path):
    landing = tmp_path / "in"
    hour = lambda h: f"2024-01-01 {h:02d}:30:00"
    texts = [
        message(i, f"u{i % 5}", [f"t{i % 3}", "x"], text=f"#t{i % 3} @u{i % 4} #x", created=hour(i // 8))
        for i in range(60)
    ]
    land(landing, "0.json", texts)
    land(landing, "1.json", [message(99, "end", ["z"], text="#z", created="2024-01-03 00:00:00")])
    stream = lambda: streams.text_lines(spark, str(landing))
    jobs.drain(jobs.topic_windows(stream(), str(tmp_path / "w"), str(tmp_path / "p1"), "1 hour"))
    jobs.drain(jobs.commentators(stream(), str(tmp_path / "c"), str(tmp_path / "p2"), "1 hour"))
    m = msg.parse(spark.createDataFrame([(t,) for t in texts], "value string"))
    by_stream = tp.rank_windows(spark.read.parquet(str(tmp_path / "w")), 2)
    assert rows(by_stream) == rows(tp.top_topics_per_window(m, 2, "1 hour"))
    assert by_stream.count() == 16
    people = tp.top_commentators(spark.read.parquet(str(tmp_path / "c")), 1)
    assert rows(people) == rows(tp.topic_commentators(m, 1, "1 hour"))


def test_stream_of_sums(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    envelopes(spark, path, [(0, "1"), (59, "2"), (60, "4"), (61, "bad"), (9_000, "0")])
    jobs.drain(jobs.metric_sums(streams.envelope_files(spark, path), out, str(tmp_path / "p")))
    got = spark.read.parquet(out).select(F.unix_seconds("window_start"), "total_value")
    assert rows(got) == [(0, 3.0), (60, 4.0)]
