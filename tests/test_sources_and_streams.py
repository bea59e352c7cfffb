"""Tables in and out, landed responses, and streams against their batch forms."""

from __future__ import annotations

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratinglens.contracts import ContractError, fields_of, project
from ratinglens.labels import ZH
from ratinglens.operators import crawl_log, snapshot
from ratinglens.session import durable_path
from ratinglens.sources import landed, payloads, tables, versions
from ratinglens.streaming import jobs
from tests.test_operators import EVENTS, random_events


def test_csv_with_byte_order_mark_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "tags.csv"
    path.write_text("﻿豆瓣ID,标签,标签内排名,采集时间\n007,热门,1,NA\n8,\"a,\"\"b\"\"\",2,null\n", encoding="utf-8")
    got = tables.missing_as_null(tables.read_csv(spark, str(path), "tag_links")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [("007", "热门", "1", None), ("8", 'a,"b"', "2", None)]


def test_old_layout_and_absent_files(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_text("电影名称,标签\nA,b\n", encoding="utf-8")
    with pytest.raises(ContractError, match="豆瓣ID"):
        tables.read_csv(spark, str(path), "tag_links")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "none.csv"), "tag_links")
    empty = tables.read_optional(spark, str(tmp_path / "none"), "tag_links")
    assert empty.columns == fields_of("tag_links") and empty.count() == 0


def test_files_with_another_column_order_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("豆瓣ID,标签,标签内排名,采集时间\n1,sea,1,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("豆瓣ID,标签,标签内排名,采集时间\n2,sky,2,x\n", encoding="utf-8")
    assert tables.read_csv(spark, str(tmp_path), "tag_links").count() == 2
    (tmp_path / "c.csv").write_text("标签,豆瓣ID,标签内排名,采集时间\nsky,3,3,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(tmp_path), "tag_links").select("entity_id", "tag").collect()


def test_append_checks_types(spark, tmp_path):
    path, names = str(tmp_path / "links"), fields_of("tag_links")
    kinds = "entity_id string, tag string, rank {}, captured_at string"
    tables.append_table(spark.createDataFrame([("1", "t", "1", "x")], kinds.format("string")), path, names)
    with pytest.raises(ContractError, match="rank int in place of string"):
        tables.append_table(spark.createDataFrame([("1", "t", 1, "x")], kinds.format("int")), path, names)


def test_append_checks_columns_and_order(spark, tmp_path):
    path, names = str(tmp_path / "links"), fields_of("tag_links")
    rows = spark.createDataFrame([("1", "t", "1", "x", "extra")], "entity_id string, tag string, rank string, captured_at string, more string")
    tables.append_table(rows, path, names)
    tables.append_table(rows, path, names)
    assert tables.read_parquet(spark, path, "tag_links").count() == 2
    with pytest.raises(ContractError):
        tables.append_table(rows, path, names[::-1])
    tables.overwrite_table(rows, path, names)
    assert tables.read_parquet(spark, path, "tag_links").count() == 1
    with pytest.raises(ContractError, match="absent"):
        project(rows, ["absent"])


def responses(spark):
    whole = {
        "title": "Slow Tide", "original_title": "Marée lente", "year": 1987, "release_date": "1987-11-4",
        "genres": ["drama", "sea"], "countries": ["Portugal"], "durations": ["88 min", "91 min"],
        "directors": [{"name": "R. Faro"}], "actors": [{"name": f"Hand {i}"} for i in range(23)],
        "rating": {"value": 6.9, "count": 71}, "comment_count": 5, "review_count": 0,
    }
    sparse = {"title": "Kite", "pubdate": ["2003-7(Lisbon)", "2004"], "rating": None}
    bodies = {"w": (200, json.dumps(whole)), "s": (200, json.dumps(sparse)), "list": (200, "[1]"), "gone": (410, "{}"), "lost": (None, None)}
    rows = [(name, status, body, "2024-05-20T06:30:00Z") for name, (status, body) in bodies.items()]
    return spark.createDataFrame(rows, "entity_id string, status int, body string, captured_at string")


def test_detail_responses(spark):
    rows = {r.entity_id: r for r in payloads.detail_rows(responses(spark)).collect()}
    assert set(rows) == {"w", "s"} and list(rows["w"].asDict()) == fields_of("details")
    whole, sparse = rows["w"], rows["s"]
    assert (whole.release_date, whole.short_count, whole.long_count, whole.score, whole.votes) == ("1987-11-04", "5", "0", "6.9", "71")
    assert whole.categories == "drama / sea" and whole.runtime == "88 min / 91 min" and len(whole.actors.split(" / ")) == 15
    assert (sparse.release_date, sparse.score, sparse.actors) == ("2003-07", "", "")
    bad = {r.entity_id: r.reason for r in payloads.failed_responses(responses(spark)).collect()}
    assert bad == {"list": ZH.parse_failure, "gone": "HTTP 410", "lost": ZH.network_failure}


def test_comment_pages_never_carry_the_author(spark):
    items = [
        {"id": "", "rating": {"value": 1}},
        {"id": "n7", "user": {"name": "somebody"}, "rating": {"value": 2}, "comment": "wet", "vote_count": 40, "create_time": "noon"},
        {"id": "n8", "rating": {}},
        {"id": "n9", "rating": {"value": 4}},
    ]
    body = json.dumps({"interests": items, "total": 64})
    pages = spark.createDataFrame(
        [("w", "Slow Tide", "new", 60, 20, 200, body, "c")],
        "entity_id string, title string, sample_label string, page_start int, asked int, status int, body string, captured_at string",
    )
    rows = payloads.comment_rows(pages, {"new": 63}).orderBy("position").collect()
    assert [(r.comment_id, r.star, r.useful, r.position) for r in rows] == [("n7", "2星", "40", "62"), ("n8", "未评分", "0", "63")]
    assert "somebody" not in str(rows) and list(rows[0].asDict()) == fields_of("comments")
    facts = payloads.page_facts(pages).collect()[0]
    assert (facts.got, facts.total, facts.failed) == (4, 64, False)


def test_search_hits_without_id_use_up_their_rank(spark):
    subjects = [{"title": "A", "url": "https://x/subject/1/", "rate": "8"}, {"title": "B", "url": "bad"}, {"title": "C", "url": "https://x/subject/3/"}]
    pages = spark.createDataFrame(
        [("t", 1, 20, 200, json.dumps({"subjects": subjects}), "c")],
        "tag string, tag_order int, page_start int, status int, body string, captured_at string",
    )
    assert {r.entity_id: r["rank"] for r in payloads.search_hits(pages).collect()} == {"1": 21, "3": 23}


def file_stream(spark, df, files):
    """A stream that delivers the rows in several batches, in order."""
    path = durable_path(spark, "source")
    for i in range(files):
        df.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)
    schema = df.drop("part").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streamed_failure_state_equals_batch(spark):
    """Rounds that are spread over batches, all of them open."""
    rows = random_events(11, entities=25)
    df = spark.createDataFrame(rows, EVENTS)
    source = file_stream(spark, df.withColumn("part", (F.col("seq") % 100 / 5).cast("int")), 3)
    path, checkpoint = durable_path(spark, "facts"), durable_path(spark, "facts-cp")
    jobs.fold_failures(source, path, checkpoint, open_rounds=50, buckets=4).awaitTermination()
    assert versions.version(spark, path).applied["fold_failures"] > 0
    batch = crawl_log.failure_state(crawl_log.round_facts(df))
    assert sorted(jobs.stored_failure_state(spark, path).collect()) == sorted(batch.collect())
    # a second start finds nothing new and changes nothing
    jobs.fold_failures(source, path, checkpoint, open_rounds=50, buckets=4).awaitTermination()
    assert sorted(jobs.stored_failure_state(spark, path).collect()) == sorted(batch.collect())


def test_failure_store_stays_level_over_many_rounds(spark):
    """Twenty batches of one round each: closed rounds are folded, the state is that of all events at any time."""
    kind = "entity_id string, title string, round int, seq int, ok boolean, reason string, at string"
    rng, path, events, sizes = random.Random(5), durable_path(spark, "facts"), [], []
    for batch_id in range(20):
        new = []
        for entity in range(12):
            for k in range(rng.randrange(3)):
                ok = entity == 11 or rng.random() < 0.3  # one entity never fails
                reason = None if ok else rng.choice(["HTTP 400", "HTTP 404", "HTTP 500"])
                # now and then an event of the round before, which is still open
                late = batch_id - (rng.random() < 0.2 and batch_id > 0)
                new.append((f"e{entity}", f"T{entity}", late + 1, (late + 1) * 1000 + batch_id * 10 + k, ok, reason, f"{batch_id:02d}-{k}"))
        events += new
        facts = crawl_log.round_facts(spark.createDataFrame(new, kind))
        for _ in range(1 + (batch_id == 7)):  # one batch is replayed
            jobs.fold_batch(facts, path, batch_id, open_rounds=2, buckets=2)
        stored = versions.read(spark, path)
        sizes.append(stored.agg(F.count("*"), F.sum(F.size("open"))).first())
        if batch_id in (0, 5, 12, 19):
            want = crawl_log.failure_state(crawl_log.round_facts(spark.createDataFrame(events, kind)))
            assert sorted(jobs.stored_failure_state(spark, path).collect()) == sorted(want.collect())
    assert max(n for n, _ in sizes) <= 12 and max(n for _, n in sizes) <= 2 * 12
    # an event of a closed round is told apart and changes nothing
    before = sorted(jobs.stored_failure_state(spark, path).collect())
    old = spark.createDataFrame([("e1", "T", 1, 1, False, "HTTP 400", "x"), ("e1", "T", 20, 20999, True, None, "y")], kind)
    jobs.fold_batch(crawl_log.round_facts(old), path, 20, open_rounds=2)
    after = sorted(jobs.stored_failure_state(spark, path).collect())
    assert [r for r in after if r.entity_id != "e1"] == [r for r in before if r.entity_id != "e1"]
    assert [r.failed_rounds for r in after] == [r.failed_rounds for r in before]
    assert [r["round"] for r in spark.read.parquet(f"{path}-late").collect()] == [1]


def test_entities_that_never_fail_are_forgotten(spark):
    kind = "entity_id string, title string, round int, seq int, ok boolean, reason string, at string"
    path = durable_path(spark, "facts")
    for batch_id in range(4):
        rows = [(f"good{batch_id}", "T", batch_id + 1, batch_id, True, None, "x"), ("bad", "T", batch_id + 1, batch_id, False, "HTTP 404", "x")]
        jobs.fold_batch(crawl_log.round_facts(spark.createDataFrame(rows, kind)), path, batch_id, open_rounds=1, buckets=1)
    assert {r.entity_id for r in versions.read(spark, path).collect()} == {"good3", "bad"}
    state = jobs.stored_failure_state(spark, path).collect()
    assert [(r.entity_id, r.failed_rounds, r.permanent_streak, r.status) for r in state] == [("bad", 4, 4, ZH.unavailable)]


def test_streamed_links_and_attempts_have_no_repeats(spark):
    rows = [(str(i % 7), "t", i % 3, i % 5, f"a{i:03d}", i // 40) for i in range(120)]
    df = spark.createDataFrame(rows, "entity_id string, tag string, round int, attempt int, failed_at string, part int")
    source = file_stream(spark, df, 3)
    path = durable_path(spark, "links")
    jobs.write_stream(jobs.first_seen(source, ["entity_id", "tag"]), path, durable_path(spark, "cp")).awaitTermination()
    assert spark.read.parquet(path).count() == 7
    log = durable_path(spark, "attempts")
    jobs.log_attempts(source, log, durable_path(spark, "cp")).awaitTermination()
    got = jobs.read_attempts(spark.read.parquet(log))
    want = snapshot.keep_last(df.drop("part"), ["entity_id", "round", "attempt"], ["failed_at"])
    assert sorted(got.collect()) == sorted(want.collect())


def test_first_rows_keep_rank_and_win_over_later_batches(spark):
    rows = [("1", "a", 5, 0), ("1", "a", 3, 0), ("2", "a", 1, 0), ("1", "a", 1, 1), ("1", "b", 9, 1), ("", "a", 1, 1), (None, "a", 1, 2), ("2", "b", 4, 2)]
    df = spark.createDataFrame(rows, "entity_id string, tag string, rank int, part int")
    links, entities, cp = durable_path(spark, "links"), durable_path(spark, "entities"), durable_path(spark, "cp")
    source = file_stream(spark, df, 3)
    jobs.first_rows(source, ["entity_id", "tag"], ["rank"], links, cp, buckets=4).awaitTermination()
    jobs.first_rows(source, ["entity_id"], ["rank", "tag"], entities, durable_path(spark, "cp"), buckets=4).awaitTermination()
    got = sorted(tuple(r) for r in versions.read(spark, links).collect())
    assert got == [("1", "a", 3), ("1", "b", 9), ("2", "a", 1), ("2", "b", 4)]
    assert sorted(tuple(r) for r in versions.read(spark, entities).collect()) == [("1", "a", 3), ("2", "a", 1)]


def test_progress_follows_tables_that_change(spark):
    """After every batch the stored counts are those of a recount of the tables as they are then."""
    changes = [
        # (entity, kind, n, batch)
        ("1", "candidate", 1, 0), ("2", "candidate", 1, 0), ("2", "candidate", 1, 0), ("", "candidate", 1, 0), ("1", "detail", 1, 0),
        ("3", "candidate", 1, 1), ("3", "lost", 1, 1), ("2", "detail", 1, 1), ("2", "detail", 1, 1), ("c", "comment", 7, 1),
        ("4", "candidate", 1, 2), ("2", "comment", -2, 2), ("9", "detail", 1, 2),
        ("3", "lost", -1, 3), ("3", "detail", 1, 3), ("2", "candidate", -1, 3),
        ("9", "lost", 1, 4), (None, "candidate", 1, 4), ("1", "detail", -1, 4),
    ]
    kind = "entity_id string, kind string, n int, part int"
    path, progress, checkpoint = (durable_path(spark, n) for n in ("entities", "progress", "cp"))
    source = file_stream(spark, spark.createDataFrame(changes, kind), 5)
    jobs.track_progress(source, path, progress, checkpoint, buckets=4).awaitTermination()
    found = {r.batch_id: r for r in spark.read.parquet(progress).collect()}
    assert sorted(found) == list(range(5))

    def table_of(name, upto):
        sums = {}
        for entity, what, n, part in changes:
            if what == name and part <= upto:
                sums[entity] = sums.get(entity, 0) + n
        return spark.createDataFrame([(e, ZH.unavailable) for e, n in sums.items() for _ in range(n)], "entity_id string, status string")

    for upto, row in found.items():
        tables_now = [table_of(name, upto) for name in ("candidate", "detail", "lost")]
        recount = crawl_log.pipeline_status(*tables_now, spark.range(sum(n for _, k, n, p in changes if k == "comment" and p <= upto)))
        want = recount.collect()[0].asDict()
        assert {k: row[k] for k in want} == want
    assert [found[i].made_progress for i in range(5)] == [True, True, True, False, False]
    assert jobs.read_progress(spark.read.parquet(progress)).collect()[0].target == found[4].target
    # a replayed batch finds its counts published and changes nothing
    jobs.apply_changes(spark.createDataFrame([c[:3] for c in changes if c[3] == 4], "entity_id string, kind string, n int"), path, progress, 4)
    assert versions.version(spark, path).notes["status"]["target"] == found[4].target


def test_sample_quota_holds_over_batches(spark):
    limits = {"A": 3, "B": 2}
    rows = [
        # (entity, label, comment, position, failed, exhausted, batch)
        *[("1", "A", f"c{i}", i, False, False, i // 2) for i in range(6)],
        ("1", "A", "c0", 0, False, False, 2),
        *[("1", "B", f"c{i}", i, False, False, 1) for i in range(1)],
        ("1", "B", None, None, False, True, 2),
        ("2", "B", None, None, True, False, 0),
        ("3", "C", "x", 1, False, False, 0),
    ]
    schema = "entity_id string, sample_label string, comment_id string, position int, failed boolean, exhausted boolean, part int"
    path, progress, checkpoint = (durable_path(spark, n) for n in ("sample", "sample-progress", "cp"))
    source = file_stream(spark, spark.createDataFrame(rows, schema), 3)
    jobs.collect_sample(source, limits, path, progress, checkpoint).awaitTermination()
    stored = spark.read.parquet(path)
    kept = sorted((r.entity_id, r.sample_label, r.comment_id) for r in stored.collect())
    assert kept == [("1", "A", "c0"), ("1", "A", "c1"), ("1", "A", "c2"), ("1", "B", "c0")]
    states = {(r.entity_id, r.sample_label): (r.target, r.held, r.status) for r in jobs.read_sample_progress(spark.read.parquet(progress)).collect()}
    assert states == {("1", "A"): (3, 3, ZH.done), ("1", "B"): (2, 1, ZH.exhausted), ("2", "B"): (2, 0, ZH.failed)}
    jobs.collect_sample(source, limits, path, progress, checkpoint).awaitTermination()
    assert spark.read.parquet(path).count() == 4


def test_sample_state_over_many_batches_and_a_restart(spark):
    """Batch by batch the comments that fill the quota in order of arrival, then of position."""
    limits, rng, rows = {"A": 4, "B": 2}, random.Random(8), []
    for part in range(6):
        for _ in range(30):
            label, entity = rng.choice("AAB"), str(rng.randrange(4))
            comment = None if rng.random() < 0.1 else f"c{rng.randrange(12)}"
            position = None if comment is None or rng.random() < 0.1 else rng.randrange(40)
            rows.append((entity, label, comment, position, rng.random() < 0.05, rng.random() < 0.1, part))
        rows += [("hot", "A", f"h{i % 50}", i, False, False, part) for i in range(300)]
    schema = "entity_id string, sample_label string, comment_id string, position int, failed boolean, exhausted boolean, part int"
    df = spark.createDataFrame(rows, schema)
    held, want, states = {}, set(), {}
    for part in range(6):
        for key in {r[:2] for r in rows if r[6] == part}:
            own = [r for r in rows if r[6] == part and r[:2] == key]
            ids = held.setdefault(key, [])
            for r in sorted((r for r in own if r[2]), key=lambda r: (r[3] is None, r[3] or 0, r[2])):
                if r[2] not in ids and len(ids) < limits[key[1]]:
                    ids.append(r[2])
                    want.add((*key, r[2], r[3], part))
            failed, ended = any(r[4] for r in own), any(r[5] for r in own)
            full = len(ids) >= limits[key[1]]
            states[key] = (len(ids), ZH.failed if failed else ZH.exhausted if ended and not full else ZH.done)
    path, progress, checkpoint, folder = (durable_path(spark, n) for n in ("sample", "sample-progress", "cp", "source"))

    def run(parts):
        for i in parts:
            df.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.collect_sample(source, limits, path, progress, checkpoint).awaitTermination()

    run(range(3))
    run(range(3, 6))  # a new start goes on from the checkpoint
    stored = spark.read.parquet(path)
    assert {(r.entity_id, r.sample_label, r.comment_id, r.position, r.batch_id) for r in stored.collect()} == want
    got = {(r.entity_id, r.sample_label): (r.held, r.status) for r in jobs.read_sample_progress(spark.read.parquet(progress)).collect()}
    assert got == states


def test_samples_need_no_call_per_sample_and_survive_a_replay(spark):
    schema = "entity_id string, sample_label string, comment_id string, position int, failed boolean, exhausted boolean, target bigint"
    path, progress, checkpoint = (durable_path(spark, n) for n in ("sample", "sample-progress", "cp"))
    rows = [("1", "A", f"c{i}", i, False, False, 3) for i in (1, 0)] + [(None, "A", "n", None, None, False, 3)]
    source = file_stream(spark, spark.createDataFrame([(*r[:6], 0) for r in rows], schema.replace("target bigint", "part int")), 1)
    jobs.collect_sample(source, {"A": 3}, path, progress, checkpoint, buckets=2).awaitTermination()
    assert not versions.Folder(spark, checkpoint).names("state")

    def stored():
        return {(r.entity_id, r.comment_id, r.batch_id) for r in spark.read.parquet(path).collect()}

    first = {("1", "c0", 0), ("1", "c1", 0), (None, "n", 0)}
    assert stored() == first
    batch = spark.createDataFrame([("1", "A", f"c{i}", i, False, True, 3) for i in (0, 2, 3)] + [(None, "A", "n", 1, False, True, 3)], schema)
    for _ in range(2):  # the second time it is in the table already
        jobs.sample_batch(batch, path, progress, 1)
        assert stored() == first | {("1", "c2", 1)}
        found = {(r.entity_id, r.held, r.status) for r in jobs.read_sample_progress(spark.read.parquet(progress)).collect()}
        assert found == {("1", 3, ZH.done), (None, 1, ZH.exhausted)}
    held = {r.entity_id: sorted(r.ids) for r in versions.read(spark, f"{path}-held").collect()}
    assert held == {"1": [], None: ["n"]}


def test_a_task_passes_on_few_rows_of_a_hot_sample():
    rows = [("hot", "A", f"h{i}", 1000 - i, i == 500, i == 700) for i in range(1000)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("entity_id", "sample_label", "comment_id", "position", "failed", "exhausted"), r, strict=True)) for r in rows])
    out = pa.Table.from_batches(jobs._enough(8)([batch])).to_pylist()
    assert len(out) == 11 and {r["position"] for r in out} >= set(range(1, 9))
    assert any(r["failed"] for r in out) and any(r["exhausted"] for r in out)


def test_slices_and_bursts_are_complete_over_batches(spark):
    minutes = [0, 10, 200, 700, 705, 1500, 1600, 3000, 3100, 3101]
    rows = [(str(i % 2), m, m % 3 != 0, i % 3) for i, m in enumerate(minutes * 2)]
    df = spark.createDataFrame(rows, "entity_id string, m int, ok boolean, part int").withColumn(
        "ts", F.timestamp_seconds(F.col("m") * 60 + 1_700_000_000)
    )
    source = file_stream(spark, df, 3)
    rates, bursts = durable_path(spark, "rates"), durable_path(spark, "bursts")
    jobs.track_outcomes(source, rates, durable_path(spark, "cp")).awaitTermination()
    jobs.track_bursts(source, bursts, durable_path(spark, "cp"), "2 hours").awaitTermination()
    assert spark.read.parquet(bursts).select("batch_id").distinct().count() == 3
    assert sorted(jobs.read_outcomes(spark.read.parquet(rates)).collect()) == sorted(jobs.outcome_rates(df).collect())
    assert sorted(jobs.read_bursts(spark.read.parquet(bursts)).collect()) == sorted(jobs.failure_bursts(df, "2 hours").collect())


# landed responses


def landing_folder(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    lines = [r.value for r in landed.lines_of(responses(spark)).collect()]
    (folder / "a.json").write_text("\n".join(lines[:2]) + "\n" + lines[0][:25] + "\n", encoding="utf-8")
    (folder / "b.json").write_text("\n".join(lines[2:]) + '\n{"entity_id": "odd", "status": "many"}\nnot json\n', encoding="utf-8")
    return str(folder)


def parses(df):
    return df._jdf.queryExecution().executedPlan().toString().count("parseJson")


def test_landed_lines_are_parsed_once(spark, tmp_path):
    found = landed.read_landed(spark, landing_folder(spark, tmp_path), "details")
    rows = payloads.detail_rows(found)
    assert parses(rows) == 1 and parses(payloads.failed_responses(found)) == 1
    assert sorted(rows.collect()) == sorted(payloads.detail_rows(responses(spark)).collect())
    bad = sorted(((r.entity_id, r.reason) for r in payloads.failed_responses(found).collect()), key=str)
    assert bad == [
        ("gone", "HTTP 410"), ("list", ZH.parse_failure), ("lost", ZH.network_failure), ("odd", ZH.parse_failure),
        ("w", ZH.parse_failure), (None, ZH.parse_failure),
    ]
    assert {r.landed_in.rsplit("/")[-1] for r in found.select("landed_in").collect()} == {"a.json", "b.json"}


def test_landed_responses_are_stored_parsed(spark, tmp_path):
    folder, path = landing_folder(spark, tmp_path), durable_path(spark, "landed")
    landed.store(landed.read_landed(spark, folder, "details"), path)
    stored = versions.read(spark, path)
    assert dict(stored.dtypes)["payload"] == "variant" and parses(payloads.detail_rows(stored)) == 0
    assert sorted(payloads.detail_rows(stored).collect()) == sorted(payloads.detail_rows(responses(spark)).collect())
    # Parquet files have the same columns and no malformed lines
    responses(spark).write.parquet(str(tmp_path / "parquet"))
    found = landed.read_landed(spark, str(tmp_path / "parquet"), "details", form="parquet")
    assert found.schema == landed.read_landed(spark, folder, "details").schema
    assert sorted(payloads.detail_rows(found).collect()) == sorted(payloads.detail_rows(stored).collect())
    with pytest.raises(ValueError):
        landed.read_landed(spark, folder, "details", form="csv")


def test_landed_responses_as_a_stream(spark, tmp_path):
    folder, path, checkpoint = landing_folder(spark, tmp_path), durable_path(spark, "landed"), durable_path(spark, "cp")

    def run():
        lines = landed.read_landed(spark, folder, "details", stream=True, files_per_batch=1)
        landed.store_stream(lines, path, checkpoint).awaitTermination()

    run()
    assert versions.version(spark, path).applied == {"landed": 1}
    assert sorted(payloads.detail_rows(versions.read(spark, path)).collect()) == sorted(payloads.detail_rows(responses(spark)).collect())
    run()  # nothing new has landed
    assert versions.read(spark, path).count() == 8
    line = landed.lines_of(responses(spark).where("entity_id = 'w'").withColumn("entity_id", F.lit("late"))).collect()[0].value
    (tmp_path / "landing" / "c.json").write_text(line + "\n", encoding="utf-8")
    run()
    assert versions.read(spark, path).count() == 9
    # a batch that is replayed after it was published is not added twice
    versions.append(versions.read(spark, path), path, batch=("landed", 2))
    assert versions.read(spark, path).count() == 9


def test_numbers_and_ratings_in_bodies(spark):
    bodies = [
        {"title": "a", "rating": {"value": 8.0, "count": 12}}, {"title": 5, "rating": 0}, {"title": "c", "rating": []}, {"title": "d", "rating": "0"},
        {"title": "e", "rating": ""}, {"title": "f", "rating": "x"}, {"title": "g", "rating": [1]}, {"title": "h", "rating": 0.0},
        {"title": "i", "rating": {"value": 7.5}, "year": None, "genres": "x", "directors": [{"name": "n"}]},
    ]
    df = spark.createDataFrame([(str(i), 200, json.dumps(b), "c") for i, b in enumerate(bodies)], "entity_id string, status int, body string, captured_at string")
    rows = {r.title: (r.score, r.votes) for r in payloads.detail_rows(df).collect()}
    assert rows == {"a": ("8.0", "12"), "5": ("", ""), "c": ("", ""), "e": ("", ""), "h": ("", ""), "i": ("7.5", "")}
    assert {r.entity_id for r in payloads.failed_responses(df).collect()} == {"3", "5", "6"}
    row = payloads.detail_rows(df).where("title = 'i'").collect()[0]
    assert (row.year, row.categories, row.directors) == ("", "", "n")


def test_bursts_are_the_runs_without_a_longer_pause(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "a"]), rng.randrange(400_000), rng.random() < 0.2) for _ in range(400)] + [("b", 0, False), ("b", 7200, False)]
    df = spark.createDataFrame(rows, "entity_id string, s long, ok boolean").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000))
    got = {(r.entity_id, r.burst_start.timestamp(), r.failures) for r in jobs.failure_bursts(df, "2 hours").collect()}
    want = set()
    for entity in ("hot", "a", "b"):
        run = []
        for s in [*sorted(s for e, s, ok in rows if e == entity and not ok), 10**9]:
            if run and s - run[-1] > 7200:
                want.add((entity, run[0] + 1_700_000_000.0, len(run)))
                run = []
            run.append(s)
    assert got == want
    pieces = jobs.burst_pieces(df, "2 hours").where("entity_id = 'hot'").count()
    assert pieces <= 400_000 / 7200 + 1
