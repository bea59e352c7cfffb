"""Operators against brute force, under skew and under any partitioning."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratinglens.labels import ZH
from ratinglens.operators import categories, charts, coverage, crawl_log, membership, ordered, quadrants, sketches, snapshot, stats
from ratinglens.operators.ordered import average_ranks, cumulative_counts, exact_medians, exact_quantiles, numbered, value_counts
from ratinglens.session import staged
from ratinglens.sources import versions


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group and on one value."""
    rng = np.random.default_rng(7)
    n = 3000
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 1 / 3, "hot", rng.integers(0, 40, n).astype(str)),
            "x": np.where(rng.random(n) < 1 / 3, 5.0, np.round(rng.lognormal(2, 2, n), 2)),
            "y": rng.integers(0, 50, n).astype(float),
        }
    )
    frame.loc[::97, "y"] = np.nan
    df = spark.createDataFrame(frame).withColumn("y", F.nanvl("y", F.lit(None)))
    return frame, df


def test_quantiles_equal_pandas(skewed):
    frame, df = skewed
    row = exact_quantiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.99}).collect()[0]
    assert [row.a, row.b, row.c] == pytest.approx(list(frame["x"].quantile([0.1, 0.5, 0.99])))
    got = {r.g: r.m for r in exact_quantiles(df, "x", {"m": 0.5}, ["g"]).collect()}
    want = frame.groupby("g")["x"].median()
    assert got == pytest.approx(want.to_dict())


@pytest.mark.parametrize("ranges", [1, 2, 3, 8, 32, 1000])
def test_running_counts_do_not_depend_on_the_ranges(skewed, ranges):
    frame, df = skewed
    got = {r.x: r.cum for r in cumulative_counts(value_counts(df, "x"), "x", ranges=ranges).collect()}
    assert got == frame["x"].value_counts().sort_index().cumsum().to_dict()


def test_average_ranks_equal_pandas(skewed):
    frame, df = skewed
    got = {r.x: r.rank for r in average_ranks(value_counts(df, "x"), "x").collect()}
    want = dict(zip(frame["x"], frame["x"].rank(), strict=True))
    assert got == pytest.approx(want)


def test_counts_of_quantiles_and_ranks_are_shuffled_once(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x"), (F.col("id") * 37 % 101).alias("y"))
    for found, key in ((exact_medians(df, ["x", "y"], ["g"]), "_measure"), (exact_quantiles(df, "x", {"m": 0.5}, ["g"]), "g")):
        assert found.count() in (7, 14)
        plan = found._jdf.queryExecution().executedPlan()
        found.collect()
        text = plan.toString()
        assert "ReusedExchange" in text or "ReusedSubquery" in text
        # the shuffled counts are asked for no range, which they don't hold yet
        assert "isnotnull(aggregate(" not in text
    got = {(r.g, r.measure): r.median for r in exact_medians(df, ["x", "y"], ["g"]).collect()}
    frame = df.toPandas()
    assert got == {(g, c): frame[frame.g == g][c].median() for g in range(7) for c in ("x", "y")}


def test_quantiles_without_rows(spark):
    df = spark.createDataFrame([("a", None)], "g string, x double")
    assert exact_quantiles(df, "x", {"m": 0.5}).collect() == [(None,)]
    assert exact_quantiles(df, "x", {"m": 0.5}, ["g"]).collect() == []
    assert exact_medians(df, ["x"], ["g"]).collect() == []


def test_spearman(spark, skewed):
    frame, df = skewed
    table = df.withColumn("k", F.lit(1.0)).withColumn("up", F.exp(F.col("x") / 1e6))
    got = {r.pair: r for r in stats.spearman(table, {"xy": ("x", "y"), "xk": ("x", "k"), "xu": ("x", "up")}).collect()}
    both = frame.dropna()
    assert got["xy"].rho == pytest.approx(both["x"].rank().corr(both["y"].rank()))
    assert got["xy"].n == len(both)
    assert got["xk"].rho is None and got["xu"].rho == pytest.approx(1.0)
    again = stats.spearman(df.repartition(7, "y"), {"xy": ("x", "y")}).collect()[0]
    assert again.rho == pytest.approx(got["xy"].rho)
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert stats.spearman(one, {"p": ("x", "y")}).collect()[0].rho is None


def test_cohens_d(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 6.0), ("c", 1.0)], "g string, v double")
    d = lambda l, r: df.agg(stats.cohens_d(F.col("v"), F.col("g") == l, F.col("g") == r)).collect()[0][0]
    assert d("a", "b") == pytest.approx(-2 / math.sqrt(5))
    assert d("c", "b") is None and d("c", "c") is None


def test_numbered_equals_a_plain_row_number(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), rng.randint(0, 10**6), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, s long, i int").withColumn("t", F.timestamp_seconds("s"))
    got = {r.i: r.n for r in numbered(df, ["k"], "t", ["i"], "n").collect()}
    want, seen = {}, {}
    for k, s, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[k] = want[i] = seen.get(k, 0) + 1
    assert got == want


def test_a_key_at_one_moment_is_cut_into_ranges(spark):
    """All rows of a key in one hour, a third of them at one moment: every task numbers a part."""
    df = spark.range(9000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3600)).alias("t"), F.col("id").alias("i")
    )
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ordered, "staged", lambda frame, name: made.append(staged(frame, name)) or made[-1])
        found = numbered(df.unionByName(df.limit(5).withColumn("k", F.lit(None).cast("string"))), ["k"], "t", ["i"], "n")
    sizes = [r["count"] for r in made[0].where("k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 9000 / 4 * 1.5
    got = {(r.k, r.i): r.n for r in found.collect()}
    want = sorted(range(9000), key=lambda i: (7 if i % 3 == 0 else i % 3600, i))
    assert [got["hot", i] for i in want] == list(range(1, 9001))
    assert sorted(n for (k, _), n in got.items() if k is None) == [1, 2, 3, 4, 5]


def test_one_row_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    last = snapshot.keep_last(df, ["k"], ["v"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    want = {}
    for i in range(5000):
        want[0 if i % 3 == 0 else i % 50] = i
    assert {r.k: r.v for r in last.collect()} == want


def test_keep_first_drops_empty_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 0), (None, 0)], "k string, i int")
    assert [tuple(r) for r in snapshot.keep_first(df, "k", ["i"]).collect()] == [("a", 1)]


def test_upsert_is_idempotent(spark):
    log = spark.createDataFrame([("1", 1, 1, "a", "t1"), ("1", 1, 2, "b", "t2")], "id string, round int, n int, reason string, at string")
    once = snapshot.upsert_log(log.where("false"), log, ["id", "round", "n"], ["at"])
    twice = snapshot.upsert_log(once, log.withColumn("reason", F.lit("new")), ["id", "round", "n"], ["at"])
    assert sorted(r.reason for r in twice.collect()) == ["new", "new"]


def test_sample_limits_differ_by_label(spark):
    df = spark.createDataFrame([("e", l, p) for l in "AB" for p in range(1, 6)] + [("e", "C", 1)], "entity_id string, sample_label string, position int")
    kept = snapshot.rank_limited_sample(df, {"A": 1, "B": 3})
    assert kept._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted((r.sample_label, r.position) for r in kept.collect()) == [("A", 1), ("B", 1), ("B", 2), ("B", 3)]


def test_pending_and_progress(spark):
    entities = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("2", "two", 3), ("3", "x", 4)], "entity_id string, title string, seq int")
    held = spark.createDataFrame([("1", "A", 3)], "entity_id string, sample_label string, held long")
    states = spark.createDataFrame([("2", "A", ZH.exhausted), ("3", "A", ZH.failed)], "entity_id string, sample_label string, state string")
    progress = membership.progress_spine(entities, {"A": 3}, held, states, ["seq"])
    got = {r.entity_id: (r.title, r.held, r.status, r.finished) for r in progress.collect()}
    assert got == {"1": ("new", 3, ZH.done, True), "2": ("two", 0, ZH.exhausted, True), "3": ("x", 0, ZH.failed, False)}
    assert {r.entity_id for r in membership.finished_entities(progress).collect()} == {"1", "2"}
    left = membership.pending(entities, [held, states.where("state <> '失败'")])
    assert [r.entity_id for r in left.collect()] == ["3"]


def test_weights_of_an_entity_sum_to_one(spark):
    df = spark.createDataFrame([("1", 2020, "a / b / a"), ("2", 2021, ""), ("3", 2021, None)], "entity_id string, year int, categories string")
    rows = categories.weighted_categories(df).collect()
    totals = {}
    for r in rows:
        totals[r.entity_id] = totals.get(r.entity_id, 0) + r.weight
    assert totals == {"1": 1.0, "2": 1.0, "3": 1.0}
    assert [r.category for r in rows if r.entity_id != "1"] == [ZH.unknown] * 2
    counts = {r.year: r.n for r in categories.yearly_counts(df, (2019, 2021)).collect()}
    assert counts == {2019: 0, 2020: 1, 2021: 2}


def test_tag_coverage_counts_entities_once(spark):
    links = spark.createDataFrame([("1", "t")] * 50 + [("2", "t"), ("9", "t")], "entity_id string, tag string")
    dated = spark.createDataFrame([("1", 2020), ("2", 2020)], "entity_id string, year int")
    assert [tuple(r) for r in categories.tag_coverage(links, dated).collect()] == [(2020, "t", 2)]


def test_quadrants_and_sensitivity(spark):
    df = spark.createDataFrame([("1", 9.0, 10), ("2", 8.0, 20), ("3", 7.0, 30), ("4", None, 5)], "entity_id string, score double, votes int")
    got = {r.entity_id: r.quadrant for r in quadrants.entity_quadrants(df).collect()}
    assert got == {"1": "较高分-小众", "2": "较高分-大众", "3": "较低分-大众"}
    rows = quadrants.quadrant_sensitivity(df, [8.0], [0.5]).collect()
    assert [tuple(r) for r in rows] == [(8.0, 0.5, 20.0, 1, 1)]


def test_histogram_equals_numpy(skewed):
    frame, df = skewed
    counts, edges = np.histogram(frame["x"], bins=20)
    rows = charts.histogram(df, "x").orderBy("bin").collect()
    assert [r.n for r in rows] == list(counts)
    assert [r.low for r in rows] == pytest.approx(list(edges[:-1]))


def test_density_of_many_values_is_within_the_stated_error(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate((rng.normal(0, 1, 3000), rng.normal(6, 0.5, 1500)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    h = values.std(ddof=1) * len(values) ** -0.2
    for grid in (64, 512):
        rows = charts.density(df, "v", 50, grid).orderBy("point").collect()
        exact = [np.exp(-(((r.x - values) / h) ** 2) / 2).sum() / (len(values) * h * math.sqrt(2 * math.pi)) for r in rows]
        step = (values.max() - values.min()) / grid
        off = max(abs(r.density - e) for r, e in zip(rows, exact, strict=True))
        assert 0 < off <= step**2 / (8 * h**3 * math.sqrt(2 * math.pi))
    assert charts.density(df.limit(0), "v").count() == 0 and charts.density(df.limit(1), "v").count() == 0


def test_density_does_not_grow_with_the_rows(spark):
    df = spark.range(40_000).select((F.col("id") * 1.0).alias("v"))
    found = charts.density(df, "v", 20)
    found.collect()
    import re

    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search("Generate explode", plan) and "HashAggregate(keys=[few" in plan


def test_density_equals_the_formula(spark):
    values = np.array([1.0, 1.0, 2.0, 4.0, 7.0])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    h = values.std(ddof=1) * len(values) ** -0.2
    rows = charts.density(df, "v", 5).orderBy("point").collect()
    for r in rows:
        want = np.exp(-(((r.x - values) / h) ** 2) / 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want)


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    r = charts.box_stats(df, "v", ["g"]).collect()[0]
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n, r.outliers) == (2, 3, 4, 1, 4, 5, 1)


def fold(events):
    """The failure state of one entity, event by event."""
    state = None
    for e in events:
        permanent = e["reason"] in ("HTTP 400", "HTTP 404", "HTTP 410")
        if e["ok"]:
            if state:
                state.update(status=ZH.recovered, permanent_streak=0, updated_at=e["at"])
            continue
        if state is None:
            state = dict(
                entity_id=e["entity_id"], first_round=e["round"], last_round=0, last_reason="", failed_rounds=0,
                permanent_rounds=0, permanent_streak=0, first_failed_at=e["at"],
            )
        if state["last_round"] != e["round"]:
            state["failed_rounds"] += 1
            if permanent:
                state["permanent_rounds"] += 1
                follows = state["last_round"] == e["round"] - 1 and state["last_reason"] in ("HTTP 400", "HTTP 404", "HTTP 410")
                state["permanent_streak"] = state["permanent_streak"] + 1 if follows else 1
            else:
                state["permanent_streak"] = 0
        state.update(title=e["title"], last_reason=e["reason"], last_round=e["round"], updated_at=e["at"])
        state["status"] = ZH.unavailable if state["permanent_streak"] >= 2 else ZH.pending
    return state


def random_events(seed, entities=60):
    rng = random.Random(seed)
    rows = []
    for i in range(entities):
        current = rng.randint(1, 3)
        for j in range(rng.randint(1, 14)):
            current += rng.choice([0, 0, 1, 1, 1, 2])
            ok = rng.random() < 0.15
            reason = None if ok else rng.choice(["HTTP 400", "HTTP 400", "HTTP 404", "HTTP 429"])
            seq = i * 100 + j
            rows.append(dict(entity_id=str(i), title=f"t{seq}", round=current, seq=seq, ok=ok, reason=reason, at=f"{seq:06d}"))
    return rows


EVENTS = "entity_id string, title string, round int, seq long, ok boolean, reason string, at string"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_failure_state_equals_the_event_by_event_fold(spark, seed):
    rows = random_events(seed)
    df = spark.createDataFrame(rows, EVENTS).repartition(5, "seq")
    got = {r["entity_id"]: r.asDict() for r in crawl_log.failure_state(crawl_log.round_facts(df)).collect()}
    want = {}
    for i in {r["entity_id"] for r in rows}:
        state = fold([r for r in rows if r["entity_id"] == i])
        if state:
            want[i] = state
    assert got == want


def one_state(spark, *events):
    rows = [
        dict(entity_id="1", title="t", round=r, seq=i, ok=reason is None, reason=reason, at=str(i))
        for i, (r, reason) in enumerate(events)
    ]
    found = crawl_log.failure_state(crawl_log.round_facts(spark.createDataFrame(rows, EVENTS))).collect()
    return found[0] if found else None


def test_failure_state_cases(spark):
    s = one_state(spark, (1, "HTTP 400"), (1, "HTTP 400"), (2, "HTTP 400"))
    assert (s.failed_rounds, s.permanent_rounds, s.status) == (2, 2, ZH.unavailable)
    s = one_state(spark, (1, "HTTP 429"), (2, "网络请求失败"))
    assert (s.permanent_rounds, s.status) == (0, ZH.pending)
    s = one_state(spark, (1, "HTTP 400"), (1, None))
    assert (s.permanent_streak, s.status) == (0, ZH.recovered)
    s = one_state(spark, (1, "HTTP 400"), (2, "HTTP 429"), (3, "HTTP 400"))
    assert (s.permanent_rounds, s.permanent_streak, s.status) == (2, 1, ZH.pending)
    s = one_state(spark, (1, "HTTP 400"), (3, "HTTP 400"))
    assert (s.permanent_streak, s.status) == (1, ZH.pending)
    assert one_state(spark, (1, None)) is None


def test_rounds_and_attempt_numbers(spark):
    schema = "entity_id string, title string, round int, attempt int, level string, reason string, failed_at string"
    log = spark.createDataFrame(
        [("1", "t", 1, 1, "r", "HTTP 400", "a"), ("1", "t", 1, 2, "r", "HTTP 404", "b"), ("2", "t", 1, 1, "r", "HTTP 400", "c")], schema
    )
    lost = crawl_log.round_outcomes(log, retries=1, request_level="r").collect()
    assert [(r.entity_id, r.reason, r["at"]) for r in lost] == [("1", "HTTP 404", "b")]
    assert {r.entity_id: r.next_attempt for r in crawl_log.next_attempts(log).collect()} == {"1": 3, "2": 2}
    new = spark.createDataFrame([("1", 1, 5), ("1", 1, 4), ("1", 2, 6)], "entity_id string, round int, s long")
    new = new.withColumn("t", F.timestamp_seconds("s"))
    got = {r.s: r.attempt for r in crawl_log.number_attempts(new, log, "t", ["s"]).collect()}
    assert got == {4: 3, 5: 4, 6: 1}
    empty = spark.createDataFrame([], "last_round int")
    assert crawl_log.next_round(empty).collect()[0][0] == 1


def test_page_outcomes(spark):
    rows = [
        ("full", 0, 20, 20, 100, False), ("short", 0, 20, 7, 0, False), ("total", 20, 10, 10, 30, False),
        ("failed", 0, 20, 7, 0, False), ("failed", 20, 20, 0, 0, True),
    ]
    pages = spark.createDataFrame(rows, "entity_id string, page_start int, asked int, got int, total int, failed boolean")
    got = {r.entity_id: (r.failed, r.exhausted) for r in crawl_log.page_outcomes(pages, ["entity_id"]).collect()}
    assert got == {"full": (False, False), "short": (False, True), "total": (False, True), "failed": (True, False)}


# completeness of tags


def page(tag, start, got, failed=False, asked=20):
    return (tag, start, asked, got, failed)


def test_tags_are_complete_without_holes_and_failed_pages(spark):
    rows = [
        page("whole", 0, 20), page("whole", 20, 20), page("whole", 40, 7),
        page("hole", 0, 20), page("hole", 40, 7),
        page("open", 0, 20), page("open", 20, 20),
        page("failed", 0, 20), page("failed", 20, 0, True),
        page("again", 0, 20), page("again", 20, 0, True), page("again", 20, 3),
        page("overlap", 0, 20), page("overlap", 15, 20), page("overlap", 35, 0),
        page("inside", 0, 20), page("inside", 15, 0, True), page("inside", 20, 1),
        page("full", 0, 100, asked=100), page("full", 100, 100, asked=100),
        page("none", 0, 0), page("lost", 0, 0, True), page("late", 5, 20), page("late", 25, 1),
        page("behind", 0, 5), page("behind", 40, 0, True),
    ]
    pages = spark.createDataFrame(rows, "tag string, page_start int, asked int, got int, failed boolean")
    got = {r.tag: (r.covered, r.ends, r.holes, r.failed_pages, r.complete) for r in coverage.tag_completeness(pages).collect()}
    assert got == {
        "whole": (47, 47, 0, 0, True), "hole": (20, None, 1, 0, False), "open": (40, None, 0, 0, False), "failed": (20, None, 0, 1, False),
        "again": (23, 23, 0, 0, True), "overlap": (35, 35, 0, 0, True), "inside": (21, 21, 0, 1, False), "full": (200, None, 0, 0, True),
        "none": (0, 0, 0, 0, True), "lost": (0, None, 0, 1, False), "late": (0, None, 1, 0, False), "behind": (5, 5, 0, 1, True),
    }
    tags = spark.createDataFrame([("whole", 1), ("hole", 2), ("unread", 3), ("none", 4)], "tag string, tag_order int")
    left = membership.pending_tags(tags, coverage.complete_tags(pages))
    assert [r.tag for r in left.collect()] == ["hole", "unread"]
    assert coverage.tag_completeness(pages.limit(0)).count() == 0


# stored sketches


def test_sketches_of_batches_add_up(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(4), rng.randrange(20_000) if rng.random() < 0.95 else None) for _ in range(30_000)]
    rows += [("hot", 0, i % 3) for i in range(5000)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, slice int, v long")
    reach, sizes = str(tmp_path / "reach"), str(tmp_path / "sizes")
    for batch in (0, 1, 1, 2):  # a batch that comes twice counts once
        part = df.where(F.abs(F.hash("g", "v")) % 3 == batch)
        sketches.add_to(reach, sketches.distinct_sketches(part, "v", ["g", "slice"]), ["g", "slice"], buckets=4, batch=("w", batch))
        sketches.add_to(sizes, sketches.quantile_sketches(part, "v", ["g", "slice"]), ["g", "slice"], True, 4, ("w", batch))
    some = versions.read(spark, reach).where("slice IN (0, 2)")
    got = {r.g: r.distinct for r in sketches.distinct_counts(some, ["g"]).collect()}
    want = {g: len({v for k, s, v in rows if k == g and s in (0, 2) and v is not None}) for g in ("a", "b", "hot", "none")}
    assert got["hot"] == 3 and got["none"] == 0
    for g in "ab":
        assert abs(got[g] - want[g]) <= 4 * sketches.distinct_error() * want[g]
    found = {r.g: r for r in sketches.sketched_quantiles(versions.read(spark, sizes), {"q": 0.3, "m": 0.5}, ["g"]).collect()}
    assert found["none"].n == 0 and found["none"].m is None and found["hot"].m == 1
    for g in "ab":
        values = np.sort([v for k, _, v in rows if k == g and v is not None])
        assert found[g].n == len(values)
        for p, q in ((0.3, found[g].q), (0.5, found[g].m)):
            low, high = np.searchsorted(values, q, "left") / len(values), np.searchsorted(values, q, "right") / len(values)
            assert low <= p + sketches.rank_error() and high >= p - sketches.rank_error()


def test_a_batch_of_sketches_reads_no_other_bucket(spark, tmp_path):
    path = str(tmp_path / "reach")
    df = spark.createDataFrame([(str(i), i) for i in range(60)], "g string, v int")
    sketches.add_to(path, sketches.distinct_sketches(df, "v", ["g"]), ["g"], buckets=8)
    before = versions.version(spark, path).folders
    sketches.add_to(path, sketches.distinct_sketches(df.where("g = '7'"), "v", ["g"]), ["g"])
    after = versions.version(spark, path).folders
    assert sum(before[b] != after[b] for b in before) == 1
