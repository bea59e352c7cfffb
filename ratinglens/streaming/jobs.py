"""Incremental collection as streams.

Every job resumes from its checkpoint and writes so that a replayed batch changes nothing. ``fold_failures``,
``first_rows``, ``track_progress`` and ``collect_sample`` keep no streaming state: a batch is merged into a bucketed table
and reads and rewrites the buckets it touches. ``first_seen`` keeps one state entry per distinct key unless a watermark
delay bounds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ratinglens.labels import ZH, Labels
from ratinglens.operators.crawl_log import FACTS, failure_state, merge_facts, round_facts, summarise
from ratinglens.operators.snapshot import keep_last, top_rows
from ratinglens.session import staged
from ratinglens.sources import versions
from ratinglens.sources.payloads import detail_rows


def event_time(stream: DataFrame, column: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Zone-less time columns cannot carry a watermark: read them as UTC instants."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def first_seen(stream: DataFrame, keys: list[str], within_watermark: bool = False) -> DataFrame:
    """First row per key; with ``within_watermark`` the state expires after the delay."""
    return stream.dropDuplicatesWithinWatermark(keys) if within_watermark else stream.dropDuplicates(keys)


def append_details(responses: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Detail rows as their responses arrive, each entity once."""
    return first_seen(detail_rows(responses, labels), ["entity_id"])


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table until the source is drained."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_batch(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Sink keyed by batch id: a replayed batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def log_attempts(attempts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Attempt log that survives replays; read it with ``read_attempts``."""
    return each_batch(attempts, by_batch(path), checkpoint)


def read_attempts(stored: DataFrame, order_by: str = "failed_at") -> DataFrame:
    """Newest row per (entity, round, attempt) of the stored batches."""
    keys = ["entity_id", "round", "attempt"]
    return keep_last(stored, keys, ["batch_id", order_by]).drop("batch_id")


def first_rows(
    stream: DataFrame, keys: Sequence[str], order_by: Sequence[str], path: str, checkpoint: str, buckets: int = versions.BUCKETS
) -> StreamingQuery:
    """Keep the first row of every key in a bucketed table: what is stored stays, then the order within the batch decides.

    Rows with a missing or empty key part are left out. Read the table with ``versions.read``.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]

    def sink(batch: DataFrame, batch_id: int) -> None:
        named = batch
        for key in keys:
            named = named.where(F.col(key).cast("string") != "")

        def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
            return stored.unionByName(new.join(stored.select(*keys), list(keys), "left_anti"))

        versions.merge(top_rows(named, keys, order), path, keys, combine, buckets, batch=("first_rows", batch_id))

    return each_batch(stream, sink, checkpoint)


def fold_failures(
    events: DataFrame, path: str, checkpoint: str, open_rounds: int = 2, buckets: int = versions.BUCKETS
) -> StreamingQuery:
    """Keep the failure state of every entity up to date in a bucketed table; read it with ``stored_failure_state``.

    The last ``open_rounds`` rounds stay open: their facts are kept one by one, so events of one round may be spread over
    batches in any order. Older rounds are folded into one summary per entity, and entities that never failed are forgotten
    with their last open round, so the table grows with the entities that failed and not with the rounds. Events of a
    round that is closed go to the table ``<path>-late``.
    """
    return each_batch(events, lambda batch, i: fold_batch(round_facts(batch), path, i, open_rounds, buckets), checkpoint)


def fold_batch(facts: DataFrame, path: str, batch_id: int, open_rounds: int = 2, buckets: int = versions.BUCKETS) -> None:
    """Merge the facts of a batch into the stored failure state."""
    if open_rounds < 1:
        raise ValueError("open_rounds from 1")
    spark = facts.sparkSession
    facts = staged(facts, "round-facts")
    top = facts.agg(F.max("round")).first()[0]
    if top is None:
        return
    known = versions.version(spark, path)
    notes = known.notes if known else {}
    if notes and known.applied.get("fold_failures", -1) < batch_id:
        closed_before = F.col("round") <= notes["closed"]
        by_batch(f"{path}-late")(facts.where(closed_before), batch_id)
        facts = facts.where(~closed_before)
    closed = max(top - open_rounds, notes.get("closed", top - open_rounds))
    summary = summarise(facts)
    kept = F.struct(*(c for c in summary.columns if c != "entity_id"))
    summary_type = summary.select(kept.alias("c")).schema["c"].dataType
    new = facts.select("entity_id", F.lit(None).cast(summary_type).alias("closed"), F.array(F.struct(*FACTS)).alias("open"))

    def combine(stored: DataFrame, rows: DataFrame) -> DataFrame:
        both = stored.unionByName(rows)
        merged = merge_facts(both.select("entity_id", F.inline("open")))
        before = both.where("closed IS NOT NULL").select("entity_id", "closed.*")
        ended = summarise(merged.where(F.col("round") <= closed), before).select("entity_id", kept.alias("closed"))
        # at most open_rounds rows per entity
        going = merged.where(F.col("round") > closed).groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct(*FACTS))).alias("open"))
        joined = ended.join(going, "entity_id", "full_outer")
        left = joined.select("entity_id", "closed", F.coalesce("open", F.array().cast(rows.schema["open"].dataType)).alias("open"))
        return left.where((F.size("open") > 0) | (F.col("closed.failed_rounds") > 0))

    versions.merge(new, path, ["entity_id"], combine, buckets, ("fold_failures", batch_id), notes=lambda *_: {"closed": closed})


def stored_failure_state(spark: SparkSession, path: str, labels: Labels = ZH) -> DataFrame:
    """Failure state from the stored summaries and open rounds."""
    rows = versions.read(spark, path)
    before = rows.where("closed IS NOT NULL").select("entity_id", "closed.*")
    return failure_state(rows.select("entity_id", F.inline("open")), labels, before)


def collect_sample(
    stream: DataFrame,
    limits: Mapping[str, int],
    path: str,
    progress_path: str,
    checkpoint: str,
    labels: Labels = ZH,
    buckets: int = versions.BUCKETS,
) -> StreamingQuery:
    """Store comments up to the limit of their label, and the progress of every sample a batch touched.

    Rows carry ``entity_id, sample_label, comment_id, position`` and the outcome of their page in ``failed`` and
    ``exhausted``; a page without comments is a row with a NULL comment id. A comment counts once in a sample, at its first
    position; labels outside the plan are ignored. The bucketed table ``<path>-held`` keeps the number of comments held by a
    sample and, until the quota is met, their ids; a batch reads the buckets of its own samples, and none reads the comments
    that earlier ones stored. A task passes on twice the quota of a sample at most, so a hot sample stays small.
    Read with ``read_sample`` and ``read_sample_progress``.
    """
    plan = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    rows = stream.withColumn("target", plan[F.col("sample_label")].cast("bigint")).where("target IS NOT NULL")
    thinned = rows.mapInArrow(_enough(2 * max(limits.values())), rows.schema)
    return each_batch(thinned, lambda batch, i: sample_batch(batch, path, progress_path, i, labels, buckets), checkpoint)


def sample_batch(
    rows: DataFrame, path: str, progress_path: str, batch_id: int, labels: Labels = ZH, buckets: int = versions.BUCKETS
) -> None:
    """Store what a batch adds to its samples, then their progress, then what they hold.

    What is held is published last: a batch that is replayed before that finds the samples as they were and writes its folders
    anew, and one that is replayed after it changes nothing.
    """
    spark, keys, table = rows.sparkSession, ["entity_id", "sample_label"], f"{path}-held"
    known = versions.version(spark, table)
    if known and known.applied.get("collect_sample", -1) >= batch_id:
        return
    columns = [c for c in rows.columns if c != "target"]
    rows = staged(rows, "offered")
    facts = [F.max("target").alias("target"), *(F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("failed", "exhausted"))]
    pages = staged(rows.groupBy(*keys).agg(*facts), "sampled-pages")
    ids_type = T.ArrayType(rows.schema["comment_id"].dataType)
    held_type = T.StructType([*(rows.schema[k] for k in keys), T.StructField("held", T.LongType()), T.StructField("ids", ids_type)])
    touched = [r[0] for r in pages.select(versions.bucket_of(keys, known.buckets)).distinct().collect()] if known else []
    before = versions.read_buckets(spark, table, known, touched, held_type)

    # one shuffle by sample serves both windows; a sample sends a bounded number of rows per Arrow batch
    offered = rows.where("comment_id IS NOT NULL").repartition(*keys)
    offered = top_rows(offered, [*keys, "comment_id"], [F.col("position").asc_nulls_last()])
    room = F.col("target")
    if known:
        was = before.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("held").alias("_held"), F.col("ids").alias("_ids"))
        offered = offered.join(was, _same(keys, offered, was), "left")
        offered = offered.where(~F.coalesce(F.array_contains("_ids", F.col("comment_id")), F.lit(False)))
        room = room - F.coalesce("_held", F.lit(0))
    arrival = Window.partitionBy(*keys).orderBy(F.col("position").asc_nulls_last(), "comment_id")
    by_batch(path)(offered.withColumn("_rn", F.row_number().over(arrival)).where(F.col("_rn") <= room).select(*columns), batch_id)

    taken = spark.read.schema(rows.select(*columns).schema).parquet(f"{path}/batch_id={batch_id}")
    parts = [
        pages,
        before.select(*keys, "held", "ids"),
        taken.select(*keys, F.lit(1).cast("bigint").alias("held"), F.array("comment_id").alias("ids")),
    ]
    summed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in ("target", "failed", "exhausted")),
        F.coalesce(F.sum("held"), F.lit(0)).alias("held"),
        F.flatten(F.collect_list("ids")).alias("ids"),
    )
    now = staged(summed.where("target IS NOT NULL"), "samples")
    status = (
        F.when(F.col("failed"), labels.failed)
        .when(F.col("exhausted") & (F.col("held") < F.col("target")), labels.exhausted)
        .otherwise(labels.done)
    )
    by_batch(progress_path)(now.select(*keys, "target", "held", status.alias("status")), batch_id)

    ids = F.when(F.col("held") < F.col("target"), F.col("ids")).otherwise(F.array().cast(ids_type))

    def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
        changed = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
        return stored.join(changed, _same(keys, stored, changed), "left_anti").unionByName(new)

    versions.merge(now.select(*keys, "held", ids.alias("ids")), table, keys, combine, buckets, ("collect_sample", batch_id))


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    """Rows of one key, which may be NULL; the right side has its names behind an underscore."""
    return reduce(and_, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _enough(most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each sample in an Arrow batch the first ``most`` comments, and a row for each outcome of its pages.

    A sample holds fewer comments than its quota as long as it takes any, so of twice the quota enough are new.
    """
    keys = ["entity_id", "sample_label"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.select([*keys, "comment_id", "position", "failed", "exhausted"]).to_pandas()
            ordered = rows[rows.comment_id.notna()].sort_values(["position", "comment_id"], kind="stable")
            firsts = ordered.drop_duplicates([*keys, "comment_id"]).groupby(keys, dropna=False).head(most).index
            outcomes = [rows[rows[c].fillna(False).astype(bool)] for c in ("failed", "exhausted")]
            pages = [part.drop_duplicates(keys).index for part in (rows, *outcomes)]
            yield b.take(pa.array(firsts.append(pages).unique().sort_values(), type=pa.int64()))

    return run


def read_sample(stored: DataFrame) -> DataFrame:
    return stored.drop("batch_id")


def read_sample_progress(stored: DataFrame) -> DataFrame:
    """Newest progress per (entity, label)."""
    return keep_last(stored, ["entity_id", "sample_label"], ["batch_id"]).drop("batch_id")


#: Kinds of change: a candidate, a stored detail row, an entity's loss, a comment; ``n`` counts them, below zero when they go.
CHANGES = ("candidate", "detail", "lost", "comment")


def progress_totals(entities: DataFrame) -> list[Column]:
    """The progress counts as sums over entities (entity_id, candidate, detail, lost)."""
    named = F.col("entity_id") != ""
    held, gone = named & (F.col("detail") > 0), named & (F.col("lost") > 0)
    parts = {
        "target": F.col("candidate"),
        "collected": F.when(held, 1).otherwise(0),
        "unavailable": F.col("lost"),
        "processed": F.when(held | gone, 1).otherwise(0),
        "pending": F.when(F.coalesce(held | gone, F.lit(False)), 0).otherwise(F.col("candidate")),
    }
    return [F.coalesce(F.sum(part), F.lit(0)).cast("bigint").alias(name) for name, part in parts.items()]


def track_progress(
    changes: DataFrame, path: str, progress_path: str, checkpoint: str, buckets: int = versions.BUCKETS
) -> StreamingQuery:
    """Store the progress counts after each batch of signed changes (entity_id, kind, n).

    The table at ``path`` holds for every entity how often it is wanted, stored and lost. A batch reads the buckets of its
    own entities, sums what their change does to every count, and adds that to the counts before: nothing is recounted, and no
    input is frozen. The counts are published with the table, so a replayed batch finds both or neither.
    """
    return each_batch(changes, lambda batch, i: apply_changes(batch, path, progress_path, i, buckets), checkpoint)


def apply_changes(batch: DataFrame, path: str, progress_path: str, batch_id: int, buckets: int = versions.BUCKETS) -> None:
    spark = batch.sparkSession
    counted = [kind for kind in CHANGES if kind != "comment"]
    summed = batch.groupBy("entity_id").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint").alias(kind) for kind in CHANGES)
    )
    summed = staged(summed, "changes")

    def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.unionByName(new).groupBy("entity_id").agg(*(F.sum(kind).alias(kind) for kind in counted))

    def status(stored: DataFrame, new: DataFrame, last: versions.Version | None) -> dict:
        before = stored.join(new, stored["entity_id"].eqNullSafe(new["entity_id"]), "left_semi")
        after = combine(before, new).agg(*progress_totals(new)).first().asDict()
        earlier = before.agg(*progress_totals(before)).first().asDict()
        comments = summed.agg(F.coalesce(F.sum("comment"), F.lit(0))).first()[0]
        held = last.notes["status"] if last else dict.fromkeys([*after, "comments"], 0)
        now = {name: held[name] + after[name] - earlier[name] for name in after} | {"comments": held["comments"] + comments}
        return {"status": now, "made_progress": after["processed"] > earlier["processed"], "batch": batch_id}

    done = versions.merge(
        summed.select("entity_id", *counted), path, ["entity_id"], combine, buckets, ("track_progress", batch_id), notes=status
    )
    if done.notes["batch"] == batch_id:
        names = [*done.notes["status"], "made_progress"]
        schema = ", ".join(f"{n} {'boolean' if n == 'made_progress' else 'bigint'}" for n in names)
        row = tuple(done.notes["status"].values()) + (done.notes["made_progress"],)
        by_batch(progress_path)(spark.createDataFrame([row], schema), batch_id)


def read_progress(stored: DataFrame) -> DataFrame:
    """The counts after the newest batch: one small row a batch is stored."""
    return top_rows(stored.withColumn("_all", F.lit(0)), ["_all"], [F.col("batch_id").desc()]).drop("_all", "batch_id")


def outcome_rates(events: DataFrame, width: str = "1 day", time: str = "ts") -> DataFrame:
    """Successes and failures per time slice."""
    return (
        events.groupBy(F.window(time, width).alias("w"))
        .agg(F.count_if("ok").alias("successes"), F.count_if(~F.col("ok")).alias("failures"))
        .select(F.col("w.start").alias("slice_start"), F.col("w.end").alias("slice_end"), "successes", "failures")
    )


def track_outcomes(stream: DataFrame, path: str, checkpoint: str, width: str = "1 day", time: str = "ts") -> StreamingQuery:
    """Store the slice counts of each batch; they add up, so no state is kept and late events count."""
    store = by_batch(path)
    return each_batch(stream, lambda batch, i: store(outcome_rates(batch, width, time), i), checkpoint)


def read_outcomes(stored: DataFrame) -> DataFrame:
    """Slices so far, with those still open."""
    return stored.groupBy("slice_start", "slice_end").agg(
        F.sum("successes").alias("successes"), F.sum("failures").alias("failures")
    )


def burst_pieces(events: DataFrame, gap: str = "6 hours", key: str = "entity_id", time: str = "ts") -> DataFrame:
    """(key, burst_start, burst_end, failures) per time slice as long as the gap: failures of one slice are of one burst.

    A plain aggregation, so the failures of a hot entity are combined before the shuffle.
    """
    failed = events.where(~F.col("ok")).groupBy(key, F.window(time, gap).alias("_slice"))
    return failed.agg(
        F.min(time).alias("burst_start"), (F.max(time) + F.expr(f"INTERVAL {gap}")).alias("burst_end"), F.count("*").alias("failures")
    ).drop("_slice")


def failure_bursts(events: DataFrame, gap: str = "6 hours", key: str = "entity_id", time: str = "ts") -> DataFrame:
    """Runs of failures of one entity with no pause longer than the gap."""
    return read_bursts(burst_pieces(events, gap, key, time), key)


def track_bursts(
    stream: DataFrame, path: str, checkpoint: str, gap: str = "6 hours", key: str = "entity_id", time: str = "ts"
) -> StreamingQuery:
    """Store the pieces of bursts within each batch; ``read_bursts`` joins those that touch."""
    store = by_batch(path)
    return each_batch(stream, lambda batch, i: store(burst_pieces(batch, gap, key, time), i), checkpoint)


def read_bursts(stored: DataFrame, key: str = "entity_id") -> DataFrame:
    """Bursts so far, with those still open: stored pieces that touch are one burst.

    A window sees the pieces of an entity, at most one per batch and slice, however many failures they hold.
    """
    ordered = Window.partitionBy(key).orderBy("burst_start", "burst_end")
    reached = F.max("burst_end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("burst_start") > reached).cast("int"), F.lit(1))
    runs = stored.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(ordered))
    return (
        runs.groupBy(key, "_run")
        .agg(F.min("burst_start").alias("burst_start"), F.max("burst_end").alias("burst_end"), F.sum("failures").alias("failures"))
        .drop("_run")
    )
