"""Incremental and streaming operators (INC-01..06).

Batch forms are plain DataFrame plans; the stream forms use Structured
Streaming with checkpoints under ``spark.checkpoint.dir`` so a restarted job
resumes where it stopped (the reference's "skip finished units" rule).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import agg as G
from ..operators import joins as J
from ..operators import window as W
from ..operators.scan import MAX, prefix_scan
from ..schema import COOLDOWN_SECONDS, LIMIT_REQUESTS_PER_MINUTE, LIMIT_TOKENS_PER_MINUTE, MAX_ATTEMPTS
from ..functions.timefn import epoch_micros, epoch_seconds
from ..session import cut_lineage
from ..sources.readers import read_or_empty
from .state import FirstSeen, RetryState, rocks_db


def _list(x) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


# INC-01 -- resume: skip finished units, process the rest
def resume(units: DataFrame, done: DataFrame, key, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    todo = J.anti(units, done, key)
    return fn(todo)


def resume_stream(spark: SparkSession, src: str, schema: T.StructType, out: str, checkpoint: str, fn: Callable[[DataFrame], DataFrame], fmt: str = "parquet"):
    """Process every file under ``src`` exactly once: files already recorded
    in the checkpoint are skipped, the rest are transformed and appended."""
    stream = spark.readStream.schema(schema).format(fmt).load(src)
    q = fn(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return q


# INC-02 -- ingest response files as they arrive: first row per index wins
# across batches, and the rows patch the deck.
def stream_responses(
    spark: SparkSession,
    src: str,
    parse: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    key: str = "idx",
    order: str | list[str] = "order",
    deck: DataFrame | None = None,
):
    """``parse`` turns the raw lines (value, file) into rows with ``key`` and
    the ``order`` columns.  The state store knows the keys met so far: of a
    micro-batch's rows of a new key the first by ``order`` passes, later files
    with a known key are ignored, so a batch costs what it holds, however much
    was ingested before.  Null is a key like any other.  A batch writes a
    folder of its own, replacing what a failed attempt at it has left, so a
    replay changes nothing.  Returns the rows, or the ``deck`` patched with
    them (null columns included)."""
    raw = spark.readStream.text(src).select("value", F.col("_metadata.file_path").alias("file"))
    rows = first_seen(parse(raw), key, order)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with rocks_db(spark):
        q = rows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    got = read_or_empty(spark, out, rows.schema, "parquet").select(*rows.columns)
    return got if deck is None else J.patch_rows(deck, got, key, strip_strings=False)


def first_seen(stream: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """The rows of a stream whose key was in no earlier micro-batch, the first
    by ``order`` (nulls first, ties by all columns) of each key."""
    keys, order = _list(key), _list(order)
    by = [*order, *[c for c in stream.columns if c not in order]]
    return stream.groupBy(*keys).transformWithState(FirstSeen(by, stream.columns), stream.schema, "Append", "None")


# INC-03 -- bounded retry: attempts so far, attempts left, terminal failures
# with their (first max_attempts) errors.  Numbering errors per task is
# skew-safe (two-level running count), so a task with a huge error history
# never collects more than max_attempts items.
def retry_state(results: DataFrame, task: str, ts: str, ok: str, error: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    errs = results.where(~F.col(ok))
    numbered = W.number_rows(errs, [task], [ts, error], "__n")
    first_errs = numbered.where(F.col("__n") <= max_attempts)
    agg_err = first_errs.groupBy(task).agg(F.sort_array(F.collect_list(F.struct(F.col("__n"), F.col(error).cast("string").alias("e")))).alias("__e"))
    counts = results.groupBy(task).agg(
        F.count_if(~F.col(ok)).cast("bigint").alias("attempts"),
        F.max(F.col(ok).cast("int")).cast("boolean").alias("succeeded"),
    )
    agg_err = agg_err.withColumnRenamed(task, "__task")
    j = counts.join(agg_err, F.col(task).eqNullSafe(F.col("__task")), "left")
    left = F.greatest(F.lit(max_attempts) - F.col("attempts"), F.lit(0)).cast("bigint")
    status = F.when(F.col("succeeded"), "succeeded").when(F.col("attempts") >= max_attempts, "failed").otherwise("retry")
    errors = F.when(F.col("__e").isNull(), F.lit("")).otherwise(F.array_join(F.transform("__e", lambda s: s["e"]), ";"))
    return j.select(task, "attempts", left.alias("attempts_left"), status.alias("status"), errors.alias("errors"))


def retry_state_stream(events: DataFrame, task: str, ok: str, error: str, max_attempts: int = MAX_ATTEMPTS, order: list[str] | None = None) -> DataFrame:
    """Streaming form, with the rows of :func:`retry_state`: the state store
    holds a task's counts and the list of its first ``max_attempts`` errors by
    ``order`` (default: arrival) and by error; a task's current status is
    emitted whenever it receives events.  Events are handled one by one, and a
    late event with an earlier place takes that place, so all arrivals of the
    same events end in the same row."""
    kind = events.schema[task].dataType
    schema = T.StructType([T.StructField(task, kind), *T.StructType.fromDDL("attempts long, attempts_left long, status string, errors string")])
    places = [T.StructField(f"o{i}", events.schema[c].dataType) for i, c in enumerate(order or [])] or [T.StructField("o0", T.LongType())]
    x = events.select(task, F.col(ok).alias("ok"), F.col(error).cast("string").alias("error"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order or [])])
    processor = RetryState(task, max_attempts, T.StructType([*places, T.StructField("error", T.StringType())]), bool(order))
    return x.groupBy(task).transformWithState(processor, schema, "Update", "None")


def latest_state(spark: SparkSession, stream: DataFrame, key: str, out: str, checkpoint: str) -> DataFrame:
    """Run an update-mode stream to completion (availableNow) and return the
    last emitted row per key: every micro-batch writes its updates to a folder
    of its own (a repeated attempt replaces it), then the latest one wins."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with rocks_db(spark):
        q = stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return G.last_per_key(spark.read.parquet(out), key, ["batch_id"]).drop("batch_id")


# INC-04 -- requests and tokens per minute against the limits
def rate_audit(df: DataFrame, ts: str, tokens: str, rpm: int = LIMIT_REQUESTS_PER_MINUTE, tpm: int = LIMIT_TOKENS_PER_MINUTE) -> DataFrame:
    g = df.groupBy(F.window(ts, "1 minute").alias("w")).agg(
        F.count(F.lit(1)).cast("bigint").alias("requests"), F.sum(tokens).cast("bigint").alias("tokens")
    )
    return g.select(
        epoch_seconds(F.col("w.start")).alias("minute"),
        "requests",
        "tokens",
        ((F.col("requests") > rpm) | (F.col("tokens") > tpm)).alias("over_limit"),
    )


def rate_audit_stream(stream: DataFrame, ts: str, tokens: str, rpm: int = LIMIT_REQUESTS_PER_MINUTE, tpm: int = LIMIT_TOKENS_PER_MINUTE, late: str = "1 minute") -> DataFrame:
    """Event-time tumbling minutes with a watermark.  In append mode a minute
    is emitted once it can no longer change; in update mode (see
    :func:`latest_state`) open minutes are emitted, too."""
    return rate_audit(stream.withWatermark(ts, late), ts, tokens, rpm, tpm)


# INC-05 -- results within `secs` after a rate-limit error: the time of the
# last error up to each row is one prefix scan over sampled ranges.
def cooldown_flags(df: DataFrame, key: str, ts: str, is_error, secs: int = COOLDOWN_SECONDS) -> DataFrame:
    """(key, cooling) of every row; an error cools its own second and those
    of the same time.  Rows without a time are not cooling."""
    t = epoch_micros(ts)
    x = df.select(key, t.alias("__t"), F.coalesce(is_error, F.lit(False)).alias("__err"))
    # errors precede the other rows of their time
    x = prefix_scan(x, [], ["__t", F.col("__err").desc()], {"__last": (F.when(F.col("__err"), F.col("__t")), MAX)})
    cooling = F.coalesce(F.col("__t") - F.col("__last") < secs * 1_000_000, F.lit(False))
    return x.select(key, cooling.alias("cooling"))


# INC-06 -- repeat a step until nothing is pending or for a number of rounds;
# each round is written to the shared folder (lineage stays short and a lost
# executor recomputes one round, not the whole history).
def iterate(deck: DataFrame, step: Callable[[DataFrame, int], DataFrame], pending: Callable[[DataFrame], DataFrame], rounds: int | None = None) -> DataFrame:
    """At most ``rounds`` rounds, if given; a round that settles nothing is
    then one of them.  Without a limit it is an error, since a step that
    settles nothing would go on for ever."""
    current, r = cut_lineage(deck), 0
    left = pending(current).count()
    while left and (rounds is None or r < rounds):
        current, before = cut_lineage(step(current, r)), left
        left = pending(current).count()
        if rounds is None and left >= before:
            raise ValueError(f"round {r} settled nothing: {left} rows are pending")
        r += 1
    return current


# SE-05 -- remaining <- problematic, repeated until no failures
def retry_rounds(remaining: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``attempt`` takes the remaining units and the round's number and
    returns them with ``ok`` and whatever it got for them; units that are not
    ok (false or null) remain for the next round.  Returns (results with
    ``round``, units that still remain after ``rounds``: none without a
    limit).  A round without any success is an error if there is no limit."""
    columns = remaining.columns
    left, done, r = cut_lineage(remaining, "remaining"), None, 0
    while rounds is None or r < rounds:
        if left.isEmpty():
            break
        tried = cut_lineage(attempt(left, r).withColumn("round", F.lit(r)), "attempt")
        ok = F.coalesce("ok", F.lit(False))
        good = tried.where(ok).drop("ok")
        if rounds is None and good.isEmpty():
            raise ValueError(f"round {r} settled nothing")
        done = good if done is None else done.unionByName(good)
        left = tried.where(~ok).select(*columns)
        r += 1
    if done is None:
        done = attempt(left, 0).where(F.lit(False)).withColumn("round", F.lit(0)).drop("ok")
    return done, left
