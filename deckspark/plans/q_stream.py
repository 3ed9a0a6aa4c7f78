"""Queries for incremental / streaming operators (INC-*), AGG-08 and UDF-06."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as S
from ..operators import agg as G
from ..operators.scan import asof_join
from ..session import scratch_path
from ..streaming import incremental as I
from .catalog import query
from .views import V_LINE_SQL, V_NOTE_SQL, table, v_line, v_note

D = "decimal(18,6)"


@query("agg08_max_value", f"select max(idx) as max_idx, cast(max(rank) as bigint) as max_rank from {V_NOTE_SQL}")
def agg08a(spark, sf):
    n = v_note(spark, sf)
    return n.agg(F.max("idx").alias("max_idx"), F.max("rank").cast("bigint").alias("max_rank"))


@query("agg08_block_max", f"select cast(floor(idx) as bigint) as block, max(idx) as block_max from {V_NOTE_SQL} group by 1")
def agg08b(spark, sf):
    return G.block_max(v_note(spark, sf))


@query(
    "inc01_resume",
    f"""select doc_id, cast(count(*) as bigint) as n_lines from {V_LINE_SQL}
       where doc_id not in (select doc_id from labels) group by doc_id""",
)
def inc01(spark, sf):
    units = table(spark, sf, "documents").select("doc_id", "text")
    done = table(spark, sf, "labels").select("doc_id")

    def process(todo):
        return todo.select("doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))

    return I.resume(units, done, "doc_id", process)


@query(
    "inc01_resume_stream",
    f"select doc_id, cast(count(*) as bigint) as n_lines from {V_LINE_SQL} group by doc_id",
)
def inc01s(spark, sf):
    """Two runs over the same folder: the second, after more files have
    arrived, processes only those."""
    src, out, ckpt = (scratch_path(spark, f"units-{x}") for x in ("src", "out", "ckpt"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    first = F.col("doc_id") % 2 == 0

    def process(todo):
        return todo.select("doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))

    for part in (docs.where(first), docs.where(~first)):
        part.write.mode("append").parquet(src)
        I.resume_stream(spark, src, docs.schema, out, ckpt, process)
    return spark.read.parquet(out)


@query("inc02_stream_responses", "select conv_id as idx, min(turn) as turn from conversations group by conv_id")
def inc02(spark, sf):
    src = scratch_path(spark, "resp-src")
    out = scratch_path(spark, "resp-out")
    ckpt = scratch_path(spark, "resp-ckpt")
    c = table(spark, sf, "conversations")
    line = F.to_json(F.array(F.to_json(F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("turn"))), F.to_json(F.struct(F.col("text").alias("content")))))
    c.where(F.col("turn") < 2).select(line.alias("value")).write.text(src + "/b1")
    c.where(F.col("turn") >= 2).select(line.alias("value")).write.text(src + "/b2")

    def parse(batch):
        a = F.from_json("value", "array<string>")
        x = batch.select(a.alias("a"))
        return x.select(
            F.get_json_object(F.col("a")[0], "$.id").cast("bigint").alias("idx"),
            F.get_json_object(F.col("a")[0], "$.turn").cast("bigint").alias("turn"),
            F.get_json_object(F.col("a")[1], "$.content").alias("content"),
        )

    deck = c.select(F.col("conv_id").alias("idx"), F.lit(None).cast("bigint").alias("turn")).distinct()
    res = I.stream_responses(spark, src + "/*", parse, out, ckpt, key="idx", order=["turn"], deck=deck)
    return res.select("idx", "turn")


INC03_SQL = """with e as (select user_id, ts, event_id from events where event_type = 'error'),
            n as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from e),
            ae as (select user_id, string_agg(cast(event_id as varchar), ';' order by rn) as errors from n where rn <= 3 group by user_id),
            c as (select user_id, cast(count(*) filter (where event_type = 'error') as bigint) as attempts,
                         max(case when event_type <> 'error' then 1 else 0 end) = 1 as succeeded from events group by user_id)
       select c.user_id, c.attempts, cast(greatest(3 - c.attempts, 0) as bigint) as attempts_left,
              case when succeeded then 'succeeded' when attempts >= 3 then 'failed' else 'retry' end as status,
              coalesce(ae.errors, '') as errors
       from c left join ae on c.user_id = ae.user_id"""


@query(
    "inc03_retry_state",
    INC03_SQL,
)
def inc03(spark, sf):
    e = table(spark, sf, "events").withColumn("ok", F.col("event_type") != "error")
    return I.retry_state(e, "user_id", "ts", "ok", "event_id", 3)


@query(
    "inc03_retry_state_by_type",
    """with e as (select value, event_type, ts, event_id from events),
            n as (select *, row_number() over (partition by event_type order by ts, event_id) as rn from e where not (value >= 90)),
            ae as (select event_type, string_agg(cast(event_id as varchar), ';' order by rn) as errors from n where rn <= 3 group by event_type),
            c as (select event_type, cast(count(*) filter (where not (value >= 90)) as bigint) as attempts,
                         max(case when value >= 90 then 1 else 0 end) = 1 as succeeded from e group by event_type)
       select c.event_type, c.attempts, cast(greatest(3 - c.attempts, 0) as bigint) as attempts_left,
              case when succeeded then 'succeeded' when attempts >= 3 then 'failed' else 'retry' end as status,
              coalesce(ae.errors, '') as errors
       from c left join ae on c.event_type = ae.event_type""",
)
def inc03b(spark, sf):
    """Hot-key shape: five tasks (event types) share all rows, so each group
    holds about a fifth of the table; the error list stays bounded."""
    e = table(spark, sf, "events").withColumn("ok", F.col("value") >= 90)
    return I.retry_state(e, "event_type", "ts", "ok", "event_id", 3)


@query("inc03_retry_state_stream", INC03_SQL)
def inc03s(spark, sf):
    """The same bounded-retry state kept by a stateful stream: events are
    replayed as parquet files, a stateful processor keeps per-user counts and
    errors, and the last update per user is the result."""
    src = scratch_path(spark, "retry-src")
    out = scratch_path(spark, "retry-out")
    ckpt = scratch_path(spark, "retry-ckpt")
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", (F.col("event_type") != "error").alias("ok"))
    e.write.parquet(src)
    stream = spark.readStream.schema(e.schema).parquet(src)
    state = I.retry_state_stream(stream, "user_id", "ok", "event_id", 3, order=["ts", "event_id"])
    return I.latest_state(spark, state, "user_id", out, ckpt)


INC04_SQL = """select cast(epoch(date_trunc('minute', ts)) as bigint) as minute, cast(count(*) as bigint) as requests,
              cast(sum(cast(floor(value * 1000) as bigint)) as bigint) as tokens,
              count(*) > 1500 or sum(cast(floor(value * 1000) as bigint)) > 125000 as over_limit
       from events group by 1"""


@query("inc04_rate_audit", INC04_SQL)
def inc04(spark, sf):
    e = table(spark, sf, "events").withColumn("tokens", F.floor(F.col("value") * 1000).cast("bigint"))
    return I.rate_audit(e, "ts", "tokens")


@query(
    "inc05_cooldown_flags",
    """select x.event_id, exists (select 1 from events e where e.event_type = 'error'
                                  and epoch_us(e.ts) <= epoch_us(x.ts) and epoch_us(x.ts) < epoch_us(e.ts) + 15000000) as cooling
       from events x""",
)
def inc05(spark, sf):
    e = table(spark, sf, "events")
    return I.cooldown_flags(e, "event_id", "ts", F.col("event_type") == "error")


@query(
    "inc05_last_error",
    """select event_id, e.event_id as error_id from (
         select event_id, max(case when event_type = 'error' then struct_pack(ts := ts, event_id := event_id) end)
                          over (partition by user_id order by ts) as e from events)""",
)
def inc05l(spark, sf):
    """Each event with the last error of its user up to its time."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    errors = e.where("event_type = 'error'").select("user_id", "ts", "event_id")
    near = asof_join(e.select("event_id", "user_id", "ts"), errors, "ts", by="user_id", order="event_id")
    return near.select("event_id", F.col("event_id_r").alias("error_id"))


@query(
    "inc06_iterate",
    f"""with l as (select doc_id, pos, sentence as src, length(sentence) > 60 as pending0 from {V_LINE_SQL}),
            r as (select doc_id, pos, row_number() over (partition by doc_id order by pos) as k from l where pending0)
       select l.doc_id, l.pos,
              case when not l.pending0 then l.src
                   else case when ends_with(l.src, '"') then replace(l.src, '/', '.') || '.' else replace(l.src, '/', '.') end
              end as sentence
       from l left join r on l.doc_id = r.doc_id and l.pos = r.pos""",
)
def inc06(spark, sf):
    l = v_line(spark, sf).select(
        "doc_id", "pos", F.col("sentence").alias("src"),
        F.when(F.char_length("sentence") <= 60, F.col("sentence")).alias("sentence"),
    )

    def pending(df):
        return df.where(F.col("sentence").isNull())

    def step(df, r):
        # a round settles the pending lines of one residue, or all in the third
        turn = F.col("sentence").isNull() & ((F.col("pos") % 3 == r) | F.lit(r >= 2))
        return df.withColumn("sentence", F.when(turn, S.fix_sentence("src")).otherwise(F.col("sentence")))

    out = I.iterate(l, step, pending)
    return out.select("doc_id", "pos", "sentence")


@query(
    "inc06_iterate_rounds",
    f"""select doc_id, pos, case when length(sentence) <= 60 or pos % 3 < 2 then sentence end as sentence from {V_LINE_SQL}""",
)
def inc06r(spark, sf):
    """Three rounds: the last settles nothing and is a round like any other."""
    l = v_line(spark, sf).select("doc_id", "pos", F.col("sentence").alias("src"), F.when(F.char_length("sentence") <= 60, F.col("sentence")).alias("sentence"))

    def step(df, r):
        turn = F.col("sentence").isNull() & (F.col("pos") % 3 == r) & F.lit(r < 2)
        return df.withColumn("sentence", F.when(turn, F.col("src")).otherwise(F.col("sentence")))

    out = I.iterate(l, step, lambda df: df.where(F.col("sentence").isNull()), rounds=3)
    return out.select("doc_id", "pos", "sentence")


@query("inc04_rate_audit_stream", INC04_SQL)
def inc04s(spark, sf):
    """Event-time minutes with a watermark, update mode: the last update of
    every minute counts, open minutes included."""
    src = scratch_path(spark, "rate-src")
    out = scratch_path(spark, "rate-out")
    ckpt = scratch_path(spark, "rate-ckpt")
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.floor(F.col("value") * 1000).cast("bigint").alias("tokens"))
    e.write.parquet(src)
    stream = spark.readStream.schema(e.schema).parquet(src)
    return I.latest_state(spark, I.rate_audit_stream(stream, "ts", "tokens"), "minute", out, ckpt)
