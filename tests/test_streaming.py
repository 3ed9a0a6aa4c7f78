import os

from pyspark.sql import functions as F

from deckspark.session import scratch_path
from deckspark.streaming import incremental as I


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def write_file(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf8") as f:
        f.write(text)


def test_stream_responses_first_file_wins(spark):
    src = local(scratch_path(spark, "t-src"))
    write_file(src, "a.jsonl", '{"idx": 1, "order": 0, "v": "first"}\n{"idx": 2, "order": 1, "v": "x"}\n')
    os.utime(os.path.join(src, "a.jsonl"), (1_000_000, 1_000_000))
    write_file(src, "b.jsonl", '{"idx": 1, "order": 0, "v": "late"}\n{"idx": 3, "order": 0, "v": "y"}\n')

    def parse(batch):
        return batch.select("file", F.from_json("value", "idx long, `order` long, v string").alias("r")).select("file", "r.*")

    out, ck, order = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck"), ["file", "order"]
    rows = I.stream_responses(spark, src, parse, out, ck, "idx", order)
    assert {r.idx: r.v for r in rows.collect()} == {1: "first", 2: "x", 3: "y"}
    # a later file adds what is new; a replay from the start changes nothing
    write_file(src, "c.jsonl", '{"idx": 3, "order": 0, "v": "z"}\n{"idx": 4, "order": 0, "v": "new"}\n')
    rows = I.stream_responses(spark, src, parse, out, ck, "idx", order)
    assert {r.idx: r.v for r in rows.collect()} == {1: "first", 2: "x", 3: "y", 4: "new"} and rows.count() == 4
    deck = spark.createDataFrame([(1, "old"), (9, "stays")], "idx long, v string")
    again = I.stream_responses(spark, src, parse, scratch_path(spark, "t-out"), scratch_path(spark, "t-ck"), "idx", order, deck=deck)
    assert {r.idx: r.v for r in again.collect()} == {1: "first", 9: "stays"}


def test_retry_state_stream(spark):
    src = local(scratch_path(spark, "t-retry"))
    write_file(src, "a.json", "\n".join([
        '{"task": 1, "ok": false, "err": "e1"}', '{"task": 1, "ok": false, "err": "e2"}',
        '{"task": 2, "ok": false, "err": "x"}', '{"task": 2, "ok": true, "err": null}',
        '{"task": 3, "ok": false, "err": "a"}', '{"task": 3, "ok": false, "err": "b"}',
        '{"task": 3, "ok": false, "err": "c"}', '{"task": 3, "ok": false, "err": "d"}',
    ]))
    stream = spark.readStream.schema("task long, ok boolean, err string").json(src)
    name = "retry_state_test"
    q = (I.retry_state_stream(stream, "task", "ok", "err", 3).writeStream.format("memory").queryName(name)
         .outputMode("update").option("checkpointLocation", scratch_path(spark, "t-rck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.task: (r.attempts, r.attempts_left, r.status, r.errors) for r in spark.table(name).collect()}
    assert got == {1: (2, 1, "retry", "e1;e2"), 2: (1, 2, "succeeded", "x"), 3: (4, 0, "failed", "a;b;c")}


def test_retry_state_batch_matches_stream_rule(spark):
    df = spark.createDataFrame(
        [(1, 1, False, "e1"), (1, 2, False, "e2"), (2, 1, False, "x"), (2, 2, True, None), (3, 1, False, "a"), (3, 2, False, "b"), (3, 3, False, "c"), (3, 4, False, "d")],
        "task long, t long, ok boolean, err string",
    ).withColumn("ts", F.timestamp_seconds("t"))
    got = {r.task: (r.attempts, r.attempts_left, r.status, r.errors) for r in I.retry_state(df, "task", "ts", "ok", "err", 3).collect()}
    assert got == {1: (2, 1, "retry", "e1;e2"), 2: (1, 2, "succeeded", "x"), 3: (4, 0, "failed", "a;b;c")}


def test_ingest_keeps_the_first_of_null_keys_and_replays(spark):
    src = local(scratch_path(spark, "t-src"))
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")

    def parse(batch):
        return batch.select("file", F.from_json("value", "idx long, `order` long, v string").alias("r")).select("r.*")

    def run():
        return sorted(((r.idx, r.order, r.v) for r in I.stream_responses(spark, src, parse, out, ck, "idx", "order").collect()), key=str)

    write_file(src, "a.jsonl", '{"idx": null, "order": 2, "v": "b"}\n{"idx": null, "order": 1, "v": "a"}\n{"idx": 7, "order": null, "v": "x"}\n{"idx": 7, "order": 0, "v": "y"}\n')
    first = run()
    assert first == [(7, None, "x"), (None, 1, "a")]
    write_file(src, "b.jsonl", '{"idx": null, "order": 0, "v": "late"}\n{"idx": 8, "order": 5, "v": "z"}\n')
    assert run() == sorted([*first, (8, 5, "z")], key=str)
    # the last batch is done again, as after a failure before its commit
    commits = os.path.join(local(ck), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    assert run() == sorted([*first, (8, 5, "z")], key=str)


def test_ingest_reads_no_earlier_output(spark, monkeypatch):
    """A batch costs what it holds: earlier rows are known to the state store,
    and the folders written before are not read by it."""
    src = local(scratch_path(spark, "t-src"))
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    parse = lambda b: b.select(F.from_json("value", "idx long, `order` long").alias("r")).select("r.*")
    write_file(src, "a.jsonl", '{"idx": 1, "order": 0}\n')
    I.stream_responses(spark, src, parse, out, ck)
    folder = local(out)
    for f in os.listdir(os.path.join(folder, "batch_id=0")):
        if f.endswith(".parquet"):
            with open(os.path.join(folder, "batch_id=0", f), "wb") as g:
                g.write(b"no table")  # whoever reads it fails
            crc = os.path.join(folder, "batch_id=0", f".{f}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    write_file(src, "b.jsonl", '{"idx": 1, "order": 0}\n{"idx": 2, "order": 0}\n')
    try:
        I.stream_responses(spark, src, parse, out, ck)
    except Exception:  # the returned table covers all batches; its schema may be read from any
        pass
    assert [r.idx for r in spark.read.parquet(out + "/batch_id=1").collect()] == [2]


def test_retry_state_stream_equals_batch(spark):
    """Errors that hold the separator, are empty or null; null tasks; two
    files, the later one with earlier events."""
    rows = [(1, 5, False, "a;b"), (1, 6, False, ""), (1, 7, False, "c"), (1, 8, False, "late"), (2, 1, True, None), (2, 2, False, None), (2, 3, False, "z"),
            (None, 1, False, "n"), (None, 2, True, "ok"), (3, 9, True, None)]
    early = [(1, 1, False, "first"), (2, 0, False, "zero"), (4, 1, False, ";")]
    schema = "task long, t long, ok boolean, err string"
    src = local(scratch_path(spark, "t-retry"))
    spark.createDataFrame(rows, schema).coalesce(1).write.json(src)
    out, ck = scratch_path(spark, "t-o"), scratch_path(spark, "t-c")

    def run():
        stream = spark.readStream.schema(schema).json(src)
        return I.latest_state(spark, I.retry_state_stream(stream, "task", "ok", "err", 3, ["t", "err"]), "task", out, ck)

    batch = lambda x: sorted((tuple(r) for r in I.retry_state(spark.createDataFrame(x, schema), "task", "t", "ok", "err", 3).collect()), key=str)
    assert sorted((tuple(r) for r in run().collect()), key=str) == batch(rows)
    spark.createDataFrame(early, schema).coalesce(1).write.mode("append").json(src)
    got = sorted((tuple(r) for r in run().collect()), key=str)
    assert got == batch(rows + early)
    assert {r[0]: r[4] for r in got}[1] == "first;a;b;"


def test_resume_stream_processes_each_file_once(spark):
    src, out, ck = (local(scratch_path(spark, f"t-{x}")) for x in ("src", "out", "ck"))
    write_file(src, "a.json", '{"v": 1}\n{"v": 2}\n')
    fn = lambda df: df.select((F.col("v") * 10).alias("w"))
    for _ in range(2):
        I.resume_stream(spark, src, I.T.StructType.fromDDL("v long"), out, ck, fn, fmt="json")
    write_file(src, "b.json", '{"v": 3}\n')
    I.resume_stream(spark, src, I.T.StructType.fromDDL("v long"), out, ck, fn, fmt="json")
    assert sorted(r.w for r in spark.read.parquet(out).collect()) == [10, 20, 30]


def test_cooldown_flags(spark):
    df = spark.createDataFrame(
        [(1, 0, "error"), (2, 5, "ok"), (3, 14, "ok"), (4, 15, "ok"), (5, 40, "ok"), (6, 50, "error"), (7, 64, "ok")],
        "id long, t long, kind string",
    ).withColumn("ts", F.timestamp_seconds("t"))
    got = {r.id: r.cooling for r in I.cooldown_flags(df, "id", "ts", F.col("kind") == "error", 15).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True, 7: True}


def test_rate_audit_stream_emits_closed_minutes(spark):
    src = local(scratch_path(spark, "t-rate"))
    lines = [f'{{"ts": "2024-01-01T00:0{m}:{s:02d}", "tokens": 10}}' for m in range(4) for s in (1, 30)]
    write_file(src, "a.json", "\n".join(lines))
    stream = spark.readStream.schema("ts timestamp, tokens long").json(src)
    name = "rate_audit_test"
    q = (I.rate_audit_stream(stream, "ts", "tokens", rpm=1, tpm=100).writeStream.format("memory").queryName(name)
         .outputMode("append").option("checkpointLocation", scratch_path(spark, "t-rate-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.table(name).collect()
    assert all(r.requests == 2 and r.tokens == 20 and r.over_limit for r in rows)
    # update mode gives the open minutes, too
    full = I.latest_state(spark, I.rate_audit_stream(stream, "ts", "tokens", rpm=1, tpm=100), "minute", scratch_path(spark, "t-o"), scratch_path(spark, "t-c"))
    assert full.count() == 4 and full.where("requests = 2 and tokens = 20 and over_limit").count() == 4


def test_iterate_stops_when_nothing_pending(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "i int, v string")
    calls = []

    def step(d, r):
        calls.append(r)
        first = d.where(F.col("v").isNull()).agg(F.min("i").alias("m"))
        return d.join(first, F.col("i") == F.col("m"), "left").withColumn("v", F.coalesce("v", F.when(F.col("m").isNotNull(), F.lit(f"r{r}")))).drop("m")

    out = I.iterate(df, step, lambda d: d.where(F.col("v").isNull()))
    assert {r.i: r.v for r in out.collect()} == {1: "r0", 2: "r1", 3: "x"}
    assert calls == [0, 1]
