"""Queries over progress rows and events, batch and streamed."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.time import day_of_millis, micros, truncated
from millrace.operators import activity as A
from millrace.operators.ranking import global_rank
from millrace.plans.checkpoints import shared_folder
from millrace.sources import corpus, read_table
from millrace.streaming import activity as S

GAP_SECONDS = 1800


def _progress(spark, sf_dir):
    return read_table(spark, sf_dir, "progress")


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def lww_latest(spark, sf_dir):
    return A.latest_by_key(_progress(spark, sf_dir).select("code", "kind", "item", "t", F.coalesce("v", F.lit(-1)).cast("int").alias("v")), ["code", "kind", "item"], ["t"], ["v"])


def arrival_upsert(spark, sf_dir):
    """Server-side state: the row that arrived last, whatever its own time."""
    rows = _progress(spark, sf_dir).select("code", "kind", "item", "arrived", "t", F.coalesce("v", F.lit(-1)).cast("int").alias("v"))
    mid = F.lit("2024-07-01").cast("timestamp_ntz")
    out = A.upsert(rows.where(F.col("arrived") < mid), rows.where(F.col("arrived") >= mid), ["code", "kind", "item"], "arrived")
    return out.select("code", "kind", "item", "t", "v")


def device_max_sum(spark, sf_dir):
    rows = _progress(spark, sf_dir).where((F.col("kind") == "study") & F.col("v").isNotNull())
    return A.device_max_sum(rows.select("code", "item", F.col("v").cast("bigint").alias("v")), ["item"], "code", "v")


def heartbeat_minutes(spark, sf_dir):
    return A.heartbeat_time(_events(spark, sf_dir), ["user_id"], "ts", "event_id", GAP_SECONDS)


def streak_days(spark, sf_dir):
    return A.day_streaks(_events(spark, sf_dir), ["user_id"], F.to_date("ts"))


def pool_advance(spark, sf_dir):
    """Pool size of each learner over the list of words, by the words they marked."""
    marks = _progress(spark, sf_dir).where(F.col("kind") == "mark").select("code", F.col("item").alias("word")).distinct()
    words = global_rank(read_table(spark, sf_dir, "senses").select("word").distinct(), [], ["word"], "rank")
    return A.pool_size(marks.join(words, "word", "left"), ["code"], "rank", words.agg(F.max("rank")), 100, 20)


def merged_items(spark, sf_dir):
    """Items a learner marked or reviewed, as one set."""
    rows = _progress(spark, sf_dir).where(F.col("kind").isin("mark", "review"))
    out = A.union_sets(rows, ["code"], "item", "kind")
    return out.select("code", F.size("merged").alias("n"), F.array_join("merged", ",").alias("items"))


def marks_by_day(spark, sf_dir):
    day = day_of_millis("t")
    return _progress(spark, sf_dir).groupBy("kind", day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


def daily_series(spark, sf_dir):
    return A.daily_series(_progress(spark, sf_dir), ["kind"], day_of_millis("t"))


def weekly_sums(spark, sf_dir):
    return A.moving_sum(marks_by_day(spark, sf_dir), ["kind"], "day", "n", 7, "week")


def month_totals(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return rows.groupBy(truncated("month", "ts").alias("month"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


def kind_counts(spark, sf_dir):
    return _progress(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("codes"))


def prefix_filter(spark, sf_dir):
    return _progress(spark, sf_dir).where((F.col("kind") == "study") & F.col("item").startswith("2025-0")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def minute_totals(spark, sf_dir):
    e = _events(spark, sf_dir).select(
        "user_id", F.to_date("ts").alias("day"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"),
        F.lit(1).cast("bigint").alias("beats"), F.get_json_object("props", "$.k").cast("bigint").alias("k"), "value",
    )
    return A.minute_totals(e, ["user_id", "day"], ["beats", "k"], ["value"], "minute")


def packed_log(spark, sf_dir):
    """Minute rows packed to `user|minute|a,b` and parsed again."""
    e = _events(spark, sf_dir)
    packed = e.groupBy("user_id", F.date_format("ts", "yyyyMMddHHmm").alias("mk")).agg(F.count(F.lit(1)).alias("n"), F.max(F.get_json_object("props", "$.k").cast("int")).alias("k"))
    lines = packed.select(F.concat_ws("|", F.col("user_id").cast("string"), "mk", F.concat_ws(",", "n", "k")).alias("item"))
    parts = F.split("item", r"\|")
    fields = F.transform(F.split(parts[2], ","), lambda x: x.cast("double"))
    return lines.select(parts[0].cast("bigint").alias("device"), F.to_timestamp(parts[1], "yyyyMMddHHmm").cast("timestamp_ntz").alias("minute"), fields[0].alias("c"), fields[1].alias("x"))


def _chunks(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        "user_id", truncated("day", "ts").alias("day"), F.pmod("event_id", F.lit(7)).alias("seq"), "event_id",
        F.concat(F.floor(micros("ts") / 1_000_000).cast("string"), F.lit(","), "event_type", F.lit("\n")).alias("part"),
    )
    return A.reassemble(rows, ["user_id", "day"], "seq", "part", "event_id")


def event_reassembly(spark, sf_dir):
    return _chunks(spark, sf_dir)


def event_timeline(spark, sf_dir):
    return A.timeline(_chunks(spark, sf_dir), ["user_id", "day"], "body").select("user_id", "day", "line_no", "offset", "event")


def percentiles(spark, sf_dir):
    q = [0.05, 0.25, 0.4, 0.5, 0.6, 0.75, 0.95]
    out = A.percentiles(_events(spark, sf_dir), "event_type", "value", {f"p{round(x * 100):02d}": x for x in q})
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


def search_rank(spark, sf_dir):
    e = read_table(spark, sf_dir, "entries_full").groupBy("word").agg(F.min("rank").alias("rank"), F.min("def").alias("def"))
    return A.search_rank(e, "st", "word", ["def"], "rank").select("word", "score", "rank")


def paged_rows(spark, sf_dir):
    rows = _progress(spark, sf_dir).select("code", "kind", "item", "t", F.coalesce("v", F.lit(-1)).cast("int").alias("v")).distinct()
    return corpus.pages_by_offset(rows.groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n")), ["kind", "item"], 100).groupBy("page").agg(
        F.count(F.lit(1)).alias("rows"), F.min("item").alias("least"), F.max("item").alias("most")
    )


def active_clock(spark, sf_dir):
    return heartbeat_minutes(spark, sf_dir).select("user_id", T.clock(F.col("active_us") / 1_000_000).alias("clock"))


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a file stream: its folder, or its one file picked by name from the data folder."""
    path = f"{sf_dir}/{table}.parquet"
    reader = spark.readStream.schema(read_table(spark, sf_dir, table).schema)
    if os.path.isfile(path):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def _run(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there now and give its output rows.

    State and rows go to the shared folder; no row passes the driver. A batch that is run again
    overwrites its own folder.
    """
    spark = stream.sparkSession
    home = f"{shared_folder(spark)}/millrace_{uuid.uuid4().hex}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/rows/batch={batch_id}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{home}/rows/batch=*")


def stream_minutes(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = _run(S.minute_buckets(rows, ["event_type"], "ts", "value"), "append")
    return out.select("event_type", F.col("minute").cast("timestamp_ntz").alias("minute"), "n", F.round("total", 6).alias("total"), "most")


def stream_sessions(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = _run(S.study_sessions(rows, ["user_id"], "ts", f"{GAP_SECONDS} seconds"), "append")
    return out.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first", "last")], "beats", "active_us")


def stream_latest(spark, sf_dir):
    rows = _stream(spark, sf_dir, "progress").select("code", "kind", "item", "t", F.coalesce("v", F.lit(-1)).cast("int").alias("v"))
    out = _run(S.latest_writes(rows, ["code", "kind", "item"], "t", "v"), "update")
    return A.latest_by_key(out, ["code", "kind", "item"], ["t"], ["v"])


_P = "progress"
_LWW = "SELECT code, kind, item, (m).t AS t, (m).v AS v FROM (SELECT code, kind, item, max({'t': t, 'v': CAST(coalesce(v, -1) AS INTEGER)}) AS m FROM progress GROUP BY ALL)"
_SESS = f"""WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {GAP_SECONDS} * 1000000 THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sess FROM g)"""
_CHUNK = """WITH r AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, event_id % 7 AS seq, event_id, epoch_us(ts) // 1000000 || ',' || event_type || chr(10) AS part FROM events),
l AS (SELECT user_id, day, seq, arg_max(part, event_id) AS p FROM r GROUP BY ALL), c AS (SELECT user_id, day, string_agg(p, '' ORDER BY seq) AS body, count(*) AS parts FROM l GROUP BY user_id, day)"""
_DAYS = "WITH d AS (SELECT kind, CAST(epoch_ms(t) AS DATE) AS day, count(*) AS n FROM progress WHERE t IS NOT NULL GROUP BY ALL)"

ORACLE = {
    "lww_latest": _LWW,
    "stream_latest": _LWW,
    "arrival_upsert": "SELECT code, kind, item, (m).t AS t, (m).v AS v FROM (SELECT code, kind, item, max({'a': arrived, 't': t, 'v': CAST(coalesce(v, -1) AS INTEGER)}) AS m FROM progress GROUP BY ALL)",
    "device_max_sum": "SELECT item, CAST(sum(m) AS BIGINT) AS total FROM (SELECT item, code, max(v) AS m FROM progress WHERE kind = 'study' AND v IS NOT NULL GROUP BY item, code) GROUP BY item",
    "heartbeat_minutes": f"""SELECT user_id, CAST(coalesce(sum(g) FILTER (g <= {GAP_SECONDS} * 1000000), 0) AS BIGINT) AS active_us, count(*) AS beats
FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events) GROUP BY user_id""",
    "streak_days": """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), r AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS s FROM d)
SELECT user_id, min(d) AS first_day, max(d) AS last_day, count(*) AS days FROM r GROUP BY user_id, s""",
    "pool_advance": """WITH w AS (SELECT word, CAST(row_number() OVER (ORDER BY word) AS INTEGER) AS rank FROM (SELECT DISTINCT word FROM senses)),
m AS (SELECT DISTINCT code, item FROM progress WHERE kind = 'mark'), c AS (SELECT DISTINCT code FROM m),
r AS (SELECT c.code, w.rank, sum(CASE WHEN m.item IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY c.code ORDER BY w.rank) AS l FROM c, w LEFT JOIN m ON m.code = c.code AND m.item = w.word)
SELECT code, coalesce(min(rank) FILTER (rank >= 100 AND (rank - 100) % 80 = 0 AND l > 20), max(rank)) AS pool, max(rank) AS listed FROM r GROUP BY code""",
    "merged_items": "SELECT code, CAST(count(*) AS INTEGER) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT code, item FROM progress WHERE kind IN ('mark', 'review')) GROUP BY code",
    "marks_by_day": "SELECT kind, CAST(epoch_ms(t) AS DATE) AS day, count(*) AS n FROM progress GROUP BY ALL",
    "daily_series": _DAYS + ", s AS (SELECT kind, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY kind) SELECT s.kind, s.day, coalesce(n, 0) AS n FROM s LEFT JOIN d ON s.kind = d.kind AND s.day = d.day",
    "weekly_sums": _DAYS + " SELECT kind, day, n, CAST(sum(n) OVER (PARTITION BY kind ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS week FROM d",
    "month_totals": "SELECT date_trunc('month', ts)::TIMESTAMP AS month, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "kind_counts": "SELECT kind, count(*) AS n, count(DISTINCT code) AS codes FROM progress GROUP BY kind",
    "prefix_filter": "SELECT item, count(*) AS n FROM progress WHERE kind = 'study' AND starts_with(item, '2025-0') GROUP BY item",
    "minute_totals": """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS beats, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k, max(value) AS value,
count(DISTINCT hour(ts) * 60 + minute(ts)) AS active, CAST(max(hour(ts) * 60 + minute(ts)) - min(hour(ts) * 60 + minute(ts)) + 1 AS INTEGER) AS span FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "packed_log": "SELECT user_id AS device, date_trunc('minute', ts)::TIMESTAMP AS minute, count(*)::DOUBLE AS c, max(CAST(props->>'$.k' AS INTEGER))::DOUBLE AS x FROM events GROUP BY 1, 2",
    "event_reassembly": _CHUNK + " SELECT * FROM c",
    "event_timeline": _CHUNK + """, x AS (SELECT user_id, day, unnest(range(len(string_split(body, chr(10))))) AS i, unnest(string_split(body, chr(10))) AS line FROM c)
SELECT user_id, day, CAST(i AS INTEGER) AS line_no, CAST(string_split(line, ',')[1] AS BIGINT) AS "offset", substr(line, instr(line, ',') + 1) AS event FROM x WHERE line <> ''""",
    "percentiles": "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {q}), 6) AS p{round(q * 100):02d}" for q in (0.05, 0.25, 0.4, 0.5, 0.6, 0.75, 0.95)) + " FROM events GROUP BY event_type",
    "search_rank": """WITH e AS (SELECT word, min(rank) AS rank, min(def) AS def FROM entries_full GROUP BY word), s AS (SELECT word, rank, CASE WHEN lower(word) = 'st' THEN 0 WHEN starts_with(lower(word), 'st') THEN 1
WHEN contains(lower(word), 'st') THEN 2 WHEN contains(lower(def), 'st') THEN 3 END AS score FROM e) SELECT word, score, rank FROM s WHERE score IS NOT NULL ORDER BY score, rank, word LIMIT 50""",
    "paged_rows": """WITH k AS (SELECT kind, item, row_number() OVER (ORDER BY kind, item) - 1 AS p FROM progress GROUP BY kind, item)
SELECT CAST(p // 100 AS INTEGER) AS page, count(*) AS rows, min(item) AS least, max(item) AS most FROM k GROUP BY 1""",
    "active_clock": f"""WITH h AS (SELECT user_id, CAST(coalesce(sum(g) FILTER (g <= {GAP_SECONDS} * 1000000), 0) // 1000000 AS BIGINT) AS s
FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events) GROUP BY user_id)
SELECT user_id, format('{{:d}}:{{:02d}}:{{:02d}}', s // 3600, s // 60 % 60, s % 60) AS clock FROM h""",
    "stream_minutes": """WITH m AS (SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS minute, count(*) AS n, round(sum(value), 6) AS total, max(value) AS most FROM events GROUP BY 1, 2)
SELECT * FROM m WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
    "stream_sessions": _SESS + f""", x AS (SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS beats, epoch_us(max(ts)) - epoch_us(min(ts)) AS active_us FROM s GROUP BY user_id, sess)
SELECT * FROM x WHERE last + INTERVAL {GAP_SECONDS} SECONDS <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
}

QUERIES = {
    f.__name__: f
    for f in (
        lww_latest, arrival_upsert, device_max_sum, heartbeat_minutes, streak_days, pool_advance, merged_items, marks_by_day, daily_series,
        weekly_sums, month_totals, kind_counts, prefix_filter, minute_totals, packed_log, event_reassembly, event_timeline,
        percentiles, search_rank, paged_rows, active_clock, stream_minutes, stream_sessions, stream_latest,
    )
}
