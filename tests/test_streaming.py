from pyspark.sql import functions as F

from millrace.plans.activity_queries import _run
from millrace.streaming import activity as S


def test_latest_writes_follow_event_time(spark, tmp_path):
    for i, data in enumerate([[("k", 5, 1), ("k", 4, 9)], [("k", 3, 7), ("l", 1, 2)], [("k", 6, 0)]]):
        spark.createDataFrame(data, "k string, t bigint, v int").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema("k string, t bigint, v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = _run(S.latest_writes(stream, ["k"], "t", "v"), "update")
    last = {r["k"]: (r["t"], r["v"]) for r in out.groupBy("k").agg(F.max("t").alias("t"), F.max_by("v", "t").alias("v")).collect()}
    assert last == {"k": (6, 0), "l": (1, 2)}
    assert out.where("k = 'k' and t = 3").count() == 0


def test_upsert_batches(spark):
    table = {}
    merge = S.upsert_batches(["k"], ["t"], lambda d: table.update(rows=[tuple(r) for r in d.collect()]), lambda: spark.createDataFrame(table["rows"], "k string, t int, v int") if table else None)
    merge(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, t int, v int"), 0)
    merge(spark.createDataFrame([("a", 2, 5)], "k string, t int, v int"), 1)
    assert sorted(table["rows"]) == [("a", 2, 5), ("b", 1, 1)]
