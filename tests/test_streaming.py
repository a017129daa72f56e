from datetime import datetime, timedelta

from inkframe.streaming.events import latest_by_key, read_events, windowed_counts


def test_streams(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [(i, t + timedelta(minutes=i), "ab"[i % 2], float(i)) for i in range(180)]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp, k string, v double")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    src = read_events(spark, str(tmp_path / "in"), df.schema)
    q = windowed_counts(src, "ts", "k", "v").writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.start, r.k, r.n) for r in spark.sql("select * from w").collect()) == sorted((t + timedelta(hours=h), k, 30) for h in range(3) for k in "ab")
    q = latest_by_key(src, "k", "id", "v").writeStream.outputMode("update").format("memory").queryName("l").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.k: (r.id, r.v) for r in spark.sql("select * from l").collect()} == {"a": (178, 178.0), "b": (179, 179.0)}
