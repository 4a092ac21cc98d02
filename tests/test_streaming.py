from datetime import datetime

from pyspark.sql import functions as F

from plumbline.streaming.dedupe import hourly_counts, intake

SCHEMA = "id string, at timestamp, kind string"


def test_late_rows_and_repeats(spark, tmp_path):
    def drop(name, rows):
        spark.createDataFrame([(i, datetime(2024, 1, 1, h, m), k) for i, h, m, k in rows], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    drop("a", [("1", 1, 5, "x"), ("1", 1, 9, "x"), ("2", 1, 30, "x"), ("3", 2, 10, "y")])
    folder = str(tmp_path / "in" / "*")
    q = intake(spark, folder, SCHEMA, "at", ["id"], "1 hour").writeStream.format("memory").queryName("seen_once").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("seen_once").collect()) == ["1", "2", "3"]
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    q = hourly_counts(stream, "at", "kind").writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.h, r.kind): r.n for r in spark.table("hours").select(F.hour("window.start").alias("h"), "kind", "n").collect()}
    assert got == {(1, "x"): 3, (2, "y"): 1}
