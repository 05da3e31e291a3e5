import datetime as dt

from vericorpus.operators import history
from vericorpus.streaming import history as stream


def test_attempts_arrive_once(spark, tmp_path):
    at = lambda n: dt.datetime(2024, 1, 1, n)
    rows = [(1, "c", "r", 0, "s", ["A line 1", "a line 2"], at(0), at(1)), (1, "c", "r", 0, "s", ["A line 1", "a line 2"], at(0), at(2)), (2, "c", "r", 1, None, None, None, at(3)), (3, "d", "q", 0, "t", ["b"], at(4), None)]
    source, path, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.createDataFrame(rows[:2], stream.STREAM_SCHEMA).write.mode("append").parquet(source)
    read = lambda: spark.readStream.schema(stream.STREAM_SCHEMA).parquet(source)
    stream.ingest(read(), path, mark).awaitTermination(120)
    spark.createDataFrame([rows[0], *rows[2:]], stream.STREAM_SCHEMA).write.mode("append").parquet(source)
    stream.ingest(read(), path, mark).awaitTermination(120)
    got = {r["history_id"]: r for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 3 and set(got) == {1, 2, 3}
    assert got[1]["errors"] == ["a"] and got[2]["errors"] == [] and got[2]["created_at"] == at(3) and got[3]["ingested_at"] is not None
    assert history.known_errors(spark.read.parquet(path)).count() == 2
