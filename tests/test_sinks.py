import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from sparkmart.session import scratch_dir
from sparkmart.sinks.files import write_parquet
from sparkmart.streaming.sinks import BatchFolderSink, WindowReport, read_totals


def test_scratch_output_under_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def test_partitioned_write(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x int, p string")
    path = write_parquet(df, spark, "part_test", partition_by=["p"])
    back = spark.read.parquet(path)
    assert rows(back.filter(F.col("p") == "a"), "x") == [(1,), (3,)]


def test_window_report_skips_empty_batches_and_replays_idempotently(spark, tmp_path):
    empty = spark.createDataFrame([], "window struct<start:timestamp,end:timestamp>, running_total long")
    rep = WindowReport(str(tmp_path / "r"))
    rep(empty, 0)
    assert not (tmp_path / "r").exists() and not (tmp_path / "r_totals").exists()
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([((t, t + dt.timedelta(minutes=1)), 4)],
                                  "window struct<start:timestamp,end:timestamp>, running_total long")
    rep(batch, 1)
    rep(batch, 1)  # a replayed batch replaces its own output
    out = spark.read.parquet(str(tmp_path / "r"))
    assert rows(out, "batch_id", "running_total") == [(1, 4)]
    assert rows(read_totals(spark, str(tmp_path / "r")), "batch_id", "windows", "total") == [(1, 1, 4)]


def test_batch_folder_sink(spark, tmp_path):
    sink = BatchFolderSink(str(tmp_path / "k"))
    df = spark.createDataFrame([("a", 2)], "key string, event_count long")
    sink(df, 0)
    sink(df, 0)
    assert spark.read.parquet(str(tmp_path / "k")).count() == 1


def test_window_report_can_print(spark, tmp_path, capsys):
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([((t, t + dt.timedelta(minutes=1)), 4)],
                                  "window struct<start:timestamp,end:timestamp>, running_total long")
    WindowReport(str(tmp_path / "r"), show=True)(batch, 3)
    out = capsys.readouterr().out
    assert "windows" in out and "running_total" in out
