import pytest
from pyspark.sql import functions as F

from tickloom.operators.events import route_records
from tickloom.schemas import KAFKA_RECORD
from tickloom.sinks.files import write_parquet
from tickloom.streaming import (
    batch_folder_sink,
    drain,
    landed_records,
    load_events,
    loaded_rows,
    new_rows,
)
from tickloom.streaming.events import decoded


def records(spark, first, last):
    rows = [
        (None, bytearray(f'{{"user_id":{i},"event":"login"}}', "utf-8"), "t", i % 3, i, None, 0)
        for i in range(first, last)
    ]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def land(spark, folder, first, last):
    records(spark, first, last).write.mode("append").parquet(folder)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("landing", "table", "checkpoint")]


def test_restart_loads_only_what_is_new(spark, folders):
    landing, table, checkpoint = folders
    land(spark, landing, 0, 400)

    def run():
        load_events(landed_records(spark, landing), batch_folder_sink(table), checkpoint).awaitTermination()
        return loaded_rows(spark, table)

    assert run().count() == 400
    assert run().count() == 400
    land(spark, landing, 400, 1000)
    loaded = run()
    assert loaded.count() == 1000
    assert loaded.select("topic", "partition", "offset").distinct().count() == 1000


def test_stream_equals_batch(spark, folders):
    landing, table, checkpoint = folders
    land(spark, landing, 0, 100)
    land(spark, landing, 100, 250)
    sink = batch_folder_sink(table)
    drain(route_records(landed_records(spark, landing, files_per_batch=3)), sink, checkpoint)
    batch = route_records(spark.read.schema(KAFKA_RECORD).parquet(landing))
    stored = loaded_rows(spark, table, key=("partition", "offset"))
    assert sorted(stored.collect()) == sorted(batch.collect())


def test_repeated_batch_replaces_itself(spark, folders):
    _, table, _ = folders
    sink = batch_folder_sink(table, unique_offsets=False)
    batch = decoded(records(spark, 0, 50))
    sink(batch.union(batch), 0)
    sink(batch, 0)
    sink(decoded(records(spark, 50, 60)), 1)
    assert loaded_rows(spark, table).count() == 60


def test_failure_of_a_batch_is_raised(spark, folders):
    landing, _, checkpoint = folders
    land(spark, landing, 0, 10)

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        drain(decoded(landed_records(spark, landing)), broken, checkpoint)


def test_only_unknown_messages_are_new(spark, folders):
    _, table, _ = folders
    write_parquet(decoded(records(spark, 0, 40)), table)
    stored = spark.read.parquet(table)
    batch = decoded(records(spark, 30, 50))
    found = new_rows(batch.union(batch), stored)
    assert sorted(r.offset for r in found.collect()) == list(range(40, 50))
    assert new_rows(batch.limit(0), stored).isEmpty()


def test_two_queries_load_into_one_table(spark, folders, tmp_path):
    landing, table, checkpoint = folders
    other = str(tmp_path / "other")
    land(spark, landing, 0, 300)
    records(spark, 0, 10).withColumn("topic", F.lit("u")).write.parquet(other)
    load_events(landed_records(spark, landing), batch_folder_sink(table), checkpoint).awaitTermination()
    load_events(landed_records(spark, other), batch_folder_sink(table), f"{checkpoint}-2").awaitTermination()
    counts = dict(loaded_rows(spark, table).groupBy("topic").count().collect())
    assert counts == {"t": 300, "u": 10}


def test_a_new_checkpoint_neither_loses_nor_doubles(spark, folders):
    landing, table, checkpoint = folders
    for first in range(0, 400, 100):
        land(spark, landing, first, first + 100)
        load_events(landed_records(spark, landing), batch_folder_sink(table), checkpoint).awaitTermination()
    load_events(landed_records(spark, landing), batch_folder_sink(table), f"{checkpoint}-2").awaitTermination()
    assert loaded_rows(spark, table).count() == 400
    assert loaded_rows(spark, table, key=None).count() == 800
