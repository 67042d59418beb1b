from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from isobar.schemas import KEY, PRECIPITATION_SCHEMA
from isobar.sinks import counters
from isobar.sinks.files import Folder
from isobar.streaming.ingest import triggered
from readings import rows

SCHEMA, COUNTED = PRECIPITATION_SCHEMA, ["sum_precipitation"]


def delta(spark, **amounts):
    return spark.createDataFrame([(c, a) for c, a in amounts.items()], "city string, sum_precipitation double").withColumn(
        "datetime", F.timestamp_seconds(F.lit(0)))


def total(spark, path):
    return {r.city: r.sum_precipitation for r in counters.totals(spark, path, SCHEMA, KEY, COUNTED).collect()}


def test_a_replayed_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    add = lambda n, **amounts: counters.add(delta(spark, **amounts), path, n, KEY, COUNTED)
    assert total(spark, path) == {}
    assert add(0, A=1.0, B=2.0) and add(1, A=0.5) and add(1, A=0.25, C=4.0) and add(0, A=1.0, B=2.0)
    assert total(spark, path) == {"A": 1.25, "B": 2.0, "C": 4.0}
    counters.fold(spark, path, 0, SCHEMA, KEY, COUNTED)
    assert not add(0, A=100.0) and add(1, A=0.5)
    assert total(spark, path) == {"A": 1.5, "B": 2.0}
    counters.fold(spark, path, 1, SCHEMA, KEY, COUNTED)
    counters.fold(spark, path, 1, SCHEMA, KEY, COUNTED)
    counters.fold(spark, path, 0, SCHEMA, KEY, COUNTED)  # older: nothing to do
    add(2, B=1.0)
    assert total(spark, path) == {"A": 1.5, "B": 3.0}
    with pytest.raises(ValueError):
        add(-1, A=1.0)


def test_repeated_keys_and_nulls_in_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = delta(spark, A=1.0).union(delta(spark, A=2.0)).union(delta(spark, A=None)).union(delta(spark, B=None))
    counters.add(twice, path, 0, KEY, COUNTED)
    assert total(spark, path) == {"A": 3.0, "B": None}
    counters.add(twice.limit(0), path, 1, KEY, COUNTED)
    counters.add(delta(spark, B=5.0), path, 2, KEY, COUNTED)
    assert total(spark, path) == {"A": 3.0, "B": 5.0}


@pytest.mark.parametrize("at", ["before the fold is complete", "before the batches go"])
def test_an_interrupted_fold(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    for n in range(4):
        counters.add(delta(spark, A=1.0), path, n, KEY, COUNTED)
    if at == "before the batches go":
        monkeypatch.setattr(Folder, "remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            counters.fold(spark, path, 2, SCHEMA, KEY, COUNTED)
        monkeypatch.undo()
    else:
        (tmp_path / "t" / "folded" / "through=2").mkdir(parents=True)  # no mark of success
    assert total(spark, path) == {"A": 4.0}
    counters.fold(spark, path, 2, SCHEMA, KEY, COUNTED)
    assert total(spark, path) == {"A": 4.0}
    assert Folder(spark, f"{path}/ledger").directories("batch=") == ["batch=3"]


def test_a_stream_that_fails_after_counting(spark, tmp_path):
    source, path, fail = str(tmp_path / "source"), str(tmp_path / "t"), [True]

    def run():
        def store(batch, number):
            counters.add(batch, path, number, KEY, COUNTED)
            if number == 1 and fail.pop():
                raise RuntimeError("driver lost")

        stream = spark.readStream.schema(SCHEMA).parquet(source)
        triggered(stream.writeStream.foreachBatch(store).option("checkpointLocation", str(tmp_path / "cp")), None).start().awaitTermination()

    for n in range(3):
        delta(spark, A=1.0, B=float(n)).write.mode("append").parquet(source)
        if n == 1:
            with pytest.raises(Exception, match="driver lost"):
                run()
            fail.append(False)
        run()
    assert total(spark, path) == {"A": 3.0, "B": 3.0}
    assert rows(counters.totals(spark, path, SCHEMA, KEY, COUNTED).select(F.count("*"))) == [(2,)]
