"""Files of payloads: one for each, all of a commit or none."""

import os

import pytest
from pyspark.sql import functions as F

from tslines.sources import payload_files, payloads

ROWS = [(k, i, f"{k} x={i}i\n".encode() * (i + 1)) for k in ("a", "b/ü", None) for i in range(4)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k string, batch_id bigint, payload binary").repartition(3)


def stored(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs
                  if f.endswith(payload_files.SUFFIX))


def test_a_file_for_each_payload(spark, tmp_path):
    path = f"{tmp_path}/out"
    payload_files.write(frame(spark), path, 1, "k")
    payload_files.write(frame(spark), path, 1, "k")
    payload_files.write(frame(spark, ROWS[:2]), path, "b/2", "k")
    assert len(stored(path)) == len(ROWS) + 2
    got = payload_files.read(spark, path).where("commit = '1'").collect()
    assert sorted(bytes(r["payload"]) for r in got) == sorted(r[2] for r in ROWS)
    assert len({r["name"] for r in got}) == len(ROWS) and all(r["n_bytes"] == len(r["payload"]) for r in got)
    assert {r["commit"] for r in payload_files.read(spark, path).collect()} == {"1", "b%2F2"}


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = f"{tmp_path}/out"

    @F.udf("binary")
    def fails(i, body):
        if i == 3:
            raise ValueError("stop here")
        return body

    bad = frame(spark).withColumn("payload", fails("batch_id", "payload"))
    with pytest.raises(Exception, match="stop here"):
        payload_files.write(bad, path, 7, "k")
    assert not os.path.exists(f"{path}/commit=7")
    payload_files.write(frame(spark), path, 7, "k")
    assert len(stored(path)) == len(ROWS) and not os.listdir(f"{path}/_staged")


def test_fan_out_to_files(spark, tmp_path):
    sinks = [lambda df, n=n: payload_files.write(df, f"{tmp_path}/{n}", 0, "k") for n in range(2)]
    payloads.fan_out(frame(spark), sinks)
    one, two = (sorted(map(str, payload_files.read(spark, f"{tmp_path}/{n}").collect())) for n in range(2))
    assert one == two and len(one) == len(ROWS)
    payload_files.write(frame(spark, []), f"{tmp_path}/none", 0, "k")
    assert stored(f"{tmp_path}/none") == []
