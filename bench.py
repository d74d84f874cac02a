"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ROWS: rows of the generated frames (default 10,000,000), which are written
before the clock starts.
The encode and decode jobs read `lineitem` and `documents` from copies in
BENCH_CPUS files, made once and not timed, because the given file has a single row group and
would be read by one task. Each job runs `1 + BENCH_REPEAT` times against a
sink that drops the rows; the best run counts. `rates` gives cells and MiB of
line text per second.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from tslines import session
from tslines.catalog import batches, checks, flows, groups, landing
from tslines.operators import decode
from tslines.operators.encode import encode
from tslines.plans import roles
from tslines.sources import tables

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS = int(os.environ.get("BENCH_ROWS", "10000000"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))
COPIES = {}


def copy(spark, name, make):
    """A table that several runs share, written before the clock starts."""
    if name not in COPIES:
        COPIES[name] = session.scratch(spark, name)
        make().write.parquet(COPIES[name])
    return tables.parquet(spark, COPIES[name])


def lineitem(spark, version):
    df = copy(spark, "lineitem", lambda: tables.table(spark, SF, "lineitem").repartition(int(CPUS)))
    plan = roles.resolve(df, table="lineitem", symbols=["l_returnflag", "l_linestatus"],
                         at="l_shipdate", version=version)
    return df, plan


def encode_lineitem(version):
    def job(spark):
        df, plan = lineitem(spark, version)
        return encode(df, plan)
    return job


def frame(kind, version, **how):
    def job(spark):
        df = copy(spark, f"frame_{kind}", lambda: tables.synthetic(
            spark, ROWS, kind, partitions=2 * int(CPUS)).drop("id"))
        return encode(df, roles.resolve(df, table="t", at=roles.SERVER_TIME, version=version, **how))
    return job


def decode_lineitem(version):
    def job(spark):
        df, plan = lineitem(spark, version)
        lines = copy(spark, f"lines{version}", lambda: encode(df, plan).select("line"))
        return (decode.text_lines if version == 1 else decode.binary_lines)(lines)
    return job


def encode_documents(spark):
    df = copy(spark, "documents",
              lambda: tables.table(spark, SF, "documents").repartition(int(CPUS)))
    return encode(df, roles.resolve(df, table="docs", symbols=["lang", "source"],
                                    at=roles.SERVER_TIME, version=1))


def query(fn):
    return lambda spark: fn(spark, SF)


JOBS = {
    "encode_v1_lineitem": encode_lineitem(1),
    "encode_v2_lineitem": encode_lineitem(2),
    "frame_pairs_v1": frame("pairs", 1, symbols=["a"]),
    "frame_mixed_v2": frame("mixed", 2, symbols=["col1", "col5"]),
    "frame_escapes_v2": frame("escapes", 2, symbols=["col1", "col2", "col3"]),
    "frame_unicode_v2": frame("unicode", 2, symbols=False),
    "frame_integers_v2": frame("integers", 2),
    "decode_v1_lineitem": decode_lineitem(1),
    "decode_v2_lineitem": decode_lineitem(2),
    "encode_v1_documents": encode_documents,
    "rejects": query(checks.rejects),
    "batch_combined": query(batches.batch_combined),
    "batch_spread": query(batches.batch_spread),
    "batch_rows_global": query(batches.batch_rows_global),
    "land_dedup": query(landing.land_dedup),
    "symbol_encode": query(groups.symbol_encode),
    "burst_counts": query(groups.burst_counts),
    "burst_alerts": query(groups.burst_alerts),
    "event_sessions": query(groups.event_sessions),
    "slot_assign": query(groups.slot_assign),
    "payload_build": query(flows.payload_build),
    "payload_frames": query(flows.payload_frames),
    "stream_batches": query(flows.stream_batches),
    "stream_alerts": query(flows.stream_alerts),
}


def main() -> None:
    spark = session.get_spark("bench", master=f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times, rates = {}, {}
    only = os.environ.get("BENCH_ONLY")
    for name, job in JOBS.items():
        if only and name not in only.split(","):
            continue
        best = None
        if name.startswith(("encode", "decode", "frame")):
            job(spark)  # makes the copies
        for _ in range(1 + REPEAT):
            start = time.perf_counter()
            df = job(spark)
            df.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        if "n_bytes" in df.columns and name.startswith(("encode", "frame")):
            size = df.agg(F.count("*"), F.sum("n_bytes")).first()
            cells = {"encode_v1_lineitem": 11, "encode_v2_lineitem": 11, "frame_pairs_v1": 2,
                     "frame_mixed_v2": 5, "frame_escapes_v2": 6, "frame_unicode_v2": 5,
                     "frame_integers_v2": 6, "encode_v1_documents": 5}[name]
            rates[name] = {"cells_per_sec": int(size[0] * cells / best),
                           "mib_per_sec": round(size[1] / best / 2**20, 1)}
    found = re.search(r"sf([0-9.]+)", SF)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rates": rates,
                      "sf": float(found.group(1)) if found else SF}))


if __name__ == "__main__":
    main()
