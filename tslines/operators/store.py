"""Landed rows, as numbered commits.

Rows lie in files below `root`; a file holds rows of one table and day, in time
order, and the files of a day do not overlap in time (files of one instant may
follow each other). A commit writes new files and a list of what it adds and takes
away, then claims the next number by moving a small manifest to its place, which
fails if another writer was first. What no manifest names does not exist: a killed
write is never seen, and a commit that is there already is not done again.

Late rows are merged: where the days of new rows have files, the time between and
in them is cut into intervals, each row finds its own by its minute, and only the
files that are hit are read and written anew. With `keys`, rows that are stored
already are left out and rows that differ from a stored one with the same keys and
instant take its place.

Nothing here is larger on the driver than the list of commits and of live files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines import session
from tslines.functions import times
from tslines.operators import land as rules

ATTEMPTS = 20
MINUTE = 60_000_000
DAY = 24 * 60 * MINUTE
_LIST = ("path string, tbl string, day date, first_us bigint, last_us bigint, n_rows bigint, "
         "live boolean, version bigint")


class Conflict(RuntimeError):
    """Other writers kept taking the number a commit needed."""


@dataclass(frozen=True)
class Commit:
    """What a manifest says: its number, the caller's name for it, the columns after it."""

    version: int
    name: str
    schema: T.StructType
    listing: str | None
    rejects: str


def history(spark: SparkSession, root: str) -> list[Commit]:
    """All commits in order; one small row for each reaches the driver."""
    if not session.exists(spark, _manifest(root, 0)):
        return []
    rows = spark.read.option("wholetext", True).text(f"{root}/_log/*.json").collect()
    found = [json.loads(r["value"]) for r in rows]
    return sorted((Commit(m["version"], m["commit"], T.StructType.fromJson(m["schema"]), m["listing"],
                          m["rejects"]) for m in found), key=lambda c: c.version)


def _manifest(root: str, version: int) -> str:
    return f"{root}/_log/{version:010d}.json"


def files(spark: SparkSession, root: str, log: list[Commit] | None = None) -> DataFrame:
    """Live files: `path` below `root`, `tbl`, `day`, first and last instant, rows."""
    log = history(spark, root) if log is None else log
    lists = [f"{root}/_lists/{c.listing}" for c in log if c.listing]
    if not lists:
        return spark.createDataFrame([], _LIST).drop("live", "version")
    rows = spark.read.schema(_LIST).parquet(*lists)
    about = [c for c in rows.columns if c not in ("path", "live", "version")]
    latest = rows.groupBy("path").agg(
        F.max_by(F.struct("live", *about), F.struct("version", ~F.col("live"))).alias("r"))
    return latest.select("path", "r.*").where("live").drop("live")


def touched(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Tables and days of a commit: files it wrote, and files it took away to write them anew."""
    commit = next(c for c in history(spark, root) if c.version == version)
    if not commit.listing:
        return spark.createDataFrame([], "tbl string, day date, written bigint, replaced bigint")
    rows = spark.read.schema(_LIST).parquet(f"{root}/_lists/{commit.listing}")
    return rows.groupBy("tbl", "day").agg(F.count_if("live").alias("written"),
                                          F.count_if(~F.col("live")).alias("replaced"))


def _read(spark, root, schema, live: DataFrame) -> DataFrame:
    paths = [f"{root}/{r['path']}" for r in live.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(paths))


def landed(spark: SparkSession, root: str, version: int | None = None, where: str | None = None) -> DataFrame:
    """All landed rows, or those of an earlier commit; columns that came later are NULL in older rows.

    `where` picks files by `tbl`, `day`, `first_us` and `last_us`; others are not opened.
    """
    log = [c for c in history(session.configure(spark), root) if version is None or c.version <= version]
    if not log:
        raise ValueError(f"nothing has landed below {root}")
    live = files(spark, root, log)
    return _read(spark, root, log[-1].schema, live.where(where) if where else live)


def _intervals(live: DataFrame) -> DataFrame:
    """Files and the gaps between them, per table and day, once for every minute they touch.

    Files of a day do not overlap, so there are at most as many rows as minutes,
    files and gaps.
    """
    order = Window.partitionBy("tbl", "day").orderBy("first_us", "last_us", "path")
    ranked = live.select("tbl", "day", "path", F.col("first_us").alias("low"), F.col("last_us").alias("high"),
                         F.row_number().over(order).alias("rank"), F.lead("first_us").over(order).alias("next"))
    begin = F.unix_micros(F.col("day").cast("timestamp"))
    own = ranked.select("tbl", "day", "path", "low", "high", (2 * F.col("rank")).alias("slot"))
    none = F.lit(None).cast("string")
    after = ranked.select("tbl", "day", none.alias("path"), (F.col("high") + 1).alias("low"),
                          (F.coalesce("next", begin + DAY) - 1).alias("high"), (2 * F.col("rank") + 1).alias("slot"))
    before = ranked.where("rank = 1").select("tbl", "day", none.alias("path"), begin.alias("low"),
                                             (F.col("low") - 1).alias("high"), F.lit(1).alias("slot"))
    every = own.unionByName(after).unionByName(before).where("low <= high")
    minute = F.sequence(F.call_function("div", F.col("low"), F.lit(MINUTE)),
                        F.call_function("div", F.col("high"), F.lit(MINUTE)))
    return every.withColumn("minute", F.explode(minute))


def _placed(rows: DataFrame, live: DataFrame, table: str, at: str) -> DataFrame:
    """Rows with `_slot` and, where a file holds their time, its `_path`.

    Rows of one instant that fills several files go to the first of them.
    """
    cells = _intervals(live).withColumnsRenamed({"tbl": "_tbl", "day": "_d", "path": "_path", "slot": "_slot"})
    us = times.micros(F.col(at))
    on = ((F.col(table) == F.col("_tbl")) & (F.call_function("div", us, F.lit(MINUTE)) == F.col("minute"))
          & us.between(F.col("low"), F.col("high")))
    hits = rows.select("_uid", table, at).join(cells, on).groupBy("_uid").agg(
        F.min(F.struct("_slot", "_path")).alias("_hit"), F.collect_set("_path").alias("_paths"))
    return rows.join(hits, "_uid", "left").select(
        *rows.columns, F.coalesce("_hit._slot", F.lit(0)).alias("_slot"),
        F.col("_hit._path").alias("_path"), F.coalesce("_paths", F.array().cast("array<string>")).alias("_paths"))


def _same(columns: list[str], one: str, other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in columns])


def _merged(spark, root, new: _Incoming, rows: DataFrame, stage):
    """Rows to write, with their `_slot`, and the paths of the files that they replace."""
    names = new.schema.names
    late = rows.where("_path IS NOT NULL")
    fresh = rows.where("_path IS NULL").select(*names, "_slot")
    hit = sorted(r[0] for r in late.select(F.explode("_paths")).distinct().collect())
    if not hit:
        return fresh, []
    stored = (spark.read.schema(new.schema).parquet(*[f"{root}/{p}" for p in hit])
              .select("*", _below(F.col("_metadata.file_path")).alias("_path")))
    changed = None
    if new.keys is not None:
        # what is stored already goes; what differs from its stored form replaces it
        both = [*new.keys, new.at]
        pairs = late.alias("n").join(stored.alias("o"), _same(both, "n", "o"), "left")
        known = F.col("o._path").isNotNull()
        late = stage(pairs.select("n.*", F.col("o._path").alias("_old"),
                                  (known & _same(names, "n", "o")).alias("_known")), "compared").where("NOT _known")
        changed = late.where("_old IS NOT NULL")
        affected = changed.select(F.col("_old").alias("_path")).union(late.select("_path"))
        late = late.dropDuplicates(["_uid"])
    else:
        affected = late.select("_path")
    affected = sorted(r[0] for r in affected.distinct().collect())
    if not affected:
        return fresh, []
    kept = stored.where(F.col("_path").isin(affected))
    if changed is not None:
        kept = _without(kept, changed.select(*both).distinct(), both)
    slots = rows.where("_path IS NOT NULL").select(F.col("_path").alias("_p"), "_slot").distinct()
    # a file that only loses rows keeps a place of its own
    own = (-F.abs(F.xxhash64("_path") % (1 << 30)) - 1).cast("int")
    kept = kept.join(slots, F.col("_path") == F.col("_p"), "left").withColumn("_slot", F.coalesce("_slot", own))
    return fresh.unionByName(late.select(*names, "_slot")).unionByName(kept.select(*names, "_slot")), affected


def _below(path: Column) -> Column:
    return F.regexp_extract(path, r"/(rows-[0-9a-f]{32}/.*)$", 1)


def _without(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Rows of `left` whose keys are not in `right`; NULL is a key like any other."""
    right = right.withColumnsRenamed({n: f"_other_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"_other_{n}")) for n in names]
    return left.join(right, reduce(lambda a, b: a & b, on), "left_anti")


def write_rows(rows: DataFrame, root: str, table: str, at: str) -> str:
    """Files of one table, day and slot each, in time order; returns their folder.

    Rows of one instant may be many (rows without one get that of the commit), so
    a second range column deals them out. Nothing names the folder yet.
    """
    folder = f"rows-{uuid.uuid4().hex}"
    parts = {"_t": F.sha1(F.col(table)), "_d": F.col("day"), "_s": F.col("_slot")}
    cols = [F.col("_t"), F.col("_d"), F.col("_s"), F.col(at)]
    names = [c for c in rows.columns if c != "_slot"]
    (rows.withColumns(parts).drop("_slot").withColumn("_salt", F.xxhash64(*names))
     .repartitionByRange(*cols, F.col("_salt")).sortWithinPartitions(*cols).drop("_salt")
     .write.partitionBy("_t", "_d", "_s").parquet(f"{root}/{folder}"))
    return folder


def _listing(spark, root, folder, new: _Incoming, gone: DataFrame, version: int) -> str:
    """Store the list of a commit: its files as they are, and those it takes away."""
    rows = spark.read.schema(new.schema).option("recursiveFileLookup", True).parquet(f"{root}/{folder}")
    us = times.micros(F.col(new.at))
    found = rows.groupBy(_below(F.col("_metadata.file_path")).alias("path")).agg(
        F.min(new.table).alias("tbl"), F.min("day").alias("day"), F.min(us).alias("first_us"),
        F.max(us).alias("last_us"), F.count("*").alias("n_rows"), F.lit(True).alias("live"))
    name = uuid.uuid4().hex
    (found.unionByName(gone.withColumn("live", F.lit(False))).withColumn("version", F.lit(version).cast("bigint"))
     .coalesce(1).write.parquet(f"{root}/_lists/{name}"))
    return name


def _claim(spark, root: str, commit: Commit) -> bool:
    """Move the manifest to its number; false if that number is taken."""
    body = {"version": commit.version, "commit": commit.name, "schema": commit.schema.jsonValue(),
            "listing": commit.listing, "rejects": commit.rejects}
    return session.claim(spark, json.dumps(body), f"{root}/_staged/{uuid.uuid4().hex}",
                         _manifest(root, commit.version))


def _apart(spark, root, ours: str | None, theirs: list[Commit]) -> bool:
    """Do other commits leave the tables and days of ours alone?"""
    lists = [f"{root}/_lists/{c.listing}" for c in theirs if c.listing]
    if not (ours and lists):
        return True
    mine = spark.read.schema(_LIST).parquet(f"{root}/_lists/{ours}").select("tbl", "day").distinct()
    return spark.read.schema(_LIST).parquet(*lists).join(mine, ["tbl", "day"], "left_semi").isEmpty()


def land(df: DataFrame, root: str, *, commit: str | None = None, table: str = "tbl", at: str = "at",
         keys: list[str] | None = None, arrival: str | None = None) -> DataFrame:
    """Land rows below `root` as one commit; returns the rejects of that commit.

    Columns are created by the first rows that have them, and keep their type and
    spelling. Values that would change are rejects, kept with the commit
    (`conform_rejects`); their rows do not land. Rows without an instant get the
    time of landing. A `commit` that is in the log changes nothing. With `keys`
    (column names, the instant is always one), of rows that agree in them the last
    arrival stays, in the frame (by `arrival`) as against what is stored.
    """
    spark = session.configure(df.sparkSession)
    commit = uuid.uuid4().hex if commit is None else str(commit)
    made: list[str] = []
    try:
        staged = None
        for _ in range(ATTEMPTS):
            log = history(spark, root)
            done = next((c for c in log if c.name == commit), None)
            if done:
                return _rejects(spark, root, done)
            known = log[-1].schema if log else None
            if staged is None or staged[0] != known:
                staged = (known, _Incoming.stage(df, root, known, table, at, keys, arrival, made))
            done = _attempt(spark, root, log, commit, staged[1], made)
            if done:
                return _rejects(spark, root, done)
    finally:
        session.discard(spark, *made)
    raise Conflict(f"commit {commit} found no number in {ATTEMPTS} attempts")


def _attempt(spark, root, log, commit, new: _Incoming, made: list[str]) -> Commit | None:
    """Write a commit on top of `log`; None if others changed what it builds on."""

    def stage(df, name):
        made.append(session.scratch(spark, name))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    rows = spark.read.schema(new.stored).parquet(new.path)
    days = rows.select(F.col(new.table).alias("tbl"), "day").distinct()
    every = files(spark, root, log)
    live = stage(every.join(days, ["tbl", "day"], "left_semi"), "live")
    placed = stage(_placed(rows, live, new.table, new.at), "placed")
    out, gone = _merged(spark, root, new, placed, stage)
    folder = write_rows(out, root, new.table, new.at)
    version = log[-1].version + 1 if log else 0
    listing = _listing(spark, root, folder, new, live.where(F.col("path").isin(gone)), version)
    while True:
        made_now = Commit(version, commit, new.schema, listing, new.rejects)
        if _claim(spark, root, made_now):
            return made_now
        newer = [c for c in history(spark, root) if c.version >= version]
        same_columns = log and newer[-1].schema == log[-1].schema
        if not same_columns or any(c.name == commit for c in newer) or not _apart(spark, root, listing, newer):
            return None
        version = newer[-1].version + 1
        listing = _renumbered(spark, root, listing, version)


def _renumbered(spark, root, listing: str, version: int) -> str:
    name = uuid.uuid4().hex
    (spark.read.schema(_LIST).parquet(f"{root}/_lists/{listing}").withColumn("version", F.lit(version).cast("bigint"))
     .coalesce(1).write.parquet(f"{root}/_lists/{name}"))
    return name


@dataclass(frozen=True)
class _Incoming:
    """Rows of a commit as they are stored for it, and the columns after it."""

    schema: T.StructType
    path: str
    rejects: str
    table: str
    at: str
    keys: list[str] | None

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_uid", T.LongType())])

    @staticmethod
    def stage(df, root, known, table, at, keys, arrival, made) -> _Incoming:
        spark = df.sparkSession
        df = rules.named(df, known)
        spelled = rules.spelling(df)
        missing = [c for c in (table, at, *(keys or ()), *([arrival] if arrival else ()))
                   if spelled(c) not in df.columns]
        if missing:
            raise ValueError(f"no column {missing}")
        table, at = spelled(table), spelled(at)
        if keys is not None:
            keys = [k for k in map(spelled, keys) if k != at]
            order = spelled(arrival) if arrival else "_arrival"
            some = df if arrival else df.withColumn("_arrival", F.lit(0))
            df = rules.dedup(some, keys, at, order).select(*df.columns)
        incoming = T.StructType([f for f in df.schema.fields if f.name != spelled("day")])
        schema = rules.evolve(known, incoming) if known else T.StructType(
            [*incoming.fields, T.StructField("day", T.DateType())])
        plain = df.select(*incoming.names)
        name = uuid.uuid4().hex
        rules.conform_rejects(plain, schema, table).write.parquet(f"{root}/_rejects/{name}")
        good = rules.stamp(rules.conform(plain, schema), at)
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
                  if f.name not in good.columns and f.name != "day"]
        good = good.withColumn("day", F.to_date(at)).select("*", *absent).select(*schema.names)
        made.append(session.scratch(spark, "incoming"))
        good.withColumn("_uid", F.monotonically_increasing_id()).write.parquet(made[-1])
        return _Incoming(schema, made[-1], name, table, at, keys)


def _rejects(spark, root, commit: Commit) -> DataFrame:
    return spark.read.parquet(f"{root}/_rejects/{commit.rejects}")
