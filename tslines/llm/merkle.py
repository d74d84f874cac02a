"""A hash tree over a data set, and proofs that its rows are unchanged.

Every row is a leaf. Per group, leaves are ordered by key and every FAN_IN
consecutive nodes become their parent until one is left, the group's subroot;
subroots, ordered by group, go on the same way up to the root. A stored node row
holds its parent's id, its turn among the parent's children, and the digests of
its own children. Ids are arithmetic: the level above 56 bits, below them the
position of the node's first leaf (for the upper tree: of its first group), so
links need no lookup.

A recursive query then climbs from all leaves at once: each step joins the node
above, appends the siblings found there and folds the digest of the possibly
altered row with them. Steps are rows, so what a leaf carries along stays small;
one aggregate per leaf joins its siblings at the end. The query ends when no leaf
has a node above, after as many steps as the tree is high.

Positions come from range partitions and one offset per partition, so a large
group is spread like any other rows; what a group's rows need to know of it
(first position, size, number) is looked up by a join that knows large groups.

Defined cases: every column may be null. Rows without a key come first in their
group, the null group before all others. Rows with one key in one group follow
each other by their digest; repeated rows are leaves of their own (their digests
are equal, so any order of them gives the same tree). Empty and long texts are
values like others. Other columns are not read. No rows: no tree, no result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.llm import common
from tslines.operators import ordered, symbols

FAN_IN = 3
#: The columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: An id's level starts at this bit; levels of the tree over the groups start at UPPER.
LEVEL_BIT = 56
UPPER = 64


def _written(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    """Binary SHA-256 of a row: each value with its length in bytes, `-` for null."""
    return F.unhex(F.sha2(F.concat(*[_written(v) for v in values]), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(level: int, place: Column) -> Column:
    return F.lit(level << LEVEL_BIT) + place


def _above(level: int, place: Column, size: Column, fan_in: int) -> Column:
    """Id of the parent of the node that begins at `place`, null if `size` leaves have none."""
    wide = fan_in ** (level % UPPER + 1)
    return F.when(size > fan_in ** (level % UPPER), _node(level + 1, place - place % wide))


def _turn(level: int, place: Column, fan_in: int) -> Column:
    return F.call_function("div", place, F.lit(fan_in ** (level % UPPER))) % fan_in


def _linked(rows: DataFrame, level: int, groups: int, fan_in: int) -> DataFrame:
    """Add `up` and `turn` to nodes of one level of the trees of all groups.

    `place` is the position of a node's first leaf within its group. A group's
    only node of a level is linked into the tree over the groups.
    """
    up, number = _above(level, F.col("place"), F.col("size"), fan_in), F.col("number")
    inside = up.isNotNull()
    return (rows.withColumn("up", F.coalesce(up + F.col("base"), _above(UPPER, number, F.lit(groups), fan_in)))
            .withColumn("turn", F.when(inside, _turn(level, F.col("place"), fan_in))
                        .otherwise(_turn(UPPER, number, fan_in)).cast("int")))


def _parents(rows: DataFrame, level: int, keep: list[str]) -> DataFrame:
    """The nodes one level above the rows; children are in order, at most FAN_IN of them."""
    rows = rows.where(F.shiftright("up", LEVEL_BIT) == level)
    out = rows.groupBy(F.col("up").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "hash")))["hash"].alias("kids"),
        *[F.min(c).alias(c) for c in keep])
    return out.withColumn("hash", F.unhex(F.sha2(F.array_join(F.transform("kids", _hex), ""), 256)))


class Manifest:
    """A built tree: stored leaves and nodes, and the root's digest (hexadecimal)."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame | None, root: str | None):
        self.leaves, self.nodes, self.root = leaves, nodes, root


def _top(height: int, fan_in: int) -> int:
    """Levels above leaves that `height` of them need."""
    level = 0
    while fan_in ** level < height:
        level += 1
    return level


def build(rows: DataFrame, fan_in: int = FAN_IN) -> Manifest:
    """The tree over rows of (doc_id, source, leaf, altered): digests in binary form."""
    spark = rows.sparkSession
    rows = common.stage(rows.withColumn("uid", F.monotonically_increasing_id()), "leaves")
    placed = ordered.global_index(rows, ["source", "doc_id", "leaf", "uid"], "at").withColumn(
        "name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    groups = placed.groupBy("name").agg(F.min("at").alias("base"), F.count("*").alias("size"))
    # the name of the null group is the smallest, the others keep their order
    groups = common.stage(ordered.global_index(groups, ["name"], "number"), "groups")
    count, largest = groups.agg(F.count("*"), F.max("size")).first()
    if not count:
        return Manifest(rows.limit(0), None, None)
    known = groups.select(F.col("name").alias("symbol"), F.struct("base", "size", "number").alias("code"))
    leaves = symbols.encode(placed.drop("source"), "name", known, "group").select(
        "uid", "doc_id", "leaf", "altered", "at", "group.*")
    leaves = _linked(leaves.withColumn("place", F.col("at") - F.col("base")), 0, count, fan_in)
    leaves = common.stage(leaves.drop("at"), "linked")

    folder, schema = session.scratch(spark, "nodes"), None
    about = ["base", "size", "number", "place"]
    below, tops = leaves.withColumnRenamed("leaf", "hash"), []

    def stored(nodes: DataFrame, level: int) -> DataFrame:
        path = f"{folder}/level={level}"
        nodes.write.parquet(path)
        return spark.read.schema(nodes.schema).parquet(path)

    for level in range(1, _top(largest, fan_in) + 1):
        tops.append(below)
        below = stored(_linked(_parents(below, level, about), level, count, fan_in), level)
    tops.append(below)
    # the tree over the groups; each of its first children is the top of a group
    last = UPPER + _top(count, fan_in)
    below = None
    for level in range(UPPER + 1, last + 1):
        if below is None:
            below = tops[0].select("up", "turn", "hash", "number")
            for more in tops[1:]:
                below = below.unionByName(more.select("up", "turn", "hash", "number"))
            below = below.where(F.shiftright("up", LEVEL_BIT) == level)
        nodes = _parents(below, level, ["number"])
        place = F.col("id").bitwiseAND((1 << LEVEL_BIT) - 1)
        nodes = (nodes.withColumn("up", _above(level, place, F.lit(count), fan_in))
                 .withColumn("turn", _turn(level, place, fan_in).cast("int"))
                 .select("id", "kids", *[F.lit(None).cast("bigint").alias(c) for c in about if c != "number"],
                         "number", "hash", "up", "turn"))
        below = stored(nodes, level)
    if below is None:
        below = tops[-1]
    root = below.where("up is null").select(_hex(F.col("hash"))).first()[0]
    if largest == count == 1:
        return Manifest(leaves, None, root)
    schema = "id bigint, kids array<binary>, up bigint, turn int"
    return Manifest(leaves, spark.read.schema(schema).parquet(folder), root)


# A step appends the siblings of the node above; on the first level of the upper
# tree the climber's own place holds its group's subroot. Siblings are brought in
# order by the byte of their step before them.
CLIMB = """
WITH RECURSIVE climb (uid, doc_id, step, up, turn, folded, siblings, own) AS (
  SELECT uid, doc_id, 0, up, turn, altered, X'', leaf FROM {leaves}
  UNION ALL
  SELECT c.uid, CAST(NULL AS BIGINT), c.step + 1, n.up, n.turn,
         unhex(sha2(array_join(transform(n.kids, (h, i) ->
             lower(hex(if(i = c.turn, c.folded, h)))), ''), 256)),
         aggregate(filter(n.kids, (h, i) -> i <> c.turn), X'', (done, h) -> concat(done, h)),
         if(shiftright(n.id, {bit}) = {first_upper}, n.kids[c.turn], CAST(NULL AS BINARY))
  FROM climb c JOIN {nodes} n ON n.id = c.up)
SELECT max(doc_id) AS doc_id,
       max(if(step = 0, own, NULL)) AS leaf,
       max(if(step > 0, own, NULL)) AS subroot,
       unhex(sha2(lower(hex(aggregate(array_sort(collect_list(
           concat(unhex(lpad(hex(step), 2, '0')), siblings))), X'',
           (done, s) -> concat(done, substring(s, 2))))), 256)) AS proof,
       max(if(up IS NULL, folded, NULL)) AS folded
FROM climb GROUP BY uid
"""


def climb(tree: Manifest) -> DataFrame:
    """Per leaf: digests of leaf, subroot, proof and the folded root of the altered row."""
    spark = tree.leaves.sparkSession
    nodes = tree.nodes
    if nodes is None:
        nodes = spark.createDataFrame([], "id bigint, kids array<binary>, up bigint, turn int")
    # every step reads the nodes; in buckets by their id they need no shuffle
    name = f"merkle_nodes_{uuid.uuid4().hex}"
    nodes.write.bucketBy(session.default_partitions(spark), "id").format("parquet").saveAsTable(name)
    # every leaf is a row of every step, so rows cannot be limited; steps are, by Spark's
    # own setting, far above any tree's height
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return common.stage(spark.sql(CLIMB, leaves=tree.leaves, nodes=spark.table(name), bit=LEVEL_BIT,
                                      first_upper=UPPER + 1), "climbed")
    finally:
        spark.conf.set(limit, before)
        spark.sql(f"DROP TABLE {name}")


def verify(docs: DataFrame, altered: Column, fields=FIELDS, key: str = "doc_id",
           group: str = "source", fan_in: int = FAN_IN) -> DataFrame:
    """Proofs of all rows; `altered` is the digest of the row as it is found later."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(group).cast("string").alias("source"),
                       digest(*[F.col(f) for f in fields]).alias("leaf"), altered.alias("altered"))
    # most rows are unchanged; their digest is made once
    tree = build(rows.withColumn("altered", F.coalesce("altered", "leaf")), fan_in)
    root = F.lit(tree.root).cast("string")
    if tree.root is None:
        empty = docs.sparkSession.createDataFrame([], "doc_id bigint, leaf binary, subroot binary, "
                                                      "proof binary, folded binary")
    climbed = empty if tree.root is None else climb(tree)
    return climbed.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), F.coalesce(_hex(F.col("subroot")), root).alias("subroot"),
        root.alias("root"), _hex(F.col("proof")).alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root"),
        (_hex(F.col("folded")) == root).alias("verified"))


def tampered(fields=FIELDS) -> Column:
    """Digest of a row whose text lost its line ends, null if it keeps the same text.

    Rows with an even checksum of their id are concerned.
    """
    hit = (common.remainder(F.col("doc_id"), 2) == 0) & F.contains(F.col("text"), F.lit("\n"))
    cut = [F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in fields]
    return F.when(hit, digest(*cut))


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(common.table(spark, sf_dir, "documents"), tampered())


# crc32 of the decimal id: each byte goes in, then eight times the lowest bit goes out
MERKLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
           CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
           CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
           CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
    text,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                        ELSE c >> 1 END)) AS crc
  FROM documents),
h AS (
  SELECT doc_id, source, coalesce(crc % 2 = 0, false) AS hit,
    sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(replace(text, chr(10), '')), ':',
                                                                  replace(text, chr(10), '')) END)) AS cut
  FROM d),
leaves AS (
  SELECT *, CASE WHEN hit THEN cut ELSE leaf END AS altered,
    row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS uid,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp
  FROM h),
inner_nodes AS (
  SELECT grp, 0 AS k, pos, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT grp, k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM inner_nodes WHERE n > 1 GROUP BY grp, k, pos // 3, n),
subroots AS (SELECT grp, hash AS subroot, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS k, grp AS pos, n, subroot AS hash FROM subroots
  UNION ALL
  SELECT k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY k, pos // 3, n),
parts AS (
  SELECT grp, k, pos // 3 AS up, list(hash ORDER BY pos) AS kids FROM inner_nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, k, pos // 3, list(hash ORDER BY pos) FROM upper_nodes WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT uid, grp, grp AS tree, 0 AS k, pos, n, altered AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT uid, c.grp, CASE WHEN here THEN tree ELSE -1 END, CASE WHEN here THEN c.k + 1 ELSE 0 END,
         CASE WHEN here THEN c.pos // 3 ELSE c.grp END,
         CASE WHEN here THEN (c.n + 2) // 3 ELSE (SELECT max(s.n) FROM subroots s) END,
         CASE WHEN here THEN sha256(concat(array_to_string(kids[1:c.pos % 3], ''), folded,
                                           array_to_string(kids[c.pos % 3 + 2:], ''))) ELSE folded END,
         CASE WHEN here THEN concat(proof, array_to_string(kids[1:c.pos % 3], ''),
                                    array_to_string(kids[c.pos % 3 + 2:], '')) ELSE proof END
  FROM (SELECT *, n > 1 AS here FROM climb WHERE n > 1 OR tree >= 0) c
  LEFT JOIN parts p ON here AND p.grp = tree AND p.k = c.k AND p.up = c.pos // 3)
SELECT l.doc_id, l.leaf, s.subroot, r.hash AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = r.hash AS verified
FROM leaves l JOIN subroots s USING (grp)
JOIN climb c ON c.uid = l.uid AND c.tree = -1 AND c.n = 1
CROSS JOIN (SELECT hash FROM upper_nodes WHERE n = 1) r
"""
