"""Operator 11 - Merkle manifest of a dataset over concatenated-level strings.

Every row is a leaf; leaves of one group (``lang``) form a tree in key order,
the groups' roots form a last tree, and each row gets the siblings that lead
from its leaf to the root.

* Numbering. Rows (keys and two digests, no text) are range-partitioned and
  sorted by (group, key, leaf, row number); a row's place in its group is its
  place in the partition plus the group's rows in earlier partitions, from one
  small aggregate. A group, or one key, that holds a third of all rows is
  spread over many partitions.
* Blocks. ``SPAN`` = 8 ^ ``DEPTH`` neighbouring nodes are an aligned block, one
  row. It keeps each of its levels as one hex string: fixed-width substrings
  (8 digests) of a level are hashed to the parents, which joined are the next
  level's string.
* Siblings. In a run of 8 the substrings on both sides of a node are its
  sibling segments.
* Recursion. The blocks' roots are the nodes of the next floor of blocks, until
  every group has one block: three floors hold 10^8 rows a group. Sibling
  segments are then handed down, one row per block, joined on the block.

No row of any table holds more than ``SPAN`` nodes; joins are on unique keys.

Defined results: null fields count as ``-``; null keys come first, rows of one
key are ordered by leaf (equal rows are leaves of their own, with places of
their own); a null group is a group, before all others; a single leaf is its
subroot and a single subroot the root; without siblings the proof is the empty
string; an empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgecast.llm import common as C
from surgecast.operators.joins import as_side

FAN = 8
DEPTH = 3
SPAN = FAN**DEPTH
DIGEST = 64  # hex characters
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_FLANKS = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """A field as it enters a leaf: ``-``, or UTF-8 length, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(fields: list[Column]) -> Column:
    return digest(F.concat(*[framed(f) for f in fields]))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with group ``g``) and ``idx``, the place in its group from 0,
    and ``n``, the group's rows."""
    keys = ["g", *order, "u"]
    rows = rows.withColumn("u", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.col("at")
    placed = C.cut(rows.drop("u").withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright(at, 33)).withColumn("at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    parts = placed.groupBy("g", "part").agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy("g")
    before = F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = C.cut(parts.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("lo")).alias("base"), F.sum("m").over(whole).alias("n")))
    return placed.join(as_side(parts, "places").for_join(), ["g", "part"]).withColumn("idx", F.col("at") + F.col("base")).drop("at", "part", "base")


def _levels_up(n: Column) -> Column:
    """Levels that a block of a group of n nodes is raised: until one node is
    left, at most DEPTH."""
    up = F.lit(0)
    for j in range(DEPTH):
        up = up + (n > F.lit(FAN**j)).cast("int")
    return up


def _runs(level: Column, nodes: Column) -> Column:
    """The level's string cut into strings of FAN digests."""
    width = FAN * DIGEST
    last = F.greatest(F.ceil(nodes / FAN).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda r: F.substring(level, r * width + 1, F.lit(width)))


def floor_of(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (g, idx, n, h, item): g, b, n, up, the items in
    order, the strings of levels 0 to DEPTH - 1, and the block's top node h."""
    order = F.array_sort(F.collect_list(F.struct("idx", "h", "item")))
    block = F.floor(F.col("idx") / SPAN).cast("long")
    rows = nodes.groupBy("g", block.alias("b")).agg(F.first("n").alias("n"), order.alias("x"))
    rows = rows.withColumn("up", _levels_up(F.col("n"))).withColumn("l0", F.array_join(F.transform("x", lambda e: e["h"]), ""))
    rows = rows.withColumn("x", F.transform("x", lambda e: e["item"]))
    for j in range(DEPTH):
        parents = F.array_join(F.transform(_runs(F.col(f"l{j}"), F.length(f"l{j}") / DIGEST), digest), "")
        rows = rows.withColumn(f"l{j + 1}", F.when(F.col("up") > j, parents))
    top = F.coalesce(*[F.col(f"l{j}") for j in range(DEPTH, -1, -1)])
    return rows.withColumn("h", top).drop(f"l{DEPTH}")


def pyramid(nodes: DataFrame) -> list[DataFrame]:
    """Floors of blocks, from the nodes up to one block per group."""
    floors = []
    while True:
        floor = C.cut(floor_of(nodes))
        floors.append(floor)
        if floor.where(F.col("n") > SPAN).isEmpty():
            return floors
        n = F.ceil(F.col("n") / SPAN).cast("long")
        nodes = floor.select("g", F.col("b").alias("idx"), n.alias("n"), "h", F.lit(None).cast("string").alias("item"))


def _flanks(runs: list[Column], up: Column, place: Column) -> Column:
    """Sibling segments of the node at ``place`` of level 0, level by level."""
    pairs, node = [], place.cast("int")
    for r in runs:
        run = F.get(r, F.floor(node / FAN).cast("int"))
        within = node % FAN
        pairs.append(F.struct(F.substring(run, F.lit(1), within * DIGEST).alias("left"), F.substring(run, (within + 1) * DIGEST + 1, F.lit(FAN * DIGEST)).alias("right")))
        node = F.floor(node / FAN).cast("int")
    return F.slice(F.array(*pairs), F.lit(1), up)


def hand_down(floors: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(item, h, flanks, ...): every node with its sibling segments up to the
    root. ``tops``: g, flanks above the group's root, and columns to carry."""
    carried = [c for c in tops.columns if c not in ("g", "flanks")]
    nodes = tops.withColumn("b", F.lit(0).cast("long"))
    runs = [F.col(f"r{j}") for j in range(DEPTH)]

    def node(item: Column, i: Column) -> Column:
        h = F.substring(F.get(runs[0], F.floor(i / FAN).cast("int")), (i % FAN) * DIGEST + 1, F.lit(DIGEST))
        return F.struct(i.alias("i"), item.alias("item"), h.alias("h"), _flanks(runs, F.col("up"), i).alias("own"))

    for floor in reversed(floors):
        rows = floor.drop("h").join(nodes, ["g", "b"])
        for j in range(DEPTH):
            level = F.coalesce(F.col(f"l{j}"), F.lit(""))
            rows = rows.withColumn(f"r{j}", _runs(level, F.length(level) / DIGEST))
        rows = rows.select("g", "b", "flanks", *carried, F.explode(F.transform("x", node)).alias("y"))
        place = F.col("b") * SPAN + F.col("y.i")
        flanks = F.concat("y.own", "flanks")
        nodes = rows.select("g", place.alias("b"), flanks.alias("flanks"), "y.item", "y.h", *carried)
    return nodes.drop("g", "b")


def fold(start: Column, flanks: Column) -> Column:
    """The root that ``start`` leads to with these siblings."""
    return F.aggregate(flanks, start, lambda acc, x: digest(F.concat(x["left"], acc, x["right"])))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", **extra: Column) -> DataFrame:
    """Per row: key, leaf, subroot, root, flanks (sibling segments from the
    leaf to the root: left and right of the node at each level), and the
    ``extra`` expressions over the row."""
    rows = docs.select(
        group_key(F.col(group)).alias("g"),
        F.col(key).alias("key"),
        leaf_of([F.col(f) for f in fields]).alias("h"),
        F.struct(F.col(key).alias("key"), *[v.alias(k) for k, v in extra.items()]).alias("item"),
    )
    floors = pyramid(numbered(rows, ["key", "h"]).select("g", "idx", "n", "h", "item"))
    subroots = floors[-1].select(F.lit("").alias("g"), "h", F.struct("g", F.col("h").alias("subroot")).alias("item"), F.col("g").alias("name"))
    upper = pyramid(numbered(subroots, ["name"]).select("g", "idx", "n", "h", "item"))
    last = upper[-1].select("h").first()
    tops = upper[-1].select("g", F.array().cast(_FLANKS).alias("flanks"), F.lit(last["h"] if last else "").alias("root"))
    tops = hand_down(upper, tops).select("item.*", "flanks", "root")
    found = hand_down(floors, tops)
    return found.select(F.col("item.key").alias(key), F.col("h").alias("leaf"), "subroot", "root", "flanks", *[F.col("item")[k].alias(k) for k in extra])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select(*FIELDS)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = [F.translate("text", upper, lower) if f == "text" else F.col(f) for f in FIELDS]
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest(docs, tampered=F.when(picked, leaf_of(changed)))
    proof = F.array_join(F.transform("flanks", lambda x: F.concat(x["left"], x["right"])), "")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("flanks"))
    found = found.select("doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 bit by bit: each byte is xored in, then eight shifts follow
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, rowid_,
    sha256(f_id || f_source || f_lang || f_chars || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(f_id || f_source || f_lang || f_chars || coalesce(strlen(low) || ':' || low, '-')) AS lowered,
    coalesce(xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 3 = 0, false) AS picked
  FROM (SELECT *, row_number() OVER () AS rowid_, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
      coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS f_id, coalesce(strlen(source) || ':' || source, '-') AS f_source,
      coalesce(strlen(lang) || ':' || lang, '-') AS f_lang, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS f_chars
    FROM documents)
), leaves AS (
  SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rowid_) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM d
), up AS (
  SELECT g, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY g, lvl, idx // 8, n
), subs AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS gi, count(*) OVER () AS gn FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, gi AS idx, gn AS n, subroot AS h FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n
), sib AS (
  SELECT g, lvl, idx, coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT g, lvl, idx, n, h FROM up UNION ALL SELECT '*', lvl, idx, n, h FROM top) WHERE n > 1
), walk AS (
  SELECT rowid_, g, 0 AS lvl, idx, CASE WHEN picked THEN lowered ELSE leaf END AS cur, '' AS proof FROM leaves
  UNION ALL
  SELECT w.rowid_, w.g, w.lvl + 1, w.idx // 8, sha256(s.l || w.cur || s.r), w.proof || s.l || s.r FROM walk AS w JOIN sib AS s USING (g, lvl, idx)
), mid AS (SELECT rowid_, g, cur, proof FROM walk QUALIFY row_number() OVER (PARTITION BY rowid_ ORDER BY lvl DESC) = 1
), walk2 AS (
  SELECT rowid_, 0 AS lvl, gi AS idx, cur, proof FROM mid JOIN subs USING (g)
  UNION ALL
  SELECT w.rowid_, w.lvl + 1, w.idx // 8, sha256(s.l || w.cur || s.r), w.proof || s.l || s.r FROM walk2 AS w JOIN sib AS s ON s.g = '*' AND s.lvl = w.lvl AND s.idx = w.idx
), fin AS (SELECT rowid_, cur, proof FROM walk2 QUALIFY row_number() OVER (PARTITION BY rowid_ ORDER BY lvl DESC) = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM leaves JOIN fin USING (rowid_) JOIN subs USING (g), (SELECT h AS root FROM top WHERE n = 1)
"""
