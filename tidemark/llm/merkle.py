"""Merkle manifest of a table: a digest tree per group, one over the groups, proofs of all rows.

A node's digest is the sha256 of its children's digests, joined; three consecutive nodes of a
level have one parent. Per group the leaves are ranked (distributed, see `ranking`), and a
leaf's rank in base three tells its place in the tree: leaves that agree in all digits but
the last are siblings, and so on. So the tree is a nested-struct rollup: rank digits are
grouped away one after the other, from the last, and each grouping nests the child structs
in their parent. All digits of one block (3^6 leaves) are grouped within one exchange by
(group, block); the blocks' digests are the leaves of the next tier, until one block is left
per group. The groups' digests are ranked by group and rolled up in the same way.

Proofs go down the tiers. A block's row meets the one row with the proof of its own digest
by grouping on (group, block); `transform` opens the nested structs level by level and
writes, for every child, its siblings' digests to the left and to the right; one explode
gives the block's leaves, each with its whole proof. No join takes part, a hot group is many
blocks, and a row holds at most one block.

Edge cases: a null value is written `-` and differs from the empty text (`0:`); a null group
is a group and comes first; rows of equal or null ids are leaves of their own (null first,
then by digest); a lone leaf is its group's digest, with no siblings there; an empty table
has no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.ranking import ranked

ARITY = 3
LEVELS = 6  # levels per block: 729 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"


# ---------------------------------------------------------------- digests
def digest(text: Column) -> Column:
    """Lowercase hex sha256."""
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """A value as the digest reads it: `-` for null, else its UTF-8 length, `:` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[str] = FIELDS, **instead: Column) -> Column:
    """The digest of a row; `instead` replaces single fields."""
    return digest(F.concat(*[written(instead.get(f, F.col(f))) for f in fields]))


# ---------------------------------------------------------------- up
def height_of(n: Column) -> Column:
    """Levels above `n` leaves: how many powers of the arity, from the zeroth, are below it."""
    powers = F.array(*[F.lit(ARITY ** i) for i in range(40)])
    return F.size(F.filter(powers, lambda p: p < n))


def nested(nodes: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """(keys, block, height, node) of (keys, rank, height, node): blocks of ARITY ** levels
    nodes. A node without parent (its group's height is reached) stays what it is."""
    digits = [f"digit{i}" for i in range(levels)]
    rows = nodes.select(
        *keys, "height", F.floor(F.col("rank") / ARITY ** levels).cast("long").alias("block"),
        *[(F.floor(F.col("rank") / ARITY ** i) % ARITY).cast("byte").alias(d)
          for i, d in enumerate(digits)], "node").repartition(*keys, "block")
    for i, d in enumerate(digits):
        rows = rows.groupBy(*keys, "block", "height", *digits[i + 1:]).agg(
            F.array_sort(F.collect_list(F.struct(d, "node"))).alias("children"))
        children = F.transform("children", lambda c: c["node"])
        parent = digest(F.array_join(F.transform("children", lambda c: c["node"]["hash"]), ""))
        rows = rows.select(
            *keys, "block", "height", *digits[i + 1:],
            F.struct(F.when(F.col("height") > i, parent)
                     .otherwise(F.col("children")[0]["node"]["hash"]).alias("hash"),
                     children.alias("children")).alias("node"))
    return rows


def built(nodes: DataFrame, keys: list[str], levels: int) -> list[DataFrame]:
    """Stored tiers of blocks, from the leaves to one block per group."""
    tiers, left = [], nodes.agg(F.max("height")).first()[0] or 0
    while True:
        blocks = stored(nested(nodes, keys, levels))
        tiers.append(blocks)
        left -= levels
        if left <= 0:
            return tiers
        nodes = blocks.select(
            *keys, F.col("block").alias("rank"),
            F.greatest(F.col("height") - levels, F.lit(0)).alias("height"),
            F.struct(F.col("node")["hash"].alias("hash")).alias("node"))


# ---------------------------------------------------------------- down
def opened(node: Column, above: Column, height: Column, levels: int) -> Column:
    """array<struct<node, path>> of a block's leaves: `path` are the siblings' digests to the
    left and right, level by level from the leaf, ending with the block's own path `above`."""
    def below(level: int):
        def children(p: Column) -> Column:
            hashes = F.transform(p["node"]["children"], lambda c: c["hash"])

            def child(c: Column, at: Column) -> Column:
                sides = F.struct(
                    F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
                    F.array_join(F.slice(hashes, at + 2, F.lit(ARITY)), "").alias("right"))
                path = F.when(height > level, F.concat(F.array(sides), p["path"]))
                return F.struct(c.alias("node"), path.otherwise(p["path"]).alias("path"))
            return F.transform(p["node"]["children"], child)
        return children

    rows = F.array(F.struct(node.alias("node"), above.alias("path")))
    for level in reversed(range(levels)):
        rows = F.flatten(F.transform(rows, below(level)))
    return rows


def emitted(tiers: list[DataFrame], keys: list[str], tops: DataFrame, levels: int) -> DataFrame:
    """(keys, rank, node, path, top) of every leaf. `tops` has one row per group: (keys, path,
    top), the proof of the group's digest and what else its leaves are told."""
    rows = tops.withColumn("rank", F.lit(0).cast("long"))
    for blocks in reversed(tiers):
        told = rows.select(*keys, F.col("rank").alias("block"), F.struct("path", "top").alias("told"))
        met = (blocks.select(*keys, "block", F.struct("height", "node").alias("own"))
               .unionByName(told, allowMissingColumns=True).groupBy(*keys, "block")
               .agg(F.first("own", ignorenulls=True).alias("own"),
                    F.first("told", ignorenulls=True).alias("told")))
        leaves = opened(F.col("own")["node"], F.col("told")["path"], F.col("own")["height"], levels)
        rows = met.select(*keys, "block", F.col("told")["top"].alias("top"),
                          F.posexplode(leaves).alias("at", "leaf")).select(
            *keys, (F.col("block") * ARITY ** levels + F.col("at")).alias("rank"),
            F.col("leaf")["node"].alias("node"), F.col("leaf")["path"].alias("path"), "top")
    return rows


# ---------------------------------------------------------------- manifest
def manifest(leaves: DataFrame, group: str, leaf: str, order: list[str],
             levels: int = LEVELS) -> DataFrame:
    """The columns of `leaves` with `subroot` (the group's digest), `root` and `path`, the
    proof: per level from the leaf to the root the siblings' digests `left` and `right`."""
    kept = [c for c in leaves.columns if c != group]
    rows = leaves.select(F.col(group).alias("group"), F.struct(
        F.col(leaf).alias("hash"), F.struct(*kept).alias("row")).alias("node"), *[
            F.col(c).alias(f"order{i}") for i, c in enumerate(order)])
    placed = ranked(rows, ["group"], [f"order{i}" for i in range(len(order))])
    low = built(placed.select("group", "rank", height_of(F.col("total")).alias("height"), "node"),
                ["group"], levels)

    # the groups' digests are the leaves of the upper tree, which is one group
    subroots = low[-1].select(F.lit(0).alias("all"), F.struct(
        F.col("node")["hash"].alias("hash"), F.col("group").alias("group")).alias("node"))
    upper = ranked(subroots.withColumn("order0", F.col("node")["group"]), ["all"], ["order0"])
    high = built(upper.select("all", "rank", height_of(F.col("total")).alias("height"), "node"),
                 ["all"], levels)
    none = F.array().cast(STEPS)
    tops = high[-1].select("all", none.alias("path"), F.col("node")["hash"].alias("top"))
    groups = emitted(high, ["all"], tops, levels).select(
        F.col("node")["group"].alias("group"), "path",
        F.struct(F.col("node")["hash"].alias("subroot"), F.col("top").alias("root")).alias("top"))
    out = emitted(low, ["group"], groups, levels)
    return out.select(F.col("group").alias(group), F.col("node")["row"].alias("row"), "top", "path"
                      ).select(group, "row.*", "top.*", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text as a vandal leaves it: without line feeds where 2 divides the id's crc32."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of `docs`, and the roots that its rows give after tampering."""
    text = F.col("text").cast("string")
    leaves = docs.select("doc_id", "source", leaf_digest().alias("leaf"), leaf_digest(
        text=tampered(F.col("doc_id"), text)).alias("found"))
    proven = manifest(leaves, "source", "leaf", ["doc_id", "leaf"], levels)
    return proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("found"), F.col("path")).alias("folded_root")).withColumn(
            "verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir):
    """Digest, group digest, root, proof and verdict of every document."""
    return audit(table(spark, sf_dir, "documents"))


_WRITTEN = " || ".join(
    f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in FIELDS)

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLE_SQL = {"op11_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                       lambda d: ascii(d)::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))
    AS flipped
  FROM documents
),
leaves AS (
  SELECT doc_id, source, sha256({_WRITTEN}) AS leaf,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM crc
),
found AS (
  SELECT doc_id, sha256({_WRITTEN}) AS found
  FROM (SELECT * REPLACE (CASE WHEN (4294967295 - flipped) % 2 = 0 THEN replace(text, chr(10), '')
                               ELSE text END AS text) FROM crc)
),
tree AS (
  SELECT source, 0 AS lvl, idx, leaf AS hash, n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, lvl, idx // 3, n
),
subroots AS (
  SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS sidx,
         count(*) OVER () AS n
  FROM tree WHERE n = 1
),
uptree AS (
  SELECT 0 AS lvl, sidx AS idx, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3
  FROM uptree WHERE n > 1 GROUP BY lvl, idx // 3, n
),
runs AS (
  SELECT source, lvl, idx // 3 AS run, list(hash ORDER BY idx) AS hs
  FROM tree WHERE n > 1 GROUP BY source, lvl, idx // 3
),
upruns AS (
  SELECT lvl, idx // 3 AS run, list(hash ORDER BY idx) AS hs
  FROM uptree WHERE n > 1 GROUP BY lvl, idx // 3
),
steps AS (
  SELECT l.doc_id, 0 AS tree, r.lvl, r.hs, (l.idx // CAST(pow(3, r.lvl) AS BIGINT)) % 3 AS pos
  FROM leaves l JOIN runs r ON l.source IS NOT DISTINCT FROM r.source
                            AND r.run = l.idx // CAST(pow(3, r.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT l.doc_id, 1, r.lvl, r.hs, (s.sidx // CAST(pow(3, r.lvl) AS BIGINT)) % 3
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
                JOIN upruns r ON r.run = s.sidx // CAST(pow(3, r.lvl + 1) AS BIGINT)
),
sides AS (
  SELECT doc_id, tree, lvl, array_to_string(hs[1:pos], '') AS l,
         array_to_string(hs[pos + 2:], '') AS r
  FROM steps
),
paths AS (
  SELECT doc_id, list({{'l': l, 'r': r}} ORDER BY tree, lvl) AS path,
         string_agg(l || r, '' ORDER BY tree, lvl) AS siblings
  FROM sides GROUP BY doc_id
),
proven AS (
  SELECT d.doc_id, d.leaf, s.subroot, (SELECT hash FROM uptree WHERE n = 1) AS root,
         sha256(coalesce(p.siblings, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': f.found, 'r': ''}}, coalesce(p.path, [])),
                     lambda x, y: {{'l': sha256(y.l || x.l || y.r), 'r': ''}}).l AS folded_root
  FROM leaves d JOIN found f USING (doc_id) LEFT JOIN paths p USING (doc_id)
       JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT *, folded_root = root AS verified FROM proven"""}
