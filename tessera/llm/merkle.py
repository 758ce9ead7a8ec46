"""Merkle manifest of a table by slot pivots: digests, inclusion proofs and their check.

A row is a leaf. Within a group (a language), leaves stand in the order of their
key; every ``FANOUT`` consecutive nodes have one parent until one node is left,
the root of the group. The group roots are the leaves of one more tree.

* **Up.** A level is one ``groupBy(group, position / FANOUT)`` whose conditional
  aggregates spread the children of a parent into ``FANOUT`` slot columns; the
  hash of the columns side by side is the parent. Each level is written once and
  has an eighth of the rows of the one below, so all levels together are a
  seventh of the leaves, and their number is the logarithm of the largest group.
* **Down.** A child's siblings are its parent's slot columns without its own
  slot, cut there into a left and a right part. From the root down, a parent's
  path is joined to its slot columns, which yields the paths of its children: a
  join on (group, position), of an eighth of the leaves at the widest.

A hot group is spread, as all keys hold the position. Nothing but the number of
groups and the size of the largest one comes to the driver. Digests travel as 32
bytes and are hashed as hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import dense_index
from tessera.llm.common import sized, staged

FANOUT = 8
_PATH = "array<struct<l:binary,r:binary>>"


def _hash(digests: Column) -> Column:
    """Digest of the hex text of digests set side by side."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def _text(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    """Digest of a row: the hash of its fields."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def _above(n: int) -> int:
    return -(-n // FANOUT)


def _side_by_side(first: int, end: int) -> str:
    """SQL of the digests in some slots of a parent, empty slots left out."""
    return "concat(" + ", ".join(["X''"] + [f"coalesce(c{i}.digest, X'')" for i in range(first, end)]) + ")"


def grow(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Levels over ``(gid, at, n, child)``, lowest first: ``(gid, at, n, c0.., digest)``, ``n`` nodes in the group."""
    levels = []
    while largest > 1:
        slots = [F.expr(f"max(CASE WHEN at % {FANOUT} = {i} THEN child END) AS c{i}") for i in range(FANOUT)]
        up = (nodes.where("n > 1").groupBy("gid", F.expr(f"at div {FANOUT}").alias("at"))
              .agg(F.max(F.expr(f"(n + {FANOUT - 1}) div {FANOUT}")).alias("n"), *slots))
        levels.append(staged(up.withColumn("digest", _hash(F.expr(_side_by_side(0, FANOUT)))), "merkle-level"))
        nodes = levels[-1].select("gid", "at", "n", F.struct("digest").alias("child"))
        largest = _above(largest)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``(gid, digest)`` of the one node that remains of each group."""
    out = nodes.where("n = 1").select("gid", F.col("child.digest").alias("digest"))
    for level in levels:
        out = out.unionByName(level.where("n = 1").select("gid", "digest"))
    return out


def _children(level: DataFrame, carried: list[str]) -> DataFrame:
    """A row per child of a level: its path is its siblings at this level, then its parent's path."""
    rows = ", ".join(
        f"struct(at * {FANOUT} + {i} AS at, c{i} AS child, "
        f"concat(array(struct({_side_by_side(0, i)} AS l, {_side_by_side(i + 1, FANOUT)} AS r)), path) AS path)" for i in range(FANOUT))
    return level.select("gid", *carried, F.expr(f"inline(array({rows}))")).where("child IS NOT NULL")


def paths(nodes: DataFrame, levels: list[DataFrame], roots: DataFrame, carried: list[str]) -> DataFrame:
    """``(gid, at, child, path)`` of every node, and the ``carried`` columns of its group's row in ``roots``."""
    roots = sized(roots.select("gid", "path", *carried))
    known = None
    for k, level in reversed(list(enumerate(levels))):
        ends = level.where("n = 1").select("gid", "at").join(roots, "gid")
        known = ends if known is None else known.unionByName(ends)
        held = _children(level.drop("n", "digest").join(known, ["gid", "at"]), carried)
        known = staged(held.drop("child"), "merkle-paths") if k else None
    alone = nodes.where("n = 1").select("gid", "at", "child").join(roots, "gid")
    return alone if not levels else held.unionByName(alone.select(held.columns))


def fold(start: Column, path: Column) -> Column:
    """Root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda at, p: _hash(F.concat(p["l"], at, p["r"])))


def manifest(df: DataFrame, columns: list[str], group: str, key: str, claimed: dict[str, Column] | None = None) -> DataFrame:
    """Digests and proof of every row, and the check of its ``claimed`` values against the root.

    ``claimed`` gives other values for some columns, as a receiver might hold
    them; the proof is folded from those. Returns ``key``, ``leaf``, ``subroot``
    (of its group), ``root``, ``proof_sha256`` (over all siblings, from the leaf
    up), ``folded_root`` and ``verified``.

    Groups are ordered by the UTF-8 bytes of their name, null first; leaves by
    key, null first, and rows of one key by digest, so repeated rows are leaves
    like any other. A group of one leaf has that leaf as its root, a table of
    one group that group's root. An empty table gives no rows. Null, empty and
    very long values are hashed whole; other columns of the table, whatever
    their names, are ignored.
    """
    claimed = claimed or {}
    leaves = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("__group"), F.col(key).alias("__key"),
        leaf([F.col(c) for c in columns]).alias("__leaf"), leaf([claimed.get(c, F.col(c)) for c in columns]).alias("__claim"))
    numbered = dense_index(staged(leaves, "merkle-leaves"), ["__group", "__key", "__leaf", "__claim"], "__at")
    sizes = numbered.groupBy("__group").agg(F.min("__at").alias("__first"), F.count("*").alias("n"))
    groups = staged(dense_index(sizes, ["__group"], "gid"), "merkle-groups")
    count, largest = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    nodes = staged(numbered.join(sized(groups), "__group").select(
        "gid", (F.col("__at") - F.col("__first")).alias("at"), "n",
        F.struct(F.col("__leaf").alias("digest"), F.col("__key").alias("key"), F.col("__claim").alias("claim")).alias("child")), "merkle-nodes")
    levels = grow(nodes, largest)
    subroots = staged(tops(nodes, levels), "merkle-subroots")

    upper = subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("at"), F.lit(count).cast("long").alias("n"),
                            F.struct("digest", F.col("gid").alias("key")).alias("child"))
    upper_levels = grow(upper, count)
    root = tops(upper, upper_levels).select("gid", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    roots = paths(upper, upper_levels, root, ["root"]).select(
        F.col("child.key").alias("gid"), F.col("child.digest").alias("subroot"), "root", "path")

    held = paths(nodes, levels, staged(roots, "merkle-roots"), ["subroot", "root"])
    held = held.select(F.col("child.key").alias(key), F.col("child.digest").alias("leaf"), "subroot", "root",
                       F.sha2(F.array_join(F.transform("path", lambda p: F.lower(F.hex(F.concat(p["l"], p["r"])))), "").cast("binary"), 256).alias("proof_sha256"),
                       fold(F.col("child.claim"), F.col("path")).alias("folded_root"))
    return held.select(key, *[_text(c).alias(c) for c in ("leaf", "subroot", "root")], "proof_sha256", _text("folded_root").alias("folded_root"),
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_ascii(text: Column) -> Column:
    """A text with A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
