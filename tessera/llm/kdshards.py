"""Sharding by k-d tree: recursive splits at weighted medians of the widest metadata dimension.

A leaf that shall become several shards is split in two, in proportion to the shards
of each side, along the dimension that is widest in it (relative to the whole
table's range), until every leaf is one shard of the target bytes. All leaves of a
level are worked on together.

Medians are exact and distributed: a histogram of weights over the leaf's range
finds the bin of the median, that bin's smallest and largest values are the next
range, until one value is left. Where that value is shared by many rows (a hot
source), the median goes on inside it by document id, then by row number. Only
histograms of at most ``BINS`` bins a leaf come to the driver. The tree itself is an
expression; rows are never rewritten or moved between levels.

Source and language count by the place of their value among all distinct ones, which is
found by distributed running sums. Built from DataFrame and SQL functions only. Law: ``bytes``.

Defined results: a null or empty text has size 1; null metadata sort first; repeated
rows are told apart by a number they get when the metadata are written; shards may
stay empty only if there are fewer rows than shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import gapless
from tessera.operators.ranks import positions
from tessera.session import materialize

SHARDS = 16
BINS = 1_024


def with_codes(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_code`` for each column: the place of its value among all distinct ones, nulls first.

    Exact for any number of values and any common beginnings; a value held by many rows is one row while
    values are numbered, and the join back is split by Spark where one value has too many.
    """
    for column in columns:
        code = f"{column}_code"
        known = positions(rows.select(column).distinct(), [column])[0].select(
            F.col(column).alias("_value"), F.col("_before").alias(code))
        rows = rows.join(known, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
    return rows


@dataclass
class Leaf:
    """A node still to be split (or one shard): the condition to be in it is the path of the tree."""

    first: int              # its first shard
    shards: int
    test: str | None = None         # SQL condition of the left side, once split
    left: Leaf | None = None
    right: Leaf | None = None


def route(node: Leaf) -> str:
    """The first shard of the leaf a row falls into, as SQL."""
    if node.test is None:
        return str(node.first)
    return f"IF({node.test}, {route(node.left)}, {route(node.right)})"


@dataclass
class Search:
    """The state of one median search."""

    leaf: Leaf
    keys: list[str]         # columns that order the leaf's rows
    target: float           # weight of the left side
    low: int
    high: int
    level: int = 0          # the key searched now
    fixed: tuple[int, ...] = ()     # values of the keys before
    below: int = 0          # weight of the rows before the range
    done: bool = False

    def inside(self) -> str:
        same = [f"{k} = {_lit(v)}" for k, v in zip(self.keys, self.fixed)]
        return " AND ".join([f"leaf = {self.leaf.first}", *same,
                             f"{self.keys[self.level]} BETWEEN {_lit(self.low)} AND {_lit(self.high)}"])

    def bin(self) -> str:
        key, width = self.keys[self.level], -(-(self.high - self.low + 1) // BINS)
        if self.high - self.low < 2**62:
            return f"({key} - {_lit(self.low)}) div {_lit(width)}"
        return f"CAST(floor((CAST({key} AS DOUBLE) - {float(self.low)}D) / {float(width)}D) AS BIGINT)"

    def narrow(self, bins: list) -> None:
        """Go into the bin that holds the median; split there when it holds one value of the last key."""
        reached = self.below
        for b in bins:
            if reached + b.weight >= self.target or b is bins[-1]:
                break
            reached += b.weight
        self.below, self.low, self.high = reached, b.low, b.high
        if b.low < b.high:
            return
        if reached + b.weight == self.target or self.level == len(self.keys) - 1:
            # The whole value goes to the side that leaves the sizes closer.
            self._split(b.low, "<=" if reached + b.weight - self.target <= self.target - reached else "<")
        else:
            self.fixed, self.level = (*self.fixed, b.low), self.level + 1
            self.low, self.high = b.next_low[self.level - 1], b.next_high[self.level - 1]

    def _split(self, value: int, last: str) -> None:
        test = f"{self.keys[self.level]} {last} {_lit(value)}"
        for key, fixed in reversed(list(zip(self.keys, self.fixed))):
            test = f"({key} < {_lit(fixed)} OR ({key} = {_lit(fixed)} AND {test}))"
        self.leaf.test, self.done = test, True


def _lit(value: int) -> str:
    return f"CAST('{value}' AS BIGINT)"


@dataclass
class Bin:
    weight: int
    low: int
    high: int
    next_low: list[int]
    next_high: list[int]


def tree(rows: DataFrame, dimensions: list[str], ties: list[str], weight: str, shards: int) -> Leaf:
    """The k-d tree over ``rows``; dimensions, ties and weight are columns of longs without nulls."""
    root = Leaf(0, shards)
    open_leaves = [root] if shards > 1 else []
    whole: list[float] | None = None
    while open_leaves:
        placed = rows.withColumn("leaf", F.expr(route(root)))
        ranges = placed.groupBy("leaf").agg(
            F.sum(weight).alias("weight"),
            *(f(c).alias(f"{name}_{c}") for c in [*dimensions, *ties] for f, name in ((F.min, "low"), (F.max, "high"))),
        ).collect()                                                     # one row per leaf
        found = {r.leaf: r for r in ranges}
        if whole is None:
            whole = [max(1.0, float(found[0][f"high_{d}"]) - found[0][f"low_{d}"]) if found else 1.0
                     for d in dimensions]
        searches = []
        for leaf in open_leaves:
            half = leaf.shards // 2
            leaf.left, leaf.right = Leaf(leaf.first, half), Leaf(leaf.first + half, leaf.shards - half)
            r = found.get(leaf.first)
            if r is None:
                leaf.test = "true"
                continue
            widest = max(range(len(dimensions)), key=lambda k: (
                (float(r[f"high_{dimensions[k]}"]) - r[f"low_{dimensions[k]}"]) / whole[k], -k))
            key = dimensions[widest]
            searches.append(Search(leaf, [key, *(t for t in ties if t != key)], r["weight"] * half / leaf.shards,
                                   r[f"low_{key}"], r[f"high_{key}"]))
        _search(placed, searches, weight)
        open_leaves = [side for leaf in open_leaves for side in (leaf.left, leaf.right) if side.shards > 1]
    return root


def _search(placed: DataFrame, searches: list[Search], weight: str) -> None:
    """All searches of a level, one aggregation a round."""
    while pending := [s for s in searches if not s.done]:
        at = "CASE " + " ".join(f"WHEN {s.inside()} THEN {i}" for i, s in enumerate(pending)) + " END"
        by = lambda make: "CASE at " + " ".join(f"WHEN {i} THEN {make(s)}" for i, s in enumerate(pending)) + " END"
        most = max(len(s.keys) for s in pending)
        later = [by(lambda s, k=k: s.keys[k] if k < len(s.keys) else "CAST(0 AS BIGINT)") for k in range(1, most)]
        rows = (placed.withColumn("at", F.expr(at)).where("at IS NOT NULL")
                .select("at", F.expr(by(lambda s: s.bin())).alias("bin"), F.col(weight).alias("w"),
                        F.expr(by(lambda s: s.keys[s.level])).alias("v"),
                        *(F.expr(x).alias(f"k{i}") for i, x in enumerate(later)))
                .groupBy("at", "bin").agg(
                    F.sum("w").alias("weight"), F.min("v").alias("low"), F.max("v").alias("high"),
                    *(f(f"k{i}").alias(f"{name}{i}") for i in range(len(later))
                      for f, name in ((F.min, "low"), (F.max, "high"))))
                .orderBy("at", "bin").collect())                        # at most BINS rows a search
        for i, s in enumerate(pending):
            s.narrow([Bin(r.weight, r.low, r.high, [r[f"low{k}"] for k in range(len(later))],
                          [r[f"high{k}"] for k in range(len(later))]) for r in rows if r["at"] == i])


def metadata(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             lang: str = "lang") -> DataFrame:
    """What the tree needs of each document, written once: sizes, checksums, codes, a row number."""
    body = F.coalesce(F.col(text), F.lit(""))
    plain = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(doc_id), F.lit(-1)).cast("long").alias("id_code"),
        F.monotonically_increasing_id().alias("row_code")), "metadata")
    return materialize(with_codes(plain, ["source", "lang"]).drop("source", "lang"), "codes")


def shard(docs: DataFrame, shards: int = SHARDS, **columns) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; sizes of shards are near equal."""
    rows = metadata(docs, **columns)
    # Named dimensions first: the widest one is taken, of equally wide ones the first.
    root = tree(rows, ["source_code", "lang_code", "size", "id_code"], ["id_code", "row_code"], "size", shards)
    placed = rows.withColumn("shard", F.expr(route(root)).cast("int"))
    return gapless(placed, ["shard"], ["id_code", "row_code"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot")


def shards_for(docs: DataFrame, target_bytes: int, *, text: str = "text") -> int:
    """Shards of at most about ``target_bytes`` each."""
    total = docs.agg(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1)).first()[0] or 0
    return max(1, -(-total // target_bytes))
