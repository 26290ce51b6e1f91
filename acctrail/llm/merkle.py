"""Merkle manifest of a dataset: leaf digests, group roots, one root, proofs that fold back to it.

Every group's leaves stand in key order; while several nodes remain, each run of
``fanout`` consecutive ones becomes their digest. The group roots, in group order, are
the leaves of the last tree in the same way.

Both sweeps process nodes forward in time. The forward one goes through the node labels
(level, place) in ascending order: a queue ordered by label hands the digests of the
children to their parent. The reversed one goes from the root to the leaves: a queue
in descending label order hands each child the proof above it. The queue is external:
labels are dealt out in blocks of ``fanout ** block_levels`` nodes under one
ancestor, a sort brings a block's messages to its task in label order, and a heap orders what
passes between the levels inside the block. Messages that leave a block go to the next round
of blocks, which has ``fanout ** block_levels`` times fewer rows. No task holds more than one
block, however many rows a group has.

Defined results: null groups come first and form one group; null keys come first in their
group; equal keys stand in order of their leaf digests, so repeated rows get neighbouring
places (which of them gets which changes no result, as all their digests are equal). An empty table
gives no rows. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StringType

from .common import stored

GROUP = ["has", "grp"]
OUT_ROWS = 5000


def _h(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    shown = value.cast("string")
    return F.when(shown.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def height(nodes: int, fanout: int) -> int:
    """Levels above ``nodes`` leaves."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def sweep_up(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The digests of a block's nodes by level, each made when its label heads the queue."""
    nodes: list[list[str]] = [leaves, *([] for _ in range(levels))]
    queue = [(1, i // fanout, i, d) for i, d in enumerate(leaves)] if levels else []
    while queue:
        level, place = queue[0][:2]
        run = []
        while queue and queue[0][:2] == (level, place):
            run.append(heapq.heappop(queue)[3])
        digest = _h("".join(run))
        nodes[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // fanout, place, digest))
    return nodes


def sweep_down(nodes: list[list[str]], above: str, fanout: int) -> list[str]:
    """The path of every leaf of a block: ``place:run`` of each level up to the root, joined by ``;``.

    ``run`` holds the digests of the node's run, its own at ``place``; ``above`` is the path of the block's top.
    """
    paths = [""] * len(nodes[0])
    queue = [(1 - len(nodes), 0, above)]
    while queue:
        level, place, path = heapq.heappop(queue)
        if level == 0:
            paths[-place] = path
            continue
        first = -place * fanout
        children = nodes[-level - 1][first:first + fanout]
        run = "".join(children)
        tail = f":{run};{path}" if path else f":{run}"
        for i in range(len(children)):
            heapq.heappush(queue, (level + 1, -(first + i), f"{i}{tail}"))
    return paths


def steps(path: str) -> list[tuple[int, str]]:
    """(place, run) of each level of a path, from the leaf to the root."""
    return [(int(place), run) for place, run in (s.split(":") for s in path.split(";"))] if path else []


def fold(digest: str, path: list[tuple[int, str]]) -> str:
    """The root that ``digest`` leads to with the siblings of ``path``."""
    for place, run in path:
        digest = _h(run[:64 * place] + digest + run[64 * place + 64:])
    return digest


def siblings(path: list[tuple[int, str]]) -> str:
    return "".join(run[:64 * place] + run[64 * place + 64:] for place, run in path)


def _by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block; the first three columns name it and the rows come sorted by it."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return (list(block) for _, block in groupby(rows, key=itemgetter(0, 1, 2)))


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
                                          schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (place within the group by ``order``) and ``size`` (rows of the group).

    The rows are dealt out by ranges of the whole order, so a group of any size is split; places
    are counted inside (range, group) and shifted by the rows of the ranges before.
    """
    salted = rows.withColumn("salt", F.rand(0))
    dealt = stored(salted.repartitionByRange(*GROUP, *order, "salt").drop("salt")
                   .withColumn("part", F.spark_partition_id()), name)
    before = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = dealt.groupBy("part", *GROUP).agg(F.count("*").alias("n")).select(
        "part", *GROUP, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(*GROUP)).alias("size"))
    within = Window.partitionBy("part", *GROUP).orderBy(*order)
    return (dealt.withColumn("rank", F.row_number().over(within)).join(spans, ["part", *GROUP])
            .withColumn("pos", F.col("before") + F.col("rank") - 1).drop("part", "rank", "before"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Each block's rows in one task, in label order."""
    return rows.repartition(*GROUP, "block").sortWithinPartitions(*GROUP, "block", "pos")


def _schema(columns: list[tuple[str, DataType]]) -> tuple[str, pa.Schema]:
    return (", ".join(f"`{n}` {t.simpleString()}" for n, t in columns),
            pa.schema([pa.field(n, to_arrow_type(t)) for n, t in columns]))


class _Forest:
    """One tree a group: its rounds of blocks, written one after the other, and its roots."""

    def __init__(self, rows: DataFrame, order: list[str], fanout: int, block_levels: int, name: str):
        self.fanout, self.block, self.name = fanout, fanout ** block_levels, name
        self.block_levels = block_levels
        self.rounds = [self._stored(_numbered(rows, order, f"{name}-dealt"))]
        while True:
            last = self.rounds[-1]
            tops = self._up(last)
            if not last.where(F.col("size") > self.block).take(1):
                self.tops = tops.select(*GROUP, "digest")
                return
            self.rounds.append(self._stored(tops))

    def _stored(self, rows: DataFrame) -> DataFrame:
        return stored(rows.withColumn("block", F.expr(f"pos div {self.block}")), f"{self.name}-round")

    def _up(self, nodes: DataFrame) -> DataFrame:
        fanout, block, levels = self.fanout, self.block, self.block_levels
        ddl, schema = _schema([("has", nodes.schema["has"].dataType), ("grp", StringType()), ("pos", LongType()),
                               ("size", LongType()), ("digest", StringType())])

        def run(batches):
            def tops():
                for rows in _by_block(batches):
                    size = rows[0][4]
                    made = sweep_up([r[5] for r in rows], levels if size > block else height(size, fanout), fanout)
                    yield *rows[0][:3], -(-size // block), made[-1][0]
            return _batches(tops(), schema)

        return _in_blocks(nodes.select(*GROUP, "block", "pos", "size", "digest")).mapInArrow(run, ddl)

    def paths(self, above: DataFrame) -> DataFrame:
        """(group, block, path, carried columns) of the blocks of the first round; ``above`` has the groups' own paths."""
        at = above.withColumn("block", F.lit(0).cast("long"))
        for nodes in reversed(self.rounds[1:]):
            carried = [c for c in at.columns if c not in {*GROUP, "block", "path"}]
            at = stored(self._down(nodes, at, carried, [], False), f"{self.name}-paths").withColumnRenamed("pos", "block")
        return at

    def leaves(self, above: DataFrame, own: list[str], prove: bool) -> DataFrame:
        """The leaves' own columns with the path above each, or with what its proof gives."""
        at = self.paths(above)
        carried = [c for c in at.columns if c not in {*GROUP, "block", "path"}]
        return self._down(self.rounds[0], at, carried, own, prove)

    def _down(self, nodes: DataFrame, above: DataFrame, carried: list[str], own: list[str], prove: bool) -> DataFrame:
        fanout, block, levels = self.fanout, self.block, self.block_levels
        names = [*GROUP, "block", "pos", "size", "digest", "path", *carried, *own]
        told = [*nodes.schema.fields, *above.schema.fields]
        types = {f.name: f.dataType for f in told}
        rows = nodes.select(*[F.col(c) if c in nodes.columns else F.lit(None).cast(types[c]).alias(c) for c in names])
        messages = above.withColumns({"pos": F.lit(-1).cast("long")}).select(
            *[F.col(c) if c in (*above.columns, "pos") else F.lit(None).cast(types[c]).alias(c) for c in names])
        made = [("proof", StringType()), ("folded_root", StringType())] if prove else [("path", StringType())]
        kept = [(c, types[c]) for c in ([*GROUP, "pos", "digest"] if prove or own else [*GROUP, "pos"])]
        ddl, schema = _schema([*kept, *((c, types[c]) for c in (*carried, *own)), *made])
        upto, claim = 7 + len(carried), names.index("claimed") if prove else -1

        def run(batches):
            def found():
                for first, *rows in _by_block(batches):
                    size, passed = rows[0][4], first[7:upto]
                    tree = sweep_up([r[5] for r in rows], levels if size > block else height(size, fanout), fanout)
                    for row, path in zip(rows, sweep_down(tree, first[6], fanout), strict=True):
                        base = (*row[:2], row[3], *((row[5],) if len(kept) > 3 else ()), *passed, *row[upto:])
                        if prove:
                            way = steps(path)
                            yield *base, siblings(way), fold(row[claim], way)
                        else:
                            yield *base, path
            return _batches(found(), schema)

        return _in_blocks(rows.unionByName(messages)).mapInArrow(run, ddl)


def merkle_manifest(docs: DataFrame, key: str = "doc_id", group: str = "source",
                    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    claims: dict[str, Column] | None = None, fanout: int = 16, block_levels: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``key``, leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    ``leaf`` digests ``columns``. ``proof`` holds the hex digests of the siblings (the others of each run), level by
    level from the leaf through its group's root to the root. ``claims`` replaces columns by what
    someone presents later; ``folded_root`` is what the presented leaf and the proof lead to, and
    ``verified`` tells whether it is the root.
    """
    if fanout < 2 or block_levels < 1:
        raise ValueError("fanout must be 2 or more and block_levels 1 or more")
    presented = claims or {}
    rows = docs.select(
        F.col(group).isNotNull().alias("has"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("grp"),
        F.col(key).alias("key"), leaf_digest(*(F.col(c) for c in columns)).alias("digest"),
        leaf_digest(*(presented.get(c, F.col(c)) for c in columns)).alias("claimed"))
    # written before it is dealt out, as finding the ranges would digest every row a second time
    trees = _Forest(stored(rows, "merkle-leaves"), ["key", "digest"], fanout, block_levels, "merkle")
    subroots = stored(trees.tops, "merkle-subroots")
    crown = _Forest(subroots.select(F.lit(True).alias("has"), F.lit("").alias("grp"), F.col("has").alias("of_has"),
                                    F.col("grp").alias("of_grp"), "digest"),
                    ["of_has", "of_grp"], fanout, block_levels, "merkle-crown")
    top = crown.tops.select(*GROUP, F.lit("").alias("path"), F.col("digest").alias("root"))
    groups = stored(crown.leaves(top, ["of_has", "of_grp"], False).select(
        F.col("of_has").alias("has"), F.col("of_grp").alias("grp"), "path", "root",
        F.col("digest").alias("subroot")), "merkle-groups")
    proven = trees.leaves(groups, ["key", "claimed"], True)
    return proven.select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "proof",
        F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
