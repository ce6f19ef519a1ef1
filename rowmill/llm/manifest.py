"""Merkle manifest of a dataset: a root over all rows, and for each row the proof that leads there.

Rows are leaves, numbered within their group by an order; a group's tree gives a subroot, and a tree over the
subroots gives the root. Trees are built by slot pivots: the nodes under one parent are spread into columns
by conditional aggregates, one column a slot; the columns put together and hashed are the parent, and put
together without the own slot they are the siblings. One shuffle spreads several levels at once (sixteen
slots are four levels of a binary tree, whose inner nodes are expressions over the columns), so a tree over
n rows takes log16(n) shuffles, each a sixteenth of the one before. Proofs come back down the same way: a
parent's proof joins the row of its slots, which go apart into rows again. All of it is built-in expressions.

Leaves are numbered by a range partitioning over group, order and leaf; counts per part and group, a few numbers a
part, say where each part starts. No group, however large, meets in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.common import by_place, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = 16
SENT_STARTS = 1_000_000
_NO_PATH = "CAST(array() AS array<struct<before:string,after:string>>)"


def leaf(values: Sequence[Column]) -> Column:
    """sha256 of the values, each as its byte count, a colon and its text; a null is a dash."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, order: Sequence[str], sent: int = SENT_STARTS) -> DataFrame:
    """``rows`` (with ``group``) and ``pos``, their place in the group by ``order``, and ``n``, the rows of the group.

    Rows alike in all of ``order`` are parted by where they were read, so copies do not pile up in one part.
    """
    known = rows.withColumn("read", F.monotonically_increasing_id())
    sort = ["group", *order, "read"]
    # Written once: the places below must not change when a task is run again.
    held = stored(known.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("read").withColumn("at", F.monotonically_increasing_id()), "ordered")
    held = held.withColumn("part", F.shiftright("at", 33))
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.groupBy("group", "part").agg(F.min("at").alias("low"), F.count("*").alias("held")).select(
        "group", "part", "low", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"), F.sum("held").over(whole).alias("n"))
    starts = stored(starts, "starts")
    starts = F.broadcast(starts) if starts.count() <= sent else starts
    return held.join(starts, ["group", "part"]).select(*rows.columns, (F.col("start") + F.col("at") - F.col("low")).alias("pos"), "n")


class Tree:
    """The levels over numbered nodes (group, pos, n, hash and others): ``roots`` (group, hash) and, by ``proofs``, the way to each."""

    def __init__(self, nodes: DataFrame, fanout: int):
        if not 2 <= fanout <= 256:
            raise ValueError("fanout must lie in 2 to 256")
        self.fanout, self.depth = fanout, 1
        while fanout ** (self.depth + 1) <= SLOTS:
            self.depth += 1
        self.width = fanout ** self.depth
        self.levels: list[DataFrame] = []
        nodes = stored(nodes, "nodes")
        most = nodes.agg(F.max("n")).first()[0] or 0
        self.bottom = nodes
        while most > 1:
            self.levels.append(stored(self._spread(nodes), "level"))
            nodes = self._inner(self.levels[-1]).select("group", F.col("parent").alias("pos"), F.ceil(F.col("n") / self.width).alias("n"),
                                                        F.col(self._digest(self.depth, 0)).alias("hash"))
            most = -(-most // self.width)
        self.roots = stored(nodes.select("group", "hash"), "roots")

    # The expressions below are SQL text: thousands of column objects a level would take the driver seconds.

    def _spread(self, nodes: DataFrame) -> DataFrame:
        """A row per parent, ``depth`` levels up, with its nodes in columns."""
        others = f"struct({', '.join(c for c in nodes.columns if c not in ('group', 'pos', 'n'))})"
        return nodes.groupBy("group", "n", F.expr(f"pos div {self.width}").alias("parent")).agg(
            *[F.expr(f"max(CASE WHEN pos % {self.width} = {i} THEN {others} END) AS slot{i}") for i in range(self.width)])

    @staticmethod
    def _digest(level: int, at: int) -> str:
        return f"slot{at}.hash" if level == 0 else f"hash{level}_{at}"

    def _several(self, level: int) -> str:
        """Whether the group still has several nodes ``level`` levels up."""
        return f"n > {self.fanout ** level}"

    def _inner(self, rows: DataFrame) -> DataFrame:
        """The hashes of the levels between the slots and their parent; a lone node goes up as it is."""
        for level in range(self.depth):
            made = []
            for at in range(self.width // self.fanout ** (level + 1)):
                run = [self._digest(level, i) for i in range(at * self.fanout, (at + 1) * self.fanout)]
                hashed = f"CASE WHEN {run[0]} IS NOT NULL THEN sha2(concat_ws('', {', '.join(run)}), 256) END"
                made.append(f"CASE WHEN {self._several(level)} THEN {hashed} ELSE {run[0]} END AS hash{level + 1}_{at}")
            rows = rows.selectExpr("*", *made)
        return rows

    def _siblings(self, slot: int) -> str:
        """What stands before and after a slot's node in its run, for each level up to the parent."""
        steps = []
        for level in range(self.depth):
            at = slot // self.fanout ** level
            first = at - at % self.fanout
            sides = [", ".join(["''", *(self._digest(level, i) for i in places)]) for places in (range(first, at), range(at + 1, first + self.fanout))]
            steps.append(f"CASE WHEN {self._several(level)} THEN struct(concat_ws({sides[0]}) AS before, concat_ws({sides[1]}) AS after) END")
        return f"array_compact(array({', '.join(steps)}))"

    def proofs(self, tops: DataFrame) -> DataFrame:
        """The nodes' own columns, what ``tops`` (group, path and others) says of their group, and the ``path`` from each on through ``tops``'s."""
        carried = [c for c in tops.columns if c not in ("group", "path")]
        if not self.levels:
            return self.bottom.drop("pos", "n").join(tops, "group")
        paths = tops.withColumn("parent", F.lit(0).cast("long"))
        for level in reversed(self.levels):
            slots = ", ".join(f"struct({i} AS i, slot{i} AS node, {self._siblings(i)} AS path)" for i in range(self.width))
            rows = self._inner(level).selectExpr("group", "parent", f"filter(array({slots}), s -> s.node IS NOT NULL) AS slots").join(paths, ["group", "parent"])
            apart = rows.select("group", "parent", "path", *carried, F.explode_outer("slots").alias("slot"))
            # An outer explode: the filter of a plain one would have the slots worked out twice.
            paths = apart.select("group", (F.col("parent") * self.width + F.col("slot.i")).alias("parent"), "slot.node",
                                 F.concat("slot.path", "path").alias("path"), *carried)
            if level is not self.levels[0]:
                paths = paths.drop("node")
        return paths.select("group", "node.*", "path", *carried)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", fanout: int = 2,
             changed: Mapping[str, Column] | None = None, sent: int = SENT_STARTS) -> DataFrame:
    """``order``, leaf, subroot, root, path, proof_sha256, folded_root and verified of every row.

    A leaf covers ``fields``. Groups (null first, then by bytes) are ordered trees of their rows by ``order``;
    a null comes first, equal values go by leaf, and rows alike in all fields count one by one. A run is up to ``fanout`` nodes; a lone
    node of a run is hashed too, a lone node of a level is the root. ``path`` holds for each level the siblings ``before`` and
    ``after``, and ``proof_sha256`` is the hash of all of them from left to right, level by level. ``changed`` gives columns
    as they are found later: ``folded_root`` is computed from the row with those values, and ``verified`` says whether it is the
    root. An empty table has no root and gives no rows. Texts of any length are hashed whole. Columns beyond ``fields``, ``group`` and ``order`` are not read.
    """
    df = by_place(df, {*fields, group, order})[0]
    now = [F.col(f"`{c}`") for c in fields]
    later = [(changed or {}).get(c, F.col(f"`{c}`")) for c in fields]
    differs = F.lit(False)
    for name in changed or {}:
        differs = differs | ~changed[name].eqNullSafe(F.col(f"`{name}`"))
    key = F.col(f"`{group}`").cast("string")
    rows = df.select(F.coalesce(F.concat(F.lit("+"), key), F.lit("")).alias("group"), F.col(f"`{order}`").alias("id"), leaf(now).alias("hash"),
                     F.when(differs, leaf(later)).alias("found"))
    documents = Tree(numbered(stored(rows, "leaves"), ["id", "hash"], sent), fanout)
    subroots = documents.roots.select(F.lit("").alias("group"), F.col("group").alias("of"), "hash")
    top = Tree(numbered(subroots, ["of"], sent), fanout)
    ends = top.roots.select("group", F.col("hash").alias("root"), F.expr(_NO_PATH).alias("path"))
    groups = stored(top.proofs(ends).select(F.col("of").alias("group"), F.col("hash").alias("subroot"), "root", "path"), "groups")
    proofs = documents.proofs(groups)
    reached = proofs.withColumns({
        "proof_sha256": F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256),
        "folded_root": folded(F.coalesce("found", "hash"), F.col("path"))})
    return reached.select(F.col("id").alias(order), F.col("hash").alias("leaf"), "subroot", "root", "path", "proof_sha256", "folded_root",
                          (F.col("folded_root") == F.col("root")).alias("verified"))
