"""Only new or changed records, by comparing two Merkle trees over key ranges.

A leaf covers a range of 2**LEAF_BITS keys and holds a digest of the keys and versions in it; each level above joins
2**FAN_BITS nodes into one, up to a single root. The walk starts at the root and goes down only under nodes whose
digests differ, so two states that agree are settled by the root alone, and records are read only from leaves that
differ.

A saved state lies in a shared folder. A run writes the records of the leaves that differ, each with the mark whether it
is new or changed, then the tree, in which a leaf names the run that holds its records; leaves that agree are neither
read nor written. Both become the saved state at once, by the creation of one small file with the next number: a run
that dies before it leaves the earlier state as it was, so its records come again; a run that is repeated after it finds
nothing new; of two runs at once the second finds the number taken and fails.

Defined results: a null key is no record; a null version is older than any other; of equal keys the greatest version
counts; an empty saved state makes every key new; keys missing from the current state aren't reported, and stay saved.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmill.functions.times import zoned_micros
from driftmill.session import broadcast_if_small, cut

#: Keys of a leaf, and children of a node, as powers of two. LEVELS leaves one node over all 64-bit keys.
LEAF_BITS, FAN_BITS = 8, 14
LEVELS = -(-(64 - LEAF_BITS) // FAN_BITS) + 1
#: Nodes up to which a level is walked on the driver; larger levels are compared by joins. Ranges that are pushed to a scan.
WALK, RANGES = 65_536, 64
#: Runs over which the records of a saved state may be spread before they are written together again.
MAX_RUNS = 16
#: Keys, as a power of two, that are written side by side, so that a scan by ranges finds them on few pages.
BLOCK_BITS = 16
STATE, TREE = "key bigint, version bigint, changed boolean, run string", "level int, node bigint, x bigint, s bigint, n bigint, run string"


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row a key with its greatest version: columns key, version."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key")).agg(F.max(version).alias("version"))


def merkle_leaves(state: DataFrame) -> DataFrame:
    """Digest of every leaf of a state (key, version): columns node, x, s, n. It doesn't depend on row order."""
    h = F.xxhash64("key", F.coalesce("version", F.lit(-(2**62))))
    return state.groupBy(F.shiftright("key", LEAF_BITS).alias("node")).agg(F.bit_xor(h).alias("x"), F.sum(F.pmod(F.xxhash64(h), F.lit(2**31))).alias("s"), F.count("*").alias("n"))


def merkle_tree(leaves: DataFrame) -> DataFrame:
    """All levels of the tree over merkle_leaves: columns level, node, x, s, n; level 0 holds the leaves.

    A node's digest is the sum of its children's, each hashed with its place, so one aggregation gives all levels.
    """
    own = F.struct(F.lit(0).alias("level"), F.col("node").alias("node"))
    up = [F.struct(F.lit(i).alias("level"), F.shiftright("node", FAN_BITS * i).alias("node")) for i in range(1, LEVELS)]
    placed = F.xxhash64("node", "x", "s", "n")
    return leaves.select(F.explode(F.array(own, *up)).alias("at"), placed.alias("h"), "n").groupBy("at.level", "at.node").agg(F.bit_xor("h").alias("x"), F.sum(F.pmod(F.xxhash64("h"), F.lit(2**31))).alias("s"), F.sum("n").alias("n"))


def _bounded(df: DataFrame, limit: int) -> list | None:
    """Rows of a frame that has no more than the limit; None if it has."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def spans(nodes: list[int]) -> list[list[int]]:
    """At most RANGES ranges that hold all nodes: neighbours make one, then those that lie closest are joined."""
    out: list[list[int]] = []
    for node in sorted(set(nodes)):
        if out and node == out[-1][1] + 1:
            out[-1][1] = node
        else:
            out.append([node, node])
    if len(out) > RANGES:
        wide = sorted(sorted(range(1, len(out)), key=lambda i: out[i - 1][1] - out[i][0])[: RANGES - 1])
        out = [[out[a][0], out[b - 1][1]] for a, b in zip([0, *wide], [*wide, len(out)], strict=True)]
    return out


def within(column: str, nodes: list[int], bits: int) -> Column:
    """Whether a value lies under one of the nodes, bits above it: ranges that a scan skips files and pages by, so values beside the nodes may pass."""
    out = F.lit(False)
    for lo, hi in spans(nodes):
        out = out | F.col(column).between(max(lo << bits, -(2**63)), min(((hi + 1) << bits) - 1, 2**63 - 1))
    return out


def differing_leaves(current: DataFrame, saved: DataFrame, walk: int = WALK) -> DataFrame:
    """Leaves (column node) of the current tree that the saved tree lacks or holds with another digest.

    Levels above the leaves are walked on the driver while they have at most walk nodes, from the root down and only
    under nodes that differ; the leaves are then read by ranges under the suspects alone. Larger levels are compared by
    joins, each level only under parents that differed.
    """
    at = lambda tree, level: tree.where(F.col("level") == level).select("node", F.struct("x", "s", "n").alias("digest"))
    upper = [_bounded(t.where("level > 0").select("level", "node", "x", "s", "n"), walk) for t in (current, saved)]
    if None in upper:
        suspects = None
        for level in range(LEVELS - 1, -1, -1):
            now, then = at(current, level), at(saved, level).withColumnRenamed("digest", "was")
            if suspects is not None:
                now = now.withColumn("up", F.shiftright("node", FAN_BITS)).join(broadcast_if_small(suspects), "up", "left_semi").drop("up")
            suspects = now.join(then, "node", "left").where(~F.col("digest").eqNullSafe(F.col("was"))).select(F.col("node").alias("up"))
            if level:
                suspects = cut(suspects)
        return suspects.withColumnRenamed("up", "node")
    ours, theirs = ({(r[0], r[1]): tuple(r[2:]) for r in rows} for rows in upper)
    children: dict[tuple[int, int], list[int]] = {}
    for level, node in ours:
        children.setdefault((level + 1, node >> FAN_BITS), []).append(node)
    todo = [n for lv, n in ours if lv == LEVELS - 1]
    for level in range(LEVELS - 1, 0, -1):
        todo = [n for n in todo if ours[level, n] != theirs.get((level, n))]
        if level > 1:
            todo = [c for n in todo for c in children[level, n]]
    if not todo:
        return current.sparkSession.createDataFrame([], "node bigint")
    pick = lambda tree: at(tree, 0).where(within("node", todo, FAN_BITS))
    return pick(current).join(pick(saved).withColumnRenamed("digest", "was"), "node", "left").where(~F.col("digest").eqNullSafe(F.col("was"))).select("node")


class Leaves:
    """Leaves that differ, for picking the rows that lie in them."""

    def __init__(self, leaves: DataFrame, walk: int = WALK):
        self.rows = cut(leaves)
        told = _bounded(self.rows, walk)
        self.nodes = None if told is None else [r[0] for r in told]

    def pick(self, df: DataFrame, *also: str) -> DataFrame:
        """Rows (key, …) in these leaves; also: further columns on which the leaves must agree."""
        if self.nodes is not None:
            df = df.where(within("key", self.nodes, LEAF_BITS))
        return df.withColumn("node", F.shiftright("key", LEAF_BITS)).join(broadcast_if_small(self.rows.select("node", *also)), ["node", *also], "left_semi").drop("node")


def merged(current: DataFrame, saved: DataFrame) -> DataFrame:
    """Both states as one: key, its greatest version, and changed, whether the current one is new or later than the saved."""
    now, was = F.col("version"), F.col("was")
    newer = F.col("__here").isNotNull() & (F.col("__there").isNull() | F.coalesce(now > was, now.isNotNull() & was.isNull()))
    both = current.withColumn("__here", F.lit(1)).join(saved.select("key", F.col("version").alias("was"), F.lit(1).alias("__there")), "key", "full_outer")
    return both.select("key", F.greatest(now, was).alias("version"), newer.alias("changed"))


def changed_records(current: DataFrame, saved: DataFrame) -> DataFrame:
    """Rows (key, version) of the current state whose version is later than the saved one, or whose key is new.

    Both states are (key, version) with one row a key, as latest() makes them. Rows of leaves that agree take no part in
    the join of records.
    """
    current, saved = cut(current), cut(saved)
    ours, theirs = (cut(merkle_tree(merkle_leaves(s))) for s in (current, saved))
    leaves = Leaves(differing_leaves(ours, theirs))
    return merged(leaves.pick(current), leaves.pick(saved)).where("changed").select("key", "version")


class Published:
    """A saved state in a shared folder, with the output of its last run.

    ``<run>/state`` holds the records of the leaves which that run found different (key, version, changed, run), in
    blocks of keys and sorted by key; ``<run>/tree`` all leaves (level 0, with the run that holds them) and nodes; ``STATE-<number>`` names a run
    and the runs whose records it needs.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self.fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self._hadoop.Path(p)

    def _children(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(self.folder))) if self.fs.exists(self._path(self.folder)) else []

    def current(self) -> dict:
        """Number, run and live runs of the saved state; number 0 before the first."""
        numbers = [n for n in self._children() if n.startswith("STATE-")]
        if not numbers:
            return {"number": 0, "run": None, "runs": []}
        stream = self.fs.open(self._path(f"{self.folder}/{numbers[-1]}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def run(self) -> str | None:
        """Name of the last published run."""
        return self.current()["run"]

    def read(self, part: str) -> DataFrame | None:
        """The published state (key, version), tree, or output; None before the first run."""
        now = self.current()
        if now["run"] is None:
            return None
        if part == "output":
            return self._parquet(f"{now['run']}/state").where("changed").select("key", "version")
        tree = self._parquet(f"{now['run']}/tree")
        return tree if part == "tree" else self._records(now, tree.where("level = 0").select("node", "run"))

    def _parquet(self, *parts: str) -> DataFrame:
        return self.spark.read.schema(TREE if parts[0].endswith("/tree") else STATE).parquet(*(f"{self.folder}/{p}" for p in parts))

    def _records(self, saved: dict, leaves: DataFrame, picked: Leaves | None = None) -> DataFrame:
        """Saved records (key, version): of each leaf those of the run that its tree names."""
        rows = self._parquet(*(f"{r}/state" for r in saved["runs"])).select("key", "version", "run")
        return (picked or Leaves(leaves)).pick(rows, "run").select("key", "version")

    def publish(self, current: DataFrame, output: DataFrame | None = None) -> DataFrame:
        """Writes records and tree of the leaves that differ and makes them the saved state at once; returns what is new or changed.

        current: (key, version), one row a key. output: a frame with column key, of which the changed keys' rows are
        returned; None returns key and version. The rows of a run can be read again until the run after the next.
        """
        saved = self.current()
        self._next = saved | {"number": saved["number"] + 1}
        name = f"run-{self._next['number']:012d}-{uuid.uuid4().hex}"
        write = lambda df, part: df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}/{part}")
        if saved["run"] is None:
            write(current.withColumns({"changed": F.lit(True), "run": F.lit(name)}).repartition(F.shiftright("key", BLOCK_BITS)).sortWithinPartitions("key"), "state")
            leaves = merkle_leaves(self._parquet(f"{name}/state")).withColumn("run", F.lit(name))
            runs = [name]
        else:
            current = cut(current)
            theirs = self._parquet(f"{saved['run']}/tree")
            found = Leaves(differing_leaves(cut(merkle_tree(merkle_leaves(current))), theirs.where("level > 0").unionByName(_levelled(theirs))).join(theirs.where("level = 0").select("node", "run"), "node", "left"))
            whole = len(saved["runs"]) >= MAX_RUNS
            if whole:  # every leaf is written again
                found = Leaves(found.rows.select("node").unionByName(theirs.where("level = 0").select("node")).distinct().join(theirs.where("level = 0").select("node", "run"), "node", "left"))
            rows = merged(found.pick(current), self._records(saved, theirs, found))
            write(rows.withColumn("run", F.lit(name)).repartition(F.shiftright("key", BLOCK_BITS)).sortWithinPartitions("key"), "state")
            fresh = merkle_leaves(self._parquet(f"{name}/state")).withColumn("run", F.lit(name))
            kept = theirs.where("level = 0").join(broadcast_if_small(found.rows.select("node")), "node", "left_anti").select("node", "x", "s", "n", "run")
            leaves, runs = fresh.unionByName(kept), [name] if whole else [*saved["runs"], name]
        own = leaves.select(F.lit(0).alias("level"), "node", "x", "s", "n", "run")
        upper = merkle_tree(leaves).where("level > 0").withColumn("run", F.lit(None).cast("string"))
        write(own.unionByName(upper).repartition("level", F.shiftright("node", FAN_BITS)).sortWithinPartitions("level", "node"), "tree")
        self._next |= {"run": name, "runs": runs}
        self._point(name)
        self._sweep(saved)
        changed = self._parquet(f"{name}/state").where("changed").select("key", "version")
        return changed if output is None else output.join(changed.select("key"), "key", "left_semi")

    def _point(self, name: str) -> None:
        """Makes the run the saved state, unless another run has taken the number since this one read the state."""
        draft = self._path(f"{self.folder}/.draft-{name}")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(json.dumps(self._next).encode()))
        stream.close()
        gateway = self.spark.sparkContext._gateway
        context = self._hadoop.FileContext.getFileContext(self._path(self.folder).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(draft, self._path(f"{self.folder}/STATE-{self._next['number']:012d}"), gateway.new_array(self._hadoop.Options.Rename, 0))

    def _sweep(self, before: dict) -> None:
        """Removes what neither this state nor the one before it needs."""
        live = {*before["runs"], before["run"], *self._next["runs"], self._next["run"]}
        for child in self._children():
            if child.startswith("run-") and child not in live and int(child.split("-")[1]) < self._next["number"] or child.startswith("STATE-") and int(child.split("-")[1]) < before["number"]:
                self.fs.delete(self._path(f"{self.folder}/{child}"), True)


def _levelled(tree: DataFrame) -> DataFrame:
    """Leaves of a stored tree as level 0 of merkle_tree() has them."""
    h = F.xxhash64("node", "x", "s", "n")
    return tree.where("level = 0").select("level", "node", h.alias("x"), F.pmod(F.xxhash64(h), F.lit(2**31)).alias("s"), "n", "run")


def entity_states(animes: DataFrame, ledger: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """States of the entity table and of what completed runs wrote: (id, latest readable updatedat in microseconds).

    Ids without a readable updatedat are in neither state. A ledger row counts only under a run with outcome ``done``.
    """
    current = latest(animes.select("id", zoned_micros(F.col("updatedat")).alias("at")).where("at IS NOT NULL"), "id", "at")
    done = runs.where(F.col("outcome") == "done").select("run_no").distinct()
    saved = latest(ledger.join(broadcast_if_small(done), "run_no", "left_semi").select("id", zoned_micros(F.col("updatedat")).alias("at")).where("at IS NOT NULL"), "id", "at")
    return current, saved
