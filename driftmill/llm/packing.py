"""Texts put whole into containers of fixed token capacities.

Lengths are counted once with a public tokenizer; only (id, part, tokens) move from then on. Permitted capacities are
chosen jointly: over the histogram of all lengths a linear program over bin patterns (which lengths share a bin of which
capacity) is solved by column generation, and its solution says, for the longest item of a bin, which capacities to open
in which proportion. Items are dealt into shards of bounded size and packed best-fit decreasing: an item goes to the open
bin with the least room that still holds it, and where none does, a bin of the capacity that is furthest behind its
proportion is opened. At the end each bin is downsized to the smallest permitted capacity that holds its contents. A shard
keeps the cheapest of the packings by that plan, by the least cost a token, and by each capacity alone. What stands in bins
that stayed emptier than FULL of their own capacity is dealt again into far fewer shards and packed once more, so the loss
does not grow with the number of shards.

With one permitted capacity, as in p8_containers, this is plain best-fit decreasing. Only a text longer than the largest
capacity is split: into parts of exactly that size, each filling a container, and a rest that is packed like any text.

Defined results: a null or empty text has no tokens and stands in no container; rows with equal ids are packed as
separate items, and where they are very many, over all shards; an empty table gives no containers; extra columns are
ignored; a container's number depends on the rows alone, not on how they are partitioned.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.session import cut, spread

#: Default container capacity in tokens; the tokenizer's file of ranks, which $DRIFTMILL_RANKS or the parameter may place elsewhere; how the tokenizer cuts a text into pieces (the vocabulary's own pattern).
CAPACITY = 2048
RANKS = os.environ.get("DRIFTMILL_RANKS", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Items of a shard at most on average; share of its room from which a bin counts as full.
SHARD_ITEMS, FULL = 50_000, 0.98
#: Classes of length that the joint choice of capacities distinguishes, and steps of its linear program.
CLASSES, PIVOTS = 128, 600


def token_counts(df: DataFrame, key: str, text: str, ranks: str = RANKS) -> DataFrame:
    """Tokens of every non-empty text: columns key, n_tokens. The vocabulary is read on the driver and travels with the job."""
    with open(ranks, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encode = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=table, special_tokens={}).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(encode(t)) for t in batch.column(1).to_pylist()], pa.int64())], names=[key, "n_tokens"])

    return df.where(F.length(text) > 0).select(key, text).mapInArrow(count, f"`{key}` {kind}, n_tokens bigint")


def attention_costs(capacities: list[int], equal_at: int = CAPACITY) -> list[float]:
    """Cost of a padded bin in a model whose attention is quadratic: tokens, plus as many again for a bin of equal_at tokens."""
    return [c * (1 + c / equal_at) for c in capacities]


class Plan:
    """Proportions in which bins of each capacity are opened, by the class of their longest item."""

    def __init__(self, width: int, shares: dict[int, dict[int, float]], bound: float):
        self.width, self.shares, self.bound = width, shares, bound


def joint_plan(histogram: dict[int, int], capacities: list[int], costs: list[float]) -> Plan:
    """The capacities to open for items of the given lengths (length: number), at the least cost over all of them.

    A linear program: patterns (a capacity, and how many items of each class stand in it) are used as often as it takes
    to hold all items. It starts from bins of one class each; a knapsack over the classes' prices finds the pattern that
    saves most, until none saves anything. Lengths are rounded up to classes, so every pattern is one that fits.
    """
    largest = max(capacities)
    width = -(-largest // CLASSES)
    demand: dict[int, float] = {}
    for size, n in histogram.items():
        if 0 < size <= largest:
            demand[-(-size // width)] = demand.get(-(-size // width), 0.0) + n
    room = [c // width for c in capacities]
    sizes = [k for k in sorted(demand) if k <= max(room)]
    if not sizes:
        return Plan(width, {}, 0.0)
    d = np.array([demand[k] for k in sizes])
    basis, price, kind = np.zeros((len(sizes), len(sizes))), np.zeros(len(sizes)), []
    for i, k in enumerate(sizes):
        _, c = min((costs[j] / (r // k), j) for j, r in enumerate(room) if r >= k)
        basis[i, i], price[i] = room[c] // k, costs[c]
        kind.append(c)
    index = np.array(sizes)
    for _ in range(PIVOTS):
        worth = np.linalg.solve(basis.T, price)
        best, last = np.zeros(max(room) + 1), np.full(max(room) + 1, -1)
        for u in range(1, max(room) + 1):
            fits = np.searchsorted(index, u, "right")
            best[u] = best[u - 1]
            if fits:
                values = best[u - index[:fits]] + worth[:fits]
                i = int(values.argmax())
                if values[i] > best[u]:
                    best[u], last[u] = values[i], i
        saves, c = max((best[r] - costs[j], j) for j, r in enumerate(room))
        if saves <= 1e-7 * max(costs):
            break
        column, u = np.zeros(len(sizes)), room[c]
        while u > 0:
            if last[u] < 0:
                u -= 1
                continue
            column[last[u]] += 1
            u -= int(index[last[u]])
        step = np.linalg.solve(basis, column)
        used = np.linalg.solve(basis, d)
        ratio = np.where(step > 1e-9, np.maximum(used, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out], price[out], kind[out] = column, costs[c], c
    used = np.maximum(np.linalg.solve(basis, d), 0)
    shares: dict[int, dict[int, float]] = {}
    for i, n in enumerate(used):
        held = np.flatnonzero(basis[:, i] > 0)
        if n > 1e-9 and len(held):
            of = shares.setdefault(sizes[held[-1]], {})
            of[capacities[kind[i]]] = of.get(capacities[kind[i]], 0.0) + float(n)
    return Plan(width, {k: {c: n / sum(of.values()) for c, n in of.items()} for k, of in shares.items()}, float((used * price).sum()))


def best_fit(sizes: list[int], capacities: list[int], costs: list[float] | None = None, plan: Plan | None = None) -> tuple[list[int], list[int]]:
    """Bin of each item, and the final size of each bin. sizes must be in descending order and within the largest capacity.

    Open bins are kept by the room they have left, and the rooms in use as bits of one number, so the tightest bin is
    the lowest set bit at or above the item's size. A new bin gets the capacity that is furthest behind its proportion
    in the plan; for items that no plan names, the one with the least cost for each token that the item takes of it,
    the larger of two that cost the same.
    """
    costs = costs or [float(c) for c in capacities]
    by_room: dict[int, list[int]] = {}
    rooms, bins, opened, used = 0, [], [], []
    cheapest: dict[int, int] = {}
    of_class: dict[int, dict[int, int]] = {}
    for size in sizes:
        left = rooms >> size
        if left:
            room = size + (left & -left).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, k = None, 0 if plan is None else -(-size // plan.width)
            if plan is not None and (shares := plan.shares.get(k)):
                had = of_class.setdefault(k, {})
                total = sum(had.values()) + 1
                fitting = [(had.get(c, 0) - share * total, c) for c, share in shares.items() if c >= size]
                if fitting:
                    room = min(fitting)[1]
                    had[room] = had.get(room, 0) + 1
            if room is None and (room := cheapest.get(size)) is None:
                # what a bin of this size would cost a token if it is filled by items like this one
                room = cheapest[size] = min((costs[i] / (c // size * size), -c, c) for i, c in enumerate(capacities) if c >= size)[2]
            b = len(opened)
            opened.append(room)
            used.append(0)
        bins.append(b)
        used[b] += size
        room -= size
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    return bins, [min(c for c in capacities if c >= u) for u in used]


def cheapest_fit(sizes: list[int], capacities: list[int], costs: list[float], plan: Plan | None) -> tuple[list[int], list[int]]:
    """The cheapest of the packings by the plan, by the least cost a token, and with bins opened at each capacity alone that holds all."""
    if len(capacities) == 1:
        return best_fit(sizes, capacities, costs)
    price = dict(zip(capacities, costs, strict=True))
    final = lambda bins, sized: (sum(price[c] for c in sized), bins, sized)
    tried = [final(*best_fit(sizes, capacities, costs, plan)), final(*best_fit(sizes, capacities, costs))]
    for c in capacities:
        if sizes and c >= sizes[0]:
            bins, _ = best_fit(sizes, [c])
            used = np.bincount(bins, sizes).astype(int)
            tried.append(final(bins, [min(x for x in capacities if x >= u) for u in used.tolist()]))
    return min(tried, key=lambda t: t[0])[1:]


def _pack_round(items: DataFrame, capacities: list[int], costs: list[float], plan: Plan | None, shards: int, number: int) -> DataFrame:
    """items: key, part, start_token, n_tokens, and copies, how often that row stands there."""
    kept = [f for f in items.schema if f.name != "copies"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", container bigint, capacity bigint, used bigint"
    names = [f.name for f in kept]
    # copies of one row are dealt over all shards
    chunks = F.least(F.col("copies"), F.lit(shards)).cast("int")
    dealt = items.withColumn("__i", F.explode(F.sequence(F.lit(0), chunks - 1))).withColumn("__n", F.floor(F.col("copies") / chunks).cast("bigint") + (F.col("__i") < F.col("copies") % chunks).cast("bigint"))
    dealt = dealt.withColumn("__shard", F.pmod(F.xxhash64(*names) + F.col("__i"), F.lit(shards)))

    def pack(shard: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", names[0], "part"], ascending=[False, True, True], kind="stable")
        pdf = pdf.loc[pdf.index.repeat(pdf["__n"]), names].reset_index(drop=True)
        bins, final = cheapest_fit(pdf["n_tokens"].tolist(), capacities, costs, plan)
        pdf["container"] = [(number << 60) | (int(shard[0]) << 24) | b for b in bins]
        pdf["capacity"] = [final[b] for b in bins]
        pdf["used"] = pdf.groupby("container")["n_tokens"].transform("sum")
        return pdf

    return dealt.select(*names, "__n", "__shard").groupBy("__shard").applyInPandas(pack, schema)


def _counted(items: DataFrame, names: list[str]) -> DataFrame:
    return items.groupBy(*names).agg(F.count("*").alias("copies"))


def pack(counts: DataFrame, capacities: list[int], costs: list[float] | None = None) -> DataFrame:
    """Containers of counted texts (key, n_tokens): columns key, part, start_token, n_tokens, container, capacity, used.

    capacities: the permitted sizes in tokens, up to 2**20; costs: what a container of each costs, by default its size. A
    text's parts are numbered from 0 and cover its tokens in order.
    """
    order = sorted(range(len(capacities)), key=lambda i: capacities[i])
    costs = [float(costs[i]) if costs else float(capacities[i]) for i in order]
    capacities = [capacities[i] for i in order]
    largest = capacities[-1]
    key = counts.columns[0]
    whole = F.floor(F.col("n_tokens") / largest).cast("int")
    parts = F.when(F.col("n_tokens") <= largest, F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), F.col("n_tokens").alias("n")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.ceil(F.col("n_tokens") / largest).cast("int") - 1),
            lambda i: F.struct(i.alias("part"), (i.cast("bigint") * largest).alias("start_token"), F.when(i < whole, F.lit(largest).cast("bigint")).otherwise(F.col("n_tokens") - whole.cast("bigint") * largest).alias("n")),
        )
    )
    names = [key, "part", "start_token", "n_tokens"]
    items = cut(_counted(counts.where("n_tokens > 0").select(key, F.explode(parts).alias("x")).select(key, "x.part", "x.start_token", F.col("x.n").alias("n_tokens")), names))
    plan = None
    if len(capacities) > 1:  # at most one row for every length up to the largest capacity
        lengths = items.groupBy("n_tokens").agg(F.sum("copies").alias("n")).collect()
        n, plan = sum(r["n"] for r in lengths), joint_plan({r["n_tokens"]: r["n"] for r in lengths}, capacities, costs)
    else:
        n = items.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    first = cut(_pack_round(items, capacities, costs, plan, max(1, -(-n // SHARD_ITEMS)), 1))
    poor = first.where(F.col("used") < F.lit(FULL) * F.col("capacity"))
    left = poor.count()
    again = _pack_round(_counted(poor, names), capacities, costs, plan, max(1, -(-left // SHARD_ITEMS)), 2)
    return first.where(F.col("used") >= F.lit(FULL) * F.col("capacity")).unionByName(again)


def containers(documents: DataFrame, capacity: int | list[int] = CAPACITY, ranks: str = RANKS, costs: list[float] | None = None) -> DataFrame:
    return pack(token_counts(spread(documents.select("doc_id", "text")), "doc_id", "text", ranks), capacity if isinstance(capacity, list) else [capacity], costs)
