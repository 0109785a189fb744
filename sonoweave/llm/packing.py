"""Filling fixed-capacity containers with documents (bin completion).

Only sizes matter to the packing, so it is planned on the histogram of sizes: at
most ``capacity`` rows per container kind, whatever the corpus.  A plan is a list
of *fillings*, each a multiset of sizes and the number of containers filled so.
Documents of one size are then dealt to the plan's places by their rank among
equals.  The rank is taken in two levels (counts per hash bucket, then a rank in
the bucket), so a size that a third of all documents share is ranked by as many
tasks as there are buckets, and there are more of them the more documents share one.

The search has a budget (:class:`Search`): it ends with the best packing found,
which is never worse than best fit.  ``EXACT`` has none and ends with the least
number of containers; its time is exponential in the number of different fillings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoweave.llm.tokens import BYTE_BPE_50K, count_tokens
from sonoweave.session import reliable

#: Items of one size that are ranked by one task, about.
RANK_ROWS = 1 << 18
#: Bytes of a dealing table that may be broadcast; a larger one is joined.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Search:
    """How far a search goes: fillings kept per branching, nodes for finding them, branchings; and whether a filling is
    applied as often as it can be at once.  ``math.inf`` is no bound."""

    keep: float = 3
    budget: float = 400
    nodes: float = 20_000
    at_once: bool = True


EXACT = Search(math.inf, math.inf, math.inf, at_once=False)


@dataclass(frozen=True)
class Filling:
    """``times`` containers that each hold ``sizes`` (descending)."""

    sizes: tuple[int, ...]
    times: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing over a histogram, the incumbent of the search.

    Equal items fall into equal containers, so runs of them are placed at once:
    ``open_bins`` maps a remaining space to the fillings that have it.
    """
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_bins if r >= size), default=None)
            if room is None:
                each = capacity // size
                full, rest = divmod(left, each)
                for times, n in ((full, each), (1, rest)):
                    if times and n:
                        open_bins.setdefault(capacity - n * size, []).append(((size,) * n, times))
                left = 0
                continue
            sizes, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            each = room // size
            full, rest = divmod(left, each)
            used = min(times, full)
            if used:
                open_bins.setdefault(room - each * size, []).append((sizes + (size,) * each, used))
                left -= used * each
            if used < times:
                if left:  # fewer than fill one such container
                    open_bins.setdefault(room - left * size, []).append((sizes + (size,) * left, 1))
                    left, used = 0, used + 1
                if used < times:
                    open_bins.setdefault(room, []).append((sizes, times - used))
    merged: dict[tuple[int, ...], int] = {}
    for fillings in open_bins.values():
        for sizes, times in fillings:
            merged[sizes] = merged.get(sizes, 0) + times
    return [Filling(tuple(sorted(s, reverse=True)), n) for s, n in merged.items()]


def _dominated(small: tuple[int, ...], big: tuple[int, ...]) -> bool:
    """Can the items of ``small`` be put into places the size of ``big``'s items?  (First fit: a sufficient test.)"""
    places = list(big)
    for item in small:
        for i, place in enumerate(places):
            if item <= place:
                places[i] = place - item
                break
        else:
            return False
    return True


def completions(counts: dict[int, int], sizes: list[int], room: int, keep: float, budget: float) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` around the largest item, least waste first.

    Depth first over sizes in descending order; a branch ends where nothing fits.
    ``budget`` bounds the nodes, and ``keep`` exact fillings end the search: they
    cannot be dominated by a filling that wastes space.
    """
    import bisect

    ascending = sizes[::-1]
    found: list[tuple[int, tuple[int, ...]]] = []
    nodes = 0
    exact = 0

    def visit(room: int, upto: int, chosen: tuple[int, ...]) -> None:
        """Sizes below index ``upto`` may still be used; copies of one size are taken together, so the
        depth is the number of distinct sizes in a filling: under the root of twice the room."""
        nonlocal nodes, exact
        i = min(bisect.bisect_right(ascending, room), upto)
        if i == 0:
            found.append((room, chosen))
            return
        while i > 0 and nodes < budget and exact < keep:
            size = ascending[i - 1]
            for copies in range(min(counts[size], room // size), 0, -1):
                if nodes >= budget or exact >= keep:
                    return
                nodes += 1
                rest, taken = room - copies * size, chosen + (size,) * copies
                if rest == 0:
                    found.append((0, taken))
                    exact += 1
                    continue
                j = bisect.bisect_left(ascending, rest, 0, i - 1)
                if j < i - 1 and ascending[j] == rest:  # one smaller item closes it exactly
                    found.append((0, (*taken, rest)))
                    exact += 1
                visit(rest, i - 1, taken)
            i -= 1

    visit(room, len(ascending), ())
    found.sort(key=lambda f: (f[0], len(f[1])))
    kept: list[tuple[int, ...]] = []
    for waste, filling in found:
        if filling not in kept and not any(_dominated(filling, k) for k in kept):
            kept.append(filling)
        if len(kept) >= keep:
            break
    return kept or [()]


def bin_completion(counts: dict[int, int], capacity: int, search: Search = Search()) -> list[Filling]:
    """Pack ``counts`` (size -> number) into as few containers of ``capacity`` as the search finds.

    The largest item left must lie in some container: branch over its undominated
    fillings, applying one as often as the counts allow.  A branch is cut where
    the containers so far plus the least number for the rest (its total over the
    capacity, rounded up: the waste bound) cannot beat the incumbent, which is
    best-fit decreasing at first.  ``search`` bounds it; the incumbent is a
    whole packing at any time, so nothing is ever left out.
    """
    counts = {int(s): int(n) for s, n in counts.items() if n > 0}
    if any(s <= 0 or s > capacity for s in counts):
        raise ValueError("sizes must lie in 1..capacity")
    total = sum(s * n for s, n in counts.items())
    least = -(-total // capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(f.times for f in best)
    # a stack of decisions: fillings still to try at this depth, and what the chosen one took
    left, done, bins, used_total = dict(counts), [], 0, 0
    stack: list[list] = []
    visited = 0

    def options() -> list[tuple[int, ...]]:
        sizes = sorted(left, reverse=True)
        first = sizes[0]
        rest = dict(left)
        rest[first] -= 1
        if not rest[first]:
            del rest[first]
        return [(first, *c) for c in completions(rest, sorted(rest, reverse=True), capacity - first, search.keep, search.budget)]

    def undo(taken: Filling) -> None:
        nonlocal bins, used_total
        for s in taken.sizes:
            left[s] = left.get(s, 0) + taken.times
        bins -= taken.times
        used_total -= sum(taken.sizes) * taken.times

    if best_bins > least:
        stack.append([options(), None])
    while stack and visited < search.nodes and best_bins > least:
        todo, taken = stack[-1]
        if taken is not None:
            undo(taken)
            done.pop()
            stack[-1][1] = None
        if not todo:
            stack.pop()
            continue
        sizes = todo.pop(0)
        visited += 1
        need: dict[int, int] = {}
        for s in sizes:
            need[s] = need.get(s, 0) + 1
        filling = Filling(sizes, min(left[s] // n for s, n in need.items()) if search.at_once else 1)
        for s, n in need.items():
            left[s] -= n * filling.times
            if not left[s]:
                del left[s]
        bins += filling.times
        used_total += sum(sizes) * filling.times
        done.append(filling)
        stack[-1][1] = filling
        if bins + -(-(total - used_total) // capacity) >= best_bins:
            continue
        if not left:
            best, best_bins = list(done), bins
            continue
        stack.append([options(), None])
    return best


def plan_containers(histogram: dict[int, int], capacity: int, search: Search = Search()) -> dict[str, np.ndarray]:
    """The dealing table of a capacity: sorted ranges of (size, rank) and the containers they go to."""
    fillings = bin_completion(histogram, capacity, search)
    size, first, base, per, times = [], [], [], [], []
    taken: dict[int, int] = {}
    container = 0
    for f in fillings:
        need: dict[int, int] = {}
        for s in f.sizes:
            need[s] = need.get(s, 0) + 1
        for s, n in need.items():
            size.append(s)
            first.append(taken.get(s, 0))
            base.append(container)
            per.append(n)
            times.append(f.times)
            taken[s] = taken.get(s, 0) + n * f.times
        container += f.times
    order = np.lexsort((first, size)) if size else np.array([], dtype=np.int64)
    pick = lambda a: np.array(a, dtype=np.int64)[order] if len(order) else np.array([], dtype=np.int64)
    return {"size": pick(size), "first": pick(first), "base": pick(base), "per": pick(per), "times": pick(times), "containers": np.int64(container)}


def item_sizes(sizes: DataFrame, capacities: DataFrame) -> DataFrame:
    """``size_name, capacity, doc_id, tokens, item``: what of each document shares a container.

    A document no longer than the capacity is one item.  A longer one fills
    ``tokens // capacity`` containers alone and leaves an item of the remainder
    (0: none).  Documents without tokens need no place and do not appear.
    """
    kinds = capacities.select("size_name", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    # the kinds are configuration, a fixed handful of rows: they become a constant in the plan
    known = kinds.where(F.col("size_name").isNotNull() & (F.col("capacity") > 0)).distinct().collect()
    each = [F.struct(F.lit(k["size_name"]).alias("size_name"), F.lit(k["capacity"]).cast("bigint").alias("capacity")) for k in sorted(known)]
    none = F.array().cast("array<struct<size_name:string,capacity:bigint>>")
    return (
        sizes.where(F.col("tokens") > 0)
        .select("doc_id", "tokens", F.explode(F.array(*each) if each else none).alias("_k"))
        .select("_k.size_name", "_k.capacity", "doc_id", "tokens")
        .withColumn("item", F.when(F.col("tokens") <= F.col("capacity"), F.col("tokens")).otherwise(F.col("tokens") % F.col("capacity")))
    )


def ranked_items(items: DataFrame, buckets: int = 64) -> DataFrame:
    """``items`` with ``rank``: a number from 0 among the items of one kind and size, each number once."""
    spread = items.withColumn("_b", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    keys = ["size_name", "item", "_b"]
    offsets = (
        spread.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .withColumn("_o", F.sum("_n").over(Window.partitionBy("size_name", "item").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
        .select(*keys, F.coalesce("_o", F.lit(0)).alias("_o"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id")) - 1
    return spread.withColumn("_r", inside).join(offsets, keys).withColumn("rank", F.col("_r") + F.col("_o")).drop("_b", "_r", "_o")


PACKED = "size_name string, container bigint, doc_id bigint, token_from bigint, token_to bigint"


def _dealt_by_search(ranked: DataFrame, plans: dict[str, dict[str, np.ndarray]]) -> DataFrame:
    """The shared containers' rows, by binary search in the broadcast dealing tables."""
    tables = ranked.sparkSession.sparkContext.broadcast(plans)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("size_name").to_pylist(), dtype=object)
            item = batch.column("item").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            where = np.zeros(len(item), dtype=np.int64)
            for name in set(names.tolist()):
                t = tables.value[name]
                rows = np.flatnonzero(names == name)
                # one sorted key of (size, rank): ranks stay far below 2**40
                at = np.searchsorted((t["size"] << 40) + t["first"], (item[rows].astype(np.int64) << 40) + rank[rows], side="right") - 1
                where[rows] = t["base"][at] + (rank[rows] - t["first"][at]) // t["per"][at]
            full = (batch.column("tokens").to_numpy(zero_copy_only=False) - item).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("size_name"), pa.array(where), batch.column("doc_id"), pa.array(full), batch.column("tokens")],
                names=["size_name", "container", "doc_id", "token_from", "token_to"],
            )

    return ranked.mapInArrow(deal, PACKED)


def _dealt_by_join(ranked: DataFrame, plans: dict[str, dict[str, np.ndarray]]) -> DataFrame:
    """The same by a join: a range of ranks is cut into its containers, each a row with the ranks it takes.

    The join is by kind, size and a stretch of ranks, so that no size is one group.
    """
    fields = ("size", "first", "base", "per", "times")
    rows = [(name, *map(int, r)) for name, t in plans.items() for r in zip(*(t[f] for f in fields), strict=True)]
    table = ranked.sparkSession.createDataFrame(rows, "size_name string, item bigint, first bigint, base bigint, per bigint, times bigint")
    stretch = lambda rank: F.shiftright(rank, 12)
    last = F.col("first") + F.col("per") * F.col("times") - 1
    table = table.select("size_name", "item", "first", "base", "per", last.alias("last"), F.explode(F.sequence(stretch(F.col("first")), stretch(last))).alias("_s"))
    met = ranked.withColumn("_s", stretch(F.col("rank"))).join(table, ["size_name", "item", "_s"]).where(F.col("rank").between(F.col("first"), F.col("last")))
    container = F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("per"))
    return met.select("size_name", container.cast("bigint").alias("container"), "doc_id", (F.col("tokens") - F.col("item")).alias("token_from"), F.col("tokens").alias("token_to"))


def pack_documents(documents: DataFrame, capacities: DataFrame, path: str = BYTE_BPE_50K, search: Search = Search()) -> DataFrame:
    """Every document with tokens in a container of each capacity.

    Columns ``size_name, container bigint, doc_id, token_from, token_to``: the
    container holds the document's tokens ``token_from..token_to``.  A document
    that fits comes out as one row, whole.  A longer one has a row per container
    it fills alone and one for its remainder, which shares a container.  Containers
    are numbered from 0 per kind, those of over-long documents' full parts after
    the shared ones (by a number derived from ``doc_id`` ranks, without holes).

    Null and empty texts need no place.  Capacities that are null or not positive
    are no containers.  Repeated documents are separate items.  No document or no
    capacity gives an empty result.

    ``search`` bounds the search for fillings; ``EXACT`` needs the least number of shared containers.

    Collected to the driver: the histogram of item sizes, at most the sum of the
    capacities in rows.
    """
    return packed(reliable(count_tokens(documents, path)), capacities, search)


def packed(sizes: DataFrame, capacities: DataFrame, search: Search = Search()) -> DataFrame:
    """As :func:`pack_documents`, of ``sizes(doc_id, tokens)``."""
    items = item_sizes(sizes, capacities)
    shared = items.where(F.col("item") > 0)
    plans: dict[str, dict[str, np.ndarray]] = {}
    histograms: dict[tuple[str, int], dict[int, int]] = {}
    most, full_items = 0, {}
    over = F.sum((F.col("tokens") > F.col("capacity")).cast("bigint")).alias("over")
    for row in items.groupBy("size_name", "capacity", "item").agg(F.count("*").alias("n"), over).collect():
        full_items[row["size_name"]] = full_items.get(row["size_name"], 0) + row["over"]
        if row["item"]:
            histograms.setdefault((row["size_name"], row["capacity"]), {})[row["item"]] = row["n"]
            most = max(most, row["n"])
    for (name, capacity), histogram in histograms.items():
        plans[name] = plan_containers(histogram, capacity, search)
    buckets = 1 + max(most, *full_items.values(), 0) // RANK_ROWS

    ranked = ranked_items(shared, buckets).select("size_name", "item", "rank", "tokens", "doc_id")
    small = sum(a.nbytes for t in plans.values() for a in t.values()) <= BROADCAST_BYTES
    dealt = (_dealt_by_search if small else _dealt_by_join)(ranked, plans)
    # whole containers of over-long documents, numbered on from the shared ones
    after = {name: int(t["containers"]) for name, t in plans.items()}
    wholes = (
        items.where(F.col("tokens") > F.col("capacity"))
        .withColumn("_k", F.floor(F.col("tokens") / F.col("capacity")))
        .withColumn("_b", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    )
    in_bucket = Window.partitionBy("size_name", "_b").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before_bucket = Window.partitionBy("size_name").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = wholes.groupBy("size_name", "_b").agg(F.sum("_k").alias("_n")).select(
        "size_name", "_b", F.coalesce(F.sum("_n").over(before_bucket), F.lit(0)).alias("_o")
    )
    base = F.lit(0).cast("bigint")
    for name, n in after.items():
        base = F.when(F.col("size_name") == name, F.lit(n)).otherwise(base)
    wholes = (
        wholes.withColumn("_i", F.coalesce(F.sum("_k").over(in_bucket), F.lit(0)))
        .join(starts, ["size_name", "_b"])
        .select("size_name", "doc_id", "capacity", (base + F.col("_i") + F.col("_o")).alias("_c"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1)).alias("_j"))
        .select("size_name", (F.col("_c") + F.col("_j")).alias("container"), "doc_id", (F.col("_j") * F.col("capacity")).alias("token_from"), ((F.col("_j") + 1) * F.col("capacity")).alias("token_to"))
    )
    return dealt.unionByName(wholes)


def container_fill(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per kind: containers used, tokens held and the share of space left unused."""
    held = packed.groupBy("size_name").agg(
        (F.max("container") + 1).alias("containers"), F.sum(F.col("token_to") - F.col("token_from")).alias("tokens")
    )
    room = F.col("containers") * F.col("capacity_tokens")
    return held.join(F.broadcast(capacities.select("size_name", "capacity_tokens").distinct()), "size_name").select(
        "size_name", "capacity_tokens", "containers", "tokens", (1 - F.col("tokens") / room).alias("unused_share")
    )
