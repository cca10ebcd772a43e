"""Filling fixed-capacity containers with items.

The items are described by their length histogram (at most ``capacity`` lengths, whatever the corpus). Over it stands
the configuration linear program: choose how often to use each way of filling a container so that every length is
covered, with as few containers as possible. It is solved approximately by multiplicative weights; the pricing problem,
the most valuable filling at the current weights, is a bounded knapsack solved by dynamic programming. The fractional
solution is rounded down, and what it leaves over is packed by best-fit decreasing on the histogram.

The plan is a table of ranges: "items ranked start..end of length s go to containers base + (rank - start) / per". Its
size follows from the capacity, not from the corpus (a few thousand ways of filling at most, some 5 MB). Items get a
rank within their length from a distributed count (length x salt, with salts in proportion to the number of items), so
no length, however common, is sorted in one task; each rank is then looked up in the plan by binary search.

Defined results: an item longer than the capacity is split into full pieces and a rest; items of length 0 (empty, blank
or null) take no room and all sit in container 0; each row is an item, repeated rows are items of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Items that one task ranks, about, and salts at least.
SALT_ITEMS, SALTS = 250_000, 64
#: Rounds of ``solve``, and after how many of them a plan is tried.
ROUNDS, TRIED = 1000, 50


def _price(sizes: np.ndarray, counts: np.ndarray, weights: np.ndarray, capacity: int) -> np.ndarray:
    """The filling of one container with the largest total weight: the bounded knapsack over all lengths, exactly.

    The copies of a length that fit are cut into lots of 1, 2, 4, .. and a rest, each taken or not, so every number of
    copies up to the bound can be made; dynamic programming runs over the lots, all rooms at once.
    """
    lots: list[tuple[int, int]] = []
    for j, (size, count) in enumerate(zip(sizes.tolist(), counts.tolist())):
        most, lot = min(count, capacity // size), 1
        while most > 0:
            lot = min(lot, most)
            lots.append((j, lot))
            most -= lot
            lot *= 2
    best, taken = np.zeros(capacity + 1), np.zeros((len(lots), capacity + 1), dtype=bool)
    for k, (j, lot) in enumerate(lots):
        room = int(sizes[j]) * lot
        value = best[: capacity + 1 - room] + lot * weights[j]
        np.greater(value, best[room:] + 1e-15, out=taken[k, room:])
        np.maximum(best[room:], value, out=best[room:])
    used, left = np.zeros(len(sizes), dtype=np.int64), capacity
    for k in range(len(lots) - 1, -1, -1):
        if taken[k, left]:
            j, lot = lots[k]
            used[j] += lot
            left -= int(sizes[j]) * lot
    return used


def solve(histogram: dict[int, int], capacity: int, rounds: int | None = None, eta: float = 0.1) -> list[tuple[int, dict[int, int]]]:
    """[(times, {size: per container})], covering every item of the histogram exactly once.

    The covering program by multiplicative weights: each round takes the filling that is worth most at the current
    prices, as often as covers one of its lengths fully, and lowers the price of a length by what was covered of it.
    The rounds are the same whatever the histogram; they end early only when a plan needs no more containers than the
    least there can be, by volume or by the prices (no container holds more than the best filling is worth).
    """
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    if not left:
        return []
    sizes = np.array(sorted(left), dtype=np.int64)
    counts = np.array([left[int(s)] for s in sizes], dtype=np.int64)
    prices = sizes / capacity
    columns: dict[tuple[int, ...], float] = {}
    least, best, fewest = -(-int(sizes @ counts) // capacity), [], None
    rounds = rounds or ROUNDS
    for done in range(1, rounds + 1):
        prices = prices / prices.max()
        used = _price(sizes, counts, prices, capacity)
        least = max(least, int(np.ceil(float(prices @ counts) / float(prices @ used) - 1e-6)))
        share = used / counts
        most = share.max()
        columns[tuple(used)] = columns.get(tuple(used), 0.0) + 1 / most
        prices = prices * np.exp(-eta * share / most)
        if done % TRIED == 0 or done == rounds:
            plan = _rounded(columns, sizes, counts, capacity)
            if fewest is None or sum(times for times, _ in plan) < fewest:
                best, fewest = plan, sum(times for times, _ in plan)
            if fewest <= least:
                break
    return best


def _rounded(columns: dict[tuple[int, ...], float], sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """The plan of a mixture of fillings: scaled to the volume of the items, rounded down within what is left of each length, the rest packed largest first."""
    plan: list[tuple[int, dict[int, int]]] = []
    names = list(columns)
    matrix = np.array(names, dtype=np.int64).T
    mass = np.array([columns[n] for n in names], dtype=float)
    mass *= float(sizes @ counts) / float(sizes @ (matrix @ mass))
    remaining = counts.copy()
    for k in np.argsort(-mass, kind="stable"):
        column = matrix[:, k]
        most = int((remaining[column > 0] // column[column > 0]).min())
        times = min(int(np.floor(mass[k])), most)
        if times > 0:
            plan.append((times, {int(sizes[j]): int(column[j]) for j in np.flatnonzero(column)}))
            remaining -= times * column
    left = {int(s): int(n) for s, n in zip(sizes, remaining) if n}
    # the rest: repeatedly fill one container largest first (best fit over the histogram), as often as the counts allow
    while left:
        room, filling = capacity, {}
        for s in sorted(left, reverse=True):
            if s <= room:
                take = min(room // s, left[s])
                filling[s] = take
                room -= take * s
        times = min(left[s] // k for s, k in filling.items())
        plan.append((times, filling))
        for s, k in filling.items():
            left[s] -= times * k
            if not left[s]:
                del left[s]
    return plan


def ranges(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(size, start, end, base, per): items of a size ranked start <= r < end go to container base + (r - start) // per."""
    out, at, base = [], {}, 1
    for times, filling in plan:
        for s, per in filling.items():
            start = at.get(s, 0)
            out.append((s, start, start + times * per, base, per))
            at[s] = start + times * per
        base += times
    return out


def fill_containers(items: DataFrame, capacity: int = 2048, id_col: str = "doc_id", size_col: str = "size") -> DataFrame:
    """(id, piece INT, size INT, container BIGINT) of every item or piece of a longer item."""
    size = F.col(size_col).cast("bigint")
    pieces = items.select(
        F.col(id_col).alias("_id"),
        F.explode(F.sequence(F.lit(0), F.greatest((F.ceil(size / capacity) - 1).cast("int"), F.lit(0)))).alias("piece"),
        F.coalesce(size, F.lit(0)).alias("_n"),
    ).select("_id", "piece", F.least(F.lit(capacity), F.col("_n") - F.col("piece") * capacity).cast("int").alias("size"))
    salts = max(SALTS, items.count() // SALT_ITEMS)
    # ranks follow the hash and salts are ranges of it, so their number doesn't change who comes where
    pieces = pieces.withColumn("_h", F.xxhash64("_id", "piece")).withColumn("_salt", F.shiftright((F.shiftright("_h", 32) + F.lit(2**31)) * F.lit(salts).cast("bigint"), 32).cast("int"))
    counts = pieces.groupBy("size", "_salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most capacity + 1 rows
    table = ranges(solve(histogram, capacity))
    if 0 in histogram:
        table.append((0, 0, histogram[0], 0, histogram[0]))
    plan = np.array(sorted(table), dtype=np.int64).reshape(-1, 5)
    shift = counts.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = pieces.withColumn("_r", F.row_number().over(Window.partitionBy("size", "_salt").orderBy("_h", "_id", "piece")) - 1)
    ranked = ranked.join(shift.select("size", "_salt", F.coalesce("before", F.lit(0)).alias("_before")), ["size", "_salt"])
    ranked = ranked.select(F.col("_id").alias(id_col), "piece", "size", (F.col("_r") + F.col("_before")).alias("container"))
    return ranked.mapInArrow(_placed(plan), ranked.schema)


def _placed(plan: np.ndarray):
    """Turn the rank in column ``container`` into the container, by binary search in the plan (size, start, end, base, per)."""
    firsts = np.searchsorted(plan[:, 0], np.arange(plan[-1, 0] + 2)) if len(plan) else np.zeros(1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "container"))
            out = np.empty(len(rank), dtype=np.int64)
            for s in np.unique(size).tolist():
                mine = np.flatnonzero(size == s)
                rows = plan[firsts[s] : firsts[s + 1]]
                hit = rows[np.searchsorted(rows[:, 1], rank[mine], side="right") - 1]
                out[mine] = hit[:, 3] + (rank[mine] - hit[:, 1]) // hit[:, 4]
            columns = [pa.array(out, pa.int64()) if n == "container" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run
