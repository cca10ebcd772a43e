"""Matching records by nearest time: a two-pointer streaming merge over co-partitioned, sorted rows.

Both sides are tagged, unioned, partitioned by (entity, time block) and sorted inside the partitions. A record of the
right side is placed ``tolerance`` days before its own day, so when a left record arrives, every right record that can
match it has been seen, and only right records within the tolerance on either side are held: at most 2 * tolerance + 1
distinct days, whatever the size of the entity. Time blocks split an entity that holds a large share of all rows; a
right record is copied into the (at most two, for tolerance <= block) blocks that its window touches. Ids stay 64-bit
integers all the way.

Defined results: rows with a null entity or day match nothing; repeated rows give one row; of right records on one day
the smallest id counts; of two days equally far away the smaller id wins; an empty side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_DAYS = 56


def _merge(tolerance: int):
    """The merge over Arrow batches: the two neighbours of each left record are looked up among the right records held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, days, ids = None, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)  # the right records held of the group ``last``
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, block = batch.column("_k"), batch.column("_b")
            new = pc.or_(pc.not_equal(key.slice(1), key.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1))).to_numpy(zero_copy_only=False)
            group = np.append(0, np.cumsum(new.astype(np.int64)))
            head, tail = (key[0].as_py(), block[0].as_py()), (key[n - 1].as_py(), block[n - 1].as_py())
            if head != last:
                days, ids = days[:0], ids[:0]
            at = batch.column("_at").to_numpy().astype(np.int64)
            is_left = batch.column("_l").is_valid().to_numpy(zero_copy_only=False)
            place = np.flatnonzero(~is_left)
            right_group = np.append(np.zeros(len(days), dtype=np.int64), group[place])
            right_day = np.append(days, at[place] + tolerance)
            right_id = np.append(ids, batch.column("_r").take(pa.array(place)).to_numpy().astype(np.int64))
            # one number orders groups and days; a group spans far fewer days than the step between groups
            step, low = 1 << 24, 1 << 23
            rights, mine = right_group * step + right_day + low, np.flatnonzero(is_left)
            t = group[mine] * step + at[mine] + low
            after = np.searchsorted(rights, t)
            far = np.int64(1) << 62
            padded, who = np.concatenate(([-far], rights, [far])), np.concatenate(([0], right_id, [0]))
            gap_before, gap_after = t - padded[after], padded[after + 1] - t
            first = (gap_before < gap_after) | (gap_before == gap_after) & (who[after] < who[after + 1])
            hit = np.minimum(gap_before, gap_after) <= tolerance
            chosen = np.where(first, who[after], who[after + 1])[hit]
            yield pa.RecordBatch.from_arrays([batch.column("_l").take(pa.array(mine[hit])), pa.array(chosen, pa.int64())], ["left_id", "right_id"])
            keep = (right_group == group[-1]) & (right_day >= at[-1] - tolerance)
            last, days, ids = tail, right_day[keep], right_id[keep]

    return run


def nearest_in_time(left: DataFrame, right: DataFrame, tolerance: int = 14, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Pair each left record with the nearest right record of its entity.

    ``left``: (id STRING, entity STRING, day INT); ``right``: (id BIGINT, entity STRING, day INT); other columns are
    ignored. Returns (left_id STRING, right_id BIGINT), one row per matched (id, entity, day) of the left side.
    """
    lefts = left.select(F.col("entity").alias("_k"), F.col("day").alias("_at"), F.col("id").alias("_l")).dropna().distinct()
    rights = right.select("entity", "day", "id").dropna().groupBy("entity", "day").agg(F.min("id").alias("_r"))
    lefts = lefts.select("_k", F.floor(F.col("_at") / block_days).cast("int").alias("_b"), "_at", "_l", F.lit(None).cast("bigint").alias("_r"))
    rights = rights.select(
        F.col("entity").alias("_k"),
        F.explode(F.sequence(F.floor((F.col("day") - tolerance) / block_days).cast("int"), F.floor((F.col("day") + tolerance) / block_days).cast("int"))).alias("_b"),
        (F.col("day") - tolerance).alias("_at"),
        F.lit(None).cast("string").alias("_l"),
        "_r",
    )
    rows = lefts.unionByName(rights).repartition("_k", "_b").sortWithinPartitions("_k", "_b", "_at", F.col("_l").asc_nulls_first())
    return rows.select("_k", "_b", "_at", "_l", "_r").mapInArrow(_merge(tolerance), "left_id string, right_id bigint")
