"""Relational operators that Spark has no one verb for, as compositions Catalyst can optimise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.session import written


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order: missing ones as typed nulls, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by a total order. Nulls in keys are equal. Partial aggregation, no window over whole groups."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def keep_first_resolvable(df: DataFrame, keys: Sequence[str], must: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_first``, but rows with a null in ``must`` are kept as they are."""
    known = F.lit(True)
    for c in must:
        known = known & F.col(c).isNotNull()
    return keep_first(df.where(known), keys, order).unionByName(df.where(~known))


def first_non_null(c: str, order: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))


def last_non_null(c: str, order: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))


def mode_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, mode, n_mode, n, n_values): the commonest value per key, the smaller of equals. Two aggregations, both partial."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col("_n").alias("n")), F.struct(-F.col("_n"), F.col(value)))
    out = counts.groupBy(*keys).agg(best.alias("_b"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_values"))
    return out.select(*keys, F.col("_b.v").alias("mode"), F.col("_b.n").alias("n_mode"), "n", "n_values")


def asof_forward(left: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str, right_id: str, how: str = "left", block: int | None = None) -> DataFrame:
    """Each left row with the first right row of its key at or after its time; ties take the smaller id.

    One pass over the union of both sides, ordered backwards in time inside a key: each left row takes the last right
    row seen, a running value, so no pairs are formed. ``block`` splits a very large key into blocks of that many time
    units; a row whose block has no later right row takes the first of the next block that has one, from a small table
    of block heads. Rows without key or time match nothing; ``how="inner"`` drops them.
    """
    at = F.col(left_on).cast("double") if dict(left.dtypes)[left_on] != "date" else F.unix_date(left_on).cast("double")
    rat = F.col(right_on).cast("double") if dict(right.dtypes)[right_on] != "date" else F.unix_date(right_on).cast("double")
    heads = right.where(F.col(by).isNotNull() & F.col(right_on).isNotNull()).groupBy(F.col(by).alias("_k"), rat.alias("_t")).agg(F.min(right_id).alias("_id"), F.min(right_on).alias("_rt"))
    slot = F.floor(F.col("_t") / F.lit(block)) if block else F.lit(0)
    rights = heads.select("_k", "_t", slot.alias("_b"), F.lit(0).alias("_side"), F.struct("_id", "_rt").alias("_hit"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    lefts = left.where(F.col(by).isNotNull() & F.col(left_on).isNotNull()).select(F.col(by).alias("_k"), at.alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(rights.schema["_hit"].dataType).alias("_hit"), F.struct(*left.columns).alias("_row")).withColumn("_b", slot)
    rows = rights.unionByName(lefts)
    back = Window.partitionBy("_k", "_b").orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_hit", F.last("_hit", ignorenulls=True).over(back)).where("_side = 1")
    if block:
        first = heads.groupBy("_k", slot.alias("_b")).agg(F.min_by(F.struct("_id", "_rt"), "_t").alias("_first"))
        edges = first.unionByName(lefts.select("_k", "_b").distinct().withColumn("_first", F.lit(None).cast(first.schema["_first"].dataType)))
        edges = edges.groupBy("_k", "_b").agg(F.max("_first").alias("_first"))
        after = Window.partitionBy("_k").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.withColumn("_next", F.last("_first", ignorenulls=True).over(after)).select("_k", "_b", "_next")
        rows = rows.join(edges, ["_k", "_b"], "left").withColumn("_hit", F.coalesce("_hit", "_next"))
    out = rows.select("_row.*", F.col("_hit._id").alias(right_id), F.col("_hit._rt").alias(right_on))
    if how == "inner":
        return out
    missing = left.where(F.col(by).isNull() | F.col(left_on).isNull())
    return out.unionByName(missing.withColumn(right_id, F.lit(None).cast(out.schema[right_id].dataType)).withColumn(right_on, F.lit(None).cast(out.schema[right_on].dataType)))


def nearest_number(left: DataFrame, right: DataFrame, by: str, number: str, tolerance: int, keep: Sequence[str]) -> DataFrame:
    """Each left row with the right row of its key whose number is nearest within a tolerance; ties take the lower number.

    The number is cut into bins of the tolerance, right rows go to their bin and both neighbours, so the join is an
    equi-join on (key, bin) and a key that holds many rows is spread over its bins.
    """
    bin_ = F.floor(F.col(number) / tolerance)
    lefts = left.withColumn("_bin", bin_)
    spread = right.select(by, F.col(number).alias("_near"), *keep).withColumn("_bin", F.explode(F.array(*[F.floor(F.col("_near") / tolerance) + d for d in (-1, 0, 1)])))
    hits = lefts.select(by, number, "_bin").distinct().join(spread, [by, "_bin"]).where(F.abs(F.col("_near") - F.col(number)) <= tolerance)
    best = hits.groupBy(by, number).agg(F.min_by(F.struct("_near", *keep), F.struct(F.abs(F.col("_near") - F.col(number)), F.col("_near"), *keep)).alias("_best"))
    return left.join(best, [by, number], "left").select(*left.columns, F.col("_best._near").alias("near_" + number), *[F.col(f"_best.{k}").alias(k) for k in keep])


def within_interval(df: DataFrame, spans: DataFrame, key: str, at: str, lo: str, hi: str, name: str, id_: str) -> DataFrame:
    """``df`` with a flag ``name``: its key has a span that holds its date. Spans are first merged per key into one array-free lookup: an equi-join with a range test, reduced by ``id_``."""
    hit = df.select(id_, key, at).join(spans.select(F.col(key), F.col(lo).alias("_lo"), F.col(hi).alias("_hi")), key).where(F.col(at).between(F.col("_lo"), F.col("_hi"))).select(id_).distinct().withColumn("_hit", F.lit(1))
    return df.join(hit, id_, "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")


def fallback(df: DataFrame, tiers: Sequence[tuple[str, DataFrame, str]], value: str) -> DataFrame:
    """Fill ``value`` from lookups tried in order: (source label, table (key, value), key column of df). Adds ``<value>_source``."""
    out, found, label = df, F.lit(None), F.lit(None).cast("string")
    for i, (source, table, key) in enumerate(tiers):
        one = table.select(F.col(table.columns[0]).alias(f"_k{i}"), F.col(table.columns[1]).alias(f"_v{i}")).where(F.col(f"_k{i}").isNotNull()).groupBy(f"_k{i}").agg(F.min(f"_v{i}").alias(f"_v{i}"))
        out = out.join(one, F.col(key) == F.col(f"_k{i}"), "left")
        label = F.coalesce(label, F.when(F.col(f"_v{i}").isNotNull(), F.lit(source)))
        found = F.coalesce(found, F.col(f"_v{i}")) if i else F.col(f"_v{i}")
    return out.select(*df.columns, found.alias(value), label.alias(f"{value}_source"))


def union_aligned(*frames: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Rows of all frames over the union of their columns, ``lead`` first."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    first = [c for c in lead if c in out.columns]
    return out.select(*first, *[c for c in sorted(out.columns) if c not in first])


def copy_referenced(rows: DataFrame, refs: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Rows of ``refs`` that point to another group (same ``keys``) replaced by copies of that group's ``rows``; others stay, tagged.

    ``refs`` holds (ref_id, keys) of references, ``rows`` the candidate rows with the keys; chains are not followed.
    """
    hit = refs.join(rows, list(keys)).withColumn("resolution", F.lit("copied"))
    miss = refs.join(rows.select(*keys).distinct(), list(keys), "left_anti").withColumn("resolution", F.lit(tag))
    return hit.unionByName(miss, allowMissingColumns=True)


def any_mixed(df: DataFrame, key: str, value: str, a: str, b: str) -> DataFrame:
    """Keys in which both values occur (nulls in the key are left out)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or(F.col(value) == a).alias("_a"), F.bool_or(F.col(value) == b).alias("_b")).where("_a AND _b").select(key)


def split_mixed(df: DataFrame, key: str, value: str, a: str, b: str, name: str) -> DataFrame:
    """``name``: the key, with the row's value in brackets where the key is mixed."""
    mixed = any_mixed(df, key, value, a, b).withColumn("_mixed", F.lit(True))
    labelled = F.when(F.col("_mixed"), F.concat(F.col(key), F.lit(" ["), F.coalesce(F.col(value), F.lit("unclear")), F.lit("]"))).otherwise(F.col(key))
    return df.join(mixed, key, "left").withColumn(name, labelled).drop("_mixed")


def components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, label): connected components of (a, b), each labelled with its smallest node.

    Rounds of minimum label over neighbours with a pointer jump, each written to the shared folder; a component of
    diameter d takes about log d rounds. Edges with nulls are ignored. Nothing is gathered on the driver but a count.
    """
    both = edges.select("a", "b").dropna().where("a <> b").distinct()
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    base = both.select(F.col("a").alias("node"))
    if nodes is not None:
        base = base.unionByName(nodes.select(F.col(nodes.columns[0]).alias("node")))
    labels = written(base.dropna().distinct().withColumn("label", F.col("node")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        step = labels.join(near, "node", "left").select("node", F.least("label", "m").alias("next"), F.col("label").alias("old"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = written(step.join(jump, "next", "left").select("node", F.least("next", "far").alias("label"), "old"), "cc-labels")
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def blocked_pairs(names: DataFrame, keys: Sequence[Column], columns: Sequence[str], least: str, block: int = 2048) -> DataFrame:
    """Pairs of rows that share any block key, the smaller ``least`` first, each once: an equi-join on exploded keys.

    Only ``least``, which must be unique, goes through the self-join, where large blocks are cut (``pairs_within``); the
    other columns follow by two joins.
    """
    rows = names.select(least, F.explode(F.array_distinct(F.array(*keys))).alias("_key")).where("_key IS NOT NULL")
    pairs = pairs_within(rows, ["_key"], least, block).select(f"{least}_a", f"{least}_b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(names.select(*[F.col(c).alias(f"{c}_{side}") for c in columns]), f"{least}_{side}")
    return pairs


def edit_pairs(names: DataFrame, block: Column, name: str, most: int = 2) -> DataFrame:
    """(name_a, name_b) of one block that may lie within ``most`` edits of each other, ignoring case; none that do is missed.

    A name is cut into ``most`` + 1 segments; so many edits leave one of them whole, moved by at most as many places. The
    shorter name of a pair is filed under its segments, the longer one looks for them at all places they can have moved
    to, so a block is not compared pair by pair, however many names it holds.
    """
    rows = names.select(F.col(name).alias("_n"), block.alias("_b"), F.lower(name).alias("_s")).where("_b IS NOT NULL").distinct()
    size, segments = F.length("_s"), most + 1

    def begin(length: Column, i: Column) -> Column:
        return F.floor(length * i / segments).cast("int")

    def keys(length: Column, shifts: range) -> Column:
        def key(i: Column) -> Column:
            at, width = begin(length, i), begin(length, i + 1) - begin(length, i)
            return F.array(*[F.when(at + d >= 0, F.struct(length.cast("int").alias("len"), i.cast("int").alias("i"), F.substring("_s", at + d + 1, width).alias("t"))) for d in shifts])

        return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(most)), key)), lambda k: k.isNotNull())

    filed = rows.select("_b", F.col("_n").alias("_x"), F.explode(keys(size, range(0, 1))).alias("_k"))
    looking = rows.select("_b", F.col("_n").alias("_y"), F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(size - most, F.lit(0)), size), lambda n: keys(n, range(-most, most + 1)))))).alias("_k"))
    met = filed.join(looking, ["_b", "_k"]).where("_x <> _y")
    return met.select(F.least("_x", "_y").alias(f"{name}_a"), F.greatest("_x", "_y").alias(f"{name}_b")).distinct()


def resolve_chain(edges: DataFrame, source: str, target: str, max_rounds: int = 20) -> DataFrame:
    """(source, target) with every target followed to the end of its chain."""
    out = edges.select(source, target)
    for _ in range(max_rounds):
        hop = edges.select(F.col(source).alias(target), F.col(target).alias("_next"))
        step = written(out.join(hop, target, "left").select(source, F.coalesce("_next", target).alias(target), F.col("_next").isNotNull().alias("_moved")), "chain")
        out = step.select(source, target)
        if step.where("_moved").limit(1).count() == 0:
            return out
    raise RuntimeError("chains did not end; is there a cycle?")


def pairs_within(members: DataFrame, keys: Sequence[str], value: str, block: int = 2048) -> DataFrame:
    """(keys, value_a, value_b): the pairs of values that share a key, the smaller value first, each once per key.

    A key of more than ``block`` rows is cut into blocks of about that many, and each pair of blocks is a join key of its
    own, so no task pairs more than ``block`` rows with as many, however hot the key. Rows with nulls are in no pair;
    repeated (key, value) rows must have been folded before.
    """
    rows = members.select(*keys, value).dropna()
    big = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_cuts")).where("_cuts > 1")
    rows = rows.join(big, list(keys), "left").withColumn("_cuts", F.coalesce("_cuts", F.lit(1)))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64(value), F.col("_cuts")).cast("int"))
    left = rows.select(*keys, F.col(value).alias("_x"), F.col("_own").alias("_i"), F.explode(F.sequence(F.col("_own"), F.col("_cuts") - 1)).alias("_j"))
    right = rows.select(*keys, F.col(value).alias("_y"), F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"), F.col("_own").alias("_j"))
    met = left.join(right, [*keys, "_i", "_j"]).where((F.col("_i") < F.col("_j")) & (F.col("_x") != F.col("_y")) | (F.col("_x") < F.col("_y")))
    return met.select(*keys, F.least("_x", "_y").alias(f"{value}_a"), F.greatest("_x", "_y").alias(f"{value}_b"))
