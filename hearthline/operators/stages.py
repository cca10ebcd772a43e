"""What stands between the stages: lookups with precedence, stage joins, stable ids, splits and their evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.rules import Rule, cascade
from hearthline.operators.relational import keep_first
from hearthline.session import written


def left_lookup(left: DataFrame, right: DataFrame, on: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Each left row with columns ``keep`` of the first right row (by ``order``) of its key; blank and null keys match nothing.

    The right side is reduced to one row per key before the join, so no left row is multiplied.
    """
    known = right.where(F.trim(F.col(on)) != "")
    one = keep_first(known.select(on, *dict.fromkeys([*order, *keep])), [on], list(order)).select(F.col(on).alias("_on"), *keep)
    return left.join(one, F.col(on) == F.col("_on"), "left").drop("_on")


def with_counts(left: DataFrame, right: DataFrame, on: str, name: str) -> DataFrame:
    """Each left row with the number of right rows of its key, 0 where there are none."""
    counts = right.where(F.col(on).isNotNull()).groupBy(F.col(on).alias("_on")).agg(F.count(F.lit(1)).alias(name))
    return left.join(counts, F.col(on) == F.col("_on"), "left").drop("_on").withColumn(name, F.coalesce(name, F.lit(0)))


@dataclass(frozen=True)
class RoleSource:
    """One source of roles: a column of the rows themselves, or a table (key, role[, floor]) looked up by a key column.

    With a floor, a row of an earlier year falls through to the next source.
    """

    label: str
    column: Column | None = None
    table: DataFrame | None = None
    key: str = "name_l"
    floor: bool = False


def assign_roles(rows: DataFrame, sources: Sequence[RoleSource], year: str = "year", groups: DataFrame | None = None) -> DataFrame:
    """``rows`` with role, role_source and role_group: the first source, in order, that has a role for the row.

    Tables are reduced to one row per key (the smaller role, then the lower floor) and joined left, so Spark picks the
    strategy by their size. ``groups`` (role, group) maps roles to groups; a role that it doesn't name is its own group.
    """
    out, found = rows, []
    for i, s in enumerate(sources):
        role = s.column
        if s.table is not None:
            t = s.table.select(F.lower(F.trim(s.table.columns[0])).alias(f"_k{i}"), F.col(s.table.columns[1]).alias(f"_r{i}"), (F.col(s.table.columns[2]) if s.floor else F.lit(None).cast("int")).alias(f"_f{i}"))
            t = keep_first(t.where(f"_k{i} <> '' AND _r{i} IS NOT NULL"), [f"_k{i}"], [f"_r{i}", F.coalesce(F.col(f"_f{i}"), F.lit(0))])
            out = out.join(t, F.col(s.key) == F.col(f"_k{i}"), "left")
            role = F.when(F.col(f"_f{i}").isNull() | (F.col(year) >= F.col(f"_f{i}")), F.col(f"_r{i}"))
        found.append(F.when(role.isNotNull(), F.struct(role.alias("role"), F.lit(s.label).alias("source"))))
    out = out.withColumn("_got", F.coalesce(*found)).select(*rows.columns, F.col("_got.role").alias("role"), F.col("_got.source").alias("role_source"))
    if groups is None:
        return out.withColumn("role_group", F.col("role"))
    named = keep_first(groups.select(F.col(groups.columns[0]).alias("_role"), F.col(groups.columns[1]).alias("_group")).dropna(), ["_role"], ["_group"])
    return out.join(named, F.col("role") == F.col("_role"), "left").withColumn("role_group", F.coalesce("_group", "role")).drop("_role", "_group")


def implied_sign(sign: Column, role: Column, rules: Sequence[Rule]) -> Column:
    """The recorded sign, else the one that the role implies by the first rule that matches; null if none does."""
    return F.coalesce(sign, cascade(role, rules))


def says_something(name: Column, sign: Column, anonymous: Column, comment: Column, reference: Column, least: int = 3) -> Column:
    """Whether a row is worth keeping: a name, a sign, an anonymous speaker, a comment of some length or a reference."""
    return (F.coalesce(F.trim(name), F.lit("")) != "") | sign.isNotNull() | (F.coalesce(anonymous, F.lit(0)) == 1) | (F.length(F.trim(F.coalesce(comment, F.lit("")))) >= least) | reference.isNotNull()


def office_holders(rows: DataFrame, holders: DataFrame, name: str = "name_clean", title: str = "title", titles: Sequence[str] = ("supervisor",)) -> DataFrame:
    """Names under one of ``titles`` written as in ``holders`` (alias, canonical); others as they are."""
    known = keep_first(holders.select(F.lower(holders.columns[0]).alias("_alias"), F.col(holders.columns[1]).alias("_canonical")).dropna(), ["_alias"], ["_canonical"])
    out = rows.join(known, F.lower(name) == F.col("_alias"), "left")
    return out.withColumn(name, F.when(F.lower(title).isin(list(titles)), F.coalesce("_canonical", name)).otherwise(F.col(name))).drop("_alias", "_canonical")


def row_ids(rows: DataFrame, order: Sequence[str], name: str, shape: str = "s%07d") -> DataFrame:
    """``rows`` with consecutive ids from 0 by a total order, printed by ``shape``.

    Rows are sorted in ranges, numbered inside their range, and shifted by the counts of the ranges before, so no task
    sees them all.
    """
    ranged = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()), "row-ids")
    before = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    at = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_at", at).join(before, "_range").withColumn(name, F.format_string(shape, F.col("_at") + F.col("_before"))).drop("_range", "_at", "_before")


def commenter_key(name: Column, sender: Column) -> Column:
    """Who wrote: the name, else "anon:" and the sender; null if neither is known."""
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), F.concat(F.lit("anon:"), F.nullif(F.trim(sender), F.lit(""))))


def public_comment(staff: Column, commissioner: Column, role: Column, left_out: Sequence[str]) -> Column:
    """Not of staff or commissioners, and in no role that is left out; rows without a role count."""
    return ~F.coalesce(staff == 1, F.lit(False)) & ~F.coalesce(commissioner == 1, F.lit(False)) & ~F.coalesce(role.isin(list(left_out)), F.lit(False))


def year_fraction(day: Column, places: int = 6) -> Column:
    """Where a day lies on a time line of years."""
    return F.round(F.year(day) + F.dayofyear(day) / F.lit(366.0), places)


def stacked(rows: DataFrame, lane: Sequence[str], order: Sequence[str], name: str, levels: int = 3) -> DataFrame:
    """``rows`` with the level on which a mark is drawn: marks of one place go up by turns. Places hold few marks."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*lane).orderBy(*order)) - 1) % levels)


def tint(share: Column, low: Sequence[int] = (178, 24, 43), middle: Sequence[int] = (247, 247, 247), high: Sequence[int] = (33, 102, 172)) -> Column:
    """#rrggbb of a net share from -1 to 1, between three colours; null stays null."""
    s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), share))
    part = [F.round(F.when(s < 0, m + (F.lit(m) - F.lit(a)) * s).otherwise(m + (F.lit(b) - F.lit(m)) * s)).cast("int") for a, m, b in zip(low, middle, high)]
    return F.when(share.isNotNull(), F.lower(F.format_string("#%02x%02x%02x", *part)))


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table without columns that a rerun adds again; missing ones are no error."""
    return df.drop(*columns)


def stratified_split(rows: DataFrame, label: str, id_: str, share: float, name: str = "held_out") -> DataFrame:
    """``rows`` with a flag for about ``share`` of each label, drawn by a hash of the id: the same at every run and size."""
    point = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(label).cast("string"), F.col(id_).cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return rows.withColumn(name, F.when(F.col(label).isNotNull(), (point < share).cast("int")))


def confusion(rows: DataFrame, truth: str, said: str) -> DataFrame:
    """(truth, said, n, share): how often each label was said for each true one, and its share of the true ones."""
    known = rows.where(F.col(truth).isNotNull() & F.col(said).isNotNull()).groupBy(F.col(truth).alias("truth"), F.col(said).alias("said")).agg(F.count(F.lit(1)).alias("n"))
    total = known.groupBy("truth").agg(F.sum("n").alias("_t"))
    return known.join(total, "truth").select("truth", "said", "n", F.round(F.col("n") / F.col("_t"), 9).alias("share"))


def scores(rows: DataFrame, truth: str, said: str) -> DataFrame:
    """(label, precision, recall, f1) per label."""
    known = rows.where(F.col(truth).isNotNull() & F.col(said).isNotNull()).select(F.col(truth).alias("t"), F.col(said).alias("s"))
    sides = known.select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.lit(1).alias("real"), F.lit(0).alias("given")), F.struct(F.col("s").alias("label"), F.lit(0).alias("real"), F.lit(1).alias("given")))).alias("x"), (F.col("t") == F.col("s")).cast("int").alias("hit"))
    per = sides.groupBy("x.label").agg(F.sum("x.real").alias("real"), F.sum("x.given").alias("given"), (F.sum("hit") / 2).alias("hit"))
    p, r = F.col("hit") / F.nullif("given", F.lit(0)), F.col("hit") / F.nullif("real", F.lit(0))
    return per.select("label", F.round(p, 9).alias("precision"), F.round(r, 9).alias("recall"), F.round(2 * F.col("hit") / (F.col("real") + F.col("given")), 9).alias("f1"))
