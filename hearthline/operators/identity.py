"""Who is one commenter: blocked comparison, corroboration, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.operators.names import indel_ratio, token_sort
from hearthline.operators.relational import blocked_pairs, components

#: Similarity of whole names and of surnames, spread of a surname that can still corroborate, years apart.
NAME_MIN, SURNAME_MIN, COMMON_SURNAME, NEAR_YEARS = 90, 60, 20, 2
RARE_FIRST = 12


def name_key(c: Column) -> Column:
    """Lower case letters, apostrophes and hyphens only; "JoanDoe" is read as "Joan Doe"."""
    t = F.trim(c)
    glued = F.regexp_extract(t, r"^[A-Z][a-z]+(?=[A-Z][a-z])", 0)
    spaced = F.when(glued != "", F.concat_ws(" ", glued, F.substr(t, F.length(glued) + 1))).otherwise(t)
    words = F.transform(F.split(F.lower(spaced), r"\s+"), lambda w: F.regexp_replace(w, "[^a-z'-]", ""))
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


def profiles(comments: DataFrame, name: str, project: str, year: str) -> DataFrame:
    """(name, first, last, years): one row per name of two tokens or more. Projects stay in rows of their own, so no name gathers an unbounded set; years are few."""
    t = F.split(F.col(name), " ")
    named = comments.where(F.size(t) >= 2).select(F.col(name).alias("name"), F.col(year).alias("year"))
    out = named.groupBy("name").agg(F.array_sort(F.collect_set("year")).alias("years"))
    return out.withColumn("first", F.element_at(F.split("name", " "), 1)).withColumn("last", F.element_at(F.split("name", " "), -1))


def commenter_links(comments: DataFrame, name: str = "name", project: str = "project", year: str = "year") -> DataFrame:
    """(a, b): names that are alike and corroborated by a shared project, or by near years and an uncommon surname."""
    prof = profiles(comments, name, project, year)
    firsts = prof.groupBy("first").agg(F.count(F.lit(1)).alias("n_first"))
    lasts = prof.groupBy("last").agg(F.count(F.lit(1)).alias("n_last"))
    prof = prof.join(firsts, "first").join(lasts, "last")
    sur = F.concat_ws("|", F.lit("s"), F.substring("first", 1, 1), F.substring("last", 1, 3))
    fore = F.when(F.col("n_first") <= RARE_FIRST, F.concat_ws("|", F.lit("f"), "first"))
    pairs = blocked_pairs(prof, [sur, fore], ["name", "first", "last", "years", "n_last", "n_first"], "name")
    # an admissible bound first: twice the shorter length over the sum can't be below the threshold
    la, lb = F.length("name_a"), F.length("name_b")
    pairs = pairs.where((200 * F.least(la, lb) / (la + lb) >= NAME_MIN) | (F.col("first_a") == F.col("first_b")))
    pairs = pairs.withColumn("whole", indel_ratio(token_sort(F.col("name_a")), token_sort(F.col("name_b")))).withColumn("surname", indel_ratio(F.col("last_a"), F.col("last_b")))
    alike = ((F.substring("first_a", 1, 1) == F.substring("first_b", 1, 1)) & (F.substring("last_a", 1, 3) == F.substring("last_b", 1, 3)) & (F.col("whole") >= NAME_MIN)) | ((F.col("first_a") == F.col("first_b")) & (F.col("n_first_a") <= RARE_FIRST) & (F.col("surname") >= SURNAME_MIN))
    pairs = pairs.where(alike)
    at = comments.select(F.col(name).alias("name"), F.col(project).alias("project")).dropna().distinct()
    shared = pairs.select("name_a", "name_b").join(at.withColumnRenamed("name", "name_a"), "name_a").join(at.withColumnRenamed("name", "name_b"), ["name_b", "project"]).select("name_a", "name_b").distinct().withColumn("_shared", F.lit(True))
    gap = F.array_min(F.flatten(F.transform("years_a", lambda x: F.transform("years_b", lambda y: F.abs(x - y)))))
    near = (F.coalesce(gap, F.lit(999)) <= NEAR_YEARS) & (F.greatest("n_last_a", "n_last_b") <= COMMON_SURNAME)
    return pairs.join(shared, ["name_a", "name_b"], "left").where(F.coalesce("_shared", F.lit(False)) | near).select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))


def resolve_commenters(comments: DataFrame, name: str = "name", project: str = "project", year: str = "year", aliases: DataFrame | None = None) -> DataFrame:
    """(name, commenter_id): the smallest name of its component; null for names of one token. ``aliases`` (a, b) merge unconditionally."""
    edges = commenter_links(comments, name, project, year)
    if aliases is not None:
        edges = edges.unionByName(aliases.select("a", "b"))
    names = comments.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
    labels = components(edges).select(F.col("node").alias("name"), "label")
    return names.join(labels, "name", "left").select("name", F.when(F.size(F.split("name", " ")) >= 2, F.coalesce("label", "name")).alias("commenter_id"))
