"""The pN_ queries: each applies its operator, with production parameters, to its whole tables."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.printed import case_number, epoch_day
from hearthline.llm.addresses import same_places
from hearthline.llm.names import link_organisations, link_persons
from hearthline.llm.near_duplicates import near_duplicates
from hearthline.llm.nearest_time import nearest_in_time
from hearthline.llm.packing import fill_containers
from hearthline.llm.personal import find_mentions, known_first_names, linked_values, redact_comments
from hearthline.llm.residue import find_residue
from hearthline.llm.scanned import repair_scans
from hearthline.llm.tokens import encode_ids, token_sizes
from hearthline.session import spread, table, written


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of written comments whose runs of three words overlap by half or more."""
    written_ = table(spark, sf_dir, "comments").where(F.col("channel") == "email")
    pairs = near_duplicates(written_.select(F.col("comment_id").alias("id"), "text"))
    return pairs.select(F.col("id_a").alias("comment_id_a"), F.col("id_b").alias("comment_id_b"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each written comment with the item of its project whose hearing is nearest within 14 days."""
    comments = table(spark, sf_dir, "comments").where(F.col("channel") == "email")
    left = comments.select(F.col("comment_id").alias("id"), case_number(F.col("id_parent")).alias("entity"), epoch_day(F.col("meeting_date")).alias("day"))
    items = table(spark, sf_dir, "items")
    right = items.select(F.col("item_id").alias("id"), case_number(F.col("id_parent")).alias("entity"), epoch_day(F.col("meeting_date")).alias("day"))
    return nearest_in_time(left, right, tolerance=14).select(F.col("left_id").alias("comment_id"), F.col("right_id").alias("item_id")).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of e-mail addresses, phone and identity numbers, addresses and names in comments."""
    comments = table(spark, sf_dir, "comments")
    known = known_first_names(comments.select(F.col("name_clean").alias("name")))
    return find_mentions(spread(comments.select("comment_id", "comment", "text")), known)


_own_secret = secrets.token_hex(32)


def pseudonym_secret(spark: SparkSession) -> str:
    """The deployment's secret from ``spark.hearthline.secret``; where it isn't set, one drawn for this process, whose pseudonyms link within its runs only."""
    return spark.conf.get("spark.hearthline.secret", None) or _own_secret


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with a typed placeholder and pseudonym for every mention."""
    comments = table(spark, sf_dir, "comments")
    known = known_first_names(comments.select(F.col("name_clean").alias("name")))
    return redact_comments(spread(comments.select("comment_id", "comment", "text")), pseudonym_secret(spark), known)


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of mention: different values, different pseudonyms, numbers that the inverse restores."""
    comments = table(spark, sf_dir, "comments")
    known = known_first_names(comments.select(F.col("name_clean").alias("name")))
    return linked_values(comments, pseudonym_secret(spark), known)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one place in the two address columns of items; units don't count (TESTDATA)."""
    items = table(spark, sf_dir, "items")
    addresses = items.select(F.explode(F.array("prj_project_address", "site_address")).alias("address"))
    return same_places(addresses, unit_veto=False)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one person that meet on a project, and spellings of one organisation."""
    comments = table(spark, sf_dir, "comments")
    people = comments.where(F.col("is_anonymous") == 0).select(case_number(F.col("id_parent")).alias("project"), F.coalesce("name_clean", "name_raw").alias("name"))
    persons = link_persons(people, table(spark, sf_dir, "nicknames"))
    organisations = link_organisations(comments.select(F.col("organization").alias("name")))
    return persons.select(F.lit("person").alias("kind"), "name_a", "name_b").unionByName(organisations.select(F.lit("organization").alias("kind"), "name_a", "name_b"))


def _item_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "items").select("item_id", F.explode(F.create_map(F.lit("item_text"), F.col("item_text"), F.lit("speakers"), F.col("speakers"))).alias("field_name", "text"))
    return spread(items.select(F.col("item_id").alias("id"), "field_name", "text"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of scanning noise per item and field."""
    found = repair_scans(_item_texts(spark, sf_dir))
    return found.select(F.col("id").alias("item_id"), "field_name", F.explode("noises").alias("noise")).distinct()


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous text of every item and field."""
    return repair_scans(_item_texts(spark, sf_dir)).select(F.col("id").alias("item_id"), "field_name", "repaired")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return encode_ids(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of 2,048 tokens of every document or piece of a longer one."""
    sizes = written(token_sizes(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), "p8-sizes")
    return fill_containers(sizes, capacity=2048)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are template residue, filler, error pages or script notices."""
    return find_residue(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_redacted": p3_redacted, "p3_links": p3_links, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p6_repaired": p6_repaired, "p7_ids": p7_ids, "p8_containers": p8_containers, "p9_found": p9_found}

CASE = "regexp_extract({c}, '(^|[^0-9])([0-9]{{4}}|[0-9]{{2}})([.-])([0-9]+)', {g})"


def _case(c: str) -> str:
    y, s, n = (CASE.format(c=c, g=g) for g in (2, 3, 4))
    return f"CASE WHEN {y} = '' THEN NULL WHEN length({y}) = 2 THEN '19' || {y} || {s} || {n} ELSE {y} || {s} || {n} END"


def _date(c: str) -> str:
    return (
        f"coalesce(try_strptime(trim({c}), '%Y-%m-%d'), CASE WHEN regexp_matches(trim({c}), '^[0-9]{{8}}$') THEN try_strptime(trim({c}), '%Y%m%d') END, "
        f"try_strptime(trim({c}), '%m/%d/%Y'), try_strptime(trim({c}), '%B %d, %Y'))::DATE"
    )


ORACLES = {
    "p1_found": r"""
        WITH t AS (SELECT DISTINCT comment_id AS id, regexp_extract_all(text, '[\\p{L}\\p{N}]+') AS w FROM comments WHERE channel = 'email' AND text IS NOT NULL),
             s AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: lower(w[i]) || ' ' || lower(w[i + 1]) || ' ' || lower(w[i + 2]))) AS s FROM t WHERE len(w) >= 30),
             e AS (SELECT id, len(s) AS n, unnest(s) AS g FROM s),
             p AS (SELECT a.id AS x, b.id AS y, a.n AS n, b.n AS m, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
        SELECT x AS comment_id_a, y AS comment_id_b FROM p WHERE k >= 0.5 * (n + m - k)""".replace("\\\\", "\\"),
    "p2_found": f"""
        WITH l AS (SELECT DISTINCT comment_id, {_case('id_parent')} AS k, {_date('meeting_date')} AS d FROM comments WHERE channel = 'email'),
             r AS (SELECT DISTINCT item_id, {_case('id_parent')} AS k, {_date('meeting_date')} AS d FROM items),
             m AS (SELECT comment_id, item_id, row_number() OVER (PARTITION BY comment_id ORDER BY abs(l.d - r.d), item_id) AS n
                   FROM l JOIN r ON l.k = r.k AND abs(l.d - r.d) <= 14)
        SELECT comment_id, item_id FROM m WHERE n = 1""",
}
