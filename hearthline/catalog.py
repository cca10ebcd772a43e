"""Queries of the engine's own operators over the whole tables, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import oracles as O
from hearthline.functions import records as R
from hearthline.functions import text as X
from hearthline.functions.printed import case_number, printed_date
from hearthline.functions.rules import flag
from hearthline.operators import aggregate as A
from hearthline.operators import identity, minutes, names, polarity, relational, roles, speakers
from hearthline.plans.release import POSITION, release, spoken_table, written_table
from hearthline.session import spread, table, written
from hearthline.sources.readers import page_links
from hearthline.sources.sinks import search_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def note(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return note


def once(df: DataFrame, *columns: str) -> DataFrame:
    """These columns, the id first, of rows that may have been delivered twice. Only what is named is read and moved."""
    return df.select(*columns).distinct()


def _dated(df: DataFrame, id_: str, columns: tuple[str, ...]) -> DataFrame:
    derived = {"project": "id_parent", "day": "meeting_date", "year": "meeting_date"}
    out = once(df, *dict.fromkeys([id_, *(derived.get(c, c) for c in columns)]))
    if "project" in columns:
        out = out.withColumn("project", case_number(F.col("id_parent")))
    if "day" in columns or "year" in columns:
        out = out.withColumn("day", printed_date(F.col("meeting_date")))
    return out.withColumn("year", F.year("day")) if "year" in columns else out


def comments(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Comments once, with their id and these columns; "project", "day" and "year" are read from print."""
    return _dated(table(spark, d, "comments"), "comment_id", columns)


def items(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return _dated(table(spark, d, "items"), "item_id", columns)


C = f"(SELECT *, {O.case_number('id_parent')} AS project, {O.printed_date('meeting_date')} AS day, year({O.printed_date('meeting_date')})::INT AS year FROM {O.COMMENTS})"
I = f"(SELECT *, {O.case_number('id_parent')} AS project, {O.printed_date('meeting_date')} AS day, year({O.printed_date('meeting_date')})::INT AS year FROM {O.ITEMS})"  # noqa: E741


# ------------------------------------------------------------------ longitudinal aggregates


@query(
    f"""WITH u AS (SELECT day, min(year) AS year, bool_or(position = 'oppose') AS o, bool_or(position = 'support') AS s FROM {C} WHERE day IS NOT NULL GROUP BY day)
        SELECT year, count(*)::BIGINT AS n, round(avg(coalesce(o, false)::INT), 9) AS share_opposed, round(avg(coalesce(s, false)::INT), 9) AS share_supported FROM u GROUP BY year"""
)
def share_by_year(spark, d):
    """Flagship: share of hearing days per year with any opposing and any supporting comment."""
    c = comments(spark, d, "day", "year", "position").select("day", "year", F.coalesce(F.col("position") == "oppose", F.lit(False)).alias("opposed"), F.coalesce(F.col("position") == "support", F.lit(False)).alias("supported"))
    out = A.share_by_year(c, "day", "year", ["opposed", "supported"])
    return out.select("year", "n", F.round("share_opposed", 9).alias("share_opposed"), F.round("share_supported", 9).alias("share_supported"))


@query(
    f"""WITH h AS (SELECT DISTINCT item_id FROM {I} WHERE regexp_matches(item_text, '(?i)dwelling|housing|residential') AND regexp_matches(section, '(?i)REGULAR|DISCRETIONARY')),
             u AS (SELECT item_id, min(year) AS year, bool_or(coalesce(position = 'support', false)) AS s FROM {C} WHERE item_id IN (SELECT item_id FROM h) GROUP BY item_id)
        SELECT year, count(*)::BIGINT AS n, round(avg(s::INT), 9) AS share_supported FROM u WHERE year IS NOT NULL GROUP BY year"""
)
def share_by_hearing(spark, d):
    """The same over hearings of housing items: semi-join, then two levels."""
    housing = items(spark, d, "item_text", "section").where((flag(F.col("item_text"), "dwelling|housing|residential") == 1) & F.col("section").rlike("(?i)REGULAR|DISCRETIONARY")).select("item_id").distinct()
    c = comments(spark, d, "item_id", "year", "position").join(housing, "item_id", "left_semi").withColumn("supported", F.coalesce(F.col("position") == "support", F.lit(False)))
    return A.share_by_year(c, "item_id", "year", ["supported"]).select("year", "n", F.round("share_supported", 9).alias("share_supported"))


@query(f"SELECT year, count(*) FILTER (position = 'support')::BIGINT AS n_support, count(*) FILTER (position = 'oppose')::BIGINT AS n_oppose, count(*) FILTER (position = 'neutral')::BIGINT AS n_neutral FROM {C} WHERE year IS NOT NULL GROUP BY year")
def year_pivot(spark, d):
    return A.cross_tab(comments(spark, d, "year", "position"), "year", "position", ["support", "oppose", "neutral"])


@query(f"SELECT year, round(count(*) FILTER (position = 'oppose') / count(*), 9) AS share FROM {C} WHERE year IS NOT NULL AND position IN ('support', 'oppose') GROUP BY year HAVING count(*) >= 10")
def opposition_share(spark, d):
    c = comments(spark, d, "year", "position").where("year IS NOT NULL AND position IN ('support', 'oppose')")
    return c.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("position") == "oppose").alias("o")).where("n >= 10").select("year", F.round(F.col("o") / F.col("n"), 9).alias("share"))


@query(
    f"""WITH k AS (SELECT year, {O.cascade("nullif(trim(organization), '')", roles.ORGANISATION_RULES, None)} AS kind FROM {C} WHERE year IS NOT NULL)
        SELECT year, kind, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY year), 9) AS share FROM k WHERE kind IS NOT NULL GROUP BY year, kind"""
)
def group_share(spark, d):
    """Kinds of organisations per year and their share, by a rule table."""
    k = comments(spark, d, "year", "organization").where("year IS NOT NULL").select("year", roles.classify(F.col("organization")).alias("kind")).where("kind IS NOT NULL").groupBy("year", "kind").agg(F.count(F.lit(1)).alias("n"))
    total = k.groupBy("year").agg(F.sum("n").alias("t"))
    return k.join(total, "year").select("year", "kind", "n", F.round(F.col("n") / F.col("t"), 9).alias("share"))


@query(
    f"""WITH y AS (SELECT year, count(*)::BIGINT AS n FROM {C} WHERE year IS NOT NULL GROUP BY year)
        SELECT year, n, round(avg(n) OVER (ORDER BY year ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS smooth FROM y"""
)
def rolling_mean(spark, d):
    y = comments(spark, d, "year").where("year IS NOT NULL").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return A.rolling_mean(y, "year", "n", "smooth").withColumn("smooth", F.round("smooth", 6))


@query(
    f"""WITH c AS (SELECT i.item_id, count(c.comment_id)::BIGINT AS n FROM (SELECT DISTINCT item_id FROM items) i LEFT JOIN {O.COMMENTS} c USING (item_id) GROUP BY i.item_id)
        SELECT CASE WHEN n < 1 THEN '0' WHEN n < 5 THEN '1-4' WHEN n < 20 THEN '5-19' ELSE '20+' END AS bin, count(*)::BIGINT AS n_items FROM c GROUP BY 1"""
)
def binned_counts(spark, d):
    """Items by their number of comments, those without any included."""
    per = comments(spark, d, "item_id").where("item_id IS NOT NULL").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    ids = table(spark, d, "items").select("item_id").distinct().join(per, "item_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return ids.groupBy(A.binned(F.col("n"), [0, 1, 5, 20]).alias("bin")).agg(F.count(F.lit(1)).alias("n_items"))


@query(
    f"""SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (name_clean IS NOT NULL)::BIGINT AS n_named, count(*) FILTER (sign IS NOT NULL)::BIGINT AS n_signed, count(*) FILTER (channel = 'email')::BIGINT AS n_written,
               count(DISTINCT project)::BIGINT AS projects, count(DISTINCT name_clean)::BIGINT AS names FROM {C}"""
)
def coverage_summary(spark, d):
    c = comments(spark, d, "project", "name_clean", "sign", "channel")
    return A.coverage(c, {"n_named": F.col("name_clean").isNotNull(), "n_signed": F.col("sign").isNotNull(), "n_written": F.col("channel") == "email"}, {"projects": "project", "names": "name_clean"})


@query(f"SELECT year, count(*)::BIGINT AS n, round(avg((prj_record_id IS NOT NULL)::INT), 9) AS matched FROM {I} WHERE year IS NOT NULL AND project IS NOT NULL GROUP BY year")
def match_rate(spark, d):
    i = items(spark, d, "year", "project", "prj_record_id").where("year IS NOT NULL AND project IS NOT NULL")
    return i.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("prj_record_id").isNotNull().cast("int")), 9).alias("matched"))


@query("SELECT r_name, count(*)::BIGINT AS nations, round(avg(b), 4) AS mean_of_means FROM (SELECT s_nationkey, avg(s_acctbal) AS b FROM supplier GROUP BY s_nationkey) JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def centroids(spark, d):
    """Two-level mean: suppliers to nations to regions."""
    per = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("b"))
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return per.join(n, per.s_nationkey == n.n_nationkey).join(r, r.r_regionkey == n.n_regionkey).groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"), F.round(F.avg("b"), 4).alias("mean_of_means"))


@query(
    f"""SELECT project, arg_max(prj_project_name, (day, item_id)) FILTER (prj_project_name IS NOT NULL) AS title, arg_max(site_address, (day, item_id)) FILTER (site_address IS NOT NULL) AS address, max(day) AS last_day, count(DISTINCT item_id)::BIGINT AS n_items
        FROM {I} WHERE project IS NOT NULL AND day IS NOT NULL GROUP BY project"""
)
def meta_last(spark, d):
    """Per project the last title and address that are known, each by its own last row."""
    i = items(spark, d, "project", "day", "prj_project_name", "site_address").where("project IS NOT NULL AND day IS NOT NULL").withColumn("o", F.struct("day", "item_id"))
    return i.groupBy("project").agg(relational.last_non_null("prj_project_name", "o").alias("title"), relational.last_non_null("site_address", "o").alias("address"), F.max("day").alias("last_day"), F.count_distinct("item_id").alias("n_items"))


@query(
    f"""SELECT name_clean AS name, count(*)::BIGINT AS n_all, count(*) FILTER (channel = 'spoken')::BIGINT AS n_spoken, count(DISTINCT project)::BIGINT AS n_projects, min(year) AS first_year, max(year) AS last_year FROM {C} WHERE name_clean IS NOT NULL GROUP BY 1"""
)
def person_stats(spark, d):
    c = comments(spark, d, "project", "year", "name_clean", "channel").where("name_clean IS NOT NULL")
    return c.groupBy(F.col("name_clean").alias("name")).agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("channel") == "spoken").alias("n_spoken"), F.count_distinct("project").alias("n_projects"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query(
    f"""SELECT c.project, count(*)::BIGINT AS n_all, count(*) FILTER (channel = 'email')::BIGINT AS n_written, min(year) AS first_year, max(year) AS last_year, max(n) AS n_records FROM {C} c
        LEFT JOIN (SELECT {O.case_number('record_id')} AS project, count(*)::BIGINT AS n FROM projects GROUP BY 1) p ON p.project = c.project WHERE c.project IS NOT NULL GROUP BY c.project"""
)
def project_stats(spark, d):
    c = comments(spark, d, "project", "year", "channel").where("project IS NOT NULL").groupBy("project").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("channel") == "email").alias("n_written"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    p = table(spark, d, "projects").groupBy(case_number(F.col("record_id")).alias("project")).agg(F.count(F.lit(1)).alias("n_records"))
    return c.join(p, "project", "left")


@query(
    f"""SELECT day, count(*) FILTER (position = 'support')::BIGINT AS n_support, count(*) FILTER (position = 'oppose')::BIGINT AS n_oppose,
               round(100 * count(*) FILTER (position = 'support') / nullif(count(*) FILTER (position IN ('support', 'oppose')), 0), 6) AS percent FROM {C} WHERE day IS NOT NULL GROUP BY day"""
)
def support_by_day(spark, d):
    c = comments(spark, d, "day", "position").where("day IS NOT NULL").groupBy("day").agg(F.count_if(F.col("position") == "support").alias("n_support"), F.count_if(F.col("position") == "oppose").alias("n_oppose"))
    return c.withColumn("percent", F.round(100 * F.col("n_support") / F.nullif(F.col("n_support") + F.col("n_oppose"), F.lit(0)), 6))


@query(f"SELECT method AS value, count(*)::BIGINT AS n FROM {O.COMMENTS} GROUP BY 1")
def method_distribution(spark, d):
    return comments(spark, d, "method").groupBy(F.col("method").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT least((SELECT min(day) FROM {C}), (SELECT min(day) FROM {I})) AS first_day, greatest((SELECT max(day) FROM {C}), (SELECT max(day) FROM {I})) AS last_day")
def timeline_domain(spark, d):
    """First and last day over both tables, nulls skipped."""
    day = lambda t: table(spark, d, t).select(printed_date(F.col("meeting_date")).alias("day"))
    return day("comments").unionByName(day("items")).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query(f"SELECT project, day, arg_min(action, item_id) FILTER (action IS NOT NULL) AS action FROM {I} WHERE project IS NOT NULL AND day IS NOT NULL GROUP BY project, day")
def hearing_track(spark, d):
    i = items(spark, d, "project", "day", "action").where("project IS NOT NULL AND day IS NOT NULL")
    return i.groupBy("project", "day").agg(relational.first_non_null("action", "item_id").alias("action"))


@query(
    """WITH n AS (SELECT user_id, event_type, count(*) AS k, min(ts) AS a, max(ts) AS b FROM events GROUP BY ALL)
       SELECT user_id, arg_min(event_type, (-k, event_type)) AS mode, max(k)::BIGINT AS n_mode, sum(k)::BIGINT AS n, count(*)::BIGINT AS n_values, round(max(k) / sum(k), 6) AS agreement FROM n GROUP BY user_id"""
)
def modal_affiliation(spark, d):
    m = relational.mode_by(table(spark, d, "events"), ["user_id"], "event_type")
    return m.withColumn("agreement", F.round(F.col("n_mode") / F.col("n"), 6))


STATED = f"(SELECT lower(name_clean) AS name, {O.cascade(chr(110) + 'ullif(trim(organization), chr(0))', roles.ORGANISATION_RULES, None)} AS role, year FROM {C})".replace("chr(0)", "''")


@query(
    f"""WITH s AS {STATED}, k AS (SELECT * FROM s WHERE name LIKE '% %' AND role IS NOT NULL AND year IS NOT NULL), g AS (SELECT name, role, count(*) AS k FROM k GROUP BY ALL),
             m AS (SELECT name, arg_min(role, (-k, role)) AS role, max(k)::BIGINT AS n_modal, sum(k)::BIGINT AS n_stated, count(*)::BIGINT AS distinct_roles FROM g GROUP BY name),
             y AS (SELECT name, min(year) - 4 AS year_lo, max(year) + 4 AS year_hi FROM k GROUP BY name)
        SELECT name, role, n_modal, n_stated, distinct_roles, round(n_modal / n_stated, 3) AS agreement, year_lo, year_hi, (n_modal >= 0.6 * n_stated)::INT AS used FROM m JOIN y USING (name)"""
)
def derived_roster(spark, d):
    """Standing affiliation of each speaker from what they stated, with agreement and a window of years."""
    c = comments(spark, d, "year", "name_clean", "organization").select(F.lower("name_clean").alias("name"), roles.classify(F.col("organization")).alias("role"), "year")
    return roles.derived_roster(c)


@query(
    f"""WITH s AS (SELECT comment_id, lower(name_clean) AS name, {O.cascade("nullif(trim(organization), '')", roles.ORGANISATION_RULES, None)} AS role, year FROM {C}),
             k AS (SELECT * FROM s WHERE name LIKE '% %' AND role IS NOT NULL AND year IS NOT NULL), g AS (SELECT name, role, count(*) AS k FROM k GROUP BY ALL),
             m AS (SELECT name, arg_min(role, (-k, role)) AS r, max(k) AS a, sum(k) AS b FROM g GROUP BY name), y AS (SELECT name, min(year) - 4 AS lo, max(year) + 4 AS hi FROM k GROUP BY name),
             u AS (SELECT * FROM m JOIN y USING (name) WHERE a >= 0.6 * b)
        SELECT comment_id, coalesce(role, CASE WHEN year BETWEEN lo AND hi THEN r END) AS role_filled, CASE WHEN role IS NOT NULL THEN 'stated' WHEN year BETWEEN lo AND hi THEN 'roster_derived' END AS filled_from FROM s LEFT JOIN u USING (name)"""
)
def affiliation_fill(spark, d):
    """Affiliations carried to comments that don't state one."""
    c = written(comments(spark, d, "year", "name_clean", "organization").select("comment_id", F.lower("name_clean").alias("name"), roles.classify(F.col("organization")).alias("role"), "year"), "fill")
    return roles.carry_over(c, roles.derived_roster(c)).select("comment_id", "role_filled", "filled_from")


# ------------------------------------------------------------------ joins


@query(
    f"""WITH l AS (SELECT DISTINCT comment_id, project, day FROM {C} WHERE channel = 'email'), r AS (SELECT project, day AS heard, min(item_id) AS item_id FROM {I} WHERE project IS NOT NULL AND day IS NOT NULL GROUP BY ALL)
        SELECT l.comment_id, r.item_id, r.heard, (r.heard - l.day)::INT AS lag_days, (r.heard = l.day)::INT AS same_day FROM l ASOF LEFT JOIN r ON l.project = r.project AND l.day <= r.heard"""
)
def asof_next_hearing(spark, d):
    """Each written comment with its project's first hearing on or after the packet date; a hot project is split into blocks of two years."""
    left = comments(spark, d, "project", "day", "channel").where("channel = 'email'").select("comment_id", "project", "day")
    right = items(spark, d, "project", "day").select("item_id", "project", F.col("day").alias("heard"))
    out = relational.asof_forward(left, right, "project", "day", "heard", "item_id", block=730)
    lag = F.datediff("heard", "day")
    return out.select("comment_id", "item_id", "heard", lag.alias("lag_days"), (lag == 0).cast("int").alias("same_day"))


@query(
    """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), r AS (SELECT user_id, ts AS at, min(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
       SELECT l.event_id, r.purchase_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.at"""
)
def asof_next_purchase(spark, d):
    e = table(spark, d, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    left = e.where("event_type = 'view'").select("event_id", "user_id", "at")
    right = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("at").alias("bought"))
    return relational.asof_forward(left, right, "user_id", "at", "bought", "purchase_id").select("event_id", "purchase_id")


@query(
    f"""SELECT c.comment_id, (max((t.name IS NOT NULL)::INT))::INT AS is_staff FROM {C} c LEFT JOIN staff_tenure t ON lower(c.name_clean) = lower(t.name) AND c.day BETWEEN t.first_seen - 365 AND t.last_seen + 365 GROUP BY c.comment_id"""
)
def tenure_interval(spark, d):
    """Comments by someone on the staff within a year of their tenure."""
    c = comments(spark, d, "name_clean", "day").select("comment_id", F.lower("name_clean").alias("n"), "day")
    t = table(spark, d, "staff_tenure").select(F.lower("name").alias("n"), F.date_sub("first_seen", 365).alias("lo"), F.date_add("last_seen", 365).alias("hi"))
    return relational.within_interval(c, t, "n", "day", "lo", "hi", "is_staff", "comment_id").groupBy("comment_id").agg(F.max("is_staff").alias("is_staff"))


@query(
    """WITH l AS (SELECT DISTINCT p_brand, p_size FROM part), r AS (SELECT p_brand, p_size AS near, p_partkey FROM part WHERE p_type = 'ECONOMY'),
            j AS (SELECT l.*, near, p_partkey, row_number() OVER (PARTITION BY l.p_brand, l.p_size ORDER BY abs(near - p_size), near, p_partkey) AS k FROM l JOIN r ON l.p_brand = r.p_brand AND abs(near - p_size) <= 5)
       SELECT l.p_brand, l.p_size, j.near AS near_p_size, j.p_partkey FROM l LEFT JOIN j ON j.p_brand = l.p_brand AND j.p_size = l.p_size AND k = 1"""
)
def nearest_within_tolerance(spark, d):
    p = table(spark, d, "part")
    return relational.nearest_number(p.select("p_brand", "p_size").distinct(), p.where("p_type = 'ECONOMY'").select("p_brand", "p_size", "p_partkey"), "p_brand", "p_size", 5, ["p_partkey"])


@query(
    f"""WITH a AS (SELECT {O.case_number('record_id')} AS k, min(block) AS v FROM projects WHERE block IS NOT NULL GROUP BY 1), b AS (SELECT upper(trim(project_address)) AS k, min(block) AS v FROM projects WHERE block IS NOT NULL AND project_address IS NOT NULL GROUP BY 1)
        SELECT DISTINCT item_id, coalesce(a.v, b.v) AS block, CASE WHEN a.v IS NOT NULL THEN 'record' WHEN b.v IS NOT NULL THEN 'address' END AS block_source FROM {I} i LEFT JOIN a ON a.k = i.project LEFT JOIN b ON b.k = upper(trim(i.site_address))"""
)
def fallback_chain(spark, d):
    """The block of an item's project: by record number, else by address; says which."""
    p = table(spark, d, "projects").where("block IS NOT NULL")
    i = items(spark, d, "project", "site_address").select("item_id", "project", F.upper(F.trim("site_address")).alias("site"))
    by_record = p.select(case_number(F.col("record_id")).alias("k"), "block")
    by_address = p.select(F.upper(F.trim("project_address")).alias("k"), "block")
    return relational.fallback(i, [("record", by_record, "project"), ("address", by_address, "site")], "block").select("item_id", "block", "block_source").distinct()


REF = "nullif(lower(regexp_extract(speakers, '(?i)^\\s*same as item\\s+([0-9]{1,2}[a-z]?)', 1)), '')"


@query(
    f"""WITH i AS (SELECT DISTINCT item_id, file, lower(item_num) AS num, {REF} AS ref FROM {I} WHERE file IS NOT NULL), r AS (SELECT item_id AS ref_id, file, ref AS num FROM i WHERE ref IS NOT NULL),
             t AS (SELECT file, num, item_id AS target FROM i WHERE ref IS NULL)
        SELECT ref_id, r.file, r.num, target, CASE WHEN target IS NULL THEN 'same_as_unresolved' ELSE 'copied' END AS resolution FROM r LEFT JOIN t USING (file, num)"""
)
def same_as_copy(spark, d):
    """Items whose speakers are "same as item n" with the items they point to; unresolved ones stay, tagged."""
    i = items(spark, d, "file", "item_num", "speakers").where("file IS NOT NULL").select("item_id", "file", F.lower("item_num").alias("num"), F.nullif(F.lower(F.regexp_extract("speakers", r"(?i)^\s*same as item\s+([0-9]{1,2}[a-z]?)", 1)), F.lit("")).alias("ref")).distinct()
    refs = i.where("ref IS NOT NULL").select(F.col("item_id").alias("ref_id"), "file", F.col("ref").alias("num"))
    return relational.copy_referenced(i.where("ref IS NULL").select("file", "num", F.col("item_id").alias("target")), refs, ["file", "num"], "same_as_unresolved").select("ref_id", "file", "num", "target", "resolution")


@query(
    """WITH m AS (SELECT meeting_date, meeting_type, file, max(n_items) AS n FROM meetings WHERE meeting_date IS NOT NULL AND meeting_type IS NOT NULL GROUP BY ALL), s AS (SELECT *, regexp_matches(file, 'closed|jnt|joint|recpark|offsite') AS special FROM m)
       SELECT meeting_date, meeting_type, file, n FROM (SELECT *, row_number() OVER (PARTITION BY meeting_date, meeting_type ORDER BY special, n DESC, file) AS k FROM s) WHERE k = 1 OR special"""
)
def best_source(spark, d):
    """Per meeting the file with most items that is no special document; special documents are kept as well."""
    m = table(spark, d, "meetings").where("meeting_date IS NOT NULL AND meeting_type IS NOT NULL").groupBy("meeting_date", "meeting_type", "file").agg(F.max("n_items").alias("n")).withColumn("special", F.col("file").rlike("closed|jnt|joint|recpark|offsite"))
    best = A.top_k(m, ["meeting_date", "meeting_type"], [F.asc("special"), F.desc("n"), F.asc("file")], 1).drop("rank")
    return best.unionByName(m.where("special")).distinct().select("meeting_date", "meeting_type", "file", "n")


@query(
    """WITH r AS (SELECT DISTINCT meeting_date, lower(regexp_replace(trim(u.n), '\\s+', ' ', 'g')) AS n FROM meetings, unnest(string_split(staff_in_attendance, ';')) AS u(n)), c AS (SELECT DISTINCT comment_id, meeting_date, lower(name_clean) AS n FROM comments)
       SELECT c.comment_id, max((r.n IS NOT NULL)::INT)::INT AS present FROM c LEFT JOIN r ON r.meeting_date = c.meeting_date AND r.n = c.n GROUP BY c.comment_id"""
)
def staff_present(spark, d):
    """Comments by someone on the same meeting's attendance list."""
    here = roles.attendance(table(spark, d, "meetings"), "staff_in_attendance", ["meeting_date"])
    c = table(spark, d, "comments").select("comment_id", "meeting_date", F.lower("name_clean").alias("name_l")).distinct()
    return c.join(here.withColumn("hit", F.lit(1)), ["meeting_date", "name_l"], "left").groupBy("comment_id").agg(F.max(F.coalesce("hit", F.lit(0))).alias("present"))


@query(
    """WITH r AS (SELECT lower(regexp_replace(trim(u.n), '\\s+', ' ', 'g')) AS name, meeting_date AS day FROM meetings, unnest(string_split(staff_in_attendance, ';')) AS u(n) WHERE meeting_date IS NOT NULL)
       SELECT name, min(day) AS first_seen, max(day) AS last_seen, count(DISTINCT day)::BIGINT AS n_days FROM r GROUP BY name"""
)
def staff_panel(spark, d):
    """Tenure of everyone on the attendance lists."""
    m = table(spark, d, "meetings").where("meeting_date IS NOT NULL")
    return roles.attendance(m, "staff_in_attendance", ["meeting_date"]).groupBy(F.col("name_l").alias("name")).agg(F.min("meeting_date").alias("first_seen"), F.max("meeting_date").alias("last_seen"), F.count_distinct("meeting_date").alias("n_days"))


@query(
    f"""WITH n AS (SELECT day, count(*)::BIGINT AS n FROM {C} WHERE day IS NOT NULL GROUP BY day), m AS (SELECT DISTINCT file, {O.printed_date('meeting_date')} AS day FROM meetings)
        SELECT file, m.day, coalesce(n, 0)::BIGINT AS n_comments FROM m LEFT JOIN n ON n.day = m.day"""
)
def meetings_with_counts(spark, d):
    n = comments(spark, d, "day").where("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    m = table(spark, d, "meetings").select("file", printed_date(F.col("meeting_date")).alias("day")).distinct()
    return m.join(n, "day", "left").select("file", "day", F.coalesce("n", F.lit(0)).alias("n_comments"))


@query(f"SELECT file, meeting_type, any_value(meeting_date) AS meeting_date, count(*)::BIGINT AS n_items, count(speakers)::BIGINT AS n_with_speakers FROM (SELECT file, meeting_type, speakers, max(meeting_date) OVER (PARTITION BY file, meeting_type) AS meeting_date FROM {O.ITEMS}) GROUP BY file, meeting_type")
def meetings_rollup(spark, d):
    return items(spark, d, "file", "meeting_type", "meeting_date", "speakers").groupBy("file", "meeting_type").agg(F.max("meeting_date").alias("meeting_date"), F.count(F.lit(1)).alias("n_items"), F.count("speakers").alias("n_with_speakers"))


@query("SELECT project FROM (SELECT " + O.case_number("id_parent") + " AS project FROM items INTERSECT SELECT " + O.case_number("record_id") + " FROM projects) WHERE project IS NOT NULL AND project NOT IN (SELECT " + O.case_number("id_parent") + " FROM comments WHERE channel = 'email' AND id_parent IS NOT NULL)")
def silent_projects(spark, d):
    """Projects on an agenda and in the project table that nobody wrote about: semi- and anti-join."""
    k = lambda t, c: table(spark, d, t).select(case_number(F.col(c)).alias("project"))
    mail = table(spark, d, "comments").where("channel = 'email'").select(case_number(F.col("id_parent")).alias("project"))
    return k("items", "id_parent").where("project IS NOT NULL").distinct().join(k("projects", "record_id"), "project", "left_semi").join(mail, "project", "left_anti")


# ------------------------------------------------------------------ deduplication, channels, campaigns


@query(
    f"""WITH s AS (SELECT DISTINCT comment_id, name_raw, comment, project, day FROM {C} WHERE channel = 'spoken')
        SELECT comment_id FROM (SELECT comment_id, row_number() OVER (PARTITION BY day, name_raw, comment, project ORDER BY comment_id) AS k, name_raw IS NOT NULL AND project IS NOT NULL AS known FROM s) WHERE k = 1 OR NOT known"""
)
def fanout_dedup(spark, d):
    """Spoken testimony once, though it was attached to several sub-items."""
    return spoken_table(table(spark, d, "comments"), "comment_id").select("comment_id")


@query(
    r"""WITH m AS (SELECT DISTINCT comment_id, sender_id, id_parent, meeting_date, text FROM comments WHERE channel = 'email' AND nullif(trim(sender_id), '') IS NOT NULL
                   AND NOT regexp_matches(coalesce(text, ''), '(?i)^\s*(\*{3}\s*media advisory|for immediate release|mayor''?s? (press )?office|schedule of public events)'))
        SELECT min(comment_id) AS comment_id FROM m GROUP BY sender_id, id_parent, meeting_date, text"""
)
def message_dedup(spark, d):
    return written_table(table(spark, d, "comments"), "comment_id").select("comment_id")


@query(
    r"""WITH m AS (SELECT sender_id, id_parent, meeting_date, text, arg_min(CASE WHEN is_campaign = 1 THEN campaign END, comment_id) AS c0, min(comment_id) AS comment_id FROM comments WHERE channel = 'email' AND nullif(trim(sender_id), '') IS NOT NULL
                   AND NOT regexp_matches(coalesce(text, ''), '(?i)^\s*(\*{3}\s*media advisory|for immediate release|mayor''?s? (press )?office|schedule of public events)') GROUP BY sender_id, id_parent, meeting_date, text),
             k AS (SELECT m.comment_id, any_value(CASE WHEN c.is_campaign = 1 THEN c.campaign END) AS c, any_value(c.position) AS position FROM m JOIN comments c USING (comment_id) GROUP BY m.comment_id),
             x AS (SELECT c FROM k WHERE c IS NOT NULL GROUP BY c HAVING bool_or(position = 'support') AND bool_or(position = 'oppose'))
        SELECT comment_id, CASE WHEN c IN (SELECT c FROM x) THEN c || ' [' || coalesce(position, 'unclear') || ']' ELSE c END AS campaign_key FROM k"""
)
def campaign_split(spark, d):
    """Campaigns; one that both sides use is split by position."""
    return written_table(table(spark, d, "comments"), "comment_id").select("comment_id", "campaign_key")


@query(f"SELECT DISTINCT comment_id, 'e' || substr(sha1(coalesce(sender_id, '') || '|' || coalesce(meeting_date, '') || '|' || coalesce(text, '')), 1, 12) AS message_id FROM {O.COMMENTS} WHERE channel = 'email'")
def message_ids(spark, d):
    c = comments(spark, d, "channel", "sender_id", "meeting_date", "text").where("channel = 'email'")
    return c.select("comment_id", R.message_id(F.col("sender_id"), F.col("meeting_date"), F.col("text")).alias("message_id"))


@query(
    f"""SELECT 'c' || comment_id AS id, channel, text, CAST(NULL AS VARCHAR) AS source FROM {O.COMMENTS} UNION ALL SELECT 'd' || doc_id::VARCHAR, CAST(NULL AS VARCHAR), text, source FROM documents"""
)
def unify_channels(spark, d):
    """Comments and documents as one table over the union of their columns."""
    a = comments(spark, d, "channel", "text").select(F.concat(F.lit("c"), "comment_id").alias("id"), "channel", "text")
    b = table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text", "source")
    return relational.union_aligned(a, b, lead=("id", "channel"))


@query(f"SELECT DISTINCT comment_id, coalesce(CASE sign WHEN '+' THEN 'support' WHEN '-' THEN 'oppose' WHEN '=' THEN 'neutral' END, position) AS position FROM {O.COMMENTS} WHERE channel = 'spoken'")
def positions(spark, d):
    from hearthline.functions.rules import lookup

    c = comments(spark, d, "channel", "sign", "position").where("channel = 'spoken'")
    return c.select("comment_id", F.coalesce(lookup(F.col("sign"), POSITION), "position").alias("position")).distinct()


# ------------------------------------------------------------------ text and records


@query(
    r"""SELECT DISTINCT comment_id, regexp_replace(regexp_replace(text, '\S*@[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)*\.[A-Za-z]{2,}', '[email removed]', 'g'), '(^|[^0-9])(\(?[0-9]{3}\)?[-.\s]){1,2}[0-9]{3}[-.\s][0-9]{4}($|[^0-9])', '\1[phone removed]\3', 'g') AS text FROM comments"""
)
def scrub_contacts(spark, d):
    return table(spark, d, "comments").select("comment_id", X.scrub_contacts(F.col("text")).alias("text")).distinct()


@query("SELECT doc_id, coalesce(regexp_matches(text, '(?i)demoli')::INT, 0) AS demolition, coalesce(regexp_matches(text, '(?i)height|stories')::INT, 0) AS height, coalesce(regexp_matches(text, 'ADU')::INT, 0) AS adu FROM documents")
def doc_flags(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", flag(t, "demoli").alias("demolition"), flag(t, "height|stories").alias("height"), flag(t, "ADU", ignore_case=False).alias("adu"))


@query(f"SELECT DISTINCT section, coalesce({O.cascade('section', R.SECTIONS, 'Other')}, '') AS section_group FROM items")
def section_groups(spark, d):
    return table(spark, d, "items").select("section", R.section_group(F.col("section")).alias("section_group")).distinct()


@query(f"SELECT DISTINCT organization, {O.cascade(chr(110) + 'ullif(trim(organization), chr(0))', roles.ORGANISATION_RULES, None)} AS kind FROM comments".replace("chr(0)", "''"))
def organisation_kinds(spark, d):
    return table(spark, d, "comments").select("organization", roles.classify(F.col("organization")).alias("kind")).distinct()


SUFFIX = "replace(regexp_extract(trim(record_id), '[.-][0-9]+([A-Z!]+)$', 1), '!', '')"
LETTERS = "CASE {} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.LETTER_TYPES.items()) + " END"


@query(
    f"""SELECT DISTINCT record_id, CASE WHEN coalesce({SUFFIX}, '') = '' THEN '' {' '.join(f"WHEN suffix({SUFFIX}, '{t}') THEN '{t}'" for t in R.TYPE_CODES)} ELSE coalesce({LETTERS.format(f'right({SUFFIX}, 1)')}, {LETTERS.format(f'left({SUFFIX}, 1)')}, '') END AS record_type,
               coalesce(regexp_replace(regexp_replace(CASE WHEN length(trim(record_id)) - length(replace(trim(record_id), '-', '')) > 1 THEN regexp_replace(trim(record_id), '-[0-9]{{1,2}}$', '') ELSE trim(record_id) END, '[A-Za-z!]+$', ''), '^(9[0-9]\\.)', '19\\1'), '') AS parent FROM items"""
)
def record_ids(spark, d):
    r = F.col("record_id")
    return table(spark, d, "items").select("record_id", R.record_type(r).alias("record_type"), R.record_parent(r).alias("parent")).distinct()


UNIT_SQL = f"(starts_with(t[i], '#') OR list_contains({R.UNIT_WORDS}, t[i]) OR list_contains({R.UNIT_SHAPES}, regexp_replace(regexp_replace(t[i], '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g')))"
TYPE_SQL = "CASE {t} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.STREET_TYPES.items()) + " ELSE {t} END"
ORDINAL_SQL = "CASE {t} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.ORDINAL_WORDS.items()) + " ELSE {t} END"


@query(
    f"""WITH a AS (SELECT DISTINCT unnest([prj_project_address, site_address]) AS address FROM items), b AS (SELECT address, regexp_replace(upper(string_split(address, ',')[1]), '\\s+[0-9]{{5}}(-[0-9]{{4}})?$', '') AS s FROM a WHERE address IS NOT NULL),
             c AS (SELECT address, regexp_replace(regexp_replace(trim(regexp_replace(s, '\\s+', ' ', 'g')), '^([0-9]+) ?[-–] ?[0-9]+[A-Z]?\\b', '\\1'), '\\.( |$)', '\\1', 'g') AS s FROM b),
             d AS (SELECT address, string_split(s, ' ') AS t FROM c),
             e AS (SELECT address, t[1:greatest(list_max([0] || list_filter(range(1, len(t) + 1), lambda i: i <= 3 OR NOT {UNIT_SQL})), 1)] AS t FROM d),
             f AS (SELECT address, list_filter(t, lambda x, i: i = 1 OR length(x) > 1 OR regexp_matches(x, '^[0-9]$')) AS t FROM e),
             g AS (SELECT address, list_transform(t, lambda x, i: CASE WHEN i = len(t) AND i > 1 THEN {TYPE_SQL.format(t='x')} ELSE x END) AS t FROM f),
             h AS (SELECT address, list_transform(t, lambda x: regexp_replace(x, '^([0-9])(ST|ND|RD|TH)$', '0\\1\\2')) AS t FROM g)
        SELECT address, CASE WHEN trim(address) = '' THEN '' ELSE array_to_string(list_transform(t, lambda x: {ORDINAL_SQL.format(t='x')}), ' ') END AS normal FROM h"""
)
def norm_addresses(spark, d):
    a = table(spark, d, "items").select(F.explode(F.array("prj_project_address", "site_address")).alias("address")).where("address IS NOT NULL").distinct()
    return a.select("address", R.norm_address(F.col("address")).alias("normal"))


SITE_SQL = R.SITE.replace("'", "''")
RECOMMENDED_SQL = r"regexp_split_to_array(regexp_split_to_array(item_text, '(?i)preliminary\s+recommendation\s*:\s*')[2], '[\n(]')[1]"


@query(f"SELECT DISTINCT item_id, coalesce(regexp_extract(substr(item_text, 1, 400), '{SITE_SQL}', 1), '') AS site, coalesce(substr(trim({RECOMMENDED_SQL}), 1, 300), '') AS recommendation FROM items")
def item_extracts(spark, d):
    t = F.col("item_text")
    return table(spark, d, "items").select("item_id", R.site_in_text(t).alias("site"), R.recommendation_in_text(t).alias("recommendation")).distinct()


@query(f"SELECT DISTINCT item_id, coalesce(nullif(trim(prj_project_name), ''), nullif(trim(prj_project_address), ''), nullif(trim(site_address), ''), record_id) AS title FROM items")
def title_fallback(spark, d):
    b = lambda c: X.blank_to_null(F.col(c))
    return table(spark, d, "items").select("item_id", F.coalesce(b("prj_project_name"), b("prj_project_address"), b("site_address"), F.col("record_id")).alias("title")).distinct()


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) <= 460 THEN coalesce(text, '') ELSE substr(text, 1, 420) || '… ' END AS shown FROM documents")
def previews(spark, d):
    return table(spark, d, "documents").select("doc_id", X.preview(F.col("text")).alias("shown"))


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND text <> ''")
def html_round_trip(spark, d):
    """Texts put into a page with scripts and styles, read back."""
    t = table(spark, d, "documents").where("text IS NOT NULL AND text <> ''")
    safe = F.replace(F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("\r"), F.lit("&#13;"))
    page = F.concat(F.lit("<html><head><style>p{color:red}</style><script>var x='<p>';</script></head><body><p>"), safe, F.lit("</p></body></html>"))
    return spread(t).select("doc_id", X.html_text(page).alias("text"))


@query()
def normal_texts(spark, d):
    return spread(table(spark, d, "documents")).select("doc_id", X.normal_text(F.col("text")).alias("text"))


@query(
    f"""WITH m AS (SELECT DISTINCT file, {O.printed_date('meeting_date')} AS day, start_time, end_time, meeting_type, staff_in_attendance AS s, commissioners_present AS p FROM meetings)
        SELECT file, strftime(day, '%Y-%m-%d') AS meeting_date, start_time, end_time, CASE WHEN lower(meeting_type) IN ('special', 'joint') THEN lower(meeting_type) ELSE 'regular' END AS meeting_type,
               nullif(substr(trim(regexp_replace(s, '\\s+', ' ', 'g')), 1, 1500), '') AS staff_in_attendance, nullif(substr(trim(regexp_replace(p, '\\s+', ' ', 'g')), 1, 500), '') AS commissioners_present FROM m WHERE day IS NOT NULL"""
)
def meeting_heads(spark, d):
    """Heads of minutes written from the whole meetings table in three layouts of the date, read back."""
    m = table(spark, d, "meetings").select("file", printed_date(F.col("meeting_date")).alias("day"), "start_time", "end_time", "meeting_type", "staff_in_attendance", "commissioners_present").distinct().where("day IS NOT NULL")
    day, layout = F.col("day"), F.dayofmonth("day") % 3

    def spoken(c):
        h, mm = F.substring(c, 1, 2).cast("int"), F.substring(c, 4, 2)
        return F.concat(F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit(":"), mm, F.when(h >= 12, " PM").otherwise(" AM"))

    kind = F.upper(F.col("meeting_type"))
    dated = F.when(layout == 0, F.date_format(day, "EEEE, MMMM d, yyyy")).when(layout == 1, F.date_format(day, "MMMM d, yyyy")).otherwise(F.upper(F.date_format(day, "EEEE MMMM d yyyy")))
    head = F.concat(F.lit("MINUTES OF "), F.when(kind.isin("SPECIAL", "JOINT"), kind).otherwise(F.lit("REGULAR")), F.lit(" MEETING\n"), dated, F.lit("\n"), F.coalesce(spoken(F.col("start_time")), F.lit("")))
    head = F.concat(head, F.lit("\n"), F.rpad(F.lit("The hearing."), 240, "."))  # the start time is looked for near the date only
    present = F.concat(F.when(layout == 0, "\nCOMMISSIONERS PRESENT: ").otherwise("\nPRESENT: "), F.coalesce("commissioners_present", F.lit("")), F.lit("\nCOMMISSIONERS ABSENT: none\n"))
    staff = F.concat(F.lit("\nSTAFF IN ATTENDANCE: "), F.coalesce("staff_in_attendance", F.lit("")), F.lit("\n\nSPEAKER KEY: + in support\n\nA. REGULAR CALENDAR\n"))
    text = F.concat(head, present, staff, F.coalesce(F.concat(F.lit("\nADJOURNMENT: "), spoken(F.col("end_time"))), F.lit("")))
    docs = minutes.split_meetings(m.select("file", text.alias("text")))
    got = minutes.meeting_head(F.col("text"))
    return docs.select("file", *[c.alias(n) for n, c in got.items()])


@query(
    """WITH i AS (SELECT DISTINCT item_id, file, trim(record_id) AS r, trim(section) AS section, nullif(trim(regexp_replace(action, '\\s+', ' ', 'g')), '') AS action, item_id % 4 AS w FROM items WHERE section IS NOT NULL)
        SELECT file, row_number() OVER (PARTITION BY file ORDER BY item_id)::INT - 1 AS item_seq, CASE w WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN '' ELSE 'C' END AS section_letter, section,
               (item_id % 90 + 1) || CASE WHEN w = 2 THEN 'a' ELSE '' END AS item_num, coalesce(r, '') AS record_id, action FROM i"""
)
def agenda_round_trip(spark, d):
    """Minutes written from the whole items table, one document per file, in four layouts of titles, items and labels, parsed and compared item by item.

    Titles stand behind a letter, below it, without one, or over two lines; items begin with a record, a contact or a title
    in capitals, on the line of their number or below it; labels have their colon behind them, a line below, or none.
    """
    i = table(spark, d, "items").where("section IS NOT NULL").select("item_id", "file", F.trim("record_id").alias("r"), F.trim("section").alias("section"), F.trim(F.regexp_replace("action", r"\s+", " ")).alias("action")).distinct()
    w, nl = F.col("item_id") % 4, F.lit("\n")
    title = F.when(w == 0, F.concat(F.lit("A. "), "section")).when(w == 1, F.concat(F.lit("B.\n\n"), "section")).when(w == 2, F.col("section")).otherwise(F.concat(F.lit("C.  "), F.regexp_replace("section", "^(\\S+) ", "$1\n")))
    number = F.concat((F.col("item_id") % 90 + 1).cast("string"), F.when(w == 2, "a").otherwise(""))
    contact = F.lit("(A. STARR: (415) 555-0100)")
    record = F.when(w == 0, F.concat(number, F.lit(". "), "r", F.lit(" "), contact)).when(w == 1, F.concat(number, nl, "r")).otherwise(F.concat(F.lit("  "), number, F.lit(". "), "r"))
    bare = F.concat(number, F.lit(". "), F.when(w % 2 == 0, contact).otherwise(F.lit("LAND ACKNOWLEDGEMENT")))
    label = F.when(w == 0, "ACTION: ").when(w == 1, "ACTION\n: ").when(w == 2, "ACTION\n").otherwise("Action: ")
    one = F.concat(title, nl, F.coalesce(record, bare), F.lit("\nThe request\nSPEAKERS: + Ann Lee\n"), F.when(F.coalesce("action", F.lit("")) != "", F.concat(label, F.col("action"), nl)).otherwise(""))
    docs = i.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("item_id", one.alias("t")))).alias("p"))  # the items of one meeting's file
    docs = docs.select("file", F.concat(F.lit("MINUTES OF REGULAR MEETING\n\n"), F.array_join(F.transform("p", lambda x: x["t"]), "\n")).alias("text"))
    got = minutes.agenda_items(minutes.split_meetings(docs))
    return got.select("file", "item_seq", "section_letter", "section", "item_num", "record_id", F.nullif("action", F.lit("")).alias("action"))


@query()
def speaker_lists(spark, d):
    """Every speakers block of every item as rows."""
    return speakers.speaker_rows(spread(items(spark, d, "speakers")))


@query()
def name_cleanup(spark, d):
    c = comments(spark, d, "channel", "name_raw", "comment", "sign").where("channel = 'spoken'").drop("channel")
    return names.clean_names(c)


def _label_sql(c: str, nouns: list[str]) -> str:
    """Whether ``c`` holds nothing but role words, one of them a noun."""
    words = f"list_filter(regexp_split_to_array(regexp_replace(lower({c}), {POSSESSIVE_SQL}, '', 'g'), '\\s+'), lambda w: w <> '')"
    known = [*nouns, *[n + "s" for n in nouns]]
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    return f"(list_has_any({words}, {listed(known)}) AND list_has_all({listed([*known, *roles.ROLE_QUALIFIERS, 'representative'])}, {words}))"


POSSESSIVE_SQL = r"'[’'']s\b|\bco-'"
PARTED_SQL = r"'^(.*?)[\s–—,-]*[–—,-]\s*([^–—,-]+)$'"


@query(
    rf"""WITH c AS (SELECT DISTINCT comment_id, name_clean, role_title, is_anonymous, coalesce(name_clean, '') AS n FROM comments),
             p AS (SELECT *, regexp_replace(n, '(?i)\b(co)-', '\1~', 'g') AS w FROM c),
             k AS (SELECT *, replace(trim(regexp_extract(w, {PARTED_SQL}, 2)), '~', '-') AS label, replace(trim(regexp_extract(w, {PARTED_SQL}, 1)), '~', '-') AS head FROM p),
             f AS (SELECT *, label <> '' AND head <> '' AND {_label_sql('label', roles.FOLLOWING)} AS cut FROM k),
             b AS (SELECT *, {_label_sql('CASE WHEN cut THEN head ELSE n END', roles.ROLE_NOUNS)} OR {_label_sql('n', roles.ROLE_NOUNS)} AS bare FROM f)
        SELECT comment_id, CASE WHEN bare THEN NULL WHEN cut THEN head ELSE name_clean END AS name_clean, coalesce(role_title, nullif(CASE WHEN bare THEN trim(n) WHEN cut THEN label END, '')) AS role_title,
               CASE WHEN bare THEN 1 ELSE is_anonymous END::INT AS is_anonymous FROM b"""
)
def role_labels(spark, d):
    c = comments(spark, d, "name_clean", "role_title", "is_anonymous")
    return roles.demote_role_labels(c)


# ------------------------------------------------------------------ lists and search


@query(f"SELECT project, n FROM (SELECT project, count(*)::BIGINT AS n FROM {C} WHERE project IS NOT NULL GROUP BY 1) ORDER BY n DESC, project LIMIT 300")
def top_projects(spark, d):
    """Report: the 300 projects with most comments."""
    return comments(spark, d, "project").where("project IS NOT NULL").groupBy("project").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "project").limit(300)


@query(
    f"""SELECT campaign, comment_id, rank FROM (SELECT campaign, comment_id, row_number() OVER (PARTITION BY campaign ORDER BY text IS NULL, day DESC NULLS LAST, comment_id)::INT AS rank FROM {C} WHERE campaign IS NOT NULL) WHERE rank <= 6"""
)
def campaign_examples(spark, d):
    """Report: six messages per campaign, those with text first."""
    c = table(spark, d, "comments").where("campaign IS NOT NULL").select("campaign", "comment_id", F.col("text").isNull().alias("empty"), printed_date(F.col("meeting_date")).alias("day")).distinct()
    return A.top_k(c, ["campaign"], [F.asc("empty"), F.desc_nulls_last("day"), F.asc("comment_id")], 6).select("campaign", "comment_id", "rank")


@query("SELECT record_id, project_name FROM projects WHERE contains(lower(project_name), 'park')")
def substring_search(spark, d):
    return table(spark, d, "projects").where(F.lower("project_name").contains("park")).select("record_id", "project_name")


@query("""SELECT '{"t":"' || project_name || '","s":"' || record_id || '","u":"/p/' || record_id || '","k":"project"}' AS json FROM projects WHERE project_name IS NOT NULL""")
def search_json(spark, d):
    p = table(spark, d, "projects").where("project_name IS NOT NULL").withColumn("url", F.concat(F.lit("/p/"), "record_id"))
    return search_index(p, "project_name", "record_id", "url", "project")


@query("SELECT DISTINCT source_url AS url, regexp_replace(string_split(source_url, '/')[-1], '[^A-Za-z0-9._-]', '_', 'g') AS local, CASE WHEN regexp_matches(lower(source_url), '\\.pdf$') THEN 'pdf' ELSE 'html' END AS kind FROM items WHERE source_url IS NOT NULL")
def pages_manifest(spark, d):
    """Where minutes come from: links, their kind and the file they are kept in."""
    links = page_links(table(spark, d, "items").where("source_url IS NOT NULL").select(F.col("source_url").alias("url"), F.lit("Minutes").alias("label"), F.col("section").alias("row_text")))
    return links.select("url", X.local_name(F.col("url"), F.col("kind")).alias("local"), "kind")


# ------------------------------------------------------------------ identity and models

KEYED = "trim(regexp_replace(regexp_replace(lower(regexp_replace(trim(name_clean), '^([A-Z][a-z]+)([A-Z][a-z])', '\\1 \\2')), '[^a-z\\s''-]', '', 'g'), '\\s+', ' ', 'g'))"


@query(
    f"""WITH n AS (SELECT {KEYED} AS name, count(*)::BIGINT AS n FROM {O.COMMENTS} WHERE name_clean IS NOT NULL GROUP BY 1), k AS (SELECT *, string_split(name, ' ') AS t FROM n WHERE name LIKE '% %'),
             b AS (SELECT *, left(name, 1) || '|' || left(t[-1], 2) || '|' || len(t) AS block FROM k)
        SELECT CASE WHEN x.n >= y.n THEN x.name ELSE y.name END AS canonical, CASE WHEN x.n >= y.n THEN y.name ELSE x.name END AS variant, greatest(x.n, y.n) AS n_canonical, least(x.n, y.n) AS n_variant, levenshtein(x.name, y.name)::INT AS dist
        FROM b x JOIN b y ON x.block = y.block AND x.name < y.name WHERE levenshtein(x.name, y.name) BETWEEN 1 AND 2"""
)
def fuzzy_pairs(spark, d):
    """Spellings up to two edits apart inside a block."""
    n = comments(spark, d, "name_clean").where("name_clean IS NOT NULL").groupBy(identity.name_key(F.col("name_clean")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return names.fuzzy_pairs(n).select("canonical", "variant", "n_canonical", "n_variant", "dist")


@query()
def fuzzy_merges(spark, d):
    """What is merged automatically, chains resolved, and what is left for review."""
    n = comments(spark, d, "name_clean").where("name_clean IS NOT NULL").groupBy(F.col("name_clean").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    judged = written(names.judged(names.fuzzy_pairs(n)), "fuzzy")
    applied = names.merge_map(judged).withColumn("status", F.lit("applied"))
    return applied.unionByName(judged.where("verdict = 'review'").select("variant", "canonical").withColumn("status", F.lit("candidate")))


@query()
def commenter_components(spark, d):
    c = comments(spark, d, "project", "year", "name_clean").withColumn("name", identity.name_key(F.col("name_clean"))).where("name <> ''").select("name", "project", "year")
    return identity.resolve_commenters(written(c, "names"))


@query()
def imputed_positions(spark, d):
    """Positions of spoken comments, the missing ones by the model; anonymous rows are left alone."""
    c = written(comments(spark, d, "channel", "text", "position", "is_anonymous").where("channel = 'spoken'").drop("channel"), "polarity")
    scored = polarity.predict_positions(c, polarity.fit_positions(c, "text", "position", id_="comment_id"), "text")
    return polarity.impute(scored, "position", F.col("is_anonymous") == 1).select("comment_id", "predicted", "probability", "position_final", "position_source")


@query()
def release_table(spark, d):
    """The whole release: both channels, once, scrubbed, with commenters resolved."""
    out = release(table(spark, d, "comments"))
    return out.select("comment_id", "channel", "item_id", "name_clean", "position", "campaign_key", "commenter_id", "text")


@query(
    r"""WITH q AS (SELECT doc_id, translate(replace(text, chr(13), ''), '’‘“”', chr(39) || chr(39) || '""') AS t FROM documents),
             p AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '.*Page [0-9]+ of [0-9]+.*', '', 'g'), '(?m)^[ \t]*Last updated:.*$', '', 'g'),
                                                 '(?m)^\f?Port Alder Planning Commission\s+[A-Za-z]+day, [A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}[ \t]*$', '', 'g') AS t FROM q),
             m AS (SELECT doc_id, regexp_replace(replace(t, chr(12), chr(10)), '\?{3,}', ' ', 'g') AS t FROM p)
        SELECT doc_id, regexp_replace(regexp_replace(t, '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS text FROM m"""
)
def furniture_off(spark, d):
    """Documents without curly quotes, furniture of pages and runs of blank lines."""
    t = X.collapse_blank(X.drop_furniture(X.fold_quotes(F.col("text"))))
    return table(spark, d, "documents").select("doc_id", t.alias("text"))


@query(
    f"""WITH m AS (SELECT DISTINCT file, {O.printed_date('meeting_date')} AS day, regexp_extract(file, '((19|20)[0-9]{{6}})_', 1) AS k FROM meetings WHERE file IS NOT NULL),
             e AS (SELECT *, CASE WHEN k <> '' THEN substr(k, 1, 4) || '-' || substr(k, 5, 2) || '-' || substr(k, 7, 2) END AS expected, strftime(day, '%Y-%m-%d') AS printed FROM m),
             n AS (SELECT file, count(DISTINCT coalesce(printed, '?')) AS n FROM e GROUP BY file)
        SELECT file, CASE WHEN n = 1 AND expected IS NOT NULL THEN expected ELSE printed END AS meeting_date FROM e JOIN n USING (file)"""
)
def reconciled_dates(spark, d):
    """Dates of meetings, corrected by what the file's name announces."""
    m = table(spark, d, "meetings").where("file IS NOT NULL").select("file", F.date_format(printed_date(F.col("meeting_date")), "yyyy-MM-dd").alias("meeting_date")).distinct()
    m = m.withColumn("expected", minutes.expected_date(F.col("file"), F.lit("")))
    return minutes.reconcile_dates(m).select("file", "meeting_date")


@query(f"SELECT 'comments' AS stage, 'values:channel' AS metric, channel AS key, count(*)::BIGINT AS value FROM {O.COMMENTS} GROUP BY channel UNION ALL SELECT 'comments', 'rows', NULL, count(*) FROM {O.COMMENTS} UNION ALL SELECT 'comments', 'filled:channel', NULL, count(channel) FROM {O.COMMENTS}")
def stage_metrics(spark, d):
    return A.metrics("comments", comments(spark, d, "channel"), ["channel"])


from hearthline import catalog_stages  # noqa: E402, F401  (registers its queries; needs the names above)
