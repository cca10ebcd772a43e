"""Queries of the operators between the stages, with their SQL oracles. Imported by ``catalog``, which registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline import oracles as O
from hearthline.catalog import C, I, comments, items, query
from hearthline.functions import text as X
from hearthline.functions.printed import case_number
from hearthline.operators import roles
from hearthline.operators import stages as S
from hearthline.session import table
from hearthline.sources import readers

PROJECTS = f"(SELECT *, {O.case_number('record_id')} AS project FROM projects)"


def projects(spark, d):
    return table(spark, d, "projects").withColumn("project", case_number(F.col("record_id")))


# ------------------------------------------------------------------ stage joins


@query(
    f"""WITH p AS (SELECT project, record_id, project_name, number_of_units_net FROM {PROJECTS} WHERE project IS NOT NULL QUALIFY row_number() OVER (PARTITION BY project ORDER BY record_id) = 1)
        SELECT item_id, project, p.record_id AS first_record, project_name, number_of_units_net FROM (SELECT DISTINCT item_id, project FROM {I}) i LEFT JOIN p USING (project)"""
)
def items_with_projects(spark, d):
    """Items with the first record of their project; projects are reduced before the join."""
    right = projects(spark, d).withColumn("first_record", F.col("record_id"))
    return S.left_lookup(items(spark, d, "project").select("item_id", "project").distinct(), right, "project", ["first_record"], ["first_record", "project_name", "number_of_units_net"])


LOT_SQL = "CASE WHEN trim(block) <> '' AND trim(lot) <> '' THEN trim(block) || '/' || ltrim(trim(lot), '0') END"


@query(f"WITH k AS (SELECT record_id, {LOT_SQL} AS parcel FROM projects), n AS (SELECT parcel, count(*)::BIGINT AS n FROM k WHERE parcel IS NOT NULL GROUP BY 1) SELECT record_id, parcel, coalesce(n, 0)::BIGINT AS n_records FROM k LEFT JOIN n USING (parcel)")
def parcels(spark, d):
    """Records joined by block and lot, leading zeros off; a missing part matches nothing."""
    block, lot = F.trim("block"), F.trim("lot")
    k = table(spark, d, "projects").select("record_id", F.when((block != "") & (lot != ""), F.concat(block, F.lit("/"), F.ltrim(lot, F.lit("0")))).alias("parcel"))
    return S.with_counts(k, k, "parcel", "n_records")


@query(f"SELECT i.item_id, coalesce(n, 0)::BIGINT AS n_comments FROM (SELECT DISTINCT item_id FROM {I} WHERE site_address IS NOT NULL) i LEFT JOIN (SELECT item_id, count(*) AS n FROM {C} WHERE item_id IS NOT NULL GROUP BY 1) c USING (item_id)")
def items_with_comments(spark, d):
    placed = table(spark, d, "items").where("site_address IS NOT NULL").select("item_id").distinct()
    return S.with_counts(placed, comments(spark, d, "item_id"), "item_id", "n_comments")


@query(
    f"""WITH s AS (SELECT project, count(*)::BIGINT AS n FROM {C} WHERE project IS NOT NULL GROUP BY 1),
             p AS (SELECT project, record_id, project_address, open_date FROM {PROJECTS} WHERE project IS NOT NULL QUALIFY row_number() OVER (PARTITION BY project ORDER BY record_id) = 1)
        SELECT project, n, project_address, open_date FROM s LEFT JOIN p USING (project)"""
)
def project_meta(spark, d):
    """Statistics of projects with what is known of them."""
    stats = comments(spark, d, "project").where("project IS NOT NULL").groupBy("project").agg(F.count(F.lit(1)).alias("n"))
    return S.left_lookup(stats, projects(spark, d), "project", ["record_id"], ["project_address", "open_date"])


# ------------------------------------------------------------------ roles by precedence

ROLE_GROUPS = {"Tenant Association": "organised", "Neighborhood Association": "organised", "Commercial Association": "organised", "Project Sponsor": "applicant"}
GROUP_SQL = "CASE role " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_GROUPS.items()) + " ELSE role END"


@query(
    f"""WITH c AS (SELECT comment_id, lower(trim(name_clean)) AS name_l, year, nullif(trim(role_title), '') AS stated, {O.cascade("nullif(trim(organization), '')", roles.ORGANISATION_RULES, None)} AS kind FROM {C}),
             m AS (SELECT lower(trim(name)) AS k, 'Staff without a title' AS r FROM staff_tenure WHERE title IS NULL AND trim(name) <> '' GROUP BY 1),
             t AS (SELECT lower(trim(name)) AS k, title AS r, year(first_seen)::INT AS f FROM staff_tenure WHERE title IS NOT NULL AND trim(name) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY title, coalesce(year(first_seen), 0)) = 1),
             g AS (SELECT c.comment_id, CASE WHEN m.r IS NOT NULL THEN ['manual', m.r] WHEN t.r IS NOT NULL AND (t.f IS NULL OR c.year >= t.f) THEN ['roster', t.r] WHEN kind IS NOT NULL THEN ['stated_organization', kind] WHEN stated IS NOT NULL THEN ['stated_role', stated] END AS x
                   FROM c LEFT JOIN m ON c.name_l = m.k LEFT JOIN t ON c.name_l = t.k)
        SELECT comment_id, role, role_source, {GROUP_SQL} AS role_group FROM (SELECT comment_id, x[2] AS role, x[1] AS role_source FROM g)"""
)
def roles_by_precedence(spark, d):
    """A role for each comment: by hand, by the roster from its year on, by the organisation, as stated."""
    c = comments(spark, d, "name_clean", "role_title", "organization", "year").withColumn("name_l", F.lower(F.trim("name_clean")))
    staff = table(spark, d, "staff_tenure")
    groups = spark.createDataFrame(list(ROLE_GROUPS.items()), "role string, grp string")
    got = S.assign_roles(
        c,
        [
            S.RoleSource("manual", table=staff.where("title IS NULL").select("name", F.lit("Staff without a title").alias("role"))),
            S.RoleSource("roster", table=staff.select("name", "title", F.year("first_seen").alias("floor")), floor=True),
            S.RoleSource("stated_organization", column=roles.classify(F.col("organization"))),
            S.RoleSource("stated_role", column=F.nullif(F.trim("role_title"), F.lit(""))),
        ],
        groups=groups,
    )
    return got.select("comment_id", "role", "role_source", "role_group")


SIGN_RULES = [("sponsor|architect|owner|applicant", "+"), ("appellant|requestor", "-")]


@query(f"SELECT comment_id, coalesce(sign, {O.cascade('role_title', SIGN_RULES, None)}) AS sign FROM {O.COMMENTS} WHERE channel = 'spoken'")
def implied_signs(spark, d):
    c = comments(spark, d, "channel", "sign", "role_title").where("channel = 'spoken'")
    return c.select("comment_id", S.implied_sign(F.col("sign"), F.col("role_title"), SIGN_RULES).alias("sign"))


@query(f"SELECT comment_id FROM {O.COMMENTS} WHERE coalesce(trim(name_clean), '') <> '' OR sign IS NOT NULL OR coalesce(is_anonymous, 0) = 1 OR length(trim(coalesce(comment, text, ''))) >= 3")
def kept_comments(spark, d):
    c = comments(spark, d, "name_clean", "sign", "is_anonymous", "comment", "text")
    return c.where(S.says_something(F.col("name_clean"), F.col("sign"), F.col("is_anonymous"), F.coalesce("comment", "text"), F.lit(None).cast("string"))).select("comment_id")


LEFT_OUT = ["Tenant Association"]


@query(f"SELECT comment_id FROM {C} WHERE year BETWEEN 2023 AND 2024 AND NOT coalesce({O.cascade(chr(110) + 'ullif(trim(organization), {q})', roles.ORGANISATION_RULES, None)} IN ('Tenant Association'), false) AND coalesce(lower(trim(name_clean)) NOT IN (SELECT lower(trim(name)) FROM staff_tenure WHERE name IS NOT NULL), true)".replace("{q}", "''"))
def public_comments(spark, d):
    """Comments of the public of some years: no staff, no role that is left out."""
    staff = table(spark, d, "staff_tenure").where("name IS NOT NULL").select(F.lower(F.trim("name")).alias("_n")).distinct().withColumn("is_staff", F.lit(1))
    c = comments(spark, d, "name_clean", "organization", "year").where(F.col("year").between(2023, 2024))
    c = c.join(staff, F.lower(F.trim("name_clean")) == F.col("_n"), "left")
    return c.where(S.public_comment(F.col("is_staff"), F.lit(None).cast("int"), roles.classify(F.col("organization")), LEFT_OUT)).select("comment_id")


# ------------------------------------------------------------------ ids, keys, splits


@query("SELECT comment_id, printf('s%07d', row_number() OVER (ORDER BY comment_id) - 1) AS row_id FROM (SELECT DISTINCT comment_id FROM comments WHERE channel = 'spoken')")
def row_ids(spark, d):
    c = table(spark, d, "comments").where("channel = 'spoken'").select("comment_id").distinct()
    return S.row_ids(c, ["comment_id"], "row_id")


@query(f"SELECT min(comment_id) AS comment_id FROM {C} GROUP BY channel, lower(name_clean), project, day, sha256(text)")
def shown_once(spark, d):
    """What a page shows once: equal in channel, name, project, day and text (compared by its SHA-256)."""
    c = comments(spark, d, "channel", "name_clean", "project", "day", "text")
    return c.groupBy("channel", F.lower("name_clean"), "project", "day", F.sha2("text", 256)).agg(F.min("comment_id").alias("comment_id")).select("comment_id")


@query(f"SELECT comment_id, coalesce(nullif(trim(name_clean), ''), 'anon:' || nullif(trim(sender_id), '')) AS who FROM {O.COMMENTS}")
def commenter_keys(spark, d):
    return comments(spark, d, "name_clean", "sender_id").select("comment_id", S.commenter_key(F.col("name_clean"), F.col("sender_id")).alias("who"))


@query(f"SELECT comment_id, CASE WHEN position IS NOT NULL THEN (('0x' || substr(md5(position || '|' || comment_id), 1, 8))::BIGINT / 4294967296.0 < 0.15)::INT END AS held_out FROM {O.COMMENTS}")
def stratified_split(spark, d):
    return S.stratified_split(comments(spark, d, "position"), "position", "comment_id", 0.15).select("comment_id", "held_out")


SAID_SQL = "CASE WHEN regexp_matches(text, '(?i)\\b(oppose|reject|deny)') THEN 'oppose' WHEN regexp_matches(text, '(?i)\\b(support|endorse|approve)') THEN 'support' ELSE 'neutral' END"


def _said(c):
    t = F.col("text")
    said = F.when(t.rlike(r"(?i)\b(oppose|reject|deny)"), "oppose").when(t.rlike(r"(?i)\b(support|endorse|approve)"), "support").otherwise("neutral")
    return c.where("position IS NOT NULL").withColumn("said", said)


@query(f"WITH k AS (SELECT position AS truth, {SAID_SQL} AS said, count(*)::BIGINT AS n FROM {O.COMMENTS} WHERE position IS NOT NULL GROUP BY ALL) SELECT truth, said, n, round(n / sum(n) OVER (PARTITION BY truth), 9) AS share FROM k")
def confusion_matrix(spark, d):
    """How a rule that reads a few words agrees with the recorded positions."""
    return S.confusion(_said(comments(spark, d, "position", "text")), "position", "said")


@query(
    f"""WITH k AS (SELECT position AS t, {SAID_SQL} AS s FROM {O.COMMENTS} WHERE position IS NOT NULL),
             l AS (SELECT t AS label FROM k UNION SELECT s FROM k), n AS (SELECT label, (SELECT count(*) FROM k WHERE t = label) AS r, (SELECT count(*) FROM k WHERE s = label) AS g, (SELECT count(*) FROM k WHERE t = label AND s = label) AS h FROM l)
        SELECT label, round(h / nullif(g, 0), 9) AS precision, round(h / nullif(r, 0), 9) AS recall, round(2 * h / (r + g), 9) AS f1 FROM n"""
)
def label_scores(spark, d):
    return S.scores(_said(comments(spark, d, "position", "text")), "position", "said")


# ------------------------------------------------------------------ text and marks

CAPS_SQL = "length(regexp_replace(x, '[^A-Z]', '', 'g')) >= 0.85 * length(regexp_replace(x, '[^A-Za-z]', '', 'g')) AND regexp_matches(x, '[A-Za-z]')"


@query(f"SELECT DISTINCT item_id, list_filter(list_filter(list_transform(string_split(replace(item_text, chr(13), ''), chr(10)), lambda x: trim(x)), lambda x: length(x) >= 4), lambda x: ({CAPS_SQL}) OR regexp_matches(x, '^[0-9]+ [A-Z]'))[1] AS title FROM items")
def text_titles(spark, d):
    return table(spark, d, "items").select("item_id", X.title_in_text(F.col("item_text")).alias("title")).distinct()


@query("SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS html FROM documents")
def escaped_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", X.escape_html(F.col("text")).alias("html"))


@query(f"SELECT DISTINCT day, 'https://archive.portalder.example/packets/' || month(day) || '_' || day(day) || '_' || year(day) || '/packet_' || strftime(day, '%Y%m%d') || '.pdf' AS url FROM {C} WHERE day IS NOT NULL")
def packet_urls(spark, d):
    days = comments(spark, d, "day").where("day IS NOT NULL").select("day").distinct()
    return days.select("day", X.packet_url("https://archive.portalder.example/packets", F.col("day")).alias("url"))


@query(
    f"""WITH t AS (SELECT channel, day, round(year(day) + dayofyear(day) / 366.0, 6) AS x, count(*)::BIGINT AS n FROM {C} WHERE project = '2001-000007' AND day IS NOT NULL GROUP BY channel, day)
        SELECT channel, day, x, round(least(13, 3 + 1.6 * sqrt(n)), 6) AS radius, ((row_number() OVER (PARTITION BY channel, floor(x) ORDER BY day) - 1) % 3)::INT AS level FROM t"""
)
def timeline_points(spark, d):
    """Marks of one project's time line, stacked by turns inside a year."""
    t = comments(spark, d, "channel", "project", "day").where("project = '2001-000007' AND day IS NOT NULL").groupBy("channel", "day").agg(F.count(F.lit(1)).alias("n"))
    t = t.withColumn("x", S.year_fraction(F.col("day"))).withColumn("_year", F.floor("x"))
    t = S.stacked(t, ["channel", "_year"], ["day"], "level")
    return t.select("channel", "day", "x", F.round(F.least(F.lit(13.0), 3 + 1.6 * F.sqrt("n")), 6).alias("radius"), "level")


@query(
    f"""WITH s AS (SELECT year, (count(*) FILTER (position = 'support') - count(*) FILTER (position = 'oppose')) / nullif(count(*) FILTER (position IN ('support', 'oppose')), 0) AS net FROM {C} WHERE year IS NOT NULL GROUP BY year)
        SELECT year, round(net, 9) AS net, CASE WHEN net IS NOT NULL THEN printf('#%02x%02x%02x', round(CASE WHEN net < 0 THEN 247 + 69 * net ELSE 247 - 214 * net END)::INT, round(CASE WHEN net < 0 THEN 247 + 223 * net ELSE 247 - 145 * net END)::INT, round(CASE WHEN net < 0 THEN 247 + 204 * net ELSE 247 - 75 * net END)::INT) END AS colour FROM s"""
)
def year_tints(spark, d):
    c = comments(spark, d, "year", "position").where("year IS NOT NULL").groupBy("year").agg(F.count_if(F.col("position") == "support").alias("a"), F.count_if(F.col("position") == "oppose").alias("b"))
    net = (F.col("a") - F.col("b")) / F.nullif(F.col("a") + F.col("b"), F.lit(0))
    return c.select("year", F.round(net, 9).alias("net"), S.tint(net).alias("colour"))


@query(f"SELECT round(avg(n), 6) AS mean, count(*)::BIGINT AS n_years FROM (SELECT year, count(*) AS n FROM {C} WHERE year BETWEEN 2023 AND 2024 GROUP BY year)")
def window_mean(spark, d):
    y = comments(spark, d, "year").where(F.col("year").between(2023, 2024)).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return y.agg(F.round(F.avg("n"), 6).alias("mean"), F.count(F.lit(1)).alias("n_years"))


# ------------------------------------------------------------------ crawl plans


@query("SELECT name, (first_seen + to_months((3 * k)::INT))::DATE AS at FROM (SELECT DISTINCT name, first_seen, last_seen FROM staff_tenure) s, range(0, 1200) t(k) WHERE first_seen + to_months((3 * k)::INT) <= last_seen")
def snapshot_grid(spark, d):
    """The dates at which snapshots of a page would be asked for."""
    s = table(spark, d, "staff_tenure").select("name", "first_seen", "last_seen").distinct()
    return readers.snapshot_dates(s, "first_seen", "last_seen", 3).select("name", "at")


@query("SELECT DISTINCT source_url AS url, replace(source_url, '://archive.', '://mirror.') AS retry_url FROM items WHERE source_url IS NOT NULL")
def retry_plan(spark, d):
    manifest = table(spark, d, "items").where("source_url IS NOT NULL").select(F.col("source_url").alias("url"), F.lit("error 503").alias("status")).distinct()
    return readers.to_retry(manifest, {"archive.": "mirror."}).select("url", "retry_url")
