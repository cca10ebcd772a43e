"""The release: spoken and written comments as one table, without fan-out copies and contact details, people resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.printed import case_number, printed_date
from hearthline.functions.rules import lookup
from hearthline.functions.text import blank_to_null, scrub_contacts
from hearthline.operators.identity import name_key, resolve_commenters
from hearthline.operators.relational import keep_first, keep_first_resolvable, split_mixed, union_aligned
from hearthline.session import written

POSITION = {"+": "support", "-": "oppose", "=": "neutral"}
LEAD = ("comment_id", "channel", "meeting_date", "item_id", "id_parent", "name_clean", "position", "position_source", "text")


def spoken_table(comments: DataFrame, *columns: str) -> DataFrame:
    """Spoken comments, each testimony once: of rows equal in date, name, note and project the smallest id stays; rows without project or name are kept.

    Only ``columns`` (all if none are named) and the keys are read; the note is compared by its SHA-256.
    """
    keep = [c for c in (columns or comments.columns) if c not in ("comment_id", "loaded_at")]
    spoken = comments.where("channel = 'spoken'").select("comment_id", *keep, case_number(F.col("id_parent")).alias("_p"), printed_date(F.col("meeting_date")).alias("_d"), F.col("name_raw").alias("_r"), F.sha2("comment", 256).alias("_c")).distinct()
    kept = keep_first_resolvable(spoken, ["_d", "_r", "_c", "_p"], ["_r", "_p"], ["comment_id"]).drop("_p", "_d", "_r", "_c")
    if "position" in keep and "sign" in keep:
        kept = kept.withColumn("position", F.coalesce(lookup(F.col("sign"), POSITION), "position"))
    return kept.withColumn("text", F.coalesce("text", "comment")) if "text" in keep and "comment" in keep else kept


def written_table(comments: DataFrame, *columns: str) -> DataFrame:
    """Written comments with a sender, each message (sender, project, date, text) once, notices left out, mixed campaigns split by position in ``campaign_key``.

    Only ``columns`` (all if none are named) and the keys are read; texts are compared by their SHA-256.
    """
    notice = r"(?i)^\s*(\*{3}\s*media advisory|for immediate release|mayor'?s? (press )?office|schedule of public events)"
    keep = [c for c in (columns or comments.columns) if c not in ("comment_id", "loaded_at")]
    more = [c for c in ("is_campaign", "campaign", "position") if c not in keep]
    mail = comments.where("channel = 'email'").where(blank_to_null(F.col("sender_id")).isNotNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(notice))
    mail = mail.select("comment_id", *keep, *more, F.col("sender_id").alias("_s"), F.col("id_parent").alias("_i"), F.col("meeting_date").alias("_d"), F.sha2("text", 256).alias("_t"))
    once = keep_first(mail, ["_s", "_i", "_d", "_t"], ["comment_id"]).drop("_s", "_i", "_d", "_t")
    split = split_mixed(once.withColumn("_c", F.when(F.col("is_campaign") == 1, F.col("campaign"))), "_c", "position", "support", "oppose", "campaign_key")
    return split.drop("_c", *more)


def release(comments: DataFrame) -> DataFrame:
    """Filter, deduplicate, unify, scrub, resolve, in this order."""
    both = union_aligned(spoken_table(comments.where("NOT coalesce(method, '') = 'same_as_unresolved'")), written_table(comments), lead=LEAD)
    for c in ("text", "comment", "subject"):
        both = both.withColumn(c, scrub_contacts(F.col(c)))
    keyed = both.withColumn("_n", name_key(F.col("name_clean"))).withColumn("_p", case_number(F.col("id_parent"))).withColumn("_y", F.year(printed_date(F.col("meeting_date"))))
    # resolving reads its table several times: a narrow one, written once
    who = resolve_commenters(written(keyed.where("_n <> ''").select(F.col("_n").alias("name"), F.col("_p").alias("project"), F.col("_y").alias("year")).distinct(), "release-names"))
    return keyed.join(who.withColumnRenamed("name", "_n"), "_n", "left").drop("_n", "_p", "_y")
