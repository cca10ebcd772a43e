"""Fragments of DuckDB SQL that several oracles share. They restate the definitions, they don't call the library."""

from __future__ import annotations


def case_number(c: str) -> str:
    part = lambda g: f"regexp_extract({c}, '(^|[^0-9])([0-9]{{4}}|[0-9]{{2}})([.-])([0-9]+)', {g})"
    y, s, n = part(2), part(3), part(4)
    return f"(CASE WHEN coalesce({y}, '') = '' THEN NULL WHEN length({y}) = 2 THEN '19' || {y} || {s} || {n} ELSE {y} || {s} || {n} END)"


def printed_date(c: str) -> str:
    return (
        f"(coalesce(try_strptime(trim({c}), '%Y-%m-%d'), CASE WHEN regexp_matches(trim({c}), '^[0-9]{{8}}$') THEN try_strptime(trim({c}), '%Y%m%d') END, "
        f"try_strptime(trim({c}), '%m/%d/%Y'), try_strptime(trim({c}), '%B %d, %Y'))::DATE)"
    )


def cascade(c: str, rules, default: str | None) -> str:
    whens = " ".join("WHEN regexp_matches({}, '(?i){}') THEN '{}'".format(c, p.replace("'", "''"), label.replace("'", "''")) for p, label in rules)
    return f"(CASE WHEN {c} IS NULL THEN NULL {whens} ELSE {'NULL' if default is None else repr(default)} END)"


#: One row per comment: copies that were delivered twice differ in loaded_at only.
COMMENTS = "(SELECT DISTINCT * EXCLUDE (loaded_at) FROM comments)"
ITEMS = "(SELECT DISTINCT * EXCLUDE (loaded_at) FROM items)"
