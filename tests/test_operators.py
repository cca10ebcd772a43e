import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hearthline.operators import aggregate as A
from hearthline.operators import identity, minutes, names, polarity, relational, roles, speakers


@pytest.mark.parametrize(
    "block, method, want",
    [
        (None, "none", []),
        ("None", "none", []),
        ("A. Lee and B. Ray spoke in opposition; C. Dow spoke in support", "tone_prose", [("-", "A. Lee", ""), ("-", "B. Ray", ""), ("+", "C. Dow", "")]),
        ("(+) Ann Lee (-) Bob Ray  too tall", "sign_inline", [("+", "Ann Lee", ""), ("-", "Bob Ray", "too tall")]),
        ("+ Ann Lee – Project presentation", "sign_lines", [("+", "Ann Lee", "Project presentation")]),
        ("+ Ann Lee – supports design\n- it is too dark at night", "sign_lines", [("+", "Ann Lee", "supports design it is too dark at night")]),
        ("In support: Ann L, Bob R. Opposed: Cy D", "tone_groups", [("+", "Ann L", ""), ("+", "Bob R", ""), ("-", "Cy D", "")]),
        ("Ann Lee\n\nRe: 12 Oak Street\n\nBob Ray\n\nRe: 7 Elm", "re_pairs", [(None, "Ann Lee", "Re: 12 Oak Street"), (None, "Bob Ray", "Re: 7 Elm")]),
        ("Ann Lee, Bob Ray, Cy Dow", "comma_list", [(None, "Ann Lee", ""), (None, "Bob Ray", ""), (None, "Cy Dow", "")]),
        ("Ann Lee: Requested continuance\nBob Ray: Opposes height", "name_colon", [(None, "Ann Lee", "Requested continuance"), (None, "Bob Ray", "Opposes height")]),
        ("Ann Lee – Intent of the code", "dash_lines", [(None, "Ann Lee", "Intent of the code")]),
        ("RE: Parking\nAnn Lee – too few spaces", "dash_lines", [(None, "Ann Lee", "[Re: Parking] too few spaces")]),
        ("Ann Lee", "single", [(None, "Ann Lee", "")]),
        ("Ann Lee\n, Director\n-first point\n-second point", "bullet_names", [(None, "Ann Lee, Director", "first point second point")]),
        ("it went on for a long while and nobody wrote down who said what at all", "unparsed", [(None, "", "it went on for a long while and nobody wrote down who said what at all")]),
    ],
)
def test_speaker_blocks(block, method, want):
    got, records = speakers.read_block(block)
    assert got == method
    assert [(r.sign, r.name, r.comment) for r in records] == want


def test_speaker_rows_are_ordered_and_references_kept(spark):
    df = spark.createDataFrame([(1, "+ Ann Lee – yes\n- Bob Ray – no"), (2, "Same as Item 9a."), (3, None)], "item_id int, speakers string")
    rows = speakers.speaker_rows(df).orderBy("item_id", "speaker_order").collect()
    assert [(r.item_id, r.speaker_order, r.sign, r.name_raw, r.same_as) for r in rows] == [(1, 1, "+", "Ann Lee", None), (1, 2, "-", "Bob Ray", None), (2, 1, None, "", "Same as Item 9a.")]


MINUTES = """Preamble
MINUTES OF REGULAR MEETING
Thursday, March 14, 2024
1:00 PM
COMMISSIONERS PRESENT: A. Lee, B. Ray

STAFF IN ATTENDANCE: C. Dow, D. Fox

A. CONSENT CALENDAR
1. 2015-009140CUA (J. LAU: (415) 558-6309)
12 OAK STREET - a request
SPEAKERS: + Ann Lee - fine
ACTION: Approved
AYES: Lee
Ray
2. LAND ACKNOWLEDGEMENT
B.
GENERAL PUBLIC COMMENT
SPEAKERS: Cy Dow
ADJOURNMENT: 4:05 PM
MINUTES OF SPECIAL MEETING
March 15, 2024
"""


def test_documents_to_items(spark):
    docs = minutes.split_meetings(spark.createDataFrame([("f", MINUTES)], "file string, text string"))
    head = minutes.meeting_head(F.col("text"))
    heads = docs.select("doc_seq", *[c.alias(n) for n, c in head.items()]).orderBy("doc_seq").collect()
    assert [(h.meeting_date, h.start_time, h.end_time, h.meeting_type) for h in heads] == [("2024-03-14", "13:00", "16:05", "regular"), ("2024-03-15", None, None, "special")]
    assert heads[0].staff_in_attendance == "C. Dow, D. Fox" and heads[0].commissioners_present == "A. Lee, B. Ray"
    items = minutes.agenda_items(docs.where("doc_seq = 0")).orderBy("item_seq").collect()
    assert [(i.section, i.item_num, i.record_id, i.action, i.ayes) for i in items] == [("CONSENT CALENDAR", "1", "2015-009140CUA", "Approved", "Lee\nRay"), ("CONSENT CALENDAR", "2", "", None, None), ("GENERAL PUBLIC COMMENT", "", "", None, None)]


def test_asof_forward_against_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, rnd.choice("abc") if rnd.random() > 0.05 else None, rnd.randrange(400) if rnd.random() > 0.05 else None) for i in range(200)]
    right = [(i, rnd.choice("ab"), rnd.randrange(400)) for i in range(60)]
    L, Rt = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "rid int, k string, h int")
    for block in (None, 37):
        got = {r.i: (r.rid, r.h) for r in relational.asof_forward(L, Rt, "k", "t", "h", "rid", block=block).collect()}
        for i, k, t in left:
            hit = min(((h, r) for r, kk, h in right if kk == k and t is not None and h >= t), default=(None, None))
            assert got[i] == (hit[1], hit[0])
    assert relational.asof_forward(L, Rt, "k", "t", "h", "rid", how="inner").count() == sum(k is not None and t is not None for _, k, t in left)


def test_keep_first_mode_and_split(spark):
    df = spark.createDataFrame([(3, "d", "n", None), (1, "d", "n", "p"), (2, "d", "n", "p"), (4, "d", "n", None)], "id int, d string, n string, p string")
    assert sorted(r.id for r in relational.keep_first_resolvable(df, ["d", "n", "p"], ["n", "p"], ["id"]).collect()) == [1, 3, 4]
    m = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", None), ("y", "c"), ("y", "c")], "k string, v string")
    assert {r.k: (r.mode, r.n_mode, r.n, r.n_values) for r in relational.mode_by(m, ["k"], "v").collect()} == {"x": ("a", 1, 2, 2), "y": ("c", 2, 2, 1)}
    c = spark.createDataFrame([("F", "support"), ("F", "oppose"), ("F", None), ("G", "support"), (None, "oppose")], "c string, p string")
    assert sorted(str(r.k) for r in relational.split_mixed(c, "c", "p", "support", "oppose", "k").collect()) == ["F [oppose]", "F [support]", "F [unclear]", "G", "None"]


def test_nearest_interval_fallback(spark):
    left = spark.createDataFrame([("OAK", 105), ("OAK", 300), ("ELM", 5)], "s string, n int")
    right = spark.createDataFrame([("OAK", 101, 1.0), ("OAK", 109, 2.0), ("OAK", 500, 3.0)], "s string, n int, lat double")
    got = {(r.s, r.n): (r.near_n, r.lat) for r in relational.nearest_number(left, right, "s", "n", 20, ["lat"]).collect()}
    assert got == {("OAK", 105): (101, 1.0), ("OAK", 300): (None, None), ("ELM", 5): (None, None)}
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(1, "a", day), (2, "b", day), (3, None, day)], "i int, k string, d date")
    spans = spark.createDataFrame([("a", day, day), ("a", day, day), ("b", dt.date(2021, 1, 1), dt.date(2022, 1, 1))], "k string, lo date, hi date")
    assert {r.i: r.hit for r in relational.within_interval(df, spans, "k", "d", "lo", "hi", "hit", "i").collect()} == {1: 1, 2: 0, 3: 0}
    base = spark.createDataFrame([("a", "z"), ("q", "b"), (None, None)], "x string, y string")
    tiers = [("one", spark.createDataFrame([("a", 1)], "k string, v int"), "x"), ("two", spark.createDataFrame([("b", 2), ("b", 3), ("z", 9)], "k string, v int"), "y")]
    assert sorted((r.v, r.v_source) for r in relational.fallback(base, tiers, "v").collect() if r.v) == [(1, "one"), (2, "two")]


def test_components_and_chains(spark):
    edges = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y"), (None, "q"), ("n9", "n8"), ("n8", "n7"), ("n7", "n6"), ("n6", "n5")], "a string, b string")
    got = {r.node: r.label for r in relational.components(edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", **{f"n{i}": "n5" for i in range(5, 10)}}
    assert relational.components(edges.limit(0)).count() == 0
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("z", "y")], "s string, t string")
    assert {r.s: r.t for r in relational.resolve_chain(chain, "s", "t").collect()} == {"a": "c", "b": "c", "z": "y"}


def test_names(spark):
    rows = [(1, " + Ann Lee, Project Architect, Oak Street Neighbors", "hello", None), (2, "Ann Lee and Bob Ray", None, "+"), (3, "Dr. Cy Dow", None, None), (4, "Speaker #2", "x", None), (5, "Ann Lee – sponsor", None, None), (6, "urged the commission to deny it", "c", None), (7, None, None, None), (8, "King, Jr.", None, None)]
    out = names.clean_names(spark.createDataFrame(rows, "id int, name_raw string, comment string, sign string")).collect()
    got = {(r.id, r.name_clean): (r.sign, r.role_title, r.organization, r.title, r.is_anonymous) for r in out}
    assert got[(1, "Ann Lee")] == (None, "Project Architect", "Oak Street Neighbors", None, 0) or got[(1, "Ann Lee")][1:3] == ("Project Architect", "Oak Street Neighbors")
    assert (2, "Ann Lee") in got and (2, "Bob Ray") in got and got[(3, "Cy Dow")][3] == "Dr" and got[(5, "Ann Lee")][1] == "sponsor"
    assert next(r for r in out if r.id == 6).comment == "urged the commission to deny it c" and next(r for r in out if r.id == 6).name_clean is None
    assert next(r for r in out if r.id == 7).name_clean is None


def test_similarity_and_merges(spark):
    assert names.indel_ratio_of("abc", "abc") == 100 and round(names.indel_ratio_of("mary johnson", "mary jonson"), 2) == 95.65
    rnd = random.Random(5)

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(100):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9))) for _ in "xy")
        assert names._common(a, b) == lcs(a, b)
    counts = spark.createDataFrame([("Mary Johnson", 6), ("Mary Jonson", 2), ("Mark Johnsen", 5), ("Zed Alone", 1)], "name string, n bigint")
    got = {(r.variant, r.canonical): r.verdict for r in names.judged(names.fuzzy_pairs(counts)).collect()}
    assert got[("Mary Jonson", "Mary Johnson")] == "auto"
    assert {r.variant: r.canonical for r in names.merge_map(names.judged(names.fuzzy_pairs(counts))).collect()} == {"Mary Jonson": "Mary Johnson"}


def test_commenters(spark):
    rows = [("ann lee", "p1", 2001), ("ann leee", "p1", 2020), ("bob rayman", "p2", 1998), ("bob raymen", "p3", 2023), ("solo", "p1", 2001)]
    got = {r.name: r.commenter_id for r in identity.resolve_commenters(spark.createDataFrame(rows, "name string, project string, year int")).collect()}
    assert got == {"ann lee": "ann lee", "ann leee": "ann lee", "bob rayman": "bob rayman", "bob raymen": "bob raymen", "solo": None}


def test_roles(spark):
    stated = spark.createDataFrame([("ann lee", "X", 2001), ("ann lee", "X", 2003), ("ann lee", "Y", 2002), ("solo", "X", 2001), ("bo ray", "X", 2001), ("bo ray", "Y", 2001)], "name string, role string, year int")
    got = {r.name: (r.role, r.agreement, r.year_lo, r.year_hi, r.used) for r in roles.derived_roster(stated).collect()}
    assert got == {"ann lee": ("X", 0.667, 1997, 2007, 1), "bo ray": ("X", 0.5, 1997, 2005, 0)}
    cell = spark.createDataFrame([("Ann Lee – Director; Bob Q. Ray, the planner and CY DOW",)], "c string")
    assert cell.select(roles.roster_names(F.col("c"))).first()[0] == ["Ann Lee", "Bob Q. Ray", "CY DOW"]
    labels = spark.createDataFrame([(1, "Project Sponsor", None, 0), (2, "Jerry -- Project Sponsor", None, 0), (3, "Ann Lee", None, 0), (4, None, None, 0)], "i int, name_clean string, role_title string, is_anonymous int")
    assert {r.i: (r.name_clean, r.role_title, r.is_anonymous) for r in roles.demote_role_labels(labels).collect()} == {1: (None, "Project Sponsor", 1), 2: ("Jerry", "Project Sponsor", 0), 3: ("Ann Lee", None, 0), 4: (None, None, 0)}


def test_series_and_bins(spark):
    s = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0)], "y int, v double")
    assert [r.m for r in A.rolling_mean(s, "y", "v", "m").orderBy("y").collect()] == [1.0, 2.0, 3.5, 3.5]
    n = spark.createDataFrame([(0,), (4,), (5,), (99,), (None,)], "n int")
    assert [r[0] for r in n.select(A.binned(F.col("n"), [0, 1, 5, 20])).collect()] == ["0", "1-4", "5-19", "20+", None]


def test_classifier_learns_and_survives_nothing(spark):
    good, bad = "I support this fine project and its homes", "I oppose this ugly tower and its shadow"
    rows = [(i, (good if i % 2 else bad) + f" number {i % 7}", None if i % 10 == 0 else ("support" if i % 2 else "oppose")) for i in range(200)]
    df = spark.createDataFrame([*rows, (999, None, None)], "id int, text string, position string")
    out = polarity.impute(polarity.predict_positions(df, polarity.fit_positions(df, "text", "position"), "text"), "position", F.lit(False)).collect()
    right = sum((r.position_final == ("support" if r.id % 2 else "oppose")) for r in out if r.id != 999 and r.position is None)
    assert right >= 19 and next(r for r in out if r.id == 999).position_final is None
    assert polarity.fit_positions(df.limit(0), "text", "position") is None
    report = {r.position: r for r in polarity.report(polarity.predict_positions(df, polarity.fit_positions(df, "text", "position", id_="id"), "text"), "position", 0.5).collect()}
    assert {k: (r.n, r.n_right, r.n_kept, r.n_kept_right) for k, r in report.items()} == {"support": (100,) * 4, "oppose": (80,) * 4}


def test_pairs_of_a_hot_key_are_made_in_blocks(spark):
    rows = [("hot", i) for i in range(41)] + [("b", 1), ("b", 2), ("c", 1), (None, 5), ("b", None)]
    got = [(r.k, r.v_a, r.v_b) for r in relational.pairs_within(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", 8).collect()]
    want = {("hot", i, j) for j in range(41) for i in range(j)} | {("b", 1, 2)}
    assert len(got) == len(set(got)) and set(got) == want


def test_edit_pairs_miss_none(spark):
    import random

    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(1, 14))) for _ in range(60)]
    names_ = set(base)
    for b in base:
        t = list(b)
        for _ in range(rnd.randint(1, 2)):
            at = rnd.randrange(len(t) + 1)
            t[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "a"])
        names_.add("".join(t))
    df = spark.createDataFrame([(n, n[:1]) for n in sorted(names_)], "name string, b string")
    got = {(r.name_a, r.name_b) for r in relational.edit_pairs(df, F.when(F.length("name") > 0, F.col("b")), "name").collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i] + [0] * len(b)
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    want = {(a, b) for a in names_ for b in names_ if a and a < b and a[0] == b[0] and edits(a, b) <= 2}
    assert want and want <= got


def test_row_ids_roles_and_splits(spark):
    from hearthline.operators import stages

    rows = spark.createDataFrame([(f"k{i:03d}",) for i in range(57)] + [("k000a",)], "k string")
    got = {r.k: r.id for r in stages.row_ids(rows, ["k"], "id", "s%03d").collect()}
    assert [got[k] for k in sorted(got)] == [f"s{i:03d}" for i in range(58)]
    c = spark.createDataFrame([(1, "ann lee", 2000, None), (2, "ann lee", 1990, "own"), (3, "bob", 2000, None), (4, None, 2000, "own")], "i int, name_l string, year int, stated string")
    roster = spark.createDataFrame([("Ann Lee", "planner", 1995), ("Ann Lee", "zoner", None), (" ", "x", None)], "name string, role string, floor int")
    hand = spark.createDataFrame([("bob", "clerk")], "name string, role string")
    groups = spark.createDataFrame([("clerk", "staff"), ("planner", "staff")], "role string, grp string")
    out = stages.assign_roles(c, [stages.RoleSource("hand", table=hand), stages.RoleSource("roster", table=roster, floor=True), stages.RoleSource("stated", column=F.col("stated"))], groups=groups)
    assert {r.i: (r.role, r.role_source, r.role_group) for r in out.collect()} == {1: ("planner", "roster", "staff"), 2: ("own", "stated", "own"), 3: ("clerk", "hand", "staff"), 4: ("own", "stated", "own")}
    held = stages.office_holders(spark.createDataFrame([("Dufty", "Supervisor"), ("Dufty", None)], "name_clean string, title string"), spark.createDataFrame([("dufty", "Bevan Dufty")], "alias string, canonical string"))
    assert sorted(r.name_clean for r in held.collect()) == ["Bevan Dufty", "Dufty"]
    assert stages.without(c, ["stated", "missing"]).columns == ["i", "name_l", "year"]
