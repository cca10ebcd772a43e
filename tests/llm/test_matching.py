"""Near duplicates, nearest time, addresses and names against brute force and hand-made cases."""

import random
import re
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hearthline.llm import addresses, hashing, names, near_duplicates, nearest_time, queries


def shingles(text):
    w = [x.lower() for x in re.findall(r"[^\W_]+", text or "")]
    return set(zip(w, w[1:], w[2:])) if len(w) >= 30 else None


def brute(rows):
    sets = {i: s for i, t in rows if i is not None and (s := shingles(t))}
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}


def test_near_duplicates_on_the_table(spark, data):
    c = pd.read_parquet(f"{data}/comments.parquet")
    c = c[(c.channel == "email")].drop_duplicates("comment_id")
    want = brute([(i, t if isinstance(t, str) else None) for i, t in zip(c.comment_id, c.text)])
    got = {(r.comment_id_a, r.comment_id_b) for r in queries.p1_found(spark, data).collect()}
    assert want and got <= want and len(got) >= 0.99 * len(want)


def test_near_duplicates_edges(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(60)]

    def edited(n):
        t = list(base)
        for _ in range(n):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        return " ".join(t)

    rows = [(f"e{k}", edited(k)) for k in range(8)] + [("same1", edited(0)), ("same2", edited(0).upper()), ("null", None), ("empty", ""), ("short", "a b c"), (None, edited(0)), ("long", " ".join(rnd.choice(words) for _ in range(30_000)))]
    rows += [(f"r{k}", " ".join(rnd.choice(words) for _ in range(50))) for k in range(30)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows + rows[:3]], "id string, text string, who string, print string")
    got = [(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_hot_signatures_are_joined_too(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "HOT", 3)
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(f"i{k:02d}", f"{base} tail{k}") for k in range(12)]
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got == brute(rows)


def drive_and_others(own):
    """A drive of a third of all records, with so many own words at the end of each letter, and unrelated letters."""
    base = " ".join(f"w{i}" for i in range(102))
    rows = [(f"d{k:03d}", " ".join([base, *(f"own{k}x{i}" for i in range(own(k)))])) for k in range(120)]
    return rows + [(f"o{k:03d}", " ".join(f"o{k}x{i}" for i in range(60))) for k in range(240)]


def test_unedited_letters_of_a_hot_drive_meet_edited_ones(spark):
    rows = drive_and_others(lambda k: k % 2 * 5)
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got == brute(rows)


def test_letters_of_a_hot_drive_with_own_paragraphs_meet(spark):
    rows = drive_and_others(lambda k: (0, 5, 24, 30, 40)[k % 5])
    want = brute(rows)
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got <= want and len(got) >= 0.999 * len(want)


def test_a_drive_above_a_twentieth_with_long_own_parts_is_found_whole(spark):
    """8 % of the records share a letter of 110 words and have 32 own words each."""
    base = " ".join(f"w{i}" for i in range(110))
    rows = [(f"d{k:03d}", " ".join([base, *(f"own{k}x{i}" for i in range(32))])) for k in range(120)]
    rows += [(f"o{k:04d}", " ".join(f"o{k}x{i}" for i in range(40))) for k in range(1380)]
    want = set(combinations([i for i, _ in rows[:120]], 2))
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_copies_of_a_third_of_all_rows_pair_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "HOT", 7)
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(f"c{k:02d}", text) for k in range(30)] + [(f"o{k}", f"{k} " * 3 + " ".join(f"o{k}x{i}" for i in range(40))) for k in range(60)]
    got = [(r.id_a, r.id_b) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "id string, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == set(combinations([f"c{k:02d}" for k in range(30)], 2))


def test_folding_never_adds_differences():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        pool = rnd.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.unique(pool[:200]), np.unique(pool[rnd.integers(0, 150) :])
        x, y = near_duplicates.sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        differ = len(np.setxor1d(a, b))
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= differ
        # pairs within the budget always pass the ring
        assert near_duplicates.ring_passes(x[:, None], y[:, None], np.array([float(differ)]))[0]


def test_words_hash_alike_however_they_are_written():
    (_, h, b), = hashing.word_hashes(["Red CAFÉ, n_1x–Ž", "red café n 1X ž", None, "", "ΟΔΟΣ οδος", "red"])
    rows = [h[i:j].tolist() for i, j in zip(b[:-1], b[1:])]
    assert rows[0] == rows[1] and len(rows[0]) == 5 and rows[2] == rows[3] == [] and rows[4][0] == rows[4][1] and rows[5] == rows[0][:1]
    (_, h, b), = hashing.word_hashes(["page 12 of 3x45", "page 7 of 0x9"], fold_digits=True)
    assert h[: b[1]].tolist() == h[b[1] :].tolist()
    long = " ".join(f"word{i}" for i in range(60_000))
    got = list(hashing.word_hashes(["a b", long, "a b"]))
    assert len(got) == 3 and len(got[1][1]) == 60_000 == len(set(got[1][1].tolist())) and got[0][1].tolist() == got[2][1].tolist()


def test_shingles_against_brute_force():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 40, 200)]
    (_, h, b), = hashing.word_hashes(texts)
    for size in (3, 5):
        x, cut = hashing.shingled(h, b, size)
        want = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if (w := t.split()) else set() for t in texts]
        assert np.diff(cut).tolist() == [len(s) for s in want]
        assert all((np.diff(x[i:j].astype(object)) > 0).all() for i, j in zip(cut[:-1], cut[1:]))


def test_nearest_in_time_against_brute_force(spark):
    rnd = random.Random(4)
    left = [(f"l{i}", rnd.choice(["hot"] * 5 + ["b", None]), rnd.randrange(-40, 500) if rnd.random() > 0.05 else None) for i in range(400)]
    right = [(i, rnd.choice(["hot", "b", None]), rnd.randrange(-40, 500) if rnd.random() > 0.05 else None) for i in range(120)]
    L = spark.createDataFrame([(*x, "clash") for x in left + left[:5]], "id string, entity string, day int, _at string")
    R = spark.createDataFrame([(*x, "clash") for x in right + right[:5]], "id bigint, entity string, day int, _k string")
    got = {r.left_id: r.right_id for r in nearest_time.nearest_in_time(L, R, 14, 21).collect()}
    want = {}
    for i, k, t in left:
        hits = [(abs(d - t), r) for r, e, d in right if k is not None and e == k and d is not None and t is not None and abs(d - t) <= 14]
        if hits:
            want[i] = min(hits)[1]
    assert got == want
    big = 2**53 + 1
    one = nearest_time.nearest_in_time(spark.createDataFrame([("a", "k", 5)], "id string, entity string, day int"), spark.createDataFrame([(big, "k", 7), (big - 1, "k", 30)], "id bigint, entity string, day int"))
    assert [tuple(r) for r in one.collect()] == [("a", big)]
    assert nearest_time.nearest_in_time(L.limit(0), R).count() == 0 and nearest_time.nearest_in_time(L, R.limit(0)).count() == 0


def test_addresses_are_read():
    p = addresses.parse
    assert p("2571–2577 tafuttano str., ground floor, port alder")[:4] == ("2571", "", "TAFUTTANO", "ST")
    assert p("Hodupquist Terrace, 2615, Port Alder")[:4] == ("2615", "", "HODUPQUIST", "TER")
    assert p("NO. 1488 KAMOLPONT COURT")[:4] == ("1488", "", "KAMOLPONT", "CT")
    assert p("3654 NO. ZOSHISFIELD ST.")[:4] == ("3654", "N", "ZOSHISFIELD", "ST")
    assert p("1093 Tenth Street")[:4] == p("1093 10TH ST, P.A.")[:4] == ("1093", "", "10", "ST")
    assert p("3285 Foselley Wy 0016")[:4] == ("3285", "", "FOSELLEY", "WAY") and p("3285 Foselley Wy 0016")[4] == "0016"
    assert p("1321 D Gindofdgrim Ct., Apt 5")[:4] == ("1321", "", "GINDOFDGRIM", "CT")
    assert p(None) is None and p("  ") is None and p("Oak Street") is None and p("the corner by the plaza") is None
    assert addresses.damerau("abcd", "acbd") == 1 and addresses.assignment_cost(["oak", "hill"], ["hill", "oka"]) == 1


def test_same_places(spark):
    rows = ["12 Oakfield Street", "12 OAKFIELD ST, PORT ALDER CA 99001", "12-18 Oakfeild St.", "Oakfield Street 12", "12 Oakfield", "14 Oakfield Street", "12 Oakfield Avenue", "12 South Oakfield Street", "9 Elmgate Ct #4", "9 Elmgate Court #5", None, " ", "12 Oakfield Street"]
    df = spark.createDataFrame([(r, 1) for r in rows], "address string, place int")
    got = {(r.address_a, r.address_b) for r in addresses.same_places(df, unit_veto=False).collect()}
    same = {"12 Oakfield Street", "12 OAKFIELD ST, PORT ALDER CA 99001", "12-18 Oakfeild St.", "Oakfield Street 12"}
    assert {tuple(sorted(x)) for x in combinations(same, 2)} <= got
    assert ("9 Elmgate Court #5", "9 Elmgate Ct #4") in got
    assert not any({"14 Oakfield Street", "12 Oakfield Avenue", "12 South Oakfield Street"} & set(x) for x in got - {("12 Oakfield", "12 Oakfield Avenue")})
    strict = {(r.address_a, r.address_b) for r in addresses.same_places(df, unit_veto=True).collect()}
    assert ("9 Elmgate Court #5", "9 Elmgate Ct #4") not in strict
    assert addresses.same_places(df.limit(0)).count() == 0


def test_long_street_names_and_chains_of_spellings(spark):
    long = ["12 Avenue of the Great Old Oaks", "12 AVENUE OF THE GRAET OLD OAKS", "12 Avenue Of The Great Old Oaks, Port Alder", "12 Great Old Oaks"]
    seen = [f"{n} Marlowgate Street" for n in range(1, 30)]
    chain = ["77 Marlowgate Street", "77 Marlowgat St", "77 Malowgat St.", "77 Malowga Street"]
    rows = [(x,) for x in long + seen + chain]
    got = {(r.address_a, r.address_b) for r in addresses.same_places(spark.createDataFrame(rows, "address string"), unit_veto=False).collect()}
    assert {tuple(sorted(x)) for x in combinations(long[:3], 2)} <= got and not any("12 Great Old Oaks" in x for x in got)
    assert {tuple(sorted(x)) for x in combinations(chain[:3], 2)} <= got and not any(set(x) & set(seen) for x in got)
    assert addresses.assignment_cost([f"t{i}" for i in range(30)], [f"t{i}" for i in range(29, -1, -1)]) == 0


def test_persons(spark):
    rows = [("p1", n) for n in ["Robert Zandelby", "Bob Zandelby", "Zandelby, R.", "ROBERT ZANDELBY", "Robert Q. Zandelby", "Robrt Zandelby", "RobertZandelby", "Maria Zandelby", "Róbert Zandelby", None, " ", "Solo"]]
    rows += [("p2", "Robert Zandelbi"), ("p3", "Ann Kirlund"), ("p3", "Abe Kirlund"), ("p3", "A. Kirlund"), (None, "Bob Zandelby")]
    nick = spark.createDataFrame([("Robert", "Bob"), (None, "x")], "formal string, nick string")
    df = spark.createDataFrame([(*r, "clash") for r in rows * 2], "project string, name string, forms string").select("project", "name")
    got = {(r.name_a, r.name_b) for r in names.link_persons(df, nick).collect()}
    same = ["Robert Zandelby", "Bob Zandelby", "Zandelby, R.", "ROBERT ZANDELBY", "Robert Q. Zandelby", "Robrt Zandelby", "RobertZandelby", "Róbert Zandelby"]
    assert got == {tuple(sorted(x)) for x in combinations(same, 2)}
    assert names.link_persons(df.limit(0), nick).count() == 0


def test_token_order_and_long_names(spark):
    firsts = [("q", f"Robert {w}field") for w in ("Ash", "Birch", "Cedar", "Dell", "Elm")]
    long = "Maria del Carmen de la Vega Zandelby"
    rows = firsts + [("p1", n) for n in ["Robert Zandelby", "Zandelby Robert", "James Thomas", "Thomas James", long, long.upper()]]
    nick = spark.createDataFrame([("Robert", "Bob")], "formal string, nick string")
    got = {(r.name_a, r.name_b) for r in names.link_persons(spark.createDataFrame(rows, "project string, name string"), nick).collect()}
    assert got == {("Robert Zandelby", "Zandelby Robert"), tuple(sorted((long, long.upper())))}


def test_initials_are_scored_by_the_persons_that_share_them(spark):
    rows = [("p1", n) for n in ("Ann Kirlund", "Ann B. Kirlund", "A. Kirlund")] + [("p2", n) for n in ("Ann Kirlund", "Abe Kirlund", "A. Kirlund")]
    nick = spark.createDataFrame([("Robert", "Bob")], "formal string, nick string")
    one = {(r.name_a, r.name_b) for r in names.link_persons(spark.createDataFrame(rows[:3], "project string, name string"), nick).collect()}
    two = {(r.name_a, r.name_b) for r in names.link_persons(spark.createDataFrame(rows[3:], "project string, name string"), nick).collect()}
    assert one == {tuple(sorted(x)) for x in combinations([n for _, n in rows[:3]], 2)} and two == set()


def test_kin_stay_apart_however_many_other_spellings_there_are(spark):
    nick = spark.createDataFrame([("Robert", "Bob")], "formal string, nick string")
    kin = [("p0", "Darlen Kirlund"), ("p0", "Darlon Kirlund")] + [(f"q{i}", f"{n} Ash{i}") for i in range(4) for n in ("Darlen", "Darlon")]
    few = spark.createDataFrame(kin, "project string, name string")
    rest = spark.range(120_000).select(F.concat(F.lit("r"), "id").alias("project"), F.concat(F.lit("Bo "), F.lower(F.conv("id", 10, 36))).alias("name"))
    one, two = ({(r.name_a, r.name_b) for r in names.link_persons(df, nick).collect()} for df in (few, few.unionByName(rest)))
    assert one == two == set()


def test_typing_errors_stay_errors_where_they_recur(spark):
    nick = spark.createDataFrame([("Robert", "Bob")], "formal string, nick string")
    rows = [("p0", "Mehhmet Kirlund"), ("p0", "Mehmmet Kirlund"), ("p1", "Oga Kirlund"), ("p1", "Olga Kirlund"), ("p2", "Olgga Kirlund"), ("p2", "Kirlund Olga")]
    rows += [(f"q{n}{i}", f"{n} Ash{i}") for n, k in (("Mehmet", 200), ("Olga", 200), ("Mehhmet", 5), ("Mehmmet", 5), ("Oga", 5), ("Kirlund", 5)) for i in range(k)]
    got = {(r.name_a, r.name_b) for r in names.link_persons(spark.createDataFrame(rows, "project string, name string"), nick).collect()}
    assert got == {("Mehhmet Kirlund", "Mehmmet Kirlund"), ("Oga Kirlund", "Olga Kirlund"), ("Kirlund Olga", "Olgga Kirlund")}


def test_chains_of_organisations_end_at_one_body(spark):
    kind = "Neighbors Association"
    rows = [(f"{n} {kind}",) for n, k in (("Abcdefgh", 9), ("Abcdefghij", 7), ("Abcdefghijkl", 5), ("Abcdefghijklmn", 3), ("Abcdefghijklmnop", 1)) for _ in range(k)]
    rows += [(f"The {r[0]}",) for r in rows]
    got = {(r.name_a, r.name_b) for r in names.link_organisations(spark.createDataFrame(rows, "name string")).collect()}
    assert got == {tuple(sorted((a, f"The {a}"))) for a, in set(rows) if not a.startswith("The")}
    near = [(f"{n} {kind}",) for n, k in (("Abcdefgh", 9), ("Abcdefghi", 7), ("Abcdefghij", 5), ("Abcdefghijk", 3), ("Abcdefghijkl", 1)) for _ in range(k)]
    got = {(r.name_a, r.name_b) for r in names.link_organisations(spark.createDataFrame(near, "name string")).collect()}
    assert got == {tuple(sorted(x)) for x in combinations({n for n, in near}, 2)}


def test_organisations(spark):
    rows = ["Oakfield Hill Neighbors Association", "Oakfield Hl Neighbors Ass'n", "Neighbors Assn of Oakfield Hill", "The Oakfeild Hill Neighbors Association, Inc.", "OAKFIELD HILL NEIGHBORS ASSOCIATION (OHNA)", "Oakfield Hill Merchants Association", "Oakfield Valley Neighbors Association", None, ""]
    got = {(r.name_a, r.name_b) for r in names.link_organisations(spark.createDataFrame([(r,) for r in rows], "name string")).collect()}
    assert got == {tuple(sorted(x)) for x in combinations(rows[:5], 2)}


def test_organisations_without_type_words_or_proper_part():
    o = names.organisation
    assert o("Spur") == o("SPUR, Inc.") == ("", "spur") and o("Mission Bay Alliance") == o("MISSION BAY ALLIANCE, Inc.") is not None
    assert o("Inc.") is not None and o("Spur") != o("Spur Association") and o(None) is o(" ") is o("--") is None
