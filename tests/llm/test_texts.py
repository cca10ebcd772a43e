"""Tokens, containers, personal information, scanned pages and residue."""

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthline.llm import packing, personal, residue, scanned, tokens

KEY = b"k" * 32


@pytest.fixture(scope="module")
def codec():
    return tokens.codec(tokens.default_vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_tokens_round_trip_and_agree_with_the_library(codec, text):
    import public_tokenizers
    from tokenizers import Tokenizer

    text = text.encode("utf-8", "ignore").decode()
    ids = codec.encode(text)
    assert codec.decode(ids) == text
    lib = test_tokens_round_trip_and_agree_with_the_library.__dict__.setdefault("lib", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    lib.encode_special_tokens = True
    assert ids == lib.encode(text, add_special_tokens=False).ids


def test_tokens_edges(spark, codec):
    long = "аб" * 30_000 + " x" * 5
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "<|endoftext|>"), (5, long), (5, long)]
    got = tokens.encode_ids(spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, ids int")).collect()
    by = {r.doc_id: r.ids for r in got}
    assert len(got) == 6 and by[1] == by[2] == [] and codec.decode(by[3]) == " \n\t" and 50256 not in by[4] and codec.decode(by[5]) == long
    assert {r.doc_id: r.size for r in tokens.token_sizes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {k: len(v) for k, v in by.items()}


def check_plan(histogram, capacity):
    plan = packing.solve(histogram, capacity)
    filled = {}
    for times, filling in plan:
        assert sum(s * k for s, k in filling.items()) <= capacity
        for s, k in filling.items():
            filled[s] = filled.get(s, 0) + times * k
    assert filled == {s: n for s, n in histogram.items() if 0 < s <= capacity}
    return sum(t for t, _ in plan)


def test_plans_are_whole_and_tight():
    rnd = random.Random(7)
    for n in (0, 1, 40, 3000):
        h = {}
        for _ in range(n):
            s = min(512, int(rnd.lognormvariate(4, 1)) + 1)
            h[s] = h.get(s, 0) + 1
        used = check_plan(h, 512)
        least = -(-sum(s * k for s, k in h.items()) // 512)
        assert used <= max(least * 1.02 + 2, 0)


def test_containers(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([0, 1, 17, 300, 999, 2048, 5000])) for i in range(500)] + [(1000, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, size int, container string")
    out = packing.fill_containers(df).collect()
    total, per, pieces = {}, {}, {}
    for r in out:
        total[r.container] = total.get(r.container, 0) + r.size
        per[r.doc_id] = per.get(r.doc_id, 0) + r.size
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + 1
    assert max(total.values()) <= 2048 and per == {i: n or 0 for i, n in rows}
    assert all(pieces[i] == max(1, -(-(n or 0) // 2048)) for i, n in rows)
    assert packing.fill_containers(df.limit(0)).count() == 0


def test_many_lengths_are_filled_as_well_as_few():
    rnd = random.Random(3)
    h = {}
    for _ in range(3000):
        s = min(512, int(rnd.lognormvariate(5, 1)) + 1)
        h[s] = h.get(s, 0) + 1
    assert len(h) > 400 and check_plan(h, 512) == -(-sum(s * k for s, k in h.items()) // 512)
    assert check_plan({682: 1000, 683: 1000, 684: 1000}, 2048) == 1125


def test_containers_do_not_depend_on_how_ranks_are_counted(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 * 100).cast("int").alias("size"))
    got = []
    for salts in (64, 5):
        monkeypatch.setattr(packing, "SALTS", salts)
        got.append({(r.doc_id, r.piece): r.container for r in packing.fill_containers(df).collect()})
    assert len(got[0]) == 3000 and got[0] == got[1]


@settings(max_examples=200, deadline=None)
@given(st.text("0123456789", min_size=1, max_size=16), st.sampled_from(["phone", "identity"]))
def test_feistel_is_a_permutation_of_its_format(digits, tweak):
    moved = personal.feistel(digits, KEY, tweak)
    assert len(moved) == len(digits) and moved.isdigit() and personal.unfeistel(moved, KEY, tweak) == digits


def test_feistel_has_no_collisions_and_dates_stay_dates():
    assert len({personal.feistel(f"{i:04d}", KEY, "x") for i in range(10_000)}) == 10_000
    moved = {personal.permute_date(f"{m}/{d}/1980", KEY) for m in range(1, 13) for d in range(1, 29)}
    assert len(moved) == 336 and all(re.fullmatch(r"\d{1,2}/\d{1,2}/19\d\d", x) for x in moved)


CASES = [
    ("call 628 – 555 – 0146 or +1 (209) 555-0154 today", [("phone", "628 – 555 – 0146"), ("phone", "1 (209) 555-0154")]),
    ("write to a.b+c@mail.example or kim at hill-neighbors dot example.", [("email", "a.b+c@mail.example"), ("email", "kim at hill-neighbors dot example")]),
    ("my SSN 963-22-9716, passport no. ZK89137240, DL N1456375", [("identity", "963-22-9716"), ("identity", "ZK89137240"), ("identity", "N1456375")]),
    ("lives at 646 PAVAPFIELD AVE.; no", [("address", "646 PAVAPFIELD AVE.")]),
    ("Our house is number 588 POPEBBERG since", [("address", "588 POPEBBERG")]),
    ("I write about Drifumdahl Ct 2516 before", [("address", "Drifumdahl Ct 2516")]),
    ("read a letter from Dr. Henry Fatodsen", [("name", "Henry Fatodsen")]),
    ("It is too tall.\n\nRegards,\nLefebescu, Emeka\n2959 Hakumhauser St", [("name", "Lefebescu, Emeka"), ("address", "2959 Hakumhauser St")]),
    ("It is fine. Thank you,, Jeffrey, 2959 Hakumhauser St, Port Alder", [("name", "Jeffrey"), ("address", "2959 Hakumhauser St")]),
    ("Everyone on Bondapmoor Street agrees. Case 2019-008305 was similar; Motion 9889-010; BPA 2009.0306.0916; Resolution No. 8946606", []),
    ("Meet @ Hakimvale Road and the plaza at 5:30. [phone removed] Count them: 4415 cars", []),
    ("The Oakfield Slope Community Council has not taken a vote on www.a.example/packets/20150422", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_mentions(text, want):
    got = [(k, text[s:e]) for s, e, k in personal.Finder().find(text)]
    assert [(k, v.rstrip(".")) for k, v in got] == [(k, v.rstrip(".")) for k, v in want]


def test_labels_and_validity_of_numbers():
    find = lambda t: [(k, t[s:e]) for s, e, k in personal.Finder().find(t)]
    assert find("My EIN: 123456789 and TIN# 987654321; EIN 223456789") == [("identity", "123456789"), ("identity", "987654321"), ("identity", "223456789")]
    assert find("SSN 000-12-3456, 666-12-3456, 123-00-4567, 123-45-0000, SSN 219-09-9999") == [("identity", "219-09-9999")]
    assert find("call 155-555-0155 or 415-155-0155 or 415-555-0155") == [("phone", "415-555-0155")]
    for text in ("My EIN: 123456789", "social security card 219-09-9999 here", "driver’s license N1456375", "CDL no. N1456375", "licence B1456375"):
        assert personal.LABEL_HINT.search(text) and len(find(text)) == 1


def test_names_in_running_text_and_on_long_lines():
    finder = personal.Finder(frozenset(["jane", "robert"]))
    text = "Jane Doe told the commission that Robert Q. Smith objects; Jane Doe Park and Robert Street stay. Mission Bay too."
    assert [text[s:e] for s, e, k in finder.find(text) if k == "name"] == ["Jane Doe", "Robert Q. Smith"]
    long = "Wolfeschlegelsteinhausenbergerdorff-Hohenzollern Vonundzuschwarzenbergundsigmaringen"
    body = f"It is fine.\n\n{long}\nOne\nTwo\nThree\n2959 Hakumhauser St"
    assert [body[s:e] for s, e, _ in finder.find(body)][:1] == [long] and any(k == "address" for _, _, k in finder.find(body))


def test_codes_don_t_collide_and_values_stay_linked(spark):
    assert len({personal.pseudonym("email", f"a{i}@mail.example", KEY) for i in range(200_000)}) == 200_000
    rows = [("c1", "call 415-555-0155", "call 415.555.0155 or (415) 555-0156"), ("c2", None, "SSN 219-09-9999; mail x@mail.example, X@mail.example")]
    got = {r.kind: (r.n_values, r.n_pseudonyms, r.n_restored) for r in personal.linked_values(spark.createDataFrame(rows, "comment_id string, comment string, text string"), "s").collect()}
    assert got == {"phone": (2, 2, 2), "identity": (1, 1, 1), "email": (1, 1, 0)}


def test_mentions_and_redaction_of_a_table(spark):
    rows = [("c1", "call 555-0155 now", "call 555-0155 now"), ("c2", None, "again 555-0155, born 3/4/1980"), ("c3", None, None), ("c4", "", "  "), ("c1", "call 555-0155 now", "call 555-0155 now"), ("c5", None, "x " * 50_000 + "555-0155")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "comment_id string, comment string, text string, both string").drop("both")
    got = {(r.comment_id, r.field_name, r.kind, r.start_pos) for r in personal.find_mentions(df).collect()}
    assert got == {("c1", "comment", "phone", 5), ("c1", "text", "phone", 5), ("c2", "text", "phone", 6), ("c5", "text", "phone", 100_000)}
    out = {r.comment_id: r for r in personal.redact_comments(df, "secret").collect()}
    first, second = (re.search(r"\[phone (\d{3}-\d{4})\]", t)[1] for t in (out["c1"].text, out["c2"].text))
    assert first == second != "555-0155" and "3/4/1980" not in out["c2"].text and out["c1"].text.startswith("call [phone") and out["c3"].text is None
    assert not personal.Finder().find(out["c1"].text)
    assert personal.find_mentions(df.limit(0)).count() == 0


def test_scans(spark):
    clean = "The environmental document concludes that potential impacts are mitigated within the building. A full-service restaurant opens on the ground floor."
    noisy = "The environmental docu-\nPage 3 of 9\nPort Alder Planning Commission\n\nment conclucles that p0tential impacts are mitigated withm the bui¬\nlding. A full-\nservice restaurant opens on the ground floor."
    rows = [(i, "item_text", clean) for i in range(40)] + [(100, "item_text", noisy), (101, "item_text", None), (102, "speakers", ""), (103, "item_text", "on page\n12 of the plan for\npage 9.")]
    out = {r.id: r for r in scanned.repair_scans(spark.createDataFrame([(*r, 1) for r in rows + rows[-4:]], "id bigint, field_name string, text string, noises int")).collect()}
    assert out[100].noises == ["header", "hyphen", "misread", "page_no"]
    assert out[100].repaired == clean
    assert out[0].noises == [] and out[102].noises == [] and 101 not in out and out[103].noises == []
    assert scanned.repair_scans(spark.createDataFrame([], "id bigint, field_name string, text string")).count() == 0


@pytest.mark.parametrize(
    "text, label",
    [
        (None, None),
        ("  ", None),
        ("Dear {{first name}},\nI support it.", "placeholder"),
        ("Dear [insert date here],", "placeholder"),
        ("Dear {salutation_line},", "placeholder"),
        ("Regards,\n«your_name»", "placeholder"),
        ("They call it «the wall» and Type something meaningful in this box later.", "filler"),
        ("They call it «the wall» and want it gone.", None),
        ("Dear [Recipient Full Name],", "placeholder"),
        ("Use set {A, B} of <A-43> [sic] [name withheld] [no address] [see Exhibit B] and the figure is 100% wrong", None),
        ("404 Not Found\n\nnginx/1.502", "error_page"),
        ("When I opened the link it said page not found, so I read a paper copy of the whole packet instead and wrote this letter.", None),
        ("Please enable JavaScript to view this page. (code 81)", "script_notice"),
        ("The web form kept telling me to enable JavaScript and I gave up and wrote this letter about the tower.", None),
        ("Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor.", "filler"),
        ("The posted notice had lorem ipsum where the hearing time should be.", None),
    ],
)
def test_residue_labels(text, label):
    assert residue.label_of(text)[0] == label


def test_residue_spreads_to_near_copies_only(spark):
    notice = "Please enable JavaScript to view this page. " + "Supported browsers are listed here. " * 2
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(1, notice), (2, notice.upper()), (3, None), (4, ""), (5, body), (6, body + " {{name}}"), (1, notice), (7, "x " * 40_000)]
    got = {(r.doc_id, r.residue) for r in residue.find_residue(spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, label int")).collect()}
    assert got == {(1, "script_notice"), (2, "script_notice"), (6, "placeholder")}
    assert residue.find_residue(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def shingles_of(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def spread_from(spark, monkeypatch, rows, trusted):
    """The documents labelled when only those in ``trusted`` are trusted."""
    real = residue._examine

    def examine(dummy):
        def run(batches):
            for b in real(dummy)(batches):
                known = [i in trusted for i in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(["filler" if k else None for k in known], pa.string()), pa.array(known), *b.columns[3:]], b.schema.names)

        return run

    monkeypatch.setattr(residue, "_examine", examine)
    return {r.doc_id for r in residue.find_residue(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_residue_spreads_at_the_stated_similarity_through_chains(spark, monkeypatch):
    """With production settings, every page linked to a labelled one by similarities of 0.8 or more is found, and no other."""
    rnd = random.Random(5)

    def word():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))

    rows, want = [], set()
    for g in range(20):
        base = [word() for _ in range(60)]
        rows.append((g * 10, " ".join(base)))
        for k, places in enumerate(([30], [0], [10, 11], [5, 25, 45]), 1):  # the last one is below 0.8
            rows.append((g * 10 + k, " ".join([word() if i in places else w for i, w in enumerate(base)])))
        chain = list(base)
        for k in (5, 6, 7):  # each is near the one before, the last is far from the first
            chain = [word() if i // 2 == k * 3 else w for i, w in enumerate(chain)]
            rows.append((g * 10 + k, " ".join(chain)))
    sets = {i: shingles_of(t.split()) for i, t in rows}
    for g in range(20):
        group, got = [i for i, _ in rows if i // 10 == g], {g * 10}
        while more := {i for i in group for j in got if i not in got and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}:
            got |= more
        want |= got
    assert len(want) > 100 and spread_from(spark, monkeypatch, rows, {g * 10 for g in range(20)}) == want


def test_simhash_tables_find_what_is_within_three_bits(spark):
    hashes = [0, 7, 1 << 63, 15, -1, (1 << 40) - 1]
    df = spark.createDataFrame([(h - (1 << 64) if h >= 1 << 63 else h,) for h in hashes], "simhash bigint")
    met = residue._tables(df).alias("a").join(residue._tables(df).alias("b"), "key").select(F.col("a.simhash").alias("x"), F.col("b.simhash").alias("y")).distinct().collect()
    assert {(0, 7), (7, 15), (0, -(1 << 63))} <= {(r.x, r.y) for r in met}


def test_words_and_wording_are_learned_from_the_corpus(spark):
    dummy = ["Lorem ipsum plonk dolor vrang sit quelm.", "Ipsum lorem vrang amet quelm plonk.", "Dolor lorem plonk quelm vrang plonk."]
    rows = [(i, t) for i, t in enumerate(dummy)] + [(10, "Dear all,\nplonk vrang quelm quelm plonk vrang plonk quelm.\nKind regards")]
    rows += [(20 + i, f"404 Not Found\nGo back to the start page.{' Now.' if i else ''}") for i in range(4)]
    rows += [(30, "500 internal server error\nThe upstream relay gave no answer in time today."), (31, "Go back to the start page. 404 not found. Ask the desk clerk upstairs for a printed list of rooms."), (33, "Look around in our big hall. 404 not found. Ask the desk clerk upstairs for a printed list of rooms."), (32, "The form said 404 not found. I walked there and every neighbour of the whole street is against this tower.")]
    rows += [(40 + i, "The tower is too tall and we are against it, plonk.") for i in range(6)]
    rows += [(50 + i, f"The posted card had lorem ipsum on it where we wanted the hour of the tower hearing {i}.") for i in range(5)]
    rows += [(60, "Posted card hour wanted hearing posted card hour wanted hearing."), *((70 + i, "The hour of the tower on it, where we had the card.") for i in range(40))]
    got = {r.doc_id: r.residue for r in residue.find_residue(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i for i, x in got.items() if x == "filler"} == {0, 1, 2, 10}
    assert {i for i, x in got.items() if x == "error_page"} == {20, 21, 22, 23, 30, 31}


def test_long_error_pages_and_notices_are_labelled():
    trace = "500 Internal Server Error\n" + "at app.views.Handler(Handler.java:42)\n" * 100
    notice = "Please enable JavaScript to view this page. " + "Menu Search Home Hearings Contact Site map\n" * 100
    letter = "The page said 404 not found. " + "I walked the whole street and every neighbour is against the tower. " * 40
    assert [residue.label_of(t) for t in (trace, notice, letter)] == [("error_page", True), ("script_notice", True), (None, False)]


@pytest.mark.parametrize(
    "text",
    ["HTTP Error 503", "http status code 404", "502 Bad Gateway", "504 gateway time-out", "410 Gone", "Service is currently unavailable", "Server Error in '/x' Application", "database error", "Invalid viewstate", "your session has timed out",
     "Access is denied", "connection timedout", "the file you requested cannot be found", "Unhandled Exception", "Página no encontrada", "enable JavaScript", "Activar scripts", "java script must be enabled", "noscript", "unsupported browser", "scripting is blocked", "Scripts are turned off", "Cookies and scripting must be allowed"],
)
def test_every_sign_has_its_hint(text):
    assert residue.signs_in(text.lower()) and residue.label_of(text)[0] in ("error_page", "script_notice")
