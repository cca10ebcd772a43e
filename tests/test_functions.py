import pytest
from pyspark.sql import functions as F

from hearthline.functions import records as R
from hearthline.functions import text as X
from hearthline.functions.printed import case_number, printed_date
from hearthline.functions.rules import cascade, flag, lookup


def values(spark, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, c string").orderBy("i").select(*cols).collect()]


def test_printed_dates(spark):
    got = values(spark, ["2024-03-05", "20240305", "3/5/2024", "March 5, 2024", " 2024-03-05 ", "5th March", "", None, "2024-13-05", "13/1/2024"], printed_date(F.col("c")).cast("string"))
    assert [g[0] for g in got] == ["2024-03-05"] * 5 + [None] * 5


def test_case_numbers(spark):
    got = values(spark, ["2015-009140CUA", "Case 2001-000007", "No. 98.1030C", " 2003.0155 ", "none", None], case_number(F.col("c")))
    assert [g[0] for g in got] == ["2015-009140", "2001-000007", "1998.1030", "2003.0155", None, None]


def test_record_type_and_parent(spark):
    rows = ["2015-009140DRP", "97.669C", "2005.0999E", "2010.0001DD", "2019-012345", "2015-009140CUA-02", "2015-009140CUA", None]
    got = values(spark, rows, R.record_type(F.col("c")), R.record_parent(F.col("c")))
    assert got == [("DRP", "2015-009140"), ("CUA", "1997.669"), ("ENV", "2005.0999"), ("DRM", "2010.0001"), ("", "2019-012345"), ("", "2015-009140"), ("CUA", "2015-009140"), ("", "")]


@pytest.mark.parametrize(
    "printed, normal",
    [
        ("2743 - 2761 Geary Boulevard, SF", "2743 GEARY BLVD"),
        ("190 07TH ST 0001", "190 07TH ST"),
        ("1269 B Lombard Street", "1269 LOMBARD ST"),
        ("10 5th Ave", "10 05TH AVE"),
        ("22 Third Street", "22 03RD ST"),
        ("", ""),
        (None, ""),
    ],
)
def test_norm_address(spark, printed, normal):
    assert values(spark, [printed], R.norm_address(F.col("c")))[0][0] == normal


def test_rules_keep_order_and_nulls(spark):
    rules = [("a", "first"), ("ab", "second")]
    got = values(spark, ["xaby", "AB", "b", None], cascade(F.col("c"), rules, "rest"), cascade(F.col("c"), rules, None, anchor="full"), flag(F.col("c"), "É"), lookup(F.col("c"), {"b": "B"}, F.col("c")))
    assert got == [("first", None, 0, "xaby"), ("first", "second", 0, "AB"), ("rest", None, 0, "B"), (None, None, 0, None)]


def test_text_normalising(spark):
    page = "ﬁrst “quote”\r\nPage 2 of 9\nLast updated: today\nPort Alder Planning Commission Thursday, May 3, 2001\nend   \n\n\n\nnext????\x0c"
    got = values(spark, [page, None], X.normal_text(F.col("c")))
    assert got[0][0].split() == ["first", '"quote"', "end", "next"] and got[1][0] is None


def test_scrub_title_html_clock(spark):
    got = values(spark, ["call 415-555-1234 or a.b@x.example.com."], X.scrub_contacts(F.col("c")))
    assert got[0][0] == "call [phone removed] or [email removed]."
    assert values(spark, ["o'neil mc-donald 07th"], X.title_case(F.col("c")))[0][0] == "O'Neil Mc-Donald 07Th"
    assert values(spark, ["<p>a &amp; b</p><script>x<1</script><b>c</b>", None], X.html_text(F.col("c"))) == [("a & b\nc",), (None,)]
    assert [v[0] for v in values(spark, ["at 1:05 P.M.", "12:30 am", "noon", None], X.clock(F.col("c")))] == ["13:05", "00:30", "", ""]
    assert values(spark, ["https://h.example/a/Min%20utes(1)"], X.local_name(F.col("c"), F.lit("html")))[0][0] == "Min_utes_1_.html"
