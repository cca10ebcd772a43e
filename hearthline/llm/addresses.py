"""Same postal address written differently.

Every distinct string is parsed into house number (of a range, the first), compass word, street tokens, street type, unit,
locality and postcode. Strings with equal components form one "form". A deletion-neighbourhood index over the street
tokens (each token and what is left of it without one or two of its letters; a name of several tokens also as one word,
as blanks come and go) is kept inside blocks of one house number, so a typo meets its street without comparing all
names, and different numbers never meet: the number is a hard veto. With ``unit_veto=True`` different units are one too.
A candidate pair is scored by the optimal assignment of its components: tokens are matched one to one at least Damerau
cost, type and compass must agree or be missing.

A form then resolves to the best attested form it is compatible with: the one whose street name occurs with the most
house numbers. Two names that are both well attested are different streets even if they differ by one letter. A form
without a street type joins a typed one only if the block has just one such type for its street. Resolutions are
followed to their end, through connected components.

The blocks are house numbers instead of postcodes and neighbouring localities: many prints have neither postcode nor
city, TESTDATA lets neither count, and the number must agree anyway. No pair of strings is formed outside a resolved
place, and a place of very many strings is paired in blocks.

Defined results: null, blank and unparseable strings (no number or no street) match nothing; repeated strings count
once; an empty table gives an empty result; of equally good resolutions the better attested, then the smaller, wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.operators.relational import components, pairs_within
from hearthline.session import written

#: Street types and their abbreviations.
TYPES = {
    "STREET": "ST", "STR": "ST", "ST": "ST", "AVENUE": "AVE", "AVE": "AVE", "AV": "AVE", "BOULEVARD": "BLVD", "BLVD": "BLVD", "BL": "BLVD", "COURT": "CT", "CT": "CT", "CRT": "CT",
    "DRIVE": "DR", "DR": "DR", "DRV": "DR", "LANE": "LN", "LN": "LN", "PLACE": "PL", "PL": "PL", "ROAD": "RD", "RD": "RD", "TERRACE": "TER", "TERR": "TER", "TER": "TER", "WAY": "WAY", "WY": "WAY",
    "PLAZA": "PLZ", "PLZ": "PLZ", "ALLEY": "ALY", "ALY": "ALY", "CIRCLE": "CIR", "CIR": "CIR", "HIGHWAY": "HWY", "HWY": "HWY", "PARKWAY": "PKWY", "PKWY": "PKWY", "SQUARE": "SQ", "SQ": "SQ",
}
COMPASS = {"NORTH": "N", "NO": "N", "N": "N", "SOUTH": "S", "SO": "S", "S": "S", "EAST": "E", "E": "E", "WEST": "W", "W": "W"}
ORDINALS = {w: f"{i + 1}" for i, w in enumerate("FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH EIGHTH NINTH TENTH ELEVENTH TWELFTH THIRTEENTH FOURTEENTH FIFTEENTH SIXTEENTH SEVENTEENTH EIGHTEENTH NINETEENTH TWENTIETH".split())}
UNIT = re.compile(r"(?:#\s*\w+|\b(?:APT|APARTMENT|UNIT|SUITE|STE|ROOM|RM)\b\.?\s*#?\s*\w*|\b(?:GROUND|FIRST|SECOND|THIRD|TOP|\d+(?:ST|ND|RD|TH)) FLOOR\b|\bFLOOR \d+\b|\bREAR(?: BUILDING)?\b|\bBASEMENT\b|\bPENTHOUSE\b)")
CITY = re.compile(r"\bPORT ALDER\b|\bP\.\s*A\.?(?=$|[\s,])")
#: A name that occurs with this many house numbers, and with at least this share of its rival's, is a street of its own.
ATTESTED, RIVAL_SHARE = 4, 0.12


def parse(text: str | None) -> tuple[str, str, str, str, str, str] | None:
    """(number, compass, name, type, unit, postcode) or None. A compass of "E?" may also be a unit letter."""
    if not text:
        return None
    s = re.sub(r"[–—−]", "-", text.upper())
    s = re.sub(r"\s+", " ", s).strip()
    postcode = m[1] if (m := re.search(r"\b(\d{5})(?:-\d{4})?\s*$", s)) else ""
    if postcode and re.search(r"[A-Z]", s[: m.start()]) and re.match(r"\D*\d", s[: m.start()] + " "):
        s = s[: m.start()].strip(" ,")
    else:
        postcode = ""
    s = re.sub(r",?\s*\bCA(?:LIF(?:ORNIA)?)?\b\.?\s*$", "", s)
    s = CITY.sub(" ", s)
    units = UNIT.findall(s)
    s = UNIT.sub(" ", s)
    s = re.sub(r"\b(?:NO|NUM|NUMBER)\b\.?\s*(?=\d)|\bNº\s*|№\s*", " ", s)
    s = re.sub(r"(\d)\s*-\s*(?=\d)", r"\1-", s)
    tokens = [t for t in re.findall(r"[\w'\-]+", s.replace(".", " ")) if t.strip("-'")]
    number = None
    for i, t in enumerate(tokens):  # the number stands first, or after the street; ordinals like 28TH are no numbers
        if re.fullmatch(r"\d+(?:-\d+)?[A-Z]?", t) and (i == 0 or not any(re.fullmatch(r"\d+(?:-\d+)?[A-Z]?", x) for x in tokens[:i])):
            number, at = t, i
            break
    if number is None:
        return None
    digits = re.match(r"\d+", number)[0].lstrip("0") or "0"
    unit = re.sub(r"^[\d\-]+", "", number)
    before, after = tokens[:at], tokens[at + 1 :]
    street = after if at == 0 else before
    if at == 0:
        while len(street) > 1 and re.fullmatch(r"\d+", street[-1]):  # a trailing unit in digits
            unit = unit or street.pop()
            street = street if not (street and street[-1] == unit) else street[:-1]
    if not street:
        return None
    compass = ""
    if len(street) > 1 and len(street[0]) == 1 and street[0].isalpha() and street[0] not in COMPASS:
        unit, street = street[0], street[1:]
    if len(street) > 1 and street[0] in COMPASS and street[1] not in TYPES:
        compass = COMPASS[street[0]] + ("?" if street[0] == "E" and "E." not in text.upper() else "")
        street = street[1:]
    kind = ""
    if len(street) > 1 and street[-1] in TYPES:
        kind, street = TYPES[street[-1]], street[:-1]
    name = []
    for t in street:
        if m := re.fullmatch(r"0*(\d+)(?:ST|ND|RD|TH)", t):
            t = m[1]
        name.append(ORDINALS.get(t, t))
    if not name:
        return None
    unit = unit or (re.sub(r"\W+", " ", units[0]).strip() if units else "")
    return digits, compass, " ".join(name), kind, unit, postcode


def damerau(a: str, b: str, most: int = 3) -> int:
    """Damerau distance (adjacent swaps count one), up to ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, one = one, row
    return min(one[-1], most + 1)


def assignment_cost(a: list[str], b: list[str]) -> int:
    """Least total Damerau cost of matching the tokens one to one (tokens left over cost their length), by dynamic programming over subsets.

    Equal tokens are matched first, which costs nothing; of what is left, more than 6 tokens on either side differ beyond any allowance.
    """
    equal = Counter(a) & Counter(b)
    a, b = list((Counter(a) - equal).elements()), list((Counter(b) - equal).elements())
    if len(a) > len(b):
        a, b = b, a
    if len(b) > 6:
        return len(b)
    best = {0: 0}
    for t in a:
        step: dict[int, int] = {}
        for mask, cost in best.items():
            for j, u in enumerate(b):
                if not mask >> j & 1:
                    c = cost + damerau(t, u)
                    key = mask | 1 << j
                    if c < step.get(key, 10**6):
                        step[key] = c
        best = step
    return min(c + sum(len(u) for j, u in enumerate(b) if not mask >> j & 1) for mask, c in best.items())


def allowed(a: str, b: str) -> int:
    """Edits that names of this length may differ by; names in digits must be equal."""
    if any(c.isdigit() for c in a + b):
        return 0
    n = min(len(a), len(b))
    return 2 if n >= 8 else 1 if n >= 4 else 0


def variants(name: str) -> list[str]:
    """The deletion neighbourhood of a street name: of each of its tokens, and of all of them as one word."""
    tokens = name.split()
    out: set[str] = set()
    for s in {*tokens, "".join(tokens)}:
        out.add(s)
        if len(s) >= 4 and not any(c.isdigit() for c in s):
            out |= {s[:i] + s[i + 1 :] for i in range(len(s))}
            if len(s) >= 8 and len(tokens) == 1:
                out |= {s[:i] + s[i + 1 : j] + s[j + 1 :] for i, j in combinations(range(len(s)), 2)}
    return sorted(out)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(s, *p) for s in pdf["address"] if (p := parse(s))]
        yield pd.DataFrame(rows, columns=["address", "num", "compass", "name", "kind", "unit", "postcode"])


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(n, v) for n in pdf["name"] for v in variants(n)]
        yield pd.DataFrame(rows, columns=["name", "variant"])


def _cost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        cost = [0 if a == b else (c if (c := assignment_cost(a.split(), b.split())) <= allowed(a, b) or (c := damerau(a.replace(" ", ""), b.replace(" ", ""))) <= allowed(a, b) else 99) for a, b in zip(pdf["name"], pdf["to"])]
        out = pdf.assign(cost=cost)
        yield out[out["cost"] < 99]


def same_places(addresses: DataFrame, unit_veto: bool = True) -> DataFrame:
    """(address_a, address_b): pairs of different strings of column ``address`` that denote one place."""
    parsed = addresses.select("address").where("address IS NOT NULL").distinct().mapInPandas(_parse, "address string, num string, compass string, name string, kind string, unit string, postcode string")
    parsed = written(parsed, "p4-parsed").withColumn("door", F.col("unit") if unit_veto else F.lit(""))
    known = parsed.groupBy("name").agg(F.count_distinct("num").alias("seen"))
    forms = parsed.groupBy("num", "compass", "name", "kind", "door").agg(F.count(F.lit(1)).alias("prints")).join(known, "name")
    index = forms.select("name").distinct().mapInPandas(_variants, "name string, variant string")
    at = forms.select("num", "name").distinct().join(index, "name")
    # names of one house number that share a variant; at most as many as streets that have the number and look alike
    pairs = at.alias("x").join(at.alias("y"), (F.col("x.num") == F.col("y.num")) & (F.col("x.variant") == F.col("y.variant"))).select(F.col("x.num").alias("num"), F.col("x.name").alias("name"), F.col("y.name").alias("to")).distinct()
    pairs = written(pairs.mapInPandas(_cost, "num string, name string, to string, cost int"), "p4-pairs")
    pairs = pairs.join(known, "name").join(known.select(F.col("name").alias("to"), F.col("seen").alias("to_seen")), "to")
    own_street = (F.col("seen") >= ATTESTED) & (F.col("seen") >= RIVAL_SHARE * F.col("to_seen"))
    pairs = pairs.where((F.col("cost") == 0) | ((F.col("to_seen") >= F.col("seen")) & ~own_street))
    target = forms.select(F.col("num"), F.col("name").alias("to"), F.col("compass").alias("to_compass"), F.col("kind").alias("to_kind"), F.col("door").alias("to_door"), F.col("prints").alias("to_prints"))
    here = forms.groupBy("num", F.col("name").alias("to")).agg(F.sum("prints").alias("to_here"))
    links = forms.drop("seen").join(pairs, ["num", "name"]).join(target, ["num", "to"]).join(here, ["num", "to"])
    exact = F.col("compass") == F.col("to_compass")
    maybe_unit = (F.col("compass") == "E?") & F.col("to_compass").isin("E", "")
    links = links.where((exact | maybe_unit) & ((F.col("kind") == F.col("to_kind")) | (F.col("kind") == "")) & (F.col("door") == F.col("to_door")))
    me = ["num", "compass", "name", "kind", "door"]
    # a form without a type may follow a typed one only if its best street has one type here
    # the best name first: with many numbers, then with many prints here, then the smaller; then a certain compass, a type, many prints
    order = Window.partitionBy(*me).orderBy(F.desc("to_seen"), F.desc("to_here"), F.asc("to"), F.desc(F.length("to_compass") == 1), F.asc(F.when(F.col("to_kind") == "", 1).otherwise(0)), F.desc("to_prints"), "to_compass", "to_kind")
    same = Window.partitionBy(*me, "to")
    links = links.withColumn("kinds", F.size(F.array_remove(F.collect_set("to_kind").over(same), "")))
    links = links.where((F.col("kind") != "") | (F.col("kinds") <= 1) | (F.col("to_kind") == ""))
    best = links.withColumn("n", F.row_number().over(order)).where("n = 1").select(*me, F.struct("num", "to_compass", "to", "to_kind", "to_door").alias("place"))
    best = written(best, "p4-best")
    # a form may have resolved to one that itself resolves further: all of a chain are one component
    form = best.select(F.xxhash64(*me).alias("a"), F.xxhash64("place.*").alias("b"), *me)
    labels = components(form.select("a", "b"))
    place = form.join(labels.select(F.col("node").alias("a"), "label"), "a", "left").select(*me, F.coalesce("label", "a").alias("place"))
    members = written(parsed.join(place, me).select("address", "place").distinct(), "p4-members")
    return pairs_within(members, ["place"], "address").select("address_a", "address_b").distinct()
