"""Variant spellings of names typed by people: link the spellings of one person or of one organisation.

Every spelling is rewritten in all canonical ways: accents, case, honorifics and token order are normalised (a name
whose last word is a common first name and whose first word is none is read the other way round); a first name is
replaced by every formal name it is short for, and by its initial; legal forms and abbreviations of an organisation are
written out. Typing errors are rewritings too: a form less one letter of the first or of the last name. The forms are
exploded and equi-joined, persons inside one project, organisations by their type words, so only spellings that share a
rewriting are ever compared.

Pairs are scored by the rarity of what they share. The rarity of a rewriting is counted in persons: a spelling that is
only an initial and a last name scores 1 / (number of different persons of the project that share this rewriting), and
links only at a score of RARITY (1: nobody else has it). Full names and short forms are as good as unique inside a
project and link outright; among several partners a spelling keeps to the best attested, then to the one with which it
shares the rarest rewriting (fewest spellings of the project have it).

Kin are kept apart: two first names that are both common as first names are different people, however alike they look,
unless one is short for the other. A first name one typing error away from another that is ERROR_RATIO times as common
counts as that error, not as a name, however often a large corpus repeats it. Spellings that meet on no project are never compared.

Variants of a name meet at the best attested spelling among their links (the hub), so two different typing errors of
one name are linked through it.

Defined results: null and blank names match nothing; repeated rows count once; names of one token match nothing but
equal tokens; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.addresses import damerau
from hearthline.operators.relational import pairs_within, resolve_chain
from hearthline.session import written

#: The least score of a link by an initial: 1 over the persons of the project that share the rewriting.
RARITY = 1.0
#: A word is read as a first name before another if it is one so often, and so many times more often.
FIRST_LEAST, FIRST_RATIO = 4, 5
#: A first name is itself a typing error if another, one error away, is so many times more common.
ERROR_RATIO = 30

HONORIFIC = re.compile(r"^(?:mr|mrs|ms|miss|mx|dr|prof|rev|hon|sir|madam|supervisor|commissioner)\b\.?\s*", re.I)
SUFFIX = re.compile(r",?\s+(?:jr|sr|ii|iii|iv|esq|phd|md|aia)\.?$", re.I)
#: Everyday short forms beside those of the nicknames table, as "short formal".
SHORT = """
abe abraham; benny benjamin; jo josephine; josie josephine; gus gustavo; lucy lucinda; mandy amanda; bea beatriz; nando fernando; lola dolores; ale alejandro; andy andrew; barb barbara; bella isabella; bert albert; bert bertha; beth elizabeth; betty elizabeth; bill william; bob robert; bobby robert; cal calvin; cam camila;
cathy catherine; charlie charles; chris christopher; cliff clifford; connie constance; dan daniel; dave david; debbie deborah; denny dennis; dick richard; don donald; dot dorothy; doug douglas;
drew andrew; ed edward; ellen eleanor; em emily; flo florence; frank francis; fred frederick; gene eugene; gen genevieve; gert gertrude; greg gregory; hal harold; hank henry; harry harold; harry henry;
howie howard; jake jacob; jen jennifer; jenn jennifer; jerry jerome; jerry gerald; jim james; jimmy james; joe joseph; jon jonathan; josh joshua; judy judith; kate catherine; kathy catherine; katie catherine; ken kenneth;
kim kimberly; larry lawrence; len leonard; lil lillian; lily lillian; liz elizabeth; lori lorraine; lou louis; maggie margaret; marge margaret; matt matthew; max maximilian; meg margaret; mick michael; mike michael;
milly mildred; nate nathaniel; nell eleanor; nick nicholas; pat patricia; patty patricia; peg margaret; phil philip; rafa rafael; ray raymond; rich richard; rick richard; rob robert; ron ronald; ros rosalind; roz rosalind;
sam samuel; sandy sandra; sol solomon; steph stephanie; steve stephen; sue susan; suzy susan; sylvie sylvia; tam tamara; ted theodore; tim timothy; tom thomas; tommy thomas; tony anthony; val valentina; vic victor;
vicky victoria; vince vincent; walt walter; will william; zach zachary; cassie cassandra; chuck charles; cindy cynthia; gabby gabriela; manny manuel; mo mohammed; nan nancy; pam pamela; pen penelope; prissy priscilla
"""
#: Words of organisation names with their abbreviations; the first word of each group is the full form.
ORG_WORDS = """
association assn assoc ass'n asn; alliance all allnce; union un; council cncl coun; coalition coal coaln; club clb; league lge lg; society soc socy; committee cmte comm; foundation fdn found; chamber chmbr;
merchants merchant merch mchts; residents resident resid res; neighbors neighbor neighbours nbrs neigh; tenants tenant ten tnts; preservation pres preserv; improvement impr improv imp; community comm'ty cmty commun;
business bus bsns; housing hsg hous; garden gdn gard gardens gdns; regional reg regl; valley vly val; heights hgts hts; triangle tri trgl; corridor corr cor; terrace terr ter; basin bsn bas; park pk; hill hl hills;
point pt; slope slp; flats flt flat flts; bay; center ctr centre; district dist; square sq; village vlg; beach bch; island isl; mission msn; street st; avenue ave; partnership ptnr; institute inst; company co
"""
LEGAL = frozenset("inc incorporated llc ltd corp corporation the of and for a an in".split())
WORDS: dict[str, str] = {}
for _group in ORG_WORDS.split(";"):
    _full, *_abbr = _group.split()
    for _w in (_full, *_abbr):
        WORDS.setdefault(_w.replace("'", ""), _full)
FULL = sorted(set(WORDS.values()))


def plain(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).casefold()


def person(name: str | None) -> tuple[str, str, str] | None:
    """(first, middle initial, last) of a spelling; first is one letter if only its initial is given."""
    if not name or not name.strip():
        return None
    s = re.sub(r"^[\s+=\-–—*•()]+(?:\([+\-=]\)\s*)?", "", name.strip())
    s = SUFFIX.sub("", HONORIFIC.sub("", s)).strip(" .,;")
    if " " not in s and "," not in s:
        s = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])", " ", s)
    if "," in s:
        last, _, first = s.partition(",")
        s = f"{HONORIFIC.sub('', first.strip())} {last.strip()}"
    tokens = [t for t in re.split(r"[\s.]+", plain(s)) if t.strip("'-")]
    if len(tokens) < 2:
        return None
    first, last = tokens[0], tokens[-1].replace("ph", "f")  # heard alike
    middle = tokens[1][0] if len(tokens) > 2 else ""
    return first, middle, last


@lru_cache(maxsize=200_000)
def _typo(a: str, b: str) -> int:
    return damerau(a, b, 2)


def turned(name: str, p: tuple[str, str, str]) -> tuple[str, str, str] | None:
    """A spelling of two words the other way round; ``p`` is how it reads as it stands."""
    if "," in name or len(p[0]) == 1:
        return None
    back = " ".join(reversed(plain(name).split()))
    return person(back) if len(back.split()) == 2 else None


class Firsts:
    """What is known about the first names of some rows: short forms, and how common each is in the whole corpus.

    The count of a typing error is 0; its worth is the count of the name it was meant for.
    """

    def __init__(self, formals: dict[str, set[str]], counts: dict[str, int], worth: dict[str, int]):
        self.formals = formals
        self.counts = counts
        self.worth = worth

    @classmethod
    def of(cls, pdf: pd.DataFrame, *ends: str) -> Firsts:
        """From the columns first, n, worth, formals and ns of a batch, with each of the endings."""
        out = cls({}, {}, {})
        for e in ends:
            for first, n, worth, formals, ns in zip(*(pdf[f"{c}{e}"] for c in ("first", "n", "worth", "formals", "ns"))):
                if first not in out.formals:
                    out.formals[first] = set(formals)
                    out.counts.update(zip(formals, ns))
                    out.counts[first], out.worth[first] = n, worth
        return out

    def read(self, name: str) -> tuple[str, str, str] | None:
        """``person``, the other way round where only the last word is a first name."""
        p = person(name)
        q = turned(name, p) if p else None
        if q and self.worth.get(q[0], 0) >= max(FIRST_LEAST, FIRST_RATIO * self.worth.get(p[0], 0)):
            return q
        return p

    def rewritings(self, first: str) -> set[str]:
        return {first} | self.formals.get(first, set())

    def relation(self, a: str, b: str) -> int | None:
        """0 equal, 1 short form, 2 initial, 3 typing error; None: different first names."""
        if a == b:
            return 0
        if len(a) == 1 or len(b) == 1:
            short, long = sorted((a, b), key=len)
            return 2 if any(f[0] == short for f in self.rewritings(long)) else None
        if self.rewritings(a) & self.rewritings(b):
            return 1
        x, y = sorted((self.counts.get(a, 0), self.counts.get(b, 0)))
        if x >= 4 and x >= 0.2 * y:
            return None  # both are common first names
        short, long = sorted((a, b), key=len)
        if 3 <= len(short) <= 4 and long.startswith(short) and len(long) >= len(short) + 2:
            return 1
        if min(len(a), len(b)) >= 4 and _typo(a, b) <= (2 if min(len(a), len(b)) >= 9 else 1):
            return 3
        if len(short) == 3 and len(long) == 4 and x <= 2 and y >= 10 and _typo(a, b) <= 1:
            return 3
        # a typing error in a short form, or beside one
        for f in self.rewritings(a):
            for g in self.rewritings(b):
                low, high = sorted((self.counts.get(f, 0), self.counts.get(g, 0)))
                if min(len(f), len(g)) >= 5 and _typo(f, g) <= 1 and not (low >= 4 and low >= 0.2 * high):
                    return 3
        return None

    def same(self, a: tuple[str, str, str], b: tuple[str, str, str]) -> bool:
        if a[1] and b[1] and a[1] != b[1]:
            return False
        if a[2] != b[2]:
            n = min(len(a[2]), len(b[2]))
            if n < 4 or _typo(a[2], b[2]) > (2 if n >= 8 else 1):
                return False
            if len(a[0]) == 1 and len(b[0]) == 1:
                return False
        return self.relation(a[0], b[0]) is not None


def person_forms(p: tuple[str, str, str] | None, formals: dict[str, set[str]]) -> list[str]:
    """All canonical rewritings of one spelling as it was read, typing errors included."""
    if p is None:
        return []
    first, _, last = p
    out = {f"{first[0]}.|{last}"}
    for f in {first} | formals.get(first, set()):
        out.add(f"{f[0]}.|{last}")
        if len(f) > 1:
            out.add(f"{f}|{last}")
            if len(f) == 3:
                out.add(f"~{f}|{last}")
            if len(f) >= 4:
                out |= {f"~{f[:i]}{f[i + 1 :]}|{last}" for i in range(len(f))} | {f"~{f}|{last}"}
    if len(last) >= 5:
        out |= {f"{first[0]}|~{last[:i]}{last[i + 1 :]}" for i in range(len(last))} | {f"{first[0]}|~{last}"}
        for f in formals.get(first, ()):
            if f[0] != first[0]:
                out |= {f"{f[0]}|~{last[:i]}{last[i + 1 :]}" for i in range(len(last))} | {f"{f[0]}|~{last}"}
    return sorted(out)


def organisation(name: str | None) -> tuple[str, str] | None:
    """(type words, proper name): words written out, legal forms dropped, token order of the type words ignored.

    Where either would be empty, the normalised words themselves are the proper name, without type words.
    """
    if not name or not name.strip():
        return None
    s = re.sub(r"\([^)]*\)", " ", plain(name)).replace("’", "'")
    s = re.sub(r"'s\b|s'(?=\s|$)", "s", s).replace("'", "")
    types, proper, words = [], [], []
    for t in re.findall(r"[a-z0-9]+", s):
        if t in LEGAL:
            continue
        words.append(t)
        word = WORDS.get(t)
        if word is None and len(t) >= 5:
            word = next((w for w in FULL if len(w) >= 5 and damerau(t, w, 2) <= (1 if len(w) < 8 else 2)), None)
            if word is None and t.endswith("s") and t[:-1] in WORDS:
                word = WORDS[t[:-1]]
            if word is None:
                tail = next((w for w in sorted(FULL, key=len, reverse=True) if len(w) >= 4 and t.endswith(w) and len(t) - len(w) >= 5), None)
                if tail:
                    types.append(tail)
                    t = t[: -len(tail)]
        if word:
            types.append(word)
        else:
            proper.append(t)
    if not types or not proper:
        whole = "".join(WORDS.get(t, t) for t in words or re.findall(r"[a-z0-9]+", s))
        return ("", whole) if whole else None
    return " ".join(sorted(types)), "".join(proper)


def link_persons(people: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(name_a, name_b) from ``people`` (project, name): spellings of one person that meet on a project.

    First names are counted over all spellings, however rare, typing errors as 0; the counts and the formal names of short forms (those of
    ``nicknames`` (formal, nick) and of SHORT) are joined to the spellings, so nothing travels to all workers.
    """
    met = written(people.dropna().where(F.trim("name") != "").distinct(), "p5-met")

    def firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for n, prints in zip(pdf["name"], pdf["prints"]):
                if p := person(n):
                    q = turned(n, p)
                    rows.append((n, prints, p[0], q[0] if q else p[0]))
            yield pd.DataFrame(rows, columns=["name", "prints", "first", "other"])

    spellings = met.groupBy("name").agg(F.count(F.lit(1)).alias("prints"))
    spellings = written(spellings.mapInPandas(firsts, "name string, prints bigint, first string, other string"), "p5-spellings")
    tally = written(spellings.where(F.length("first") > 1).groupBy("first").agg(F.count(F.lit(1)).alias("n")), "p5-tally")

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.loc[np.array([damerau(a, b, 2) <= 1 for a, b in zip(pdf["first"], pdf["of"])], dtype=bool), ["first", "most"]]

    cut = F.expr("array_distinct(concat(array(first), transform(sequence(1, length(first)), i -> concat(substr(first, 1, i - 1), substr(first, i + 1)))))")
    less = tally.where(F.length("first") > 2).select("first", "n", F.explode(cut).alias("form"))
    beside = less.join(less.select("form", F.col("first").alias("of"), F.col("n").alias("most")), "form").where(F.col("most") >= ERROR_RATIO * F.col("n"))
    errors = beside.select("first", "of", "most").distinct().mapInPandas(near, "first string, most bigint").groupBy("first").agg(F.max("most").alias("most"))
    tally = tally.join(errors, "first", "left").select("first", F.when(F.col("most").isNull(), F.col("n")).otherwise(0).alias("n"), F.coalesce("most", "n").alias("worth"))

    def lowered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"first": pdf["nick"].map(plain), "formal": pdf["formal"].map(plain)})

    nicks = nicknames.select("nick", "formal").dropna().where("nick <> '' AND formal <> ''").mapInPandas(lowered, "first string, formal string")
    short = met.sparkSession.createDataFrame([tuple(x.split()) for x in SHORT.split(";") if x.strip()], "first string, formal string")
    formals = nicks.unionByName(short).distinct().join(tally.select(F.col("first").alias("formal"), "n"), "formal", "left")
    formals = formals.groupBy("first").agg(F.collect_list(F.struct("formal", F.coalesce("n", F.lit(0)).alias("n"))).alias("f"))
    facts = written(tally.join(formals, "first", "full").select("first", "n", "worth", F.col("f.formal").alias("formals"), F.col("f.n").alias("ns")), "p5-firsts")

    def known(e: str) -> DataFrame:
        return facts.select(*[F.col(c).alias(f"{c}{e}") for c in facts.columns])

    def filled(e: str) -> list:
        return [*[F.coalesce(f"{c}{e}", F.lit(0)).alias(f"{c}{e}") for c in ("n", "worth")], F.coalesce(f"formals{e}", F.array().cast("array<string>")).alias(f"formals{e}"), F.coalesce(f"ns{e}", F.array().cast("array<bigint>")).alias(f"ns{e}")]

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            firsts = Firsts.of(pdf, "_p", "_q")
            read = [firsts.read(n) for n in pdf["name"]]
            first, middle, last = ([p[i] for p in read] for i in range(3))
            yield pd.DataFrame({"name": pdf["name"], "prints": pdf["prints"], "first": first, "middle": middle, "last": last, "forms": [person_forms(p, firsts.formals) for p in read]})

    told = spellings.withColumnsRenamed({"first": "first_p", "other": "first_q"}).join(known("_p"), "first_p", "left").join(known("_q"), "first_q", "left")
    told = told.select("name", "prints", "first_p", *filled("_p"), "first_q", *filled("_q"))
    spellings = written(told.mapInPandas(forms, "name string, prints bigint, first string, middle string, last string, forms array<string>"), "p5-read")
    rewritten = spellings.select("name", "forms")
    rows = met.join(rewritten, "name").select(F.xxhash64("project").alias("p"), F.xxhash64("name").alias("s"), F.explode("forms").alias("form"))
    rows = rows.select(F.xxhash64("p", "form").alias("key"), "p", "s")
    held = rows.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")  # a rewriting of one spelling links nothing
    rows = written(rows.join(held, "key"), "p5-forms")
    pairs = pairs_within(rows.select("key", "p", "held", "s"), ["key", "p", "held"], "s")
    pairs = pairs.groupBy("p", F.col("s_a").alias("x"), F.col("s_b").alias("y")).agg(F.min("held").alias("held"))
    by_hash = spellings.join(facts, "first", "left").select(F.xxhash64("name").alias("s"), "name", "prints", "first", "middle", "last", *filled(""))

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            firsts = Firsts.of(pdf, "_x", "_y")
            x, y = (list(zip(pdf[f"first{e}"], pdf[f"middle{e}"], pdf[f"last{e}"])) for e in ("_x", "_y"))
            keep = np.array([firsts.same(p, q) for p, q in zip(x, y)], dtype=bool)
            out = pdf.assign(weak_x=pdf["first_x"].str.len() == 1, weak_y=pdf["first_y"].str.len() == 1)
            yield out.loc[keep, ["p", "held", "name_x", "prints_x", "name_y", "prints_y", "weak_x", "weak_y"]]

    schema = "p bigint, held bigint, name_x string, prints_x bigint, name_y string, prints_y bigint, weak_x boolean, weak_y boolean"
    links = pairs
    for side in "xy":
        links = links.join(by_hash.select(F.col("s").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in by_hash.columns if c != "s"]), side)
    links = links.drop("x", "y").mapInPandas(verified, schema)
    sides = [F.struct("p", "held", F.col(f"name_{u}").alias("a"), F.col(f"name_{v}").alias("b"), F.col(f"prints_{v}").alias("n"), F.col(f"weak_{u}").alias("weak"), F.col(f"weak_{v}").alias("weak_b")) for u, v in ("xy", "yx")]
    both = written(links.select(F.explode(F.array(*sides)).alias("l")).select("l.*"), "p5-links")
    # the score of an initial: persons of the project that share it; spellings that meet at one hub are one person
    prints = spellings.select(F.col("name").alias("a"), "prints")
    own = both.groupBy("p", "a").agg(F.max("weak").alias("weak")).join(prints, "a")
    named = both.where("NOT weak AND NOT weak_b").select("p", "a", "b", "n").unionByName(own.where("NOT weak").select("p", "a", F.col("a").alias("b"), F.col("prints").alias("n")))
    homes = named.groupBy("p", F.col("a").alias("b")).agg(F.max_by("b", F.struct("n", "b")).alias("home"))
    full = both.where("weak AND NOT weak_b").select("p", "a", "b").join(homes, ["p", "b"], "left").select("p", "a", F.coalesce("home", "b").alias("home"))
    scores = full.distinct().groupBy("p", "a").agg((1 / F.count(F.lit(1))).alias("score"))
    vague = scores.where(F.col("score") < RARITY).select("p", "a")
    sure = both.join(vague, ["p", "a"], "left_anti").join(vague.select("p", F.col("a").alias("b")), ["p", "b"], "left_anti")
    sure = written(sure.select("p", "a", "b", "n", "weak", "weak_b", "held"), "p5-sure")
    # variants meet at the best attested spelling among their links
    own = sure.groupBy("p", "a").agg(F.max("weak").alias("weak_b")).join(prints, "a").select("p", "a", F.col("a").alias("b"), F.col("prints").alias("n"), "weak_b", F.lit(1).cast("bigint").alias("held"))
    reach = sure.select("p", "a", "b", "n", "weak_b", "held").unionByName(own)
    best = reach.groupBy("p", "a").agg(F.max_by("b", F.struct(~F.col("weak_b"), F.col("n"), -F.col("held"), F.col("b"))).alias("hub"))
    together = pairs_within(best, ["p", "hub"], "a").select(F.col("a_a").alias("name_a"), F.col("a_b").alias("name_b"))
    direct = sure.where("a < b").select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))
    return together.unionByName(direct).distinct()


def link_organisations(names: DataFrame) -> DataFrame:
    """(name_a, name_b) from column ``name``: spellings of one organisation."""

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for n in pdf["name"]:
                if o := organisation(n):
                    kind, proper = o
                    keys = {proper} | {proper[:i] + proper[i + 1 :] for i in range(len(proper))} if len(proper) >= 5 else {proper}
                    rows += [(n, kind, proper, k) for k in keys]
            yield pd.DataFrame(rows, columns=["name", "kind", "proper", "form"])

    seen = names.where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("prints"))
    rows = written(seen.select("name").mapInPandas(forms, "name string, kind string, proper string, form string"), "p5-orgs")
    near = F.levenshtein(F.col("a.proper"), F.col("b.proper")) <= 2
    at = rows.select("kind", "proper", "form").distinct()
    links = at.alias("a").join(at.alias("b"), (F.col("a.kind") == F.col("b.kind")) & (F.col("a.form") == F.col("b.form")) & near).select("a.kind", F.col("a.proper").alias("proper"), F.col("b.proper").alias("to")).distinct()
    weight = rows.select("name", "kind", "proper").distinct().join(seen, "name").groupBy("kind", "proper").agg(F.sum("prints").alias("n"))
    hub = links.join(weight.select("kind", F.col("proper").alias("to"), "n"), ["kind", "to"]).groupBy("kind", "proper").agg(F.max_by("to", F.struct("n", "to")).alias("hub"))
    steps = hub.select(F.struct("kind", "proper").alias("from"), F.struct("kind", F.col("hub").alias("proper")).alias("to"))
    ends = resolve_chain(written(steps.where("from <> to"), "p5-chain"), "from", "to")  # every step goes to a better attested name, or to a later one of equals
    hub = hub.join(ends.select("from.*", F.col("to.proper").alias("end")), ["kind", "proper"], "left").select("kind", "proper", F.coalesce("end", "hub").alias("hub"))
    members = written(rows.select("name", "kind", "proper").distinct().join(hub, ["kind", "proper"]).select("name", "kind", "hub").distinct(), "p5-hubs")
    return pairs_within(members, ["kind", "hub"], "name").select("name_a", "name_b").distinct()
