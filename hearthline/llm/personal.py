"""Personal information inside free text: find it and replace it with typed placeholders.

Mentions are found by their form (e-mail addresses, phone and identity numbers, house numbers with streets) or by their
place (names in closings, signatures and after words that introduce a person). Overlapping finds keep the stronger
kind. Every mention is replaced by a placeholder of its kind that carries a keyed pseudonym: the digits of validated
numbers, and dates, are permuted within their own format by a Feistel network keyed with a secret, so equal values stay
linked across documents, different values stay different, and lengths and separators survive; words are replaced by
keyed codes of 96 bits. Numbers are mentions only if they are valid (area and exchange codes of phones, areas and groups
of social security numbers). The rest of the text is untouched.

Defined results: null and blank texts have no mentions and stay as they are; texts are treated whole; of overlapping
mentions one is kept; positions are 0-based and count characters; repeated rows count once.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "identity", "address", "name")
PLACEHOLDERS = frozenset((*KINDS, "date"))

GAP = r"[ \t\xa0]"
EMAIL = re.compile(
    r"(?<![\w@/])[A-Za-z0-9][\w.+\-]*(?:" + GAP + r"{0,3}(?:@|[(\[{]" + GAP + r"?at" + GAP + r"?[)\]}])" + GAP + r"{0,3}[A-Za-z0-9][\w\-]*(?:(?:\.|" + GAP + r"?[(\[{]dot[)\]}]" + GAP + r"?|" + GAP + r"+dot" + GAP + r"+)[A-Za-z0-9][\w\-]*)+|"
    + GAP + r"+at" + GAP + r"+[A-Za-z0-9][\w\-]*(?:" + GAP + r"+dot" + GAP + r"+[A-Za-z0-9][\w\-]*)+)",
    re.I,
)
PHONE = re.compile(
    r"(?<![\w.\-/$#])\+?(?:1" + GAP + r"{0,2}[.\-–—]?" + GAP + r"{0,2})?(?:\(\d{3}\)|\d{3})" + GAP + r"{0,2}[.\-–—/]?" + GAP + r"{0,2}\d{3}" + GAP + r"{0,2}[.\-–—]?" + GAP + r"{0,2}\d{4}(?![\w\-–/]|\.\d)|"
    r"(?<![\w.\-–—/$#(])(?<!\d[ \xa0])\d{3}[\-.]\d{4}(?![\w\-–/]|\.\d)"
)
NUMBERISH = re.compile(r"[+(\d][\d ()./\-–—\t\xa0]{6,}\d")
#: How every label of an identity number begins, for a quick look before the pattern is tried.
LABEL_HINT = re.compile(r"\b(?:ssn|soc|itin|tin|ein|tax|c?dl|driv|licen|passport)", re.I)
#: What every identity number holds.
FIVE_DIGITS = re.compile(r"\d(?:[ \xa0\-–]?\d){4}")
IDENTITY_LABEL = (
    r"(?:ssn|social" + GAP + r"+security(?:" + GAP + r"+(?:number|no\.?|card))?|soc\." + GAP + r"?sec\.?|itin|tin|ein|tax(?:payer)?" + GAP + r"*(?:id|identification)|c?dl|(?:driver['’]?s?|driving)?" + GAP + r"*licen[cs]e|passport)"
)
IDENTITY = re.compile(
    r"\b" + IDENTITY_LABEL + r"(?:" + GAP + r"*(?:number|num|no|nr|id|is|was|#|:|\.|-))*" + GAP + r"*(?P<v>[A-Z]{0,2}\d(?:[ \xa0\-–]?\d){6,9}|[A-Z]{1,2}\d{5,9})(?![\w])|(?<![\w.\-–/])(?P<w>\d{3}[\-–]\d{2}[\-–]\d{4})(?![\w\-–])",
    re.I,
)
BIRTH = re.compile(r"\b(?:born(?: on)?|dob|date of birth)\W{0,3}(\d{1,2}[/-]\d{1,2}[/-]\d{4})", re.I)
TYPE = r"(?:street|str|st|avenue|ave|av|boulevard|blvd|court|ct|drive|dr|lane|ln|place|pl|road|rd|terrace|terr|ter|way|wy)(?![\w'’])\.?"
COMPASS = r"(?:north|south|east|west|no|so|n|s|e|w)\b\.?"
NUMBER = r"\d{1,5}(?:" + GAP + r"*[-–—]" + GAP + r"*\d{1,5})?"
STREET = r"(?:[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’]+|\d{1,3}(?:st|nd|rd|th))"
#: House number, unit letter, compass word, street, type.
TYPED = re.compile(r"(?<![\w.\-–—/#$:,])(?<!\w[\-–]" + GAP + r")(?P<a>" + NUMBER + r"(?:" + GAP + r"+[A-DF-H](?=" + GAP + r"))?" + GAP + r"+(?:" + COMPASS + GAP + r"+)?(?P<s>" + STREET + r")" + GAP + r"+" + TYPE + r")", re.I)
#: Street with type, then the house number.
AFTER_HINT = re.compile(r"[ \t\xa0]\d")
STREET_ENDS = frozenset("street str st avenue ave av boulevard blvd court ct drive dr lane ln place pl road rd terrace terr ter way wy no number".split())
AFTER = re.compile(r"(?<![\w.\-–@#])(?P<a>(?:" + COMPASS + GAP + r"+)?(?P<s>" + STREET + r")" + GAP + r"+" + TYPE + r",?" + GAP + r"+(?:(?:no|number)\b\.?" + GAP + r"*)?\d{1,5}(?![\w/:]|[.\-–]\d))(?!" + GAP + r"+(?:square|feet|percent|cars|households|units|homes|people|years|days|times|months|weeks|buildings|blocks|pages|stories))", re.I)
#: Where an address stands, even without a street type.
PLACE = r"(?:(?:lives?|living|resid(?:e|es|ing)|located)" + GAP + r"+(?:at|on)|(?:about|regarding|concerns?|concerning|write" + GAP + r"+on|home" + GAP + r"+is|house" + GAP + r"+is(?:" + GAP + r"+at)?|address" + GAP + r"+is|number|address:?))"
BARE = re.compile(
    r"(?:(?:no|number)\b\.?" + GAP + r"*(?=\d))?(?P<a>" + NUMBER + r"(?:" + GAP + r"+[A-DF-H](?=" + GAP + r"))?" + GAP + r"+(?:" + COMPASS + GAP + r"+)?(?P<s>[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’]{3,}|\d{1,3}(?:st|nd|rd|th))(?![\w@]))",
    re.I,
)
BARE_AFTER = re.compile(r"(?P<a>(?:" + COMPASS + GAP + r"+)?(?P<s>[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’]{3,})(?:" + GAP + r"+" + TYPE + r")?,?" + GAP + r"+(?:(?:no|number)\b\.?" + GAP + r"*)?\d{1,5}(?![\w/:%]|[.\-–]\d))", re.I)
#: The same at the start of a line or field of a signature.
FIELD = re.compile(r"(?:(?:no|number)\b\.?" + GAP + r"*(?=\d))?(?P<a>" + NUMBER + r"(?:" + GAP + r"+[A-DF-H](?=" + GAP + r"))?" + GAP + r"+(?:" + COMPASS + GAP + r"+)?(?P<s>[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’]{3,}))(?:" + GAP + r"*(?:[,#\n]|" + GAP + r"(?:unit|apt|suite|\d{4})\b|\.?$)|" + GAP + r"*$)", re.I | re.M)
FIELD_AFTER = re.compile(r"(?P<a>(?:" + COMPASS + GAP + r"+)?(?P<s>[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’]{3,})(?:" + GAP + r"+" + TYPE + r")?,?" + GAP + r"+(?:(?:no|number)\b\.?" + GAP + r"*)?\d{1,5})(?![\w/:%@]|[.\-–]" + GAP + r"*\d)", re.I)
#: Words that follow a number without making it a house number.
ORDINARY = frozenset(
    """about above affordability after against agreed also among and another approval are around at bedrooms before below beside between bicycles bikes blocks buildings but by cars cases changes children comments copies
    day days decisions documents drawings dwelling employees errors exactly families feet floor floors foot for from hearing hearings homes hours houses households in inches into items jobs letters lots members meeting meetings messages
    miles minutes month months motion motions near neighbors of off on open or other others our out over page pages parcels parking pedestrians people percent persons petitions photos plans points projects records renters requests residents
    residential rooms seniors shops signatures similar since sites spaces speakers square stories story street students than that the their them there these this those three times to trees trips trucks two unanswered under units until up vacant
    vehicles visitors votes was we week weeks were when where which with within without workers year years your""".split()
)
CLOSING = re.compile(
    r"(?:[\n>.!?][ \t]{0,2}|\A)(?:with" + GAP + r"+(?:appreciation|respect|thanks|gratitude)|(?:many" + GAP + r"+)?thanks(?:" + GAP + r"+(?:for" + GAP + r"+(?:listening|your" + GAP + r"+time)|again))?|thank" + GAP + r"+you(?:" + GAP + r"+for" + GAP + r"+\w+(?:" + GAP + r"+\w+)?)?|sincerely(?:" + GAP + r"+yours)?|"
    r"respectfully(?:" + GAP + r"+(?:yours|submitted))?|(?:best|kind|warm)(?:" + GAP + r"+(?:regards|wishes))?|regards|yours" + GAP + r"+(?:truly|sincerely|faithfully)|cordially|cheers)" + GAP + r"*,{1,2}(?:" + GAP + r"*\r?\n(?:>" + GAP + r"?|" + GAP + r")*(?:\r?\n(?:>" + GAP + r"?|" + GAP + r")*)*|" + GAP + r"+)",
    re.I,
)
HONORIFIC = r"(?:(?:mr|mrs|ms|miss|mx|dr|prof|professor|rev|reverend|hon|honorable|sir|madam|commissioner|supervisor|president|vice" + GAP + r"president|director|planner|secretary|mayor|senator|chair|councilmember)\b\.?" + GAP + r"+)*"
HONOR = re.compile(HONORIFIC, re.I)
WORD = r"[A-ZÀ-Þ](?:[a-zß-ÿ'’\-]+(?:[A-ZÀ-Þ][a-zß-ÿ'’]+)*|[A-ZÀ-Þ'’\-]+)"
FULL_NAME = r"(?:" + WORD + r"|[A-ZÀ-Þ]\.)(?:" + GAP + r"+[A-ZÀ-Þ]\.)?(?:" + GAP + r"+" + WORD + r")?"
REVERSED = WORD + r"," + GAP + r"+(?:" + WORD + r"|[A-ZÀ-Þ]\.)(?:" + GAP + r"+[A-ZÀ-Þ]\.)?"
FULL_LINE, REVERSED_LINE = re.compile(FULL_NAME), re.compile(REVERSED)
LOWER_LINE = re.compile(r"([^\W\d_'’\-]+)(?: [a-z]\.)? [^\W\d_'’\-]{3,}")
INITIAL = re.compile(r"[A-Za-z]\.,?")
#: Words after which a person is named.
INTRODUCED = re.compile(
    r"\b(?:(?:letter|note|message|e-?mail)" + GAP + r"+from|agrees" + GAP + r"+with|seconds|seconded" + GAP + r"+by|(?:spoke|speaking)" + GAP + r"+for|asked" + GAP + r"+that|on" + GAP + r"+behalf" + GAP + r"+of|i" + GAP + r"+am|my" + GAP + r"+name" + GAP + r"+is|"
    r"(?:the|my|our|a)" + GAP + r"+(?:tenant|owner|neighbor|neighbour|architect|sponsor|planner|landlord|manager|applicant|attorney|engineer|friend|husband|wife|mother|father|sister|brother|son|daughter|principal|contractor|realtor|agent)s?,?|"
    r"commissioner|supervisor|planner|president|secretary|director)" + GAP + r"+",
    re.I,
)
#: Words after which an address stands.
PLACED = re.compile(r"\b" + PLACE + GAP + r"+", re.I)
NAMED = re.compile(r"(?P<n>" + REVERSED + r"(?=,|\s*$|;)|" + FULL_NAME + r")(?![\w@])")
#: A name all in lower case; its first word must be a known first name.
LOWER = re.compile(r"(?P<n>(?P<f>[a-zß-ÿ'’\-]{2,})(?:" + GAP + r"+[a-z]\.)?" + GAP + r"+[a-zß-ÿ'’\-]{3,}|[a-zß-ÿ'’\-]{3,}," + GAP + r"+(?P<g>[a-zß-ÿ'’\-]{2,}))(?![\w@])")
TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Miss|Mx|Dr|MR|MRS|MS|DR)\b\.?" + GAP + r"+(?P<n>" + FULL_NAME + r")(?![\w@])")
#: Two capitalised words in running text; the first must be a known first name.
PROSE = re.compile(r"(?<![\w@])(?P<n>(?P<f>[A-ZÀ-Þ][a-zß-ÿ'’]+)(?:" + GAP + r"+[A-ZÀ-Þ]\.)?" + GAP + r"+[A-ZÀ-Þ][\w'’\-]*[a-zß-ÿ])(?![\w@])")
#: Capitalised words that are no names.
NO_NAME = frozenset(
    """commissioners commissioner commission planning department planner president members member hearing everyone port alder street avenue dear hello honorable good morning afternoon evening regarding subject forwarded message whom concern
    january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday the this that these those our my we i it in on at of and or no not yes please case motion
    resolution page block lot permit bpa speaker staff city hall neighbor neighbors association club council union league society alliance coalition chamber committee residents tenants merchants business call tel phone ph cell email e-mail
    write sent from to cc fw re fwd attachment attached housing plan citywide unit apt suite rear ground floor north south east west""".split()
)


def _no_name(s: str) -> bool:
    return any(w.strip(".,").casefold() in NO_NAME and not INITIAL.fullmatch(w) for w in s.split())


def valid_phone(printed: str) -> bool:
    """Area and exchange codes begin with 2 to 9; a number without an area code has only an exchange."""
    digits = "".join(c for c in printed if c.isdigit())
    local = digits[-10:] if len(digits) >= 10 else digits
    return local[0] not in "01" and (len(local) < 10 or local[3] not in "01") and (len(digits) < 11 or digits[0] == "1")


def valid_identity(printed: str, value: str) -> bool:
    """A social security number has no part of zeros only and no area 666; other numbers have a digit other than 0."""
    digits = "".join(c for c in value if c.isdigit())
    social = re.match(r"ssn|soc", printed, re.I) or re.fullmatch(r"\d{3}[-–]\d{2}[-–]\d{4}", value)
    if social and len(digits) == 9:
        return digits[:3] not in ("000", "666") and digits[3:5] != "00" and digits[5:] != "0000"
    return bool(digits.strip("0"))


class Finder:
    """Finds the mentions of one text. ``first_names`` (lower case) let names in lower case be told from words."""

    def __init__(self, first_names: frozenset[str] = frozenset()):
        self.first_names = first_names

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind), sorted, without overlaps."""
        spans: list[tuple[int, int, str]] = []

        def add(start: int, end: int, kind: str) -> bool:
            while start < end and not text[start].isalnum():
                start += 1
            if (at := text.rfind("[", max(0, start - 10), start)) >= 0 and text[at + 1 : start].strip() in PLACEHOLDERS:
                return False  # a placeholder of ours
            if start >= end or any(s < end and start < e for s, e, _ in spans):
                return False
            spans.append((start, end, kind))
            return True

        low = text.lower()
        if "@" in text or "(at" in low or "[at" in low or "{at" in low or " dot " in low or "(dot" in low or "[dot" in low:
            for m in EMAIL.finditer(text):
                add(m.start(), m.end(), "email")
        has_digit = any(c in text for c in "0123456789")
        if has_digit:
            numbers = [(c.start(), c.end()) for c in NUMBERISH.finditer(text)]
            labelled = FIVE_DIGITS.search(text) and LABEL_HINT.search(text)
            if numbers or labelled:
                for m in IDENTITY.finditer(text) if labelled else (m for a, b in numbers for m in IDENTITY.finditer(text, a, min(len(text), b + 2))):
                    g = "v" if m["v"] else "w"
                    if valid_identity(m[0], m[g]):
                        add(m.start(g), m.end(g), "identity")
            for a, b in numbers:
                for m in PHONE.finditer(text, a, min(len(text), b + 3)):
                    if valid_phone(m[0]) and not re.search(r"(?:\bno\.?|resolution|motion|case|permit|bpa|#|\$)\s*$", text[max(0, m.start() - 12) : m.start()], re.I):
                        add(m.start(), m.end(), "phone")
        fields = self.signature(text, add)
        introduced = list(INTRODUCED.finditer(text))
        if has_digit:
            after = any((x := low[max(0, m.start() - 14) : m.start()].split()) and x[-1].strip(".,") in STREET_ENDS for m in AFTER_HINT.finditer(text))
            for pattern in (TYPED, AFTER) if after else (TYPED,):
                for m in pattern.finditer(text):
                    if m["s"].lower() not in ORDINARY:
                        add(m.start("a"), m.end("a"), "address")
            # where a person is introduced no address is looked for, and the other way round
            starts = [c.start() for c in introduced]
            for c in PLACED.finditer(text):
                if any(c.start() <= at < c.end() for at in starts):
                    continue
                for pattern in (BARE, BARE_AFTER):
                    m = pattern.match(text, c.end())
                    if not m or (s := m["s"].lower()) in ORDINARY:
                        continue
                    if pattern is BARE_AFTER and not m["s"][0].isupper() and "," not in m["a"] and len(s) < 6 and c[0].lower().startswith(("about", "number", "concern")) and not re.search(TYPE, m["a"], re.I):
                        continue
                    add(m.start("a"), m.end("a"), "address")
            for start, end in fields:
                for pattern in (FIELD, FIELD_AFTER):
                    m = pattern.match(text, start, end)
                    if m and m["s"].lower() not in ORDINARY and not re.match(r"(?:call|tel|phone|cell|ph|fax|ext|page|case|unit|apt|suite|room|port|email|write|mobile|home|work)\b", m["s"], re.I):
                        add(m.start("a"), m.end("a"), "address")
        for c in introduced:
            start = HONOR.match(text, c.end()).end()
            m = NAMED.match(text, start)
            if m:
                name, end = m["n"], m.end("n")
                if " " not in name and "," not in name and (more := re.match(r"," + GAP + r"+([^\W\d_'’\-]+)(?:" + GAP + r"+[A-Z]\.)?(?![\w@])", text[end : end + 40])) and more[1].lower() in self.first_names:
                    end += more.end()  # last name first
                if c[0].isupper() and len(c[0]) > 5 and start == c.end() and not name.endswith(".") and name.split()[0].lower() not in self.first_names and "," not in name:
                    continue  # in a text in capitals only a known first name is told from a word
                if not _no_name(name) and not self._organisation(text, end):
                    add(start, end, "name")
            elif self.first_names and (m := LOWER.match(text, start)) and (m["f"] or m["g"]) in self.first_names and not _no_name(m["n"]):
                add(start, m.end("n"), "name")
        for m in TITLED.finditer(text):
            if not _no_name(m["n"]):
                add(m.start("n"), m.end("n"), "name")
        if self.first_names:
            for m in PROSE.finditer(text):
                if m["f"].lower() in self.first_names and not _no_name(m["n"]) and not self._organisation(text, m.end()):
                    add(m.start(), m.end(), "name")
        return sorted(spans)

    @staticmethod
    def _organisation(text: str, end: int) -> bool:
        """The words go on as the name of a body or a street."""
        return bool(re.match(GAP + r"+(?:[A-Z]\w+" + GAP + r"+){0,2}(?:Association|Ass'n|Assn|Alliance|Union|Council|Club|League|Society|Coalition|Chamber|Hill|Heights|Park|Valley|Basin|Point|Slope|Flats|Corridor|Triangle|Gardens|Terrace|Street|Str|St|Avenue|Ave|Court|Road|Drive|Lane|Way|Place|Boulevard)\b", text[end : end + 60]))

    def signature(self, text: str, add) -> list[tuple[int, int]]:
        """Add the names of closings and of lines that are only a name; return the bounds of signature fields."""
        fields: list[tuple[int, int]] = []
        for m in CLOSING.finditer(text):
            at = m.end()
            inline = "\n" not in text[m.start() + 1 : m.end()]
            stop = text.find("\n\n", at)
            stop = len(text) if stop < 0 else stop
            block = text[at:stop]
            if inline and "\n" in block:
                block = block.split("\n", 1)[0]
            parts, pos = [], at
            for piece in re.split(r"(\r?\n(?:>[ ]?)*|,[ \t]+)", block):
                if re.fullmatch(r"\r?\n(?:>[ ]?)*|,[ \t]+", piece):
                    parts.append((None, pos, pos + len(piece), piece))
                elif piece.strip():
                    parts.append((piece, pos, pos + len(piece), ""))
                pos += len(piece)
            if not parts or parts[0][0] is None:
                continue
            name, start, end, _ = parts[0]
            rest = 1
            shift = HONOR.match(name).end()
            core = name[shift:].strip(" \t\r.")
            if re.fullmatch(r"[A-Za-zÀ-ÿ'’.\-]+(?:[ \t\xa0]+[A-Za-zÀ-ÿ'’.\-]+){0,3}", core) and not _no_name(core):
                last = start + shift + len(name[shift:].rstrip(" \t\r"))
                if len(parts) > 2 and parts[1][3].startswith(",") and " " not in core and re.fullmatch(r"[A-Za-zÀ-ÿ'’\-]+\.?(?:[ \t]+[A-Z]\.)?", parts[2][0].strip(" \r") if parts[2][0] else "") and not _no_name(parts[2][0]) and not re.match(r"(?:call|tel|phone|cell|email|write)\b", parts[2][0], re.I):
                    last = parts[2][1] + len(parts[2][0].rstrip(" \t\r"))
                    rest = 3
                add(start + shift, last, "name")
            fields += [(a, stop) for p, a, _, _ in parts[rest:] if p]
        line_start = 0
        lines = text.split("\n")
        for i, line in enumerate(lines):
            body = line.strip(" >\t\r")
            if i and body:
                shift = HONOR.match(body).end()
                core = body[shift:]
                low = core.islower() and LOWER_LINE.fullmatch(core)
                if low and low[1] not in self.first_names:
                    low = None
                if core and (low or FULL_LINE.fullmatch(core) and (" " in core or shift) or REVERSED_LINE.fullmatch(core)) and not _no_name(core):
                    at = line_start + line.index(body) + shift
                    add(at, at + len(core), "name")
                    fields_at = line_start + len(line) + 1
                    for k in range(i + 1, len(lines)):
                        if not lines[k].strip(" >\t\r"):
                            break
                        lead = len(lines[k]) - len(lines[k].lstrip(" >\t"))
                        fields.append((fields_at + lead, fields_at + len(lines[k])))
                        fields_at += len(lines[k]) + 1
            line_start += len(line) + 1
        return fields


def feistel(digits: str, key: bytes, tweak: str, rounds: int = 8) -> str:
    """A keyed permutation of the strings of digits of one length: an unbalanced Feistel network over decimal halves."""
    n = len(digits)
    if n < 2:
        digest = hmac.new(key, f"{tweak}|1".encode(), hashlib.sha256).digest()
        return str((int(digits) + digest[0]) % 10) if digits else digits
    u = n // 2
    a, b = int(digits[:u]), int(digits[u:])
    for r in range(rounds):
        digest = hmac.new(key, f"{tweak}|{n}|{r}|{b}".encode(), hashlib.sha256).digest()
        width = u if r % 2 == 0 else n - u
        c = (a + int.from_bytes(digest[:12], "big")) % 10**width
        a, b = b, c
    if rounds % 2:
        a, b = b, a
    return f"{a:0{u}d}{b:0{n - u}d}"


def unfeistel(digits: str, key: bytes, tweak: str, rounds: int = 8) -> str:
    """The inverse of ``feistel``."""
    n = len(digits)
    if n < 2:
        digest = hmac.new(key, f"{tweak}|1".encode(), hashlib.sha256).digest()
        return str((int(digits) - digest[0]) % 10) if digits else digits
    u = n // 2
    a, b = int(digits[:u]), int(digits[u:])
    if rounds % 2:
        a, b = b, a
    for r in range(rounds - 1, -1, -1):
        width = u if r % 2 == 0 else n - u
        digest = hmac.new(key, f"{tweak}|{n}|{r}|{a}".encode(), hashlib.sha256).digest()
        a, b = (b - int.from_bytes(digest[:12], "big")) % 10**width, a
    return f"{a:0{u}d}{b:0{n - u}d}"


def permute_date(printed: str, key: bytes) -> str:
    """Another date of the same hundred years, in the same format (month first); not a date: its digits permuted."""
    m = re.fullmatch(r"(\d{1,2})([/-])(\d{1,2})([/-])(\d{4})", printed)
    try:
        day = datetime.date(int(m[5]), int(m[1]), int(m[3])) if m else None
    except ValueError:
        day = None
    if day is None:
        return re.sub(r"\d+", lambda x: feistel(x[0], key, "date"), printed)
    first = datetime.date(day.year // 100 * 100 or 1, 1, 1)
    span = (datetime.date(first.year + 100, 1, 1) - first).days if first.year < 9900 else 36524
    at = (day - first).days
    while True:  # cycle walking keeps the permutation inside the hundred years
        at = int(feistel(f"{at:05d}", key, "date"))
        if at < span:
            break
    moved = first + datetime.timedelta(days=at)
    return f"{moved.month}{m[2]}{moved.day}{m[4]}{moved.year}"


#: Hexadecimal digits of a code: 96 bits, so that different values don't share one in any corpus.
CODE = 24


def pseudonym(kind: str, value: str, key: bytes) -> str:
    """The placeholder of one mention."""
    if kind == "date":
        return f"[date {permute_date(value, key)}]"
    if kind in ("phone", "identity"):
        digits = re.sub(r"\D", "", value)
        lead = digits[:-10] if kind == "phone" and len(digits) == 11 else ""
        moved = iter(lead + feistel(digits[len(lead) :], key, kind))
        return f"[{kind} " + re.sub(r"\d", lambda _: next(moved, "0"), value) + "]"
    same = re.sub(r"\W+", " ", value.casefold()).strip()
    return f"[{kind} {hmac.new(key, f'{kind}|{same}'.encode(), hashlib.sha256).hexdigest()[:CODE]}]"


def redact(text: str | None, finder: Finder, key: bytes) -> str | None:
    if not text:
        return text
    spans = finder.find(text)
    spans += [(m.start(1), m.end(1), "date") for m in BIRTH.finditer(text) if not any(s < m.end(1) and m.start(1) < e for s, e, _ in spans)]
    out, at = [], 0
    for start, end, kind in sorted(spans):
        out += [text[at:start], pseudonym(kind, text[start:end], key)]
        at = end
    return "".join([*out, text[at:]])


def _fields(comments: DataFrame) -> DataFrame:
    """(comment_id, comment, text), the text left out where it repeats the comment, so each wording is read once."""
    return comments.select("comment_id", "comment", F.when(~F.col("text").eqNullSafe(F.col("comment")), F.col("text")).alias("text"), (F.col("text") == F.col("comment")).alias("both")).distinct()


#: A first name is known if it is this share of all recorded names, so that at most that many are known.
NAME_SHARE = 50_000


def known_first_names(names: DataFrame) -> frozenset[str]:
    """First names (lower case) of column ``name`` that make up at least 1 in NAME_SHARE of its rows: at most NAME_SHARE of them."""
    first = F.lower(F.regexp_extract("name", r"^([\p{L}'’]{2,})\s+[\p{L}]", 1)).alias("first")
    counts = names.where("name IS NOT NULL").select(first).where("first <> ''").groupBy("first").agg(F.count(F.lit(1)).alias("n")).persist()
    total = counts.agg(F.sum("n")).collect()[0][0] or 0
    found = frozenset(r["first"] for r in counts.where(F.col("n") >= max(2, total / NAME_SHARE)).collect())
    counts.unpersist()
    return found


def find_mentions(comments: DataFrame, first_names: frozenset[str] = frozenset()) -> DataFrame:
    """(comment_id, field_name, kind, start_pos) of a table (comment_id, comment, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(first_names)
        for pdf in batches:
            rows = []
            for cid, comment, text, both in zip(pdf["comment_id"], pdf["comment"], pdf["text"], pdf["both"]):
                if comment:
                    for start, _, kind in finder.find(comment):
                        rows.append((cid, "comment", kind, start))
                        if both:
                            rows.append((cid, "text", kind, start))
                if text:
                    rows += [(cid, "text", kind, start) for start, _, kind in finder.find(text)]
            yield pd.DataFrame(rows, columns=["comment_id", "field_name", "kind", "start_pos"]).astype({"start_pos": "int32"})

    return _fields(comments).mapInPandas(run, "comment_id string, field_name string, kind string, start_pos int").distinct()


def redact_comments(comments: DataFrame, secret: str, first_names: frozenset[str] = frozenset()) -> DataFrame:
    """(comment_id, comment, text) with placeholders; the secret keys the pseudonyms."""
    key = hashlib.sha256(secret.encode()).digest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(first_names)
        for pdf in batches:
            comment = [redact(t, finder, key) for t in pdf["comment"]]
            text = [c if both else redact(t, finder, key) for c, t, both in zip(comment, pdf["text"], pdf["both"])]
            yield pd.DataFrame({"comment_id": pdf["comment_id"], "comment": comment, "text": text})

    return _fields(comments).mapInPandas(run, "comment_id string, comment string, text string")


def linked_values(comments: DataFrame, secret: str, first_names: frozenset[str] = frozenset()) -> DataFrame:
    """(kind, n_values, n_pseudonyms, n_restored) of all mentions: that equal values stay linked and different ones apart.

    Values are compared as their pseudonyms see them (the digits of numbers, the words of the rest). A number counts as
    restored if the inverse of the permutation gives its digits back; words have no inverse, so none of them counts.
    """
    key = hashlib.sha256(secret.encode()).digest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(first_names)
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                for start, end, kind in finder.find(text):
                    value, code, back = text[start:end], pseudonym(kind, text[start:end], key), 0
                    if kind in ("phone", "identity"):
                        value, moved = ("".join(c for c in x if c.isdecimal()) for x in (value, code))
                        lead = len(value) - 10 if kind == "phone" and len(value) == 11 else 0
                        back, code = int(value[:lead] + unfeistel(moved[lead:], key, kind) == value), moved
                    else:
                        value = re.sub(r"\W+", " ", value.casefold()).strip()
                    rows.append((kind, value, code, back))
            yield pd.DataFrame(rows, columns=["kind", "value", "code", "back"]).astype({"back": "int32"})

    texts = comments.select(F.explode(F.array("comment", "text")).alias("text")).where("text IS NOT NULL").distinct()
    found = texts.mapInPandas(run, "kind string, value string, code string, back int").distinct()
    counts = found.groupBy("kind").agg(F.count_distinct("value").alias("n_values"), F.count_distinct("code").alias("n_pseudonyms"), F.sum("back").alias("n_restored"))
    return counts.select("kind", "n_values", "n_pseudonyms", "n_restored")
