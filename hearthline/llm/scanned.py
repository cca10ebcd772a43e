"""Noise in text from scanned pages: broken words, misread characters, running heads and page numbers.

Two passes over the whole texts. The first counts words, word pairs and compounds of the corpus (fragments at broken
line ends excepted). The second repairs each text: running heads and page numbers are taken out, words broken over a
line end are joined unless the corpus knows the compound, and every line is decoded by Viterbi over candidate words,
with the probability of the character confusions that turn a candidate into what was read as the channel, and the
corpus' word and word-pair likelihood as the source.

What travels to the workers is bounded whatever the corpus: words with a share of at least 1 in 200,000 and pairs with
one of at least 1 in 300,000 of all tokens (shares sum to one, so there are at most as many).

Defined results: null and blank texts have no noise and stay as they are; texts of any length are treated whole;
repeated ids give one row per field and noise; words without a known likely reading are left alone.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_SHARE, PAIR_SHARE = 200_000, 300_000
#: What scanners read for what is printed, as (read, printed, probability of a confusion).
CONFUSIONS = [
    ("rn", "m", 1.0), ("cl", "d", 1.0), ("vv", "w", 1.0), ("ii", "u", 1.0), ("li", "h", 1.0), ("m", "in", 0.6), ("m", "rn", 0.6), ("m", "ni", 0.4), ("d", "cl", 0.5), ("h", "li", 0.4), ("w", "vv", 0.2), ("fi", "ti", 0.6), ("ri", "n", 0.6), ("in", "m", 0.6), ("n", "ri", 0.3),
    ("tl", "d", 0.3), ("lo", "b", 0.3), ("c", "e", 1.0), ("e", "c", 0.6), ("0", "o", 1.0), ("1", "l", 1.0), ("1", "i", 0.8), ("l", "i", 0.5), ("i", "l", 0.5), ("I", "l", 0.8), ("!", "l", 0.8), ("!", "i", 1.0), ("|", "l", 0.9), ("|", "i", 0.8), ("5", "s", 1.0), ("$", "s", 0.8), ("9", "g", 1.0), ("6", "b", 0.7), ("8", "b", 0.5),
    ("8", "a", 0.3), ("3", "e", 0.5), ("4", "a", 0.5), ("7", "t", 0.5), ("†", "t", 1.0), ("+", "t", 0.6), ("f", "t", 0.5), ("t", "f", 0.5), ("q", "g", 0.4), ("g", "q", 0.3), ("y", "v", 0.3), ("v", "y", 0.3), ("o", "c", 0.3), ("c", "o", 0.4), ("a", "o", 0.3), ("o", "a", 0.3), ("u", "n", 0.4), ("n", "u", 0.4), ("b", "h", 0.4),
    ("h", "b", 0.4), ("s", "5", 0.01), ("@", "a", 0.8), ("€", "e", 0.7), ("£", "f", 0.3), ("¢", "c", 0.7), ("ß", "b", 0.5), ("é", "e", 0.6), ("ö", "o", 0.5), ("í", "i", 0.6), ("ı", "i", 0.9), ("ﬁ", "fi", 1.0), ("ﬂ", "fl", 1.0), ("rri", "m", 0.4), ("iii", "m", 0.4), ("nn", "m", 0.3), ("uu", "w", 0.4),
]
#: Log probability of the channel below which no reading is looked at: a word of any frequency loses to an unknown one there.
FARTHEST = math.log(1e-7)
#: Probability that a printed word is misread with one given confusion; of a letter-for-letter confusion less.
P_MISREAD, P_LETTER = 0.02, 0.004
#: The confusions by the first character read, with their log probabilities.
CHANNEL: dict[str, list[tuple[str, str, float]]] = {}
for _wrong, _right, _share in CONFUSIONS:
    CHANNEL.setdefault(_wrong[0], []).append((_wrong, _right, math.log(_share * (P_LETTER if _wrong.isalpha() and len(_wrong) == len(_right) else P_MISREAD))))
#: Different confusions in one word.
CONFUSED = 3
#: Words that may name the place before a body in a running head.
PLACE = "port alder"
HEAD = re.compile(
    rf"^\W*(?:(?:the )?(?:{PLACE} )?(?:city )?planning (?:commission|department)(?: minutes| hearing| meeting)?|(?:meeting|hearing) minutes|minutes of the (?:regular|special|joint|closed)?\s*(?:hearing|meeting)|"
    r"(?:regular|special|joint) (?:hearing|meeting) minutes)\b",
    re.I,
)
MONTH = r"(?:january|february|march|april|may|june|july|august|september|october|november|december)"
DATE = re.compile(r"(?:(?:mon|tues|wednes|thurs|fri|satur|sun)day,?\s*)?(?:" + MONTH + r"\s+\d{1,2},?\s+\d{4}|\d{1,2}/\d{1,2}/\d{2,4})", re.I)
PAGE = re.compile(r"(?:\bpage\s*\d+(?:\s*of\s*\d+)?|\bp\.\s*\d+|\bpg\.?\s*\d+)", re.I)
DIGIT = re.compile(r"[0-9]")
LONE = re.compile(r"^\s*(?:[-–—\[(|]\s*)?(?:(?:page|pg\.?|p\.)\s*)?\d{1,4}(?:\s*(?:of|\||/)\s*\d{1,4})?(?:\s*[-–—\])|])?\s*$", re.I)
BREAK = re.compile(r"([^\W\d_][\w'’†!|$@]*)([-‐‑¬­])[ \t\r]*$")
MARKS = frozenset("-‐‑¬­")
COMPOUND = re.compile(r"\b[a-z]+-[a-z]+\b")
TOKEN = re.compile(r"[^\s\-–—/]+")
PARTS = re.compile(r"([\s\-–—/]+)")
EDGE = "\"'“”‘’().,;:?*"


def kind_of_line(line: str) -> tuple[bool, bool]:
    """(a running head, holds a page number) of one line."""
    s = line.strip()
    if not DIGIT.search(s) and "lanning" not in (low := s.lower()) and "inutes" not in low:
        return False, False  # every head and page number has a digit or one of these words
    if s[:4] == "page":  # a wrapped sentence that ends in "page 12."
        return False, False
    if LONE.match(s):
        return False, True
    m = HEAD.match(s)
    if m:
        rest = PAGE.sub(" ", DATE.sub(" ", s[m.end() :]))
        tail = re.sub(r"\b(?:minutes|regular|special|joint|hearing|meeting|port alder|planning|commission|of|the|page|\d+)\b", " ", rest, flags=re.I)
        if not re.search(r"\w", tail):
            trail = re.search(r"\s{2,}\d{1,4}\s*$", s)
            return True, bool(PAGE.search(s) or trail)
    elif DATE.fullmatch(s.strip(" -–")):
        return True, False
    elif (p := PAGE.search(s)) and re.fullmatch(r"[\W\d]*", DATE.sub("", s[: p.start()] + s[p.end() :])):
        return True, True
    return False, False


def broken(left: str, right: str, words: dict[str, int], compounds: dict[str, int], mark: str) -> bool:
    """Whether a line end mark between the two parts is none of the word's own."""
    if mark != "-" and mark not in "‐‑":
        return True
    low = (left + right).lower()
    joined, compound = words.get(low, 0), compounds.get(f"{left.lower()}-{right.lower()}", 0)
    if joined or compound:
        return joined >= compound
    if not right[:1].islower() and not (left.isupper() and right.isupper()):
        return False
    return not (words.get(left.lower(), 0) and words.get(right.lower(), 0))


def lines_of(text: str) -> list[tuple[str, bool, bool]]:
    out = []
    for line in text.split("\n"):
        head, page = kind_of_line(line)
        out.append((line.rstrip(), head, page))
    # a date alone is a running head only beside another head or page number
    for i, (line, head, page) in enumerate(out):
        if head and not page and DATE.fullmatch(line.strip(" -–")):
            near = [out[j] for j in (i - 1, i + 1) if 0 <= j < len(out)]
            if not any(HEAD.match(x[0].strip()) or x[2] for x in near):
                out[i] = (line, False, False)
    return out


def _clean(token: str) -> str:
    return token.strip(EDGE)


class _Lows(dict):
    """A token as printed -> the lower-case word it counts as in pairs ('' if none), and whether it counts as a word itself. Forgotten at a bound."""

    def __missing__(self, token: str) -> tuple[str, bool]:
        t = token.strip(EDGE)
        low = t.lower() if t.isalpha() and (t.islower() or t[1:].islower() or len(t) == 1) else ""
        if len(self) > 200_000:
            self.clear()
        self[token] = out = (low, bool(low) and low == t)
        return out


_lows = _Lows()


def count_text(text: str, words: Counter, pairs: Counter, compounds: Counter) -> None:
    """Add one text's words, pairs (as tuples; '' stands between) and compounds; parts of broken words are left out."""
    skip_first = False
    lows: list[tuple[str, bool]] = []
    for line, head, page in lines_of(text):
        if head or page or not line:
            continue
        m = BREAK.search(line) if line[-1] in MARKS else None
        if "-" in line:
            compounds.update(COMPOUND.findall(line[: m.start()] if m else line))
        tokens = TOKEN.findall(line)
        lows += [_lows[t] for t in tokens[skip_first : len(tokens) - bool(m)]]
        lows.append(("", False))  # pairs end with the line
        skip_first = bool(m)
    words.update([w for w, own in lows if own])
    pairs.update([(a, b) for (a, _), (b, _) in zip(lows, lows[1:]) if a and b])


class Reader:
    """Decodes lines with the corpus' words and pairs."""

    def __init__(self, words: dict[str, int], pairs: dict[str, int], compounds: dict[str, int]):
        self.words, self.pairs, self.compounds = words, pairs, compounds
        self.total = max(1, sum(words.values()))
        self.beginnings = {w[:k] for w in words for k in range(1, len(w) + 1)}
        self.memo: dict[str, list[tuple[str, float]]] = {}
        self.known: dict[str, tuple[str, list[tuple[str, float]], bool]] = {}
        self.plain: set[str] = set()

    def candidates(self, read: str) -> list[tuple[str, float]]:
        """(printed, log probability of the channel) of every known word that up to CONFUSED different confusions turn into
        what was read, the reading itself among them: a walk through the beginnings of known words, so none is missed."""
        found = self.memo.get(read)
        if found is not None:
            return found
        best = {read: 0.0}
        # place in the reading, what is printed so far, log probability, confusions used so far (a repeated one costs half, then nothing)
        open_: list[tuple[int, str, float, tuple[tuple[str, str], ...]]] = [(0, "", 0.0, ())]
        while open_:
            i, printed, p, used = open_.pop()
            if i == len(read):
                if printed in self.words and p > best.get(printed, -99.0):
                    best[printed] = p
                continue
            if (more := printed + read[i]) in self.beginnings:
                open_.append((i + 1, more, p, used))
            for wrong, right, cost in CHANNEL.get(read[i], ()):
                if read.startswith(wrong, i) and (more := printed + right) in self.beginnings:
                    times = used.count((wrong, right))
                    q = p + (cost if not times else 0.5 * cost if times == 1 else 0.0)
                    if q > FARTHEST and (times or len(set(used)) < CONFUSED):
                        open_.append((i + len(wrong), more, q, (*used, (wrong, right))))
        found = sorted(best.items(), key=lambda x: -x[1])
        if len(self.memo) > 100_000:
            self.memo.clear()
        self.memo[read] = found
        return found

    def options(self, token: str) -> tuple[str, list[tuple[str, float]], bool]:
        """(the word without punctuation, its candidates, whether it is an ordinary lower-case word); remembered up to a bound."""
        found = self.known.get(token)
        if found is None:
            core = _clean(token)
            low = core[:1].islower() or (core[:1] and not core[:1].isalpha() and any(c.islower() for c in core))
            ordinary = low and len(core) >= 3 and not re.search(r"[.:/\\#]|@.*@|[+_].*@|^\d+(?:st|nd|rd|th|s)$|\d{3}", core) and core[-1:] not in "!" or (low and core.endswith("!") and core[:-1] not in self.words and len(core) > 4)
            options = self.candidates(core) if ordinary and self.words.get(core, 0) <= max(2, self.total / 20_000) else [(core, 0.0)]
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[token] = (core, options, bool(ordinary))
            if len(options) == 1:
                if len(self.plain) > 200_000:
                    self.plain.clear()
                self.plain.add(token)
        return found

    def decode(self, tokens: list[str]) -> list[str]:
        """Viterbi over the candidates of each word of a line."""
        choices = [self.options(t) for t in tokens]
        if all(len(options) == 1 for _, options, _ in choices):  # every word has but one reading
            return [core for core, _, _ in choices]
        paths: list[tuple[float, list[str], str]] = [(0.0, [], "")]
        for core, options, ordinary in choices:
            step: dict[str, tuple[float, list[str], str]] = {}
            for word, channel in options:
                n = self.words.get(word, 0)
                if word == core:  # the reading itself doesn't speak for itself
                    n = max(n - 1, 0) + 0.02
                source = math.log(n / self.total) if n else math.log(1e-6)
                for score, path, before in paths:
                    pair = self.pairs.get(f"{before} {word}", 0) if before and n > 1 else 0
                    b = self.words.get(before, 0)
                    link = math.log(0.5 * pair / b + 0.5 * n / self.total) if pair and b else source
                    s = score + link + channel
                    if word not in step or s > step[word][0]:
                        step[word] = (s, [*path, word], word)
            paths = list(step.values())
        return max(paths, key=lambda x: x[0])[1]

    def repair(self, text: str | None) -> tuple[str | None, set[str]]:
        """(continuous text, kinds of noise found)."""
        if not text or not text.strip():
            return text, set()
        noise: set[str] = set()
        body: list[str] = []
        rows = lines_of(text)
        gap = False
        for line, head, page in rows:
            if head or page:
                if head:
                    noise.add("header")
                if page:
                    noise.add("page_no")
                gap = True
                continue
            if gap and not line.strip():
                continue
            body.append(line)
            if line.strip():
                gap = False
        joined: list[str] = []
        carry = ""
        for i, line in enumerate(body):
            if carry and line.strip():
                line, carry = carry + line.lstrip(), ""
            m = BREAK.search(line) if line.rstrip()[-1:] in MARKS else None
            following = next((x for x in body[i + 1 :] if x.strip()), "") if m else ""
            r = re.match(r"\s*([^\W\d_][\w'’†!|$@]*)", following) if following else None
            if m and r and (m.start() == 0 or line[m.start() - 1] not in "@."):
                left, right = m[1], r[1]
                if broken(left, right, self.words, self.compounds, m[2]) or self._joins(left, right):
                    noise.add("hyphen")
                    carry = line[: m.start()] + left
                else:
                    carry = line[: m.end(2)].rstrip()
                continue
            joined.append(line)
        if carry:
            joined.append(carry)
        out = []
        for line in joined:
            if self.plain.issuperset(TOKEN.findall(line)):  # every word has but one reading
                out.append(line)
                continue
            pieces = PARTS.split(line)
            tokens = pieces[::2]
            want = [k for k, t in enumerate(tokens) if t]
            decoded = self.decode([tokens[k] for k in want])
            for k, word in zip(want, decoded):
                core = _clean(tokens[k])
                if word != core:
                    noise.add("misread")
                    tokens[k] = tokens[k].replace(core, word, 1)
            pieces[::2] = tokens
            out.append("".join(pieces))
        return paragraphs(out), noise

    def _joins(self, left: str, right: str) -> bool:
        """A broken word that is misread as well: its best reading as one word is known, as a compound it isn't."""
        if f"{left.lower()}-{right.lower()}" in self.compounds or (left.lower() in self.words and right.lower() in self.words):
            return False
        return any(w in self.words for w, _ in self.candidates(left + right))


def paragraphs(lines: list[str]) -> str:
    """Wrapped lines put together; blank lines and lines that begin a new entry or label stay apart."""
    out: list[str] = []
    width = max((len(x) for x in lines), default=0)
    for line in lines:
        s = line.strip()
        fresh = not s or not out or not out[-1] or re.match(r"[+=–—-]\s|\([+\-=]\)|[A-Z][\w ]{2,40}:", s)
        if not fresh and (s[:1].islower() or (len(out[-1]) >= 0.5 * width and out[-1][-1:] not in ".:;!?")):
            out[-1] += " " + s
        elif not fresh and len(lines) > 1 and out[-1][-1:] not in ".:;!?" and not s[:1].isupper():
            out[-1] += " " + s
        else:
            out.append(s)
    return "\n".join(out)


def _model(texts: DataFrame) -> tuple[dict[str, int], dict[str, int], dict[str, int]]:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pairs, compounds = Counter(), Counter(), Counter()
        for pdf in batches:
            for t in pdf["text"]:
                count_text(t, words, pairs, compounds)
            if len(words) + len(pairs) > 500_000:
                yield _rows(words, pairs, compounds)
                words, pairs, compounds = Counter(), Counter(), Counter()
        yield _rows(words, pairs, compounds)

    counts = texts.mapInPandas(count, "kind int, gram string, n bigint").groupBy("kind", "gram").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    totals = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    out = []
    for kind, share in ((0, WORD_SHARE), (1, PAIR_SHARE), (2, WORD_SHARE)):
        least = max(2, totals.get(kind, 0) / share)
        out.append({r["gram"]: r["n"] for r in counts.where((F.col("kind") == kind) & (F.col("n") >= least)).select("gram", "n").collect()})
    counts.unpersist()
    return out[0], out[1], out[2]


def _rows(words: Counter, pairs: Counter, compounds: Counter) -> pd.DataFrame:
    rows = [(0, w, n) for w, n in words.items()] + [(1, f"{a} {b}", n) for (a, b), n in pairs.items()] + [(2, c, n) for c, n in compounds.items()]
    return pd.DataFrame(rows, columns=["kind", "gram", "n"]).astype({"kind": "int32", "n": "int64"})


_readers: dict[str, Reader] = {}


def reader_of(name: str, model) -> Reader:
    """The reader of one model, kept by the worker process between its tasks, so each form of a word is looked at once."""
    if name not in _readers:
        _readers.clear()
        _readers[name] = Reader(*model.value)
    return _readers[name]


def repair_scans(texts: DataFrame) -> DataFrame:
    """(id, field_name, repaired, noises ARRAY<STRING>) of a table (id, field_name, text)."""
    spark = texts.sparkSession
    texts = texts.select("id", "field_name", "text").where("text IS NOT NULL").distinct()
    model = spark.sparkContext.broadcast(_model(texts.select("text")))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = reader_of(name, model)
        for pdf in batches:
            done = [reader.repair(t) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "field_name": pdf["field_name"], "repaired": [x for x, _ in done], "noises": [sorted(n) for _, n in done]})

    return texts.mapInPandas(run, "id bigint, field_name string, repaired string, noises array<string>")
