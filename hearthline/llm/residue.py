"""Template residue and error-page text: detect documents that hold no real content, or fields left unfilled.

Trusted labels come from few, general signs only: wording that any error page, script demand, dummy text or template
uses. From there they spread, by what the corpus itself shows:

1. Words of dummy text. Words that keep company with the standard dummy words (in the same sentence) and are rarely met
   elsewhere are dummy words too; counts are taken over all documents.
2. Wording of error pages and script demands. A document that holds little beside the sign is trusted. Runs of three
   words that trusted documents have in common are residue wording (unless mostly met in documents that mention such a
   sign among real text); a document with a sign and little beside such wording is trusted as well, and so on until
   nothing changes.
3. Near-duplicates. Exact copies after normalisation (lower case, runs of digits folded) share one representative.
   Representatives are filed in partitioned SimHash tables over five-word shingles: the 64 bits fall into 6 blocks and
   each table is keyed by 3 of them (20 tables), so any two hashes within 3 bits meet in at least one table. Most pairs
   of a similarity of 0.8 are further apart, so representatives are also filed by BANDS keys of ROWS minimum hashes
   each: a pair at exactly 0.8 shares a key in 99.99 % of cases. Candidates of the tables are verified by Hamming
   distance, all candidates by the Jaccard similarity of their shingles (0.8 or more). Trusted labels spread through the
   connected components of these links: the labelled frontier is joined, newly labelled representatives form the next
   frontier, until none is left. Only labels of documents that are residue as a whole spread; a placeholder inside a
   real letter says nothing about a letter like it.

Each round writes its frontier to the shared folder, so lineage stays short and lost executors do no harm. No links,
components or fingerprints reach the driver; of dummy words at most DUMMY_SHARE travel, as each makes up at least
1 in DUMMY_SHARE of the words they are found among.

Defined results: null, empty and blank texts are no residue; texts of any length are treated whole; one label per
document, in the order error_page, script_notice, filler, placeholder; repeated doc_ids give one row; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.hashing import choices, keys_of, least_hashes, shingled, split_mix, word_hashes
from hearthline.session import written

SHINGLE, SIMILARITY, BITS = 5, 0.8, 3
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
TABLES = list(combinations(range(6), 3))
BANDS, ROWS = 24, 5
BAND_SALT, PICK = split_mix(BANDS, 71), choices(BANDS, ROWS, 3000)
LABELS = ("error_page", "script_notice", "filler", "placeholder")

#: The words of the standard dummy text that no ordinary language uses.
DUMMY_WORDS = frozenset("lorem ipsum dolor amet consectetur adipiscing eiusmod incididunt labore dolore aliqua veniam nostrud exercitation ullamco laboris aliquip consequat reprehenderit voluptate cillum fugiat pariatur excepteur occaecat cupidatat proident deserunt mollit laborum".split())
#: Short words of it that are also words of ordinary languages: they count inside a run, but don't make one.
COMMON_WORDS = frozenset("sit elit sed do tempor ut et magna enim ad minim quis nisi ex ea commodo duis aute irure in velit esse eu nulla sint non sunt culpa qui officia anim id est".split())
#: A word is a dummy word if it is this much more often among dummy words than its share of all its uses, and so frequent there.
DUMMY_PURITY, DUMMY_LEAST, DUMMY_SHARE = 0.2, 3, 2000
#: Ordinary words that a sentence of dummy text may hold.
ORDINARY_SHARE = 0.2
#: A run of dummy words: how many, how many of them that no ordinary language uses, strangers allowed in between.
RUN_WORDS, RUN_RARE, RUN_MISS = 6, 3, 1
DUMMY_PHRASES = re.compile(
    r"\b(?:(?:body text[ .]*){3,}|(?:test ){2,}test\b|(?:asdf[ ;]*){2,}|x{3,}(?: +x{3,}){2,}|your (?:paragraph|text|content) goes here|(?:sample|dummy|filler|placeholder) (?:text|copy)\b(?! (?:where|in|on|instead|that))|"
    r"(?:text|content) goes here|type (?:[a-z]+ ){1,3}in this (?:box|field)|heading one\W+subheading|draft filler|replace before publishing|the quick brown fox jumps over)",
    re.I,
)
DUMMY_HINTS = ("body text", "test test", "asdf", "xxx", "goes here", "in this box", "in this field", "sample text", "sample copy", "dummy", "placeholder", "filler", "heading one", "replace before", "quick brown fox")
#: Nouns that name a field of a template.
FIELD = (
    r"(?:name|address|date|neighbou?rhood|organi[sz]ation|planner|district|phone|zip|code|city|state|e-?mail|commissioner|number|case|project|reasons?|title|signature|company|street|subject|position|salutation|recipient|sender|"
    r"reasons?[ _]for[ _][a-z]+)"
)
NAMED = r"(?:(?!(?:no|wrong|unknown|illegible|without|missing|same|sic|not|see|is|was|the same)\b)[A-Za-z]+[ _]){0,3}" + FIELD + r"(?:[ _](?:no|line|here))?"
ANY = r"[A-Za-z][A-Za-z0-9]*(?:[ _.\-][A-Za-z0-9]+){0,5}"
PLACEHOLDER = re.compile(
    r"\{\{[ #/]*" + ANY + r" *\}\}|\$\{ *" + ANY + r" *\}|<<+ *" + ANY + r" *>>+|\[\[ *" + ANY + r" *\]\]|<%=? *" + ANY + r" *%>|\*\| *" + ANY + r" *\|\*|@@" + ANY + r"@@|##" + ANY + r"##|"
    r"\[ *(?:insert|enter|add|type|your|fill in) [A-Za-z _\-]{2,40}\]|\( *(?:insert |enter )?your [A-Za-z _\-]{2,40} (?:goes )?here *\)|\{ *[A-Za-z]+(?:_[A-Za-z]+)+ *\}|"
    r"\[ *" + NAMED + r" *\]|\{ *" + NAMED + r" *\}|< *" + NAMED + r" *>|[«‹] *" + NAMED + r" *[»›]|%" + NAMED + r"%|__+" + NAMED + r"__+",
    re.I,
)
OPENING = re.compile(r"\{|\$\{|<|«|‹|\[|\*\||@@|##|%(?=\w)|__+|\(")
#: Signs of an error page and of a demand for scripts, on text whose runs of digits are folded.
SIGNS = {
    "error_page": (
        re.compile(
            r"\b(?:http (?:error|status)(?: code)? ?0|0 (?:bad gateway|not found|forbidden|gateway time-?out|internal server error|service unavailable|unauthorized|bad request|too many requests|gone)|"
            r"(?:page|file|document|resource|site) not found|p[áa]gina no encontrada|service (?:is )?(?:temporarily |currently )?unavailable|(?:internal )?server error(?: in '[^'\n]*' application)?|"
            r"database (?:connection|error)(?: failed)?|invalid viewstate|(?:your )?session (?:has )?(?:expired|timed out)|something went wrong|access (?:is )?denied|"
            r"(?:request|connection|gateway) timed? ?-?out|too many requests|(?:document|page|file) you requested (?:could not|cannot) be (?:located|found)|permission denied|fatal error|unhandled exception)",
            re.I,
        ),
        ("http error", "http status", "not found", "bad gateway", "forbidden", "gateway time", "unavailable", "server error", "unauthorized", "bad request", "too many requests", "gone", "no encontrada", "database connection", "database error", "viewstate",
         "session expired", "session has expired", "session timed", "session has timed", "went wrong", "access denied", "access is denied", "request time", "connection time", "you requested could not be", "you requested cannot be", "permission denied", "fatal error", "unhandled exception"),
    ),
    "script_notice": (
        re.compile(
            r"(?:enable|activate|turn on|allow|activ[ea]r?) (?:java ?script|scripts?|scripting)|java ?script (?:appears to be|is|must be|seems) (?:disabled|off|required|enabled|turned off)|"
            r"requires? (?:java ?)?scripts?\b|scripts? (?:are|is) (?:turned off|disabled|required)|scripting (?:may be|is) blocked|noscript|browser does not support|(?:unsupported|outdated) browser|"
            r"cookies and scripting must be|checking your browser",
            re.I,
        ),
        ("javascript", "java script", " script", "noscript", "browser", "scripting", "script is", "script are", "scripts is", "scripts are"),
    ),
}
WORD = re.compile(r"[^\W_]+")
#: The same, but scripts that don't set words apart give a word for each character.
UNIT = re.compile(r"[\u2e80-\u9fff\uac00-\ud7af]|[^\W_\u2e80-\u9fff\uac00-\ud7af]+")
DIGITS = re.compile(r"\d+")
SENTENCE = re.compile(r"[\n.!?;|]+")
#: Different words that a document may hold beside a sign and residue wording to be trusted.
REST_WORDS = 12
#: Wording counts as residue if so many trusted documents have it, and so large a share of those with a sign that have it.
WORDING, WORDING_DOCUMENTS, WORDING_SHARE = 3, 3, 0.05


def signs_in(low: str) -> dict[str, tuple[list[str], list[bool]]]:
    """Label -> (words, whether each belongs to a sign) for the signs that occur in a text in lower case."""
    out, folded = {}, None
    for label, (sign, hints) in SIGNS.items():
        if any(h in low for h in hints):
            folded = DIGITS.sub("0", low) if folded is None else folded
            spans = [m.span() for m in sign.finditer(folded)]
            if spans:
                words, inside, k = [], [], 0
                for m in UNIT.finditer(folded):
                    while k < len(spans) and spans[k][1] <= m.start():
                        k += 1
                    words.append(m[0])
                    inside.append(k < len(spans) and spans[k][0] < m.end())
                out[label] = words, inside
    return out


def has_run(words: list[str], dummy: frozenset[str]) -> bool:
    run = rare = miss = 0
    for w in words:
        if w in dummy or w in COMMON_WORDS:
            run += 1
            rare += w not in COMMON_WORDS
            miss = 0
            if run >= RUN_WORDS and rare >= RUN_RARE:
                return True
        else:
            miss += 1
            if miss > RUN_MISS:
                run = rare = miss = 0
    return False


def label_of(text: str | None, dummy: frozenset[str] = DUMMY_WORDS, signs: dict[str, tuple[list[str], list[bool]]] | None = None) -> tuple[str | None, bool]:
    """(trusted label or None, whether the whole document is residue) of one text, by its own signs alone."""
    if not text or not text.strip():
        return None, False
    low = text.lower()
    for label, (words, inside) in (signs_in(low) if signs is None else signs).items():
        if len({w for w, i in zip(words, inside) if not i}) <= REST_WORDS:
            return label, True
    words = None
    phrase = DUMMY_PHRASES.search(low) if any(h in low for h in DUMMY_HINTS) else None
    if phrase or len(dummy.intersection(words := WORD.findall(low))) >= 2 and has_run(words, dummy):
        words = words or WORD.findall(low)
        return "filler", sum(w in dummy or w in COMMON_WORDS for w in words) >= 0.6 * len(words)
    if any(PLACEHOLDER.match(text, m.start()) for m in OPENING.finditer(text)):
        return "placeholder", False
    return None, False


# ------------------------------------------------------------------ words of dummy text


def _company(ordinary: frozenset[str]):
    """Counts of the words of sentences with standard dummy words, sentences that hold ordinary words left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                low = text.lower()
                if "lorem" in low or "ipsum" in low or sum(w in low for w in DUMMY_WORDS) >= 3:
                    for sentence in SENTENCE.split(low):
                        words = WORD.findall(sentence)
                        seeds = DUMMY_WORDS.intersection(words)
                        if len(words) >= RUN_WORDS and (len(seeds) >= 3 or "lorem" in seeds or "ipsum" in seeds) and sum(w in ordinary for w in words) <= ORDINARY_SHARE * len(words):
                            counts.update(w for w in words if w.isalpha())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return run


def _found_with(texts: DataFrame, ordinary: frozenset[str]) -> dict[str, int]:
    near = texts.mapInArrow(_company(ordinary), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).persist()
    total = near.agg(F.sum("n")).collect()[0][0] or 0
    found = {r["word"]: r["n"] for r in near.where(F.col("n") >= max(DUMMY_LEAST, total / DUMMY_SHARE)).collect()}
    near.unpersist()
    return found


def dummy_words(texts: DataFrame) -> frozenset[str]:
    """The standard dummy words and those that keep company with them, by counts over all texts of column ``text``.

    Words that are mostly met elsewhere are ordinary; a sentence that mentions dummy words among ordinary ones says nothing.
    """
    found = _found_with(texts, frozenset())
    wanted = sorted(set(found) - DUMMY_WORDS - COMMON_WORDS)
    if not wanted:
        return DUMMY_WORDS
    (_, hashes, bounds), = word_hashes(wanted)
    alone = np.diff(bounds) == 1
    order = np.argsort(hashes[bounds[:-1]])
    keys, place = hashes[bounds[:-1]][order], np.arange(len(wanted))[order]
    alone = alone[order]

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(keys), dtype=np.int64)
        for batch in batches:
            for _, h, _ in word_hashes(batch.column(0).to_pylist()):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                counts += np.bincount(at[keys[at] == h], minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(counts, pa.int64())], ["at", "n"])

    everywhere = {r["at"]: r["n"] for r in texts.mapInArrow(uses, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    uses_of = {wanted[k]: everywhere.get(k, 0) for k, ok in zip(place.tolist(), alone) if ok}
    ordinary = frozenset(w for w, n in uses_of.items() if found[w] < DUMMY_PURITY * n)
    return DUMMY_WORDS | {w for w, n in _found_with(texts, ordinary).items() if n >= DUMMY_PURITY * uses_of.get(w, n / DUMMY_PURITY + 1)}


# ------------------------------------------------------------------ one pass over the texts


def simhashes(shingles: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each set of shingles, as signed numbers; 0 for an empty set."""
    out = np.zeros(len(cut) - 1, dtype=np.int64)
    some = np.flatnonzero(np.diff(cut))
    for a in range(0, len(some), 256):
        rows = some[a : a + 256]
        lo, hi = cut[rows[0]], cut[rows[-1] + 1]
        bits = np.unpackbits(shingles[lo:hi].view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, cut[rows] - lo, axis=0, dtype=np.int64)
        out[rows] = np.packbits((2 * ones > np.diff(cut)[rows][:, None]).astype(np.uint8), axis=1).view(">i8").ravel()
    return out


def _prints(h: np.ndarray, bounds: np.ndarray) -> list[str | None]:
    """A 128-bit print of the words of each text, in order; None without words."""
    raw = h.tobytes()
    return [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).hexdigest() if a < b else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


SEEN = "doc_id bigint, label string, pure boolean, print string, simhash bigint, bands array<bigint>, signs array<struct<label: string, words: array<string>, inside: array<boolean>>>"
_SIGN = pa.struct([("label", pa.string()), ("words", pa.list_(pa.string())), ("inside", pa.list_(pa.bool_()))])


def _examine(dummy: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [signs_in(t.lower()) if t else {} for t in texts]
            labels = [label_of(t, dummy, s) for t, s in zip(texts, found)]
            signs = [[{"label": k, "words": w, "inside": i} for k, (w, i) in s.items()] for s in found]
            prints, hashes, bands = [], [], []
            for _, h, bounds in word_hashes(texts, fold_digits=True):
                shingles, cut = shingled(h, bounds, SHINGLE)
                prints += _prints(h, bounds)
                hashes.append(simhashes(shingles, cut))
                bands += list(keys_of(least_hashes(shingles, cut), PICK, BAND_SALT).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in labels], pa.string()), pa.array([x for _, x in labels], pa.bool_()), pa.array(prints, pa.string()), pa.array(np.concatenate(hashes) if hashes else [], pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.list_(_SIGN))],
                ["doc_id", "label", "pure", "print", "simhash", "bands", "signs"],
            )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each text, as bytes."""
    for batch in batches:
        sets = []
        for _, h, bounds in word_hashes(batch.column(1).to_pylist(), fold_digits=True):
            shingles, cut = shingled(h, bounds, SHINGLE)
            sets += [shingles[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the candidates whose texts are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= SIMILARITY * (len(a) + len(b) - both))
        yield batch.select(["print", "label"]).filter(pa.array(keep, pa.bool_()))


# ------------------------------------------------------------------ spreading


def trusted_by_wording(seen: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(doc_id, label) of the documents with a sign and little beside signs and residue wording."""
    signed = seen.select("doc_id", F.explode("signs").alias("s")).select("doc_id", "s.label", "s.words", "s.inside").dropDuplicates(["doc_id", "label"])
    last = F.size("words") - WORDING
    grams = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("words", i + 1, WORDING)))).otherwise(F.array(F.xxhash64("words")))
    signed = written(signed.select("doc_id", "label", "words", "inside", grams.alias("grams")), "p9-signed")
    units = written(signed.select("doc_id", "label", F.explode(F.array_distinct("grams")).alias("gram")), "p9-wording")
    words = signed.select("doc_id", "label", F.posexplode(F.arrays_zip("words", "inside")).alias("at", "w")).select("doc_id", "label", "at", "w.words", "w.inside")
    words = written(words, "p9-words")
    places = signed.select("doc_id", "label", F.posexplode("grams").alias("at", "gram"))
    trusted, known = None, -1
    for _ in range(most_rounds):
        open_words = words.where("NOT inside")
        if trusted is not None:
            wording = units.join(trusted.withColumn("t", F.lit(1)), ["doc_id", "label"], "left").groupBy("label", "gram").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n"))
            wording = wording.where((F.col("t") >= WORDING_DOCUMENTS) & (F.col("t") >= WORDING_SHARE * F.col("n"))).select("label", "gram")
            covered = places.join(wording, ["label", "gram"]).select("doc_id", "label", F.explode(F.array(*[F.col("at") + k for k in range(WORDING)])).alias("at")).distinct()
            open_words = open_words.join(covered, ["doc_id", "label", "at"], "left_anti")
        rest = open_words.groupBy("doc_id", "label").agg(F.count_distinct("words").alias("rest"))
        much = rest.where(F.col("rest") > REST_WORDS)
        trusted = written(signed.select("doc_id", "label").join(much, ["doc_id", "label"], "left_anti"), "p9-trusted")
        now = trusted.count()
        if now == known:
            return trusted
        known = now
    raise RuntimeError("residue wording did not settle")


def _tables(df: DataFrame) -> DataFrame:
    """One row per representative and table: the table's number in the high bits of the key, its three blocks below."""
    block = [F.shiftrightunsigned("simhash", start).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")) for start, width in BLOCKS]
    keys = [F.lit(k).cast("bigint") * F.lit(1 << 33) + F.shiftleft(block[a], 22) + F.shiftleft(block[b], 11) + block[c] for k, (a, b, c) in enumerate(TABLES)]
    return df.withColumn("key", F.explode(F.array(*keys)))


def rank_of(label: str):
    return F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col(label))


def find_residue(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, residue) of the documents to leave out."""
    source = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")
    seen = written(source.mapInArrow(_examine(dummy_words(source.select("text"))), SEEN), "p9-seen")
    by_wording = trusted_by_wording(seen).select("doc_id", F.col("label").alias("residue"), F.lit(True).alias("pure"))
    own = by_wording.unionByName(seen.where("label IS NOT NULL").select("doc_id", F.col("label").alias("residue"), "pure"))
    own = written(own.groupBy("doc_id").agg(F.min_by(F.struct("residue", "pure"), rank_of("residue")).alias("r")).select("doc_id", "r.*"), "p9-own")
    return own.select("doc_id", "residue").unionByName(near_labelled(source, seen, own)).dropDuplicates(["doc_id"])


def near_labelled(source: DataFrame, seen: DataFrame, own: DataFrame) -> DataFrame:
    """(doc_id, residue) of the documents without a label of their own that are linked to labelled ones."""
    reps = seen.where("print IS NOT NULL").select("doc_id", "print", "simhash", "bands").join(own, "doc_id", "left")
    best = F.min_by("residue", F.when(F.col("pure"), rank_of("residue")))
    reps = reps.groupBy("print").agg(best.alias("label"), F.max("residue").alias("any"), F.min("simhash").alias("simhash"), F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("doc_id"))
    reps = written(reps, "p9-reps")
    frontier = reps.where("label IS NOT NULL").select("print", "label", "simhash", "doc_id", "bands")
    open_reps = reps.where("any IS NULL").select("print", "simhash", "doc_id", "bands")
    labels = frontier.select("print", "label")  # copies of a representative have its label
    while True:
        tables = _tables(frontier.select("label", "simhash", F.col("doc_id").alias("from"))).withColumnRenamed("simhash", "h").join(_tables(open_reps.drop("bands")), "key")
        candidates = tables.where(F.bit_count(F.col("h").bitwiseXOR(F.col("simhash"))) <= BITS).select("print", "doc_id", "label", "from")
        left = frontier.select("label", F.col("doc_id").alias("from"), F.explode("bands").alias("key"))
        right = open_reps.select("print", "doc_id", F.explode("bands").alias("key"))
        candidates = written(candidates.unionByName(left.join(right, "key").select("print", "doc_id", "label", "from")).distinct(), "p9-candidates")
        wanted = candidates.select(F.explode(F.array("doc_id", "from")).alias("doc_id")).distinct()
        sets = source.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id bigint, shingles binary").dropDuplicates(["doc_id"])
        both = candidates.join(sets.withColumnRenamed("shingles", "set_b"), "doc_id").join(sets.select(F.col("doc_id").alias("from"), F.col("shingles").alias("set_a")), "from")
        found = both.select("print", "label", "set_a", "set_b").mapInArrow(_similar, "print string, label string").groupBy("print").agg(F.min_by("label", rank_of("label")).alias("label"))
        found = written(found, "p9-round")
        if found.isEmpty():
            break
        labels = written(labels.unionByName(found), "p9-labels")
        frontier = written(found.join(open_reps, "print").select("print", "label", "simhash", "doc_id", "bands"), "p9-frontier")
        open_reps = written(open_reps.join(found, "print", "left_anti"), "p9-open")
    return seen.select("doc_id", "print").join(labels, "print").join(own, "doc_id", "left_anti").select("doc_id", F.col("label").alias("residue"))
