"""Near-duplicate records with small edits: all pairs whose word shingles are similar enough.

1. One pass over all records hashes the words of each text, forms its shingle set and draws BANDS signatures, each over
   ROWS minimum hashes of the whole set. Nothing is left out of a set, however common, so a drive of any size is seen.
   Two sets of similarity s agree on a signature with probability s^ROWS: a pair at exactly 0.5 shares one of the BANDS
   in 99.9 % of cases, a more similar one more often, while unrelated records (0.04 on average) hardly ever do.
   Signatures are packed per target partition (sorted, delta-coded) before the shuffle; equal ones yield candidates.
   One bit of each of AGREE_BITS minimum hashes travels along: two similar records agree in (1 + s) / 2 of them, so
   most pairs of unrelated records are dropped where they meet (a margin of 4.5 standard deviations is left).
   The same pass writes a sketch of every record (below), so that texts are not read again for it.
2. Pigeonring filtering. The shingle set of a record is folded into a bit vector (each shingle flips one bit), cut into
   a ring of segments. Two sets of sizes a and b with a Jaccard similarity of t or more differ in at most
   T = (a + b)(1 - t) / (1 + t) shingles, so their vectors differ in at most T bits. By the pigeonring principle some
   chain of consecutive segments then keeps every one of its prefixes within its proportional budget (l segments: at
   most l T / m differences). Candidates without such a chain are pruned, then those over T in the full Hamming check.
   Folding never adds differences, so no similar pair is lost here.
3. What is left is verified on the shingle sets themselves, of which only those still wanted are moved. Sets are
   compared by SET_BYTES bytes of each hash: two different shingles of a pair agree by chance in one of 10^7 pairs.

The recall of step 1 is probabilistic: measured against brute force in the README. Records with equal texts share one
64-bit handle throughout; membership expands at the end, because the result is defined on ids. The number of partitions
follows from the number of records, so what one task holds doesn't grow with the table. Signatures and texts shared by
very many records are paired in blocks (``pairs_within``), so no key, however hot, is paired in one task.

Defined results: null texts and texts of fewer than MIN_WORDS words are in no pair; repeated ids count once; ids with
equal texts pair with each other; whole texts are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.hashing import choices, keys_of, least_hashes, shingled, split_mix, word_hashes
from hearthline.operators.relational import pairs_within
from hearthline.session import written

SHINGLE, THRESHOLD, MIN_WORDS = 3, 0.5, 30
#: Signatures a record and minimum hashes a signature.
BANDS, ROWS = 256, 5
#: Minimum hashes of which one bit is compared where two records meet, and the margin in standard deviations.
AGREE_BITS, MARGIN = 256, 4.5
SKETCH_WORDS, CHAIN = 8, 3
#: Records that share a signature before it is paired in blocks, bytes of a signature kept, records a partition.
HOT, SIGNATURE_BYTES, PARTITION_RECORDS = 2048, 6, 16_384
#: Bytes of each shingle hash that the last check compares.
SET_BYTES = 5
BAND_SALT, PICK = split_mix(BANDS, 37), choices(BANDS, ROWS, 1000)


def sets_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``texts``, shingles, bounds): the distinct shingles of each text of enough words, sorted, end to end."""
    for first, h, bounds in word_hashes(texts):
        shingles, cut = shingled(h, bounds, SHINGLE)
        enough = np.diff(bounds) >= MIN_WORDS
        if not enough.all():
            sizes = np.diff(cut)
            shingles, cut = shingles[np.repeat(enough, sizes)], np.append(0, np.cumsum(sizes[enough]))
        if enough.any():
            yield first + np.flatnonzero(enough), shingles, cut


def sketches(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each set folded into SKETCH_WORDS x 64 bits: each shingle flips one bit. One row of words a set."""
    bits, out = SKETCH_WORDS * 64, []
    slot = ((shingles >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)
    for i in range(0, len(bounds) - 1, 512):
        part = bounds[i : i + 513]
        rows = np.repeat(np.arange(len(part) - 1), np.diff(part))
        flips = np.bincount(rows * bits + slot[part[0] : part[-1]], minlength=(len(part) - 1) * bits)
        out.append(np.packbits((flips & 1).astype(np.uint8)).view(">i8").astype(np.int64).reshape(-1, SKETCH_WORDS))
    return np.concatenate(out)


SKETCH = [f"w{k}" for k in range(SKETCH_WORDS)]
PACKED = pa.schema([("part", pa.int32()), ("sigs", pa.binary()), ("at", pa.binary()), ("whos", pa.binary()), ("ns", pa.binary()), ("words", pa.binary()), ("bits", pa.binary())])


def _pack(parts: int):
    """Signatures and sketches of a batch by target partition: signatures as sorted steps with places in the batch's handles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            handles, texts = _once(batch)
            held, size = [], 0
            for at, shingles, bounds in sets_of(texts):
                least = least_hashes(shingles, bounds)
                sig = keys_of(least, PICK, BAND_SALT) >> np.uint64(64 - 8 * SIGNATURE_BYTES)
                bits = np.packbits((least[:, :AGREE_BITS] & 1).astype(np.uint8), axis=1)
                held.append((handles[at], np.diff(bounds).astype(np.int32), sig, sketches(shingles, bounds), bits))
                size += len(at)
                if size > 30_000:  # places have 16 bits; a chunk has far fewer texts
                    yield packed_rows(*map(np.concatenate, zip(*held)), parts, squeeze)
                    held, size = [], 0
            if held:
                yield packed_rows(*map(np.concatenate, zip(*held)), parts, squeeze)

    return run


def _once(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str | None]]:
    """The handles of a batch and its texts, repeated ones left out."""
    handles = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = batch.column(1).to_pylist()
    _, once = np.unique(handles, return_index=True)
    if len(once) < len(texts):
        first = set(once.tolist())
        texts = [t if i in first else None for i, t in enumerate(texts)]
    return handles, texts


def packed_rows(who: np.ndarray, n: np.ndarray, sig: np.ndarray, folded: np.ndarray, bits: np.ndarray, parts: int, squeeze: zstandard.ZstdCompressor) -> pa.RecordBatch:
    key = ((sig << np.uint64(16)) | np.arange(len(who), dtype=np.uint64)[:, None]).ravel()
    key.sort()
    sig, place = key >> np.uint64(16), (key & np.uint64(0xFFFF)).astype(np.uint16)
    cuts = np.searchsorted(sig, _floors(parts))
    home = who % parts
    rows = []
    for p in range(parts):
        a, b = cuts[p], cuts[p + 1]
        mine = np.flatnonzero(home == p)
        used, local = np.unique(place[a:b], return_inverse=True) if parts > 32 else (np.arange(len(who)), place[a:b])
        step = np.diff(sig[a:b], prepend=np.uint64(0))
        planes = step.view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES].T
        heads = np.concatenate([who[used], who[mine]])
        rows.append((p, squeeze.compress(np.ascontiguousarray(planes).tobytes()), local.astype(np.uint16).tobytes(), heads.tobytes(), n[mine].tobytes(), folded[mine].tobytes(), bits[used].tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PACKED.types)], schema=PACKED)


def _floors(parts: int) -> np.ndarray:
    """The least signature of each partition, and one beyond the last."""
    return np.array([(p << (8 * SIGNATURE_BYTES)) // parts for p in range(parts + 1)], dtype=np.uint64)


MET = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("sig", pa.int64()), ("n", pa.int32()), *((w, pa.int64()) for w in SKETCH)])


def _met(x=None, y=None, sig=None, n=None, words=None) -> pa.RecordBatch:
    size = len(x)
    columns = [x, y, sig, n, *(words.T if words is not None else [None] * SKETCH_WORDS)]
    return pa.RecordBatch.from_arrays([pa.nulls(size, t) if c is None else pa.array(c, t) for c, t in zip(columns, MET.types)], schema=MET)


def _meet(threshold: float):
    agree = (1 + threshold) / 2
    most = AGREE_BITS - int(AGREE_BITS * agree - MARGIN * (AGREE_BITS * agree * (1 - agree)) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidate pairs (x, y) of one partition; (x, sig) where too many share one; sketches (x, n, words) passed through."""
        expand = zstandard.ZstdDecompressor()
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            for p, blob, at, whos, ns, folded, bits in zip(*(batch.column(k).to_pylist() for k in range(7))):
                planes = np.frombuffer(expand.decompress(blob), dtype=np.uint8).reshape(SIGNATURE_BYTES, -1)
                step = np.zeros((planes.shape[1], 8), dtype=np.uint8)
                step[:, :SIGNATURE_BYTES] = planes.T
                n, heads = np.frombuffer(ns, dtype=np.int32), np.frombuffer(whos, dtype=np.int64)
                known, mine = np.split(heads, [len(heads) - len(n)])
                held = parts.setdefault(p, [])
                base = sum(len(h[2]) for h in held)
                held.append((np.cumsum(step.view(np.uint64).ravel(), dtype=np.uint64), np.frombuffer(at, dtype=np.uint16) + np.int64(base), known, np.frombuffer(bits, dtype=np.uint64).reshape(-1, AGREE_BITS // 64)))
                if len(n):
                    yield _met(x=mine, n=n, words=np.frombuffer(folded, dtype=np.int64).reshape(-1, SKETCH_WORDS))
        for p in sorted(parts):
            yield from _met_in(*map(np.concatenate, zip(*parts.pop(p))), most)

    return run


def _met_in(sigs: np.ndarray, at: np.ndarray, whos: np.ndarray, bits: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """What meets among the signatures of one partition: ``at`` says which of ``whos`` a signature is of."""
    values = np.sort(sigs)  # a signature that one record has is of no use
    values = values[1:][values[1:] == values[:-1]]
    if not len(values):
        return
    shared = values[np.minimum(np.searchsorted(values, sigs), len(values) - 1)] == sigs
    sigs, at = sigs[shared], at[shared]
    whos, first, same = np.unique(whos, return_index=True, return_inverse=True)
    bits, ids = bits[first], same[at]
    order = np.lexsort((ids, sigs))
    sigs, ids = sigs[order], ids[order]
    new = np.append(True, (sigs[1:] != sigs[:-1]) | (ids[1:] != ids[:-1]))[: len(sigs)]  # copies count once
    sigs, ids = sigs[new], ids[new]
    first = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1])[: len(sigs)])
    size = np.diff(np.append(first, len(sigs)))
    found, count = [], 0
    for n in np.unique(size[size > 1]):
        starts = first[size == n]
        if n > HOT:
            for a in starts:
                for b in range(a, a + n, 50_000):
                    who = whos[ids[b : min(b + 50_000, a + n)]]
                    yield _met(x=who, sig=np.full(len(who), sigs[a], dtype=np.int64))
            continue
        upper = np.triu_indices(n, 1)
        block = max(1, 1_000_000 // len(upper[0]))
        for c in range(0, len(starts), block):
            row = starts[c : c + block, None]
            pair = np.unique(ids[row + upper[0]].ravel() << 32 | ids[row + upper[1]].ravel())  # ids ascend within a signature
            differ = np.bitwise_count(bits[pair >> 32] ^ bits[pair & 0xFFFFFFFF]).sum(axis=1)
            found.append(pair[differ <= most])
            count += len(found[-1])
            if count > 2_000_000:
                pair = np.unique(np.concatenate(found))
                yield _met(x=whos[pair >> 32], y=whos[pair & 0xFFFFFFFF])
                found, count = [], 0
    if found:
        pair = np.unique(np.concatenate(found))
        yield _met(x=whos[pair >> 32], y=whos[pair & 0xFFFFFFFF])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        who, texts = _once(batch)
        for at, shingles, bounds in sets_of(texts):
            sets = [packed_set(shingles[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(who[at], pa.int64()), pa.array(sets, pa.binary())], ["who", "shingles"])


def packed_set(shingles: np.ndarray) -> bytes:
    """The upper SET_BYTES bytes of each hash of a sorted set; still sorted, each once."""
    upper = shingles >> np.uint64(64 - 8 * SET_BYTES)
    if len(upper) > 1 and not (upper[1:] != upper[:-1]).all():
        upper = np.unique(upper)
    return upper.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def unpacked_set(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // SET_BYTES, 8), dtype=np.uint8)
    out[:, :SET_BYTES] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, SET_BYTES)
    return out.view(np.uint64).ravel()


def shared_size(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values have in common."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, a = [], None, None
            for x, y in zip(batch.column("x_set").to_pylist(), batch.column("y_set").to_pylist()):
                if x is not last:
                    last, a = x, unpacked_set(x)
                b = unpacked_set(y)
                both = shared_size(a, b)
                keep.append(both >= threshold * (len(a) + len(b) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _pigeonring(threshold: float):
    """Keep the candidates that pass the ring and the full Hamming check. Columns x, y, x_n, y_n, x_w.., y_w.."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("x_n").to_numpy().astype(np.int64) + batch.column("y_n").to_numpy()
            keep = ring_passes(
                np.stack([batch.column(f"x_{w}").to_numpy() for w in SKETCH]),
                np.stack([batch.column(f"y_{w}").to_numpy() for w in SKETCH]),
                np.floor(n * ((1 - threshold) / (1 + threshold)) + 1e-9),
            )
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def ring_passes(x: np.ndarray, y: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """For each column of two sketches: does some chain of CHAIN consecutive segments of the ring keep each prefix within
    its proportional share of the budget, and the whole the budget?"""
    differ = np.bitwise_count((x ^ y).view(np.uint64)).astype(np.int64)
    m = len(differ)
    found = np.zeros(differ.shape[1], dtype=bool)
    for i in range(m):
        within, total = np.ones_like(found), np.zeros(differ.shape[1], dtype=np.int64)
        for k in range(min(CHAIN, m)):
            total = total + differ[(i + k) % m]
            within &= total * m <= budget * (k + 1)
        found |= within
    return found & (differ.sum(axis=0) <= budget)


def near_duplicates(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id_a, id_b) of all records (id STRING, text STRING) with a shingle similarity of ``threshold`` or more, the smaller id first."""
    spark = records.sparkSession
    source = records.select("id", "text").where("text IS NOT NULL AND id IS NOT NULL")
    handle = F.xxhash64("text")  # copies of a text share it
    reps = source.select(handle.alias("who"), "text")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-records.select("id").count() // PARTITION_RECORDS))

    packed = reps.mapInArrow(_pack(parts), "part int, sigs binary, at binary, whos binary, ns binary, words binary, bits binary")
    schema = "x bigint, y bigint, sig bigint, n int, " + ", ".join(f"{w} bigint" for w in SKETCH)
    met = written(packed.repartitionById(parts, "part").mapInArrow(_meet(threshold), schema), "p1-met")
    hot = pairs_within(met.where("sig IS NOT NULL").select("sig", "x").distinct(), ["sig"], "x", HOT).select(F.col("x_a").alias("x"), F.col("x_b").alias("y"))
    pairs = met.where("y IS NOT NULL").select("x", "y").unionByName(hot).distinct()

    folded = met.where("n IS NOT NULL").select("x", "n", *SKETCH).dropDuplicates(["x"])
    for side in ("x", "y"):
        pairs = pairs.join(folded.select(F.col("x").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("n", *SKETCH))), side)
    near = written(pairs.mapInArrow(_pigeonring(threshold), "x bigint, y bigint"), "p1-near")

    wanted = near.select(F.explode(F.array("x", "y")).alias("who")).distinct()
    sets = reps.join(wanted, "who", "left_semi").mapInArrow(_sets, "who bigint, shingles binary").dropDuplicates(["who"])
    similar = near.join(sets.select(F.col("who").alias("y"), F.col("shingles").alias("y_set")), "y").join(sets.select(F.col("who").alias("x"), F.col("shingles").alias("x_set")), "x")
    similar = similar.select("x", "y", "x_set", "y_set").mapInArrow(_verify(threshold), "x bigint, y bigint")

    members = source.select("id", handle.alias("who")).distinct()
    ids = members.join(similar.select(F.col("x").alias("who"), "y"), "who").select(F.col("id").alias("a"), F.col("y").alias("who"))
    across = ids.join(members, "who").select("a", F.col("id").alias("b"))
    copies = members.join(folded.select(F.col("x").alias("who")), "who", "left_semi")
    copies = pairs_within(copies, ["who"], "id", HOT).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    # an id that comes with two texts could pair with itself or twice
    return across.where("a <> b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).unionByName(copies.select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))).distinct()
