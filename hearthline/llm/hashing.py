"""Hashes of words, shingles and sets of many texts at once, on arrays instead of per word.

Words are maximal runs of letters and digits, lower-cased. A word's hash is a polynomial over its UTF-8 bytes (each byte
first turned into a random 64-bit number) modulo 2^64, taken from running sums over the whole batch, then mixed. Texts
beyond ASCII are cut into words by a pattern first; their bytes then go the same way, so equal words hash alike.

Minimum hashes come from one-permutation hashing: a set is hashed ROUNDS times, each hash falls into one of BINS bins,
and the least value of each bin is kept. A bin that stays empty takes the value of the first filled one in a fixed order
of its own, so two sets agree in a bin with about the probability of their Jaccard similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORD = re.compile(r"[^\W_]+")
_MASK = (1 << 64) - 1
#: Bytes of text that are hashed together; a longer text is hashed whole.
CHUNK = 1 << 18
ROUNDS, BINS = 8, 56


def split_mix(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    out, x = [], seed
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append(z ^ (z >> 31))
    return np.array(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers in place."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_PART = _LETTER & (_BYTES < 128) | _DIGIT | (_BYTES >= 128)
_FOLDED = np.where(_LETTER & (_BYTES < 128), _BYTES | 32, _BYTES)
#: A random number for each byte of a word, the same for upper and lower case, 0 between words.
_VALUE = np.where(_PART, split_mix(256, 71)[_FOLDED] | np.uint64(1), np.uint64(0)).astype(np.uint64)
_RADIX = int(split_mix(1, 83)[0]) | 1
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _table(k: int, n: int) -> np.ndarray:
    """Powers of the radix (k = 0) or of its inverse (k = 1), at least ``n`` of them."""
    if len(_powers[k]) < n:
        size = 1 << max(n - 1, CHUNK).bit_length()
        base = np.full(size, _RADIX if k == 0 else pow(_RADIX, -1, 1 << 64), dtype=np.uint64)
        base[0] = 1
        _powers[k] = np.multiply.accumulate(base)
    return _powers[k][:n]


_BEYOND = re.compile(r"[^\x00-\x7f]+")


class _Lowered(dict):
    """Characters beyond ASCII -> the letters and digits among them in lower case, a blank for each other one."""

    def __missing__(self, run: str) -> str:
        out = "".join([c.lower() if WORD.match(c) else " " for c in run])
        if len(self) > 10_000:
            self.clear()
        self[run] = out
        return out


_lowered = _Lowered()


def _encoded(text: str) -> bytes:
    if text.isascii():
        return text.encode()
    if "Σ" in text:  # the one letter whose lower case depends on what follows
        text = " ".join([w.lower() for w in WORD.findall(text)])
    else:
        text = _BEYOND.sub(lambda m: _lowered[m[0]], text)
    return text.encode("utf-8", "replace")


def word_hashes(texts: list[str | None], fold_digits: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first place, hashes, bounds) of consecutive texts: the hashes of their words end to end, text i at bounds[i]..bounds[i+1].

    With ``fold_digits`` every run of digits counts as one 0.
    """
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = _encoded(text) if text else b""
        if held and size + len(raw) > CHUNK:
            yield first, *_hashed(held, fold_digits)
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, *_hashed(held, fold_digits)


def _hashed(held: list[bytes], fold_digits: bool) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) + 1 for x in held])
    buf = np.frombuffer(b" ".join(held) + b" ", dtype=np.uint8)
    if fold_digits:
        digit = _DIGIT[buf]
        keep = np.append(True, ~(digit[1:] & digit[:-1]))
        buf = np.where(digit, np.uint8(48), buf)[keep]
        ends = np.cumsum(keep)[ends - 1]
    value = _VALUE[buf]
    part = value != 0
    value *= _table(0, len(buf))
    sums = np.cumsum(value, dtype=np.uint64)
    step = np.diff(part.view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    h = np.diff(sums[stops], prepend=np.uint64(0)) * _table(1, len(buf))[starts]
    return mix(h), np.append(0, np.searchsorted(starts, ends))


def shingled(h: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds): the distinct runs of ``length`` words of each text, sorted, end to end. A shorter text that has words is one run."""
    n = np.diff(bounds)
    runs = np.where(n > 0, np.maximum(n - length + 1, 1), 0)
    cut = np.append(0, np.cumsum(runs))
    at = np.arange(cut[-1]) + np.repeat(bounds[:-1] - cut[:-1], runs)
    odd = split_mix(length, 53) | np.uint64(1)
    short = np.repeat(n < length, runs)
    last = np.repeat(bounds[1:], runs)
    x = h[at] * odd[0]
    whole = not short.any()
    for k in range(1, length):
        if whole:
            x += h[at + k] * odd[k]
        else:
            inside = at + k < last
            x[inside] += h[at[inside] + k] * odd[k]
    mix(x)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        x[a:b].sort()
    new = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    new[cut[:-1][runs > 0]] = True
    return x[new], np.append(0, np.cumsum(new))[cut]


_TURN = split_mix(ROUNDS, 97) | np.uint64(1)
EMPTY = np.uint32(0xFFFFFFFF)
#: For each bin, the order in which it looks for a filled one: the others of its round, then all rounds share the same.
_ORDER = np.array([np.argsort(split_mix(BINS, 500 + b)) for b in range(BINS)])


def least_hashes(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """ROUNDS x BINS minimum hashes of each set, one row a set; all EMPTY for an empty set."""
    sets = len(bounds) - 1
    row = np.repeat(np.arange(sets, dtype=np.int64) * BINS, np.diff(bounds))
    out = np.empty((sets, ROUNDS, BINS), dtype=np.uint32)
    for r in range(ROUNDS):
        x = shingles * _TURN[r]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        at = row + ((x >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        least = np.full(sets * BINS, EMPTY, dtype=np.uint32)
        np.minimum.at(least, at, x.astype(np.uint32))
        out[:, r] = least.reshape(sets, BINS)
    for r in range(ROUNDS):
        table = out[:, r]
        i, b = np.nonzero(table == EMPTY)
        if len(i):
            held = table.copy()
            for k in range(BINS):
                got = held[i, _ORDER[b, k]]
                table[i, b] = got
                left = got == EMPTY
                i, b = i[left], b[left]
                if not len(i):
                    break
    return out.reshape(sets, ROUNDS * BINS)


def keys_of(least: np.ndarray, pick: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set and each choice of minimum hashes in ``pick`` (keys x rows)."""
    s = np.broadcast_to(salt, (len(least), len(pick))).copy()
    for r in range(pick.shape[1]):
        s ^= least[:, pick[:, r]]
        s *= np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return s


def choices(keys: int, rows: int, seed: int) -> np.ndarray:
    """``keys`` fixed choices of ``rows`` of the minimum hashes."""
    return np.array([np.argsort(split_mix(ROUNDS * BINS, seed + b))[:rows] for b in range(keys)])
