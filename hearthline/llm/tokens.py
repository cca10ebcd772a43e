"""Encoding of a whole corpus with a public byte-level tokenizer.

Each pre-tokenised piece is merged with a priority queue of merge ranks over a doubly linked list of symbols. An entry
of the queue names the two symbols it would merge by their bounds; it is stale, and skipped, when either bound has
moved since. Decoding concatenates the vocabulary's byte strings. Pieces repeat in a corpus, so each worker keeps a
bounded memo of pieces already merged.

Defined results: null and empty texts give the empty list; blank texts are encoded as they are; strings that look like
special tokens are ordinary text; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces a worker remembers before it starts afresh, and the longest piece it remembers.
MEMO, MEMO_LEN = 200_000, 64
#: Characters encoded before a batch is handed on, so that very long texts don't pile up in a worker.
BATCH_CHARS = 4_000_000


def default_vocabulary() -> str:
    """Where the installed public tokenizers keep the ranks of byte_bpe_50k."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Codec:
    """Byte-level pair encoding with a queue of merge ranks over linked symbols."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.strings = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        ranks, n = self.ranks, len(data)
        if data in ranks:
            return [ranks[data]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the bound after each symbol is its successor's start
        alive = bytearray(b"\x01") * n
        queue = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, left, right, end = heapq.heappop(queue)
            if not alive[left] or after[left] != right or right >= n or not alive[right] or after[right] != end:
                continue  # stale
            after[left] = end
            alive[right] = 0
            if end < n:
                before[end] = left
                if (rank := ranks.get(data[left : after[end]])) is not None:
                    heapq.heappush(queue, (rank, left, end, after[end]))
            if (prev := before[left]) >= 0 and (rank := ranks.get(data[prev:end])) is not None:
                heapq.heappush(queue, (rank, prev, left, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        memo, out = self.memo, []
        for piece in self.pieces(text):
            ids = memo.get(piece)
            if ids is None:
                ids = tuple(self.merge(piece.encode("utf-8", "replace")))
                if len(piece) <= MEMO_LEN:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[piece] = ids
            out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.strings[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path)


def encode_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids ARRAY<INT>) of every row."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            start = 0
            while start < len(texts):
                stop, chars, parts, bounds = start, 0, [], [0]
                while stop < len(texts) and (chars < BATCH_CHARS):
                    ids = encode(texts[stop])
                    parts.append(np.array(ids, dtype=np.int32))
                    bounds.append(bounds[-1] + len(ids))
                    chars += len(texts[stop] or "")
                    stop += 1
                values = np.concatenate(parts) if parts else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(start, stop - start), lists], ["doc_id", "ids"])
                start = stop

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def token_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, size INT): the number of tokens of every row, without moving the ids out of the worker."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            sizes = [len(encode(text)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], ["doc_id", "size"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, size int")
