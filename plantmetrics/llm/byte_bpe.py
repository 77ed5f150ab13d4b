"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a byte string ends in exactly one token, and that token decides the rest:
strip it and look at the prefix before. So a table with one token per prefix length holds all encodings at
once. A token ``t`` that ends at position ``e`` is the last one there if ``t`` may stand after the last
token of the prefix before ``t``; two tokens may stand side by side if BPE, run on their joined bytes,
gives just these two. The table grows by appending, and after an edit only the stretch around it changes:
an entry depends on no more than the longest token's length of entries before it, so once that many agree
with the old table, the rest agrees too.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.arrow import keep_in_worker, map_columns

#: Distinct pieces a worker remembers; beyond, the older half is forgotten.
CACHE_PIECES = 400_000
#: Characters of the longest piece that is remembered.
LONGEST_KEPT = 64
#: Answers about neighbouring tokens that a worker remembers before it starts afresh.
CACHE_PAIRS = 500_000


class Vocabulary:
    """Rank table with, for each token, the two tokens BPE makes it from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.split: list[tuple[int, int]] = [(rank, rank) for rank in range(len(self.tokens))]
        self.made_from: dict[tuple[int, int], int] = {}
        self.met: dict[int, bool] = {}
        #: Longest token by its last three bytes: bounds the search backwards.
        self.reach: dict[bytes, int] = {}
        for rank, token in enumerate(self.tokens):
            end = token[-3:]
            self.reach[end] = max(self.reach.get(end, 1), len(token))
            for cut in range(len(token) - 1, 0, -1):
                left, right = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                if left < rank and right < rank and self.adjacent(left, right):
                    self.split[rank] = (left, right)
                    self.made_from[left, right] = rank
                    break
        self.longest = max(self.reach.values(), default=1)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def may_meet(self, left: int, right: int) -> bool:
        """``adjacent``, remembered."""
        key = left << 32 | right
        known = self.met.get(key)
        if known is None:
            if len(self.met) >= CACHE_PAIRS:
                self.met.clear()
            self.met[key] = known = self.adjacent(left, right)
        return known

    def adjacent(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` as they are when they meet.

        Walks back through the merges that made both, latest first: a merge across the seam that would have
        come before the later of the two is a contradiction.
        """
        bound = len(self.tokens)
        while True:
            if self.made_from.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, left = left, self.split[left][1]
                if left == bound:
                    bound, right = right + 1, self.split[right][0]
                    if right + 1 == bound:
                        return True
            else:
                bound, right = right + 1, self.split[right][0]
                if right + 1 == bound:
                    bound, left = left, self.split[left][1]
                    if left == bound:
                        return True


class PrefixTable:
    """All encodings of all prefixes of ``data``: ``last[n - 1]`` is the last token of the first n bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; entries so far stay as they are."""
        self.data += more
        self._fill(len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start to stop; returns how many entries were computed."""
        old, shift = self.last, start + len(new) - stop
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        agreed, fixed = 0, start + len(new)
        for end in range(start + 1, len(self.data) + 1):
            self._fill(end)
            agreed = agreed + 1 if end > fixed and self.last[-1] == old[end - 1 - shift] else 0
            if agreed == self.vocabulary.longest:
                self.last.extend(old[end - shift :])
                return end - start
        return len(self.data) - start

    def _fill(self, stop: int) -> None:
        """Add entries until there are ``stop``."""
        vocabulary, data, last = self.vocabulary, self.data, self.last
        rank_of, reach_of, known = vocabulary.ranks.get, vocabulary.reach.get, vocabulary.met.get
        for end in range(len(last) + 1, stop + 1):
            reach = reach_of(data[end - 3 if end > 3 else 0 : end], 2)
            for start in range(end - reach if end > reach else 0, end):
                token = rank_of(data[start:end])
                if token is not None:
                    if not start:
                        break
                    left = last[start - 1]
                    fits = known(left << 32 | token)
                    if fits or (fits is None and vocabulary.may_meet(left, token)):
                        break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")
            last.append(token)

    def tokens(self, size: int | None = None) -> list[int]:
        """The encoding of the first ``size`` bytes, all of them by default."""
        end, found = len(self.data) if size is None else size, []
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


class _Pieces(dict):
    """Piece of text -> its ids as packed little-endian integers, computed on first use."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            for old in list(islice(self, CACHE_PIECES // 2)):
                del self[old]
        ids = PrefixTable(self.vocabulary, piece.encode()).tokens()
        packed = np.array(ids, dtype="<u4").tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = packed
        return packed


class Codec:
    """Encodes and decodes whole texts; every match of ``pattern`` is a piece of its own."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find, self.pieces = vocabulary, regex.compile(pattern).findall, _Pieces(vocabulary)

    def encode_packed(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


OWNER = "byte_bpe"
_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str | None = None, pattern: str | None = None) -> Codec:
    """The codec of a rank file, built once per process and kept until another operator's task begins there."""
    import public_tokenizers

    key = (ranks_path or default_ranks(), pattern or public_tokenizers.PATTERN)
    keep_in_worker(OWNER, _codecs.clear)
    if key not in _codecs:
        _codecs[key] = Codec(Vocabulary.load(key[0]), key[1])
    return _codecs[key]


def encode_documents(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", ranks_path: str | None = None
) -> DataFrame:
    """One row per document: ``doc_id``, ``token_ids`` (array<int>), ``n_tokens``, and the digests
    ``ids_sha256`` and ``decoded_sha256`` (of the bytes that decoding the ids gives back).

    A null text counts as empty: no tokens. Rows are independent: repeated rows give repeated results, a
    null doc_id stays null, other columns are ignored, an empty table gives an empty result. Memory is
    bounded by one Arrow batch and what a worker remembers: ``CACHE_PIECES`` pieces of at most ``LONGEST_KEPT``
    characters and ``CACHE_PAIRS`` pairs, together some 100 MB, let go when another operator's task begins.
    """

    def work(ids, texts):
        coder = codec(ranks_path)
        packed = [coder.encode_packed(value or "") for value in texts]
        sizes = [len(one) // 4 for one in packed]
        flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        decoded = (coder.decode(np.frombuffer(one, dtype="<u4").tolist()) for one in packed)
        return (
            ids,
            sizes,
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            [hashlib.sha256(one).hexdigest() for one in packed],
            [hashlib.sha256(one).hexdigest() for one in decoded],
        )

    schema = "doc_id long, n_tokens long, token_ids array<int>, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs.select(F.col(doc_id).cast("long"), F.col(text)), work, schema, OWNER)


def decode_ids(df: DataFrame, *, ids: str = "token_ids", ranks_path: str | None = None) -> DataFrame:
    """``df`` with a column ``decoded`` (binary): the bytes of its ids; null ids give null."""

    from pyspark.sql.functions import pandas_udf

    @pandas_udf("binary")
    def decode(column):
        coder = codec(ranks_path)
        return column.map(lambda one: None if one is None else coder.decode(one))

    return df.withColumn("decoded", decode(F.col(ids)))
