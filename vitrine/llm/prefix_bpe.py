"""Byte-level BPE by prefix dynamic programming.

A byte string has one valid encoding, and all its prefixes do. The last token of the encoding of
every prefix is stored: position i ends with the one token t (of those that end there) whose
pair with the last token before it is stable, that is, merging the bytes of both gives just these
two tokens back. Whether a pair is stable only depends on the tokens that stand at the seam while
both are built: merges happen in the order of ranks, and the pair is stable if none of the merges
over the seam is due before the merge that next takes one of its two sides away. The encoding is read off backwards. Since a position depends only on earlier
ones, bytes can be appended without touching what is stored, and after an edit positions are
recomputed only until the last tokens agree with the old ones for as many bytes as the longest
token has.

Texts are cut by the tokenizer's pattern first, each match is encoded on its own, and ids of short
matches are kept in a bounded cache per worker; the vocabulary (a fixed file) is read once per
worker. Documents are mapped one by one: no shuffle, no hot keys, nothing collected.

Rows: a null text is empty and has no tokens; a null id is carried along; repeated rows get the
same result; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workers import ship_package
from .common import text_or_empty

CACHE_ENTRIES = 1_000_000
CACHE_BYTES = 48  # longer matches are not kept


class Vocabulary:
    """Ranks of byte strings, read from a tiktoken rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.longest = max(map(len, ranks), default=1)
        self.stable: dict[int, bool] = {}
        self.seams: dict[int, tuple[list[int], list[int]]] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))})

    def is_stable(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends in these two tokens."""
        key = left << 32 | right
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) >= CACHE_ENTRIES:
                self.stable.clear()
            known = self.stable[key] = self._stable(self._seam(left)[1], self._seam(right)[0])
        return known

    def _stable(self, left: list[int], right: list[int]) -> bool:
        i = j = 0
        never = len(self.bytes_of)
        while True:
            left_due = left[i + 1] if i + 1 < len(left) else never
            right_due = right[j + 1] if j + 1 < len(right) else never
            over = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]], never)
            # Of equal ranks the leftmost merge comes first.
            if over < left_due and over <= right_due and over < never:
                return False
            if left_due == right_due == never:
                return True
            if left_due <= right_due:
                i += 1
            else:
                j += 1

    def _seam(self, token: int) -> tuple[list[int], list[int]]:
        """The tokens at the left and at the right end of a token while it is built, first to last."""
        known = self.seams.get(token)
        if known is None:
            text = self.bytes_of[token]
            if len(text) == 1:
                known = [token], [token]
            else:
                a, b = self.merge(text, 2)
                known = [*self._seam(a)[0], token], [*self._seam(b)[1], token]
            self.seams[token] = known
        return known

    def merge(self, text: bytes, until: int = 1) -> list[int]:
        """Plain merging, lowest rank first, down to ``until`` tokens."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > until:
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min((r for r in ranked if r[0] is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]


class PrefixEncoding:
    """The encoding of one byte string, kept as the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary = vocabulary
        self.text = b""
        self.last: list[int] = [-1]
        self.append(text)

    def _last_at(self, end: int) -> int:
        """The last token of the prefix of ``end`` bytes."""
        v, text, last = self.vocabulary, self.text, self.last
        for size in range(min(end, v.longest), 0, -1):
            token = v.ranks.get(text[end - size : end])
            if token is not None:
                before = last[end - size]
                if before == -1 or v.is_stable(before, token):
                    return token
        raise ValueError("the vocabulary does not hold every byte")

    def append(self, more: bytes) -> None:
        """Add bytes at the end; nothing stored before changes."""
        start = len(self.text)
        self.text += more
        for end in range(start + 1, len(self.text) + 1):
            self.last.append(self._last_at(end))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start..stop; returns how many positions were recomputed."""
        old_last, shift = self.last, len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        self.last = old_last[: start + 1]
        agreed = 0
        for end in range(start + 1, len(self.text) + 1):
            token = self._last_at(end)
            self.last.append(token)
            agreed = agreed + 1 if end > start + len(new) and token == old_last[end - shift] else 0
            if agreed >= self.vocabulary.longest:
                self.last += old_last[end - shift + 1 :]
                return end - start
        return len(self.text) - start

    def ids(self) -> list[int]:
        found, at = [], len(self.text)
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[self.last[at]])
        return found[::-1]


class Encoder(dict):
    """Match of the pattern -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        super().__init__()
        self.vocabulary = vocabulary
        self.matches = regex.compile(pattern).findall

    def __missing__(self, match: str) -> bytes:
        text = match.encode()
        whole = self.vocabulary.ranks.get(text)
        found = [whole] if whole is not None else PrefixEncoding(self.vocabulary, text).ids()
        packed = np.array(found, dtype="<u4").tobytes()
        if len(text) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, packed."""
        return b"".join(map(self.__getitem__, self.matches(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(Vocabulary.read(path), pattern)
    return _encoders[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep``, n_tokens and ids (array of int) of every row's whole text."""
    ship_package(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*keep, text_or_empty(text_col))
    kept = len(keep)  # columns go by their place, so that names may repeat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            packed = [coder.encode(t) for t in batch.column(kept).to_pylist()]
            counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(counts), ids], names=[*keep, "n_tokens", "ids"])

    return source.mapInArrow(run, source.select(*keep, F.lit(0).cast("long").alias("n_tokens"), F.array().cast("array<int>").alias("ids")).schema)


def digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, so that no ids travel."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                packed = coder.encode(text.as_py())
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    wanted = source.select(id_col, F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256"))
    return source.mapInArrow(run, wanted.schema)
