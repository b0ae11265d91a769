"""Byte-level BPE encoding and decoding with a rank file.

Distinct pre-tokens of an Arrow batch are bucketed by length into padded
numpy matrices.  In each round every row merges its leftmost minimum-rank
pair; pair ranks come from an open-addressing hash table, and rows without a
pair left are compacted away.  Spark distributes the texts; nothing is
shuffled."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

NO_RANK = np.int32(2**31 - 1)
LONG_PIECE = 256          # bytes; longer pre-tokens are merged with a heap, not in a matrix
CACHE_ENTRIES = 1_200_000   # chunks remembered by one Python worker

ASCII_CHUNK = regex.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+$")
WIDE_SPACE = regex.compile(r"[\x85\xa0  -     　]")


class PairTable:
    """Rank of the concatenation of two tokens, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        slot, left = self._home(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]          # the last writer of a slot wins it
            won = self.keys[at] == keys[left]
            self.ranks[at[won]] = ranks[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where it is no token; negative ids are padding."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._home(keys[todo])
        while len(todo):
            seen = self.keys[slot]
            hit = seen == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            more = ~hit & (seen != -1)
            todo, slot = todo[more], (slot[more] + 1) & self.mask
        return out.reshape(shape)


class Encoder:
    """Vocabulary of a rank file plus the caches of one Python worker."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {v: k for k, v in self.rank.items()}
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        keys, ranks = [], []
        for word, rank in self.rank.items():
            for cut in range(1, len(word)):
                a, b = self.rank.get(word[:cut]), self.rank.get(word[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    ranks.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(ranks, np.int32))
        self.chunks: dict[str, bytes] = {}

    # -- merging -----------------------------------------------------------
    def merge_matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Little-endian uint32 ids of pieces of at most ``width`` bytes, all merged together."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < sizes[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(pieces))
        out: list[bytes] = [b""] * len(pieces)

        def finish(which: np.ndarray) -> None:
            real = ids[which] >= 0
            flat = ids[which][real].astype("<u4").tobytes()
            ends = (real.sum(axis=1).cumsum() * 4).tolist()
            lo = 0
            for r, hi in zip(rows[which].tolist(), ends):
                out[r] = flat[lo:hi]
                lo = hi

        while ids.shape[1] > 1:
            best = ranks.argmin(axis=1)                      # argmin takes the leftmost
            least = ranks[np.arange(len(ids)), best]
            done = least == NO_RANK
            if done.any():
                finish(done)
                ids, ranks, rows, best, least = ids[~done], ranks[~done], rows[~done], best[~done], least[~done]
            n, w = ids.shape
            if not n:
                return out
            at = np.arange(n)
            ids[at, best] = least
            keep = np.ones((n, w), bool)
            keep[at, best + 1] = False
            ids = ids[keep].reshape(n, w - 1)                # every row loses one column
            keep = np.ones((n, w - 1), bool)
            keep[at, best] = False
            ranks = ranks[keep].reshape(n, w - 2)
            if w > 2:
                right = best < w - 2
                ranks[at[right], best[right]] = self.pairs.lookup(ids[at[right], best[right]],
                                                                  ids[at[right], best[right] + 1])
                left = best > 0
                ranks[at[left], best[left] - 1] = self.pairs.lookup(ids[at[left], best[left] - 1],
                                                                    ids[at[left], best[left]])
        finish(np.ones(len(ids), bool))
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a heap of (rank, place)."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        words = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < len(ids) and (r := self.rank.get(words[i] + words[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue                                     # one side has merged meanwhile
            ids[i], words[i], ids[j] = r, words[i] + words[j], -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian uint32 ids of distinct pre-tokens."""
        out: dict[bytes, bytes] = {}
        buckets: dict[int, list[bytes]] = {}
        for p in pieces:
            whole = self.rank.get(p)
            if whole is not None:
                out[p] = whole.to_bytes(4, "little")
            elif len(p) > LONG_PIECE:
                out[p] = self.merge_long(p).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(p) + 3) // 4 * 4, []).append(p)
        for width, group in buckets.items():
            for lo in range(0, len(group), 1 << 14):
                part = group[lo:lo + (1 << 14)]
                out.update(zip(part, self.merge_matrix(part, width)))
        return out

    # -- texts -------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """Chunks that encode independently: a pre-token never crosses from a
        non-space to white space.  A text with white space beyond ASCII is one
        chunk, as its runs of spaces must be seen whole."""
        if not text.isascii() and WIDE_SPACE.search(text):
            return [text]
        return ASCII_CHUNK.findall(text)

    def encode_batch(self, texts: Iterable[str]) -> Iterator[bytes]:
        parts = [self.split(t) for t in texts]
        missing = {c for p in parts for c in p if c not in self.chunks}
        if len(self.chunks) + len(missing) > CACHE_ENTRIES:
            missing = {c for p in parts for c in p}
            self.chunks = {}
        todo = list(missing)
        pieces = [[x.encode() for x in self.pattern.findall(c)] for c in todo]
        known = self.encode_pieces(list({x for p in pieces for x in p}))
        for c, p in zip(todo, pieces):
            self.chunks[c] = b"".join([known[x] for x in p])
        get = self.chunks.__getitem__
        for p in parts:
            yield b"".join(map(get, p))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(rank_file: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    key = (rank_file, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(rank_file, pattern)
    return _ENCODERS[key]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids binary): little-endian uint32 ids of every whole text.

    A null text counts as empty and has no ids; repeated rows are encoded each;
    other columns are not carried.  Rank files must hold all 256 single bytes."""
    def run(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            for part in blocks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(enc.encode_batch(part.column("text").to_pylist()), pa.binary())],
                    ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary"))


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(id, bytes): the bytes that the ids of ``encode`` stand for."""
    def run(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(enc.decode, batch.column("ids").to_pylist()), pa.binary())],
                ["id", "bytes"])

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, bytes binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass and return only the digests:
    (id, n_tokens, ids_sha256, decoded_sha256)."""
    def run(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            for part in blocks(batch, "text"):
                n, a, b = [], [], []
                for ids in enc.encode_batch(part.column("text").to_pylist()):
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(enc.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"))
