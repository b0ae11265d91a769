"""Lexical retrieval packing: documents fill windows of a fixed number of
tokens together with their nearest unused neighbours.

Documents are tokenised once and written; the distinct words of a block of texts
are looked up, and the unknown ones merged, together.  Document frequencies, their number
and their mean length are those of the whole table.  The BM25 index is sharded
by contents: in every cell of documents above a shard's size a bounded number of
routing documents is drawn by hash, and each document goes to the one that finds
it best; cells that are still too large are split again.  The first split, of all
documents, needs no shuffle: its routing documents go to every task.  Cells and
shards hold bags only (a document's distinct ids with their counts); its ids are
shuffled once, when they meet the pieces.  A document meets a
bounded number of routing documents per level, and there are as many levels as
the logarithm of the table's size asks for, so the work grows with the table.
Neighbouring small cells share a shard; what no level could split (copies, say)
is dealt over several shards by row.

In a shard a seed document opens a window; its best unused neighbours, asked
from the shard's inverted index, follow until the window is full.  The document
at the window's end is cut there, and its rest is the seed of the next window.
Only the last window of a shard can be short: it is split into sequences whose
lengths are powers of two, so nothing is padded."""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_ids
from .common import blocks, materialize, materialize_texts

WINDOW = 4096
SHARD_BYTES = 8 << 20      # text bytes of a shard, about
NEIGHBOURS = 64            # ranked at a time; when they are used up the index is asked again
K1, B = 1.2, 0.75
FANOUT, FEWEST = 128, 8    # routing documents of a cell, about
SPREAD = 4                 # routing documents for each shard that a cell would fill
TASK_BYTES = 16 << 20      # text bytes that meet their routing documents in one group, about
NOBODY = -1                # place of the head of a document that shares no term with any
CHUNKS, PIECES, WORDS = 300_000, 150_000, 600_000   # entries of the caches of a Python worker; words are Arrow arrays
BLOCK_BYTES = 16 << 20     # text bytes encoded together, about
MERGED = 1000              # unknown pieces merged in one call
LONG = 1 << 26             # bytes; longer texts are encoded chunk by chunk
HEAD_BYTES = 64            # of the ids, by which rows that repeat an id are ordered
FREQUENT = 4               # terms in one of so many documents of a shard are added up as whole rows

ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\f\va-z0-9]+")
# Precomposed Latin letters: composing leaves them alone and each has one lower-case letter.
LATIN = re.compile("[\x21-\x7e\u00c0-\u012f\u0131-\u017f]+")
LATIN_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Texts of these letters, printable ASCII and ASCII white space; what stands between their runs of letters (RE2).
PLAIN = "\\A[\t-\r -~\u00c0-\u012f\u0131-\u017f]*\\z"
BETWEEN = r"'s|'t|'re|'ve|'m|'ll|'d|\pN|[^\t-\r \pL\pN]+"


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: printable
    ones for themselves, the others from 256 on in their order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


BYTE_SIGNS = byte_signs()


class Known(dict):
    """A cache that works out what it lacks and keeps the first it meets; words
    that come late and are not kept are worked out again."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        value = self.work(key)
        if len(self) < self.most:
            self[key] = value
        return value


class WordTokenizer:
    """The ``tokenizers`` file's ids with caches: a pre-token never crosses
    ASCII white space, so the chunks between encode independently.  Plain texts
    are cut into pre-tokens as whole Arrow arrays, and each distinct one of a
    block is looked up once; other texts are encoded chunk by chunk."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark hands out the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True
        self.bare = Tokenizer(self.inner.model)                      # for pieces that are normalised and cut already
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.inner.model.end_of_word_suffix
        self.ends = np.zeros(self.inner.get_vocab_size(), bool)      # ids that only the end of a piece has
        self.ends[[i for word, i in self.inner.get_vocab().items() if suffix and word.endswith(suffix)]] = True
        self.dtype = np.dtype("<u2" if self.inner.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks = Known(self._chunk, CHUNKS)
        self.pieces = Known(self._piece, PIECES)
        self.words, self.found = pa.array([""]), pa.array([b""])     # the pieces met so far and their ids

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._ids([t.id for t in self.inner.model.tokenize(piece)])

    def _chunk(self, chunk: bytes) -> bytes:
        word = chunk.decode()
        if word.isascii() and word.isprintable():    # normalising is lower-casing, bytes are their own characters
            return b"".join(map(self.pieces.__getitem__, ASCII_PIECES.findall(word.lower())))
        if LATIN.fullmatch(word):
            signs = [p.encode().decode("latin-1").translate(BYTE_SIGNS) for p in LATIN_PIECES.findall(word.lower())]
            return b"".join(map(self.pieces.__getitem__, signs))
        return self._ids(self.inner.encode(word, add_special_tokens=False).ids)

    def _merged(self, pieces: list[str]) -> pa.Array:
        """Ids of pieces not known yet, all merged in one call."""
        signs = [p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_SIGNS) for p in pieces]
        ids = np.array(self.bare.encode_batch_fast([" ".join(signs)], add_special_tokens=False)[0].ids, self.dtype)
        cuts = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        if len(cuts) != len(pieces) + 1:             # a piece without an end of its own
            return pa.array(list(map(self._piece, signs)), pa.binary())
        return binaries(ids, cuts)

    def _known(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces."""
        at = pc.index_in(pieces, self.words)
        new = pieces.filter(pc.is_null(at))
        if not len(new):
            return self.found.take(at)
        group = new.to_pylist()
        ids = pa.concat_arrays([self._merged(group[lo:lo + MERGED]) for lo in range(0, len(group), MERGED)])
        order = np.argsort(at.is_valid().to_numpy(zero_copy_only=False), kind="stable")     # new ones first
        out = pa.concat_arrays([ids, self.found.take(at.drop_null())]).take(pa.array(np.argsort(order)))
        room = max(0, WORDS - len(self.words))
        if room:
            self.words = pa.concat_arrays([self.words, new[:room]])
            self.found = pa.concat_arrays([self.found, ids[:room]])
        return out

    def _plain(self, texts: pa.Array) -> pa.Array:
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), BETWEEN, r" \0 "))
        coded = words.flatten().dictionary_encode()
        ids = self._known(coded.dictionary)
        return pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids.take(coded.indices)), b"")

    def encode_batch(self, texts: pa.Array, last: int) -> pa.Array:
        """Ids of each text (none null), then the id ``last``."""
        plain = pc.and_(pc.match_substring_regex(texts, PLAIN), pc.less(pc.binary_length(texts), LONG))
        get = self.chunks.__getitem__
        ids = self._plain(texts.filter(plain))
        if len(ids) < len(texts):                    # bytes split at ASCII white space only
            rest = [b"".join(map(get, t.encode().split())) for t in texts.filter(pc.invert(plain)).to_pylist()]
            order = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")     # where each row of both came from
            ids = pa.concat_arrays([ids, pa.array(rest, pa.binary())]).take(pa.array(np.argsort(order)))
        return pc.binary_join_element_wise(ids, pa.scalar(self._ids([last]), pa.binary()), pa.scalar(b"", pa.binary()))


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the values between each cut and the next, as Arrow."""
    offsets = pa.py_buffer((cuts * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def forget_tokenizers() -> None:
    """For the steps after encoding: the worker lives on, its caches need not."""
    _TOKENIZERS.clear()


class Bag:
    """A document's distinct ids in order, with their counts; ``len`` is that of the document."""

    __slots__ = ("terms", "counts", "many")

    def __init__(self, terms: np.ndarray, counts: np.ndarray, many: int):
        self.terms, self.counts, self.many = terms, counts, many

    def __len__(self) -> int:
        return self.many


def bag(doc: np.ndarray | Bag) -> Bag:
    if isinstance(doc, Bag):
        return doc
    ids = np.sort(doc)
    begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])[:len(ids)])
    return Bag(ids[begin], np.diff(begin, append=len(ids)), len(doc))


def bags(rows: pa.RecordBatch | pa.Table, dtype: np.dtype) -> list[Bag]:
    """Counts are of one byte each, or of four."""
    return [Bag(terms := np.frombuffer(raw, dtype), np.frombuffer(counts, f"<u{len(counts) // len(terms)}"), many)
            for raw, counts, many in zip(*(rows.column(c).to_pylist() for c in ("terms", "counts", "length")))]


def count_bytes(counts: np.ndarray) -> bytes:
    return counts.astype("<u1" if counts.max() < 256 else "<u4").tobytes()


def bags_of(ids: pa.Array, dtype: np.dtype) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(lengths, terms, counts) of documents (bytes of ids, none empty), those of
    a block sorted together."""
    many = np.array(pc.binary_length(ids).to_numpy(zero_copy_only=False), np.int64) // dtype.itemsize
    flat = np.frombuffer(b"".join(ids.to_pylist()), dtype)
    small = dtype.itemsize == 2 and len(many) <= 1 << 16      # document and id in one number
    wide, shift = (np.uint32, np.uint32(16)) if small else (np.uint64, np.uint64(32))
    both = np.repeat(np.arange(len(many), dtype=wide) << shift, many) | flat
    both.sort()
    begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[:len(both)])
    counts, terms = np.diff(begin, append=len(both)), both[begin].astype(dtype)        # the lower bits
    cuts = np.searchsorted(begin, np.append(0, np.cumsum(many)))
    out = binaries(counts.astype(np.uint8), cuts)
    if len(counts) and counts.max() >= 256:          # those documents' counts need four bytes each
        out = pa.array([count_bytes(counts[lo:hi]) for lo, hi in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary())
    return pa.array(many), binaries(terms, cuts), out


def gathered(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches put together while their texts hold ``max_bytes`` at most; larger ones cut."""
    some, total = [], 0
    for part in (part for batch in batches for part in blocks(batch, column, max_bytes)):
        size = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if some and total + size > max_bytes:
            yield pa.concat_batches(some)
            some, total = [], 0
        some.append(part)
        total += size
    if some:
        yield pa.concat_batches(some)


def inverse(df: np.ndarray, many: int) -> np.ndarray:
    return np.log1p((many - df + 0.5) / (df + 0.5))


class Index:
    """Inverted BM25 index over the token ids of one shard's documents (ids or
    bags, none empty): for each term the documents that hold it, with their weights.
    Used documents leave the postings in turn.  Frequent terms have a row of
    weights of all documents instead.  ``whole`` is (inverse frequency
    of every id, mean length) of all documents; without it the shard's own
    count."""

    def __init__(self, docs: list[np.ndarray | Bag], whole: tuple[np.ndarray, float] | None = None):
        self.own, counts = zip(*((b.terms, b.counts) for b in map(bag, docs)))
        many = np.array([len(t) for t in self.own])
        term = np.concatenate(self.own)
        df = np.bincount(term)
        known = np.flatnonzero(df)
        self.number = np.cumsum(df > 0) - 1          # of each id among the known ones
        term, df = self.number[term], df[known]
        tf, size = np.concatenate(counts).astype(np.int64), np.array([len(d) for d in docs], np.float64)
        idf, mean = (inverse(df, len(docs)), size.mean()) if whole is None else (whole[0][known], whole[1])
        norm = np.repeat(K1 * (1 - B + B * size / mean), many)
        by_term = np.argsort(term.astype(np.uint16) if len(known) <= 1 << 16 else term, kind="stable")
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32)[by_term]
        place = np.repeat(np.arange(len(docs)), many)[by_term]
        often = df * FREQUENT > len(docs)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        dense, term = np.repeat(often, df), term[by_term]
        self.rows = np.zeros((np.count_nonzero(often), len(docs)))
        self.rows[self.row[term[dense]], place[dense]] = weight[dense]
        self.weight, self.place = weight[~dense].astype(np.float64), place[~dense]     # as they are added up
        self.begin = np.concatenate([[0], np.cumsum(np.where(often, 0, df))])
        self.live = np.arange(len(docs))

    def ranked(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share any term of the seed, best first, ties
        to the smaller place; NEIGHBOURS at most."""
        many = np.count_nonzero(unused)
        if not many:
            return np.empty(0, np.int64)
        if 4 * many < 3 * len(self.live):
            left = unused[self.live]
            keep = left[self.place]
            self.begin = np.concatenate([[0], np.cumsum(keep)])[self.begin]
            self.place, self.weight = (np.cumsum(left) - 1)[self.place[keep]], self.weight[keep]
            self.rows, self.live = self.rows[:, left], self.live[left]
        terms = self.number[self.own[seed]]
        spans = [slice(lo, hi) for lo, hi in zip(self.begin[terms].tolist(), self.begin[terms + 1].tolist()) if lo < hi]
        score = np.zeros(len(self.live))
        if spans:
            score += np.bincount(np.concatenate([self.place[x] for x in spans]),
                                 np.concatenate([self.weight[x] for x in spans]), len(self.live))
        often = self.row[terms]
        asked = np.zeros(len(self.rows))
        asked[often[often >= 0]] = 1
        score += asked @ self.rows
        found = np.flatnonzero(np.where(unused[self.live], score, 0))
        if len(found) > NEIGHBOURS:
            least = np.partition(score[found], -NEIGHBOURS)[-NEIGHBOURS]
            found = found[score[found] >= least]    # all ties with the last, so that the smaller places win
        return self.live[found[np.lexsort((found, -score[found]))][:NEIGHBOURS]]


def chain(docs: list[np.ndarray | Bag], window: int, whole: tuple[np.ndarray, float] | None = None) -> Iterator[int]:
    """The order in which a shard's documents follow each other."""
    index = Index(docs, whole)
    unused = np.ones(len(docs), bool)
    seed, filled, later = -1, 0, 0
    queue: list[int] = []
    for _ in range(len(docs)):
        while queue and not unused[queue[-1]]:
            queue.pop()
        if not queue and seed >= 0:
            queue = index.ranked(seed, unused)[::-1].tolist()
        alone = not queue
        if queue:
            now = queue.pop()
        else:                                       # no neighbour left: the next unused document is a new seed
            while not unused[later]:
                later += 1
            now = later
        unused[now] = False
        yield now
        filled += len(docs[now])
        if alone or filled >= window:               # a window begins inside or after this document
            seed, filled, queue = now, filled % window, []


def pieces(docs: list[np.ndarray | Bag], window: int, whole: tuple[np.ndarray, float] | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of a shard's pieces."""
    total = sum(map(len, docs))
    full, rest = divmod(total, window)
    sizes = [window] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    sequence, offset = 0, 0
    for d in chain(docs, window, whole):
        start = 0
        while start < len(docs[d]):
            take = min(len(docs[d]) - start, sizes[sequence] - offset)
            yield d, start, take, sequence, offset
            start += take
            offset += take
            if offset == sizes[sequence]:
                sequence, offset = sequence + 1, 0


def corpus(tokens: DataFrame, dtype: np.dtype, vocabulary: int, end_id: int) -> tuple[int, np.ndarray, float]:
    """(number, inverse frequency of every id, mean length) of all documents.  The end
    id, which all of them hold, counts nothing."""
    def count(batches):
        forget_tokenizers()
        df, many, total = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype), minlength=vocabulary)
            many, total = many + len(batch), total + (pc.sum(batch.column("length")).as_py() or 0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, (-1, -2))), pa.array(np.append(df[at], (many, total)))],
                                         ["term", "c"])

    found = dict(map(tuple, tokens.select("terms", "length").mapInArrow(count, "term long, c long")   # the vocabulary's size at most
                     .groupBy("term").agg(F.sum("c").alias("c")).collect()))
    many, total = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(vocabulary, np.int64)
    df[list(found)] = list(found.values())
    idf = inverse(df, many).astype(np.float32)
    idf[end_id] = 0
    return many, idf, total / max(1, many)


def ask(heads: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """By term: the heads that ask for it."""
    asked = np.zeros((len(idf), len(heads)), np.float32)
    for i, terms in enumerate(heads):
        asked[terms, i] = idf[terms]
    return asked


def best_heads(docs: list[np.ndarray | Bag], heads: list[np.ndarray], idf: np.ndarray, mean: float) -> np.ndarray:
    """Place of the head that scores each document highest when all terms of
    the head are asked for; ties to the smaller place; NOBODY without a common term."""
    return best_asked(docs, ask(heads, idf), mean)


def best_asked(docs: list[np.ndarray | Bag], asked: np.ndarray, mean: float) -> np.ndarray:
    place = np.full(len(docs), NOBODY)
    for i, doc in enumerate(map(bag, docs) if asked.shape[1] else ()):
        tf = doc.counts
        score = (tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(doc) / mean))).astype(np.float32) @ asked[doc.terms]
        top = score.argmax()
        if score[top] > 0:
            place[i] = top
    return place


BAG_COLUMNS = ["id", "row", "size", "head", "length", "terms", "counts"]


def drawn(level: int, chance) -> Column:
    """Whether a row is a routing document of its cell."""
    return F.pmod(F.xxhash64("row", F.lit(level)), F.lit(1 << 40)) < chance * (1 << 40)


def cell_names(cell: str, found: np.ndarray) -> pa.Array:
    return pa.array([f"{cell}{i + 1:03d}." for i in found.tolist()], pa.string())


def split_all(docs: DataFrame, schema: str, shard_bytes: int, total_bytes: int, many: int, whole, dtype: np.dtype) -> DataFrame:
    """The one cell of all documents, split.  The distinct ids of its FANOUT
    routing documents or so go to every task."""
    chance = min(FANOUT, max(FEWEST, math.ceil(total_bytes * SPREAD / shard_bytes))) / many
    heads = sorted((r.row, bytes(r.terms)) for r in docs.where(drawn(0, chance)).select("row", "terms").collect())
    heads = docs.sparkSession.sparkContext.broadcast([terms for _, terms in heads])

    def route(batches):
        asked = None
        for batch in batches:
            if asked is None:
                idf, mean = whole.value
                asked = ask([np.frombuffer(x, dtype) for x in heads.value], idf)
            names = cell_names("", best_asked(bags(batch, dtype), asked, mean))
            yield pa.RecordBatch.from_arrays([*batch.columns, names], [*BAG_COLUMNS, "cell"])

    return docs.select(*BAG_COLUMNS).mapInArrow(route, schema)


def split_cells(docs: DataFrame, large: DataFrame, schema: str, level: int, shard_bytes: int, whole, dtype: np.dtype) -> DataFrame:
    """The documents of the large cells in the cells of their routing documents."""
    none = docs.select(*BAG_COLUMNS, "cell").limit(0).toArrow()
    docs = docs.join(large, "cell").withColumn("parts", F.ceil(F.col("bytes") / TASK_BYTES).cast("int"))
    chance = F.least(F.lit(FANOUT), F.greatest(F.lit(FEWEST), F.ceil(F.col("bytes") * SPREAD / shard_bytes))) / F.col("many")
    heads = (docs.where(drawn(level, chance))
             .select("cell", "row", "terms", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
             .toDF("head_cell", "head_row", "head_terms", "head_part"))
    docs = docs.select(*BAG_COLUMNS, "cell", F.pmod(F.xxhash64("row", F.lit(-1)), F.col("parts")).cast("int").alias("part"))

    def route(some: pa.Table, heads: pa.Table) -> pa.Table:
        if not len(some):
            return none
        terms = [np.frombuffer(x, dtype) for x in heads.sort_by("head_row").column("head_terms").to_pylist()]
        names = cell_names(some.column("cell")[0].as_py(), best_heads(bags(some, dtype), terms, *whole.value))
        return some.select(BAG_COLUMNS).append_column("cell", names)

    return docs.groupBy("cell", "part").cogroup(heads.groupBy("head_cell", "head_part")).applyInArrow(route, schema)


def place(tokens: DataFrame, kind: str, shard_bytes: int, total_bytes: int, many: int, whole, dtype: np.dtype) -> DataFrame:
    """Bags with their shard: documents of like contents share a shard of at
    most twice ``shard_bytes`` of text."""
    schema = f"id {kind}, row long, size long, head binary, length long, terms binary, counts binary, cell string"
    docs = tokens.select(*BAG_COLUMNS)
    docs = (materialize_texts(split_all(docs, schema, shard_bytes, total_bytes, many, whole, dtype), "pack-cells", "zstd")
            if total_bytes > shard_bytes else docs.withColumn("cell", F.lit("")))
    shards = max(1, -(-total_bytes // shard_bytes))
    for level in range(1, 2 + math.ceil(math.log(shards, FANOUT))):
        large = materialize(docs.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("many"))
                            .where(F.col("bytes") > shard_bytes), "pack-large")
        if large.isEmpty():
            break
        split = materialize_texts(split_cells(docs, large, schema, level, shard_bytes, whole, dtype), "pack-cells", "zstd")
        docs = docs.join(large.select("cell"), "cell", "left_anti").select(*BAG_COLUMNS, "cell").union(split)
    # The cells of one routing step, FANOUT or so, fill shards in turn; what is too large is dealt by row.
    sizes = (docs.groupBy("cell").agg(F.sum("size").alias("bytes"))
             .withColumn("parent", F.regexp_replace("cell", "[0-9]+[.]$", ""))
             .withColumn("parts", F.ceil(F.col("bytes") / shard_bytes)))
    before = F.sum(F.when(F.col("parts") == 1, F.col("bytes")).otherwise(0)).over(Window.partitionBy("parent").orderBy("cell"))
    name = F.when(F.col("parts") > 1, F.concat("cell", F.lit("#"))).otherwise(
        F.concat("parent", F.lit(":"), F.ceil(before / shard_bytes).cast("string")))
    sizes = materialize(sizes.withColumn("name", name).select("cell", "name", "parts"), "pack-sizes")
    # written: their size is known then, and the documents need no shuffle to meet them
    numbers = materialize(dense_ids(
        sizes.select("name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).distinct(),
        ["name", "part"], "shard", first_id=0), "pack-numbers")
    return (docs.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
            .join(numbers, ["name", "part"]).select("id", "row", "head", "length", "terms", "counts", "shard"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset[, ids]); ``ids`` are little-endian unsigned 32-bit.

    A document is the ids of its whole text (null: empty), then ``end_id``; so
    an empty text is the one id.  Every id lies in exactly one piece; sequences
    hold ``window`` ids or a power of two.  Rows that repeat an id or a text
    are documents of their own; an empty table gives no rows; extra columns of
    any name are ignored.  A sequence's id is its shard's number times 2^32
    plus its place there."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum((F.octet_length("text") + 1).cast("long"))).first()[0] or 0

    tok = tokenizer(tokenizer_path)
    dtype, vocabulary = tok.dtype, tok.inner.get_vocab_size()

    def tokenise(batches):
        tok = tokenizer(tokenizer_path)
        for part in gathered(batches, "text", BLOCK_BYTES):
            ids = tok.encode_batch(part.column("text"), end_id)
            length, terms, counts = bags_of(ids, dtype)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("size"), pc.binary_slice(ids, 0, HEAD_BYTES), length, terms, counts, ids],
                ["id", "size", "head", "length", "terms", "counts", "ids"])
        pa.default_memory_pool().release_unused()    # the worker lives on, in other steps too

    tokens = rows.select("*", (F.octet_length("text") + 1).cast("long").alias("size"))
    tokens = materialize_texts(tokens.mapInArrow(        # Zstandard: ids take two thirds of what Snappy leaves
        tokenise, f"id {kind}, size long, head binary, length long, terms binary, counts binary, ids binary")
        .withColumn("row", F.monotonically_increasing_id()), "pack-tokens", "zstd")
    many, *whole = corpus(tokens, dtype, vocabulary, end_id)
    whole = docs.sparkSession.sparkContext.broadcast(whole)    # one number per id
    placed = place(tokens, kind, shard_bytes, int(total), many, whole, dtype)

    def pack_shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("id", "head", "terms", "counts", "row")])
        shard = table.column("shard")[0].as_py()
        which, start, length, sequence, offset = map(np.array, zip(*pieces(bags(table, dtype), window, whole.value)))
        return pa.table({"row": table.column("row").take(pa.array(which)), "start": pa.array(start, pa.int64()),
                         "length": pa.array(length, pa.int64()), "sequence_id": pa.array((shard << 32) + sequence, pa.int64()),
                         "offset": pa.array(offset, pa.int64())})

    def cut(batches):
        forget_tokenizers()
        for part in (part for batch in batches for part in blocks(batch, "ids")):
            found = part.column("pieces")
            which = np.repeat(np.arange(len(part)), found.value_lengths().to_numpy())
            found = pa.RecordBatch.from_struct_array(found.flatten())
            ids = [np.frombuffer(x, dtype) for x in part.column("ids").to_pylist()]
            spans = list(zip(which.tolist(), found.column("start").to_pylist(), found.column("length").to_pylist()))
            at = pa.array(which)
            out = {"id": part.column("id").take(at), "start": found.column("start"), "length": found.column("length"),
                   "ids_crc32": pa.array([zlib.crc32(ids[d][s:s + n].astype("<u4")) for d, s, n in spans], pa.int64()),
                   "doc_tokens": part.column("tokens").take(at),
                   "sequence_id": found.column("sequence_id"), "offset": found.column("offset")}
            if with_ids:
                out["ids"] = pa.array([ids[d][s:s + n].astype("<u4").tobytes() for d, s, n in spans], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    schema = (f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids binary" if with_ids else ""))
    packed = placed.groupBy("shard").applyInArrow(pack_shard, "row long, start long, length long, sequence_id long, offset long")
    packed = packed.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    return (tokens.select("row", "id", F.col("length").alias("tokens"), "ids").join(packed.hint("shuffle_hash"), "row")
            .select("id", "tokens", "ids", "pieces").mapInArrow(cut, schema))
