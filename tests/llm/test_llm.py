"""The training-data operators against brute-force versions and on edge cases:
nulls, empty and very long texts, repeated rows, empty tables, extra columns
with clashing names."""

import base64
import binascii
import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from citecube.llm import bpe, exact, graph, licenses, neardup, packing, quality, sharding, substring, topk, urls

SCHEMA = "doc_id long, text string, id string, h int, n int, key string, component string, shard string, lang string"
WORD = "[^\x20\x09-\x0d]+"


def make_docs(spark, texts, first=0):
    rows = [(first + i, t, "x", 1, 2, "k", "c", "s", "en") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def random_texts(seed, many=60, vocabulary=400, most=200):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(80)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, most))) for _ in range(many)]
    for k in range(0, many, 4):       # near copies, shared passages, repeats inside a text
        base = texts[k].split()
        if base:
            base[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(base))
        cut = rng.randint(0, 30)
        texts.append(" ".join([rng.choice(words) for _ in range(20)] + passage[cut:cut + 50]))
    texts += [texts[0], texts[0].replace(" ", "\n ", 1), texts[5], "a b " * 60, "one", "One", " \t", "", None, None,
              "x" * 5000, " ".join(words * 30)]
    return texts


def hostile(spark):
    return make_docs(spark, random_texts(3))


def empty(spark):
    return make_docs(spark, []).limit(0)


# -- exact dedup -----------------------------------------------------------
def test_exact_against_brute_force(spark):
    docs = hostile(spark)
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[re.sub("[\x20\x09-\x0d]+", " ", r.text or "")].append(r.doc_id)
    want = sorted((i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
                  for t, ids in groups.items() for i in ids)
    got = exact.exact_labels(docs)
    assert sorted(map(tuple, got.collect())) == want
    kept = exact.drop_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if w[3])


def test_exact_edges(spark):
    assert exact.exact_labels(empty(spark)).count() == 0
    twice = make_docs(spark, ["a", None]).union(make_docs(spark, ["a", ""]))
    assert sorted((r.id, r.keep_id, r.group_size) for r in exact.exact_labels(twice).collect()) == [
        (0, 0, 2), (0, 0, 2), (1, 1, 2), (1, 1, 2)]


def test_exact_counts_rows_without_an_id(spark):
    rows = make_docs(spark, ["same text", "other", "other"], first=7)
    rows = rows.union(make_docs(spark, ["same text", "lost", "lost"]).withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in exact.exact_labels(rows).collect()), key=str)
    assert got == sorted([(7, 7, 2, True), (8, 8, 2, True), (9, 8, 2, False), (None, 7, 2, None), (None, None, 2, None),
                          (None, None, 2, None)], key=str)


# -- near-dedup ------------------------------------------------------------
def brute_near(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_groups_against_brute_force(spark, words, percent):
    docs = hostile(spark)
    want = brute_near([(r.doc_id, r.text) for r in docs.collect()], words, percent)
    assert sorted(map(tuple, neardup.near_groups(docs, words, percent).collect())) == want
    kept = neardup.drop_near(docs, words, percent)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [w[0] for w in want if w[3]]


def test_near_chain_of_copies(spark):
    """Documents that drift: neighbours link, ends do not; one component."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:k * 4] + [f"n{j}" for j in range(k * 4)] + words[k * 4:]) for k in range(6)]
    texts = [" ".join([f"z{k}_{i}" if i < 5 * k else w for i, w in enumerate(words)]) for k in range(8)]
    docs = make_docs(spark, texts[::-1] + ["a"])
    want = brute_near([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    assert sorted(map(tuple, neardup.near_groups(docs, 3, 85).collect())) == want


def test_near_edges(spark):
    assert neardup.near_groups(empty(spark)).count() == 0
    got = neardup.near_groups(make_docs(spark, [None, "", "  ", "a", "A"])).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    b = np.unique(np.concatenate((a[:800], rng.integers(0, 2**63, 200).astype(np.uint64))))
    x, y, small = neardup.sketches([a, b, a[:1]])
    assert abs((x == y).mean() - 800 / 1200) < 0.12
    assert (small != neardup.EMPTY).all()          # even one element fills every bin


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(300, 200), (250, 300)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[k] for k in range(100, 130)} == {100}
    assert {got[i] for i in (200, 250, 300)} == {200}


# -- substring dedup -------------------------------------------------------
def brute_repeats(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    count = collections.Counter(tuple(w[p:p + window]) for w in words.values() for p in range(len(w) - window + 1))
    out = []
    for i, w in words.items():
        gone = {q for p in range(len(w) - window + 1) if count[tuple(w[p:p + window])] > 1 for q in range(p, p + window)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window,seed", [(35, 3), (35, 4), (10, 5), (50, 6)])
def test_repeats_against_brute_force(spark, window, seed):
    docs = make_docs(spark, random_texts(seed))
    want = brute_repeats([(r.doc_id, r.text) for r in docs.collect()], window)
    assert sorted(map(tuple, substring.remove_repeats(docs, window).collect())) == want


def test_cut_repeats_keeps_columns_and_clean_texts(spark):
    docs = make_docs(spark, random_texts(3))
    want = {i: (gone, sha) for i, _, gone, sha in brute_repeats([(r.doc_id, r.text) for r in docs.collect()], 35)}
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = substring.cut_repeats(docs, 35)
    assert cut.columns == docs.columns
    got = {r.doc_id: r.text for r in cut.collect()}
    for i, (gone, sha) in want.items():
        if not gone:
            assert got[i] == texts[i]
        elif i in got:
            assert hashlib.sha256(got[i].encode()).hexdigest() == sha
        else:
            assert sha == hashlib.sha256(b"").hexdigest()


def test_repeats_of_rows_without_an_id(spark):
    """The passage of a row without an id, and a copy of another row without one."""
    passage, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "pq")
    rows = make_docs(spark, ["seven " + passage, other, "nine " + other], first=7)
    rows = rows.union(make_docs(spark, ["lost " + passage, "eight " + other, "eight " + other])
                      .withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted(((r.id, r.n_words, r.n_removed) for r in substring.remove_repeats(rows).collect()), key=str)
    assert got == sorted([(7, 41, 40), (8, 40, 40), (9, 41, 40), (None, 41, 40), (None, 41, 41), (None, 41, 41)], key=str)
    cut = {(r.doc_id, r.text) for r in substring.cut_repeats(rows, 35).collect()}
    assert cut == {(7, "seven"), (9, "nine"), (None, "lost " + passage), (None, "eight " + other)}


def test_repeats_edges(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = make_docs(spark, [text]).union(make_docs(spark, [text + " more"])).union(make_docs(spark, [None]))
    assert sorted((r.n_words, r.n_removed) for r in substring.remove_repeats(rows).collect()) == [(0, 0), (40, 40), (41, 40)]


# -- tokenising ------------------------------------------------------------
def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark):
    path, pattern, other = tiktoken_encoding()
    rng = random.Random(7)
    signs = "ab cd\n\t\xa0\u2003 d'sé漢字😀12 ..!\x85\x1c\u200b<|endoftext|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["the" * 400, "ab" * 300 + "é" * 300, "", None, "<|endoftext|>", " " * 500, "x" * 20000]
    docs = make_docs(spark, texts)
    encoded = bpe.encode(docs, path, pattern)
    ids = {r.id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()}
    back = {r.id: r.bytes for r in bpe.decode(encoded, path, pattern).collect()}
    for i, t in enumerate(texts):
        assert ids[i] == other.encode_ordinary(t or ""), repr(t)
        assert back[i] == (t or "").encode()
    assert bpe.encode(empty(spark), path, pattern).count() == 0


def test_heap_and_matrix_merge_alike():
    path, pattern, _ = tiktoken_encoding()
    enc = bpe.Encoder(path, pattern)
    rng = random.Random(2)
    pieces = list({"".join(rng.choice("etaoinshr ") for _ in range(rng.randint(2, 60))).encode() for _ in range(200)})
    assert enc.merge_matrix(pieces, 64) == [enc.merge_long(p).astype("<u4").tobytes() for p in pieces]


# -- sharding --------------------------------------------------------------
def test_shards_are_even_gapless_and_whole(spark):
    docs = hostile(spark).union(make_docs(spark, ["same"] * 50).withColumn("doc_id", F.lit(7).cast("long")))
    got = sharding.shuffle_shards(docs, 8, bucket_bytes=4000).collect()
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    key = lambda r: tuple(map(str, r))
    assert sorted(key(r.record) for r in got) == sorted(key(r) for r in docs.collect())
    order = [r.record.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard))]
    assert order != sorted(order)
    assert sharding.shuffle_shards(empty(spark), 8).count() == 0


def test_written_shards(spark, tmp_path):
    docs = hostile(spark)
    sharding.write_shards(sharding.shuffle_shards(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and {r[0] for r in back.select("_shard").distinct().collect()} == {0, 1, 2, 3}


# -- packing ---------------------------------------------------------------
def test_pack_is_whole_and_unpadded(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    texts = random_texts(9) + ["ÀÉ Σίσυφος İstanbul 漢字 it's I'LL 12ab!", "\x1c a\xa0b", "x1" * 9000, "<|endoftext|>"]
    docs = make_docs(spark, texts)
    want = [np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]
    rows = packing.pack(docs, path, with_ids=True, shard_bytes=20_000).collect()
    parts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        piece = want[r.id][r.start:r.start + r.length].tobytes()
        assert r.ids == piece and r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(want[r.id])
        parts[r.id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, ids in enumerate(want):
        end = 0
        for start, length in sorted(parts[i]):
            assert start == end
            end += length
        assert end == len(ids)
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 4096 or end & (end - 1) == 0
    assert packing.pack(empty(spark), path).count() == 0


def test_neighbours_follow_their_seed():
    rng = np.random.default_rng(3)
    topics = [rng.integers(1000 * t, 1000 * t + 50, (6, 300)) for t in range(4)]
    docs = [d.astype(np.uint16) for i in range(6) for d in (topics[t][i] for t in range(4))]
    order = list(packing.chain(docs, 1800))
    assert sorted(order) == list(range(24))
    same = sum(a % 4 == b % 4 for a, b in zip(order, order[1:]))
    assert same >= 18


def test_seed_with_many_rare_terms_finds_its_neighbour():
    common = np.arange(30)
    docs = [np.concatenate([common, np.arange(100, 200)]), np.arange(300, 360), np.arange(400, 460), common]
    assert packing.Index(docs).ranked(0, np.array([False, True, True, True])).tolist() == [3]
    assert list(packing.chain(docs, 1000))[:2] == [0, 3]


def test_best_heads_against_brute_force():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 60, rng.integers(1, 90)).astype(np.uint16) for _ in range(700)] + [np.array([99], np.uint16)]
    heads = [np.unique(d) for d in docs[::40]]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=100)
    idf, mean = packing.inverse(df, len(docs)).astype(np.float32), np.mean([len(d) for d in docs])
    idf[99] = 0
    assert packing.best_heads(docs, [], idf, mean).tolist() == [-1] * len(docs)
    for d, p in zip(docs, packing.best_heads(docs, heads, idf, mean)):
        terms = dict(zip(*np.unique(d, return_counts=True)))
        norm = 1.2 * (0.25 + 0.75 * len(d) / mean)
        want = [sum(idf[t] * terms[t] * 2.2 / (terms[t] + norm) for t in h if t in terms) for h in heads]
        assert p == -1 if max(want) == 0 else want[p] >= max(want) * (1 - 1e-4)


def test_related_documents_share_a_shard(spark):
    import public_tokenizers as P

    rng = random.Random(2)
    texts = [" ".join(rng.choice(string.ascii_lowercase[5 * t:5 * t + 5]) * 3 for _ in range(100)) for _ in range(40) for t in range(5)]
    shard = {r.doc_id: r.sequence_id >> 32 for r in packing.pack(
        make_docs(spark, texts), P.path("word_bpe_49k.json"), window=512, shard_bytes=20_000, id_col="doc_id")
        .withColumnRenamed("id", "doc_id").collect()}
    together = np.mean([shard[i] == shard[j] for i in range(200) for j in range(i % 5, i, 5)])
    apart = np.mean([shard[i] == shard[j] for i in range(200) for j in range(i) if i % 5 != j % 5])
    assert together > 0.3 and together > 4 * apart      # by a hash both are one in the number of shards


def test_equal_rows_are_dealt_over_shards(spark):
    import public_tokenizers as P

    docs = make_docs(spark, ["the same words in every row of it"] * 600)
    rows = packing.pack(docs, P.path("word_bpe_49k.json"), shard_bytes=5_000).collect()
    filled = collections.Counter()
    for r in rows:
        filled[r.sequence_id >> 32] += r.length
    assert sum(filled.values()) == 600 * 9 and len(filled) >= 4 and max(filled.values()) < 2 * min(filled.values())


def test_plain_texts_are_encoded_as_others():
    import public_tokenizers as P

    tok = packing.tokenizer(P.path("word_bpe_49k.json"))
    rng = random.Random(6)
    signs = [chr(c) for c in [*range(0x20, 0x7F), *range(0xC0, 0x130), *range(0x131, 0x180)]] + list(" \t\n\v\f\r''sStTdDmMlLrRvVeE0!?.,") * 9
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    texts += ["", "  ", "it'S I'LL !'s ''s 12ab </w>", "\u0301a\u0301", "\x1c a\xa0b", "İ Σίσυφος 漢字", "x1" * 900, "<|endoftext|>"] + texts[:3]
    assert 400 < pc.sum(pc.match_substring_regex(pa.array(texts), packing.PLAIN)).as_py() < len(texts)
    for _ in range(2):      # pieces that are unknown, then known
        for text, ids in zip(texts, tok.encode_batch(pa.array(texts), 2).to_pylist()):
            want = tok.inner.encode(text, add_special_tokens=False).ids + [2]
            assert np.frombuffer(ids, tok.dtype).tolist() == want, text


def test_ranking_against_brute_force_as_documents_are_used():
    rng = np.random.default_rng(7)
    docs = [(rng.zipf(1.4, rng.integers(1, 80)) % 300).astype(np.uint16) for _ in range(200)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=300)
    whole = packing.inverse(df, 200).astype(np.float32), float(np.mean([len(d) for d in docs]))
    index, unused = packing.Index([packing.bag(d) for d in docs], whole), np.ones(200, bool)
    assert len(index.rows) and len(index.place)          # frequent terms and others
    for seed in rng.permutation(200)[:150].tolist():
        unused[seed] = False
        score = np.zeros(200)
        for i in np.flatnonzero(unused):
            terms, tf = np.unique(docs[i], return_counts=True)
            w = whole[0][terms] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[i]) / whole[1]))
            score[i] = w.astype(np.float32).astype(float)[np.isin(terms, docs[seed])].sum()
        found = index.ranked(seed, unused)
        assert len(found) == min(64, np.count_nonzero(score)) and unused[found].all()
        assert np.allclose(score[found], np.sort(score)[::-1][:len(found)], rtol=1e-6)


def test_counts_of_one_and_four_bytes():
    docs = [np.repeat(np.arange(3), n).astype(np.uint16) for n in (1, 255, 256, 70_000)]
    want = list(map(packing.bag, docs))
    rows = pa.table({"terms": pa.array([b.terms.tobytes() for b in want]), "length": [len(b) for b in want],
                     "counts": pa.array([packing.count_bytes(b.counts) for b in want])})
    assert [len(x) for x in rows.column("counts").to_pylist()] == [3, 3, 12, 12]
    for b, n in zip(packing.bags(rows, np.dtype("<u2")), (1, 255, 256, 70_000)):
        assert b.terms.tolist() == [0, 1, 2] and b.counts.tolist() == [n] * 3 and len(b) == 3 * n


def test_ids_are_shuffled_once(spark):
    """Cells and shards hold bags; only the last join with the pieces holds ids."""
    import public_tokenizers as P

    docs = make_docs(spark, random_texts(11))
    plan = packing.pack(docs, P.path("word_bpe_49k.json"), shard_bytes=20_000)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.split("\n") if "Relation" in line and "ids#" in line]
    shard = plan[plan.index("FlatMapGroupsInArrow"):]
    assert len(scans) == 1 and "ids#" not in shard


# -- quality ---------------------------------------------------------------
def test_quality_learns_and_scores_every_row(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    good = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(120)]
    bad = [" ".join(rng.choice(words) + "!!!" for _ in range(60)) for _ in range(80)]
    texts = good + bad + [None, "", "y" * 30000]
    docs = make_docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(200)] + [(900, None), (None, 1)], "doc_id long, quality int")
    weights = quality.train(docs, labels, usable=~quality.in_fold())
    scores = {r.id: r.score for r in quality.score(docs, weights).collect()}
    assert len(scores) == len(texts) and scores[200] == scores[201] and all(0 <= s <= 1 for s in scores.values())
    held = [i for i in range(200) if binascii.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(scores[i] >= 0.5) == (i < 120) for i in held]) >= 0.95
    kept = quality.drop_poor(docs, weights, 0.5)
    assert kept.columns == docs.columns and kept.count() == sum(s >= 0.5 for s in scores.values())
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty(spark), weights).count() == 0


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights = quality.train(docs, labels, usable=~quality.in_fold())
    held = docs.join(labels.select("doc_id", "quality"), "doc_id").where(quality.in_fold())
    rows = quality.score(held, weights).join(held.select(F.col("doc_id").alias("id"), "quality"), "id").collect()
    assert np.mean([(r.score >= 0.7) == r.quality for r in rows]) >= 0.97


# -- top-k -----------------------------------------------------------------
def brute_top(rows, k):
    import math
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 5 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]                     # ties
    rows += [(500, None), (505, [None] * 24), (510, [float("nan")] * 24), (515, [float("inf")] + [0.0] * 23),
             (520, [1.0, 2.0]), (521, [2.0, 1.0]), (525, []), (526, []), (None, [1.0] * 24)]
    df = spark.createDataFrame([(i, v, 1, "g") for i, v in rows], "vec_id long, embedding array<double>, strip int, id string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, 10)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_top_k_beyond_float(spark):
    rows = [(0, [2.0**45, 1.0]), (1, [2.0**45, 3.0]), (2, [2.0**45, 2.0]), (3, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (3, 3)]           # all clipped to the largest long: ties by id
    rows = [(0, [2.0**43, 1.0]), (1, [2.0**-20, 3.0]), (2, [2.0**-20, 2.0]), (3, [-(2.0**43), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 1024 * 3072), (2, 1024 * 2048), (3, -(2**63))]   # beyond what float64 adds exactly


def test_top_k_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "STRIP", 40)
    monkeypatch.setattr(topk, "GROUP", 7)
    test_top_k_against_brute_force(spark)


# -- licences --------------------------------------------------------------
def test_license_scan(spark):
    apache, mit, gpl = (licenses.TEMPLATES[i][1] for i in (0, 1, 4))
    filler = " ".join(f"w{i}" for i in range(100))
    texts = [apache, f"{filler} {apache.upper()} {filler}", f"{filler}\n{mit}\n{filler} {mit}", gpl.replace("This", "That"),
             gpl.replace("licensed", "offered"), "licensed under the", None, "", filler * 20]
    got = {(r.id, r.license): r for r in licenses.scan(make_docs(spark, texts)).collect()}
    assert {k for k in got if k[1] in ("Apache-2.0",)} == {(0, "Apache-2.0"), (1, "Apache-2.0")}
    assert (2, "MIT") in got and got[2, "MIT"].n_windows >= 2
    assert (3, "GPL-3.0") in got and got[3, "GPL-3.0"].n_shared == got[3, "GPL-3.0"].n_template - 1
    assert (4, "GPL-3.0") not in got                   # half of the shingles are gone
    assert {k[0] for k in got} == {0, 1, 2, 3}
    assert licenses.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(empty(spark), [("short", "too few words")])


# -- URLs ------------------------------------------------------------------
def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = host.encode().lower().decode()
    fits = []
    for rule, says in urls.RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, says))
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def test_url_rules_and_trees(spark):
    rng = random.Random(6)
    texts = [f"http://{rng.choice(['www.', 'a.', ''])}{rng.choice(['example', 'spam', 'xcom'])}.{rng.choice(['com', 'net', 'org'])}"
             f"{rng.choice(['/en/', '/es/', '/fr/', '/', '', '/en?x=/es/'])}{rng.randint(0, 999)}" for _ in range(300)]
    texts += [None, "", "no scheme", "http://", "HTTP://WWW.EXAMPLE.COM/en/é#x?y", "http://com/", "http://com", "x://net/es/" + "z" * 9000]
    pages = spark.createDataFrame([(i, u, "h", "r", 1.0) for i, u in enumerate(texts)],
                                  "page_id long, url string, host string, rule string, features double")
    got = {r.id: r for r in urls.judge(pages).collect()}
    assert len(got) == len(texts)
    for i, u in enumerate(texts):
        host, path, rule, says = brute_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == says if rule else got[i].verdict in ("allow", "block")
    assert {r.verdict for r in urls.judge(pages.where("url IS NULL")).collect()} == {"allow"}
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_trees_learn_from_rules(spark):
    """Rules that fit half of the hosts: the trees carry their verdict over."""
    rng = random.Random(8)
    texts = [f"http://h{i}.{'good' if i % 2 else 'evil'}{i % 4}.{'org' if i % 2 else 'biz'}/{'a/' * (1 if i % 2 else 5)}{rng.randint(0, 99)}"
             for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    got = urls.judge(pages, rules=[("good1.org/", "allow"), ("evil0.biz/", "block")]).collect()
    free = [r for r in got if r.rule is None]
    assert len(free) == 200
    assert np.mean([(r.verdict == "allow") == (r.host.endswith("org")) for r in free]) > 0.95
