"""The conversation trie against a brute-force version and on edge cases."""

import collections
import hashlib
import random
import re
import zlib

from citecube.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, name string, depth int, a string, n int, last boolean"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, True) for r in rows], SCHEMA)


def brute(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert all(len({t[:2] for t in ts}) == len(ts) or len(set(ts)) == 1 for ts in own.values()), "only equal turns tie here"
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(donor, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(p))))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p],
                    sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", q[-1][1])) for q in below if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(conversations):
    nodes, ends = prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.order_turns(conversations)))
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return sorted(((*r, digests.get((r.conv_id, r.depth), nothing)) for r in nodes.collect()), key=str)


def conversations(seed, many=70, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(-25, many):
        if rng.random() < 0.1:
            continue       # some donors are absent
        turns = rng.choice([1, 1, 2, 3, longest])
        start = rng.choice([None, 0, 5])
        for t in range(turns):
            turn = None if t == 0 and start is None else (start or 0) + t
            rows.append((c, turn, rng.choice(["user", None, "", "bot"]),
                         rng.choice(["hi there", "hi  there\n", "", None, "bye", "x " * 4000])))
    return rows


def test_trie_against_brute_force(spark):
    rows = conversations(1)
    same = [(c, t, "user", f"turn {t}") for c in range(200, 260) for t in range(17)]     # copies and long shared prefixes
    forks = [(c, t, "user", f"turn {t}" if t < c % 17 else f"own {c % 5}") for c in range(300, 380) for t in range(17)]
    rows += same + forks + [(500, 3, "user", "again")] * 3 + [(None, 1, "user", "lost")]
    random.Random(1).shuffle(rows)
    assert run(make(spark, rows)) == brute(rows)


def test_trie_edges(spark):
    assert run(make(spark, []).limit(0)) == []
    rows = [(41, 1, "u", "a"), (42, 1, "u", "a"), (7, None, None, None)]
    assert run(make(spark, rows)) == brute(rows)


def test_role_and_text_do_not_run_together(spark):
    rows = [(20, 1, "ab", "c"), (40, 1, "a", "bc")]
    got = run(make(spark, rows))
    assert got == brute(rows) and len(got) == 3


def test_end_digests_stream_over_many_ranges(spark):
    ends = spark.range(0, 30000, 1, 7).selectExpr("id % 3 AS conv_id", "id % 2 AS depth", "id AS member")
    got = {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    want = collections.defaultdict(list)
    for i in range(30000):
        want[i % 3, i % 2].append(str(i))
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}


def test_query_is_the_operator(spark):
    assert "op13_prefix_trie" in queries.oracle_sql()
