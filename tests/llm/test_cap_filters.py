"""Near-duplicate vectors against brute force, recall at the threshold, edges."""

import math

import numpy as np

from citecube.llm import cap_filters

SCHEMA = "vec_id long, embedding array<double>, id string, node int, a string, filter int"


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1, "y", 2)
                                  for i, v in rows], SCHEMA)


def usable(i, v):
    return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=0.9):
    good = [k for k, (i, v) in enumerate(rows) if usable(i, v)]
    near = {k: set() for k in range(len(rows))}
    for x in good:
        for y in good:
            if x < y and len(rows[x][1]) == len(rows[y][1]):
                p, q = (np.array(rows[k][1], float) / np.abs(rows[k][1]).max() for k in (x, y))
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= cosine:
                    near[x].add(y)
                    near[y].add(x)
    out = []
    for k, (i, _) in enumerate(rows):
        if i is None:
            out.append((None, 0, None, None))
            continue
        seen, todo = {k}, [k]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        least = min(rows[x][0] for x in seen)
        out.append((i, len(near[k]), least, least == i))
    return sorted(out, key=str)


def run(vectors, percent=90):
    return sorted(map(tuple, cap_filters.near_vectors(vectors, percent).collect()), key=str)


def hostile(seed, hot=150):
    rng = np.random.default_rng(seed)
    center = rng.standard_normal(16)
    rows = [(3 * k, rng.standard_normal(16)) for k in range(60)]
    rows += [(1000 - k, center + 0.08 * rng.standard_normal(16)) for k in range(hot)]       # a large group of near copies
    rows += [(2000 + k, center * (k + 1)) for k in range(5)] + [(3000 + k, rows[0][1]) for k in range(40)]
    chain = rng.standard_normal(16)
    for k in range(8):             # each linked with the next
        rows.append((4000 + k, chain := chain + 0.25 * rng.standard_normal(16)))
    rows += [(5000, rows[1][1] * 1e200), (5001, rows[1][1] * 1e-200), (5002, -rows[1][1])]
    rows += [(6000, None), (6001, []), (6002, np.zeros(16)), (6003, [None] + [1.0] * 15), (6004, [math.nan] * 16),
             (6005, [math.inf] + [0.0] * 15), (None, rows[2][1]), (6006, [1.0, 2.0]), (6007, [1.0, 2.01]), (6008, [5.0]), (6009, [7.0])]
    rows += [(7000, rows[3][1]), (7000, rows[4][1]), (7000, rows[4][1])]
    return [(i, None if v is None else list(v)) for i, v in rows]


def test_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "STRIP", 16)        # large filters meet in many tiles
    rows = hostile(16)
    assert run(make(spark, rows)) == brute(rows)


def test_edges(spark):
    assert run(make(spark, []).limit(0)) == []
    rows = [(5, None), (None, None), (8, [1.0]), (4, [2.0])]
    assert run(make(spark, rows)) == brute(rows)


def test_recall_right_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    x = cap_filters.units(rng.standard_normal((3000, 64)))
    y = rng.standard_normal((3000, 64))
    y = cap_filters.units(y - (x * y).sum(axis=1, keepdims=True) * x)
    above, below = (cap_filters.units(c * x[s] + math.sqrt(1 - c * c) * y[s])
                    for c, s in ((0.901, slice(0, 1500)), (0.8999, slice(1500, 3000))))
    rows = [(2 * k, v) for k, v in enumerate(x)] + [(2 * k + 1, v) for k, v in enumerate([*above, *below])]
    got = {r[0]: r[1] for r in run(make(spark, rows))}
    assert sum(got[2 * k] for k in range(1500)) >= 0.998 * 1500
    assert not any(got[2 * k] for k in range(1500, 3000))


def test_list_decoding_is_exhaustive():
    x = cap_filters.units(np.random.default_rng(1).standard_normal((5, 20)))
    row, found = cap_filters.decode(x, 6, 0.3)
    first, signs, second, _ = cap_filters.rotations(20)
    words = cap_filters.codes(20, 6)
    want = []
    for r in range(5):
        for c in range(cap_filters.CODES):
            y = (x[r] @ first) * signs[c] @ second
            for u in range(6):
                for v in range(6):
                    if y @ np.concatenate([words[c, 0, u], words[c, 1, v]]) >= 0.3:
                        want.append((r, (c * 6 + u) * 6 + v))
    assert sorted(zip(row.tolist(), found.tolist())) == want
