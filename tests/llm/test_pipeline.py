"""The pipeline's stages on the small tables, each against a plain version."""

import corpus_pipeline as cp
import numpy as np

from citecube.llm import packing, quality
from citecube.llm.common import read_table

from .test_llm import brute_near, brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    good = cp.keep_good(spark, docs, SF)
    weights = quality.train(docs, read_table(spark, SF, "labels"), usable=~quality.in_fold())
    scores = {r.id: r.score for r in quality.score(docs, weights).collect()}
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, s in scores.items() if s >= cp.REJECT_BELOW)

    once = cp.drop_copies(spark, good, SF)
    first = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        first.setdefault(" ".join((r.text or "").split()), r.doc_id)
    assert {r.doc_id for r in once.collect()} <= {r.doc_id for r in good.collect()}
    assert len({r.text for r in once.collect()}) == once.count()

    apart = cp.drop_near_copies(spark, once, SF)
    want = brute_near([(r.doc_id, r.text) for r in once.collect()], 5, 80)
    assert sorted(r.doc_id for r in apart.collect()) == [w[0] for w in want if w[3]]

    cut = cp.cut_repeats(spark, apart, SF)
    want = {w[0]: w for w in brute_repeats([(r.doc_id, r.text) for r in apart.collect()], cp.REPEAT_WORDS)}
    rows = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns
    for i, (_, n, gone, _) in want.items():
        assert (i in rows) == (gone == 0 or gone < n)
        if i in rows and gone:
            assert len(rows[i].text.split()) == n - gone and rows[i].n_chars == len(rows[i].text)

    pieces = cp.pack(spark, cut, SF).collect()
    assert {r.doc_id for r in pieces} == set(rows)


def test_doubled_rows_and_two_texts_under_one_id(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    near = text["c"] + " more"
    rows = [(1, text["a"]), (1, text["a"]), (2, text["a"]), (2, text["b"]), (3, text["c"]), (4, near), (4, text["d"]),
            (5, "bad " * 40), (5, "short and clean"), (None, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = np.zeros((1 << quality.BITS) + 1, np.float32)
    weights[quality.features("bad " * 40)[0]] = -9
    good = quality.drop_poor(docs, weights, 0.4)
    assert sorted(map(str, good.collect())) == sorted(str(r) for r in docs.collect() if "bad" not in r.text)
    once = cp.drop_copies(spark, good, SF)
    assert once.where("doc_id = 1").count() == 1 and [r.text for r in once.where("doc_id = 2").collect()] == [text["b"]]
    out = cp.cut_repeats(spark, cp.drop_near_copies(spark, once, SF), SF)
    want = [(1, text["a"]), (2, text["b"]), (3, text["c"]), (4, text["d"]), (5, "short and clean"), (None, "null")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    doubled = docs.where("doc_id = 1")
    assert [tuple(r) for r in cp.drop_near_copies(spark, doubled, SF).collect()] == [(1, text["a"])]


def test_what_the_classifier_rejects_does_not_go_on(spark):
    from citecube.llm.queries import op1_quality

    rejected = {r.doc_id for r in op1_quality(spark, SF).where("predicted = 0").collect()}
    good = cp.keep_good(spark, read_table(spark, SF, "documents"), SF)
    assert cp.REJECT_BELOW == 0.7 and rejected and not rejected & {r.doc_id for r in good.collect()}


def test_run(spark):
    assert cp.run(spark, SF).count() > 0
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "exact dedup", "near-dedup", "substring dedup", "packing"]


def test_steps_after_encoding_hold_no_tokenizer(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "_TOKENIZERS", {})
    path = public_tokenizers.path("word_bpe_49k.json")
    first = packing.tokenizer(path)
    assert packing.tokenizer(path) is first
    packing.forget_tokenizers()
    assert not packing._TOKENIZERS


def test_a_task_that_cuts_calls_python_once(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text + " one", 1), (2, text + " two", 2), (3, "apart", 3)], "doc_id long, text string, n_chars long")
    cut = cp.cut_repeats(spark, docs, SF)
    assert cut._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, cut.collect())) == [(1, "one", 3), (2, "two", 3), (3, "apart", 3)]


def test_exact_dedup_moves_whole_rows_once(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "a b"), (2, "a b"), (2, "own"), (3, None), (4, ""), (None, "a b"), (None, "a b"), (5, "c"), (5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    once = cp.drop_copies(spark, docs, SF)
    got = sorted(((i, " ".join((t or "").split())) for i, t in once.collect()), key=str)
    assert got == sorted([(1, "a b"), (2, "own"), (3, ""), (None, "a b"), (None, "a b"), (5, "c")], key=str)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "sha2" not in plan
