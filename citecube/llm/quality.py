"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot
products.

Training reads a bounded sample of labelled documents (``TRAIN_ROWS``); the
weights are one vector of 2^BITS floats, a fixed size that every task gets.
Scoring is one narrow pass over all whole texts."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, pair_hash

BITS = 18
TRAIN_ROWS = 5000        # about so many labelled documents are learnt from, chosen by a hash of their id
EPOCHS = 3
REJECT_BELOW = 0.7       # score
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.1

REPEAT = np.uint64(0x1F0E157A9B3C2D47)   # stands for "the word before, again"
TOKEN = re.compile(r"\w+|[^\w\s]+")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text: its words and word pairs, hashed to 2^BITS
    places; values are log-scaled counts of unit length.  Runs of letters and
    digits and runs of other signs are words of their own; a word that repeats
    the one before also counts as one common pair, whichever word it is."""
    tokens = TOKEN.findall(text)
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    again = np.full((words[1:] == words[:-1]).sum(), REPEAT)
    grams = np.concatenate((words, pair_hash(words[:-1], words[1:]), again)) if len(words) else words
    place, count = np.unique(grams >> np.uint64(64 - BITS), return_counts=True)
    value = np.log1p(count)
    norm = np.sqrt((value * value).sum()) or 1.0
    return place.astype(np.int32), (value / norm).astype(np.float32)


class FollowTheLeader:
    """FTRL-proximal for logistic loss; weights are derived from (z, n) where a
    document touches them."""

    def __init__(self):
        size = (1 << BITS) + 1            # the last place is the bias, without penalty
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, place: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(place)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        old = self.n[place]
        self.n[place] = old + g * g
        self.z[place] += g - (np.sqrt(self.n[place]) - np.sqrt(old)) / ALPHA * w


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  usable: Column, bound: int) -> DataFrame:
    """Features of about ``bound`` labelled documents at most: (draw, label, place, value).
    Rows without a 0/1 label are left out."""
    labelled = (labels.where(F.col(label_col).isin(0, 1)).where(usable)
                .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"),
                        F.xxhash64(F.lit(5), F.col(id_col)).alias("draw")))
    share = min(1.0, bound / max(1, labelled.count()))
    chosen = labelled.where(F.pmod("draw", F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "id")

    def run(batches):
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("draw"), batch.column("label"), pa.array([p.tobytes() for p, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())], ["draw", "label", "place", "value"])

    return rows.select("draw", "label", "text").mapInArrow(run, "draw long, label int, place binary, value binary")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", usable: Column | None = None, bound: int = TRAIN_ROWS) -> np.ndarray:
    """Weights (bias last) learnt from the sample, in the order of the draw.
    Without labelled rows all weights are 0 and every score is 0.5."""
    usable = F.lit(True) if usable is None else usable
    rows = training_rows(docs, labels, id_col, text_col, label_col, usable, bound).collect()
    rows.sort(key=lambda r: (r["draw"], r["label"], r["place"]))
    data = []
    for r in rows:
        place = np.append(np.frombuffer(r["place"], np.int32), np.int32(1 << BITS))
        data.append((place, np.append(np.frombuffer(r["value"], np.float32), np.float32(1.0)), r["label"]))
    model = FollowTheLeader()
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(data)):
            model.learn(*data[i])
    return model.weights(slice(None)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row: the chance of label 1.  A null or empty text
    scores by the bias alone.  Rows that repeat an id are scored each; an empty
    table gives no rows; extra columns of any name are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # 2^BITS + 1 floats, whatever the input

    def run(batches):
        w = shared.value
        for batch in batches:
            for part in blocks(batch, "text"):
                out = []
                for text in part.column("text").to_pylist():
                    place, value = features(text)
                    out.append(1.0 / (1.0 + np.exp(-float(np.clip(w[place] @ value + w[-1], -35, 35)))))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, f"id {kind}, score double"))


def in_fold(id_col: str = "doc_id") -> Column:
    """True for the quarter of ids held out from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def drop_poor(docs: DataFrame, weights: np.ndarray, threshold: float, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, each by its
    own text; rows with a null id all stay.  One narrow pass: only texts go to
    Python, and nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def chance(texts: pd.Series) -> pd.Series:
        w, out = shared.value, []
        for text in texts:
            place, value = features(text)
            out.append(1.0 / (1.0 + np.exp(-float(np.clip(w[place] @ value + w[-1], -35, 35)))))
        return pd.Series(out, dtype="float64")

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.where(F.col(f"`{id_col}`").isNull() | (chance(text) >= threshold))
