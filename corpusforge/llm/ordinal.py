"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds split the
latent score into grades: P(grade >= k) = logistic(w.x - t_k). The expected grade and the tail
probabilities serve for selection.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, lean, narrow, strings, tune

BITS = 18
#: Bound of the training sample: about this many rated texts.
SAMPLE, MIN_TEXTS, L2, STEPS = 6000, 5, 2e-4, 250
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")


def features(text: str | None) -> np.ndarray:
    """Sorted hashed features of a whole text: its different words and symbol runs, and classes of its length and of its share of symbols."""
    tokens = TOKEN.findall((text or "").lower())
    symbols = sum(not t[0].isalnum() for t in tokens)
    names = {*tokens, f"length {len(tokens).bit_length()}", f"symbols {20 * symbols // max(len(tokens), 1)}"}
    return np.unique(np.fromiter((zlib.crc32(x.encode("utf-8", "replace")) & (1 << BITS) - 1 for x in names), np.int32, len(names)))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # rising

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """(texts, thresholds): P(grade >= k)."""
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        sums = np.add.reduceat(self.weights[flat], np.cumsum([0, *map(len, rows[:-1])])) if rows else np.empty(0)
        return logistic(sums[:, None] - self.thresholds[None, :])


def fit(rows: list[np.ndarray], grades: np.ndarray, levels: int) -> Model:
    """Maximum likelihood with an L2 penalty by Adam over the whole sample; only features of at least MIN_TEXTS texts get a weight."""
    used = np.nonzero(np.bincount(np.concatenate(rows), minlength=1 << BITS) >= MIN_TEXTS)[0]
    index = np.full(1 << BITS, -1)
    index[used] = np.arange(len(used))
    rows = [x[x >= 0] for x in (index[r] for r in rows)]
    owner, flat, n = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows), len(rows)
    share = np.bincount(grades, minlength=levels) / n
    tail = np.clip(1 - np.cumsum(share)[:-1], 0.01, 0.99)
    start = np.log((1 - tail) / tail)
    params = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second, w_n = np.zeros_like(params), np.zeros_like(params), len(used)
    lower, upper = grades - 1, grades  # thresholds below and above each grade
    for step in range(1, STEPS + 1):
        t = np.cumsum(np.concatenate([params[w_n : w_n + 1], np.exp(params[w_n + 1 :])]))
        s = np.bincount(owner, params[flat], n)
        below = np.where(lower >= 0, logistic(s - t[np.maximum(lower, 0)]), 1.0)
        above = np.where(upper < levels - 1, logistic(s - t[np.minimum(upper, levels - 2)]), 0.0)
        p = np.maximum(below - above, 1e-9)
        d_below, d_above = below * (1 - below) / p, above * (1 - above) / p
        g_t = np.zeros(levels - 1)
        np.add.at(g_t, lower[lower >= 0], d_below[lower >= 0] / n)
        np.add.at(g_t, upper[upper < levels - 1], -d_above[upper < levels - 1] / n)
        g = np.concatenate([np.bincount(flat, (-(d_below - d_above) / n)[owner], w_n) + L2 * params[:w_n], [g_t.sum()], np.exp(params[w_n + 1 :]) * np.cumsum(g_t[::-1])[::-1][1:]])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = params[:w_n]
    return Model(weights, np.cumsum(np.concatenate([params[w_n : w_n + 1], np.exp(params[w_n + 1 :])])))


def train(documents: DataFrame, ratings: DataFrame, id: str = "doc_id", text: str = "text", grade: str = "grade", sample: int = SAMPLE) -> Model | None:
    """Learns from about `sample` rated texts, chosen by a hash of the id. ratings: (id, grade), grades from 0; rows with a
    null grade or without a document don't count, and of several grades of an id the lowest does. None if fewer than two grades are
    left, or on empty tables."""
    tune(documents.sparkSession)
    rated = narrow(ratings, id=id, grade=grade).filter("grade is not null and id is not null").groupBy("id").agg(F.min("grade").alias("grade"))
    total = rated.count()
    if not total:
        return None
    chosen = rated.filter(F.xxhash64("id") / float(1 << 64) + 0.5 < sample / total)  # about `sample` rows: safe to broadcast
    df = narrow(documents, id=id, text=text).join(F.broadcast(chosen), "id").select("id", "grade", "text")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array([features(t).tobytes() for t in strings(batch, "text")], pa.binary())], names=["id", "grade", "features"])

    rows = df.mapInArrow(lean(run), f"id {df.schema['id'].dataType.simpleString()}, grade int, features binary").collect()
    rows = sorted(rows, key=lambda r: (r.id, r.grade, r.features))[: 2 * sample]
    grades = np.array([r.grade for r in rows], int)
    if len(set(grades.tolist())) < 2:
        return None
    return fit([np.frombuffer(r.features, np.int32) for r in rows], grades, int(grades.max()) + 1)


def grade(documents: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns id, expected_grade, tail array<double> with P(grade >= k) for k = 1, 2, ... for every whole text.

    Null texts count as empty; very long ones are read whole. Without a model, expected_grade is null and tail is empty. Repeated rows
    stay and are graded alike; an empty table gives an empty result; other columns are ignored.
    """
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if shared.value is None:
                tails, expected = [[] for _ in range(batch.num_rows)], [None] * batch.num_rows
            else:
                p = shared.value.tails([features(t) for t in strings(batch, "text")])
                tails, expected = p.tolist(), p.sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected, pa.float64()), pa.array(tails, pa.list_(pa.float64()))], names=[id, "expected_grade", "tail"])

    return df.mapInArrow(lean(run), f"`{id}` {df.schema['id'].dataType.simpleString()}, expected_grade double, tail array<double>")


def label_grades(labels: DataFrame) -> DataFrame:
    """Graded ratings of the table labels: 0 toxic, 1 of low quality, 2 good. A null toxic counts as 0; a null quality leaves no grade unless toxic."""
    return labels.select("doc_id", F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))


def keep_good(documents: DataFrame, model: Model | None, min_tail: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose chance of the best grade is at least min_tail. Without a model all stay. Null texts count as
    empty; an empty table stays empty."""
    tune(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if shared.value and batch.num_rows:
                batch = batch.filter(pa.array(shared.value.tails([features(t) for t in strings(batch, text)])[:, -1] >= min_tail))
            yield batch

    return documents.mapInArrow(lean(run), documents.schema)
