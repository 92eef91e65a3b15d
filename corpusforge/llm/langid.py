"""Language identification with string kernels.

Texts are compared by which character n-grams of several lengths (a blended spectrum) they have at
all: presence kernels, normalised by the numbers of n-grams. Nyström landmarks make the kernel finite,
one-versus-rest kernel ridge regression is solved on them, and texts are scored in batches by
matrix products of presence bits and landmark bits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, lean, narrow, strings, tune

BITS, GRAMS = 13, (1, 2, 3)
#: Bound of the training sample: about this many texts a language, and landmarks a language.
PER_LANGUAGE, LANDMARKS, RIDGE = 400, 40, 1e-2
#: An n-gram is familiar to a language if at least this share of its training texts have it.
FAMILIAR = 0.02
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")
SEEDS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)  # odd 32-bit multipliers


def normalise(text: str | None) -> str | None:
    """Lower case, runs of anything but letters as one space; None if there is no letter."""
    clean = NO_LETTERS.sub(" ", text.lower()) if text else ""
    return f" {clean.strip()} " if any(map(str.isalpha, clean)) else None


def presence(text: str | None) -> np.ndarray | None:
    """Which hashed n-grams the whole text has, as 0 and 1; None without letters."""
    clean = normalise(text)
    if clean is None:
        return None
    codes, out = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32), np.zeros(1 << BITS, np.uint8)
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        h = (h[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint32(SEEDS[(n - 1) % 3])
        h ^= h >> np.uint32(15)
        if n in GRAMS:
            out[(h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)] = 1
    return out


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # float32, landmarks x bits
    size: np.ndarray  # square roots of the landmarks' numbers of n-grams
    weights: np.ndarray  # (landmarks + 1) x languages
    familiar: np.ndarray  # 0 and 1, languages x bits
    usual: np.ndarray  # what share of a text's n-grams is familiar, the median of texts of each language

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return with_one(kernel(bits.astype(np.float32), self.landmarks, self.size)) @ self.weights

    def familiarity(self, bits: np.ndarray) -> np.ndarray:
        """Of the best language alone: the share of familiar n-grams, by the usual one. Other languages don't enter, nor does their number."""
        best = self.scores(bits).argmax(axis=1)
        return known(bits, self.familiar[best]) / self.usual[best]


def known(bits: np.ndarray, familiar: np.ndarray) -> np.ndarray:
    return (bits & familiar).sum(axis=-1, dtype=np.int64) / np.maximum(bits.sum(axis=-1, dtype=np.int64), 1)


def kernel(bits: np.ndarray, landmarks: np.ndarray, size: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(bits.sum(axis=1), 1))
    return (bits @ landmarks.T) / own[:, None] / size[None, :]


def with_one(k: np.ndarray) -> np.ndarray:
    return np.hstack([k, np.ones((len(k), 1), k.dtype)])


def fit(languages: list[str], bits: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """One-versus-rest ridge regression in the landmarks' feature space, each language weighing the same."""
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages])
    chosen = np.concatenate([np.nonzero(y == c)[0][:landmarks] for c in range(len(names))])
    x = bits.astype(np.float32)
    marks = x[chosen]
    size = np.sqrt(np.maximum(marks.sum(axis=1), 1))
    values, vectors = np.linalg.eigh(kernel(marks, marks, size).astype(np.float64))
    whiten = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    phi = with_one(kernel(x, marks, size).astype(np.float64) @ whiten)
    target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    weight = (len(y) / len(names) / np.bincount(y, minlength=len(names)))[y][:, None]
    gram = phi.T @ (phi * weight) / len(y)
    beta = np.linalg.solve(gram + ridge * np.diag([1.0] * len(chosen) + [1e-6]), phi.T @ (target * weight) / len(y))
    own = [bits[y == c] for c in range(len(names))]
    familiar = np.stack([(b[::2].mean(axis=0) >= FAMILIAR).astype(np.uint8) for b in own])
    usual = np.array([max(np.median(known(b[1::2] if len(b) > 1 else b, f)), 1e-6) for b, f in zip(own, familiar)])  # on texts that weren't counted
    return Model(names, marks, size, np.vstack([whiten @ beta[:-1], beta[-1:]]).astype(np.float32), familiar, usual)


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Learns from about per_language labelled texts of each language outside the held-out part, chosen by a hash of
    the id; None if there are none. The number of different labels is taken to be small."""
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text, lang=lang).filter(~held_out(F.col("id")) & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in df.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    draw = F.xxhash64("id", "lang", F.when(F.col("id").isNull(), F.xxhash64("text"))) / float(1 << 64) + 0.5  # rows without id are drawn one by one
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])[F.col("lang")]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            bits = [presence(t) for t in strings(batch, "text")]
            keep = [i for i, b in enumerate(bits) if b is not None]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(keep, pa.int64())) for k in (0, 1)), pa.array([np.packbits(bits[i]).tobytes() for i in keep], pa.binary())], names=["lang", "draw", "bits"])

    rows = df.withColumn("draw", draw).filter(F.col("draw") < share).select("lang", "draw", "text").mapInArrow(lean(run), "lang string, draw double, bits binary").collect()
    rows = sorted(rows, key=lambda r: (r.draw, r.lang, r.bits))
    kept, seen = [], dict.fromkeys(counts, 0)
    for r in rows:
        seen[r.lang] += 1
        if seen[r.lang] <= 2 * per_language:
            kept.append(r)
    if not kept:
        return None
    return fit([r.lang for r in kept], np.unpackbits(np.frombuffer(b"".join(r.bits for r in kept), np.uint8).reshape(len(kept), -1), axis=1))


def identify(documents: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns id, held_out, lang_pred, score (0 to 1) for every whole text.

    A text that is null, empty or has no letter, or any text if nothing was learned, is `und` with score 0. Equal scores go to the
    alphabetically first language. Very long texts are read whole. Repeated rows stay and are predicted alike; an empty table gives an
    empty result; other columns are ignored.
    """
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text).withColumn("held_out", held_out(F.col("id")))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # languages x landmarks x 2^BITS numbers
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        model = shared.value
        for batch in batches:
            n, texts = batch.num_rows, strings(batch, "text")
            names, scores = [UNKNOWN] * n, [0.0] * n
            bits = [presence(t) for t in texts] if model else []
            have = [i for i, b in enumerate(bits) if b is not None]
            if have:
                f = model.scores(np.stack([bits[i] for i in have]))
                for i, best, value in zip(have, f.argmax(axis=1).tolist(), f.max(axis=1).tolist()):
                    names[i], scores[i] = model.languages[best], min(max((value + 1) / 2, 0.0), 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id, "held_out", "lang_pred", "score"])

    return df.select("id", "held_out", "text").mapInArrow(lean(run), f"`{id}` {kind}, held_out boolean, lang_pred string, score double")


def keep_known(documents: DataFrame, model: Model | None, min_score: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a letter and at least min_score of the familiarity that texts of its best
    language usually have. Without a model every text with a letter stays. Texts that are null, empty or without letters go; repeated rows stay or go
    together; an empty table stays empty; all columns come along as they are."""
    tune(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # languages x landmarks x 2^BITS numbers

    def run(batches: Batches) -> Batches:
        for batch in batches:
            bits = [presence(t) for t in strings(batch, text)]
            have = [i for i, b in enumerate(bits) if b is not None]
            if have and shared.value:
                found = shared.value.familiarity(np.stack([bits[i] for i in have]))
                have = [i for i, f in zip(have, found.tolist()) if f >= min_score]
            yield batch.take(pa.array(have, pa.int64()))

    return documents.mapInArrow(lean(run), documents.schema)
