"""Language identification: nearest of several clustered centroids per language.

A text is a vector of hashed letter trigrams (ASCII lower-cased, other bytes of UTF-8 as they are, everything but letters
a space), (1 + log tf) * idf, of length 1. Each language has a few centroids from spherical k-means. The nearest
centroid by cosine gives the language; a text too far from all of them is marked as rejected. How far is too far
depends on the length: for each power of two of trigrams it is a quarter of the cosine that all but one in a hundred
passages of that length, drawn from training vectors, reach. Texts below 16 trigrams are never rejected for distance.

The model is fitted on about `per_language` labelled rows of each language, chosen by a hash of the id (the documented
bound), without texts that have no trigram; prediction covers every whole text. Null texts and texts without a letter are `und`, score 0, rejected. With
nothing to learn from, all are `und`, and only texts without a letter are rejected. Equal cosines go to the language with more training rows, then the smaller name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace.llm.textbytes import Slice, byte_set, slices
from runtrace.sources.staging import small_batches, stage

FEATURES = 1 << 14
PER_LANGUAGE = 1000
CENTROIDS = 3
FEW_LANGUAGES = 10_000
_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_ASCII_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))
#: Vectors are dense for a short while: so many bytes of text at once, and so many texts, however short.
_BYTES = 400_000
_TEXTS = 64


def trigram_counts(part: Slice) -> np.ndarray:
    """Counts of hashed trigrams, a row for each text."""
    letters = np.where(_LETTERS[part.bytes], part.bytes, 32).astype(np.uint32)
    if len(letters) == 0:
        return np.zeros((part.n, FEATURES), np.float32)
    before, after = np.concatenate([[32], letters[:-1]]).astype(np.uint32), np.concatenate([letters[1:], [32]]).astype(np.uint32)
    key = before << np.uint32(16) | letters << np.uint32(8) | after
    key = (key * np.uint32(0x9E3779B1)) >> np.uint32(18)
    owner = np.repeat(np.arange(part.n), part.ends - part.starts + 1)
    inside = np.flatnonzero(letters != 32)
    counts = np.bincount(owner[inside] * FEATURES + key[inside], minlength=part.n * FEATURES)
    return counts.reshape(part.n, FEATURES).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Vectors of length 1 from counts; 0 stays 0."""
    vectors = np.log1p(counts) * idf
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors / np.where(norms == 0, 1, norms)[:, None]


def has_letter(part: Slice) -> np.ndarray:
    """Whether each text has a letter of any script."""
    at = np.concatenate([[0], np.cumsum(_ASCII_LETTERS[part.bytes])])
    found = at[part.ends] > at[part.starts]
    high = np.concatenate([[0], np.cumsum(part.bytes >= 0x80)])
    for i in np.flatnonzero(~found & (high[part.ends] > high[part.starts])):
        found[i] = any(map(str.isalpha, part.bytes[part.starts[i]:part.ends[i]].tobytes().decode("utf-8", "ignore")))
    return found


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floors: np.ndarray

    def predict(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, cosine, and whether the text is too far from all."""
        counts = trigram_counts(part)
        cosines = weigh(counts, self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(part.n), best], 0, 1).astype(np.float64)
        size = np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int)
        return self.owner[best], score, score < self.floors[np.minimum(size, len(self.floors) - 1)]


def _mean(vectors: np.ndarray, chosen: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """Mean of the chosen rows; a few columns are copied at once."""
    return np.concatenate([vectors[chosen, at:at + at_once].mean(axis=0) for at in range(0, vectors.shape[1], at_once)])


def _centroids(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: start from the mean and the farthest vectors, ten rounds."""
    chosen = [vectors.mean(axis=0)]
    nearest = vectors @ chosen[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(vectors[nearest.argmin()])
        nearest = np.maximum(nearest, vectors @ chosen[-1])
    centres = np.array(chosen, np.float32)
    for _ in range(10):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        near = (vectors @ centres.T).argmax(axis=1)
        for j in range(len(centres)):
            if (near == j).any():
                centres[j] = _mean(vectors, near == j)
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def _floors(some: np.ndarray, idf: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """By power of two of trigrams, the cosine below which a text is too far; some: counts of some texts."""
    dice, floors = np.random.default_rng(7), np.zeros(32)
    for power in range(4, 32):
        size = 1 << power
        long = some[some.sum(axis=1) >= size]
        if len(long) == 0:
            floors[power] = floors[power - 1]
            continue
        drawn = np.zeros((len(long), FEATURES), np.float32)
        for i, row in enumerate(long):
            row = row.astype(np.float64)
            drawn[i] = dice.multinomial(size, row / row.sum())
        cosines = (weigh(drawn, idf) @ centres.T).max(axis=1)
        floors[power] = 0.25 * np.quantile(cosines, 0.01)
    return floors


def _sparse(counts: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes(), counts[at].astype(np.float32).tobytes()


def _dense(rows: pd.DataFrame) -> np.ndarray:
    out = np.zeros((len(rows), FEATURES), np.float32)
    for i, (at, values) in enumerate(zip(rows["at"], rows["counts"])):
        out[i, np.frombuffer(at, np.uint16)] = np.frombuffer(values, np.float32)
    return out


def _fitted(rows: pd.DataFrame, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and floors of a language; only its vectors are held whole and dense."""
    vectors = np.zeros((len(rows), FEATURES), np.float32)
    for at in range(0, len(rows), _TEXTS):
        vectors[at:at + _TEXTS] = weigh(_dense(rows.iloc[at:at + _TEXTS]), idf)
    centres = _centroids(vectors, k)
    del vectors
    return centres, _floors(_dense(rows.iloc[:: max(1, len(rows) // 100)]), idf, centres)


def train(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> LanguageModel | None:
    """Fit on the learnable rows with a language: columns doc_id, text, lang."""
    spark = docs.sparkSession
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = stage(rows.groupBy("lang").count(), "language-sizes")
    if sizes.count() <= FEW_LANGUAGES:
        sizes = F.broadcast(sizes)  # else Spark joins as it sees fit
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count"))
    lot = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    chosen = rows.select("doc_id", "lang", "text").join(sizes.select("lang", share.alias("share")), "lang")
    chosen = chosen.where(lot < F.col("share")).select("lang", "text")

    def vectors(batches):
        for batch, part in slices(batches, size=_BYTES, most=_TEXTS):
            both = [_sparse(row) for row in trigram_counts(part)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b[0] for b in both], pa.binary()), pa.array([b[1] for b in both], pa.binary())],
                names=["lang", "at", "counts"]).filter(pa.array([len(b[0]) > 0 for b in both], pa.bool_()))

    with small_batches(spark):
        sample = stage(chosen.mapInArrow(vectors, "lang string, at binary, counts binary"), "language-sample")

    def document_counts(batches):
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for at in batch.column(0).to_pylist():
                df[np.frombuffer(at, np.uint16)] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["df", "n"])

    parts = sample.select("at").coalesce(16).mapInArrow(document_counts, "df binary, n bigint").collect()
    n = sum(p.n for p in parts)
    if not n:
        return None
    df = sum(np.frombuffer(p.df, np.int64) for p in parts)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "counts"])  # the order of a shuffle is not always the same
        centres, floors = _fitted(rows, idf, k)
        return pd.DataFrame([{"lang": rows["lang"].iloc[0], "n": len(rows), "centres": centres.tobytes(), "floors": floors.tobytes()}])

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, n bigint, centres binary, floors binary").collect()
    fitted.sort(key=lambda r: (-r.n, r.lang))
    centres = [np.frombuffer(r.centres, np.float32).reshape(-1, FEATURES) for r in fitted]
    floors = np.min([np.frombuffer(r.floors) for r in fitted], axis=0)
    return LanguageModel([r.lang for r in fitted], idf, np.vstack(centres), np.repeat(np.arange(len(fitted)), [len(c) for c in centres]), floors)


def predict(docs: DataFrame, model: LanguageModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred, score (cosine), rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        model = shared.value
        for batch, part in slices(batches, "text", size=_BYTES, most=_TEXTS):
            names, score, far = _judged(part, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(far)],
                                             names=["key", "lang_pred", "score", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(work, f"key {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("key", key)


def _judged(part: Slice, model: LanguageModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and whether it is rejected, for each text."""
    spoken = has_letter(part)
    names, score, far = np.full(part.n, "und", object), np.zeros(part.n), ~spoken
    if model is not None:
        best, cosine, too_far = model.predict(part)
        names[spoken] = np.array(model.languages, object)[best[spoken]]
        score, far = np.where(spoken, cosine, 0), far | too_far
    return names, score, far


def without_rejected(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """The rows that have a language, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch, part in slices(batches, text, size=_BYTES, most=_TEXTS):
            yield batch.filter(pa.array(~_judged(part, shared.value)[2]))

    return docs.mapInArrow(work, docs.schema)
