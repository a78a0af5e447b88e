"""Toxicity by multiple-instance learning.

A document is a bag of sentences (parts between . ! ? and line feeds). A sentence's score is a logistic function of the
sum of weights of its words and of their first 4, 5 and 6 bytes, ASCII lower-cased and hashed into `FEATURES` places.
The document's score is the noisy-or of its sentences: one toxic sentence is enough. Only document labels are known; the
weights are fitted to them through the noisy-or (full-batch Adam, the round with the best log loss on a fifth that is held
back). Only features have a weight that are in `MIN_DOCUMENTS` of the sample, and in toxic ones by `MIN_DEVIATIONS` standard
deviations more or less often than labels drawn by lot would have it.

The model is fitted on about `sample` labelled documents, chosen by a hash of the id (the documented bound). Scoring covers every
whole text. Null texts, and texts without words, have no sentence and score 0. Where the labels hold one class or none,
or no feature tells them apart, every score is the toxic share (0 without labels). A document with several labels counts once for each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace.llm.textbytes import ALPHANUMERIC, Slice, byte_set, slices
from runtrace.sources.staging import stage

FEATURES = 1 << 18
SAMPLE = 8000
MIN_DOCUMENTS = 5
MIN_DEVIATIONS = 4.0
PREFIXES = (4, 5, 6)
ROUNDS = 150
OFFENDING = 0.3
_STOPS = byte_set((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    constant: float | None = None


def features(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends, and a row of feature numbers for each word; a prefix that is the word, or longer, is -1."""
    starts, ends = part.runs(ALPHANUMERIC)
    out = np.full((len(starts), 1 + len(PREFIXES)), -1, np.int32)
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    out[:, 0] = part.hashes(starts, ends) >> shift
    for j, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(ends - starts > n)
        out[long, j] = (part.hashes(starts[long], starts[long] + n) * np.uint64(2 * n + 1)) >> shift
    return starts, ends, out


def sentences(part: Slice, word_starts: np.ndarray) -> np.ndarray:
    """A number for each word that is equal for words of one sentence and grows along the slice."""
    stops = np.cumsum(_STOPS[part.bytes]) if len(part.bytes) else np.zeros(0, np.int64)
    return stops[word_starts]


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, firsts) if len(firsts) else np.zeros(0)


def _firsts(numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else np.zeros(0, np.int64)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _logistic(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def score_slice(model: ToxicityModel, part: Slice) -> tuple[np.ndarray, list[list[dict]]]:
    """Document scores, and the offending sentences of each as byte places of the slice."""
    found: list[list[dict]] = [[] for _ in range(part.n)]
    if model.constant is not None:
        return np.full(part.n, model.constant), found
    starts, ends, numbers = features(part)
    z = np.concatenate([model.weights, [0.0]])[numbers].sum(axis=1)  # -1 is the last place
    firsts = _firsts(sentences(part, starts))
    z = _sums(z, firsts) + model.bias
    owner = part.texts_of(starts[firsts])
    clean = part.per_text(owner, _softplus(z))  # minus the log of the chance that no sentence is toxic
    lasts = np.concatenate([firsts[1:], [len(starts)]]) - 1 if len(firsts) else firsts
    for s in np.flatnonzero(z >= np.log(OFFENDING / (1 - OFFENDING))).tolist():
        found[owner[s]].append({"start": int(starts[firsts[s]]), "end": int(ends[lasts[s]]), "score": float(_logistic(z[s]))})
    return -np.expm1(-clean), found


def fit(bags: pd.DataFrame, rounds: int = ROUNDS) -> ToxicityModel:
    """Weights from rows of toxic (0 or 1), numbers (int32, a row of features a word) and sentence (int32 a word)."""
    labels = bags["toxic"].to_numpy(np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        return ToxicityModel(np.zeros(0), 0.0, float(labels[0]) if len(labels) else 0.0)
    width = 1 + len(PREFIXES)
    rows = [np.frombuffer(x, np.int32).reshape(-1, width) for x in bags["numbers"]]
    held = np.arange(len(labels)) % 5 == 4
    learn = ~held
    in_documents, in_toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    for r, toxic in zip([rows[i] for i in np.flatnonzero(learn)], labels[learn]):
        there = np.unique(r)
        there = there[there >= 0]
        in_documents[there] += 1
        in_toxic[there] += toxic
    share = labels[learn].mean()
    apart = np.abs(in_toxic - in_documents * share) / np.sqrt(np.maximum(in_documents * share * (1 - share), 1e-9))
    use = np.concatenate([(in_documents >= MIN_DOCUMENTS) & (apart >= MIN_DEVIATIONS), [False]])
    if not use.any():
        return ToxicityModel(np.zeros(0), 0.0, float(labels.mean()))
    flat, sentence, document, at = [], [], [], 0
    for d, (r, s) in enumerate(zip(rows, bags["sentence"])):
        if not len(r):
            continue
        s = np.frombuffer(s, np.int32)
        first = _firsts(s)
        index = np.searchsorted(first, np.arange(len(s)), side="right") - 1 + at
        word, column = np.nonzero(use[r])
        flat.append(r[word, column])
        sentence.append(index[word])
        document += [d] * len(first)
        at += len(first)
    places, inverse = np.unique(np.concatenate(flat), return_inverse=True)
    sentence, document = np.concatenate(sentence), np.array(document)
    w, bias = np.zeros(len(places)), -5.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    best = (np.inf, w, bias)
    for step in range(1, rounds + 1):
        z = np.bincount(sentence, w[inverse], minlength=at) + bias
        clean = np.bincount(document, _softplus(z), minlength=len(labels))
        p = np.clip(-np.expm1(-clean), 1e-9, 1 - 1e-9)
        loss = -(labels * np.log(p) - (1 - labels) * clean)
        if loss[held].mean() < best[0]:
            best = (loss[held].mean(), w.copy(), bias)
        # d loss / d z of a sentence is its own chance, times 1 in clean documents and -(1 - p) / p in toxic ones.
        pull = np.where(labels == 1, -(1 - p) / p, 1.0) * learn / learn.sum()
        dz = pull[document] * _logistic(z)
        g = np.bincount(inverse, dz[sentence], minlength=len(w)) + 1e-6 * w
        gb = dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        one, two = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.15 * (m / one) / (np.sqrt(v / two) + 1e-9)
        bias -= 0.15 * (mb / one) / (np.sqrt(vb / two) + 1e-9)
    weights = np.zeros(FEATURES, np.float32)
    weights[places] = best[1]
    return ToxicityModel(weights, float(best[2]))


def train(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on the labelled rows that are learnable: docs (doc_id, text), labels (doc_id, toxic)."""
    spark = docs.sparkSession
    known = labels.where(learnable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    n = known.count()
    lot = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    chosen = stage(known.where(lot < F.lit(min(1.0, sample / max(n, 1)))), "toxic-labels")
    if chosen.count() <= 2 * sample:
        chosen = F.broadcast(chosen)

    def bags(batches):
        for batch, part in slices(batches, "text"):
            starts, _, numbers = features(part)
            said = sentences(part, starts).astype(np.int32)
            cuts = np.searchsorted(starts, part.ends)
            rows = [(a, b) for a, b in zip([0, *cuts[:-1]], cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([numbers[a:b].tobytes() for a, b in rows], pa.binary()),
                 pa.array([said[a:b].tobytes() for a, b in rows], pa.binary())],
                names=["doc_id", "toxic", "numbers", "sentence"])

    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", F.col("toxic").cast("double").alias("toxic"), "text")
    rows = stage(texts.mapInArrow(bags, "doc_id bigint, toxic double, numbers binary, sentence binary"), "toxic-bags")

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        model = fit(frame.sort_values(["doc_id", "toxic"]))
        return pd.DataFrame([{"weights": model.weights.astype(np.float32).tobytes(), "bias": model.bias, "constant": model.constant}])

    done = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(learn, "weights binary, bias double, constant double").collect()
    if not done:
        return fit(pd.DataFrame({"toxic": [], "numbers": [], "sentence": []}))
    constant = done[0].constant
    return ToxicityModel(np.frombuffer(done[0].weights, np.float32), done[0].bias, None if constant is None or np.isnan(constant) else constant)


_SENTENCES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, score, and the offending sentences (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch, part in slices(batches, "text"):
            scores, found = score_slice(shared.value, part)
            for i, spans in enumerate(found):
                if spans:
                    first = part.starts[i]
                    begins = np.concatenate([[0], np.cumsum((part.bytes[first:part.ends[i]] & 0xC0) != 0x80)])
                    for s in spans:
                        s["start"], s["end"] = int(begins[s["start"] - first]), int(begins[s["end"] - first])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, _SENTENCES)],
                                             names=["key", "score", "sentences"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = f"key {kind}, score double, sentences array<struct<start:bigint,end:bigint,score:double>>"
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)
