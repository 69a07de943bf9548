"""Toxicity scores from a factorization machine over hashed terms.

A text is a bag of hashed terms: lower-cased words and their first bytes (so that inflected and
compounded forms share a term), valued by the logarithm of their count, plus its length. The
model adds to the linear weights an interaction weight for every pair of terms, the product of
two learned vectors; it can tell an insult beside a group name, or many beside a short length,
from either alone.

Fitting uses at most about ``max_rows`` labelled rows (chosen by a hash of the id); the term
statistics over them are sums in Spark, and only the ``n_terms`` most telling terms enter the
machine. Scoring covers all rows and whole texts.

Handling of odd input: NULL and empty texts have no terms and get the score of a text without
any; rows without a label, or with a NULL id, are never used for fitting; with no usable label of
either class, or no labelled text, every score is the share of toxic labels (0 without labels); equal texts score
alike; other columns are passed on, existing ``score`` and ``predicted`` columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.llm.kernels import Words, runs, utf8
from streamlab.llm.session import slices, with_python

MAX_FIT_ROWS = 30_000
N_TERMS = 1_024
FACTORS = 8
PREFIXES = (4, 6, 8)
BITS = 22
THRESHOLD = 0.3
# keeps a word apart from a prefix of the same letters; the last one spreads the bits
_KIND = (0, 0x632BE59BD9B4E019, 0xB5AD4ECEDA1CE2A9, 0x8CB92BA72F3D8DD7, 0x9E3779B97F4A7C15)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def bags(texts: pa.Array, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of documents: (row of each term, term, count, words of each row).

    ``known`` is a table of term -> position (-1: not wanted); terms are then positions.
    """
    data, offsets = utf8(texts)
    for a, b in runs(offsets):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], _LETTER)
        doc, size = words.doc_index(), words.ends - words.starts
        rows, terms = [], []
        for k, length in enumerate((None, *PREFIXES)):
            h = (words.hashes(length) ^ np.uint64(_KIND[k])) * np.uint64(_KIND[-1]) >> np.uint64(64 - BITS)
            use = np.ones(len(h), bool) if length is None else size >= length
            term = h.astype(np.int64)
            if known is not None:
                term = known[term].astype(np.int64)
                use &= term >= 0
            rows.append(doc[use])
            terms.append(term[use])
        key = (np.concatenate(rows) << BITS) | np.concatenate(terms)
        key, count = np.unique(key, return_counts=True)
        yield (key >> BITS) + a, key & ((1 << BITS) - 1), count, np.diff(words.of_doc)


def _places(terms: np.ndarray) -> np.ndarray:
    """Table of term -> position among the machine's terms, -1 for others."""
    known = np.full(1 << BITS, -1, np.int16 if len(terms) < 1 << 15 else np.int32)
    known[terms] = np.arange(len(terms))
    return known


@dataclass
class Machine:
    """Fitted model: terms of the machine and its weights (the last one is the text's length)."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score_batch(self, texts: pa.Array) -> np.ndarray:
        known, parts = _places(self.terms), []
        first = 0
        for row, term, count, words in bags(texts, known):
            x = np.log1p(count.astype(float))
            parts.append(self._margin(row - first, term, x, _length(words)))
            first += len(words)
        margin = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))

    def _margin(self, row, term, x, length) -> np.ndarray:
        n = len(length)
        value = self.bias + np.bincount(row, x * self.linear[term], n) + length * self.linear[-1]
        for f in range(self.factors.shape[1]):
            v = self.factors[:, f]
            one = np.bincount(row, x * v[term], n) + length * v[-1]
            two = np.bincount(row, (x * v[term]) ** 2, n) + (length * v[-1]) ** 2
            value += (one**2 - two) / 2
        return value


def _length(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) / 4


def train(row, term, x, length, y, n_terms: int, terms: np.ndarray, rounds: int = 250, decay: float = 2e-4) -> Machine:
    """Logistic loss, full-batch Adam; deterministic."""
    n, p = len(y), n_terms + 1
    row = np.concatenate([row, np.arange(n)])
    term = np.concatenate([term, np.full(n, n_terms)])
    x = np.concatenate([x, length])
    rng = np.random.default_rng(7)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    weights = np.zeros((p, FACTORS + 1))
    weights[:, 1:] = rng.normal(0, 0.02, (p, FACTORS))
    bias = np.array([np.log(share / (1 - share))])
    moment = [np.zeros_like(weights), np.zeros_like(weights), np.zeros(1), np.zeros(1)]
    columns = range(1, FACTORS + 1)
    for t in range(1, rounds + 1):
        xw = [x * weights[term, f] for f in range(FACTORS + 1)]
        sums = [np.bincount(row, v, n) for v in xw]
        margin = bias[0] + sums[0]
        for f in columns:
            margin += (sums[f] ** 2 - np.bincount(row, xw[f] ** 2, n)) / 2
        error = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y) / n
        e = error[row] * x
        slope = np.empty_like(weights)
        slope[:, 0] = np.bincount(term, e, p)
        for f in columns:
            slope[:, f] = np.bincount(term, e * (sums[f][row] - xw[f]), p)
        slope += decay * weights
        for k, (value, g) in enumerate(((weights, slope), (bias, np.array([error.sum()])))):
            m, s = moment[2 * k], moment[2 * k + 1]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return Machine(terms, float(bias[0]), weights[:, 0].copy(), weights[:, 1:].copy())


def constant(share: float) -> Machine:
    """A machine that gives every text the same score."""
    return Machine(np.zeros(0, np.int64), float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(1), np.zeros((1, FACTORS)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, n_terms: int = N_TERMS) -> Machine:
    """Fit on labelled rows: ``docs`` (doc_id, text), ``labels`` (doc_id, toxic)."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().dropDuplicates(["doc_id"])
    total = labels.count()
    share = min(1.0, max_rows / max(total, 1))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # about max_rows ids at most, 12 bytes each
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            y = batch["toxic"].to_numpy(zero_copy_only=False)
            for row, term, _, _ in bags(batch["text"]):
                seen, at = np.unique(term, return_inverse=True)
                bad = np.bincount(at, y[row] != 0, len(seen)).astype(np.int64)
                good = np.bincount(at, y[row] == 0, len(seen)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(bad), pa.array(good)], ["term", "bad", "good"])

    per_class = {r["toxic"]: r["n"] for r in chosen.groupBy((F.col("toxic") != 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = per_class.get(1, 0), per_class.get(0, 0)
    if not n_bad or not n_good:
        return constant(n_bad / max(n_bad + n_good, 1))
    p, q = F.col("bad") / n_bad, F.col("good") / n_good
    spread = F.sqrt(((F.col("bad") + F.col("good")) / (n_bad + n_good)) * (1.0 / n_bad + 1.0 / n_good))
    telling = (
        sample.mapInArrow(count_terms, "term long, bad long, good long")
        .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") + F.col("good") >= 5)
        .select("term", F.abs((p - q) / spread).alias("z"))
        .orderBy(F.desc("z"), "term").limit(n_terms)
    )
    terms = np.array([r["term"] for r in telling.collect()], np.int64)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _places(terms)
        for batch in slices(batches):
            first = 0
            for row, term, count, words in bags(batch["text"], known):
                n = len(words)
                cuts = np.searchsorted(row - first, np.arange(n + 1))
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"].cast(pa.int64()),
                        part["toxic"].cast(pa.int32()),
                        pa.array(words, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(count, pa.int32())),
                    ],
                    ["doc_id", "toxic", "words", "terms", "counts"],
                )
                first += n

    # about max_rows rows of a few terms each
    rows = sample.mapInArrow(reduce_rows, "doc_id long, toxic int, words long, terms array<int>, counts array<int>").toArrow()
    frame: pd.DataFrame = rows.to_pandas().sort_values("doc_id", kind="stable")
    if frame.empty:
        return constant(n_bad / (n_bad + n_good))
    size = frame["terms"].map(len).to_numpy()
    join = lambda c: np.concatenate([*frame[c], np.zeros(0, np.int32)]).astype(np.int64)
    return train(
        np.repeat(np.arange(len(frame)), size), join("terms"), np.log1p(join("counts").astype(float)),
        _length(frame["words"].to_numpy()), (frame["toxic"].to_numpy() != 0).astype(float), len(terms), terms,
    )


def score(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""

    def scored(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(machine.score_batch(texts))]

    out = with_python(docs, [text], {"score": T.DoubleType()}, scored)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of the id's text, modulo 4, is not 2."""
    return labels.where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
