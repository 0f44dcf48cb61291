"""Quality rules: word counts of whole texts and a trained classifier on hashed word and character n-grams.

The model is a logistic regression over the relative frequencies of hashed words, word pairs and 4-byte n-grams,
trained on a bounded sample of the rows of ``labels``; Platt scaling on the held-out part turns its score into a
probability, and fixed thresholds decide.  Texts are scored in Arrow batches with numpy, whole and in one pass.

Null or empty text: no words, so the base rules fail it.  Null ``doc_id`` and repeated rows: one result each.  Null or
repeated labels: nulls are left out, repeats count.  Without labels of both kinds the base rules decide alone.  Empty
table: no rows.  Other columns are ignored (``judge`` carries them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import mix64, table, with_text_column
from coderail.llm.words import BASE, Batch

#: Labelled documents used at most for training and calibration, drawn by a seeded hash of their id.
SAMPLE_DOCS = 4000
#: Every so many of them is held out for calibration.
HOLD_OUT = 4
#: Hash space of each of the two kinds of features.
BITS = 17
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document is kept from this calibrated probability of good quality on: below one half, as a clean document lost
#: weighs more than a poor one kept (on held-out labels nearly all poor ones lie below 0.01).
MIN_PROBABILITY = 0.2
SLICE_BYTES = 1 << 20

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Texts(Batch):
    """What the rules and the classifier read off the words of some texts."""

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.ends] - sums[self.starts]

    def repeat_words(self, width: int = 5) -> np.ndarray:
        """Words in windows of ``width`` words that the same text holds twice or more."""
        n, out = len(self.word_hash), np.zeros(len(self.ends), np.int64)
        if n < width:
            return out
        with np.errstate(over="ignore"):
            h = np.zeros(n - width + 1, np.uint64)
            for k in range(width):
                h = (h + self.word_hash[k : n - width + 1 + k]) * BASE
            h = mix64(h + self.word_doc[: len(h)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        inside = np.flatnonzero(self.word_doc[width - 1 :] == self.word_doc[: len(h)])
        order = inside[np.argsort(h[inside], kind="stable")]
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(n - width + 1, bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for k in range(width):
            covered[k : n - width + 1 + k] |= again
        return np.bincount(self.word_doc[covered], minlength=len(out))

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashed features and the text of each: words and word pairs, then byte 4-grams (upper half of the space)."""
        shift = np.uint64(64 - BITS)
        with np.errstate(over="ignore"):
            pair = mix64(self.word_hash[:-1] * BASE + self.word_hash[1:])
            pair = pair[self.word_doc[:-1] == self.word_doc[1:]]
            pair_doc = self.word_doc[:-1][self.word_doc[:-1] == self.word_doc[1:]]
            words = np.concatenate([self.word_hash, pair]) >> shift
            d = self.data.astype(np.uint32)
            gram = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
            gram = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)) + np.uint32(1 << BITS)
        at = np.arange(len(gram))
        doc = np.searchsorted(self.ends, at, side="right")
        inside = at + 3 < self.ends[doc] if len(at) else np.zeros(0, bool)
        return words.astype(np.int64), np.concatenate([self.word_doc, pair_doc]), gram[inside].astype(np.int64), doc[inside]


def base_counts(texts: list[str | None], batch: Texts) -> pd.DataFrame:
    dup = []
    for t in texts:
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")]
        dup.append(len(lines) - len(set(lines)))
    return pd.DataFrame({
        "n_words": batch.n_words, "word_chars": batch.per_doc(~batch.blank & (batch.data & 0xC0 != 0x80)),
        "n_symbols": batch.per_doc(SYMBOL[batch.data]), "n_dup_lines": dup, "n_repeat_words": batch.repeat_words()})


def scores(batch: Texts, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the words' features plus mean weight of the 4-grams, per text."""
    out = np.zeros(len(batch.ends))
    words, word_doc, grams, gram_doc = batch.features()
    for index, doc in ((words, word_doc), (grams, gram_doc)):
        total = np.bincount(doc, weights=weights[index], minlength=len(out))
        out += total / np.maximum(1, np.bincount(doc, minlength=len(out)))
    return out


def train(texts: list[str], labels: np.ndarray, rounds: int = 60, l2: float = 1e-7) -> tuple[np.ndarray, float, float]:
    """Weights, then slope and offset of the calibration; Adagrad over the full sample, kinds weighed evenly."""
    held = np.arange(len(texts)) % HOLD_OUT == 0
    cols, rows, vals = [], [], []
    first = 0
    for at in np.array_split(np.arange(len(texts)), max(1, len(texts) // 200)):
        words, word_doc, grams, gram_doc = Texts([texts[i] for i in at]).features()
        for index, doc in ((words, word_doc), (grams, gram_doc)):
            n = np.bincount(doc, minlength=len(at))
            key, count = np.unique(doc.astype(np.int64) << (BITS + 1) | index, return_counts=True)
            doc = key >> (BITS + 1)
            cols.append((key & ((2 << BITS) - 1)).astype(np.int32))
            rows.append((doc + first).astype(np.int32))
            vals.append((count / n[doc]).astype(np.float32))
        first += len(at)
    cols, rows, vals = np.concatenate(cols), np.concatenate(rows), np.concatenate(vals)
    y, n = labels.astype(float), len(texts)
    share = np.where(y > 0, 0.5 / max(1, (y[~held] > 0).sum()), 0.5 / max(1, (y[~held] <= 0).sum())) * ~held
    w, squares = np.zeros(2 << BITS), np.full(2 << BITS, 1e-12)
    for _ in range(rounds):
        z = np.bincount(rows, weights=w[cols] * vals, minlength=n)
        error = share * (1 / (1 + np.exp(-z)) - y)
        gradient = np.bincount(cols, weights=error[rows] * vals, minlength=len(w)) + l2 * w
        squares += gradient**2
        w -= 2.0 * gradient / np.sqrt(squares)
    z = np.bincount(rows, weights=w[cols] * vals, minlength=n)[held]
    slope, offset = calibrate(z, y[held])
    return w, slope, offset


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling by Newton steps, with Platt's smoothed targets."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, v = p - t, p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).sum() + 1e-6, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, [(g * z).sum() + 1e-6 * (a - 1), g.sum()])
        step *= min(1, 5 / np.abs(step).max()) if step.any() else 1
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def fit(labelled: DataFrame) -> tuple[np.ndarray, float, float] | None:
    """The model of a bounded sample (doc_id, text, quality), trained by one task; None without both classes."""

    def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([pd.DataFrame(columns=["doc_id", "text", "quality"]), *frames])
        pdf = pdf.sort_values(["doc_id", "text", "quality"], kind="stable")
        y = pdf["quality"].to_numpy(float)
        held = np.arange(len(y)) % HOLD_OUT == 0
        if min((y[held] > 0).sum(), (y[held] <= 0).sum(), (y[~held] > 0).sum(), (y[~held] <= 0).sum()) < 1:
            return
        w, a, b = train(list(pdf["text"]), y)
        yield pd.DataFrame([{"weights": w.astype("<f4").tobytes(), "slope": a, "offset": b}])

    got = labelled.repartition(1).mapInPandas(one, "weights binary, slope double, offset double").first()
    return got and (np.frombuffer(got["weights"], "<f4").astype(float), got["slope"], got["offset"])


def model_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, seed: int = 42):
    """The model of the labelled documents.  At most ``sample`` labels are drawn, so their rows may be broadcast."""
    drawn = (labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
             .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "quality").limit(sample))
    return fit(docs.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id"))


def judge(docs: DataFrame, model, name: str = "q_") -> DataFrame:
    """``docs`` with ``name``: a struct of the counts, base_failed, probability and kept."""

    def rate(texts: list[str | None]) -> pa.Array:
        batch = Texts(texts)
        out = base_counts(texts, batch)
        out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
        p = np.ones(len(out))
        if model is not None:
            p = 1 / (1 + np.exp(-np.clip(model[1] * scores(batch, model[0]) + model[2], -500, 500)))
        out["probability"], out["kept"] = p, ~out["base_failed"] & (p >= MIN_PROBABILITY)
        return pa.StructArray.from_arrays([pa.array(out[c]) for c in out], names=list(out))

    return with_text_column(docs, name, f"struct<{COUNTS}, base_failed boolean, probability double, kept boolean>",
                            rate, SLICE_BYTES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, model_of(docs, table(spark, sf_dir, "labels"))).select("doc_id", "q_.*")
