"""Document quality by the votes of nearest labelled neighbours.

Documents become tf-idf vectors over hashed words, word shapes and a few counts, and these
are projected on the leading singular vectors of the labelled sample (latent semantics). The
labelled vectors are broadcast; for every document the cosines with all of them are computed
exactly, block by block, and the nearest ``NEIGHBOURS`` vote with their similarity as weight.

The sample is bounded: about ``SAMPLE`` labelled rows, chosen by a hash of the id; so are, with
it, the model, the broadcast and what reaches the driver. Every document is scored against it.

Null and empty texts, and those without a known feature, score the share of good labels in the
sample; without any label all score 0.5. Labels that repeat count each; null labels do not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the vectors are made from, about.
SAMPLE = 6000
SHAPES, WORDS, COUNTS = 512, 1024, 64
WIDTH = SHAPES + WORDS + COUNTS
DIMENSIONS, NEIGHBOURS, SHARPNESS = 64, 25, 8
BLOCK = 2048


def shape(word: str) -> str:
    """A word with its runs of letters and digits shortened: ``Aa``, ``A!!``, ``9.9``."""
    out = re.sub(r"\d+", "9", word)
    out = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", out)
    return out[:12]


class Codes(dict):
    """Two feature numbers of a word, remembered up to a bound: of its shape and of itself."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= 300_000:
            self.clear()
        plain = word.lower().strip(".,;:!?\"'()*#$%&|")
        code = self[word] = (xxh3_64_intdigest(shape(word)) % SHAPES) << 40 | (
            SHAPES + xxh3_64_intdigest(plain) % WORDS
        ) << 20 | xxh3_64_intdigest(word) % (1 << 20)
        return code


def features(text: str | None, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and counts of a text."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    c = np.array([codes[w] for w in words], dtype=np.int64)
    n = len(c)
    counts = np.bincount(c >> 40, minlength=WIDTH) + np.bincount((c >> 20) & 0xFFFFF, minlength=WIDTH)
    base = SHAPES + WORDS

    def bin_of(at: int, share: float) -> None:
        # The count of a bin is the length of the text, so that it weighs as much as all shapes.
        counts[base + at + min(7, int(share * 8))] += max(1, n // 4)

    _, each = np.unique(c[:-2] * 31 + c[1:-1] * 17 + c[2:], return_counts=True) if n > 2 else (None, np.ones(1))
    bin_of(0, float((c[1:] == c[:-1]).mean()) if n > 1 else 0.0)
    bin_of(8, float(each[each > 1].sum() / each.sum()))
    bin_of(16, len(np.unique(c)) / n)
    bin_of(24, min(0.99, np.log2(n) / 16))
    lines = [x for x in text.split("\n") if x.strip()]
    bin_of(32, 1 - len(set(lines)) / max(1, len(lines)))
    at = np.flatnonzero(counts)
    return at, counts[at].astype(float)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        x = np.zeros((len(found), WIDTH), np.float32)
        for i, (at, n) in enumerate(found):
            x[i, at] = np.log1p(n)
        x *= self.idf
        return unit(x @ self.basis)

    def score(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(found), self.prior)
        q = self.project(found)
        cos = q @ self.vectors.T
        k = min(NEIGHBOURS, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(float) ** SHARPNESS
        total = weight.sum(1)
        votes = (weight * self.labels[near]).sum(1)
        return np.where(total > 1e-12, votes / np.maximum(total, 1e-12), self.prior)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """The model of labelled rows; ``labels`` has the ids and labels to learn from."""
    labels = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    n = labels.count()
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = labels.where(part < int(1_000_000 * min(1.0, sample / max(1, n))) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            found = [features(t.as_py(), codes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.float64()),
                    pa.array([a for a, _ in found], pa.list_(pa.int64())),
                    pa.array([c for _, c in found], pa.list_(pa.float64())),
                ],
                names=["label", "at", "n"],
            )

    # The sample of labels is bounded, so it may be broadcast; texts are not shuffled.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.select("label", "text").mapInArrow(run, "label double, at array<bigint>, n array<double>").toArrow()
    y = np.array(rows.column("label").to_pylist(), np.float64)
    if not len(y):
        return Model(np.zeros(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    x = np.zeros((len(y), WIDTH), np.float32)
    for i, (at, c) in enumerate(zip(rows.column("at").to_pylist(), rows.column("n").to_pylist())):
        x[i, at] = np.log1p(c)
    idf = np.log((1 + len(y)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = np.ascontiguousarray(vectors[:, ::-1][:, :DIMENSIONS], dtype=np.float32)
    return Model(idf, basis, unit(x @ basis), y, float(y.mean()))


def scores(model: Model, spark, text: Column | str) -> Column:
    """The score of a text, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codes, model = Codes(), shared.value
        for texts in batches:
            out = []
            for i in range(0, len(texts), BLOCK):
                out.append(model.score([features(t.as_py(), codes) for t in texts[i : i + BLOCK]]))
            yield pa.array(np.clip(np.concatenate([*out, np.empty(0)]), 0, 1))

    return run(text)
