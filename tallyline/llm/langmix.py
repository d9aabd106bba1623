"""Language identification by mixture inference.

Each language is a smoothed distribution over hashed character trigrams of words. A document
is a mixture: expectation-maximisation estimates the share of every language from the
likelihoods of its trigrams. The language set is the one of the largest penalised likelihood
among the nested sets of the largest shares; the prediction is the set's largest share.

The model is fitted on a sample of labelled rows, at most about ``per_language`` of each
language (``PER_LANGUAGE``), drawn by id and text; of languages, on the ``LANGUAGES`` most frequent. So its
size is bounded whatever the corpus, also where the labels are dirty. Repeated rows are drawn
together and predicted alike; only the columns named are read, so others' names cannot clash.

A text that is null or without a letter is ``und`` with score 0, and so is every text if
nothing was learned. Ties go to the language first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 14
BUCKETS = 1 << BITS
#: Labelled rows of a language that the model is fitted on, about.
PER_LANGUAGE = 3000
#: Nats that another language must gain: per trigram, and times the logarithm of their number.
PER_GRAM, PER_LOG = 0.02, 2.0
ROUNDS = 12
#: Languages of the model, at most.
LANGUAGES = 500


def letters() -> np.ndarray:
    """For every code point: is it a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def grams(text: str, is_letter: np.ndarray) -> np.ndarray:
    """Hashed trigrams over the words of a text, word ends included."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = is_letter[code]
    if not letter.any():
        return np.empty(0, np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one separator after each word
    code = np.where(letter, code, 32)[keep].astype(np.uint32)
    code = np.concatenate([np.array([32], np.uint32), code])
    h = code[:-2] * np.uint32(2654435761) + code[1:-1] * np.uint32(2246822519) + code[2:] * np.uint32(3266489917)
    h ^= h >> np.uint32(15)
    return (h * np.uint32(2654435769)) >> np.uint32(32 - BITS)


@dataclass
class Model:
    """Languages in alphabetical order and the log probability of each bucket in each."""

    langs: list[str]
    logp: np.ndarray


def fit(docs: DataFrame, text: str, lang: str, key: str, per_language: int = PER_LANGUAGE) -> Model:
    """The model of labelled rows. ``key`` decides which rows are in the sample."""
    docs = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    by_size = docs.groupBy(lang).agg(F.count("*").alias("n")).orderBy(F.desc("n"), lang).limit(LANGUAGES)
    counts = {r[lang]: r["n"] for r in by_size.collect()}
    if not counts:
        return Model([], np.zeros((0, BUCKETS), np.float32))
    chosen = F.lit(False)
    part = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(1_000_000))
    for name, n in counts.items():
        chosen = chosen | ((F.col(lang) == name) & (part < int(1_000_000 * min(1.0, per_language / n)) + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, sums = letters(), {}
        for batch in batches:
            for name, t in zip(batch.column(0), batch.column(1)):
                name = name.as_py()
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS, np.int64)
                sums[name] += np.bincount(grams(t.as_py(), is_letter), minlength=BUCKETS)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"],
            )

    sample = docs.where(chosen).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = (
        sample.mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(counts)
    table = np.zeros((len(langs), BUCKETS))
    place = {name: i for i, name in enumerate(langs)}
    for name, bucket, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "bucket", "n"))):
        table[place[name], bucket] = n
    table += 0.5
    return Model(langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32))


def shares(p: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares of the languages (rows of ``p``) by EM, and the log likelihood they reach."""
    pi = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in range(rounds):
        pi = pi * (p @ (n / (pi @ p))) / total
    return pi, float(n @ np.log(pi @ p))


def infer(text: str | None, model: Model, is_letter: np.ndarray) -> tuple[list[int], list[float]]:
    """The chosen languages, largest share first, and their shares."""
    found = grams(text, is_letter) if text and model.langs else np.empty(0, np.uint32)
    if not len(found):
        return [], []
    counts = np.bincount(found, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    n = counts[at].astype(float)
    logp = model.logp[:, at].astype(float)
    alone = logp @ n
    best = int(np.argmax(alone))
    base = logp.max(0)
    p = np.exp(logp - base)  # a factor per trigram changes no share and all likelihoods alike
    offset = float(n @ base)
    cost = PER_GRAM * n.sum() + PER_LOG * np.log(n.sum() + 1)
    pi, reached = shares(p, n)
    if reached + offset - alone[best] <= cost:
        return [best], [1.0]
    order = np.argsort(-pi, kind="stable")
    top, chosen, part = float(alone[best]), [best], [1.0]
    for k in range(2, len(order) + 1):
        these = order[:k]
        if pi[these[-1]] < 0.01:
            break
        share, reached = shares(p[these], n)
        if reached + offset - cost * (k - 1) > top:
            top = reached + offset - cost * (k - 1)
            rank = np.argsort(-share, kind="stable")
            chosen, part = [int(i) for i in these[rank]], [float(x) for x in share[rank]]
    return chosen, part


def predict(model: Model, spark, text: Column | str) -> Column:
    """``struct(lang_pred, score, langs, shares)`` of a text."""
    shared = spark.sparkContext.broadcast(model)
    kind = "struct<lang_pred:string,score:double,langs:array<string>,shares:array<double>>"

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, is_letter = shared.value, letters()
        for texts in batches:
            out = [infer(t.as_py(), model, is_letter) for t in texts]
            names = [[model.langs[i] for i in langs] for langs, _ in out]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([n[0] if n else "und" for n in names], pa.string()),
                    pa.array([min(1.0, part[0]) if part else 0.0 for _, part in out], pa.float64()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array([part for _, part in out], pa.list_(pa.float64())),
                ],
                names=["lang_pred", "score", "langs", "shares"],
            )

    return run(text)
