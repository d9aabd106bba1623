"""URL filter by the ratio of two character language models.

Accepted and rejected URLs each give a Markov model of variable order: the probability of a
character is interpolated from the longest known context (``ORDER`` characters) down to none,
with Witten-Bell weights. A URL's score is the difference of its log likelihoods divided by its
length; the threshold is calibrated on labelled URLs kept out of the counts: of the scores that would
block at most ``FALSE_BLOCKS`` of the accepted, the one of best balanced accuracy.

Every distinct labelled address counts, four fifths in the models and a fifth in the threshold. What a
character adds to a score depends on it and the ``ORDER`` before it, its window, so no task needs a whole model:
windows are counted, the probabilities of a length are joined from those of the length below and from the
counts of the context, and addresses get the sum over their windows. A key of these joins has as many rows as there
are characters, but for the windows of addresses. The driver gets counts of scores by ``1 / BINS``.
Rejected are addresses whose host has one of ``SEEDS``, words that mark unwanted hosts whatever a
rule of their domain says; accepted are those of other hosts that a rule allows. What a rule blocks
is no example: rules block parts of sites that have nothing wrong with their names. Nor do the models read
what rules go by, the top level and a language at the start of the path.

A URL without ``://``, and a null one, has an empty host and path; an empty address scores 0 and
is allowed. So is every URL if one class has no example. A tie with the threshold is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Stored

ORDER = 5
#: Steps of the threshold in a score of 1, and of what a window adds to a score; sums of integers have no order.
BINS, STEPS = 1000, 2**32
#: Parts of host names that mark an unwanted host. Fixed values.
SEEDS = ("spam", "casino", "pills", "viagra", "free-bets", "betting", "porn", "xxx", "adult", "ads-", "track", "malware", "phish")
#: Share of accepted addresses that the threshold may block, at most.
FALSE_BLOCKS = 0.01
START, END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (``host/path``) and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def address_of(host: Column, path: Column) -> Column:
    """What the models read: host and path without the top-level domain and a language at the path's start.

    Rules speak for whole domains and languages, so a model that saw them would learn the rules.
    """
    return F.concat(F.regexp_replace(host, r"\.[^.]*\z", ""), F.regexp_replace(path, r"\A/[A-Za-z]{2}(?=/|\z)", ""))


@dataclass
class CharModel:
    """Counts of characters after each context, and of each context: the model in one place, for a small number of addresses."""

    after: dict[str, int]
    total: dict[str, int]
    kinds: dict[str, int]

    def log_likelihood(self, text: str) -> float:
        out, padded = 0.0, START * ORDER + text + END
        after, total, kinds = self.after, self.total, self.kinds
        for i in range(ORDER, len(padded)):
            p = 1 / 256
            for k in range(ORDER + 1):
                context = padded[i - k : i]
                n = total.get(context)
                if n is None:
                    break
                t = kinds[context]
                p = (after.get(padded[i - k : i + 1], 0) + t * p) / (n + t)
            out += log(p)
        return out


@dataclass
class Ratio:
    accepted: CharModel
    rejected: CharModel
    threshold: float

    def score(self, address: str) -> float:
        if not address:
            return 0.0
        return (self.accepted.log_likelihood(address) - self.rejected.log_likelihood(address)) / (len(address) + 1)


def calibrate(accepted: np.ndarray, rejected: np.ndarray, false_blocks: float = FALSE_BLOCKS) -> float:
    """The threshold of some scores, see :func:`calibrate_counts`."""
    scores, at = np.unique(np.concatenate([accepted, rejected]), return_inverse=True)
    good, bad = (np.bincount(x, minlength=len(scores)) for x in (at[: len(accepted)], at[len(accepted) :]))
    return calibrate_counts(scores, good, bad, false_blocks)


def calibrate_counts(
    scores: np.ndarray, accepted: np.ndarray, rejected: np.ndarray, false_blocks: float = FALSE_BLOCKS
) -> float:
    """The score of the best balanced accuracy, half way between its neighbours, that blocks few accepted.

    ``scores`` are distinct and rise; the others count them.
    """
    if not accepted.sum() or not rejected.sum():
        return 0.0
    cuts = np.concatenate([[scores[0] - 1], (scores[1:] + scores[:-1]) / 2])
    good = 1 - (np.cumsum(accepted) - accepted) / accepted.sum()
    bad = (np.cumsum(rejected) - rejected) / rejected.sum()
    total = np.where(good >= 1 - false_blocks, good + bad, 0)
    best = np.flatnonzero(total >= total.max() - 1e-12)
    return float(cuts[best].mean())


@F.arrow_udf(T.ArrayType(T.StringType()))
def windows(addresses: pa.Array) -> pa.Array:
    """Each character of an address and its end, after the ``ORDER`` characters before it."""
    padded = [START * ORDER + a + END for a in addresses.to_pylist()]
    found = [[s[i - ORDER : i + 1] for i in range(ORDER, len(s))] for s in padded]
    return pa.array(found, pa.list_(pa.string()))


def _ratios(counted: DataFrame) -> DataFrame:
    """``window, adds``: what each window adds to a score, in ``STEPS``, from ``window, accepted, rejected``.

    Windows that no example has are among them, with counts of zero.
    """
    sides, below = ("accepted", "rejected"), None
    for k in range(ORDER + 1):
        gram = F.substr("window", F.lit(ORDER + 1 - k), F.lit(k + 1)).alias("gram")
        level = counted.groupBy(gram).agg(*[F.sum(x).alias(x) for x in sides])
        level = level.withColumn("context", F.substr("gram", F.lit(1), F.lit(k)))
        totals = [F.sum(x).alias(f"all_{x}") for x in sides] + [F.count_if(F.col(x) > 0).alias(f"kinds_{x}") for x in sides]
        level = level.join(level.groupBy("context").agg(*totals), "context")
        if below is None:
            level = level.withColumns({f"p_{x}": F.lit(1 / 256) for x in sides})
        else:
            level = level.withColumn("rest", F.substr("gram", F.lit(2), F.lit(k)))
            level = level.join(below.withColumnRenamed("gram", "rest"), "rest")
        below = level.select("gram", *[_interpolated(x).alias(f"p_{x}") for x in sides])
    adds = F.round((F.log("p_accepted") - F.log("p_rejected")) * STEPS).cast("long")
    return below.select(F.col("gram").alias("window"), adds.alias("adds"))


def _interpolated(side: str) -> Column:
    n, kinds, p = F.col(f"all_{side}"), F.col(f"kinds_{side}"), F.col(f"p_{side}")
    return F.when(n > 0, (F.col(side) + kinds * p) / (n + kinds)).otherwise(p)


def fit(addresses: DataFrame) -> tuple[DataFrame, float] | None:
    """``address, score`` of every distinct address, and the threshold.

    The addresses are labelled by ``accepted``, null for those that are only scored. A fifth of the
    labelled is kept for the threshold.
    """
    store = Stored(addresses.sparkSession)
    known = addresses.where("address <> ''").groupBy("address").agg(F.min("accepted").alias("accepted"))
    known = store.put(known, "addresses")
    if known.where("accepted is not null").select("accepted").distinct().count() < 2:
        return None
    kept = F.crc32(F.col("address").cast("binary")) % 5 == 0
    counts = {name: F.col("accepted").isNotNull() & ~kept & (F.col("accepted") == side) for name, side in (("accepted", True), ("rejected", False))}
    spots = known.select(F.explode(windows("address")).alias("window"), *[F.coalesce(c, F.lit(False)).cast("long").alias(n) for n, c in counts.items()])
    counted = store.put(spots.groupBy("window").agg(*[F.sum(n).alias(n) for n in counts]), "windows")
    adds = store.put(_ratios(counted), "ratios")
    spots = known.select("address", "accepted", F.explode(windows("address")).alias("window")).join(adds, "window")
    score = F.sum("adds") / STEPS / (F.length("address") + 1)
    scored = store.put(spots.groupBy("address", "accepted").agg(score.alias("score")), "scores")
    store.drop(known, counted, adds)
    place = F.floor(F.col("score") * BINS).alias("place")
    sides = [F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")]
    rows = scored.where(kept & F.col("accepted").isNotNull()).groupBy(place).agg(*sides).orderBy("place").collect()
    places, good, bad = (np.array([r[c] for r in rows], float) for c in ("place", "good", "bad"))
    return scored.select("address", "score"), calibrate_counts((places + 0.5) / BINS, good, bad)


def judge(
    urls: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", seeds: tuple[str, ...] = SEEDS
) -> DataFrame:
    """The rows with ``host, path, rule, score, verdict`` (columns of these names are replaced)."""
    host, path = host_and_path(F.col(url_col))
    df = urls.withColumns({"host": host, "path": path})
    name, says = matching_rule(F.col("host"), F.col("path"), rules)
    df = df.withColumns({"rule": name, "verdict": says})
    address = address_of(F.col("host"), F.col("path"))
    seeded = F.lit(False)
    for seed in seeds:
        seeded = seeded | F.contains("host", F.lit(seed))
    labelled = F.when((F.col("verdict") == "allow") | seeded, ~seeded)
    found = fit(df.select(address.alias("address"), labelled.alias("accepted")))
    if found is None:
        return df.withColumns({"score": F.lit(0.0), "verdict": F.coalesce("verdict", F.lit("allow"))})
    scores, threshold = found
    scores = scores.select(F.col("address").alias("_address"), F.col("score").alias("_score"))
    # An empty address scores 0.
    df = df.withColumn("_address", address).join(scores, "_address", "left")
    df = df.withColumn("score", F.coalesce("_score", F.lit(0.0)))
    mine = F.when((F.col("score") >= threshold) | (F.col("_address") == ""), "allow").otherwise("block")
    return df.withColumn("verdict", F.coalesce("verdict", mine)).drop("_address", "_score")
