"""Toxic passages: maximum-scoring segments over token log-odds, calibrated as extreme values.

Learning, from labelled rows only:

1. Token counts of toxic and clean texts give log-odds under a Dirichlet prior: half a text for every token, and a
   share of its count in both together (informative prior), so it weighs alike in small and large
   label sets; a text counts a token once.
   A token is a word; rare words fall back to their first five, then first four letters.
2. Every token loses a constant ``DRIFT``, so the expected score is negative and
   segments end. Rows scored with the other folds' log-odds give the extreme-value
   constants of clean text: the decay ``lam`` solves E[exp(lam * score)] = 1, the scale
   ``k`` is the likelihood estimate for the best segments of clean texts.
3. The same rows give a logistic curve from a text's evidence to a probability.

Scoring scans a text once (linear time) and finds *all* maximal segments. A
segment of score S in a text of n tokens is expected k * n * exp(-lam * S) times by
chance; those expected fewer than ``CHANCE`` times are toxic passages, and their
surprise adds up to the evidence of the text.
"""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved

TOKEN = re.compile(r"\w+")
PREFIXES = (5, 4)
FLOOR, SPREAD = 0.5, 0.002  # prior of a token: so many texts, and this share of those that hold it
FOLDS = 4
CLEAREST = 3.0         # standard errors from 0 from which a log-odds counts
STRONG = 2.5           # smallest log-odds that counts
RARE = 20_000          # an entry is held by one in so many labelled texts at least: bounds what is sent to the tasks
CALIBRATION = 20_000   # labelled rows the curve is fitted on, at most; chosen by hash
REMEMBERED = 50_000    # words whose scores a scorer keeps: some 8 MB, and a task of the fit has a scorer for each fold
DRIFT = 0.15           # taken from every token
CAP = 8.0              # largest score of one token
CHANCE = 0.05
BROADCAST_LABELS = 1_000_000  # rows of a long and an int that may be sent to every executor; beyond that the join shuffles
THRESHOLD = 0.7


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _keys(token: str) -> list[str]:
    """The token's entries in the lexicon, most specific first."""
    return [token, *(f"{token[:n]}*" for n in PREFIXES if len(token) > n)]


@dataclass(frozen=True)
class Model:
    """Everything scoring needs. Entries are at most ``RARE`` times the different words and word starts of an average text."""

    scores: dict[str, float]
    lam: float
    k: float
    slope: float
    offset: float
    prior: float

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer(dict):
    """Scores of tokens met so far; forgets them when there are too many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        known = self.model.scores
        found = next((known[key] for key in _keys(token) if key in known), 0.0)
        self[token] = value = min(CAP, found) - DRIFT
        return value

    def values(self, text: str | None) -> np.ndarray:
        """Score of each token. A toxic word that counted a short way before does not count again: it does only
        where ``DRIFT`` has used up its score since, so repeating a word never raises a segment and a later passage of
        the same words is scored like the first."""
        words = tokens(text)
        values = np.fromiter(map(self.__getitem__, words), dtype=float, count=len(words))
        counted: dict[str, int] = {}
        for at in np.flatnonzero(values > 0).tolist():
            last = counted.get(words[at])
            if last is not None and (at - last) * DRIFT < values[at] + DRIFT:
                values[at] = -DRIFT
            else:
                counted[words[at]] = at
        return values

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens and the maximal segments (first token, end token, score)."""
        values = self.values(text)
        return len(values), maximal_segments(values)

    def evidence(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Evidence of the text and its toxic passages (first token, end token, score)."""
        model = self.model
        n, found = self.segments(text)
        if not found:
            return 0.0, []
        base = math.log(model.k * n)
        toxic = [s for s in found if model.lam * s[2] - base > -math.log(CHANCE)]
        return sum(model.lam * s[2] - base for s in toxic), toxic

    def probability(self, evidence: float) -> float:
        if not self.model.scores:
            return self.model.prior
        x = self.model.slope * math.log1p(evidence) + self.model.offset
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def maximal_segments(values: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), left to right, in linear time.

    Neighbouring positive values are one step, what lies between them another,
    so the walk takes one step for each run. Each candidate knows the sums before and
    after it; a new one that ends above an earlier candidate's end, but starts above
    that one's start, is merged with it.
    """
    up = np.flatnonzero(values > 0)
    if not len(up):
        return []
    cut = np.flatnonzero(np.diff(up) > 1)
    starts, ends = up[np.r_[0, cut + 1]], up[np.r_[cut, len(up) - 1]] + 1
    total = np.r_[0.0, np.cumsum(values)]
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    lower: list[int] = []  # of each kept one: the nearest earlier one with a smaller sum before, or -1
    for start, end, before, after in zip(starts.tolist(), ends.tolist(), total[starts].tolist(), total[ends].tolist()):
        while True:
            at = len(kept) - 1
            while at >= 0 and kept[at][2] >= before:
                at = lower[at]
            if at < 0 or kept[at][3] >= after:
                kept.append((start, end, before, after))
                lower.append(at)
                break
            start, before = kept[at][0], kept[at][2]
            del kept[at:], lower[at:]
    return [(start, end, after - before) for start, end, before, after in kept]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of each fold and label that hold an entry; a text counts an entry once, however often it repeats it."""
    for batch in batches:
        for (fold, label), part in batch.groupby(["fold", "label"]):
            seen: Counter[str] = Counter()
            for text in part["text"]:
                seen.update({key for token in set(tokens(text)) for key in _keys(token)})
            if seen:
                yield pd.DataFrame({"key": [*seen, ""], "cell": int(2 * fold + label), "n": [*seen.values(), len(part)]})


def log_odds(labelled: DataFrame) -> list[dict[str, float]]:
    """Scores of the clear entries of rows (text, label, fold): without fold 0, 1, ..., and from all.

    Batches count their own entries before the shuffle; the sums stay distributed,
    and only clear entries come to the driver. An entry counts by its own evidence: an odds ratio of ``STRONG``
    that is ``CLEAREST`` standard errors from none.
    """
    seen = labelled.mapInPandas(_counts, "key string, cell int, n long")
    cells = [F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(2 * FOLDS)]
    sums = saved(seen.groupBy("key").agg(*cells), "tokens")
    texts = sums.filter("key = ''").agg(*[F.sum(f"n{c}") for c in range(2 * FOLDS)]).first()
    whole = sums.filter(~F.col("key").endswith("*") & (F.col("key") != "")).agg(*[F.sum(f"n{c}") for c in range(2 * FOLDS)]).first()
    found = []
    for left_out in (*range(FOLDS), None):
        folds = [f for f in range(FOLDS) if f != left_out]
        toxic, clean = (float(sum(whole[2 * f + label] or 0 for f in folds)) for label in (1, 0))
        if not toxic or not clean:
            found.append({})
            continue
        held = sum(texts[2 * f + label] or 0 for f in folds for label in (0, 1))
        y_toxic, y_clean = (sum((F.col(f"n{2 * f + label}") for f in folds), F.lit(0)) for label in (1, 0))
        prior, mass = FLOOR + SPREAD * (y_toxic + y_clean), SPREAD * (toxic + clean)
        rated = sums.filter(F.col("key") != "").filter((y_toxic + y_clean) * RARE >= held)
        rated = rated.withColumn("bad", y_toxic + prior).withColumn("good", y_clean + prior)
        odds = F.log(F.col("bad") / (toxic + mass + FLOOR - F.col("bad") + 1)) - F.log(F.col("good") / (clean + mass + FLOOR - F.col("good") + 1))
        rated = rated.filter("bad > 0").select("key", odds.alias("odds"), (odds / F.sqrt(1 / F.col("bad") + 1 / F.col("good"))).alias("z"))
        clear = rated.filter((F.abs("z") >= CLEAREST) & (F.abs("odds") >= STRONG))
        found.append({row.key: row.odds for row in clear.select("key", "odds").collect()})
    return found


def _decay(values: np.ndarray, weights: np.ndarray) -> float:
    """Positive solution of E[exp(lam * value)] = 1; the mean is negative."""
    low, high = 0.0, 1.0
    mean = lambda lam: float((weights * np.exp(lam * values)).sum() / weights.sum())
    if values.max(initial=-1.0) <= 0:
        return 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by penalised Newton steps; the slope is never negative."""
    weights = np.zeros(2)
    rows = np.c_[x, np.ones_like(x)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -60, 60)))
        gradient = rows.T @ (p - y) + 1e-2 * weights * [1, 0]
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(bend, gradient)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(weights[0])), float(weights[1])


def fit(labelled: DataFrame, rows: int = CALIBRATION) -> Model:
    """Model from rows (key, text, label), label 1 for toxic.

    The log-odds come from all rows. For the curve and the extreme-value constants,
    each of ``FOLDS`` folds (by hash of the key) is scored with the log-odds of the other ones, on at
    most ``rows`` rows or so; a fold whose others give no clear entry is left out of this. Without both labels, or with
    too few rows for any clear entry, the lexicon is empty and every text gets the share of toxic rows, held below the threshold
    (0 without any rows). Where there are entries but no fold to judge them by, a warning says so and the curve is
    that of the learned rows themselves.
    """
    fold = F.pmod(F.xxhash64("key"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = saved(labelled.filter("label in (0, 1)").select("key", "text", "label", fold), "labelled")
    size, share = labelled.agg(F.count("*"), F.avg("label")).first()
    share = share or 0.0
    *parts, both = log_odds(labelled)
    if not both:
        return Model(both, 1.0, 1.0, 1.0, -math.log1p(5.0), min(share, THRESHOLD / 2))
    if any(parts):
        labelled = labelled.filter(F.col("fold").isin([f for f, scores in enumerate(parts) if scores]))
    else:
        warnings.warn("too few labelled rows to hold some out: toxicity scores are calibrated on the rows they were learned from", stacklevel=2)
        parts = [both] * FOLDS
    if size > rows:  # a sample of the stated size, spread by hash
        labelled = labelled.filter(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * rows / size))
    models = [Model(scores, 1.0, 1.0, 1.0, 0.0, share) for scores in parts]  # by fold

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorers = [model.scorer() for model in models]
        for batch in batches:
            out, spread = [], Counter()
            for text, label, part in zip(batch["text"], batch["label"], batch["fold"]):
                values = scorers[part].values(text)
                out.append((int(label), len(values), [s[2] for s in maximal_segments(values)]))
                if not label:
                    spread.update(np.round(values, 1).tolist())
            first_row = [True] + [False] * (len(out) - 1)
            yield pd.DataFrame({"label": [r[0] for r in out], "n": [r[1] for r in out], "found": [r[2] for r in out],
                                "spread": [list(map(float, spread)) if one else [] for one in first_row],
                                "times": [list(map(int, spread.values())) if one else [] for one in first_row]})

    schema = "label int, n long, found array<double>, spread array<double>, times array<long>"
    # Sorted, so that sums of floats do not depend on the order in which tasks end.
    seen = sorted(labelled.mapInPandas(summary, schema).collect(), key=lambda row: (row.label, row.n, row.found))
    spread: Counter[float] = Counter()
    for row in seen:
        spread.update(dict(zip(row.spread, row.times)))
    spread = Counter(dict(sorted(spread.items())))
    lam = _decay(np.array(list(spread) or [-DRIFT]), np.array(list(spread.values()) or [1], dtype=float))
    clean = [(row.n, max(row.found, default=0.0)) for row in seen if not row.label and row.n]
    k = len(clean) / sum(n * math.exp(-lam * best) for n, best in clean) if clean else 1.0

    def evidence(row) -> float:
        base = math.log(k * row.n) if row.n else 0.0
        return sum(x for s in row.found if (x := lam * s - base) > -math.log(CHANCE))

    labels = np.array([row.label for row in seen], dtype=float)
    if len(set(labels)) < 2:
        return Model(both, lam, k, 1.0, -math.log1p(5.0), share)
    slope, offset = _logistic(np.log1p([evidence(row) for row in seen]), labels)
    return Model(both, lam, k, slope, offset, share)


def scores(text: str, model: Model) -> Column:
    """Struct (score, evidence, passages) of a text; passages hold first token, end token and score.

    Null and empty texts hold no segment and get the lowest score.
    """
    @F.pandas_udf("score double, evidence double, passages array<struct<start: int, end: int, score: double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for texts in batches:
            found = [scorer.evidence(t) for t in texts]
            yield pd.DataFrame({"score": [scorer.probability(e) for e, _ in found], "evidence": [e for e, _ in found],
                                "passages": [[{"start": a, "end": b, "score": s} for a, b, s in p] for _, p in found]})
    return run.asNondeterministic()(F.col(text))


def held_out(doc_id: str) -> Column:
    """True for ids that are never learned from: crc32 of the id's text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def fit_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from documents (doc_id, text) and labels (doc_id, toxic), held-out ids left out.

    An id labelled more than once counts once for each label; null labels count
    nothing.
    """
    known = labels.filter("toxic is not null").select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("label"))
    known = known.filter(~held_out("key"))
    if known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return fit(docs.select(F.col("doc_id").alias("key"), "text").join(known, "key"))
