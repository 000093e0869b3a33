"""Language identification by error-correcting output codes over hashed character n-grams.

Every language has a codeword. For each bit a binary classifier, trained on n-gram counts,
says on which side of the code a text lies. Its verdict is a log-likelihood ratio per n-gram, moved and scaled so
that the languages of either side lie beyond +1 and -1. A text gets the language whose codeword
has the least loss, where each bit's logistic loss weighs as much as its classifier parts the
languages; a small lead over the second is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 15
# Expected number of labelled documents of each language that training reads.
SAMPLE = 3000
MIN_LEAD = 0.02
UNKNOWN = "und"
# Loss of a codeword whose classifiers say 0.
CHANCE = float(np.log(2))
# Characters whose n-grams are hashed at once; longer texts are added up piece by piece.
PIECE = 1 << 18
_ODD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def _grams(points: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all 1-, 2- and 3-grams of code points."""
    one = points * _ODD[0]
    two = (one[:-1] ^ (points[1:] * _ODD[1])) * _ODD[2] if len(points) > 1 else one[:0]
    three = (two[:-1] ^ (points[2:] * _ODD[0])) * _ODD[1] if len(points) > 2 else one[:0]
    mixed = np.concatenate((one, two, three))
    return ((mixed ^ (mixed >> np.uint32(15))) * _ODD[2] >> np.uint32(17)) & np.uint32(buckets - 1)


def gram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket comes in the lower-cased letters and blanks of a whole text."""
    counts = np.zeros(buckets, np.int64)
    text = text.lower()
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        # Digits, punctuation and white space tell nothing about a language: all are blanks.
        points = np.where((points < 65) | ((points > 90) & (points < 97)) | ((points > 122) & (points < 192)), 32, points)
        counts += np.bincount(_grams(points.astype(np.uint32), buckets), minlength=buckets)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """Codes of +1 and -1 for `n` languages, a row each: all ways to part up to six languages in two.

    More languages get random words of 10 log2 n bits, the best of 50 draws by least distance, from
    a fixed seed.
    """
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        sides = [(0, *rest) for k in range(n - 1) for rest in combinations(range(1, n), k)]
        return np.array([[1.0 if i in side else -1.0 for side in sides] for i in range(n)])
    draws = np.random.default_rng(0)
    width = int(np.ceil(10 * np.log2(n)))
    best, reached = None, -1
    for _ in range(50):
        code = draws.choice([-1.0, 1.0], (n, width))
        # A bit that all languages share teaches nothing.
        code[0, np.abs(code.sum(0)) == n] *= -1
        apart = width - (code @ code.T + width) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > reached:
            best, reached = code, least
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Weights of a bounded size: buckets x bits."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    middle: np.ndarray
    half: np.ndarray
    trust: np.ndarray
    min_lead: float

    @staticmethod
    def fit(counts: dict[str, np.ndarray], min_lead: float = MIN_LEAD) -> LanguageModel:
        """From the n-gram counts of each language. A bit's classifier is naive Bayes of its two sides."""
        names = tuple(sorted(counts))
        code = codewords(len(names))
        table = np.array([counts[k] for k in names], float) if names else np.zeros((0, BUCKETS))
        share = (table + 0.5) / (table + 0.5).sum(1, keepdims=True) if len(names) else table
        bits = code.shape[1]
        weights = np.zeros((table.shape[1], bits), np.float32)
        middle, half, trust = np.zeros(bits), np.ones(bits), np.zeros(bits)
        for bit in range(bits):
            ours = code[:, bit] > 0
            weights[:, bit] = np.log(share[ours].mean(0)) - np.log(share[~ours].mean(0))
            usual = share @ weights[:, bit]
            above, below = usual[ours].min(), usual[~ours].max()
            middle[bit], half[bit] = (above + below) / 2, max(abs(above - below) / 2, 1e-6)
            trust[bit] = max(above - below, 1e-6)
        trust = trust / trust.sum() if bits else trust
        return LanguageModel(names, code, weights, middle, half, trust, min_lead)

    def margins(self, text: str) -> np.ndarray:
        """What each bit's classifier says: about +1 or -1 on the training languages."""
        total, n = np.zeros(self.code.shape[1]), 0
        counts = gram_counts(text, len(self.weights))
        there = np.flatnonzero(counts)
        total = counts[there].astype(np.float64) @ self.weights[there]
        n = counts.sum()
        return (total / max(n, 1) - self.middle) / self.half

    def predict(self, text: str | None) -> tuple[str, float, bool, float]:
        """Language, score from 0 to 1, ambiguous, loss. Texts without a letter are `und` with score 0.

        The score is shared among all languages, so it is less where there are more. The loss is that of the language's own codeword, and
        does not depend on their number: near 0 where all classifiers agree with it, `CHANCE` where they say nothing.
        """
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True, CHANCE
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False, 0.0
        losses = np.logaddexp(0, -4 * self.code * self.margins(text)) @ self.trust
        order = np.argsort(losses, kind="stable")
        chances = np.exp(-2 * (losses - losses[order[0]]))
        chances /= chances.sum()
        lead = float(losses[order[1]] - losses[order[0]])
        return self.languages[order[0]], float(chances[order[0]]), lead < self.min_lead, float(losses[order[0]])


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", by: str = "doc_id", sample: int = SAMPLE,
    buckets: int = BUCKETS, min_lead: float = MIN_LEAD,
) -> LanguageModel:
    """Fit a model on rows with a label and a text.

    `sample` bounds the expected number of documents of each language: where there are more, those
    with the least hash of column `by` are read, whole. Their counts are summed in Spark; the driver
    gets one number for each language and bucket. Without labelled rows the model knows no language.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(by).alias("by"))
    rows = rows.filter("text is not null and lang is not null")
    found = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not found:
        return LanguageModel.fit({}, min_lead)
    chance = F.pmod(F.xxhash64("by"), F.lit(1_000_003)) / 1_000_003
    kept = [(F.col("lang") == k) & (chance < min(1.0, sample / n)) for k, n in found.items()]
    chosen = kept[0]
    for condition in kept[1:]:
        chosen = chosen | condition

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, whole in zip(batch.column("lang").to_pylist(), batch.column("text")):
                sums[name] = sums.get(name, 0) + gram_counts(whole.as_py(), buckets)
        for name, counts in sums.items():
            there = np.flatnonzero(counts)
            columns = [pa.array([name] * len(there), pa.string()), pa.array(there, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[there], pa.int64())], ["lang", "bucket", "n"])

    counted = rows.filter(chosen).select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    totals = {name: np.zeros(buckets) for name in found}
    for name, bucket, n in counted.groupBy("lang", "bucket").agg(F.sum("n")).collect():
        totals[name][bucket] = n
    return LanguageModel.fit(totals, min_lead)


def language(model: LanguageModel, text: Column) -> Column:
    """struct<lang, score, ambiguous, loss> of a text column, null texts included."""

    @F.arrow_udf("lang string, score double, ambiguous boolean, loss double")
    def of(texts: pa.Array) -> pa.Array:
        found = [model.predict(x.as_py()) for x in texts]
        columns = list(zip(*found)) if found else [(), (), (), ()]
        kinds = [pa.string(), pa.float64(), pa.bool_(), pa.float64()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "score", "ambiguous", "loss"])

    return of(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of all documents by checksum of the id; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row, in one pass without a shuffle.

    A null text, or one without a letter, is `und`; repeated rows get a row each; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), language(model, F.col(text)).alias("found"))
    return rows.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
        F.col("found.ambiguous").alias("ambiguous"),
    )
