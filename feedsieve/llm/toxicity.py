"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Lexicon voters are words, and beginnings of words, that the labelled training rows
   tie to toxic text; pattern voters look at shouting, strings of symbols and spelled-out
   letters; one voter fires when no other does.
2. A generative model treats the true label as hidden: every voter fires with one rate on
   toxic and another on clean text. Expectation maximisation estimates these
   accuracies; correlations of voters, given the estimated label, discount votes
   that repeat each other.
3. A logistic classifier learns the posterior labels from a wider set of word
   features, and scores every text.

Only the fit uses a sample: ``SAMPLE`` labelled rows at most, those whose ids hash
lowest, and ``FEATURES`` features at most. Features are counted and texts are scored by Spark tasks;
the driver holds the sample's few hits, never texts.

Null text is the empty text and gets the score of a text without any feature. Rows
without an id are scored but not learnt from. Null labels are not learnt from; without any
label, or with one kind only, every score is the share of toxic labels (0 without labels).
Repeated rows get equal scores. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import slices, whole_text

SAMPLE = 12_000
FEATURES = 2_000
VOTERS = 200
LEAST_DOCS = 3
# Likelihood ratios from which a feature is used, and from which it votes.
TOLD, VOTES_FROM = 8.0, 15.0
# Log odds of a label against the posterior it leaves; labels may err.
TRUST = 4.5
ROUNDS = 15
BEGINNINGS = (4, 5, 6)
REMEMBERED = 50_000

WORDS = regex.compile(r"[^\W_]+").findall
PATTERNS = {
    "~shouting": regex.compile(r"\b\p{Lu}{4,}(?:\s+\p{Lu}{3,}){2,}"),
    "~symbols": regex.compile(r"\p{L}[*#@$%&]{2,}\p{L}"),
    "~spelled": regex.compile(r"\b(?:\p{L}[.\-*_ ]){4,}\p{L}\b"),
    "~exclaims": regex.compile(r"!{3,}"),
}
NONE_FIRES = "~none"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of the fit; those without an id are not, but they are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def features_of(word: str) -> list[str]:
    """A word and its beginnings; the latter end in a bar."""
    return [word, *(word[:n] + "|" for n in BEGINNINGS if len(word) > n)]


def text_features(text: str) -> set[str]:
    found = {f for w in set(WORDS(text.lower())) for f in features_of(w)}
    found.update(name for name, pattern in PATTERNS.items() if pattern.search(text))
    return found


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """id, text, toxic of the sampled labelled rows outside the held-out quarter."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    known = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = (
        known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "toxic")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers; of a repeated id one text stays, so no more rows than that come out.
    known = docs.select("doc_id", whole_text("text").alias("text")).join(F.broadcast(chosen.distinct()), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    return known.groupBy("doc_id", "toxic").agg(one).select("doc_id", "toxic", F.col("one.text").alias("text"))


def _hits(rows: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """doc_id, toxic and an array of the row's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(2).to_pylist():
                features = text_features(text)
                found.append(sorted(features if wanted is None else features & wanted))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "features"],
            )

    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("toxic", T.IntegerType()),
            T.StructField("features", T.ArrayType(T.StringType())),
        ]
    )
    return rows.select("doc_id", "toxic", "text").mapInArrow(run, schema)


def label_model(votes: np.ndarray, rates: np.ndarray, prior: float, given: np.ndarray) -> np.ndarray:
    """Posterior of the hidden label for each row of 0/1 votes.

    ``rates`` holds each voter's firing rate on clean and on toxic text to start from;
    ``given`` is the log odds of each row's known label, one more vote.
    """
    votes = votes.astype(np.float64)
    rates = np.clip(rates, 1e-4, 1 - 1e-4)
    weight = np.ones(votes.shape[1])
    posterior = np.full(len(votes), prior)
    for _ in range(ROUNDS):
        clean, toxic = rates
        fires = np.log(toxic / clean) * weight
        silent = np.log((1 - toxic) / (1 - clean)) * weight
        odds = np.log(prior / (1 - prior)) + given + votes @ fires + (1 - votes) @ silent
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        mass = np.array([1 - posterior, posterior])
        total = mass.sum(1, keepdims=True)
        rates = np.clip((mass @ votes + 0.01) / (total + 1), 1e-4, 1 - 1e-4)
        prior = float(np.clip(posterior.mean(), 1e-3, 1 - 1e-3))
        # Correlation of voters given the label: what both leave unexplained.
        rest = votes - mass.T @ rates
        spread = np.sqrt((rest**2).mean(0)) + 1e-9
        alike = (rest.T @ rest) / len(votes) / np.outer(spread, spread)
        np.fill_diagonal(alike, 0)
        weight = 1 / (1 + np.where(alike > 0.1, alike, 0).sum(1))
    return posterior


def logistic(rows: np.ndarray, columns: np.ndarray, n: int, width: int, target: np.ndarray) -> np.ndarray:
    """Weights and, last, the bias; entries are 1 at (rows, columns). Soft targets."""
    weights, step = np.zeros(width + 1), np.zeros(width + 1)
    for _ in range(300):
        score = np.bincount(rows, weights[columns], n) + weights[-1]
        error = 1 / (1 + np.exp(-score)) - target
        gradient = np.append(np.bincount(columns, error[rows], width), error.sum()) / n
        gradient[:-1] += 1e-4 * weights[:-1]
        step += gradient**2
        weights -= 0.5 * gradient / (np.sqrt(step) + 1e-8)
    return weights


class Model:
    """Weights by feature."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.patterns = [(p, weights[n]) for n, p in PATTERNS.items() if n in weights]
        self.seen: dict[str, tuple[tuple[str, float], ...]] = {}

    def _of(self, word: str) -> tuple[tuple[str, float], ...]:
        found = tuple((f, self.weights[f]) for f in features_of(word) if f in self.weights)
        self.seen[word] = found
        return found

    def score(self, text: str) -> float:
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        hits: dict[str, float] = {}
        seen = self.seen
        for word in set(WORDS(text.lower())):
            found = seen.get(word)
            if found is None:
                found = self._of(word)
            if found:
                hits.update(found)
        total = self.bias + sum(sorted(hits.values()))
        total += sum(w for pattern, w in self.patterns if pattern.search(text))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The classifier learnt from the labelled rows of ``docs``."""
    rows = training_rows(docs, labels, sample)
    counted = (
        _hits(rows)
        .select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    )
    sizes = rows.groupBy().agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    n, n_toxic = sizes["n"], sizes["toxic"] or 0
    if n_toxic in (0, n):
        share = n_toxic / n if n else 0.0
        return Model({}, 500.0 if share == 1 else -500.0)
    # Likelihood ratio of the feature's counts against independence of the label.
    cells = [
        (F.col("toxic"), F.col("n") * n_toxic / n),
        (F.col("n") - F.col("toxic"), F.col("n") * (n - n_toxic) / n),
        (n_toxic - F.col("toxic"), (n - F.col("n")) * n_toxic / n),
        (n - n_toxic - F.col("n") + F.col("toxic"), (n - F.col("n")) * (n - n_toxic) / n),
    ]
    told = 2 * sum(F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0) for seen, due in cells)
    features = (
        counted.where(F.col("n") >= LEAST_DOCS)
        .select("feature", "n", "toxic", told.alias("told"))
        .where(F.col("told") >= TOLD)
        .orderBy(F.desc("told"), "feature")
        .limit(FEATURES)
        .collect()
    )
    number = {r["feature"]: i for i, r in enumerate(features)}
    lines = _hits(rows, set(number)).select("doc_id", "toxic", "features").collect()
    lines.sort(key=lambda r: (r["doc_id"], r["toxic"], r["features"]))
    at = np.array([i for i, r in enumerate(lines) for _ in r["features"]], np.int64)
    of = np.array([number[f] for r in lines for f in r["features"]], np.int64)
    voters = [
        i
        for i, r in enumerate(features)
        if r["told"] >= VOTES_FROM and r["toxic"] * (n - n_toxic) > 3 * (r["n"] - r["toxic"]) * n_toxic
    ][:VOTERS]
    place = np.full(len(features), -1)
    place[voters] = np.arange(len(voters))
    votes = np.zeros((len(lines), len(voters) + 1), np.int8)
    voting = place[of] >= 0 if len(of) else np.zeros(0, bool)
    votes[at[voting], place[of[voting]]] = 1
    votes[:, -1] = ~votes[:, :-1].any(1)
    label = np.array([r["toxic"] for r in lines], bool)
    rates = np.array([(votes[~label].mean(0)), (votes[label].mean(0))])
    posterior = label_model(votes, rates, float(label.mean()), np.where(label, TRUST, -TRUST))
    weights = logistic(at, of, len(lines), len(features), posterior)
    used = {f: float(weights[i]) for f, i in number.items()}
    return Model(used, float(weights[-1]))


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every text."""
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model(weights, bias).score
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                scores = pa.array([score(t) for t in part.column(1).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), scores], names=[id_col, "score"])

    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, in one pass."""
    weights, bias, at = model.weights, model.bias, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model(weights, bias).score
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                texts = part.column(at).to_pylist()
                stays = pa.array([score(t or "") < threshold for t in texts], pa.bool_())
                yield part.filter(stays)

    return docs.mapInArrow(run, docs.schema)
