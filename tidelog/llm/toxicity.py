"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidelog.llm.common import free_name

# Labelled rows that voters and classifier are fitted on: a bound, in expectation, on a sample by hash of doc_id.
EXAMPLES = 8_000
# Mined word and stem voters, at most.
MINED = 300
STEM = range(4, 8)
SHARED = (1, 2, 4)
THRESHOLD = 0.3
# A missed toxic text against a clean one called toxic.
COST = 3
WORD = re.compile(r"[^\W\d_]+")
# Own short list of insults in four languages.
LEXICON = frozenset("""
idiot idiots idiotic moron morons moronic stupid dumb dumbass loser losers scum scumbag trash garbage pathetic worthless
disgusting clown vermin filth imbecile cretin jerk bastard bitch asshole dickhead fool freak creep degenerate subhuman
arschloch wichser hurensohn depp vollidiot abschaum connard salaud abruti ordure crétin gilipollas cabrón imbécil basura
""".split())
# Patterns that vote on the text as it stands.
PATTERNS = {
    "shouting": re.compile(r"\b[A-Z]{4,}\b\W+\b[A-Z]{4,}\b\W+\b[A-Z]{4,}\b"),
    "exclaims": re.compile(r"!{2,}"),
    "addressed": re.compile(r"\byou(?:'re| are)\s+(?:all\s+|such\s+|an?\s+)*(?:" + "|".join(sorted(LEXICON)) + r")\b", re.I),
    "wished": re.compile(r"\b(?:shut up|go away|get lost|kill yourself|drop dead)\b", re.I),
}


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def stems(found: set[str]) -> set[str]:
    """What mined voters look at: whole words (with a closing ``$``), and beginnings that so many words share."""
    starts = Counter(w[:n] for w in found for n in STEM if n < len(w))
    return {w + "$" for w in found} | {f"{stem}{n}" for stem, seen in starts.items() for n in SHARED if seen >= n}


@dataclass
class Model:
    """Voters in order, and the classifier's weights; small, and sent along with the tasks that score."""

    mined: dict[str, int] = field(default_factory=dict)
    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def __post_init__(self):
        names = sorted(LEXICON)
        first = len(self.mined)
        self.lexicon = {w: first + k for k, w in enumerate(names)}
        self.patterns = {name: first + len(names) + k for k, name in enumerate(PATTERNS)}
        self.size = first + len(names) + len(PATTERNS)

    def votes(self, text: str | None) -> list[int]:
        """The voters that call a text toxic; the others abstain."""
        found = words(text)
        fired = {self.lexicon[w] for w in found & self.lexicon.keys()}
        if self.mined:
            fired |= {self.mined[key] for key in stems(found) & self.mined.keys()}
        return sorted(fired | {at for name, at in self.patterns.items() if PATTERNS[name].search(text or "")})

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[self.votes(text)].sum()))))


@dataclass
class LabelModel:
    """Weights of a voter's firing and of its silence, and the log odds of label 1 before any vote."""

    fires: np.ndarray
    silent: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of label 1 of whole rows of votes."""
        return self._probability(votes @ (self.fires - self.silent) + self.silent.sum())

    def posterior_of_some(self, votes: np.ndarray) -> np.ndarray:
        """Of rows with votes taken away: only votes that are left say something, the human one never."""
        return self._probability(votes[:, 1:] @ self.fires[1:])

    def _probability(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(odds + self.prior, -30, 30)))


def label_model(votes: np.ndarray, rounds: int = 30) -> LabelModel:
    """The generative model of ``votes`` (rows x voters, 0/1), the first voter a human label.

    A mixture of two classes in which every voter has its own rate of firing (its accuracy), fitted
    by expectation maximisation from the human labels on. Voters that fire together more than the
    class explains are counted down: each weighs 1 / (1 + its positive residual correlations), or
    many near-identical stems would outvote the rest.
    """
    posterior = np.clip(votes[:, 0], 0.05, 0.95)
    for _ in range(rounds):
        share = np.clip(posterior.mean(), 0.01, 0.99)
        on = (posterior @ votes + 0.5) / (posterior.sum() + 1)
        off = ((1 - posterior) @ votes + 0.5) / ((1 - posterior).sum() + 1)
        rest = votes - np.outer(posterior, on) - np.outer(1 - posterior, off)
        spread = rest.std(axis=0) + 1e-6
        linked = np.clip(rest.T @ rest / len(votes) / np.outer(spread, spread), 0, 1)
        weight = 1 / linked.sum(axis=0).clip(1)
        weight[0] = 1
        model = LabelModel(np.log(on / off) * weight, np.log((1 - on) / (1 - off)) * weight, float(np.log(share / (1 - share))))
        now = model.posterior(votes)
        if np.abs(now - posterior).max() < 1e-4:
            break
        posterior = now
    return model


def thinned(votes: np.ndarray, copies: int = 3) -> np.ndarray:
    """Rows with some of their votes taken away, the human one too: texts that give less away than the labelled ones."""
    rng = np.random.default_rng(0)
    rows = np.repeat(votes[votes[:, 1:].sum(axis=1) > 1], copies, axis=0)
    return rows * (rng.random(rows.shape) < rng.random((len(rows), 1)))


def linear(votes: np.ndarray, posterior: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; the rarer label 1 weighs ``COST`` times as much."""
    weight = 1 + (COST - 1) * posterior
    x = np.hstack([votes, np.ones((len(votes), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty),
                               x.T @ (weight * (p - posterior)) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def learn(model: Model, votes: np.ndarray) -> Model:
    """The classifier from the votes (human labels first) and their posterior labels."""
    generative, fewer = label_model(votes), thinned(votes)
    labels = np.concatenate([generative.posterior(votes), generative.posterior_of_some(fewer)])
    model.weights, model.bias = linear(np.vstack([votes, fewer])[:, 1:], labels)
    return model


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def distinct_stems(rows) -> list[str]:
    """The keys of ``rows`` (key, clean, toxic) without those that only lengthen an earlier one with the same counts."""
    seen, kept = set(), []
    for r in rows:
        stem = r.key.rstrip("$0123456789")
        if not any((stem[:n], r.clean, r.toxic) in seen for n in range(STEM[0], len(stem) + 1)):
            kept.append(r.key)
        seen.add((stem, r.clean, r.toxic))
    return kept


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """Voters and classifier from labelled documents that are not held out.

    Null labels and labels of null doc_ids are ignored; of several labels of a document the highest
    counts, of several texts the smallest. Without a labelled row of each kind the lexicon decides alone.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    # At most ``examples`` documents, one text each, however often a doc_id repeats.
    part = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    sample = docs.select("doc_id", "text").join(part, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text")

    def counted(rows):
        for batch in rows:
            seen = [Counter(), Counter()]
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                seen[toxic].update(stems(words(text)))
                seen[toxic][""] += 1
            # Rare among the clean and absent among the toxic of a batch says nothing.
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"key": keys, "clean": [seen[0][k] for k in keys], "toxic": [seen[1][k] for k in keys]})

    counts = sample.mapInArrow(counted, "key string, clean long, toxic long").groupBy("key").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 2 OR key = ''")
    whole = Counter()
    sums = counts.where("key = ''").first()
    if sums:
        whole.update(clean=sums.clean, toxic=sums.toxic)
    if not whole["clean"] or not whole["toxic"]:
        model = Model()
        model.weights, model.bias = np.zeros(model.size), -4.0
        model.weights[list(model.lexicon.values())] = 3.0
        return model
    # Lift of the lower bound of a count: what a few toxic texts share by chance is no voter.
    surely = F.col("toxic") - 2 * F.sqrt("toxic") + 0.5
    lift = F.log((surely / (whole["toxic"] + 1)) / ((F.col("clean") + 0.5) / (whole["clean"] + 1)))
    best = counts.where("key != ''").where(surely > 0).withColumn("lift", lift).where("lift > 2").orderBy(
        (F.col("lift") * F.col("toxic")).desc(), "key").limit(4 * MINED).collect()
    model = Model(mined={key: k for k, key in enumerate(distinct_stems(best)[:MINED])})

    def voted(rows):
        for batch in rows:
            fired = [model.votes(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(fired, pa.list_(pa.int32()))], ["toxic", "votes"])

    rows = sample.mapInArrow(voted, "toxic int, votes array<int>").collect()  # bounded by ``examples``
    rows = sorted((r.toxic, tuple(r.votes)) for r in rows)
    votes = np.zeros((len(rows), model.size + 1))
    for k, (toxic, fired) in enumerate(rows):
        votes[k, 0] = toxic
        votes[k, [at + 1 for at in fired]] = 1
    return learn(model, votes)


def with_score(docs: DataFrame, model: Model, column: str = "_score") -> DataFrame:
    """``docs`` with the score of each whole text; nothing is shuffled. Null text scores as empty text."""
    names = docs.columns
    at = names.index("text")

    def batches(rows):
        for batch in rows:
            scores = [model.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, column])

    return docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are never read. The
    score depends on the text alone. Empty and null texts score as a text without a vote; a null
    doc_id is scored and not held out; repeated rows each give a row.
    """
    model = fit(docs, labels, examples)
    found = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
                        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, examples: int = EXAMPLES) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns as given, whatever they are called.

    Null and empty texts score as a text without a vote and stay, rows that repeat a doc_id are judged one by one,
    whole texts of any length are read, and an empty table gives no rows.
    """
    column = free_name(docs)
    return with_score(docs, fit(docs, labels, examples), column).where(F.col(column) < threshold).drop(column)
