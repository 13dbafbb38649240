"""Toxicity scores from weak supervision.

A bounded sample of labelled rows yields a lexicon: whole words and beginnings of words that stand out in toxic texts.
Lexicon parts of several lengths and strengths, and patterns of shouting, become voters. A generative label model
estimates by expectation maximization how each voter, the given label among them, votes in either class and how voters depend on each other beyond
the class, which lowers the weight of voters that repeat each other. A linear classifier over the lexicon is trained
on the posterior labels and scores every text.

Null and empty texts get the score of a text without any entry. Without rows of both classes to learn from, all texts
get the smoothed share of toxic rows. Label rows without id or label are ignored; of several labels of a document the
highest counts. Repeated documents are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.flat import LOWER, byte_sums, range_hash, slices, words
from corpusloom.session import materialize

#: Labelled rows to learn from, taken in the order of a hash of their ids.
SAMPLE_ROWS = 50_000
#: Lexicon entries at most, the share of toxic rows that must have one, and its log odds at least.
LEXICON = 4096
LEAST_SHARE, LEAST_ROWS, LEAST_ODDS = 0.005, 3, 2.5
#: Entries are whole words (0) and beginnings of so many bytes.
KINDS = (0, 3, 4, 5, 6, 7)
#: Voters vote on entries from one of these log odds on.
TIERS = (2.5, 4.0, 6.0)
THRESHOLD = 0.3

_APART = np.ones(256, bool)
_APART[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_SEEN_SHIFT = np.uint64(42)
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True


def features(data: np.ndarray, where: np.ndarray):
    """For each kind of entry: hash and text of every word, letter case aside."""
    data = LOWER[data]
    begins, ends, before = words(data, where, _APART)
    row = np.repeat(np.arange(len(where) - 1), np.diff(before))
    sums = byte_sums(data)
    for kind in KINDS:
        long = ends - begins > kind
        first, last, owner = begins[long], ends[long] if not kind else begins[long] + kind, row[long]
        yield kind, range_hash(sums, first, last) ^ np.uint64(kind), owner


def distinct(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once per row."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], rows[new]


class Index:
    """Finds the positions of keys in a sorted array."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = None

    def find(self, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.seen is None:
            self.seen = np.zeros(1 << (64 - int(_SEEN_SHIFT)), bool)
            self.seen[self.keys >> _SEEN_SHIFT] = True
        some = np.flatnonzero(self.seen[keys >> _SEEN_SHIFT])
        keys, rows = keys[some], rows[some]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[at] == keys
        return at[same], rows[same]

    def __getstate__(self):
        return {"keys": self.keys, "seen": None}


def shouting(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Pattern votes of each text: many capitals, many exclamation marks, marks amid the words."""
    out = np.zeros((len(where) - 1, 3), bool)
    size = np.maximum(np.diff(where), 1)
    letters = _CAPITAL | ~_APART
    marks = np.zeros(256, bool)
    marks[[ord(c) for c in "*#$%&@^~"]] = True
    for j, (table, least) in enumerate(((_CAPITAL, 0.5), (np.arange(256) == ord("!"), 0.02), (marks, 0.05))):
        total = np.concatenate([[0], np.cumsum(table[data])])
        count = total[where[1:]] - total[where[:-1]]
        if j == 0:
            spelled = np.concatenate([[0], np.cumsum(letters[data])])
            out[:, j] = count > least * np.maximum(spelled[where[1:]] - spelled[where[:-1]], 1)
        else:
            out[:, j] = count > least * size
    return out


def label_model(votes: np.ndarray, share: float, start: np.ndarray, turns: int = 4) -> np.ndarray:
    """Posterior probability of class 1 for rows of votes -1, 0 and 1, given the share of class 1 and a first guess."""
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    said = (votes == 1).astype(float)
    weights = np.ones(votes.shape[1])
    posterior = np.clip(start, 0.05, 0.95)
    for turn in range(turns):
        odds = np.full(len(votes), np.log(share) - np.log1p(-share))
        dependence = np.zeros((votes.shape[1],) * 2)
        for sign, mass in ((1, posterior), (-1, 1 - posterior)):
            rates = (np.einsum("i,ijv->jv", mass, hot) + 0.1) / (mass.sum() + 0.3)
            odds += sign * (np.einsum("ijv,jv->ij", hot, np.log(rates)) @ weights)
            rest = (said - rates[:, 2]) * np.sqrt(mass)[:, None]
            spread = np.sqrt((rest**2).sum(axis=0)) + 1e-9
            dependence = np.maximum(dependence, rest.T @ rest / spread[:, None] / spread)
        if turn == turns - 1:
            # A group of voters that say the same, given the class, counts as one. That is settled in the last turn:
            # going on with such weights, the classes would blur and all voters would seem to depend on each other.
            np.fill_diagonal(dependence, 1)
            weights = 1 / np.maximum(dependence, 0).sum(axis=1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def linear_model(at: np.ndarray, rows: np.ndarray, target: np.ndarray, size: int, turns: int = 400, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on the presence of entries, by full-batch gradient steps."""
    n = len(target)
    weights = np.zeros(size + 1)
    weights[-1] = np.log(target.mean() + 1e-6) - np.log1p(1e-6 - target.mean())
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, turns + 1):
        score = np.bincount(rows, weights[at], n) + weights[-1]
        miss = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) / n
        slope = np.append(np.bincount(at, miss[rows], size) + shrink * weights[:-1], miss.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.1 * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return weights[:-1], float(weights[-1])


def voters(at: np.ndarray, rows: np.ndarray, shouts: np.ndarray, kinds: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Votes of each row: 1 for a voter that finds an entry, -1 for one that looks and finds none; patterns abstain."""
    n, out = len(shouts), []
    for kind in KINDS:
        for least in TIERS:
            entries = (kinds == kind) & (odds >= least)
            if entries.any():
                out.append(np.where(np.bincount(rows[entries[at]], minlength=n) > 0, 1, -1))
    several = np.bincount(rows, minlength=n)
    out += [np.where(several >= k, 1, -1) for k in (2, 4)] + list(shouts.T.astype(int))
    return np.stack(out, axis=1)


@dataclass
class ToxicityModel:
    """Lexicon keys with their weights, and the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, text: Column | str) -> Column:
        """Probability that a text is toxic."""
        index, weights, intercept = Index(self.keys), self.weights, self.intercept

        def scored(texts: pa.Array) -> pa.Array:
            out = []
            for some, data, where in slices(pa.record_batch([texts], ["text"]), "text"):
                found = [index.find(keys, rows) for _, keys, rows in features(data, where)]
                at, rows = distinct(*(np.concatenate(part) for part in zip(*found, strict=True)))
                total = np.bincount(rows, weights[at], some.num_rows) + intercept
                out.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            return pa.array(np.concatenate(out) if out else [], pa.float64())

        return F.arrow_udf(scored, "double")(text)


def counted(sample: DataFrame, known: np.ndarray | None) -> DataFrame:
    """In how many texts of each class a feature stands: all features, or those known."""
    index = None if known is None else Index(known)

    def count(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                toxic = some.column("toxic").to_numpy(zero_copy_only=False)
                for kind, keys, rows in features(data, where):
                    if index is not None:
                        at, rows = index.find(keys, rows)
                        keys = known[at]
                    keys, rows = distinct(keys, rows)
                    keys, place = np.unique(keys, return_inverse=True)
                    counts = [np.bincount(place[toxic[rows] == y], minlength=len(keys)) for y in (0, 1)]
                    yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), kind, np.int32)), *map(pa.array, counts)], ["key", "kind", "n0", "n1"])

    return sample.mapInArrow(count, "key long, kind int, n0 long, n1 long").groupBy("key", "kind").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def looked_up(sample: DataFrame, known: np.ndarray) -> DataFrame:
    """The lexicon entries and pattern votes of each row."""
    index = Index(known)

    def look(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                found = [index.find(keys, rows) for _, keys, rows in features(data, where)]
                at, rows = distinct(*(np.concatenate(part) for part in zip(*found, strict=True)))
                ends = np.searchsorted(rows, np.arange(some.num_rows + 1))
                entries = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
                shouts = pa.array(shouting(data, where).tolist(), pa.list_(pa.bool_()))
                yield pa.record_batch([some.column("toxic"), entries, shouts], ["toxic", "entries", "shouts"])

    return sample.mapInArrow(look, "toxic int, entries array<int>, shouts array<boolean>")


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, rows: int) -> DataFrame:
    """Texts and labels of up to ``rows`` labelled documents."""
    chosen = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # The sample is bounded by ``rows``, so it may go to every task; the texts stay where they are.
    return texts.join(F.broadcast(chosen), "id").select("toxic", "text")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    lexicon: int = LEXICON,
) -> ToxicityModel:
    """Learn from the given labels; leave out of them what must not be learned from."""
    spark = docs.sparkSession
    sample = materialize(labelled_sample(docs, labels, id_column, text_column, label_column, sample_rows), "toxicity")
    total, toxic = sample.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (toxic + 0.5) / (total + 5)
    none = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    if not 0 < toxic < total:
        return none
    least = max(LEAST_ROWS, int(LEAST_SHARE * toxic))
    often = materialize(counted(sample.where("toxic = 1"), None).where(F.col("n1") >= least).select("key"), "features")
    # Each kept feature stands in a fixed share of the toxic rows, so their number does not grow with the rows.
    known = np.sort(np.array([r.key for r in often.collect()], np.int64).view(np.uint64))
    counts = counted(sample, known).toPandas()
    odds = np.log((counts.n1 + 0.5) / (toxic + 1)) - np.log((counts.n0 + 0.5) / (total - toxic + 1))
    counts = counts.assign(odds=odds)[odds >= LEAST_ODDS].sort_values(["odds", "key"], ascending=[False, True])[:lexicon]
    if not len(counts):
        return none
    keys = counts.key.to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, kinds, odds = keys[order], counts.kind.to_numpy()[order], counts.odds.to_numpy()[order]
    rows = looked_up(sample, keys).toPandas()
    at = np.concatenate(rows.entries.to_numpy()).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), rows.entries.map(len))
    votes = voters(at, owner, np.stack(rows.shouts.to_numpy()), kinds, odds)
    # The given label is one more voter, whose accuracy is estimated like the others'.
    given = rows.toxic.to_numpy()
    posterior = label_model(np.column_stack([votes, 2 * given - 1]), share, given)
    weights, intercept = linear_model(at, owner, posterior, len(keys))
    return ToxicityModel(keys, weights, intercept)


def held_out(id_column: str = "doc_id") -> Column:
    """The quarter of all ids that is kept for measuring."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def fit_without_held_out(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", **options) -> ToxicityModel:
    return fit(docs, labels.where(~held_out(id_column)), id_column, **options)
