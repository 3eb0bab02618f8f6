"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicon entries, some fixed and some mined from a bounded sample of
labelled documents, and patterns of two words.  Each fires on a document or
abstains.  How often voters fire, alone and together, is counted over all
documents; from these moments the label model estimates without labels how much
oftener each fires on toxic documents and which pairs are correlated beyond
the class.  Its posterior labels of a hash sample of all documents, labelled or
not, train the classifier, whose features also cover words that no voter knows:
words and beginnings of words.  A label, where there is one, is one voter more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, label_sample
from .text import U64, Words, binary_text, mix64, slices

#: Common insults in four languages, and patterns of two words.
LEXICON = (
    "arschloch bastard bitch blöd clown connard conne coward creep crétin cretin degenerate depp disgusting dumb dummkopf dumm ekelhaft "
    "estúpido estúpida filth fool freak garbage gilipollas gross idiot idiota idiote idioten idiots imbecile imbécil imbécile jerk liar loser "
    "losers lousy miserable moron morons mierda nazi ordure pathetic pathétique pendejo pig puta repugnant repulsive ridiculous salaud "
    "salope savage scheiße schwein scum shameful shit stupid stupide sucker trash trottel ugly vermin vile wertlos worthless wretch"
).split()
PATTERNS = "shut up|you idiot|you moron|hate you|you are|go die|kill yourself|du bist|tu es|eres un|get lost|screw you".split("|")
SLICE_BYTES = 1 << 20
#: The most labelled documents for mining and training, and about as many of all documents for training; mined voters, and
#: features of the classifier: parameters of ``fit``.
SAMPLE, MINED, FEATURES = 8_000, 96, 4_096
#: What a label adds to the log-odds of its document.
LABEL_ODDS = 4.0
#: The score at which documents are told apart: the intercept is set so that this serves labelled documents best.
LIMIT = 0.7
#: A mined entry is in so many toxic documents of the sample at least, and so many times oftener there than in others.
MINED_LEAST, MINED_LIFT = 5, 12.0
PREFIXES = (4, 5, 6, 7, 8)
#: Features of the classifier differ between the classes by so many standard errors at least.
LEAST_Z = 4.0
#: Standard errors from which a covariance is clear, and from which, with so many times the expected, it is structure.
CLEAR_Z, STRUCTURE_Z, STRUCTURE_TIMES = 4.0, 6.0, 2.0
ROUNDS, DECAY = 400, 5e-4


def _letters(column: pa.Array) -> Words:
    """Lower-cased words of letters: a-z and whatever is not ASCII."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = binary_text(pc.utf8_lower(column.fill_null("")))
    return Words(data, offsets, inside=((data >= 97) & (data <= 122)) | (data >= 128))


def _hashed(column: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the words, pairs of adjacent words and beginnings of words of each text."""
    words = _letters(column)
    each = words.prefix_hashes(prefixes)
    row = np.repeat(np.arange(words.rows), words.counts)
    pair, pair_row, _ = words.windows(2)
    return np.concatenate([*each, mix64(pair ^ U64(0x51ED270B0F2C1A3D))]), np.concatenate([*[row] * len(each), pair_row])


def entry_hashes(entries: list[str]) -> np.ndarray:
    """Hash of each word or pair of words."""
    out = []
    for entry in entries:
        h, _ = _hashed(pa.array([entry]))
        out.append(h[-1])  # of a pair the pair, of a word the word
    return np.array(out, U64)


class Lookup:
    """Finds the entries of a list among many hashes; most others fall to a bitmap."""

    def __init__(self, entries: np.ndarray):
        self.order = np.argsort(entries)
        self.sorted = entries[self.order]
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(entries & U64(0xFFFF)).astype(np.int64)] = True

    def present(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, entry) pairs."""
        maybe = np.flatnonzero(self.bits[(h & U64(0xFFFF)).astype(np.int64)])
        h, row = h[maybe], row[maybe]
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        hit = self.sorted[at] == h
        pairs = np.unique(row[hit] * len(self.order) + self.order[at[hit]])
        return pairs // len(self.order), pairs % len(self.order)


def _mine(batches: Iterator[pa.RecordBatch], prefixes: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        h, row = _hashed(batch.column("text"), prefixes)
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        keep = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] & (h != 0) if len(h) else np.zeros(0, bool)
        h, row = h[keep], row[keep]
        weight = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        begins = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        toxic = np.add.reduceat(weight[row], begins) if len(h) else np.zeros(0)
        n = np.diff(np.r_[begins, len(h)])
        yield pa.RecordBatch.from_arrays([pa.array(h[begins].view(np.int64)), pa.array(toxic, pa.float64()), pa.array(n.astype(np.float64))], ["h", "toxic", "n"])


def _document_counts(sample: DataFrame, prefixes: tuple[int, ...]) -> DataFrame:
    """h, toxic (sum of label) and n, the documents of the sample with each entry."""
    parts = sample.select("label", "text").mapInArrow(lambda b: _mine(b, prefixes), "h long, toxic double, n double")
    return parts.groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """label and text of labelled documents outside the held-out third; of equal texts one."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(label_sample(labels, "toxic", most)), "doc_id")
    return rows.groupBy(F.xxhash64("text").alias("k")).agg(F.min(F.struct("label", "text")).alias("r")).select("r.label", "r.text")


def _unlabelled(docs: DataFrame, most: int) -> DataFrame:
    """text of about ``most`` documents outside the held-out third, by a hash of their texts."""
    texts = docs.where(~held_out(F.col("doc_id"))).select(F.coalesce("text", F.lit("")).alias("text"))
    share = most / max(docs.count(), 1)
    return texts.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 32)) < int(share * (1 << 32)))


def _moments(batches: Iterator[pa.RecordBatch], lookup: Lookup) -> Iterator[pa.RecordBatch]:
    v = len(lookup.order)
    total, n = np.zeros((v, v), np.int64), 0
    for batch in slices(batches, SLICE_BYTES):
        row, entry = lookup.present(*_hashed(batch.column("text")))
        fired = np.zeros((batch.num_rows, v), np.float32)
        fired[row, entry] = 1
        total += (fired.T @ fired).astype(np.int64)
        n += batch.num_rows
    i, j = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, i], pa.int32()), pa.array(np.r_[-1, j], pa.int32()), pa.array(np.r_[n, total[i, j]])], ["i", "j", "n"])


@dataclass(frozen=True)
class LabelModel:
    """prior: share of toxic documents; weight: what a vote adds to the log-odds, discounted for correlations."""

    prior: float
    rate_toxic: np.ndarray
    rate_other: np.ndarray
    correlated: np.ndarray
    weight: np.ndarray

    def posterior(self, fired: np.ndarray, more: np.ndarray | float = 0.0) -> np.ndarray:
        """Probability of toxic for each row of votes, and more log-odds; abstaining says nothing."""
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior / (1 - self.prior)) + fired @ self.weight + more, -30, 30)))


def fit_label_model(together: np.ndarray, n: int, prior: float) -> LabelModel:
    """From counts of how often voters fire together, alone on the diagonal, among n documents.

    Let gap be the difference of a voter's firing rates on toxic and other
    documents.  Given the class, independent voters have Cov(i, j) = gap_i *
    gap_j * prior * (1 - prior), so three of them give gap_i^2 = Cov(i, j) *
    Cov(i, k) / Cov(j, k) / (prior * (1 - prior)) (Fu et al., "Fast and
    Three-rious", 2020); the median over all j and k that covary clearly is
    taken.  Pairs far off their product are correlated beyond the class: they
    are left out, the gaps are estimated again, and their votes are discounted.
    """
    v = len(together)
    rate = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(rate, rate)
    spread = prior * (1 - prior)
    error = np.sqrt(np.maximum(np.outer(rate, rate), 1 / max(n, 1) ** 2) / max(n, 1))
    clear = (cov > CLEAR_Z * error) & ~np.eye(v, dtype=bool)
    correlated = np.zeros((v, v), bool)
    gap = np.zeros(v)
    for _ in range(3):
        good = clear & ~correlated
        for i in range(v):
            mine = np.flatnonzero(good[i])
            trio = good[np.ix_(mine, mine)]
            if trio.any():
                value = np.outer(cov[i, mine], cov[i, mine])[trio] / cov[np.ix_(mine, mine)][trio] / spread
                gap[i] = min(np.sqrt(np.median(value)), 1.0)
        expected = np.outer(gap, gap) * spread
        correlated = clear & (cov - expected > STRUCTURE_Z * error) & (cov > STRUCTURE_TIMES * expected)
    deviation = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    shared = np.where(correlated, np.clip((cov - np.outer(gap, gap) * spread) / np.outer(deviation, deviation), 0, 1), 0).sum(1)
    toxic = np.clip(rate + (1 - prior) * gap, 1e-6, 1 - 1e-6)
    other = np.clip(rate - prior * gap, 0.02 * rate + 1e-7, 1 - 1e-6)
    weight = np.clip(np.log(toxic / other), 0, 6) / (1 + shared)
    return LabelModel(prior, toxic, other, correlated, np.where((rate > 0) & (gap > 0), weight, 0))


@dataclass(frozen=True)
class Model:
    """Log-odds of each feature that a text has, and the intercept."""

    features: Lookup
    weight: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        row, feature = self.features.present(*_hashed(column, PREFIXES))
        odds = self.intercept + np.bincount(row, self.weight[feature], len(column))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _voted(batches: Iterator[pa.RecordBatch], lookup: Lookup, label_model: LabelModel) -> Iterator[pa.RecordBatch]:
    """The texts with posterior labels in the place of labels, which may be null."""
    for batch in slices(batches, SLICE_BYTES):
        row, entry = lookup.present(*_hashed(batch.column("text")))
        fired = np.zeros((batch.num_rows, len(lookup.order)))
        fired[row, entry] = 1
        label = batch.column("label").cast(pa.float64()).fill_null(0.5).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(label_model.posterior(fired, (2 * label - 1) * LABEL_ODDS)), batch.column("label"), batch.column("text")], ["label", "gold", "text"])


def _present(batches: Iterator[pa.RecordBatch], lookup: Lookup) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        row, feature = lookup.present(*_hashed(batch.column("text"), PREFIXES))
        ends = np.cumsum(np.bincount(row, minlength=batch.num_rows))
        lists = np.split(feature.astype(np.int32), ends[:-1])
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("gold"), pa.array([x.tobytes() for x in lists], pa.binary())], ["label", "gold", "features"])


def _logistic(lists: list[np.ndarray], y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and intercept for soft labels y, by Adam on all rows."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    col = np.concatenate(lists) if len(row) else np.zeros(0, np.int64)
    w, prior = np.zeros(size + 1), np.clip(y.mean(), 0.01, 0.99)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        odds = w[-1] + np.bincount(row, w[col], len(lists))
        error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y) / len(lists)
        grad = np.r_[np.bincount(col, error[row], size) + DECAY * w[:-1], error.sum()]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def best_cut(odds: np.ndarray, gold: np.ndarray) -> float:
    """The middle of the gap in the odds above which documents are called toxic with the best F1."""
    order = np.argsort(-odds, kind="stable")
    s, y = odds[order], gold[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[1:] == s[:-1]] = -1  # no cut parts equal odds
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] - 1e-9)


def fit(docs: DataFrame, labels: DataFrame, scratch, sample: int = SAMPLE, most_mined: int = MINED, most_features: int = FEATURES) -> Model:
    """Mines voters from ``sample`` labelled documents at most, counts votes over all, trains on posteriors of those and as many others.

    Without labels only the fixed voters vote, with a prior of 0.1.  The driver
    gets at most ``most_mined`` entries, one number for each pair of voters, ``most_features``
    candidates, and the candidates that each document of the sample has.
    """
    chosen = scratch.save(_sample(docs, labels, sample), "sample")
    n, toxic = chosen.select(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    others = n - toxic
    fixed = entry_hashes([*LEXICON, *PATTERNS])
    mined = np.zeros(0, U64)
    if toxic and others:
        lift = (F.col("toxic") / toxic) / ((F.col("n") - F.col("toxic") + 0.5) / others)
        counts = _document_counts(chosen, ()).where((F.col("toxic") >= MINED_LEAST) & (lift >= MINED_LIFT))
        top = counts.orderBy(F.col("toxic").desc(), "h").limit(most_mined).collect()
        mined = np.array([r.h for r in top], np.int64).view(U64)
    voters = Lookup(np.unique(np.concatenate([fixed, mined])))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(lambda b: _moments(b, voters), "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    together, total = np.zeros((len(voters.order),) * 2), 1
    for i, j, k in rows:
        if i < 0:
            total = max(k, 1)
        else:
            together[i, j] = k
    prior = min(max(toxic / n if n else 0.1, 0.01), 0.5)
    label_model = fit_label_model(together, total, prior)
    if not n:  # nothing to train on: the voters' weights are the classifier
        return Model(voters, label_model.weight, float(np.log(prior / (1 - prior))))
    every = chosen.unionByName(_unlabelled(docs, sample).select(F.lit(None).cast("int").alias("label"), "text"))
    every = every.groupBy(F.xxhash64("text").alias("k")).agg(F.max(F.struct("label", "text")).alias("r")).select("r.label", "r.text")
    voted = scratch.save(every.mapInArrow(lambda b: _voted(b, voters, label_model), "label double, gold int, text string"), "voted")
    share = voted.agg(F.avg("label")).first()[0]
    z = (F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    best = _document_counts(voted, PREFIXES).where((F.col("n") >= 3) & (F.abs(z) >= LEAST_Z)).orderBy(F.abs(z).desc(), "h").limit(most_features).collect()
    if not best:
        return Model(voters, label_model.weight, float(np.log(prior / (1 - prior))))
    features = Lookup(np.array([r.h for r in best], np.int64).view(U64))
    seen = voted.mapInArrow(lambda b: _present(b, features), "label double, gold int, features binary").collect()
    seen.sort(key=lambda r: (r.label, r.features))
    lists = [np.frombuffer(r.features, np.int32) for r in seen]
    weight, intercept = _logistic(lists, np.array([r.label for r in seen]), len(best))
    odds = np.array([weight[x].sum() for x, r in zip(lists, seen, strict=True) if r.gold is not None])
    gold = np.array([r.gold for r in seen if r.gold is not None])
    return Model(features, weight, float(np.log(LIMIT / (1 - LIMIT))) - best_cut(odds, gold) if 0 < gold.sum() < len(gold) else intercept)


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(batch.column("text")))], ["doc_id", "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; null and empty texts have the intercept's.

    Every row is scored on its own whole text, so repeated rows, null ids, ties
    and further columns change nothing; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(lambda batches: _scored(batches, model), "doc_id long, score double")
