"""Quality rules: base counts of every text and a verdict by importance of hashed n-grams.

The verdict is the log-likelihood ratio of a text's hashed byte n-grams between
two multinomials, that of trusted texts and that of the raw corpus, divided by
the number of n-grams.  Texts unlike the trusted ones have a low ratio and fall
below a threshold that is the same for every document and rerun.

The raw multinomial counts every document and the trusted one every document
labelled 1.  The threshold is the best of all documents that are labelled, or of
those outside the held-out third where it is to be judged on that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .labelled import beside_labels, every_label, label_sample, training_labels, with_every_label
from .text import U64, Words, binary_text, coded, gives_back, is_space, mix64, ranked, repeated, slices

N, BUCKETS = 3, 1 << 16
#: Trusted counts are smoothed by so many draws from the raw multinomial.
PRIOR = 10_000.0
#: A trusted document below the threshold weighs as much as so many others above it.
TRUSTED_COST = 20.0
SLICE_BYTES = 2 << 20
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
RUN_DDL = "first double, last double, ones long, zeros long, value double, low double, high double"
RUN = pa.schema([(c.split()[0], {"double": pa.float64(), "long": pa.int64()}[c.split()[1]]) for c in RUN_DDL.split(", ")])


def grams(data: np.ndarray, offsets: np.ndarray, n: int = N, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket and row of every run of n bytes within one text."""
    count = len(data) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(count, U64)
    for i in range(n):
        value = (value << U64(8)) | data[i : i + count]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:count] == row[n - 1 :]
    return (mix64(value[inside]) % U64(buckets)).astype(np.int64), row[:count][inside]


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket and the threshold on their mean."""

    ratio: np.ndarray
    threshold: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log ratio of each text; 0 for texts without an n-gram."""
        gram, row = grams(data, offsets)
        rows = len(offsets) - 1
        return np.bincount(row, self.ratio[gram], rows) / np.maximum(np.bincount(row, minlength=rows), 1)


@gives_back
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches, SLICE_BYTES):
        total += np.bincount(grams(*binary_text(batch.column("text")))[0], minlength=BUCKETS)
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], ["bucket", "n"])


def _counts(texts: DataFrame) -> np.ndarray:
    """How many n-grams of all texts each bucket has."""
    rows = texts.mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()  # BUCKETS rows at most
    total = np.zeros(BUCKETS)
    for bucket, n in rows:
        total[bucket] = n
    return total


@gives_back
def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(*binary_text(batch.column("text"))))], ["doc_id", "score"])


@dataclass
class Run:
    """Consecutive scores, and the best cut between two of them.

    value is what the cut costs for the run's own scores, less by all of its
    zeros, so runs need not know of each other; the cut is between low and
    high, nowhere (infinite value) in a run of one score.
    """

    first: float
    last: float
    ones: int = 0
    zeros: int = 0
    value: float = float("inf")
    low: float = 0.0
    high: float = 0.0

    def add(self, s: np.ndarray, ones: np.ndarray, zeros: np.ndarray, cost: float) -> None:
        """Further distinct scores, ascending, and how many of each label have them."""
        value = cost * (self.ones + np.cumsum(ones) - ones) - (self.zeros + np.cumsum(zeros) - zeros)
        gap = np.diff(s, prepend=self.last)  # 0 only at a run's first score
        value = np.where(gap > 0, value, np.inf)
        least = np.flatnonzero(value == value.min())
        k = int(least[np.argmax(gap[least])])
        if (value[k], -gap[k]) < (self.value, self.low - self.high):
            self.value, self.low, self.high = float(value[k]), float(s[k - 1]) if k else self.last, float(s[k])
        self.ones, self.zeros, self.last = self.ones + int(ones.sum()), self.zeros + int(zeros.sum()), float(s[-1])


def _runs(batches: Iterator[pa.RecordBatch], cost: float) -> Iterator[pa.RecordBatch]:
    """The run of a whole partition, which is sorted."""
    run = None
    for batch in batches:
        if batch.num_rows:
            s, ones, zeros = (batch.column(c).to_numpy() for c in ("score", "ones", "zeros"))
            run = run or Run(float(s[0]), float(s[0]))
            run.add(s, ones, zeros, cost)
    if run:
        yield pa.RecordBatch.from_pylist([asdict(run)], RUN)


def best_of(runs: list[Run], cost: float = TRUSTED_COST) -> float:
    """The middle of the widest best gap of runs that do not overlap; -inf without both labels."""
    runs = sorted(runs, key=lambda r: r.first)
    all_ones, all_zeros = sum(r.ones for r in runs), sum(r.zeros for r in runs)
    if not all_ones or not all_zeros:
        return float("-inf")
    # Errors, gap and threshold of each cut: below all scores, between runs, in runs, above all.
    cuts, ones, zeros = [(all_zeros, 0.0, runs[0].first - 1e-9)], 0, 0
    for i, r in enumerate(runs):
        before = cost * ones + all_zeros - zeros
        if i:
            cuts.append((before, r.first - runs[i - 1].last, (runs[i - 1].last + r.first) / 2))
        cuts.append((before + r.value, r.high - r.low, (r.low + r.high) / 2))
        ones, zeros = ones + r.ones, zeros + r.zeros
    cuts.append((cost * all_ones, 0.0, runs[-1].last + 1e-9))
    return float(min(cuts, key=lambda c: (c[0], -c[1]))[2])


def best_threshold(scores: np.ndarray, labels: np.ndarray, cost: float = TRUSTED_COST) -> float:
    """The middle of the widest best gap: scores of 1 should be above, of 0 below; -inf without both."""
    if not len(scores):
        return float("-inf")
    s, place = np.unique(scores, return_inverse=True)
    run = Run(float(s[0]), float(s[0]))
    run.add(s, *[np.bincount(place, labels == y, len(s)).astype(np.int64) for y in (1, 0)], cost)
    return best_of([run], cost)


def threshold_of(scored: DataFrame, cost: float = TRUSTED_COST) -> float:
    """``best_threshold`` of any number of rows of score and label.

    Scores are counted and dealt by ranges; each range gives one row, so the
    driver has as many as there are partitions.
    """
    of = lambda y: F.count_if(F.col("label") == y)
    counts = scored.groupBy("score").agg(of(1).alias("ones"), of(0).alias("zeros"))
    runs = counts.repartitionByRange("score").sortWithinPartitions("score").mapInArrow(lambda b: _runs(b, cost), RUN_DDL)
    return best_of([Run(**r.asDict()) for r in runs.collect()], cost)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int | None = None, hold_out: bool = True) -> Model:
    """Counts all of docs, and as trusted all that are marked 1; all labelled documents set the threshold.

    With ``hold_out`` those are outside the held-out third, on which the
    threshold can then be judged; ``sample`` bounds their number where a caller
    wants that.  Texts are scored where they are, and only ids and scores are
    shuffled to the labels.
    Without trusted documents every ratio is 0 and nothing is rejected by it.
    """
    trusted = _counts(with_every_label(docs, every_label(labels, label).where("label = 1")))
    if not trusted.sum():
        return Model(np.zeros(BUCKETS), float("-inf"))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    raw = _counts(texts.select("text"))
    p = (raw + 1e-3) / (raw + 1e-3).sum()
    model = Model(np.log((trusted + PRIOR * p) / (trusted.sum() + PRIOR)) - np.log(p), 0.0)
    if sample is not None:
        chosen = label_sample(labels, label, sample, hold_out)
    else:
        chosen = training_labels(labels, label) if hold_out else every_label(labels, label)
    scores = texts.where("doc_id is not null").mapInArrow(lambda b: _scored(b, model), texts.select("doc_id", F.lit(0.0).alias("score")).schema)
    return Model(model.ratio, threshold_of(beside_labels(scores, chosen)))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    rows = len(offsets) - 1
    words = Words(data, offsets)
    per_row = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][offsets])
    space = is_space(data)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    # Lines: from the text's start or after \n, up to the next \n or the end.
    newline = np.flatnonzero(data == 10)
    text_of = np.searchsorted(offsets, newline, "right") - 1
    starts = np.r_[offsets[:-1], newline + 1]
    owner = np.r_[np.arange(rows), text_of]
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.r_[starts[1:] - 1, 0]
    last = np.r_[owner[1:] != owner[:-1], True]
    ends[last] = offsets[owner[last] + 1]
    inked = np.r_[0, np.cumsum(~space)]
    has_word = inked[ends] > inked[starts]
    starts, ends, owner = starts[has_word], ends[has_word], owner[has_word]
    line = coded(data, starts, ends)
    _, same = repeated(ranked((owner, max(rows, 1)), (line, len(line) + 1)))
    # Windows of three words found again in their text.
    window, _, first = words.sequences(3)
    again = first[repeated(window)[0]]
    covered = np.zeros(len(words.starts), bool)
    for i in range(3):
        covered[again + i] = True
    return {
        "n_words": words.counts,
        "word_chars": per_row(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(symbol[data]),
        "n_dup_lines": np.bincount(owner[same], minlength=rows),
        "n_repeat_words": np.diff(np.r_[0, np.cumsum(covered)][words.bounds]),
    }


COLUMNS_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


OWN = [x.split()[0] for x in COLUMNS_DDL.split(", ")]


@gives_back
def _judged(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        data, offsets = binary_text(batch.column("text"))
        counts = base_counts(data, offsets)
        failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
        llr = model.scores(data, offsets)
        columns = [*counts.values(), failed, llr, ~failed & (llr >= model.threshold)]
        arrays = [pa.array(c.astype(np.int64) if c.dtype.kind in "iu" else c) for c in columns]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", *OWN])


def judge_rows(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """row (a struct of docs' columns, or of those to carry) with the counts, base_failed, llr and kept.

    Base rules fail texts of fewer than 50 words, and those with over half of
    their words in 3-word windows found twice or more.  A text that passes is
    kept if its mean log ratio reaches the threshold.  Every row is judged on
    its own whole text, so repeated rows and null ids are judged alike.  Null
    counts as empty; texts without a word have zeros and fail.  Columns of any
    name stay inside ``row``.  An empty table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    rows = docs.select(row.alias("row"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    schema = StructType([rows.schema["row"], *StructType.fromDDL(COLUMNS_DDL).fields])
    return rows.mapInArrow(lambda batches: _judged(batches, model), schema)


def judge(docs: DataFrame, model: Model, with_text: bool = True) -> DataFrame:
    """``judge_rows`` with docs' columns beside the judgement, but for those that are named, in any case, like one of its own."""
    taken = {*OWN, *(() if with_text else ("text",))}
    carry = [c for c in docs.columns if c.lower() not in taken]
    return judge_rows(docs, model, carry).select(*[F.col("row")[c].alias(c) for c in carry], *OWN)
