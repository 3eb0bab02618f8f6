"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded, from counts of its
bytes and words' repeats and from learned embeddings of its words and their
beginnings, hashed; gated attention
(Ilse et al., "Attention-based Deep Multiple Instance Learning", 2018) weighs
the passages of a document by what their encodings show, and a logistic unit
scores the weighted sum.  Only documents have labels: what makes a passage
matter is learned from them.

The model is fitted on the driver from all passages of a bounded sample of
labelled documents, which it keeps in files, and is some 35,000 numbers;
scoring reads each text once and whole, without a shuffle.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .labelled import label_sample
from .text import U64, Words, binary_text, mix64, ranked, repeated, slices

PASSAGE = 48
SLICE_BYTES = 1 << 20
#: The most labelled documents that the model is fitted on.
SAMPLE = 6_000
#: Passages of a row that goes to the driver, partitions of such rows, of which it holds one at a time, and passages of
#: documents whose gradient is taken at once (one document may have more).
PIECE, PARTS, AT_ONCE = 4_096, 128, 16_384
#: Rows and width of the embedding of words, bytes of a word's beginning, and words of a passage that a training step draws.
WORD_ROWS, WORD_WIDTH, BEGINNING, DRAWN = 4_096, 8, 4, 8
HIDDEN, ATTENTION, STEPS, BATCH, RATE, DECAY, SEED = 16, 8, 1500, 64, 0.01, 1e-4, 17
HASHED = 48
#: Kinds of bytes whose shares describe a passage.
KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"\n", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"!", b"?", b".", b",;:", b"'\"()[]{}-_/\\@=+~^`", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
FEATURES = len(KINDS) + HASHED + 6


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and how many passages each text has.

    A passage is a run of PASSAGE words, the last of a text a shorter one.  A
    text without words has one passage of zeros.
    """
    words = Words(data, offsets)
    per_text = np.maximum(-(-words.counts // PASSAGE), 1)
    total = int(per_text.sum())
    out = np.zeros((total, FEATURES), np.float32)
    if not len(words.starts):
        return out, per_text
    base = np.cumsum(per_text) - per_text
    row = np.repeat(np.arange(words.rows), words.counts)
    within = np.arange(len(row)) - words.bounds[row]
    passage = base[row] + within // PASSAGE
    begins = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    there = passage[begins]
    n_words = np.diff(np.r_[begins, len(row)])
    first = words.starts[begins]
    stop = np.where(np.r_[there[1:] == there[:-1] + 1, False] & np.r_[row[begins][1:] == row[begins][:-1], False], np.r_[first[1:], 0], offsets[row[begins] + 1])
    length = np.maximum(stop - first, 1).astype(np.float32)
    share = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][np.stack([first, stop], 1)], axis=1)[:, 0]
    for k, kind in enumerate(KINDS):
        inside = np.zeros(256, bool)
        inside[list(kind)] = True
        out[there, k] = np.sqrt(share(inside[data]) / length)
    # Adjacent bytes, hashed: which pairs a passage is made of.
    pair = (mix64((data[:-1].astype(U64) << U64(8)) | data[1:]) % U64(HASHED)).astype(np.int64) if len(data) > 1 else np.zeros(0, np.int64)
    of = np.full(len(data), -1)
    sizes = stop - first
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    of[at] = np.repeat(there, sizes)
    good = (of[:-1] >= 0) & (of[:-1] == of[1:])
    counts = np.bincount(of[:-1][good] * HASHED + pair[good], minlength=total * HASHED).reshape(total, HASHED)
    out[:, len(KINDS) : len(KINDS) + HASHED] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    k = len(KINDS) + HASHED
    sizes = words.ends - words.starts
    mean = lambda values: np.add.reduceat(values.astype(np.float64), begins) / n_words
    out[there, k] = np.log1p(mean(sizes))
    out[there, k + 1] = mean(sizes == 1)
    code, size = words.codes
    out[there, k + 2] = mean(repeated(ranked((passage, total), (code, size)))[1])
    out[there, k + 3] = mean(repeated(ranked((row, words.rows), (code, size)))[1])
    window, _, window_first = words.sequences(3)
    found = np.zeros(len(code), bool)
    found[window_first[repeated(window)[0]]] = True
    out[there, k + 4] = mean(found)
    out[there, k + 5] = np.log1p(n_words)
    return out, per_text


Bag = tuple[np.ndarray, np.ndarray]


def word_bags(data: np.ndarray, offsets: np.ndarray) -> Bag:
    """Embedding rows of the words of all passages, two for each word, and how many each passage has."""
    words = Words(data, offsets, lower=True)
    per_text = np.maximum(-(-words.counts // PASSAGE), 1)
    within = np.arange(len(words.row)) - words.bounds[words.row]
    passage = (np.cumsum(per_text) - per_text)[words.row] + within // PASSAGE
    whole, beginning = words.prefix_hashes((BEGINNING,))
    both = np.stack([whole, np.where(beginning == 0, mix64(whole), beginning)], 1)
    return (both % U64(WORD_ROWS)).astype(np.int32).ravel(), 2 * np.bincount(passage, minlength=int(per_text.sum()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Embedding (W), weights of the encoder (E), of tanh and gate attention (V, U, w) and of the score (c)."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def embedded(self, bag: Bag | None, rows: int) -> np.ndarray:
        """The mean embedding of each passage's words; zeros without any."""
        out = np.zeros((rows, WORD_WIDTH))
        if bag is not None and len(bag[0]):
            there = np.flatnonzero(bag[1])
            starts = np.cumsum(bag[1]) - bag[1]
            out[there] = np.add.reduceat(self.p["W"][bag[0]], starts[there]) / bag[1][there, None]
        return out

    def forward(self, x: np.ndarray, n: np.ndarray, bag: Bag | None = None) -> tuple[np.ndarray, dict]:
        """Scores of bags of n passages each; x: standardised features of all passages; bag: the words of each."""
        p, starts = self.p, np.cumsum(n) - n
        words, x = bag, np.concatenate([x, self.embedded(bag, len(x))], 1)
        z = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(z @ p["V"]), _sigmoid(z @ p["U"])
        a = (t * g) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), n))
        a /= np.repeat(np.add.reduceat(a, starts), n)
        bag = np.add.reduceat(a[:, None] * z, starts)
        return bag @ p["c"] + p["d"][0], {"x": x, "n": n, "starts": starts, "z": z, "t": t, "g": g, "a": a, "bag": bag, "words": words}

    def gradient(self, s: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; error: probability less label of each bag."""
        p, n = self.p, s["n"]
        out = {"c": s["bag"].T @ error, "d": np.array([error.sum()])}
        of_bag = np.repeat(error[:, None] * p["c"], n, axis=0)
        by_a = (of_bag * s["z"]).sum(1)
        logit = s["a"] * (by_a - np.repeat(np.add.reduceat(s["a"] * by_a, s["starts"]), n))
        out["w"] = (s["t"] * s["g"]).T @ logit
        both = logit[:, None] * p["w"]
        by_t, by_g = both * s["g"] * (1 - s["t"] ** 2), both * s["t"] * s["g"] * (1 - s["g"])
        out["V"], out["U"] = s["z"].T @ by_t, s["z"].T @ by_g
        by_z = (s["a"][:, None] * of_bag + by_t @ p["V"].T + by_g @ p["U"].T) * (1 - s["z"] ** 2)
        out["E"], out["e"] = s["x"].T @ by_z, by_z.sum(0)
        out["W"] = np.zeros_like(p["W"])
        if s["words"] is not None:
            ids, sizes = s["words"]
            by_word = (by_z @ p["E"][FEATURES:].T) / np.maximum(sizes, 1)[:, None]
            np.add.at(out["W"], ids, np.repeat(by_word, sizes, axis=0))
        return {k: v / len(n) for k, v in out.items()}

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, n = passages(data, offsets)
        return _sigmoid(self.forward((x - self.mean) / self.scale, n, word_bags(data, offsets))[0])


Spans = list[list[tuple[int, int]]]


def _together(n: np.ndarray) -> Iterator[slice]:
    """Consecutive documents of AT_ONCE passages at most, or a single one."""
    start, total = 0, 0
    for i, k in enumerate(n.tolist()):
        if i > start and total + k > AT_ONCE:
            yield slice(start, i)
            start, total = i, 0
        total += k
    yield slice(start, len(n))


def train(x: np.ndarray, n: np.ndarray, y: np.ndarray, bag: Bag | None = None, seed: int = SEED, spans: Spans | None = None) -> Model:
    """Adam on mini-batches of documents, with DRAWN words of each passage; the same data in the same order give the same model.

    spans: where in x the passages of each document are, if not one document
    after the other; x and the words of bag may be mapped files.
    """
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    prior = np.clip(y.mean(), 0.01, 0.99)
    p = {"W": np.zeros((WORD_ROWS, WORD_WIDTH)), "E": draw(FEATURES + WORD_WIDTH, HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION), "w": draw(ATTENTION), "c": draw(HIDDEN), "d": np.array([np.log(prior / (1 - prior))])}
    if spans is None:
        ends = np.cumsum(n)
        spans = [[span] for span in zip((ends - n).tolist(), ends.tolist(), strict=True)]
    total, squares = np.zeros(FEATURES), np.zeros(FEATURES)
    for i, j in (span for own in spans for span in own):
        part = x[i:j].astype(np.float64)
        total, squares = total + part.sum(0), squares + (part**2).sum(0)
    mean = total / len(x)
    scale = np.sqrt(np.maximum(squares / len(x) - mean**2, 0)) + 0.02
    model = Model(mean.astype(x.dtype), scale.astype(x.dtype), p)
    places = None if bag is None else np.cumsum(bag[1]) - bag[1]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        chosen = rng.integers(0, len(n), BATCH)
        gradient = {k: np.zeros_like(v) for k, v in p.items()}
        for docs in (chosen[some] for some in _together(n[chosen])):
            rows = np.concatenate([np.arange(i, j) for d in docs for i, j in spans[d]])
            drawn = None
            if bag is not None:
                sizes = bag[1][rows]
                at = places[rows][:, None] + (rng.random((len(rows), DRAWN)) * sizes[:, None]).astype(np.int64)
                drawn = bag[0][at[sizes > 0]].ravel(), np.where(sizes > 0, DRAWN, 0)
            score, state = model.forward(((x[rows] - model.mean) / model.scale).astype(np.float64), n[docs], drawn)
            for k, grad in model.gradient(state, _sigmoid(score) - y[docs]).items():
                gradient[k] += grad * (len(docs) / BATCH)
        rate = RATE * (1 - step / (STEPS + 1))
        for k, grad in gradient.items():
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad**2
            p[k] -= rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8) + DECAY * p[k])
    return model


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and words of all passages of every text, PIECE passages a row."""
    for batch in slices(batches, SLICE_BYTES):
        text = binary_text(batch.column("text"))
        (x, n), (ids, sizes) = passages(*text), word_bags(*text)
        sizes, cuts, ends = sizes.astype(np.int32), np.r_[0, np.cumsum(sizes)], np.cumsum(n)
        for doc_id, label, k, end in zip(batch.column("doc_id"), batch.column("label"), n.tolist(), ends.tolist(), strict=True):
            for piece, i in enumerate(range(end - k, end, PIECE)):
                j = min(i + PIECE, end)
                row = [x[i:j].tobytes(), ids[cuts[i] : cuts[j]].tobytes(), sizes[i:j].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()], pa.int64()), pa.array([label.as_py()], pa.int32()), pa.array([piece], pa.int32()), *(pa.array([c], pa.binary()) for c in row)], ENCODED)


ENCODED = ["doc_id", "label", "piece", "features", "words", "sizes"]


def _trained(rows: Iterable[Row]) -> Model | None:
    """The model of encoded pieces in any order, which are kept in files; None without both labels."""
    with tempfile.TemporaryFile() as features, tempfile.TemporaryFile() as words:
        pieces, sizes, done = [], [], 0
        for r in rows:
            features.write(r.features)
            words.write(r.words)
            sizes.append(np.frombuffer(r.sizes, np.int32))
            pieces.append((r.doc_id, r.piece, r.label, done, done + len(sizes[-1])))
            done = pieces[-1][-1]
        docs = [list(own) for _, own in groupby(sorted(pieces), key=lambda p: p[0])]
        y = np.array([own[0][2] for own in docs], float)
        if len(set(y)) < 2:
            return None
        spans = [[p[3:] for p in own] for own in docs]
        n = np.array([sum(j - i for i, j in own) for own in spans])
        features.flush()
        words.flush()
        x = np.asarray(np.memmap(features, np.float32, "r")).reshape(-1, FEATURES)
        ids = np.asarray(np.memmap(words, np.int32, "r")) if words.tell() else np.zeros(0, np.int32)
        return train(x, n, y, (ids, np.concatenate(sizes).astype(np.int64)), spans=spans)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model of at most ``sample`` labelled documents outside the held-out third; None without both labels.

    All of their passages go to the driver, a partition at a time, and there
    into files: some 700 bytes a passage of 48 words.  Documents without an id
    have no label.
    """
    chosen = label_sample(labels, label, sample)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy("doc_id").agg(F.min(F.struct("label", "text")).alias("r")).select("doc_id", "r.*")  # so the sample bounds rows too
    seen = once.mapInArrow(_encoded, "doc_id long, label int, piece int, features binary, words binary, sizes binary")
    return _trained(seen.repartition(PARTS, "doc_id", "piece").toLocalIterator())


def _scored(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE_BYTES):
        scores = np.full(batch.num_rows, 0.5) if model is None else model.scores(*binary_text(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row; texts without words (and null) have the score of an empty passage.

    Every row is scored on its own whole text, so repeated rows, null ids and
    further columns change nothing; an empty table gives an empty result.
    Without a model every score is 0.5.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(lambda batches: _scored(batches, model), "doc_id long, score double")
