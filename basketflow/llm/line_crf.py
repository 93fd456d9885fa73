"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad.  A line's evidence are counts of its characters
and words, and the same of the line before and after it; transitions tie
neighbouring lines together.  Forward-backward gives each line the probability
that it is good; their mean, weighted by the lines' lengths, tells the document's
quality, through a logistic curve fitted to the documents of the training sample.

The field is trained on a bounded sample of labelled documents, whose lines take
their document's label; only the lines' features come to the driver.  Scoring is
one narrow pass over the texts.  Labels, language, source and id of a document are
never among the features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import stored, text_chunks, text_or_empty

#: Labelled documents to train on, at most, and lines of all of them; their texts are whole.
TRAIN_DOCS, TRAIN_LINES = 6_000, 1_200_000
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 150, 0.1, 1e-3
#: Lines, with those that pad shorter texts, that are worked on at once.
CELLS = 1 << 16

#: Groups of characters that are counted.
SYMBOLS, PIPES, STOPS = b"#*$%&<>@=_~^\\/{}[]+", b"|", b".,;:!?"

FEATURES = [
    "length", "words", "word_length", "symbols", "pipes", "stops", "digits", "capitals", "beyond_ascii",
    "marked_words", "ends_in_stop", "again", "repeated_words", "blank",
]


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for number, group in enumerate((b" \t\v\f\r", SYMBOLS, PIPES, STOPS, b"0123456789"), 1):
        table[list(group)] = number
    table[ord("A") : ord("Z") + 1] = 6
    table[0xC0:] = 7  # begins a character beyond ASCII
    table[0x80:0xC0] = 8  # goes on with it
    return table


CLASS = _class_table()


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the lines' lengths in bytes, and the lines per text."""
    lines_of = [text.split(b"\n") for text in texts]
    counts = np.array([len(lines) for lines in lines_of], np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kinds = CLASS[data]
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = (ends - starts).astype(np.float64)

    def per_line(marks: np.ndarray) -> np.ndarray:
        return np.add.reduceat(marks.astype(np.int32), starts).astype(np.float64)

    blank = (kinds == 1) | (data == 10)
    opens = ~blank
    opens[1:] &= blank[:-1]
    closes = ~blank
    closes[:-1] &= blank[1:]
    words = per_line(opens)
    known = np.maximum(words, 1)
    length = np.maximum(size, 1)
    filled = np.maximum(per_line(~blank), 1)
    again, repeated = np.zeros(len(ends)), np.zeros(len(ends))
    at = 0
    for lines in lines_of:
        seen = set()
        for line in lines:
            if line in seen and line.strip():
                again[at] = 1
            seen.add(line)
            own = line.split()
            repeated[at] = 1 - len(set(own)) / len(own) if own else 0
            at += 1
    last = np.maximum(ends - 1, 0)
    columns = (
        lambda: np.log1p(size),
        lambda: np.log1p(words),
        lambda: filled / known,
        lambda: per_line(kinds == 2) / length,
        lambda: per_line(kinds == 3) / length,
        lambda: per_line(kinds == 4) / length,
        lambda: per_line(kinds == 5) / length,
        lambda: per_line(kinds == 6) / length,
        lambda: per_line(kinds == 7) / length,
        lambda: per_line(closes & ((kinds == 2) | (kinds == 3))) / known,
        lambda: (kinds[last] == 4) & (size > 0),
        lambda: again,
        lambda: repeated,
        lambda: words == 0,
    )
    features = np.empty((len(ends), len(columns)))
    for number, column in enumerate(columns):
        features[:, number] = column()
    return features, size, counts


def moved(values: np.ndarray, counts: np.ndarray, by: int) -> np.ndarray:
    """Each line's value moved ``by`` lines (1 or -1) within its text; zero where none comes."""
    first = np.cumsum(counts) - counts
    result = np.roll(values, by, axis=0)
    result[first if by == 1 else first + counts - 1] = 0
    return result


def evidence_of(features: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of a line's features, those of the line before and of the line after, and one, by ``weights``."""
    own, before, after = np.split(weights[:-1], 3)
    found = features @ own + weights[-1]
    found += moved(features @ before, counts, 1)
    found += moved(features @ after, counts, -1)
    return found


@dataclass
class Field:
    """Weights of evidence for "good", of transitions, and of the curve for documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray  # from bad, good to bad, good
    curve: tuple[float, float] = (1.0, 0.0)

    def evidence(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return evidence_of((features - self.mean) / self.scale, counts, self.weights)


def padded(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of one text each, zero beyond its lines."""
    grid = np.zeros((len(counts), counts.max(initial=1)))
    grid[np.arange(grid.shape[1])[None, :] < counts[:, None]] = values
    return grid


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(evidence: np.ndarray, counts: np.ndarray, transitions: np.ndarray):
    """Forward-backward for texts of one block.

    Returns the probability that each line is good, the expected counts of each
    transition (2 x 2), and the log of the normaliser per text.
    """
    grid = padded(evidence, counts)
    texts, length = grid.shape
    order = np.argsort(-counts, kind="stable")
    grid, sizes = grid[order], counts[order]
    active = [int((sizes > t).sum()) for t in range(length)]
    ahead = np.zeros((length, texts, 2))
    ahead[0, :, 1] = grid[:, 0]
    for t in range(1, length):
        n = active[t]
        for state in (0, 1):
            ahead[t, :n, state] = _log_add(
                ahead[t - 1, :n, 0] + transitions[0, state], ahead[t - 1, :n, 1] + transitions[1, state]
            )
        ahead[t, :n, 1] += grid[:n, t]
    back = np.zeros((length, texts, 2))
    total = np.zeros(texts)
    pairs = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        n, later = active[t], active[t + 1] if t + 1 < length else 0
        total[later:n] = _log_add(ahead[t, later:n, 0], ahead[t, later:n, 1])
        if later:
            into = back[t + 1, :later].copy()
            into[:, 1] += grid[:later, t + 1]
            for state in (0, 1):
                back[t, :later, state] = _log_add(
                    transitions[state, 0] + into[:, 0], transitions[state, 1] + into[:, 1]
                )
                for to in (0, 1):
                    path = ahead[t, :later, state] + transitions[state, to] + into[:, to] - total[:later]
                    pairs[state, to] += np.exp(path).sum()
    good = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[None, :]).T
    restored = np.empty_like(order)
    restored[order] = np.arange(texts)
    good, total = good[restored], total[restored]
    return good[np.arange(length)[None, :] < counts[:, None]], pairs, total


def chain(evidence: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The probability that each line of one text is good, for a text of any length.

    A message is the log of the odds of "good" alone, so a line takes a few numbers.
    """
    (bad_bad, bad_good), (good_bad, good_good) = transitions.tolist()
    own = evidence.tolist()

    def odds(x: float, to_good: tuple[float, float], to_bad: tuple[float, float]) -> float:
        """The odds after a step whose scores are these from bad and (with ``x``) from good."""
        return _log_sum(to_good[0], to_good[1] + x) - _log_sum(to_bad[0], to_bad[1] + x)

    found, message = np.empty(len(own)), own[0]
    for t, e in enumerate(own):
        if t:
            message = e + odds(message, (bad_good, good_good), (bad_bad, good_bad))
        found[t] = message
    message = 0.0
    for t in range(len(own) - 2, -1, -1):
        message = odds(own[t + 1] + message, (good_bad, good_good), (bad_bad, bad_good))
        found[t] += message
    return 1 / (1 + np.exp(-np.clip(found, -700, 700)))


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def blocks(counts: np.ndarray, cells: int = CELLS) -> Iterator[np.ndarray]:
    """Texts in groups of about the same number of lines, padded to at most ``cells`` lines.

    A text with more lines is alone.
    """
    order = np.argsort(counts, kind="stable")
    at = 0
    for end, count in enumerate(counts[order].tolist()):
        if end > at and (end + 1 - at) * count > cells:
            yield order[at:end]
            at = end
    if len(order):
        yield order[at:]


def lines_of(texts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of the lines of some texts among the lines of all."""
    first = np.cumsum(counts) - counts
    sizes = counts[texts]
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(first[texts], sizes) + inside


def line_probabilities(field: Field, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    evidence = field.evidence(features, counts)
    good = np.empty(len(features))
    for texts in blocks(counts):
        rows = lines_of(texts, counts)
        if len(texts) == 1:
            good[rows] = chain(evidence[rows], field.transitions)
        else:
            good[rows] = marginals(evidence[rows], counts[texts], field.transitions)[0]
    return good


def weighted(good: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The mean over a text's lines, by length; a text without characters: its first line's."""
    first = np.cumsum(counts) - counts
    weight = np.add.reduceat(size, first)
    mean = np.add.reduceat(good * size, first) / np.maximum(weight, 1)
    return np.where(weight > 0, mean, good[first])


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def train(features: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Conditional likelihood of the documents' labels on all their lines, by Adam."""
    mean, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    inputs = (features - mean) / scale
    target = np.repeat(labels, counts).astype(np.float64)
    groups = [(texts, lines_of(texts, counts)) for texts in blocks(counts)]
    seen = np.zeros((2, 2))
    for state in (0, 1):
        seen[state, state] = (counts - 1)[labels == state].sum()
    params = np.zeros(3 * inputs.shape[1] + 1 + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, transitions = params[:-4], params[-4:].reshape(2, 2)
        evidence = evidence_of(inputs, counts, weights)
        good, pairs = np.empty(len(target)), np.zeros((2, 2))
        for texts, rows in groups:
            good[rows], own, _ = marginals(evidence[rows], counts[texts], transitions)
            pairs += own
        error = target - good
        by_weight = [inputs.T @ e for e in (error, moved(error, counts, -1), moved(error, counts, 1))]
        gradient = np.concatenate([*by_weight, [error.sum()], (seen - pairs).ravel()]) / len(target)
        gradient -= PENALTY * params
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    field = Field(mean, scale, params[:-4], params[-4:].reshape(2, 2))
    raw = logit(weighted(line_probabilities(field, features, counts), size, counts))
    field.curve = fitted_curve(raw, labels)
    return field


def fitted_curve(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton steps."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))
        w = p * (1 - p) + 1e-6
        error = labels - p
        h = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(h, [(error * raw).sum() - (slope - 1), error.sum()])
        slope, offset = slope + np.clip(move[0], -1, 1), offset + np.clip(move[1], -1, 1)
    return max(slope, 1e-3), offset


def score(field: Field, texts: list[bytes]) -> np.ndarray:
    raw = np.empty(len(texts))
    # The features of a few texts at a time: they are many times a text of short lines.
    for some in blocks(np.array([1 + text.count(b"\n") for text in texts], np.int64)):
        features, size, counts = line_features([texts[i] for i in some])
        raw[some] = logit(weighted(line_probabilities(field, features, counts), size, counts))
    slope, offset = field.curve
    return 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))


def remainder(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> Field:
    """The field from at most ``max_docs`` labelled documents that are not held out.

    They train with all their lines.  A document that has more than are left of
    ``max_lines`` after those before it, in order of a hash, is left out as a whole.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            features, size, counts = line_features(texts)
            rows = np.split(np.column_stack([size, features]), np.cumsum(counts)[:-1])
            columns = [pa.array([r.ravel() for r in rows], pa.list_(pa.float64())), batch.column("label")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lines", "label"])

    texts = docs.select(F.col("doc_id"), text_or_empty(docs).alias("text")).join(F.broadcast(known), "doc_id")
    texts = stored(texts.withColumn("n", 1 + F.length("text") - F.length(F.translate("text", "\n", ""))), "sample")
    sizes = texts.groupBy("doc_id").agg(F.sum("n").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    whole, left = [], max_lines
    for r in sizes:
        if r["n"] <= left:
            whole.append((r["doc_id"],))
            left -= r["n"]
    if len(whole) < len(sizes):
        fits = docs.sparkSession.createDataFrame(whole, docs.select("doc_id").schema)
        texts = texts.join(F.broadcast(fits), "doc_id", "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "text", "label").mapInArrow(
        features_of, f"doc_id {kind}, lines array<double>, label int"
    )
    sample = found.toArrow().combine_chunks()
    ids, known_labels = (sample.column(name).to_pylist() for name in ("doc_id", "label"))
    # In a fixed order, so that training again gives the same field.
    order = sorted(range(len(ids)), key=lambda i: (ids[i], known_labels[i]))
    if len(set(known_labels)) < 2:
        # Nothing to learn from: lines are as good as the labels say, or even.
        share = float(np.mean(known_labels)) if known_labels else 0.5
        size = len(FEATURES)
        weights = np.zeros(3 * size + 1)
        weights[-1] = float(logit(np.array(share)))
        return Field(np.zeros(size), np.ones(size), weights, np.zeros((2, 2)))
    lines = sample.column("lines").chunk(0)
    ends, values = lines.offsets.to_numpy(), lines.flatten().to_numpy()
    grids = [values[ends[i] : ends[i + 1]].reshape(-1, len(FEATURES) + 1) for i in order]
    every = np.concatenate(grids)
    return train(every[:, 1:], every[:, 0], np.array([len(g) for g in grids]), np.array(known_labels)[order])


def quality_scores(
    docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    ``score`` is from 0 to 1, higher if label 1 is likelier; ``predicted`` is 1 from
    ``threshold`` on.  Null and empty texts are one empty line.  A null ``doc_id``
    is not held out and has no label.  Rows with ``crc32(doc_id) % 5 = 0`` are held
    out and never train.  Columns other than ``doc_id`` and the text are not read.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_docs))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            scores = score(field.value, batch.column("text").cast(pa.binary()).to_pylist())
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = F.coalesce(remainder(docs["doc_id"]) == 0, F.lit(False)).alias("held_out")
    rows = docs.select(docs["doc_id"], held_out, text_or_empty(docs).alias("text"))
    result = rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double")
    return result.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
