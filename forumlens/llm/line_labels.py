"""Quality rules: lines labelled as content or boilerplate by a linear-chain conditional random field.

The field has two states, bucketed features of a line, and transition weights. It is trained by
maximum likelihood on lines of a bounded sample of labelled documents. Labels belong to documents, so
the states of lines are learned in rounds: the best path of a document whose content share agrees with
its label gives the states that the next field is fitted to; the first field has no transitions, so
that a document may hold both states. Viterbi decoding then labels all lines of every document, and the share of words in
content lines decides, after fixed base rules, whether a document is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.passages import Words, runs_of
from forumlens.llm.words import WordHashes, byte_slices, mixed, window_hashes, worker_cache

# Labelled documents drawn for training: the bound of what the driver gathers.
SAMPLE = 2_000
CHUNK_BYTES = 2 << 20
SYMBOLS = b"#*$%&|<>"
STOPS = b".!?:;"
# Fixed values of the base rules.
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
MIN_SHARE = 0.5
# Rounds of training, and what a line of the document's label gains, step by step, until the share agrees.
LABEL_ROUNDS = 3
GAINS = (0.0, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0)
# Upper borders of the buckets of each line feature; the last bucket is open.
BUCKETS = {
    "words": (0, 2, 5, 10, 20, 40),
    "symbols_per_word": (0.0, 0.02, 0.1, 0.3, 0.7),
    "repeats_per_word": (0.0, 0.05, 0.15, 0.4),
    "chars_per_word": (2.5, 3.5, 4.5, 6.0, 8.0, 11.0),
    "stops_per_word": (0.0, 0.05, 0.15, 0.4),
    "ends_in_stop": (0,),
    "seen_before": (0,),
}
OFFSETS = np.cumsum([0, *[len(b) + 1 for b in BUCKETS.values()]])


@dataclass
class Field:
    """Weights: per feature bucket and state, per pair of neighbouring states. State 1 is content."""

    emit: np.ndarray
    move: np.ndarray

    @property
    def trained(self) -> bool:
        return bool(self.emit.any() or self.move.any())

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.emit[features + OFFSETS[:-1]].sum(1)


@dataclass
class Measured:
    """Counts per document of a chunk, and bucket numbers per line."""

    counts: np.ndarray
    features: np.ndarray
    line_words: np.ndarray
    n_lines: np.ndarray


def repeated_words(words: Words, n_texts: int, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, the words inside windows that occur at least twice in it."""
    at = np.flatnonzero(words.text[: -window + 1] == words.text[window - 1 :]) if len(words.text) >= window else np.empty(0, np.int64)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    keys = window_hashes(words.hashes, window)[at] ^ mixed(words.text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    first, size = runs_of(keys[order])
    hit = at[order[np.repeat(size > 1, size)]]
    step = np.zeros(len(words.text) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + window, -1)
    return np.bincount(words.text[np.cumsum(step)[:-1] > 0], minlength=n_texts)


def measure(texts: list[bytes], table: WordHashes) -> Measured:
    """Counts word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words per text, and line features."""
    words = Words(texts, table)
    raw, n = words.raw, len(texts)
    lines_of, again, dup = [], [], []
    for t in texts:
        lines, seen, k = t.split(b"\n"), set(), 0
        for line in lines:
            old = line in seen
            again.append(old)
            if not old:
                seen.add(line)
            elif line.strip():
                k += 1
        lines_of.append(len(lines))
        dup.append(k)
    n_lines = np.array(lines_of, np.int64)
    total = int(n_lines.sum())
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, words.begin)
    per_line = lambda at, weights=None: np.bincount(at, weights, minlength=total)[:total]
    starts_char = np.cumsum(np.r_[0, (raw & 0xC0) != 0x80])
    chars = starts_char[words.end] - starts_char[words.begin]
    symbol = np.isin(raw, np.frombuffer(SYMBOLS, np.uint8))
    symbols_at = np.flatnonzero(symbol)
    stops_at = np.isin(raw[words.end - 1], np.frombuffer(STOPS, np.uint8)) if len(words.end) else np.empty(0, bool)
    line_words = per_line(line)
    base = np.maximum(line_words, 1)
    same = np.flatnonzero((words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1])) + 1
    last = np.zeros(total, bool)
    last[line] = stops_at
    values = {
        "words": line_words,
        "symbols_per_word": per_line(np.searchsorted(breaks, symbols_at)) / base,
        "repeats_per_word": per_line(line[same]) / base,
        "chars_per_word": per_line(line, chars) / base,
        "stops_per_word": per_line(line[stops_at]) / base,
        "ends_in_stop": last,
        "seen_before": np.array(again, np.int64),
    }
    features = np.stack([np.searchsorted(BUCKETS[k], v, side="left") for k, v in values.items()], 1).astype(np.int8)
    borders = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    per_text = lambda at, weights=None: np.bincount(at, weights, minlength=n)
    counts = np.stack(
        [
            per_text(words.text, chars).astype(np.int64),
            per_text(words.text),
            per_text(np.searchsorted(borders, symbols_at, side="right")),
            np.array(dup, np.int64),
            repeated_words(words, n),
        ]
    )
    return Measured(counts, features, line_words, n_lines)


def viterbi(field: Field, features: np.ndarray, n_lines: np.ndarray, gain: np.ndarray | None = None) -> np.ndarray:
    """Best state of every line; all sequences advance together, longest first. ``gain`` adds to the scores of states."""
    scores = field.scores(features.astype(np.int64))
    if gain is not None:
        scores = scores + gain
    begin = np.cumsum(n_lines) - n_lines
    order = np.argsort(-n_lines, kind="stable")
    begin, length = begin[order], n_lines[order]
    best = scores[begin].copy()
    back = np.zeros((len(scores), 2), np.int8)
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(length) else []
    for t in range(1, int(length[0]) if len(length) else 0):
        k = active[t]
        ways = best[:k, :, None] + field.move[None]
        back[begin[:k] + t] = ways.argmax(1)
        best[:k] = ways.max(1) + scores[begin[:k] + t]
    state = np.zeros(len(scores), np.int8)
    now = best.argmax(1)
    for t in range(int(length[0]) - 1 if len(length) else -1, -1, -1):
        k = active[t]
        state[begin[:k] + t] = now[:k]
        if t:
            now[:k] = back[begin[:k] + t, now[:k]]
    return state


def fit_field(features: np.ndarray, n_lines: np.ndarray, label: np.ndarray, steps: int = 120, rate: float = 0.2, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge, by adaptive gradient steps; ``label`` is the state of every line."""
    field = Field(np.zeros((OFFSETS[-1], 2)), np.zeros((2, 2)))
    if not len(label):
        return field
    at = features.astype(np.int64) + OFFSETS[:-1]
    begin = np.cumsum(n_lines) - n_lines
    order = np.argsort(-n_lines, kind="stable")
    begin, length = begin[order], n_lines[order]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    inner = np.ones(len(label), bool)
    inner[begin] = False
    at_inner = np.flatnonzero(inner)
    seen_emit = np.zeros_like(field.emit)
    for s in (0, 1):
        seen_emit[:, s] = np.bincount(at[label == s].ravel(), minlength=OFFSETS[-1])
    seen_move = np.zeros((2, 2))
    np.add.at(seen_move, (label[at_inner - 1], label[at_inner]), 1)
    squares = [np.full_like(field.emit, 1e-8), np.full_like(field.move, 1e-8)]
    top = int(length[0])
    for _ in range(steps):
        scores = field.emit[at].sum(1)
        forward = np.empty_like(scores)
        backward = np.zeros_like(scores)
        forward[begin] = scores[begin]
        for t in range(1, top):
            rows = begin[: active[t]] + t
            forward[rows] = scores[rows] + np.logaddexp.reduce(forward[rows - 1][:, :, None] + field.move, axis=1)
        for t in range(top - 2, -1, -1):
            rows = begin[: active[t + 1]] + t
            backward[rows] = np.logaddexp.reduce((scores[rows + 1] + backward[rows + 1])[:, None, :] + field.move, axis=2)
        whole = np.empty(len(label))
        whole[np.concatenate([np.arange(b, b + n) for b, n in zip(begin, length)])] = np.repeat(
            np.logaddexp.reduce(forward[begin + length - 1], axis=1), length
        )
        node = np.exp(forward + backward - whole[:, None])
        pair = forward[at_inner - 1][:, :, None] + field.move + (scores[at_inner] + backward[at_inner])[:, None, :]
        hoped_move = np.exp(pair - whole[at_inner][:, None, None]).sum(0)
        hoped_emit = np.stack([np.bincount(at.ravel(), np.repeat(node[:, s], at.shape[1]), minlength=OFFSETS[-1]) for s in (0, 1)], 1)
        for w, seen, hoped, sq in ((field.emit, seen_emit, hoped_emit, squares[0]), (field.move, seen_move, hoped_move, squares[1])):
            gradient = (seen - hoped) / len(label) - ridge * w
            sq += gradient**2
            w += rate * gradient / np.sqrt(sq)
    return field


def agreeing_states(
    field: Field, features: np.ndarray, n_lines: np.ndarray, line_words: np.ndarray, label: np.ndarray, min_share: float = MIN_SHARE
) -> np.ndarray:
    """Best states of the lines of documents with known labels: content holds at least ``min_share`` of the
    words in documents of label 1, and less in those of label 0.

    In a document that breaks this, lines in the state of its label gain more and more until it holds; where
    no gain helps (a document without words), all its lines take the label.
    """
    owner = np.repeat(np.arange(len(n_lines)), n_lines)
    words = np.maximum(np.bincount(owner, line_words, minlength=len(n_lines)), 1)
    state = label[owner].astype(np.int8)
    left = np.ones(len(n_lines), bool)
    for gain in GAINS:
        rows = left[owner]
        if not rows.any():
            break
        extra = gain * np.eye(2)[label[owner[rows]]]
        found = viterbi(field, features[rows], n_lines[left], extra)
        share = np.bincount(owner[rows], found * line_words[rows], minlength=len(n_lines)) / words
        agrees = left & ((share >= min_share) == (label == 1))
        take = agrees[owner]
        state[take] = found[agrees[owner[rows]]]
        left &= ~agrees
    return state


def fit_documents(features: np.ndarray, n_lines: np.ndarray, line_words: np.ndarray, label: np.ndarray, rounds: int = LABEL_ROUNDS) -> Field:
    """A field learned from labels of documents: lines by themselves first, then chains of agreeing states."""
    state = np.repeat(label, n_lines)
    field = fit_field(features, np.ones(len(state), np.int64), state)
    for _ in range(rounds if len(state) else 0):
        state = agreeing_states(field, features, n_lines, line_words, label).astype(np.int64)
        field = fit_field(features, n_lines, state)
    return field


def _judged(field: Field, texts: list[bytes], table: WordHashes, min_share: float):
    """Measures, line states, content share, base verdict and verdict of some texts."""
    m = measure(texts, table)
    # An untrained field knows no boilerplate; then the base rules alone decide.
    state = viterbi(field, m.features, m.n_lines) if field.trained else np.ones(len(m.features), np.int8)
    n, repeat = m.counts[1], m.counts[4]
    owner = np.repeat(np.arange(len(texts)), m.n_lines)
    share = np.bincount(owner, state * m.line_words, minlength=len(texts)) / np.maximum(n, 1)
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    return m, state, owner, share, failed, ~failed & (share >= min_share)


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        raw, offsets = byte_slices(batch.column(column))
        start = 0
        for i in range(batch.num_rows):
            if offsets[i + 1] - offsets[start] >= CHUNK_BYTES or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start), [raw[offsets[j] : offsets[j + 1]].tobytes() for j in range(start, i + 1)]
                start = i + 1


def train_field(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality", sample: int = SAMPLE) -> Field:
    """Fit on at most ``sample`` labelled texts of ``docs``, those with the smallest hash of the key.

    Null keys, texts and labels are left out, and a text repeated under its key counts once. Without
    labelled rows of both classes all weights are 0.
    """
    known = labels.where(F.col(quality).isNotNull() & F.col(key).isNotNull())
    known = known.select(F.col(key).alias("k"), (F.col(quality) > 0).cast("int").alias("q")).distinct()
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").withColumn("s", F.xxhash64("t"))
    # Joined before the sample is drawn, so that ids that docs lacks take no place in it.
    picked = texts.select("k", "s").join(known, "k").distinct().orderBy(F.xxhash64("k"), "k", "q", "s").limit(sample)
    joined = texts.join(F.broadcast(picked), ["k", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        for part, texts in _chunks(batches, 1):
            m = measure(texts, table)
            end = np.cumsum(m.n_lines)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    part.column(3),
                    pa.array([m.features[e - n : e].tobytes() for e, n in zip(end, m.n_lines)], pa.binary()),
                    pa.array([m.line_words[e - n : e].astype("<i4").tobytes() for e, n in zip(end, m.n_lines)], pa.binary()),
                ],
                names=["k", "q", "s", "f", "w"],
            )

    measured = joined.select("k", "t", "q", "s").mapInArrow(run, "k bigint, q int, s bigint, f binary, w binary")
    rows = measured.groupBy("k", "q", "s").agg(F.min(F.struct("f", "w")).alias("m")).select("k", "q", "m.*").collect()
    if len({r["q"] for r in rows}) < 2:
        rows = []
    rows.sort(key=lambda r: (r["k"], r["q"], bytes(r["f"])))
    parts = [np.frombuffer(bytes(r["f"]), np.int8).reshape(-1, len(BUCKETS)) for r in rows]
    n_lines = np.array([len(p) for p in parts], np.int64)
    features = np.concatenate(parts) if parts else np.empty((0, len(BUCKETS)), np.int8)
    line_words = np.concatenate([np.frombuffer(bytes(r["w"]), "<i4") for r in rows]) if rows else np.empty(0, np.int32)
    return fit_documents(features, n_lines, line_words, np.array([r["q"] for r in rows], np.int64))


def label_lines(
    docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text", min_share: float = MIN_SHARE
) -> DataFrame:
    """Base counts, content share and verdict per document.

    Columns: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_content_lines, content_share (by words; 0 without words), states (one byte per line,
    1 for content), kept. Null and empty texts have no words and fail the base rules. Null keys,
    ties and repeated rows are kept as they come; other columns are not read; texts are handled
    whole; an empty table gives no rows. Nothing is shuffled.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        for part, texts in _chunks(batches, 1):
            m, state, owner, share, failed, kept = _judged(field, texts, table, min_share)
            chars, n, symbols, dup, repeat = m.counts
            end = np.cumsum(m.n_lines)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *[pa.array(c.astype(np.int64)) for c in (n, chars, symbols, dup, repeat)],
                    pa.array(failed),
                    pa.array(m.n_lines),
                    pa.array(np.bincount(owner, state, minlength=len(texts)).astype(np.int64)),
                    pa.array(share),
                    pa.array([state[e - k : e].tobytes() for e, k in zip(end, m.n_lines)], pa.binary()),
                    pa.array(kept),
                ],
                names=["k", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "n_lines", "n_content_lines", "content_share", "states", "kept"],
            )

    schema = (
        f"k {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, n_lines bigint, n_content_lines bigint, content_share double, states binary, kept boolean"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def keep_good(docs: DataFrame, field: Field, text: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; see :func:`label_lines`."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        for part, texts in _chunks(batches, at):
            yield part.filter(pa.array(_judged(field, texts, table, min_share)[-1]))

    return docs.mapInArrow(run, docs.schema)
