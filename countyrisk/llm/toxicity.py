"""Toxicity: a linear-chain conditional random field tags toxic spans.

Tokens are words with A-Z lower-cased and marks at both ends left off. The labels are of whole
texts, so the labelled tokens are made from them first: a word, or the first four to eight bytes
of one, that stands in toxic texts far more often than in others marks its tokens as toxic. The
field learns emission weights of hashed features (the word, its beginnings and end, its
neighbours) and the four transitions from windows of these tokens, by gradient of the
likelihood. Scoring runs forward and backward over every whole text; the marginals give the
spans (runs of tokens at 0.5 or more) and, through a logistic fit on the sampled texts, the
score of the text.

The two states make a message one number, the ratio of the states. Long texts are cut into
chunks whose 2 x 2 products are chained first, so that all chunks of a block are run at once
and the marginals are those of the whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import held_out, labelled_texts
from .text import Powers, byte_blocks, byte_table, mixed, prefix_hashes, span_hashes, word_spans

PER_CLASS = 1_500
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)
WINDOW = 32
MAX_WINDOWS = 12_000
EPOCHS = 8
UNSURE = 0.05
BATCH = 256
RATE = 0.1
CHUNK = 64
LEAST_TEXTS, LEAST_ODDS = 4, 20.0
THRESHOLD = 0.3
MARKS = b".,;:!?\"'()[]*-"


class Field(NamedTuple):
    weights: np.ndarray  # difference of the two states' emissions, per feature
    trans: np.ndarray  # log transitions, from and to
    scale: np.ndarray  # of the logistic fit: constant, log of the sum, maximum, log of the share
    empty: bool


class Tokens(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    features: np.ndarray  # tokens x features
    heads: np.ndarray  # hashes of the word and its beginnings, for making labels


def tokenise(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, tables: Powers) -> Tokens:
    starts, ends, rows = word_spans(data, offsets)
    mark = np.zeros(256, bool)
    mark[list(MARKS)] = True
    for _ in range(3):
        ends = np.where((ends - starts > 1) & mark[data[ends - 1]], ends - 1, ends) if len(ends) else ends
        starts = np.where((ends - starts > 1) & mark[data[starts]], starts + 1, starts) if len(starts) else starts
    prefix = prefix_hashes(data, table, tables)
    part = lambda a, b: span_hashes(prefix, a, b, tables)
    word = part(starts, ends)
    beginnings = [part(starts, np.minimum(ends, starts + size)) for size in BEGINNINGS]
    tail = part(np.maximum(starts, ends - 3), ends)
    before, after = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
    if len(word) > 1:
        joined = rows[1:] == rows[:-1]
        before[1:] = np.where(joined, word[:-1], 0)
        after[:-1] = np.where(joined, word[1:], 0)
    kinds = [word, *beginnings, tail, before, after]
    features = np.stack([(mixed(h + np.uint64(k * 0x51ED27)) >> np.uint64(64 - 18)).astype(np.int32) for k, h in enumerate(kinds)], 1)
    # a beginning counts only where the word goes on after it
    longer = ends - starts
    heads = [np.where(longer > size, mixed(head + np.uint64(size)), word) for size, head in zip(BEGINNINGS, beginnings, strict=True)]
    heads = np.stack([word, *heads], 1)
    return Tokens(starts, ends, rows, features, heads)


def runs(odds: np.ndarray, rows: np.ndarray, trans: np.ndarray, count: int) -> np.ndarray:
    """Marginal probability of the toxic state at every token."""
    n = len(odds)
    if not n:
        return np.zeros(0)
    a = np.exp(trans)
    lengths = np.bincount(rows, minlength=count)
    chunks = -(-lengths // CHUNK)
    first_chunk = np.concatenate([[0], np.cumsum(chunks)])
    first_token = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    within = np.arange(n) - first_token[rows]
    place = (first_chunk[rows] + within // CHUNK) * CHUNK + within % CHUNK
    total = int(first_chunk[-1])
    emit = np.ones((total, CHUNK))
    used = np.zeros((total, CHUNK), bool)
    emit.ravel()[place] = np.exp(np.clip(odds, -30, 30))
    used.ravel()[place] = True
    owner = np.repeat(np.arange(count), chunks)
    number = np.arange(total) - first_chunk[owner]

    def chained(order: range, step: np.ndarray, forward: bool) -> np.ndarray:
        """Message into each chunk, from the products of the chunks on its way."""
        m = np.zeros((total, 2, 2))
        m[:, 0, 0] = m[:, 1, 1] = 1
        for t in order:
            one = np.empty((total, 2, 2))
            if forward:  # new[j] = sum_i old[i] a[i, j] e[j]
                one[:] = a.T
                one[:, 1, :] *= step[:, t, None]
            else:  # new[i] = sum_j a[i, j] e[j] old[j]
                one[:] = a
                one[:, :, 1] *= step[:, t, None]
            live = used[:, t]
            moved = np.einsum("nij,njk->nik", one[live], m[live])
            m[live] = moved / moved.max(axis=(1, 2), keepdims=True)
        message = np.ones(total)
        state = np.ones(count)  # the ratio before the first token: both states alike
        steps = range(int(chunks.max(initial=0)))
        for k in steps:
            at = first_chunk[:-1] + (k if forward else 0) if forward else first_chunk[1:] - 1 - k
            live = np.flatnonzero(chunks > k)
            spots = at[live]
            message[spots] = state[live]
            top = m[spots, 1, 0] + m[spots, 1, 1] * state[live]
            state[live] = top / (m[spots, 0, 0] + m[spots, 0, 1] * state[live])
        return message

    ahead, back = chained(range(CHUNK), emit, True), chained(range(CHUNK - 1, -1, -1), emit, False)
    forward, backward = np.zeros((total, CHUNK)), np.zeros((total, CHUNK))
    state = ahead
    for t in range(CHUNK):
        # the first token of a text has no transition into it
        start = (number == 0) & (t == 0)
        moved = emit[:, t] * np.where(start, 1.0, (a[0, 1] + state * a[1, 1]) / (a[0, 0] + state * a[1, 0]))
        state = np.where(used[:, t], np.clip(moved, 1e-250, 1e250), state)
        forward[:, t] = state
    state = back
    for t in range(CHUNK - 1, -1, -1):
        backward[:, t] = state
        weight = emit[:, t] * state
        moved = (a[1, 0] + a[1, 1] * weight) / (a[0, 0] + a[0, 1] * weight)
        state = np.where(used[:, t], moved, state)
    both = forward.ravel()[place] * backward.ravel()[place]
    return both / (1 + both)


def emissions(weights: np.ndarray, tokens: Tokens) -> np.ndarray:
    out = np.zeros(len(tokens.features), np.float64)
    for k in range(tokens.features.shape[1]):
        out += weights[tokens.features[:, k]]
    return out + weights[-1]


def marked_heads(parts: list[tuple[Tokens, np.ndarray]]) -> np.ndarray:
    """Hashes of words and beginnings that mark toxic tokens. ``parts``: tokens and labels of their rows."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    sizes = [0, 0]
    for tokens, labels in parts:
        for label in (0, 1):
            sizes[label] += int((labels == label).sum())
        for k in range(tokens.heads.shape[1]):
            if not len(tokens.rows):
                continue
            pairs = np.unique(np.stack([tokens.rows.astype(np.uint64), tokens.heads[:, k], np.full(len(tokens.rows), k, np.uint64)], 1), axis=0)
            for label in (0, 1):
                seen[label].update(map(tuple, pairs[labels[pairs[:, 0].astype(np.int64)] == label][:, 1:].tolist()))
    found = []
    for key, n in seen[1].items():
        odds = ((n + 0.5) / (sizes[1] + 1)) / ((seen[0][key] + 0.5) / (sizes[0] + 1))
        if n >= LEAST_TEXTS and odds >= LEAST_ODDS:
            found.append(key[0])
    return np.unique(np.array(found, np.uint64))


def fit_field(examples: list[tuple[str, int]], seed: int = 3, max_windows: int = MAX_WINDOWS) -> Field:
    """The field of (text, 0 or 1) pairs; without both classes every score is 0.

    The texts are cut into windows of ``WINDOW`` tokens, their ends too. Of the windows with and of
    those without a marked token at most half of ``max_windows`` each are learned from, and as many
    unsure ones in the second half of the epochs, all picked at random."""
    labels = np.array([y for _, y in examples], np.int64)
    none = Field(np.zeros(BUCKETS + 1, np.float32), np.zeros((2, 2)), np.zeros(4), True)
    if not len(labels) or labels.min() == labels.max():
        return none
    table, tables = byte_table(lower=True), Powers()
    parts = []
    for at, offsets, data in byte_blocks(pa.array([t for t, _ in examples], pa.string())):
        parts.append((tokenise(data, offsets, table, tables), labels[at : at + len(offsets) - 1]))
    marks = marked_heads(parts)
    windows: tuple[list, list] = ([], [])  # without and with a marked token
    for tokens, own in parts:
        toxic = np.isin(tokens.heads, marks).any(1) & (own[tokens.rows] == 1)
        edges = np.searchsorted(tokens.rows, np.arange(len(own) + 1))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            for at in range(low, high, WINDOW):
                end = min(at + WINDOW, high)
                windows[int(toxic[at:end].any())].append((tokens.features[at:end], toxic[at:end]))
    random = np.random.default_rng(seed)
    chosen = []
    for kind in windows:
        pick = random.permutation(len(kind))[: max_windows // 2]
        chosen += [kind[i] for i in pick]
    weights, trans = np.zeros(BUCKETS + 1), np.zeros((2, 2))
    squares, trans_squares = np.full(BUCKETS + 1, 1e-2), np.full((2, 2), 1e-2)
    for epoch in range(EPOCHS):
        if epoch == EPOCHS // 2:
            # the second half also sees the clean windows that the field is still unsure of
            odds = np.concatenate([weights[f].sum(1) + weights[-1] for f, _ in windows[0]])
            rows = np.repeat(np.arange(len(windows[0])), [len(y) for _, y in windows[0]])
            unsure = np.unique(rows[runs(odds, rows, trans, len(windows[0])) >= UNSURE])
            chosen += [windows[0][i] for i in random.permutation(unsure)[: max_windows // 2]]
        for pick in np.array_split(random.permutation(len(chosen)), max(1, len(chosen) // BATCH)):
            rows = np.concatenate([np.full(len(chosen[i][1]), k) for k, i in enumerate(pick)])
            features = np.concatenate([chosen[i][0] for i in pick])
            truth = np.concatenate([chosen[i][1] for i in pick]).astype(np.float64)
            odds = weights[features].sum(1) + weights[-1]
            marginal = runs(odds, rows, trans, len(pick))
            wrong = marginal - truth
            pull = np.bincount(features.ravel(), np.repeat(wrong, features.shape[1]), BUCKETS + 1) / len(pick)
            pull[-1] = wrong.sum() / len(pick)
            pull += 1e-4 * weights
            # expected transitions from the marginals of neighbours, less the seen ones
            joined = rows[1:] == rows[:-1]
            p, q = marginal[:-1][joined], marginal[1:][joined]
            y, z = truth[:-1][joined], truth[1:][joined]
            turn = np.array([[((1 - p) * (1 - q) - (1 - y) * (1 - z)).sum(), ((1 - p) * q - (1 - y) * z).sum()], [(p * (1 - q) - y * (1 - z)).sum(), (p * q - y * z).sum()]]) / len(pick)
            squares += pull**2
            trans_squares += turn**2
            weights -= RATE * pull / np.sqrt(squares)
            trans -= RATE * turn / np.sqrt(trans_squares)
    field = Field(weights.astype(np.float32), np.clip(trans, -8, 8), np.zeros(4), False)
    gathered = np.concatenate([text_summary(field, tokens, len(own)) for tokens, own in parts])
    scale = np.zeros(4)
    for _ in range(400):
        wrong = 1 / (1 + np.exp(-np.clip(gathered @ scale, -35, 35))) - labels
        curve = gathered.T @ (gathered * 0.25) / len(labels) + 1e-3 * np.eye(4)
        scale -= np.linalg.solve(curve, gathered.T @ wrong / len(labels) + 1e-3 * scale)
    return field._replace(scale=scale)


def text_summary(field: Field, tokens: Tokens, count: int, marginals: np.ndarray | None = None) -> np.ndarray:
    """Constant, and of the fourth powers of the marginals of every row the log of the sum, the maximum, the log of the mean."""
    if marginals is None:
        marginals = runs(emissions(field.weights, tokens), tokens.rows, field.trans, count)
    marginals = marginals**4  # many unsure tokens of a long text shouldn't add up to a sure one
    most = np.zeros(count)
    np.maximum.at(most, tokens.rows, marginals)
    total = np.bincount(tokens.rows, marginals, count) if len(marginals) else np.zeros(count)
    n = np.maximum(np.bincount(tokens.rows, minlength=count), 1)
    return np.stack([np.ones(count), np.log(total + 0.01), most, np.log((total + 0.01) / n)], 1)


def tag_texts(field: Field, column: pa.Array, table: np.ndarray, tables: Powers) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score and toxic spans (byte offsets) of every text."""
    scores, spans = [], []
    for _, offsets, data in byte_blocks(column):
        rows = len(offsets) - 1
        tokens = tokenise(data, offsets, table, tables)
        marginals = runs(emissions(field.weights, tokens), tokens.rows, field.trans, rows)
        scores.append(1 / (1 + np.exp(-np.clip(text_summary(field, tokens, rows, marginals) @ field.scale, -35, 35))))
        own: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
        last = -2
        for k in np.flatnonzero(marginals >= 0.5):
            row = int(tokens.rows[k])
            start, end = int(tokens.starts[k] - offsets[row]), int(tokens.ends[k] - offsets[row])
            if k == last + 1 and own[row]:
                own[row][-1] = (own[row][-1][0], end)
            else:
                own[row].append((start, end))
            last = k
        spans += own
    out = np.concatenate(scores) if scores else np.zeros(0)
    return (np.zeros(len(out)), [[] for _ in spans]) if field.empty else (out, spans)


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every row of ``docs``.

    ``spans`` has the (start, end) of toxic runs as offsets into the UTF-8 bytes of the text,
    end exclusive. Null texts are scored as empty ones; rows without a label are scored all the
    same; a null id isn't held out; repeated rows are scored each; other columns are left out;
    an empty table gives no rows; without labels of both classes every score is 0. ``max_windows``
    bounds what the fit learns from (see :func:`fit_field`); scoring reads whole texts."""
    field = docs.sparkSession.sparkContext.broadcast(fit_field(labelled_texts(docs, labels, "toxic", per_class), max_windows=max_windows))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = byte_table(lower=True), Powers()
        for batch in batches:
            scores, spans = tag_texts(field.value, batch.column(2), table, tables)
            tagged = pa.array([[{"start": a, "end": b} for a, b in own] for own in spans], kind)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), predicted, tagged], names=["doc_id", "held_out", "score", "predicted", "spans"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:long,end:long>>")
