"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's evidence is a few ratios of its characters and words
and those of its two neighbours; neighbouring labels are tied by a transition weight. A document's
score is the mean of its lines' forward-backward probabilities of "good", weighted by their length.

Labels are known per document, so in training each line carries its document's label. The weights
are fitted on at most TRAIN_DOCUMENTS labelled documents (those with the smallest hash of their id,
outside of the held-out third), of each at most TRAIN_LINES lines (longer texts: even stretches of
STRETCH lines over the whole text); only these lines' features reach the driver. Features come from
the text alone. Scoring is one pass without a shuffle over all rows, in slices of CHUNK_CHARS.

Null and empty texts are one empty line. Without usable labels of both kinds every score is 0.5 and
so 1 is predicted. Repeated rows are scored each; for fitting, a document labelled twice counts once,
with its smallest label, and an id with several texts by its smallest one; other columns are not read.
Texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.llm.common import table

#: Bound of the sample of labelled documents that the weights are fitted on.
TRAIN_DOCUMENTS = 3_000
#: Bound of the lines of one document in that sample, and the lines that stay together in longer ones.
TRAIN_LINES, STRETCH = 2_000, 100
ROUNDS, RATE, DECAY = 150, 0.05, 1e-3
CHUNK_CHARS = 250_000
SYMBOLS = "#*$%&|<>"
_KIND = np.zeros(128, dtype=np.uint8)
for _c in " \t\n\v\f\r":
    _KIND[ord(_c)] = 1
for _c in SYMBOLS:
    _KIND[ord(_c)] = 2
for _c in "!?.,;:-'\"()[]{}/\\_=+~^@`":
    _KIND[ord(_c)] = 3
for _c in "0123456789":
    _KIND[ord(_c)] = 4
for _c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _KIND[ord(_c)] = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_hashes(chars: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A polynomial of each word's characters, from running sums over blocks of words."""
    hashes, done = np.empty(len(begins), dtype=np.uint64), 0
    power = back = np.empty(0, dtype=np.uint64)
    while done < len(begins):
        low = begins[done]
        upto = max(done + 1, int(np.searchsorted(stops, low + CHUNK_CHARS, side="right")))
        size = stops[upto - 1] - low
        if size > len(power):
            power, back = (np.cumprod(np.full(size, b, dtype=np.uint64)) for b in (_BASE, _INVERSE))
        running = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(chars[low : low + size] * power[:size], out=running[1:])
        b, e = begins[done:upto] - low, stops[done:upto] - low
        hashes[done:upto] = (running[e] - running[b]) * back[b]
        done = upto
    return hashes ^ (hashes >> np.uint64(31))


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, characters, first line of each text and the end) of all lines of some texts."""
    joined = "\n".join(texts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4") if joined else np.empty(0, dtype="<u4")
    breaks = np.flatnonzero(chars == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(chars)]])
    counts = np.array([t.count("\n") + 1 for t in texts])
    first = np.concatenate([[0], np.cumsum(counts)])
    document = np.repeat(np.arange(len(texts)), counts)
    kind = np.where(chars < 128, _KIND[np.minimum(chars, 127)], 0)

    def per_line(mask):
        total = np.zeros(len(mask) + 1, dtype=np.int32)
        np.cumsum(mask, dtype=np.int32, out=total[1:])
        return (total[ends] - total[starts]).astype(np.float64)

    filled = per_line(kind != 1)
    shares = [per_line(kind == k) / np.maximum(1, filled) for k in (2, 3, 4, 5)]
    exclaimed = per_line(chars == 33) / np.maximum(1, filled)
    word = np.concatenate([[False], kind != 1, [False]])
    begins, stops = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(~word[1:] & word[:-1])
    line_of = np.searchsorted(ends, begins)
    n_words = np.bincount(line_of, minlength=len(ends)).astype(np.float64)
    hashes = word_hashes(chars, begins, stops)
    # windows of three words found twice in their document
    repeated = np.zeros(len(ends))
    if len(hashes) > 2:
        in_doc = document[line_of]
        at = np.flatnonzero(in_doc[:-2] == in_doc[2:])
        window = (hashes[at] * _BASE + hashes[at + 1]) * _BASE + hashes[at + 2]
        window = (window ^ (window >> np.uint64(29))) * _INVERSE + in_doc[at].astype(np.uint64) * _BASE
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(hashes) - 2, dtype=bool)
        twice[at[order[1:][same]]] = True
        twice[at[order[:-1][same]]] = True
        covered = np.zeros(len(hashes), dtype=bool)
        for k in range(3):
            covered[k : k + len(twice)] |= twice
        repeated = np.bincount(line_of, weights=covered, minlength=len(ends)) / np.maximum(1, n_words)
    mean = np.minimum(filled / np.maximum(1, n_words), 40) / 10
    own = np.stack([*shares, exclaimed, repeated, mean, np.log1p(n_words) / 5], axis=1)
    # the neighbours' evidence, zero outside of the document
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = document[1:] == document[:-1]
    before[1:][inner], after[:-1][inner] = own[:-1][inner], own[1:][inner]
    around = (before + after)[:, :6] / 2
    # every text stands between line breaks, so lines of two texts never meet
    return np.concatenate([np.ones((len(own), 1)), own, around], axis=1), np.maximum(1, filled), first


def marginals(unary: np.ndarray, step: np.ndarray, first: np.ndarray, heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: P(good) per line, expected transitions (2 x 2), log Z per chain.

    unary: score of "good" per line ("bad" has 0); step: transition weights; heavy: weight of each
    chain in the expected transitions.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    heavy = np.ones(len(length)) if heavy is None else heavy[order]
    emit = np.stack([np.ones_like(unary), np.exp(np.clip(unary, -30, 30))], axis=1)
    move = np.exp(step)
    alpha, scale = np.zeros((len(unary), 2)), np.ones(len(unary))
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length[0]) if len(length) else 0)]
    for t, n in enumerate(active):
        at = start[:n] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at, None]
    beta, both = np.ones((len(unary), 2)), np.zeros((2, 2))
    for t in range(len(active) - 2, -1, -1):
        at = start[: active[t + 1]] + t
        ahead = emit[at + 1] * beta[at + 1] / scale[at + 1, None]
        both += move * ((alpha[at] * heavy[: len(at), None]).T @ ahead)
        beta[at] = ahead @ move.T
    good = alpha * beta
    return good[:, 1] / good.sum(axis=1), both, np.add.reduceat(np.log(scale), first[:-1])


def fit(features: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of largest penalised likelihood.

    Features are brought to one scale while fitting. Lines of the rarer kind weigh more: together
    the kinds weigh as the square roots of their numbers of lines.
    """
    middle, spread = features.mean(axis=0), features.std(axis=0)
    middle[0], spread[spread < 1e-9] = 0.0, 1.0
    x = (features - middle) / spread
    length = np.diff(first)
    lines = np.repeat(label, length).astype(np.float64)
    of = np.sqrt([max(1, length[label == k].sum()) for k in (0, 1)])
    heavy = 1 / of[label] / of.sum()
    weights, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(step), np.zeros_like(step)]]
    same = np.diag([(heavy * np.maximum(0, length - 1))[label == k].sum() for k in (0, 1)])
    for k in range(1, rounds + 1):
        good, both, _ = marginals(x @ weights, step, first, heavy)
        grads = [x.T @ ((lines - good) * np.repeat(heavy, length)) - DECAY * weights, same - both - DECAY * step]
        for value, (m, v), g in zip((weights, step), moments, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value += RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    weights = weights / spread
    weights[0] -= weights[1:] @ middle[1:]
    return weights, step


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def stretches(features: np.ndarray) -> list[np.ndarray]:
    """The lines of one document for fitting: all of them, or even stretches where they are too many."""
    if len(features) <= TRAIN_LINES:
        return [features]
    starts = np.linspace(0, len(features) - STRETCH, TRAIN_LINES // STRETCH).astype(int)
    return [features[at : at + STRETCH] for at in starts]


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = TRAIN_DOCUMENTS):
    """(weights, transitions), or None where the labels are of one kind only."""
    known = labels.filter(F.col(label_col).isin(0, 1)).filter(F.crc32(F.col(id_col).cast("string")) % 3 != 1)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    picked = known.orderBy(F.xxhash64("id"), "id").limit(most)  # the documented bound, also of this broadcast
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(picked), "id")
    texts = texts.groupBy("id", "label").agg(F.min("text").alias("text"))

    def work(batches):
        for batch in batches:
            for k, label in enumerate(batch.column(1).to_pylist()):
                features = stretches(line_features([batch.column(0)[k].as_py() or ""])[0])
                for part in features:
                    yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([part.astype("<f8").tobytes()], pa.binary())], ["label", "features"])

    rows = texts.select("text", F.col("label").cast("int"), "id").mapInArrow(work, "label int, features binary").collect()
    if len({r["label"] for r in rows}) < 2:
        return None
    width = len(line_features([""])[0][0])
    parts = sorted((r["label"], bytes(r["features"])) for r in rows)  # any order of arrival gives the same weights
    features = [np.frombuffer(p, dtype="<f8").reshape(-1, width) for _, p in parts]
    first = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    return fit(np.concatenate(features), first, np.array([l for l, _ in parts]))


def score(documents: DataFrame, model, text_col: str = "text") -> DataFrame:
    """(row: struct of the input's columns, score, n_lines, n_bad_lines) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def chunks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(1) if batch.num_columns > 1 else batch.column(0).field(at)
            size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64) + 1)
            start = 0
            while start < len(size):
                before = size[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(size, before + CHUNK_CHARS, side="right")))
                yield batch.slice(start, end - start), [x or "" for x in column.slice(start, end - start).to_pylist()]
                start = end

    def work(batches):
        for own, texts in chunks(batches):
            if shared.value is None:
                n = np.array([t.count("\n") + 1 for t in texts])
                result, bad = np.full(len(texts), 0.5), np.zeros(len(texts), dtype=np.int64)
            else:
                weights, step = shared.value
                features, size, first = line_features(texts)
                good, _, _ = marginals(features @ weights, step, first)
                result = np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])
                n, bad = np.diff(first), np.add.reduceat((good < 0.5).astype(np.int64), first[:-1])
            arrays = [pa.array(np.clip(result, 0, 1), pa.float64()), pa.array(n, pa.int64()), pa.array(bad, pa.int64())]
            yield pa.RecordBatch.from_arrays([own.column(0), *arrays], ["row", "score", "n_lines", "n_bad_lines"])

    # a text goes to the worker once, inside its row, unless it has to be made a string
    at = documents.columns.index(text_col)
    is_text = isinstance(documents.schema[at].dataType, T.StringType)
    rows = documents.select(F.struct("*").alias("row"), *([] if is_text else [F.col(text_col).cast("string").alias("text")]))
    kinds = T.StructType([rows.schema["row"], *(T.StructField(n, t()) for n, t in (("score", T.DoubleType), ("n_lines", T.LongType), ("n_bad_lines", T.LongType)))])
    return rows.mapInArrow(work, kinds)


def op5_quality_crf(spark, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines", "n_bad_lines")
