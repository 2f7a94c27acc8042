"""Severity of toxic language by cumulative-link ordinal regression.

Features are the words of a text and their beginnings of four to six bytes, hashed; a feature is present or
not. Those that tell toxic from clean documents in the labelled sample are kept. One weight vector is shared
by all grades, and ordered thresholds separate them: P(grade > k) = logistic(w x - theta_k). The labels
only say toxic or not, so toxic documents of the sample are graded by how many marker words they hold (low,
middle and high third). The result is the expected grade, from 0 to 3, and whether P(grade > 0) is over half.

The model is fitted on the driver from a bounded sample of labelled documents (`most_toxic`, `most_clean`,
taken by a hash of the id). Everything else is computed in the tasks, on whole texts.

Null and empty texts have no features. Labels without document, or null, are not used; of several labels of
a document the highest counts. Without toxic labels nothing is toxic and every severity is 0. Repeated rows
are scored alike. Other columns pass through; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.flat import flat_text, give_back, slices, span_hash

GRADES = 4
PREFIXES = (4, 5, 6)
RESULTS = ("severity", "grade", "is_toxic")

# Letters, digits and all bytes beyond ASCII make up words.
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # hashes, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades; empty if there was nothing to learn from

    def severity(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected grade, most probable grade, and whether toxic is more probable than not."""
        n = len(texts)
        if not len(self.thresholds):
            return np.zeros(n), np.zeros(n, np.int32), np.zeros(n, bool)
        doc, feature = present(texts, self.features)
        score = np.bincount(doc, self.weights[feature], minlength=n)
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))
        share = -np.diff(np.c_[np.ones(n), above, np.zeros(n)], axis=1)
        return above.sum(axis=1), share.argmax(axis=1).astype(np.int32), above[:, 0] > 0.5


def _hashed(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document and hash of every word, then of every beginning of each length."""
    data, offsets = flat_text(pc.utf8_lower(pc.fill_null(texts, "")))
    inside = np.r_[False, _WORD[data], False]
    if len(data):
        # A text's first byte never continues a word of the text before it.
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        starts = np.union1d(starts, edges[_WORD[data[edges]]])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        ends = np.union1d(ends, edges[_WORD[data[edges - 1]]])
        doc = np.searchsorted(offsets, starts, side="right") - 1
        yield doc, span_hash(data, starts, ends)
        for n in PREFIXES:
            longer = ends - starts > n
            begin = starts[longer]
            yield doc[longer], span_hash(data, begin, begin + n) ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))


def present(texts: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which documents hold which of the given features (indices of both, each pair once)."""
    pairs = [np.zeros(0, np.int64)]
    for doc, code in _hashed(texts):
        at = np.minimum(np.searchsorted(features, code), len(features) - 1) if len(features) else np.zeros(0, np.int64)
        hit = features[at] == code if len(features) else np.zeros(0, bool)
        pairs.append(doc[hit] * len(features) + at[hit])
    both = np.unique(np.concatenate(pairs))
    return both // max(len(features), 1), both % max(len(features), 1)


def all_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every distinct feature."""
    docs, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for doc, code in _hashed(texts):
        docs.append(doc)
        codes.append(code)
    doc, code = np.concatenate(docs), np.concatenate(codes)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    first = np.r_[True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])] if len(doc) else np.zeros(0, bool)
    return doc[first], code[first]


def labelled_sample(docs: DataFrame, labels: DataFrame, most_toxic: int = 3000, most_clean: int = 5000) -> tuple[np.ndarray, list[np.ndarray]]:
    """Label and feature hashes of a bounded number of labelled documents, each text once."""
    by_id = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    order = F.xxhash64("doc_id")
    toxic = by_id.where("toxic").orderBy(order, "doc_id").limit(most_toxic)
    clean = by_id.where("NOT toxic").orderBy(order, "doc_id").limit(most_clean)
    # At most `most_toxic` + `most_clean` ids.
    chosen = docs.select("doc_id", "text").join(F.broadcast(toxic.unionAll(clean)), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            doc, code = all_features(batch.column("text"))
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            hashes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code.view(np.int64)))
            same = pa.array(span_hash_of(batch.column("text")).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), same, hashes], names=["toxic", "same", "hashes"])
            del doc, code, ends, hashes, same
        give_back()

    rows = chosen.mapInArrow(run, "toxic boolean, same long, hashes array<long>").toArrow()
    flags, same = rows["toxic"].to_numpy(), rows["same"].to_numpy()
    # Copies would make any word of theirs look telling. The order of rows must not matter either.
    _, first = np.unique(np.stack([same, flags.astype(np.int64)], axis=1), axis=0, return_index=True)
    lists = rows["hashes"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
    return flags[first].astype(bool), [values[offsets[i] : offsets[i + 1]] for i in first]


def span_hash_of(texts: pa.Array) -> np.ndarray:
    """One hash per text."""
    data, offsets = flat_text(texts)
    found = np.zeros(len(offsets) - 1, np.uint64)
    full = np.diff(offsets) > 0
    found[full] = span_hash(data, offsets[:-1][full], offsets[1:][full])
    return found


def fit(toxic: np.ndarray, hashes: list[np.ndarray], most_features: int = 4096, least_docs: int = 5, rounds: int = 1200) -> Model:
    """Select features, grade the toxic documents and fit weights and thresholds."""
    if not toxic.any() or toxic.all():
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    doc = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    codes, feature = np.unique(np.concatenate(hashes), return_inverse=True)
    bad = np.bincount(feature, toxic[doc].astype(float), minlength=len(codes))
    good = np.bincount(feature, minlength=len(codes)) - bad
    n_bad, n_good = toxic.sum(), (~toxic).sum()
    odds = np.log((bad + 0.5) / (n_bad - bad + 0.5)) - np.log((good + 0.5) / (n_good - good + 0.5))
    certain = odds / np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5) + 1 / (n_bad - bad + 0.5) + 1 / (n_good - good + 0.5))
    usable = np.flatnonzero(bad + good >= least_docs)
    kept = np.sort(usable[np.argsort(-np.abs(certain[usable]), kind="stable")[:most_features]])
    kept = kept[np.abs(certain[kept]) > 3]
    column = np.full(len(codes), -1)
    column[kept] = np.arange(len(kept))
    used = column[feature] >= 0
    row, col = doc[used], column[feature[used]]
    markers = np.bincount(row[certain[kept][col] > 5], minlength=len(hashes))
    low, high = np.quantile(markers[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (markers > low) + (markers > high), 0)

    # Adam on the mean negative log-likelihood; thresholds are a first one and positive steps.
    above = grade[:, None] > np.arange(GRADES - 1)[None, :]
    weights, theta = np.zeros(len(kept)), np.array([2.0, 1.0, 1.0])[: GRADES - 1]
    state = [np.zeros(len(kept) + GRADES - 1) for _ in range(2)]
    for t in range(1, rounds + 1):
        cuts = np.cumsum(np.r_[theta[0], np.log1p(np.exp(theta[1:]))])
        score = np.bincount(row, weights[col], minlength=len(hashes))
        p = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -30, 30)))  # P(grade > k)
        edge = np.c_[np.ones(len(score)), p, np.zeros(len(score))]
        mine = np.take_along_axis(edge, grade[:, None], 1)[:, 0] - np.take_along_axis(edge, grade[:, None] + 1, 1)[:, 0]
        slope = edge * (1 - edge)  # derivative of P(grade > k - 1) by the score
        upper = np.take_along_axis(slope, grade[:, None], 1)[:, 0] / np.maximum(mine, 1e-9)
        lower = np.take_along_axis(slope, grade[:, None] + 1, 1)[:, 0] / np.maximum(mine, 1e-9)
        by_score = -(upper - lower) / len(score)
        by_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_cut[k] = (upper[grade == k + 1].sum() - lower[grade == k].sum()) / len(score)
        tail = np.cumsum(by_cut[::-1])[::-1]
        by_theta = np.r_[tail[0], tail[1:] / (1 + np.exp(-theta[1:]))]
        gradient = np.r_[np.bincount(col, by_score[row], minlength=len(kept)) + 1e-4 * weights, by_theta]
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        step = 0.05 * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-8)
        weights, theta = weights - step[: len(kept)], theta - step[len(kept) :]
    del above
    return Model(codes[kept], weights, np.cumsum(np.r_[theta[0], np.log1p(np.exp(theta[1:]))]))


def train(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    return fit(*labelled_sample(docs, labels, **bounds))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with severity (0 to 3), grade and is_toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            rest = [n for n in batch.schema.names if n not in RESULTS]
            found = [pa.array(x) for x in model.severity(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), *found], names=[*rest, *RESULTS])
        give_back()

    rest = docs.drop(*RESULTS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{schema}, severity double, grade int, is_toxic boolean")
