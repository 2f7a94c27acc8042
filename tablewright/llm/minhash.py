"""Near-duplicate classes by ProbMinHash signatures, banding and verification.

Shingles are `SHINGLE` consecutive words (words as they stand; a text of fewer words is one shingle). Each
shingle is a Poisson process whose rate is its weight; every arrival falls on one register of the signature,
which keeps the earliest. A process ends as soon as its next arrival is later than all registers hold. Two
signatures agree in a register with the probability Jaccard similarity of the weighted shingles. The weight is
1 + ln of how often the shingle occurs; a text in which some occur again is signed a second time with equal
weights, which estimates the Jaccard similarity of the shingle sets. (Without repetitions both are the same.)

Texts of equal words are one node from the start (by 128 bits of hashes). Texts that agree in a band of
registers, of either signature, form a block, named by the least of them. In each cell (two pieces of a block,
bounded in texts and shingles) all pairs are verified: shared shingles are counted exactly, by a sparse matrix
product, and pairs link whose shingle sets have a Jaccard similarity of `threshold` or more. A cell hands on a
spanning forest of its verified links, no more than it has texts, so no group of copies becomes pairs; texts
cross a shuffle once for each block that they are in, not for each pair. Nothing is capped or estimated after
the bands. Classes are the connected components of the links.

Null and empty texts have no words and are copies of each other. Rows repeated or of equal doc_id are rows
of their own. A class is named by its least doc_id (null if none of its rows has one). An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import jaccard
from tablewright.llm.components import components
from tablewright.llm.flat import flat_text, give_back, mixed, rolling_hash, slices, span_hash, word_spans
from tablewright.llm.substring import release, unpacked
from tablewright.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
# A pair at the threshold shares no band of a signature with probability 0.0001, one at 0.3 shares one with 0.02.
BANDS, ROWS = 30, 6
# Texts and shingles of a piece at most.
PIECE_TEXTS, PIECE_SHINGLES = 2048, 1 << 20
# From so many texts on, a cell's memory is worth giving back.
_MANY = 256

_SALTS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NO_WORDS = -1


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Text and hash of every shingle, and two hashes of each text's words (0: no words)."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(data, starts, ends)
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    filled = size > 0
    place = (np.arange(len(words)) - first[doc]).astype(np.uint64)
    wholes = []
    for salt in _SALTS:
        whole = np.zeros(len(size), np.uint64)
        if filled.any():
            summed = np.add.reduceat(mixed(words + mixed(place + salt)), first[:-1][filled])
            whole[filled] = mixed(summed + size[filled].astype(np.uint64))
        wholes.append(whole)
    at = np.flatnonzero(np.arange(len(words)) + SHINGLE <= first[1:][doc]) if len(words) else np.zeros(0, np.int64)
    short = np.flatnonzero(filled & (size < SHINGLE))
    found = rolling_hash(words, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    return np.r_[doc[at], short], np.r_[found, wholes[0][short]], wholes


def distinct(doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's different shingles, by text, and how often they occur."""
    order = np.argsort(code)
    small = np.uint16 if int(doc.max(initial=0)) < 1 << 16 else np.int64  # Numbers of 16 bits are sorted by radix.
    order = order[np.argsort(doc[order].astype(small), kind="stable")]
    doc, code = doc[order], code[order]
    opens = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])]) if len(code) else np.zeros(0, np.int64)
    return doc[opens], code[opens], np.diff(np.r_[opens, len(code)])


def signatures(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures, one row per text; texts without shingles have zeros."""
    time = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    seed, now, arrival = mixed(code + np.uint64(0x9E3779B97F4A7C15)), np.zeros(len(code)), 0
    while len(doc):
        arrival += 1
        random = mixed(seed + np.uint64(arrival * 0xD1B54A32D192ED03 % (1 << 64)))
        now = now - np.log((random >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weight
        place = doc * registers + (mixed(random) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(now < time[place])
        # Of several arrivals on a register the earliest is written last.
        better = better[np.argsort(-now[better], kind="stable")]
        time[place[better]] = now[better]
        winner[place[better]] = seed[better]
        # No later arrival of a process counts once its text's registers are all earlier.
        latest = time.reshape(n, registers).max(axis=1)
        going = now < latest[doc]
        doc, seed, now, weight = doc[going], seed[going], now[going], weight[going]
    return winner.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band of each signature."""
    keys = np.zeros((len(signature), bands), np.uint64)
    for i in range(rows):
        keys = mixed(keys + signature[:, i::rows])
    return mixed(keys + np.arange(bands, dtype=np.uint64)[None, :])


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, with_bands: bool = True) -> DataFrame:
    """doc_id, x (a hash of the text), one and two (hashes of its words; 0: none), and n (shingles) and bands."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, code, wholes = shingles(*flat_text(batch.column("text")))
        columns = [batch.column("doc_id"), batch.column("x"), *(pa.array(w.view(np.int64)) for w in wholes)]
        names = ["doc_id", "x", "one", "two"]
        if with_bands:
            doc, code, count = distinct(doc, code)
            n = np.bincount(doc, minlength=batch.num_rows)
            found = signatures(doc, code, np.ones(len(doc)), batch.num_rows, bands * rows)
            texts, keys = [np.flatnonzero(n)], [band_keys(found, bands, rows)[n > 0]]
            again = np.unique(doc[count > 1])  # texts with weights that are not all equal
            own = np.isin(doc, again)
            found = signatures(np.searchsorted(again, doc[own]), code[own], 1 + np.log(count[own]), len(again), bands * rows)
            texts.append(again)
            keys.append(band_keys(found, bands, rows))
            owner = np.repeat(np.concatenate(texts), bands)
            order = np.argsort(owner, kind="stable")
            ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=batch.num_rows))]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).ravel()[order].view(np.int64)))
            columns, names = [*columns, pa.array(n, pa.int64()), lists], [*names, "n", "bands"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield sign(batch)
        give_back()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("x"), "text")
    return keyed.mapInArrow(run, "doc_id long, x long, one long, two long" + (", n long, bands array<long>" if with_bands else ""))


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


class Texts(jaccard.Side):
    """Some texts of a cell, with their shingles."""

    def __init__(self, table: pa.Table) -> None:
        table = table.take(pa.array(np.argsort(table["n"].to_numpy(), kind="stable")))
        self.id, self.n = table["id"].to_numpy(), table["n"].to_numpy()
        rows, codes, before = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
        for batch in unpacked(iter(table.select(["_text"]).to_batches())):
            row, code, _ = distinct(*shingles(*flat_text(batch.column("text")))[:2])
            rows.append(row + before)
            codes.append(code)
            before += batch.num_rows
        nothing = np.zeros(0, np.int64)
        self.entries = {"grams": (np.concatenate(rows), np.concatenate(codes)), "pivots": (nothing, nothing)}


def _verified(hundredths: int):
    def verify(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block = table["block"].to_numpy()
        left = Texts(table.take(pa.array(np.flatnonzero(block == i))))
        right = left if i == j else Texts(table.take(pa.array(np.flatnonzero(block == j))))
        found, _ = jaccard.linked(left, right, hundredths)
        if i == j:
            np.fill_diagonal(found, False)
        edges = np.array(jaccard.forest(found, i == j), np.int64).reshape(-1, 2)
        return pa.table([pa.array(left.id[edges[:, 0]]), pa.array(right.id[edges[:, 1]])], names=["u", "v"])

    def links(key: tuple, table: pa.Table) -> pa.Table:
        found = verify(key, table)
        if table.num_rows > _MANY:
            give_back()
        return found

    return links


def _nodes(docs: DataFrame, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, x, one, two), and the nodes (one, two, component, and the least row: doc_id, x)."""
    spark = docs.sparkSession
    every = materialize(signed(docs, with_bands=False), label="words")
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "x")
    nodes = signed(docs, bands, rows).where("n > 0").groupBy("one", "two")
    nodes = nodes.agg(F.min_by(F.struct("doc_id", "x", "n", "bands"), order).alias("row"), F.count("*").alias("copies"))
    nodes = materialize(nodes.select(F.monotonically_increasing_id().alias("id"), "one", "two", "copies", "row.*"), label="nodes")
    release(spark)
    entries = nodes.select("id", "n", F.explode("bands").alias("band"))
    # Written first: behind an aggregation in the same stage Spark could not split the join on a band that many
    # share.
    blocks = materialize(entries.groupBy("band").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).where("size > 1"), label="bands")
    members = materialize(entries.join(blocks, "band").select("pivot", "id", "n").distinct(), label="members")
    release(spark)
    # A text alone in its block (it agrees with itself in two bands) has no pair.
    pieces = F.greatest(F.ceil(F.count("*") / PIECE_TEXTS), F.ceil(F.sum("n") / PIECE_SHINGLES)).cast("int")
    pieces = materialize(members.groupBy("pivot").agg(pieces.alias("pieces"), F.count("*").alias("size")).where("size > 1").drop("size"), label="pieces")
    texts = jaccard._texts(docs, every, nodes, members).drop("pivots", "copies")
    mine = F.pmod(F.xxhash64("id"), "pieces").cast("int")
    # A text goes to the cells of its piece with every piece of the block.
    cells = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")))
    dealt = members.select("pivot", "id").join(pieces, "pivot").select("pivot", "id", mine.alias("block"), F.explode(cells).alias("cell"))
    dealt = dealt.select("pivot", "cell.i", "cell.j", "block", "id").join(texts, "id")
    links = dealt.groupBy("pivot", "i", "j").applyInArrow(_verified(round(100 * threshold)), "u long, v long")
    links = materialize(links, label="links")
    release(spark)
    label = components(links).withColumnRenamed("node", "id")
    named = nodes.select("id", "one", "two", "doc_id", "x").join(label, "id", "left")
    named = materialize(named.select("one", "two", F.coalesce("component", "id").alias("component"), "doc_id", "x"), label="named")
    release(spark)
    return every, named


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class): one row per document. Threshold in hundredths."""
    every, nodes = _nodes(docs, threshold, bands, rows)
    least = materialize(nodes.groupBy("component").agg(F.min("doc_id").alias("class_id")), label="least")
    named = nodes.select("one", "two", "component").join(least, "component").select("one", "two", "class_id")
    alone = every.where("one = 0 AND two = 0").groupBy("one", "two").agg(F.min("doc_id").alias("class_id"))
    named = materialize(named.unionAll(alone), label="classes")
    return every.join(named, ["one", "two"]).select("doc_id", "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of `docs`, one for each class: that of least doc_id, then of least text hash."""
    every, nodes = _nodes(docs, threshold, bands, rows)
    order = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "x")).alias("row")
    alone = every.where("one = 0 AND two = 0").groupBy(F.lit(_NO_WORDS).cast("long").alias("component")).agg(order)
    kept = nodes.groupBy("component").agg(order).unionAll(alone).select(F.col("row.doc_id").alias("_id"), F.col("row.x").alias("_x"))
    kept = materialize(kept, label="kept")
    keyed = docs.withColumns({"_key_id": F.col("doc_id").cast("long"), "_key_x": text_hash()})
    same = F.col("_key_id").eqNullSafe(F.col("_id")) & (F.col("_key_x") == F.col("_x"))
    kept_rows = keyed.join(kept, same, "left_semi")
    # Rows repeated as a whole have the same key: where there are such, one stays.
    repeated = every.groupBy("doc_id", "x").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.col("x").alias("_x"))
    repeated = materialize(repeated, label="repeated")
    if not repeated.isEmpty():
        single = kept_rows.join(repeated, same, "left_semi").dropDuplicates(["_key_id", "_key_x"])
        kept_rows = kept_rows.join(repeated, same, "left_anti").unionAll(single)
    return kept_rows.drop("_key_id", "_key_x")
