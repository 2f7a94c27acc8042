"""Substring dedup by relative Lempel-Ziv parsing against content-defined reference blocks.

Every text is cut into blocks: the longest stretches of windows (of `window` words) that share the same
minimizer, the smallest hash of `ANCHOR` consecutive words in the window. Cuts depend on the words alone, so
copies are cut alike wherever they stand. The first occurrence of each different block is a reference block,
indexed by its minimizer. A document is factored greedily over this index: blocks that equal an earlier
reference block are factors as a whole, and follow on each other to make long ones. At the boundaries of
factors, where a block shares its minimizer with a reference block but differs from all (the copy begins or
ends inside), each of its windows is checked on its own. A block that shares its minimizer with no other
can't hold a window that occurs elsewhere. So exactly those windows are found that occur earlier.

Factoring every document against every block by suffix search would compare all pairs of blocks; the index
by minimizer makes it a join. Blocks are compared by 128 bits of hashes, windows by 128 bits.

Documents are ordered by doc_id, null first. Rows with the same id and different texts are told apart by 87 bits
of hashes of the text, which also order them; rows repeated as a whole are one document and come out alike.
Null text has no words. A text of any length is processed whole. Extra columns pass through.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.flat import flat_text, gather, give_back, mixed, pieces, powers, rolling_hash, slices, span_hash, word_spans
from tablewright.session import materialize

WINDOW = 20
ANCHOR = 5
# Bytes of text that a task works on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

# A place in a document as one long, in this order: 23 bits of a second hash of the text, 35 bits of word number,
# 5 bits of the number of windows.
_TAG_BITS, _COUNT_BITS, _WORD_BITS = 23, 5, 35
_ROW = ["_doc", "_wide", "_tag"]
_BASE, _INVERSE = 0xA0761D6478BD642F, pow(0xA0761D6478BD642F, -1, 1 << 64)
_SECOND = 0xE7037ED1A0B428DB


def _ids_repeat(docs: DataFrame) -> bool:
    """Whether rows with one id (or none) have different texts."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), _text_hash().alias("x"))
    several = rows.groupBy("_doc").agg(F.min("x").alias("least"), F.max("x").alias("most")).where("least <> most")
    return not several.isEmpty()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _keys(docs: DataFrame, wide: bool) -> DataFrame:
    """`docs` with `_doc`, `_wide` and `_tag`, by which rows are told apart.

    Where every id has one text only, the id does that. Otherwise rows of one id differ by a hash of 64 bits,
    which also orders them, and by some bits of a second one.
    """
    second = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1)).bitwiseAND((1 << _TAG_BITS) - 1)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.withColumns({"_doc": doc, "_wide": _text_hash() if wide else F.lit(0).cast("long"), "_tag": second if wide else F.lit(0).cast("long")})


def _blocks(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of each block: minimizer, hash of its words, text, first window (word in the text), number of windows."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(data, starts, ends)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = rolling_hash(words, ANCHOR)
    valid = np.flatnonzero(np.arange(len(words)) + window <= first[1:][doc]) if len(words) else np.zeros(0, np.int64)
    if not len(valid):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    # The smallest gram of each window, the first of equals: upper half hash, lower half place.
    half = np.uint64(32)
    least = (grams >> half << half) | np.arange(len(grams), dtype=np.uint64)
    width, size = window - ANCHOR + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    at = (least[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    opens = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[opens, len(at)])
    begin = valid[opens]
    end = begin + count + window - 1
    sums = np.r_[np.uint64(0), np.cumsum(words * powers(len(words), _BASE), dtype=np.uint64)]
    content = mixed((sums[end] - sums[begin]) * powers(len(words), _INVERSE)[begin] + end.astype(np.uint64) - begin.astype(np.uint64))
    owner = doc[begin]
    return grams[at[opens]].view(np.int64), content.view(np.int64), owner, begin - first[owner], count


def blocks(docs: DataFrame, window: int) -> DataFrame:
    """anchor, content, doc, wide, place of every block of every document (with `_doc`, `_wide`, `_tag`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=PIECE_BYTES):
            anchor, content, owner, word, count = _blocks(*flat_text(batch.column("text")), window)
            doc, wide, tag = (batch.column(c).to_numpy()[owner] for c in _ROW)
            place = (tag << (_WORD_BITS + _COUNT_BITS)) | (word << _COUNT_BITS) | count
            columns = [pa.array(x, pa.int64()) for x in (anchor, content, doc, wide, place)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "doc", "wide", "place"])
            del columns, anchor, content, owner, word, count, doc, wide, tag, place
        give_back()

    return docs.select(*_ROW, "text").mapInArrow(run, "anchor long, content long, doc long, wide long, place long")


def packed(docs: DataFrame, *more: str) -> DataFrame:
    """The texts compressed, as they go through a shuffle: `_text` in place of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches, max_bytes=PIECE_BYTES):
            names = [n for n in batch.schema.names if n != "text"]
            texts = [pack(t.encode("utf-8")) if t is not None else None for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.binary())], names=[*names, "_text"])
            del texts
        give_back()

    df = docs.select(*more, "text")
    rest = df.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return df.mapInArrow(run, f"{schema}, _text binary")


def unpacked(batches: Iterator[pa.RecordBatch], most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches with `text` again, in pieces whose texts come to about `most_bytes`; a longer text is a piece of its own."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        # A text can be a thousand times as long as its compressed form, so what it will take is read from its frame.
        sizes = np.array([zstandard.frame_content_size(t.as_buffer()) if t.is_valid else 0 for t in batch.column("_text")], np.int64)
        for piece in pieces(batch, sizes, most_bytes):
            texts = pa.array([unpack(t) if t is not None else None for t in piece.column("_text").to_pylist()], pa.binary()).cast(pa.string())
            names = [n for n in piece.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), texts], names=[*names, "text"])
            del texts


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _tag_of(place: Column) -> Column:
    return F.shiftright(place, _WORD_BITS + _COUNT_BITS)


def _span_of(place: Column) -> Column:
    return place.bitwiseAND((1 << (_WORD_BITS + _COUNT_BITS)) - 1)


def repeated_windows(docs: DataFrame, window: int = WINDOW, wide: bool = True) -> DataFrame:
    """_doc, _wide, _tag, spans of the documents with words to remove; a span is first word * 32 + windows."""
    if not ANCHOR <= window <= 31 + ANCHOR:
        raise ValueError(f"windows have from {ANCHOR} to {31 + ANCHOR} words")
    spark = docs.sparkSession
    docs = _keys(docs, wide)
    every = blocks(docs, window)
    # What a frequent minimizer or window is joined with is written first: behind an aggregation in the same
    # stage Spark could not split the join.
    shared = materialize(every.groupBy("anchor").count().where("count > 1").select("anchor"), label="shared")
    # Of blocks whose minimizer occurs nowhere else nothing more is needed.
    some = materialize(every.join(shared, "anchor", "left_semi"), label="blocks")
    release(spark)
    index = some.groupBy("anchor", "content").agg(F.min(F.struct("doc", "wide", "place")).alias("first"), F.count("*").alias("n"))
    index = materialize(index, label="index")
    again = some.join(index.where("n > 1"), ["anchor", "content"])
    place = F.struct("doc", "wide", "place")
    whole = again.where(~(place == F.col("first"))).select("doc", "wide", "place")
    # Reference blocks that share a minimizer with another one: windows at the boundaries of factors.
    several = materialize(index.groupBy("anchor").count().where("count > 1").select("anchor"), label="several")
    edges = index.join(several, "anchor", "left_semi").select("first.doc", "first.wide", "first.place")
    lists = edges.groupBy(F.col("doc").alias("_doc"), F.col("wide").alias("_wide"), _tag_of(F.col("place")).alias("_tag")).agg(F.collect_list(_span_of(F.col("place"))).alias("spans"))
    # The texts go through a shuffle twice; what was shuffled before is released first.
    lists = materialize(lists, label="lists")
    release(spark)
    joined = packed(docs, *_ROW).join(lists, _ROW)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            data, offsets = flat_text(batch.column("text"))
            starts, ends, first = word_spans(data, offsets)
            words = span_hash(data, starts, ends)
            spans = batch.column("spans")
            span = spans.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), spans.value_lengths().to_numpy())
            count = span & ((1 << _COUNT_BITS) - 1)
            word = gather(span >> _COUNT_BITS, count)
            owner = np.repeat(owner, count)
            at = first[owner] + word
            doc, wide, tag = (batch.column(c).to_numpy()[owner] for c in _ROW)
            place = (tag << (_WORD_BITS + _COUNT_BITS)) | (word << _COUNT_BITS) | 1
            one, two = rolling_hash(words, window)[at].view(np.int64), rolling_hash(words, window, _SECOND)[at].view(np.int64)
            columns = [pa.array(x, pa.int64()) for x in (one, two, doc, wide, place)]
            yield pa.RecordBatch.from_arrays(columns, names=["one", "two", "doc", "wide", "place"])
            del columns, data, offsets, starts, ends, first, words, spans, span, owner, count, word, at, doc, wide, tag, place, one, two
        give_back()

    single = materialize(joined.mapInArrow(windows, "one long, two long, doc long, wide long, place long"), label="windows")
    release(spark)
    firsts = single.groupBy("one", "two").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(firsts, label="firsts")
    parts = single.join(firsts, ["one", "two"]).where(~(place == F.col("first"))).select("doc", "wide", "place")
    found = whole.unionAll(parts).groupBy(F.col("doc").alias("_doc"), F.col("wide").alias("_wide"), _tag_of(F.col("place")).alias("_tag"))
    found = materialize(found.agg(F.collect_set(_span_of(F.col("place"))).alias("spans")), label="spans")
    release(spark)
    return found


def _removed(batch: pa.RecordBatch, first: np.ndarray, window: int) -> np.ndarray:
    """Which words of the batch are covered by its spans."""
    change = np.zeros(int(first[-1]) + 1, np.int64)
    spans = batch.column("spans")
    span = spans.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = spans.value_lengths().fill_null(0).to_numpy()
    begin = np.repeat(first[:-1], sizes) + (span >> _COUNT_BITS)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + (span & ((1 << _COUNT_BITS) - 1)) + window - 1, -1)
    return np.cumsum(change)[:-1] > 0


def _with_spans(docs: DataFrame, window: int, *columns: str) -> DataFrame:
    wide = _ids_repeat(docs)
    spans = repeated_windows(docs, window, wide)
    return packed(_keys(docs, wide), *_ROW, *columns).join(spans, _ROW, "left")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, joined by one blank."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column("text"))
        starts, ends, first = word_spans(data, offsets)
        kept = ~_removed(batch, first, window)
        length = np.where(kept, ends - starts + 1, 0)  # with a blank behind
        at = gather(starts, length)
        last = np.cumsum(length)[kept] - 1
        joined = data[np.minimum(at, max(len(data) - 1, 0))]
        joined[last] = 0x20
        bounds = np.r_[0, np.cumsum(length)][first]
        raw = joined.tobytes()
        digests = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        n_kept = np.r_[0, np.cumsum(kept)][first]
        n_words = np.diff(first)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(n_kept), pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            yield digest(batch)
        give_back()

    joined = _with_spans(docs, window, "doc_id").select("doc_id", "_text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with repeated passages cut out of the text; white space goes with the word before it."""
    names = [n for n in docs.columns if n != "text"]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column("text"))
        starts, _, first = word_spans(data, offsets)
        removed = np.flatnonzero(_removed(batch, first, window))
        # A word's bytes reach to the next word, or to the end of its text.
        doc = np.searchsorted(first, removed, side="right") - 1
        begin, until = starts[removed], np.minimum(np.r_[starts[1:], len(data)][removed], offsets[1:][doc])
        # No two words begin, or end, at the same byte.
        change = np.zeros(len(data) + 1, np.int8)
        change[begin] += 1
        change[until] -= 1
        raw = data[np.cumsum(change[:-1], dtype=np.int8) == 0].tobytes()
        lengths = np.diff(offsets)
        np.subtract.at(lengths, doc, until - begin)
        bounds = np.r_[0, np.cumsum(lengths)].tolist()
        nulls = batch.column("text").is_null().to_pylist()
        texts = [None if no else raw[a:b].decode("utf-8") for a, b, no in zip(bounds[:-1], bounds[1:], nulls, strict=True)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in inner), pa.array(texts, pa.string())], names=[*names, "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            yield cut(batch)
        give_back()

    # Under names of our own, so that no column of the table can clash.
    inner = [f"_c{i}" for i in range(len(names))]
    keyed = docs.select("doc_id", "text", *(F.col(f"`{n}`").alias(c) for n, c in zip(names, inner, strict=True)))
    joined = _with_spans(keyed, window, *inner).select(*inner, "_text", "spans").toDF(*inner, "_text", "spans")
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return joined.mapInArrow(run, f"{schema}, text string").select(*(f"`{n}`" for n in docs.columns))
