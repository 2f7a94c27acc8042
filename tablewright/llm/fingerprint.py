"""Context-triggered piecewise hashing of whole texts.

A hash of the last seven bytes decides where chunks end: at block size 2**i a chunk ends where that hash has
i trailing zeros. The block size is the smallest (from 2) that ends fewer than 64 chunks, whatever the length.
Each chunk gives twelve bits of its hash, written as two characters. A fingerprint is
`block:signature:signature at twice the block`. Two fingerprints compare at block sizes they share, by the
edit distance (insertions and deletions) of the signatures; the likeness is 1 less the distance over the
summed lengths, and 0 without a shared block size.

A null text is an empty text, whose fingerprint is `2::`. Equal texts have equal fingerprints, and equal
fingerprints a likeness of 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.flat import flat_text, rolling_hash, slices, span_hash

WINDOW = 7
MOST_CHUNKS = 64
LEAST_LEVEL, TOP_LEVEL = 1, 40

# The 64 characters of base64, in order.
_ALPHABET = np.array([*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), ord("+"), ord("/")], np.uint8)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprint of each text; texts as in `flat.flat_text`."""
    n = len(offsets) - 1
    if not len(data):
        return ["2::"] * n
    # Windows reach over the beginning of a text into zeros: the bytes are spread with seven zeros between texts.
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    spread = np.zeros(len(data) + WINDOW * n, np.uint64)
    at = np.arange(len(data)) + WINDOW * (doc + 1)
    spread[at] = data.astype(np.uint64) + np.uint64(1)
    context = rolling_hash(spread, WINDOW)[at - WINDOW + 1]
    # Only every second place can end a chunk, at the smallest block size.
    places = np.flatnonzero((context & np.uint64((1 << LEAST_LEVEL) - 1)) == 0)
    value = context[places]
    low = value & (~value + np.uint64(1))
    level = np.where(value == 0, TOP_LEVEL, np.minimum(np.log2(np.maximum(low, 1).astype(np.float64)), TOP_LEVEL)).astype(np.int64)
    owner = doc[places]
    block = np.full(n, TOP_LEVEL + 1)
    counts = np.zeros(n, np.int64)
    by_level = np.bincount(owner * (TOP_LEVEL + 1) + level, minlength=n * (TOP_LEVEL + 1)).reshape(n, TOP_LEVEL + 1)
    for i in range(TOP_LEVEL, LEAST_LEVEL - 1, -1):
        counts += by_level[:, i]
        block[counts < MOST_CHUNKS] = i
    first = _signatures(data, offsets, places, level, owner, block)
    second = _signatures(data, offsets, places, level, owner, block + 1)
    return [f"{1 << b}:{x}:{y}" for b, x, y in zip(block.tolist(), first, second, strict=True)]


def _signatures(data, offsets, places, level, owner, block) -> list[str]:
    ends = places[level >= block[owner]] + 1
    ends = np.union1d(ends, offsets[1:][np.diff(offsets) > 0])
    starts = np.r_[0, ends[:-1]]
    code = span_hash(data, starts, ends) >> np.uint64(52)
    letters = np.empty(2 * len(code), np.uint8)
    letters[::2], letters[1::2] = _ALPHABET[code >> np.uint64(6)], _ALPHABET[code & np.uint64(63)]
    raw = letters.tobytes().decode("ascii")
    at = (2 * np.searchsorted(starts, offsets)).tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _codes(signatures: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Chunk codes, one row per signature, padded with zeros, and their numbers."""
    lengths = np.array([len(s) // 2 for s in signatures], np.int64)
    table = np.zeros((len(signatures), max(int(lengths.max(initial=0)), 1)), np.uint16)
    flat = np.frombuffer("".join(signatures).encode("ascii"), np.uint16)
    table[np.arange(table.shape[1]) < lengths[:, None]] = flat
    return table, lengths


def _common(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness of signatures pairwise: longest common subsequences bit by bit, all pairs at once."""
    x, n = _codes(a)
    y, m = _codes(b)
    bits = np.uint64(1) << np.arange(x.shape[1], dtype=np.uint64)
    state = np.full(len(a), ~np.uint64(0))
    for j in range(y.shape[1]):
        match = np.where((x == y[:, j : j + 1]) & (y[:, j : j + 1] > 0), bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        both = state & match
        state = (state + both) | (state & ~match)
    used = np.where(n >= 64, ~np.uint64(0), (np.uint64(1) << n.astype(np.uint64) % np.uint64(64)) - np.uint64(1))
    same = np.bitwise_count(~state & used).astype(np.float64)
    return np.where(n + m > 0, 2 * same / np.maximum(n + m, 1), 1.0)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """From 0 to 1, for each pair of fingerprints."""
    a, b = [x.split(":") for x in left], [x.split(":") for x in right]
    result = np.zeros(len(a))
    p, q = np.array([int(x[0]) for x in a] or [0]), np.array([int(x[0]) for x in b] or [0])
    for chosen, i, j in ((p == q, 1, 1), (p == q, 2, 2), (p == 2 * q, 1, 2), (2 * p == q, 2, 1)):
        rows = np.flatnonzero(chosen)[: len(a)]
        if len(rows):
            found = _common([a[k][i] for k in rows], [b[k][j] for k in rows])
            result[rows] = np.maximum(result[rows], found)
    return result


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of each text. A column that has that name already is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rest = [n for n in batch.schema.names if n != name]
            found = pa.array(fingerprints(*flat_text(batch.column(text))), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), found], names=[*rest, name])

    rest = docs.drop(name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{schema}, `{name}` string")


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, text in ascending order over range partitions; each ends with a copy of the row after it.

    Columns: bucket, copy (false for the rows themselves), doc_id, text. Ties of doc_id are ordered by text;
    the row after the last one is the first.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"))
    # A handful of bounds, and the smallest id of each bucket: as many values as there are buckets.
    share = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(ids.agg(F.percentile_approx("key", share, 10_000)).first()[0] or [])) if share else []
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))

    def bucket(column):
        return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < column)) if bounds else F.lit(0)

    first = dict(ids.groupBy(bucket(F.col("key")).alias("bucket")).agg(F.min("key")).collect())
    order = sorted(first)
    before = {first[b]: order[i - 1] for i, b in enumerate(order)}
    place = F.struct(bucket(key).alias("bucket"), F.lit(False).alias("copy"))
    places = F.array(place)
    if before:
        leads = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
        lent = F.struct(leads[key].alias("bucket"), F.lit(True).alias("copy"))
        places = F.when(key.isin(list(before)), F.array(place, lent)).otherwise(places)
    both = docs.select("doc_id", "text", F.explode(places).alias("place")).select("place.bucket", "place.copy", "doc_id", "text")
    number = F.array_position(F.array(*map(F.lit, order or [0])), F.col("bucket")).cast("int") - 1
    return both.repartitionById(max(len(order), 1), number).sortWithinPartitions(
        "bucket", "copy", "doc_id", "text"
    )


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has the last floor(n_chars / 2) characters replaced by the first as many (or all) of the
    next document, by ascending doc_id; after the last comes the first.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(rows: list[tuple[int, str]], following: str, prints: list[str]) -> pa.RecordBatch:
        texts = [t for _, t in rows] + [following]
        edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts[:-1], texts[1:], strict=True)]
        theirs = fingerprints(*flat_text(pa.array(edited, pa.string())))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in rows], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
                pa.array(prints[:-1]),
                pa.array(theirs),
                pa.array(likeness(prints[:-1], theirs)),
                pa.array(likeness(prints[:-1], prints[1:])),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, which waits for the one after it
        for batch in slices(batches):
            prints = fingerprints(*flat_text(batch.column("text")))
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns = [batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id")]
            rows = [*([held] if held else []), *zip(*columns, texts, prints, strict=True)]
            held = rows[-1]
            # A row is complete if its successor is here; copies and rows of another bucket only lend their text.
            at = 0
            while at < len(rows) - 1:
                upto = at
                while upto < len(rows) - 1 and not rows[upto][1]:
                    upto += 1
                if upto > at:
                    mine = rows[at:upto]
                    yield results([(r[2], r[3]) for r in mine], rows[upto][3], [r[4] for r in rows[at : upto + 1]])
                at = upto
                while at < len(rows) - 1 and rows[at][1]:
                    at += 1

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs.select("doc_id", "text"), buckets).mapInArrow(run, schema)
