"""Fill-in-middle transformation: texts cut in prefix, middle and suffix, put together for infilling models.

Cuts are drawn in units of a text, tokens (`[A-Za-z]+|[^A-Za-z]`) or characters, and needed both as characters
and as bytes. An index of exceptions converts between them: of a batch of texts as flat UTF-8 it records only
the positions of multibyte characters and how many bytes they have beyond one. Between two exceptions characters
and bytes differ by a constant, so a binary search and a subtraction turn one into the other; pure ASCII has an
empty index. Where a unit begins is a bit per byte, counted in blocks; the cut is found within its block.

The draws are the first four 8-digit groups of the hex SHA-256 of `<seed>:<doc_id>` (nothing behind the colon for
a null doc_id), so they are the same in every run and on every partition. Forms: plain (the text as it is), psm
(prefix, suffix, middle) and spm (suffix, prefix, middle). A null text is empty; empty texts and texts with a
marker in them are plain, so that every output can be taken apart again. Repeated rows come out alike. Added
columns replace columns of the same name, others pass through. An empty table gives an empty result. A text is
never split over tasks; beyond the text a task holds a few bytes per byte of about 4 MB of texts, or of one
longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.flat import flat_text, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}

_BLOCK = 64


class Exceptions:
    """Where bytes and characters of a flat text part: the multibyte characters."""

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.r_[0, np.cumsum(more)]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Characters before each byte position (where a character begins)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Bytes before each character."""
        return char + self.excess[np.searchsorted(self.at - self.excess[:-1], char)]


class Begins:
    """Marks on bytes, counted by blocks."""

    def __init__(self, marks: np.ndarray) -> None:
        self.rows = np.zeros((len(marks) // _BLOCK + 1, _BLOCK), bool)
        self.rows.ravel()[: len(marks)] = marks
        self.upto = np.r_[0, np.cumsum(self.rows.sum(axis=1))]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each position."""
        row = at // _BLOCK
        return self.upto[row] + (self.rows[row] & (np.arange(_BLOCK) < (at % _BLOCK)[:, None])).sum(axis=1)

    def select(self, rank: np.ndarray) -> np.ndarray:
        """Position of the mark with that many marks before it, which must exist."""
        row = np.searchsorted(self.upto, rank, side="right") - 1
        inside = np.cumsum(self.rows[row], axis=1, dtype=np.int8)
        return row * _BLOCK + (inside <= (rank - self.upto[row])[:, None]).sum(axis=1)


def token_begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes begin a token: a run of ASCII letters, or any other character."""
    letter = (data | 0x20) - np.uint8(97) < 26
    within = letter.copy()
    within[1:] &= letter[:-1]
    within[offsets[offsets < len(data)]] = False
    return ~within & ((data & 0xC0) != 0x80)


def cuts(data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray], units: str) -> tuple[np.ndarray, ...]:
    """Units of each text; bytes where prefix and middle end, and how many characters both have."""
    index = Exceptions(data)
    chars = index.chars(offsets)
    if units == "char":
        n = np.diff(chars)
    else:
        begins = Begins(token_begins(data, offsets))
        before = begins.rank(offsets)
        n = np.diff(before)
    drawn = [d % (n + 1) for d in draws]
    ends = []
    for unit in (np.minimum(*drawn), np.maximum(*drawn)):
        if units == "char":
            ends.append(index.bytes(chars[:-1] + unit))
        else:
            inner = unit < n
            end = offsets[1:].copy()
            end[inner] = begins.select((before[:-1] + unit)[inner])
            ends.append(end)
    first, second = (index.chars(end) for end in ends)
    return n, ends[0], ends[1], first - chars[:-1], second - first


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, units: str = "token", text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """`docs` with n (units of the text), form, prefix_chars, middle_chars (null if plain) and output."""
    if units not in ("token", "char"):
        raise ValueError("units are 'token' or 'char'")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))), 256)
    own = F.col(f"`{text}`")
    draw = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    plain = own.isNull() | (own == "") | (draw[2] % 100 >= 100 - plain_percent)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(own, F.lit(mark))
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    others = [c for c in docs.columns if c not in ADDED]
    # Under names of our own, so that no column of the table can clash.
    inner = [f"_c{i}" for i in range(len(others))]
    rows = docs.withColumn("_digest", digest).select(
        *(F.col(f"`{c}`").alias(i) for c, i in zip(others, inner, strict=True)),
        F.col(f"`{text}`").alias("text"),
        draw[0].alias("_h1"),
        draw[1].alias("_h2"),
        form.alias("_form"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        for batch in slices(batches):
            data, offsets = flat_text(batch.column("text"))
            forms = batch.column("_form").to_pylist()
            n, first, second, prefix, middle = cuts(data, offsets, [batch.column(h).to_numpy() for h in ("_h1", "_h2")], units)
            raw, out = data.tobytes(), []
            for form, a, b, c, d in zip(forms, offsets.tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(), strict=False):
                if form == "plain":
                    out.append(raw[a:d])
                elif form == "psm":
                    out.append(b"".join((marks[0], raw[a:b], marks[1], raw[c:d], marks[2], raw[b:c])))
                else:
                    out.append(b"".join((marks[1], raw[c:d], marks[0], raw[a:b], marks[2], raw[b:c])))
            plain = np.array([f == "plain" for f in forms], bool)
            made = [pa.array(n, pa.int64()), batch.column("_form"), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in inner), *made], names=[*inner, *ADDED])

    kinds = [T.StructField(i, docs.schema[c].dataType) for c, i in zip(others, inner, strict=True)]
    schema = T.StructType([*kinds, *(T.StructField(c, T.LongType() if kind == "long" else T.StringType()) for c, kind in ADDED.items())])
    made = rows.mapInArrow(run, schema)
    return made.select(*(F.col(i).alias(c) for c, i in zip(others, inner, strict=True)), *ADDED)


def restored(output: Column, form: Column) -> Column:
    """The text that `output` of this form was made from.

    No text with a marker is cut and no marker begins inside another one, so an output holds three of them.
    """
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), 4)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def digests(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256."""
    made = fill_in_middle(docs.select("doc_id", "text"), **how)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
