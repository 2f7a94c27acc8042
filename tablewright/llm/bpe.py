"""Byte-pair encoding and decoding in batched numpy merge rounds.

Texts are cut at white space into chunks; equal chunks of a batch are encoded once. The words of all new
chunks lie in one flat array of symbols. In each round every word merges its pair of lowest rank (all its
places, left to right); ranks are found by binary search over the sorted pair keys, and a word without a
pair to merge leaves the rounds. The ids are those of the `tokenizers` library for the two kinds of file in
use: byte-level BPE, and BPE with word ends behind an NFC and lower-case normaliser.

Null text is encoded as empty text; an empty text has no ids. A text of any length is encoded whole.
Equal rows give equal results; columns other than the text are passed through as they are.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablewright.llm.flat import SPACE, flat_text, gather, give_back, slices, span_hash

# Unicode white space, as a regular expression class (fixed values).
WHITE = r"\t-\r \x85\xa0  -     　"
# First bytes of the white space beyond ASCII.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE = regex.compile(r"[\x85\xa0  -     　]")

# The pattern of byte-level files whose pre-tokenizer names none (fixed value of the format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = np.int64(1 << 40)
_encoders: dict[str, Encoder] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _explicit(pattern: str) -> str:
    """The pattern with white space spelled out, so that it means the same in any library."""
    inside = pattern.replace(r"[^\s", "[^" + WHITE)
    return inside.replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")


LETTER, NUMBER, BLANK = 1, 2, 3
_classes: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """Letter, number, white space or other (0), by code point."""
    if not _classes:
        table = np.zeros(0x110000, np.uint8)
        for at in (a for a in range(0, 0x110000, 0x800) if a != 0xD800):  # bit by bit: all at once is a list of a million numbers
            some = "".join(map(chr, range(at, at + 0x800)))
            for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, f"[{WHITE}]+")):
                for found in regex.finditer(pattern, some):
                    table[at + found.start() : at + found.end()] = kind
        _classes.append(table)
    return _classes[0]


def _lower(text: str) -> str:
    # str.lower() treats a sigma at a word's end by context; the normaliser goes letter by letter.
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


class Encoder:
    """One tokenizer file, its pair table and the chunks that this process has met lately."""

    def __init__(self, path: str, kept_chunks: int = 600_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.kept_chunks = kept_chunks
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.normalise = spec["normalizer"] is not None
        splits = [p for p in spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]]) if p["type"] == "Split"]
        self._words = regex.compile(_explicit(splits[0]["pattern"]["Regex"] if splits else BYTE_LEVEL))
        suffix = model["end_of_word_suffix"] or ""
        characters = byte_characters()
        self.byte_id = np.array([vocab[c] for c in characters], np.int64)
        self.last_id = np.array([vocab[c + suffix] for c in characters], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([(vocab[a] << 24) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        place = {c: i for i, c in enumerate(characters)}
        texts = {i: bytes(place[c] for c in t.removesuffix(suffix)) + b" " * bool(suffix and t.endswith(suffix)) for t, i in vocab.items()}
        texts |= {i: t.encode() for t, i in self.special.items()}
        pieces = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and whose
        self.chunk_start, self.chunk_length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.chunk_ids = np.zeros(0, np.uint32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 24) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def merge_rounds(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (none is empty), one after the other, and how many each has."""
        last = np.cumsum(lengths) - 1
        symbols = self.byte_id[data]
        symbols[last] = self.last_id[data[last]]
        word = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.full(len(symbols), NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        ranks[inner] = self.pair_ranks(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(word)])
            lowest = np.minimum.reduceat(ranks, first)
            goes_on = np.repeat(lowest < NEVER, size)
            if not goes_on.all():
                done_symbols.append(symbols[~goes_on])
                done_words.append(word[~goes_on])
                lowest = np.repeat(lowest, size)[goes_on]
                symbols, word, ranks = symbols[goes_on], word[goes_on], ranks[goes_on]
                if not len(symbols):
                    break
            else:
                lowest = np.repeat(lowest, size)
            at = np.flatnonzero(ranks == lowest)
            # Of overlapping places (a, a, a) every other one merges, from the left.
            opens = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.flatnonzero(opens)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            symbols[at] = self.joined[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol went with each merge before
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            changed = np.flatnonzero(touched)
            ranks[changed] = NEVER
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[word[changed] == word[changed + 1]]
            ranks[changed] = self.pair_ranks(symbols[changed], symbols[changed + 1])
        word = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        return symbols[np.argsort(word, kind="stable")].astype(np.uint32), np.bincount(word, minlength=len(lengths))

    def _cut_by_library(self, chunk: bytes) -> list[bytes]:
        """Words of a chunk by the pattern itself; special tokens stand as they are."""
        text, words = chunk.decode("utf-8"), []
        for piece in self._special_split.split(text) if self._special_split else (text,):
            if piece in self.special:
                words.append(piece.encode("utf-8"))
                continue
            if self.normalise:
                piece = _lower(unicodedata.normalize("NFC", piece))
            words.extend([w.encode("utf-8") for w in self._words.findall(piece)])
        return words

    def _hard(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which chunks take more than the classes of their characters to cut."""
        ends = np.cumsum(lengths)
        hard = np.zeros(len(lengths), bool)
        hard[np.searchsorted(ends, np.flatnonzero((data == ord("'")) | (data == ord("<"))), side="right")] = True
        text = data.tobytes().decode("utf-8") if self.normalise else ""
        if "Σ" in text or "İ" in text or not unicodedata.is_normalized("NFC", text):
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(data >= 0x80), side="right")).tolist():
                chunk = data[ends[i] - lengths[i] : ends[i]].tobytes().decode("utf-8")
                hard[i] |= "Σ" in chunk or "İ" in chunk or not unicodedata.is_normalized("NFC", chunk)
            # A mark that opens a chunk must not be read with the chunk before.
            heads = data[ends - lengths] >= 0x80
            for i in np.flatnonzero(heads & ~hard).tolist():
                hard[i] = unicodedata.combining(data[ends[i] - lengths[i] : ends[i]].tobytes().decode("utf-8")[0]) > 0
        return hard

    def _cut(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of plain chunks by character class: their bytes, lengths, and the number per chunk."""
        text = raw.tobytes().decode("utf-8")
        heads = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
        opens = heads[np.r_[0, np.cumsum(sizes)]]  # in characters, as all below
        text = text.lower() if self.normalise else text
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        kind = character_classes()[points]
        first = np.zeros(len(points), bool)
        first[opens[:-1]] = True
        begins = first.copy()
        begins[1:] |= kind[1:] != kind[:-1]
        if self.normalise:
            begins |= kind == NUMBER
        else:
            # White space before a word gives its last blank to it and leaves the others together.
            last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~first[1:])
            begins[last] = True
            begins[last + 1] = points[last] != 0x20
        at = np.flatnonzero(begins)
        edges = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]
        ends = np.r_[at[1:], len(points)]
        if self.normalise:
            at, ends = at[kind[at] != BLANK], ends[kind[at] != BLANK]
        counts = np.diff(np.searchsorted(at, opens))
        lengths = edges[ends] - edges[at]
        return data[gather(edges[at], lengths)], lengths, counts

    def _learn(self, data: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> None:
        """Encode chunks that aren't known yet."""
        starts = np.cumsum(sizes) - sizes
        hard = self._hard(data, sizes)
        difficult = [data[a : a + n].tobytes() for a, n in zip(starts[hard].tolist(), sizes[hard].tolist(), strict=True)]
        order = np.r_[np.flatnonzero(~hard), np.flatnonzero(hard)]
        plain = ~hard
        data, lengths, counts = self._cut(data[gather(starts[plain], sizes[plain])], sizes[plain])
        flat: list[bytes] = []
        if difficult:
            words = [self._cut_by_library(c) for c in difficult]
            flat = [w for ws in words for w in ws]
            data = np.r_[data, np.frombuffer(b"".join(flat), np.uint8)]
            lengths = np.r_[lengths, np.array([len(w) for w in flat], np.int64)]
            counts = np.r_[counts, np.array([len(ws) for ws in words], np.int64)]
        starts = np.cumsum(lengths) - lengths
        _, example, which = np.unique(span_hash(data, starts, starts + lengths), return_index=True, return_inverse=True)
        size = lengths[example]
        ids, found = self.merge_rounds(data[gather(starts[example], size)], size) if len(size) else (np.zeros(0, np.uint32), size)
        begin = np.cumsum(found) - found
        if flat:
            # Special tokens are one id, whatever their letters would merge to.
            specials = {k.encode("utf-8"): v for k, v in self.special.items()}
            others = len(lengths) - len(flat)
            for i, w in enumerate(flat):
                if w in specials:
                    begin, found, which = np.r_[begin, len(ids)], np.r_[found, 1], which.copy()
                    which[others + i] = len(begin) - 1
                    ids = np.r_[ids, np.uint32(specials[w])]
        each = found[which]
        ends = np.r_[0, np.cumsum(each)][np.cumsum(counts)]
        total = np.diff(np.r_[0, ends])
        self.chunk_start = np.r_[self.chunk_start, len(self.chunk_ids) + ends - total]
        self.chunk_length = np.r_[self.chunk_length, total]
        self.chunk_ids = np.r_[self.chunk_ids, ids[gather(begin[which], each)]]
        known = np.r_[self.known, hashes[order]]
        by = np.argsort(known, kind="stable")
        self.known, self.place = known[by], np.r_[self.place, len(self.place) + np.arange(len(order))][by]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin (one entry more than texts)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(self.known) > self.kept_chunks:
            self._forget()
        space = SPACE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        # A text with white space beyond ASCII is one chunk: blanks may join with it.
        for doc in np.unique(np.searchsorted(offsets, np.flatnonzero(_LEADS[data]), side="right") - 1):
            a, b = offsets[doc], offsets[doc + 1]
            if _WIDE.search(data[a:b].tobytes().decode("utf-8")):
                begins[a:b] = False
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], len(data)]
        found, example, which = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        new = ~np.isin(found, self.known, assume_unique=True)
        if new.any():
            begin, size = starts[example[new]], (ends - starts)[example[new]]
            self._learn(data[gather(begin, size)], size, found[new])
        place = self.place[np.searchsorted(self.known, found)][which]
        length = self.chunk_length[place]
        ids = self.chunk_ids[gather(self.chunk_start[place], length)]
        return ids, np.r_[0, np.cumsum(length)][np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts again; bytes that are no UTF-8 become U+FFFD."""
        length = self.piece_length[ids]
        raw = self.piece_bytes[gather(self.piece_start[ids], length)].tobytes()
        ends = np.r_[0, np.cumsum(length)][offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        give_back()  # the file's vocabulary as Python objects
    return _encoders[path]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with a column of token ids. A column that has that name already is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found, offsets = encoder(path).encode(*flat_text(batch.column(text)))
            rest = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), _lists(found, offsets)], names=[*rest, ids])

    rest = docs.drop(ids)
    return rest.mapInArrow(run, _schema(rest, f"`{ids}` array<int>"))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the text of its ids (null: empty). A column that has that name already is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            lengths = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = encoder(path).decode(flat, np.r_[0, np.cumsum(lengths)])
            rest = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(texts, pa.string())], names=[*rest, text])

    rest = docs.drop(text)
    return rest.mapInArrow(run, _schema(rest, f"`{text}` string"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number and SHA-256 of its ids, and the SHA-256 of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            mine = encoder(path)
            ids, offsets = mine.encode(*flat_text(batch.column("text")))
            raw, at = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in mine.decode(ids, offsets)]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), more])
