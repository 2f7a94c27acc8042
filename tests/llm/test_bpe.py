import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablewright.llm import bpe
from tablewright.llm.flat import flat_text

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TEXTS = [
    *("", None, " ", "a", "aaaaaaa aaaa", "it's we'll  \n\n  x ", "don'T CAN'T'S", "x   y", "tail   ", "   head"),
    *("<|endoftext|> b<|endoftext|>  <|startoftext|>x", "<|endoftext", "ΑΣ ΣΑΣ", "é ́x", "İ İstanbul ǅ \x1c\x1d a", "naïve cafȩ́́"),
    *("日本語テスト 漢字", "😀😀 👩‍👩‍👧", "1234567 12 ½ ²", "\t\n\r\x0b\x0c  end\n", "x   y  z", "a" * 3000, " " * 500, "=-" * 700),
]


@pytest.mark.parametrize("file", FILES)
def test_ids_are_those_of_the_library(file):
    path = public_tokenizers.path(file)
    draw = random.Random(3)
    letters = "ab cé'<|>\n\t 12.,-ßΣ́漢😀"
    texts = TEXTS + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    library, mine = Tokenizer.from_file(path), bpe.Encoder(path)
    for part in (texts, texts[::-1], ["it's"], ["<|endoftext|>"]):  # known chunks, then only difficult ones
        ids, offsets = mine.encode(*flat_text(pa.array(part, pa.string())))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want
    if file == FILES[0]:
        ids, offsets = mine.encode(*flat_text(pa.array(texts, pa.string())))
        assert mine.decode(ids, offsets) == [t or "" for t in texts]


def test_forgetting_chunks_changes_nothing():
    path = public_tokenizers.path(FILES[0])
    full, small = bpe.Encoder(path), bpe.Encoder(path, kept_chunks=2)
    for text in ("one two three", "four five", "one two", "six"):
        data = flat_text(pa.array([text]))
        assert np.array_equal(full.encode(*data)[0], small.encode(*data)[0])


def test_digests(corpus, nothing):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    want = []
    for r in corpus.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.digests(corpus, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.digests(nothing, path).collect() == []


def test_columns_pass_through(corpus):
    path = public_tokenizers.path(FILES[0])
    docs = corpus.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    back = bpe.decode(bpe.encode(docs, path), path)
    assert sorted(back.columns) == ["decoded", "doc_id", "ids", "n_chars", "text"]
    assert all(r.decoded == (r.text or "") for r in back.collect())
