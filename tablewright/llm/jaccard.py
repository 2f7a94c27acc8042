"""N-gram Jaccard join by a blocked sparse matrix product.

Documents by n-grams is a sparse matrix of zeros and ones; its product with its own transpose holds the number of
n-grams that two documents share. Two documents link when their Jaccard similarity is at least `percent`: the
shared n-grams must come to percent / (100 + percent) of both sizes together, and neither size may be below
percent of the other.

Only blocks of the product that can hold a link are computed. Sizes say how much two linked sets differ at most:
d n-grams. So the columns are dealt into d + 1 parts and some to spare, by a hash of the n-gram: linked sets
are equal in one part at least, one that is not empty. (Parts that are empty in both count as equal too; a set
with more empty parts than there are to spare takes part with its empty ones, so no link is lost.) Sets that are
equal in a part form a row block, named by the least of them. Parts depend on the size, so sets are compared in
classes of size; a set also joins the next class when it can reach a set there.

In each cell (two pieces of a row block, bounded in rows and n-grams) the product is accumulated: frequent
columns as slabs of dense matrices, the others entry by entry, rows in strips against those rows whose size
allows a link; pairs below the bound are discarded inside the cell. A cell hands on a spanning forest of its
links, at most one row for each row it has, and for each row how many documents it is linked with (a pair that
meets in several blocks is counted in the first). So no group of copies, however large, becomes pairs.

Words are `[^\x20\x09-\x0D]+` after A-Z became a-z. Sets are known by 128 bits of hashes, n-grams by 64. Equal
sets are one row of the matrix. Texts with fewer words than an n-gram have one, the whole sequence; null and
empty texts have none, link with nothing and are components of their own. Rows repeated, or of equal or null
doc_id, are rows of their own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.components import components
from tablewright.llm.flat import flat_text, gather, mixed, rolling_hash, slices, span_hash, word_spans
from tablewright.llm.substring import packed, release, unpacked
from tablewright.session import materialize

SHINGLE, PERCENT = 3, 90
# Rows and n-grams of a piece at most, rows of a strip, columns of a slab, entries expanded at once.
ROWS, GRAMS, STRIP, SLAB, ENTRIES = 4096, 1 << 20, 1024, 1024, 1 << 21

_ONE, _TWO, _THREE, _FOUR = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_HALF = np.uint64(32)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each different n-gram of each text, in order."""
    data = np.where(data - np.uint8(0x41) < 26, data | np.uint8(0x20), data)
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(data, starts, ends)
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    at = np.flatnonzero(np.arange(len(words)) + width <= first[1:][doc]) if len(words) else np.zeros(0, np.int64)
    owner, code = [doc[at]], [rolling_hash(words, width)[at] if len(at) else np.zeros(0, np.uint64)]
    for n in range(1, width):  # the whole sequence, where there are fewer words
        short = np.flatnonzero(size == n)
        if len(short):
            owner.append(short)
            code.append(mixed(rolling_hash(words, n)[first[:-1][short]] + np.uint64(n)))
    owner, code = np.concatenate(owner), np.concatenate(code)
    order = np.argsort(code)
    small = np.uint16 if len(size) < 1 << 16 else np.int64  # Numbers of 16 bits are sorted by radix.
    order = order[np.argsort(owner[order].astype(small), kind="stable")]
    owner, code = owner[order], code[order]
    if len(code):
        new = np.r_[True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]
        owner, code = owner[new], code[new]
    return owner, code


class Classes:
    """Classes of size; for each the number of parts its sets are dealt into (0: only equal sets link)."""

    def __init__(self, percent: int) -> None:
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(-(-bounds[-1] * 3 // 2))
        self.percent = percent
        self.bounds = np.array(bounds, np.int64)
        differ = [2 * (b - 1) * (100 - percent) // (100 + percent) for b in bounds[1:]]
        self.spare = np.array([1 + d // 16 for d in differ], np.int64)
        self.parts = np.array([d + 1 + s if d else 0 for d, s in zip(differ, self.spare.tolist(), strict=True)], np.int64)

    def of(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each size, and the highest class it reaches."""
        return tuple(np.searchsorted(self.bounds, s, side="right") - 1 for s in (size, size * 100 // self.percent))


def parts(owner: np.ndarray, code: np.ndarray, size: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each part of the texts' sets."""
    own, highest = classes.of(size)
    spread, content = mixed(code + _ONE) >> _HALF, mixed(code + _TWO)
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for step in range(int((highest - own).max(initial=-1)) + 1):
        level = own + step
        count = np.where((size > 0) & (level <= highest), classes.parts[np.minimum(level, len(classes.parts) - 1)], 0)
        offset = np.r_[0, np.cumsum(count)]
        inside = count[owner] > 0
        part = (spread[inside] * count[owner[inside]].astype(np.uint64)) >> _HALF
        slot = offset[owner[inside]] + part.astype(np.int64)
        sums, filled = np.zeros(int(offset[-1]), np.uint64), np.zeros(int(offset[-1]), bool)
        np.add.at(sums, slot, content[inside])
        filled[slot] = True
        text = np.repeat(np.arange(len(size)), count)
        empty = np.bincount(text[~filled], minlength=len(size))
        kept = filled | (empty > classes.spare[level])[text]
        number = (np.arange(len(text)) - offset[text]).astype(np.uint64) | (level[text].astype(np.uint64) << _HALF)
        owners.append(text[kept])
        hashes.append(mixed(sums + mixed(number + _THREE))[kept])
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    return owners[order], hashes[order]


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def _sets(docs: DataFrame, percent: int, width: int, with_parts: bool) -> DataFrame:
    """doc_id, x (a hash of the text), n (n-grams), one and two (hashes of the set), and parts if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(percent)
        for batch in slices(batches):
            owner, code = shingles(*flat_text(batch.column("text")), width)
            n = batch.num_rows
            size = np.bincount(owner, minlength=n)
            keys = []
            for salt in (_THREE, _FOUR):
                key = size.astype(np.uint64)
                np.add.at(key, owner, mixed(code + salt))
                keys.append(pa.array(mixed(key).view(np.int64)))
            columns, names = [batch.column("doc_id"), batch.column("x"), pa.array(size, pa.int64()), *keys], ["doc_id", "x", "n", "one", "two"]
            if with_parts:
                columns, names = [*columns, _lists(*parts(owner, code, size, classes), n)], [*names, "parts"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("x"), "text")
    return keyed.mapInArrow(run, "doc_id long, x long, n long, one long, two long" + (", parts array<long>" if with_parts else ""))


def overlaps(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], nl: int, nr: int) -> np.ndarray:
    """The product: shared entries of nl rows with nr rows. A side is (row, column) of its different entries."""
    total = np.zeros((nl, nr), np.int32)
    columns = np.intersect1d(left[1], right[1])
    if not len(columns):
        return total
    sides = []
    for row, column in (left, right):
        at = np.searchsorted(columns, column)
        known = columns[np.minimum(at, len(columns) - 1)] == column
        row, at = row[known], at[known]
        order = np.argsort(at, kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(at, minlength=len(columns)))]
        sides.append((row[order], ends))
    (rows_l, ends_l), (rows_r, ends_r) = sides
    n_l, n_r = np.diff(ends_l), np.diff(ends_r)
    frequent = n_l * n_r * 32 > nl * nr
    for a in range(0, int(frequent.sum()), SLAB):
        slab = np.flatnonzero(frequent)[a : a + SLAB]
        dense = []
        for rows, ends, count, n in ((rows_l, ends_l, n_l, nl), (rows_r, ends_r, n_r, nr)):
            matrix = np.zeros((n, len(slab)), np.float32)
            matrix[rows[gather(ends[slab], count[slab])], np.repeat(np.arange(len(slab)), count[slab])] = 1
            dense.append(matrix)
        total += (dense[0] @ dense[1].T).astype(np.int32)
    rare = np.repeat(~frequent, n_l)
    rows, column = rows_l[rare], np.repeat(np.arange(len(columns)), n_l)[rare]
    work = np.cumsum(n_r[column])
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + ENTRIES, side="right")))
        count = n_r[column[a:b]]
        place = np.repeat(rows[a:b] * nr, count) + rows_r[gather(ends_r[column[a:b]], count)]
        np.add.at(total.ravel(), place, 1)
        a = b
    return total


class Side:
    """Some rows of a cell: their sets, and the row blocks they are in, as (row, entry) pairs."""

    def __init__(self, table: pa.Table, before: int, width: int) -> None:
        order = np.argsort(table["n"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        self.id, self.n, self.copies = (table[c].to_numpy() for c in ("id", "n", "copies"))
        pivots = table["pivots"].to_pylist()
        row, pivot = np.repeat(np.arange(len(pivots)), [len(p) for p in pivots]), np.array([x for p in pivots for x in p], np.int64)
        self.entries = {"grams": _grams(table["_text"], width), "pivots": (row[pivot < before], pivot[pivot < before])}

    def __len__(self) -> int:
        return len(self.id)

    def rows(self, name: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        row, value = self.entries[name]
        a, b = np.searchsorted(row, (a, b))
        return row[a:b], value[a:b]


def _grams(packed_texts: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each n-gram of compressed texts, a few megabytes of text at a time."""
    rows, codes, before = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    batches = pa.table([packed_texts], names=["_text"]).to_batches()
    for batch in unpacked(iter(batches)):
        row, code = shingles(*flat_text(batch.column("text")), width)
        rows.append(row + before)
        codes.append(code)
        before += batch.num_rows
    return np.concatenate(rows), np.concatenate(codes)


def linked(left: Side, right: Side, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows link, and which pairs have not met in an earlier row block (left by right)."""
    links, fresh = np.zeros((len(left), len(right)), bool), np.ones((len(left), len(right)), bool)
    for a in range(0, len(left), STRIP):
        b = min(a + STRIP, len(left))
        c, d = np.searchsorted(right.n, (-(-left.n[a] * percent // 100), left.n[b - 1] * 100 // percent + 1))
        if c == d:
            continue
        strip = []
        for name in ("grams", "pivots"):
            (row_l, value_l), (row_r, value_r) = left.rows(name, a, b), right.rows(name, c, d)
            strip.append(overlaps((row_l - a, value_l), (row_r - c, value_r), b - a, d - c))
        both = left.n[a:b, None] + right.n[None, c:d]
        links[a:b, c:d] = (100 + percent) * strip[0].astype(np.int64) >= percent * both
        fresh[a:b, c:d] = strip[1] == 0
    return links, fresh


def forest(links: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Edges (left, right) that connect what the links connect, no more than there are rows."""
    nl, nr = links.shape
    found: list[tuple[int, int]] = []
    across = np.ascontiguousarray(links.T)
    left, right = np.ones(nl, bool), np.ones(nr, bool)
    if same:
        right = left
    for begin in range(nl):
        if not left[begin]:
            continue
        left[begin] = False
        going = [(begin, True)]
        while going:
            at, is_left = going.pop()
            free = right if is_left else left
            new = np.flatnonzero((links if is_left else across)[at] & free)
            free[new] = False
            found += [(at, x) if is_left else (x, at) for x in new.tolist()]
            going += [(x, same or not is_left) for x in new.tolist()]
    return found


def _cell(percent: int, width: int):
    def product(key: tuple, table: pa.Table) -> pa.Table:
        pivot, i, j = (k.as_py() for k in key)
        block = table["block"].to_numpy()
        left = Side(table.take(pa.array(np.flatnonzero(block == i))), pivot, width)
        right = left if i == j else Side(table.take(pa.array(np.flatnonzero(block == j))), pivot, width)
        links, fresh = linked(left, right, percent)
        if i == j:
            np.fill_diagonal(links, False)
        edges = np.array(forest(links, i == j), np.int64).reshape(-1, 2)
        fresh &= links
        counts = [(left.id, fresh.astype(np.int64) @ right.copies)]
        if i != j:
            counts.append((right.id, fresh.T.astype(np.int64) @ left.copies))
        node, count = (np.concatenate(x) for x in zip(*counts, strict=True))
        node, count = node[count > 0], count[count > 0]
        u, v = left.id[edges[:, 0]], right.id[edges[:, 1]]
        # Edges have two nodes, numbers of links one.
        is_count = np.r_[np.zeros(len(u), bool), np.ones(len(node), bool)]
        columns = [pa.array(np.r_[u, node]), pa.array(np.r_[v, node], mask=is_count), pa.array(np.r_[v, count], mask=~is_count)]
        return pa.table(columns, names=["u", "v", "links"])

    return product


def join(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links reach), n_links: one row per document."""
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    spark = docs.sparkSession
    every = materialize(_sets(docs, percent, width, False), label="sets")
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "x")
    # The parts are a tenth of all n-grams; computing the sets again is cheaper than keeping those of copies.
    nodes = _sets(docs, percent, width, True).where("n > 0").groupBy("one", "two").agg(F.min_by(F.struct("doc_id", "x", "n", "parts"), order).alias("row"), F.count("*").alias("copies"))
    nodes = materialize(nodes.select(F.monotonically_increasing_id().alias("id"), "one", "two", "copies", "row.*"), label="nodes")
    release(spark)
    entries = nodes.select("id", "n", F.explode("parts").alias("part"))
    # Written first: behind an aggregation in the same stage Spark could not split the join on a part that many
    # sets have.
    blocks = materialize(entries.groupBy("part").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).where("size > 1"), label="parts")
    members = materialize(entries.join(blocks, "part").select("pivot", "id", "n").distinct(), label="members")
    release(spark)
    pieces = F.greatest(F.ceil(F.count("*") / ROWS), F.ceil(F.sum("n") / GRAMS)).cast("int")
    pieces = materialize(members.groupBy("pivot").agg(pieces.alias("pieces")), label="pieces")
    texts = _texts(docs, every, nodes, members)
    mine = F.pmod(F.xxhash64("id"), "pieces").cast("int")
    # A row goes to the cells of its piece with every piece of the block.
    cells = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")))
    dealt = members.select("pivot", "id").join(pieces, "pivot").select("pivot", "id", mine.alias("block"), F.explode(cells).alias("cell"))
    dealt = dealt.select("pivot", "cell.i", "cell.j", "block", "id").join(texts, "id")
    found = dealt.groupBy("pivot", "i", "j").applyInArrow(_cell(percent, width), "u long, v long, links long")
    found = materialize(found, label="products")
    release(spark)
    label = components(found.where("v IS NOT NULL").select("u", "v"))
    degrees = found.where("v IS NULL").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    named = nodes.select("id", "one", "two", "copies", "doc_id").join(label.withColumnRenamed("node", "id"), "id", "left").join(degrees, "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    least = materialize(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), label="least")
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = materialize(named.join(least, "component").select("one", "two", "component_id", links), label="named")
    release(spark)
    filled = every.where("n > 0").select("doc_id", "n", "one", "two").join(named, ["one", "two"])
    filled = filled.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    alone = every.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return filled.unionAll(alone)


def _texts(docs: DataFrame, every: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """id, n, copies, pivots (the row blocks), _text (compressed) of all sets that share a block with another."""
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), F.col("x").alias("_x")]
    blocks = members.groupBy("id").agg(F.collect_list("pivot").alias("pivots"))
    chosen = materialize(nodes.select("id", *key, "n", "copies").join(blocks, "id"), label="chosen")
    keyed = docs.withColumn("x", F.xxhash64(F.coalesce("text", F.lit("")))).select(*key, "text")
    # What is chosen grows with the input, so it is not broadcast at any size.
    texts = packed(keyed, "_id", "_x").join(chosen.hint("merge"), ["_id", "_x"]).select("id", "n", "copies", "pivots", "_text")
    # Rows repeated as a whole are one set; where there are none, nothing has to be looked for.
    if not every.groupBy(*key).count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["id"])
    texts = materialize(texts, label="texts")
    release(docs.sparkSession)
    return texts
