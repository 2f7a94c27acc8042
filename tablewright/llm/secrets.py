"""Secret scans: broad candidate patterns, and a random forest that takes out false positives.

Candidates are values assigned to a name like `password`, `DB_PASSWORD`, `client_secret` or `accessToken`,
passwords in URLs, credentials of Authorization headers, long runs of letters, digits and `+ / _ -` with a
digit, and private key blocks. The forest sees each candidate's length, character
transitions (changes of class, and how usual its letter pairs are), how much of it dictionary words cover,
the path it came from or stands in, and the words around it. It is trained from labelled findings: candidates
with the verdict of a reviewer. `label_findings` stands in for reviewers: provider formats, random values
assigned to secret names or beside them, and credentials in URLs and headers are findings, numbers, checksums, identifiers, paths and placeholders are not;
made-up findings of both sorts widen the sample, so that the forest knows what a corpus lacks.

Dictionary and letter pairs are counted over all documents. A dictionary word stands in `WORD_SHARE` of them
(and in `WORD_DOCS`), so there are at most as many as a document has different words on average, divided by
that share; a letter pair that makes up less than `PAIR_SHARE` of all counts as unseen, so at most 1 /
`PAIR_SHARE` are kept. Only the forest is fitted on a bounded sample (`SAMPLE_FINDINGS`, chosen by hash).
Candidates are searched in whole texts. Positions count code points. Null and empty texts have no
candidates; overlapping ones don't occur. Repeated rows give repeated findings. Extra columns pass through.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.flat import give_back, slices
from tablewright.session import materialize

SAMPLE_FINDINGS = 4000
WORD_DOCS, WORD_SHARE, PAIR_SHARE = 3, 1e-4, 1e-6
# Words that a task counts before it hands on what it has.
HELD_WORDS = 500_000
TREES, DEPTH, LEAF = 40, 8, 3

# Names whose values are secrets, prefixes that providers give theirs, words before other long values, words
# of placeholders and of paths to samples (fixed values).
NAMES = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?)"
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ")
OTHER_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "uuid", "id", "card", "order", "phone", "version", "build", "ref")
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "dummy", "sample", "xxxx", "redacted", "12345678", "todo", "none", "null")
SAMPLE_PATHS = ("test", "example", "fixture", "sample", "mock", "doc")

# A name stands alone, or is joined to other words by `_`, `-`, `.` or a capital. Of several names in one the
# last counts, so no part is read twice. The letters that names begin with are only asked for to save time.
_NAME_BEGINS = r"(?=[pstac][aweorpcu])(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"
_NAME_ENDS = r"(?![A-Za-z0-9])"
_MORE = r"(?:[_.\-](?!" + NAMES + _NAME_ENDS + r")[A-Za-z0-9]+)*+"
CANDIDATE = re.compile(
    # Up to the next such line, whatever it is: no part of a text is read for two beginnings.
    r"(?P<block>-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]*PRIVATE KEY-----)"
    r"|(?i:" + _NAME_BEGINS + r"(?P<name>" + NAMES + r")" + _NAME_ENDS + _MORE + r")[\"']?\s*[:=]\s*[\"']?(?i:(?:bearer|basic)[ \t]+)?(?P<value>[^\s\"']{6,})"
    r"|://[^\s/:@\"']*:(?P<url>[^\s/@\"']+)@"
    r"|(?i:\bbearer|\bauthorization[\"']?\s*[:=]\s*[\"']?(?:basic|token))[ \t]+(?P<header>[A-Za-z0-9._~+/\-]{8,}={0,2})"
    r"|(?<![A-Za-z0-9+/_\-])(?P<bare>(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2})(?![A-Za-z0-9+/_\-])"
)
_SECRET_NAME = re.compile(r"(?i:" + _NAME_BEGINS + NAMES + _NAME_ENDS + r")")
_OTHER_NAME = re.compile(r"(?i:(?<![A-Za-z0-9])(?:" + "|".join(OTHER_WORDS) + r")(?![A-Za-z0-9]))")
# Where a digit follows a letter or a letter a digit: often in random values, seldom in names and paths.
_CHANGES = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_WORDS = re.compile(r"[^\W\d_]+")
# What stands between words, as Arrow writes it.
_BETWEEN = r"[^\p{L}\p{Nl}\p{No}]+"
_RUNS = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")

FEATURES = (
    "length",
    "entropy",
    "digits",
    "capitals",
    "symbols",
    "is_hex",
    "is_number",
    "transitions",
    "longest_run",
    "letter_pairs",
    "dictionary",
    "prefix",
    "assigned",
    "block",
    "in_path",
    "sample_path",
    "name_near",
    "other_word_near",
    "placeholder",
    "quoted",
    "changes",
    "credential",
)


def candidates(text: str) -> Iterator[tuple[int, str, str, str, str]]:
    """Start, kind, candidate, what stands before it on the line, and behind it."""
    for found in CANDIDATE.finditer(text):
        kind = found.lastgroup if found.lastgroup != "name" else "value"
        start, end = found.span(kind)
        before = text[max(0, start - 80) : start].rpartition("\n")[2]
        yield start, kind, text[start:end], before, text[end : end + 40].partition("\n")[0]


@dataclass
class Language:
    """What ordinary words look like."""

    words: frozenset[str]
    pairs: dict[str, float] = field(default_factory=dict)
    rare: float = -9.0

    @classmethod
    def of(cls, counts: dict[str, int], pairs: dict[str, int] | None = None, total: int = 0) -> Language:
        """From dictionary words and letter pairs, of `total` in all; without pairs they are those of the words."""
        if pairs is None:
            pairs = Counter()
            for word, n in counts.items():
                for a, b in zip(word, word[1:], strict=False):
                    pairs[a + b] += n
        total = total or sum(pairs.values()) or 1
        return cls(frozenset(counts), {p: math.log(n / total) for p, n in pairs.items()}, math.log(0.5 * max(1 / total, PAIR_SHARE)))

    def usual(self, text: str) -> float:
        """Mean logarithm of the frequencies of its letter pairs."""
        scores = [self.pairs.get(w[i : i + 2], self.rare) for w in _WORDS.findall(text.lower()) for i in range(len(w) - 1)]
        return sum(scores) / len(scores) if scores else self.rare

    def covered(self, text: str) -> float:
        """Share of the letters that dictionary words cover, longest first from the left."""
        total = done = 0
        for word in _WORDS.findall(text.lower()):
            total += len(word)
            at = 0
            while at < len(word):
                for end in range(min(len(word), at + 20), at + 2, -1):
                    if word[at:end] in self.words:
                        done += end - at
                        at = end
                        break
                else:
                    at += 1
        return done / total if total else 0.0


def nearest_name(before: str) -> str:
    """Which sort of name comes last in the few words before a candidate: secret, other or none ('')."""
    beside = before[-40:]
    at = {sort: max((m.end() for m in name.finditer(beside)), default=-1) for sort, name in (("secret", _SECRET_NAME), ("other", _OTHER_NAME))}
    if max(at.values()) < 0:
        return ""
    return "secret" if at["secret"] >= at["other"] else "other"


def features(kind: str, text: str, before: str, behind: str, path: str, language: Language) -> list[float]:
    n = len(text)
    counts = Counter(text)
    runs = _RUNS.findall(text)
    near = nearest_name(before)
    lower = text.lower()
    token = before[-1:] in ("/", ":", ".") or behind[:1] in ("/", ".") and behind[1:2].strip() != ""
    return [
        float(n),
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(c.isdigit() for c in text) / n,
        sum(c.isupper() for c in text) / n,
        sum(not c.isalnum() for c in text) / n,
        float(_HEX.fullmatch(text) is not None),
        float(text.isdigit()),
        (len(runs) - 1) / n,
        max(map(len, runs)) / n,
        language.usual(text),
        language.covered(text),
        float(text.startswith(PREFIXES)),
        float(kind == "value"),
        float(kind == "block"),
        float(token or text.count("/") > 1),
        float(any(p in path.lower() for p in SAMPLE_PATHS)),
        float(near == "secret"),
        float(near == "other"),
        float(any(p in lower for p in PLACEHOLDERS)),
        float(before[-1:] in ("'", '"')),
        len(_CHANGES.findall(text)) / n,
        float(kind in ("url", "header")),
    ]


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, left, right, share of findings; `roots` begins each."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    roots: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(DEPTH + 1):
                split = self.feature[at]
                inner = split >= 0
                if not inner.any():
                    break
                down = rows[np.arange(len(rows)), np.maximum(split, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(down, self.left[at], self.right[at]), at)
            total += self.share[at]
        return total / max(len(self.roots), 1)


def fit_forest(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Forest:
    """A random forest: bootstrap samples, a random square root of the features at each split, Gini impurity."""
    draw = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    roots = []
    tried = max(1, round(math.sqrt(rows.shape[1])))

    def grow(at: np.ndarray, level: int) -> int:
        me = len(nodes)
        share = labels[at].mean()
        nodes.append([-1, 0.0, -1, -1, share])
        if level == depth or len(at) < 2 * LEAF or share in (0, 1):
            return me
        best = (share * (1 - share) * len(at) - 1e-12, -1, 0.0)
        for f in draw.permutation(rows.shape[1])[:tried]:
            order = np.argsort(rows[at, f], kind="stable")
            value, hit = rows[at, f][order], np.cumsum(labels[at][order])
            n = np.arange(1, len(at))
            cut = (value[1:] > value[:-1]) & (n >= LEAF) & (n <= len(at) - LEAF)
            if not cut.any():
                continue
            a, b = hit[:-1], hit[-1] - hit[:-1]
            impurity = np.where(cut, a * (1 - a / n) + b * (1 - b / (len(at) - n)), np.inf)
            i = int(impurity.argmin())
            if impurity[i] < best[0]:
                # Between neighbouring floats the mean may be the upper one.
                middle = (value[i] + value[i + 1]) / 2
                best = (impurity[i], int(f), middle if middle < value[i + 1] else value[i])
        if best[1] >= 0:
            down = rows[at, best[1]] <= best[2]
            nodes[me][:2] = [best[1], best[2]]
            nodes[me][2] = grow(at[down], level + 1)
            nodes[me][3] = grow(at[~down], level + 1)
        return me

    for _ in range(trees):
        roots.append(grow(draw.integers(0, len(rows), len(rows)), 0))
    table = np.array(nodes)
    whole = [table[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Forest(whole[0], table[:, 1], whole[1], whole[2], table[:, 4], np.array(roots))


def label_findings(kind: str, text: str, before: str) -> bool:
    """The verdict of a reviewer who knows provider formats and reads what stands before the candidate."""
    lower = text.lower()
    if any(p in lower for p in PLACEHOLDERS):
        return False
    if kind == "block":
        return True
    mixed = any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
    if text.startswith(PREFIXES) and mixed and len(text) >= 16:
        return True
    if kind == "url":
        return len(text) >= 6 and len(set(text)) >= 4 and not text.isdigit() and text[0] not in "${<%[" and not _SECRET_NAME.fullmatch(text)
    if kind == "header":
        return mixed and len(set(text)) >= 6
    if kind == "bare":
        # A random value: many different characters, digits and letters that change often.
        random_value = len(set(text)) >= 8 and len(_CHANGES.findall(text)) >= max(3, len(text) / 8)
        return random_value and nearest_name(before) == "secret"
    return kind == "value" and mixed and len(text) >= 8 and len(set(text)) >= 6


def made_up(seed: int = 11, n: int = 60) -> list[tuple[str, bool]]:
    """Lines with findings and with what looks like them."""
    draw = random.Random(seed)
    digits, hexes = "0123456789", "0123456789abcdef"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alnum = upper + upper.lower() + digits

    def some(letters: str, k: int) -> str:
        return "".join(draw.choice(letters) for _ in range(k))

    lines = []
    for _ in range(n):
        uuid = "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12))
        lines += [
            (f"key AKIA{some(upper + '234567', 16)} in use", True),
            (f"password={some(hexes, draw.randint(10, 32))} next", True),
            (f'token = "{some(hexes, 40)}"', True),
            (f"api_key: {some(alnum, 32)}", True),
            (f"secret='{some(alnum + '+/', 44)}'", True),
            (f"push with ghp_{some(alnum, 36)} now", True),
            (f"-----BEGIN RSA PRIVATE KEY-----\n{some(alnum + '+/', 256)}\n-----END RSA PRIVATE KEY-----", True),
            (f"export DB_PASSWORD={some(alnum, draw.randint(9, 14))}", True),
            (f'"refreshToken": "{some(alnum, draw.randint(16, 40))}",', True),
            (f"redis://cache:{some(alnum, draw.randint(8, 20))}@10.0.0.1:6379", True),
            (f"the bearer {some(alnum, draw.randint(20, 60))} was sent", True),
            (f"our secret is {some(draw.choice([alnum, hexes]), draw.randint(20, 44))} now", True),
            (f"token {some(alnum + '+/', 40)}", True),
            (f"http://{{user}}:{draw.choice(['${PASS}', '<password>', 'password', '%s', 'secret', 'changeme'])}@host.example", False),
            (f"the secret of /srv/data/part-{some(digits, 5)}/file_{some(digits, 3)}-final", False),
            (f"token at commit {some(hexes, 40)}", False),
            ("bearer " + draw.choice(["certificates", "instruments", "securities", "authentication"]), False),
            ("max-token-count: " + draw.choice(["unlimited", "409600", "1000000", "default"]), False),
            (f"see commit {some(hexes, 40)} for it", False),
            (f"sha256 {some(hexes, 64)} file", False),
            (f"uuid {uuid} and", False),
            (f"card {some('3456', 1)}{some(digits, 15)} paid", False),
            (f"order id {some(digits, 20)} sent", False),
            ("password=" + draw.choice(["changeme", "example1", "your_password", "xxxxxxxx", "placeholder9"]), False),
            (f"AKIA{some(upper, 6)}EXAMPLE{some(digits, 3)} in the manual", False),
            (f"path /srv/data/part-{some(digits, 5)}/file_{some(digits, 3)}-final", False),
            (f"call getUserNameById{some(digits, 1)}WithDefaultValue here", False),
            (f"http://host.example/{some(upper.lower(), 5)}/{some(digits, 6)}/{some(upper.lower(), 8)}-{some(digits, 4)}", False),
            ("token: " + draw.choice(["optional", "required", "string", "undefined"]), False),
        ]
    return lines


@dataclass
class Scanner:
    language: Language
    forest: Forest
    threshold: float = 0.5

    def findings(self, text: str, path: str) -> list[tuple[int, int, str, float]]:
        """Start, length, kind and score of every candidate."""
        found = list(candidates(text))
        if not found:
            return []
        rows = np.array([features(kind, value, before, behind, path, self.language) for _, kind, value, before, behind in found])
        scores = self.forest.score(rows).tolist()
        return [(start, len(value), kind, score) for (start, kind, value, _, _), score in zip(found, scores, strict=True)]


def _rows(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int, str, str]]:
    paths = batch.column(path).to_pylist() if path in batch.schema.names else [""] * batch.num_rows
    for i, (text, where) in enumerate(zip(batch.column("text").to_pylist(), paths, strict=True)):
        if text:
            yield i, text, str(where or "")


def language_of(docs: DataFrame) -> Language:
    """Dictionary and letter pairs by the number of documents that each word stands in, over all of `docs`."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Under '' the number of documents.
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches, max_bytes=1 << 20):
            lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(batch.column("text"), "")), _BETWEEN)
            found = lists.flatten()
            doc = pc.list_parent_indices(lists).to_numpy()
            size = pc.utf8_length(found)
            good = pc.and_(pc.greater(size, 2), pc.less_equal(size, 20))
            coded = found.filter(good).dictionary_encode()
            doc, n = doc[good.to_numpy(zero_copy_only=False)], max(len(coded.dictionary), 1)
            once = np.unique(doc.astype(np.int64) * n + coded.indices.to_numpy())
            counts.update(dict(zip(coded.dictionary.to_pylist(), np.bincount(once % n, minlength=n).tolist(), strict=False)))
            counts[""] += batch.num_rows
            if len(counts) > HELD_WORDS:
                yield handed_on()
                counts.clear()
            del lists, found, doc, size, good, coded, once
        yield handed_on()
        counts.clear()
        give_back()

    counts = docs.select("text").mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, label="words")
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    pairs = counts.where("word <> ''").select("word", "n", at.alias("at")).groupBy(F.expr("substr(word, at, 2)").alias("pair")).agg(F.sum("n").alias("n"))
    pairs = materialize(pairs, label="letter-pairs")
    n_docs = sum(r["n"] for r in counts.where("word = ''").collect())
    total = pairs.agg(F.sum("n").alias("n")).first()["n"] or 0
    dictionary = counts.where("word <> ''").where(F.col("n") >= max(WORD_DOCS, WORD_SHARE * n_docs)).collect()
    usual = pairs.where(F.col("n") >= PAIR_SHARE * total).collect()
    return Language.of({r["word"]: r["n"] for r in dictionary}, {r["pair"]: r["n"] for r in usual}, total)


def train(docs: DataFrame, path: str = "source", sample_findings: int = SAMPLE_FINDINGS, sample_chars: int = 8192) -> Scanner:
    """Dictionary and letter pairs from all of `docs`, the forest from a sample of findings and made-up ones.

    The sample is bounded in findings and in the characters of each, as it is labelled on the driver; longer
    candidates are scored all the same. Dictionary words have from 3 to 20 letters.
    """
    language = language_of(docs)
    names = ["kind", "text", "before", "behind", "path"]

    def all_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            rows = [(*c[1:], where) for _, text, where in _rows(batch, path) for c in candidates(text) if len(c[2]) <= sample_chars]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*rows, strict=True) if rows else [[]] * 5)], names=names)
            del rows
        give_back()

    columns = ["text", path] if path in docs.columns else ["text"]
    found = docs.select(*columns).mapInArrow(all_candidates, ", ".join(f"{n} string" for n in names)).distinct()
    found = found.orderBy(F.xxhash64(*names), *names).limit(sample_findings).collect()
    sample = [(*r, label_findings(r["kind"], r["text"], r["before"])) for r in found]
    for line, verdict in made_up():
        sample += [(kind, value, before, behind, "", verdict) for _, kind, value, before, behind in candidates(line)]
    rows = np.array([features(*s[:5], language) for s in sample])
    return Scanner(language, fit_forest(rows, np.array([float(s[5]) for s in sample])))


def scan(docs: DataFrame, scanner: Scanner, path: str = "source") -> DataFrame:
    """doc_id, start, length, kind, score, is_secret: one row per candidate."""
    names = ["doc_id", "start", "length", "kind", "score", "is_secret"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            rows = [(i, *f) for i, text, where in _rows(batch, path) for f in scanner.findings(text, where)]
            row, start, length, kind, score = zip(*rows, strict=True) if rows else [[]] * 5
            score = np.array(score, np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
                + [pa.array(kind, pa.string()), pa.array(score), pa.array(score > scanner.threshold)],
                names=names,
            )
        give_back()

    columns = [c for c in ("doc_id", "text", path) if c in docs.columns]
    return docs.select(*columns).mapInArrow(run, "doc_id long, start long, length long, kind string, score double, is_secret boolean")


def redact(docs: DataFrame, scanner: Scanner, path: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in the text replaced by `mark`."""

    def cleaned(text: str, where: str) -> str:
        parts, at = [], 0
        for start, length, _, score in scanner.findings(text, where):
            if score > scanner.threshold:
                parts += [text[at:start], mark]
                at = start + length
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            texts = batch.column("text").to_pylist()
            for i, text, where in _rows(batch, path):
                texts[i] = cleaned(text, where)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            del texts, columns
        give_back()

    return docs.mapInArrow(run, docs.schema)
