"""Operator 5: quality rules by line sequence labelling.

A linear-chain conditional random field labels each line of a document as content or boilerplate; Viterbi decoding
finds the best labels of the whole sequence, and the share of words in content lines decides whether the document
stays, after plain base rules.  The field is trained here, without given labels: lines of clear shape (and lines
that many of the sampled documents share) are its seeds, the labels of the rest are summed over in training.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

_SPACE, _SYMBOLS, _DIGITS = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b"0123456789"
#: Words that mark legal and navigation lines.
_NOTICE = ("license", "licensed", "copyright", "rights reserved", "cookie", "privacy policy", "terms of", "sign in", "click here", "subscribe")
FEATURES = (
    "1-2 words", "3-5 words", "6-15 words", "16 words or more", "ends a sentence", "some symbols", "many symbols", "bars", "capitals", "shouts",
    "digits", "seen above", "notice", "first", "last", "long words", "few different words", "no letters",
)
_AT = {name: 1 << k for k, name in enumerate(FEATURES)}


def line_features(text: str) -> tuple[list[int], list[int], list[str]]:
    """Feature bits, words and text of each line that has a word."""
    bits, sizes, kept, seen = [], [], [], set()
    for line in text.split("\n"):
        data = line.encode()
        words = data.split()
        n = len(words)
        if not n:
            continue
        chars = len(data) - data.count(b" ")
        b = 1 if n < 3 else 2 if n < 6 else 4 if n < 16 else 8
        tail = words[-1]
        if tail[-1:] in b".!?:;\"')" and tail[-1:]:
            b |= _AT["ends a sentence"]
        symbols = len(data) - len(data.translate(None, _SYMBOLS))
        if symbols * 50 > chars:
            b |= _AT["many symbols"] if symbols * 10 > chars else _AT["some symbols"]
        if data.count(b"|") * 5 > n:
            b |= _AT["bars"]
        if line.isupper() and chars > 3:
            b |= _AT["capitals"]
        if data.count(b"!") * 3 > n:
            b |= _AT["shouts"]
        if (len(data) - len(data.translate(None, _DIGITS))) * 4 > chars:
            b |= _AT["digits"]
        if line in seen:
            b |= _AT["seen above"]
        seen.add(line)
        if n < 40 and any(x in (low := line.lower()) for x in _NOTICE):
            b |= _AT["notice"]
        if chars > 14 * n:
            b |= _AT["long words"]
        if n > 5 and len(set(words)) * 5 < n * 2:
            b |= _AT["few different words"]
        if not any(c.isalpha() for c in line[:200]) and not any(c.isalpha() for c in line):
            b |= _AT["no letters"]
        bits.append(b)
        sizes.append(n)
        kept.append(line)
    if bits:
        bits[0] |= _AT["first"]
        bits[-1] |= _AT["last"]
    return bits, sizes, kept


_BAD = _AT["many symbols"] | _AT["bars"] | _AT["shouts"] | _AT["notice"] | _AT["few different words"] | _AT["no letters"]


def seed(bits: int, common: bool) -> int:
    """1: surely content, 0: surely boilerplate, -1: not told by its shape."""
    if bits & _BAD or bits & _AT["seen above"] and bits & 7 or common and bits & 7:
        return 0
    if bits & _AT["ends a sentence"] and bits & 12 and not bits & (_AT["capitals"] | _AT["digits"] | _AT["some symbols"] | _AT["seen above"]):
        return 1
    return -1


@dataclass(frozen=True)
class LineField:
    """Content weights of the features (boilerplate has none) and transition scores [from][to]."""

    weights: tuple[float, ...]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, bits: list[int], memo: dict[int, float]) -> list[int]:
        """Viterbi: the best sequence of labels, 1 for content."""
        (stay0, up), (down, stay1) = self.moves
        s0, s1, back = 0.0, 0.0, []
        for k, b in enumerate(bits):
            e = memo.get(b)
            if e is None:
                e = memo[b] = sum(w for j, w in enumerate(self.weights) if b >> j & 1)
            if k:
                from0, from1 = s1 + down > s0 + stay0, s1 + stay1 >= s0 + up
                s0, s1 = (s1 + down if from0 else s0 + stay0), (s1 + stay1 if from1 else s0 + up) + e
                back.append((from0, from1))
            else:
                s1 = e
        out = [int(s1 >= s0)] if bits else []
        for from0, from1 in reversed(back):
            out.append(int(from1 if out[-1] else from0))
        return out[::-1]


def train(texts: list[str], rounds: int = 90, longest: int = 200, most_pieces: int = 4000, ridge: float = 1e-3) -> LineField:
    """Maximum likelihood with the labels of unseeded lines summed out, by Adam on padded sequences.

    A document of more than ``longest`` lines is cut into pieces of that, each a sequence of its own.  Of more than
    ``most_pieces`` sequences those at even steps are trained on, which bounds the driver's arrays.
    """
    docs = [d for d in map(line_features, texts) if d[0]]
    if not docs:
        return LineField((1.0,) * 4 + (0.0,) * (len(FEATURES) - 4), ((1.0, 0.0), (0.0, 1.0)))
    shared = Counter(line for d in docs for line in set(d[2]))
    common = {x for x, n in shared.items() if n >= max(3, len(docs) // 200)}
    docs = [[x[at : at + longest] for x in d] for d in docs for at in range(0, len(d[0]), longest)]
    docs = docs[:: -(-len(docs) // most_pieces)]
    top, n = max(len(d[0]) for d in docs), len(docs)
    x, lab, here = np.zeros((top, n, len(FEATURES))), np.full((top, n), -1), np.zeros((top, n), bool)
    for i, (bits, _, lines) in enumerate(docs):
        for t, (b, line) in enumerate(zip(bits, lines)):
            x[t, i] = [b >> j & 1 for j in range(len(FEATURES))]
            lab[t, i] = seed(b, line in common)
            here[t, i] = True
    w, a = np.zeros(len(FEATURES)), np.eye(2)
    m = [np.zeros_like(w), np.zeros_like(a)]
    v = [np.zeros_like(w), np.zeros_like(a)]
    total = here.sum()

    def expect(clamped: bool) -> tuple[np.ndarray, np.ndarray]:
        """Expected content features and transitions a line, over all labels or over those that agree with the seeds."""
        e = np.stack([np.zeros((top, n)), x @ w], axis=2)
        if clamped:
            e = e + np.where((lab >= 0)[..., None] & (np.arange(2) != lab[..., None]), -1e3, 0.0)
        fwd, bwd = np.zeros((top, n, 2)), np.zeros((top, n, 2))
        fwd[0] = e[0]
        for t in range(1, top):
            fwd[t] = np.where(here[t][:, None], np.logaddexp(fwd[t - 1][:, :1] + a[0], fwd[t - 1][:, 1:] + a[1]) + e[t], fwd[t - 1])
        for t in range(top - 2, -1, -1):
            s = e[t + 1] + bwd[t + 1]
            bwd[t] = np.where(here[t + 1][:, None], np.logaddexp(a[:, 0] + s[:, :1], a[:, 1] + s[:, 1:]), 0.0)
        z = np.logaddexp(fwd[-1][:, 0], fwd[-1][:, 1])
        content = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z) * here
        moves = np.zeros((2, 2))
        for i in range(2):
            for j in range(2):
                moves[i, j] = (np.exp(fwd[:-1, :, i] + a[i, j] + e[1:, :, j] + bwd[1:, :, j] - z) * here[1:]).sum()
        return np.tensordot(content, x, 2) / total, moves / total

    for k in range(1, rounds + 1):
        (f1, t1), (f0, t0) = expect(True), expect(False)
        for p, g, q, r in zip((w, a), (f1 - f0 - ridge * w, t1 - t0 - ridge * a), m, v):
            q += 0.1 * (g - q)
            r += 0.001 * (g * g - r)
            p += 0.1 * (q / (1 - 0.9**k)) / (np.sqrt(r / (1 - 0.999**k)) + 1e-8)
    return LineField(tuple(map(float, w)), tuple(tuple(map(float, r)) for r in a))


def fit_lines(docs: DataFrame, most: int = 1000) -> LineField:
    """Trains on a bounded sample: the ``most`` documents whose ids hash lowest."""
    known = docs.select("doc_id", "text").dropna()
    picked = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = known.join(F.broadcast(picked), "doc_id").collect()  # ``most`` ids
    return train([r.text for r in sorted(rows, key=lambda r: (r.doc_id, r.text))])


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window that the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
        code = pair[:-1] * len(ids) + w[2:]
    else:
        code = pair[:-1] * len(ids) + w[2:]
    order = np.argsort(code, kind="stable")
    same = np.diff(code[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(code), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : len(words) - 2 + k] |= twice
    return int(hit.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()
    spaces = len(data) - len(data.translate(None, _SPACE))
    lines = [x for x in data.split(b"\n") if x.split()]
    return len(words), len(text) - spaces, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def label_lines(docs: DataFrame, field: LineField, least_share: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, content_words, n_lines, n_content_lines, labels (a bit a line), kept.

    Null and empty texts have no words and fail.  Lines without a word get no label.  Repeated rows stay; other
    columns are not read; an empty table gives an empty result.  Whole texts, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[int, float] = {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                n, chars, symbols, dups, repeats = base_counts(text)
                bits, sizes, _ = line_features(text)
                labels = field.decode(bits, memo)
                content = sum(s for s, y in zip(sizes, labels) if y)
                failed = n < 50 or 100 * repeats > 50 * n
                rows.append((doc_id, n, chars, symbols, dups, repeats, failed, content, len(labels), sum(labels), labels, not failed and content >= least_share * n))
            cols = list(zip(*rows)) or [[]] * 12
            kinds = (pa.int64(),) * 6 + (pa.bool_(),) + (pa.int64(),) * 3 + (pa.list_(pa.int8()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in LABELLED.split(", ")])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, LABELLED)


LABELLED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, n_lines long, n_content_lines long, labels array<tinyint>, kept boolean"


def op5_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label_lines(docs, fit_lines(docs)).drop("labels")
