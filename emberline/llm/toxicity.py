"""Operator 3: toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary texts and one on what toxic texts have of their own: the stretches
covered by grams of bytes that recur in toxic texts and hardly in ordinary ones.  Most of a toxic document is ordinary
text, and a dictionary trained on all of it tells the classes apart less.  No words are listed; a stretch ends where its
grams do.

Every window of a whole text (a word, lower-cased, in a frame of bytes that both dictionaries hold) is compressed with
each; its margin is the length with the ordinary dictionary less the length with the toxic one.  A document's evidence is
how many of its windows reach each of a few margins, and calibrated weights turn that into a score.  Wider windows mix
the few telling bytes with the noise of how prose happens to match: the README has figures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_worker, small_batches, table

#: Margins in bytes that windows are counted at.
LEVELS = (1, 2, 3, 4, 5, 6, 7, 8)
#: What stands around a window when it is compressed, known to both dictionaries: without it a few bytes of text
#: are stored as they are, whatever the dictionary, and a match could not begin in the last bytes.
_BEFORE, _AFTER = bytes(range(1, 32)) + bytes(range(128, 161)), bytes(range(161, 192))
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class _Margins(dict):
    """Margin of a chunk of text, found once per chunk."""

    def __init__(self, model: ToxicityModel, cap: int = 300_000):
        super().__init__()
        import zstandard

        make = lambda d: zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False).compress
        self.ordinary, self.toxic, self.cap = make(model.ordinary), make(model.toxic), cap

    def __missing__(self, chunk: str) -> int:
        window = b"%b %b %b" % (_BEFORE, chunk.strip(_TRIM).encode(), _AFTER)
        out = max(-1, min(len(self.ordinary(window)) - len(self.toxic(window)), LEVELS[-1]))
        self[chunk] = out
        return out


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.model, self.margins = model, _Margins(model)

    def evidence(self, text: str) -> list[float]:
        """For each level, the log of one plus the windows that reach it, and their share."""
        if len(self.margins) > self.margins.cap:
            self.margins.clear()
        found = list(map(self.margins.__getitem__, text.lower().split()))
        at = [0] * (LEVELS[-1] + 1)
        for k in range(1, LEVELS[-1] + 1):
            at[k] = found.count(k)
        out, n = [], max(1, len(found))
        for level in LEVELS:
            k = sum(at[level:])
            out += [math.log1p(k), math.sqrt(k / n)]
        return out

    def score(self, text: str) -> float:
        z = self.model.bias + sum(w * x for w, x in zip(self.model.weights, self.evidence(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _grams(text: bytes, n: int) -> np.ndarray:
    """Every n bytes in a row (at most 8) as a number."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(len(a) - n + 1, 0), np.uint64)
    for j in range(n):
        out = out << np.uint64(8) | a[j : j + len(out)]
    return out


def _shares(texts: list[str], most: int, piece: int = 4096) -> list[bytes]:
    """The texts in lower case; of those over an even share of ``most`` bytes, pieces spread evenly over all of the text."""
    share, out = max(piece, most // max(len(texts), 1)), []
    for text in texts:
        b = text.lower().encode()
        n = -(-len(b) // piece)
        if len(b) > share:
            b = b"\n".join(b[int(k) * piece : (int(k) + 1) * piece] for k in np.linspace(0, n - 1, share // piece))
        out.append(b)
    return out


def _telling(toxic: list[bytes], ordinary: list[bytes], lengths: tuple[int, ...], few: int, times: float) -> list[bytes]:
    """Distinct stretches of toxic texts, with a byte on either side, that telling grams cover.

    A gram tells if ``few`` toxic texts or more hold it, and ``times`` the share of ordinary texts that do.
    """

    def held(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(_grams(t, n)) for t in texts)]), return_counts=True)

    out: dict[bytes, None] = {}
    for n in lengths:
        (grams, count), (others, often) = held(toxic, n), held(ordinary, n)
        at = np.searchsorted(others, grams)
        there = np.append(others, np.uint64(2**64 - 1))[at] == grams
        expected = np.where(there, np.append(often, 0)[at], 0) + 0.5
        tells = np.append(grams[(count >= few) & (count * len(ordinary) >= times * expected * len(toxic))], np.uint64(2**64 - 1))
        for text in toxic:
            grams = _grams(text, n)
            at = np.flatnonzero(tells[np.searchsorted(tells, grams)] == grams)
            for run in np.split(at, np.flatnonzero(np.diff(at) > n) + 1) if len(at) else []:
                out[text[max(0, int(run[0]) - 1) : int(run[-1]) + n + 1]] = None
    return list(out)


def _dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Content of a trained dictionary, or the distinct samples themselves where they are too few to train on."""
    import zstandard

    try:
        content = zstandard.train_dictionary(size + 512, samples, k=k, d=d).as_bytes()[-size:]  # less the entropy tables
    except zstandard.ZstdError:
        content = b" ".join(dict.fromkeys(samples))[:size]
    return content + _BEFORE + _AFTER


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> np.ndarray:
    """Ridge logistic weights by Newton's method, the bias last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    toxic: list[str], ordinary: list[str], toxic_bytes: int = 4 << 10, ordinary_bytes: int = 48 << 10, lengths: tuple[int, ...] = (5, 8), few: int = 4, times: float = 6.0, most_bytes: int = 16 << 20
) -> ToxicityModel:
    """Dictionaries from distinct texts, then weights on the evidence; a constant score if a class is empty.

    ``toxic_bytes`` and ``ordinary_bytes`` are the dictionaries' sizes; ``lengths``, ``few`` and ``times`` say which grams
    tell.  ``most_bytes`` bounds what the dictionaries of a class are trained on; every text gives an even share.  The
    weights are fitted on whole texts.
    """
    import random

    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    plain = _shares(ordinary, most_bytes)
    stretches = _telling(_shares(toxic, most_bytes), plain, lengths, few, times) if plain else []
    if not stretches:
        return ToxicityModel(_BEFORE + _AFTER, _BEFORE + _AFTER, (0.0,) * 2 * len(LEVELS), -30.0 if not toxic else math.log((len(toxic) + 0.5) / (len(ordinary) + 0.5)))
    random.Random(7).shuffle(stretches)  # training reads samples in turn, so their order must not follow the texts
    bad = _dictionary([b" ".join(stretches[k : k + 8]) for k in range(0, len(stretches), 8)], toxic_bytes, 32, 6)
    good = _dictionary([t[k : k + 256] for t in plain for k in range(0, len(t), 256)], ordinary_bytes, 64, 8)
    model = ToxicityModel(bad, good, (0.0,) * 2 * len(LEVELS), 0.0)
    scorer = model.scorer()
    x = np.array([scorer.evidence(t) for t in toxic + ordinary])
    w = _logistic(x, np.array([1.0] * len(toxic) + [0.0] * len(ordinary)))
    return ToxicityModel(model.toxic, model.ordinary, tuple(map(float, w[:-1])), float(w[-1]))


def held_out(doc_id) -> F.Column:
    """Rows whose crc32 of the id as text is divisible by 5; never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """At most ``most`` labelled documents of each class, the ones whose ids hash lowest; held-out rows never.

    A document with several labels has the largest; without a label, an id or a text it is not taken.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")).filter(~held_out("doc_id"))
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = known.filter("label = 1").orderBy(*order).limit(most).union(known.filter("label = 0").orderBy(*order).limit(most))
    return docs.select("doc_id", *columns).join(F.broadcast(picked), "doc_id").dropna()  # 2 x most rows of two numbers


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = 3000) -> ToxicityModel:
    """Fits on a bounded sample: at most ``most`` labelled documents a class reach the driver."""
    rows = labelled_sample(docs, labels, "toxic", most).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return fit([r.text for r in rows if r.label == 1], [r.text for r in rows if r.label == 0])


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Adds ``toxicity`` (0 to 1) to every row of ``docs``, from whole texts.

    Null and empty texts have no evidence and get the score of none.  Row count, order of columns and repeated rows
    stay; a column of the same name is replaced.  An empty table stays empty.
    """
    spark = small_batches(docs).sparkSession
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of fixed size and 11 numbers

    @F.pandas_udf("double")
    def toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = in_worker(("toxicity", hash(shared.value)), shared.value.scorer)
        for batch in texts:
            yield pd.Series([scorer.score(t) if t else scorer.score("") for t in batch], dtype="float64")

    return docs.withColumn("toxicity", toxicity(F.col("text").cast("string")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
