"""Language of whole texts by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over
hashed byte trigrams tells languages with that bit from the others: naive
Bayes log odds between the mean trigram distributions of the two sides. The
bits are decoded to the codeword of least logistic loss, so sure bits weigh
more than unsure ones. A text whose second codeword is nearly as close is
flagged as ambiguous.

Training counts every trigram of every training text, in Spark; what reaches
the driver is languages x 16,384 counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

WIDTH = 1 << 14  # hashed trigrams
EVIDENCE = 60.0  # trigrams after which a text's evidence counts as saturated
SURE = 0.5  # below this score no language has the better half: ambiguous

_FOLD = np.full(256, 0x20, dtype=np.uint8)  # letters in lower case, bytes of other scripts as they are, else blank
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    """Whether a character of Unicode's category L is in the text (numbers such as a half are none)."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, set(text.decode("utf-8", "replace"))))


def trigrams(text: bytes) -> np.ndarray:
    """Hashed trigrams; those with two blanks side by side carry nothing and are left out."""
    b = _FOLD[np.frombuffer(b" " + text + b" ", dtype=np.uint8)].astype(np.uint32)
    x, y, z = b[:-2], b[1:-1], b[2:]
    keep = ~((y == 0x20) & ((x == 0x20) | (z == 0x20)))
    code = ((x << 16) | (y << 8) | z)[keep]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)  # 14 bits


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1/-1: all ways to part up to five languages in two, beyond that the most distant of random codes."""
    if n <= 5:
        bits = max(1, (1 << max(0, n - 1)) - 1)
        return np.array([[1 if i == 0 or not (c + 1) >> (i - 1) & 1 else -1 for c in range(bits)] for i in range(n)], dtype=np.int8)
    bits, rng, best, far = 8 * int(np.ceil(np.log2(n))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        same = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(same, -bits)
        least = bits - int(same.max())
        if least > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, least
    return best


class Decoder:
    """Trigram counts by language -> weights of the bits, and the decision for a text."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = []
        for bit in self.code.T:
            one, other = share[bit > 0], share[bit < 0]
            weights.append(np.log(one.mean(0) / other.mean(0)) if len(one) and len(other) else np.zeros(WIDTH))
        self.weights = np.array(weights, dtype=np.float32).T.copy()

    def decide(self, text: bytes) -> tuple[str, float]:
        grams = trigrams(text)
        if not len(grams):
            return self.langs[0], 1.0 / len(self.langs)
        n = len(grams)
        odds = np.bincount(grams, minlength=WIDTH).astype(np.float32) @ self.weights / n * (n * EVIDENCE / (n + EVIDENCE))
        loss = np.logaddexp(0.0, -self.code * odds[None, :].astype(np.float64)).sum(axis=1)
        near = np.exp(loss.min() - loss)
        best = int(np.argmin(loss))
        return self.langs[best], float(near[best] / near.sum())


def train(docs: DataFrame, use: Column, lang_col: str = "lang", text_col: str = "text") -> Decoder | None:
    """Counts of all texts of rows for which ``use`` holds and that have a language; None if there are none.

    Each row counts, also if rows repeat. A text of any length counts whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(lang, np.zeros(WIDTH, dtype=np.int64))
                own += np.bincount(trigrams(text.as_py()), minlength=WIDTH)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["lang", "gram", "n"])

    rows = docs.filter(use).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text")).filter("lang is not null and text is not null")
    table = map_arrow(rows, count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if not langs:
        return None
    counts = np.zeros((len(langs), WIDTH))
    place = {x: i for i, x in enumerate(langs)}
    counts[[place[x] for x in table.column("lang").to_pylist()], table.column("gram").to_numpy()] = table.column("n").to_numpy()
    return Decoder(langs, counts)


def predict(docs: DataFrame, decoder: Decoder | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred, score and ambiguous.

    ``und`` with score 0 if the text is NULL or has no letter, or nothing was
    learnt. Of languages equally near, the first in order of name is taken,
    and ambiguous holds as none has the better half. Each row is answered,
    also if rows repeat; an empty table gives an empty result. Columns of
    ``keep`` named like the new ones are left out. A text of ``keep`` is sent
    to the workers once.
    """
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", "ambiguous")]
    sent = dict(docs.select(*keep).dtypes).get(text_col) == "string"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    place = keep.index(text_col) if sent else len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(decoder)  # languages x codeword bits x 16,384 floats at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary())
            said = [model.decide(t) if model and t and has_letter(t) else ("und", 0.0) for t in (x.as_py() for x in texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64()),
                 pa.array([s[0] != "und" and s[1] < SURE for s in said], pa.bool_())], names=[*keep, "lang_pred", "score", "ambiguous"])

    own = [] if sent else [F.col(text_col).cast("string").cast("binary").alias("_text")]
    return map_arrow(docs.select(*keep, *own), run, kinds + ", lang_pred string, score double, ambiguous boolean")
