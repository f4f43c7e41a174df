"""Log probability of whole texts under a word model that grows with the corpus.

The model is an n-gram trie of two levels, in parts by the context word: no
machine ever holds it whole. A part has, for each of its contexts, the word's
count and the sorted range of its successors. Pointers to the ranges and the
successors (relative to their context, so that all of a part are one rising
sequence) are Elias-Fano coded; the discounted log probabilities are 8-bit
codes into a table of the part. Levels are written to a file that is mapped
into memory (a local one of the task, some 10 bytes for each distinct pair of
a part, so at most about its share of the text); a query reads the range of
its context from the pointers and searches its successors there, on the packed
bits. The pointers also give the number of distinct successors.

Probabilities. Seen after a context: (c(context, word) - D) / c(context). Not
seen: D * distinct successors / c(context) times the word's own probability,
(c(word) + 1) / (N + V + 1); after an unknown context that alone. They sum to
at most one.

How it runs. One pass over the texts sends each part its word pairs, packed
by chunks of documents (a few bytes a pair). A part builds its levels from
the pairs of training documents and answers all pairs, then sums by document.
Log probabilities add, so parts need not agree on anything: what depends on
another part (the own probability of a word not seen after its context; the
totals of a word so frequent that its pairs are dealt over all parts) is sent
on as counts and added at the end.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, row_key, saved

DISCOUNT = 0.75
KEY = np.uint64((1 << 40) - 1)  # successors are known by 40 bits of their hash
CHUNK = 6 << 20  # bytes of text packed together
PART = 12 << 20  # bytes of text a part stands for, at most
COUNTED = 100_000  # words counted at a time when frequent ones are sought


def _mark(name: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"\n" + name, 42)  # no word holds a line feed


def _nth_one(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the ``r``-th set bit (from 0) of each word: by halves, the lower first."""
    place, r = np.zeros(len(words), dtype=np.uint64), r.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((words >> place) & np.uint64((1 << width) - 1)).astype(np.int64)
        beyond = r >= below
        r -= np.where(beyond, below, 0)
        place += np.where(beyond, np.uint64(width), np.uint64(0))
    return place.astype(np.int64)


class Rising:
    """A rising sequence of unsigned integers, Elias-Fano coded: low bits packed, high bits in unary.

    The unary bits stay packed. A directory has the number of ones before each
    64-bit word, so the i-th one, and with it a value, is found by a search in
    the directory and by halving one word; likewise the i-th zero, which ends
    the values with one high part.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, words: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.words, self.ones = n, low_bits, low, words, ones

    @classmethod
    def of(cls, values: np.ndarray) -> Rising:
        values, n = values.astype(np.uint64), len(values)
        most = int(values[-1]) if n else 0
        bits = max(0, (most // max(1, n)).bit_length() - 1)
        width = (bits + 7) // 8  # low parts are stored in whole bytes
        bits = min(8 * width, 56)
        low = (values & np.uint64((1 << bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].copy()
        unary = np.zeros(-(-(n + (most >> bits) + 1) // 64) * 64, dtype=np.uint8)
        unary[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        words = np.packbits(unary, bitorder="little").view("<u8")
        return cls(n, bits, low, words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.uint32))

    def _one(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th one."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        return 64 * word + _nth_one(self.words[word], i - self.ones[word])

    def _ones_before_zero(self, i: np.ndarray) -> np.ndarray:
        """Number of ones before the i-th zero: of values whose high part is at most i."""
        zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones
        word = np.searchsorted(zeros, i, side="right") - 1
        return np.where(i < 64 * len(self.words) - self.n, 64 * word + _nth_one(~self.words[word], np.minimum(i - zeros[word], 63)) - i, self.n)

    def _low(self, places: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(places), 8), dtype=np.uint8)
        wide[:, :self.low.shape[1]] = self.low[places]
        return wide.view("<u8").reshape(-1)

    def at(self, places: np.ndarray) -> np.ndarray:
        return ((self._one(places) - places).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(places)

    def values(self) -> np.ndarray:
        """All, decoded in one go."""
        highs = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.words).view(np.uint8), bitorder="little"))[:self.n] - np.arange(self.n)
        return (highs.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(np.arange(self.n))

    def successor(self, wanted: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value at or above each of ``wanted``, among the places from ``first`` up to ``last`` (which it is if there is none)."""
        last = np.full(len(wanted), self.n) if last is None else last
        h = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        start = np.where(h > 0, self._ones_before_zero(np.maximum(h, 1) - 1), 0) if self.n else np.zeros(len(h), dtype=np.int64)
        stop = self._ones_before_zero(h) if self.n else start.copy()
        start, stop = np.clip(start, first, last), np.clip(stop, first, last)
        want = wanted & np.uint64((1 << self.low_bits) - 1)
        while True:  # binary search among the values with that high part, for all of ``wanted`` at once
            live = np.flatnonzero(start < stop)
            if not len(live):
                return start
            mid = (start[live] + stop[live]) // 2
            less = self._low(mid) < want[live]
            start[live] = np.where(less, mid + 1, start[live])
            stop[live] = np.where(less, stop[live], mid)


class Trie:
    """Contexts (hash, count) and their successors with quantised log10(count - D), in mapped memory."""

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, owner: np.ndarray, keys: np.ndarray, pair_counts: np.ndarray):
        """``owner``: place of the context of each successor key; successors sorted by (owner, key)."""
        log = np.log10(pair_counts - DISCOUNT)
        distinct = np.unique(log)
        self.table = distinct if len(distinct) <= 256 else np.quantile(distinct, np.linspace(0, 1, 256))
        codes = np.clip(np.searchsorted((self.table[1:] + self.table[:-1]) / 2, log), 0, 255).astype(np.uint8) if len(log) else np.zeros(0, np.uint8)
        successors = Rising.of((owner.astype(np.uint64) << np.uint64(40)) | keys)
        pointers = Rising.of(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(contexts)))]))
        levels = [contexts, counts, codes, successors.low, successors.words, successors.ones, pointers.low, pointers.words, pointers.ones]
        with tempfile.TemporaryFile() as f:  # unlinked: gone with the task, whatever ends it
            places = []
            for x in levels:
                places.append(f.tell())
                f.write(np.ascontiguousarray(x).tobytes() or b"\0")
                f.write(b"\0" * (-f.tell() % 8))
            f.flush()
            self.contexts, self.counts, self.codes, sl, sw, so, pl, pw, po = (
                np.memmap(f, dtype=x.dtype, mode="r", offset=at, shape=x.shape) if x.size else x for x, at in zip(levels, places))
        self.successors = Rising(successors.n, successors.low_bits, sl, sw, so)
        self.pointers = Rising(pointers.n, pointers.low_bits, pl, pw, po)

    def ranges(self) -> np.ndarray:
        """Number of distinct successors of each context."""
        return np.diff(self.pointers.values().astype(np.int64))

    def find(self, context: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """log10(count - D) of each (place of context, key), NaN where not seen: a search in the context's range of successors."""
        wanted = (context.astype(np.uint64) << np.uint64(40)) | keys
        asked, which = np.unique(context, return_inverse=True)
        first, last = (self.pointers.at(p).astype(np.int64)[which] for p in (asked, asked + 1))
        at = self.successors.successor(wanted, first, last)
        out = np.full(len(wanted), np.nan)
        inside = np.flatnonzero(at < last)
        hit = inside[self.successors.at(at[inside]) == wanted[inside]]
        out[hit] = self.table[self.codes[at[hit]]]
        return out


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.itemsize, len(a))]], dtype="<u4").tobytes()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays]  # bytes of one rank together compress better
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<u4", 2 * n, 4).reshape(n, 2).tolist(), 4 + 8 * n, []
    for width, length in sizes:
        out.append(np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length).T.copy().view(f"<u{width}").reshape(-1))
        at += width * length
    return out


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 42)
        return h


_hashes = _Hashes()


def _pairs_of_chunk(rows: list[tuple[int, int | None, bool, bytes]], hot: np.ndarray, labels: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(part label, kind, payload): kind 0 documents with their frequent words, kind 1 pairs."""
    start, end, look = _mark(b"start"), _mark(b"end"), _hashes.__getitem__
    streams, lengths = [], []
    for _, _, _, text in rows:
        words = text.lower().split()  # of bytes: A-Z, and white space \x20 \x09-\x0D
        streams.append(np.fromiter((look(w) for w in words), dtype=np.uint64, count=len(words)))
        lengths.append(len(words) + 1)
    n = np.array(lengths)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    context, word = np.empty(n.sum(), dtype=np.uint64), np.empty(n.sum(), dtype=np.uint64)
    for at, s in zip(first.tolist(), streams):
        context[at], context[at + 1:at + 1 + len(s)] = start, s
        word[at:at + len(s)], word[at + len(s)] = s, end
    doc = np.repeat(np.arange(len(rows)), n)
    key, train = np.array([r[0] for r in rows], dtype=np.int64).view("<u8"), np.array([r[2] for r in rows], dtype=np.uint8)
    ids, known = np.array([r[1] or 0 for r in rows], dtype=np.int64).view("<u8"), np.array([r[1] is not None for r in rows], dtype=np.uint8)
    parts, frequent = np.uint64(len(labels)), np.isin(context, hot)
    # the document's row has how often each frequent word stands in it, so their totals can be applied there
    which, times = np.unique(doc[frequent] * len(hot) + np.searchsorted(hot, context[frequent]), return_counts=True)
    yield (int(labels[int(key[0] % parts)]), 0, _pack(key, ids, known, train, n.astype("<u8"), np.bincount(which // max(1, len(hot)), minlength=len(rows)).astype("<u4"),
                                                      (which % max(1, len(hot))).astype("<u4"), times.astype("<u4")))
    mixed = np.where(frequent, context ^ (word * np.uint64(0x9E3779B97F4A7C15)), context)
    part = ((mixed >> np.uint64(20)) % parts).astype(np.int64)
    order = np.lexsort((word & KEY, context, part))
    context, word, doc, part = context[order], word[order] & KEY, doc[order], part[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        c, w, d = context[a:b], word[a:b], doc[a:b]
        new_c = np.concatenate([[True], c[1:] != c[:-1]])
        new_w = new_c | np.concatenate([[True], w[1:] != w[:-1]])
        runs = lambda new: np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
        used, d = np.unique(d, return_inverse=True)
        some = w[new_w].astype("<u8")
        yield (int(labels[part[a]]), 1, _pack(c[new_c].astype("<u8"), runs(new_c).astype("<u4"), (some & np.uint64(0xFFFFFFFF)).astype("<u4"), (some >> np.uint64(32)).astype("u1"),
               runs(new_w).astype("<u4"), d.astype("<u2" if len(used) < 65536 else "<u4"), key[used], train[used]))


RESULT = "kind int, key long, word long, model double, base double, n1 long, n2 long, doc_id long, held_out boolean, frequent array<int>, times array<int>"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
DOCUMENT, SUMS, FREQUENT, OWN, WORD, TOTAL, STATISTICS = range(7)


def _rows(kind: int, n: int, **cols) -> pa.RecordBatch:
    cols["kind"] = np.full(n, kind, dtype=np.int32)
    return pa.RecordBatch.from_arrays([(cols[c] if isinstance(cols[c], pa.Array) else pa.array(cols[c], t)) if c in cols else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES)], names=_NAMES)


def _answer(payloads: list[bytes], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Build one part's trie, answer its pairs, sum by document."""
    # by pair of a payload: its context, word and number of places; by place only the document
    names, pairs, sizes, docs, keys, trains, at = [], [], [], [], [], [], 0
    for data in payloads:
        c, c_n, low, high, w_n, d, key, train = _unpack(data)
        of = np.searchsorted(np.cumsum(c_n), np.cumsum(w_n) - w_n, side="right")
        pairs.append((of, (high.astype(np.uint64) << np.uint64(32)) | low))
        names.append(c)
        sizes.append(w_n)
        docs.append((d + np.uint32(at)).astype(np.uint32))
        keys.append(key.view(np.int64))
        trains.append(train.astype(bool))
        at += len(key)
    payloads.clear()
    ends = np.cumsum([0] + [len(c) for c in names])
    names, own = np.unique(np.concatenate(names), return_inverse=True)
    place = np.concatenate([own[start:][of] for start, (of, _) in zip(ends.tolist(), pairs)])
    word = np.concatenate([w for _, w in pairs])
    size, doc, key, train = (np.concatenate(x) for x in (sizes, docs, keys, trains))
    del pairs, sizes, docs
    first = np.cumsum(size, dtype=np.int64) - size
    learnt = np.add.reduceat(train[doc].astype(np.int32), first)
    asked, back = np.unique((place.astype(np.uint64) << np.uint64(40)) | word, return_inverse=True)
    of = (asked >> np.uint64(40)).astype(np.int64)
    pair_counts = np.bincount(back, learnt, len(asked)).astype(np.int64)
    counts = np.bincount(of, pair_counts, len(names)).astype(np.int64)
    known = pair_counts > 0
    trie = Trie(names, counts, of[known], asked[known] & KEY, pair_counts[known])
    distinct = trie.ranges()
    log = trie.find(of, asked & KEY)
    seen = ~np.isnan(log)
    split, begin = np.isin(names, hot), names == np.uint64(_mark(b"start"))
    with np.errstate(divide="ignore"):
        share = np.where(seen, log, np.log10(DISCOUNT) + np.log10(distinct[of])) - np.log10(counts[of])
    share[counts[of] == 0] = 0.0  # an unknown context adds nothing of its own
    share[split[of]] = np.where(seen, log, 0.0)[split[of]]  # its totals are added to the document's row
    n = len(key)
    whole = ~split[of]
    base = np.where(begin, 0.0, np.log10(counts + 1.0))
    has = (counts > 0) & ~begin

    def by_document(values: np.ndarray) -> np.ndarray:
        """Sum over places of what their pair (of ``asked``) has."""
        return np.bincount(doc, np.repeat(values[back], size), n)

    yield _rows(SUMS, n, key=key, model=by_document(share), base=by_document(np.where(whole, base[of], 0.0)),
                n1=by_document(np.where(whole, has[of], 0.0)).astype(np.int64))
    if split.any():
        some = np.flatnonzero(np.repeat(~whole[back] & ~seen[back], size))  # after a frequent word, but not seen after it
        which = np.repeat(back, size)[some]
        both, times = np.unique(doc[some].astype(np.int64) * len(names) + of[which], return_counts=True)
        yield _rows(FREQUENT, len(both), key=key[both // len(names)], word=names[both % len(names)].view(np.int64), n1=times)
        mine = np.flatnonzero(split)
        yield _rows(TOTAL, len(mine), word=names[mine].view(np.int64), n1=counts[mine], n2=distinct[mine])
    missing = np.flatnonzero(np.repeat(~seen[back], size))
    if len(missing):
        lacking = (asked & KEY)[np.repeat(back, size)[missing]]
        order = np.lexsort((lacking, doc[missing]))
        w, d = lacking[order], doc[missing][order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])])
        yield _rows(OWN, int(new.sum()), key=key[d[new]], word=w[new].astype(np.int64), n1=np.diff(np.concatenate([np.flatnonzero(new), [len(order)]])))
    learnt_words = np.flatnonzero(has)
    yield _rows(WORD, len(learnt_words), word=(names[learnt_words] & KEY).astype(np.int64), n1=counts[learnt_words])
    yield _rows(STATISTICS, 1, n1=[int((has & ~split).sum())], n2=[int(pair_counts.sum())])


def _tally(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(word, n): words, and the start mark, with over 1 / (16 parts) of a task's places; their number under a NULL word.

    Counters are bounded: beyond that many words, the count that half of them
    exceed is taken off all. A count lacks at most 1 / (32 parts) of the places.
    """
    from collections import Counter

    counts, places, lacking, most = Counter(), 0, 0, max(COUNTED, 64 * parts)
    for batch in batches:
        for text in batch.column(0):
            words = text.as_py().lower().split()
            counts.update(words)
            counts[b"\nstart"] += 1  # its hash is the mark's
            places += len(words) + 1
            if len(counts) > most:
                cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - most // 2)[len(counts) - most // 2])
                lacking += cut
                counts = Counter({w: n - cut for w, n in counts.items() if n > cut})
    kept = [(w, n) for w, n in counts.items() if n + lacking > places / (16 * parts)]
    yield pa.RecordBatch.from_arrays([pa.array([None, *[int(np.uint64(_hashes[w]).view(np.int64)) for w, _ in kept]], pa.int64()), pa.array([places, *[n for _, n in kept]], pa.int64())], names=["word", "n"])


def frequent_contexts(texts: DataFrame, parts: int) -> np.ndarray:
    """Hashes of all words, or the start mark, that are more than one ``parts``-th of all contexts, in order.

    Counted over all texts (one binary column). What tasks leave out and lack
    is less than a tenth of that share, so nothing is missed; what is a little
    below it may be there too, which only deals its pairs differently.
    """
    tally = saved(map_arrow(texts, lambda batches: _tally(batches, parts), "word long, n long"), "lm-tally")
    places = tally.filter("word is null").agg(F.sum("n")).first()[0] or 0
    found = tally.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > max(20.0, 0.9 * places / parts)).select("word").collect()
    return np.sort(np.array([r["word"] for r in found], dtype=np.int64).view(np.uint64))


def _even_labels(spark, parts: int) -> np.ndarray:
    """For each of ``parts`` partitions a number that Spark's hash partitioning sends there."""
    rows = (spark.range(parts * 40 + 200).select(F.col("id").cast("int").alias("id")).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("id")).collect())
    return np.array([r["id"] for r in sorted(rows, key=lambda r: r["p"])])


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows for which ``held_out`` (over the columns of ``docs``) does
    not hold. A NULL text counts as empty: one token, its end. Rows alike in
    id and text get the same result each. Without training rows all
    probabilities are 1. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size["bytes"] or 0) // PART))
    labels = _even_labels(spark, parts)
    # with more than a part's share of all places: hardly more than there are parts
    hot = frequent_contexts(docs.select(text.cast("binary").alias("text")), parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            label, kind, data = zip(*_pairs_of_chunk(rows, hot, labels))
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["part", "kind", "data"])

        for batch in batches:
            for key, doc_id, train, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                rows.append((key, doc_id, train, text.as_py()))
                size += len(rows[-1][3])
                if size >= CHUNK:
                    yield from flush()
                    rows, size = [], 0
        if rows:
            yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads = []
        for batch in batches:
            for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if kind:
                    payloads.append(data)
                else:
                    key, ids, known, train, n, kinds, which, times = _unpack(data)
                    at = pa.array(np.concatenate([[0], np.cumsum(kinds)]), pa.int32())
                    yield _rows(DOCUMENT, len(key), key=key.view(np.int64), doc_id=pa.array(ids.view(np.int64), pa.int64(), mask=known == 0), held_out=train == 0, n1=n.astype(np.int64),
                                frequent=pa.ListArray.from_arrays(at, pa.array(which, pa.int32())), times=pa.ListArray.from_arrays(at, pa.array(times, pa.int32())))
        if payloads:
            yield from _answer(payloads, hot)

    source = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("doc_id"), (~held).alias("train"), text.cast("binary").alias("text"))
    sent = map_arrow(source, pack, "part int, kind int, data binary").repartition(parts, "part")  # a part is a partition
    found = saved(map_arrow(sent, answer, RESULT), "lm-answers", partition_by="kind")
    of = lambda kind: found.filter(F.col("kind") == kind)

    statistics = of(STATISTICS).agg(F.sum("n1").alias("words"), F.sum("n2").alias("tokens")).first()
    totals = saved(of(TOTAL).groupBy("word").agg(F.sum("n1").alias("c"), F.sum("n2").alias("distinct")), "lm-totals")  # one row per frequent word
    learnt_docs = of(DOCUMENT).filter("not held_out").count()
    tokens = int(statistics["tokens"] or 0)
    start = int(np.uint64(_mark(b"start")).view(np.int64))  # a context, but no word
    distinct = int(statistics["words"] or 0) + totals.filter((F.col("c") > 0) & (F.col("word") != start)).count() + (learnt_docs > 0)
    scale = float(np.log10(tokens + distinct + 1))

    sums = of(SUMS).select("key", "model", "base", "n1")
    split = (of(FREQUENT).select("key", "word", "n1").join(F.broadcast(totals), "word").filter("c > 0")
             .select("key", (F.col("n1") * (float(np.log10(DISCOUNT)) + F.log10("distinct"))).alias("model"), F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("n1")))
    # of each frequent word, in the order of their places: its count
    count_of = {int(np.int64(r["word"]).view(np.uint64)): r["c"] for r in totals.collect()}
    counts = np.array([count_of.get(int(h), 0) for h in hot], dtype=np.float64)
    a_word = hot != np.uint64(_mark(b"start"))

    def own_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(divide="ignore"):
            less, more = np.where(counts > 0, -np.log10(counts), 0.0), np.where(a_word, np.log10(counts + 1), 0.0)
        for batch in batches:
            at = batch.column("frequent").offsets.to_numpy().astype(np.int64)
            at, lo = at - at[0], int(at[0])
            which, times = (batch.column(c).values.to_numpy()[lo:lo + at[-1]] for c in ("frequent", "times"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            add = lambda v: np.bincount(row, times * v[which], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(add(less)), pa.array(add(more)), pa.array(add(((counts > 0) & a_word).astype(float)).astype(np.int64))],
                                             names=["key", "model", "base", "n1"])

    if len(hot):
        sums = sums.unionByName(map_arrow(of(DOCUMENT).select("key", "frequent", "times"), own_totals, "key long, model double, base double, n1 long"))
    end = spark.range(1).select(F.lit(int(np.uint64(_mark(b"end")) & KEY)).cast("long").alias("word"), F.lit(learnt_docs).cast("long").alias("n1"))
    words = saved(of(WORD).select("word", "n1").unionByName(end).groupBy("word").agg(F.sum("n1").alias("c")), "lm-words")
    own = (of(OWN).select("key", "word", "n1").join(words, "word", "left")
           .select("key", (F.col("n1") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - scale)).alias("model"), F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("n1")))
    by_key = sums.unionByName(split).unionByName(own).groupBy("key").agg(F.sum("model").alias("model"), F.sum("base").alias("base"), F.sum("n1").alias("known"))
    # rows alike in id and text have added up: all got the same
    rows = of(DOCUMENT).select("key", "doc_id", "held_out", "n1").groupBy("key", "doc_id", "held_out", "n1").count().withColumnRenamed("n1", "n_tokens")
    last = float(np.log10(learnt_docs + 1))
    per = rows.join(by_key, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") / F.col("count")).cast("long").alias("_known"), (F.col("base") / F.col("count")).alias("_base"),
        (F.col("model") / F.col("count")).alias("_model"), F.explode(F.array_repeat(F.lit(0), F.col("count").cast("int"))).alias("_copy"))
    return per.select("doc_id", "held_out", "n_tokens", (F.col("_known") + (1 if learnt_docs else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
                      (F.col("_base") + last - F.col("n_tokens") * scale).alias("base_score"), F.col("_model").alias("score"))
