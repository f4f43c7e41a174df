"""SimHash near duplicates by Golay-code fuzzy hashing.

The 64 bits are three segments of 22, 21 and 21 bits. Three differing bits at
most leave two segments with at most one differing bit each (pigeonhole). The
binary Golay code of length 23 is perfect: every word is within 3 bits of one
codeword, its index is 12 bits. The words within one bit of a segment decode
to 1 or 6 different codewords; if two segments differ in at most one bit, the
codeword of the one is among those of the other.

So for each pair of segments a fingerprint is filed under its two codewords,
and looks under the nearby codewords of both: all combinations for one pair
of segments (needed if all three have one error), for the others those with
one exact side. Who meets under a key is verified by the bit distance.

Equal fingerprints count once. A key with very many entries is split in
blocks that its visitors all pass. A block gives the edges of a spanning
forest of the links found, not the links, so the output is linear in its rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, row_key, saved
from .components import connected_components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
GOLAY = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BLOCK = 4096  # entries of a key that one task compares at once
PAIRS = 1 << 18  # compared at once


@functools.lru_cache(maxsize=1)
def golay_table() -> np.ndarray:
    """Index of the nearest codeword of each 23-bit word."""
    code = np.arange(1 << 12, dtype=np.int64) << 11
    rest = code.copy()
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GOLAY << (bit - 11)), rest)
    code |= rest
    one = [1 << i for i in range(23)]
    errors = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]),
              *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])]
    out = np.empty(1 << 23, dtype=np.int16)
    for e in errors:
        out[code ^ e] = np.arange(1 << 12, dtype=np.int16)
    return out


def _nearby(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest codeword, those of all words within one bit; repeats are -1)."""
    table = golay_table()
    own = table[words]
    ball = np.stack([own, *[table[words ^ (1 << i)] for i in range(width)]], axis=1)
    ball.sort(axis=1)
    ball[:, 1:][ball[:, 1:] == ball[:, :-1]] = -1
    return own.astype(np.int64), ball.astype(np.int64)


def golay_keys(prints: np.ndarray, filed: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys ``prints`` are filed under, or look under."""
    rows, keys = [], []
    seg = [_nearby(((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64), width) for first, width in SEGMENTS]
    every = np.arange(len(prints))

    def add(pair: int, left: np.ndarray, right: np.ndarray) -> None:
        key = np.where((left >= 0) & (right >= 0), (pair << 24) | (left << 12) | right, -1)
        at, _ = np.nonzero(key >= 0)
        rows.append(at)
        keys.append(key[key >= 0])

    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        (own_x, near_x), (own_y, near_y) = seg[x], seg[y]
        if filed:
            rows.append(every)
            keys.append((pair << 24) | (own_x << 12) | own_y)
        elif pair == 0:
            # few of the places hold a codeword: close up before combining
            near_x, near_y = -np.sort(-near_x, axis=1)[:, :6], -np.sort(-near_y, axis=1)[:, :6]
            add(pair, np.repeat(near_x, 6, axis=1), np.tile(near_y, (1, 6)))
        else:
            add(pair, own_x[:, None], near_y)
            add(pair, np.where(near_x == own_x[:, None], -1, near_x), own_y[:, None])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash of a UTF-8 text over ``width``-word shingles."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z, and white space \x20 \x09-\x0D
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, 42)
    ends = list(accumulate(map(len, words), lambda x, y: x + 1 + y))
    hashes = [digest(joined[a:b], 42) for a, b in zip([0, *[e + 1 for e in ends]], ends[width - 1:])]
    parts = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.array([np.bincount(parts[:, k], minlength=256) for k in range(8)])  # per byte of the hash: how often each value
    set_bits = counts @ ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return int.from_bytes(np.packbits((set_bits * 2 > len(hashes)).reshape(-1), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """(doc_id, print[, doc_key]): ``print`` as a signed long. NULL and blank texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py() or b"", width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64)), *batch.columns[2:]], names=["doc_id", "print", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), *([row_key(id_col, text_col).alias("doc_key")] if keyed else []))
    return map_arrow(rows, run, "doc_id long, print long" + (", doc_key long" if keyed else ""))


def _keys(prints: DataFrame, filed: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(own), 4096):
                rows, keys = golay_keys(own[a:a + 4096].view(np.uint64), filed)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[a:a + 4096][rows])], names=["key", "print"])

    return map_arrow(prints.select("print"), run, "key long, print long")


class Forest:
    """Components of array places, updated with arrays of edges."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                nxt = label[label]
                if (nxt == label).all():
                    break
                label = nxt
            self.label = label


def _links(group: np.ndarray, prints: np.ndarray, entry: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Edges of a spanning forest of the links between entries and visitors of each group.

    Rows are sorted by group, its entries first.
    """
    starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    entries = np.add.reduceat(entry.astype(np.int64), starts)
    visitors = sizes - entries
    # each entry row meets its group's visitor rows
    row = np.flatnonzero(entry)
    of = np.repeat(np.arange(len(starts)), sizes)[row]
    first, n = (starts + entries)[of], visitors[of]
    keep = n > 0
    row, first, n = row[keep], first[keep], n[keep]
    forest = Forest(len(group))
    up_to = np.cumsum(n)
    at = 0
    while at < len(row):
        end = max(at + 1, int(np.searchsorted(up_to, (up_to[at - 1] if at else 0) + PAIRS, side="right")))
        k = n[at:end]
        left = np.repeat(row[at:end], k)
        right = np.arange(len(left)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[at:end], k)
        near = np.bitwise_count(prints[left] ^ prints[right]) <= most
        forest.link(left[near], right[near])
        at = end
    child = np.flatnonzero(forest.label != np.arange(len(group)))
    a, b = prints[child], prints[forest.label[child]]
    differ = a != b
    if differ.any():
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[differ].view(np.int64)), pa.array(np.maximum(a, b)[differ].view(np.int64))], names=["a", "b"])


def fingerprint_links(prints: DataFrame, most: int = 3, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect distinct values of ``print`` as links of at most ``most`` (3 or fewer) bits do."""
    if most > 3:
        raise ValueError("the segments find up to 3 differing bits")
    distinct = saved(prints.select("print").filter("print is not null").distinct(), "simhash-prints")
    filed, looked = _keys(distinct, True), _keys(distinct, False)
    hot = saved(filed.groupBy("key").count().filter(F.col("count") > block)
                .select("key", F.ceil(F.col("count") / F.lit(block)).cast("int").alias("blocks")), "simhash-hot")
    blocks = F.coalesce("blocks", F.lit(1))
    filed = filed.join(hot, "key", "left").select("key", F.pmod(F.xxhash64("print"), blocks).cast("int").alias("block"), "print", F.lit(True).alias("entry"))
    looked = looked.join(hot, "key", "left").select("key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "print", F.lit(False).alias("entry"))
    met = filed.unionByName(looked).repartition("key", "block").sortWithinPartitions("key", "block", F.desc("entry"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            key, prints_, entry = (np.concatenate(x) for x in zip(*held))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))  # the last group may go on
            if cut:
                yield from _links(key[:cut], prints_[:cut], entry[:cut], most)
            rest = [key[cut:], prints_[cut:], entry[cut:]]
            if len(rest[0]) > 64 * BLOCK:  # one group: what visited so far is compared, its entries stay
                yield from _links(*rest, most)
                rest = [x[rest[2]] for x in rest]
            held = [rest]

        for batch in batches:
            if not batch.num_rows:
                continue
            key, b, p, e = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "print", "entry"))
            held.append([(key << 28) | b, p.view(np.uint64), e])  # keys have 26 bits, blocks fewer than 28
            if sum(len(x[0]) for x in held) >= 16 * BLOCK:
                yield from flush(False)
        if held:
            yield from flush(True)

    return map_arrow(met, run, "a long, b long")


def simhash_components(docs: DataFrame, width: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links); ``keyed``: also doc_key, ``row_key`` of the document.

    NULL ids get the component of their fingerprint; a component of NULL ids
    only has a NULL component_id. An empty table gives an empty result.
    """
    prints = saved(fingerprints(docs, width, id_col, text_col, keyed), "simhash-docs")
    joined = saved(connected_components(fingerprint_links(prints, most)).select(F.col("id").alias("print"), F.col("component_id").alias("root")), "simhash-cc")
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least")).join(joined, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = saved(least, "simhash-least")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = saved(least.select("print", "root").join(ids, "root").select("print", "component_id"), "simhash-ids")
    return prints.join(by_print, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", *(["doc_key"] if keyed else []))
