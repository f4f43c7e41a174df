"""Bounded-space online best-fit packing of token sequences.

Documents are tokenised once, where they are read; only (id, piece, length,
checksum) travel. A piece goes to the open bin with the least free space that
still holds it. The open bins are indexed by a bitset over free space, so that
bin is the lowest set bit at or above the piece's length. At most ``open_bins``
bins are open; to open one more, the fullest closes first.

Each partition packs its own stream. What it has open at the end are bins
that are not full; they become items of a next round over a sixteenth of the
partitions, and so on until one is left, so the number of partly filled
sequences does not grow with the number of partitions. One round's task packs
about 16 x ``open_bins`` bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, saved
from .tokens import default_tokenizer, encoder, with_end

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
FAN_IN = 16
CHUNK = 1 << 20  # bytes of texts tokenised at once: their pieces take many times that


def cuts(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, piece, start, length) of the pieces of texts of ``sizes`` tokens; of several, the first may be shorter."""
    first = (sizes - 1) % most + 1
    n = 1 + (sizes - first) // most
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return doc, piece, np.where(piece > 0, first[doc] + (piece - 1) * most, 0), np.where(piece > 0, most, first[doc])


def token_pieces(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``max_tokens`` of every whole text and its end id.

    A NULL text counts as empty and gives one piece, the end id alone. With
    ``with_ids`` a column ``ids`` has the ids as little-endian uint32 bytes.
    """
    path = tokenizer or default_tokenizer()
    schema = PIECES + (", ids binary" if with_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in chunks(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist(), CHUNK):
                flat, at = with_end(*enc.encode(texts.slice(a, b - a)), end_id)
                doc, piece, start, length = cuts(np.diff(at), max_tokens)
                raw, begins = memoryview(flat).cast("B"), (at[doc] + start) * 4
                parts = [raw[x:y] for x, y in zip(begins.tolist(), (begins + length * 4).tolist())]
                cols = [ids.slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(x) for x in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), pieces, schema)


class Bins:
    """The open bins of one stream. ``put`` returns (bin, offset); closed bins are forgotten."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.bits, self.count = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        b = held.pop()
        if not held:
            self.bits ^= 1 << free
        self.count -= 1
        return b

    def _open(self, b: int, free: int) -> None:
        if not self.by_free[free]:
            self.bits |= 1 << free
        self.by_free[free].append(b)
        self.count += 1

    def put(self, size: int) -> tuple[int, int]:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if size < self.capacity and self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest
            b, free = self.next, self.capacity
            self.next += 1
        if free > size:
            self._open(b, free - size)
        return b, self.capacity - free

    def open_bins(self) -> dict[int, int]:
        """bin -> tokens in it."""
        return {b: self.capacity - free for free, held in enumerate(self.by_free) for b in held}


def _packer(capacity: int, open_bins: int, size_col: str, turn: int, items: list[str]):
    """Stream of items -> the same with bin, place, and for bins left open what they hold (else NULL).

    A task holds one batch and the items of its open bins, at most ``open_bins`` x ``capacity``.
    """

    def told(rows: pa.Table, held: pa.Array) -> Iterator[pa.RecordBatch]:
        if rows.num_rows:
            yield from pa.Table.from_arrays([*rows.columns, held], names=[*items, "bin", "place", "held"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # bin numbers: round, partition and a counter; unique without coordination
        bins = Bins(capacity, open_bins, (turn << 58) + (TaskContext.get().partitionId() << 34))
        names = [*items, "bin", "place", "held"]
        waiting = None  # the items of open bins; what a closed bin holds goes out at once
        for batch in batches:
            placed = np.array([bins.put(int(s)) for s in batch.column(size_col).to_pylist()], dtype=np.int64).reshape(-1, 2)
            rows = pa.Table.from_arrays([*batch.columns, pa.array(placed[:, 0]), pa.array(placed[:, 1])], names=names[:-1])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            is_open = np.isin(rows["bin"].to_numpy(), np.fromiter(bins.open_bins(), dtype=np.int64))
            waiting = rows.filter(pa.array(is_open)).combine_chunks()
            yield from told(rows.filter(pa.array(~is_open)), pa.nulls(int((~is_open).sum()), pa.int64()))
        if waiting is not None:
            left = bins.open_bins()
            yield from told(waiting, pa.array([left[b] for b in waiting["bin"].to_pylist()], pa.int64()))

    return run


def pack(items: DataFrame, size_col: str = "length", capacity: int = 2048, open_bins: int = 1024) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: gapless places in sequences of at most ``capacity``.

    ``size_col`` must be between 1 and ``capacity``. Items that are alike in
    all columns get places of their own. An empty table gives an empty result.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    placed_by = ", bin long, place long, held long"
    order = F.xxhash64(*[F.col(c) for c in items.columns])
    dealt = items.withColumn("_h", order).repartition("_h").sortWithinPartitions("_h", *items.columns).drop("_h")
    # written once: a retried task must not place items anew after others have read its bins
    first = saved(map_arrow(dealt, _packer(capacity, open_bins, size_col, 0, dealt.columns), kinds + placed_by), "pack-0")

    left = first.filter("held is not null and place = 0").select("bin", "held")
    turn, maps = 0, None
    while True:
        parts, turn = max(1, -(-left.count() // (FAN_IN * open_bins))), turn + 1
        largest_first = left.coalesce(parts).withColumnsRenamed({"bin": "was", "held": "size"}).sortWithinPartitions(F.desc("size"), "was")
        packed = saved(map_arrow(largest_first, _packer(capacity, open_bins, "size", turn, ["was", "size"]), "was long, size long" + placed_by), f"pack-{turn}")
        maps = packed if maps is None else saved(
            maps.select("was", F.col("bin").alias("_b"), F.col("place").alias("_p"))
            .join(packed.select(F.col("was").alias("_b"), "bin", "place"), "_b", "left")
            .select("was", F.coalesce("bin", "_b").alias("bin"), (F.coalesce("place", F.lit(0)) + F.col("_p")).alias("place")), f"pack-map-{turn}")
        if parts == 1:
            break
        left = packed.filter("held is not null and place = 0").select("bin", "held")
    moved = maps.select(F.col("was").alias("bin"), F.col("bin").alias("_to"), F.col("place").alias("_base"))
    cols = [F.col(f"`{c}`") for c in items.columns]
    stay = first.filter("held is null").select(*cols, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    go = first.filter("held is not null").join(moved, "bin").select(*cols, F.col("_to").alias("sequence_id"), (F.col("_base") + F.col("place")).alias("offset"))
    return stay.unionByName(go)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 2048, open_bins: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all ``docs``.

    NULL ids stay NULL; repeated rows are packed as often as they occur.
    """
    return pack(token_pieces(docs, tokenizer, max_tokens, id_col=id_col, text_col=text_col), "length", max_tokens, open_bins)
