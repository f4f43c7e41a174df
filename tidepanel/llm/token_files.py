"""Token ids in files: static range asymmetric numeral coding with interleaved lanes.

Layout. A partition holds a range of doc_id in ascending order. Its documents
are gathered into shards of about ``shard_tokens`` ids; a shard is one row:

    part, shard         place of the shard in the dataset
    first               ids before it in its partition
    doc_ids, lengths    its documents in order, with their number of ids
    scale_bits          frequencies sum to 2^scale_bits
    symbols, freqs      the frequency table all blocks of the shard share
    blocks              per block: n_tokens, byte offset, byte length, crc32 of
                        its bytes, checkpoints (step, word offset)
    payload             the blocks

A block is coded for itself: token t belongs to lane t mod ``lanes``, so one
numpy operation advances all lanes. Lane states are 64 bits, emitted words 32.
A block starts with the states a decoder begins with, one set for its start
and one for each checkpoint (every ``checkpoint_steps`` steps of all lanes):
a reader may begin there and leave the rest of the block to others.

The container is Parquet, so that Spark's commit protocol makes a written
dataset complete or absent, wherever it is stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import scratch_dir

from .common import chunks, map_arrow
from .tokens import default_tokenizer, encoder, with_end

LOW = np.uint64(1 << 31)  # states are in [2^31, 2^63)
SHARD = ("part int, shard int, first long, doc_ids array<long>, lengths array<long>, scale_bits int, symbols binary, freqs binary, "
         "lanes int, blocks array<struct<n_tokens:long, offset:long, size:long, crc32:long, steps:array<int>, words:array<long>>>, payload binary")
_BLOCK = pa.struct([("n_tokens", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("crc32", pa.int64()),
                    ("steps", pa.list_(pa.int32())), ("words", pa.list_(pa.int64()))])
_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("scale_bits", pa.int32()), ("symbols", pa.binary()), ("freqs", pa.binary()),
                    ("lanes", pa.int32()), ("blocks", pa.list_(_BLOCK)), ("payload", pa.binary())])


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, frequencies that sum to 2^bits and are at least 1, bits)."""
    symbols, counts = np.unique(ids, return_counts=True)
    bits = min(26, max(16, int(np.ceil(np.log2(max(2, len(symbols))))) + 5))
    total = 1 << bits
    freqs = np.maximum(1, (counts * (total / counts.sum())).astype(np.int64))
    gap = total - int(freqs.sum())
    if gap >= 0:
        freqs[np.argmax(freqs)] += gap
    else:  # take from the most frequent, which lose least by it
        for i in np.argsort(-freqs, kind="stable"):
            cut = min(-gap, int(freqs[i]) // 2)
            freqs[i] -= cut
            gap += cut
            if not gap:
                break
    return symbols.astype("<u4"), freqs.astype("<u4"), bits


def encode_block(ids: np.ndarray, symbols: np.ndarray, freqs: np.ndarray, bits: int, lanes: int, every: int) -> tuple[bytes, list[int], list[int]]:
    """(bytes, steps of the checkpoints, words before each)."""
    steps = -(-len(ids) // lanes)
    at = np.searchsorted(symbols, ids)
    if steps * lanes > len(ids):  # the last step is filled up with the cheapest symbol
        at = np.concatenate([at, np.full(steps * lanes - len(ids), np.argmax(freqs))])
    begins = np.concatenate([[0], np.cumsum(freqs[:-1], dtype=np.uint64)]).astype(np.uint64)
    f, c = freqs.astype(np.uint64)[at].reshape(steps, lanes), begins[at].reshape(steps, lanes)
    most = f << np.uint64(63 - bits)
    shift, word = np.uint64(bits), np.uint64(32)
    state = np.full(lanes, LOW, dtype=np.uint64)
    out, saved = [], {}
    for s in range(steps - 1, -1, -1):
        if s + 1 < steps and (s + 1) % every == 0:
            saved[s + 1] = state.copy()
        full = state >= most[s]
        if full.any():
            out.append(state[full].astype("<u4"))
            state[full] >>= word
        else:
            out.append(None)
        q = state // f[s]
        state = (q << shift) + (state - q * f[s]) + c[s]
    out.reverse()  # now in the order a decoder reads
    sizes = np.cumsum([0] + [0 if w is None else len(w) for w in out])
    marks = sorted(saved)
    body = b"".join(w.tobytes() for w in out if w is not None)
    heads = b"".join(x.astype("<u8").tobytes() for x in [state, *[saved[m] for m in marks]])
    return heads + body, [0, *marks], [0, *[int(sizes[m]) for m in marks]]


class Table:
    """A shard's frequency table, ready to decode."""

    def __init__(self, symbols: bytes, freqs: bytes, bits: int):
        self.symbols, self.bits = np.frombuffer(symbols, "<u4"), bits
        f = np.frombuffer(freqs, "<u4").astype(np.int64)
        self.freqs, self.begins = f.astype(np.uint64), np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(f), dtype=np.uint32), f)


def decode_block(data: bytes, n_tokens: int, table: Table, lanes: int, steps: list[int], words: list[int], only: int | None = None) -> np.ndarray:
    """The ids of a block; with ``only``, of its stretch from that checkpoint to the next."""
    heads = np.frombuffer(data, "<u8", lanes * len(steps)).reshape(len(steps), lanes)
    stream = np.frombuffer(data, "<u4", offset=heads.nbytes)
    total = -(-n_tokens // lanes)
    k = only or 0
    start, stop = steps[k], total if only is None or k + 1 == len(steps) else steps[k + 1]
    state, at = heads[k].astype(np.uint64), words[k]
    shift, mask, word = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(32)
    out = np.empty((stop - start, lanes), dtype=np.uint32)
    for s in range(stop - start):
        slot = state & mask
        sym = table.slots[slot]
        out[s] = sym
        state = table.freqs[sym] * (state >> shift) + slot - table.begins[sym]
        low = np.flatnonzero(state < LOW)
        if len(low):
            state[low] = (state[low] << word) | stream[at:at + len(low)]
            at += len(low)
    return table.symbols[out.reshape(-1)[:n_tokens - start * lanes]]


def _shard(part: int, number: int, first: int, docs: list[tuple[int | None, np.ndarray]], lanes: int, block_steps: int, every: int) -> pa.RecordBatch:
    ids = np.concatenate([d[1] for d in docs])
    symbols, freqs, bits = frequency_table(ids)
    blocks, payload, at = [], [], 0
    for a in range(0, len(ids), lanes * block_steps):
        some = ids[a:a + lanes * block_steps]
        data, steps, words = encode_block(some, symbols, freqs, bits, lanes, every)
        blocks.append({"n_tokens": len(some), "offset": at, "size": len(data), "crc32": zlib.crc32(data), "steps": steps, "words": words})
        payload.append(data)
        at += len(data)
    row = {"part": part, "shard": number, "first": first, "doc_ids": [d[0] for d in docs], "lengths": [len(d[1]) for d in docs], "scale_bits": bits,
           "symbols": symbols.tobytes(), "freqs": freqs.tobytes(), "lanes": lanes, "blocks": blocks, "payload": b"".join(payload)}
    return pa.RecordBatch.from_pylist([row], schema=_ARROW)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                      shard_tokens: int = 4 << 20, lanes: int = 2048, block_steps: int = 256, checkpoint_steps: int = 128) -> None:
    """Write the ids of every whole text, an end id after each, in ascending id order.

    One pass: texts are dealt by ranges of the id, sorted, tokenised and coded
    in the same task, which holds one shard at a time (a single text may be
    larger than ``shard_tokens``; its shard has it whole). NULL texts count
    as empty. NULL ids come first; equal ids are ordered by a hash of the text.
    An empty table gives a dataset without shards.
    """
    model = tokenizer or default_tokenizer()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(model), TaskContext.get().partitionId()
        held, size, number, first = [], 0, 0, 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in chunks(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist(), 4 << 20):
                flat, at = with_end(*enc.encode(texts.slice(a, b - a)), end_id)
                for i in range(b - a):
                    own = flat[at[i]:at[i + 1]]
                    if held and size + len(own) > shard_tokens:
                        yield _shard(part, number, first, held, lanes, block_steps, checkpoint_steps)
                        held, size, number, first = [], 0, number + 1, first + size
                    held.append((ids[a + i], own))
                    size += len(own)
        if held:
            yield _shard(part, number, first, held, lanes, block_steps, checkpoint_steps)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealing by ranges reads the ids once more, for the bounds; the texts are shuffled once
    ordered = rows.repartitionByRange(width, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    map_arrow(ordered, shards, SHARD).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it. A block whose bytes
    do not have their checksum fails the read.
    """
    data = spark.read.schema(SHARD).parquet(path)
    # ids before each partition: one row a partition
    sizes = {r["part"]: r["n"] for r in data.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n")).collect()}
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                table, parts = Table(row["symbols"], row["freqs"], row["scale_bits"]), []
                for b in row["blocks"]:
                    own = row["payload"][b["offset"]:b["offset"] + b["size"]]
                    if zlib.crc32(own) != b["crc32"]:
                        raise ValueError(f"shard {row['part']}/{row['shard']}: a block at byte {b['offset']} does not match its checksum")
                    parts.append(decode_block(own, b["n_tokens"], table, row["lanes"], b["steps"], b["words"]))
                raw, lengths = memoryview(np.concatenate(parts).astype("<u4")).cast("B"), np.array(row["lengths"], dtype=np.int64)
                starts = np.concatenate([[0], np.cumsum(lengths)])
                own = [raw[4 * a:4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                cols = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts[:-1] + row["first"] + before[row["part"]]), pa.array(lengths),
                        pa.array([zlib.crc32(x) for x in own], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(x) for x in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    return map_arrow(data, documents, schema)


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return read_token_files(spark, path)
