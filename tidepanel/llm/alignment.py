"""Alignment of two tokenizers' tokens by interval coalescing.

Both tokenisations tile the bytes of a space and the text. All tokens of a
chunk of documents are sorted by their start; ``maximum.accumulate`` of their
ends gives how far the bytes are covered, and a group ends where a start
reaches that place. Within a group the overlapping pairs of tokens are
expanded. A document's boundary is such a place, so a chunk of documents is
aligned by a few operations over flat arrays.

How many documents hold a pair of ids is known only when all chunks are done.
A chunk therefore keeps its distinct pairs, with the number of its documents
that hold each, beside its documents' links as places in that list; sums over
the chunks are joined back to the lists. What is shuffled follows the distinct
pairs of a chunk, not the links.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, saved
from .tokens import PieceEncoder, default_pieces, default_tokenizer, encoder, piece_encoder

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
PARTS = ["doc_ids", *COUNTS, "digests", "distinct", "places", "times"]  # per document; the last two per distinct link of each
CHUNK = "chunk long, pairs binary, held binary, doc_ids array<long>, " + ", ".join(f"{c} binary" for c in PARTS[1:])
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def bytes_of_a(tokenizer) -> pa.Array:
    """The bytes of each id of a byte-level BPE file."""
    table, out = byte_level(), [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return pa.array(out, pa.large_binary())


def bytes_of_b(pieces: PieceEncoder) -> pa.Array:
    """The bytes of each id of a sentence piece model: U+2581 is a space, byte pieces are their byte."""
    model = pieces.model
    return pa.array([bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
                     for i in range(model.vocab_size())], pa.large_binary())


@functools.lru_cache(maxsize=2)
def _tables(path_a: str, path_b: str) -> tuple[pa.Array, pa.Array, pa.Array]:
    a, b = bytes_of_a(encoder(path_a, True).tokenizer), bytes_of_b(piece_encoder(path_b))
    names = [str(i) for i in range(max(len(a), len(b)))]
    return a, b, pa.array([n + sep for sep in (",", "|", ";", "") for n in names], pa.large_binary())


def _offsets(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]


def _bytes(values: pa.Array) -> np.ndarray:
    at = _offsets(values)
    return np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)[at[0]:at[-1]]


def _running(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def tokens_of(texts: pa.Array, path_a: str, path_b: str) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(which texts have tokens, per tokenizer of these: ids, their bytes' ends, number of each text)."""
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    tables, found = _tables(path_a, path_b)[:2], []
    want = np.diff(_offsets(spaced))
    fits = want > 1
    for table, (ids, at) in zip(tables, (encoder(path_a, True).encode(spaced), piece_encoder(path_b).encode(texts))):
        size = np.diff(_offsets(table))[ids]
        fits &= np.diff(_running(size)[at]) == want
        found.append((ids, np.diff(at), size))
    for again in (True, False):  # first those of a fitting length, so that bytes stand at the same places, then those of fitting bytes
        found = [(ids[np.repeat(fits, n)], n[fits], size[np.repeat(fits, n)]) for ids, n, size in found]
        spaced = spaced.filter(pa.array(fits))
        if again:
            bounds, same, left = _offsets(spaced) - _offsets(spaced)[0], np.ones(len(spaced), dtype=bool), np.flatnonzero(fits)
            for table, (ids, _, _) in zip(tables, found):
                odd = _running(_bytes(table.take(pa.array(ids))) != _bytes(spaced))
                same &= odd[bounds[1:]] == odd[bounds[:-1]]
            fits = same
    kept = np.zeros(len(texts), dtype=bool)
    kept[left[fits]] = True
    return kept, [(ids, np.cumsum(size, dtype=np.int64), n) for ids, n, size in found]


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A and each B token of two tilings of the same bytes, numbered from 0."""
    n = len(ends_a)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ends = np.concatenate([ends_a, ends_b])
    starts = np.concatenate([[0], ends_a[:-1], [0], ends_b[:-1]])
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(ends[order])
    new = np.zeros(len(order), dtype=bool)
    new[1:] = starts[order[1:]] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new)
    return group[:n], group[n:]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all pairs whose bytes overlap, by A token."""
    starts_a, starts_b = ends_a - np.diff(ends_a, prepend=0), ends_b - np.diff(ends_b, prepend=0)
    first = np.searchsorted(ends_b, starts_a, side="right")
    n = np.searchsorted(starts_b, ends_a, side="left") - first
    a = np.repeat(np.arange(len(ends_a)), n)
    return a, np.arange(len(a)) + np.repeat(first - (np.cumsum(n) - n), n)


def _digests(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, sizes: np.ndarray, names: pa.Array) -> list[bytes]:
    """SHA-256 of each text's groups: a1,a2|b1;a3|b2,b3. ``sizes``: tokens of both kinds of each text."""
    n, kinds = len(names) // 4, int(group_a[-1]) + 1 if len(a) else 0
    in_a, in_b = np.bincount(group_a, minlength=kinds), np.bincount(group_b, minlength=kinds)
    word = np.empty(len(a) + len(b), dtype=np.int64)
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    word[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + n * last_a
    word[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + 2 * n * last_b
    stops = np.cumsum(sizes)
    word[stops - 1] += n  # the last group of a text has no semicolon
    said = names.take(pa.array(word))
    raw, at = memoryview(_bytes(said)), (_offsets(said) - _offsets(said)[0])[np.concatenate([[0], stops])].tolist()
    return [hashlib.sha256(raw[x:y]).digest() for x, y in zip(at[:-1], at[1:])]


def align_texts(texts: pa.Array, path_a: str, path_b: str) -> dict[str, np.ndarray]:
    """A chunk of texts: per text its counts and digest; distinct pairs, how many texts hold each; each text's links as places in them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    kept, ((a, ends_a, n_a), (b, ends_b, n_b)) = tokens_of(texts, path_a, path_b)
    some = np.flatnonzero(kept)
    out = {c: np.zeros(len(texts), dtype="<i8") for c in [*COUNTS, "distinct"]}
    out["digests"] = np.zeros((len(texts), 32), dtype=np.uint8)
    empty = {"pairs": np.zeros(0, "<i8"), "held": np.zeros(0, "<u4"), "places": np.zeros(0, "<u4"), "times": np.zeros(0, "<u4")}
    if not len(some):
        return out | empty
    group_a, group_b = coalesce(ends_a, ends_b)
    out["n_a"][some], out["n_b"][some] = n_a, n_b
    out["n_groups"][some] = np.diff(np.append(group_a, group_a[-1] + 1)[_running(n_a)])
    out["digests"][some] = np.array([np.frombuffer(d, np.uint8) for d in _digests(a, b, group_a, group_b, n_a + n_b, _tables(path_a, path_b)[2])])
    at_a, at_b = overlaps(ends_a, ends_b)
    doc = np.repeat(np.arange(len(some)), n_a)[at_a]
    out["n_links"][some] = np.bincount(doc, minlength=len(some))
    pairs, place = np.unique((a[at_a].astype(np.int64) << 32) | b[at_b], return_inverse=True)
    links, times = np.unique(doc * len(pairs) + place, return_counts=True)
    doc, place = np.divmod(links, len(pairs))
    out["distinct"][some] = np.bincount(doc, minlength=len(some))
    return out | {"pairs": pairs.astype("<i8"), "held": np.bincount(place, minlength=len(pairs)).astype("<u4"), "places": place.astype("<u4"), "times": times.astype("<u4")}


def _chunk_rows(path_a: str, path_b: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), size):
                got = align_texts(texts.slice(a, b - a), path_a, path_b)
                got = {k: pa.array([v.tobytes()], pa.binary()) for k, v in got.items()} | {"doc_ids": pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(pa.int64()))}
                names = ["pairs", "held", *PARTS]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[got[n] for n in names]], names=["chunk", *names])
                number += 1

    return run


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            pairs, held = np.frombuffer(batch["pairs"][i].as_py(), "<i8"), np.frombuffer(batch["held"][i].as_py(), "<u4")
            for a in range(0, len(pairs), 1 << 16):
                some = pairs[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), batch["chunk"][i].as_py())), pa.array(some), pa.array(held[a:a + (1 << 16)].astype(np.int64))], names=["chunk", "pair", "n"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by chunk: first the counts of its pairs, in order, then the chunk itself (pair is NULL)."""
    said: list[np.ndarray] = []
    for batch in batches:
        own = batch["pair"].is_null().to_numpy(zero_copy_only=False)
        at = 0
        for i in [*np.flatnonzero(own).tolist(), batch.num_rows]:
            if i > at:
                said.append(batch["value"].slice(at, i - at).to_numpy(zero_copy_only=False).astype(np.int64))
            at = i + 1
            if i < batch.num_rows:
                row = {c: batch[c][i].as_py() for c in PARTS}
                value, said = np.concatenate(said) if said else np.zeros(0, dtype=np.int64), []
                whole = {c: np.frombuffer(row[c], "<i8") for c in [*COUNTS, "distinct"]}
                place, times = np.frombuffer(row["places"], "<u4"), np.frombuffer(row["times"], "<u4").astype(np.int64)
                ends = np.cumsum(whole["distinct"])
                sums = [_running(times * x)[ends] - _running(times * x)[ends - whole["distinct"]] for x in (value[place] & 1, value[place] >> 1)]
                digests = row["digests"].hex()
                sha = [digests[64 * k:64 * k + 64] if n else "" for k, n in enumerate(whole["n_a"].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *[pa.array(whole[c]) for c in COUNTS], *map(pa.array, sums), pa.array(sha, pa.string())],
                                                 names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])


def align_tokenizers(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None, chunk_bytes: int = 2 << 20,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How a byte-level BPE file (A) and a sentence piece model (B) cut each whole text: one row per row of ``docs``.

    n_a, n_b, n_groups, n_links count tokens, groups and overlapping pairs of
    a space and the text. A pair of ids counts in as many documents as hold it
    linked; n_best are links whose count is the highest of their A id (ties
    included), count_sum is the sum over links. groups_sha256 is the digest of
    the groups' ids. Texts that are NULL, empty or not given back by the
    bytes of A or B have zeros and an empty digest. Repeated rows are
    documents of their own and counted each; NULL ids stay NULL. An empty
    table gives an empty result. A text longer than ``chunk_bytes`` is a
    chunk of its own, aligned as a whole.
    """
    path_a, path_b = tokenizer_a or default_tokenizer(), tokenizer_b or default_pieces()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = saved(map_arrow(rows, _chunk_rows(path_a, path_b, chunk_bytes), CHUNK), "aligned", rows_at_once=4)
    held = map_arrow(done.select("chunk", "pairs", "held"), _held, "chunk long, pair long, n long")
    counts = saved(held.groupBy("pair").agg(F.sum("n").alias("n")), "aligned-counts")
    a_id = F.shiftright("pair", 32)
    best = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    told = counts.withColumn("a", a_id).join(best, "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("value"))
    values = held.select("chunk", "pair").join(told, "pair").select("chunk", "pair", "value")
    own = done.select("chunk", *PARTS)
    both = values.unionByName(own, allowMissingColumns=True)
    return map_arrow(both.repartition("chunk").sortWithinPartitions("chunk", F.col("pair").asc_nulls_last()), _answers, ALIGNED)
