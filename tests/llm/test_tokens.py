"""Token files and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidepanel.llm import packing
from tidepanel.llm import token_files as tf
from tidepanel.llm.packing import Bins, cuts, pack, pack_documents, token_pieces
from tidepanel.llm.tokens import Encoder, default_tokenizer

from .helpers import ODD, frame, prose


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def enc():
    return Encoder(default_tokenizer())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\r.,'!ab1é漢\u00a0\u2003\x1c\x85\0\x0b", "'s", "  ", " a", "word"]), max_size=30).map("".join), max_size=6))
def test_encoder_gives_the_tokenizers_ids(plain, enc, texts):
    flat, at = enc.encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(plain, t) for t in texts]


def test_encoder_on_many_random_texts(plain):
    enc, rng = Encoder(default_tokenizer()), random.Random(5)
    signs = [*" \n\t\r.,'!ab1é漢\u00a0\u2003\x1c\x85\0\x0b", "'s", "  ", " a", "word", "\n\n", "|%", "<|endoftext|>", " 12"]
    for _ in range(500):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(6)]
        flat, at = enc.encode(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(plain, t) for t in texts]


def test_encoder_odd_texts(plain, enc):
    texts = [t for _, t in ODD]
    flat, at = enc.encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(plain, t) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 60_000), st.integers(0, 2 ** 31))
def test_block_round_trip_and_checkpoints(n, kinds, seed):
    rng = np.random.default_rng(seed)
    ids = (rng.pareto(1.0, n) * 3).astype(np.int64) % kinds
    symbols, freqs, bits = tf.frequency_table(ids)
    assert freqs.min() >= 1 and int(freqs.sum()) == 1 << bits
    data, steps, words = tf.encode_block(ids, symbols, freqs, bits, 16, 8)
    table = tf.Table(symbols.tobytes(), freqs.tobytes(), bits)
    assert (tf.decode_block(data, n, table, 16, steps, words) == ids).all()
    parts = [tf.decode_block(data, n, table, 16, steps, words, only=k) for k in range(len(steps))]
    assert (np.concatenate(parts) == ids).all()


def test_token_files_odd_rows(spark, plain, tmp_path):
    docs = frame(spark, ODD)
    tf.write_token_files(docs, str(tmp_path / "t"), shard_tokens=5000, lanes=8, block_steps=64, checkpoint_steps=16)
    got = sorted(tf.read_token_files(spark, str(tmp_path / "t"), with_ids=True).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    assert [r.doc_id for r in got][:2] == [None, None]
    assert [r.doc_id for r in got[2:]] == sorted(r.doc_id for r in got[2:])
    want = sorted((str(d), np.array(ids_of(plain, t) + [0], "<u4").tobytes()) for d, t in ODD)
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == want


def test_damaged_block_is_found(spark, tmp_path):
    tf.write_token_files(frame(spark, [(1, prose(3, 200))]), str(tmp_path / "t"))
    rows = spark.read.schema(tf.SHARD).parquet(str(tmp_path / "t")).collect()
    bad = [r.asDict(True) | {"payload": bytes(r.payload[:-3]) + b"xyz"} for r in rows]
    spark.createDataFrame(bad, tf.SHARD).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="checksum"):
        tf.read_token_files(spark, str(tmp_path / "bad")).collect()


def cut(n, most):
    """(start, length) of the pieces of one text, one after the other."""
    first = n % most or most
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def test_cuts():
    sizes = [5, 8, 3, 1, 4, 9]
    doc, piece, start, length = (x.tolist() for x in cuts(np.array(sizes), 4))
    assert list(zip(start, length)) == [p for n in sizes for p in cut(n, 4)]
    assert doc == [i for i, n in enumerate(sizes) for _ in cut(n, 4)] and piece == [k for n in sizes for k in range(len(cut(n, 4)))]


def test_best_fit_and_fullest_first():
    bins = Bins(10, 2)
    assert bins.put(6) == (0, 0) and bins.put(7) == (1, 0)
    assert bins.put(3) == (1, 7)  # the tightest place, which fills it
    assert bins.put(9) == (2, 0) and bins.put(5) == (3, 0)  # a third bin: that with 9 closes first
    assert sorted(bins.open_bins()) == [0, 3]


def test_pack_documents_odd_rows(spark, plain):
    rows = ODD + [(100 + i, prose(i, 5 + 37 * i % 900)) for i in range(60)]
    got = pack_documents(frame(spark, rows), open_bins=8).collect()
    want = {}
    for d, t in rows:
        own = np.array(ids_of(plain, t) + [0], "<u4")
        for k, (s, n) in enumerate(cut(len(own), 2048)):
            want.setdefault((d, k, s, n, zlib.crc32(own[s:s + n].tobytes())), []).append(1)
    seen = {}
    for r in got:
        seen.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert seen == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 2048) * 1.15 + 1


def test_rounds_merge_what_partitions_leave_open(spark):
    items = spark.range(4000).selectExpr("id", "1 + id % 700 AS length").repartition(40)
    got = pack(items, "length", 1000, open_bins=4).groupBy("sequence_id").agg({"length": "sum"}).collect()
    total = sum(1 + i % 700 for i in range(4000))
    assert max(r[1] for r in got) <= 1000 and sum(r[1] for r in got) == total and len(got) <= 1.25 * total / 1000


def test_empty_tables(spark, tmp_path):
    none = frame(spark, []).limit(0)
    assert pack_documents(none).count() == 0 and token_pieces(none, with_ids=True).count() == 0
    tf.write_token_files(none, str(tmp_path / "e"))
    assert tf.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_pieces_of_a_batch_are_cut_a_few_texts_at_a_time(spark, monkeypatch, enc):
    seen, texts = [], ["word " * 100_000, None, "", "more " * 60_000, "x y " * 400_000, *["some " * 20_000] * 12]

    class Noted:
        def encode(self, own):
            seen.append((len(own), pa.compute.sum(pa.compute.binary_length(own)).as_py() or 0))
            return enc.encode(own)

    monkeypatch.setattr(packing, "encoder", lambda path: Noted())
    monkeypatch.setattr(packing, "map_arrow", lambda docs, fn, schema: fn)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    rows = [r for out in token_pieces(frame(spark, [(1, "")]))(iter([batch])) for r in out.to_pylist()]
    assert sum(n for n, _ in seen) == len(texts) and all(n == 1 or size <= 1 << 20 for n, size in seen)
    flat, at = enc.encode(batch.column(1))
    assert [sum(r["length"] for r in rows if r["doc_id"] == i) for i in range(len(texts))] == (np.diff(at) + 1).tolist()
