"""Alignment of two tokenizers against a plain walk over bytes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidepanel.llm.alignment import align_tokenizers, coalesce, overlaps
from tidepanel.llm.tokens import Encoder, PieceEncoder, default_pieces, default_tokenizer

from .helpers import ODD, frame, prose

SIGNS = [*" \n\t\r.,'!ab1é漢  \x85\0\x0b", "▁", "ﬁ", "'s", "  ", "   ", " a", "word", "<|endoftext|>", "<s>", "<0x41>", " 12"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(default_tokenizer())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=default_pieces())


def plain_tokens(models, text):
    """[(id, bytes)] of A and of B; empty if either does not give the text back."""
    if not text:
        return [], []
    a, b = models
    own = []
    enc = a.encode(" " + text, add_special_tokens=False)
    chars = {c: i for i, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], [chr(i) for i in [*range(33, 127), *range(161, 173), *range(174, 256)]])}
    n = 0
    for i in range(256):
        if i not in chars.values():
            chars[chr(256 + n)] = i
            n += 1
    own.append([(i, bytes(chars[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)])
    own.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
    want = (" " + text).encode()
    return own if all(b"".join(x[1] for x in side) == want for side in own) else ([], [])


def plain_alignment(models, docs):
    aligned, held = [], {}
    for doc_id, text in docs:
        a, b = plain_tokens(models, text)
        spans = [np.cumsum([0, *[len(t[1]) for t in side]]).tolist() for side in (a, b)]
        links = [(x[0], y[0]) for i, x in enumerate(a) for j, y in enumerate(b) if spans[0][i] < spans[1][j + 1] and spans[1][j] < spans[0][i + 1]] if len(a) < 2000 else None
        cuts = sorted(set(spans[0][1:]) & set(spans[1][1:]))
        said, lo = [], 0
        for hi in cuts:
            said.append(",".join(str(x[0]) for i, x in enumerate(a) if lo <= spans[0][i] < hi) + "|" + ",".join(str(y[0]) for j, y in enumerate(b) if lo <= spans[1][j] < hi))
            lo = hi
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
        aligned.append((doc_id, a, b, links, len(cuts), hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    return [(d, len(a), len(b), n, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha) for d, a, b, links, n, sha in aligned]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join), max_size=6))
def test_encoders_give_the_libraries_ids(models, texts):
    for enc, own in ((Encoder(default_tokenizer(), plain_special=True), lambda t: models[0].encode(t, add_special_tokens=False).ids), (PieceEncoder(default_pieces()), models[1].encode)):
        flat, at = enc.encode(pa.array(texts, pa.string()))
        assert [flat[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [own(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(st.sets(st.integers(1, n)).map(lambda s: sorted(s | {n})), st.sets(st.integers(1, n)).map(lambda s: sorted(s | {n})))))
def test_groups_and_overlaps(ends):
    a, b = (np.array(e) for e in ends)
    ga, gb = coalesce(a, b)
    common = sorted(set(ends[0]) & set(ends[1]))
    assert ga.tolist() == [sum(c < e for c in common) for e in ends[0]] and gb.tolist() == [sum(c < e for c in common) for e in ends[1]]
    sa, sb = [0, *ends[0]], [0, *ends[1]]
    assert list(zip(*(x.tolist() for x in overlaps(a, b)))) == [(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < sb[j + 1] and sb[j] < sa[i + 1]]


@pytest.mark.parametrize("size", [200, 2 << 20])
def test_against_a_plain_walk(spark, models, size):
    rng = random.Random(4)
    docs = [r for r in ODD if r[0] != 11] + [(100 + i, "".join(rng.choice(SIGNS) for _ in range(rng.randint(1, 40)))) for i in range(60)] + [(200 + i, prose(i, 60)) for i in range(12)] + [(300, prose(3, 60)), (300, prose(3, 60))]
    got = align_tokenizers(frame(spark, docs), chunk_bytes=size).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_alignment(models, docs)))
    assert sum(r.n_a > 0 for r in got) > 40 and any(r.n_a == 0 for r in got)


def test_empty_table_and_a_long_text(spark, models):
    assert align_tokenizers(frame(spark, []).limit(0)).count() == 0
    text = prose(9, 30_000)
    row = align_tokenizers(frame(spark, [(1, text)]), chunk_bytes=1000).collect()[0]
    a, b = plain_tokens(models, text)
    assert (row.n_a, row.n_b, row.n_best >= row.n_links - row.count_sum + row.n_best) == (len(a), len(b), True) and row.count_sum == row.n_links  # in one document
