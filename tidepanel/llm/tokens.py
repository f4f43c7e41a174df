"""Whole texts to token ids, a column at a time.

Both kinds of vocabulary file split a text at places that no token crosses,
and encode what lies between independently. Each distinct piece of a batch is
therefore encoded once and the ids of the texts are put together from the
pieces with Arrow, which gives the ids of the library's own ``encode`` at a
fraction of its time. Pieces are remembered between batches up to a number of
bytes; beyond it, those of the last batch stay.

Byte-level BPE splits before a space that a non-space follows, around a line
feed between two non-spaces, and between a letter or number and punctuation.
Sentence pieces split before a space that follows a non-space, if no piece of
the vocabulary holds a space after another character. Texts that hold a NUL,
or the string of a special token that is to be found, are encoded whole.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"  # of Unicode (RE2)
# white space other than single blanks or line feeds between other characters
_UNEVEN = r"[\s\x0b][\s\x0b]|[\t\r\x0b\f\x1c-\x1f]|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BEFORE_WORD = re.compile(r"(?= \S)")
_PLAIN = rf"^ ?[^{_SPACES}]+$"  # nothing that could join with a line feed beside it
_TAIL = r"([\pL\pN])([.,;:!?|%*$#&]+)$"


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Array of byte strings: ``ids`` (uint32) cut at ``ends`` (numbers of ids)."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, dtype="<u4"))])


def _joined(parts: pa.Array, at: np.ndarray) -> pa.Array:
    """Byte strings of runs of ``parts``, a run from each of ``at`` to the next."""
    offsets = np.frombuffer(parts.buffers()[1], dtype=np.int64)[parts.offset:parts.offset + len(parts) + 1][at] if len(parts) else np.zeros(len(at), dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets)), parts.buffers()[2]])


def _once(values: pa.Array, encode) -> pa.Array:
    """``encode`` of each distinct value, put back in place."""
    words = values.dictionary_encode()
    return encode(words.dictionary).take(words.indices) if len(values) else pa.array([], pa.large_binary())


class _Known:
    """Pieces and their ids, at most ``most`` bytes of both and what one batch has."""

    def __init__(self, encode, most: int = 16 << 20):
        self.encode, self.most = encode, most
        self.pieces, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def __call__(self, pieces: pa.Array) -> pa.Array:
        at = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(pc.is_null(at))
        ids = pa.concat_arrays([self.ids, self.encode(new)])
        place = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.ids) + np.arange(len(new))
        found = ids.take(pa.array(place))
        self.pieces, self.ids = pa.concat_arrays([self.pieces, new]), ids
        if self.pieces.nbytes + self.ids.nbytes > self.most:
            self.pieces, self.ids = pieces, found
        return found


class _ByPieces:
    """``encode(texts)`` -> (ids as one uint32 array, offset of each text)."""

    special: list[str] = []
    apart = True  # whether texts can be split

    def _whole(self, text: str) -> list[int]:
        raise NotImplementedError

    def _split(self, texts: pa.Array, skip: np.ndarray) -> pa.Array:
        """The pieces of each text joined by NUL; those of ``skip`` do not matter."""
        raise NotImplementedError

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Byte strings of the ids of distinct pieces."""
        raise NotImplementedError

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        whole = pc.match_substring(texts, "\0") if self.apart else pa.repeat(pa.scalar(True), n)
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        whole = whole.to_numpy(zero_copy_only=False)
        apart = {int(i): self._whole(texts[int(i)].as_py()) for i in np.flatnonzero(whole)}
        split = self._split(texts, whole)
        if apart:
            split = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), split)
        lists = pc.split_pattern(split, "\0")
        ids = _joined(_once(lists.flatten(), self._pieces), lists.offsets.to_numpy(zero_copy_only=False))
        bounds = np.frombuffer(ids.buffers()[1], dtype=np.int64) // 4 if n else np.zeros(1, dtype=np.int64)
        flat = np.frombuffer(ids.buffers()[2] or b"", dtype="<u4")[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        if apart:
            parts = [np.array(apart[i], dtype="<u4") if i in apart else flat[bounds[i]:bounds[i + 1]] for i in range(n)]
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            flat = np.concatenate(parts)
        return flat, bounds


class Encoder(_ByPieces):
    """Byte-level BPE. With ``plain_special`` the strings of special tokens are ordinary text."""

    def __init__(self, path: str, joined: int = 2000, plain_special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.joined = Tokenizer.from_file(path), joined
        self.tokenizer.encode_special_tokens = plain_special
        self.special = [] if plain_special else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self._parts)
        feed = self._whole("\n")
        # pieces are encoded many at a time, separated by a line feed, if that always is one token of its own
        probe = self._whole("a\nb\n c\n.")
        self.feed = feed[0] if len(feed) == 1 and probe.count(feed[0]) == 3 else None

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _split(self, texts: pa.Array, skip: np.ndarray) -> pa.Array:
        split = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        odd = np.flatnonzero(pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False) & ~skip)
        if len(odd):
            rows = ["\0".join(_BEFORE_WORD.split(texts[int(i)].as_py())) for i in odd]
            mask = np.zeros(len(texts), dtype=bool)
            mask[odd] = True
            split = pc.replace_with_mask(split, pa.array(mask), pa.array(rows, pa.large_string()))
        return split

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        parts = pc.split_pattern(pc.replace_substring_regex(pieces, _TAIL, "\\1\0\\2"), "\0")
        return _joined(_once(parts.flatten(), self.known), parts.offsets.to_numpy(zero_copy_only=False))

    def _parts(self, parts: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(parts, _PLAIN).to_numpy(zero_copy_only=False) if self.feed is not None else np.zeros(len(parts), dtype=bool)
        some, found = parts.filter(pa.array(plain)), []
        for a in range(0, len(some), self.joined):
            enc, = self.tokenizer.encode_batch_fast(["\n".join(some.slice(a, self.joined).to_pylist())], add_special_tokens=False)
            found += [np.array(enc.ids, dtype="<u4"), np.array([self.feed], dtype="<u4")]
        flat = np.concatenate(found) if found else np.zeros(0, "<u4")
        feeds = np.flatnonzero(flat == self.feed) if found else np.zeros(0, dtype=np.int64)
        if len(feeds) != len(some):
            raise ValueError("a line feed did not stay a token of its own")
        ids = [_binary(flat[flat != self.feed] if found else flat, feeds - np.arange(len(feeds)))]
        odd = [np.array(self._whole(p), dtype="<u4") for p in parts.filter(pa.array(~plain)).to_pylist()]
        if odd:
            ids.append(_binary(np.concatenate(odd), np.cumsum([len(o) for o in odd])))
        place = np.where(plain, np.cumsum(plain) - 1, len(some) + np.cumsum(~plain) - 1)
        return pa.concat_arrays(ids).take(pa.array(place))


class PieceEncoder(_ByPieces):
    """Sentence pieces of a space and each text; that space is the one the model adds itself."""

    special = ["\u2581"]  # stands for a space too

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.known = _Known(self._parts)
        self.space = self.model.piece_to_id("\u2581")
        # no piece crosses a space, and a single one is a piece
        self.apart = self.space != self.model.unk_id() and not any("\u2581" in p.lstrip("\u2581") for p in pieces)

    def _whole(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def _split(self, texts: pa.Array, skip: np.ndarray) -> pa.Array:
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        single = pc.replace_substring(texts, " ", "\0 ")
        odd = pc.match_substring(texts, "  ")
        if pc.any(odd).as_py():
            several = pc.replace_substring_regex(texts.filter(odd), "([^ ]) ", "\\1\0 ")
            single = pc.replace_with_mask(single, odd, several)
        return single

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        return self.known(pieces)

    def _parts(self, pieces: pa.Array) -> pa.Array:
        rest = pc.utf8_slice_codeunits(pieces, 1).to_pylist()
        ids = self.model.encode(rest, num_threads=1)
        for i in np.flatnonzero(pc.equal(pieces, " ").to_numpy(zero_copy_only=False)):
            ids[i] = [self.space]  # the library gives an empty text no space
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return _binary(np.fromiter((x for own in ids for x in own), dtype="<u4", count=int(sizes.sum())), np.cumsum(sizes))


def with_end(flat: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets with ``end_id`` after each text."""
    n = len(at) - 1
    return np.insert(flat, at[1:], np.uint32(end_id)).astype("<u4", copy=False), at + np.arange(n + 1)


@functools.lru_cache(maxsize=2)
def encoder(path: str, plain_special: bool = False) -> Encoder:
    """One per worker process, kept between tasks."""
    return Encoder(path, plain_special=plain_special)


@functools.lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One per worker process, kept between tasks."""
    return PieceEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
