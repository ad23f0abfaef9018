"""Whole-text token ids from a public tokenizer file.

Byte-level BPE splits a text into words before it merges. A space only ever
opens a word, a run of letters always ends one at an ASCII character that is
no letter, and a single line feed behind a visible character stands alone. So
a text in which every space is followed by a visible character can be cut
there into pieces that are encoded each on its own, and pieces that repeat
are encoded once. Numpy cuts a group of texts at a time and Arrow tells the
pieces apart, so that none is a Python object. New pieces go to the tokenizer
strung together where their ids can be told apart: by the token that opens
with a space, or by a line feed between runs of letters.
Any other text, and any text of another kind of tokenizer, goes there whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# Pieces of one generation of a worker's memo (about 15 MB). A full one
# becomes the old generation, of which pieces that come up again move over.
MEMO_PIECES = 400_000
# Characters of texts cut at once; a longer text is cut alone.
GROUP_CHARS = 2_000_000
# A lean encoder takes this share of both: less memory for more time.
LEAN_SHARE = 8
# New pieces strung together, and characters handed to the tokenizer at once: what
# it returns takes over a hundred bytes an id until the ids are taken from it.
STRING_PIECES = 500
CALL_CHARS = 100_000
# What \s stands for, and the vowel separator that some tables count as white space.
_WHITE = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u180e"
# A space before white space or at the end joins a run that the tokenizer
# splits by looking ahead; such texts stay whole, as do those with a NUL.
_RUN = f" (?:[{_WHITE}]|\\z)|\\x00"
_IS_ASCII_LETTER = np.zeros(256, dtype=bool)
_IS_ASCII_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
# À-ÖØ-öø-ÿ: this byte and one of those.
_LATIN = 0xC3
_IS_LATIN_SECOND = np.zeros(256, dtype=bool)
_IS_LATIN_SECOND[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a byte of UTF-8 opens a piece, for texts that start there; none is empty.

    Those are the starts, every space, an ASCII character behind a run of
    letters, and a letter behind a line feed that follows a visible character.
    """
    first = np.zeros(len(data), dtype=bool)
    first[starts] = True
    plain = _IS_ASCII_LETTER[data]
    pair = np.zeros(len(data), dtype=bool)
    pair[1:] = (data[:-1] == _LATIN) & _IS_LATIN_SECOND[data[1:]]
    ends = plain | pair
    opens = plain | np.append(pair[1:], False)
    out = data == ord(" ")
    out[1:] |= ends[:-1] & (data[1:] < 0x80) & ~_IS_ASCII_LETTER[data[1:]]
    seen = ends | ((data > ord(" ")) & (data < 0x7F))
    # a line feed that opens a text follows nothing
    feed = (data[1:-1] == ord("\n")) & seen[:-2] & ~first[1:-1]
    out[2:] |= feed & opens[2:]
    return out | first


def binaries(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Ids of pieces of these lengths, as an array of their bytes."""
    bounds = np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Encodes lists of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.forget()
        self.share = 1
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self.feeds = np.zeros(len(self.opens), dtype=bool)
        self.feeds[[i for token, i in vocab.items() if token == "Ċ"]] = True
        self.cuttable = (self.tokenizer.normalizer is None and bool(self.feeds.any())
                         and "ByteLevel(add_prefix_space=False" in repr(self.tokenizer.pre_tokenizer))

    def _ids(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, a call's worth of texts at a time; a longer text goes alone."""
        call, size = [], 0
        for text in texts:
            if call and size + len(text) > CALL_CHARS:
                yield from self._called(call)
                call, size = [], 0
            call.append(text)
            size += len(text)
        yield from self._called(call)

    def _called(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        """Empty the memo: pieces and, beside them, their ids."""
        self.memo = self.old = pa.array([], pa.large_string())
        self.memo_ids = self.old_ids = pa.array([], pa.large_binary())

    def _whole(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts behind each other, and how many each has."""
        found = list(self._ids(texts))
        return np.concatenate([np.array([], dtype="<u4"), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _strung(self, pieces: pa.Array, between: str, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that open with a space (``between`` empty), or that a line feed divides."""
        bounds = np.append(np.arange(0, len(pieces), STRING_PIECES), len(pieces))
        strings = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces), pa.scalar(between, pa.large_string()))
        ids, held = self._whole(between + x.as_py() for x in strings)
        opens = marks[ids]
        at = np.flatnonzero(opens)
        ends = np.cumsum(held)
        if (np.diff(np.searchsorted(at, ends), prepend=0) != np.diff(bounds)).any() or not opens[ends - held].all():
            raise ValueError("the tokenizer joins words across their bounds")
        lengths = np.diff(at, append=len(ids)) - len(between)
        return (ids[~opens] if between else ids), lengths

    def _new_pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces that the memo doesn't hold."""
        spaced = pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False)
        runs = pc.utf8_is_alpha(pieces).to_numpy(zero_copy_only=False)
        kinds = [np.flatnonzero(x) for x in (spaced, runs, ~spaced & ~runs)]
        some, letters, rest = [pieces.take(pa.array(x)) for x in kinds]
        found = [binaries(*self._strung(some, "", self.opens)), binaries(*self._strung(letters, "\n", self.feeds)),
                 binaries(*self._whole(rest.to_pylist()))]
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(kinds))))

    def _numbered(self, pieces: pa.Array) -> np.ndarray:
        """The places of pieces in the memo, which takes in those that it lacks."""
        if len(self.memo) > MEMO_PIECES // self.share:
            self.old, self.old_ids = self.memo, self.memo_ids
            self.memo, self.memo_ids = self.memo[:0], self.memo_ids[:0]
        coded = pa.chunked_array([self.memo, pieces]).dictionary_encode().chunks[-1]
        new = coded.dictionary[len(self.memo):]
        known = pc.index_in(new, value_set=self.old)
        unknown = known.is_null()
        ids = pa.concat_arrays([self.old_ids.take(known.drop_null()), self._new_pieces(new.filter(unknown))])
        # those of the old generation first, then the others, each at its own place
        order = np.argsort(np.argsort(unknown.to_numpy(zero_copy_only=False), kind="stable"))
        self.memo, self.memo_ids = coded.dictionary, pa.concat_arrays([self.memo_ids, ids.take(pa.array(order))])
        return coded.indices.to_numpy()

    def _by_piece(self, texts: pa.Array, tail: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that may be cut and aren't empty, with ``tail`` behind each.

        Distinct pieces are numbered by their places in the memo, and Arrow
        strings the ids of a text's pieces together.
        """
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
        ends = bounds[1:] - bounds[0]
        starts = np.flatnonzero(cuts(data, bounds[:-1] - bounds[0]))
        offsets = np.append(starts, len(data))
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        which = self._numbered(pieces)
        behind = np.searchsorted(starts, ends)
        which = np.insert(which, behind, len(self.memo))
        found = pa.concat_arrays([self.memo_ids, binaries(tail, np.array([len(tail)]))]).take(pa.array(which))
        done = np.frombuffer(found.buffers()[1], dtype=np.int64)[behind + np.arange(1, len(ends) + 1)] // tail.itemsize
        return np.split(np.frombuffer(found.buffers()[2], dtype="<u4")[:done[-1]], done[:-1])

    def encode(self, texts: list[str | None], end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text, null as empty, with ``end_id`` appended."""
        tail = np.array([] if end_id is None else [end_id], dtype="<u4")
        out: list[np.ndarray] = [tail] * len(texts)
        whole: list[int] = []
        groups: list[list[int]] = [[]]
        size = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.cuttable:
                whole.append(i)
                continue
            if size and size + len(text) > GROUP_CHARS // self.share:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(text)
        for group in filter(None, groups):
            held = pa.array([texts[i] for i in group], pa.large_string())
            runs = pc.match_substring_regex(held, _RUN).to_numpy(zero_copy_only=False)
            at = np.array(group)
            whole += at[runs].tolist()
            if not runs.all():
                for i, ids in zip(at[~runs].tolist(), self._by_piece(held.filter(pa.array(~runs)), tail), strict=True):
                    out[i] = ids
        for i, ids in zip(whole, self._ids(texts[i] for i in whole), strict=True):
            out[i] = np.concatenate([ids, tail])
        return out


_ENCODERS: dict[str, Encoder] = {}


@contextmanager
def encoder(path: str, lean: bool = False) -> Iterator[Encoder]:
    """The worker's encoder of a tokenizer file, loaded once.

    Its memo serves one task: a worker goes on to tasks of other kinds, which
    need the memory.
    """
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    found = _ENCODERS[path]
    found.share = LEAN_SHARE if lean else 1
    try:
        yield found
    finally:
        found.forget()
