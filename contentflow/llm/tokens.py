"""Token ids of whole texts, by a public vocabulary file and the tokenizers library.

The vocabulary folds case, drops white space and splits letters from punctuation before
it merges anything.  So a text's ids are those of its words (parts between ASCII white
space) one after another, and a word's ids are those of its lower-case form without
trailing ASCII punctuation (after a letter or digit) and then those of that punctuation.  Each distinct form of a task is
encoded once; forms are encoded many to a call: those of letters only are told apart by
the vocabulary's word-end marks, others by a special token between them.  Words that hold
``<|`` (special tokens) are left whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from contentflow.llm.common import mix64, trim, words_of

U64 = np.uint64


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TAIL = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""


def _byte_flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


IN_TAIL = _byte_flags(TAIL)
LETTER_OR_DIGIT = _byte_flags("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOWER = np.array([ord(chr(i).lower()) if i < 128 else i for i in range(256)], np.uint8)
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)  # of a little-endian number


def bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a column without nulls."""
    strings = strings.cast(pa.large_string())
    _, offsets, data = strings.buffers()
    if not len(strings) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(strings) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def stem_ends(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the tail of every word begins; its end, if it has none.

    A tail follows an ASCII letter or digit or one of U+00C0 to U+024F that is a letter; after
    other characters punctuation is one run with them (so it is after U+0130, whose lower case
    ends in a combining mark)."""
    if not len(starts):
        return ends
    solid = np.maximum.accumulate(np.where(IN_TAIL[raw], 0, np.arange(1, len(raw) + 1)))
    cut = solid[ends - 1]
    at = np.flatnonzero((cut > starts) & (cut < ends))
    last = raw[cut[at] - 1]
    pair = raw[np.maximum(cut[at] - 2, 0)].astype(np.int64) << 8 | last  # UTF-8 of two bytes
    latin = (last >= 0x80) & (pair >= 0xC380) & (pair <= 0xC98F) & ~np.isin(pair, (0xC397, 0xC3B7, 0xC4B0))
    at = at[LETTER_OR_DIGIT[last] | latin]
    out = ends.copy()
    out[at] = cut[at]
    return out


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of all elements of the runs ``starts[i] : starts[i] + sizes[i]``."""
    done = np.cumsum(sizes)
    n = int(done[-1]) if len(done) else 0
    kind = np.int32 if n < 1 << 31 and (len(starts) == 0 or starts.max() < 1 << 31) else np.int64
    return np.arange(n, dtype=kind) + np.repeat((starts - (done - sizes)).astype(kind), sizes)


def texts_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[str]:
    """The texts ``data[start:start + size]``."""
    raw = data[gather(starts, sizes)]
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(raw)).to_numpy(zero_copy_only=False).tolist()


class FormTable:
    """Numbers of word forms, by 128 bits instead of the text (the bytes themselves up to 15,
    hashes of longer forms): a sorted main part and a small recent part, as plain arrays."""

    HASHES = "0123456789abcdef", "fedcba9876543210"
    SHORT = 15

    def __init__(self):
        self.main = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int32))
        self.recent = self.main

    @classmethod
    def keys(cls, padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers for every form ``padded[start:start + size]``; 16 bytes of padding follow the last.

        The second one's highest byte is the size, 255 for hashes; the first is a bijection of
        the first 8 bytes for every second one."""
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        b = words[starts + 8] & FIRST_BYTES[np.clip(sizes - 8, 0, 7)] | np.minimum(sizes, 255).astype(U64) << U64(56)
        a = mix64(words[starts] & FIRST_BYTES[np.minimum(sizes, 8)] ^ mix64(b))
        long = np.flatnonzero(sizes > cls.SHORT)
        if len(long):
            forms = np.array(texts_of(padded, starts[long], sizes[long]), object)
            a[long], b[long] = (pd.util.hash_array(forms, hash_key=k, categorize=False) for k in cls.HASHES)
            b[long] |= U64(255 << 56)
        return a, b

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of every form, -1 for those not there."""
        out = np.full(len(a), -1, np.int64)
        for ka, kb, number in (self.main, self.recent):
            if len(ka):
                at = np.minimum(np.searchsorted(ka, a), len(ka) - 1)
                hit = (ka[at] == a) & (kb[at] == b)
                out[hit] = number[at[hit]]
        return out

    def add(self, a: np.ndarray, b: np.ndarray, numbers: np.ndarray):
        merged = [np.concatenate(x) for x in zip(self.recent, (a, b, numbers.astype(np.int32)))]
        full = len(merged[0]) > max(50_000, len(self.main[0]) // 8)
        if full:
            merged = [np.concatenate(x) for x in zip(self.main, merged)]
        order = np.argsort(merged[0], kind="stable")
        merged = tuple(x[order] for x in merged)
        if full:
            self.main, self.recent = merged, tuple(x[:0] for x in merged)
        else:
            self.recent = merged


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker process's encoder: its cache outlives a task.

    Spark runs a task per core; threads of the library's own would only hold memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def release() -> None:
    """Give back the memory of earlier tasks' encoders and of Arrow's pool."""
    encoder.cache_clear()
    trim()


class WordEncoder:
    """Encodes columns of texts; word forms seen before come from a bounded cache."""

    def __init__(self, path: str, cache: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.type = np.uint16 if self.vocab <= 1 << 16 else np.uint32
        self.last = np.zeros(self.vocab, bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.last[i] = token.endswith("</w>")
        # A token that stands alone wherever it is written: put between forms, it keeps them apart.
        added = self.tokenizer.get_added_tokens_decoder().items()
        alone = [(i, t.content) for i, t in added if not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.mark, self.between = min(alone, default=(-1, ""))
        self.limit = cache
        self._reset()

    def _reset(self):
        self.table = FormTable()
        self.ids = np.zeros(1 << 16, self.type)
        self.ends = np.zeros(1 << 12, np.int64)  # form k has ids[ends[k - 1]:ends[k]]; form 0 is empty
        self.forms = 1

    def _store(self, ids: np.ndarray, sizes: np.ndarray):
        at, n = int(self.ends[self.forms - 1]), len(sizes)
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids) // 2, self.type)))
        while self.forms + n > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(len(self.ends) // 2, np.int64)))
        self.ids[at:at + len(ids)] = ids
        self.ends[self.forms:self.forms + n] = at + np.cumsum(sizes)
        self.forms += n

    def _learn(self, forms: list[str]) -> np.ndarray:
        """Encode the forms; their numbers."""
        plain = np.array([f.isalpha() for f in forms], bool)
        numbers = np.zeros(len(forms), np.int64)
        letters, other = np.flatnonzero(plain), [np.flatnonzero(~plain)]
        for a in range(0, len(letters), 1024):
            part = letters[a:a + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([forms[i] for i in part])], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                numbers[part] = self.forms + np.arange(len(part))
                self._store(ids, np.diff(ends, prepend=0))
            else:  # some form is not one word to the vocabulary
                other.append(part)
        other = np.concatenate(other)
        for a in range(0, len(other), 1024):
            part = other[a:a + 1024]
            numbers[part] = self.forms + np.arange(len(part))
            self._store(*self._encode_marked([forms[i] for i in part]))
        return numbers

    def _encode_marked(self, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the forms one after another, and how many each has."""
        if self.between:
            ids = np.array(self.tokenizer.encode_batch_fast([self.between.join(forms)], add_special_tokens=False)[0].ids, np.int64)
            mark = ids == self.mark
            at = np.flatnonzero(mark)
            if len(at) == len(forms) - 1:  # else a form holds the mark itself
                return ids[~mark], np.diff(at, prepend=-1, append=len(ids)) - 1
        each = [e.ids for e in self.tokenizer.encode_batch_fast(forms, add_special_tokens=False)]
        return np.array([i for x in each for i in x], np.int64), np.array([len(x) for x in each], np.int64)

    def _slots(self, padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of every form ``padded[start:start + size]``."""
        a, b = FormTable.keys(padded, starts, sizes)
        slot = self.table.find(a, b)
        fresh = np.flatnonzero(slot < 0)
        if len(fresh):
            fresh = fresh[np.lexsort((b[fresh], a[fresh]))]
            new = np.ones(len(fresh), bool)
            new[1:] = (a[fresh[1:]] != a[fresh[:-1]]) | (b[fresh[1:]] != b[fresh[:-1]])
            first = fresh[new]
            numbers = self._learn(texts_of(padded, starts[first], sizes[first]))
            self.table.add(a[first], b[first], numbers)
            slot[fresh] = numbers[np.cumsum(new) - 1]
        return slot

    def encode(self, texts: pa.Array, end_id: int | None = None):
        """``(offsets, ids)`` of all texts; ``end_id`` closes every text."""
        offsets, codes, words = words_of(texts)
        raw, at = bytes_of(words)
        starts, ends = at[:-1], at[1:]
        cut = stem_ends(raw, starts, ends)
        padded = np.zeros(len(raw) + 16, np.uint8)
        padded[:len(raw)] = LOWER[raw]
        special = pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        if special.any():
            cut = np.where(special, ends, cut)
            whole = gather(starts[special], (ends - starts)[special])
            padded[whole] = raw[whole]
        if self.forms + len(words) > self.limit:
            self._reset()
        tails = np.flatnonzero(cut < ends)
        slots = self._slots(padded, np.concatenate((starts, cut[tails])), np.concatenate((cut - starts, (ends - cut)[tails])))
        both = np.zeros((len(words), 2), np.int64)
        both[:, 0] = slots[:len(words)]
        both[tails, 1] = slots[len(words):]
        both = both.ravel()
        # Ids of this run's distinct words, one after another; the end id stands last.
        starts = np.concatenate(([0], self.ends[:self.forms]))
        size = starts[both + 1] - starts[both]
        own = self.ids[gather(starts[both], size)]
        edges = np.concatenate(([0], np.cumsum(size)))[::2]
        n = len(offsets) - 1
        if end_id is not None:  # one more piece after each text's words
            own, edges = np.append(own, self.type(end_id)), np.append(edges, len(own) + 1)
            inner = np.ones(len(codes) + n, bool)
            inner[offsets[1:] + np.arange(n)] = False
            pieces = np.full(len(codes) + n, len(edges) - 2, np.int64)
            pieces[inner] = codes
            codes, offsets = pieces, offsets + np.arange(n + 1)
        # Arrow copies each piece's ids as a run of bytes.
        width = own.itemsize
        cells = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges * width), pa.py_buffer(own)])
        _, done, data = cells.take(pa.array(codes)).buffers()
        if not len(codes) or data is None:
            return np.zeros(n + 1, np.int64), own[:0]
        done = np.frombuffer(done, np.int64)[offsets] // width
        return done, np.frombuffer(data, own.dtype, int(done[-1]))
