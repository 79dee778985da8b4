"""Token ids of Arrow batches of texts, piece by piece with a bounded cache.

Both tokenizers used here give the ids of a text as the joined ids of its pieces when the text is
cut at places that none of their patterns reach across, so each distinct piece is encoded once by
the tokenizers library and later only looked up. Texts in which such places are not certain (other
white space than single blanks and newlines, or the start of a special token) are encoded whole.
Words of letters that normalizers and patterns leave as they are go to the library's model alone,
many in a call, which takes a third of the time.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space besides blank and newline, and the separators that some libraries take for it.
OTHER_SPACE = (
    r"[\x{09}\x{0B}-\x{0D}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
CUT = "\x1f"
#: Marks at the end of a word; both tokenizers part them from the letter before.
LAST_MARKS = r"(\pL)([!-/:-@\[-`{-~]+)([ \n]|$)"
#: Words of lower-case letters that are composed and compose with none of the others.
LETTERS = re.compile("[a-zß-öø-ÿα-ωа-џ\u4e00-\u9fa5]+")
JOINED = 64  # such words in a call
WIDTH = 6  # numbers of a key: 47 bytes of a piece and how many there are
LONGEST_KEPT = 8 * WIDTH - 1  # bytes; longer pieces hardly come back
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * k * k + 1) % (1 << 64) for k in range(WIDTH)], np.uint64)
SLOT_BITS = 21
AT_ONCE = 4096  # what the library returns for a piece is far larger than its ids


class PieceEncoder:
    """Encodes texts with a tokenizer file of the tokenizers library.

    word_level: the tokenizer drops white space and lower-cases, so pieces are words; otherwise a
    piece keeps the white space before it. limit: pieces in the cache at which all go but those
    that were found in it since the last time; if these are more than half, those of the current batch.
    """

    def __init__(self, path: str, word_level: bool, limit: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)  # what is left of the whole for words of letters
        bare = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bare])
        self.tokenizer.encode_special_tokens = not word_level
        self.word_level, self.limit = word_level, limit
        self.forget()

    def forget(self) -> None:
        self.ids = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # ends[c + 1]: where the ids of code c end
        self.keys = np.empty((1 << 14, WIDTH), np.uint64)
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)  # codes by the hash of their keys
        self.used = np.zeros(1 << 14, bool)  # whether a code was found since the last time
        self.n_codes = 0

    def keep(self, codes: np.ndarray) -> None:
        """Forgets all other pieces."""
        keys = self.keys[codes]
        ids, ends = gather(self.ids, self.ends[codes], self.ends[codes + 1])
        self.forget()
        self.add(ids, np.diff(ends, prepend=0), keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The code of each key, -1 for one that is not there."""
        found, slot = np.full(len(keys), -1, np.int64), slots_of(keys)
        for own in (slot, slot ^ 1):
            code = self.slots[own]
            at = np.flatnonzero(code >= 0)
            at = at[(self.keys[code[at]] == keys[at]).all(1)]
            found[at] = code[at]
        return found

    def add(self, ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """New codes for pieces with these joined ids; one without a key, or whose slots get another's, is not found."""
        first, start = self.n_codes, int(self.ends[self.n_codes])
        stop, total = first + len(sizes), start + len(ids)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while stop + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.keys = np.concatenate([self.keys, np.empty_like(self.keys)])
            self.used = np.concatenate([self.used, np.zeros_like(self.used)])
        self.ids[start:total] = ids
        self.ends[first + 1 : stop + 1] = start + np.cumsum(sizes)
        self.keys[first:stop] = keys
        codes, slot = np.arange(first, stop), slots_of(keys)
        kept = keys[:, -1] != 0
        slot = np.where(self.slots[slot] < 0, slot, slot ^ 1)
        self.slots[slot[kept]] = codes[kept]
        self.n_codes = stop
        return codes

    def learn(self, pieces: list[str], keys: np.ndarray) -> np.ndarray:
        """Codes of pieces that were not found."""
        if self.word_level:
            plain = np.fromiter((LETTERS.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        else:
            plain = np.zeros(len(pieces), bool)
        words, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        out = np.empty(len(pieces), np.int64)
        if len(words):
            ids, sizes = [], []
            for k in range(0, len(words), JOINED):
                text = " ".join([pieces[i] for i in words[k : k + JOINED].tolist()])
                found = self.letters.encode(text, add_special_tokens=False)
                ids.append(np.array(found.ids, np.uint32))
                sizes.append(np.bincount(found.word_ids))
            out[words] = self.add(np.concatenate(ids), np.concatenate(sizes), keys[words])
        if len(rest):
            encoded = self.tokenizer.encode_batch_fast([pieces[i] for i in rest.tolist()], add_special_tokens=False)
            own = [e.ids for e in encoded]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            out[rest] = self.add(np.fromiter((i for x in own for i in x), np.uint32, int(sizes.sum())), sizes, keys[rest])
        return out

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Marks the texts to be encoded whole."""
        pattern = OTHER_SPACE + (r"|<\|" if self.word_level else r"|[ \n][ \n]")
        return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)

    def pieces(self, texts: pa.Array) -> pa.ListArray:
        if self.word_level:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), LAST_MARKS, r"\1 \2\3")
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        texts = pc.replace_substring_regex(texts, LAST_MARKS, rf"\1{CUT}\2\3")
        texts = pc.replace_substring(texts, " ", CUT + " ")
        return pc.split_pattern(pc.replace_substring(texts, "\n", CUT + "\n"), CUT)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text (null: none), as unsigned 32-bit integers."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        odd = self.odd(texts)
        plain = pa.array(np.where(odd, None, np.arange(len(texts))), pa.int64(), from_pandas=True)
        cut = self.pieces(pc.fill_null(texts.take(plain), ""))
        bounds = cut.offsets.to_numpy()
        table = cut.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        keys = keys_of(table.dictionary)
        code_of = self.find(keys)
        self.used[code_of[code_of >= 0]] = True
        if self.n_codes > self.limit:
            kept = np.flatnonzero(self.used)
            self.keep(kept if 2 * len(kept) <= self.limit else code_of[code_of >= 0])
            code_of = self.find(keys)
        fresh = np.flatnonzero(code_of < 0)
        for k in range(0, len(fresh), AT_ONCE):
            some = fresh[k : k + AT_ONCE]
            code_of[some] = self.learn(table.dictionary.take(pa.array(some)).to_pylist(), keys[some])
        codes = code_of[table.indices.to_numpy()]
        flat, ends = gather(self.ids, self.ends[codes], self.ends[codes + 1])
        ends = np.concatenate([[0], ends])[bounds]
        out = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for k in np.flatnonzero(odd):
            ids = self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
            out[k] = np.array(ids, np.uint32)
        return out


def keys_of(pieces: pa.LargeStringArray) -> np.ndarray:
    """The bytes and length of every piece as numbers; zeros for pieces of more than `LONGEST_KEPT` bytes, and empty ones."""
    bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    starts, sizes = bounds[:-1] - bounds[0], np.diff(bounds)
    data = np.zeros(int(bounds[-1] - bounds[0]) + 8 * WIDTH, np.uint8)
    data[: -8 * WIDTH] = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    short = np.flatnonzero(sizes <= LONGEST_KEPT)
    starts, sizes = starts[short], sizes[short]
    keys = np.zeros((len(pieces), WIDTH), np.uint64)
    for k in range(WIDTH):
        keys[short, k] = eights[starts + 8 * k] & MASKS[np.clip(sizes - 8 * k, 0, 8)]
    keys[short, -1] |= sizes.astype(np.uint64) << np.uint64(56)
    return keys


def slots_of(keys: np.ndarray) -> np.ndarray:
    mixed = keys @ FACTORS
    mixed ^= mixed >> np.uint64(32)
    return (mixed * FACTORS[0] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The joined slices values[start:end], and where each ends in them."""
    sizes = ends - starts
    out_ends = np.cumsum(sizes)
    total = int(out_ends[-1]) if len(out_ends) else 0
    places = np.repeat(starts - (out_ends - sizes), sizes) + np.arange(total)
    return values[places], out_ends


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, word_level: bool, limit: int = 150_000) -> PieceEncoder:
    """One encoder a file and Python worker, so that its cache serves all tasks of the worker."""
    key = (path, word_level)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, word_level)
    _encoders[key].limit = limit
    return _encoders[key]


def give_back() -> None:
    """Returns freed memory to the system; Python workers live on between tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `most` bytes of text, so memory does not depend on row counts."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    give_back()
