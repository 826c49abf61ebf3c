"""Token ids of whole texts, by the ``tokenizers`` library, with a word cache.

Encoding is by far the dearest step of packing and of writing ids, and texts
repeat their words.  A text is therefore cut at blanks, tabs and line ends, which
the vocabulary's own rule drops between words anyway, and each different word is
encoded once per worker.  ``tests/llm/test_tokens.py`` compares the ids with those
of whole texts.

The cut is only right for tokenizers that drop white space and encode each word
by itself; ``WordEncoder`` refuses others.
"""

from __future__ import annotations

import ctypes
import json
import os
from codecs import charmap_decode
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Words, and pieces of words, remembered per worker; beyond them it starts anew.
CACHE_WORDS = 200_000
# Pieces that are encoded as one text.
LINE_PIECES = 200
ID_BYTES = 4
_ID = np.dtype("<u4")

# Fixed value: the words of the vocabulary's own splitting rule.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Fixed value: the rules that leave such pieces of a text.
_NORMAL = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Marks that are no letter and no number, and begin no piece of letters.
_MARKS = ".,;:!?"
# Words of these characters have one Unicode form and lower case everywhere.
_PLAIN = "^[!-~¡-¬®-ÿ]+$"


def strings(column: pa.Array) -> list[str]:
    """The strings of a column without nulls; by numpy, as ``to_pylist`` is slow."""
    return column.to_numpy(zero_copy_only=False).tolist()


class _Known:
    """The ids of strings met before, end to end, and the place of each string."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self._ids = np.empty(0, _ID)
        self._sizes = self._starts = np.empty(0, np.int64)

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add strings not met before; returns their places."""
        first = len(self.place)
        self.place.update(zip(strings, range(first, first + len(strings))))
        self._starts = np.concatenate((self._starts, len(self._ids) + np.cumsum(sizes) - sizes))
        self._ids = np.concatenate((self._ids, ids))
        self._sizes = np.concatenate((self._sizes, sizes))
        return np.arange(first, first + len(strings))

    def places(self, strings: list[str]) -> np.ndarray:
        """The place of each string, -1 for those not met before."""
        found = map(self.place.get, strings, repeat(-1))
        return np.fromiter(found, np.int64, len(strings))

    def gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the string at every place, end to end, and where each ends."""
        count = self._sizes[place]
        ends = np.concatenate(([0], np.cumsum(count)))
        return self._ids[np.repeat(self._starts[place] - ends[:-1], count) + np.arange(ends[-1])], ends


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str = TOKENIZER, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        with open(path, encoding="utf-8") as source:
            rule = json.load(source)
        splits = [
            p for p in (rule["pre_tokenizer"] or {}).get("pretokenizers", ())
            if p["type"] == "Split"
        ]
        if not (splits and splits[0]["behavior"] == "Removed" and splits[0]["invert"]):
            raise ValueError(f"{path} does not drop the white space between words")
        self._own_pieces = rule["normalizer"] == _NORMAL and rule["pre_tokenizer"] == _SPLIT
        self._special = [t["content"] for t in rule["added_tokens"]]
        self._tokenizer = Tokenizer.from_file(path)
        # The same merges without the rules that cut a text to pieces, and how those
        # rules spell the bytes of the characters of plain words.
        self._merges = Tokenizer(self._tokenizer.model)
        self._merges.pre_tokenizer = CharDelimiterSplit(" ")
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._spelling = "".join(
            spell(chr(byte))[0][0][1] if 0x80 <= byte < 0xC0 else chr(byte) for byte in range(256)
        )
        suffix = rule["model"].get("end_of_word_suffix") or ""
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._ends_word = np.zeros(1 + max(self._tokenizer.get_vocab().values()), bool)
        if suffix:
            self._ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._cache_words = cache_words
        self._words, self._pieces = _Known(), _Known()

    def _encode(self, strings: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        encode = (tokenizer or self._tokenizer).encode_batch_fast
        found = [e.ids for e in encode(strings, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), _ID, int(sizes.sum())), sizes

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces, many at a time as one text with blanks between them.

        The ids that end a word tell them apart again.  Pieces are what the vocabulary's
        own rules leave of a text, so that the rules need not be gone through again.
        """
        lines = [" ".join(pieces[i : i + LINE_PIECES]) for i in range(0, len(pieces), LINE_PIECES)]
        lines = [charmap_decode(line.encode(), "strict", self._spelling)[0] for line in lines]
        ids, _ = self._encode(lines, self._merges)
        ends = np.flatnonzero(self._ends_word[ids])
        if len(ends) != len(pieces) or ends[-1] != len(ids) - 1:
            return self._encode(pieces)
        return ids, np.diff(ends, prepend=-1)

    def _plain(self, words: pa.Array) -> pa.Array:
        """Which words may be encoded piece by piece."""
        if not self._own_pieces:
            return pa.array(np.zeros(len(words), bool))
        plain = pc.match_substring_regex(words, _PLAIN)
        for content in self._special:
            plain = pc.and_not(plain, pc.match_substring(words, content))
        return plain

    @staticmethod
    def _marked(words: pa.Array) -> pa.Array:
        """The words with a blank after each piece.

        Letters alone, or with one mark of punctuation after them, need no pattern.
        """
        stem = pc.utf8_rtrim(words, characters=_MARKS)
        after = pc.subtract(pc.utf8_length(words), pc.utf8_length(stem))
        letters = pc.utf8_is_alpha(stem)
        one = pc.and_(letters, pc.equal(after, 1))
        none = pc.and_(letters, pc.equal(after, 0))
        simple = pc.or_(one, none)
        other = pc.replace_substring_regex(words.filter(pc.invert(simple)), f"({_PIECES})", r"\1 ")
        marked = pc.if_else(
            none, pc.binary_join_element_wise(stem, "", " "),
            pc.binary_join_element_wise(stem, pc.utf8_slice_codeunits(words, -1), "", " "),
        )
        return pc.replace_with_mask(marked, pc.invert(simple), other)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Add words: plain ones from their pieces, others whole.  Returns their places.

        Arrow cuts all words at once, and only pieces not met before are encoded.
        """
        plain = self._plain(words)
        known, places = plain.to_numpy(zero_copy_only=False), np.empty(len(words), np.int64)
        whole = strings(words.filter(pc.invert(plain)))
        if whole:
            places[~known] = self._words.add(whole, *self._encode(whole))
        words = words.filter(plain)
        if not len(words):
            return places
        split = pc.split_pattern(self._marked(pc.utf8_lower(words)), " ")
        flat = split.flatten()
        # The string after the last blank is empty.
        bounds = split.offsets.to_numpy() - np.arange(len(split) + 1)
        numbered = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
        pieces = strings(numbered.dictionary)
        if len(self._pieces.place) > self._cache_words:
            self._pieces = _Known()
        at = self._pieces.places(pieces)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            new = [pieces[i] for i in fresh.tolist()]
            at[fresh] = self._pieces.add(new, *self._encode_pieces(new))
        ids, ends = self._pieces.gather(at[numbered.indices.to_numpy()])
        places[known] = self._words.add(strings(words), ids, np.diff(ends[bounds]))
        return places

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as bytes; a null text has none.

        Arrow splits the texts and numbers their different words; only those are
        looked up one by one, and their ids are then gathered for all words.
        """
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = split.flatten().dictionary_encode()
        different = strings(numbered.dictionary)
        if len(self._words.place) > self._cache_words:
            self._words = _Known()
        places = self._words.places(different)
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            places[fresh] = self._learn(numbered.dictionary.take(pa.array(fresh)))
        ids, ends = self._words.gather(places[numbered.indices.to_numpy()])
        flat = ids.tobytes()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        cuts = (ends[bounds] * ID_BYTES).tolist()
        # A worker lives on after its task, beside the next stage's memory.
        del split, numbered, ids
        pa.default_memory_pool().release_unused()
        return [flat[x:y] for x, y in zip(cuts, cuts[1:])]


def release_memory() -> None:
    """Give back what a worker's allocators keep for later.

    A worker lives on after its task, beside the next stage's memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str = TOKENIZER) -> WordEncoder:
    """This worker's encoder for a vocabulary file.

    It stays in the worker's own thread: Spark keeps the cores busy already.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def text_runs(texts: pa.Array, most_bytes: int = 4_000_000) -> list[slice]:
    """Slices of a batch of texts that hold at most so many bytes, or one text.

    Keeps the working memory of a step small, however long the texts are.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    runs, start, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most_bytes:
            runs.append(slice(start, i))
            start, held = i, 0
        held += size
    if start < len(sizes):
        runs.append(slice(start, len(sizes)))
    return runs
