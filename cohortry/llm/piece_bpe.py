"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text's symbols are its characters.  An agenda holds the adjacent pairs whose
concatenation is a piece, ordered by the piece's score, the leftmost first among
equal scores; the best pair becomes one symbol, its two new neighbours join the
agenda, until none is left.  Characters that are no piece become their UTF-8 bytes.

No piece of such a vocabulary has a space mark after another character, so pairs
never cross the place where a space follows a character: texts are cut there, and a
segment that was met before is not merged again.  New segments of a batch keep their
agendas in one array, a row each, and take their best pairs together; long ones have
an agenda of their own.  ``PieceEncoder`` refuses vocabularies of another kind.

Every batch is checked against the ``sentencepiece`` library: its ids of the whole
texts must be equal, or the job fails.  Decoding is the library's.

Rows: a null text is empty, and an empty text has no ids and decodes to an empty
text; texts of any length are encoded whole, in slices of bounded bytes; repeated rows
and doc_ids are rows of their own; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cohortry.llm.tokens import strings, text_runs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
# Fixed value: the mark that stands for a space.
SPACE = "▁"
# Segments remembered per worker; beyond them it starts anew.
CACHE_SEGMENTS = 600_000
# Longer segments have an agenda of their own.
ROW_SYMBOLS = 40
# Segments whose agendas are worked off together.
ROWS = 20_000
# Bytes of text worked on at a time.
RUN_BYTES = 4_000_000

ENCODED = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
_ID = np.dtype("<i4")
_NONE = np.float32(-np.inf)


class PieceEncoder:
    """Encodes texts as the library does; keeps the ids of segments met before."""

    def __init__(self, path: str = MODEL, cache_segments: int = CACHE_SEGMENTS):
        from sentencepiece import SentencePieceProcessor

        self.library = model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [
            i for i in range(size)
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
        ]
        piece = {model.id_to_piece(i): i for i in normal}
        self._byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        probe = "a  b é ﬁ"
        if (
            any(model.is_unused(i) for i in normal)
            or not all(model.is_byte(int(i)) for i in self._byte)
            or model.normalize(probe) != SPACE + probe.replace(" ", SPACE)
            or any(SPACE in p.lstrip(SPACE) for p in piece)
            or any(c not in piece for p in piece for c in p)
        ):
            raise ValueError(f"{path} is not a plain merge-type vocabulary with byte pieces")
        self._size = size
        self._chars = {c: i for c, i in piece.items() if len(c) == 1}
        self._score = np.full(size, _NONE, np.float32)
        self._score[normal] = [model.get_score(i) for i in normal]
        # All pairs of symbols that make a piece, as left * size + right.
        pairs = {
            piece[p[:cut]] * size + piece[p[cut:]]: i
            for p, i in piece.items()
            for cut in range(1, len(p))
            if p[:cut] in piece and p[cut:] in piece
        }
        self._pairs = np.array(sorted(pairs), np.int64)
        self._merged = np.array([pairs[k] for k in self._pairs.tolist()], np.int64)
        self._pair = pairs
        codes = np.full(0x110000, -1, np.int64)
        for c, i in self._chars.items():
            codes[ord(c)] = i
        self._codes = codes
        self._cache_segments = cache_segments
        self._forget()

    def _symbols(self, segment: str) -> np.ndarray:
        """Piece ids of the characters; others get ids from the size on."""
        code = np.frombuffer(segment.encode("utf-32-le"), "<u4").astype(np.int64)
        found = self._codes[code]
        return np.where(found < 0, self._size + code, found)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of each pair's piece; the score is -inf where there is none."""
        size = self._size
        key = np.where((left < size) & (right < size), left * size + right, -1)
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        merged = self._merged[at]
        return np.where(self._pairs[at] == key, self._score[merged], _NONE), merged

    def merge_rows(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of all segments in a row, and how many each has.

        Every row of the arrays is a segment's agenda.  A step takes the best pair of
        every row, so all rows lose a symbol; rows without pairs are set aside.
        """
        length = np.fromiter(map(len, segments), np.int64, len(segments))
        width = int(length.max())
        symbols = np.full((len(segments), width), self._size + 0x110000, np.int64)
        symbols[np.arange(width) < length[:, None]] = self._symbols("".join(segments))
        agenda, merged = self._look_up(symbols[:, :-1], symbols[:, 1:])
        result = np.empty_like(symbols)
        left = length.copy()
        which = np.arange(len(segments))
        while len(which):
            row = np.arange(len(which))
            if width > 1:
                best = agenda.argmax(axis=1)
                open_ = agenda[row, best] > _NONE
            else:
                open_ = np.zeros(len(which), bool)
            if not open_.all():
                result[which[~open_], :width] = symbols[~open_]
                which = which[open_]
                if not len(which):
                    break
                symbols, agenda, merged, best = symbols[open_], agenda[open_], merged[open_], best[open_]
                row = np.arange(len(which))
            symbols[row, best] = merged[row, best]
            left[which] -= 1
            width -= 1
            keep = np.ones((len(which), width + 1), bool)
            keep[row, best + 1] = False
            symbols = symbols[keep].reshape(len(which), width)
            keep = np.ones((len(which), width), bool)
            keep[row, best] = False
            agenda, merged = (x[keep].reshape(len(which), width - 1) for x in (agenda, merged))
            for rows, place in (
                (row[best < width - 1], best[best < width - 1]), (row[best > 0], best[best > 0] - 1)
            ):
                agenda[rows, place], merged[rows, place] = self._look_up(
                    symbols[rows, place], symbols[rows, place + 1]
                )
        return result[np.arange(result.shape[1]) < left[:, None]], left

    def merge_one(self, segment: str) -> np.ndarray:
        """The same for one long segment, with a heap for its agenda."""
        symbols = self._symbols(segment).tolist()
        size, score, pair = self._size, self._score, self._pair
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[float, int, int, int, int]] = []

        def add(left: int, right: int) -> None:
            if left < 0 or right >= len(symbols):
                return
            a, b = symbols[left], symbols[right]
            piece = pair.get(a * size + b) if a < size and b < size else None
            if piece is not None:
                heapq.heappush(agenda, (-float(score[piece]), left, right, a, b))

        for i in range(len(symbols) - 1):
            add(i, i + 1)
        while agenda:
            _, left, right, a, b = heapq.heappop(agenda)
            # An entry is stale once one of its symbols was merged.
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            symbols[left], symbols[right] = pair[a * size + b], -1
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            add(before[left], left)
            add(left, after[left])
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _to_ids(self, symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids, with the UTF-8 bytes of symbols that are no piece."""
        odd = np.flatnonzero(symbols >= self._size)
        if not len(odd):
            return symbols.astype(_ID), left
        code = symbols[odd] - self._size
        size = np.ones(len(symbols), np.int64)
        size[odd] += (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(size)
        ids = np.repeat(symbols, size)
        written = np.frombuffer("".join(map(chr, code.tolist())).encode(), np.uint8)
        place = np.repeat((ends - size)[odd] - (np.cumsum(size[odd]) - size[odd]), size[odd])
        ids[place + np.arange(len(written))] = self._byte[written]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(left)))]
        return ids.astype(_ID), np.diff(bounds)

    def _learn(self, segments: list[str]) -> None:
        """Merge new segments, and keep their ids."""
        short = sorted((s for s in segments if len(s) < ROW_SYMBOLS), key=len)
        long = [s for s in segments if len(s) >= ROW_SYMBOLS]
        found = []
        for first in range(0, len(short), ROWS):
            found.append(self._to_ids(*self.merge_rows([SPACE + s for s in short[first : first + ROWS]])))
        for segment in long:
            symbols = self.merge_one(SPACE + segment)
            found.append(self._to_ids(symbols, np.array([len(symbols)])))
        self._known.update(zip(short + long, range(len(self._known), len(self._known) + len(segments))))
        self._ids = np.concatenate([self._ids, *[f[0] for f in found]])
        self._sizes = np.concatenate([self._sizes, *[f[1] for f in found]])
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = np.empty(0, _ID)
        self._sizes = self._starts = np.empty(0, np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text has none.

        A space is the mark of the segment it begins.  Of several spaces in a row all
        but the first are written as marks, and the first cuts.
        """
        texts = pc.fill_null(texts, "")
        marked = pc.replace_substring(texts, SPACE, " ")
        marked = pc.binary_join_element_wise("", marked, " ")
        marked = pc.replace_substring(pc.replace_substring(marked, "  ", " " + SPACE), SPACE + " ", SPACE * 2)
        split = pc.split_pattern(pc.utf8_slice_codeunits(marked, 1), " ")
        numbered = split.flatten().dictionary_encode()
        segments = strings(numbered.dictionary)
        if len(self._known) > self._cache_segments:
            self._forget()
        missing = [s for s in segments if s not in self._known]
        if missing:
            self._learn(missing)
        place = np.fromiter(map(self._known.__getitem__, segments), np.int64, len(segments))
        segment = place[numbered.indices.to_numpy()]
        count = self._sizes[segment]
        ends = np.concatenate(([0], np.cumsum(count)))
        first = self._starts[segment] - ends[:-1]
        ids = self._ids[np.repeat(first, count) + np.arange(ends[-1])]
        cuts = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(False)
        return [
            ids[:0] if blank else ids[a:b] for blank, a, b in zip(empty, cuts[:-1], cuts[1:])
        ]

    def check(self, texts: pa.Array, ids: list[np.ndarray]) -> None:
        """Raise unless the library gives the same ids for the whole texts."""
        for i, text in enumerate(pc.fill_null(texts, "").to_pylist()):
            if not np.array_equal(self.library.encode_as_numpy(text), ids[i]):
                raise ValueError(f"ids differ from the library's for a text of {len(text)} characters")


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str = MODEL) -> PieceEncoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, model: str = MODEL, check: bool = True) -> DataFrame:
    """``doc_id`` and the ``ids`` of each whole text, checked against the library."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(model)
        for batch in batches:
            for run in text_runs(batch.column(1), RUN_BYTES):
                texts = batch.column(1)[run]
                ids = pieces.encode(texts)
                if check:
                    pieces.check(texts, ids)
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[run],
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                        ),
                    ],
                    names=["doc_id", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id BIGINT, ids ARRAY<INT>")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and the ``text`` that the ids stand for."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(model).library
        for batch in batches:
            for i in range(batch.num_rows):
                text = library.decode(batch.column(1)[i].as_py() or [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i : i + 1], pa.array([text], pa.string())], names=["doc_id", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id BIGINT, text STRING")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Check sums of every document's ids and of the text they decode to.

    Encodes and decodes in one pass, so that neither ids nor texts leave the task.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(model)
        decimal = [str(i) for i in range(pieces.library.get_piece_size())]
        for batch in batches:
            for run in text_runs(batch.column(1), RUN_BYTES):
                texts = batch.column(1)[run]
                found = pieces.encode(texts)
                pieces.check(texts, found)
                written, decoded = [], []
                for ids in found:
                    ids = ids.tolist()
                    written.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[run], pa.array([len(i) for i in found], pa.int64()),
                        pa.array(written), pa.array(decoded),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(digest, ENCODED)
