"""SentencePiece encoding and decoding for vocabularies of merges (model type BPE).

A text is normalised by the model's own rule and cut into symbols of one character. All adjacent symbols that make up a
piece are put on an agenda ordered by the piece's score (equal scores: from left to right); the best pair is
merged, the pairs it makes with its neighbours join the agenda, and pairs that a merge has made void leave it or are
passed over when they come up. What no piece covers in the end is written as bytes. Decoding puts pieces and bytes
back together. The agenda of a long stretch is a heap; those of short ones lie side by side in an array with a place for
each pair, and the best of each stretch is merged in the same step.

A merge never joins two neighbouring characters that no piece has side by side, and the order of merges on one side of
such a place does not bear on the other. So if no piece has a blank sign behind another character (checked when the
model is read), each run of blank signs is worked on with the characters behind it; for other models a text is one
stretch. Within it, characters that are in no longer piece and signs at the end that never join what stands before
them are set apart in the same way. A stretch is worked out once by a worker and remembered within bounds.

What is new in a batch of texts is also encoded and decoded by the sentencepiece library, as one text; ``agrees``
tells whether all stretches of a text came to the same ids and the same characters there. (``PieceCodec.whole_agree``
compares whole texts; the tests do that.)

Defined results: a null text is like an empty one, which has the end id alone and decodes to nothing; rows are
worked on one by one, so repeated rows and ids stay as they are; columns besides ``doc_id`` and ``text`` are left
behind; empty tables give no rows. A model of another type, without bytes for unknown characters, or with
user-defined or unused pieces is refused.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamflow.llm.base import ship, whole_columns

BLANK = "▁"  # fixed value: the model's sign for a blank
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6  # fixed values: piece types of a model file
_BPE = 2  # fixed value: model type
_NEVER = 1 << 40
_ENCODED = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("agrees", pa.bool_()),
])


def merge_symbols(symbols: list[str], rank: Callable[[str, int], int]) -> list[str]:
    """The symbols of a stretch after all merges, by a heap; ``rank`` orders the pieces, the best first."""
    parts: list[str | None] = list(symbols)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, str]] = []

    def add(i: int, pair: str) -> None:
        at = rank(pair, _NEVER)
        if at != _NEVER:
            heappush(agenda, (at, i, pair))

    for i in range(n - 1):
        add(i, symbols[i] + symbols[i + 1])
    while agenda:
        _, i, pair = heappop(agenda)
        j = after[i]
        if j == n or parts[i] is None or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j] = pair, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            add(i, pair + parts[k])
        if before[i] >= 0:
            add(before[i], parts[before[i]] + pair)
    return [p for p in parts if p is not None]


class MergeTable:
    """The same merges for many stretches at a time, over numbered symbols: pieces have their ids, other characters follow."""

    def __init__(self, pieces: dict[str, int], order: dict[str, int]):
        self.numbers = dict(pieces)
        self.first_character = max(pieces.values()) + 1
        self.characters: list[str] = []
        #: The numbers of characters by their code points; -1 if they have none.
        self.by_code = np.full(sys.maxunicode + 1, -1, np.int32)
        for piece, at in pieces.items():
            if len(piece) == 1:
                self.by_code[ord(piece)] = at
        pairs = []
        for piece, at in order.items():
            for k in range(1, len(piece)):
                left, right = piece[:k], piece[k:]
                if (k == 1 or left in pieces) and (k == len(piece) - 1 or right in pieces):
                    pairs.append((self.number(left) << 32 | self.number(right), at, pieces[piece]))
        pairs.sort()
        self.keys, self.ranks, self.merged = (np.array(c, np.int64) for c in zip(*pairs))
        self.fixed = len(self.characters)

    def number(self, symbol: str) -> int:
        known = self.numbers.get(symbol)
        if known is None:
            known = self.numbers[symbol] = self.first_character + len(self.characters)
            self.characters.append(symbol)
            self.by_code[ord(symbol)] = known
        return known

    def forget(self) -> None:
        """Characters that are in no piece, beyond a bounded number of them."""
        if len(self.characters) > self.fixed + 100_000:
            for symbol in self.characters[self.fixed:]:
                del self.numbers[symbol]
                self.by_code[ord(symbol)] = -1
            del self.characters[self.fixed:]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], _NEVER), self.merged[at]

    def merge(self, stretches: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in ``stretches``, how many symbols are left of each, and these symbols in a row; the first done come first."""
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols = self.by_code[codes]
        if len(new := codes[symbols < 0]):
            for code in np.unique(new).tolist():
                self.number(chr(code))
            symbols = self.by_code[codes]
        symbols = symbols.astype(np.int64)
        which = np.arange(len(stretches))
        rank, to = np.full(len(symbols), _NEVER), np.zeros(len(symbols), np.int64)
        rank[:-1], to[:-1] = self._pairs(symbols[:-1], symbols[1:])
        rank[np.cumsum(sizes) - 1] = _NEVER
        while len(which):
            best = np.minimum.reduceat(rank, np.cumsum(sizes) - sizes)
            going = best < _NEVER
            if not going.all():
                on = np.repeat(going, sizes)
                yield which[~going], sizes[~going], symbols[~on]
                which, sizes, best = which[going], sizes[going], best[going]
                symbols, rank, to = symbols[on], rank[on], to[on]
                if not len(which):
                    return
            of = np.repeat(np.arange(len(which)), sizes)
            at = np.flatnonzero(rank == best[of])
            at = at[np.append(True, of[at[1:]] != of[at[:-1]])]  # the leftmost of each
            symbols[at] = to[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, rank, to = symbols[keep], rank[keep], to[keep]
            sizes = sizes - 1
            at -= np.arange(len(at))
            ends = np.cumsum(sizes) - 1
            inner = at[at < ends]
            rank[at] = _NEVER
            rank[inner], to[inner] = self._pairs(symbols[inner], symbols[inner + 1])
            behind = at[at > ends - sizes + 1]
            rank[behind - 1], to[behind - 1] = self._pairs(symbols[behind - 1], symbols[behind])


class PieceCodec:
    """Encodes and decodes with the model file at ``path``; remembers at most ``limit`` stretches and those of a batch."""

    def __init__(self, path: str, limit: int = 600_000, longest: int = 48):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model_file

        self.library = SentencePieceProcessor(model_file=path)
        model = model_file.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        kinds = [p.type for p in model.pieces]
        if model.trainer_spec.model_type != _BPE or _BYTE not in kinds:
            raise ValueError(f"{path}: not a merge-type vocabulary with bytes for unknown characters")
        if _USER_DEFINED in kinds or _UNUSED in kinds or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError(f"{path}: user-defined pieces, unused pieces and denormalising are not supported")
        names = [p.piece for p in model.pieces]
        pieces = {p: i for i, p in enumerate(names) if kinds[i] == _NORMAL}
        best = sorted({model.pieces[i].score for i in pieces.values()}, reverse=True)
        rank = {score: at for at, score in enumerate(best)}
        self.ids = pieces
        self.order = {p: rank[model.pieces[i].score] for p, i in pieces.items() if len(p) > 1}
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(names) if kinds[i] == _BYTE}
        self.end = self.library.eos_id()
        self.unknown = (self.library.unk_id(), model.trainer_spec.unk_surface.encode())
        #: What an id stands for in a decoded text.
        self.surface = [
            bytes([int(p[1:-1], 16)]) if kind == _BYTE else p.replace(BLANK, " ").encode() if kind == _NORMAL else b""
            for p, kind in zip(names, kinds)
        ]
        self.surface[self.unknown[0]] = self.unknown[1]
        self.leading = bool(model.normalizer_spec.add_dummy_prefix)
        apart = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if apart else r"(?s:.+)").findall
        self.limit, self.longest = limit, longest
        self.known: dict[str, tuple[bytes, str]] = {}
        self.joined = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        alone = re.escape("".join(sorted(set(map(chr, range(128))).difference(*self.joined))))
        self.parts = re.compile(f"[{alone}]|[^{alone}]+" if alone else r"(?s:.+)").findall
        self.set_apart = re.compile(f"[{alone}]" if alone else r"(?!)").search
        self.table = MergeTable(self.ids, self.order)
        #: Ids that stand for a null character, and the number behind all ids, which stands for one between two stretches.
        self.nulls = [i for i, own in enumerate(self.surface) if b"\0" in own]
        self.between = len(self.surface)
        self.surface.append(b"\0")
        self.cores: dict[str, bytes] = {}
        self.differing: set[str] = set()

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text and the end id."""
        return array("i", self.batch([text])[0][0]).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of whole ids: the blank that stands for the start of a text goes."""
        return self._start(self._decode(ids))

    def batch(self, texts: list[str | None]) -> list[tuple[bytes, str, bool]]:
        """Ids (32-bit, the end id last) of whole texts, what they decode to, and whether the library agrees."""
        cut = [self.cut(self.library.normalize(t)) if t else [] for t in texts]
        known = self.known
        if len(known) > self.limit:
            known.clear()
            self.differing.clear()
        new = list(set().union(*cut).difference(known))
        if new:
            done = self._stretches(new)
            known.update(zip(new, done))
            self.differing.update(s for s, same in zip(new, self._agreeing(new, done)) if not same)
        end, out = array("i", [self.end]).tobytes(), []
        for stretches in cut:
            ids, decoded = zip(*map(known.__getitem__, stretches)) if stretches else ((), ())
            agrees = not self.differing or self.differing.isdisjoint(stretches)
            out.append((b"".join(ids) + end, self._start("".join(decoded)), agrees))
        for s in new:
            if len(s) > self.longest:
                del known[s]
                self.differing.discard(s)
        self.table.forget()
        return out

    def _start(self, text: str) -> str:
        return text[1:] if self.leading and text.startswith(" ") else text

    def _cut_off(self, stretch: str) -> list[str]:
        """Parts that never merge with each other."""
        parts = []
        for part in self.parts(stretch):
            n = len(part)
            while n > 1 and part[n - 2:n] not in self.joined:
                n -= 1
            parts.append(part[:n])
            parts += part[n:]
        return parts

    def _stretches(self, stretches: list[str]) -> list[tuple[bytes, str]]:
        """Ids of each stretch, and the text that they stand for."""
        apart, joined = self.set_apart, self.joined
        cut = [[s] if s[-2:] in joined and not apart(s) else self._cut_off(s) for s in stretches]
        cores = self.cores
        if len(cores) > self.limit:
            cores.clear()
        new = set().union(*cut).difference(cores)
        short = [c for c in new if len(c) <= self.longest]
        for which, sizes, symbols in self.table.merge(short):
            ids, at = symbols.astype(np.int32).tobytes(), 0
            unknown = bool((symbols >= self.table.first_character).any())
            for w, size in zip(which.tolist(), sizes.tolist()):
                own = ids[4 * at:4 * (at + size)]
                cores[short[w]] = self._with_bytes(own) if unknown else own
                at += size
        long = [c for c in new if len(c) > self.longest]
        for c in long:
            pieces = merge_symbols(list(c), self.order.get)
            cores[c] = self._with_bytes(array("i", map(self.table.number, pieces)).tobytes())
        ids = [cores[parts[0]] if len(parts) == 1 else b"".join([cores[c] for c in parts]) for parts in cut]
        for c in long:
            del cores[c]
        return list(zip(ids, self._decoded(ids)))

    def _with_bytes(self, numbers: bytes) -> bytes:
        """Ids, with bytes in place of the characters that are no pieces."""
        first, ids = self.table.first_character, array("i")
        for number in array("i", numbers):
            if number < first:
                ids.append(number)
            else:
                ids.extend([self.byte_ids[b] for b in self.table.characters[number - first].encode()])
        return ids.tobytes()

    def _decode(self, ids: Iterable[int]) -> str:
        surface = self.surface
        return b"".join([surface[i] for i in ids]).decode("utf-8", "replace")

    def _decoded(self, stretches: list[bytes]) -> list[str]:
        """What the ids of each stretch decode to. As one text, as no character reaches across the null characters between them."""
        ids = array("i", array("i", [self.between]).tobytes().join(stretches))
        if np.isin(np.frombuffer(ids, np.int32), self.nulls).any():
            return [self._decode(array("i", own)) for own in stretches]
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").split("\0")

    def _agreeing(self, stretches: list[str], done: list[tuple[bytes, str]]) -> list[bool]:
        """Stretches that start with a blank sign make up one text; only if that differs they are tried one by one."""
        if self.leading and all(s[0] == BLANK for s in stretches):
            ids = self.library.encode("".join(stretches)[1:], out_type=int)
            same = array("i", ids).tobytes() == b"".join([own for own, _ in done])
            if same and self.library.decode(ids) == self._start("".join([text for _, text in done])):
                return [True] * len(done)
        # The library puts a blank sign before a text, as the stretches have one already.
        texts = [s[1:] if self.leading and s[0] == BLANK else s for s in stretches]
        # A lone blank sign would be the start of an empty text, which the library gives no ids.
        ids = [self.library.encode(t) if t else [self.library.piece_to_id(BLANK)] for t in texts]
        decoded = map(self.library.decode, ids)
        return [array("i", i).tobytes() == own and d == self._start(text) for i, d, (own, text) in zip(ids, decoded, done)]

    def whole_agree(self, text: str) -> bool:
        """Whether the library comes to the same ids and the same decoded text for a whole text."""
        ids = self.library.encode(text, add_eos=True)
        (own, decoded, _), = self.batch([text])
        return array("i", ids).tobytes() == own and self.library.decode(ids) == decoded


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The worker's codec for the file at ``path``; it outlives a task."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, batch_chars: int = 1 << 20) -> DataFrame:
    """doc_id, ids (the end id last), the text they decode to, and whether the library agrees, for each row of ``docs``.

    ``path`` is the model file, at the same place on every executor. Texts are worked on in batches of about ``batch_chars``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)

        def out(doc_ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
            ids, decoded, agrees = zip(*own.batch(texts))
            ends = np.cumsum([0, *map(len, ids)]) // 4
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
            return pa.RecordBatch.from_arrays([
                pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_()),
            ], schema=_ENCODED)

        for batch in batches:
            doc_ids: list[int | None] = []
            texts: list[str] = []
            chars = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= batch_chars:
                    yield out(doc_ids, texts)
                    doc_ids, texts, chars = [], [], 0
            if texts:
                yield out(doc_ids, texts)

    ship(docs.sparkSession)
    rows = whole_columns(docs, "doc_id", "text").selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean")
