"""SentencePiece encoding by streaming Viterbi, and decoding.

A text is normalised as the model says (here: identity, a leading word mark, spaces as
word marks) and cut into the pieces with the largest sum of scores. Characters outside the
vocabulary cost less than any piece by 10 and become byte pieces. Of equal sums the path
whose last piece starts first wins, at every boundary.

The lattice is never held whole. Positions are opened from left to right; an opened
position only reaches as far as the longest piece. Scores and back pointers are kept from
the last commit on. A boundary that every path still open passes is looked for once 4 x the
longest piece is pending, then each time the pending text has doubled and grown by as much;
the ids up to it are committed and forgotten. So up to twice the text since the paths last
met is held, and 4 x the longest piece more, and a shorter text is committed at its end
only. Paths meet at the latest where no
piece of the vocabulary holds the two characters on either side, as before every word
mark that follows another character. Such certain boundaries cut a text into spans whose
ids do not depend on their surroundings, so each Python worker keeps the ids of spans it has met
(``CACHE_SPANS`` at most, short ones only; full, it starts afresh), from one task to the next.

Decoding joins the pieces, turns word marks into spaces and byte pieces into their bytes
and drops the space of the leading mark. ``decode(encode(t)) == t`` for every text without
the word mark U+2581 itself, which reads back as a space.

Defined results: a null or empty text has no ids and decodes to the empty text; rows are
coded one by one, so ties and repeated rows have equal results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

MARK = "▁"
CACHE_SPANS = 1 << 20
_CACHED_CHARS = 40
_SLICE_CHARS = 1 << 21
_UNKNOWN_PENALTY = 10.0
_SPANS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize(f"a  B\néﬁ ") != f"{MARK}a{MARK}{MARK}B\néﬁ{MARK}":
            raise ValueError("only models with identity normalisation and a leading word mark are read")
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.scores: list[float] = [sp.get_score(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.parts: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.parts.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.parts.append(b"")
            else:
                self.ids[piece] = i
                self.parts.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores[i] for i in self.ids.values()) - _UNKNOWN_PENALTY
        self.trie = self._trie()
        joints = {p[k - 1:k + 1] for p in self.ids for k in range(1, len(p))}
        #: No piece goes on over a word mark after another character, or holds a line feed.
        self.spans_are_certain = not any("\n" in j or (j[1] == MARK and j[0] != MARK) for j in joints)

    def _trie(self) -> dict:
        """Nested ``{character: (id or -1, score, continuations or None)}`` of the pieces; a single
        character that is no piece scores as unknown."""
        table = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        longer: dict[str, list[str]] = {}
        for p in table:
            longer.setdefault(p[:-1], []).append(p)

        def nodes(p: str) -> dict | None:
            return {m[-1]: (table[m], self.scores[table[m]] if table[m] >= 0 else self.unknown, nodes(m))
                    for m in longer[p]} if p in longer else None

        return nodes("")

    def normalise(self, text: str) -> str:
        return (" " + text).replace(" ", MARK) if text else ""

    def decode(self, ids) -> str:
        text = b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class StreamingViterbi:
    """Feed text in chunks; ``committed`` collects the ids that no later character can change."""

    __slots__ = ("model", "committed", "pending", "best", "start", "piece", "at", "check")

    def __init__(self, model: PieceModel):
        self.model = model
        self.committed: list[int] = []
        self.pending = ""  # characters from the last committed boundary on
        self.best = [0.0]  # score of the best path to each boundary reached so far
        self.start = [0]  # where its last piece starts
        self.piece = [-1]  # that piece, -1 for the bytes of an unknown character
        self.at = 0  # the next boundary to open
        self.check = 4 * model.longest

    def feed(self, chunk: str) -> None:
        self.pending += chunk
        self._advance(len(self.pending) - self.model.longest)

    def finish(self) -> list[int]:
        """The ids of all that was fed; the coder has done its work."""
        self._advance(len(self.pending) - 1)
        self.committed += self._path(len(self.pending))
        return self.committed

    def _advance(self, last: int) -> None:
        """Open the boundaries up to ``last``: all characters that their pieces may hold are there."""
        m = self.model
        first, longest = m.trie.get, m.longest
        other, unset = (-1, m.unknown, None), float("-inf")
        while self.at <= last:
            s, best, start, piece = self.pending, self.best, self.start, self.piece
            size = len(s)
            # look for a common boundary once enough is pending, later on each time twice as much
            upto = min(last, max(self.check, self.at))
            new = min(size, upto + longest) + 1 - len(best)
            if new > 0:
                best += [unset] * new
                start += [0] * new
                piece += [-1] * new
            for q in range(self.at, upto + 1):
                base = best[q]
                i, score, more = first(s[q], other)
                score += base
                e = q + 1
                if score > best[e]:
                    best[e], start[e], piece[e] = score, q, i
                while more is not None and e < size:
                    node = more.get(s[e])
                    if node is None:
                        break
                    i, score, more = node
                    e += 1
                    if i >= 0:
                        score += base
                        if score > best[e]:
                            best[e], start[e], piece[e] = score, q, i
            self.at = upto + 1
            if self.at > self.check:
                drop = self._meeting()
                self.check = 2 * (self.at - drop) + 4 * longest
                self._commit(drop)
                last -= drop

    def _meeting(self) -> int:
        """The last boundary that the best paths to all boundaries still open share."""
        alive = {p for p in range(self.at, len(self.best)) if self.best[p] > float("-inf")}
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            alive.add(self.start[top])
        return alive.pop()

    def _path(self, upto: int) -> list[int]:
        path, p = [], upto
        while p:
            q, i = self.start[p], self.piece[p]
            if i >= 0:
                path.append(i)
            else:
                path.extend(self.model.byte_ids[b] for b in reversed(self.pending[q:p].encode()))
            p = q
        path.reverse()
        return path

    def _commit(self, upto: int) -> None:
        self.committed += self._path(upto)
        self.pending = self.pending[upto:]
        base = self.best[upto]
        self.best = [b - base for b in self.best[upto:]]
        self.start = [max(0, q - upto) for q in self.start[upto:]]
        self.piece = self.piece[upto:]
        self.at -= upto


class PieceEncoder(dict):
    """Texts to ids (``int32`` bytes); spans between certain boundaries are coded once and kept."""

    def __init__(self, path: str):
        super().__init__()
        self.model = PieceModel(path)

    def _code(self, normal: str) -> bytes:
        coder = StreamingViterbi(self.model)
        coder.feed(normal)
        ids = array("i", coder.finish())
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __missing__(self, span: str) -> bytes:
        got = self._code(span)
        if len(span) <= _CACHED_CHARS:
            self[span] = got
        return got

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if not self.model.spans_are_certain:
            return [self._code(self.model.normalise(t or "")) for t in texts]
        if len(self) > CACHE_SPANS:
            self.clear()
        return [b"".join(map(self.__getitem__, self._spans(t or ""))) for t in texts]

    def _spans(self, text: str) -> list[str]:
        if text[:1] == " " or "  " in text or MARK in text:
            return _SPANS.findall(self.model.normalise(text))
        return _simple(text)


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a worker's tasks: a model is read, and a span coded, once for all of them."""
    return PieceEncoder(path)


def _simple(text: str | None) -> list[str]:
    """The spans of a text without a leading space, double spaces and word marks: each word with its mark, and line feeds."""
    if not text:
        return []
    return (MARK + text.replace(" ", f" {MARK}").replace("\n", " \n ")).split(" ")


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list]]:
    """(offset, texts) of a batch, cut so that the texts of a slice stay short together."""
    texts = batch.column(column)
    start, size = 0, 0
    for i, n in enumerate(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= _SLICE_CHARS or i + 1 == batch.num_rows:
            yield start, texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def encode_table(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
                 verify: bool = False) -> DataFrame:
    """``(key, n_tokens, ids)`` of every row; with ``verify`` also ``decoded_chars`` and
    ``round_trip``, true where decoding the ids gives the text back. One pass, no shuffle."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    extra = ", decoded_chars long, round_trip boolean" if verify else ""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        for batch in batches:
            for start, texts in _slices(batch, 1):
                coded = encoder(texts)
                counts = np.array([len(c) // 4 for c in coded], np.int64)
                values = np.frombuffer(b"".join(coded), "<i4")
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                cols = [batch.column(0).slice(start, len(texts)), pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
                if verify:
                    back = [encoder.model.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
                    cols += [pa.array([len(b) for b in back], pa.int64()),
                             pa.array([b == (t or "") for b, t in zip(back, texts)])]
                yield pa.RecordBatch.from_arrays(
                    cols, ["key", "n_tokens", "ids", "decoded_chars", "round_trip"][:len(cols)])

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = slim.mapInArrow(rows, f"key {kind}, n_tokens long, ids array<int>{extra}")
    return out.withColumnRenamed("key", key)


def decode_table(coded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)``: the texts of id arrays; null arrays decode to the empty text, ids outside
    the vocabulary are refused."""
    ship_package(coded.sparkSession)
    kind = coded.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        for batch in batches:
            texts = [model.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    slim = coded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return slim.mapInArrow(rows, f"key {kind}, text string").withColumnRenamed("key", key)
