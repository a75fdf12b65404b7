"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three mappings make up the transducer. The first and the last act on single
characters and are applied directly, before and after the path search; the
search itself runs over the machine of pieces composed with each input:

* the normaliser: a blank for the start of a text, blanks to the mark U+2581;
* the pieces: an arc for each stretch of the input that is a piece;
* byte fallback: a character outside the vocabulary becomes its UTF-8 bytes.

Weights lie in the tropical semiring (sum along a path, minimum over paths).
For a unigram model an arc weighs minus the piece's score. For a byte-pair
model the piece machine is a bigram machine: going from piece a to piece b
weighs 0 if merging the text of a and b by rank gives a, b back, else infinity.
Merges never cross the borders of the final pieces, so exactly one path has a
finite weight, and it is the one that merging the whole text by rank finds
(each consecutive pair of it survives, and the first merge across a border of
any other path would also occur in the pair at that border).

The composition falls apart wherever no piece holds the two characters at a
border, so it is done stretch by stretch, and stretches are remembered.

Defined cases: a null text gives null ids and 0 tokens; an empty text gives no
ids; texts of any length are encoded whole (a stretch without borders too, in
linear memory); U+2581 in a text is read as a blank, so such a text is not
restored (``lossless`` false); a null doc_id is kept and repeated rows are coded
each; an empty table gives an empty result; other columns are not read, whatever
their names. A model without byte fallback gives one unknown id per unknown
character. User-defined pieces and character maps other
than identity are refused when the model is compiled.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
#: Borders to try, most frequent first: around Latin words, before blanks.
SPLITS = (r" *[A-Za-zÀ-ɏ]+| *[^A-Za-zÀ-ɏ ]+| +", r" *[^ ]+| +")
#: Stretches and piece pairs remembered by a worker.
REMEMBERED = 400_000
INFINITY = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at:at + size]
            at += size


class Model:
    """Pieces, scores and switches of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.bpe, self.prefix, self.squeeze, charsmap = False, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                score = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
                self.pieces.append((f[1].decode(), score, f.get(3, NORMAL)))
            elif number == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                f = dict(_fields(value))
                charsmap = f.get(2, b"")
                self.prefix, self.squeeze = bool(f.get(3, 1)), bool(f.get(4, 1))
        if charsmap:
            raise ValueError("only the identity character map is supported")
        if any(t == USER_DEFINED for _, _, t in self.pieces):
            raise ValueError("user-defined pieces are not supported")


class Transducer:
    def __init__(self, model: Model):
        self.model = model
        self.ids = {p: i for i, (p, _, t) in enumerate(model.pieces) if t == NORMAL}
        self.score = [s for _, s, _ in model.pieces]
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, t) in enumerate(model.pieces) if t == BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(model.pieces) if t == UNKNOWN), 0)
        self.fallback_cost = 10.0 - min((self.score[i] for i in self.ids.values()), default=0.0)
        self.outputs = [bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t in (CONTROL, UNUSED)
                        else p.replace(MARK, " ").encode() for p, _, t in model.pieces]
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            self.reach[piece[:2]] = max(len(piece), self.reach.get(piece[:2], 1))
        self.pairs: dict[str, dict[str, float]] = {}
        self.n_pairs = 0
        self.memo: dict[str, bytes] = {}
        inner = {(p[i], p[i + 1]) for p in self.ids for i in range(len(p) - 1)}
        self.split = next((re.compile(s) for s in SPLITS if not self._crossed(s, inner)), None)

    @staticmethod
    def _crossed(split: str, inner: set[tuple[str, str]]) -> bool:
        """Whether some piece reaches over a border that ``split`` makes."""
        whole = re.compile(split)
        return any(whole.fullmatch((a + b).replace(MARK, " ")) is None for a, b in inner)

    # merging by rank, for the pairs of the bigram machine ------------------
    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITY, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and self.score[piece] > best:
                    best, at = self.score[piece], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, a: str, b: str) -> float:
        """Of piece b after piece a ('' at the start) in the byte-pair machine."""
        after = self.pairs.get(a)
        if after is None:
            if self.n_pairs >= REMEMBERED:
                self.pairs.clear()
                self.n_pairs = 0
            after = self.pairs[a] = {}
        cost = after.get(b)
        if cost is None:
            self.n_pairs += 1
            cost = after[b] = 0.0 if self._merged(a + b) == ([a, b] if a else [b]) else INFINITY
        return cost

    def _reach(self, text: str, at: int) -> int:
        """No piece that starts with the two characters at ``at`` is longer."""
        return min(self.reach.get(text[at:at + 2], 1), len(text) - at)

    def _arcs(self, text: str, at: int) -> list[str]:
        """Pieces that start at ``at``, longest first; a character outside the vocabulary by itself."""
        found = [text[at:at + n] for n in range(self._reach(text, at), 1, -1) if text[at:at + n] in self.ids]
        found.append(text[at])
        return found

    def _bigram_path(self, text: str) -> list[str]:
        """Depth first: the only path of finite weight. Dead states are left once and for all."""
        ids, weight, n = self.ids, self.weight, len(text)
        dead: set[tuple[int, str]] = set()
        path: list[str] = []
        tries: list[int] = []          # the length of each piece on the path
        at, before, size = 0, "", self._reach(text, 0)
        while at < n:
            while size > 0:
                piece = text[at:at + size]
                if (size == 1 or piece in ids) and weight(before, piece) == 0.0 and (at + size, piece) not in dead:
                    break
                size -= 1
            if size:
                path.append(piece)
                tries.append(size)
                at, before = at + size, piece
                size = self._reach(text, at) if at < n else 0
            else:
                # merging by rank always ends, so the start itself is never dead
                dead.add((at, before))
                path.pop()
                size = tries.pop()
                at, before, size = at - size, path[-1] if path else "", size - 1
        return path

    def _unigram_path(self, text: str) -> list[str]:
        """Shortest path over positions (Viterbi)."""
        n = len(text)
        best, back = [0.0] + [INFINITY] * n, [0] * (n + 1)
        for at in range(n):
            for piece in self._arcs(text, at):
                i = self.ids.get(piece)
                cost = best[at] + (self.fallback_cost if i is None else -self.score[i])
                if cost < best[at + len(piece)]:
                    best[at + len(piece)], back[at + len(piece)] = cost, at
        path, at = [], n
        while at:
            path.append(text[back[at]:at])
            at = back[at]
        return path[::-1]

    def stretch(self, raw: str) -> bytes:
        """Ids of one stretch between borders, as 32-bit numbers."""
        text = raw.replace(" ", MARK)
        path = self._bigram_path(text) if self.model.bpe else self._unigram_path(text)
        ids: list[int] = []
        for piece in path:
            i = self.ids.get(piece)
            if i is not None:
                ids.append(i)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode("utf-8", "replace"))
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int32).tobytes()

    def normalise(self, text: str) -> str:
        text = text.replace(MARK, " ")
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return " " + text if self.model.prefix and text else text

    def encode(self, text: str) -> bytes:
        raw = self.normalise(text)
        if not raw:
            return b""
        memo, out = self.memo, []
        for part in self.split.findall(raw) if self.split else [raw]:
            ids = memo.get(part)
            if ids is None:
                ids = self.stretch(part)
                if len(part) <= 48:
                    if len(memo) >= REMEMBERED:
                        memo.clear()
                    memo[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids) -> str:
        outputs = self.outputs
        text = b"".join([outputs[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(path: str) -> Transducer:
    """The machine of a model file, kept with what it remembers while the worker process lives."""
    with open(path, "rb") as f:
        return Transducer(Model(f.read()))


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids, lossless): every text encoded, decoded again and compared.

    The model file must lie at ``model_path`` on every worker.
    """
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, ids array<int>, lossless boolean"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = load(model_path)
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                texts = part.column(1).to_pylist()
                coded = [None if t is None else np.frombuffer(machine.encode(t), np.int32) for t in texts]
                ends = np.cumsum([0] + [0 if c is None else len(c) for c in coded]).astype(np.int32)
                flat = np.concatenate([c for c in coded if c is not None] or [np.empty(0, np.int32)])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()),
                                                 mask=pa.array([c is None for c in coded]))
                same = [None if c is None else machine.decode(c.tolist()) == t for c, t in zip(coded, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends).astype(np.int64)), lists, pa.array(same, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "lossless"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decode_documents(coded: DataFrame, model_path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text) from id lists; null ids give a null text."""
    schema = f"doc_id {coded.schema[doc_id].dataType.simpleString()}, text string"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = load(model_path)
        for part in parts:
            texts = [None if x is None else machine.decode(x) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, schema)
