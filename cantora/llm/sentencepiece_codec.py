"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice runs over characters. Node ``k`` keeps the best way to segment the first ``k``
characters as (score, start, piece id); only a window of the longest piece's length can still be
extended. An automaton of all pieces runs over the characters and gives the edges that end at each. After each block the backpointers
of all nodes in the window are followed: where they meet in one boundary, everything before it is decided and its ids are
committed, so memory is bounded by the window and not by the text. This one search serves words and texts of any length.

Where no piece holds a space after another character, all paths meet before each space whatever comes later. So a text is committed
there at once, and the ids between two spaces depend on nothing else; a worker remembers those of recent words.

Two kinds of models share the search:

* ``unigram`` -- an edge adds the piece's log probability; the best sum wins (ties: the longest
  last piece).
* ``bpe`` -- an edge is admitted only if merging its piece's text after its predecessor's text
  gives exactly these two pieces back. By locality of merges a segmentation is the merge
  result exactly if all its neighbours are admitted, and each prefix has one. The ids are therefore those
  of the merge procedure, although no pass over the whole text is made.

Null text is encoded like the empty one: no ids. A literal U+2581 takes the byte pieces, so that
decoding gives back every text byte for byte.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cantora.llm.common import map_batches, table, texts

SPACE = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: A model larger than this isn't sent along with the tasks.
MODEL_BYTES = 64 << 20
#: Distinct words whose ids a Python worker remembers (two generations).
CACHE_WORDS = 150_000
PAIR_CACHE = 1_000_000
#: Longer words are searched each time.
CACHE_LENGTH = 64
#: Characters between two looks at where the paths meet.
BLOCK = 64


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return model


class Window:
    """The nodes that a coming piece may still reach back to or that are not decided. Node k, after k characters from ``start``: the
    last piece of the best way there, its length, and for unigram models the sum. Node 0 is the last committed boundary."""

    __slots__ = ("out", "piece", "size", "start", "total")

    def __init__(self) -> None:
        self.start, self.piece, self.size, self.total = 0, [-1], [0], [0.0]
        self.out: list[int] = []  # committed ids

    def end(self) -> int:
        return self.start + len(self.piece) - 1

    def meeting(self, width: int) -> int:
        """The last boundary on the ways to all nodes that a coming piece of at most ``width`` characters can start from."""
        last = len(self.piece) - 1
        alive = set(range(max(0, last - width + 1), last + 1))
        while len(alive) > 1:
            k = max(alive)
            alive.discard(k)
            alive.add(k - self.size[k])
        return alive.pop()

    def commit(self, k: int) -> None:
        """The way to node k is decided: its ids go out, and the window begins there."""
        ids, e = [], k
        while e > 0:
            ids.append(self.piece[e])
            e -= self.size[e]
        self.out += reversed(ids)
        del self.piece[:k], self.size[:k], self.total[:k]
        self.start += k

    def restart(self, length: int, ids: list[int]) -> None:
        """All is decided, ``ids`` for the next ``length`` characters too; nothing before them restricts what follows."""
        self.commit(len(self.piece) - 1)
        self.out += ids
        self.start += length
        self.piece, self.size, self.total = [-1], [0], [0.0]


class Codec:
    """Pieces, scores and the search. ``pieces``: (text, score) of ordinary pieces by id."""

    def __init__(self, pieces: dict[int, tuple[str, float]], byte_ids: dict[int, int], kind: str = "bpe", unknown: int = 0):
        self.kind, self.bytes_of, self.unknown = kind, byte_ids, unknown
        self.id = {t: i for i, (t, _) in pieces.items()}
        self.score = {t: s for t, s in pieces.values()}
        self.text = {i: t for i, (t, _) in pieces.items()}
        self.width = max(map(len, self.id), default=1)
        self.raw = {i: t.replace(SPACE, " ").encode() for i, t in self.text.items()} | {i: bytes([b]) for b, i in byte_ids.items()}
        self.many = max(self.text, default=0) + 1
        #: Finds the pieces that end at a character, longest first. One that holds a character that is no piece is out of reach.
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id.items():
            if all(c in self.id for c in t):
                self.automaton.add_word(t, (i, len(t)))
        if not len(self.automaton):
            raise ValueError("a model needs a piece of one character")
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.old_words: dict[str, tuple[int, ...]] = {}
        #: Words can be encoded one by one if no piece holds a space after another character, or a line break.
        self.by_word = all(SPACE not in t.lstrip(SPACE) for t in self.id) and not any("\n" in t for t in self.id)

    @classmethod
    def from_model(cls, model: bytes, kind: str = "bpe") -> Codec:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(p.get_piece_size())
        byte_ids = {int(p.id_to_piece(i)[3:5], 16): i for i in ids if p.is_byte(i)}
        pieces = {i: (p.id_to_piece(i), p.get_score(i)) for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))}
        return cls(pieces, byte_ids, kind, p.unk_id())

    def merge(self, s: str) -> list[str]:
        """The merge procedure on a short text: best score first, then leftmost."""
        parts: list[str | None] = list(s)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(parts)
            if j < len(parts) and (score := self.score.get(t := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, t))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, t = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[j] is None or parts[i] + parts[j] != t:
                continue
            parts[i], parts[j] = t, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [x for x in parts if x is not None]

    def admits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` in a merge result."""
        key = left * self.many + right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            got = self.pairs[key] = self.merge(a + b) == [a, b]
        return got

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of strings (spaces as U+2581), as soon as they are decided. However it is cut into strings, the ids are the same."""
        w, found, seen = Window(), None, 0
        advance = self._advance_bpe if self.kind == "bpe" else self._advance_unigram
        for part in parts:
            for at in range(0, len(part), BLOCK):
                block = part[at : at + BLOCK]
                if found is None:
                    found = self.automaton.iter(block)
                else:
                    found.set(block)  # the automaton goes on in its state
                advance(found, w, block, seen)
                seen += len(block)
                if w.end() < seen:
                    self._bytes(w, block[len(block) - seen + w.end() :])
                if len(w.piece) > 4 * self.width and (keep := w.meeting(self.width)) > 0:
                    w.commit(keep)
                if w.out:
                    yield from w.out
                    w.out = []
        w.commit(len(w.piece) - 1)
        yield from w.out

    def _bytes(self, w: Window, chars: str) -> None:
        """Characters that are no pieces: a boundary on both sides."""
        w.restart(len(chars), [self.bytes_of.get(b, self.unknown) for b in chars.encode()] if self.bytes_of else [self.unknown] * len(chars))

    def _advance_bpe(self, found: Iterable, w: Window, block: str, seen: int) -> None:
        """Nodes at the ends of ``found``, the pieces that end in ``block``, which begins after ``seen`` characters: for each end
        the longest piece comes first, and the first that may follow the node at its start decides."""
        piece, size, pairs, many = w.piece, w.size, self.pairs, self.many
        start, n = w.start, len(piece)
        for end, (i, length) in found:
            k = end + 1 - start
            if k < n:
                continue
            if k > n:
                self._bytes(w, block[w.end() - seen : end - seen])
                piece, size, start, n = w.piece, w.size, w.start, 1
            left = piece[n - length]
            if left >= 0:
                ok = pairs.get(left * many + i)
                if not (self.admits(left, i) if ok is None else ok):
                    continue
            piece.append(i)
            size.append(length)
            n += 1

    def _advance_unigram(self, found: Iterable, w: Window, block: str, seen: int) -> None:
        """As ``_advance_bpe``; the best sum decides, and the longest piece between equal ones."""
        for end, (i, length) in found:
            k = end + 1 - w.start
            if k > len(w.piece):
                self._bytes(w, block[w.end() - seen : end - seen])
                k = 1
            total = w.total[k - length] + self.score[self.text[i]]
            if k == len(w.piece):
                w.piece.append(i)
                w.size.append(length)
                w.total.append(total)
            elif total > w.total[k]:
                w.piece[k], w.size[k], w.total[k] = i, length, total

    def _word(self, w: str) -> tuple[int, ...]:
        """Ids between two spaces: ``\\nx`` is a line break and then x, anything else follows a space."""
        got = self.old_words.get(w)
        if got is None:
            got = (*self.stream((w if w[:1] == "\n" else SPACE + w,)),)
        if len(w) <= CACHE_LENGTH:
            if len(self.words) >= CACHE_WORDS:
                self.words, self.old_words = {}, self.words
            self.words[w] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if SPACE in text or "  " in text or text[-1] == " " or text[0] == " " or " \n" in text or not self.by_word:
            return [*self._whole(text)]
        words, get = self.words, self._word
        out: list[tuple[int, ...]] = []
        for w in text.replace("\n", " \n").split(" ") if text[0] != "\n" else [None, *text.replace("\n", " \n").split(" ")[1:]]:
            if w is None:
                out.append((*self.stream(SPACE),))
                continue
            ids = words.get(w)
            if ids is None:
                ids = get(w)
                words = self.words
            out.append(ids)
        return [*chain.from_iterable(out)]

    def _whole(self, text: str) -> Iterator[int]:
        """Any text, as one stream; literal U+2581 becomes bytes."""
        byte_space = [self.bytes_of.get(b, self.unknown) for b in SPACE.encode()] if self.bytes_of else [self.unknown]
        for n, part in enumerate(text.split(SPACE)):
            if n:
                yield from byte_space
            yield from self.stream((SPACE if n == 0 else "", part.replace(" ", SPACE)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The text's bytes. The space that encoding puts in front is taken off."""
        out = b"".join(map(self.raw.__getitem__, ids))
        return out[1:] if out[:1] == b" " else out


#: Codecs of this Python worker by model and kind, with the words and pairs they remember.
_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec_of(model: bytes, kind: str) -> Codec:
    """The worker's codec: tasks that follow each other use what earlier ones have learned about pairs and words."""
    key = hashlib.sha256(model).digest(), kind
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec.from_model(model, kind)
    return _CODECS[key]


def encode_documents(docs: DataFrame, model: bytes, kind: str = "bpe") -> DataFrame:
    """(doc_id, ids, decoded) per row; decoded is the binary that decoding the ids gives back."""

    def make() -> Callable:
        codec = codec_of(model, kind)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = [codec.encode(t) for t in b.column("text").to_pylist()]
            back = [codec.decode(x) for x in ids]
            flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(offsets, flat), pa.array(back, pa.binary())], ["doc_id", "ids", "decoded"])

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>, decoded binary")


def encoded_digests(docs: DataFrame, model: bytes, kind: str = "bpe") -> DataFrame:
    """(doc_id, n_bytes, n_ids, ids, ids_sha256, decoded_sha256, round_trip): as ``encode_documents``, with the decoded
    bytes compared to the text where they arise. ids_sha256 is of the ids as little-endian 32-bit."""

    def make() -> Callable:
        codec = codec_of(model, kind)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = [x or b"" for x in texts(b)]
            ids = [codec.encode(t.decode("utf-8", "replace")) for t in raw]
            back = [codec.decode(x) for x in ids]
            arrays = [np.array(x, np.int32) for x in ids]
            flat = pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(map(len, ids), pa.int64()), pa.ListArray.from_arrays(offsets, flat),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in arrays]), pa.array([hashlib.sha256(x).hexdigest() for x in back]), pa.array([x == y for x, y in zip(raw, back, strict=True)]),
                ],
                ["doc_id", "n_bytes", "n_ids", "ids", "ids_sha256", "decoded_sha256", "round_trip"],
            )

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_bytes long, n_ids long, ids array<int>, ids_sha256 string, decoded_sha256 string, round_trip boolean")


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again. Null: as the empty text."""
    return encoded_digests(table(spark, sf_dir, "documents"), read_model(model_path))
