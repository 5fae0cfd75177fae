"""SentencePiece encoding and decoding with a merge-type (BPE) model, exactly as the library does it.

A sequence of pieces is what merging gives if and only if every piece alone merges to itself and no
merge crosses the border of two neighbours in the text of just those two. So every prefix of a text
has one last piece: an automaton reports the pieces that end at a position, and the one compatible
with the last piece of the prefix before it is stored. Ids are then read backwards from the end.

No piece holds a space mark after another character, so texts fall into stretches that start at a
run of space marks; stretches repeat, and each worker keeps a bounded table of those it has seen.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.words import byte_slices, worker_cache

MARK = "▁"
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6
# Stretches and pairs of pieces kept per worker, and text handled at a time.
KEPT_STRETCHES = 200_000
KEPT_PAIRS = 400_000
BYTES_AT_ONCE = 1 << 20


class PieceModel:
    """Pieces of a model file with their merge trees, the automaton, and the tested pairs."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        kinds = {p.type for p in proto.pieces}
        if trainer.model_type != trainer.BPE or not plain or not trainer.byte_fallback or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only merge-type models with byte fallback, no text rules and no user-defined or unused pieces")
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.bos, self.eos = trainer.bos_id, trainer.eos_id
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.surface = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.surface[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == NORMAL:
                self.surface[i] = p.piece.replace(MARK, " ").encode()
        if any(MARK in p.strip(MARK) or (p[0] != MARK and MARK in p) for p in ids):
            raise ValueError("a piece holds a space mark after another character")
        # Single characters take part in merges even where they are no piece themselves.
        chars = sorted({c for p in ids for c in p})
        self.text = ["", *chars, *[p for p in ids if len(p) > 1]]
        self.packed: list[bytes] = [b""]
        self.length = [1]
        self.right: list[list] = [[]]
        self.left: list[list] = [[]]
        self.odd = [False]
        self.automaton = ahocorasick.Automaton()
        for t, piece in enumerate(self.text):
            if t == 0:
                continue
            tree = self._tree(piece)
            self.length.append(len(piece))
            self.packed.append(array("I", [ids[piece]]).tobytes() if piece in ids else self._bytes(piece))
            self.odd.append(tree is not None and not self._falling(piece, tree))
            self.right.append(self._spine(piece, 1) if tree is not None else [])
            self.left.append(self._spine(piece, 0) if tree is not None else [])
            if tree is not None:
                self.automaton.add_word(piece, (len(piece), t))
        self.automaton.make_automaton()
        del self._trees
        broken = "".join(c for c in "\n\t\r" if not any(c in p for p in ids))
        self.separator = "\n"
        if "\n" not in broken:
            raise ValueError("a piece holds a line break")
        stop = re.escape(broken)
        self.stretch = re.compile(f"{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+|[{stop}]+")
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        return array("I", [self.byte_ids[b] for b in text.encode()]).tobytes()

    def merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging: the best-scored neighbours first, the leftmost of equals. Also the last merge."""
        parts, last = list(text), None
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = (s, i)
            if best is None:
                break
            i = best[1]
            last = (parts[i], parts[i + 1])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, last

    def _tree(self, piece: str):
        """Last merge of a piece; () for a character; None if merging never makes the piece."""
        if not hasattr(self, "_trees"):
            self._trees: dict[str, tuple | None] = {}
        if piece not in self._trees:
            parts, last = self.merge(piece)
            self._trees[piece] = None if len(parts) > 1 else last or ()
        return self._trees[piece]

    def _born(self, piece: str) -> float:
        return self.score[piece] if len(piece) > 1 else float("inf")

    def _falling(self, piece: str, tree: tuple) -> bool:
        """Whether every merge of the piece scores below the merges that made its halves."""
        return not tree or all(
            self.score[piece] < self._born(half) and self._falling(half, self._tree(half)) for half in tree
        )

    def _spine(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """Symbols at one edge of a piece while it is made: text, score when made, score when merged on."""
        out, dies = [], float("-inf")
        while True:
            out.append((piece, self._born(piece), dies))
            tree = self._tree(piece)
            if not tree:
                return out
            dies = self.score[piece]
            piece = tree[side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of both pieces leaves exactly these two."""
        if not a or not b:
            return True
        if self.odd[a] or self.odd[b]:
            return self.merge(self.text[a] + self.text[b])[0] == [self.text[a], self.text[b]]
        score = self.score.get
        for x, born_x, dies_x in self.right[a]:
            for y, born_y, dies_y in self.left[b]:
                s = score(x + y)
                if s is not None:
                    fires = min(s, born_x, born_y)
                    # Of equal scores the leftmost goes first: x's own merge before this one, this one before y's.
                    if fires > dies_x and fires >= dies_y:
                        return False
        return True

    def prefix_table(self, text: str) -> list[int]:
        """Last piece of every prefix, 0 where the last character belongs to no piece."""
        last = [0] * (len(text) + 1)
        pairs, test = self.pairs, self.compatible
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        done = -1
        for end, (length, t) in self.automaton.iter(text):
            if end != done:
                key = last[end + 1 - length] << 20 | t
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = test(key >> 20, t)
                if fits:
                    last[end + 1] = t
                    done = end
        return last

    def learn(self, stretches: set[str]) -> None:
        """Encode stretches not yet known, all in one pass of the automaton."""
        if len(self.known) > KEPT_STRETCHES:
            self.known.clear()
        new = [s for s in stretches if s not in self.known]
        text = self.separator.join(new)
        last = self.prefix_table(text)
        packed, length = self.packed, self.length
        start = 0
        for s in new:
            at, out = start + len(s), []
            while at > start:
                t = last[at]
                out.append(packed[t] if t else self._bytes(text[at - 1]))
                at -= length[t]
            out.reverse()
            self.known[s] = b"".join(out)
            start += len(s) + 1

    def encode_many(self, texts: list[str], bos: bool = True, eos: bool = True) -> list[bytes]:
        """Ids of every text as 32-bit little-endian numbers; an empty text has only the end marks."""
        head = array("I", [self.bos] if bos else []).tobytes()
        tail = array("I", [self.eos] if eos else []).tobytes()
        cut = [self.stretch.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn({s for stretches in cut for s in stretches})
        look = self.known.__getitem__
        return [head + b"".join(map(look, stretches)) + tail for stretches in cut]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids: pieces with marks as spaces, byte pieces as bytes, one leading space less."""
        ids = array("I", packed)
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about BYTES_AT_ONCE bytes each, at least one row."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BYTES_AT_ONCE)))
        yield start, min(end, n)
        start = end


def encode_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None,
    bos: bool = True, eos: bool = True,
) -> DataFrame:
    """Encode and decode every whole text: key, n_tokens, ids (packed little-endian 32-bit), decoded.

    ``model`` is a path every executor can read; by default the workers ask the installed tokenizer
    package for theirs. Sampling is never used. A null or empty text has just the begin and end ids
    and decodes to "". Null keys, ties and repeated rows are kept; other columns are not read; an
    empty table gives no rows. Nothing is shuffled and texts of any length are handled whole.
    """
    keyed = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model or default_model()
        pieces = worker_cache(f"pieces:{path}", lambda: PieceModel(path))
        for batch in batches:
            for a, b in _groups(byte_slices(batch.column(1))[1]):
                packed = pieces.encode_many([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()], bos, eos)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.array([pieces.decode(p) for p in packed], pa.string()),
                    ],
                    names=["k", "n_tokens", "ids", "decoded"],
                )

    return keyed.mapInArrow(run, f"k {kind}, n_tokens bigint, ids binary, decoded string").withColumnRenamed("k", key)
