"""SentencePiece encoding and decoding with a weighted transducer, for BPE models with byte fallback.

Three transducers are compiled from a model file and composed with each text as it is read:

* the normaliser writes a mark for each space, and one before a text that isn't empty;
* the lexicon reads characters and writes pieces: one arc for each piece that merging can make, and byte arcs for
  characters that are no piece;
* the grammar has a state for each piece: an arc from one piece to the next exists only if merging their characters
  together gives these two pieces again. Its arcs are compiled when first asked for.

Every arc weighs one, absent arcs weigh infinity. Pairwise agreement of neighbours is what makes a segmentation the one
that merging by score gives, so exactly one path is finite, for a text and for each of its prefixes, and the shortest
path of the tropical semiring is that one. Pieces that consist of marks only share one score, where the pairwise rule
has ties; runs of marks are therefore compiled by merging, which the model must allow (they must merge last).
"""

from __future__ import annotations

import struct
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words and arcs a worker remembers, and the longest word it does.
REMEMBERED, REMEMBERED_ARCS, LONGEST = 250_000, 1_000_000, 48
NORMAL, CONTROL, USER, BYTE, BPE = 1, 3, 4, 6, 2
#: Rows that one task turns into one batch of ids.
ROWS = 500


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at, n = 0, len(data)

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < n:
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class Transducer:
    """A compiled model: ``encode`` and ``decode`` of single texts."""

    def __init__(self, model: bytes):
        parts = list(_fields(model))
        self.pieces, scores, kinds = [], [], []
        for piece in (dict(_fields(v)) for k, v in parts if k == 1):
            self.pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
            kinds.append(piece.get(3, NORMAL))
        trainer = dict(_fields(next(v for k, v in parts if k == 2)))
        normaliser = dict(_fields(next(v for k, v in parts if k == 3)))
        if trainer.get(3) != BPE or not trainer.get(35):
            raise ValueError("only BPE models with byte fallback are supported")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24) or USER in kinds:
            raise ValueError("only the identity normaliser without user-defined pieces is supported")
        self.prefix = bool(normaliser.get(3, 1))
        self.all = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        self.score = {p: scores[i] for p, i in self.all.items()}
        self.bytes = [i for i, k in enumerate(kinds) if k == BYTE]
        self.byte_ids = set(self.bytes)
        if len(self.pieces) > 1 << 16:
            raise ValueError("at most 65536 pieces")
        self.written = [
            b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, kinds)
        ]
        self.written[0] = " ⁇ ".encode()
        marks = [s for p, s in self.score.items() if not p.strip(MARK) and len(p) > 1]
        words = [s for p, s in self.score.items() if len(p) > 1 and p.strip(MARK)]
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in self.all) or (
            marks and max(marks) >= min(words)
        ):
            raise ValueError("pieces must hold marks in front only, and runs of marks must merge last")
        self.lexicon = {p: i for p, i in self.all.items() if len(p) == 1 or self.merged(p) == [p]}
        self.lexicon = {p: i for p, i in self.lexicon.items() if len(p) == 1 or p.strip(MARK)}

    def merged(self, text: str) -> list[str]:
        """Merging by score, leftmost first: for pairs of pieces and runs of marks, which are short."""
        out = list(text)
        while True:
            best, where = None, -1
            for i in range(len(out) - 1):
                score = self.score.get(out[i] + out[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if where < 0:
                return out
            out[where : where + 2] = [out[where] + out[where + 1]]

    @property
    def grammar(self) -> Grammar:
        if "_grammar" not in self.__dict__:
            self._grammar = Grammar(self)
        return self._grammar

    @property
    def known(self) -> Words:
        if "_known" not in self.__dict__:
            self._known = Words(self)
        return self._known

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_grammar", "_known", "_trie")}

    @property
    def trie(self) -> dict:
        """The lexicon as a tree of characters; a piece stands under the empty key where it ends."""
        if "_trie" not in self.__dict__:
            self._trie: dict = {}
            for piece, i in self.lexicon.items():
                node = self._trie
                for char in piece:
                    node = node.setdefault(char, {})
                node[""] = i
        return self._trie

    def shortest(self, text: str) -> list[int]:
        """The one finite path through a word with at most one mark, in front.

        A depth-first walk, long pieces first. Each prefix has one segmentation, so a place from which the end was not
        reached is reached by no other path either, and no place is left twice.
        """
        n, grammar, trie = len(text), self.grammar, self.trie
        dead: set[int] = set()
        taken: list[int] = []  # pieces on the path, minus one for a character that is none
        open_: list[list[tuple[int, int]]] = []  # for each place on the path: arcs not tried yet, longest last
        at = 0
        while at < n:
            arcs, node, end = [], trie, at
            while end < n and (node := node.get(text[end])) is not None:
                end += 1
                if (piece := node.get("")) is not None:
                    arcs.append((piece, end))
            open_.append(arcs or [(-1, at + 1)])
            while True:
                last = taken[-1] if taken else -1
                arcs = open_[-1]
                while arcs:
                    piece, end = arcs.pop()
                    if end not in dead and (last < 0 or piece < 0 or grammar[last << 16 | piece]):
                        taken.append(piece)
                        at = end
                        break
                else:
                    open_.pop()
                    dead.add(at)
                    at -= len(self.pieces[last]) if last >= 0 else 1
                    taken.pop()
                    continue
                break
        if -1 not in taken:
            return taken
        out, at = [], 0
        for piece in taken:
            if piece < 0:
                out += [self.bytes[b] for b in text[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(piece)
            at += len(self.pieces[piece]) if piece >= 0 else 1
        return out

    def run(self, marks: int) -> list[int]:
        """Pieces of a run of marks; long runs are cut where merging can't reach over."""
        return [self.all[p] for p in _merged_run(self, marks)]

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text; words are looked up whole, since no piece reaches over a mark that follows something else."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        words = text.replace(MARK, " ").split(" ")
        if not self.prefix:
            head, words = words[0], words[1:]
        known = self.known
        if "" not in words:
            out = b"".join(map(known.__getitem__, words))
        else:
            found, marks = [], 0
            for word in words:
                if word:
                    found.append(known[word] if not marks else known.after(marks, word))
                    marks = 0
                else:
                    marks += 1
            if marks:
                found.append(array("i", self.run(marks)).tobytes())
            out = b"".join(found)
        if not self.prefix and head:
            out = array("i", self.shortest(head)).tobytes() + out
        return np.frombuffer(out, dtype=np.int32)

    def text(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that the normaliser put in front."""
        out = b"".join(map(self.written.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


@lru_cache(maxsize=4096)
def _merged_run(model: Transducer, marks: int) -> tuple[str, ...]:
    return tuple(model.merged(MARK * marks))


class Grammar(dict):
    """Whether one piece may follow another."""

    def __init__(self, model: Transducer):
        super().__init__()
        self.model = model

    def __missing__(self, pair: int) -> bool:
        a, b = self.model.pieces[pair >> 16], self.model.pieces[pair & 0xFFFF]
        if len(self) >= REMEMBERED_ARCS:
            self.clear()
        out = self[pair] = self.model.merged(a + b) == [a, b]
        return out


class Words(dict):
    """Ids, as bytes, of words with a mark in front."""

    def __init__(self, model: Transducer):
        super().__init__()
        self.model = model
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = self._appended(word) or array("i", self.model.shortest(MARK + word)).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                # Words in use come back from here; the others go with the next turn.
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out

    def _appended(self, word: str) -> bytes | None:
        """A word with a sign at its end: the path of the word and an arc for the sign, if there is that arc."""
        sign = self.model.lexicon.get(word[-1]) if len(word) > 1 and not word[-1].isalnum() else None
        if sign is None:
            return None
        ids = self[word[:-1]]
        last = int.from_bytes(ids[-4:], sys.byteorder)
        follows = self.model.grammar[last << 16 | sign] and last not in self.model.byte_ids
        return ids + array("i", [sign]).tobytes() if follows else None

    def after(self, marks: int, word: str) -> bytes:
        """Ids of further marks, a mark and a word: marks merge last, so the word takes its own mark if it can."""
        ids = self[word]
        first = int.from_bytes(ids[:4], sys.byteorder)
        if first == self.model.all[MARK]:
            return array("i", self.model.run(marks + 1)).tobytes() + ids[4:]
        return array("i", self.model.run(marks)).tobytes() + ids


def load(path: str = MODEL) -> Transducer:
    """Compile the model file at a path of the driver."""
    with open(path, "rb") as file:
        return Transducer(file.read())


def encoded(docs: DataFrame, model: Transducer, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids``, the pieces of each text, and if named ``decoded``, the text that they give.

    Null texts have null ids, empty ones none. Whole texts are encoded; a character that is no piece becomes its bytes.
    Decoding gives the text again, but that a mark U+2581 comes back as a space and bytes that are no UTF-8 come back
    replaced. Columns of ``docs`` with these names are replaced, all others stay, rows are neither dropped nor joined.
    The compiled model is broadcast: its size is that of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = {ids.lower(), (decoded or ids).lower()}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    (source,) = fresh(docs, "_source")
    rows = docs.select(*kept, F.col(text).alias(source))
    names = [c for c in rows.columns if c != source]
    schema = rows.select(*[F.col(f"`{c}`") for c in names]).schema.add(ids, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, "string")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()
                found = [None if t is None else model.ids(t.decode("utf-8", "replace")) for t in texts]
                sizes = [0 if x is None else len(x) for x in found]
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = np.concatenate([x for x in found if x is not None] or [np.zeros(0, np.int32)])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=np.array([*(x is None for x in found), False])), pa.array(values, pa.int32())
                )
                columns = [part.column(i) for i in range(len(names))] + [lists]
                if decoded:
                    columns.append(pa.array([None if x is None else model.text(x) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return rows.mapInArrow(convert, schema)


def decoded(docs: DataFrame, model: Transducer, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, what the pieces in ``ids`` give; null ids give a null text. A column named so is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()])
    (source,) = fresh(docs, "_source")
    rows = kept.withColumn(source, F.col(ids))
    schema = kept.schema.add(text, "string")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = batch.column(batch.num_columns - 1).to_pylist()
            texts = pa.array([None if x is None else model.text(np.array(x, dtype=np.int32)) for x in found], pa.string())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, texts], names=[f.name for f in schema])

    return rows.mapInArrow(convert, schema)


def with_pieces(docs: DataFrame, model: Transducer) -> DataFrame:
    """doc_id, n_pieces, ids, and whether decoding gives the text again (marks U+2581 read as spaces)."""
    out = encoded(docs.select("doc_id", "text"), model, decoded="decoded")
    return out.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "ids",
        F.col("decoded").eqNullSafe(F.translate("text", MARK, " ")).alias("round_trip"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    return with_pieces(table(spark, sf_dir, "documents"), load(model))
