"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Ids and decoded texts are those of the sentencepiece library, for BPE and unigram models with byte fallback.

No piece reaches across a place before a mark (U+2581, a space) that follows another character, or beside a character that
is in no piece; words between such places are encoded once by the library and remembered.

A document above ``GIANT`` characters is cut into chunks.  A border's states are the pieces that end at it or reach across it.  A chunk's
transfer matrix holds, for each state at its first border and each at its last one, the best score of a path of pieces between them:
in a unigram model the sum of the pieces' scores; in a BPE model 0 where every two neighbours are what merging the two of
them alone gives, and minus infinity elsewhere.  That is enough, since merging in one piece never depends on another that it doesn't merge
with: one path alone has only such neighbours, the model's.  Matrices combine associatively,
(A*B)[i,j] = max_k A[i,k] + B[k,j]: first in blocks of chunks, then over a document's blocks.  The best states at block and
chunk borders follow, and each chunk is traced on its own between its states.

All paths meet at the places that no piece reaches across, so a chunk with words needs pieces only up to its first such place and after its last one;
what lies between is a constant, which favours no state and is left out.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import resident, written

MARK = "▁"
#: Characters of a document that is cut into chunks, of a chunk, and chunks of a block.
GIANT, CHUNK, BLOCK = 1 << 15, 1 << 13, 64
#: Words and pairs of pieces that a Python worker remembers at most, and characters of a word that is.
CACHE_WORDS, CACHE_PAIRS, CACHED_CHARS = 300_000, 100_000, 48
#: What a character without a piece costs more than the worst piece of a unigram model; a fixed value of the library.
UNKNOWN = 10.0


class Pieces:
    """Words, borders and paths under a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.of_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.of_byte) < 256:
            raise ValueError("the model has no byte fallback")
        self.pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.merges = all(x == int(x) for _, x in self.pieces.values())  # scores of BPE models are ranks of merges
        self.longest = max(map(len, self.pieces))
        self.unknown = min(x for _, x in self.pieces.values()) - UNKNOWN
        inside = {c for p in self.pieces if len(p) > 1 for c in p}
        self.wall = next(c for c in ("\n", "\x01", "﷐", "﷑") if c not in inside and c not in self.pieces and model.normalize(c) == MARK + c)
        self.skip = len(model.encode(self.wall))
        # words begin at a mark that follows another character; a piece with a mark further on would cross such a place
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("the model has pieces of several words")
        self.words = re.compile(f"{MARK}*[^{MARK}{self.wall}]+|{self.wall}|{MARK}+")
        self.meet = re.compile(f"(?<=[^{MARK}])(?={MARK})|(?={self.wall})")
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[str | None, str], bool] = {}

    def marked(self, text: str) -> str:
        """The text as the model sees it: normalised, spaces as marks."""
        return self.model.normalize(text)

    def _library(self, words: list[str]) -> list[list[int]]:
        """Ids of stretches of marked text; the library puts a mark before each text, so a word without one mark comes after a wall."""
        simple = [w[0] == MARK and len(w) > 1 and w[1] != MARK for w in words]
        found = self.model.encode([w[1:] if s else self.wall + w for w, s in zip(words, simple, strict=True)], num_threads=1)
        return [x if s else x[self.skip :] for x, s in zip(found, simple, strict=True)]

    def encode_marked(self, s: str) -> bytes:
        """Ids (little-endian unsigned 32-bit) of marked text between two borders of its pieces."""
        words = self.words.findall(s)
        found = list(map(self.known.get, words))
        if None in found:
            missing = list({w for w, v in zip(words, found, strict=True) if v is None})
            fresh = {w: np.array(x, dtype="<u4").tobytes() for w, x in zip(missing, self._library(missing), strict=True)}
            if len(self.known) + len(fresh) > CACHE_WORDS:
                self.known.clear()
            self.known.update((w, x) for w, x in fresh.items() if len(w) <= CACHED_CHARS)
            found = [fresh[w] if v is None else v for w, v in zip(words, found, strict=True)]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, dtype="<u4").tolist())

    # The scan

    def edges(self, s: str, i: int) -> list[tuple[int, float]]:
        """(end, score) of the pieces that begin at i; a character without a piece is one of its own."""
        out = [(j, self.pieces[s[i:j]][1]) for j in range(i + 1, min(len(s), i + self.longest) + 1) if s[i:j] in self.pieces]
        return out if s[i] in self.pieces else [(i + 1, self.unknown), *out]

    def states(self, s: str, border: int) -> list[tuple[int, int]]:
        """(begin, end) of the pieces that end at the border or reach across it, in order."""
        return [(i, j) for i in range(max(0, border - self.longest), border) for j, _ in self.edges(s, i) if j >= border]

    def _ids(self, piece: str) -> list[int]:
        return [self.pieces[piece][0]] if piece in self.pieces else [self.of_byte[b] for b in piece.encode()]

    def fits(self, before: str | None, piece: str) -> bool:
        """Whether merging the two alone gives the two."""
        found = self.pairs.get((before, piece))
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            ids = (self._ids(before) if before else []) + self._ids(piece)
            found = self.pairs[before, piece] = self.model.encode(self.wall + (before or "") + piece)[self.skip :] == ids
        return found

    def run(self, s: str, arrivals: dict[int, list], low: int, high: int) -> dict[tuple[int, int], np.ndarray]:
        """Best scores (a vector over the states at the start) of the pieces that begin before ``high`` and end at it or beyond.

        arrivals: by place, (piece, vector) of those that end there."""
        out = {}
        for i in range(low, high):
            here = arrivals.pop(i, None)
            if not here:
                continue
            best = None if self.merges else np.maximum.reduce([v for _, v in here])
            for j, score in self.edges(s, i):
                piece = s[i:j]
                if self.merges:
                    fit = [v for before, v in here if self.fits(before, piece)]
                    if not fit:
                        continue
                    v = np.maximum.reduce(fit)
                else:
                    v = best + score
                arrivals.setdefault(j, []).append((piece, v))
                if j >= high:
                    out[i, j] = v
        return out

    def transfer(self, s: str, begin: int, end: int) -> np.ndarray:
        """The matrix of the chunk s[begin:end], where s has the characters around it that a piece can reach.

        A document's beginning (begin 0) and its end (end of s) have one state each."""
        left = self.states(s, begin) if begin else [(0, 0)]
        arrivals: dict[int, list] = {}
        for k, (i, j) in enumerate(left):
            unit = np.full(len(left), -np.inf)
            unit[k] = 0.0
            arrivals.setdefault(j, []).append((s[i:j] or None, unit))
        first = self.meet.search(s, max(begin, 1), end)
        if first and first.end() < end:
            p = first.end()
            self.run(s, arrivals, begin, p)
            into = np.maximum.reduce([v for _, v in arrivals.get(p, [])] or [np.full(len(left), -np.inf)])
            last = p
            for at in range(end - 1, p, -1):
                if self.meet.match(s, at):
                    last = at
                    break
            out = {k: into + v[0] for k, v in self.run(s, {last: [(None, np.zeros(1))]}, last, end).items()}
        else:
            out = self.run(s, arrivals, begin, end)
        if end == len(s):
            return np.maximum.reduce([v for (_, j), v in out.items() if j == end])[:, None]
        nothing = np.full(len(left), -np.inf)
        return np.stack([out.get(k, nothing) for k in self.states(s, end)], axis=1)

    def between(self, s: str, begin: int, end: int, first: int, last: int) -> str:
        """The marked text between the ends of two states at a chunk's borders."""
        a = self.states(s, begin)[first][1] if begin else 0
        return s[a : self.states(s, end)[last][1] if end < len(s) else end]


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(a * b)[i, j] = max over k of a[i, k] + b[k, j]."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def borders(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """Best states at all borders, from ``first`` before the matrices to ``last`` after them; of equal ones the first."""
    ahead = np.full(matrices[-1].shape[1], -np.inf)
    ahead[last] = 0.0
    later = [ahead]
    for t in reversed(matrices[1:]):
        later.append((t + later[-1][None, :]).max(axis=1))
    out = [first]
    for t, after in zip(matrices, reversed(later), strict=True):
        out.append(int((t[out[-1]] + after).argmax()))
    return out


#: Rows of a batch that are worked on at a time, so that what Python holds of texts beside Arrow stays small.
SLICE = 500


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def pieces_of(path: str) -> Pieces:
    return resident(("sentence pieces", path), lambda: Pieces(path))


def _dump(m: np.ndarray) -> bytes:
    return m.shape[0].to_bytes(4, "little") + m.astype("<f8").tobytes()


def _load(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype="<f8", offset=4).reshape(int.from_bytes(b[:4], "little"), -1)


def chunks_of(s: str, longest: int) -> list[tuple[int, int, str]]:
    """(begin, end, text) of the chunks of marked text, each with the characters around it that a piece can reach; begin and end count in it."""
    n = max(1, len(s) // CHUNK)
    edges = [k * CHUNK for k in range(n)] + [len(s)]
    return [(min(a, longest), b - max(0, a - longest), s[max(0, a - longest) : b + longest]) for a, b in zip(edges, edges[1:], strict=False)]


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): the library's ids of each row's text, as little-endian unsigned 32-bit integers.

    A null or empty text has no ids.  Repeated rows each give a row; null ids stay null; other columns are
    ignored.  An empty table gives an empty one.  Equal scores of a unigram model's paths are summed in double precision in giant documents and in single
    precision by the library; of equal paths the first state in order counts.
    """
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = given.schema["id"].dataType

    def whole(batches):
        p = pieces_of(model)
        for batch in _slices(batches):
            found = [p.encode_marked(p.marked(t)) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "ids"])

    small = given.where(F.char_length("t") <= GIANT).mapInArrow(whole, StructType([StructField("id", kind), *StructType.fromDDL("ids binary").fields]))

    giants = written(given.where(F.char_length("t") > GIANT).withColumn("row", F.monotonically_increasing_id()), "giant-texts")

    def cut(batches):
        p = pieces_of(model)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                begin, end, s = zip(*chunks_of(p.marked(text), p.longest), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(s), pa.int64()), pa.array(list(range(len(s))), pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(s, pa.string())], names=["row", "chunk", "begin", "end", "s"])

    # dealt by chunk, so that one document's go to all tasks
    chunks = written(giants.select("row", "t").mapInArrow(cut, "row long, chunk long, begin long, end long, s string").repartition("row", "chunk"), "giant-chunks")

    def matrices(batches):
        p = pieces_of(model)
        for batch in _slices(batches):
            found = [_dump(p.transfer(s, a, b)) for a, b, s in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "chunk", "m"])

    block = F.floor(F.col("chunk") / BLOCK).cast("long").alias("block")
    each = written(chunks.mapInArrow(matrices, "row long, chunk long, m binary").select("row", "chunk", block, "m"), "giant-matrices")

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        out = _load(pdf["m"].iloc[0])
        for m in pdf["m"].iloc[1:]:
            out = combine(out, _load(m))
        return pd.DataFrame({"row": [pdf["row"].iloc[0]], "block": [pdf["block"].iloc[0]], "m": [_dump(out)]})

    blocks = each.groupBy("row", "block").applyInPandas(reduce, "row long, block long, m binary")

    def place_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        at = borders([_load(m) for m in pdf["m"]], 0, 0)
        return pd.DataFrame({"row": pdf["row"], "block": pdf["block"], "first": at[:-1], "last": at[1:]})

    def place_chunks(_, own: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("chunk")
        at = borders([_load(m) for m in own["m"]], int(ends["first"].iloc[0]), int(ends["last"].iloc[0]))
        return pd.DataFrame({"row": own["row"], "chunk": own["chunk"], "first": at[:-1], "last": at[1:]})

    # a document's blocks: one matrix for each BLOCK * CHUNK characters of it
    ends = blocks.groupBy("row").applyInPandas(place_blocks, "row long, block long, first long, last long")
    placed = each.groupBy("row", "block").cogroup(ends.groupBy("row", "block")).applyInPandas(place_chunks, "row long, chunk long, first long, last long")

    def trace(batches):
        p = pieces_of(model)
        for batch in _slices(batches):
            found = [p.encode_marked(p.between(s, a, b, first, last)) for a, b, s, first, last in zip(*(batch.column(k).to_pylist() for k in range(2, 7)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "chunk", "ids"])

    traced = chunks.join(placed, ["row", "chunk"]).select("row", "chunk", "begin", "end", "s", "first", "last").mapInArrow(trace, "row long, chunk long, ids binary")
    # a document's parts meet in one row, as its text did
    joined = traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", F.hex("ids").alias("ids")))).alias("x"))
    large = giants.select("row", "id").join(joined, "row").select("id", F.unhex(F.array_join(F.transform("x", lambda y: y["ids"]), "")).alias("ids"))
    return small.unionByName(large).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, *, ids_col: str = "ids") -> DataFrame:
    """The rows with ``text``: what the library decodes their ids to; null ids give null.

    Of an encoded text that is the text itself, but that a mark (U+2581) of its own comes back as the space it was encoded as, and that
    a model with normalisation gives the normalised text.  A column ``text`` of the input is replaced.
    """

    def back(batches):
        p = pieces_of(model)
        for batch in _slices(batches):
            found = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if x is None else p.decode(x) for x in found], pa.string())], names=[*batch.schema.names, "text"])

    rows = encoded.drop("text")
    return rows.mapInArrow(back, StructType([*rows.schema.fields, StructField("text", StringType())]))
