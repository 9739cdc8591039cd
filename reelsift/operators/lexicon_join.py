"""A lexicon that is a table: releases met with any number of tokens.

:mod:`functions.lexicon` compiles a list of literals into a few scans, right for a hundred tokens; here the same rules meet a table.  All that is looked for is a piece of a text: raw tokens,
glued names and allowed phrases anywhere, other tokens as phrases between the spaces of all names.  A task hashes the pieces of a batch's different texts, all of one length at once, looks them up among
the hashes of the tokens of that length, and compares what it finds.  So releases are read once for a million tokens, are not shuffled unless there are more, and a text costs its pieces whatever the tokens' number.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.lexicon import _joined
from ..functions.text import effective_title, norm
from ..sources.scratch import settled

#: Characters and number of the texts to find that a task holds at once (some 100 MB at most); more are met by further passes.
AUTOMATON, MOST_BROADCAST = 16 << 20, 1 << 20
#: How a token was found, in the order in which one goes before another, and what stands for an allowed phrase.
RAW, PHRASE, GLUED, ALLOW = 0, 1, 2, 3
#: The columns of texts that each is looked for in.
PLACES = ("raw", "every", "glued", "name")
#: Multipliers of hashes; entries of a table of hashes at most.
BASE, MIX, SEEN = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), 1 << 24

_parts: dict = {}


def lexicon_of(rows: DataFrame) -> DataFrame:
    """(ord, kind, token, n, raw): a lexicon made ready, from rows (ord long, kind, token); kind "allow" is for phrases that are never blocked.

    n: the normalized token.  raw: whether it has other characters than letters, digits and spaces, and is looked for as it stands.  Null and blank tokens are left out, and so are
    others in which nothing is left; a repeated token of a kind counts with its least ord."""
    least = rows.where(F.trim("token") != "").groupBy("kind", "token").agg(F.min("ord").alias("ord"))
    made = least.select("ord", "kind", "token", norm(F.col("token")).alias("n"), ((F.col("kind") != "allow") & F.col("token").rlike("[^a-zA-Z0-9 ]")).alias("raw"))
    return made.where("raw or n <> ''")


def _wanted(lexicon: DataFrame) -> DataFrame:
    """(how, find, ord, kind, token): the texts to find; of tokens that look for the same, the first counts."""
    plain, n = lexicon.where("not raw and kind <> 'allow'"), F.col("n")
    entry = lambda df, how, find: df.select(F.lit(how).alias("how"), find.alias("find"), F.struct("ord", "kind", "token").alias("e"))
    every = entry(lexicon.where("raw"), RAW, F.lower("token"))
    # a phrase stands between spaces
    every = every.unionByName(entry(plain, PHRASE, F.concat(F.lit(" "), n, F.lit(" ")))).unionByName(entry(plain, GLUED, F.replace(n, F.lit(" "), F.lit(""))))
    every = every.unionByName(entry(lexicon.where("kind = 'allow'"), ALLOW, n))
    return every.where("find <> ''").groupBy("how", "find").agg(F.min("e").alias("e")).select("how", "find", "e.*")


def _shipments(wanted: DataFrame):
    """Lists of Arrow streams of the texts to find, up to the bounds; the driver holds one at a time, as bytes."""
    rows = max(10, min(2000, AUTOMATON // 16))

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some, sink = batch.slice(at, rows), pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(some)
                yield pa.RecordBatch.from_pydict({"entries": pa.array([sink.getvalue().to_pybytes()], pa.binary()), "n": [some.num_rows], "size": pa.array([pc.sum(pc.utf8_length(some.column("find"))).as_py()], pa.int64())})

    part, n, size = [], 0, 0
    for row in wanted.mapInArrow(pack, "entries binary, n long, size long").toLocalIterator():
        part.append(bytes(row["entries"]))
        n += row["n"]
        size += row["size"]
        if n >= MOST_BROADCAST or size >= AUTOMATON:
            yield part
            part, n, size = [], 0, 0
    if part:
        yield part


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points one after another, and where each ends."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), np.cumsum([len(x) for x in texts], dtype=np.int64)


class Tokens:
    """Texts to find in one place, first ones first."""

    def __init__(self, entries: pa.Table):
        self.entries = entries.take(pc.sort_indices(entries, sort_keys=[("ord", "ascending"), ("kind", "ascending"), ("token", "ascending")], null_placement="at_start"))
        self.ords = pc.fill_null(self.entries["ord"], np.iinfo(np.int64).min).to_numpy()
        points, ends = _points(self.entries["find"].to_pylist())
        sizes = np.diff(ends, prepend=0)
        bits = min(SEEN, 8 * len(ends)).bit_length()
        self.shift, self.seen = np.uint64(64 - bits), np.zeros(1 << bits, dtype=bool)
        #: by length: sorted hashes, and the entry of each
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        open_, hashed = np.arange(len(ends)), np.zeros(len(ends), dtype=np.uint64)
        for size in range(1, int(sizes.max(initial=0)) + 1):
            longer = sizes[open_] >= size
            open_, hashed = open_[longer], hashed[longer]
            hashed = hashed * BASE + points[ends[open_] - sizes[open_] + size - 1]
            here = np.flatnonzero(sizes[open_] == size)
            if len(here):
                order = here[np.argsort(hashed[here], kind="stable")]
                self.by_size[size] = hashed[order], open_[order]
                self.seen[self._at(hashed[order], size)] = True

    def _at(self, hashed: np.ndarray, size: int) -> np.ndarray:
        return ((hashed ^ np.uint64(size)) * MIX) >> self.shift

    def first(self, texts: list[str], words: bool) -> np.ndarray:
        """The first entry that each text has as a piece, -1 without one; ``words``: all pieces begin with a space."""
        best = np.full(len(texts), -1, dtype=np.int64)
        points, ends = _points(texts)
        at = np.flatnonzero(points == 32) if words else np.arange(len(points))
        owner = np.searchsorted(ends, at, side="right")
        end, hashed, found = ends[owner], np.zeros(len(at), dtype=np.uint64), []
        for size in range(1, max(self.by_size, default=0) + 1):
            inside = at + size <= end
            if not inside.all():
                at, owner, end, hashed = (x[inside] for x in (at, owner, end, hashed))
            if not len(at):
                break
            hashed = hashed * BASE + points[at + size - 1]
            if size in self.by_size:
                may = np.flatnonzero(self.seen[self._at(hashed, size)])
                known, entry = self.by_size[size]
                low = np.searchsorted(known, hashed[may])
                n = np.searchsorted(known, hashed[may], side="right") - low
                of = np.repeat(may, n)
                found.append((owner[of], entry[np.arange(len(of)) + np.repeat(low - (np.cumsum(n) - n), n)], at[of]))
        if not found:
            return best
        owner, entry, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((entry, owner))
        owner, entry, at = owner[order], entry[order], at[order]
        # hashes may be equal by chance: a text's first one is compared, then its next
        starts = at - (ends - np.diff(ends, prepend=0))[owner]
        while len(owner):
            lead = np.flatnonzero(np.diff(owner, prepend=-1))
            finds = self.entries["find"].take(pa.array(entry[lead])).to_pylist()
            right = np.array([texts[o].startswith(x, s) for o, s, x in zip(owner[lead].tolist(), starts[lead].tolist(), finds, strict=True)], dtype=bool)
            best[owner[lead[right]]] = entry[lead[right]]
            left = best[owner] < 0
            left[lead] = False
            owner, entry, starts = owner[left], entry[left], starts[left]
        return best


def tokens_of(part: list[bytes]) -> dict[int, Tokens]:
    """The texts to find of a part, by how they are looked for."""
    table = pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in part)
    return {how: Tokens(some) for how in range(len(PLACES)) if (some := table.filter(pc.equal(table["how"], how))).num_rows}


def _found(batch: pa.RecordBatch, tokens: dict[int, Tokens]):
    """Record batches (id, ord, how, kind, token, allowed) of a batch of texts: a release's first token and, in a row without one, that it has an allowed phrase."""
    entry = {}
    for how, some in tokens.items():
        texts = batch.column(PLACES[how]).dictionary_encode()
        entry[how] = some.first(texts.dictionary.to_pylist(), how == PHRASE)[texts.indices.to_numpy()]
    best, least = np.full(batch.num_rows, -1), np.zeros(batch.num_rows, dtype=np.int64)
    for how in (RAW, PHRASE, GLUED):
        if how in entry:
            first = tokens[how].ords[np.maximum(entry[how], 0)]
            better = (entry[how] >= 0) & ((best < 0) | (first < least))
            best[better], least[better] = how, first[better]
    for how in entry:
        rows = np.flatnonzero(entry[how] >= 0 if how == ALLOW else best == how)
        told = tokens[how].entries.take(pa.array(entry[how][rows])).combine_chunks()
        columns = [told[c].combine_chunks() for c in ("ord", "kind", "token")]
        order, kind, token = (pa.nulls(len(rows), c.type) for c in columns) if how == ALLOW else columns
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), order.cast(pa.int64()), pa.array(np.full(len(rows), how, dtype=np.int32)), kind.cast(pa.string()), token.cast(pa.string()), pa.array(np.full(len(rows), how == ALLOW))], names=["id", "ord", "how", "kind", "token", "allowed"])


def blocked_by(releases: DataFrame, lexicon: DataFrame, *, id_col: str = "id") -> DataFrame:
    """(id, kind, token, how) of each release that a token of ``lexicon`` (from :func:`lexicon_of`) blocks: the first in order of ord, then of how.

    The rules of :func:`functions.lexicon.blocked`: raw tokens as substrings of title, group and tracker; others at word boundaries of all names, or as
    substrings of the glued group and tracker; a release whose effective title has an allowed phrase anywhere isn't blocked.  how: "raw", "phrase" or "glued".  Ids are the table's
    key: unique, not null.  An empty table or lexicon blocks nothing.
    """
    texts = releases.select(
        F.col(id_col).alias("id"), F.lower(_joined("title", "release_group", "source_tracker")).alias("raw"), F.concat(F.lit(" "), norm(_joined("title", "title_text", "release_group", "source_tracker")), F.lit(" ")).alias("every"),
        F.replace(norm(_joined("release_group", "source_tracker")), F.lit(" "), F.lit("")).alias("glued"), norm(effective_title(F.col("title"), F.col("title_text"))).alias("name"),
    )
    schema = StructType([texts.schema["id"], StructField("ord", LongType()), StructField("how", IntegerType()), StructField("kind", StringType()), StructField("token", StringType()), StructField("allowed", BooleanType())])
    found = None
    # read once for each way of looking
    for part in _shipments(_wanted(settled(lexicon))):
        sent, key = releases.sparkSession.sparkContext.broadcast(part), uuid.uuid4().hex

        def scan(batches, sent=sent, key=key):
            for batch in batches:
                if key not in _parts:
                    _parts.clear()
                    _parts[key] = tokens_of(sent.value)
                yield from _found(batch, _parts[key])

        more = texts.mapInArrow(scan, schema)
        found = more if found is None else found.unionByName(more)
    found = found if found is not None else releases.sparkSession.createDataFrame([], schema)
    first = found.groupBy("id").agg(F.min(F.when(~F.col("allowed"), F.struct("ord", "how", "kind", "token"))).alias("f"), F.bool_or("allowed").alias("allowed")).where("not allowed")
    how = F.when(F.col("f.how") == RAW, "raw").when(F.col("f.how") == PHRASE, "phrase").otherwise("glued")
    return first.select(F.col("id").alias(id_col), "f.kind", "f.token", how.alias("how"))
