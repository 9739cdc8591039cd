"""Katz backoff scoring of whole texts.

P(w | u) = d(r) r / c(u) where the pair was seen r times in training, else a(u) P(w); P(w) = d(c) c / N for known words,
and the mass discounting leaves there is that of the one unknown word.  d are Good-Turing discounts (Katz 1987) for counts up to
``LOW``, from the corpus' smoothed counts of counts; a(u) = (1 - sum of seen P(w | u)) / (1 - sum of seen P(w)), so each context's
distribution sums to one exactly.

All texts count and are scored; nothing is sampled or cut.  To keep the shuffles small, texts become blocks of a few
megabytes with local word numbers.  A block sends each partition of a count table the sorted keys it knows of with its own counts, and gets
the totals back in the same order:

``blocks``    (block, ids, tokens, hashes, counts)      written once; later steps read no text
``unigrams``  by ranges of the 64-bit word hash         -> totals and word numbers, frequent words first
``bigrams``   by context                                -> pair totals and each context's sums for a(u)

A context with more than ``hot`` occurrences (at least an eighth of a partition; at most ``HOT_CONTEXTS`` of them) is spread over
several partitions by its following word; the partitions' sums for it, a few numbers each, are added on
the driver and broadcast. So no key's rows meet in one task.  Words are told apart by a
64-bit hash (XXH64): at ten billion words, two share one with a chance of about two to one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Text bytes of a block.
BLOCK_BYTES = 8 << 20
#: Keys that a partition of the count tables gets, on average.
PART_KEYS = 1 << 20
#: Most contexts that are spread; bounds what the driver adds and broadcasts to some ten MB.
HOT_CONTEXTS = 100_000
#: Counts up to this one are discounted, by a line fitted to the counts of counts up to the other.
LOW, FIT = 5, 40
#: The line's slope where there is but one point, and the flattest one that leaves a discount.
USUAL_SLOPE, FLATTEST = -2.0, -1.05
START, END = 0, 1  # hashes of the two marks


def squeeze(x: np.ndarray) -> bytes:
    """Integers or doubles as compressed byte planes."""
    import zstandard

    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize)
    return x.dtype.str.encode() + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unsqueeze(b: bytes) -> np.ndarray:
    import zstandard

    kind = np.dtype(b[:3].decode())
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[3:], max_output_size=1 << 31), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def small(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in four bytes where they fit."""
    return x.astype(np.uint32 if not len(x) or int(x.max()) < 1 << 32 else np.uint64)


def discounts(n: np.ndarray) -> np.ndarray:
    """d(0..LOW) from counts of counts n(1..FIT): Katz's, with Good-Turing's expected counts of counts smoothed as in Gale and Sampson's Simple Good-Turing.

    A count's share is spread over the gap around it, and a line through log shares and log counts gives the expected ones,
    n(r) ~ r**slope.  So discounts always are between 0 and 1, also where the counts of counts themselves rise or have gaps."""
    seen = np.flatnonzero(np.asarray(n)) + 1
    slope = USUAL_SLOPE
    if len(seen) > 1:
        before, after = np.concatenate([[0], seen[:-1]]), np.append(seen[1:], 2 * seen[-1] - seen[-2])
        x, y = np.log(seen), np.log(2 * np.asarray(n, dtype=float)[seen - 1] / (after - before))
        slope = min(FLATTEST, float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()))
    r = np.arange(1, LOW + 1)
    share = (LOW + 1.0) ** (slope + 1)
    return np.concatenate([[0.0], (((r + 1) / r) ** (slope + 1) - share) / (1 - share)])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts <= LOW, d[np.minimum(counts, LOW).astype(np.int64)], 1.0) * counts


class Unigrams:
    """P(w) from a word's count; count 0 is the unknown word."""

    def __init__(self, total: int, n: list[int]):
        self.total, self.d = max(1, total), discounts(np.array(n))
        left = sum(n[r - 1] * r * (1 - self.d[r]) for r in range(1, LOW + 1)) / self.total
        # where no count is discounted, one more token than seen makes room
        self.scale, self.unknown = (1.0, left) if left > 0 else (self.total / (self.total + 1), 1 / (self.total + 1))

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.scale * discounted(counts, self.d) / self.total, self.unknown)


def backoff(c: np.ndarray, low: np.ndarray, rest: np.ndarray, seen: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight a(u), scale of seen pairs) of contexts with count c: low[:, r-1] pairs seen r times, ``rest`` occurrences of pairs
    seen more often, ``seen`` the unigram mass of seen words."""
    mass = (low @ (d[1:] * np.arange(1, LOW + 1)) + rest) / np.maximum(c, 1)
    full = mass >= 1 - 1e-12  # nothing was discounted: one more occurrence than seen makes room
    scale = np.where(full, c / (c + 1.0), 1.0)
    left = np.where(full, 1 / (c + 1.0), 1 - mass)
    return left / np.maximum(1 - seen, 1e-300), scale


class Block:
    """Token arrays of a block: ``word`` and ``before`` are local numbers, ``doc`` the row, ``train`` its share."""

    def __init__(self, tokens: bytes, lens: bytes, train: bytes):
        n = unsqueeze(lens).astype(np.int64)
        words = unsqueeze(tokens).astype(np.int64)
        ends = np.cumsum(n + 1) - 1
        self.docs = len(n)
        self.word = np.empty(len(words) + len(n), dtype=np.int64)
        is_end = np.zeros(len(self.word), dtype=bool)
        is_end[ends] = True
        self.word[is_end] = END
        self.word[~is_end] = words
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[np.concatenate([[0], ends[:-1] + 1])] = START
        self.doc = np.repeat(np.arange(len(n)), n + 1)
        self.train = unsqueeze(train).astype(bool)

    def pairs(self, gid: np.ndarray, count: np.ndarray, parts: int, hot: int) -> tuple[np.ndarray, ...]:
        """Pairs with a known context, in the order (part, context, word): their local numbers, parts, training counts; and each token's place among them (-1: none).

        Pairs with an unknown word are asked for too: their context's sums are needed."""
        known = count[self.before] > 0
        key = self.before[known] * len(gid) + self.word[known]
        uniq, inverse = np.unique(key, return_inverse=True)
        u, w = uniq // len(gid), uniq % len(gid)
        n = np.bincount(inverse, weights=self.train[self.doc[known]], minlength=len(uniq)).astype(np.int64)
        with np.errstate(over="ignore"):
            salt = ((gid[w] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % (1 + count[u] // hot).astype(np.uint64)
            spread = gid[u] + np.where(count[u] > hot, salt, 0).astype(np.uint64)
        part = (spread % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((gid[w], gid[u], part))
        place = np.empty(len(uniq), dtype=np.int64)
        place[order] = np.arange(len(uniq))
        at = np.full(len(self.word), -1, dtype=np.int64)
        at[known] = place[inverse]
        return u[order], w[order], part[order], n[order], at


def _bounds(sorted_parts: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of each run."""
    if not len(sorted_parts):
        return []
    edge = np.concatenate([[0], np.flatnonzero(np.diff(sorted_parts)) + 1, [len(sorted_parts)]]).tolist()
    return [(int(sorted_parts[a]), a, b) for a, b in zip(edge, edge[1:], strict=False)]


def _blocks(docs: DataFrame, id_col: str, text_col: str, fold: int) -> DataFrame:
    import xxhash

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    kind = given.schema["id"].dataType.simpleString()

    def make(batches):
        where, nth = TaskContext.get().partitionId(), 0
        ids, lens, train, local, numbers, size = [], [], [], [], {}, 0
        id_type = None

        def block():
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
            hashes = np.concatenate([np.array([START, END], dtype=np.uint64), hashes])
            order = np.argsort(hashes, kind="stable")
            to = np.empty(len(order), dtype=np.int64)
            to[order] = np.arange(len(order))
            n, held = np.array(lens, dtype=np.int64), np.array(train, dtype=bool)
            words = to[np.concatenate([*local, np.zeros(0, dtype=np.int64)]).astype(np.int64) + 2]
            counts = np.bincount(words, weights=np.repeat(held, n), minlength=len(order)).astype(np.int64)
            counts[START] = counts[END] = int(held.sum())
            return pa.RecordBatch.from_arrays([pa.array([where << 32 | nth]), pa.array([ids], pa.list_(id_type)), pa.array([squeeze(small(n))]), pa.array([squeeze(held.astype(np.uint8))]), pa.array([squeeze(small(words))]), pa.array([squeeze(hashes[order])]), pa.array([squeeze(small(counts))]), pa.array([int(n.sum() + len(n))]), pa.array([len(order)])], names=["block", "ids", "lens", "train", "tokens", "hashes", "counts", "n_tokens", "n_words"])

        for batch in batches:
            id_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").lower().split()
                ids.append(key)
                lens.append(len(words))
                train.append(zlib.crc32(("" if key is None else str(key)).encode()) % fold != 0)
                local.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)))
                size += len(text or b"") + 64
                if size >= BLOCK_BYTES:
                    yield block()
                    nth += 1
                    ids, lens, train, local, numbers, size = [], [], [], [], {}, 0
        if ids:
            yield block()

    return given.mapInArrow(make, f"block long, ids array<{kind}>, lens binary, train binary, tokens binary, hashes binary, counts binary, n_tokens long, n_words long")


def _ask_words(parts: int):
    def ask(batches):
        for batch in batches:
            out = {"part": [], "block": [], "a": [], "b": []}
            for r in batch.to_pylist():
                hashes, counts = unsqueeze(r["hashes"]), unsqueeze(r["counts"])
                part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                for p, i, j in _bounds(part):
                    out["part"].append(p)
                    out["block"].append(r["block"])
                    out["a"].append(hashes[i:j].tobytes())
                    out["b"].append(squeeze(counts[i:j]))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("part", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]))

    return ask


_ANSWER = "block long, part long, a binary, b binary, n array<long>"


def _count_words(parts: int):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [np.frombuffer(x, dtype=np.uint64) for x in pdf["a"]]
        uniq, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([unsqueeze(x) for x in pdf["b"]])).astype(np.int64)
        rank = np.empty(len(uniq), dtype=np.uint64)
        rank[np.lexsort((uniq, -totals))] = np.arange(len(uniq), dtype=np.uint64)
        part = int(pdf["part"].iloc[0])
        gid = rank * np.uint64(parts) + np.uint64(part)
        word = totals[uniq != START]
        ends = np.cumsum([len(x) for x in asked])[:-1]
        rows = [(b, part, squeeze(small(gid[i])), squeeze(small(totals[i])), None) for b, i in zip(pdf["block"], np.split(inverse, ends), strict=True)]
        rows.append((-1, part, None, None, [int(word.sum()), int((word > 0).sum()), *np.bincount(word[word <= FIT], minlength=FIT + 1)[1:].tolist()]))
        return pd.DataFrame(rows, columns=["block", "part", "a", "b", "n"])

    return count


def _join(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and counts of a block's words, from the parts' answers."""
    answers = answers.sort_values("part")
    gid, count = (np.concatenate([unsqueeze(x) for x in answers[c]]) for c in ("a", "b"))
    return gid.astype(np.uint64), count.astype(np.int64)


def _ask_pairs(parts: int, hot: int):
    def ask(_, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in blocks.itertuples():
            gid, count = _join(answers)
            u, w, part, n, _at = Block(r.tokens, r.lens, r.train).pairs(gid, count, parts, hot)
            for p, i, j in _bounds(part):
                runs = _bounds_of(u[i:j])
                first = gid[w[i:j]]
                step = np.diff(first, prepend=np.uint64(0))
                step[runs] = first[runs]
                ctx = gid[u[i:j][runs]]
                rows.append((p, r.block, squeeze(small(np.diff(ctx, prepend=np.uint64(0)))), squeeze(small(np.diff(np.append(runs, j - i)))), squeeze(small(step)), squeeze(small(n[i:j])), squeeze(small(count[w[i:j]])), squeeze((count[u[i:j][runs]] > hot).astype(np.uint8))))
        return pd.DataFrame(rows, columns=["part", "block", "ctx", "follow", "word", "n", "cw", "hot"])

    return ask


def _bounds_of(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1]).astype(np.int64)


def _sums(low: np.ndarray, mass: np.ndarray) -> bytes:
    """Contexts' count sums and unigram masses as one value."""
    ints = squeeze(small(low))
    return len(ints).to_bytes(8, "little") + ints + squeeze(mass)


def _unsums(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 8 + int.from_bytes(b[:8], "little")
    return unsqueeze(b[8:n]).astype(np.int64).reshape(LOW + 1, -1).T, unsqueeze(b[n:])


def _count_pairs(unigrams: Unigrams):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        us, ws, lens, runs = [], [], [], []
        for r in pdf.itertuples():
            ctx, follow = np.cumsum(unsqueeze(r.ctx).astype(np.uint64)), unsqueeze(r.follow).astype(np.int64)
            step = unsqueeze(r.word).astype(np.uint64)
            begin = np.cumsum(follow) - follow
            summed = np.cumsum(step)
            us.append(np.repeat(ctx, follow))
            ws.append(summed - np.repeat(summed[begin] - step[begin], follow))
            lens.append(len(step))
            runs.append(begin)
        u, ui = np.unique(np.concatenate(us), return_inverse=True)
        _, wi = np.unique(np.concatenate(ws), return_inverse=True)
        pair, first, inverse = np.unique(ui.astype(np.int64) << 32 | wi, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unsqueeze(x) for x in pdf["n"]])).astype(np.int64)
        p = unigrams.p(np.concatenate([unsqueeze(x) for x in pdf["cw"]]).astype(np.int64)[first])
        of = pair >> 32
        add = lambda x: np.bincount(of, weights=x, minlength=len(u))
        sums = [add(total == r).astype(np.int64) for r in range(1, LOW + 1)] + [add(np.where(total > LOW, total, 0)).astype(np.int64)]
        mass = add(np.where(total > 0, p, 0.0))
        rows, at = [], 0
        part = int(pdf["part"].iloc[0])
        hot = np.zeros(len(u), dtype=bool)
        for k, begin, flags in zip(lens, runs, pdf["hot"], strict=True):
            hot[ui[at : at + k][begin]] |= unsqueeze(flags).astype(bool)
            at += k
        if hot.any():
            rows.append((-2, part, squeeze(u[hot]), _sums(np.stack([x[hot] for x in sums]).reshape(-1), mass[hot]), None))
        at = 0
        for block, k, begin in zip(pdf["block"], lens, runs, strict=True):
            c = ui[at : at + k][begin]
            low = np.stack([x[c] for x in sums]).reshape(-1)
            rows.append((block, part, squeeze(small(total[inverse[at : at + k]])), _sums(low, mass[c]), None))
            at += k
        rows.append((-1, part, None, None, np.bincount(total[total <= FIT], minlength=FIT + 1)[1:].tolist()))
        return pd.DataFrame(rows, columns=["block", "part", "a", "b", "n"])

    return count


def _add_hot(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context numbers ascending, their count sums, their unigram masses) over the partitions' partial sums."""
    if not rows:
        return np.zeros(0, dtype=np.uint64), np.zeros((0, LOW + 1)), np.zeros(0)
    rows = sorted(rows, key=lambda r: r["part"])
    ctx, low, mass = [unsqueeze(bytes(r["a"])) for r in rows], [], []
    for r in rows:
        ints, doubles = _unsums(bytes(r["b"]))
        low.append(ints)
        mass.append(doubles)
    uniq, of = np.unique(np.concatenate(ctx), return_inverse=True)
    sums, masses = np.zeros((len(uniq), LOW + 1)), np.zeros(len(uniq))
    np.add.at(sums, of, np.concatenate(low))
    np.add.at(masses, of, np.concatenate(mass))
    return uniq, sums, masses


def _score(parts: int, hot: int, unigrams: Unigrams, v: int, d: np.ndarray, spread):
    total = unigrams.total

    def score(_, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for r in blocks.itertuples():
            gid, count = _join(answers[answers["table"] == "u"])
            block = Block(r.tokens, r.lens, r.train)
            u, w, part, _, at = block.pairs(gid, count, parts, hot)
            seen, low, mass = np.zeros(len(u), dtype=np.int64), np.zeros((len(gid), LOW + 1)), np.zeros(len(gid))
            got = {a.part: a for a in answers[answers["table"] == "b"].itertuples()}
            for p, i, j in _bounds(part):
                seen[i:j] = unsqueeze(got[p].a)
                ctx = u[i:j][_bounds_of(u[i:j])]
                low[ctx], mass[ctx] = _unsums(got[p].b)
            wide, wide_low, wide_mass = spread.value
            if len(wide):
                place = np.minimum(np.searchsorted(wide, gid), len(wide) - 1)
                mine = wide[place] == gid
                low[mine], mass[mine] = wide_low[place[mine]], wide_mass[place[mine]]
            weight, scale = backoff(count.astype(float), low[:, :LOW], low[:, LOW], mass, d)
            c = count[block.word]
            p_word, before = unigrams.p(c), block.before
            n = np.where(at >= 0, seen[np.maximum(at, 0)] if len(seen) else 0, 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(count[before] == 0, p_word, np.where(n > 0, scale[before] * discounted(n, d) / np.maximum(count[before], 1), weight[before] * p_word))
            base = np.log10((c + 0.1) / (total + 0.1 * (v + 1)))
            add = lambda x: np.bincount(block.doc, weights=x, minlength=block.docs)
            frames.append(pd.DataFrame({"id": r.ids, "held_out": ~block.train, "n_tokens": add(np.ones(len(c))).astype(np.int64), "n_known": add(c > 0).astype(np.int64), "train_tokens": total, "base_score": add(base), "score": add(np.log10(p))}))
        return pd.concat(frames) if frames else pd.DataFrame({"id": [], "held_out": [], "n_tokens": [], "n_known": [], "train_tokens": [], "base_score": [], "score": []})

    return score


def katz_scores(docs: DataFrame, *, fold: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learns from rows whose crc32 of the id's text isn't 0 modulo ``fold``.  Tokens: words between ASCII white space with A-Z lower-cased,
    then one end.  base_score: add-0.1 unigram log10 probability; score: the Katz model's.  A null or empty text has
    the end alone; a null id's text is empty, so it is held out.  Repeated rows each count and each give a row.  Other columns are ignored.
    An empty table gives an empty one; with no training rows every word is the unknown one.
    """
    blocks = written(_blocks(docs, id_col, text_col, fold), "katz-blocks")
    sizes = blocks.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    parts = max(1, (sizes[1] or 0) // PART_KEYS)
    asked = blocks.select("block", "hashes", "counts").mapInArrow(_ask_words(parts), "part long, block long, a binary, b binary")
    words = written(asked.groupBy("part").applyInPandas(_count_words(parts), _ANSWER), "katz-unigrams")
    stats = lambda table, n: [int(x or 0) for x in table.where("block = -1").agg(*(F.sum(F.col("n")[i]) for i in range(n))).first()]
    total, v, *counts = stats(words, FIT + 2)
    unigrams = Unigrams(total, counts)

    parts = max(1, (sizes[0] or 0) // PART_KEYS)
    hot = max(1, PART_KEYS // 8, (sizes[0] or 0) // HOT_CONTEXTS)
    own = blocks.select("block", "ids", "lens", "train", "tokens")
    told = words.where("block >= 0").select("block", "part", "a", "b", F.lit("u").alias("table"))
    asked = own.drop("ids").groupBy("block").cogroup(told.groupBy("block")).applyInPandas(_ask_pairs(parts, hot), "part long, block long, ctx binary, follow binary, word binary, n binary, cw binary, hot binary")
    pairs = written(asked.groupBy("part").applyInPandas(_count_pairs(unigrams), _ANSWER), "katz-bigrams")
    d = discounts(np.array(stats(pairs, FIT)))
    # at most two rows for each spread context and a few for each part: see HOT_CONTEXTS
    spread = docs.sparkSession.sparkContext.broadcast(_add_hot(pairs.where("block = -2").select("part", "a", "b").collect()))

    told = told.unionByName(pairs.where("block >= 0").select("block", "part", "a", "b", F.lit("b").alias("table")))
    kind = docs.schema[id_col].dataType.simpleString()
    found = own.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(_score(parts, hot, unigrams, v, d, spread), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return found.withColumnRenamed("id", id_col)
