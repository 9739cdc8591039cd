"""SimHash near-duplicate linking by anchor-point covering.

Anchors are the words of a covering code: on bits 0-22 and 23-45 of a fingerprint the perfect
binary Golay code (23, 12), whose words cover every point within three bits; bits 46-63 are free.
For a threshold of t bits, a fingerprint is replicated to the anchors nearest to any point within
ceil(t/2) flips, which lie within covering radius plus threshold.  Two fingerprints
that differ in t bits have a point halfway, so they meet at its anchor: no link is lost.  For t = 2
that is about 11 replicas with 24-bit anchors.

Fingerprints are compared within an anchor.  Where an anchor holds more than ``CROWD`` different ones (a large
group of near copies), its members are replicated instead to the anchors of the code that consists of all 64-bit
words (covering radius 0): those within ceil(t/2) flips.  An anchor of this code has 65 members at most for t = 2, all
linked for even t, whatever the data.  So no step makes all pairs of a group, and nothing is capped.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import are_few, checkpoint, few, forget, gathered, joined_by, written
from .components import components

#: Different fingerprints that are compared with each other at an anchor.
CROWD = 64
#: Fixed values of the Golay code: length, check bits and generator x^11+x^10+x^6+x^5+x^4+x^2+1.
BLOCK, CHECKS, GENERATOR = 23, 11, 0b110001110101


def _syndrome_of_bit(i: int) -> int:
    x = 1 << i
    for j in range(BLOCK - 1, CHECKS - 1, -1):
        if x >> j & 1:
            x ^= GENERATOR << (j - CHECKS)
    return x


class Golay:
    """Nearest words of the perfect Golay code."""

    def __init__(self):
        one = [_syndrome_of_bit(i) for i in range(BLOCK)]
        self.leaders = np.zeros(1 << CHECKS, dtype=np.uint64)
        for k in (1, 2, 3):
            for bits in combinations(range(BLOCK), k):
                s = 0
                for i in bits:
                    s ^= one[i]
                self.leaders[s] = sum(1 << i for i in bits)
        self.tables = []
        for base in range(0, BLOCK, 8):
            table = np.zeros(256, dtype=np.int64)
            for v in range(256):
                for i in range(8):
                    if v >> i & 1 and base + i < BLOCK:
                        table[v] ^= one[base + i]
            self.tables.append(table)

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """The message bits (12) of the code word nearest to each 23-bit point."""
        x = points.astype(np.int64)
        s = self.tables[0][x & 255] ^ self.tables[1][x >> 8 & 255] ^ self.tables[2][x >> 16]
        return (points ^ self.leaders[s]) >> np.uint64(CHECKS)


def flips(bits: int, most: int) -> np.ndarray:
    """Words of at most ``most`` set bits among the lowest ``bits``."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], dtype=np.uint64)


def code_anchors(golay: Golay, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) of each replica."""
    near = prints[:, None] ^ flips(2 * BLOCK, reach)[None, :]
    mask = np.uint64((1 << BLOCK) - 1)
    anchors = golay.nearest((near & mask).ravel()) << np.uint64(12) | golay.nearest((near >> np.uint64(BLOCK) & mask).ravel())
    anchors = np.sort(anchors.reshape(near.shape), axis=1)
    fresh = np.ones(near.shape, dtype=bool)
    fresh[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
    return np.nonzero(fresh)[0], anchors[fresh]


def roots(prints: np.ndarray, most: int) -> np.ndarray:
    """For the fingerprints of one anchor: the least one that each reaches by links within it."""
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= most
    label = np.arange(len(prints))
    while True:
        least = np.where(apart, label[None, :], len(prints)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return prints[label]
        label = least


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 (seed 42) of the space-joined shingles, repeats included; fewer words than ``width``: of all of them; none: nothing."""
    import xxhash

    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(starts))


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print long): the SimHash of each row's shingles of ``words`` words, A-Z lower-cased, split at ASCII white space.

    A null or wordless text has print 0.
    """

    def make(batches):
        for batch in batches:
            found = [majority(shingle_hashes((t or b"").lower().split(), words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["id", "print"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    return given.mapInArrow(make, f"id {given.schema['id'].dataType.simpleString()}, print long")


def fingerprint_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) links between different fingerprints of ``prints`` (print long, no repeats), enough to connect all that are
    reachable by steps of at most ``max_bits`` differing bits; every link given is such a step or a chain of them."""
    reach = -(-max_bits // 2)

    def replicate(batches):
        forget()
        golay = Golay()
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(x), 2048):
                who, anchors = code_anchors(golay, x[at : at + 2048], reach)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.astype(np.int64)), pa.array(x[at : at + 2048][who].view(np.int64))], names=["anchor", "print"])

    def compare(batches):
        forget()
        for batch in batches:
            a, b = [], []
            for members in batch.column(0).to_pylist():
                x = np.sort(np.array(members, dtype=np.int64)).view(np.uint64)
                root = roots(x, max_bits)
                a.append(x[root != x])
                b.append(root[root != x])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*y, np.zeros(0, dtype=np.uint64)]).view(np.int64)) for y in (a, b)], names=["a", "b"])

    replicas = prints.select("print").mapInArrow(replicate, "anchor long, print long")
    held = replicas.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = replicas.join(held, "anchor")
    close = shared.where(F.col("n") <= CROWD).groupBy("anchor").agg(F.collect_list("print").alias("members")).select("members")
    crowded = shared.where(F.col("n") > CROWD).select("print").distinct()
    around = [F.col("print").bitwiseXOR(F.lit(int(x))) for x in flips(64, reach).view(np.int64).tolist()]
    dense = crowded.select("print", F.explode(F.array(*around)).alias("anchor"))
    packed = dense.groupBy("anchor").agg(F.collect_list("print").alias("members")).where(F.size("members") > 1).select("members")
    return close.unionByName(packed).mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, *, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of each row of ``docs``.

    fingerprint: 16 lowercase hex digits.  component_id: the least id of the rows whose fingerprints are reachable
    by links of at most ``max_bits`` bits, itself included; null where all of them have null ids.  Rows without words
    have fingerprint zero, which links like any other.  Repeated rows each give a row.  Other columns
    are ignored.  An empty table gives an empty one.
    """
    rows = checkpoint(fingerprints(docs, words=words, id_col=id_col, text_col=text_col))
    firsts = checkpoint(rows.groupBy("print").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")))
    reached = components(fingerprint_links(firsts, max_bits)).withColumnRenamed("node", "print")
    linked = firsts.join(reached, "print")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    known = linked.join(least, "root").select("print", "least_id")
    classes = checkpoint(firsts.join(known, "print", "left").select("print", F.coalesce("least_id", "first_id").alias("component_id"), "n_rows"))
    found = joined_by(rows, classes, "print")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


# Near copies by similarity -----------------------------------------------------------------------------------------

#: Documents whose shingles are counted to tell common ones, at least, and one of how many, at most; documents of a common one among them, and common ones known at most.
#: These only set the order that shingles are taken in; pairs are the same for any order.
COUNTED, EVERY, COMMON, MOST_COMMON = 10_000, 100, 3, 200_000
#: Rows of a crowded shingle that are compared in one block.
BLOCK_ROWS = 4096
#: Rounds in which rows outside a crowded shingle's largest group are compared with so many of the other groups' nearest rows, before all of them.
NEAREST_ROUNDS, NEAREST = 4, 32
#: Shingles of texts that a task of the verification remembers at most.
MOST_HELD = 2_000_000
#: Bits of a text's sketch, a power of two; more of them tell longer texts apart.
SKETCH = 1024


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets, given as sorted arrays; 1 for two empty ones."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def sketch(shingles: np.ndarray) -> bytes:
    """SKETCH bits, each the parity of how many of the different ``shingles`` fall on it: two sets have at least as many shingles apart as their sketches have bits."""
    return np.packbits(np.bincount((shingles & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1).tobytes()


def may_reach(x: list[bytes], y: list[bytes], n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles with sketches ``x`` and ``y`` can reach the similarity; True for all that do."""
    return _near_enough(_words(x), _words(y), n, m, similarity)


def _words(sketches) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(sketches), dtype=np.uint64).reshape(-1, SKETCH // 64)


def _near_enough(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """:func:`may_reach` of sketches as :func:`_words` gives them."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= (n.astype(np.int64) + m) * (1 - similarity) / (1 + similarity) + 1e-6


def prefix(shingles: np.ndarray, common: np.ndarray, weight: np.ndarray, similarity: float) -> np.ndarray:
    """Those of the different ``shingles`` that two sets alike enough can't both be without: the first ones, rare before common."""
    n = len(shingles)
    heavy = np.zeros(n, dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        heavy = np.where(common[at] == shingles, weight[at], 0)
    return shingles[np.lexsort((shingles, heavy))][: n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0]


def _may_be_alike(n, pos, m, qos, similarity):
    """Whether sets of ``n`` and ``m`` shingles whose first common one is at ``pos`` and ``qos`` can reach the similarity."""
    return np.minimum(n - pos, m - qos) * (1 + similarity) + 1e-6 >= similarity * (n + m)


def _greatest_partner(n, pos, similarity):
    """How many shingles another set may have at most, if its first one in common with a set of ``n`` is that set's at ``pos`` and both are alike enough.

    Two sets can be alike by :func:`_may_be_alike` where neither is greater than the other's greatest partner."""
    return (n - pos * (1 + similarity) + 2e-6) / similarity


def _whole_groups(batches, keys: int = 1):
    """Columns of sorted batches as arrays, cut only between different values of the first ``keys`` ones."""
    held = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        new = _starts(columns[:keys])
        cut = int(new[-1])
        if cut or (held and any(held[-1][i][-1] != columns[i][0] for i in range(keys))):
            held.append([c[:cut] for c in columns])
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        held.append([c[cut:] for c in columns])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where the runs of equal keys begin."""
    changed = np.zeros(len(keys[0]), dtype=bool)
    changed[:1] = True
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(changed)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def medoid(prints: np.ndarray) -> int:
    """The place of the fingerprint nearest to the majority of all: of edited copies, most likely their original."""
    return int(np.bitwise_count(prints ^ np.uint64(majority(prints))).argmin())


_MEETINGS = "a long, b long, token long, n int, pos int"


def _meetings(similarity: float):
    """Of (token, id, n, pos) sorted by token: pairs (a, b) that may be alike of tokens with at most CROWD rows; the rows of other tokens as they came, as a.

    A token's rows are held until there are more than CROWD of them, and then pass through."""

    def pairs_of(token, ids, n, pos):
        starts = _starts([token])
        sizes = np.diff(np.append(starts, len(token)))
        found = []
        for k in np.unique(sizes[sizes > 1]).tolist():
            i, j = np.triu_indices(k, 1)
            firsts, step = starts[sizes == k], max(1, 200_000 // len(i))
            for at in range(0, len(firsts), step):
                x, y = ((firsts[at : at + step, None] + s[None, :]).ravel() for s in (i, j))
                ok = _may_be_alike(n[x], pos[x], n[y], pos[y], similarity)
                found.append(_pairs(ids[x[ok]], ids[y[ok]]))
        for p in found:
            none = [pa.nulls(p.num_rows, kind) for kind in (pa.int64(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*p.columns, *none], names=["a", "b", "token", "n", "pos"])

    def meet(batches):
        forget()
        held, crowd = None, None
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if not len(now[0]):
                continue
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            starts = _starts(now[:1])
            sizes = np.diff(np.append(starts, len(now[0])))
            crowded = np.repeat((sizes > CROWD) | (now[0][starts] == crowd), sizes)
            if crowded.any():
                token, ids, n, pos = (c[crowded] for c in now)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(token), pa.array(n), pa.array(pos)], names=["a", "b", "token", "n", "pos"])
            crowd = now[0][-1] if crowded[-1] else None
            # the last token may go on in the next batch
            last = np.arange(len(now[0])) >= starts[-1]
            yield from pairs_of(*(c[~crowded & ~last] for c in now))
            held = None if crowded[-1] else [c[last] for c in now]
        if held is not None:
            yield from pairs_of(*held)

    return meet


def _star_meetings(similarity: float):
    """Of (token, part, id, n, print, root, sketch) sorted by token and part: rows outside the part's largest root, or all of them, with the most typical one among them, where sketches may be alike."""

    def meet(batches):
        forget()
        for token, part, ids, n, prints, root, sketches in _whole_groups(batches, 2):
            starts = _starts([token, part]).tolist()
            for low, high in zip(starts, [*starts[1:], len(token)], strict=True):
                _, which, counts = np.unique(root[low:high], return_inverse=True, return_counts=True)
                if len(counts) == 1:
                    continue
                among = low + np.flatnonzero(which != counts.argmax()) if counts.max() > 1 else np.arange(low, high)
                r = among[medoid(prints[among].view(np.uint64))]
                ok = low + np.flatnonzero((root[low:high] != root[r]) & _may_be_alike(n[low:high], 0, n[r], 0, similarity))
                ok = ok[_near_enough(_words(sketches[ok]), _words(sketches[r : r + 1]), n[ok], n[r], similarity)]
                yield _pairs(ids[ok], np.full(len(ok), ids[r]))

    return meet


def _block_meetings(similarity: float, nearest: int | None):
    """Of (token, part, slice, outside, id, n, pos, print, root, sketch) sorted by the first four: each row outside the token's largest root with each other one that may be alike, of different roots;
    with the NEAREST ones by SimHash, after ``nearest`` times as many, unless that is None.  A pair of nulls tells that some row had more of them.  Without the column of sketches none is left out by them."""

    def meet(batches):
        forget()
        for token, part, piece, outside, ids, n, pos, prints, root, *sketches in _whole_groups(batches, 3):
            starts = _starts([token, part, piece]).tolist()
            prints, words, more = prints.view(np.uint64), _words(sketches[0]) if sketches else None, False
            for low, high in zip(starts, [*starts[1:], len(token)], strict=True):
                middle = low + int(np.searchsorted(outside[low:high], 1))
                # by size: the sizes that can be alike are one stretch, often an empty one
                own = low + np.argsort(n[low:middle], kind="stable")
                sizes, most = n[own], _greatest_partner(n[own], pos[own], similarity)
                mine = _greatest_partner(n[middle:high], pos[middle:high], similarity)
                begin = np.searchsorted(sizes, similarity * n[middle:high] - 1e-6)
                end = np.searchsorted(sizes, mine, side="right")
                for u in (middle + np.flatnonzero(begin < end)).tolist():
                    b, e = begin[u - middle], end[u - middle]
                    ok = own[b:e][(most[b:e] >= n[u]) & (root[own[b:e]] != root[u])]
                    ok = ok if words is None else ok[_near_enough(words[ok], words[u], n[ok], n[u], similarity)]
                    if nearest is not None:
                        more = more or len(ok) > (nearest + 1) * NEAREST
                        ok = ok[np.argsort(np.bitwise_count(prints[ok] ^ prints[u]), kind="stable")[nearest * NEAREST : (nearest + 1) * NEAREST]]
                    if len(ok):
                        yield _pairs(ids[ok], np.full(len(ok), ids[u]))
            if more:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 2, names=["a", "b"])

    return meet


def near_copies(docs: DataFrame, *, words: int = 5, similarity: float = 0.8, max_bits: int = 2, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, first_id) of those rows that are near copies of a row with a lesser id: first_id is the least id of the row's group.

    A group is connected by links of rows whose sets of ``words``-word shingles have a Jaccard similarity of at least ``similarity``;
    texts with the same words are always linked.  Candidates are texts whose SimHash fingerprints meet at an anchor within ``max_bits``
    bits and, since alike texts may differ in more bits than any covering can afford, all that share one of their first shingles in a common order:
    sets alike enough do, so no link is lost.  Each candidate is verified on the whole texts.  A shingle that over CROWD rows share is
    resolved by steps, as many as it takes, in blocks of some BLOCK_ROWS: its rows are compared with the one whose SimHash is nearest to the majority of theirs (first for each
    row's first crowded shingle, then for all), then each row that isn't linked to the shingle's largest group with the nearest ones of other groups, in rounds, and at last with every row of them.
    ``id_col`` holds different bigints without nulls.  Null, empty and wordless texts are alike.  Other columns are ignored.  An empty table gives an empty one.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))

    def count(batches):
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = [np.unique(shingle_hashes((t or b"").lower().split(), words)) for t in batch.column(0).slice(at, 500).to_pylist()]
                tokens, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    every = min(-(-given.count() // COUNTED), EVERY) or 1
    counted = given.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("t").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    known = counted.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "token").limit(MOST_COMMON).toArrow()
    common, weight = known.column(0).to_numpy().view(np.uint64), known.column(1).to_numpy()
    order = common.argsort()
    common, weight = common[order], weight[order]

    def make(batches):
        import xxhash

        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for t in part.column(1).to_pylist():
                    w = (t or b"").lower().split()
                    h = shingle_hashes(w, words)
                    shingles = np.unique(h)
                    rows.append((xxhash.xxh3_128_digest(b" ".join(w)), np.uint64(majority(h)).view(np.int64), len(shingles), sketch(shingles), prefix(shingles, common, weight, similarity).view(np.int64)))
                same, prints, n, sketches, tokens = zip(*rows, strict=True)
                ends = np.cumsum([0, *map(len, tokens)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(same, pa.binary()), pa.array(prints, pa.int64()), pa.array(n, pa.int32()), pa.array(sketches, pa.binary()), lists], names=["id", "same", "print", "n", "sketch", "tokens"])

    rows = written(given.mapInArrow(make, "id long, same binary, print long, n int, sketch binary, tokens array<long>"), "prefixes")
    reps = checkpoint(rows.groupBy("same").agg(F.min("id").alias("id"), F.count("*").alias("n_rows")))
    first = rows.join(reps.select("id"), "id", "left_semi")
    tokens = first.select("id", "n", F.posexplode("tokens").alias("pos", "token")).select("token", "id", "n", "pos")
    met = written(tokens.repartition("token").sortWithinPartitions("token").mapInArrow(_meetings(similarity), _MEETINGS), "meetings")
    crowds = met.where("b is null").select("token", F.col("a").alias("id"), "n", "pos")
    # a row whose greatest partner is less than every row of the shingle meets none there
    fewest = few(checkpoint(crowds.groupBy("token").agg(F.min("n").alias("fewest"))))
    crowds = checkpoint(crowds.join(fewest, "token").where(_greatest_partner(F.col("n"), F.col("pos"), similarity) >= F.col("fewest")).drop("fewest"))

    firsts = checkpoint(first.select("id", "n", "print", "sketch"))
    # SimHash: texts of one fingerprint with the first of them, and those first ones where fingerprints meet at an anchor
    heads = checkpoint(firsts.groupBy("print").agg(F.min("id").alias("head")))
    same_print = firsts.join(heads, "print").where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    met_prints = fingerprint_links(heads.select("print"), max_bits)
    at_anchors = met_prints.join(heads.select(F.col("print").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("print").alias("b"), F.col("head").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def prune(batches):
        forget()
        for batch in batches:
            x, y, n, m = (batch.column(i) for i in (2, 3, 4, 5))
            keep = pa.array(may_reach(x.to_pylist(), y.to_pylist(), n.to_numpy(), m.to_numpy(), similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    def pruned(links):
        """Those of the links whose sketches may be alike: only their texts are shuffled."""
        end = lambda id_, x, n: firsts.select(F.col("id").alias(id_), F.col("sketch").alias(x), F.col("n").alias(n))
        both = links.join(end("a", "x", "n"), "a").join(end("b", "y", "m"), "b")
        return checkpoint(both.select("a", "b", "x", "y", "n", "m").mapInArrow(prune, "a long, b long"))

    pairs = gathered(pruned(met.where("b is not null").select("a", "b").unionByName(same_print).unionByName(at_anchors).distinct()))
    crowds = gathered(crowds)
    met_crowds = gathered(checkpoint(crowds.select("id").distinct()))
    seen = gathered(checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(met_crowds).distinct()))
    texts = written(given.join(few(seen), "id", "left_semi"), "candidates")

    def verify(batches):
        forget()
        known, held = {}, 0

        def shingles(t):
            nonlocal held
            if (found := known.get(t)) is None:
                found = np.unique(shingle_hashes((t or b"").lower().split(), words))
                held += len(found)
                if held > MOST_HELD:
                    known.clear()
                    held = len(found)
                known[t] = found
            return found

        for batch in batches:
            keep = [jaccard(shingles(x), shingles(y)) >= similarity for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in (batch.column(0), batch.column(1))], names=["a", "b"])

    def verified(links):
        # where they are many, the joins below leave out the others
        needed = gathered(checkpoint(links.select(F.explode(F.array("a", "b")).alias("id")).distinct()))
        own = texts.join(F.broadcast(needed), "id", "left_semi") if are_few(needed) else texts
        both = few(links).join(own.select(F.col("id").alias("a"), F.col("t").alias("x")), "a").join(own.select(F.col("id").alias("b"), F.col("t").alias("y")), "b")
        return gathered(checkpoint(both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")), links.count())

    roots_ = components(verified(pairs))
    steps = ("first", "all", *range(NEAREST_ROUNDS), "blocks") if not crowds.isEmpty() else ()
    # of crowds' rows alone, so that steps read no others
    marks = gathered(checkpoint(firsts.join(few(met_crowds), "id", "left_semi").select("id", "print", "sketch"))) if steps else None
    for step in steps:
        mine = crowds if step != "first" else crowds.groupBy("id").agg(F.min_by(F.struct("token", "n", "pos"), F.struct("pos", "token")).alias("x")).select("id", "x.*")
        placed = gathered(checkpoint(mine.join(roots_.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "n", "pos", F.coalesce("root", "id").alias("root"))))
        # of shingles whose rows aren't all linked: the largest root, all rows, and those outside it
        counted = placed.groupBy("token", "root").agg(F.count("*").alias("c")).groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("big"), F.sum("c").alias("rows"), (F.sum("c") - F.max("c")).alias("others")).where("others > 0")
        parts = lambda x: F.ceil(F.col(x) / BLOCK_ROWS).cast("long")
        part = lambda x: F.pmod(F.xxhash64("id"), F.col(x))
        unsettled = gathered(checkpoint(counted.select("token", "big", parts("rows").alias("parts"), parts("others").alias("slices"))))
        if unsettled.isEmpty():
            if step == "first":
                continue
            break
        left = placed.join(few(unsettled), "token").join(marks, "id")
        if step not in ("first", "all"):
            own = left.select("token", part("parts").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("outside"), "id", "n", "pos", "print", "root", "sketch")
            others = left.where("root <> big").select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), part("slices").alias("slice"), F.lit(1).alias("outside"), "id", "n", "pos", "print", "root", "sketch")
            key = ["token", "part", "slice"]
            links = own.unionByName(others).repartition(*key).sortWithinPartitions(*key, "outside").mapInArrow(_block_meetings(similarity, None if step == "blocks" else step), "a long, b long")
        else:
            key = ["token", "part"]
            stars = left.select("token", part("parts").alias("part"), "id", "n", "print", "root", "sketch")
            links = stars.repartition(*key).sortWithinPartitions(*key).mapInArrow(_star_meetings(similarity), "a long, b long")
        met_here = gathered(checkpoint(links))
        links = gathered(checkpoint(met_here.where("a is not null").distinct()))
        if not links.isEmpty():
            # what is linked already stands in its stars
            roots_ = components(gathered(verified(links).unionByName(roots_.select(F.col("root").alias("a"), F.col("node").alias("b")))))
        if step == 0 and met_here.where("a is null").isEmpty():
            # every row outside a largest group has met all that may be alike
            break
    classes = checkpoint(reps.select("same", F.col("id").alias("node"), "n_rows").join(roots_, "node", "left").select("same", F.coalesce("root", "node").alias("first_id"), "n_rows"))
    return joined_by(rows.select("id", "same"), classes, "same").where("id <> first_id").select(F.col("id").alias(id_col), "first_id")
