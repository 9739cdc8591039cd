"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point by a hash.  An n-gram's vector binds its letters': the
product, component by component, of each letter's vector rotated by its place from the end.  A text's vector bundles (adds) the vectors of all its
n-grams, a language's prototype those of all its training texts, and a text takes the language whose prototype has the greatest cosine with
it.  What all languages share, the direction of their prototypes' mean, is taken off both sides first.

Bundling is linear, so many texts are bundled by one matrix product: counts of n-grams by text times the n-grams' vectors.  All sums are
whole numbers below 2^24, which single precision adds exactly in any order; a longer text comes in slices.
Prototypes have one size however much text there is: each partition adds up its own, and they merge pair by pair.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import crc32_of

#: Components of a vector, and letters of an n-gram.
WIDTH, GRAM = 1024, 3
#: Texts and code points that are bundled at once, and n-grams of one matrix product.
TEXTS, POINTS, GRAMS = 256, 1 << 20, 8192
#: Languages whose prototypes are shipped to tasks at most (40 MB); there are some 8000 living ones.
MOST_LANGUAGES = 10_000
#: The language of a text without letters.
UNKNOWN = "und"
#: Scores are rounded, so that they don't depend on which texts are bundled together.
DIGITS = 9


@functools.cache
def folded() -> np.ndarray:
    """The code point of each code point's lower case; 0 for what isn't a letter or a mark."""
    import unicodedata

    table = np.zeros(0x110000, dtype=np.int32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower[0])
        elif point > 127 and unicodedata.category(char)[0] == "M":
            table[point] = point
    return table


def letter_vectors(points: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """(points, width) of +1 and -1 as int8: the bits of a 64-bit mixing function of code point and place."""
    with np.errstate(over="ignore"):
        x = (points.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(width // 64, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1)
    return (bits * 2).astype(np.int8) - np.int8(1)


def letters_of(text: str) -> np.ndarray:
    """Lower-cased letters of a text as code points; each run of anything else, and both ends, a 0."""
    points = folded()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    keep[0] = True
    return points[keep]


def gram_vectors(grams: np.ndarray, alphabet: np.ndarray, size: int = GRAM, width: int = WIDTH) -> np.ndarray:
    """(grams, width) in single precision.  grams: numbers whose digits, in base ``len(alphabet)``, are places in ``alphabet``."""
    found, rest, base = None, grams, letter_vectors(alphabet, width)
    for turn in range(size):
        rest, digit = np.divmod(rest, len(alphabet))
        letters = np.roll(base, turn, axis=1)[digit]
        found = letters if found is None else found * letters
    return found.astype(np.float32)


def bundles(texts: list[np.ndarray], groups: np.ndarray, number: int, size: int = GRAM, width: int = WIDTH) -> np.ndarray:
    """(number, width) doubles: the n-gram vectors of all ``texts`` (letters) added up by ``groups``, each text's group."""
    total = np.zeros((number, width))
    spans = [(g, t[at : at + POINTS + size - 1]) for g, t in zip(groups.tolist(), texts, strict=True) for at in range(0, max(len(t) - size + 1, 0), POINTS)]
    start = 0
    while start < len(spans):
        end, points = start, 0
        while end < len(spans) and (end == start or points + len(spans[end][1]) <= POINTS):
            points += len(spans[end][1])
            end += 1
        letters = np.concatenate([t for _, t in spans[start:end]])
        lengths = np.array([len(t) for _, t in spans[start:end]])
        there = np.zeros(0x110000, dtype=bool)
        there[letters] = True
        alphabet = np.flatnonzero(there)
        place = np.zeros(0x110000, dtype=np.int64)
        place[alphabet] = np.arange(len(alphabet))
        digits = place[letters]
        grams = digits[: len(digits) - size + 1]
        for turn in range(1, size):
            grams = grams * len(alphabet) + digits[turn : len(digits) - size + 1 + turn]
        owner = np.repeat(np.array([g for g, _ in spans[start:end]]), lengths)
        # no n-gram runs over a text's end
        last = np.cumsum(lengths)
        inside = np.ones(len(digits), dtype=bool)
        for turn in range(1, size):
            inside[last - turn] = False
        inside = inside[: len(grams)]
        grams, owner = grams[inside], owner[: len(inside)][inside]
        if len(alphabet) ** size <= 1 << 22:
            seen = np.zeros(len(alphabet) ** size, dtype=bool)
            seen[grams] = True
            distinct = np.flatnonzero(seen)
            number_of = np.zeros(len(seen), dtype=np.int64)
            number_of[distinct] = np.arange(len(distinct))
            index = number_of[grams]
        else:
            distinct, index = np.unique(grams, return_inverse=True)
        members, row = np.unique(owner, return_inverse=True)
        pairs = np.bincount(row * len(distinct) + index, minlength=len(members) * len(distinct)).reshape(len(members), -1)
        for at in range(0, len(distinct), GRAMS):
            total[members] += pairs[:, at : at + GRAMS].astype(np.float32) @ gram_vectors(distinct[at : at + GRAMS], alphabet, size, width)
        start = end
    return total


def groups_of(texts: list):
    """Ranges of ``texts`` with at most :data:`TEXTS` members and, but for a single long one, :data:`POINTS` characters."""
    start = points = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (i - start >= TEXTS or points + size > POINTS):
            yield start, i
            start, points = i, 0
        points += size
    if start < len(texts):
        yield start, len(texts)


def prototypes(rows: DataFrame, size: int = GRAM, width: int = WIDTH) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, (languages, width).  rows: (lang, t) of the training texts."""

    def add_up(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in groups_of(texts):
                names = sorted(set(langs[start:end]))
                sums = bundles([letters_of(t) for t in texts[start:end]], np.array([names.index(x) for x in langs[start:end]]), len(names), size, width)
                for name, vector in zip(names, sums, strict=True):
                    totals[name] = totals[name] + vector if name in totals else vector
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["lang", "bundle"])

    found = rows.mapInArrow(add_up, "lang string, bundle binary").rdd.map(lambda r: (r[0], np.frombuffer(r[1]))).reduceByKey(np.add)
    if found.count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    learned = dict(found.collect())
    names = sorted(learned)
    return names, np.array([learned[n] for n in names]).reshape(len(names), width)


def cosines(vectors: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(vectors, languages): cosines after the prototypes' mean direction is taken off vectors and prototypes; with one language alone, plain ones."""
    unit = lambda x: x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)
    known, vectors = unit(known), unit(vectors)
    if len(known) > 1:
        mean = unit(known.mean(0, keepdims=True))
        known = unit(known - (known @ mean.T) * mean)
        vectors = unit(vectors - (vectors @ mean.T) * mean)
    return vectors @ known.T


def languages(docs: DataFrame, *, folds: int = 4, held: int = 2, size: int = GRAM, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(``id_col``, held_out, lang_pred, score) of each row.

    Rows whose crc32 of the id's decimal text has the remainder ``held`` by ``folds`` teach nothing; the others do where their language isn't null.  The score is the cosine, 0 where it is
    negative.  A null text, or one without a letter, is ``und`` with score 0; so is every text where nothing was learned.  Ties go to the first language in order of text.  Repeated rows
    count each; a null id has the empty text as its decimal one; other columns are ignored, so clashing names don't matter.  An empty table gives an empty one.
    """
    held_out = crc32_of(F.col(id_col)) % folds == held
    given = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("t"))
    training = docs.where(~held_out & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    names, known = prototypes(training, size, width)
    schema = StructType([given.schema["id"], StructField("held_out", BooleanType()), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def predict(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in groups_of(texts):
                letters = [letters_of(t or "") for t in texts[start:end]]
                lang, score = np.full(end - start, UNKNOWN, dtype=object), np.zeros(end - start)
                lettered = np.flatnonzero([any(map(str.isalpha, t or "")) for t in texts[start:end]])
                if names and len(lettered):
                    found = np.round(cosines(bundles([letters[i] for i in lettered], np.arange(len(lettered)), len(lettered), size, width), known), DIGITS)
                    best = found.argmax(1)
                    lang[lettered] = np.array(names, dtype=object)[best]
                    score[lettered] = np.clip(found[np.arange(len(best)), best], 0.0, 1.0)
                rows = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(lang.tolist(), pa.string()), pa.array(score)], names=schema.names)

    return given.mapInArrow(predict, schema).withColumnRenamed("id", id_col)
