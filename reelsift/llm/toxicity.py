"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary labelled texts, give each word a probability: absolute discounting of the class's
word counts, interpolated with a spelling model.  That has the class's counts of a letter after up to
four letters, interpolated with Kneser-Ney continuation counts that both classes share.  So an expression that is
rare, or an unseen inflection of a toxic stem, is judged by its letters, and where a class knows nothing both
back off to the same counts and the comparison stays neutral.

Most words of a toxic text are ordinary ones, so a toxic text's word is taken to come from the toxic model with probability ``SHARE`` and else from the
ordinary one.  The verdict is the difference of the log-likelihoods of the toxic and the ordinary text, normalised by length; a logistic
curve with two parameters makes a probability of it.  The curve is fitted on labelled rows that the models it sees weren't fitted on: each half of the rows is
compared under models of the other half.

Bounds: models and curve are fitted on at most ``max_rows`` labelled rows of each class, those whose
hashed ids come first.  All their words count.  What is broadcast are the words that a class has more often than the discount (others have no share of their
own in the discounted counts, only in the letters') and the letter counts.  Every text is scored whole.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import crc32_of, resident, written

#: Letters before the letter that is predicted.
ORDER = 4
#: Taken from each count of a class's words, of its letters, and from the shared counts.  The first two are above one, so that a few chance
#: sightings of a rare word in one class don't outweigh what both classes share.
WORD_DISCOUNT, LETTER_DISCOUNT, DISCOUNT = 3.0, 5.0, 0.75
#: A word's log-ratio counts up to this one either way.
CLIP = 10.0
#: Share of a toxic text's words that come from the toxic model.
SHARE = 0.02
#: Keeps the curve's two parameters of a size, for its ridge.
SCALE = 10.0
CACHE_WORDS = 300_000
#: Stripped from the ends of words; A-Z are lower-cased.
MARKS = b".,!?;:'\"()[]{}*$%&#|<>-_"
#: Characters of a word that are looked at one by one; a longer one is cut into words of that length.
LONGEST = 64


def words_of(text: bytes | None) -> list[str]:
    found = [w for x in (text or b"").lower().split() if (w := x.strip(MARKS))]
    out = []
    for w in found:
        w = w.decode("utf-8", "replace")
        out += [w[i : i + LONGEST] for i in range(0, len(w), LONGEST)] if len(w) > LONGEST else [w]
    return out


def grams_of(word: str) -> list[str]:
    """Each letter of a word, with its end, after up to ORDER letters."""
    s = "^" + word + "$"
    return [s[max(0, i - ORDER) : i + 1] for i in range(1, len(s))]


class Models:
    """Both class models.

    words, grams: (ordinary count, toxic count) of words and of letters with those before them; totals: the classes' tokens;
    taken: what discounting takes from the classes' words.  Words that a class has at most WORD_DISCOUNT times may be left out of ``words``."""

    def __init__(self, words: dict[str, tuple[int, int]], grams: dict[str, tuple[int, int]], totals: tuple[int, int], taken: tuple[float, float]):
        self.words, self.letter = words, grams
        self.totals = [max(1, x) for x in totals]
        self.left = [max(x / n, 1e-9) for x, n in zip(taken, self.totals, strict=True)]
        # of each class: count of a context, and what discounting takes from its letters, for the shared counts
        self.context = [defaultdict(int), defaultdict(int)]
        self.spare = [defaultdict(float), defaultdict(float)]
        for g, n in grams.items():
            for c in (0, 1):
                if n[c]:
                    self.context[c][g[:-1]] += n[c]
                    self.spare[c][g[:-1]] += min(n[c], LETTER_DISCOUNT)
        # shared continuation counts: different letters before a context and letter
        every = {g[k:] for g in grams for k in range(len(g))}
        self.follow, self.sums, self.kinds = defaultdict(int), defaultdict(int), defaultdict(int)
        for g in every:
            if len(g) > 1:
                self.follow[g[1:]] += 1
        for g, n in self.follow.items():
            self.sums[g[:-1]] += n
            self.kinds[g[:-1]] += 1
        self.letters = max(2, self.kinds[""] + 1)  # one for all unknown ones
        self.cache: dict[str, float] = {}
        self.memo: dict[str, tuple[float, float]] = {}

    def _shared(self, ctx: str, ch: str) -> float:
        p = 1 / self.letters
        for k in range(len(ctx), -1, -1):
            c = ctx[k:]
            if total := self.sums.get(c):
                p = (max(self.follow.get(c + ch, 0) - DISCOUNT, 0) + DISCOUNT * self.kinds[c] * p) / total
        return p

    def _letter(self, gram: str) -> tuple[float, float]:
        """Log-probabilities of the last letter of ``gram`` after the others, in both classes."""
        ctx, ch = gram[:-1], gram[-1]
        low, out = self._shared(ctx[1:], ch), []
        counts = self.letter.get(gram, (0, 0))
        for c in (0, 1):
            total = self.context[c].get(ctx, 0)
            out.append(math.log((max(counts[c] - LETTER_DISCOUNT, 0) + self.spare[c][ctx] * low) / total if total else low))
        self.memo[gram] = found = (out[0], out[1])
        return found

    def _spelling(self, w: str) -> tuple[float, float]:
        a, b, get = 0.0, 0.0, self.memo.get
        if len(self.memo) > CACHE_WORDS:
            self.memo.clear()
        for gram in grams_of(w):
            x, y = get(gram) or self._letter(gram)
            a, b = a + x, b + y
        return a, b

    def logs(self, w: str) -> tuple[float, float]:
        """Log-probabilities of a word in both classes."""
        counts, found = self.words.get(w, (0, 0)), []
        for c, spelled in enumerate(self._spelling(w)):
            known = max(counts[c] - WORD_DISCOUNT, 0) / self.totals[c]
            found.append(math.log(known + self.left[c] * math.exp(max(spelled, -600.0))))
        return found[0], found[1]

    def evidence(self, w: str) -> float:
        """log of P(word | toxic text) / P(word | ordinary text), where toxic texts have SHARE of their words from the toxic model."""
        found = self.cache.get(w)
        if found is None:
            ordinary, toxic = self.logs(w)
            found = math.log(1 - SHARE + SHARE * math.exp(min(CLIP, max(-CLIP, toxic - ordinary))))
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[w] = found
        return found

    def compare(self, text: bytes | None) -> float:
        """The difference of the log-likelihoods of a text, normalised by its length; 0 without words."""
        words = words_of(text)
        get = self.cache.get
        return sum(self.evidence(w) if v is None else v for w, v in zip(words, map(get, words), strict=True)) / max(1, len(words))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


#: Halves of the labelled rows that a model is fitted on.
_HALVES = {"0": (0,), "1": (1,), "both": (0, 1)}


def _built_once(key: str, shared, name: str) -> Models:
    """The model ``name`` of broadcast counts, built once in each Python worker."""

    def build():
        words, grams, sums = shared.value
        counts = []
        for keys, n in (words, grams):
            two = [n[:, [2 * c + h for h in _HALVES[name]]].sum(axis=1).tolist() for c in (0, 1)]
            counts.append({k: (a, b) for k, a, b in zip(keys, *two, strict=True) if a or b})
        return Models(*counts, *sums[name])

    # the two of the halves stay beside each other
    return resident(("toxicity", key, name), build, ("toxicity", key, name == "both"))


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, max_rows: int = 6000, fold: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", carry: bool = False) -> DataFrame:
    """(id, held_out, score, predicted) of each row of ``docs``.

    Learns from labelled rows whose crc32 of the id's text isn't ``held`` modulo ``fold``; of each class at most ``max_rows``.  score: 0 to 1, from the text alone.  Null and empty texts get the
    score of a text without words.  Where a class has no labelled text, every score is the share of toxic labels (0 without labels).
    With ``carry``, the whole row comes along as the struct ``row``.  Null labels and ids teach nothing; a repeated labelled id counts as toxic if any of its rows is.  Repeated documents each give a row.  Other columns are
    ignored.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (crc32_of(F.col(id_col)) % fold != held)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows) for y in (0, 1)]
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    # at most 2 * max_rows rows of two numbers: a fixed bound for the broadcast
    sample = written(given.join(F.broadcast(picked[0].unionByName(picked[1])), "id").withColumn("half", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2)).cast("int")), "toxicity-sample")

    def count(batches):
        for batch in batches:
            n: dict[str, list[int]] = {}
            for text, y, half in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for w in words_of(text):
                    n.setdefault(w, [0, 0, 0, 0])[2 * y + half] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array([x[i] for x in n.values()], pa.int64()) for i in range(4))], names=["w", "n0", "n1", "n2", "n3"])

    four = [f"n{i}" for i in range(4)]
    summed = lambda df, key: df.groupBy(key).agg(*(F.sum(x).alias(x) for x in four))
    counted = written(summed(sample.select("t", "y", "half").mapInArrow(count, "w string, n0 long, n1 long, n2 long, n3 long"), "w"), "toxicity-words")

    def spell(batches):
        n: dict[str, np.ndarray] = {}
        for batch in batches:
            for w, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.array(own)
                for g in grams_of(w):
                    n[g] = n[g] + own if g in n else own
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array([int(x[i]) for x in n.values()], pa.int64()) for i in range(4))], names=["g", *four])

    grams = summed(counted.mapInArrow(spell, "g string, n0 long, n1 long, n2 long, n3 long"), "g").toPandas()
    of = lambda c, name: sum((F.col(f"n{2 * c + h}") for h in _HALVES[name]), F.lit(0))
    row = counted.agg(*(F.sum(x).alias(f"{kind}{c}{name}") for name in _HALVES for c in (0, 1) for kind, x in (("all", of(c, name)), ("taken", F.least(of(c, name).cast("double"), F.lit(WORD_DISCOUNT)))))).first()
    sums = {name: tuple(tuple(row[f"{kind}{c}{name}"] or 0 for c in (0, 1)) for kind in ("all", "taken")) for name in _HALVES}
    frequent = counted.where((of(0, "both") > WORD_DISCOUNT) | (of(1, "both") > WORD_DISCOUNT)).toPandas()
    shared = spark.sparkContext.broadcast((*((df.iloc[:, 0].tolist(), df[four].to_numpy(dtype=np.int64)) for df in (frequent, grams)), sums))
    run = uuid.uuid4().hex

    def features(batches):
        for batch in batches:
            found = [_built_once(run, shared, str(1 - half)).compare(text) for text, half in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.float64())], names=["y", "x"])

    beta = None
    if min(shares.get(0, 0), shares.get(1, 0)) > 0:
        seen = sample.select("t", "y", "half").mapInArrow(features, "y int, x double").toPandas()
        x, y = np.stack([np.ones(len(seen)), SCALE * seen["x"].to_numpy()], axis=1), seen["y"].to_numpy()
        if len(set(y.tolist())) == 2:
            prior = shares[1] / (shares[0] + shares[1])
            order = np.lexsort(tuple(x.T))  # so that sums don't depend on the order of arrival
            x, y = x[order], y[order]
            beta = fit_logistic(x, y, np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean())))
    constant = shares.get(1, 0) / max(1, sum(shares.values()))

    def score(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if beta is None:
                p = np.full(len(texts), constant)
            else:
                x = SCALE * np.array([_built_once(run, shared, "both").compare(t) for t in texts])
                p = 1 / (1 + np.exp(-np.clip(beta[0] + beta[1] * x, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), *batch.columns[2:]], names=["id", "score", *batch.schema.names[2:]])

    whole = [F.struct("*").alias("row")] if carry else []
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"), *whole)
    out = StructType([texts.schema["id"], StructField("score", DoubleType()), *([texts.schema["row"]] if carry else [])])
    scored = texts.mapInArrow(score, out)
    return scored.select(*(["row"] if carry else []), F.col("id").alias(id_col), (crc32_of(F.col("id")) % fold == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
