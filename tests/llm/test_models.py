"""Near duplicates, language models, rules, trees, chats: against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reelsift.llm import common, components as components_, katz, merkle, preference, quality, simhash, toxicity
from reelsift.llm.components import components

NULLS = [(None, "orphan text"), (1, None), (2, ""), (3, "  \n ")]


def make(spark, rows, kinds="doc_id long, text string"):
    return spark.createDataFrame(rows, kinds)


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components_, "FEW_LINKS", few)
    links = make(spark, [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (2, 1), (None, 4)] + [(100 + i, 101 + i) for i in range(40)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} and {v for k, v in got.items() if k >= 100} == {100}
    assert components(links.limit(0)).count() == 0


def brute_print(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << j for j in range(64) if sum(v >> j & 1 for v in h) * 2 > len(h))


def test_golay_is_perfect():
    g = simhash.Golay()
    x = np.random.default_rng(0).integers(0, 1 << 23, 2000, dtype=np.uint64)
    words = {int(g.nearest(np.array([v], dtype=np.uint64))[0]) for v in x[:50]}
    assert all(w < 1 << 12 for w in words)
    home = g.nearest(x)
    for f in simhash.flips(23, 1)[1:]:
        same = g.nearest(x ^ f) == home
        assert 0.05 < same.mean() < 0.5
    assert np.bitwise_count(g.leaders).max() == 3 and len(set(g.leaders.tolist())) == 2048


@pytest.mark.parametrize("crowd", [64, 2])
def test_fingerprint_links_are_exact(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(0)
    points = {rng.getrandbits(64) for _ in range(40)}
    for c in list(points)[:10]:
        for _ in range(15):
            points.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    x = np.array(sorted(points), dtype=np.uint64)
    label = np.arange(len(x))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 2
    while not (new := np.where(near, label[None, :], len(x)).min(1)).tolist() == label.tolist():
        label = new
    links = simhash.fingerprint_links(make(spark, [(int(v),) for v in x.view(np.int64)], "print long"), 2)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    mine = defaultdict(set)
    for v in x.view(np.int64).tolist():
        mine[got.get(v, v)].add(v)
    want = defaultdict(set)
    for v, k in zip(x.view(np.int64).tolist(), label.tolist(), strict=True):
        want[k].add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_simhash_rows(spark):
    texts = [*NULLS, (4, "One two Three four"), (9, "one TWO three four"), (4, "One two Three four"), (7, "Ünï two"), (8, "solo")]
    docs = make(spark, texts).selectExpr("*", "1 as id", "2 as print")
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(texts)
    by = {r["doc_id"]: r for r in got}
    for k, t in texts:
        assert by[k]["fingerprint"] == f"{brute_print(t):016x}"
    assert by[9]["component_id"] == 4 and by[2]["component_id"] == by[3]["component_id"] == 1
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_near_copies(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [[word() for _ in range(300)] for _ in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    rows += [(100 + i, " ".join(w).upper()) for i, w in enumerate(base[:3])]
    for i, w in enumerate(base[:6]):
        w = list(w)
        for _ in range(4):
            w[rng.randrange(300)] = word()
        rows.append((200 + i, " ".join(w)))
    got = {r["doc_id"]: r["first_id"] for r in simhash.near_copies(make(spark, rows), id_col="doc_id").collect()}
    assert got == {**{100 + i: i for i in range(3)}, **{200 + i: i for i in range(6)}}


def test_near_copies_of_one_original(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(5000, " ".join(base))]
    for i in range(2000):
        at = rng.randrange(272)  # 264 of 328 shingles in common with the original; mostly 232 of 360 with each other
        rows.append((i, " ".join(base[:at] + [f"c{i}x{k}" for k in range(28)] + base[at + 28 :])))
    got = simhash.near_copies(make(spark, rows), id_col="doc_id").collect()
    assert {r["doc_id"]: r["first_id"] for r in got} == {i: 0 for i in [*range(1, 2000), 5000]}


def test_near_copies_at_the_threshold(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, expected = [], {}
    for i in range(150):
        w = [word() for _ in range(300)]
        longer, block = w + [word() for _ in range(74 + i % 2)], w[:100] + [word() for _ in range(28 + 2 * (i % 2))] + w[128 + 2 * (i % 2) :]
        rows += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(longer)), (3 * i + 2, " ".join(block))]
        expected |= {} if i % 2 else {3 * i + 1: 3 * i, 3 * i + 2: 3 * i}
    got = simhash.near_copies(make(spark, rows), id_col="doc_id").collect()
    assert {r["doc_id"]: r["first_id"] for r in got} == expected


def test_near_copies_against_brute_force(spark):
    rng = random.Random(7)
    texts = [[f"w{i}" for i in range(100)]]
    while len(texts) < 400:
        w = list(rng.choice(texts))
        at, k = rng.randrange(len(w)), rng.randrange(1, 10)
        w[at : at + k] = [f"e{len(texts)}x{j}" for j in range(rng.randrange(10))]
        texts.append(w)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    first = list(range(len(texts)))
    for a, x in enumerate(sets):
        for b in range(a):
            if len(x & sets[b]) >= 0.8 * len(x | sets[b]) and first[a] != first[b]:
                old, new = max(first[a], first[b]), min(first[a], first[b])
                first = [new if f == old else f for f in first]
    got = simhash.near_copies(make(spark, [(i, " ".join(w)) for i, w in enumerate(texts)]), id_col="doc_id").collect()
    assert {r["doc_id"]: r["first_id"] for r in got} == {i: f for i, f in enumerate(first) if i != f} and len(set(first)) > 1


def test_sketches_leave_out_no_alike_pair():
    rng = np.random.default_rng(9)
    x = [np.unique(rng.integers(0, 1 << 63, int(n)).astype(np.uint64)) for n in [0, 1, 2, 9, *rng.integers(10, 5000, 300)]]
    y = [np.unique(np.concatenate([v[int(len(v) * r) :], rng.integers(0, 1 << 63, int(len(v) * q)).astype(np.uint64)])) for v, r, q in zip(x, rng.random(len(x)) * 0.3, rng.random(len(x)) * 0.2, strict=True)]
    n, m = (np.array([len(v) for v in z], dtype=np.int32) for z in (x, y))
    may = simhash.may_reach([simhash.sketch(v) for v in x], [simhash.sketch(v) for v in y], n, m, 0.8)
    alike = np.array([simhash.jaccard(v, w) >= 0.8 for v, w in zip(x, y, strict=True)])
    assert may[alike].all() and 50 < alike.sum() < len(x)
    assert not simhash.may_reach([simhash.sketch(x[9])], [simhash.sketch(x[8])], n[9:10], n[8:9], 0.8).any()


def test_texts_of_pairs_that_cannot_be_alike_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(60):
        same = [word() for _ in range(9)]
        rows += [(5 * i + k, " ".join(same + [word() for _ in range(5)])) for k in range(5)]
    texts, plain = [], simhash.written

    def noted(df, label):
        found = plain(df, label)
        texts.extend(r["id"] for r in found.select("id").collect()) if label == "candidates" else None
        return found

    monkeypatch.setattr(simhash, "written", noted)
    monkeypatch.setattr(common, "MOST_BROADCAST", 0)
    got = simhash.near_copies(make(spark, [*rows, (1000, rows[7][1] + " " + word())]), id_col="doc_id").collect()
    assert [(r["doc_id"], r["first_id"]) for r in got] == [(1000, 7)]
    assert sorted(texts) == [7, 1000]


def test_blocks_meet_all_that_may_be_alike():
    rng = np.random.default_rng(4)
    n = rng.integers(1, 60, 300).astype(np.int32)
    pos = (n * rng.random(300) ** 3 * 0.3).astype(np.int32)
    root, outside, ids = rng.integers(0, 40, 300), np.sort(rng.integers(0, 2, 300)), np.arange(300)
    zero = np.zeros(300, dtype=np.int64)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (zero, zero, zero, outside, ids, n, pos, zero, root)], names=list("abcdefghi"))
    got = {(a, b) for p in simhash._block_meetings(0.8, None)([batch]) for a, b in zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)}
    want = {(u, v) for u in range(300) for v in range(u + 1, 300) if outside[u] != outside[v] and root[u] != root[v] and simhash._may_be_alike(n[u], pos[u], n[v], pos[v], 0.8)}
    assert got == want and len(want) > 300


def test_blocks_tell_whether_rows_had_more_than_the_nearest():
    import pyarrow as pa

    def met(rows):
        zero, ids = np.zeros(rows, dtype=np.int64), np.arange(rows)
        columns = [zero, zero, zero, (ids == rows - 1).astype(np.int32), ids, zero + 9, zero, zero, ids]
        sketches = pa.array([simhash.sketch(np.arange(9 if i % 2 else 100, 109 if i % 2 else 200, dtype=np.uint64)) for i in range(rows)])
        batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), sketches], names=list("abcdefghij"))
        return [x for p in simhash._block_meetings(0.8, 0)([batch]) for x in zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)]

    assert met(64) == [(i, 63) for i in range(1, 63, 2)]
    most = 2 * simhash.NEAREST + 4
    assert (None, None) in (found := met(most)) and len(found) == simhash.NEAREST + 1


def test_steps_of_few_crowded_rows_take_few_tasks(spark):
    """However many partitions shuffles have: those of tables that one task can hold aren't made."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    form = [word() for _ in range(30)]
    rows = [(i, " ".join(form + [word() for _ in range(12 if i % 4 else 3)])) for i in range(300)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("20", "false"), strict=True):
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("few tasks", "near copies")
        got = simhash.near_copies(make(spark, rows), id_col="doc_id").collect()
        told = spark.sparkContext.statusTracker()
        stages = {s for j in told.getJobIdsForGroup("few tasks") for s in told.getJobInfo(j).stageIds}
        tasks = sum(x.numCompletedTasks for s in stages if (x := told.getStageInfo(s)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {(r["doc_id"], r["first_id"]) for r in got} == {(i, 0) for i in range(4, 300, 4)}
    assert tasks < 1200, tasks


@pytest.mark.parametrize("crowd, block", [(64, 4096), (4, 3)])
def test_near_copies_of_odd_rows(spark, monkeypatch, crowd, block):
    """Null, empty, wordless, repeated and very long texts, other columns, and crowds and blocks of a few rows."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    long = [word() for _ in range(60_000)]
    rows = [(3, None), (1, ""), (2, " \n "), (5, None), (10, " ".join(long)), (11, " ".join(long[:50_000])), (12, " ".join(long[:30_000])), (20, "a b c"), (21, "A b\nc"), (22, "a b d")]
    first = {2: 1, 3: 1, 5: 1, 11: 10, 21: 20}
    base = [word() for _ in range(200)]
    for i in range(30):  # one of each ten is like none but its own copy, yet has the rarest shingles of all
        w = list(base)
        if i % 10 == 0:
            w[40:] = [word() for _ in range(160)]
            rows.append((200 + i, " ".join([*w, "more"])))
            first[200 + i] = 100 + i
        else:
            w[rng.randrange(200)] = word()
            first |= {100 + i: 101} if i > 1 else {}
        rows.append((100 + i, " ".join(w)))
    docs = make(spark, rows).selectExpr("*", "1 as token", "'x' as same", "2 as id", "3 as t", "4 as n_rows")
    got = simhash.near_copies(docs, id_col="doc_id").collect()
    assert {r["doc_id"]: r["first_id"] for r in got} == first
    assert simhash.near_copies(docs.limit(0), id_col="doc_id").count() == 0


def simple_good_turing(counts):
    """Discounts of counts 1 to 5 by the definition, with a line from numpy; index 0 is none."""
    of = Counter(v for v in counts if v <= 40)
    rs = sorted(of)
    gaps = [((rs[i + 1] if i + 1 < len(rs) else 2 * r - rs[i - 1]) - (rs[i - 1] if i else 0)) / 2 for i, r in enumerate(rs)]
    slope, at = np.polyfit(np.log(rs), np.log([of[r] / g for r, g in zip(rs, gaps, strict=True)]), 1)
    slope = min(slope, -1.05)
    expected = lambda r: math.exp(at + slope * math.log(r))
    k = 6 * expected(6) / expected(1)
    return [0.0, *(((r + 1) * expected(r + 1) / (r * expected(r)) - k) / (1 - k) for r in range(1, 6))]


def test_good_turing_discounts():
    # counts of counts that fall with the square: r* = r * r / (r + 1), so d(1) = (1/2 - 1/6) / (5/6), ..., d(5) = (5/6 - 1/6) / (5/6)
    exact = [1e9 / r**2 for r in range(1, 41)]
    assert np.allclose(katz.discounts(np.array(exact)), [0, 0.4, 0.6, 0.7, 0.76, 0.8], atol=1e-3)
    rough = [900, 210, 130, 45, 60, 20, 25, 0, 14, 9, 0, 0, 5, *[0] * 27]
    assert np.allclose(katz.discounts(np.array(rough)), simple_good_turing([r + 1 for r, n in enumerate(rough) for _ in range(n)]))
    for odd in ([0] * 40, [0, 0, 7, *[0] * 37], [5] * 40, [1, 2, 3, 4, 5, 6, *[9] * 34]):
        d = katz.discounts(np.array(odd))
        assert ((d[1:] > 0) & (d[1:] < 1)).all() and (np.diff(d) > 0).all()


def test_katz_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(katz, "PART_KEYS", 60)
    rng = random.Random(0)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(60)], k=rng.randint(0, 40)))) for i in range(200)] + [(None, "W1 w2"), (500, None), (500, None)]
    got = katz.katz_scores(make(spark, texts).selectExpr("*", "1 as score", "2 as block")).toPandas()
    start, end = "<s>", "</s>"
    split = [(t or "").lower().split() for _, t in texts]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0 for i, _ in texts]
    c, pairs, starts = Counter(), Counter(), sum(train)
    for w, x in zip(split, train, strict=True):
        if x:
            c.update([*w, end])
            pairs.update(zip([start, *w], [*w, end], strict=True))
    d1, d = simple_good_turing(c.values()), simple_good_turing(pairs.values())
    unknown = sum(r * (1 - d1[r]) for r in c.values() if r <= 5) / sum(c.values())
    room = sum(c.values()) + (unknown == 0)  # where nothing is discounted, one more token than seen makes room
    p = lambda w: (d1[c[w]] if c[w] <= 5 else 1) * c[w] / room if c[w] else unknown or 1 / room
    follow = defaultdict(list)
    for (u, w), r in pairs.items():
        follow[u].append((w, r))
    count = {**c, start: starts}
    prob = {}
    for u, seen in follow.items():
        mass = sum((d[r] if r <= 5 else 1) * r for _, r in seen) / count[u]
        scale, left = (1.0, 1 - mass) if mass < 1 - 1e-12 else (count[u] / (count[u] + 1), 1 / (count[u] + 1))
        back = left / (1 - sum(p(w) for w, _ in seen))
        prob[u] = (scale, back, dict(seen))
        total = sum(scale * (d[r] if r <= 5 else 1) * r / count[u] for _, r in seen) + sum(back * p(w) for w in [*c, "unknown"] if w not in dict(seen))
        assert abs(total - 1) < 1e-9
    want = []
    for (i, _), w, x in zip(texts, split, train, strict=True):
        score = base = 0.0
        for u, v in zip([start, *w], [*w, end], strict=True):
            if u not in prob:
                q = p(v)
            else:
                scale, back, seen = prob[u]
                r = seen.get(v, 0)
                q = scale * (d[r] if r <= 5 else 1) * r / count[u] if r else back * p(v)
            score += math.log10(q)
            base += math.log10((c[v] + 0.1) / (sum(c.values()) + 0.1 * (len(c) + 1)))
        want.append((-1 if i is None else i, not x, len(w) + 1, round(base, 6), round(score, 6)))
    mine = [(-1 if math.isnan(r.doc_id) else int(r.doc_id), r.held_out, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.itertuples()]
    assert sorted(mine) == sorted(want)
    assert katz.katz_scores(make(spark, texts).limit(0)).count() == 0


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 7)))
    vocabulary, rows, labels = [word() for _ in range(300)], [], []
    for i in range(600):
        w = rng.choices(vocabulary, k=60)
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(60)] = "zugk" + rng.choice(("a", "et", "or", "im", "us"))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = make(spark, [*rows, *((1000 + i if k is not None else None, t) for i, (k, t) in enumerate(NULLS))])
    known = make(spark, [*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs.selectExpr("*", "1 as score", "2 as id"), known).toPandas()
    assert len(got) == 604 and got.score.between(0, 1).all()
    held = got[got.held_out & (got.doc_id < 600)]
    assert (held.predicted == (held.doc_id % 4 == 0)).mean() > 0.97
    none = toxicity.toxicity(docs, known.limit(0)).toPandas()
    assert (none.score == 0).all()


def test_class_models_by_definition():
    words = {"ab": (20, 2), "ac": (5, 40), "b": (9, 0), "abab": (1, 1), "zzz": (0, 7)}
    marked = {"^" + w + "$": n for w, n in words.items()}
    grams = defaultdict(lambda: [0, 0])
    for w, n in words.items():
        for g in toxicity.grams_of(w):
            for c in (0, 1):
                grams[g][c] += n[c]
    totals = tuple(sum(n[c] for n in words.values()) for c in (0, 1))
    taken = tuple(sum(min(n[c], 3.0) for n in words.values()) for c in (0, 1))
    m = toxicity.Models({w: n for w, n in words.items() if max(n) > 3}, {g: tuple(n) for g, n in grams.items()}, totals, taken)
    letters = sorted({x for w in marked for x in w[1:]})

    def before(s):
        """Different letters before a stretch of a word, among those a gram of five letters can see."""
        return {w[i - 1] for w in marked for i in range(1, len(w)) if w.startswith(s, i)}

    def shared(ctx, ch):
        below = shared(ctx[1:], ch) if ctx else 1 / (len(letters) + 1)
        sums = {x: len(before(ctx + x)) for x in letters}
        total = sum(sums.values())
        return (max(sums.get(ch, 0) - 0.75, 0) + 0.75 * sum(v > 0 for v in sums.values()) * below) / total if total else below

    def letter(ctx, ch, c):
        full = {x: sum(n[c] for w, n in marked.items() for i in range(1, len(w)) if w[max(0, i - 4) : i + 1] == ctx + x) for x in letters}
        total = sum(full.values())
        return (max(full.get(ch, 0) - 5, 0) + sum(min(v, 5) for v in full.values()) * shared(ctx[1:], ch)) / total if total else shared(ctx[1:], ch)

    for c in (0, 1):
        assert abs(sum(letter("^a", x, c) for x in [*letters, "?"]) - 1) < 1e-9
        for w in ("ab", "ac", "b", "abab", "zzz", "abc", "new"):
            s = "^" + w + "$"
            spelled = math.prod(letter(s[max(0, i - 4) : i], s[i], c) for i in range(1, len(s)))
            want = max(words.get(w, (0, 0))[c] - 3, 0) / totals[c] + taken[c] / totals[c] * spelled
            assert abs(m.logs(w)[c] - math.log(want)) < 1e-9
    ratio = lambda w: math.exp(min(10.0, m.logs(w)[1] - m.logs(w)[0]))
    assert abs(m.compare(b"AB, zzz new") - sum(math.log(0.98 + 0.02 * ratio(w)) for w in ("ab", "zzz", "new")) / 3) < 1e-9 and m.compare(None) == 0


def test_quality_counts(spark):
    rng = random.Random(0)
    texts = ["", None, "a\na\n\nb # $", "x y z x y z x y z", " ".join("word%d" % rng.randrange(999) for _ in range(80)), "é ü ß\n é ü ß"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    docs = make(spark, [(i, t, None if i % 2 else "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, size int")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs, path).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for k, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for j in (k, k + 1, k + 2)}
        lines = t.split("\n")
        dup = sum(bool(x.encode().split()) and x in lines[:k] for k, x in enumerate(lines))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r["base_failed"] or not r["kept"])
    assert quality.quality_rules(docs.limit(0), path).count() == 0


def test_bands_reject_outliers(spark):
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    rng = random.Random(0)
    vocabulary = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=100))) for i in range(300)] + [(900, " ".join(rng.choices(["zz", "qq"], k=55) + rng.choices(vocabulary, k=45))), (901, " ".join("日本語%d" % i for i in range(100)))]
    got = {r["doc_id"]: r["in_band"] for r in quality.quality_rules(make(spark, [(*r, "en") for r in rows], "doc_id long, text string, lang string"), path).collect()}
    assert not got[900] and not got[901] and sum(got[i] for i in range(300)) >= 297


def test_merkle(spark):
    text = "\n".join(f"Line {i} has words. And a tail, too." for i in range(80))
    changed = text.replace("Line 40 has", "Line 40 had")
    docs = make(spark, [(5, text), (7, changed), (7, "second row"), (8, text), (None, "first"), (9, None)]).selectExpr("*", "1 as key", "2 as t")
    got = sorted(merkle.merkle_fingerprints(docs).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["n_chars"]))
    assert len(got) == 6
    five = next(r for r in got if r["doc_id"] == 5)
    eight = next(r for r in got if r["doc_id"] == 8)
    assert five["fingerprint"] == eight["fingerprint"] and five["near_next"] > 0.95 and eight["near_next"] == 0.0
    nine = next(r for r in got if r["doc_id"] == 9)
    assert nine["n_chars"] == 0 and nine["fingerprint"] == nine["edited_fingerprint"]
    assert merkle.merkle_fingerprints(docs.limit(0)).count() == 0
    both = make(spark, [(text, changed)], "a string, b string").select(merkle.tree(F.col("a")).alias("x"), merkle.tree(F.col("b")).alias("y"))
    differing = both.select(merkle.differing_sections(both["x"], both["y"]).alias("d")).first()["d"]
    sections = both.select(F.size(both["x"]["sections"]).alias("n")).first()["n"]
    assert 1 <= len(differing) <= 2 < sections  # two where the changed paragraph ended a section


def test_preference(spark):
    kinds = "pair long, turn long, role string, text string"
    shared = [(1, 0, "system", "be"), (1, 1, "user", "hi")]
    chosen = make(spark, [*shared, shared[0], (1, 2, "assistant", "good"), (2, 0, "user", "x"), (3, 0, "user", None), (None, 0, "user", "y"), (4, 0, "user", "same")], kinds)
    rejected = make(spark, [*shared, (1, 2, "assistant", "bad"), (1, 3, None, "more"), (2, 0, "user", "z"), (4, 0, "user", "same")], kinds)
    got = {(r["pair"], r["side"]): r for r in preference.format_preferences(chosen, rejected).collect()}
    assert got[1, "prompt"]["text"] == "<|system|>\nbe<|end|>\n<|user|>\nhi<|end|>\n" and got[1, "prompt"]["trained_spans"] == []
    good = got[1, "chosen"]
    (span,) = good["trained_spans"]
    assert good["text"][span["start"] : span["end"]] == "good<|end|>\n"
    assert got[1, "rejected"]["n_turns"] == 2 and len(got[1, "rejected"]["trained_spans"]) == 1
    assert (2, "prompt") not in got and got[2, "chosen"]["text"].startswith("<|user|>\nx") and (3, "rejected") not in got
    assert set(k for k in got if k[0] == 4) == {(4, "prompt")}
    many = make(spark, [(1, i, "assistant" if i % 2 else "user", str(i)) for i in range(600)], kinds)
    parts = preference.format_preferences(many, many.where("turn < 300")).collect()
    assert sorted((r["side"], r["part"]) for r in parts) == [("chosen", 1), ("chosen", 2), ("prompt", 0), ("prompt", 1)]


def test_quality_bands_of_rare_languages(spark):
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    rng = random.Random(2)
    words = "the of and house river morning people water light small great under between paper".split()
    text = lambda: " ".join(rng.choices(words, k=80))
    rows = [(i, text(), "en") for i in range(150)] + [(200, text(), "xx"), (201, "\u16a0\u16b1" * 400, "xx"), (202, "\u16a0 " * 5000, "yy")]
    got = {r["doc_id"]: r["in_band"] for r in quality.quality_rules(make(spark, rows, "doc_id long, text string, lang string"), path).collect()}
    assert got[200] and not got[201] and not got[202]


def test_preference_of_odd_rows(spark):
    convs = make(spark, [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (0, 0, None, "b" * 300_000), (None, 0, "user", "x"), (2, None, "user", "x")], "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pair", "2 as part", "'z' as side", "3 as sides")
    got = {(r["pair"], r["side"]): r for r in preference.format_marked(preference.reply_pairs(convs)).collect()}
    assert set(got) == {(0, "chosen"), (0, "rejected"), (1, "prompt"), (1, "chosen"), (1, "rejected")}
    assert got[1, "chosen"]["text"] == "<|assistant|>\n<|end|>\n" and got[1, "rejected"]["text"] == "<|user|>\n" + "b" * 300_000 + "<|end|>\n"
    assert preference.format_marked(preference.reply_pairs(convs.limit(0))).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    long = " ".join(rng.choices(words, k=150_000)).replace(words[0], words[0] + ".\n")
    rows = [(1, long), (2, long + " end"), (3, long), (4, "short text of a few words"), (5, "x" * 300_000)]
    docs = make(spark, rows).selectExpr("*", "'en' as lang")
    n = {i: len(t.split()) for i, t in rows}
    prints = {r["doc_id"]: r for r in simhash.simhash_groups(docs).collect()}
    assert all(prints[i]["fingerprint"] == f"{brute_print(t):016x}" for i, t in rows) and prints[3]["component_id"] == 1
    assert {r["doc_id"]: r["n_tokens"] - 1 for r in katz.katz_scores(docs).collect()} == n
    trees = {r["doc_id"]: r for r in merkle.merkle_fingerprints(docs).collect()}
    assert trees[1]["fingerprint"] == trees[3]["fingerprint"] and trees[1]["n_chars"] == len(long) and 0.7 < trees[1]["near_edited"] < 1 and trees[1]["near_next"] > 0.99
    scores = toxicity.toxicity(docs, make(spark, [(1, 0), (4, 1)], "doc_id long, toxic int")).collect()
    assert len(scores) == 5 and all(0 <= r["score"] <= 1 for r in scores)
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    assert {r["doc_id"]: r["n_words"] for r in quality.quality_rules(docs, path).collect()} == n


def test_bands_are_numpys_quartiles(spark):
    rng = np.random.default_rng(7)
    rows = [(k % 2 and "xx" or "yy", 5 + k % 3, 10, *(float(x) for x in rng.gamma(2.0, 1.0, 3))) for k in range(900)] + [("zz", 5, 10, 1.0, 0.0, 2.0)] * 20 + [("yy", 5, 0, 9.0, 9.0, 9.0)]
    frame = make(spark, rows, "lang string, size int, n_tokens long, chars_per_token double, byte_share double, entropy double")
    got = {(r["lang"], r["size"], r["measure"]): (r["low"], r["high"]) for r in quality.bands(frame, 4.0).collect()}
    want = {}
    for lang in ("xx", "yy", "zz", None):
        for size in (5, 6, 7, None):
            mine = [r for r in rows if r[2] and lang in (r[0], None) and size in (r[1], None)]
            if len(mine) < quality.LEAST and (lang or size):
                continue
            for i, m in enumerate(quality.MEASURES):
                low, mid, high = np.quantile(np.round([r[3 + i] / quality.STEP for r in mine]) * quality.STEP, [0.25, 0.5, 0.75], method="inverted_cdf")
                wide = lambda side, m=m, mid=mid: 4.0 * max(abs(side - mid) / 0.6745, quality.FLOOR[m])
                want[lang, size, m] = mid - wide(low), mid + wide(high)
    assert got.keys() == want.keys() and len(want) == 3 * 12
    assert all(np.allclose(got[k], want[k], atol=1e-9) for k in want)


def test_near_dedup_steps_forget_models():
    steps = [simhash._meetings(0.8), simhash._star_meetings(0.8), simhash._block_meetings(0.8, None)]
    for step in steps:
        common.resident("a model", lambda: object())
        assert list(step(iter(()))) == [] and not common._residents
