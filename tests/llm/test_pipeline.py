"""The stages of the corpus pipeline, each on its own input: odd rows, clashing columns, empty tables; near copies against brute force."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as cp  # noqa: E402

KINDS = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, t string"
WORDS = "the of and house river morning people water light small great under between paper garden winter stone table letter open".split()


def docs_of(spark, rows):
    """Rows (doc_id, text) as documents, with columns that are called like those the operators make."""
    return spark.createDataFrame([(i, t, "en" if k % 3 else None, "web", None if t is None else len(t), f"r{k}", 7, "t") for k, (i, t) in enumerate(rows)], KINDS)


def prose(rng, n=80):
    return " ".join(rng.choices(WORDS, k=n))


def folder(spark, tmp_path, docs, labels):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_toxicity_stage(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, prose(rng) + (" zugk zugkor zugkam zugk" if i % 5 == 0 else "")) for i in range(400)] + [(None, prose(rng)), (1000, None), (1001, ""), (1002, " \n "), (3, prose(rng)), (3, prose(rng))]
    docs = docs_of(spark, rows)
    sf_dir = folder(spark, tmp_path, docs, [(i, 1, int(i % 5 == 0)) for i in range(400)] + [(None, 1, 1), (5, None, None)])
    kept = cp.drop_toxic(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    got = [r["row"] for r in kept.collect()]
    bad = {f"r{i}" for i in range(0, 400, 5)}
    assert len(got) == len(set(got)) and len(bad & set(got)) <= 2 and len(set(got) - bad) >= 324
    assert cp.drop_toxic(spark, docs.limit(0), sf_dir).count() == 0


def test_quality_stage(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng)) for i in range(120)] + [(7, prose(rng, 60))] * 2 + [(None, prose(rng)), (900, None), (901, ""), (902, "too few words"), (903, "same again here " * 60), (904, prose(rng, 60) + " " + "日本語" * 900)]
    docs = docs_of(spark, rows)
    kept = cp.drop_poor(spark, docs, "")
    assert kept.columns == docs.columns
    got = [r["row"] for r in kept.collect()]
    clean = {f"r{k}" for k, (i, _) in enumerate(rows) if i is None or i < 900}
    assert len(got) == len(set(got)) and not set(got) - clean and len(clean - set(got)) <= 3
    assert cp.drop_poor(spark, docs.limit(0), "").count() == 0


def brute_groups(texts):
    """The least place that each place reaches by similarity of five-word shingles."""
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets, first = [shingles(t) for t in texts], list(range(len(texts)))
    for a, x in enumerate(sets):
        for b in range(a):
            if first[a] != first[b] and (len(x & sets[b]) >= 0.8 * len(x | sets[b]) if x or sets[b] else True):
                old, new = max(first[a], first[b]), min(first[a], first[b])
                first = [new if f == old else f for f in first]
    return first


def test_near_dedup_stage_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(rng.randrange(40, 200))] for _ in range(60)]
    texts = [" ".join(w) for w in base]
    for w in base:
        for _ in range(rng.randrange(4)):
            v = list(w)
            at, k = rng.randrange(len(v)), rng.randrange(1, max(2, len(v) // 8))
            v[at : at + k] = [word() for _ in range(rng.randrange(k + 1))]
            texts.append(" ".join(v))
    crowd = [word() for _ in range(150)]
    for _ in range(90):
        v = list(crowd)
        v[rng.randrange(150)] = word()
        texts.append(" ".join(v))
    texts += [None, "", "  ", texts[0], texts[0].upper(), " ".join(base[1] * 300), " ".join(base[1] * 300 + ["end"])]
    docs = docs_of(spark, [(None if k % 11 == 0 else k // 2, t) for k, t in enumerate(texts)])
    docs = docs.repartition(5)
    first = brute_groups(texts)
    kept = cp.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    places = sorted(first[int(r["row"][1:])] for r in kept.collect())
    assert places == sorted(set(first)) and len(places) < len(texts) - 90  # one of each group, and no group is lost
    assert cp.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_packing_stage(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 900))) for i in range(30)] + [(None, "x"), (50, None), (51, ""), (4, prose(rng)), (4, prose(rng))]
    docs = docs_of(spark, rows)
    got = cp.pack_windows(spark, docs, "").toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 4096).all() and got.start.eq(0).sum() == len(rows)
    assert got[got.doc_id.isin([50, 51])].length.tolist() == [1, 1]
    assert cp.pack_windows(spark, docs.limit(0), "").count() == 0


def test_pipeline_on_a_small_folder(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, prose(rng)) for i in range(150)] + [(200 + i, prose(rng) + " zugk zugkor zugkam zugk") for i in range(40)]
    rows += [(300, rows[0][1]), (301, rows[1][1] + " end"), (302, "short"), (303, None)]
    sf_dir = folder(spark, tmp_path, docs_of(spark, rows), [(i, 1, int(i >= 200)) for i, _ in rows[:190]])
    got = cp.run(spark, sf_dir).toPandas()
    ids = set(got.doc_id.tolist())
    assert len(ids & set(range(150))) >= 140 and len(ids & set(range(200, 240))) <= 4 and not ids & {302, 303} and len(ids & {0, 300}) == 1 and len(ids & {1, 301}) == 1
    assert (got.groupby("sequence_id").length.sum() <= 4096).all()
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality rules", "SimHash near-dedup", "packing"]
