import pytest
from pyspark.sql import functions as F

from reelsift.functions import ids, lexicon, matching, text, titles
from reelsift.schema import RELEASES, ensure_columns


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, want", [("ÁÉÍÓÚ Ñ Ç Ü", "aeiou n c u"), ("The.Matrix_1999", "the matrix 1999"), ("  ", ""), (None, ""), ("São", "s o")])
def test_norm(spark, given, want):
    assert one(spark, text.norm(F.col("a")), a=given) == want
    assert text.py_norm(given) == want


def test_norm_unicode(spark):
    assert one(spark, text.norm_unicode(F.col("a")), a="São Tomé") == "sao tome"


def test_names_and_keys(spark):
    name = text.effective_title(F.col("a"), F.col("b"))
    assert one(spark, name, a=" ", b=" x ") == "x"
    assert one(spark, name, a=None, b=None) is None
    assert one(spark, text.title_key(F.col("a")), a=" !! ") is None


def test_token_needs_word_boundaries(spark):
    has = lambda t, k: one(spark, text.has_token(text.norm(F.col("a")), k), a=t)
    assert has("Anal x", "anal") and not has("Analytics", "anal") and not has("", "anal") and not has("x", "")


@pytest.mark.parametrize("q, want", [("2160p", 60), ("UHD", 60), ("1080P", 40), ("240", 10), (None, 0), ("dvd", 0)])
def test_quality_rank(spark, q, want):
    assert one(spark, text.quality_rank(F.col("a")), a=q) == want


def test_spanish(spark):
    es = lambda t, extra=None: one(spark, lexicon.is_spanish(F.col("a"), extra), a=t)
    assert es("SUBS [ES]") and es("Español") and not es("Estonian") and not es(None) and es("con mexicano", "mexicano, x")


def releases(spark, *rows):
    """Rows given as dicts."""
    names = sorted({k for r in rows for k in r})
    kinds = {f.name: f.dataType.simpleString() for f in RELEASES}
    made = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} {kinds[n]}" for n in names))
    return ensure_columns(made, RELEASES)


def test_blocking(spark):
    rows = releases(spark, {"id": 1, "title": "Some XXX film"}, {"id": 2, "title": "xXx 2002"}, {"id": 3, "title": "a", "release_group": "xXxTorrents"}, {"id": 4, "title": "b", "source_tracker": "t 18+"}, {"id": 5, "title": "Analytics"}, {"id": 6, "title": None, "title_text": "porn"}, {"id": 7, "title": "Erotica"}, {"id": 8})
    hit = lambda **k: sorted(r["id"] for r in rows.where(lexicon.blocked(**k)).collect())
    assert hit() == [1, 3, 4, 6]
    assert hit(soft=lexicon.SOFT_TOKENS) == [1, 3, 4, 6, 7]
    assert hit(tokens=("analytics", "")) == []
    assert hit(allow=("some",)) == [3, 4, 6]
    why = {r["id"]: r["r"] for r in rows.select("id", lexicon.block_reason(soft=True).alias("r")).collect()}
    assert why[1] == "blocked:xxx" and why[2] == "allow:xxx 2002" and why[7] == "soft:erotica" and why[8] == ""


def test_work_key(spark):
    rows = releases(
        spark, {"id": 1, "title": "A", "imdb_id": " ", "tmdb_id": 5}, {"id": 2, "title": "The A!", "tmdb_id": 5, "ids_source": "tmdb", "ids_confidence": 0.91},
        {"id": 3, "title": "A", "imdb_id": "tt1", "ids_source": "Manual", "ids_confidence": 0.1}, {"id": 4, "title": " "}, {"id": 5, "mal_id": 7, "kitsu_id": 8},
    )
    assert {r["id"]: r["w"] for r in rows.select("id", ids.work_key().alias("w")).collect()} == {1: "tmdb:5", 2: "t:the a", 3: "imdb:tt1", 4: None, 5: "kitsu:8"}


@pytest.mark.parametrize("given, want, bad", [(" 42 ", 42, False), ("603.5", None, True), ("12 34", None, True), ("", None, False), (None, None, False), ("0", None, True), ("99999999999999999999999", None, True), ("2147483647", 2147483647, False), ("007", 7, False)])
def test_clean_int(spark, given, want, bad):
    v, b = ids.clean_int(F.col("a"))
    assert one(spark, F.struct(v.alias("v"), b.alias("b")), a=given) == (want, bad)


@pytest.mark.parametrize("given, want, bad", [("TT0133093", "tt0133093", False), ("tt", None, True), ("ttx", None, True), (" ", None, False)])
def test_clean_imdb(spark, given, want, bad):
    v, b = ids.clean_imdb(F.col("a"))
    assert one(spark, F.struct(v.alias("v"), b.alias("b")), a=given) == (want, bad)


CASES = [
    ("The.Matrix.1999.1080p.BluRay.x264-AMIABLE", {"title": "The Matrix", "year": 1999, "quality": "1080p", "codec": "x264", "release_group": "AMIABLE", "season": None}),
    ("[SubsPlease] Jujutsu Kaisen - 24 (1080p)", {"title": "Jujutsu Kaisen", "absolute": 24, "release_group": "SubsPlease", "episode": None}),
    ("Show.Name.S02E05.720p-GRP.mkv", {"title": "Show Name", "season": 2, "episode": 5, "quality": "720p", "release_group": "GRP"}),
    ("Show 1x02", {"title": "Show", "season": 1, "episode": 2}),
    ("Show 99x02", {"season": None, "episode": None}),
    ("Dune.Part.Two.2024.2160p", {"title": "Dune Part Two", "year": 2024}),
    ("Serie Temporada 3 Capitulo 7", {"title": "Serie", "season": 3, "episode": 7}),
    ("", {"title": "", "year": None}), (None, {"title": ""}), ("1080p", {"title": "1080p"}),
]


@pytest.mark.parametrize("name, want", CASES)
def test_parse_release(spark, name, want):
    found = one(spark, titles.parse_release(F.col("a")), a=name).asDict()
    assert {k: found[k] for k in want} == want


def test_signals_and_pick(spark):
    assert one(spark, titles.release_signals(F.col("a")), a="The.Matrix.1999.1080p.BluRay.x264-AMIABLE") >= 6
    assert one(spark, titles.release_signals(F.col("a")), a=None) == 0
    assert tuple(one(spark, titles.pick_name(F.col("a"), F.col("b")), a="Matrix", b="Matrix.1999.1080p.x264-GRP")) == ("Matrix.1999.1080p.x264-GRP", "Matrix")
    assert tuple(one(spark, titles.pick_name(F.col("a"), F.col("b")), a=" ", b="x")) == (None, "x")


def test_similarity():
    assert matching.similarity_of("The Matrix", "the matrix!") == 1.0
    assert matching.similarity_of("", "x") == 0.0
    assert matching.similarity_of("The Matrix", "The Matrix Reloaded") == 1.0  # one has all words of the other
    assert matching.similarity_of("abc", "xyz") < 0.4
    a, b = "one two three", "three two four"
    assert abs(matching.similarity_of(a, b) - matching.similarity_of(b, a)) < 1e-12


def test_common_length_against_table():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for a, b in (("kitten", "sitting"), ("", "a"), ("abcabc", "cba"), ("aaaa", "aa"), ("the matrix", "matrix the")):
        assert matching.common_length(a, b) == slow(a, b)


def test_variants(spark):
    v = lambda t: [tuple(x) for x in one(spark, matching.variants(F.col("a")), a=t)]
    assert v("The Lord: of  the Rings") == [("The Lord: of the Rings", False), ("The Lord", False), ("Lord: of the Rings", False), ("The Lord: of the", True), ("The Lord: of", True)]
    assert v(" ") == [] and v(None) == []
    a = one(spark, matching.aggressive_variants(F.col("a")), a="Rocky II 1979 S01E02 x")
    assert a[:3] == ["Rocky II 1979", "Rocky 2 1979 S01E02 x", "Rocky II S01E02 x"]


def test_confidence(spark):
    c = lambda s, q, y, w: one(spark, matching.confidence(F.lit(s), F.lit(q), F.lit(y), F.lit(w)), a="x")
    assert c(0.9, 1999, 1999, False) == 0.94 and c(0.9, 1999, 2000, False) == 0.8 and c(1.0, None, 1999, True) == 0.8 and c(1.0, 1999, 1999, False) == 1.0
