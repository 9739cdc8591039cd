"""The identity closure: against union-find, conflicts, and what it fills in the resolver."""

import random

import pytest

from reelsift.operators import identity, resolve

FIELDS = "id long, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int"
CANDIDATE = "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int"
QUEUED = "id long, title string, title_text string, title_alt string, type string"


def roots(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed", range(2))
def test_classes_are_components(spark, seed):
    rng = random.Random(seed)
    edges = [(f"tmdb:{rng.randrange(120)}", f"imdb:tt{rng.randrange(120)}") for _ in range(90)]
    edges += [(f"mal:{i}", f"mal:{i + 1}") for i in range(60)]  # a long chain
    edges += [("kitsu:1", f"anilist:{i}") for i in range(150)]  # a node of many edges
    edges += [("x:1", "x:1"), ("x:2", None), (None, None), edges[0], edges[0][::-1]]
    frame = spark.createDataFrame(edges, "a string, b string").repartition(3)
    assert {r["node"]: r["root"] for r in identity.classes(frame).collect()} == roots(edges)
    assert identity.classes(frame.limit(0)).count() == 0


def test_conflicts_are_told_and_fill_nothing(spark):
    rows = spark.createDataFrame([
        (1, 5, "tt5", None, None, None), (2, None, "tt5", None, 50, None), (3, 6, "tt6", None, None, None), (4, 7, "tt6", None, None, None), (5, None, "  ", None, 8, None), (6, None, None, 9, None, 90),
    ], FIELDS)
    maps = spark.createDataFrame([("50", '{"data":[{"attributes":{"externalSite":"MyAnimeList / anime","externalId":"500"}},{"attributes":{"externalSite":"anilist","externalId":"x"}},{"attributes":{"externalSite":"anilist/anime","externalId":"55"}},{"attributes":{"externalSite":"anilist","externalId":"56"}}]}'), ("z", "{}"), ("8", None), ("9", "no json")], "key string, payload string")
    assert [tuple(r) for r in identity.mapping_ids(maps).where("mal_id is not null").collect()] == [(50, 500, 55)]
    edges = identity.edges_of(rows), identity.edges_of(identity.mapping_ids(maps))
    members = identity.classes(edges[0].unionByName(edges[1]))
    assert [(r["site"], r["n"], r["low"], r["high"]) for r in identity.conflicts(members).collect()] == [("tmdb", 2, "6", "7")]
    known = identity.closure(*edges)
    asked = spark.createDataFrame([
        (1, 5, None, None, None, None), (2, None, None, None, None, 500), (3, 6, None, None, None, None), (4, None, None, None, None, None), (5, 5, None, 77, None, None), (6, 5, None, 9, None, None), (7, None, " ", 9, None, None),
    ], FIELDS)
    got = {r["id"]: tuple(r)[1:] for r in identity.fill(asked, known).collect()}
    assert got[1] == got[2] == (5, "tt5", 55, 50, 500)
    # a conflict, nothing to go by, another number of a site, two works
    assert got[3] == (6, None, None, None, None) and got[4] == (None,) * 5 and got[5] == (5, None, 77, None, None) and got[6] == (5, None, 9, None, None)
    assert got[7] == (None, None, 9, None, 90)


def test_resolver_fills_from_works(spark):
    offered = spark.createDataFrame([
        ("tmdb", "Quillow Bay", None, 71, None, None, None, None), ("omdb", "Something else", None, 71, "tt71", None, None, None),
        ("kitsu", "Varn Odori", None, None, None, None, 31, None), ("jikan", "Elsewhere", None, None, None, None, None, 33), ("imdb", "Nettle Row", None, None, "tt90", None, None, None), ("tmdb", "Far off", None, 90, "tt90", None, None, None), ("tmdb", "Further off", None, 91, "tt90", None, None, None),
    ], CANDIDATE)
    maps = spark.createDataFrame([("31", '{"data":[{"attributes":{"externalSite":"myanimelist/anime","externalId":"33"}},{"attributes":{"externalSite":"anilist","externalId":"35"}}]}')], "key string, payload string")
    known = identity.closure(identity.edges_of(offered), identity.edges_of(identity.mapping_ids(maps)))
    rows = spark.createDataFrame([(1, "Quillow Bay", None, None, "movie"), (2, "Varn Odori", None, None, "anime"), (3, "Nettle Row", None, None, "movie")], QUEUED)
    got = {r["id"]: r.asDict() for r in resolve.resolve(rows, offered, known=known).collect()}
    assert (got[1]["imdb_id"], got[1]["source"], got[1]["outcome"]) == ("tt71", "tmdb", "resolved")
    assert (got[2]["mal_id"], got[2]["anilist_id"], got[2]["source"]) == (33, 35, "kitsu")
    # two tmdb identifiers of one imdb one: a conflict
    assert got[3]["tmdb_id"] is None and got[3]["outcome"] == "partial"

