"""Likeness in lanes and the search for all alike names, against one pair at a time."""

import random

import numpy as np
import pytest

from reelsift.functions import lanes, matching
from reelsift.operators import fuzzy, resolve

WORDS = ["the", "of", "a", "who", "love", "night"] * 4


def names(seed, n, words=400, typos=3):
    """Invented names, a quarter of them with misspelt words."""
    rng = random.Random(seed)
    pool = ["".join(rng.choices("etaoinshrdlucmfwyp", k=rng.randint(2, 9))) for _ in range(words)] + WORDS
    out = [" ".join(rng.choices(pool, k=rng.choice([1, 2, 2, 3, 3, 4, 7]))) for _ in range(n)]
    for k in range(0, n, 4):
        t = rng.choice(out)
        for _ in range(rng.randint(1, typos)):
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice("abxz e") + t[i + rng.choice([0, 1, 2]) :] or "a"
        out[k] = " ".join(t.split()) or "a"
    return out


def test_lanes_equal_one_pair_at_a_time(monkeypatch):
    a, b = names(1, 900), names(2, 900)
    a += ["", "x", "same", "the who", "long " * 30 + "tail", "abc", "ab" * 80, "q" * 64, "q" * 65]
    b += ["x", "", "same", "who the", "long " * 31 + "tale", "cab", "ba" * 81, "q" * 65, "p" + "q" * 64]
    want = [matching.similarity_of(x, y) for x, y in zip(a, b, strict=True)]
    a, b = [x.strip() for x in a], [x.strip() for x in b]
    assert lanes.similarities(a, b).tolist() == want
    monkeypatch.setattr(lanes, "CELLS", 700)  # long pairs on their own, and small batches
    assert lanes.similarities(a, b).tolist() == want


@pytest.mark.parametrize("least", [0.77, 0.6, 0.9])
def test_no_pair_is_lost(monkeypatch, least):
    monkeypatch.setattr(fuzzy, "PAIRS", 1000)
    held = list(dict.fromkeys(names(3, 2000)))
    asked = list(dict.fromkeys(names(4, 40) + held[::70] + [" ".join(x.replace("e", "i") + "z" for x in t.split()) for t in held[1::90]]))
    i, j, alike = fuzzy.alike_in(fuzzy.Block(asked), fuzzy.Block(held), least)
    got = {(asked[x], held[y]): s for x, y, s in zip(i, j, alike.tolist(), strict=True)}
    want = {}
    for x in asked:
        s = lanes.similarities([x] * len(held), held)
        want |= {(x, held[k]): s[k].item() for k in np.flatnonzero(s >= least)}
    assert got == want and len(want) > len(asked) // 2


def test_alike_names_over_tables(spark, monkeypatch):
    for name, value in (("SHIPPED", 300), ("PACKED", 100), ("SEARCHES", 16), ("NAMES", 32)):
        monkeypatch.setattr(fuzzy, name, value)
    held, asked = names(5, 150), names(6, 20) + names(5, 150)[::8]
    titles = spark.createDataFrame([(x.title() + "!",) for x in held] + [(None,), ("",), ("...",)] + [(held[0],)], "title string").repartition(4)
    searches = spark.createDataFrame([(x.upper(),) for x in asked] + [(None,), (" ",)], "query string")
    got = {(r["search"], r["name"]): r["alike"] for r in fuzzy.alike_names(searches, titles, 0.77).collect()}
    want = {(x, y): s for x in set(asked) for y in set(held) if (s := matching.similarity_of(x, y)) >= 0.77}
    assert got == want
    assert fuzzy.alike_names(searches.limit(0), titles, 0.77).count() == 0 == fuzzy.alike_names(searches, titles.limit(0), 0.77).count()


def test_both_rare_words_misspelt(spark):
    queue = spark.createDataFrame([(1, "Zarkonia Quibbelton of the Night", None, None, "movie"), (2, "The Whu", None, None, "series")], "id long, title string, title_text string, title_alt string, type string")
    offered = spark.createDataFrame([("tmdb", "Zarkonnia Quibelton of the Night", None, 5, None, None, None, None), ("tvmaze", "The Who", None, None, "tt7", None, None, None), ("tvmaze", "The Wheel of the Night", None, None, "tt8", None, None, None)], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    got = {r["id"]: r.asDict() for r in resolve.resolve(queue, offered).collect()}
    assert got[1]["tmdb_id"] == 5 and got[1]["confidence"] > 0.9 and got[2]["imdb_id"] == "tt7"


def test_a_common_name_is_answered_once(spark, monkeypatch):
    """Many rows that ask one name, and many candidates of it: the first in order of identifiers counts, and ties don't multiply rows."""
    queue = spark.range(300).selectExpr("id", "'Love' as title", "cast(null as string) title_text", "cast(null as string) title_alt", "'movie' as type")
    offered = spark.range(1, 200).selectExpr("'tmdb' as provider", "'Love' as title", "cast(null as int) as year", "cast(id as int) as tmdb_id", "cast(null as string) as imdb_id", "cast(null as int) as anilist_id", "cast(null as int) as kitsu_id", "cast(null as int) as mal_id")
    got = resolve.resolve(queue, offered).collect()
    assert len(got) == 300 and {r["tmdb_id"] for r in got} == {1}


def test_rows_of_one_name_differ_by_their_other_names(spark, monkeypatch):
    """Rows of one name and type are asked for as one, and on their own only where that leaves them open."""
    others = [None, "Great Quest", "Great Quest", "Nothing alike"]
    rows = [(i, "Zork", None, o, "movie") for i, o in enumerate(others)] + [(9, "Full House", None, o, "movie") for o in others[:1]] + [(10 + i, "Full House", None, f"Other {i}", "movie") for i in range(5)]
    queue = spark.createDataFrame(rows, "id long, title string, title_text string, title_alt string, type string")
    offered = spark.createDataFrame([("tmdb", "Zork", None, 5, None, None, None, None), ("imdb", "Great Quest", None, None, "tt7", None, None, None), ("tmdb", "Full House", None, 6, None, None, None, None), ("imdb", "Full House", None, None, "tt8", None, None, None)], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    asked = []
    monkeypatch.setattr(resolve, "_questions", lambda named, plain=resolve._questions: asked.append(named.count()) or plain(named))
    got = {r["id"]: (r["tmdb_id"], r["imdb_id"], r["outcome"]) for r in resolve.resolve(queue, offered).collect()}
    assert got == {0: (5, None, "partial"), 1: (5, "tt7", "resolved"), 2: (5, "tt7", "resolved"), 3: (5, None, "partial")} | dict.fromkeys([9, *range(10, 15)], (6, "tt8", "resolved"))
    assert asked == [2]


@pytest.mark.parametrize("slack", [0.0003, 0.1403])
def test_best_names_against_brute_force(spark, monkeypatch, slack):
    for name, value in (("SHIPPED", 3000), ("PACKED", 1000), ("SEARCHES", 64), ("NAMES", 50), ("ROUNDS", ((0, 1), (1, 3), (3, 1 << 62)))):
        monkeypatch.setattr(fuzzy, name, value)
    held = {x: 1 + i % 3 for i, x in enumerate(dict.fromkeys(names(7, 150) + [f"nombre interno {k * 37 % 1000}" for k in range(300)] + ["nombre interno", "interno"]))}
    asked = {x: 1 + i % 3 for i, x in enumerate(dict.fromkeys(names(8, 20) + names(7, 150)[::8] + [f"nombre interno {k}" for k in range(0, 1000, 9)] + ["nombre interno"]))}
    searches = spark.createDataFrame([(x, k, held.get(x, 0), 0.8, slack) for x, k in asked.items()], "x string, kinds int, known int, least double, slack double")
    found = fuzzy.best_names(searches, spark.createDataFrame(list(held.items()), "x string, kinds int")).collect()
    got = {(r["search"], r["name"]): r["alike"] for r in found}
    assert len(got) == len(found)
    pairs = 0
    for x, k in asked.items():
        s = dict(zip(held, lanes.similarities([x] * len(held), list(held)).tolist(), strict=True))
        pairs += sum(v >= 0.8 for v in s.values())
        assert all(s[y] == v for (q, y), v in got.items() if q == x)
        for bit in (1, 2):
            mine = {y: v for y, v in s.items() if v >= 0.8 and k & held[y] & bit}
            assert all((x, y) in got for y, v in mine.items() if v >= max(mine.values()) - slack)
    # a family of alike names doesn't come back whole
    assert len(found) < pairs / (8 if slack < 0.1 else 1)


@pytest.mark.parametrize("paths", [1 << 18, 60])
def test_trees_find_what_brute_force_finds(monkeypatch, paths):
    """A large family of alike names is searched by trees alone, with nothing lost; other searches meet the names block by block."""
    family = [f"nombre interno {k * 37 % 2000}" for k in range(700)]
    odd = ["nombre interno", "interno", "aa aa aa bb", "interno 345 nombre", "x" * 69 + "y", "x" * 70]
    held = {x: 1 + i % 3 for i, x in enumerate(dict.fromkeys(family + names(9, 150) + odd))}
    asked = {x: 1 + i % 3 for i, x in enumerate(dict.fromkeys([f"nombre interno {k}" for k in range(100, 2000, 31)] + names(9, 150)[::9] + names(10, 20) + odd + ["nombre 77 interno", "x" * 64, "x" * 66, "aa bb aa"]))}
    monkeypatch.setattr(fuzzy, "TREES", 1)
    monkeypatch.setattr(fuzzy, "PATHS", paths)

    def best(asked, held, slack):
        groups = fuzzy.grouped([("\n".join(held), np.array(list(held.values()), dtype=np.int32).tobytes())])
        known = np.array([held.get(x, 0) for x in asked])
        found = list(fuzzy.best_of(list(asked), np.array(list(asked.values())), known, np.full(len(asked), 0.8), np.full(len(asked), slack), groups))
        got = {(x, y): s for some in found for x, y, s in zip(*some, strict=True)}
        assert len(got) == sum(len(x) for x, _, _ in found)
        for x, k in asked.items():
            s = dict(zip(held, lanes.similarities([x] * len(held), list(held)).tolist(), strict=True))
            assert all(s[y] == v for (q, y), v in got.items() if q == x)
            for bit in (1, 2):
                mine = {y: v for y, v in s.items() if v >= 0.8 and k & held[y] & bit}
                assert all((x, y) in got for y, v in mine.items() if v >= max(mine.values()) - slack)

    for slack in (0.0003, 0.03):
        best(asked, held, slack)
    # no search of the family is left to the product
    monkeypatch.setattr(fuzzy, "best_in", None)
    best({x: 1 for x in asked if x.startswith("nombre interno ")}, dict.fromkeys(family, 1), 0.0003)
