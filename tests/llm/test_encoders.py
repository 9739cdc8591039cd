"""Encoders, token files, packing: against the libraries."""

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from reelsift.llm import packing, pieces, sentence_pieces, token_files  # noqa: E402
from reelsift.llm.pieces import PieceEncoder  # noqa: E402
from reelsift.llm.token_counts import token_counts  # noqa: E402

ODD = [
    "", " ", "\n", "  ", "a", " a", "a ", "a  b", "a   b \n c\n\nd ", "\t\ta\tb", "a\x1cb!\x1c c", "<|endoftext|> a <|endoftext|>b  <|endoftext|>", "it's 'll don't  I'm\n'em", "é̈ ̈x ́y", "Σας ΣΑΣ. İstanbul", "你好 世界　好",
    "BELEDİYESİ, ANKARA İ. VALİ. DENİZLİ! DİKKATİ: Iİ? ıi.", " ".join(chr(i) + m for i in range(0x41, 0x250) if chr(i).isalpha() for m in ".,!?;:"), " ".join("x" + chr(i) + m for i in range(0x41, 0x250) if chr(i).isalpha() for m in ".,!?;:"),
    "\0a \0b", "a\r\nb", "😀 😀😀  x", "naïve x", "\n\na", "a\n\n", "!?\x1c .. \x85 z", None, "<|startoftext|> Hi, you. Don't!", "<|ENDOFTEXT|> <|STARTOFTEXT|>x <|EndOfText|>. A<|endofText|>B", "word " * 20000 + "x" * 3000 + "\n\n tail  " * 3000,
]


def rows(spark, texts, extra=False):
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return made.selectExpr("*", "'z' as n_tokens", "1 as k", "2 as id", "3 as t", "4 as row") if extra else made


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_librarys_ids(name):
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice(" \n\t ab'sTé.1😀 \0|<,") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    enc = PieceEncoder(P.path(name))
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(enc.encode(texts)) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_skip_the_rules(name):
    letters = "".join(c for c in map(chr, range(0x41, 0x250)) if c.isalpha() and c != "\u0130")
    rng = random.Random(1)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) + rng.choice(["", "", ".", "!!", ",%%%", "$$$", ".?!;"]) for _ in range(3000)]
    texts = [" ".join(words), "\n".join(words), *words[:50]]
    enc = PieceEncoder(P.path(name))
    library, seen = enc.tokenizer, []
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]

    class Spy:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return library.encode_batch_fast(texts, **options)

    enc.tokenizer = Spy()
    assert list(enc.encode(texts)) == want
    # runs of marks, and words that begin a text with them; the words have some 20,000 letters
    assert sum(map(len, seen)) < 3000


def test_token_counts(spark):
    enc = PieceEncoder(P.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in token_counts(rows(spark, ODD, extra=True), P.path("byte_bpe_50k.json")).collect()}
    for i, t in enumerate(ODD):
        n = len(enc.tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 512)
    assert token_counts(rows(spark, ODD).limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_perfect_hash():
    keys, seen = np.arange(-500, 4500, dtype=np.int64) * 7919, np.zeros(5000, dtype=np.int64)
    table = token_files.PerfectHash.load(*token_files.PerfectHash.build(keys, seen).dump())
    assert sorted(table.slots(keys, seen).tolist()) == list(range(5000))
    assert len(token_files.PerfectHash.build(keys[:0], seen[:0]).slots(keys[:3], seen[:3])) == 3


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    # small shards and ranges, so that the repeated ids span several
    monkeypatch.setattr(token_files, "SHARD_BYTES", 300)
    monkeypatch.setattr(token_files, "RANGE_BYTES", 3000)
    texts, path = ODD + ODD[:3] + ["again and again"] * 70 + [f"again {i}" for i in range(40)], str(tmp_path / "files")
    docs = rows(spark, texts, extra=True).selectExpr("case when doc_id = 5 then null when doc_id > 25 then 3 else doc_id end as doc_id", "text", "k").repartition(3)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    token_files.write_token_files(docs, P.path("byte_bpe_50k.json"), path)
    assert spark.read.parquet(f"{path}/ranges").where("before > 0").count() > 0
    enc = PieceEncoder(P.path("byte_bpe_50k.json"))
    filed = sorted((token_files.LOWEST if r["doc_id"] is None else r["doc_id"], r["h"], r["text"] or "") for r in docs.selectExpr("*", "xxhash64(coalesce(text, '')) as h").collect())
    want, at, seen = {}, 0, {}
    for key, _, text in filed:
        ids = np.array([*enc.tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        seen[key] = seen.get(key, -1) + 1
        want[key, seen[key]] = (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    monkeypatch.setattr(token_files, "ASKED", 7)
    assert sorted((r["key"], r["occurrence"]) for r in token_files.keys_of(docs).collect()) == sorted(want)
    strangers = spark.createDataFrame([(12345, 0), (3, 9999)], "key long, occurrence long")
    told = lambda keys: {(r["key"], r["occurrence"]): (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_documents(keys, path).collect()}
    assert told(token_files.keys_of(docs).unionByName(strangers)) == want
    one = spark.createDataFrame([(3, 60)], "key long, occurrence long")
    assert told(one) == {(3, 60): want[3, 60]} and told(strangers) == {}
    monkeypatch.setattr(token_files, "NAMED", 0)
    assert told(one) == {(3, 60): want[3, 60]}


def test_token_files_of_nothing(spark, tmp_path):
    docs, path = rows(spark, ODD).limit(0), str(tmp_path / "none")
    token_files.write_token_files(docs, P.path("byte_bpe_50k.json"), path)
    assert token_files.read_documents(token_files.keys_of(docs), path).count() == 0
    assert token_files.read_documents(spark.createDataFrame([(1, 0)], "key long, occurrence long"), path).count() == 0


def plain_differencing(sizes, k):
    """Sums of multiway differencing, by the definition: lists of sums, the two with the largest spread merged largest with least."""
    parts = [([0] * (k - 1) + [x], i) for i, x in enumerate(sizes)]
    tick = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[0][0] - p[0][-1] if k > 1 else 0, p[1]))
        (a, _), (b, _) = parts.pop(0), parts.pop(0)
        parts.append((sorted(x + y for x, y in zip(a, reversed(b), strict=True)), tick))
        tick += 1
    return parts[0][0]


def test_differencing_by_definition():
    rng = np.random.default_rng(3)
    for n, k in [(1, 1), (5, 1), (6, 2), (30, 4), (40, 7), (25, 25), (9, 12)]:
        sizes = rng.integers(1, 400, n)
        window, sums = packing.difference(sizes, k)
        assert sorted(sums.tolist()) == plain_differencing(sizes.tolist(), k)
        assert sorted(np.bincount(window, weights=sizes, minlength=k).tolist()) == sorted(sums.tolist())


def test_rests_above_half_a_window_take_few_rounds(monkeypatch):
    rounds = []
    plain = packing.difference
    monkeypatch.setattr(packing, "difference", lambda sizes, k: rounds.append(k) or plain(sizes, k))
    assert len(set(packing.partition(np.full(2048, 2049), 4096).tolist())) == 2048 and len(rounds) == 1
    rounds.clear()
    window = packing.partition(np.array([1400] * 600 + [2049] * 300), 4096)
    assert np.bincount(window, weights=[1400] * 600 + [2049] * 300).max() <= 4096 and len(rounds) < 16


def test_packing_keeps_every_id_once(spark):
    texts = [*ODD, *["some words here " * 40] * 30]
    got = packing.pack(rows(spark, texts, extra=True), P.path("word_bpe_49k.json"), capacity=256, with_ids=True).toPandas()
    enc = PieceEncoder(P.path("word_bpe_49k.json"))
    for i, t in enumerate(texts):
        mine = got[got.doc_id == i].sort_values("start")
        want = np.array([*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        assert b"".join(mine.ids) == want and set(mine.doc_tokens) == {len(want) // 4}
        assert mine.start.tolist() == (mine.length.cumsum() - mine.length).tolist() and mine.ids_crc32.tolist() == [zlib.crc32(x) for x in mine.ids]
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length
    assert by.sum().max() <= 256 and (by.cumsum() - got.sort_values(["sequence_id", "offset"]).length == got.sort_values(["sequence_id", "offset"]).offset).all()
    assert 1 - got.length.sum() / (256 * got.sequence_id.nunique()) < 0.05


def scanned(model, s):
    """Ids of marked text by the scan; the matrices' product must have the same best score as the way found."""
    chunks = sentence_pieces.chunks_of(s, model.longest)
    matrices = [model.transfer(x, a, b) for a, b, x in chunks]
    at = sentence_pieces.borders(matrices, 0, 0)
    total = matrices[0]
    for m in matrices[1:]:
        total = sentence_pieces.combine(total, m)
    assert total.shape == (1, 1) and abs(total[0, 0] - sum(m[i, j] for m, i, j in zip(matrices, at, at[1:], strict=False))) < 1e-6
    return b"".join(model.encode_marked(model.between(x, a, b, i, j)) for (a, b, x), i, j in zip(chunks, at, at[1:], strict=False))


def strange_texts(n):
    rng = random.Random(1)
    parts = ("the ", "ing", "tion ", " ", "x", "é", "\n", "international", "aaaa", "▁", "\ufdd0", "漢字", "💩", "\0", "0x7f", "  ")
    texts = ["".join(rng.choice(parts) for _ in range(120)) for _ in range(n)]
    return [t.replace(" ", "") if i % 3 == 0 else t for i, t in enumerate(texts)] + [" " * 150, "▁" * 77, "ab" * 90, "\n" * 90, "字" * 99]


def unigram_model(path):
    """A model file put together by hand, with scores that hardly ever tie."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    rng, m = random.Random(4), pb.ModelProto()
    kinds = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256))]
    words = ("▁the", "▁", "the", "ing", "tion", "▁▁", "▁in", "inter", "nation", "national", "al", "aa", "aaa", "ab", "ba", "▁x", "漢", "字", *"theingoxralb0f7")
    for piece, score, kind in [*kinds, *((w, -rng.randrange(1 << 10, 1 << 13) / (1 << 10), 1) for w in words)]:
        added = m.pieces.add()
        added.piece, added.score, added.type = piece, score, kind
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, True
    rules = m.normalizer_spec
    rules.name, rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces = "identity", True, False, True
    path.write_bytes(m.SerializeToString())
    return str(path)


@pytest.mark.parametrize("kind", ["merges", "unigram"])
@pytest.mark.parametrize("chunk", [17, 64])
def test_sentence_pieces_scan_gives_the_librarys_ids(monkeypatch, tmp_path, kind, chunk):
    monkeypatch.setattr(sentence_pieces, "CHUNK", chunk)
    model = sentence_pieces.Pieces(P.path("piece_bpe_32k.model") if kind == "merges" else unigram_model(tmp_path / "u.model"))
    assert model.merges == (kind == "merges")
    for text in strange_texts(40):
        want = np.array(model.model.encode(text), dtype="<u4").tobytes()
        assert model.encode_marked(model.marked(text)) == want
        got = scanned(model, model.marked(text))
        if kind == "unigram" and got != want:  # a tie
            score = lambda ids: sum(model.pieces.get(model.model.id_to_piece(int(i)), (0, 0.0))[1] for i in np.frombuffer(ids, dtype="<u4"))
            assert abs(score(got) - score(want)) < 1e-3
        else:
            assert got == want


def test_sentence_pieces_round_trip(spark, monkeypatch):
    path = P.path("piece_bpe_32k.model")
    monkeypatch.setattr(sentence_pieces, "GIANT", 1 << 13)
    texts = [*ODD, "long and  wide\n" * 5000, "nospaces" * 6000, "nospaces" * 6000, "▁ mark", "字" * 20000]
    docs = rows(spark, texts, extra=True)
    got = {r["doc_id"]: r for r in sentence_pieces.decode(sentence_pieces.encode(docs, path), path).collect()}
    model = sentence_pieces.Pieces(path).model
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert bytes(got[i]["ids"]) == np.array(model.encode(t or ""), dtype="<u4").tobytes() and got[i]["text"] == (t or "").replace("▁", " ")
    repeated = spark.createDataFrame([(None, "a b"), (7, "x"), (7, "x"), (8, None)], "doc_id long, text string")
    encoded = sentence_pieces.encode(repeated, path)
    assert sorted((str(r["doc_id"]), r["text"]) for r in sentence_pieces.decode(encoded, path).collect()) == [("7", "x"), ("7", "x"), ("8", ""), ("None", "a b")]
    assert sentence_pieces.decode(encoded.limit(0), path).count() == 0
    assert sentence_pieces.decode(encoded.selectExpr("doc_id", "cast(null as binary) as ids"), path).where("text is null").count() == 4


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_met_before_stay_in_columns(name, monkeypatch):
    path = str(P.path(name))
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdeéG") for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", ".", "!?", "\n"]) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(40)).replace("\n ", "\n") for _ in range(200)] + ["", "x" * 100, "x " + "y" * 100]
    enc = PieceEncoder(path)
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(enc.encode(texts)) == want
    asked, learn = [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda keys, **more: (asked.extend(keys), learn(keys, **more))[1])
    monkeypatch.setattr(enc, "_look_up", lambda keys: pytest.fail(f"looked up again: {keys[:3]}") if keys else [])
    assert list(enc.encode(texts)) == want and all(len(x) > 99 for x in asked)
    # columns without room, and emptied again and again
    monkeypatch.setattr(pieces, "COLUMN_ENTRIES", 20)
    enc._empty_columns()
    for at in range(0, len(texts), 7):
        assert list(enc.encode(texts[at : at + 7])) == want[at : at + 7]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_closing_marks_and_line_feeds_are_keys_of_their_own(name):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéÿıG") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    ends = ["", ".", ",", "!?", "...", "%%%%", "%%%%%", ".x", "1.", ")."]
    texts = ["".join(rng.choice(words) + rng.choice(ends) + rng.choice("   \n") for _ in range(rng.randrange(80))) for _ in range(300)]
    enc = PieceEncoder(P.path(name))
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    asked, learn = [], enc._learn
    enc._learn = lambda keys, **more: (asked.extend(keys), learn(keys, **more))[1]
    assert list(enc.encode(texts)) == want
    # a word before a mark, or after a line feed, is no key apart from the word
    assert len(asked) == len(set(asked)) and not any(x[-1:] in ".,!?" and x[:-1].isalpha() for x in asked) and not any("\n" in x and x != "\n" for x in asked)
    # what the columns keep fills them to the last place
    small = PieceEncoder(P.path(name))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "COLUMN_ENTRIES", 400)
        assert list(small.encode(texts)) == want and len(small.numbers) == len(small.sizes) == 400
