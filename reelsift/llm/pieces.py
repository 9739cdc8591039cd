"""Exact sub-word encoding through a cache of text pieces.

A text is cut where no token of the vocabulary can reach across: before a white-space
character that follows a character which isn't one.  Pre-tokenizers of the two supported kinds
never match across such a place and look only forward, so encoding the pieces one
by one gives the ids of the whole text.  Pieces repeat, so most of a text is looked up
rather than encoded; what isn't known yet is encoded in batches by the tokenizers library.

Most pieces that aren't known are words of letters, which pre-tokenizers leave whole: the model of the
library gets them without normalizer and pre-tokenizer.

The caches have at most ``CACHE_ENTRIES`` and ``COLUMN_ENTRIES`` pieces and pieces above ``CACHED_CHARS`` characters
never enter them, so their memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import resident

CACHE_ENTRIES = 400_000
CACHED_CHARS = 48
#: Keys whose ids are kept in columns, some 150 bytes each with their names: a batch's different words are looked up there, each once.
COLUMN_ENTRIES = 400_000
#: Characters of a text that are handled at a time; longer texts are cut at safe places.
STRETCH = 1 << 18
#: Words that are encoded as one text.
JOINED = 32
#: UTF-8 bytes of texts that are encoded together.
BATCH = 6 << 20

_UNSAFE = re.compile(r"[^\S \t\n\r\f\v]")
_EXACT = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
_CUT = re.compile(r"\S(?=[ \n])")
_MARKS = ".,!?;:#*$%&"
#: Letters below U+0250: all are in normal form, and all but U+0130, left out, have one lower case that every version of Unicode knows.
_LETTER = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
_LETTERS = re.compile(_LETTER + "+")
#: At most four marks that end a word: a letter and a mark never share a token.
_CLOSING = f"({_LETTER})([{_MARKS}]{{1,4}})( |$)"
#: White space that isn't a single space or line feed (there is none beyond U+3000), or U+0000.
_ODD = "[\0" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "]|[ \n][ \n]"
_ODD_TEXT = re.compile(_ODD)


def _byte_letters() -> str:
    """The letter that a byte-level vocabulary writes for each byte: itself if it can be seen, else one from U+0100 on."""
    hidden = [i for i in range(256) if not (0x21 <= i <= 0x7E or 0xA1 <= i <= 0xAC or i >= 0xAE)]
    return "".join(chr(0x100 + hidden.index(i)) if i in hidden else chr(i) for i in range(256))


_BYTES = _byte_letters()


def _runs(sizes: np.ndarray, ids: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` with numbers ``which``: their sizes, and they themselves one after the other."""
    each = sizes[which]
    ends = np.cumsum(each)
    return each, ids[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - each), each) + np.arange(each.sum())]


def _cut_up(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of ids up to each end."""
    raw = ids.tobytes()
    return [raw[a:b] for a, b in pairwise([0, *(4 * ends).tolist()])]


def plain(text: str) -> bool:
    """Whether single spaces and line feeds are the only white space."""
    return _ODD_TEXT.search(text) is None


class PieceEncoder:
    """Ids of whole texts for one vocabulary file of the tokenizers library.

    kind "byte": byte-level pre-tokenizer, where a space belongs to the word after it.
    kind "drop": white space never gets into a token.
    kind "whole": any other; texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = before.get("pretokenizers", [])
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normalizer:
            self.kind = "byte"
        elif steps and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert"):
            self.kind = "drop"
        else:
            self.kind = "whole"
        self.n_ids = self.tokenizer.get_vocab_size()
        # added tokens are found before letters are lower-cased
        added = [x["content"] for x in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added)) or r"[^\s\S]", re.IGNORECASE)
        # words of letters, which no rule cuts, go to the model alone, many with a mark between each two
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # words to encode differ, so the model's own cache would only be searched in vain
        if self.kind != "whole" and hasattr(self.bare.model, "_resize_cache"):
            self.bare.model._resize_cache(0)
        mark = self.bare.encode("!", add_special_tokens=False).ids
        self.mark_id = mark[0] if self.kind != "whole" and len(mark) == 1 and not any(x.isalpha() for x in added) else None
        self.known: dict[str, bytes] = {}
        self.misses = 0
        self._empty_columns()
        # by runs of at most four marks
        self.marks: dict[str, bytes] = {}

    def _empty_columns(self) -> None:
        self.numbers: dict[str, int] = {}
        self.sizes, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4")
        self.unkept = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _as_letters(self, words: list[str]) -> str:
        """Words of letters (some after a space) as the model takes them, all of them ASCII or none, each with a mark after it that isn't a letter."""
        text = "\n!\n".join([*words, ""])
        text = text.lower() if self.kind == "drop" else text
        text = text.replace(" ", _BYTES[32]).replace("\n", _BYTES[10]) if text.isascii() else text.encode().decode("latin-1").translate(_BYTES)
        return text.replace(_BYTES[10], " ")

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of the texts; words of letters are given to the model itself, JOINED at a time."""
        known = [] if self.mark_id is None else [(i, w) for i, w in enumerate(x.removeprefix(" ") for x in texts) if w.isalpha() and len(w) <= CACHED_CHARS]
        fit = [[i for i, w in known if w.isascii()], [i for i, w in known if not w.isascii() and _LETTERS.fullmatch(w)]]
        groups = [x[at : at + JOINED] for x in fit for at in range(0, len(x), JOINED)]
        joined = self.bare.encode_batch_fast([self._as_letters([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, dtype="<u4"), *(np.array(x.ids, dtype="<u4") for x in joined)])
        marks = flat == (self.mark_id if joined else 0)
        order = np.array(fit[0] + fit[1], dtype=np.int64)
        alone = np.setdiff1d(np.arange(len(texts)), order)
        others = self._encode([texts[i] for i in alone.tolist()])
        sizes = np.concatenate([np.diff(np.flatnonzero(marks), prepend=-1) - 1, np.fromiter(map(len, others), dtype=np.int64, count=len(others)) // 4])
        ids = np.concatenate([flat[~marks], np.frombuffer(b"".join(others), dtype="<u4")])
        return _runs(sizes, ids, np.argsort(np.concatenate([order, alone])))

    def _stretches(self, text: str) -> Iterator[str]:
        """A text in parts of about STRETCH characters, each but the first beginning with white space that follows another character."""
        at = 0
        while len(text) - at > STRETCH:
            m = _CUT.search(text, at + STRETCH)
            if not m:
                break
            yield text[at : m.end()]
            at = m.end()
        yield text[at:] if at else text

    def _pieces(self, text: str) -> list[str]:
        """Cache keys, in order.  A key that begins with white space or with U+0000 stands for itself (less the U+0000); else for a space and itself."""
        if self.kind == "drop":
            return [x for x in text.replace("\n", " ").split(" ") if x]
        if self.kind == "whole" or _UNSAFE.search(text):
            return ["\0" + text]
        if plain(text):
            first, *rest = text.replace("\n", " \n").split(" ")
            # a key of "" is a lone space at the end
            return ["\0" + first, *rest] if first else rest
        return [x if x[0].isspace() else "\0" + x for x in _EXACT.findall(text)]

    def _texts(self, keys: list[str]) -> list[str]:
        if self.kind == "drop":
            return keys
        return [x[1:] if x[:1] == "\0" else x if x[:1].isspace() else " " + x for x in keys]

    def _root(self, key: str) -> tuple[str, str]:
        """A key without its closing marks, and those: a letter and a mark never share a token, so most keys need no encoding of their own.

        A letter whose lower case ends in a combining mark (U+0130) is none here: that one and the mark do share a token."""
        mark = ""
        if self.kind != "whole" and key[-1:] in _MARKS and key[:1] != "\0":
            bare = key.rstrip(_MARKS)
            if bare and len(key) - len(bare) <= 4 and bare[-1] < "\u0250" and bare[-1].isalpha() and bare[-1] != "\u0130":
                key, mark = bare, key[len(bare) :]
                if mark not in self.marks:
                    self.marks[mark] = self._encode([mark])[0]
        if self.kind == "drop" and key.isascii() and (key.islower() or not self.added.search(key)):
            key = key.lower()
        return key, mark

    def _recall(self, keys: list[str]) -> list[bytes]:
        """Ids of keys that aren't in the cache; fills it while it has room, and empties it where it no longer fits what comes."""
        roots, marks = zip(*map(self._root, keys), strict=True)
        ids = {r: self.known.get(r) for r in roots}
        fresh = [r for r, v in ids.items() if v is None]
        sizes, joined = self._encode_words(self._texts(fresh))
        new = dict(zip(fresh, _cut_up(joined, np.cumsum(sizes)), strict=True))
        ids |= new
        found = [ids[r] + self.marks[m] if m else ids[r] for r, m in zip(roots, marks, strict=True)]
        self.misses += len(fresh)
        if self.misses > 8 * CACHE_ENTRIES:
            self.known.clear()
            self.misses = 0
        for names, values in ((keys, found), (new, new.values())):
            if len(self.known) + len(names) <= CACHE_ENTRIES:
                self.known.update((k, v) for k, v in zip(names, values, strict=True) if len(k) <= CACHED_CHARS)
        return found

    def _look_up(self, keys: list[str]) -> list[bytes]:
        found = list(map(self.known.get, keys))
        if None in found:
            # each different key once
            gaps = {k: None for k, v in zip(keys, found, strict=True) if v is None}
            gaps = dict(zip(gaps, self._recall(list(gaps)), strict=True))
            found = [gaps[k] if v is None else v for k, v in zip(keys, found, strict=True)]
        return found

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none), encoded in batches balanced by size."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text or "")
            size += len(batch[-1]) if batch[-1].isascii() else len(batch[-1].encode())
            if size >= BATCH:
                yield from self._batch(batch)
                batch, size = [], 0
        if batch:
            yield from self._batch(batch)

    def _bodies(self, texts: list[str]) -> list[str | None]:
        """The cache keys of each text with single spaces between them; None for one that needs :meth:`_pieces`, or has no key."""
        if self.kind == "drop":
            return [x.replace("\n", " ") for x in texts]
        if self.kind == "whole":
            return [None] * len(texts)
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD).to_pylist()
        # a line feed is a key of its own
        return [None if o or not x else (x[1:] if x[0] == " " else x if x[0] == "\n" else "\0" + x).replace("\n", " \n \0").removeprefix(" " if x[0] == "\n" else "") for x, o in zip(texts, odd, strict=True)]

    def _learn(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of keys that no column holds; adds those to the columns while they have room, and empties them where they no longer fit what comes."""
        sizes, ids = self._encode_words(self._texts(keys))
        keep = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys)) <= CACHED_CHARS
        keep &= np.cumsum(keep) <= COLUMN_ENTRIES - len(self.numbers)
        self.numbers.update(zip([keys[i] for i in np.flatnonzero(keep).tolist()], range(len(self.sizes), COLUMN_ENTRIES), strict=False))
        self.sizes, self.ids = np.concatenate([self.sizes, sizes[keep]]), np.concatenate([self.ids, ids[np.repeat(keep, sizes)]])
        self.unkept += len(keys) - int(keep.sum())
        if self.unkept > 8 * COLUMN_ENTRIES:
            self._empty_columns()
        return sizes, ids

    def _together(self, bodies: list[str]) -> list[bytes]:
        """Ids of texts given as keys with single spaces between them: each different key of all of them is looked up once, closing marks apart from their words."""
        apart = pc.replace_substring_regex(pa.array(bodies, pa.large_string()), _CLOSING, "\\1 \0\\2\\3" if self.kind == "byte" else "\\1 \\2\\3")
        texts = pc.split_pattern(apart, " ")
        words = texts.values.dictionary_encode()
        keys = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.numbers.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        sizes, ids = self.sizes, self.ids
        if len(gaps := np.flatnonzero(number < 0)):
            number[gaps] = len(sizes) + np.arange(len(gaps))
            new_sizes, new_ids = self._learn([keys[i] for i in gaps.tolist()])
            sizes, ids = np.concatenate([sizes, new_sizes]), np.concatenate([ids, new_ids])
        each, whole = _runs(sizes, ids, number[words.indices.to_numpy()])
        return _cut_up(whole, np.concatenate([[0], np.cumsum(each)])[texts.offsets.to_numpy()[1:]])

    def _batch(self, texts: list[str]) -> Iterator[bytes]:
        if any(len(t) > STRETCH for t in texts):
            for text in texts:
                if len(text) <= STRETCH or self.kind == "whole" or (self.kind == "byte" and _UNSAFE.search(text)):
                    yield b"".join(self._look_up(self._pieces(text)))
                    continue
                yield b"".join(x for part in self._stretches(text) for x in self._look_up(self._pieces(part)))
            return
        bodies = self._bodies(texts)
        done = iter(self._together([x for x in bodies if x is not None])) if any(x is not None for x in bodies) else iter(())
        for text, body in zip(texts, bodies, strict=True):
            yield next(done) if body is not None else b"".join(self._look_up(self._pieces(text)))


def encoder(path: str) -> PieceEncoder:
    """One encoder for each vocabulary and Python worker."""
    return resident(("pieces", path), lambda: PieceEncoder(path))
