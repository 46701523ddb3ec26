"""Public tokenizers with a cache over independent stretches of text.

A vocabulary file's pre-tokenizer never looks across certain white space, so
the ids of a text are the ids of the stretches between, one after another.
Frequent stretches are encoded once per worker; every stretch is encoded by
the tokenizers library itself. Texts for which the cut is not provably
neutral are handed to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

from .common import release, worker_cache

#: White space before a place where texts are cut: then the text is encoded whole.
_UNSAFE = re.compile(r"\s[ \n]")
#: A run of Latin letters, and marks after it (no apostrophe, which may join with letters): separate pre-tokens.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
#: Byte-level vocabularies write each byte as a printable character: itself, or the next one from 256 on.
_UNPRINTABLE = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_SYMBOLS = {b: chr(256 + i) for i, b in enumerate(_UNPRINTABLE)}
#: Entries of the younger half of the cache before it becomes the older half.
ENTRIES = 400_000
_MET = 1 << 22


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _uncuttable(text: str) -> bool:
    """Whether white space stands before a space or line feed in ``text``."""
    if not ("  " in text or "\n " in text or " \n" in text or "\n\n" in text or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text or "\x85" in text or "\xa0" in text):
        try:
            text.encode("latin-1")  # it has no other white space
            return False
        except UnicodeEncodeError:
            pass
    return _UNSAFE.search(text) is not None


class Encoder:
    """Ids of whole texts as little-endian bytes, ``width`` 2 or 4 bytes an id.

    ``ordinary`` makes the strings of special tokens ordinary text. Vocabularies
    either keep white space (byte-level, a word carries the space before it) or
    drop it (word-end symbols); which is found out once from two letters.
    """

    def __init__(self, path: str, width: int = 4, ordinary: bool = False, entries: int = ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if ordinary:
            self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        if width == 2 and size > 65536:
            raise ValueError(f"{size} ids do not fit two bytes")
        self.dtype = {2: "<u2", 4: "<u4"}[width]
        self.code = {2: "H", 4: "I"}[width]
        bare = [i for x in ("a", "b") for i in self._ids([x])[0]]
        self.spaced = self._ids(["a b"])[0] != bare
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.met = bytearray(_MET)
        self.entries = entries
        self.line_feed = self._bytes(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, ids).tobytes() for ids in self._ids(texts)]

    def _keep(self, learnt: dict[str, bytes]) -> None:
        """Take stretches into the cache: all until it is two fifths full, then those met before."""
        if len(self.known) < 2 * self.entries // 5:
            self.known.update(learnt)
            return
        met, older = self.met, self.older
        for p, ids in learnt.items():
            at = hash(p) & (_MET - 1)
            if met[at] or p in older:
                self.known[p] = ids
            else:
                met[at] = 1
        if len(self.known) > self.entries:
            self.older, self.known = self.known, {}
            self.met = bytearray(_MET)

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode stretches that the cache lacks.

        Letters and marks after them are separate pre-tokens. Runs of Latin
        letters, which normalisation changes by case at most, go straight to
        the library's BPE model; all else through its whole pipeline.
        """
        known, older, marks = {}, self.older, self.marks
        tokenize, code, symbols, spaced = self.tokenizer.model.tokenize, self.code, _SYMBOLS, self.spaced
        word = _WORD.fullmatch
        rest = []
        for p in pieces:
            ids = older.get(p)
            if ids is not None:
                known[p] = ids
                continue
            before, space, core = b"", "", p
            if spaced:
                if p[:1] == "\n":
                    before, core = self.line_feed, p[1:]
                elif p[:1] == " ":
                    core = p[1:]
                else:
                    space = symbols[32]
            m = word(core)
            if m is None:
                rest.append(p)
                continue
            run, mark = m.groups()
            ids = (known.get(run) or self.known.get(run)) if mark and (space or not spaced) else None
            if ids is None:
                seen = run if spaced else run.lower()
                if not seen.isascii():
                    seen = seen.encode().decode("latin-1").translate(symbols)
                ids = array(code, [t.id for t in tokenize(space + seen)]).tobytes()
            if mark:
                if mark not in marks:
                    if len(marks) > 10_000:
                        marks.clear()
                    marks[mark] = self._bytes([mark])[0]
                ids += marks[mark]
            known[p] = before + ids
        lead = " " if spaced else ""
        known.update(zip(rest, self._bytes([p if p[:1] == "\n" else p[1:] if p[:1] == " " else lead + p for p in rest]), strict=True))
        return known

    def many(self, texts: list[str | None], group: int = 256) -> Iterator[bytes]:
        """The id bytes of each text in turn; null and empty texts have none."""
        for at in range(0, len(texts), group):
            some = [x or "" for x in texts[at : at + group]]
            if self.spaced:
                whole = [i for i, x in enumerate(some) if _uncuttable(x)]
                # a stretch is white space and what follows; the first has a key of its own
                cut = [x.replace("\n", " \n").split(" ") for x in some]
                for pieces in cut:
                    pieces[0] = " " + pieces[0]
            else:
                whole = []
                cut = [x.replace("\n", " ").split(" ") for x in some]
            skip = set(whole)
            get = self.known.get
            found: list[list | None] = []
            holes: list[list[int]] = []
            new: set[str] = set()
            for i, pieces in enumerate(cut):
                # one look-up a stretch; what is not known is learnt for the group at once
                got = list(map(get, pieces)) if i not in skip else []
                gaps = [k for k, ids in enumerate(got) if ids is None]
                new.update([pieces[k] for k in gaps])
                found.append(got)
                holes.append(gaps)
            if new:
                learnt = self._learn(new)
                for got, gaps, pieces in zip(found, holes, cut, strict=True):
                    for k in gaps:
                        got[k] = learnt[pieces[k]]
                self._keep(learnt)
            out = dict(zip(whole, self._bytes([some[i] for i in whole]), strict=True)) if whole else {}
            for i, got in enumerate(found):
                yield out[i] if i in skip else b"".join(got)


def encoder(path: str, width: int = 4, ordinary: bool = False, entries: int = ENTRIES) -> Encoder:
    """One encoder per worker process and vocabulary; to be asked for at a task's start."""
    key = ("encoder", path, width, ordinary, entries)
    release(key)
    cache = worker_cache()
    if key not in cache:
        cache[key] = Encoder(path, width, ordinary, entries)
    return cache[key]
