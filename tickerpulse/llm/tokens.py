"""Token ids of whole texts by the tokenizers library, part by part.

Byte-level and word BPE vocabularies never merge across certain places of a text: before a blank that
a visible character follows, and between letters or digits and signs. A text of plain letters, digits
and signs is split at all of these, any other only before blanks. The strings of special tokens are cut out
of the text first, as the tokenizer does, and stand for their ids. The ids of the parts, joined, are
the ids of the text (the tests compare both). Parts recur far more often than they differ: each is
encoded once per worker and afterwards looked up. A vocabulary that lower-cases and drops blanks keeps runs of
letters, digits and runs of signs apart as words: those of a plain text need no normalizing, so the library's model is
asked for their ids.
"""

from __future__ import annotations

import array
import os
import re
import sys

_SPLIT = re.compile(r"(?=(?<!^) \S)")
_CUT = re.compile(r"(?<=\S) (?=[A-Za-z])")
# Signs without the apostrophe, which joins letters in the vocabularies' patterns.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9 \n.,:;!?()\[\]|*%$&#@/<>=+\"-]+")
_PARTS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ0-9]+|(?: (?![A-Za-zÀ-ÖØ-öø-ÿ0-9])|[^A-Za-zÀ-ÖØ-öø-ÿ0-9 ])+")
_WORDS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n]+")  # of a plain text in lower case
KEPT_PARTS = 800_000  # held by a worker; beyond them it starts anew, which changes no result
KEPT_WORDS = 400_000  # likewise
LONGEST_KEPT = 100  # characters; longer ones hardly recur
PIECE = 1 << 20  # characters of a very long text that are split at a time
_ENCODERS: dict[str, "Encoder"] = {}


class _Parts(dict):
    """Ids of parts, which the tokenizer encodes when they are first asked for."""

    def __init__(self, tokenizer, kept: int):
        self.tokenizer, self.kept = tokenizer, kept

    def ids(self, part: str) -> list[int]:
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def __missing__(self, part: str) -> bytes:
        ids = array.array("I", self.ids(part))
        if sys.byteorder == "big":
            ids.byteswap()
        data = ids.tobytes()
        if len(part) <= LONGEST_KEPT:
            if len(self) >= self.kept:
                self.clear()
            self[part] = data
        return data


class _Words(_Parts):
    """Ids of words, by the tokenizer's model."""

    def __init__(self, tokenizer, kept: int):
        super().__init__(tokenizer, kept)
        self.model, self.cut = tokenizer.model, tokenizer.pre_tokenizer

    def ids(self, part: str) -> list[int]:
        cuts = [part] if part.isascii() else [x for x, _ in self.cut.pre_tokenize_str(part)]
        return [token.id for x in cuts for token in self.model.tokenize(x)]


class Encoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer, KEPT_PARTS)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.names = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, self.names))})")
        # tokens that look at or change their surroundings: such texts are left whole
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.words = _Words(self.tokenizer, KEPT_WORDS) if self._folds() else None

    def _folds(self) -> bool:
        """Whether plain texts have the ids of their ``_WORDS``, one after the other: asked of a text that has every
        plain character beside its like, a letter, a digit, a blank and a line end."""
        if not self.plain or self.tokenizer.pre_tokenizer is None or any(len(_WORDS.findall(n.lower())) < 2 for n in self.names):
            return False  # a word could be a special string
        every = "".join(c for c in map(chr, range(256)) if _PLAIN.fullmatch(c))
        text, words = every + "".join(f"{c}a{c}{c} {c}\n{c}1{c}" for c in every), _Words(self.tokenizer, KEPT_WORDS)
        return self.tokenizer.encode(text, add_special_tokens=False).ids == [
            i for w in _WORDS.findall(text.lower()) for i in words.ids(w)]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(name in text for name in self.names):
            if not self.plain:
                return self.parts.__missing__(text)
            pieces = self.special.split(text)
            return b"".join(self.parts[x] if i % 2 else self._between(x) for i, x in enumerate(pieces))
        return self._between(text)

    def _between(self, text: str) -> bytes:
        if not text:
            return b""
        if len(text) <= PIECE:
            return self._encode(text)
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + PIECE)
            end = cut.start() if cut else len(text)
            out.append(self._encode(text[at:end]))
            at = end
        return b"".join(out)

    def _encode(self, text: str) -> bytes:
        plain = _PLAIN.fullmatch(text)
        if plain and self.words is not None:
            return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))
        # of several blanks and line ends in a row, what belongs together depends on what follows
        plain = plain and not ("  " in text or "\n\n" in text or " \n" in text)
        parts = _PARTS.findall(text) if plain else _SPLIT.split(text)
        return b"".join(map(self.parts.__getitem__, parts))


def encoder(path: str) -> Encoder:
    """The worker's encoder for the tokenizer file ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
