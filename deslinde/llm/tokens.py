"""Token ids of whole texts with a public word tokenizer, through a bounded store of words already seen."""

from __future__ import annotations

import os
import re
import sys
from array import array

#: The vocabulary that packing and counting use; a parameter everywhere.
VOCABULARY = "word_bpe_49k.json"
# Words kept in a worker; at the bound the store starts anew, which changes its speed and never its answers.
MOST_WORDS = 400_000
# Small Latin-1 letters between ASCII marks: the letters are one unit for the tokenizer, and each run of marks another.
_MARKS = "[!-&(-/:-@\\[-`{-~]*"
_SHAPE = re.compile(f"({_MARKS})([a-zß-öø-ÿ]+)({_MARKS})")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if visible, else the next free one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


class WordTokens:
    """Encodes by white-space parted chunks.

    The tokenizer drops white space and never joins what it parts, so a text's ids are its chunks'
    ids one after another; special-token strings in a text are ordinary text. Ids are kept as
    little-endian 32-bit bytes, ready to be joined, cut and hashed.
    """

    def __init__(self, name: str = VOCABULARY, most_words: int = MOST_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.tokenizer.encode_special_tokens = True
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most = most_words

    def _word(self, word: str) -> bytes:
        """The ids of one unit; asks the merges alone, as parting and lower-casing are done."""
        ids = self.words.get(word)
        if ids is None:
            letters = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(_LETTERS)
            ids = self.words[word] = _packed([t.id for t in self.tokenizer.model.tokenize(letters)])
        return ids

    def _learn(self, chunks: set[bytes]) -> None:
        rest = []
        for chunk in chunks:
            found = _SHAPE.fullmatch(chunk.decode("utf-8").lower())
            if found:
                a, word, b = found.groups()
                ids = self._word(word)
                self.chunks[chunk] = (self._word(a) + ids if a else ids) + (self._word(b) if b else b"")
            else:
                rest.append(chunk)
        coded = self.tokenizer.encode_batch_fast([c.decode("utf-8") for c in rest], add_special_tokens=False)
        self.chunks.update((c, _packed(x.ids)) for c, x in zip(rest, coded))

    def pieces(self, raw: bytes) -> list[bytes]:
        """The ids of each chunk of one UTF-8 text."""
        chunks = raw.split()
        known = self.chunks
        if len(known) > self.most:
            self.chunks = known = {}
        if len(self.words) > self.most:
            self.words = {}
        try:
            return [known[c] for c in chunks]
        except KeyError:
            self._learn({c for c in chunks if c not in known})
            return [known[c] for c in chunks]

    def ids(self, raw: bytes) -> bytes:
        return b"".join(self.pieces(raw))

    def count(self, raw: bytes) -> int:
        return sum(map(len, self.pieces(raw))) // 4


_OWN: dict[str, WordTokens] = {}


def shared(name: str = VOCABULARY) -> WordTokens:
    """One store per Python worker."""
    if name not in _OWN:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _OWN[name] = WordTokens(name)
    return _OWN[name]
