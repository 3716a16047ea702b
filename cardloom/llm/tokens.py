"""Tokenizers inside tasks: the ids of whole texts, with a bounded memory of chunks already encoded.

A text is cut before a single space and around a single line feed that stand between two characters that are not white
space, and before the ASCII punctuation that ends such a chunk after a letter. No pre-token of the two vocabularies used here
spans such a place, so the ids of the chunks, one after the other, are the ids of the text. Chunks repeat a lot; each
distinct one is given to the tokenizers library once per worker while it is remembered.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from collections.abc import Iterable

#: Bytes, about, of each of the two generations of chunks that a worker remembers, what an entry takes beside its text and ids,
#: and the longest chunk that is remembered.
REMEMBERED, ENTRY, LONGEST = 64 << 20, 160, 64

_EDGE = re.compile(r"(?<=\S)(?= \S)")
#: White space but the blank and the line feed; a search for each is faster than one for their class.
_RARE_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A full stop or comma that ends a chunk but does not follow a letter.
_ODD_STOP = re.compile(r"(?<![A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF])[.,][ \n]")
#: The same for texts below U+0100, as kinds of characters: a letter, . stop or comma, blank or line feed, x any other.
_KINDS = bytes(ord("a") if chr(c).isalpha() and c not in (0xAA, 0xB5, 0xBA) else ord(".") if chr(c) in ".," else ord(" ") if chr(c) in " \n" else ord("x")
               for c in range(256))
#: Byte-level vocabularies write a byte as a visible character: itself where printable, else the next one from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
SPACE = chr(BYTE_CHARACTERS[32])


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def odd_stop(text: str) -> bool:
    """Whether a full stop or comma before a blank or line feed follows anything but a letter."""
    try:
        kinds = text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return _ODD_STOP.search(text) is not None
    return b"x. " in kinds or b" . " in kinds or b".. " in kinds or kinds.startswith(b". ")


class ChunkEncoder(dict):
    """Ids of texts as little-endian bytes, 32 or (``kind`` H) 16 bits each, without special tokens added.

    Maps a chunk to its ids. What is looked up and missing is found in the older generation or encoded.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, kind: str = "I"):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.remembered, self.held, self.kind = remembered, 0, kind
        kinds = str(self.tokenizer.pre_tokenizer) + str(self.tokenizer.normalizer)
        self.lower, self.merges = "Lowercase" in kinds, self.tokenizer.model.tokenize
        self.direct = "ByteLevel" in kinds and ("NFC" in kinds) == self.lower
        self.older: dict[str, bytes] = {}

    def _fresh(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, chunk: str) -> bytes | None:
        """Ids of a chunk of letters straight from the library's merge model; None where its normalizer is needed."""
        space = chunk[0] == " "
        word = chunk[1:] if space else chunk
        if not (word.isalpha() and self.direct):
            return None
        if word.isascii():
            word = word.lower() if self.lower else SPACE + word if space else word
        else:
            if self.lower:
                word = "".join([x.lower() for x in unicodedata.normalize("NFC", word)])
                if not word.isalpha():
                    return None
            word = word.encode().decode("latin-1").translate(BYTE_CHARACTERS)
            word = SPACE + word if space and not self.lower else word
        return array(self.kind, [t.id for t in self.merges(word)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._word(chunk) if chunk else b""
        if ids is None:
            stem = chunk.rstrip(string.punctuation)
            if len(stem) < len(chunk) and stem[-1:].isalpha():
                ids = self[stem] + self[chunk[len(stem):]]
            else:
                ids = self._fresh(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
            self.held += ENTRY + len(chunk) + len(ids)
        return ids

    @staticmethod
    def chunks(text: str) -> list[str]:
        odd = ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or "\x00" in text
               or text[0].isspace() or text[-1].isspace() or any(c in text for c in _RARE_BLANKS))
        if odd:
            return _EDGE.split(text)
        if not odd_stop(text):
            # a stop after a letter is a pre-token of its own, so words are remembered without it
            text = text.replace(". ", "\x00. ").replace(", ", "\x00, ").replace(".\n", "\x00.\n").replace(",\n", "\x00,\n")
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and self.added.search(text):
            return self._fresh(text)
        if self.held > self.remembered:
            self.older, self.held = dict(self), 0
            self.clear()
        if self.lower and self.direct:
            # such a vocabulary lowers every letter; below U+0100 that is one letter for one, so variants of a word are one chunk
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.__getitem__, self.chunks(text)))

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        return [self.one(t) for t in texts]


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, kind: str = "I", remembered: int = REMEMBERED):
    """The ``encode`` of this worker's encoder for a vocabulary file, loaded once per worker.

    A file given by a path of the driver's machine is looked up by its name where the worker's installation differs.
    """
    if (path, kind) not in _ENCODERS:
        found = path if os.path.exists(path) else vocabulary(os.path.basename(path))
        _ENCODERS[path, kind] = ChunkEncoder(found, remembered, kind)
    return _ENCODERS[path, kind].encode
