"""Distinct-chunk tables: a tokenizer runs once on each distinct chunk of many texts.

A chunk is a stretch of text that no token can leave, so the ids of a text are the ids of its chunks, joined by position.
Each Python worker keeps one table for all its tasks; it is emptied when it has grown over its limit, which changes nothing
but the work done again.
"""

import os
import re
import sys
from array import array
from collections.abc import Callable

#: Entries after which a worker empties its table (about 220 bytes each).
TABLE_ENTRIES = 1_000_000
#: White space to Python, ordinary characters to the tokenizers' patterns: such texts are encoded whole.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Byte-level pieces keep one space before a word; longer white space is split before its last space.
SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")


class ChunkTable:
    """chunk -> value, filled for many chunks at once by ``encode``."""

    def __init__(self, encode: Callable[[list[str]], list], entries: int = TABLE_ENTRIES):
        self.encode, self.entries, self.table = encode, entries, {}

    def fill(self, split: list[list[str]]) -> Callable:
        """Make sure that every chunk has a value; returns the lookup."""
        if len(self.table) > self.entries:
            self.table = {}
        missing = list(set().union(*split).difference(self.table)) if split else []
        if missing:
            self.table.update(zip(missing, self.encode(missing)))
        return self.table.__getitem__


class Ids:
    """Token ids of whole texts as little-endian 32-bit bytes, exactly as the tokenizers library gives them.

    The library's plain call finds special tokens in a text before anything else, so a text is cut at their strings and each
    is a chunk. ``path`` is a tokenizers JSON file; ``chunking`` is "spaced" for byte-level vocabularies that keep spaces,
    "words" for vocabularies that drop white space.
    """

    def __init__(self, path: str, chunking: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        #: Tokens found in another way than as they stand: then every text is encoded whole.
        self.whole = any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added)
        strings = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        self.split = SPACED.findall if chunking == "spaced" else str.split
        self.table = ChunkTable(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = [array("I", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for ids in out:
                ids.byteswap()
        return [ids.tobytes() for ids in out]

    def _chunks(self, text: str) -> list[str] | None:
        """The chunks of a text; None if it must be encoded whole."""
        # plain searches for each are ten times faster than one for a pattern
        if self.whole or any(c in text for c in ODD_SPACE):
            return None
        if self.special is None or not self.special.search(text):
            return self.split(text)
        return [c for i, part in enumerate(self.special.split(text)) for c in ([part] if i % 2 else self.split(part))]

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        get = self.table.fill([s for s in split if s is not None])
        return [self._encode([t])[0] if s is None else b"".join(map(get, s)) for s, t in zip(split, texts)]


_KEPT: dict[tuple, object] = {}


def kept(kind: Callable, *args):
    """``kind(*args)``, made once in each Python worker, which runs many tasks."""
    key = (kind.__name__, *args)
    if key not in _KEPT:
        _KEPT[key] = kind(*args)
    return _KEPT[key]
