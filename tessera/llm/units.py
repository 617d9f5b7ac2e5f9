"""Encoding with library tokenizers, each stretch of text once.

Words repeat, tokens do not cross certain blanks, so a text is cut there and every
different stretch goes to the library once a Python worker; a bounded memory holds its
ids. The cuts are exact for the tokenizers they are named after:

* ``words``: for vocabularies that drop white space and tell letters from signs before they
  look for words. Blanks, tabs and line ends belong to no token, and nothing composes
  across them; nor does a run of ASCII letters with an ASCII sign or digit after it.
* ``spaced``: for vocabularies whose words start with their blank. A single blank between
  two characters that are no white space starts a token in any case.

A stretch without such a place stays whole, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Different stretches of a generation of a worker's memory, and the longest one in it.
MOST_UNITS = 400_000
LONGEST_UNIT = 64

_WORDS = re.compile(r"[A-Za-z]++(?![^\x00-\x7f])|[^ \t\n\r]+")
_SPACED = re.compile(r"(?<=\S) (?=\S)")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

words = _WORDS.findall
spaced = _SPACED.split


def lowered(text: str) -> str:
    """A-Z in lower case, for vocabularies that do so anyway; texts that may spell out a
    special token stay as they are."""
    return text if "<|" in text else text.encode().translate(_LOWER).decode()


class Units:
    """What ``encode`` gives for each stretch of some texts, in order.

    encode: from a list of different stretches to one value each. cut: from a text to its
    stretches. Memory has two generations: when the younger one is full it becomes the
    older one, and what is used again moves on, so frequent stretches stay.
    """

    def __init__(self, encode: Callable[[list[str]], list], cut: Callable[[str], list[str]], most: int | None = None):
        self.encode, self.cut, self.young, self.old, self.most = encode, cut, {}, {}, most or MOST_UNITS

    def of(self, texts: list[str]) -> list[list]:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        cuts = [self.cut(t) for t in texts]
        missing = set().union(*cuts) - self.young.keys()
        again = missing & self.old.keys()
        self.young.update((u, self.old[u]) for u in again)
        new = list(missing - again)
        for at in range(0, len(new), 10_000):  # the library's results are large
            part = new[at : at + 10_000]
            self.young.update(zip(part, self.encode(part), strict=True))
        out = [list(map(self.young.__getitem__, units)) for units in cuts]
        for u in new:
            if len(u) > LONGEST_UNIT:
                del self.young[u]
        return out


def load_library(path: str, special_as_text: bool = False):
    """A tokenizer of the tokenizers library, for one thread."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    if special_as_text:
        out.encode_special_tokens = True
    return out
