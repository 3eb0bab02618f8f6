"""What the two tokenizer operators share: cutting texts as a library does, at the speed of one regular expression.

The expression is built from character classes that are read off the library
itself, one character at a time, so on texts of those characters it cuts as the
library does.  Texts with other characters are left to the library.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Characters below are classed; a text with another one goes to the library.
CLASSED_BELOW = 0x3000
OTHERS = re.compile("[^\\x00-\\u%04x]" % (CLASSED_BELOW - 1))


def ranges(inside: Callable[[int], bool]) -> str:
    """The characters below CLASSED_BELOW that are inside, for use in brackets."""
    out, start = [], None
    for i in range(CLASSED_BELOW + 1):
        if i < CLASSED_BELOW and inside(i):
            start = i if start is None else start
        elif start is not None:
            out.append(f"\\u{start:04x}-\\u{i - 1:04x}")
            start = None
    return "".join(out)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves and the rest, in order, for the
    characters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))


def as_letters(s: str) -> str:
    """The UTF-8 bytes of s in the letters of the vocabulary."""
    return s.encode().decode("latin-1").translate(_LETTERS)
