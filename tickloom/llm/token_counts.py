"""Token counts with a shortcut for words that are one token.

Byte-level BPE works on one pre-token at a time, so a text's count is the sum
over its pre-tokens.  Which strings of the vocabulary encode alone as one token
is proved once per vocabulary by encoding each of them; a pre-token among them
counts 1 without any merging.  Only the others are merged, by the library's
model, and their counts are kept in a memo of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .pretokens import CLASSED_BELOW, OTHERS, as_letters, ranges

#: Pre-tokens beside the whole ones whose counts a worker remembers (about 60 MB).
MEMO = 400_000


class _Counts(dict):
    """Tokens of a pre-token; what is not yet known is merged."""

    def __init__(self, whole: dict[str, int], model):
        super().__init__(whole)
        self.whole, self.model, self.most = whole, model, len(whole) + MEMO

    def __missing__(self, s: str) -> int:
        n = len(self.model.tokenize(as_letters(s)))
        if len(self) >= self.most:
            self.clear()
            self.update(self.whole)
        self[s] = n
        return n


class TokenCounter:
    """Counts as the byte-level tokenizer of a file gives them, without added special tokens.

    Strings of special tokens inside a text are one token each, as is the
    library's default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cut_by_library = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.pre_token = self._expression()
        self.counts = _Counts(self.whole_tokens(), self.tokenizer.model)

    def _expression(self) -> re.Pattern:
        """The public pre-token expression over the library's own letters, numbers and spaces."""
        kind = {}
        for i in range(CLASSED_BELOW):
            kind[i] = next((k for k in "a1!" if len(self.cut_by_library(k + chr(i))) == 1), " ")
        letter, number, space = (ranges(lambda i, k=k: kind[i] == k) for k in "a1 ")
        return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")

    def whole_tokens(self) -> dict[str, int]:
        """Vocabulary strings proved to be one pre-token and one token when alone."""
        ids = list(self.tokenizer.get_vocab(with_added_tokens=False).values())
        strings = [s for s in self.tokenizer.decode_batch([[i] for i in ids]) if s and "�" not in s]
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return {s: 1 for s, e in zip(strings, found, strict=True) if len(e) == 1 and self.cut(s) == [s]}

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not OTHERS.search(text):
            return self.pre_token.findall(text)
        return [text[a:b] for _, (a, b) in self.cut_by_library(text)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        get = self.counts.__getitem__
        if self.special is None or not self.special.search(text):
            return sum(map(get, self.cut(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(get, self.cut(part))) for part in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter for each Python worker, which serves many tasks."""
    return TokenCounter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Number of tokens of each whole text; 0 for null and empty."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            yield pd.Series([c.count(t) for t in texts], dtype="int64")

    return count(text)
