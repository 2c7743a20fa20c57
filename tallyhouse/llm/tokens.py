"""Token ids of texts by a public byte-level vocabulary."""

from __future__ import annotations

import base64
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: The start of a run of whitespace that the ranks' library, whose stack ends at a million, is not given.
_LONG_SPACE = re.compile(r"(?<!\s)\s{100001}")


def special_strings(vocabulary: str) -> list[str]:
    at = f"{vocabulary}.json"
    whole = Tokenizer.from_file(at if "/" in vocabulary else public_tokenizers.path(at))
    return [t.content for t in whole.get_added_tokens_decoder().values()]


class TextEncoder:
    """The ids that the tokenizers library gives without special tokens of its own.

    The vocabulary is stored twice, for two libraries. Texts are coded by its ranks, which takes a third
    of the time; one with the string of a special token, or with over 100,000 whitespace characters in a
    row, goes to the tokenizers library itself.
    """

    def __init__(self, vocabulary: str = "byte_bpe_50k", special: list[str] | None = None):
        """`vocabulary`: a name of the public vocabularies, or the path of its files without their ending.
        `special`: its special tokens' strings, where they are known; the tokenizers library is then
        loaded only for a text that has one."""
        self.at = vocabulary if "/" in vocabulary else str(Path(public_tokenizers.path(f"{vocabulary}.json")).with_suffix(""))
        self.special = special_strings(vocabulary) if special is None else special
        self.whole: Tokenizer | None = None
        with open(f"{self.at}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or (len(text) > 100_000 and _LONG_SPACE.search(text)):
            self.whole = self.whole or Tokenizer.from_file(f"{self.at}.json")
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.encode(text), "<u4")
