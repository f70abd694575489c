"""Token ids of whole texts by a public byte-level vocabulary, for use inside tasks."""

from __future__ import annotations

import base64
import json
import re

_SPACES = re.compile(r"\s\s")
_LOOKAHEAD = r"\s+(?!\S)|"


def ranks_of(path: str) -> dict[bytes, int]:
    """Bytes and rank of every token of a file with lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable bytes as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def tokenizer_file(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special tokens of a byte-level tokenizers file, whose ids follow its merges."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {x["content"]: x["id"] for x in content.get("added_tokens", [])}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}
    return ranks, special


class Encoder:
    """Ids as the tokenizers library gives them for the same vocabulary.

    Strings of special tokens in a text get their ids, as that library does by default. A text
    without two neighbouring white space characters needs no look-ahead in the pattern and is
    split by a simpler one in two thirds of the time.
    """

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], pattern: str):
        import tiktoken
        self.full, self.simple = (
            tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for name, p in (("full", pattern), ("simple", pattern.replace(_LOOKAHEAD, ""))))
        self.ids = special
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def encode(self, text: str) -> list[int]:
        if self.special and self.special.search(text):
            return [i for part in self.special.split(text)
                    for i in ([self.ids[part]] if part in self.ids else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        return (self.full if _SPACES.search(text) else self.simple).encode_ordinary(text)
