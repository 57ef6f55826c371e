"""Ids of whole texts by a byte-level BPE file of the tokenizers library, and the bytes of its tokens."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import tiktoken

from .token_counts import PRE_TOKEN, special_strings

#: A rank engine takes a run of white space recursively; longer runs go to the tokenizers library, which gives the same ids.
LONGEST_RUN = 50_000

_SPACE = re.compile(r"\s+")


def byte_characters() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for U+0100 and up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteVocabulary:
    """Encodes texts as `tokenizers` does with the file at `path`.

    Where ids are the ranks of the merges (checked here), a rank engine does the work several times faster; a file of another make is
    read by the tokenizers library alone."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        special_strings(path)  # refuses added tokens with matching rules
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.plain, self.special = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        alphabet = byte_characters()
        model = spec["model"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*model["vocab"].values(), *added.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, k in model["vocab"].items():
            self.bytes_of[k] = bytes(map(alphabet.__getitem__, token))
        for token, k in added.items():
            self.bytes_of[k] = token.encode()
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        splits = spec.get("pre_tokenizer") or {}
        ranked = (
            model["type"] == "BPE" and spec.get("normalizer") is None and splits.get("type") == "ByteLevel" and splits.get("use_regex")
            and not splits.get("add_prefix_space") and not any(model.get(x) for x in ("dropout", "unk_token", "ignore_merges", "byte_fallback"))
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and all(model["vocab"].get(m) == 256 + n for n, m in enumerate(merged)))
        self.ranks = None
        if ranked:
            ranks = {self.bytes_of[k]: k for k in model["vocab"].values()}
            self.ranks = tiktoken.Encoding("ranks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str, specials: bool = True) -> np.ndarray:
        """Ids of the whole text; special strings in it are single tokens, or plain text if not `specials`."""
        long_run = len(text) > LONGEST_RUN and any(m.end() - m.start() > LONGEST_RUN for m in _SPACE.finditer(text))
        if self.ranks is None or long_run:
            ids = (self.special if specials else self.plain).encode(text, add_special_tokens=False).ids
            return np.array(ids, np.uint32)
        if specials:
            return self.ranks.encode_to_numpy(text, allowed_special="all")
        return self.ranks.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    """One vocabulary a Python worker, kept over its tasks."""
    return ByteVocabulary(path)
