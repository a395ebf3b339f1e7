"""Ids of whole texts by a public byte-level BPE vocabulary file.

The vocabulary file fixes the ids; ``tiktoken`` runs the merges (the ids of a
byte-level vocabulary are its merge ranks). Over every Unicode code point, in
several contexts, this gives the ids of the library the file belongs to; the
tests repeat the comparison on texts. Special strings inside a text become
their special id, that library's default.

The pattern backtracks over a run of white space, which overflows the regex
engine's stack at about a million characters. Long runs are therefore cut by
the pattern's own rule and merged without it: the pre-token is the run without
its last character if something other than white space follows, else the run.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

# the byte-level pre-token pattern of this vocabulary (fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LONG_RUN = 10_000  # white space characters from which a run is merged apart

_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # the pattern's \s


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        back = _byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {bytes(back[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self._enc = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=self.strings, special_tokens=self.special)
        self._is_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self._long_run = re.compile(f"(?<![{_WHITE}])[{_WHITE}]{{{LONG_RUN},}}")

    def has_special(self, text: str) -> bool:
        return self._is_special.search(text) is not None

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text."""
        if len(text) >= LONG_RUN and self._long_run.search(text):
            return self._ids_around_runs(text)
        if self.has_special(text):
            return self._enc.encode_to_numpy(text, allowed_special="all")
        return np.asarray(self._enc.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def _ids_around_runs(self, text: str) -> np.ndarray:
        out, at = [], 0
        for special in [*self._is_special.finditer(text), None]:  # texts between special strings stand alone
            part = text[at: special.start() if special else len(text)]
            done = 0
            for run in self._long_run.finditer(part):
                upto = run.end() - (run.end() < len(part))
                out.append(self._enc.encode_to_numpy(part[done: run.start()], disallowed_special=()))
                out.append(self._enc._encode_single_piece(part[run.start(): upto]))
                done = upto
            out.append(self._enc.encode_to_numpy(part[done:], disallowed_special=()))
            if special:
                out.append([self.special[special[0]]])
                at = special.end()
        return np.concatenate([np.asarray(x, np.uint32) for x in out])

    def plain_ids(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text in which special strings are plain text."""
        out, done = [], 0
        for run in self._long_run.finditer(text) if len(text) >= LONG_RUN else ():
            upto = run.end() - (run.end() < len(text))
            out += [self._enc.encode_to_numpy(text[done: run.start()], disallowed_special=()),
                    self._enc._encode_single_piece(text[run.start(): upto])]
            done = upto
        out.append(self._enc.encode_to_numpy(text[done:], disallowed_special=()))
        return np.concatenate([np.asarray(x, np.uint32) for x in out])

    def count(self, text: str) -> int:
        return len(self.ids(text))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)
