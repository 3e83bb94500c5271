"""Token ids of a byte-level BPE inside tasks.

``Bpe(json_path, rank_path)`` gives, per text, the ids that the ``tokenizers``
library gives for ``json_path`` with ``add_special_tokens=False`` (a special
token's string in a text is that token).  The merges are done by ``tiktoken``
on the same vocabulary in rank form, several times faster; texts
that hold a special token's string go through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import json
import os


def default_paths() -> tuple[str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken")


class Bpe:
    def __init__(self, json_path: str, rank_path: str):
        import public_tokenizers as p
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("byte-bpe", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        with open(json_path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        self._special = [t["content"] for t in added]
        self.size = max([max(ranks.values()), *(t["id"] for t in added)]) + 1
        self._json, self._exact = json_path, None

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self._special):
            if self._exact is None:  # few texts need it
                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                from tokenizers import Tokenizer

                self._exact = Tokenizer.from_file(self._json)
            return self._exact.encode(text, add_special_tokens=False).ids
        return self._fast(text)


_LOADED: dict[tuple[str, str], Bpe] = {}


def bpe(paths: tuple[str, str]) -> Bpe:
    """One instance per Python worker."""
    if paths not in _LOADED:
        _LOADED[paths] = Bpe(*paths)
    return _LOADED[paths]
