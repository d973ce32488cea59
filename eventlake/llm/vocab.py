"""Public tokenizer files, found through a parameter and never copied."""

from __future__ import annotations

import importlib
import os

PIECE = "piece_bpe_32k.model"
BYTE = "byte_bpe_50k.tiktoken"
WORD = "word_bpe_49k.json"


def vocabulary(name: str, folder: str | None = None) -> str:
    """The path of a vocabulary file: in ``folder``, or where the installed
    ``public_tokenizers`` package keeps it."""
    return os.path.join(folder, name) if folder else importlib.import_module("public_tokenizers").path(name)


class Recent:
    """A bounded cache in two generations: what is looked up stays."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def fill(self, keys, compute) -> dict:
        """A dict that holds every one of ``keys`` until the next call;
        ``compute(list of missing keys)`` returns their values."""
        new, old = self.new, self.old
        missing = []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    missing.append(k)
        for at in range(0, len(missing), 100_000):
            part = missing[at : at + 100_000]
            new.update(zip(part, compute(part)))
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return new
