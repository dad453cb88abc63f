"""Token ids of whole texts by a tokenizer file, a word at a time.

The tokenizer drops white space and never joins tokens over it, so a text's
ids are those of its blank-separated parts in order. Each distinct part is
given to the tokenizer once and its ids are kept as little-endian unsigned
32-bit bytes. The table lives as long as the Python worker, which runs many
tasks, and is emptied when it is full.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from types import ModuleType

#: Distinct parts a worker keeps, some 200 bytes each.
TABLE = 1_000_000
#: Blanks for Python that are none for the tokenizer's pattern.
_ODD = "\x1c\x1d\x1e\x1f"


class WordCoder:
    """``encode(texts)`` -> the ids of each text as bytes, four to an id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tables = sys.modules.setdefault("_worker_tables", ModuleType("_worker_tables")).__dict__
        if path not in tables:
            tables[path] = Tokenizer.from_file(path), {}
        self.tokenizer, self.known = tables[path]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Exactly the tokenizer's ids, without those it adds around a text."""
        known = self.known
        if len(known) > TABLE:
            known.clear()
        parts = []
        for t in texts:
            if any(s in t for s in self.special) or any(c in t for c in _ODD):
                parts.append(None)  # a special token or an odd blank: the whole text as it is
                continue
            if not unicodedata.is_normalized("NFC", t):
                t = unicodedata.normalize("NFC", t)
            parts.append(t.replace("Σ", "σ").lower().split())
        new = {w for p in parts if p for w in set(p) if w not in known}
        # "word," is "word" and ","; many such parts share the word
        cut = {w: w.rstrip(".,") for w in new}
        cut = {w: c for w, c in cut.items() if c and c != w and c[-1].isalpha()}
        ask = {c for c in cut.values() if c not in known} | {w[len(c):] for w, c in cut.items()} | {w for w in new if w not in cut}
        ask = [w for w in ask if w not in known]
        known.update(zip(ask, self._ids(ask)))
        known.update({w: known[c] + known[w[len(c):]] for w, c in cut.items()})
        whole = iter(self._ids([t for t, p in zip(texts, parts) if p is None]))
        return [next(whole) if p is None else b"".join(map(known.__getitem__, p)) for p in parts]
