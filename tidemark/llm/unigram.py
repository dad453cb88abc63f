"""Unigram tokenisation: Viterbi search over a double-array trie of scored pieces.

White space is marked with U+2581 and one mark is put before a text; characters
no piece covers are written as byte pieces. No piece has a mark after another
character, so the best path of a text is made of the best paths of its parts
between marks; distinct parts are searched together, position by position.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import Shared

MARK = "▁"
#: Below the least piece's log score: what one uncovered character costs.
UNKNOWN = 10.0
#: Distinct parts a task keeps; bytes above which a part is searched on its own.
TABLE, LONG = 500_000, 48


class Pieces:
    """A vocabulary as plain arrays: strings, log scores, and the trie over the strings' bytes.

    ``base``/``check`` are the double array: byte c leads from state s to
    t = base[s] + c if check[t] == s. ``piece[s]`` is the id that ends at s.
    """

    def __init__(self, strings: list[str], scores: list[float], normal: list[bool], byte_ids: list[int]):
        self.strings, self.byte_ids = strings, byte_ids
        self.scores = np.array(scores, np.float64)
        self.unknown = min((s for s, ok in zip(scores, normal) if ok), default=0.0) - UNKNOWN
        for s, ok in zip(strings, normal):
            if ok and MARK in s.lstrip(MARK):
                raise ValueError("a piece has a mark after another character")
        # characters that are in no longer piece part a text like marks do
        self.alone = "\n" not in "".join(s for s, ok in zip(strings, normal) if ok and len(s) > 1)
        self._build({s.encode(): i for i, (s, ok) in enumerate(zip(strings, normal)) if ok})

    def _build(self, keys: dict[bytes, int]) -> None:
        nodes, ends = [{}], [-1]
        for key, i in keys.items():
            at = 0
            for c in key:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][c]
            ends[at] = i
        size = 2 * len(nodes) + 1024
        self.base, self.check, self.piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        slot, todo, low, wide = {0: 0}, [0], 1, 1
        while todo:
            following = []
            for node in todo:
                s, kids = slot[node], sorted(nodes[node].items())
                self.piece[s] = ends[node]
                if not kids:
                    continue
                if len(kids) == 1:  # any free slot will do: the lowest
                    while taken[low] or low < kids[0][0]:
                        low += 1
                    base = low - kids[0][0]
                else:  # the next place where all children fit
                    codes, fits = np.array([c for c, _ in kids]), None
                    while fits is None or not fits.any():
                        window = np.arange(wide, wide + 64)
                        if wide + 1024 > len(taken):
                            more = len(taken)
                            taken = np.concatenate((taken, np.zeros(more, bool)))
                            self.base, self.check, self.piece = (
                                np.concatenate((a, np.full(more, v, np.int32))) for a, v in ((self.base, 0), (self.check, -1), (self.piece, -1)))
                        fits = ~taken[window[:, None] + codes].any(axis=1)
                        wide += 0 if fits.any() else 64
                    base = int(window[fits.argmax()])
                self.base[s] = base
                for c, kid in kids:
                    slot[kid] = base + c
                    taken[base + c] = True
                    self.check[base + c] = s
                    following.append(kid)
            todo = following
        self.base, self.check, self.piece = (np.concatenate((a, np.full(256, v, np.int32))) for a, v in ((self.base, 0), (self.check, -1), (self.piece, -1)))

    def best_paths(self, parts: list[bytes]) -> list[list[int]]:
        """The ids of the best path of each part; all parts are searched at once.

        Of equal paths the one whose last piece is longest is taken, and so on backwards.
        """
        if not parts:
            return []
        m, width = len(parts), max(map(len, parts))
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(m, width).astype(np.int32)
        size = np.array([len(p) for p in parts])
        best = np.full((m, width + 1), -np.inf)
        best[:, 0] = 0.0
        came, by = np.zeros((m, width + 1), np.int32), np.full((m, width + 1), -1, np.int32)
        lead = text[:, :]
        char = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        for i in range(width):
            row = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
            if not len(row):
                continue
            start = best[row, i]
            end1 = i + char[row, i]
            whole = np.zeros(len(row), bool)
            live, state = np.arange(len(row)), np.zeros(len(row), np.int32)
            for j in range(i, width):
                at = row[live]
                inside = size[at] > j
                live, at, state = live[inside], at[inside], state[inside]
                nxt = self.base[state] + text[at, j]
                ok = self.check[nxt] == state
                live, at, state = live[ok], at[ok], nxt[ok]
                if not len(live):
                    break
                piece = self.piece[state]
                hit = piece >= 0
                if hit.any():
                    h, r, p = live[hit], at[hit], piece[hit]
                    whole[h[end1[h] == j + 1]] = True
                    score = start[h] + self.scores[p]
                    up = score > best[r, j + 1]
                    r = r[up]
                    best[r, j + 1], came[r, j + 1], by[r, j + 1] = score[up], i, p[up]
            lost = np.flatnonzero(~whole)
            if len(lost):
                r, e = row[lost], np.minimum(end1[lost], width)
                score = start[lost] + self.unknown
                up = score > best[r, e]
                r, e = r[up], e[up]
                best[r, e], came[r, e], by[r, e] = score[up], i, -1
        out = []
        came, by = came.tolist(), by.tolist()
        for k, part in enumerate(parts):
            ids, at = [], len(part)
            while at:
                begin, p = came[k][at], by[k][at]
                ids.extend([p] if p >= 0 else [self.byte_ids[c] for c in reversed(part[begin:at])])
                at = begin
            out.append(ids[::-1])
        return out


class Coder:
    """``encode`` and ``decode`` of whole texts, with a bounded table of parts already searched."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known = pieces, {}
        cut = "\n" if pieces.alone else ""
        self.part = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+|\n")
        byte = {i: bytes([c]) for c, i in enumerate(pieces.byte_ids)}
        self.bytes = [byte.get(i, s.encode()) for i, s in enumerate(pieces.strings)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit bytes."""
        known = self.known
        if len(known) > TABLE:
            known.clear()
        parts = [self.part.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {}
        for p in {w for ps in parts for w in set(ps) if w not in known}:
            new.setdefault(min(len(p.encode()) // 4, LONG), []).append(p)
        for width, words in new.items():
            step = 20_000 if width < LONG else 1
            for k in range(0, len(words), step):
                some = words[k : k + step]
                known.update(zip(some, (np.array(x, "<i4").tobytes() for x in self.pieces.best_paths([w.encode() for w in some]))))
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def decode(self, ids: list[int]) -> str:
        """Pieces and bytes put together, marks as blanks, without the one before the text."""
        table = self.bytes
        text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def load_pieces(path: str) -> Pieces:
    """The pieces of a SentencePiece file with log scores.

    A file that ranks its pieces (scores 0, -1, -2, ...) holds no probabilities;
    they are taken to follow Zipf's law, log p = -log(1 + rank) - log(sum 1 / (1 + rank)).
    """
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    normal = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
    rank = np.array([-sp.get_score(i) for i in range(n)])
    weight = 1 / (1 + np.maximum(rank, 0))
    scores = np.log(weight) - np.log(weight[np.array(normal)].sum())
    byte_ids = [sp.piece_to_id(f"<0x{c:02X}>") for c in range(256)]
    return Pieces([sp.id_to_piece(i) for i in range(n)], scores.tolist(), normal, byte_ids)


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", out_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``out_col`` array<int>: the pieces of the whole text; with
    ``decoded_col`` also the text that these pieces decode to, in the same pass.

    Defined cases: a null or empty text has no pieces; a U+2581 in a text is
    read as a blank; repeated rows are encoded alike; an empty table stays
    empty. Other columns pass through unread; existing ``out_col`` and
    ``decoded_col`` are replaced.
    """
    new = [out_col, *([decoded_col] if decoded_col else [])]
    src = docs.drop(*[c for c in new if c in docs.columns])
    shared, at = Shared(docs, pieces), src.columns.index(text_col)

    def each(batches):
        coder = Coder(shared.get())
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                data = coder.encode([t or "" for t in part.column(at).to_pylist()])
                ends = np.cumsum([0] + [len(d) // 4 for d in data]).astype(np.int32)
                out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(data), "<i4")))]
                if decoded_col:
                    out.append(pa.array([coder.decode(np.frombuffer(d, "<i4").tolist()) for d in data], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*part.schema.names, *new])

    kinds = zip(new, ("array<int>", "string"))
    return src.mapInArrow(each, src.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in kinds]).schema)


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col`` string: the text of the pieces (null for null ids)."""
    src = docs.drop(out_col) if out_col in docs.columns else docs
    shared, at = Shared(docs, pieces), src.columns.index(ids_col)

    def each(batches):
        coder = Coder(shared.get())
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = [None if x is None else coder.decode(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out_col])

    schema = src.select("*", F.lit(None).cast("string").alias(out_col)).schema
    return src.mapInArrow(each, schema)
