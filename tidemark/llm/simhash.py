"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints within ``2r`` bits have a common point within ``r`` bits of
both. Every distinct fingerprint therefore emits all its variants within ``r``
bits; fingerprints that meet on a variant are within ``2r`` bits of each other.

The variants of one fingerprint share most of their bits, so the shuffle does
not carry them one by one: it deals the fingerprint once to each *leading part*
that its variants can have, and the task that owns a leading part forms the
trailing parts there. Members of one variant are linked to the smallest member
only (all of them are within the distance by the triangle inequality), so a
group of n near copies makes about n links, never n * n pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.store import stored

BITS = 64
SEED = 42
#: Variants that one task expands at a time; a larger set is halved bit by bit.
CHUNK = 1 << 19


def text_fingerprint(data: bytes | None, words_per_shingle: int) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles (0 without words).

    ``bytes.lower`` and ``bytes.split`` work on ASCII letters and on the six
    ASCII blanks only, which is the wanted rule.
    """
    from xxhash import xxh64_intdigest as xxh

    words = (data or b"").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), min(words_per_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - n + 1].tolist()
    ends = (ends[n - 1 :] - 1).tolist()
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), 1 << 16):
        part = zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)])
        h = np.array([xxh(line[a:b], SEED) for a, b in part], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """(id, fp): one row per input row, ``fp`` the fingerprint as a signed bigint."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def each(batches):
        for b in batches:
            fp = [text_fingerprint(t, shingle_words) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "fp"])

    return src.mapInArrow(each, f"id {src.schema['id'].dataType.simpleString()}, fp bigint")


def _masks(positions, flips: int) -> list[int]:
    return [sum(1 << p for p in c) for k in range(flips + 1) for c in combinations(positions, k)]


def meet(fps: np.ndarray, used: np.ndarray, free: int, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star links (smallest member, other) of every variant with two or more members.

    ``used`` are the bits each fingerprint has already flipped to get here;
    the lowest ``free`` bits may still be flipped. A set with more than CHUNK
    variants is halved on its highest free bit, so memory stays bounded.
    """
    if len(fps) < 2:
        return []
    left = np.bincount(used, minlength=radius + 1)
    if free and sum(int(n) * sum(comb(free, k) for k in range(radius - u + 1)) for u, n in enumerate(left)) > CHUNK:
        bit = ((fps >> np.uint64(free - 1)) & np.uint64(1)).astype(np.int64)
        out = []
        for want in (0, 1):
            cost = used + (bit != want)
            ok = cost <= radius
            out += meet(fps[ok], cost[ok], free - 1, radius)
        return out
    low = fps & np.uint64((1 << free) - 1)
    values, members = [], []
    for u in np.flatnonzero(left):
        at = np.flatnonzero(used == u)
        masks = np.array(_masks(range(free), radius - int(u)), np.uint64)
        values.append((low[at][:, None] ^ masks).ravel())
        members.append(np.repeat(at, len(masks)))
    value, member = np.concatenate(values), np.concatenate(members)
    order = np.argsort(value)
    value = value[order]
    same = value[1:] == value[:-1]
    meets = np.concatenate((same, [False])) | np.concatenate(([False], same))
    if not meets.any():
        return []
    value, fp = value[meets], fps[member[order[meets]]]
    begin = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    size = np.diff(np.concatenate((begin, [len(value)])))
    root = np.repeat(np.minimum.reduceat(fp, begin), size)
    pairs = np.unique(np.stack((root, fp), axis=1)[root != fp], axis=0)
    return [(pairs[:, 0], pairs[:, 1])]


def links(distinct: DataFrame, max_distance: int = 4) -> DataFrame:
    """``distinct`` (fp) -> (u, v): verified links that connect all fingerprints within ``max_distance`` bits.

    Two fingerprints within the distance are always connected through links of
    this set; not every such pair is listed itself.
    """
    if max_distance % 2 or max_distance < 2:
        raise ValueError("max_distance must be even and at least 2")
    radius = max_distance // 2
    n = distinct.count()
    ball = sum(comb(BITS, k) for k in range(radius + 1))
    # So many leading bits that an evenly filled leading part has about CHUNK variants.
    lead = min(32, max(4, ceil(log2(max(1, n * ball / CHUNK)))))
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in _masks(range(BITS - lead, BITS), radius)]
    dealt = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
        F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), BITS - lead).alias("bucket"), "fp",
        F.bit_count("mask").cast("tinyint").alias("used"))

    def collide(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        found = meet(fp, group.column("used").to_numpy().astype(np.int64), BITS - lead, radius)
        u = np.concatenate([a for a, _ in found] or [np.empty(0, np.uint64)])
        v = np.concatenate([b for _, b in found] or [np.empty(0, np.uint64)])
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    met = dealt.groupBy("bucket").applyInArrow(collide, "u bigint, v bigint")
    return met.distinct().where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                   max_distance: int = 4) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per input row.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_distance`` differing bits, itself included. Other columns are not
    read, so clashing names cannot matter.

    Defined cases: a null or empty text, or one of blanks only, has
    fingerprint zero and is linked like any other. Fewer words than a shingle
    count as one shingle. Repeated rows share a fingerprint and a group. A
    row with a null id is returned and grouped, but never names a group
    (null if its whole group has no id). An empty table gives an empty table.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    # Exact and fingerprint-equal copies are one vertex from here on.
    reps = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-reps")
    roots = connected_components(links(reps.select("fp"), max_distance))
    member = reps.join(roots, reps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = stored(member, "simhash-members")
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = member.join(named, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
