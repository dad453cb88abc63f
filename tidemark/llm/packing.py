"""Best-fit packing of documents into fixed-size sequences, in bulk-synchronous rounds.

A round takes the documents of one length band, longest bands first, and all
open gaps. Both are range-sorted by size; the sorted order is dealt over lanes
rank by rank, so every lane holds an even sample of all document lengths and
all gap sizes, in order, whatever lengths are common. Each lane sweeps its
documents from the longest down, and each takes the smallest gap that still
holds it (its successor in the sorted order); where several documents want one
gap, the one of the higher rank has it. A document without a gap opens a new
sequence. Gaps are updated, written to the shared folder, and dealt anew in
the next round.
"""

from __future__ import annotations

import zlib
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.subwords import WordCoder

#: Documents and gaps that one lane sweeps.
LANE_ROWS = 50_000
#: Bands: lengths over 1/2, 1/4, ... of a sequence; the last one takes all below.
BANDS = 6


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): the token ids of whole texts, then ``end_id``,
    cut into pieces of ``capacity`` only where a document is longer."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    end, step = end_id.to_bytes(4, "little"), 4 * capacity

    def each(batches):
        coder = WordCoder(tokenizer)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                at, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(coder.encode(part.column("text").to_pylist())):
                    ids += end
                    for n, s in enumerate(range(0, len(ids), step)):
                        one = ids[s : s + step]
                        at.append(i), piece.append(n), start.append(s // 4), length.append(len(one) // 4), crc.append(zlib.crc32(one))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(each, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def sweep(sizes: list[int], gaps: list[tuple[int, int]], capacity: int, first_new: int):
    """Place ``sizes`` (in rank order) into ``gaps`` (seq, gap): (seq, offset) of each, and all gaps after it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    held = 0
    for seq, gap in gaps:
        room[gap].append(seq)
        held |= 1 << gap
    out, new = [], first_new
    for size in sizes:
        fits = held >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            seq = room[gap].pop()
            if not room[gap]:
                held ^= 1 << gap
        else:
            gap, seq, new = capacity, new, new + 1
        out.append((seq, capacity - gap))
        room[gap - size].append(seq)
        held |= 1 << (gap - size)
    return out, [(seq, gap) for gap, seqs in enumerate(room) for seq in seqs]


def _matcher(capacity: int, band: int):
    """The sweep over one lane: its documents' places, then its gaps after that."""

    def match(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc", "descending"), ("size", "descending"), ("key", "ascending")])
        n = pa.compute.sum(group["doc"]).as_py()
        key, size = group["key"].to_pylist(), group["size"].to_pylist()
        first = ((band + 1) << 56) + (group["lane"][0].as_py() << 28)
        where, after = sweep(size[:n], list(zip(key[n:], size[n:])), capacity, first)
        return pa.table({
            "uid": pa.array(key[:n] + [None] * len(after), pa.int64()),
            "seq": pa.array([s for s, _ in where] + [s for s, _ in after], pa.int64()),
            "offset": pa.array([o for _, o in where] + [None] * len(after), pa.int64()),
            "gap": pa.array([None] * n + [g for _, g in after], pa.int64())})

    return match


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (uid, length in 1..capacity) -> (uid, sequence_id, offset); ``uid`` is unique.

    Offsets are gapless from 0 in each sequence.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    upper = [capacity >> b for b in range(BANDS)]
    band_of = sum((F.col("length") <= u).cast("int") for u in upper) - 1
    items = items.select("uid", "length", band_of.alias("band"))
    counts = dict(items.groupBy("band").count().collect())  # at most BANDS rows
    gaps, placed, n_gaps = None, [], 0
    for band in sorted(counts):
        docs = items.where(F.col("band") == band).select(F.lit(True).alias("doc"), F.col("uid").alias("key"), F.col("length").alias("size"))
        if 2 * (upper[band + 1] + 1 if band + 1 < BANDS else 1) > capacity:  # no two of them fit together, and no gap is open yet
            done = docs.select(F.col("key").alias("uid"), F.monotonically_increasing_id().alias("seq"), F.lit(0).cast("bigint").alias("offset"),
                               (F.lit(capacity) - F.col("size")).alias("gap"))
            done = stored(done, f"pack-{band}")
            placed.append(done.select("uid", "seq", "offset"))
            gaps = done.select("seq", "gap")
        else:
            rows = docs if gaps is None else docs.unionByName(
                gaps.where("gap > 0").select(F.lit(False).alias("doc"), F.col("seq").alias("key"), F.col("gap").alias("size")))
            lanes = max(1, ceil((counts[band] + n_gaps) / LANE_ROWS))
            rows = rows.repartitionByRange(lanes, F.desc("doc"), F.desc("size"), "key").sortWithinPartitions(F.desc("doc"), F.desc("size"), "key")
            # position within the sorted partition, shifted by the partition's number
            at = F.monotonically_increasing_id()
            lane = F.pmod(at.bitwiseAND((1 << 33) - 1) + F.shiftright(at, 33), F.lit(lanes))
            rows = rows.withColumn("lane", lane.cast("bigint"))

            done = stored(rows.groupBy("lane").applyInArrow(_matcher(capacity, band), "uid bigint, seq bigint, offset bigint, gap bigint"), f"pack-{band}")
            placed.append(done.where("uid is not null").select("uid", "seq", "offset"))
            gaps = done.where("uid is null").select("seq", "gap")
        gaps = gaps.where("gap > 0")
        n_gaps = gaps.count()
    out = items.select("uid", F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("offset")).limit(0)
    for p in placed:
        out = out.unionByName(p)
    return out.select("uid", F.col("seq").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document, placed.

    Defined cases: a null text counts as empty, an empty one is the end id
    alone. Repeated rows, and rows with equal or null ids, are documents of
    their own. An empty table gives no rows. Only the two named columns are
    read.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    pieces = stored(pieces, "pack-pieces")
    return pieces.join(pack(pieces.select("uid", "length"), capacity), "uid").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
