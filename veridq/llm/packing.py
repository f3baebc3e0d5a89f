"""Sequence packing: first-fit decreasing in randomised groups of documents.

``cut`` turns each document into ids plus an end id and cuts it into pieces of at
most ``size`` tokens: full pieces, then the rest.  ``pack`` numbers full pieces as they
are, each a sequence, and deals the rest, at most one piece of a document, to groups by a
hash of their document; in each group it puts them, longest first, into the first
sequence with room; a tournament tree over the sequences' free capacities finds it in
logarithmic time.  Groups hold about ``group_pieces`` pieces whatever the input, so the
work is linear and a group fits in a task.  Only sizes are shuffled, never ids.

Edge cases: a null or empty text is one piece holding the end id; repeated rows are
packed each for itself; rows with a null id are packed like others; an empty table
gives no rows; further input columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veridq.llm.bpe import rank_encoder
from veridq.llm.common import arrow_map, materialise, ship

SIZE = 2048
GROUP_PIECES = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"


class Tournament:
    """Free capacity of bins; the leftmost bin with enough room in O(log n)."""

    def __init__(self, bins: int, capacity: int):
        self.n = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.n)

    def first(self, need: int) -> int:
        free, i = self.free, 1
        while i < self.n:
            i *= 2
            if free[i] < need:
                i += 1
        return i - self.n

    def take(self, b: int, need: int) -> None:
        free, i = self.free, b + self.n
        free[i] -= need
        while i > 1:
            i //= 2
            most = max(free[2 * i], free[2 * i + 1])
            if free[i] == most:
                break
            free[i] = most


def first_fit_decreasing(lengths, size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; ties go by position in ``lengths``."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    tree = Tournament(len(lengths), size)
    for i in order:
        b = tree.first(lengths[i])
        bins[i], offsets[i] = b, size - tree.free[b + tree.n]
        tree.take(b, lengths[i])
    return bins, offsets


def cut(docs: DataFrame, path: str, size: int = SIZE, end_id: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of each document: doc_id, start, length, ids_crc32, doc_tokens, deal."""

    def make():
        enc, end, step = rank_encoder(path), int(end_id).to_bytes(4, "little"), 4 * size

        def fn(ids, texts):
            rows = [], [], [], [], [], []
            for d, t in zip(ids, texts, strict=True):
                got = enc.encode(t) + end
                whole = zlib.crc32(got)
                for at in range(0, len(got), step):
                    part = got[at : at + step]
                    for col, v in zip(rows, (d, at // 4, len(part) // 4, zlib.crc32(part), len(got) // 4, whole), strict=True):
                        col.append(v)
            return dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"), rows, strict=True))

        return fn

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), make, PIECES, "doc_id", "text")


def pack(pieces: DataFrame, n_docs: int, size: int = SIZE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.  ``n_docs`` sets the number of groups."""
    ship(pieces.sparkSession)
    groups = max(1, -(-n_docs // group_pieces))
    pieces = materialise(pieces, "packing-pieces")
    # numbers above those of the groups
    whole = pieces.where(F.col("length") >= size).drop("deal").withColumn("sequence_id", F.lit(groups << 32) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = pieces.where(F.col("length") < size).withColumn("g", F.pmod(F.xxhash64("doc_id", "deal", "doc_tokens"), F.lit(groups)))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_group(pdf, size)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return whole.unionByName(dealt.groupBy("g").applyInPandas(one, kind))


def pack_group(pdf: pd.DataFrame, size: int) -> pd.DataFrame:
    """One group, first-fit decreasing."""
    pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    bins, offsets = first_fit_decreasing(pdf["length"].tolist(), size)
    out = pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].copy()
    out["sequence_id"] = (int(pdf["g"].iloc[0]) << 32) + np.array(bins, dtype=np.int64)
    out["offset"] = np.array(offsets, dtype=np.int64)
    return out


def padding(packed: DataFrame, size: int = SIZE) -> DataFrame:
    """Sequences, tokens and padding; a sequence whose length is a power of two has none."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.expr("bit_count(used) = 1")
    return used.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("used").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(size - F.col("used"))).alias("padding"),
    )


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, end_id: int = 1) -> DataFrame:
    """Cut and pack ``docs``: one row per piece."""
    return pack(cut(docs, path, size, end_id), docs.count(), size)
