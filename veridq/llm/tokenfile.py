"""Token ids in compressed binary files: an adaptive context-mixing range coder.

A file row is a segment: whole documents in order, their ids in one stream cut into blocks
of ``BLOCK`` ids.  Every block starts from the same state and has a checksum of its ids.
The model predicts an id three times: order 2 and order 1 remember the id that followed the
last two ids (hashed, with a confidence) and the last one, order 0 has the segment's
frequencies, which its header holds.  The weights of the predictions are learnt in the
block, one pair for each confidence and for whether both agree; they drive a range coder with a 64-bit
interval.  All blocks of a segment are coded side by side, each a lane of numpy arrays, so
one step handles an id of every block.

Edge cases: null or empty text is the end id alone; documents with a null id come first;
repeated ids follow each other by their text's hash; an empty table has no segments; further
columns of the input are not read; a damaged block raises an error.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from veridq.llm.bpe import word_encoder
from veridq.llm.common import ship, slices
from veridq.session import new_path

MAGIC = b"VQTB2\0\0\0"
BLOCK = 2048  # ids in a block
LANES = 4096  # blocks in a segment, about
TEXTS = 16_000_000  # characters encoded together, about
SLOTS1, SLOTS2 = 9, 10  # bits of the context tables
HEAD = struct.Struct("<8sIIQII")


class Lanes:
    """The model's state for n blocks, all fresh.

    Order 2 keeps id * 4 + confidence, order 1 the id.  Shares are of 4096 and stay
    between LEAST and MOST; shifts of differences move them towards either."""

    LEAST, MOST = 31, 4064

    def __init__(self, n: int):
        self.at1 = np.arange(n) << SLOTS1  # a lane's own part of each table
        self.at2 = np.arange(n) << SLOTS2
        self.ats = np.arange(n) << 3
        self.t1 = np.zeros(n << SLOTS1, dtype=np.int32)
        self.t2 = np.zeros(n << SLOTS2, dtype=np.int32)
        self.p1 = np.full(n * 8, 1024, dtype=np.int32)
        self.p2 = np.full(n * 8, 1024, dtype=np.int32)
        self.a = np.zeros(n, dtype=np.int64)  # hashes of the last two ids
        self.b = np.zeros(n, dtype=np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of order 2 and 1, and their shares of 4096."""
        self.i2 = (((self.a * 5) ^ self.b) >> 9 & ((1 << SLOTS2) - 1)) + self.at2
        self.i1 = (self.b >> 9 & ((1 << SLOTS1) - 1)) + self.at1
        self.e2, o1 = self.t2.take(self.i2), self.t1.take(self.i1)
        o2 = self.e2 >> 2
        self.c = self.e2 & 3
        self.other = (o1 != o2).astype(np.int32)
        self.s = (self.c * 2 + self.other) + self.ats
        f2 = self.p2.take(self.s)
        self.q1 = self.p1.take(self.s)
        return o2, o1, f2, (self.q1 * (4096 - f2) >> 12) * self.other

    def learn(self, x: np.ndarray, f2: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit2`` and ``hit1``: 1 where the prediction was right, else 0."""
        low, span = self.LEAST, self.MOST - self.LEAST
        self.p2[self.s] = f2 + ((low + hit2 * span - f2) >> 4)
        self.p1[self.s] = self.q1 + ((low + hit1 * span - self.q1) >> 4) * (1 - hit2) * self.other
        step = hit2 * (1 + (self.c < 3).astype(np.int32)) - 1
        self.t2[self.i2] = np.where((hit2 | self.c) > 0, self.e2 + step, x << 2)
        self.t1[self.i1] = x
        self.a, self.b = self.b, x * np.int64(40503)


def table_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur and their shares of 65536, one at least."""
    count = np.bincount(ids)
    used = np.flatnonzero(count)
    if len(used) > 60000:
        raise ValueError("more than 60000 different ids in a segment")
    free = 65536 - len(used)
    share = 1 + count[used] * free // max(1, len(ids))
    share[np.argmax(share)] += 65536 - share.sum()
    return used, share


LEAST_RANGE = np.uint64(1 << 48)
U12, U16, U20, U48 = np.uint64(12), np.uint64(16), np.uint64(20), np.uint64(48)
ALL, LOW20 = np.uint64(65536), np.uint64((1 << 20) - 1)


class Order0:
    """Shares and starts, and the id at each of the 65536 places."""

    def __init__(self, used: np.ndarray, share: np.ndarray):
        of = np.zeros(int(used[-1]) + 1, dtype=np.uint64)
        of[used] = share.astype(np.uint64)
        self.both = (np.cumsum(of) - of) << U20 | of  # a share has 17 bits at most
        self.at = np.repeat(used, share).astype(np.int32)

    def place(self, x: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and share of 65536; an id predicted by a higher order has it all."""
        both = np.where(rest > 0, self.both.take(x), ALL)
        return both >> U20, both & LOW20


def _shares(f2: np.ndarray, f1: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and width, of 4096, of what came: order 2's id, order 1's or another."""
    start = (1 - hit2) * f2 + rest * f1
    return start.astype(np.uint64), (hit2 * f2 + hit1 * f1 + rest * (4096 - f2 - f1)).astype(np.uint64)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Order-0 table and the coded blocks of ``ids``."""
    used, share = table_of(ids)
    zero = Order0(used, share)
    n = -(-len(ids) // BLOCK)
    grid = np.zeros((n, BLOCK), dtype=np.int32)
    grid.ravel()[: len(ids)] = ids
    grid[n - 1, len(ids) - (n - 1) * BLOCK :] = used[0]
    grid = np.ascontiguousarray(grid.T)
    m, lanes = Lanes(n), np.arange(n)
    low, rng = np.zeros(n, dtype=np.uint64), np.full(n, (1 << 64) - 1, dtype=np.uint64)
    out = np.zeros((2 * BLOCK + 8) * n, dtype=np.uint16)  # 28 bits an id at most
    pos = np.zeros(n, dtype=np.int64)

    for t in range(min(BLOCK, len(ids))):
        x = grid[t]
        o2, o1, f2, f1 = m.predict()
        hit2 = (x == o2).astype(np.int32)
        hit1 = ((x == o1) & (f1 > 0)) * (1 - hit2)
        rest = 1 - hit2 - hit1
        r = rng >> U12
        start, width = _shares(f2, f1, hit2, hit1, rest)
        before = low
        low = low + r * start
        rng = r * width >> U16
        start, width = zero.place(x, rest)
        low += rng * start
        rng *= width
        at = np.flatnonzero(low < before)  # the carry runs into words already written
        p = pos[at] - 1
        while len(at):
            k = p * n + at
            out[k] += 1
            full = out[k] == 0
            at, p = at[full], p[full] - 1
        few = np.flatnonzero(rng < LEAST_RANGE)
        while len(few):
            lo, rg, p = low[few], rng[few] << U16, pos[few]
            out[p * n + few] = lo >> U48
            pos[few] = p + 1
            low[few] = lo << U16
            rng[few] = rg
            few = few[rg < LEAST_RANGE]
        m.learn(x, f2, hit2, hit1)
    for _ in range(4):
        out[pos * n + lanes] = low >> U48
        pos += 1
        low <<= U16
    words = np.ascontiguousarray(out.reshape(-1, n)[: pos.max()].T)
    return used, share, [words[k, : pos[k]].tobytes() for k in range(n)]


def decode_blocks(used: np.ndarray, share: np.ndarray, blocks: list[bytes], total: int) -> np.ndarray:
    """The ids of ``encode_blocks``."""
    zero = Order0(used, share)
    n = len(blocks)
    most = max(len(b) for b in blocks) // 2
    words = np.zeros((most + 4, n), dtype=np.uint16)
    for k, b in enumerate(blocks):
        words[: len(b) // 2, k] = np.frombuffer(b, dtype="<u2")
    words = words.ravel()
    m = Lanes(n)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(4):
        code = code << U16 | words[i * n : (i + 1) * n]
    rng = np.full(n, (1 << 64) - 1, dtype=np.uint64)
    pos = np.full(n, 4, dtype=np.int64)
    grid = np.zeros((min(BLOCK, total), n), dtype=np.int32)

    for t in range(len(grid)):
        o2, o1, f2, f1 = m.predict()
        r = rng >> U12
        hit2 = (code < r * f2.astype(np.uint64)).astype(np.int32)
        rest = (code >= r * (f2 + f1).astype(np.uint64)).astype(np.int32)
        hit1 = 1 - hit2 - rest
        start, width = _shares(f2, f1, hit2, hit1, rest)
        code -= r * start
        rng = r * width >> U16
        y = zero.at.take((code // rng).astype(np.int64), mode="clip")
        x = np.where(rest, y, o1 + hit2 * (o2 - o1))
        start, width = zero.place(x, rest)
        code -= rng * start
        rng *= width
        few = np.flatnonzero(rng < LEAST_RANGE)
        while len(few):
            rg, p = rng[few] << U16, pos[few]
            # a finished lane, in a short last block, may read past its words
            code[few] = code[few] << U16 | words.take(np.minimum(p, most) * n + few)
            pos[few] = p + 1
            rng[few] = rg
            few = few[rg < LEAST_RANGE]
        grid[t] = x
        m.learn(x, f2, hit2, hit1)
    out = np.zeros(n * BLOCK, dtype=np.uint32)
    out.reshape(n, BLOCK)[:, : len(grid)] = grid.T
    return out[:total]


def pack_segment(docs: list[tuple[int | None, bytes]]) -> bytes:
    """Documents (id, little-endian unsigned 32-bit ids) as one segment."""
    raw = b"".join(ids for _, ids in docs)
    ids = np.frombuffer(raw, dtype="<u4").astype(np.int64)
    used, share, blocks = encode_blocks(ids)
    step = 4 * BLOCK
    index = zlib.compress(
        np.array([0 if d is None else d for d, _ in docs], dtype="<i8").tobytes()
        + np.array([len(i) // 4 for _, i in docs], dtype="<i8").tobytes()
        + np.array([d is None for d, _ in docs], dtype="u1").tobytes()
    )
    order0 = zlib.compress(used.astype("<u4").tobytes() + (share - 1).astype("<u2").tobytes())
    sums = np.array([[len(b), zlib.crc32(raw[i * step : (i + 1) * step])] for i, b in enumerate(blocks)], dtype="<u4").tobytes()
    return b"".join([HEAD.pack(MAGIC, len(blocks), len(docs), len(ids), len(index), len(order0)), index, order0, sums, *blocks])


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids; checks every block."""
    magic, n, k, total, a, b = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    index = zlib.decompress(data[at : at + a])
    docs, lens, null = np.frombuffer(index, "<i8", k), np.frombuffer(index, "<i8", k, 8 * k), np.frombuffer(index, "u1", k, 16 * k)
    order0 = zlib.decompress(data[at + a : at + a + b])
    d = len(order0) // 6
    used, share = np.frombuffer(order0, "<u4", d).astype(np.int64), np.frombuffer(order0, "<u2", d, 4 * d).astype(np.int64) + 1
    at += a + b
    sums = np.frombuffer(data, "<u4", 2 * n, at).reshape(n, 2)
    ends = at + 8 * n + np.cumsum(sums[:, 0].astype(np.int64))
    blocks = [data[e - int(s) : e] for e, s in zip(ends.tolist(), sums[:, 0], strict=True)]
    ids = decode_blocks(used, share, blocks, total).astype("<u4", copy=False)
    for i in range(n):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) != sums[i, 1]:
            raise ValueError(f"block {i} is damaged")
    return [None if z else x for x, z in zip(docs.tolist(), null, strict=True)], lens, ids


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Token files of ``docs`` in ascending doc_id order under ``path``: rows of
    ``segment`` (ascending with the documents), ``n_tokens`` and ``data``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    kind = StructType.fromDDL("segment long, n_tokens long, data binary")
    arrow = to_arrow_schema(kind)

    def run(batches):
        enc, end = word_encoder(tokenizer), int(end_id).to_bytes(4, "little")
        part, count = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def segment() -> pa.RecordBatch:
            row = [[part + count], [size], [pack_segment(held)]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for lo, hi in slices(batch, TEXTS):
                ids_of, texts = [c.slice(lo, hi - lo).to_pylist() for c in batch.columns[:2]]
                for d, ids in zip(ids_of, enc.encode_all(texts), strict=True):
                    ids += end
                    held.append((d, ids))
                    size += len(ids) // 4
                    if size >= LANES * BLOCK:
                        yield segment()
                        held, size, count = [], 0, count + 1
        if held:
            yield segment()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    ordered = src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, kind).write.parquet(path)


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary) in the files."""
    kind = StructType.fromDDL("segment long, doc_id long, at long, n_tokens long, ids binary")
    return _decoded(spark, path, kind, lambda raw: raw).drop("segment", "at")


def read_checksums(spark, path: str) -> DataFrame:
    """As ``read_documents`` with the crc32 of the ids for the ids."""
    kind = StructType.fromDDL("segment long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return _decoded(spark, path, kind, zlib.crc32).drop("segment", "at")


def _decoded(spark, path: str, kind: StructType, value) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(spark)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                docs, lens, ids = unpack_segment(batch.column(1)[i].as_py())
                ends = np.cumsum(lens)
                raw = ids.tobytes()
                for lo in range(0, len(docs), 1024):
                    part = slice(lo, lo + 1024)
                    at, n = (ends - lens)[part], lens[part]
                    made = [value(raw[4 * s : 4 * (s + k)]) for s, k in zip(at.tolist(), n.tolist(), strict=True)]
                    cols = [[batch.column(0)[i].as_py()] * len(n), docs[part], at, n, made]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    files = spark.read.schema("segment long, n_tokens long, data binary").parquet(path)
    docs = files.select("segment", "data").mapInArrow(run, kind)
    # one row per segment of about LANES * BLOCK ids
    before = F.sum("n_tokens").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("segment", F.coalesce(before, F.lit(0)).alias("before"))
    return docs.join(starts, "segment").select("segment", "at", "doc_id", (F.col("before") + F.col("at")).alias("start"), *[f.name for f in kind][3:])


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files to the shared work folder and read them back."""
    path = new_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id)
    return read_checksums(docs.sparkSession, path)
