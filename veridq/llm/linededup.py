"""Fuzzy line duplicates by MinHash.

A line (without spaces at the ends, lower-cased) is compared by its character shingles:
``K`` characters, fewer at its end, from every position.

1. One pass splits the texts and numbers the lines.  A task keeps a line that it meets again
   once.  Of every line text it takes a signature of ``BANDS`` * ``ROWS`` minima, each under
   a hash of its own, the same rule for all lengths; ``ROWS`` minima make a band's key.  Two
   lines of similarity 0.8 miss all bands with probability 0.003.  Lines of a block that have
   a key in common send one row for it to the shuffle, so a common line or template costs a
   row per block.  Texts stay in compressed blocks.
2. Equal lines are one.  In each bucket the first is paired with the others.  Those that take part get
   their texts from the blocks; a pair is a link if the Jaccard similarity of the full
   shingle sets is at least 0.8.
3. Components of the links.  Buckets of three lines or more that still
   hold several components are compared whole, in blocks of at most ``BLOCK`` lines: only
   links become rows.
4. One line of each component stays: the first by document, line number and row.

Edge cases: null or empty text has no lines; blank lines are never compared and stay;
lines of a document with a null id come first; of repeated rows one has its lines kept;
an empty table gives no rows; a line of any length is read whole, in parts; further
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from veridq.llm.common import arrow_map, materialise, ship
from veridq.llm.components import components
from veridq.session import new_path

K = 8
BANDS, ROWS = 8, 3
SIMILAR = 80  # per cent
BLOCK = 256  # lines of an open bucket on either side of a comparison
COLUMNS = 4096  # shingles in a product of matrices
TEXT_BLOCK = 2_000_000  # characters in a block of texts
LINE_BITS = 20  # lines in a block of texts, as bits
SEGMENT = 1 << 16  # positions hashed at once
BROADCAST_LINES = 2_000_000  # numbers of lines, 16 MB, that are sent to all blocks of texts

U = np.uint64
PAD = 0x110000  # no character
MIX = U(0x9E3779B97F4A7C15)
#: Odd multipliers, one for each hash of the signature and one for each row of a band.
SEEDS = np.random.default_rng(2718).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
FOLD = np.random.default_rng(1828).integers(0, 1 << 63, ROWS, dtype=np.uint64) | U(1)

PARTS = "kind string, row long, doc_id long, line_no int, k1 long, k2 long, rid long, key long, lead long, block long, texts binary"


# ---- signatures ---------------------------------------------------------------


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1 of every i, in a row."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - size), size)


def shingles(segments: list[str], positions: np.ndarray) -> np.ndarray:
    """Hashes of the shingles at the first ``positions[i]`` places of every segment; a segment
    that is too short for its last shingles ends its line."""
    size = np.array([len(s) for s in segments])
    wide = positions + K - 1
    text = "".join([s.ljust(w, "\0") for s, w in zip(segments, wide.tolist(), strict=True)])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(wide) - wide
    codes[_spans(start + size, wide - size)] = PAD
    n = len(codes) - K + 1
    h = np.zeros(max(n, 0), np.uint64)
    for j in range(K if n > 0 else 0):
        h = (h + codes[j : n + j]) * MIX
        h ^= h >> U(29)
    return h[_spans(start, positions)]


def signatures(lines: list[str]) -> np.ndarray:
    """One row of ``BANDS`` keys for each (not empty) line."""
    least = np.full((len(lines), BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    held: list[tuple[int, str, int]] = []

    def close() -> None:
        positions = np.array([p for _, _, p in held])
        h = (shingles([s for _, s, _ in held], positions) >> U(32)).astype(np.uint32)
        at, first = np.array([i for i, _, _ in held]), np.cumsum(positions) - positions
        for r, seed in enumerate(SEEDS):
            x = h * seed
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            np.minimum.at(least[:, r], at, np.minimum.reduceat(x, first))
        held.clear()

    size = 0
    for i, line in enumerate(lines):
        for lo in range(0, len(line), SEGMENT):
            positions = min(SEGMENT, len(line) - lo)
            held.append((i, line[lo : lo + positions + K - 1], positions))
            size += positions
            if size >= SEGMENT:
                close()
                size = 0
    if held:
        close()
    keys = np.zeros((len(lines), BANDS), np.uint64)
    for r in range(ROWS):
        keys = (keys ^ least[:, r::ROWS].astype(np.uint64)) * FOLD[r]
        keys ^= keys >> U(31)
    return ((keys << U(4)) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def shingle_set(line: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a line."""
    return np.unique(np.concatenate(list(_each([line]))[0]))


def _each(lines: list[str]) -> Iterator[list[np.ndarray]]:
    """The shingle hashes of every line, in parts; short lines are hashed together."""
    lo = 0
    while lo < len(lines):
        hi, size = lo, 0
        while hi < len(lines) and (hi == lo or size + len(lines[hi]) <= SEGMENT):
            size += len(lines[hi])
            hi += 1
        if size <= SEGMENT:
            positions = np.array([len(x) for x in lines[lo:hi]])
            for h in np.split(shingles(lines[lo:hi], positions), np.cumsum(positions)[:-1]):
                yield [h]
        else:
            line = lines[lo]
            yield [shingles([line[i : i + SEGMENT + K - 1]], np.array([min(SEGMENT, len(line) - i)])) for i in range(0, len(line), SEGMENT)]
        lo = hi


def near(n, m, met):
    """Whether sets of n and m shingles with ``met`` in common are similar enough."""
    return 100 * met >= SIMILAR * (n + m - met)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    return near(len(a), len(b), int(met_in(a, [b]).sum()))


def met_in(a: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Which elements of the sorted set ``a`` are in ``parts``."""
    seen = np.zeros(len(a), bool)
    for h in parts:
        at = np.searchsorted(a, h)
        at[at == len(a)] = 0
        seen[at[a[at] == h]] = True
    return seen


# ---- one pass over the texts -----------------------------------------------------


def lines(docs: DataFrame, *more: str) -> DataFrame:
    """``more``, doc_id, line_no, raw line, its normal form ``line`` and that one's two hashes."""
    got = docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "raw"))
    got = got.withColumn("line", F.trim(F.lower("raw")))
    return got.withColumn("k1", F.xxhash64("line")).withColumn("k2", F.xxhash64(F.lit(1), "line"))


class _Block:
    """Line texts of a task until they are signed and written."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.texts: list[str] = []
        self.known: set[tuple[int, int]] = set()

    def add(self, text: str, key: tuple[int, int]) -> int | None:
        """The number of a text that is new here."""
        if key in self.known:
            return None
        self.known.add(key)
        self.texts.append(text)
        self.size += len(text)
        return (self.number << LINE_BITS) + len(self.texts) - 1

    def full(self) -> bool:
        return self.size >= TEXT_BLOCK or len(self.texts) == 1 << LINE_BITS

    def close(self) -> Iterator[dict]:
        keys = signatures(self.texts)
        rid = np.repeat((self.number << LINE_BITS) + np.arange(len(keys)), BANDS)
        flat = keys.reshape(-1)
        _, first, which = np.unique(flat, return_index=True, return_inverse=True)
        lead = rid[first[which]]  # the smallest rid with the key
        yield {"kind": "bands", "key": flat, "rid": rid, "lead": lead}
        packed = zstandard.ZstdCompressor(3).compress("\n".join(self.texts).encode("utf-8", "surrogatepass"))
        yield {"kind": "texts", "block": [self.number], "texts": [packed]}


def _read_once(docs: DataFrame, number: str | None) -> str:
    """Write the tables of pass 1 to a new folder: ``rows`` (every line that is not blank; ``rid``
    where its text is new to the block), ``bands`` and ``texts``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    ship(spark)
    kind = StructType.fromDDL(PARTS)
    schema = to_arrow_schema(kind)

    def batch_of(cols: dict) -> pa.RecordBatch:
        n = len(next(v for k, v in cols.items() if k != "kind"))
        whole = {"kind": pa.array([cols.pop("kind")] * n, pa.string())} | {k: v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type) for k, v in cols.items()}
        return pa.RecordBatch.from_arrays([whole[f.name].cast(f.type) if f.name in whole else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << LINE_BITS
        block = _Block(made)
        for batch in batches:
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
            texts, rids = batch.column("line"), []
            for i, key in enumerate(keys):
                if block.full():
                    for part in block.close():
                        yield batch_of(part)
                    made += 1
                    block = _Block(made)
                rids.append(None if key in block.known else block.add(texts[i].as_py(), key))
            yield batch_of({"kind": "rows", "rid": rids} | {c: batch.column(c) for c in ("row", "doc_id", "line_no", "k1", "k2")})
        if block.texts:
            for part in block.close():
                yield batch_of(part)

    row = F.col(number) if number else F.monotonically_increasing_id()
    numbered = docs.select(row.alias("row"), "doc_id", "text")
    every = lines(numbered, "row").where("line <> ''").select("row", "doc_id", "line_no", "line", "k1", "k2")
    path = new_path(spark, "lines")
    every.mapInArrow(run, kind).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return path


def _part(docs: DataFrame, path: str, kind: str, *cols: str) -> DataFrame:
    return docs.sparkSession.read.schema(PARTS).parquet(path).where(F.col("kind") == kind).select(*cols)


# ---- links --------------------------------------------------------------------------


def _texts_of(wanted: DataFrame, blocks: DataFrame) -> DataFrame:
    """rid, line and n (distinct shingles) of the texts ``wanted(rid)``."""
    places = wanted.groupBy(F.shiftright("rid", LINE_BITS).alias("block")).agg(F.collect_list("rid").alias("rids"))  # a block's lines at most

    def make():
        def fn(rids, packed):
            out = {"rid": [], "line": [], "n": []}
            for want, raw in zip(rids, packed, strict=True):
                texts = zstandard.ZstdDecompressor().decompress(raw).decode("utf-8", "surrogatepass").split("\n")
                texts = [texts[r & ((1 << LINE_BITS) - 1)] for r in want]
                out["rid"] += want
                out["line"] += texts
                out["n"] += [len(np.unique(np.concatenate(h))) for h in _each(texts)]
            return out

        return fn

    # few lines go to the blocks; many are met by the blocks, which move compressed
    places = F.broadcast(places) if wanted.count() <= BROADCAST_LINES else places
    return arrow_map(blocks.join(places, "block"), make, "rid long, line string, n int", "rids", "texts")


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar."""
    size = lambda x: texts.select(F.col("rid").alias(x), F.col("n").alias(f"n{x}"))
    line = lambda x: texts.select(F.col("rid").alias(x), F.col("line").alias(f"t{x}"))
    sized = pairs.join(size("a"), "a").join(size("b"), "b").where(f"100 * least(na, nb) >= {SIMILAR} * greatest(na, nb)")
    both = sized.join(line("b"), "b").join(line("a"), "a")

    def make():
        last: list = [None, None]

        def fn(a, b, nb, ta, tb):
            ok = []
            for x, n, s, h in zip(a, nb, ta, _each(tb), strict=True):
                if last[0] != x:
                    last[:] = x, shingle_set(s)
                ok.append(near(len(last[1]), n, int(met_in(last[1], h).sum())))
            return {"a": np.array(a)[ok], "b": np.array(b)[ok]} if any(ok) else None

        return fn

    return arrow_map(both, make, "a long, b long", "a", "b", "nb", "ta", "tb")


def _unseen(members: DataFrame, label: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between different components inside buckets ``members(key, rid)``."""
    rows = members.join(label.select(F.col("node").alias("rid"), "label"), "rid", "left").select("key", "rid", F.coalesce("label", "rid").alias("comp"))
    some = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi and n > 2")
    open_ = rows.join(some.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")), "key")
    # a bucket's block i meets every block j; most buckets are one block
    open_ = open_.withColumn("i", F.pmod(F.xxhash64("rid"), F.col("nb")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = open_.select("key", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "rid", "comp").join(texts.select("rid", "line"), "rid")
    group = ["key", "p", "q"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, "rid").select(*group, "rid", "comp", "line")
    ship(members.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            out = []
            for *g, rid, comp, line in zip(*cols, strict=True):
                if g != last:
                    out += _linked(held)
                    held, last = [], g
                held.append((rid, comp, line))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)
        out = _linked(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)

    return dealt.mapInArrow(run, "a long, b long")


def _linked(rows: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Links that join the components of ``rows`` (rid, component, line), by all pairs of
    different ones."""
    sets = [np.unique(np.concatenate(h)) for h in _each([line for _, _, line in rows])]
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.get(v, v) != v:
            v = root[v]
        return v

    out = []
    for x, y in zip(*_close(sets), strict=True):
        a, b = find(rows[x][1]), find(rows[y][1])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((rows[y][0], rows[x][0]))
    return out


def _close(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """The pairs x > y of similar sets.  A pair's common shingles are counted by a product of
    matrices, ``COLUMNS`` shingles at a time; those of one set alone have no column."""
    if len(sets) < 2:
        return [], []
    size = np.array([len(s) for s in sets])
    flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat)
    flat, of = flat[order], of[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    shared = ~(new & np.r_[new[1:], True])
    column, of = np.cumsum(new[shared]) - 1, of[shared]
    met = np.zeros((len(sets), len(sets)), np.int64)
    columns = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, columns, COLUMNS):
        first, end = np.searchsorted(column, (lo, lo + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, columns - lo)), np.float32)  # sums up to COLUMNS are exact
        has[of[first:end], column[first:end] - lo] = 1
        met += (has @ has.T).astype(np.int64)
    x, y = np.nonzero(np.tril(near(size[:, None], size[None, :], met), -1))
    return x.tolist(), y.tolist()


def _links(docs: DataFrame, path: str, same: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Confirmed links (a, b), buckets (key, rid) of several lines, and the lines' texts.
    ``same(a, b)``: texts b that equal a, of another block; a stands for them."""
    bands = _part(docs, path, "bands", "key", "rid", "lead")
    # a row per block and key, so a bucket has at most as many as there are blocks
    every = Window.partitionBy("key")
    sent = bands.where("rid = lead").select("key", "rid").withColumn("first", F.min("rid").over(every)).withColumn("n", F.count(F.lit(1)).over(every))
    leads = materialise(sent.where("n > 1").select("key", "rid", "first"), "lines-leads")
    local = bands.where("rid <> lead")
    stars = leads.where("rid <> first").select(F.col("first").alias("a"), F.col("rid").alias("b"))
    one = lambda df, c: df.join(same.select(F.col("b").alias(c), F.col("a").alias("to")), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
    stars = one(one(stars.unionByName(local.select(F.col("lead").alias("a"), F.col("rid").alias("b"))), "a"), "b").where("a <> b")
    stars = materialise(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "lines-stars")
    wanted = stars.select(F.col("a").alias("rid")).unionByName(stars.select(F.col("b").alias("rid"))).distinct()
    texts = materialise(_texts_of(wanted, _part(docs, path, "texts", "block", "texts")), "lines-met")
    members = leads.select("key", "rid").unionByName(local.select("key", "rid")).unionByName(local.select("key", F.col("lead").alias("rid")))
    return materialise(_confirm(stars, texts), "lines-links"), one(members, "rid").distinct(), texts


def _kept(docs: DataFrame, number: str | None = None) -> DataFrame:
    """row, doc_id, line_no, keep (place of the line that stays), group_size of every line
    that is not blank."""
    path = _read_once(docs, number)
    rows = _part(docs, path, "rows", "row", "doc_id", "line_no", "k1", "k2", "rid")
    place = F.struct(F.col("doc_id").isNotNull().alias("real"), "doc_id", "line_no", "row")
    of_text = [F.min(place).alias("place"), F.count(F.lit(1)).alias("times"), F.min("rid").alias("lid"), F.max("rid").alias("last")]
    classes = materialise(rows.groupBy("k1", "k2").agg(*of_text), "lines-classes")
    # equal lines of several blocks
    again = classes.where("lid <> last").select("k1", "k2", "lid")
    same = rows.where("rid is not null").join(again, ["k1", "k2"]).where("rid <> lid").select(F.col("lid").alias("a"), F.col("rid").alias("b"))
    links, members, texts = _links(docs, path, materialise(same, "lines-same"))
    label = components(links, "lines-c1")
    more = materialise(_unseen(members, label, texts), "lines-more")
    if not more.isEmpty():  # components that are one
        label = components(links.unionByName(more), "lines-c2")
    of = classes.join(label.select(F.col("node").alias("lid"), "label"), "lid", "left").withColumn("comp", F.coalesce("label", "lid"))
    best = of.groupBy("comp").agg(F.min("place").alias("keep"), F.sum("times").alias("group_size"))
    stays = of.select("k1", "k2", "comp").join(best, "comp").select("k1", "k2", "keep", "group_size")
    return rows.select("row", "doc_id", "line_no", "k1", "k2").join(stays, ["k1", "k2"]).select("row", "doc_id", "line_no", "keep", "group_size")


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: doc_id, line_no, keep_doc_id, keep_line_no,
    group_size, kept."""
    kept = (F.col("row") == F.col("keep.row")) & (F.col("line_no") == F.col("keep.line_no"))
    return _kept(docs).select(
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.line_no").cast("long").alias("keep_line_no"),
        "group_size",
        kept.alias("kept"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row without the lines that another line stands for."""
    numbered = materialise(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "lines-numbered")
    stays = _kept(numbered, "row").where("row = keep.row and line_no = keep.line_no").select("row", "line_no", F.lit(True).alias("kept"))
    rest = lines(numbered, "row").join(stays, ["row", "line_no"], "left").where("line = '' or kept")
    parts = rest.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("line_no", "raw"))).alias("p"))  # one document's lines
    texts = parts.select("row", F.array_join("p.raw", "\n").alias("text"))
    return numbered.select("row", F.col("doc_id").cast("long").alias("doc_id")).join(texts, "row", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
