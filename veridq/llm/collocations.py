"""Phrase collocations, counted with counting quotient filters (``quotient.py``).

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and those
into words at spaces and tabs.  All counts are per language.

1. Each task writes blocks: about ``BLOCK`` words of one language as numbers of the block's
   own dictionary.  Word counts are summed over the dictionaries; words met ``least`` times
   get dense ids, which go back to the blocks that have them.
2. For m = 2 to 5 a block tallies its n-grams of m ids in a filter, cut by the top bits of
   the permuted keys into even ranges.  Each range's sorted filters are merged by one task.
   A bit per entry tells every block which of its n-grams are frequent; the merged filter
   of the frequent ones is kept.
3. A phrase is no more frequent than its parts, so a block goes on to m + 1 with the runs
   of words in which every n-gram of m words is frequent; the rest cannot hold a candidate.
   Nothing is estimated: each count is exact.
4. Candidates get the counts of both parts of each cut by joins; scores are decimals, and
   the integer division is exact.  A candidate goes if one with a word more in front or
   behind is as frequent; a longer one as frequent implies one of those.

No vocabulary or set of phrases is sent to all tasks.  A frequent phrase has one entry per
block, a frequent word one row per block.  A block is read whole by a task; only a piece of
more words than ``BLOCK`` without a separator makes it longer.

Edge cases: a null language counts as ``und``; null and empty texts have no words; repeated
rows and null ids count like others (the id is not read); an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from veridq.llm import quotient
from veridq.llm.common import materialise, ship

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words of a candidate
TOP = 2000  # phrases a language
BLOCK = 1 << 20  # words in a block
RANGE = 1 << 21  # n-grams that a merging task gets
CHUNK = 4 << 20  # bytes of a text split at once
LANGS = 10_000  # languages up to which a row for each is broadcast

#: Bytes: A-Z lowered, tab as space, separators as line feeds.
TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?" or 10 <= c <= 13 else c for c in range(256))

BLOCKS = "block long, lang string, n long, ids binary, words array<string>, counts array<long>"
STATE = "block long, lang string, grams long, ids binary"


def _arrow(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(ddl)
    return kind, to_arrow_schema(kind)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


# ---- words --------------------------------------------------------------------


class Open:
    """A block being filled: 0 stands for a separator, 1 for the nothing between spaces."""

    def __init__(self):
        self.of: defaultdict = defaultdict()
        self.of.default_factory = self.of.__len__
        assert (self.of[b"\n"], self.of[b""]) == (0, 1)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.of.__getitem__, words), np.int32, len(words))
        ids = ids[ids != 1]
        self.parts.append(ids)
        self.size += len(ids)

    def close(self) -> tuple[int, bytes, list[str], list[int]]:
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.of))
        return int(counts[2:].sum()), ids.astype("<i4").tobytes(), [w.decode() for w in self.of][2:], counts[2:].tolist()


def blocks(docs: DataFrame) -> DataFrame:
    """Blocks of words as local numbers (from 2), with their dictionaries and counts."""
    ship(docs.sparkSession)
    kind, schema = _arrow(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 33, 0
        held: dict[str, Open] = {}

        def flush(langs: list[str]):
            nonlocal made
            for lang in langs:
                b = held.pop(lang)
                if b.size:
                    yield _batch([(part + made, lang, *b.close())], schema)
                    made += 1

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                data = (texts[i].as_py() or b"").translate(TABLE).replace(b"\n", b" \n ")
                at = 0
                while at < len(data):
                    end = data.find(b" ", at + CHUNK)
                    words = data[at : end if end >= 0 else len(data)].split(b" ")
                    at = end + 1 if end >= 0 else len(data)
                    if lang in held and held[lang].size >= BLOCK and b"\n" in words:
                        cut = words.index(b"\n")  # the rest of the piece that is open
                        held[lang].add(words[:cut])
                        words = words[cut:]
                        yield from flush([lang])
                    held.setdefault(lang, Open()).add(words)
                if lang in held:
                    held[lang].add([b"\n"])
                    if held[lang].size >= BLOCK:
                        yield from flush([lang])
                if len(held) > 1 and sum(b.size for b in held.values()) >= 2 * BLOCK:
                    yield from flush(list(held))
        yield from flush(list(held))

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, kind)


def dense(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``id`` from 1, without gaps: the rows of each written part are numbered,
    and the parts' counts (one row a task) are summed up."""
    rows = materialise(df.withColumn("id", F.monotonically_increasing_id()), name)
    part = F.shiftright("id", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    return rows.withColumn("part", part).join(parts, "part").withColumn("id", F.col("id") - F.shiftleft("part", 33) + F.col("before") + 1).drop("part", "before")


def vocabulary(cut: DataFrame, least: int) -> DataFrame:
    """lang, word, f, id of the words met at least ``least`` times."""
    each = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    return dense(each.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least), "phrase-words")


# ---- n-grams --------------------------------------------------------------------


def runs(ids: np.ndarray, good: np.ndarray, m: int) -> tuple[np.ndarray, int]:
    """The words of each run of n-grams of m ids that are all ``good`` (by their first
    place), with a 0 behind each; and the number of n-grams of m + 1 ids in them."""
    edge = np.diff(np.r_[0, good.astype(np.int8), 0])
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = last - first > 1  # a run of one n-gram holds no longer one
    first, size = first[long], (last - first)[long] + m  # its words and a 0
    if not len(first):
        return ids[:0], 0
    end = np.cumsum(size)
    at = np.arange(end[-1]) - np.repeat(end - size, size) + np.repeat(first, size)
    out = ids[np.minimum(at, len(ids) - 1)]
    out[end - 1] = 0
    return out, int((size - 1 - m).sum())


def places(ids: np.ndarray, m: int) -> np.ndarray:
    """First places of the n-grams of m ids without a 0."""
    zeros = np.r_[0, np.cumsum(ids == 0)]
    return np.flatnonzero(zeros[m:] == zeros[:-m]) if len(ids) >= m else np.zeros(0, np.int64)


def _keys(ids: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    at = places(ids, m)
    return at, quotient.permute(quotient.pack([ids[at + j] for j in range(m)], bits), bits * m)


def _dtype(bits: int) -> str:
    """How ids of ``bits`` bits are written."""
    return "<i4" if bits < 32 else "<i8"


def first_state(cut: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """Blocks in the ids of the vocabulary; words that are not in it end a run."""
    kind, schema = _arrow(STATE)
    local = cut.select("block", "lang", F.posexplode("words").alias("at", "word"))
    # left: a row per entry of a dictionary, however many of the words are frequent
    named = local.join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    known = named.groupBy("block").agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "id"))).alias("known"))
    known = known.select("block", "known.at", F.col("known.id").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, lang, raw, at, id_ = (batch.column(c)[r] for c in range(5))
                ids = np.frombuffer(raw.as_py(), "<i4")
                table = np.zeros(max(int(ids.max()) + 1, 2), np.int64)
                table[at.values.to_numpy() + 2] = id_.values.to_numpy()
                ids = table[ids]
                out, grams = runs(ids, ids > 0, 1)
                if grams:
                    yield _batch([(block.as_py(), lang.as_py(), grams, out.astype(_dtype(bits)).tobytes())], schema)

    return cut.select("block", "lang", "ids").join(known, "block").select("block", "lang", "ids", "at", "id").mapInArrow(run, kind)


def filters(state: DataFrame, m: int, bits: int) -> DataFrame:
    """block, lang, head, range, filter: a block's n-grams of m ids, cut by the ``head`` top
    bits of their keys."""
    kind, schema = _arrow("block long, lang string, head int, range long, filter binary")
    top = quotient.widths(bits * m)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, lang, raw, head = (batch.column(c)[r].as_py() for c in range(4))
                head = min(head, top)
                keys, counts, _ = quotient.tally(_keys(np.frombuffer(raw, _dtype(bits)), m, bits)[1])
                ranges = keys[0] >> np.uint64(top - head) if head else np.zeros(len(counts), np.uint64)
                first = np.flatnonzero(quotient.starts([ranges]))
                rows = []
                for lo, hi in zip(first, np.r_[first[1:], len(counts)], strict=True):
                    rows.append((block, lang, head, int(ranges[lo]), quotient.encode([x[lo:hi] for x in keys], counts[lo:hi], bits * m, head, int(ranges[lo]))))
                    if len(rows) == 1024:
                        yield _batch(rows, schema)
                        rows = []
                yield _batch(rows, schema)

    # ranges by the language's n-grams: a row for each language, broadcast only if few
    heads = state.groupBy("lang").agg(F.greatest(F.lit(0), F.ceil(F.log2(F.sum("grams") / F.lit(float(RANGE))))).cast("int").alias("head"))
    heads = F.broadcast(heads) if heads.count() <= LANGS else heads
    return state.join(heads, "lang").select("block", "lang", "ids", "head").mapInArrow(run, kind)


def merged(parts: DataFrame, least: int) -> DataFrame:
    """For each language and range the filter of the frequent n-grams (block is null), and
    for each block there a bit per entry: whether it is frequent."""
    kind, schema = _arrow("block long, lang string, head int, range long, data binary")

    def run(table: pa.Table) -> pa.Table:
        head, lang, range_ = (table.column(c)[0].as_py() for c in ("head", "lang", "range"))
        raws = [v.as_buffer() for v in table.column("filter")]
        told, kept = [[] for _ in raws], []
        for keys, counts, found in quotient.merge_pieces(raws):
            often = counts >= least
            for bits, p in zip(told, found, strict=True):
                bits.append(often[p])
            if often.any():
                kept.append(([x[often] for x in keys], counts[often]))
        rows = [(b, lang, head, range_, np.packbits(np.concatenate(bits)).tobytes()) for b, bits in zip(table.column("block").to_pylist(), told, strict=True)]
        if kept:
            keys = [np.concatenate(x) for x in zip(*(k for k, _ in kept), strict=True)]
            rows.append((None, lang, head, range_, quotient.encode(keys, np.concatenate([c for _, c in kept]), quotient.bits_of(raws[0]), head, range_)))
        return pa.Table.from_batches([_batch(rows, schema)])

    return parts.groupBy("lang", "range").applyInArrow(run, kind)


def next_state(state: DataFrame, told: DataFrame, m: int, bits: int) -> DataFrame:
    """Blocks cut down to the runs whose n-grams of m ids are frequent."""
    kind, schema = _arrow(STATE)
    top = quotient.widths(bits * m)[0]
    flags = told.where("block is not null").groupBy("block").agg(F.max("head").alias("head"), F.sort_array(F.collect_list(F.struct("range", "data"))).alias("told"))
    flags = flags.select("block", "head", F.col("told.range").alias("ranges"), F.col("told.data").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, lang, raw, head, ranges, data = (batch.column(c)[r].as_py() for c in range(6))
                ids = np.frombuffer(raw, _dtype(bits))
                at, keys = _keys(ids, m, bits)
                keys, counts, place = quotient.tally(keys)
                first = [0] if not head else np.searchsorted(keys[0] >> np.uint64(top - head), np.array(ranges, np.uint64))
                size = np.diff(np.r_[first, len(counts)])  # entries of each range
                often = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8), count=int(n)) for d, n in zip(data, size, strict=True)])
                good = np.zeros(len(ids), bool)
                good[at] = often[place] == 1
                out, grams = runs(ids, good, m)
                if grams:
                    yield _batch([(block, lang, grams, out.astype(_dtype(bits)).tobytes())], schema)

    return state.join(flags, "block").select("block", "lang", "ids", "head", "ranges", "data").mapInArrow(run, kind)


def listed(told: DataFrame, m: int, bits: int) -> DataFrame:
    """lang, ids, f of the n-grams in the merged filters."""
    kind, schema = _arrow("lang string, ids array<long>, f long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, counts = quotient.decode(raw)
                cols = quotient.unpack(quotient.restore(keys, bits * m), bits, m)
                yield _batch(list(zip([lang] * len(counts), np.array(cols, np.int64).T.tolist(), counts.tolist(), strict=True)), schema)

    return told.where("block is null").select("lang", "data").mapInArrow(run, kind)


# ---- phrases ----------------------------------------------------------------------


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), (lang, word, f, id) and the phrases (lang, ids, f) of 2 to ``longest``
    words that occur ``least`` times, with exact counts."""
    ship(docs.sparkSession)
    cut = materialise(blocks(docs), "phrase-blocks")
    words = materialise(vocabulary(cut, least), "phrase-vocabulary")
    bits = max(1, words.count().bit_length())
    state = materialise(first_state(cut, words, bits), "phrase-state-1")
    found = []
    for m in range(2, longest + 1):
        told = materialise(merged(filters(state, m, bits), least), f"phrase-told-{m}")
        found.append(listed(told, m, bits))
        if m < longest:
            state = materialise(next_state(state, told, m, bits), f"phrase-state-{m}")
            if state.isEmpty():
                break
    grams = found[0]
    for g in found[1:]:
        grams = grams.unionByName(g)
    return cut.groupBy("lang").agg(F.sum("n").alias("n")), words, materialise(grams, "phrase-grams")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases (None:
    all of them)."""
    totals, words, grams = count_phrases(docs, least, longest)
    # parts of a phrase are frequent too; ids tell languages apart
    every = grams.select("ids", "f").unionByName(words.select(F.array("id").alias("ids"), "f"))
    cuts = grams.select("lang", "ids", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(ids, 1, k)")).withColumn("rest", F.expr("slice(ids, k + 1, size(ids))"))
    cuts = cuts.join(every.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first").join(every.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= LANGS else totals, "lang")
    cuts = cuts.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    best = cuts.groupBy("lang", "ids").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("c")).select("lang", "ids", "c.*")
    # the phrases of one word less inside a phrase, with its count
    inner = grams.where("size(ids) > 2").select("f", F.explode(F.expr("array(slice(ids, 1, size(ids) - 1), slice(ids, 2, size(ids) - 1))")).alias("ids"))
    inside = inner.groupBy("ids").agg(F.max("f").alias("longer"))
    kept = best.join(inside, "ids", "left").where("longer is null or longer < a")
    spelt = kept.select("lang", "ids", "score", "a", "l", "r", "n", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    phrases = spelt.groupBy("lang", "ids", "score", "a", "l", "r", "n").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = phrases.withColumn("rank", place)
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
