"""Near duplicates with SetSketch registers.

A document's set is its distinct 4-word shingles.  Register i is the truncated logarithm
``clip(floor(1 - log_b(min_d x_i(d))), 0, q + 1)`` of the least of exponentially distributed
values x_i(d) that a hash gives the shingles d; registers of a union are the maxima, and equal
registers are the likelier the more similar two sets are.

1. Texts with the same word sequence form one class, named by a number of its own; the
   text with its smallest id (else smallest hashes) stands for it.
2. ``BANDS`` bands of ``ROWS`` registers: classes with an equal band meet in a bucket.
   A link of similarity 0.8 misses all bands with probability (1 - 0.8^4)^24 = 3e-6.
3. Each bucket links its members to its smallest one only.  A candidate pair is kept
   if the joint likelihood of its registers and set sizes has its maximum not far below
   the threshold, and is confirmed on the full shingle sets.
4. Components of the confirmed links.  In buckets that still hold several components a
   link may exist that no star saw.  Rows that cannot have one are dropped first: the
   intersection is at most the number of shingles that another such class has too.  What
   is left of a bucket is compared in blocks of ``BLOCK`` rows by matrix products on the
   full sets; only links that join components leave a task, never all pairs.

Edge cases: null or empty text, or one without words, has an empty set and links with
nothing; texts of one to three words have their whole sequence as only shingle; a row
with a null id is compared like others, its component is the smallest non-null id met,
else null; of each component the text with that id stays, of several texts with it or
without any id the one with the smallest hashes; repeated rows of an id and text share
one result; an empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veridq.llm.common import arrow_map, free_name, materialise, ship
from veridq.llm.components import components

WORDS = 4
SIMILAR = 80  # per cent
BANDS, ROWS = 24, 4
M = BANDS * ROWS
B, A, Q = 1.001, 20.0, (1 << 16) - 2  # base, rate and largest register value less one
MARGIN = 0.25  # five standard deviations of the estimate
BLOCK = 512

SEED = np.random.default_rng(20240611)
MULT = SEED.integers(1, 1 << 63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
XOR = SEED.integers(0, 1 << 63, M, dtype=np.uint64)
MIX = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased; white space is space and 9-13."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 4-word shingles."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(WORDS, n)
    with np.errstate(over="ignore"):
        s = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            s = (s ^ h[i : n - k + 1 + i]) * MIX[i]
            s ^= s >> np.uint64(32)
        s = s * MIX[0]
        s ^= s >> np.uint64(29)
    return np.unique(s)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers (unsigned 16-bit) of a set."""
    if not len(s):
        return np.zeros(M, dtype=np.uint16)
    least = np.full(M, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 2048):
            part = s[i : i + 2048, None] ^ XOR
            part *= MULT
            np.minimum(least, part.min(axis=0), out=least)
    x = -np.log1p(-np.minimum((least >> np.uint64(11)).astype(np.float64) + 0.5, 2.0**53 - 1) / 2.0**53) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely_jaccard(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 40) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs (rows) from how many registers are
    larger, smaller and equal, given both set sizes."""
    up, down = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)
    log_b = np.log(B)
    p = lambda x: -np.log1p(-x * (B - 1) / B) / log_b
    best, out = np.full(len(u), -np.inf), np.zeros(len(u))
    top = np.minimum(u / v, v / u)
    for f in np.linspace(0, 1, steps + 1):
        j = top * f
        pa, pb = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
        p0 = np.maximum(1 - pa - pb, 1e-12)
        ll = up * np.log(np.maximum(pa, 1e-12)) + down * np.log(np.maximum(pb, 1e-12)) + same * np.log(p0)
        better = ll > best
        best, out = np.where(better, ll, best), np.where(better, j, out)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (two hashes of the text), text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), "text")


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, seq (digest of the word sequence), n, regs (binary)."""

    def make():
        def fn(ids, k1, k2, texts):
            out = {"doc_id": ids, "k1": k1, "k2": k2, "seq": [], "n": [], "regs": []}
            for t in texts:
                w = words_of(t)
                s = shingles(w)
                out["seq"].append(xxhash.xxh3_128_hexdigest(b" ".join(w)))
                out["n"].append(len(s))
                out["regs"].append(registers(s).tobytes())
            return out

        return fn

    return arrow_map(keyed(docs), make, "doc_id long, k1 long, k2 long, seq string, n long, regs binary", "doc_id", "k1", "k2", "text")


def sets(docs: DataFrame) -> DataFrame:
    """c, full shingle set (binary)."""

    def make():
        def fn(cs, texts):
            return {"c": cs, "s": [shingles(words_of(t)).tobytes() for t in texts]}

        return fn

    return arrow_map(docs, make, "c long, s binary", "c", "text")


def bands(classes: DataFrame) -> DataFrame:
    """c, n, band, key: one row for each class and band."""

    def make():
        def fn(cs, ns, regs):
            r = np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(len(cs), BANDS, ROWS).astype(np.uint64)
            with np.errstate(over="ignore"):
                k = np.zeros((len(cs), BANDS), dtype=np.uint64)
                for i in range(ROWS):
                    k = (k ^ r[:, :, i]) * MIX[i]
                    k ^= k >> np.uint64(31)
            return {
                "c": np.repeat(np.array(cs, dtype=np.int64), BANDS),
                "n": np.repeat(np.array(ns, dtype=np.int64), BANDS),
                "band": np.tile(np.arange(BANDS, dtype=np.int32), len(cs)),
                "key": k.view(np.int64).ravel(),
            }

        return fn

    return arrow_map(classes, make, "c long, n long, band int, key long", "c", "n", "regs")


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose set sizes allow the similarity and whose registers make it likely."""
    side = lambda x: classes.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def make():
        def fn(a, b, na, nb, ra, rb):
            x, y = (np.frombuffer(b"".join(v), dtype=np.uint16).reshape(len(a), M).astype(np.int32) for v in (ra, rb))
            na, nb = np.array(na, dtype=np.float64), np.array(nb, dtype=np.float64)
            sized = 100 * np.minimum(na, nb) >= SIMILAR * np.maximum(na, nb)
            ok = sized & (likely_jaccard(x, y, na, nb) >= SIMILAR / 100 - MARGIN)
            return {"a": np.array(a, dtype=np.int64)[ok], "b": np.array(b, dtype=np.int64)[ok]}

        return fn

    return arrow_map(both, make, "a long, b long", "a", "b", "na", "nb", "ra", "rb")


def confirm(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs with 100 * |A and B| >= SIMILAR * |A or B| on the full sets ``members(c, s)``."""
    side = lambda x: members.select(F.col("c").alias(x), F.col("s").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def make():
        def fn(a, b, sa, sb):
            ok = []
            for x, y in zip(sa, sb, strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                met = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * met >= SIMILAR * (len(x) + len(y) - met))
            return {"a": np.array(a, dtype=np.int64)[ok], "b": np.array(b, dtype=np.int64)[ok]} if any(ok) else None

        return fn

    return arrow_map(both, make, "a long, b long", "a", "b", "sa", "sb")


def links(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confirmed links between classes (a, b), and the components of their ends."""
    banded = bands(classes.where("n > 0"))
    buckets = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("lead")).where("size > 1")
    met = materialise(banded.join(buckets, ["band", "key"]), "setsketch-buckets")
    stars = met.where("c <> lead").select(F.col("lead").alias("a"), F.col("c").alias("b")).distinct()
    stars = materialise(promising(stars, classes), "setsketch-stars")
    # full sets of the classes that meet another one in a bucket, from one text each
    on = ["id0", "k1", "k2"]  # a null id counts as 0 here: the same text is the same class
    wanted = classes.join(met.select("c").distinct(), "c", "left_semi").select("c", F.coalesce("best.doc_id", F.lit(0)).alias("id0"), "best.k1", "best.k2")
    texts = keyed(docs).withColumn("id0", F.coalesce("doc_id", F.lit(0))).select(*on, "text")
    one = texts.join(wanted, on).groupBy(*on).agg(F.first("c").alias("c"), F.first("text").alias("text"))
    members = materialise(sets(one), "setsketch-sets")
    found = materialise(confirm(stars, members), "setsketch-found")
    label = components(found, "setsketch-c1")
    more = materialise(_unseen(met, label, members), "setsketch-more")
    if more.isEmpty():
        return found, label
    every = found.unionByName(more)
    return every, components(every, "setsketch-c2")


def _unseen(met: DataFrame, label: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) inside buckets that hold several components."""
    lab = label.select(F.col("node").alias("c"), "label")
    rows = met.join(lab, "c", "left").select("band", "key", "c", "n", F.coalesce("label", "c").alias("comp"))
    open_ = materialise(_several(rows), "setsketch-open")
    # shingles that no other open class has cannot be in an intersection
    mine = members.join(open_.select("c").distinct(), "c", "left_semi")
    each = materialise(_exploded(mine), "setsketch-shingles")
    shared = each.join(each.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1").select("h"), "h", "left_semi").groupBy("c").agg(F.count(F.lit(1)).alias("most"))
    least = open_.groupBy("band", "key").agg(F.min("n").alias("low"))
    able = open_.join(shared, "c").join(least, ["band", "key"]).where(f"100 * most >= {SIMILAR} * (n + low - most)")
    left = materialise(_several(able.select("band", "key", "c", "n", "comp")), "setsketch-able")
    # buckets are compared in blocks: rows of block i go to (i, j) for every block j
    blocks = left.join(left.groupBy("band", "key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb")), ["band", "key"])
    blocks = blocks.withColumn("i", F.pmod(F.xxhash64("c"), F.col("nb")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = blocks.select("band", "key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "c", "comp").join(members, "c")
    ship(met.sparkSession)
    return dealt.groupBy("band", "key", "i", "j").applyInPandas(_linked, "a long, b long")


def _several(rows: DataFrame) -> DataFrame:
    """Rows of the buckets with more than one component."""
    some = rows.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return rows.join(some.select("band", "key"), ["band", "key"], "left_semi")


def _exploded(members: DataFrame) -> DataFrame:
    """c, h: a row for each shingle."""

    def make():
        def fn(cs, sets):
            got = [np.frombuffer(x, dtype=np.int64) for x in sets]
            return {"c": np.repeat(np.array(cs, dtype=np.int64), [len(x) for x in got]), "h": np.concatenate(got)}

        return fn

    return arrow_map(members, make, "c long, h long", "c", "s")


def _linked(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between different components among the rows of two blocks; of all links
    those that join components not joined by the ones before."""
    pdf = pdf.sort_values("c", kind="stable")
    cs, comps = pdf["c"].to_numpy(), pdf["comp"].to_numpy()
    got = [np.frombuffer(x, dtype=np.uint64) for x in pdf["s"]]
    size = np.array([len(x) for x in got])
    row = np.repeat(np.arange(len(got)), size)
    _, at, count = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    use = several[at]
    row, col = row[use], number[at[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    met = np.zeros((len(got), len(got)), dtype=np.float32)
    for lo in range(0, int(several.sum()), 4096):
        i, j = np.searchsorted(col, [lo, lo + 4096])
        part = np.zeros((len(got), 4096), dtype=np.float32)
        part[row[i:j], col[i:j] - lo] = 1
        met += part @ part.T
    near = 100 * met >= SIMILAR * (size[:, None] + size[None, :] - met)
    x, y = np.nonzero(np.triu(near & (comps[:, None] != comps[None, :]), 1))
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.get(v, v) != v:
            v = root[v]
        return v

    keep = []
    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        a, b = find(int(comps[i])), find(int(comps[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append((int(cs[i]), int(cs[j])))
    return pd.DataFrame(keep, columns=["a", "b"], dtype="int64")


def _found(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, k1, k2, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    rows = materialise(sketch(docs), "setsketch-rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    by_seq = rows.groupBy("seq").agg(F.min(place).alias("best"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    classes = materialise(by_seq.withColumn("c", F.monotonically_increasing_id()), "setsketch-classes")
    _, label = links(docs, classes)
    comp = classes.where("n > 0").join(label.select(F.col("node").alias("c"), "label"), "c", "left").select("seq", "best", F.coalesce("label", "c").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("best").alias("keep"))
    of = comp.join(least, "comp").select("seq", "keep")
    out = rows.select("doc_id", "k1", "k2", "seq", F.col("n").alias("n_shingles")).join(of, "seq", "left")
    empty = F.col("n_shingles") == 0
    own = F.when(empty, F.col("doc_id")).otherwise(F.col("keep.doc_id"))
    kept = empty | (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("k1") == F.col("keep.k1")) & (F.col("k2") == F.col("keep.k2")))
    return out.select("doc_id", "k1", "k2", "n_shingles", own.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id;
    for a null id: the row that stays).  Of rows with the same id all are kept or none;
    ``keep_one`` tells their texts apart."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), "kept")
    return _found(docs).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that stand for no component, by id and text."""
    on = [free_name(docs, n) for n in ("none", "id", "k1", "k2")]
    number, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    named = lambda *cols: [c.alias(n) for c, n in zip(cols, on, strict=True)]
    keys = number.isNull(), F.coalesce(number, F.lit(0))
    gone = _found(docs).where(~F.col("kept")).select(*named(*keys, F.col("k1"), F.col("k2"))).distinct()
    every = docs.select("*", *named(*keys, F.xxhash64(text), F.xxhash64(F.lit(1), text)))
    return every.join(gone, on, "left_anti").select(*docs.columns)
