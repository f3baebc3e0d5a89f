"""Document fingerprints by winnowing, with DataFrame functions only.

Every run of ``K`` characters is hashed; of each window of ``W`` consecutive hashes the
smallest is chosen, the rightmost of equal ones; the fingerprint is the chosen hashes with
their positions, in order.  Two texts that share ``K + W - 1`` characters in a row share a
fingerprint, and one shorter than ``K`` never matters.  A window minimum over W = 2^k
positions takes k passes that each combine neighbours, so the work is linear.

A chosen hash is one long: 36 bits of hash above 28 bits that fall with the position,
so that the smallest long is the smallest hash at its rightmost place.

Edge cases: null or empty text has no fingerprint entries; a text shorter than ``K`` has
one hash, of all of it; one with fewer than ``W`` hashes is one window; equal texts have
equal fingerprints; further columns of the input are kept, whatever their names; rows with
a null id come first and are edited with the row after them; rows with the same id are
ordered by a hash of the text; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, W = 8, 8
SPAN = K + W - 1  # characters that a window looks at
PLACE_BITS = 28
PLACES = (1 << PLACE_BITS) - 1
MAX_BUCKETS = 4096
BUCKET_DOCS = 400


def minima(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the array of window minima of column ``text`` (not null), one per window."""
    t = F.col(text)
    n = F.length(t)
    grams = F.when(n == 0, F.array().cast("array<string>")).when(n < K, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(rf"(?s)(?=(.{{{K}}}))."), F.lit(1)))
    df = df.withColumn("_g", grams)
    df = df.withColumn("_m", F.expr(f"transform(_g, (x, i) -> (xxhash64(x) & {~PLACES}L) + ({PLACES}L - (i & {PLACES})))")).drop("_g")
    step = 1
    while step < W:
        df = df.withColumn("_m", F.expr(f"zip_with(_m, slice(_m, {step + 1}, size(_m)), (x, y) -> if(y < x, y, x))"))
        step *= 2
    return df.withColumn(out, F.expr(f"slice(_m, 1, greatest(size(_m) - {W - 1}, least(size(_m), 1)))")).drop("_m")


def chosen(minima: str) -> Column:
    """Entries of a fingerprint: each chosen position once, in order."""
    return F.array_distinct(F.col(minima))


def moved(entries: str, by: str) -> str:
    """SQL of entries ``by`` positions further to the right."""
    return f"transform({entries}, x -> x - {by})"


def upto(entries: str, n: str, span: str) -> Column:
    """The entries that the windows within the first ``n`` characters choose; ``span``: the
    last ``SPAN`` of those.  Chosen positions never fall from window to window, so they are
    the entries up to the last such window's minimum."""
    last = f"array_min(transform(sequence(0, {W - 1}), i -> (xxhash64(substring({span}, i + 1, {K})) & {~PLACES}L) + ({PLACES}L - (({n} - {SPAN} + i) & {PLACES}))))"
    return F.expr(f"if({n} < {SPAN}, cast(array() as array<bigint>), slice({entries}, 1, cast(array_position({entries}, {last}) as int)))")


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with ``out``: array of (hash, position) of the text's fingerprint."""
    # the input's columns wait in one struct, so none of them can clash
    whole = df.select(F.struct(*[c for c in df.columns if c != out]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    got = minima(whole, "_t", "_w").withColumn("_e", chosen("_w"))
    pairs = F.expr(f"transform(_e, x -> named_struct('hash', shiftright(x, {PLACE_BITS}), 'position', {PLACES}L - (x & {PLACES}L)))")
    return got.select("row.*", pairs.alias(out))


def digest(entries: str) -> Column:
    """A short string of a fingerprint."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(entries)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.reverse(F.col(entries)))), 16, "0")))


def likeness(a: str, b: str) -> Column:
    """Share of the hashes of both fingerprints that are in both; 1 if both are empty."""
    x, y = (f"transform({v}, e -> shiftright(e, {PLACE_BITS}))" for v in (a, b))
    both = F.expr(f"size(array_intersect({x}, {y}))")
    either = F.expr(f"size(array_distinct({x})) + size(array_distinct({y}))") - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / either)


def with_next(docs: DataFrame, order: str, payload, n_docs: int, prepare) -> DataFrame:
    """``prepare(docs)`` with ``next``: ``payload`` of the row after it by ``order`` (after the
    last: the first).  Rows are dealt to ranges of ``order`` whose bounds are approximate
    quantiles; the first row of a range is also dealt to the range before it.  Ties
    go by the text's hash."""
    ranges = max(1, min(MAX_BUCKETS, n_docs // BUCKET_DOCS))
    got = docs.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)] or [0.5], 20 * ranges)).first()[0] if n_docs else None
    bounds = sorted(set(got or [])) if ranges > 1 else []
    at = _range_of(F.col(order), bounds)
    firsts = docs.select(F.col(order).alias("o"), at.alias("range")).groupBy("range").agg(F.min("o").alias("first"), F.count_if(F.col("o").isNull()).alias("nulls"))
    seen = sorted(((r["range"], None if r["nulls"] else r["first"]) for r in firsts.collect()), key=lambda r: r[0])  # MAX_BUCKETS rows at most
    spark = docs.sparkSession
    before = spark.createDataFrame([(r, f, seen[i - 1][0]) for i, (r, f) in enumerate(seen)], "range int, first long, previous int")
    dealt = docs.withColumn("range", at).join(F.broadcast(before), "range")
    guest = F.when(F.col(order).eqNullSafe(F.col("first")), F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("g")), F.struct(F.col("previous").alias("r"), F.lit(True).alias("g"))))
    dealt = dealt.withColumn("_to", F.explode(F.coalesce(guest, F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("g"))))))
    dealt = dealt.select(*docs.columns, F.col("_to.r").alias("_r"), F.col("_to.g").alias("_guest"))
    rows = prepare(dealt.repartition("_r"))
    w = Window.partitionBy("_r").orderBy("_guest", F.col(order).asc_nulls_first(), F.xxhash64("_t"))
    return rows.withColumn("next", F.lead(payload).over(w)).where(~F.col("_guest")).drop("_guest", "_r")


def _range_of(col: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``col``: first by every 64th bound, then among 64."""
    if not bounds:
        return F.lit(0)
    col = F.coalesce(col, F.lit(-(1 << 63)))
    coarse = F.array(*[F.lit(b) for b in bounds[63::64]]) if len(bounds) > 64 else None
    fine = F.array(*[F.lit(b) for b in bounds])
    below = lambda a: F.size(F.filter(a, lambda b: b <= col))
    if coarse is None:
        return below(fine)
    skip = below(coarse) * 64
    return skip + below(F.slice(fine, skip + 1, 64))


def edited(docs: DataFrame) -> DataFrame:
    """For each document: its fingerprint entries ``e``, those of the edited text ``ee``, and of
    the next document ``ne``; ``n_chars`` and the edited text.

    The edited text is a prefix of the document and a prefix of the next one, so its
    entries are theirs but for the windows across the cut, which are computed from
    ``SPAN - 1`` characters on either side."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_t"))

    def prepare(df: DataFrame) -> DataFrame:
        return minima(df, "_t", "_w").withColumn("e", chosen("_w")).drop("_w")

    rows = with_next(src, "doc_id", F.struct("_t", "e"), src.count(), prepare)
    rows = rows.select("doc_id", "_t", "e", F.length("_t").alias("n_chars"), F.col("next._t").alias("_nt"), F.col("next.e").alias("ne"))
    rows = rows.withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("_p", F.col("n_chars") - F.col("_half"))
    rows = rows.withColumn("_t", F.expr("substring(_t, 1, _p)")).withColumn("_nt", F.expr("substring(_nt, 1, _half)"))
    rows = rows.withColumn("_q", F.length("_nt")).withColumn("edited", F.concat("_t", "_nt"))
    # the windows across the cut
    side = SPAN - 1
    rows = rows.withColumn("_from", F.greatest(F.col("_p") - side, F.lit(0)))
    rows = rows.withColumn("_c", F.expr(f"substring(edited, _from + 1, _p - _from + least(_q, {side}))"))
    rows = rows.withColumn("_ts", F.expr(f"substring(_t, _p - {side}, {SPAN})")).withColumn("_ns", F.expr(f"substring(_nt, _q - {side}, {SPAN})")).drop("_t", "_nt")
    rows = minima(rows, "_c", "_cw")
    rows = rows.withColumn("_cw", F.expr(f"if(length(_c) >= {SPAN} or length(_c) = _p + _q, _cw, cast(array() as array<bigint>))"))
    rows = rows.withColumn("_a", upto("e", "_p", "_ts")).withColumn("_b", upto("ne", "_q", "_ns"))
    rows = rows.withColumn("_all", F.expr(f"concat(_a, {moved('_cw', '_from')}, {moved('_b', '_p')})"))
    return rows.withColumn("ee", chosen("_all")).select("doc_id", "n_chars", "edited", "e", "ee", "ne")
