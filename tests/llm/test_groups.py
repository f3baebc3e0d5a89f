"""Duplicates, conversations, the classifier and the pipeline against brute force."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veridq.llm import chat, components, exact, gam, linededup, packing, setsketch, winnow
from veridq.llm.common import read

SF001 = "/root/testdata/sf0.001"


class Union:
    def __init__(self, nodes):
        self.p = {n: n for n in nodes}

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.p[max(a, b)] = min(a, b)


def brute_near(rows):
    """doc_id -> (n, component) by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = setsketch.words_of(t)
        sets[d] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    u = Union(sets)
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b]:
            met = len(sets[a] & sets[b])
            if 100 * met >= 80 * (len(sets[a]) + len(sets[b]) - met):
                u.join(a, b)
    return {d: (len(s), u.find(d)) for d, s in sets.items()}


def variants(n, words, rng, most=12):
    base = [f"w{rng.integers(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.integers(0, most)):
            w[rng.integers(words)] = f"v{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_all_pairs(spark):
    rng = np.random.default_rng(8)
    texts = variants(80, 120, rng, 14) + variants(40, 30, rng, 3) + variants(30, 6, rng, 2) + ["one two", "One  TWO", "one two three", "", None, " \t", "a b c d e", "a b c d e"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, component_id string, n int")
    want = brute_near(rows)
    got = setsketch.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = setsketch.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    rng = np.random.default_rng(9)
    rows = list(enumerate(variants(90, 100, rng, 16)))
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows)


def test_near_duplicates_edges(spark):
    docs = spark.createDataFrame([(None, "same words here now ok"), (5, "same words here now ok"), (5, "same words here now ok"), (None, "alone in this world"), (7, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in setsketch.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (0, 5, False), (5, 5, True), (5, 5, True), (7, 7, True)]
    assert setsketch.near_duplicates(docs.limit(0)).count() == 0


def test_near_copies_with_null_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    other = [" ".join(f"{p}{i}" for i in range(60)) for p in "abc"]
    rows = [(None, near()), (None, near(0)), (None, near(59)), (0, near(0, 59)), (4, near(1)), (None, other[0]), (None, other[0] + " end"), (9, other[1]), (None, other[1] + " end"), (None, None)]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id, r.kept) for r in got)
    assert of == sorted([(-1, 0, False)] * 3 + [(0, 0, True), (4, 0, False), (-1, -1, False), (-1, -1, True), (9, 9, True), (-1, 9, False), (-1, -1, True)])


def test_keep_one_goes_by_row(spark):
    words = [f"w{i}" for i in range(60)]
    near, clean = " ".join(["x", *words[1:]]), " ".join(f"c{i}" for i in range(60))
    rows = [(1, " ".join(words)), (2, near), (2, clean), (None, near + " y"), (3, clean + " z"), (None, "all alone in here"), (6, None)]
    kept = setsketch.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in kept} == {rows[0], rows[2], rows[5], rows[6]} and len(kept) == 4


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[400:2400])
    ra, rb = setsketch.registers(a), setsketch.registers(b)
    assert (setsketch.union(ra, rb) == setsketch.registers(np.union1d(a, b))).all()
    j = setsketch.likely_jaccard(ra[None].astype(int), rb[None].astype(int), np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(j - 1600 / 2400) < 0.2


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)]
    u = Union(range(600))
    for a, b in edges:
        u.join(a, b)
    got = components.components(spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {n: u.find(n) for e in edges for n in e if e[0] != e[1]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup(spark, monkeypatch):
    monkeypatch.setattr(exact, "HELD_BYTES", 4000)
    rows = [(i, f"Text {i % 37}" if i % 3 else "HOT text") for i in range(600)] + [(900, None), (901, ""), (902, "É"), (903, "é"), (None, "hot TEXT"), (901, "")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, key string").repartition(6)
    got = exact.dedup(docs, capacity=8).collect()
    assert len(got) == len(rows)
    norm = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    import hashlib

    for t, ids in groups.items():
        g = by[hashlib.sha256(t.encode()).hexdigest()]
        assert {r.group_size for r in g} == {len(ids)} and {r.keep_id for r in g} == {max(i for i in ids if i is not None)}
        assert [r.doc_id for r in g if r.kept] == [max(i for i in ids if i is not None)]
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact.dedup(docs.limit(0)).count() == 0


def test_exact_stage_survives_other_splits(spark):
    """The input's splits change between the jobs, as when executors join or leave."""
    rows = [(i, f"text {i % 927}", i) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int").repartition(7)
    import veridq.llm.exact as module

    whole = module.dedup

    def later(docs, *a, **k):
        out = whole(docs, *a, **k)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        return out

    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        module.dedup = later
        kept = exact.keep_first(docs)
        got = kept.collect()
    finally:
        module.dedup = whole
        for k, v in before.items():
            spark.conf.set(k, v)
    assert kept.columns == docs.columns and len(got) == 927 and {r._row for r in got} == {r.doc_id for r in got}


def test_helper_columns_do_not_clash(spark):
    names = ["_row", "_id", "_none", "_k1", "_k2", "_score", "_w", "_t", "_e", "_g", "_m", "row", "score"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(["some plain words in a text here", "other words of another text there", "some plain words in a text here"])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    for step in (exact.keep_first, setsketch.keep_one, lambda d: gam.keep_good(d, SF001, 0.0)):
        got = step(docs)
        assert got.columns == docs.columns
        assert {tuple(r) for r in got.collect()} <= set(rows) and got.count() >= 2
    marked = winnow.fingerprint(docs)
    assert marked.columns == [*docs.columns, "fingerprint"] and {tuple(r)[:-1] for r in marked.collect()} == set(rows)


def test_scores_are_sums_of_tables(spark):
    docs = read(spark, SF001, "documents").select("doc_id", "text")
    model = gam.fit(docs, read(spark, SF001, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: None, -2: "", -3: "word " * 200_000}

    def plain(t):
        x = gam.features(t)
        total = model.base
        for j, table in enumerate(model.tables):
            total += table[sum(c <= x[j] for c in model.cuts[j])]
        for a, b, grid in model.pairs:
            total += grid[sum(c <= x[a] for c in model.coarse[a])][sum(c <= x[b] for c in model.coarse[b])]
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, total))))

    got = gam.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()
    assert len(got) == len(texts) and all(r.score == pytest.approx(plain(texts[r.doc_id]), abs=1e-9) for r in got)


def test_fit_bounds_its_sample(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i} of words") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    import veridq.llm.gam as module

    seen, train = [], module.train
    try:
        module.train = lambda x, y: seen.append(len(x)) or train(x, y)
        gam.fit(docs, labels, max_train=50)
    finally:
        module.train = train
    assert seen == [50]


def test_directory_doubles_and_covers_all_keys(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key")).unionByName(spark.range(400).select(F.lit(77).cast("long").alias("key")))
    buckets = exact.directory(keys, capacity=100)
    assert sum(n for _, _, n in buckets) == 5400
    assert sum(1 / 2**d for _, d, _ in buckets) == pytest.approx(1)
    assert all(n <= 100 or d == 56 for _, d, n in buckets)


def test_equal_keys_are_told_apart_by_bytes(spark):
    rows = [(0, 5, 1, b"a"), (0, 5, 2, b"b"), (0, 5, 3, b"a"), (0, 6, 4, b"a")]
    got = exact.chain(spark.createDataFrame(rows, "bucket long, key long, rep long, text binary").coalesce(1)).collect()
    assert {r.rep: r["class"] for r in got} == {1: 1, 2: 2, 3: 1, 4: 4}


def brute_every_position(texts):
    """text -> first text of its component, on the shingles from every position."""
    sets = [{s[j : j + linededup.K] for j in range(len(s))} for s in texts]
    u = Union(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[i] & sets[j]) >= linededup.SIMILAR * len(sets[i] | sets[j]):
            u.join(i, j)
    return {s: texts[u.find(i)] for i, s in enumerate(texts)}


def line_groups(spark, texts):
    """text -> text of the line that stays for it, of one-line documents."""
    got = linededup.line_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {texts[r.doc_id]: texts[r.keep_doc_id] for r in got}


def test_lines_compare_letters_inside_words(spark):
    rng = np.random.default_rng(12)
    word = lambda n: "".join(rng.choice(list("acdefgiklmnopqrstuvwxyz"), n))
    head, long = word(8), word(90)
    texts = ["internationalization", "internationalism", *(head + word(52) for _ in range(6))]
    for _ in range(25):  # one word with letters changed, and words with one word changed
        c = list(long)
        for _ in range(rng.integers(0, 3)):
            c[rng.integers(90)] = "b"
        texts.append("".join(c))
    base = [word(12) for _ in range(8)]
    texts += [" ".join([*base[:i], base[i][:10] + "bb", *base[i + 1 :]]) for i in range(8)]
    texts = list(dict.fromkeys(texts))
    got = line_groups(spark, texts)
    assert got == brute_every_position(texts)
    assert all(got[t] == t for t in texts[:8])


def brute_lines(rows):
    """(row number, line number) -> the place that stays, by all pairs; ties go by row."""
    place = {(i, n): x.lower().strip(" ") for i, (_, t) in enumerate(rows) for n, x in enumerate((t or "").split("\n")) if x.strip(" ")}
    order = lambda p: (rows[p[0]][0] is not None, rows[p[0]][0] or 0, p[1], p[0])
    stays = brute_every_position(list(dict.fromkeys(place[p] for p in sorted(place, key=order))))
    first = {s: min((p for p, v in place.items() if v == s), key=order) for s in set(place.values())}
    return {p: first[stays[s]] for p, s in place.items()}


@pytest.mark.parametrize("text_block", [2_000_000, 300])
def test_lines_match_all_pairs(spark, monkeypatch, text_block):
    monkeypatch.setattr(linededup, "BLOCK", 8)
    monkeypatch.setattr(linededup, "TEXT_BLOCK", text_block)
    monkeypatch.setattr(linededup, "BROADCAST_LINES", text_block // 1000)
    rng = np.random.default_rng(4)
    lines = variants(60, 30, rng, 6) + variants(30, 8, rng, 2) + ["Same line", "same LINE ", "", "  ", "x"]
    rows = [(i, "\n".join(lines[j] for j in rng.integers(0, len(lines), 4))) for i in range(60)] + [(90, None), (91, ""), (92, "same line\n\nsame line")]
    docs = spark.createDataFrame([(d, t, 1, "r") for d, t in rows], "doc_id long, text string, line int, row string").coalesce(2)
    got = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in linededup.line_rows(docs).collect()}
    want = {(rows[i][0], n): (rows[j][0], m) for (i, n), (j, m) in brute_lines(rows).items()}
    assert got == want
    texts = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert texts == {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if not x.strip(" ") or want[d, i] == (d, i)) for d, t in rows}
    assert linededup.line_rows(docs.limit(0)).count() == 0 and linededup.dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_repeated_and_unnamed_rows(spark):
    rows = [(5, "one line here\ntwo line there"), (5, "one line here\ntwo line there"), (None, "Two line there\nonly here"), (None, "only here"), (7, "only here\n\n one line here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = linededup.line_rows(docs).collect()
    want = brute_lines(rows)
    assert len(got) == len(want) and sum(r.kept for r in got) == len(set(want.values()))
    assert {(r.keep_doc_id, r.keep_line_no) for r in got if r.doc_id == 5} == {(5, 0), (None, 0)}
    assert sorted(r.group_size for r in got) == [3, 3, 3, 3, 3, 3, 3, 3, 3]
    texts = sorted(((r.doc_id or 0), r.text) for r in linededup.dedup_lines(docs).collect())
    assert texts == [(0, "Two line there"), (0, "only here"), (5, ""), (5, "one line here"), (7, "")]


def test_very_long_lines(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SEGMENT", 1000)
    rng = np.random.default_rng(6)
    long = "".join(rng.choice(list("abcdefgh ijklm"), 50_000))
    near = long[:30_000] + "zz" + long[30_000:]
    rows = [(1, long), (2, near), (3, long[:20_000]), (4, "é" * 5000), (5, "é" * 4000 + "\n" + "\0" * 9 + "a")]
    got = {(r.doc_id, r.line_no): r.keep_doc_id for r in linededup.line_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 0): 1, (2, 0): 1, (3, 0): 3, (4, 0): 4, (5, 0): 4, (5, 1): 5}
    assert (linededup.signatures([long]) == linededup.signatures([long, "x"])[:1]).all()
    sets = {long[i : i + linededup.K] for i in range(len(long))}
    assert len(linededup.shingle_set(long)) == len(sets)


@pytest.mark.parametrize("a,b,both", [(5, 4, 4), (18, 18, 16), (20, 16, 16), (80, 64, 64), (72, 72, 64), (300, 300, 267)])
def test_bands_find_similar_lines(a, b, both):
    """At the threshold at most 1 in 100 pairs is missed, whatever the sizes."""
    rng = np.random.default_rng(a)
    n, missed = 4000, 0
    h = rng.integers(0, 1 << 32, (n, a + b - both), dtype=np.uint64).astype(np.uint32)

    def keys(part):
        least = np.empty((n, linededup.BANDS * linededup.ROWS), np.uint32)
        for r, seed in enumerate(linededup.SEEDS):
            x = part * seed
            x ^= x >> np.uint32(15)
            least[:, r] = (x * np.uint32(0x2C1B3C6D)).min(axis=1)
        return least.reshape(n, linededup.BANDS, linededup.ROWS)

    met = (keys(h[:, :a]) == keys(h[:, a - both :])).all(axis=2).any(axis=1)
    missed = n - int(met.sum())
    assert missed <= n // 100, missed


def test_chat_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN", 4)
    turns = lambda c, n, tag="": [(c, i, "user" if i % 2 == 0 else "assistant", f"t{i}{tag if i == n - 1 else ''}", "x") for i in range(n)]
    rows = turns(1, 3) + turns(2, 5) + turns(3, 11) + turns(4, 11) + turns(5, 6, "other") + turns(6, 1) + [(7, None, None, None, "x"), (None, 0, "user", "t0", "x"), (8, 0, "user", "lone", "x")]
    got = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")).collect()
    assert {r.conv_id: r.n_turns for r in got} == {3: 11, 5: 6, 7: 1, 8: 1}
    parts = [r.text for r in sorted((r for r in got if r.conv_id == 3), key=lambda r: r.part)]
    assert len(parts) == 3 and "".join(parts) == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, _, r, t, _ in turns(3, 11))
    assert [r.text for r in got if r.conv_id == 7] == ["<|im_start|>\n<|im_end|>\n"]
    assert chat.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    scored = gam.score(docs, gam.fit(docs, labels)).join(labels, "doc_id").where(gam.held_out(F.col("doc_id")))
    right, n = scored.agg(F.sum(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.count(F.lit(1))).first()
    assert n > 50 and right / n >= 0.95


def test_classifier_edges(spark):
    d = next(i for i in range(2, 20) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (d, "word " * 9, "c"), (d, "word " * 9, "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = gam.score(docs, gam.fit(docs, labels)).collect()
    assert {r.score for r in got} == {0.5} and len(got) == 4
    one = gam.fit(docs, spark.createDataFrame([(d, 1)], "doc_id long, quality int"))
    assert all(0.9 < r.score <= 1 for r in gam.score(docs, one).collect())
    assert gam.score(docs.limit(0), one).count() == 0


def test_pairs_find_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.train(x, y)
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1) and ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9


def test_pipeline_stages(spark):
    docs = read(spark, SF001, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF001)
        assert step.columns == docs.columns, name
    good = corpus_pipeline.STAGES[0][1](spark, docs, SF001).collect()
    best = {}
    for r in good:
        k = exact_key(r.text)
        best[k] = max(best.get(k, -1), r.doc_id)
    near = brute_near([(d, rows[d]) for d in best.values()])
    want = {d for d, (_, c) in near.items() if c == d}
    assert {r.doc_id for r in step.collect()} == want
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id for r in got} == want and max(r.length for r in got) <= packing.SIZE


def exact_key(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def test_lines_of_an_open_bucket_are_not_compared_pair_by_pair(monkeypatch):
    import random

    import numpy as np

    from veridq.llm import linededup as L

    r = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    base = [" ".join(r.choice(words) for _ in range(8)) for _ in range(12)]
    rows = []
    for i in range(60):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 5)):
            text[r.randrange(len(text))] = r.choice("xyz")
        rows.append((100 + i, 100 + i // 2, "".join(text)))
    rows.append((99, 7, "q"))  # shares no shingle
    sets = [L.shingle_set(t) for _, _, t in rows]
    root, want = {}, []

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    for x in range(len(rows)):
        for y in range(x):
            a, b, met = find(rows[x][1]), find(rows[y][1]), len(np.intersect1d(sets[x], sets[y]))
            if a != b and 100 * met >= L.SIMILAR * (len(sets[x]) + len(sets[y]) - met):
                root[max(a, b)] = min(a, b)
                want.append((rows[y][0], rows[x][0]))

    def one_pair(*a):
        raise AssertionError("a pair is compared on its own")

    monkeypatch.setattr(L, "similar", one_pair)
    for columns in (7, 4096):
        monkeypatch.setattr(L, "COLUMNS", columns, raising=False)
        assert L._linked(rows) == want and want
    assert L._linked([]) == [] == L._linked(rows[:1])
