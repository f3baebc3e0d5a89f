"""BPE, token files, packing, page extraction and fingerprints against brute force."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from veridq.llm import bpe, htmlcrf, packing, tokenfile, winnow
from veridq.llm.queries import tokenizer

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, start int, score string"
EDGE = [
    (1, None, "x", 1, None), (2, "", None, 2, None), (3, "a", "x", None, "s"), (3, "a", "x", None, "s"), (7, "It's <|endoftext|> done\n\n  ok 12½", "x", 3, "s"),
    (8, "word " * 3000, "x", 3, "s"), (None, "no id here", "x", 3, "s"), (9, "ÉÀ Σς 日本語 🙂🙂 " * 40, "x", 4, "s"), (10, "z" * 70000, "x", 4, "s"), (11, "  \t ", "x", 4, "s"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(name))


def ids_of(t, text):
    return np.array(t.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_encoders_match_the_library():
    rng = random.Random(5)
    pool = ["a", "B", "'re", "'RE", "  ", "\n", "é", "12", "-", "-" * 8, "ing", " The", "<|endoftext|>", "日本", "́", "🙂", "Σ", "İ", "½", "\x1c", "\x85", "_"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + ["x" * 200_000, " " * 70_000 + "x", "ing" * 40_000]
    byte, word = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    own, rank, words = bpe.Encoder(tokenizer("byte_bpe_50k.json")), bpe.RankEncoder(tokenizer("byte_bpe_50k.json")), bpe.WordEncoder(tokenizer("word_bpe_49k.json"))
    dec = bpe.Decoder(own.m)
    for t in texts:
        want = ids_of(byte, t)
        assert own.encode(t) == want and rank.encode(t) == want
        assert dec.decode(want) == byte.decode(np.frombuffer(want, "<u4").tolist(), skip_special_tokens=False)
        if len(t) < 1000:
            assert words.encode(t) == ids_of(word, t)


def test_words_of_many_texts_are_coded_together(monkeypatch):
    rng = random.Random(7)
    pool = ["a", "B", "'re", "'", "  ", "\n", "\t", "é", "ß", "12", "7", "-", "...", "?!", "ing", " The", "end. ", "ª", "\xa0", "×", "İ", "_", "ſ"]
    odd = [None, "", "  \t ", "\xa0", "<|endoftext|> x", "Σς", "日本語 🙂", "a\x01b \x01", "\x1c", "a\x85b", "z" * 5000]
    texts = odd + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    rng.shuffle(texts)
    enc, word = bpe.WordEncoder(tokenizer("word_bpe_49k.json")), library("word_bpe_49k.json")
    assert enc.encode_all(texts) == [ids_of(word, t) for t in texts]
    assert enc.encode_all([]) == [] and enc.encode_all([None]) == [b""]
    monkeypatch.setattr(enc, "word", None)  # plain texts take no call a word
    assert enc.encode_all(["One, two. Three's e\xa0f", "ß9"]) == [ids_of(word, t) for t in ("One, two. Three's e f", "ß9")]


def test_transducer_is_stable_in_small_steps():
    m = bpe.Encoder(tokenizer("byte_bpe_50k.json")).m
    rng = random.Random(2)
    for _ in range(40):
        data = "".join(rng.choice(["a", "e", "in", "g", "th", "-", "--", "er", "s"]) for _ in range(3000)).encode()
        t, out, held = bpe.Transducer(m), [], 0
        for i in range(0, len(data), 37):
            out += t.feed(data[i : i + 37])
            held = max(held, len(t.buf))
        assert out + t.close() == m.merge(data) and held <= 4 * m.lookahead + 200


def test_decoder_handles_broken_utf8():
    m = bpe.Encoder(tokenizer("byte_bpe_50k.json")).m
    t = library("byte_bpe_50k.json")
    rng = random.Random(1)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(30)]
        assert bpe.Decoder(m).decode(np.array(ids, "<u4").tobytes()) == t.decode(ids, skip_special_tokens=False)


def test_encode_decode_frames(spark, edge):
    path = tokenizer("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(edge, path), path)
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((r[0] or 0, r[1] or "") for r in EDGE)
    assert {"start", "score"} <= set(got.columns)
    assert bpe.encode(edge.limit(0), path).count() == 0


def test_token_segment_round_trip_and_checksum():
    rng = np.random.default_rng(3)
    docs = [(i, rng.integers(0, 49408 if i % 2 else 9, rng.integers(1, 5000)).astype("<u4").tobytes()) for i in range(12)] + [(None, b"\2\0\0\0")]
    data = tokenfile.pack_segment(docs)
    names, lens, ids = tokenfile.unpack_segment(data)
    assert names == [d for d, _ in docs] and ids.tobytes() == b"".join(b for _, b in docs) and lens.tolist() == [len(b) // 4 for _, b in docs]
    broken = bytearray(data)
    broken[len(data) // 2] ^= 4
    with pytest.raises(ValueError):
        tokenfile.unpack_segment(bytes(broken))


def test_token_files(spark, edge):
    path = tokenizer("word_bpe_49k.json")
    t = library("word_bpe_49k.json")
    got = tokenfile.round_trip(edge, path).collect()
    assert len(got) == len(EDGE)
    at = 0
    want = sorted(((r[0], ids_of(t, r[1]) + b"\2\0\0\0") for r in EDGE), key=lambda r: (r[0] is not None, r[0] or 0))
    by = sorted(got, key=lambda r: r.start)
    for (d, ids), r in zip(want, by, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert tokenfile.round_trip(edge.limit(0), path).count() == 0


def test_packing(spark, edge):
    path = tokenizer("byte_bpe_50k.json")
    docs = edge.unionByName(spark.read.parquet(f"{SF001}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text"), allowMissingColumns=True)
    got = packing.pack_documents(docs, path).collect()
    t = library("byte_bpe_50k.json")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r.doc_id, []).append(ids_of(t, r.text) + b"\1\0\0\0")
    seqs = {}
    for r in got:
        assert r.ids_crc32 in {zlib.crc32(w[4 * r.start : 4 * (r.start + r.length)]) for w in want[r.doc_id]}
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(w) // 4 for ws in want.values() for w in ws)
    assert sum(r.length for r in got) == total
    used = [sum(n for _, n in p) for p in seqs.values()]
    assert sum(0 if u & (u - 1) == 0 else 2048 - u for u in used) <= 0.02 * total + 2048
    assert packing.pack_documents(edge.limit(0), path).count() == 0


def test_full_pieces_go_to_no_group(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    plain = packing.pack_group

    def counted(pdf, size):
        seen.add(int((pdf["length"] >= size).sum()))
        return plain(pdf, size)

    monkeypatch.setattr(packing, "pack_group", counted)
    rows = [(d, s, n, 0, 20 * 8 + 3, 7) for d in (1, 2, None) for s, n in [*((8 * i, 8) for i in range(20)), (160, 3)]]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES), 3, 8).collect()
    assert len(got) == 63 and seen.value == 0
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sorted(p) for p in used.values()) == sorted([[(0, 8)]] * 60 + [[(0, 3), (3, 3)], [(0, 3)]])


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 2047) for _ in range(rng.randint(1, 60))]
        bins, offsets = packing.first_fit_decreasing(sizes, 2048)
        free = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            b = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
            if b == len(free):
                free.append(2048)
            assert (bins[i], offsets[i]) == (b, 2048 - free[b])
            free[b] -= sizes[i]


def test_field_on_held_out_layouts():
    field = htmlcrf.trained()
    wrong = total = 0
    for text, labels in htmlcrf.labelled_pages(150, seed=99):
        got = htmlcrf.blocks(text)
        assert len(got) == len(labels)
        wrong += sum(a != b for a, b in zip(field.labels(got), labels, strict=True))
        total += len(labels)
    assert wrong <= 0.03 * total


def test_quotes_open_a_value_only_after_equals():
    text = lambda page: [b.text for b in htmlcrf.blocks(page)]
    assert text("<p title=it's>One can't do <b>two</b>") == ["One can't do two"]
    assert text("<p><a href=/o'brien>O'Brien wrote</a> it") == ["O'Brien wrote it"]
    assert text('<div class="x""><p>First part.</p><p>A 5" pipe is <b>here') == ["First part.", 'A 5" pipe is here']
    assert text('<p><a href=/q?s=">He said "so"</a> twice') == ['He said "so" twice']
    assert text("""<p title = "a > b" data-x='c > d'>Text</p><p title="no end>More <i title=>text""") == ["Text", "More text"]


def test_extract_given_pages_and_edges(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r for r in htmlcrf.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        assert got[r.page_id].text == "\n".join(x for x in parts if x) and got[r.page_id].n_chars == len(got[r.page_id].text)
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article><p>One &amp; two<p>three &am"), (3, "u", "<article><p>One &amp; two<p>three &am"), (None, "u", "<p>" * 5000), (5, "u", "<article><p>x <script>if (a<b) {}</script>y</p><div class='ad'>Buy</div></article")]
    out = htmlcrf.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {(r.page_id, r.text) for r in out}
    assert texts == {(1, ""), (2, ""), (3, "One & two\nthree &am"), (None, ""), (5, "x y")} and len(out) == 6
    assert htmlcrf.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("plain", [0.0, 1.0])
def test_held_out_layouts_with_and_without_marks(plain):
    field, wrong, total = htmlcrf.trained(), 0, 0
    for text, labels in htmlcrf.labelled_pages(300, 4321, plain):
        got = htmlcrf.blocks(text)
        if len(got) == len(labels):
            wrong += sum(x != y for x, y in zip(field.labels(got), labels, strict=True))
            total += len(labels)
    assert total > 2000 and wrong <= 0.03 * total


PROSE = "This is a paragraph of prose, and it has a good length to be one."


def test_extract_without_marks_and_with_open_controls():
    text = htmlcrf.trained().text
    nav = "<ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul>"
    want = f"The title of it\n{PROSE}\n{PROSE}"
    assert text(f"<nav>{nav}</nav><div><h1>The title of it</h1><p>{PROSE}</p><p>{PROSE}</p></div><footer>&copy; 2024 Site</footer>") == want
    assert text(f"<div>{nav}</div><div><h1>The title of it</h1><p>{PROSE}</p><p>{PROSE}</p></div>") == want
    article = f"<article><h1>The title of it</h1><p>{PROSE}</p><p>{PROSE}</p></article>"
    for control in ("<button>Menu", "<select><option>a<option>b", "<svg><path d=x>"):
        assert text(f"<nav>{control}</nav>{article}") == want
        assert text(f"<nav><div>{control}</div></nav>{article}<button>Send</button>") == want
    assert text(article.replace("</h1>", "</h1><button><div>Share</div></button><select><option>a</select><svg><text>x</text></svg>")) == want
    assert text("<article><p>See <![CDATA[the tail") == "See the tail"
    assert text("<article><p>See <![CDATA[the tail]]> end") == "See the tail end"


def test_extract_a_very_long_page():
    text = htmlcrf.trained().text
    body = "".join(f"<p>{PROSE}<button>x</p>" if i % 2 else f"<p>{PROSE}</p>" for i in range(20_000))
    assert text(f"<article>{body}</article>") == "\n".join([PROSE] * 20_000)
    assert text(f"<article><p>{'word ' * 200_000}end.</p></article>") == "word " * 200_000 + "end."


def brute_winnow(t, k=winnow.K, w=winnow.W):
    grams = [t[i : i + k] for i in range(len(t) - k + 1)] if len(t) >= k else [t] if t else []
    v = []
    for g in grams:
        x = xxhash.xxh64_intdigest(g.encode(), 42)
        v.append((x - (1 << 64) if x >> 63 else x) >> winnow.PLACE_BITS)
    out = []
    for s in range(max(1, len(v) - w + 1) if v else 0):
        win = v[s : s + w]
        p = s + max(i for i, x in enumerate(win) if x == min(win))
        if not out or out[-1][1] != p:
            out.append((v[p], p))
    return out


def test_winnowing(spark, edge):
    got = winnow.fingerprint(edge.select("doc_id", "text").where("length(text) < 20000 or text is null")).collect()
    for r in got:
        assert [(x["hash"], x["position"]) for x in r.fingerprint] == brute_winnow(r.text or "")


def test_edited_texts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    docs = docs.unionByName(spark.createDataFrame([(100, None), (101, "ab"), (102, "abcdefghij"), (103, "🙂" * 30), (104, "")], "doc_id long, text string"))
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in winnow.edited(docs).withColumn("d", winnow.digest("e")).withColumn("near", winnow.likeness("e", "ee")).withColumn("next", winnow.likeness("e", "ne")).collect()}

    def like(a, b):
        a, b = {x for x, _ in a}, {x for x, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, r in enumerate(rows):
        t, nxt = r.text or "", rows[(i + 1) % len(rows)].text or ""
        text = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        g = got[r.doc_id]
        assert g.edited == text and g.n_chars == len(t)
        assert g.near == pytest.approx(like(brute_winnow(t), brute_winnow(text)), abs=1e-12)
        assert g.next == pytest.approx(like(brute_winnow(t), brute_winnow(nxt)), abs=1e-12)
    assert winnow.edited(docs.limit(0)).count() == 0


def test_entries_of_edited_texts_without_all_minima(spark):
    """Entries match those of the edited text at every length, and no array with a value for
    each position passes the sort."""
    rng = random.Random(8)
    texts = ["".join(rng.choice(pool) for _ in range(n)) for n in range(70) for pool in ("a", "ab", "aé🙂b")]
    rng.shuffle(texts)
    rows = winnow.edited(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert not re.search(r"\b_w#", rows._jdf.queryExecution().optimizedPlan().toString())
    got = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        text = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        for entries, of in ((got[i].e, t), (got[i].ee, text), (got[i].ne, nxt)):
            assert [(x >> winnow.PLACE_BITS, winnow.PLACES - (x & winnow.PLACES)) for x in entries] == brute_winnow(of)


def test_edited_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(winnow, "BUCKET_DOCS", 3)
    docs = spark.createDataFrame([(i * i * 7 % 1009, f"text number {i} " * 3) for i in range(300)], "doc_id long, text string").dropDuplicates(["doc_id"])
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r.edited for r in winnow.edited(docs).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)].text
        assert got[r.doc_id] == r.text[: len(r.text) - len(r.text) // 2] + nxt[: len(r.text) // 2]


def test_digest_is_of_the_whole_text(spark):
    q = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(20)
    path = tokenizer("byte_bpe_50k.json")
    for r in bpe.encode(q, path).join(q, "doc_id").withColumn("sha", F.sha2("ids", 256)).collect():
        assert r.sha == hashlib.sha256(ids_of(library("byte_bpe_50k.json"), r.text)).hexdigest()
