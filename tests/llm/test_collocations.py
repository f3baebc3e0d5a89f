import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from veridq.llm import collocations as C
from veridq.llm import quotient as Q

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    candidates = [k for k, a in f.items() if len(k[1]) > 1 and a >= least]
    longer = defaultdict(int)
    for lang, p in candidates:
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], f[lang, p])
    out = defaultdict(list)
    for lang, p in candidates:
        a = f[lang, p]
        if 100 * longer[lang, p] < 100 * a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(g, i + 1, x[2].decode(), -x[1], x[3], x[4], n[g], -x[0]) for g, v in out.items() for i, x in enumerate(sorted(v)[:top])}


def text_of(rng, words):
    seps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", " ;"]
    return "".join(w + seps[rng.integers(len(seps))] for w in words)


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    vocab = ["The", "of", "Ä", "été", "x-1", "a", " nb", "naïve", " ", "0"]
    rows = []
    for i in range(n):
        words = [vocab[j] for j in rng.zipf(1.6, rng.integers(0, 60)) % len(vocab)]
        if i % 3 == 0:
            words += ["new", "york", "stock", "exchange", "opens"] * int(rng.integers(1, 4))
        rows.append((["en", "de", None, "und", ""][i % 5], text_of(rng, words)))
    return [*rows, ("en", None), ("en", ""), (None, None), ("fr", "  .. "), ("en", "a " * 5000), rows[0], rows[0]]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_match_brute_force(spark, monkeypatch, small):
    rows = corpus(3)
    if small:  # several blocks, cut texts, many ranges and a plain join by language
        for name, value in (("BLOCK", 90), ("CHUNK", 40), ("RANGE", 16), ("LANGS", 0)):
            monkeypatch.setattr(C, name, value)
    docs = spark.createDataFrame([(i, g, t, 1) for i, (g, t) in enumerate(rows)], "n long, lang string, text string, word int")
    assert {tuple(r) for r in C.collocations(docs, 10).collect()} == brute(rows, 10)


def test_top_and_empty(spark):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in C.collocations(docs, 8, 3, 2).collect()} == brute(rows, 8, 3, 2)
    assert C.collocations(docs.limit(0)).collect() == []
    assert C.collocations(docs, 10**9).collect() == []


@pytest.mark.parametrize("bits,m", [(1, 2), (7, 5), (13, 5), (16, 4), (25, 5), (32, 5), (38, 5)])
def test_filters_are_lossless(bits, m):
    rng = np.random.default_rng(bits)
    cols = [rng.integers(0, 2**bits, 2000) for _ in range(m)]
    packed = Q.pack(cols, bits)
    assert all((a == b.astype(np.int64)).all() for a, b in zip(cols, Q.unpack(packed, bits, m), strict=True))
    mixed = Q.permute(packed, bits * m)
    assert all((a == b).all() for a, b in zip(packed, Q.restore(mixed, bits * m), strict=True))
    keys, counts, place = Q.tally(mixed)
    assert Counter(zip(*(x.tolist() for x in mixed), strict=True)) == dict(zip(zip(*(x.tolist() for x in keys), strict=True), counts.tolist(), strict=True))
    assert all((k[place] == x).all() for k, x in zip(keys, mixed, strict=True))
    counts = counts * rng.integers(1, 500, len(counts))
    raw = Q.encode(keys, counts, bits * m)
    back, n = Q.decode(raw)
    assert all((a == b).all() for a, b in zip(back, keys, strict=True)) and (n == counts).all() and Q.bits_of(raw) == bits * m
    half = Q.encode([x[::2] for x in keys], counts[::2], bits * m)
    every, total, (first, second) = Q.merge([raw, half])
    counts[::2] *= 2
    assert (total == counts).all() and (first == np.arange(len(counts))).all() and (second == np.arange(len(counts))[::2]).all()
    empty, none = Q.decode(Q.encode([x[:0] for x in keys], counts[:0], bits * m))
    assert len(none) == 0 and all(len(x) == 0 for x in empty)


def test_counts_past_64_bits(spark):
    # 1000*a*n passes 64 bits only with counts that no fixture has: the expression itself
    big = spark.sql("select (cast(1000 as decimal(4,0)) * cast(123456789012345L as decimal(15,0)) * cast(987654321098765432L as decimal(18,0))) div (cast(123456789012346L as decimal(18,0)) * cast(999999999999999L as decimal(18,0))) as s").first().s
    assert big == 1000 * 123456789012345 * 987654321098765432 // (123456789012346 * 999999999999999)


def test_merge_in_pieces():
    r = np.random.default_rng(3)
    for bits, head in ((40, 3), (90, 0)):
        keys = [Q.permute(Q.pack([r.integers(0, 50, 400)] * 2, bits // 2), bits) for _ in range(3)]
        if head:  # one range of the keys
            top = np.uint64(Q.widths(bits)[0] - head)
            keys = [[x[k[0] >> top == 5] for x in k] for k in keys]
        filters = [Q.encode(*Q.tally(k)[:2], bits, head, 5 if head else 0) for k in keys]
        want, total, found = Q.merge(filters)
        for size in (1, 7, 10**6):
            parts = list(Q.merge_pieces(filters, size))
            assert size > 7 or len(parts) > 1
            assert all((np.concatenate([p[0][i] for p in parts]) == x).all() for i, x in enumerate(want))
            assert (np.concatenate([p[1] for p in parts]) == total).all()
            before = np.cumsum([0, *(len(p[1]) for p in parts)])
            for f, place in enumerate(found):
                assert (np.concatenate([p[2][f] + b for p, b in zip(parts, before, strict=False)]) == place).all()
