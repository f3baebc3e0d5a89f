"""Byte-level BPE as a bounded-lookahead streaming transducer.

The text is cut into pre-tokens by a pattern whose matches depend on at most
``HELD`` characters to their right.  Each pre-token's bytes then run through a
``Transducer``: it keeps a window of bytes, applies the merges to it and emits a
token once every byte that could still change it has been seen.  How many bytes
that is follows from the merge list alone (``sufficient_lookahead``), so the memory
is constant however long a pre-token is.  Decoding feeds the ids' bytes through an
incremental UTF-8 state machine.

Edge cases: null or empty text gives no ids and an empty text; ids are those of the
``tokenizers`` library for the same file; an added token's string in a text becomes
its id; rows repeat unchanged; columns of the input are kept, and the operators'
own columns replace input columns of the same name.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from veridq.llm.common import ship, slices

#: Fixed value: the file format's pre-token pattern (white space as Unicode defines it).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: The same for texts of characters on which the standard library's classes agree with
#: the pattern's; it is twice as fast.
PLAIN = r"\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20b9"
PLAIN_PATTERN = r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
UNPLAIN = re.compile(rf"[^{PLAIN}]")

CHUNK = 1 << 16  # characters cut into pre-tokens at a time
HELD = 3  # characters after a pre-token that can still change it
CACHED = 500_000  # distinct short pre-tokens remembered per worker
SHORT = 64  # characters
WHOLE = 1 << 20  # characters of a text whose parts are numbered with those of others
MARK = "\x01"  # stands for the end of a word
LETTERS = "[a-z\xdf-\xf6\xf8-\u024f]+"  # letters to all libraries


def byte_names() -> list[str]:
    """The printable stand-in of each byte in the file: itself where it is printable,
    else the next unused code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, spare = [], 256
    for b in range(256):
        names.append(chr(b if b in shown else spare))
        spare += b not in shown
    return names


class Merges:
    """The merge list of a byte-level BPE file, in ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        byte_of = {c: b for b, c in enumerate(names)}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.suffix: str = spec["model"].get("end_of_word_suffix") or ""
        if spec["model"].get("ignore_merges") or spec["model"].get("dropout"):
            raise ValueError("not a plain byte-level BPE file")
        self.first = [vocab[c] for c in names]
        self.final = [vocab[c + self.suffix] for c in names]  # the last byte of a word
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}
        made = {*self.first, *self.final}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if x not in made or y not in made or z in made:
                raise ValueError("the merge list must build each token once, from tokens built before")
            if self.made and z <= self.made[-1] or z in self.final:
                raise ValueError("ids must rise in merge order")
            made.add(z)
            self.rank[x, y] = r
            self.made.append(z)
            self.parts[z] = (x, y)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("added tokens with options are not handled")
            self.special[t["content"]] = t["id"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        self.ends = [False] * size  # tokens that end a word
        for s, i in vocab.items():
            self.ends[i] = bool(self.suffix) and s.endswith(self.suffix)
            self.bytes[i] = bytes(byte_of[c] for c in (s.removesuffix(self.suffix) if self.suffix else s))
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.lookahead = self.sufficient_lookahead()

    def sufficient_lookahead(self) -> int:
        """Bytes after a position that decide whether it is a token boundary.

        A merge (u, v) at a position fails for a reason to the right only if an earlier
        merge takes v's last bytes away: one whose left part is v itself or a token
        on the right edge of v's derivation.  So it needs v's bytes and what such an
        earlier merge needs after them; in rank order that is one pass."""
        need: dict[int, int] = {}  # by left part: most bytes after it that a merge looks at
        size = [len(b) for b in self.bytes]
        most = 1
        for (x, y), _ in sorted(self.rank.items(), key=lambda kv: kv[1]):
            t, tail = y, 0
            while True:
                tail = max(tail, need.get(t, 0))
                if t not in self.parts:
                    break
                t = self.parts[t][1]
            need[x] = max(need.get(x, 0), size[y] + tail)
            most = max(most, need[x])
        return most

    def merge(self, data: bytes) -> list[int]:
        """Ids of a byte string, lowest rank first, leftmost first."""
        ids = [self.first[b] for b in data]
        if ids:
            ids[-1] = self.final[data[-1]]
        return self._scan(ids) if len(ids) <= 24 else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        """For short words: keep the rank of each neighbouring pair, take the least."""
        get, none = self.rank.get, 1 << 60
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = z = self.made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], z), none)
            if i < len(ranks):
                ranks[i] = get((z, ids[i + 1]), none)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (r := rank.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if ids[i] != a or nxt[i] >= n or ids[nxt[i]] != b:
                continue
            j = nxt[i]
            ids[i], ids[j], nxt[i] = self.made[r], -1, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [t for t in ids if t >= 0]


class Transducer:
    """Bytes in, stable ids out; holds at most about four lookaheads of bytes."""

    def __init__(self, merges: Merges):
        self.m, self.buf = merges, bytearray()

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        step = 2 * self.m.lookahead + 64
        for i in range(0, len(data), step):
            self.buf += data[i : i + step]
            if len(self.buf) >= step:
                safe, at = len(self.buf) - self.m.lookahead, 0
                for t in self.m.merge(bytes(self.buf)):
                    end = at + len(self.m.bytes[t])
                    if end > safe:
                        break
                    out.append(t)
                    at = end
                del self.buf[:at]
        return out

    def close(self) -> list[int]:
        out = self.m.merge(bytes(self.buf))
        self.buf.clear()
        return out


class Remembered(dict):
    """Results for short strings, ``CACHED`` at most: those not asked for while half as
    many others came are forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= SHORT:
            if len(self) >= CACHED // 2:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Text to ids (little-endian unsigned 32-bit)."""

    PATTERN, PLAIN_PATTERN = PATTERN, PLAIN_PATTERN

    def __init__(self, path: str):
        self.m = Merges(path)
        self.any = regex.compile(self.PATTERN)
        self.plain = re.compile(self.PLAIN_PATTERN)
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.m.special, key=len, reverse=True)) + ")") if self.m.special else None
        self.words = Remembered(self.word)

    def word(self, word: str) -> bytes:
        data = word.encode()
        if len(data) <= self.m.lookahead:  # the window holds it all
            return array("I", self.m.merge(data)).tobytes()
        t = Transducer(self.m)
        out = array("I", t.feed(data))
        out.extend(t.close())
        return out.tobytes()

    def _run(self, text: str, pos: int, out: list[bytes]) -> int:
        """One pre-token longer than the window, fed in parts."""
        end = self.any.match(text, pos).end()
        t = Transducer(self.m)
        for i in range(pos, end, CHUNK):
            out.append(array("I", t.feed(text[i : min(i + CHUNK, end)].encode())).tobytes())
        out.append(array("I", t.close()).tobytes())
        return end

    def _plain(self, text: str, out: list[bytes]) -> None:
        pos, n, get = 0, len(text), self.words.__getitem__
        find = (self.any if UNPLAIN.search(text) else self.plain).findall
        while pos < n:
            taken = min(CHUNK, n - pos)
            words = find(text, pos, pos + taken)
            if pos + taken < n:
                held = 0
                while words and held < HELD:
                    held += len(words.pop())
                taken -= held
                if not words:
                    pos = self._run(text, pos, out)
                    continue
            out.extend(map(get, words))
            pos += taken

    def encode(self, text: str | None) -> bytes:
        out: list[bytes] = []
        if text:
            if not any(s in text for s in self.m.special):
                self._plain(text, out)
            else:
                for part in self.split.split(text):
                    if part in self.m.special:
                        out.append(array("I", [self.m.special[part]]).tobytes())
                    elif part:
                        self._plain(part, out)
        return b"".join(out)


class Decoder:
    """Ids to text: each id's bytes go through an incremental UTF-8 decoder that
    keeps the bytes of an unfinished character."""

    STEP = 1 << 14

    def __init__(self, merges: Merges):
        self.bytes = merges.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        get = self.bytes.__getitem__
        return self.state.decode(b"".join(map(get, ids)))

    def close(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out

    def decode(self, ids: bytes | None) -> str:
        got = np.frombuffer(ids or b"", dtype="<u4")
        parts = [self.feed(got[i : i + self.STEP].tolist()) for i in range(0, len(got), self.STEP)]
        return "".join(parts) + self.close()


#: Fixed value: the word file's pre-token pattern; white space is dropped.
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
PLAIN_WORD_PATTERN = r"[^\W\d_]+|\d|'(?:[stmd]|re|ve|ll)|(?:[^\s\w]|_)+"


#: Characters whose class is the same in every Unicode version since 6; a text with
#: others goes through the library itself, whose tables may be older or newer.
SETTLED = r"\x00-\u0377\u037a-\u037e\u0384-\u038a\u038c\u038e-\u03a1\u03a3-\u0527\u05d0-\u05ea\u0621-\u064a\u2010-\u2027\u2030-\u205e\u20a0-\u20b9\u2190-\u23f3\u2500-\u26ff\u3001-\u303f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\U0001f600-\U0001f64f"


SEPARATOR = re.compile(r"[\x1c-\x1f]")
WHITE = re.compile(rf"[{SPACE}]")


class WordEncoder(Encoder):
    """Ids of a BPE file with word ends: the text is composed (NFC) and lower-cased
    character by character, and white space between pre-tokens is dropped."""

    PATTERN, PLAIN_PATTERN = WORD_PATTERN, PLAIN_WORD_PATTERN

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # a word's last byte and this mark merge before all others: the byte at a word's end
        mark = b"\xff"
        parts = {bytes([b]): i for b, i in enumerate(self.m.first)} | {bytes([b]) + mark: i for b, i in enumerate(self.m.final)}
        parts |= {self.m.bytes[i] + mark * self.m.ends[i]: i for i in self.m.made}
        self.piece = pieces(parts, WORD_PATTERN).encode_single_piece
        # plain texts have no MARK, and no part of one a line end, which is its own token here
        control = {b.removesuffix(mark) + MARK.encode() * b.endswith(mark): i for b, i in parts.items() if b != mark}
        self.marked = pieces(control, rf"[^\n{MARK}]+{MARK}|\n")
        self.unsettled = regex.compile(rf"[^{SETTLED}]")
        self.parts = Remembered(self._part)

    def word(self, word: str) -> bytes:
        return array("I", self.piece(word.encode() + b"\xff")).tobytes()

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of every text.  The parts of plain texts are numbered together and the
        distinct ones coded in one call."""
        out, at, low = [b""] * len(texts), [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > WHOLE or UNPLAIN.search(text) or any(s in text for s in self.m.special):
                out[i] = self.encode(text)
            else:
                text = text.lower()
                at.append(i)
                low.append(text.replace("\xa0", " "))  # the white space of plain texts that is not ASCII
        if not at:
            return out
        split = pc.ascii_split_whitespace(pa.array(low, pa.large_string()))
        coded = split.values.dictionary_encode()
        ids, first, size = self._distinct(coded.dictionary)
        of = coded.indices.to_numpy()
        n = size[of]
        end = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.repeat(first[of] - end[:-1], n) + np.arange(end[-1])].tobytes()
        ends = end[split.offsets.to_numpy()] * 4  # of the texts, in bytes
        for i, lo, hi in zip(at, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = raw[lo:hi]
        return out

    def _distinct(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts of plain texts, and where each part's begin and how many they are.
        White space at a text's ends gives empty parts, which have none."""
        alpha, dotted = [pc.match_substring_regex(parts, f"^{LETTERS}{end}$").to_numpy(zero_copy_only=False) for end in ("", "[.,;:!?]")]
        kinds = [alpha, dotted, ~(alpha | dotted)]
        order = np.concatenate([np.flatnonzero(k) for k in kinds])
        one, two, rest = [parts.filter(pa.array(k)).to_numpy(zero_copy_only=False) for k in kinds]
        rest = "".join([w + "\n" for w in rest])
        find = self.any if UNPLAIN.search(rest) else self.plain
        text = "".join([w + MARK + "\n" for w in one] + [w[:-1] + MARK + w[-1] + MARK + "\n" for w in two]) + find.sub("\\g<0>" + MARK, rest)
        ids = np.frombuffer(self.marked.encode_to_tiktoken_buffer(text, set()), "<u4")
        ends = np.flatnonzero(ids == self.m.first[10])
        first, size = np.empty_like(ends), np.empty_like(ends)
        first[order] = begin = np.concatenate([[0], ends[:-1] + 1])
        size[order] = ends - begin
        return ids, first, size

    def _part(self, text: str) -> bytes:
        """Lower-cased text between white space.  No pre-token has white space, so a part's
        ids do not depend on its neighbours."""
        if text.isascii():
            if text.isalpha():
                return self.word(text)
            if text[-1] in ".,;:!?" and text[:-1].isalpha():
                return self.parts[text[:-1]] + self.parts[text[-1]]
        find = (self.any if UNPLAIN.search(text) else self.plain).finditer
        return b"".join([self.word(m.group()) for m in find(text)])

    def _plain(self, text: str, out: list[bytes]) -> None:
        if UNPLAIN.search(text):
            if self.unsettled.search(text):
                out.append(array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes())
                return
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")  # no final form of sigma
            if SEPARATOR.search(text):  # split() takes these for white space, the pattern does not
                out.append(self._part(text.lower()))
                return
        text, get, pos = text.lower(), self.parts.__getitem__, 0
        while pos < len(text):  # cut at white space, so that few parts are held at a time
            cut = WHITE.search(text, pos + CHUNK)
            end = cut.start() if cut else len(text)
            out.extend(map(get, text[pos:end].split()))
            pos = end


class RankEncoder(Encoder):
    """The same ids from the library for rank files, which has no cache of words."""

    LONG = re.compile(r"\S{4096}|\s{4096}")

    def __init__(self, path: str):
        super().__init__(path)
        self.ranks = pieces({self.m.bytes[i]: i for i in (*self.m.first, *self.m.made)}, PATTERN)

    def _plain(self, text: str, out: list[bytes]) -> None:
        if self.LONG.search(text):  # long pre-tokens take the windowed way
            super()._plain(text, out)
        else:
            out.append(bytes(self.ranks.encode_to_tiktoken_buffer(text, set())))


def pieces(ids: dict[bytes, int], pattern: str):
    """The rank library's core; its ranks are the ids."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ids, special_tokens={})._core_bpe


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=2)
def rank_encoder(path: str) -> RankEncoder:
    return RankEncoder(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def _mapped(df: DataFrame, drop: tuple[str, ...], add: list[StructField], source: str, make) -> DataFrame:
    """Input columns but ``drop``, then the columns that ``make()(values)`` gives."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    gone = {f.name.lower() for f in add} | {d.lower() for d in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    kind = StructType(kept + add)
    arrow = to_arrow_schema(kind)
    keep = [f.name for f in kept]

    def run(batches):
        fn = make()
        for batch in batches:
            for lo, hi in slices(batch):
                part = batch.slice(lo, hi - lo)
                made = fn(part.column(source).to_pylist())
                cols = [part.column(k) for k in keep] + [pa.array(c, f.type) for c, f in zip(made, list(arrow)[len(keep) :], strict=True)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, kind)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` without ``text`` and with ``ids`` (binary, little-endian unsigned 32-bit)
    and ``n_tokens``."""

    def make():
        enc = encoder(path)

        def fn(texts):
            got = [enc.encode(t) for t in texts]
            return got, [len(g) // 4 for g in got]

        return fn

    return _mapped(df, (text,), [StructField(ids, BinaryType()), StructField("n_tokens", LongType())], text, make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with ``text`` decoded from ``ids``."""

    def make():
        merges = encoder(path).m

        def fn(values):
            dec = Decoder(merges)
            return ([dec.decode(v) for v in values],)

        return fn

    return _mapped(df, (), [StructField(text, StringType())], ids, make)
