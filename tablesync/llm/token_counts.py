"""Token counts of every prefix of a text, by dynamic programming over a byte-level BPE vocabulary.

For each prefix, the last token of its encoding decides the rest: the encoding of ``s`` is that of ``s`` without its
last token, plus that token, and the last token is the only one that ends ``s`` and stays as it is beside the token
before it. So a table of (last token, count) over all prefixes is filled from left to right; candidates for the last
token come from an automaton over the vocabulary, and whether two tokens stay side by side is asked of the
vocabulary's own model, once a pair.

The vocabulary's pre-tokenizer never joins across the begin of a run of white space. A text is therefore cut into
units, white space and what follows up to the next white space; a worker fills the table once for each unit it
meets (``KEEP`` units, then anew) and adds up whole columns of texts. A string of a special token is one token where
it is complete; cut short, it is ordinary text after the unit before it.

``prefix_counts`` keeps the count of every prefix (by code points) with the text: ``tokens_at`` and ``longest_within``
answer from it what a truncation holds and what fits a budget, without encoding again. Counts of prefixes may fall:
four letters can be one token where three are two.

Nulls and empties: null and empty texts have 0 tokens. Null ids stay, rows that repeat id or text are counted each.
Other columns are left out. Long texts are cut nowhere; a worker holds about ``BATCH`` bytes of text at a time, or
one text. Units are told apart by 64-bit fingerprints: of n units in a worker's memory two are taken for one with a
probability of n**2 / 2**65.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import pack, unpack
from tablesync.llm.words import SPACE, Words

KEEP = 1 << 19
BATCH = 3 << 20
LIMIT = 512
LONG = 1 << 12
#: White space beyond ASCII, by its UTF-8 bytes.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

# How a byte-level pre-tokenizer splits ASCII text, and the letters of its alphabet.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
CONTRACTIONS = ("'re", "'ve", "'ll")
OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
#: A byte's letter; 255 never occurs in UTF-8 and parts pieces here.
LETTERS = {b: chr(256 + k) for k, b in enumerate(OTHERS)} | {255: "\n"}


class Units(Words):
    """The units of a list of texts: white space and what follows it; ``breaks``: byte places where one begins in any case."""

    def __init__(self, texts: list[bytes | None], breaks: list[np.ndarray] | None = None):
        parts = [x or b"" for x in texts]
        joined = b"\n".join([*parts, b""])
        self.data = np.frombuffer(joined, np.uint8)
        gap = SPACE[self.data]
        if (self.data >= 0xC2).any():
            for m in WIDE_SPACE.finditer(joined):
                gap[m.start() : m.end()] = True
        size = np.array([len(x) for x in parts], np.int64)
        stop = np.cumsum(size + 1) - 1
        begin = np.zeros(len(self.data) + 1, bool)
        begin[1:-1] = gap[1:] & ~gap[:-1]
        begin[stop - size] = True
        for b, at in zip(stop - size, breaks or []):
            begin[b + at] = True
        begin[stop] = False
        self.start = np.flatnonzero(begin[:-1])
        self.first = np.concatenate(([0], np.searchsorted(self.start, stop))).astype(np.int64)
        self.end = np.append(self.start[1:], len(self.data))
        self.end = np.minimum(self.end, np.repeat(stop, np.diff(self.first)))
        self.n = len(self.start)


class Vocabulary:
    """Prefix tables of a byte-level BPE vocabulary, whose regular pre-tokenizer begins anew at white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import ahocorasick
        from tokenizers import Tokenizer, pre_tokenizers

        own = Tokenizer.from_file(path)
        if own.normalizer is not None or not isinstance(own.pre_tokenizer, pre_tokenizers.ByteLevel) or own.pre_tokenizer.add_prefix_space:
            raise ValueError("prefix counts need a byte-level vocabulary without normalizer or prefix space")
        self.model, self.split = own.model, own.pre_tokenizer.pre_tokenize_str
        special = sorted((t.content for t in own.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special)) if special else None
        self.ends = ahocorasick.Automaton()
        self.text = {token: text for text, token in own.get_vocab(with_added_tokens=False).items()}
        for token, text in self.text.items():
            self.ends.add_word(text, token)
        self.ends.make_automaton()
        self.tokens = max(self.text) + 2
        self.size_of = np.array([len(self.text.get(t, "")) for t in range(self.tokens)], np.int64)
        self.pairs, self.stay = np.array([-1], np.int64), np.zeros(1, bool)
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.counts = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _stays(self, pair: np.ndarray) -> np.ndarray:
        """Whether the model leaves the second token as it is after the first; pairs are numbers, 0 is no token."""
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        if (new := self.pairs[at] != pair).any():
            if len(self.pairs) > KEEP:
                self.pairs, self.stay = self.pairs[:1], self.stay[:1]
            asked = np.unique(pair[new])
            both = [[t - 1 for t in divmod(x, self.tokens) if t] for x in asked.tolist()]
            stay = [[t.id for t in self.model.tokenize("".join(self.text[t] for t in b))] == b for b in both]
            keys, first = np.unique(np.concatenate((self.pairs, asked)), return_index=True)
            self.pairs, self.stay = keys, np.concatenate((self.stay, stay))[first]
            return self._stays(pair)
        return self.stay[at]

    def long_piece(self, letters: str) -> np.ndarray:
        """Token counts of all prefixes of one piece, filled by itself, so that few pieces do not make many short steps."""
        last, count, done = [0] * (len(letters) + 1), [0] * (len(letters) + 1), 0
        known: dict[int, bool] = {}
        for end, token in self.ends.iter(letters):
            end += 1
            if end != done:
                s = end - int(self.size_of[token])
                pair = last[s] * self.tokens + token + 1
                if pair not in known:
                    known[pair] = bool(self._stays(np.array([pair]))[0])
                if known[pair]:
                    last[end], count[end], done = token + 1, count[s] + 1, end
        return np.array(count[1:], np.int32)

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of all prefixes of all pieces, by bytes, one piece after the other; and the pieces' lengths."""
        raw = [x.encode() for x in pieces]
        size = np.array([len(x) for x in raw], np.int64)
        long = {i: self.long_piece(raw[i].decode("latin-1").translate(LETTERS)) for i in np.flatnonzero(size > LONG).tolist()}
        raw = b"\xff".join([*(b"" if i in long else x for i, x in enumerate(raw)), b""])
        data = np.frombuffer(raw, np.uint8)
        stop = np.flatnonzero(data == 255)
        start = np.concatenate(([0], stop[:-1] + 1)).astype(np.int64)
        # a slot for each prefix, the empty one included
        last, count = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int32)
        found = np.fromiter(chain.from_iterable(self.ends.iter(raw.decode("latin-1").translate(LETTERS))), np.int64).reshape(-1, 2)
        end, token = found[:, 0] + 1, found[:, 1]
        depth = end - np.repeat(start, stop - start + 1)[end - 1]
        by = np.argsort(depth, kind="stable")
        end, token, depth = end[by], token[by], depth[by]
        cut = [*np.flatnonzero(np.diff(depth, prepend=-1)).tolist(), len(depth)]
        for i, j in zip(cut, cut[1:]):
            e, t = end[i:j], token[i:j]
            s = e - self.size_of[t]
            stays = self._stays(last[s] * self.tokens + t + 1)
            e = e[stays]
            last[e], count[e] = t[stays] + 1, count[s[stays]] + 1
        out = np.empty(int(size.sum()), np.int32)
        own = np.ones(len(out), bool)
        for i, counts in long.items():
            at = slice(int(size[:i].sum()), int(size[: i + 1].sum()))
            out[at], own[at] = counts, False
        out[own] = count[1:][data != 255]
        return out, size

    def units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of all prefixes of all units, by code points, one unit after the other; and the units' lengths."""
        texts = [u.decode() for u in units]
        pieces: list[str] = []
        many, odd, heads = [], [], []
        for k, x in enumerate(texts):
            own = ASCII_PIECES.findall(x) if x.isascii() else [x[a:b] for _, (a, b) in self.split(x)]
            many.append(len(own))
            pieces += own
            if x[1:2].isspace() and (n := len(x) - len(x.lstrip())) < len(x):
                heads.append((k, n))
            if "'" in x:
                odd += [len(pieces) - len(own) + i for i, p in enumerate(own) if p in CONTRACTIONS]
        place = {x: i for i, x in enumerate(dict.fromkeys([*pieces, *(texts[k][:n] for k, n in heads)]))}
        counts, size = self.pieces(list(place))
        begin = np.cumsum(size) - size
        at = np.array([place[x] for x in pieces], np.int64)
        length = size[at]
        over = np.cumsum(length) - length
        first = np.cumsum(many) - many
        whole = counts[begin[at] + length - 1].astype(np.int64)
        before = np.cumsum(whole) - whole
        before -= np.repeat(before[first], many)
        flat = counts[np.repeat(begin[at] - over, length) + np.arange(length.sum())] + np.repeat(before, length)
        # an apostrophe and a first letter are two pieces until the contraction is whole
        flat[over[odd] + 1] = before[odd] + 2
        data = np.frombuffer(b"".join([*units, b"\0"]), np.uint8)
        flat = flat[(data[1:] & 0xC0) != 0x80]
        points = np.array([len(x) for x in texts], np.int64)
        begins = np.cumsum(points) - points
        for k, n in heads:
            # white space at the end of a prefix is one piece, whatever follows it in the unit
            head = texts[k][:n]
            i = place[head]
            ends = np.cumsum([len(c.encode()) for c in head]) - 1
            flat[begins[k] : begins[k] + n] = counts[begin[i] : begin[i] + size[i]][ends]
        return flat.astype(np.int32), points

    def places(self, u: Units) -> np.ndarray:
        """For each unit, where its counts are kept."""
        if len(self.place) > KEEP:
            self.clear()
        own, first, back = np.unique(u.hashes(lower=False), return_index=True, return_inverse=True)
        at = np.array([self.place.get(h, -1) for h in own.tolist()], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            data = u.data.tobytes()
            counts, size = self.units([data[a:b] for a, b in zip(u.start[first[new]].tolist(), u.end[first[new]].tolist())])
            at[new] = len(self.begin) + np.arange(len(new))
            self.begin = np.concatenate((self.begin, len(self.counts) + np.cumsum(size) - size))
            self.counts, self.size = np.concatenate((self.counts, counts)), np.concatenate((self.size, size))
            self.place.update(zip(own[new].tolist(), at[new].tolist()))
        return at[back]

    def texts(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """For each text, the token counts of its prefixes of 1, 2, ... code points."""
        found = [[m.span() for m in self.special.finditer(t)] if t and self.special else [] for t in texts]
        u = Units(texts, [np.array([x for span in spans for x in span], np.int64) for spans in found])
        at = self.places(u)
        out = []
        for k, spans in enumerate(found):
            i, j = int(u.first[k]), int(u.first[k + 1])
            own = at[i:j]
            size, begin = self.size[own], self.begin[own]
            over = np.concatenate(([0], np.cumsum(size)))
            counts = self.counts[np.repeat(begin - over[:-1], size) + np.arange(over[-1])]
            whole = np.where(size > 0, self.counts[np.maximum(begin + size - 1, 0)], 0) if len(self.counts) else size
            if spans:
                marks = {s for s, _ in spans}
                base = int(u.start[i]) if j > i else 0
                starts = {int(u.start[x]) - base: x - i for x in range(i, j)}
                whole = whole.copy()
                for s, e in spans:
                    x = starts[s]
                    whole[x] = 1
                    word = texts[k][s:e].decode()
                    lead = "" if x == 0 or int(u.start[i + x - 1]) - base in marks else texts[k][int(u.start[i + x - 1]) - base : s].decode()
                    less = int(whole[x - 1]) if lead else 0
                    cut = self.units([(lead + word).encode()])[0][len(lead) :] - less
                    cut[-1] = 1
                    counts[over[x] : over[x] + len(word)] = cut
            before = np.cumsum(whole) - whole
            out.append(counts + np.repeat(before, size).astype(np.int32))
        return out


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(path)

        def out(ids: list, texts: list) -> pa.RecordBatch:
            counts = v.texts(texts)
            ends = [int(c[-1]) if len(c) else 0 for c in counts]
            steps = [pa.compress(pack(np.diff(c, prepend=0).astype(np.int16)), "zstd", asbytes=True) for c in counts]
            cols = [pa.array(x, pa.int64()) for x in (ids, [len(t or b"") for t in texts], [len(c) for c in counts], ends)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(steps, pa.binary())], names=["doc_id", "n_bytes", "n_chars", "n_tokens", "steps"])

        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
                if size >= BATCH:
                    yield out(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield out(ids, texts)

    return run


def prefix_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, steps): ``steps`` packs the token count of every prefix.

    ``tokenizer`` is the path of a byte-level vocabulary file, the same on every machine. Written as a table, the
    rows answer ``tokens_at`` and ``longest_within`` for any prefix and any budget.
    """
    schema = "doc_id long, n_bytes long, n_chars long, n_tokens long, steps binary"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_counts(tokenizer), schema)


def _read(steps: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(pa.decompress(steps, 2 * n, "zstd", asbytes=True), np.int16), dtype=np.int64) if n else np.zeros(0, np.int64)


def _asked(ask) -> Column:
    """A function of (steps, n_chars, number) on whole batches; null for a null number."""

    @F.arrow_udf(T.LongType())
    def answer(steps: pa.Array, n: pa.Array, number: pa.Array) -> pa.Array:
        rows = zip(steps.to_pylist(), n.to_pylist(), number.to_pylist())
        return pa.array([None if x is None else ask(_read(s, k), x) for s, k, x in rows], pa.int64())

    return answer


def tokens_at(chars: Column | int, steps: str = "steps", n_chars: str = "n_chars") -> Column:
    """The number of tokens of the first ``chars`` code points (of all, if there are fewer)."""

    def ask(counts: np.ndarray, x: int) -> int:
        x = min(x, len(counts))
        return int(counts[x - 1]) if x > 0 else 0

    return _asked(ask)(F.col(steps), F.col(n_chars), _number(chars))


def longest_within(tokens: Column | int, steps: str = "steps", n_chars: str = "n_chars") -> Column:
    """The length in code points of the longest prefix of at most ``tokens`` tokens."""

    def ask(counts: np.ndarray, x: int) -> int:
        fits = np.flatnonzero(counts <= x)
        return int(fits[-1]) + 1 if len(fits) else 0

    return _asked(ask)(F.col(steps), F.col(n_chars), _number(tokens))


def _number(x: Column | int) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = prefix_counts(docs, default_tokenizer())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), longest_within(LIMIT).alias("chars_within"))


QUERIES = {"op13_token_counts": op13_token_counts}
ORACLES: dict[str, str] = {}
