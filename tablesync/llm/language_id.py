"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

Learned from labelled documents, all of them: per language, counts of hashed letter trigrams (words in
lower case, padded by their edges) and of scripts. A word's score in a language is the sum of its trigrams'
log probabilities; a language is a candidate where it uses one of the word's scripts. Viterbi finds for each
text the labels of its words with the best sum, less a fixed penalty for each change of language; runs of
one label are spans. The text's language is the one with most letters, its score that share.

The model is of a fixed size for each language (``BUCKETS`` values), with at most ``MOST_LANGUAGES``, more
raise; so it may be broadcast.

Nulls and empties: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing
could be learned. Rows without text or label are not learned from; nor are rows with a null id, which have no
fold. Repeated rows count and are labelled as often as they come. Other columns pass through
``label``; it replaces those named like its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import added, crc_mod, named, numbered, place

BUCKETS = 1 << 16
CHUNKS = 16
MOST_LANGUAGES = 250
BATCH = 4 << 20
CHUNK = 1 << 19
#: First code points of script ranges and their scripts, from the Unicode block list (fixed values).
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x31A0, "han"),
    (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF65, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({s for _, s in SCRIPTS})


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its lower case if it is a letter, else 0; its script's bit."""
    chars = map(chr, range(0x110000))
    low = np.fromiter(((ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in chars), np.uint32, 0x110000)
    begin = np.array([b for b, _ in SCRIPTS])
    bit = np.array([1 << NAMES.index(s) for _, s in SCRIPTS], np.int32)
    return low, np.repeat(bit, np.diff(begin, append=0x110000))


class _Letters:
    """Words (runs of letters) of texts, with the trigram of each letter and of each word's end."""

    def __init__(self, texts: list[str | None]):
        low, script = _tables()
        points = np.frombuffer(("\n".join([x or "" for x in texts]) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        c = low[points]
        on = c != 0
        edge = np.flatnonzero(np.diff(on, prepend=False))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc_at = np.concatenate(([0], np.cumsum([len(x or "") + 1 for x in texts]))).astype(np.int64)
        self.first = np.searchsorted(self.start, self.doc_at)
        b = np.concatenate(([0], c[:-1])).astype(np.uint32)
        a = np.concatenate(([0, 0], c[:-2])).astype(np.uint32)[: len(c)]
        a[b == 0] = 0
        self.gram = ((a * np.uint32(0x85EBCA6B) + b * np.uint32(0xC2B2AE35) + c * np.uint32(0x27D4EB2F)) * np.uint32(0x9E3779B1)) >> np.uint32(16)
        self.used = on | (b != 0)
        self.scripts = np.bitwise_or.reduceat(np.where(on, script[points], 0), self.start) if len(self.start) else np.zeros(0, np.int32)


def _count(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(NAMES)), np.int64)
        seen = False
        for b in batches:
            lang = np.array(b.column(1).to_pylist(), object)
            texts = b.column(0).to_pylist()
            for k, name in enumerate(languages):
                at = np.flatnonzero(lang == name)
                for part in _parts([texts[i] for i in at], CHUNK):
                    seen = True
                    w = _Letters(part)
                    grams[k] += np.bincount(w.gram[w.used], minlength=BUCKETS)
                    for s in range(len(NAMES)):
                        scripts[k, s] += int((w.end - w.start)[(w.scripts >> s & 1) == 1].sum())
        if seen:
            step = BUCKETS // CHUNKS
            rows = [(k, c, grams[k, c * step : (c + 1) * step].tobytes()) for k in range(len(languages)) for c in range(CHUNKS)]
            rows += [(k, CHUNKS, scripts[k].tobytes()) for k in range(len(languages))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["lang", "chunk", "counts"])

    return run


def _parts(texts: list[str], limit: int) -> Iterator[list[str]]:
    now, size = [], 0
    for t in texts:
        now.append(t)
        size += len(t or "")
        if size >= limit:
            yield now
            now, size = [], 0
    if now:
        yield now


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"lang": table.column("lang").slice(0, 1), "chunk": table.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


class Model:
    """``weights``: log probabilities, BUCKETS x languages; ``allowed``: for each script bit, its languages."""

    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray, least_share: float = 0.001):
        self.languages = languages
        smooth = grams + 0.5
        self.weights = np.ascontiguousarray(np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32)) if languages else np.zeros((BUCKETS, 0), np.float32)
        self.allowed = (scripts >= least_share * np.maximum(scripts.sum(1, keepdims=True), 1)) & (scripts > 0)

    def scores(self, w: _Letters) -> np.ndarray:
        """Words x languages."""
        begin = w.start
        every = np.where(w.used, w.gram, 0)
        per = np.empty((len(begin), len(self.languages)), np.float32)
        edges = np.stack((w.start, w.end + 1), 1).reshape(-1)
        for k in range(len(self.languages)):
            x = self.weights[:, k][every]
            x[~w.used] = 0
            per[:, k] = np.add.reduceat(np.append(x, np.float32(0)), edges)[0::2]
        bits = (w.scripts[:, None] >> np.arange(len(NAMES)) & 1).astype(bool)
        fits = np.stack([(bits & row).any(1) for row in self.allowed], 1)
        per[~fits & fits.any(1)[:, None]] -= 1000
        return per


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; all texts go one word further at each step. Ties go to the lower label."""
    many = np.diff(first)
    order = np.argsort(-many, kind="stable")
    begin, many = first[:-1][order], many[order]
    label = np.zeros(len(score), np.int32)
    if not len(score):
        return label
    switch = np.zeros(score.shape, bool)
    best = np.zeros(len(score), np.int32)
    active = np.searchsorted(-many, -np.arange(int(many[0])), "left")  # texts with more than t words
    v = score[begin[: active[0]]].astype(np.float64)
    last = np.zeros(active[0], np.int32)
    for t in range(1, int(many[0])):
        n = active[t]
        if n < len(v):
            last[n : len(v)] = v[n:].argmax(1)
            v = v[:n]
        at = begin[:n] + t
        top = v.argmax(1)
        high = v[np.arange(n), top][:, None] - penalty
        s = high > v
        switch[at], best[at] = s, top
        v = np.where(s, high, v) + score[at]
    last[: len(v)] = v.argmax(1)
    for t in range(int(many[0]) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        label[at] = last[:n]
        if t:
            last[:n] = np.where(switch[at, last[:n]], best[at], last[:n])
    return label


def _words(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its start and end in its text and its scores; each text's first word, with their number.

    Letters take much more memory than words, so they go ``CHUNK`` at a time.
    """
    start, end, scores, many = [], [], [], []
    for part in _parts(texts, CHUNK):
        w = _Letters(part)
        many.append(np.diff(w.first))
        begin = np.repeat(w.doc_at[:-1], many[-1])
        start.append(w.start - begin)
        end.append(w.end - begin)
        scores.append(model.scores(w) if model.languages else np.zeros((len(begin), 0), np.float32))
    return np.concatenate(start), np.concatenate(end), np.concatenate(scores), np.concatenate(([0], np.cumsum(np.concatenate(many))))


def _predict(model_of, penalty: float, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_of.value
        for b in batches:
            names = list(b.schema.names)
            lo = 0
            for part in _parts(b.column(names.index("__text")).to_pylist(), BATCH):
                own = b.slice(lo, len(part))
                lo += len(part)
                start, end, scores, first = _words(model, part)
                langs = len(model.languages)
                many = len(part)
                doc = np.repeat(np.arange(many), np.diff(first))
                if langs and len(doc):
                    label = viterbi(scores, first, penalty)
                    share = np.bincount(doc * langs + label, (end - start).astype(float), many * langs).reshape(many, langs)
                else:
                    label, share = np.zeros(len(doc), np.int32), np.zeros((many, max(langs, 1)))
                top, total = share.argmax(1), share.sum(1)
                lang = [model.languages[i] if n else "und" for i, n in zip(top, total)]
                score = np.where(total > 0, share.max(1) / np.maximum(total, 1), 0.0)
                cols = [*own.columns[: len(names) - 1], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                out = [*names[:-1], "lang_pred", "score"]
                if spans:
                    each: list[list] = [[] for _ in part]
                    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0)) if total.any() else []
                    for i, j in zip(new, [*new[1:], len(doc)]):
                        d = int(doc[i])
                        each[d].append({"start": int(start[i]), "end": int(end[j - 1]), "lang": model.languages[label[i]]})
                    cols.append(pa.array(each, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
                    out.append("lang_spans")
                yield pa.RecordBatch.from_arrays(cols, names=out)

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all rows with text and language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    got = added(rows.mapInArrow(_count(languages), "lang int, chunk int, counts binary"), ["lang", "chunk"], _add).collect()
    grams, scripts, step = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), len(NAMES))), BUCKETS // CHUNKS
    for r in got:
        x = np.frombuffer(bytes(r["counts"]), np.int64)
        if r["chunk"] == CHUNKS:
            scripts[r["lang"]] = x
        else:
            grams[r["lang"], r["chunk"] * step : (r["chunk"] + 1) * step] = x
    return Model(languages, grams, scripts)


def label(docs: DataFrame, model: Model, text: str = "text", penalty: float = 12.0, spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred string, score double and, with ``spans``, lang_spans (code points, end exclusive).

    ``penalty``: what a change of language costs, in nats.
    """
    own, new = numbered(docs), ("lang_pred", "score", *["lang_spans"] * spans)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema) + ", lang_pred string, score double"
    schema += ", lang_spans array<struct<start:int,end:int,lang:string>>" * spans
    out = own.withColumn("__text", F.col(place(docs, text))).mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model), penalty, spans), schema)
    return out.select(*named(docs, new), *new)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = crc_mod("doc_id", 4)
    model = fit(docs.filter(fold != 2))
    out = label(docs.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op3_language_id": op3_language_id}
ORACLES: dict[str, str] = {}
