"""Collocations against plain counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablesync.llm import collocations


def pieces(t):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, most=3, least=10, best=2000, share=50):
    f, n = defaultdict(Counter), Counter()
    for lang, t in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(t):
            n[lang] += len(ws)
            for k in range(1, most + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        wanted = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in wanted.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        rows = []
        for p, a in wanted.items():
            if p in inside and 100 * inside[p] >= share * a:
                continue
            score, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, n[lang], score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:best], 1)]
    return sorted(out)


def drawn(n, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "aé", "New", "york", "ba.d", "x-1", "\x00nul", *(f"w{i}" for i in range(30))]
    odd = [" ", "  ", "\t", ", ", ". ", "!\n", "\x0b", " new york city ", " of the of the of "]
    return [(rng.choice(["en", "de", "", "line\nend\\", None]), "".join(rng.choice(vocabulary[: rng.randrange(3, 39)]) + rng.choice([" "] * 9 + odd) for _ in range(rng.randrange(60)))) for _ in range(n)]


ODD = [("en", None), (None, ""), ("en", " \t "), ("xx", ",,;"), ("hot", "aa " * 5000), ("hot", "aa bb " * 3000 + "aa aa cc " * 2000), (None, "no language " * 20)]


def frame(spark, docs):
    return spark.createDataFrame([(x, t, "clash", 1) for x, t in docs], "lang string, text string, word string, k int").repartition(3)


@pytest.mark.parametrize("budget,block,most,least", [(1 << 20, 8 << 20, 3, 10), (400, 4000, 3, 10), (50, 3000, 3, 12), (30, 5000, 5, 4), (400, 5000, 2, 10)])
def test_equals_plain_counts(spark, monkeypatch, budget, block, most, least):
    """With small budgets prefixes of every length occur, and nodes above them take their counts from the lengthening."""
    monkeypatch.setattr(collocations, "BUDGET", budget)
    monkeypatch.setattr(collocations, "BLOCK", block)
    docs = drawn(250, budget) + ODD
    got = collocations.collocations(frame(spark, docs), most=most, least=least, best=150)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, most, least, 150)


def test_all_phrases_and_no_rows(spark):
    docs = drawn(80, 5)
    assert sorted(map(tuple, collocations.collocations(frame(spark, docs), best=None, share=101).collect())) == brute(docs, best=None, share=101)
    assert collocations.collocations(frame(spark, docs).limit(0)).count() == 0
    assert collocations.collocations(frame(spark, [("en", None), (None, "one two")])).count() == 0


def test_prefixes_are_lengthened_as_their_counts_ask(monkeypatch):
    s = collocations.Suffixes(["en"], [b"a a a a a a b c. a b d b"], 3)
    heavy = collocations.Heavy()
    keys = lambda k, words: collocations.chained([w[:1] for w in collocations.Suffixes(["en"], [words], 3).words], k).view(np.int64).tolist()
    heavy.add(keys(1, b"a"), [7])
    heavy.add(keys(2, b"a a"), [5])
    # a a a: four times, a a b, a b c, b c and c, then a b d, b d b, d b, b
    assert heavy.lengths(s.words).tolist() == [3, 3, 3, 3, 3, 2, 1, 1, 2, 1, 1, 1]
    assert heavy.count(2, np.array(keys(2, b"a a")).view(np.uint64)).tolist() == [5]


def test_a_hot_phrase_is_one_entry_of_a_block(spark, monkeypatch):
    s = collocations._suffixes(3, 4, collocations.Heavy())
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(["hot words here. " * 400] * 50)], names=["lang", "text"])
    sent = [b.to_pylist()[0] for b in s(iter([batch]))]
    assert sum(len(collocations._unzip(x["n"], np.uint32)) for x in sent) == 3 and sum(int(collocations._unzip(x["n"], np.uint32).sum()) for x in sent) == 3 * 400 * 50


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of 10**12: scores are exact where products take 30 digits."""
    big = 10**12 + 39
    words = spark.createDataFrame([("en", 1, "a", big + 7), ("en", 2, "b", big + 11), ("en", None, None, 5 * big)], "lang string, key long, word string, f long")
    nodes = spark.createDataFrame([(2, 1, 2, None, big, big + 7, None)], "k long, w1 long, w2 long, w3 long, a long, l1 long, l2 long")
    monkeypatch.setattr(collocations, "phrases", lambda *_: (words, nodes))
    assert tuple(collocations.collocations(None).first()) == ("en", 1, "a b", big, big + 7, big + 11, 5 * big, 1000000 * big * big // ((big + 7) * (big + 11)))
