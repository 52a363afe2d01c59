"""Language ID by plain loops: counts, scores, Viterbi and shares, for whole texts."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from tablesync.llm import language_id
from tablesync.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FULL = (1 << 32) - 1


def words(text):
    """(start, end) of runs of letters."""
    out, begin = [], None
    for i, c in enumerate((text or "") + "\n"):
        if c.isalpha() and begin is None:
            begin = i
        elif not c.isalpha() and begin is not None:
            out.append((begin, i))
            begin = None
    return out


def grams(word):
    low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in word]
    for i in range(len(low) + 1):
        c = low[i] if i < len(low) else 0
        b = low[i - 1] if i else 0
        a = low[i - 2] if i > 1 else 0
        yield (((a * 0x85EBCA6B + b * 0xC2B2AE35 + c * 0x27D4EB2F) & FULL) * 0x9E3779B1 & FULL) >> 16


def scripts(word):
    return {next(s for begin, s in reversed(language_id.SCRIPTS) if begin <= ord(c)) for c in word}


class Brute:
    def __init__(self, labelled):
        self.languages = sorted({lang for t, lang in labelled if t is not None and lang is not None})
        count, used = defaultdict(Counter), defaultdict(Counter)
        for t, lang in labelled:
            if t is None or lang is None:
                continue
            for i, j in words(t):
                count[lang].update(grams(t[i:j]))
                for s in scripts(t[i:j]):
                    used[lang][s] += j - i
        self.weight = {k: (lambda c, total: lambda g: math.log((c[g] + 0.5) / total))(count[k], sum(count[k].values()) + 0.5 * language_id.BUCKETS) for k in self.languages}
        self.allowed = {k: {s for s, n in used[k].items() if n >= 0.001 * sum(used[k].values())} for k in self.languages}

    def predict(self, text, penalty=12.0):
        own = words(text)
        if not own or not self.languages:
            return "und", 0.0, []
        scores = []
        for i, j in own:
            word = text[i:j]
            fits = {k for k in self.languages if scripts(word) & self.allowed[k]}
            scores.append([sum(self.weight[k](g) for g in grams(word)) - 1000 * (bool(fits) and k not in fits) for k in self.languages])
        n = len(self.languages)
        best, back = [scores[0]], []
        for s in scores[1:]:
            came = []
            for k in range(n):
                stay, top = best[-1][k], max(range(n), key=lambda x: (best[-1][x], -x))
                came.append(top if best[-1][top] - penalty > stay else k)
            back.append(came)
            best.append([max(best[-1][k], max(best[-1]) - penalty) + s[k] for k in range(n)])
        label = [max(range(n), key=lambda x: (best[-1][x], -x))]
        for came in reversed(back):
            label.append(came[label[-1]])
        label.reverse()
        share = Counter()
        for (i, j), k in zip(own, label):
            share[k] += j - i
        top = min(share, key=lambda k: (-share[k], k))
        spans = []
        for (i, j), k in zip(own, label):
            if spans and spans[-1][2] == self.languages[k]:
                spans[-1] = (spans[-1][0], j, spans[-1][2])
            else:
                spans.append((i, j, self.languages[k]))
        return self.languages[top], share[top] / sum(share.values()), spans


def test_query_against_plain_loops(spark):
    docs = {r["doc_id"]: (r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    model = Brute([v for i, v in docs.items() if fold(i) != 2])
    got = QUERIES["op3_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        lang, score, _ = model.predict(docs[r["doc_id"]][0])
        assert r["lang_pred"] == lang and math.isclose(r["score"], score, abs_tol=1e-9) and r["held_out"] == (fold(r["doc_id"]) == 2), r


@pytest.mark.parametrize("penalty", [0.5, 12.0])
def test_spans_of_mixed_scripts_and_languages(spark, penalty):
    learn = [("the cat and the dog were here with them all", "en"), ("der Hund und die Katze waren größer als ihr", "de"), ("кошка и собака были здесь со всеми", "ru"), ("η γάτα και ο σκύλος ήταν εδώ", "el"), (None, "xx"), ("no label", None)]
    texts = ["the dog und die Katze waren кошка была там and them", "ΓΆΤΑ dog собака", "größer the", "漢字 かな the", "İstanbul ǅ ŉ", "", None, "123 !", "the " * 3000 + "und die " * 3000]
    model = language_id.fit(spark.createDataFrame(learn, "text string, lang string"))
    rows = language_id.label(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), model, penalty=penalty, spans=True).collect()
    brute = Brute(learn)
    for r in rows:
        lang, score, spans = brute.predict(texts[r["i"]], penalty)
        assert r["lang_pred"] == lang and math.isclose(r["score"], score, abs_tol=1e-9) and [tuple(x) for x in r["lang_spans"]] == spans, texts[r["i"]]
