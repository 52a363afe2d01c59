"""Secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an OR of ANDs of trigrams (of text
in lower case) that any match must hold. The index lists, for every trigram that some query names, the rows
whose text holds it; a rule's postings are intersected and only its candidates are verified with the
expression itself. A rule without mandatory trigrams scans all texts.

Matches are leftmost and do not overlap within a rule; a match that fails the rule's least lengths is
dropped but keeps its place. Offsets are code points, end exclusive.

Nulls and empties: a null or empty text has no spans. Repeated rows each get the same result. A null id is
an id like any other. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import named, numbered, place, row_key


@dataclass(frozen=True)
class Rule:
    """``group``'s match must have ``least`` code points."""

    kind: str
    regex: str
    group: int
    least: int


#: The base kinds in their fixed order, as the contract gives them; a run that is too short can hold no
#: longer one, so the last two ask for the least length at once.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Further kinds: public formats of credentials.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
)
RULES = BASE + MORE
MOST_EXACT = 64
#: Elements or code points that are worked through from their start at a time.
STRIDE = 1024


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Sets of trigrams of which a match, in lower case, holds at least one whole set; [] if it may hold none.

    A sequence keeps the set of strings it can be so far; where that set can't go on (a large class, an open
    repeat), each string's trigrams become one alternative, and the sequence starts anew.
    """
    clauses: list[frozenset[str]] = [frozenset()]

    def strings(op, arg) -> set[str] | None:
        """All strings of an item, if they are few."""
        name = str(op)
        if name == "LITERAL":
            return {chr(arg).lower()}
        if name == "IN":
            if all(str(o) == "LITERAL" for o, _ in arg):
                return {chr(a).lower() for _, a in arg}
            return None
        if name == "SUBPATTERN":
            return whole(arg[3])
        if name == "BRANCH":
            each = [whole(x) for x in arg[1]]
            return None if None in each else set().union(*each)
        if name == "MAX_REPEAT" and arg[1] != parser.MAXREPEAT and arg[1] <= 3:
            one = whole(arg[2])
            return None if one is None else {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(sorted(one), repeat=n)}
        return None

    def whole(items) -> set[str] | None:
        now = {""}
        for op, arg in items:
            if (s := strings(op, arg)) is None or len(now) * len(s) > MOST_EXACT:
                return None
            now = {a + b for a in now for b in s}
        return now

    def flush(now: set[str]) -> None:
        nonlocal clauses
        own = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in now}
        if frozenset() not in own:
            own = {a for a in own if not any(b < a for b in own)}
            clauses = sorted({a | b for a in clauses for b in own}, key=sorted)

    now = {""}
    for op, arg in parser.parse(regex):
        s = strings(op, arg)
        if s is None or len(now) * len(s) > MOST_EXACT:
            flush(now)
            now = {""} if s is None or len(s) > MOST_EXACT else s
        else:
            now = {a + b for a in now for b in s}
    flush(now)
    return [] if frozenset() in clauses else clauses


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): for rows (key, text), the numbers of the indexed rules whose trigram query holds."""
    queries = [(r, c, clause) for r, rule in enumerate(rules) for c, clause in enumerate(trigram_query(rule.regex))]
    grams = sorted({t for _, _, clause in queries for t in clause})
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(F.array(*map(F.lit, grams)), lambda t: F.contains(low, t)))[0]
    postings = docs.select("key", F.explode(held).alias("gram"))
    wanted = docs.sparkSession.createDataFrame([(t, r, c, len(clause)) for r, c, clause in queries for t in clause], "gram string, rule int, clause int, need int")
    both = postings.distinct().join(F.broadcast(wanted), "gram").groupBy("key", "rule", "clause", "need").agg(F.count("*").alias("have"))
    return both.filter("have = need").groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often a function inside names it."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For an array of whole numbers of 0 or more, the fold of those before each place (0 at the first).

    An array that grows by one is copied each time, so parts of ``STRIDE`` are folded by themselves, and then their
    totals: the work grows nearly with the length.
    """
    none = F.array().cast("array<int>")

    def running(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), none.alias("out"))
        return F.aggregate(x, start, lambda acc, v: F.struct(fold(acc["sum"], v).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")))

    def within(own: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(own), F.lit(STRIDE)), lambda i: i < F.size(own))
        parts = F.transform(starts, lambda i: running(F.slice(own, i + 1, F.lit(STRIDE))))
        return _bound(parts, lambda p: _bound(running(F.transform(p, lambda x: x["sum"]))["out"], lambda base: F.flatten(F.zip_with(p, base, lambda x, y: F.transform(x["out"], lambda v: fold(v, y))))))

    return _bound(values, within)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Sorted structs (start, order, end, kind) of a rule's matches in ``text``."""
    pattern = rf"(?s)\G(.*?)({rule.regex})"  # \G: no new start after the last match
    part = lambda g: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)), F.length)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def placed(found: Column) -> Column:
        before = _before(F.transform(found, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)

        def span(x: Column, at: Column) -> Column:
            start = at + x["gap"]
            return F.struct(start.alias("start"), F.lit(order).alias("order"), (start + x["hit"]).alias("end"), F.lit(rule.kind).alias("kind"), x["own"].alias("own"))

        kept = F.filter(F.zip_with(found, before, span), lambda x: x["own"] >= rule.least)
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["order"].alias("order"), x["end"].alias("end"), x["kind"].alias("kind")))

    found = _bound(F.arrays_zip(part(1).alias("gap"), part(2).alias("hit"), part(2 + rule.group).alias("own")), placed)
    return F.when(F.rlike(text, F.lit(rule.regex)), found).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", to: str = "spans") -> DataFrame:
    """``docs`` with array ``to`` of structs (start, order, end, kind): all spans by start, then rule order.

    A column named like ``to`` is replaced.
    """
    body, key, found = "__text", "__key", "__rules"
    at = place(docs, text)
    keyed = numbered(docs).withColumns({body: F.coalesce(F.col(at), F.lit("")), key: row_key(at, at)})
    cands = candidates(keyed.select(F.col(key).alias("key"), F.col(body).alias("text")), rules).select(F.col("key").alias(key), F.col("rules").alias(found))
    joined = keyed.join(cands, key, "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    each = []
    for n, rule in enumerate(rules):
        s = _spans(F.col(body), rule, n)
        each.append(F.when(F.array_contains(found, n), s).otherwise(none) if trigram_query(rule.regex) else s)
    return joined.select(*named(docs, (to.lower(),)), F.array_sort(F.flatten(F.array(*each))).alias(to))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in square brackets; null stays null.

    Where spans overlap, the first one's name stands for all they cover.
    """

    at = place(docs, text)
    wide = F.regexp_extract_all(F.col(at), F.lit(rf"(?s).{{1,{STRIDE}}}"), F.lit(0))

    def clean(spans: Column) -> Column:
        ends = _before(F.transform(spans, lambda x: x["end"]), F.greatest)

        def pieces(cut: Column) -> Column:
            def part(start: Column, end: Column) -> Column:
                """Code points from ``start`` to ``end``, without a walk from the text's start."""
                first, last = F.floor(start / STRIDE).cast("int"), F.floor((end - 1) / STRIDE).cast("int")
                inside = F.substring(cut[first], start % STRIDE + 1, end - start)
                over = F.concat(F.substring(cut[first], start % STRIDE + 1, F.lit(STRIDE)), F.array_join(F.slice(cut, first + 2, last - first - 1), ""), F.substring(cut[last], F.lit(1), end - last * STRIDE))
                return F.when(start >= end, F.lit("")).when(first == last, inside).otherwise(over)

            def piece(x: Column, done: Column) -> Column:
                return F.when(x["start"] >= done, F.concat(part(done, x["start"]), F.lit("["), x["kind"], F.lit("]"))).otherwise(F.lit(""))

            most = F.array_max(F.transform(spans, lambda x: x["end"]))
            rest = F.when(most < F.length(at), part(most, F.length(at))).otherwise(F.lit(""))
            return F.concat(F.array_join(F.zip_with(spans, ends, piece), ""), rest)

        return _bound(wide, pieces)

    found = scan(numbered(docs), rules, at, "__spans")
    return found.withColumn(at, F.when(F.size("__spans") > 0, _bound(F.col("__spans"), clean)).otherwise(F.col(at))).select(*named(docs))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    count = lambda n: F.size(F.filter("spans", lambda s: s["order"] == n)).cast("long")
    return scan(docs).select("doc_id", *(count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


QUERIES = {"op6_secret_scan": op6_secret_scan}


def _sql() -> str:
    """Each rule's matches as (gap, match) pairs from the text's start; places are running sums of their lengths."""
    quoted = lambda x: x.replace("'", "''")
    each = []
    for n, r in enumerate(RULES):
        part = lambda g, r=r: f"regexp_extract_all(t, '(?s)(.*?)({quoted(r.regex)})', {g})"
        each.append(f"SELECT r, {n} AS o, '{r.kind}' AS kind, {r.least} AS least, unnest({part(1)}) AS gap, unnest({part(2)}) AS hit, unnest({part(2 + r.group)}) AS own, unnest(range(len({part(0)}))) AS i FROM d")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(each)}),
p AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY r, o ORDER BY i) AS BIGINT) AS stop FROM m),
s AS (SELECT r, o, kind, stop - length(hit) AS start, stop, kind || ':' || (stop - length(hit)) || ':' || stop AS span FROM p WHERE length(own) >= least),
g AS (SELECT r, count(*) FILTER (WHERE o = 0) AS a, count(*) FILTER (WHERE o = 1) AS b, count(*) FILTER (WHERE o = 2) AS c,
             string_agg(span, ',' ORDER BY start, o) FILTER (WHERE o < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, o) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
"""


ORACLES = {"op6_secret_scan": _sql()}
