"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query: an OR of ANDs of three-letter strings
that every match must hold (``trigram_query``).  The index is a table of postings (trigram, row key)
for the trigrams of those queries, over whole lower-cased texts.  Intersecting postings is one
aggregation: each posting sets its trigram's bit, a row key is a candidate of a rule when the bits of
one of the rule's AND-clauses are all set.  Only candidates run the rule's regular expression; rules
without a mandatory trigram run on every text.

A match is the leftmost, non-overlapping one of the rule's pattern; it counts if the rule's group has
``min_length`` characters.  Rules whose pattern is a run of one character class may give an equivalent
``scan`` pattern with the length in it (a greedy run is maximal, so dropping short runs and asking
for long ones find the same spans); it spares an array of short runs per text.

Defined results: a null text is empty and has no spans; the row key is a hash of id and text, so null
and repeated ids and repeated rows are judged row by row (equal keys only add candidates); an empty
table gives no rows; very long texts are scanned whole; other columns are passed by.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as sre, _parser

from pyspark.sql import Column, DataFrame, functions as F

from knnspark.llm.common import unused, written

ANYTHING = frozenset({frozenset()})
_MOST_STRINGS, _MOST_CLAUSES = 64, 64


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` (group ``group`` of ``min_length`` characters or more); ``scan`` as told above."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    ignore_case: bool = False
    scan: str | None = None

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + (self.scan or self.pattern)


#: Fixed by the query's contract, in its order.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               group=2, min_length=6, ignore_case=True),
    SecretRule("access", r"AKIA[A-Z0-9]+", min_length=20, scan=r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]+", min_length=24, scan=r"[0-9a-f]{24,}"),
)
#: Kinds that this operator adds.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("hook_url", r"https://hooks\.[a-z]+\.com/services/[A-Za-z0-9/]{20,}"),
)
RULES = BASE_RULES + MORE_RULES


# ---------------------------------------------------------------- trigram queries

def _both(a: frozenset, b: frozenset) -> frozenset:
    joined = frozenset(x | y for x in a for y in b)
    return joined if len(joined) <= _MOST_CLAUSES else min(a, b, key=len)


def _needs(strings: frozenset[str]) -> frozenset:
    """The query of texts that hold one of ``strings``."""
    if any(len(s) < 3 for s in strings):
        return ANYTHING
    return frozenset(frozenset(s[k:k + 3] for k in range(len(s) - 2)) for s in strings)


def _walk(nodes) -> tuple[frozenset[str] | None, frozenset]:
    """(all strings that the nodes match, if few; the query of any text with a match)."""
    exact: frozenset[str] = frozenset({""})
    whole, query = True, ANYTHING
    for op, arg in nodes:
        strings, needed = _node(op, arg)
        if strings is not None:
            longer = frozenset(a + b for a, b in itertools.islice(itertools.product(exact, strings), _MOST_STRINGS + 1))
            if len(longer) <= _MOST_STRINGS:
                exact = longer
                continue
        whole = False
        query = _both(query, _needs(exact))
        query = _both(query, needed if strings is None else ANYTHING)
        exact = strings if strings is not None else frozenset({""})
    query = _both(query, _needs(exact))
    return (exact if whole else None), query


def _node(op, arg) -> tuple[frozenset[str] | None, frozenset]:
    if op is sre.LITERAL:
        return frozenset({chr(arg).lower()}), ANYTHING
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
            return frozenset(chr(a).lower() for _, a in arg), ANYTHING
        return None, ANYTHING
    if op is sre.AT:
        return frozenset({""}), ANYTHING
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        found = [_walk(branch) for branch in arg[1]]
        query = frozenset(c for s, q in found for c in (_needs(s) if s is not None else q))
        if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= _MOST_STRINGS:
            return frozenset().union(*(s for s, _ in found)), query
        return None, (query if len(query) <= _MOST_CLAUSES else ANYTHING)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        if low == 0:
            return None, ANYTHING
        return None, (query if strings is None else _needs(strings))
    return None, ANYTHING


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams; ``ANYTHING`` if no trigram is mandatory."""
    strings, query = _walk(_parser.parse(pattern))
    clauses = _needs(strings) if strings is not None else query
    if frozenset() in clauses:
        return ANYTHING
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


# ---------------------------------------------------------------- index and candidates

def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of ``trigrams``: (gram, key), one row for each trigram that a row's text holds."""
    grams = F.array(*(F.lit(g) for g in trigrams))
    held = F.transform(F.array(F.lower("text")), lambda t: F.filter(grams, lambda g: F.contains(t, g)))[0]
    return docs.select(row_key().alias("key"), F.explode(held).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, frozenset]) -> DataFrame:
    """(key, kinds): the rules whose trigram query holds, for row keys with any."""
    grams = sorted({g for q in queries.values() for c in q for g in c})
    words = -(-len(grams) // 62)
    bit = {g: (k // 62, 1 << (k % 62)) for k, g in enumerate(grams)}

    def bits(word: int) -> Column:
        own = [(g, b) for g, (w, b) in bit.items() if w == word]
        value = F.create_map(*(F.lit(x) for g, b in own for x in (g, b)))[F.col("gram")]
        return F.bit_or(F.coalesce(value, F.lit(0))).alias(f"w{word}")

    masks = index.groupBy("key").agg(*(bits(w) for w in range(words)))

    def holds(clause: frozenset) -> Column:
        need = [sum(bit[g][1] for g in clause if bit[g][0] == w) for w in range(words)]
        tests = [F.col(f"w{w}").bitwiseAND(F.lit(n)) == n for w, n in enumerate(need) if n]
        return _all(tests)

    flags = [F.when(_any([holds(c) for c in query]), F.lit(kind)) for kind, query in queries.items()]
    kinds = F.array_compact(F.array(*flags))
    return masks.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


# ---------------------------------------------------------------- verification

_SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _spans(rule: SecretRule, rank: int) -> Column:
    """Spans of a rule in ``text``: code points, end exclusive.

    The text between matches (``split``) and the matches alternate, so their lengths add up to the
    starts of the matches.
    """
    pattern = F.lit(rule.java)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    checked = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else found
    between = F.split("text", rule.java, -1)
    zipped = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("b"), found.alias("m"), checked.alias("g"))
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["b"])
        end = start + F.char_length(x["m"])
        span = F.struct(start.cast("bigint").alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                        end.cast("bigint").alias("end"))
        out = F.when(F.char_length(x["g"]) >= rule.min_length, F.concat(acc["out"], F.array(span).cast(_SPANS))).otherwise(acc["out"])
        return F.struct(end.cast("bigint").alias("at"), out.alias("out"))

    return F.aggregate(zipped, state, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, spans: str = "spans") -> DataFrame:
    """``docs`` with a column ``spans`` (replaced if there): array of (start, rank, kind, end), by start, then the
    rules' order."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ANYTHING}
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    key, kinds = unused(docs, "key", "kinds")
    if indexed:
        grams = sorted({g for q in indexed.values() for c in q for g in c})
        index = written(postings(rows, grams), "trigram-postings")
        found = written(candidates(index, indexed), "secret-candidates").withColumnsRenamed({"key": key, "kinds": kinds})
        rows = rows.withColumn(key, row_key()).join(found, key, "left").drop(key)
    none = F.array().cast(_SPANS)

    def of(rule: SecretRule, rank: int) -> Column:
        test = F.col("text").rlike(rule.java)
        if rule.kind in indexed:
            test = F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)) & test
        return F.when(test, _spans(rule, rank)).otherwise(none)

    return rows.withColumn(spans, F.array_sort(F.concat(*(of(r, k) for k, r in enumerate(rules))))).drop(kinds)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """One row per row of ``scan``: counts of the base kinds, a hash of their spans, and all spans."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scanned.select("doc_id", *(count(r.kind) for r in BASE_RULES), F.sha2(joined(base), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"))


def mask(scanned: DataFrame, with_: str = "*", spans: str = "spans") -> DataFrame:
    """``scanned`` with every character inside a span replaced in ``text``, lengths kept."""
    inside = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"],
                     F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                     F.repeat(F.lit(with_), F.greatest(s["end"] - F.greatest(acc["at"], s["start"]), F.lit(0)).cast("int"))).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return scanned.withColumn("text", F.when(F.size(spans) > 0, inside).otherwise(F.col("text")))


def sql(rules: tuple[SecretRule, ...] = RULES) -> str:
    """DuckDB SQL for ``digest(scan(documents))``."""
    cols, lists = [], []
    for k, r in enumerate(rules):
        pattern = ("(?i)" if r.ignore_case else "") + r.pattern.replace("'", "''")
        cols += [f"regexp_extract_all(t, '{pattern}', 0) AS m{k}", f"regexp_extract_all(t, '{pattern}', {r.group}) AS g{k}",
                 f"string_split_regex(t, '{pattern}') AS b{k}"]
        start = (f"coalesce(list_sum(list_transform(b{k}[1:i], lambda x: length(x))), 0)"
                 f" + coalesce(list_sum(list_transform(m{k}[1:i - 1], lambda x: length(x))), 0)")
        lists.append(f"list_transform(list_filter(range(1, len(m{k}) + 1), lambda i: length(g{k}[i]) >= {r.min_length}),"
                     f" lambda i: {{'s': ({start})::BIGINT, 'r': {k}, 'k': '{r.kind}', 'e': ({start} + length(m{k}[i]))::BIGINT}})")
    text = "array_to_string(list_transform({}, lambda x: x.k || ':' || x.s || ':' || x.e), ',')"
    counts = ", ".join(f"len(list_filter(sp, lambda x: x.k = '{r.kind}'))::BIGINT AS n_{r.kind}" for r in BASE_RULES)
    base = text.format(f"list_filter(sp, lambda x: x.r < {len(BASE_RULES)})")
    return (f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {', '.join(cols)} FROM d),"
            f" s AS (SELECT doc_id, list_sort(list_concat({', '.join(lists)})) AS sp FROM m)"
            f" SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {text.format('sp')} AS spans FROM s")
