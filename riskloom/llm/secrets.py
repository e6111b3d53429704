"""Secrets in texts: regular expressions that are tried where a trigram index allows it.

A rule's regular expression is turned into a Boolean query over trigrams: which sets of three
neighbouring characters every match must contain (lower case, so that rules of either case
share one index). ``trigram_index`` holds, per segment of documents and trigram, the documents
of the segment that contain it, as the bits of one integer. A rule's postings are intersected
and united bit by bit, and its expression runs on what is left, over whole texts. A rule that
has no mandatory trigram (``hex``) runs on every text.

Documents are dealt to segments by a hash, with their texts, once; the index of a segment is
built and read where its documents are, so neither postings nor texts move again. Two
documents of a segment may share a bit: then both are candidates, and the expression decides.
A document is one row of one segment, however long; its trigrams are found in pieces. Equal
texts of different ids fall into different segments.

All of it is expressions of Spark. Positions are found without a match offset function: a
text is split at the matches, so the lengths of pieces and matches add up to the positions.

Defined cases: a null text counts as empty and has no spans; every row has one result, also
repeated ids and rows; an empty table gives an empty one; other columns are ignored, whatever
their names. Spans of one kind never overlap, spans of different kinds may.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as code
from re import _parser as regular

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Documents per segment, one bit each.
SEGMENT = 64
# Characters whose trigrams are taken at once; bounds memory whatever the length of a text.
PIECE = 1 << 16
# Strings, or alternatives of a query, beyond which a query is made weaker, never wrong.
_MOST = 64


@dataclass(frozen=True)
class Rule:
    """Non-overlapping matches from the left whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False

    @property
    def expression(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The three kinds that are asked for. In ``access`` and ``hex`` a run that is
# too short holds no other match, so their least length is written into the expression; an
# assignment that is too short takes its characters away from a later one.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Published forms of credentials.
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + FURTHER


# ---- From an expression to a query ----------------------------------------------------

# A query is a set of alternatives, each a set of trigrams that must all occur. The query
# that is always true has one alternative without trigrams.
Query = frozenset[frozenset[str]]
_TRUE: Query = frozenset([frozenset()])


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams (lower case) of which every match has one in full."""
    return _sequence(regular.parse(pattern))


def _least(query: set[frozenset[str]]) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(x: Query, y: Query) -> Query:
    joined = _least({a | b for a, b in product(x, y)})
    return joined if len(joined) <= _MOST else min(x, y, key=len)


def _of_strings(strings: set[str]) -> Query:
    # Beyond ASCII, two libraries need not agree on lower case.
    grams = ({s[i : i + 3] for i in range(len(s) - 2)} for s in strings)
    return _least({frozenset(filter(str.isascii, g)) for g in grams})


def _sequence(items) -> Query:
    """Runs of parts that have few values give trigrams; others are asked by themselves."""
    query, run = _TRUE, {""}
    for item in items:
        values = _values(item)
        if values is not None and len(run) * len(values) <= _MOST:
            run = {a + b for a, b in product(run, values)}
            continue
        query = _both(query, _of_strings(run))
        run = values if values is not None else {""}
        if values is None:
            query = _both(query, _part(item))
    return _both(query, _of_strings(run))


def _part(item) -> Query:
    kind, told = item
    if kind is code.SUBPATTERN:
        return _sequence(told[-1])
    if kind is code.BRANCH:
        return _least(set().union(*map(_sequence, told[1])))
    if kind in (code.MAX_REPEAT, code.MIN_REPEAT) and told[0] >= 1:
        return _sequence(told[2])
    return _TRUE


def _values(item) -> set[str] | None:
    """All texts a part can stand for, lower case; None if there are many."""
    kind, told = item
    if kind is code.LITERAL:
        return {chr(told).lower()}
    if kind in (code.AT, code.ASSERT, code.ASSERT_NOT):
        return {""}
    if kind is code.IN:
        if all(k is code.LITERAL for k, _ in told):
            return {chr(c).lower() for _, c in told}
        return None
    if kind is code.SUBPATTERN:
        return _texts(told[-1])
    if kind is code.BRANCH:
        options = [_texts(branch) for branch in told[1]]
        return None if None in options else set().union(*options)
    if kind in (code.MAX_REPEAT, code.MIN_REPEAT) and told[1] <= 4:
        once, out = _texts(told[2]), set()
        if once is None or len(once) ** int(told[1]) > _MOST:
            return None
        for times in range(told[0], told[1] + 1):
            out |= {"".join(p) for p in product(once, repeat=times)}
        return out
    return None


def _texts(items) -> set[str] | None:
    texts = {""}
    for item in items:
        values = _values(item)
        if values is None or len(texts) * len(values) > _MOST:
            return None
        texts = {a + b for a, b in product(texts, values)}
    return texts


# ---- Index and candidates -------------------------------------------------------------


def _dealt(documents: DataFrame) -> DataFrame:
    """``doc_id, text, segment``, a segment of about ``SEGMENT`` documents in one task."""
    slim = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    segments = max(1, -(-slim.count() // SEGMENT))
    segment = F.pmod(F.xxhash64("doc_id", "text"), F.lit(segments).cast("bigint"))
    # Known not to be null, so that no side of the join gets a filter of its own and both
    # read one exchange.
    segment = F.coalesce(segment, F.lit(0).cast("bigint"))
    return slim.withColumn("segment", segment).repartition("segment")


def _bit() -> Column:
    """The document's bit in its segment. It takes another hash than the segment."""
    return F.pmod(F.hash("doc_id", "text"), F.lit(SEGMENT))


def _trigrams(text: Column) -> Column:
    return F.array_distinct(
        F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1))
    )


def _index(dealt: DataFrame) -> DataFrame:
    last = F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / PIECE)
    pieces = dealt.withColumn("bit", _bit()).select(
        "segment",
        "bit",
        F.explode(
            F.transform(
                F.sequence(F.lit(0).cast("bigint"), last),
                lambda p: F.substring("text", (p * PIECE + 1).cast("int"), F.lit(PIECE + 2)),
            )
        ).alias("piece"),
    )
    grams = pieces.select("segment", "bit", F.explode(_trigrams(F.col("piece"))).alias("trigram"))
    own = F.expr("shiftleft(1L, bit)")
    return grams.groupBy("segment", "trigram").agg(F.bit_or(own).alias("documents"))


def trigram_index(documents: DataFrame) -> DataFrame:
    """``segment, trigram, documents``: all trigrams of all documents, as bits."""
    return _index(_dealt(documents))


def _candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Per segment, for each rule that has a query, the documents that meet it, as bits.

    The postings are picked by conditions inside one aggregate per segment, not by a filter:
    a segment's index is in one task, and is read once for all rules.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != _TRUE}
    wanted = sorted(set().union(*(a for q in queries.values() for a in q)))
    # Names of columns, as a trigram may hold any character.
    name = {t: f"t{i}" for i, t in enumerate(wanted)}
    postings = index.groupBy("segment").agg(
        *[
            F.coalesce(
                F.bit_or(F.when(F.col("trigram") == t, F.col("documents"))),
                F.lit(0).cast("bigint"),
            ).alias(name[t])
            for t in wanted
        ]
    )

    def of(query: Query) -> Column:
        every = [
            reduce(Column.bitwiseAND, [F.col(name[t]) for t in sorted(a)])
            for a in sorted(query, key=sorted)
        ]
        return reduce(Column.bitwiseOR, every)

    return postings.select("segment", *[of(q).alias(f"may_{k}") for k, q in queries.items()])


# ---- Matches --------------------------------------------------------------------------


def _spans(rule: Rule, order: int) -> Column:
    """``start, order, end`` of all matches of a rule in the whole text, in code points."""
    text, pattern = F.col("text"), rule.expression
    matches = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)).alias("counted"),
    )
    kind = "array<struct<start: int, order: int, end: int>>"

    def step(seen: Column, match: Column) -> Column:
        start = seen["at"] + F.length(match["before"])
        end = start + F.length(match["found"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"))
        long_enough = F.length(match["counted"]) >= rule.least
        return F.struct(
            end.alias("at"),
            F.when(long_enough, F.concat(seen["spans"], F.array(span).cast(kind)))
            .otherwise(seen["spans"])
            .alias("spans"),
        )

    none = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    walked = F.aggregate(matches, none, step, lambda seen: seen["spans"])
    return F.when(F.rlike(text, F.lit(pattern)), walked).otherwise(F.array().cast(kind))


def scanned(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans`` of every document: kind, start and end of every secret.

    Spans are ordered by start, then by the place of their rule; positions are code points,
    the end is exclusive.
    """
    dealt = _dealt(documents)
    may = _candidates(_index(dealt), rules)
    met = dealt.withColumn("bit", _bit()).join(may, "segment", "left")
    none = F.array().cast("array<struct<start: int, order: int, end: int>>")
    per_rule = []
    for order, rule in enumerate(rules):
        spans = _spans(rule, order)
        if f"may_{rule.kind}" in may.columns:
            candidate = F.expr(f"shiftright(may_{rule.kind}, bit) & 1L") == 1
            spans = F.when(candidate, spans)
        per_rule.append(F.coalesce(spans, none))
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return met.select(
        "doc_id",
        F.transform(
            F.array_sort(F.concat(*per_rule)),
            lambda s: F.struct(
                F.get(kinds, s["order"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        ).alias("spans"),
    )


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    told = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(told, ",")
