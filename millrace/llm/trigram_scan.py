"""Secret scan over a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean query over trigrams that any match must contain. The
index holds postings (trigram, text key) for the trigrams the rules ask about; the postings of a rule's
query are intersected per text, and only candidates are scanned with that rule. A rule without
mandatory trigrams scans every text.
"""

from __future__ import annotations

import functools
import re._constants as kinds
import re._parser as regex_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut, slot, text_key


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The rules of the contract, in the order in which they are listed. A run of characters
#: that must reach a length is written with that length, which finds the same matches; ``assign`` is
#: not, because a match that is too short still uses up its characters.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

MOST_STRINGS = 64  # alternatives kept while deriving a query; beyond them a part is left unconstrained

Query = tuple[frozenset[str], ...]  # any of these sets of trigrams, all of a set
ANYTHING: Query = (frozenset(),)


def _any(queries: list[Query]) -> Query:
    sets = {s for q in queries for s in q}
    return tuple(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))


def _all(first: Query, second: Query) -> Query:
    return _any([tuple(a | b for a in first for b in second)])


def _of_strings(strings: set[str]) -> Query:
    return _any([(frozenset(s[i : i + 3] for i in range(len(s) - 2)),) for s in strings])


def _walk(parsed) -> tuple[set[str] | None, Query]:
    """All strings a part can match (None: too many to list) and the query any match satisfies."""
    run: set[str] = {""}
    query, whole = ANYTHING, True
    for op, value in parsed:
        strings, inner = _part(op, value)
        joined = {a + b for a in run for b in strings} if strings is not None else None
        if joined is not None and len(joined) <= MOST_STRINGS:
            run = joined
            continue
        query, whole = _all(query, _of_strings(run)), False
        if strings is not None:
            run = strings
        else:
            query, run = _all(query, inner), {""}
    if whole:
        return run, _of_strings(run)
    return None, _all(query, _of_strings(run))


def _part(op, value) -> tuple[set[str] | None, Query]:
    if op is kinds.LITERAL:
        return {chr(value).lower()}, ANYTHING
    if op is kinds.IN and all(k is kinds.LITERAL for k, _ in value) and len(value) <= 4:
        return {chr(v).lower() for _, v in value}, ANYTHING
    if op is kinds.SUBPATTERN:
        return _walk(value[-1])
    if op is kinds.BRANCH:
        parts = [_walk(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            strings = set().union(*(s for s, _ in parts))
            return strings, _of_strings(strings)
        return None, _any([q for _, q in parts])
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, inner = value
        strings, query = _walk(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        return None, query if least else ANYTHING
    if op is kinds.AT:
        return {""}, ANYTHING
    return None, ANYTHING


@functools.cache
def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, without which ``pattern`` cannot match; ANYTHING if there are none."""
    query = _walk(regex_parser.parse(pattern))[1]
    return ANYTHING if any(not s for s in query) else query


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (gram, key) of all texts, for the trigrams in the rules' queries. Copies of a text have
    one posting; a posting list is a set of rows, never an array, so its length is no limit."""
    grams = sorted({g for rule in rules for s in trigram_query(rule.pattern) for g in s})
    texts = docs.select(text_key(F.col("text")).alias("key"), F.lower("text").alias("low"))
    if not grams:
        return texts.select(F.lit("").alias("gram"), "key").limit(0)
    held = F.filter(F.array(*map(F.lit, grams)), lambda gram: F.contains(F.col("low"), gram))
    return texts.select("key", F.explode(held).alias("gram")).distinct()


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key and one flag per rule with mandatory trigrams, for texts that satisfy any rule's query."""
    asked = [(n, trigram_query(r.pattern)) for n, r in enumerate(rules) if trigram_query(r.pattern) != ANYTHING]
    held = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    flags = [
        functools.reduce(
            Column.__or__,
            (
                functools.reduce(Column.__and__, (F.array_contains("grams", g) for g in sorted(s)))
                for s in query
            ),
        ).alias(f"rule_{n}")
        for n, query in asked
    ]
    flagged = held.select("key", *flags)
    any_flag = functools.reduce(Column.__or__, (F.col(f"rule_{n}") for n, _ in asked), F.lit(False))
    return flagged.where(any_flag)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule in code points, from the lengths of its matches and of the gaps between them."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), 1, F.size(matches)).alias("gap"),
        matches.alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        span = F.struct(
            start.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        kept = F.when(
            F.length(part["value"]) >= rule.least, F.concat(state["found"], F.array(span))
        ).otherwise(state["found"])
        return F.struct(end.alias("at"), kept.alias("found"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(parts, begin, step, lambda state: state["found"])
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, rank, kind, end), by start and then rule order.

    Code points, end exclusive; spans of different kinds may overlap. A null or empty text has none;
    repeated rows have the same. A column of ``docs`` named secret_spans is replaced.
    """
    found = candidates(build_index(docs, rules), rules)
    flags = found.columns[1:]
    # Which slots hold candidates of a rule is at most SLOTS rows, so the texts are not moved; a text that
    # merely shares a candidate's slot is scanned for nothing.
    slots = found.groupBy(slot("key").alias("secret_slot")).agg(*(F.max(c).alias(f"secret_{c}") for c in flags))
    slots = cut(slots, "secret-candidates")
    joined = docs.withColumn("secret_slot", slot(text_key(F.col("text")))).join(
        F.broadcast(slots), "secret_slot", "left"
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    each = [
        F.when(F.col(f"secret_rule_{n}"), _spans(text, rule, n)).otherwise(none)
        if f"rule_{n}" in flags
        else _spans(text, rule, n)
        for n, rule in enumerate(rules)
    ]
    spans = F.array_sort(F.concat(*each))
    return joined.select(*(F.col(c) for c in docs.columns if c != "secret_spans"), spans.alias("secret_spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; overlapping spans give one mark."""
    text = F.col("text")

    def step(state: Column, span: Column) -> Column:
        gap = F.greatest(F.lit(0), span["start"] - state["at"])
        fresh = F.concat(state["out"], F.substring(text, state["at"] + 1, gap), F.lit(mark))
        out = F.when(span["start"] >= state["at"], fresh).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate(
        "secret_spans",
        begin,
        step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])),
    )
    fixed = F.when(F.size("secret_spans") > 0, cleaned).otherwise(text)
    return scan(docs, rules).withColumn("text", fixed).select(*docs.columns)
