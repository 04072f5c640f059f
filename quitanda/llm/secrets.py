"""Operator 4: secret scans through a trigram inverted index, in DataFrame functions only.

Method: each rule's regex is turned into a Boolean query over trigrams that any
match must hold (``trigram_query``: an OR of ANDs).  The trigrams of all
queries are looked up in every text, which gives the postings (trigram,
document); postings are intersected per clause, and only the documents of a
satisfied clause are verified with the regex.  Rules without mandatory trigrams
scan every text.

Spans are code points, end exclusive, leftmost and not overlapping within a
kind: the text is split at a rule's matches, so the lengths of gaps and matches
add up to their places.

Defined cases: null text is empty; null doc_id is an id like others; rows that
repeat a doc_id are told apart by their text; repeated rows get equal results;
an empty table gives no rows; very long texts and texts of very many matches are
scanned whole, in time n log n of their matches; only ``id_col`` and
``text_col`` are read, so other columns can have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import same, text_key

_parser = re._parser


@dataclass(frozen=True)
class Rule:
    """``regex`` works alike in Java and Python; a match counts if its ``group`` has ``least`` characters."""
    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run of 24 or more, found as such instead of every run of one letter and more
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public formats of credentials that the method adds.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE + MORE
_MOST_STRINGS = 40


def _exact(items) -> set[str] | None:
    """All strings a regex part can match, in lower case, if these are few; else None."""
    out = {""}
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            more = {chr(arg).lower()}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            more = {chr(c).lower() for _, c in arg}
        elif name == "SUBPATTERN":
            more = _exact(arg[-1])
        elif name == "BRANCH":
            parts = [_exact(b) for b in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif name == "MAX_REPEAT" and arg[1] <= 4:
            inner = _exact(arg[2])
            more = inner and {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(inner, repeat=n)}
        else:
            more = None
        if more is None or len(out) * len(more) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Clauses, any of which a matching text satisfies by holding all its trigrams; [] if nothing is mandatory.

    Runs of neighbouring parts with few exact strings are joined; a run of
    which every string has three characters or more is mandatory.
    """
    runs: list[set[str]] = [{""}]
    for item in _parser.parse(regex):
        strings = _exact([item])
        if strings is None or len(runs[-1]) * len(strings) > _MOST_STRINGS:
            runs.append({""} if strings is None else strings)
            if strings is None:
                runs.append({""})
            continue
        runs[-1] = {a + b for a in runs[-1] for b in strings}
    wanted = [run for run in runs if all(len(s) >= 3 for s in run)]
    clauses = []
    for choice in product(*wanted):
        clause = frozenset(s[i:i + 3] for s in choice for i in range(len(s) - 2))
        if clause and clause not in clauses:
            clauses.append(clause)
    # a clause that asks for more than another adds no text
    return [c for c in clauses if not any(other < c for other in clauses)]


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, text_key, kinds): documents that satisfy a rule's trigram query.  ``docs``: doc_id, text_key, text."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    clauses = [(kind, n, sorted(c)) for kind, found in queries.items() for n, c in enumerate(found)]
    trigrams = sorted({t for _, _, c in clauses for t in c})
    number = {t: i for i, t in enumerate(trigrams)}
    lower = docs.select("doc_id", "text_key", F.lower("text").alias("t"))
    held = F.array_compact(F.array(*(F.when(F.contains("t", F.lit(t)), F.lit(i)) for t, i in number.items())))
    postings = lower.select("doc_id", "text_key", F.explode(held).alias("trigram"))
    # the rules' trigrams: a constant of this module, a few dozen rows
    table = docs.sparkSession.createDataFrame(
        [(number[t], kind, n, 1 << i, (1 << len(c)) - 1) for kind, n, c in clauses for i, t in enumerate(c)],
        "trigram int, kind string, clause int, bit long, full long")
    met = postings.join(F.broadcast(table), "trigram").groupBy("doc_id", "text_key", "kind", "clause", "full").agg(
        F.bit_or("bit").alias("bits")).where("bits = full")
    return met.groupBy("doc_id", "text_key").agg(F.collect_set("kind").alias("kinds"))


def running_sums(numbers: Column) -> Column:
    """Sums of an array's first 1, 2, ... longs: each pass adds the value 1, 2, 4, ... places before.

    n values take n log n steps; appending sums one by one would copy the array for each.
    """
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers) + 1)).cast("int"))
    return F.aggregate(passes, numbers, lambda sums, k: F.transform(
        sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0).cast("long"))))


def matches(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, number, end, kind>> of a rule's spans in a text."""
    pattern = F.lit(rule.regex)
    gaps = F.transform(F.split(text, rule.regex, -1), F.length)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    lengths = F.transform(found, F.length)
    parts = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    ends = running_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), lengths, lambda gap, n: (gap + n).cast("long")))
    placed = F.transform(F.arrays_zip(ends.alias("end"), lengths.alias("n"), parts.alias("part")), lambda s: F.struct(
        (s["end"] - s["n"]).alias("start"), F.lit(number).alias("number"), s["end"].alias("end"),
        F.lit(rule.kind).alias("kind"), s["part"].alias("part")))
    return F.transform(F.filter(placed, lambda s: s["part"] >= rule.least),
                       lambda s: F.struct(s["start"], s["number"], s["end"], s["kind"]))


def joined(spans: Column) -> Column:
    """kind:start:end, by start, then by the rules' order, joined by commas."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, found array<struct<start, number, end, kind>>.

    ``number`` is the rule's place in ``rules``.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    listed = candidates(base, rules).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "kinds")
    both = base.join(listed, same(F.col("doc_id"), F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    none = F.array().cast("array<struct<start:long,number:int,end:long,kind:string>>")
    found = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.regex):
            listed_here = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            listed_here = F.col("text").rlike(rule.regex)  # no mandatory trigram: a full scan
        found.append(F.when(listed_here, matches(F.col("text"), rule, number)).otherwise(none))
    return both.select("doc_id", "text_key", F.concat(*found).alias("found"))


def digest(found: DataFrame, base: int = len(BASE)) -> DataFrame:
    """Contract columns from the result of ``scan`` with the base kinds first."""
    of_base = F.filter("found", lambda s: s["number"] < base)

    def count(number: int) -> Column:
        return F.size(F.filter("found", lambda s: s["number"] == number)).cast("long")

    return found.select("doc_id", *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)),
                        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


def _sql_spans(rule: Rule, number: int) -> str:
    pattern = "'" + rule.regex.replace("'", "''") + "'"
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, {pattern})) + 1), lambda i: {{
        's': list_sum(list_transform(string_split_regex(t, {pattern})[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(regexp_extract_all(t, {pattern})[1:i - 1], lambda x: length(x))), 0),
        'n': {number}, 'l': length(regexp_extract_all(t, {pattern})[i]), 'k': '{rule.kind}',
        'p': length(regexp_extract_all(t, {pattern}, {rule.group})[i])}}), lambda x: x.p >= {rule.least})"""


def oracle() -> str:
    """The contract in SQL: each rule's regex over every text."""
    def shown(spans: str) -> str:
        return ("array_to_string(list_transform(list_sort(" + spans + "), lambda x: x.k || ':' || x.s || ':' || (x.s + x.l)), ',')")
    columns = ", ".join(f"{_sql_spans(r, i)} AS {r.kind}" for i, r in enumerate(RULES))
    base, every = (" || ".join(r.kind for r in rules) for rules in (BASE, RULES))
    counts = ", ".join(f"len({r.kind}) AS n_{r.kind}" for r in BASE)
    return (f"WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS (SELECT doc_id, {columns} FROM texts) "
            f"SELECT doc_id, {counts}, sha256({shown(base)}) AS base_sha256, {shown(every)} AS spans FROM found")
