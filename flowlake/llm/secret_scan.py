"""Secret scanning with a trigram inverted index, in DataFrame operations only.

Every rule's regex is turned into a Boolean query over trigrams that any match
must contain: alternatives are OR, trigrams of one literal stretch are AND. The
index holds postings (trigram, document) for the trigrams that some query asks
for; a document is a candidate of a rule if, for all trigrams of one alternative,
it is in the postings. Only candidates are searched with the regex; a rule
without mandatory trigrams is searched everywhere.

A match's place comes from the gaps between matches (split) and their lengths.

Defined results: a null text is empty; documents that share an id share their
candidates, yet each is searched on its own and keeps its own row; a null id is
an id of its own; an empty table gives an empty one; other columns are kept only
if asked for.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.tables import BUILD_SIDE


@dataclass(frozen=True)
class Rule:
    """least: what the match, or its group, must measure; shorter ones are found,
    block what they cover, and are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The first three in this order are the base rules. Runs of a repeated class are
# given their least length in the pattern where that finds the same spans.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")
SPANS = "array<struct<kind:string,start:int,end:int>>"
# A stretch with more variants than this is taken as unknown there.
MOST_VARIANTS = 64

_CLASS_OR_LITERAL = re.compile(r"\\x[0-9A-Fa-f]{2}|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\(\?i\)|\(|\)|\||\{\d+(?:,\d*)?\}|[*+?.^$]|.", re.S)


def _variants(piece: str) -> list[str] | None:
    """The strings that one regex atom can be, None if unknown."""
    if piece.startswith("\\x"):
        return [chr(int(piece[2:], 16))]
    if piece.startswith("\\"):
        return [piece[1]] if not piece[1].isalnum() else None
    if piece.startswith("["):
        inside = piece[1:-1]
        return None if inside.startswith("^") or "\\" in inside or re.search(".-.", inside) else list(inside)
    return None if piece in ".^$" else [piece]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each the lower-cased trigrams that a match must contain;
    an empty alternative means that the rule has no mandatory trigrams."""
    pieces = _CLASS_OR_LITERAL.findall(pattern)
    at = 0

    def joined(stretches: list[str], more: list[str]) -> list[str] | None:
        return [a + b for a, b in product(stretches, more)] if len(stretches) * len(more) <= MOST_VARIANTS else None

    def parse() -> tuple[list[frozenset[str]], list[str] | None]:
        """Alternatives up to the closing bracket; their strings if all known."""
        nonlocal at
        alternatives: list[frozenset[str]] = []
        whole: list[str] | None = []
        done: list[frozenset[str]] = [frozenset()]
        stretch, exact = [""], True

        def flush() -> None:
            nonlocal done, stretch
            ways = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in stretch}
            done = [a | b for a, b in product(done, ways)] if len(done) * len(ways) <= MOST_VARIANTS else done
            stretch = [""]

        def close() -> None:
            nonlocal alternatives, whole, done, stretch, exact
            whole = whole + stretch if whole is not None and exact else None
            flush()
            alternatives += done
            done, exact = [frozenset()], True

        while at < len(pieces) and pieces[at] != ")":
            piece = pieces[at]
            at += 1
            if piece == "(?i)":
                continue
            if piece == "|":
                close()
                continue
            if piece == "(":
                inner, strings = parse()
                at += 1
            else:
                strings = _variants(piece.lower())
                inner = [frozenset()]
            follow = pieces[at] if at < len(pieces) and re.fullmatch(r"[*+?]|\{.*\}", pieces[at]) else ""
            at += bool(follow)
            if follow == "?" and strings is not None:
                strings, inner = ["", *strings], [frozenset()]
            elif follow in ("*", "?") or follow.startswith("{0"):
                strings, inner = None, [frozenset()]
            elif follow:
                # At least one; what comes after it is not known.
                strings = None
            longer = joined(stretch, strings) if strings is not None else None
            if longer is not None:
                stretch = longer
            else:
                exact = False
                flush()
                done = [a | b for a, b in product(done, inner)] if len(done) * len(inner) <= MOST_VARIANTS else done
        close()
        return alternatives, whole

    found = parse()[0]
    # An alternative that asks for more than another one adds nothing.
    return [a for i, a in enumerate(found) if not any(b < a or (b == a and j < i) for j, b in enumerate(found))]


def postings(docs: DataFrame, trigrams: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """trigram, doc_id: the inverted index of some trigrams over all documents."""
    lowered = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("folded"))
    present = F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select("doc_id", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id, kinds: the rules whose query the postings satisfy. One row for
    each document of the index: its postings are merged, bounded by the rules'
    trigrams, and every alternative is a set inclusion."""
    merged = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("present"))
    def holds(rule: Rule) -> Column:
        wanted = F.lit(False)
        for alternative in trigram_query(rule.pattern):
            own = F.array(*(F.lit(t) for t in sorted(alternative)))
            wanted = wanted | (F.size(F.array_intersect("present", own)) == len(alternative))
        return F.when(wanted, F.lit(rule.kind))
    kinds = F.array_compact(F.array(*(holds(r) for r in rules)))
    return merged.select(F.col("doc_id").alias("__doc_id"), kinds.alias("__kinds")).filter(F.size("__kinds") > 0)


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<kind, start, end>> (code points, end exclusive): leftmost,
    non-overlapping matches; the short ones are dropped."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    steps = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
        measured, lambda s, m: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(m).alias("measure")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPANS})").alias("spans"))

    def add(acc: Column, step: Column) -> Column:
        begin, end = acc["at"] + step["gap"], acc["at"] + step["gap"] + step["size"]
        span = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end"))
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(step["measure"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.filter(steps, lambda s: s["size"].isNotNull()), start, add)["spans"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and spans, ordered by start, then by the rules' order."""
    keep = list(keep)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = tuple(r for r in rules if all(queries[r.kind]))
    trigrams = sorted({t for r in indexed for a in queries[r.kind] for t in a})
    rows = docs.select(*(F.col(c) for c in keep), F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col("doc_id").alias("__id"))
    if indexed:
        found = candidates(postings(rows, trigrams, "__text", "__id"), indexed)
        rows = rows.join(found.hint(BUILD_SIDE), F.col("__id").eqNullSafe(F.col("__doc_id")), "left")
    nothing = F.expr(f"cast(array() as {SPANS})")
    order = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    own = []
    for rule in rules:
        searched = F.rlike("__text", F.lit(rule.pattern))
        if rule in indexed:
            searched = F.coalesce(F.array_contains("__kinds", rule.kind), F.lit(False)) & searched
        own.append(F.when(searched, spans_of(F.col("__text"), rule)).otherwise(nothing))
    keyed = F.transform(F.concat(*own), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(*keep, ordered.alias("spans"))
