"""Secret scans over a trigram inverted index.

Each rule is a regular expression. From its parse tree follow strings of which one must occur in every match, and from those a Boolean
trigram query: for each mandatory place, any of some alternatives, all of whose trigrams must occur. Documents are
indexed by the trigrams that the rules ask for: one posting (trigram, document) each. Postings are intersected
per alternative and place; what is left are candidates, and only there the rule's expression runs. A rule
without mandatory trigrams scans every text.

Everything is DataFrame expressions. Spans come from the pieces between matches: a match begins after all pieces and matches before it.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import once

MOST_STRINGS = 16  # alternatives of a place before it is given up as no help
CLASS_MEMBERS = 3  # members up to which a character class counts as alternatives


@dataclass(frozen=True)
class Rule:
    """A kind of secret: expression, the group that must be long enough, its least length."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool = True


# --- fixed values: the base rules, and two more kinds that this scan adds ---
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, base=False),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, base=False),
)


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Places, each a list of alternatives, each a list of lower-case trigrams; empty without mandatory trigrams."""
    places: list[set[str]] = []

    def close(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            places.append(strings)

    def walk(tree, strings: set[str], top: bool) -> set[str] | None:
        """Strings that the tree can match if there are few, else None; closed places are noted on the way at the top."""
        for op, value in tree:
            now: set[str] | None = None
            if op is sre.LITERAL:
                now = {chr(value).lower()}
            elif op is sre.IN and len(value) <= CLASS_MEMBERS and all(o is sre.LITERAL for o, _ in value):
                now = {chr(v).lower() for _, v in value}
            elif op is sre.BRANCH:
                found = [walk(branch, {""}, False) for branch in value[1]]
                now = None if None in found else set().union(*found)
            elif op is sre.SUBPATTERN:
                now = walk(value[3], {""}, False)
            elif op is sre.MAX_REPEAT and value[:2] == (0, 1):
                inner = walk(value[2], {""}, False)
                now = None if inner is None else inner | {""}
            grown = None if now is None else {s + x for s in strings for x in now}
            if grown is None or len(grown) > MOST_STRINGS:
                if not top:
                    return None
                close(strings)
                strings = {""}
            else:
                strings = grown
        if top:
            close(strings)
        return strings

    walk(sre_parser.parse(pattern), {""}, True)
    return [[sorted({s[i : i + 3] for i in range(len(s) - 2)}) for s in sorted(place)] for place in places]


def postings(docs: DataFrame, trigrams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``trigram, doc_id``: the inverted index of the given trigrams over lower-cased texts, one row for each pair."""
    lowered = F.col("_low")
    found = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(t)), F.lit(t)) for t in trigrams]))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    # a border: each trigram looks at the lowered text, which must be made once
    return once(rows, "_low", F.lower("_text")).select("doc_id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[list[list[str]]]]) -> DataFrame:
    """``doc_id, kinds``: documents in which a rule can match, with those rules."""
    spark = index.sparkSession
    cells = [
        (kind, p, a, t, len(alternative))
        for kind, places in queries.items()
        for p, place in enumerate(places)
        for a, alternative in enumerate(place)
        for t in alternative
    ]
    wanted = spark.createDataFrame(cells, "kind string, place int, alternative int, trigram string, need int")
    places = spark.createDataFrame([(k, len(p)) for k, p in queries.items() if p], "kind string, places int")
    # both tables hold the rules and nothing of the corpus
    hits = index.join(F.broadcast(wanted), "trigram")
    full = hits.groupBy("doc_id", "kind", "place", "alternative").agg(F.countDistinct("trigram").alias("n"), F.first("need").alias("need"))
    held = full.where("n = need").groupBy("doc_id", "kind").agg(F.countDistinct("place").alias("held"))
    good = held.join(F.broadcast(places), "kind").where("held = places")
    return good.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans ``(start, number, kind, end)`` of a rule in a text, in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    triples = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), found.alias("found"), values.alias("value"))
    empty = F.array().cast("array<struct<start:long,number:int,kind:string,end:long>>")

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.char_length(x["piece"])
        end = start + F.coalesce(F.char_length(x["found"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        longer = F.when(F.char_length(x["value"]) >= rule.least, F.concat(s["spans"], F.array(span))).otherwise(s["spans"])
        return F.struct(end.alias("at"), longer.alias("spans"))

    zipped = F.aggregate(triples, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")), step)
    return zipped["spans"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, found``: one row for each row of ``docs``; ``found`` holds all spans by start, then rule.

    Matches of a rule are leftmost and do not overlap; one whose group is too short is dropped. A NULL text is empty and
    has no spans. A NULL id and repeated rows are scanned like others. An empty table gives an empty result;
    other columns are not looked at.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    trigrams = sorted({t for q in queries.values() for place in q for alternative in place for t in alternative})
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    able = candidates(postings(rows, trigrams), queries).withColumnRenamed("doc_id", "_doc")
    joined = rows.join(able, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    none = F.array().cast("array<struct<start:long,number:int,kind:string,end:long>>")
    parts = []
    for number, rule in enumerate(rules):
        can = F.array_contains("kinds", rule.kind) if queries[rule.kind] else F.lit(True)
        can &= F.col("text").rlike(_sure(rule))
        parts.append(F.when(F.coalesce(can, F.lit(False)), rule_spans(F.col("text"), rule, number)).otherwise(none))
    # a border: what follows reads the spans several times, and they must be computed once
    return once(joined.select("doc_id", "text", "kinds"), "found", F.array_sort(F.concat(*parts))).select("doc_id", "found")


def _sure(rule: Rule) -> str:
    """An expression that fails early where the rule has no long enough match: its last repeat asks for the least length."""
    if rule.pattern.endswith("+") and not rule.group:
        head = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{max(rule.least - len(head), 1)},}}" if head.isalnum() or not head else rule.pattern
    return rule.pattern


def joined_spans(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, a digest of the base spans and all spans as text, one row for each row of ``docs``."""
    base = [rule.kind for rule in rules if rule.base]
    kinds = F.transform("found", lambda s: s["kind"])
    count = [(F.size("found") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    own = F.filter("found", lambda s: s["kind"].isin(*base))
    found = scan(docs, rules)
    return found.select("doc_id", *count, F.sha2(joined_spans(own), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"))
