"""Verdicts on URLs by rules of host and path, else by a weighted vocabulary.

The vocabulary, a table of any size that a worker can hold, has strict terms and soft ones with weights. An Aho-Corasick
automaton, built once in a worker, finds all terms of a URL in one pass; a hit counts if no letter or digit stands right before or
after it. One strict hit, or distinct soft ones whose weights reach a sum, reject a URL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: terms that reject alone, and terms that reject together ---
STRICT = ("casino", "cheap-pills", "escort", "free-bets", "hentai", "malware", "porn", "viagra", "xxx")
SOFT = (
    "ads", "adult", "bet", "bets", "bonus", "cheap", "click", "crypto", "dating", "free", "loan", "loans", "pills", "poker", "prize", "track",
    "win",
)
REJECT_AT = 2.0  # sum of the weights of distinct soft terms that rejects
MOST_TERMS = 1_000_000  # terms sent to every worker
LETTERS_AND_DIGITS = frozenset(ascii_lowercase + "0123456789")


@dataclass(frozen=True)
class Term:
    """A lower-case term; a strict one rejects alone, a soft one adds its weight."""

    text: str
    strict: bool
    weight: float = 1.0


TERMS = (*(Term(t, True) for t in STRICT), *(Term(t, False) for t in SOFT))


def terms_from_table(table: DataFrame) -> tuple[Term, ...]:
    """The vocabulary of a table ``term, strict, weight``. NULL and empty terms are none, a NULL weight is 1, NULL is not strict, A-Z
    is lower-cased; of a repeated term the strict one stays, else the heaviest."""
    rows = table.select(lower_ascii(F.col("term")).alias("term"), F.coalesce("strict", F.lit(False)).alias("strict"), F.coalesce("weight", F.lit(1.0)).cast("double").alias("weight"))
    best = rows.where("term <> ''").groupBy("term").agg(F.max(F.struct("strict", "weight")).alias("best")).limit(MOST_TERMS + 1).collect()
    if len(best) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return tuple(Term(r.term, r.best.strict, r.best.weight) for r in sorted(best, key=lambda r: r.term))


@dataclass(frozen=True)
class UrlRule:
    """Fits its host and all subdomains if the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# --- fixed values: the rules of host and path ---
RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _automaton(table: dict):
    """The automaton of a broadcast vocabulary, which a worker keeps from batch to batch and from task to task."""
    import ahocorasick

    if "automaton" not in table:
        found = ahocorasick.Automaton()
        for number, (text, strict, weight) in enumerate(table["terms"]):
            found.add_word(text, (number, len(text), strict, weight))
        if len(found):
            found.make_automaton()
        table["automaton"] = found
    return table["automaton"]


def _hits(table: dict, urls: pa.Array) -> pa.Array:
    found, strict, soft, weights = _automaton(table), [], [], []
    for url in urls.to_pylist():
        hard, weak = set(), {}
        for last, (number, length, is_strict, weight) in found.iter(url or "") if len(found) else ():
            first = last - length
            before, after = url[first : first + 1] if first >= 0 else "", url[last + 1 : last + 2]
            if before not in LETTERS_AND_DIGITS and after not in LETTERS_AND_DIGITS:
                if is_strict:
                    hard.add(number)
                else:
                    weak[number] = weight
        strict.append(len(hard))
        soft.append(len(weak))
        weights.append(math.fsum(weak.values()))
    columns = [pa.array(strict, pa.int32()), pa.array(soft, pa.int32()), pa.array(weights, pa.float64())]
    return pa.StructArray.from_arrays(columns, ["n_strict", "n_soft", "weight"])


def judge(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, page_id: str = "page_id", url: str = "url",
    terms: tuple[Term, ...] = TERMS, reject_at: float = REJECT_AT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_strict, n_soft``: one row for each row of ``pages``.

    The longest fitting rule decides; where none fits, distinct term hits do. A NULL, empty or schemeless URL has an empty host
    and path and fits no rule; a NULL has no hits and is allowed. NULL ids and repeated rows are judged like others. An
    empty table gives an empty result; other columns are not looked at.
    """
    shared = pages.sparkSession.sparkContext.broadcast({"terms": [(t.text, t.strict, t.weight) for t in terms]})

    @F.arrow_udf("struct<n_strict:int,n_soft:int,weight:double>")
    def hits(urls: pa.Array) -> pa.Array:
        return _hits(shared.value, urls)

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), hits(lower_ascii(F.col("url"))).alias("hits"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.name)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    rejected = (F.col("hits.n_strict") > 0) | (F.col("hits.weight") >= reject_at)
    own = F.when(rejected, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "hits.n_strict", "hits.n_soft")
