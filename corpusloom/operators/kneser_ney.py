"""N-gram probabilities of any order with interpolated Kneser-Ney smoothing, as tables.

The highest order counts occurrences; each lower order counts the distinct words found before its grams. A
discount comes from how many grams were counted once and twice. Probabilities are built from single words
up: a gram's own discounted share plus what its context leaves to the gram without its first word. A gram that
was never seen falls to the next lower order with the weight its context leaves, as a join for each order.

A gram is an array of ids; before the first id of a text stands ``START``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import land
from .lookup import salted_lookup

START = -1


@dataclass(frozen=True)
class KneserNey:
    """For each order the seen grams ``gram, p`` and the contexts ``context, left`` with the share they leave to lower orders."""

    order: int
    grams: dict[int, DataFrame]
    contexts: dict[int, DataFrame]
    floor: float  # probability of a word never seen


def _grams(ids: Column, order: int) -> Column:
    """All grams of an id array that predict its second and later ids.

    Shifted copies of the array stand side by side, so each is cut once a row: inside a lambda the padded array
    would be built again for every gram.
    """
    padded = F.concat(F.array_repeat(F.lit(START), order - 1), ids)
    steps = F.greatest(F.size(ids) - 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice(padded, F.lit(2 + j), steps) for j in range(order)])
    return F.transform(shifted, lambda g: F.array(*[g[str(j)] for j in range(order)]))


def _context(order: int) -> Column:
    return F.slice("gram", 1, order - 1)


def _lower(order: int) -> Column:
    return F.slice("gram", 2, order - 1)


def _discount(counts: DataFrame) -> float:
    """n1 / (n1 + 2 n2) of the counts of counts, one half where no gram was counted once."""
    found = counts.agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    return found.n1 / (found.n1 + 2 * found.n2) if found.n1 else 0.5


def fit_kneser_ney(df: DataFrame, vocab_size: int, ids: str = "ids", order: int = 3) -> KneserNey:
    """The model of all id arrays of ``df``; without any gram every word has probability 1 / ``vocab_size``.

    NULL arrays and arrays of one id have no grams. Counts combine before the shuffle, contexts and lower grams that many
    rows share are met by salted joins, and every order is written once.
    """
    top = df.select(F.explode(_grams(F.col(ids), order)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    counts = {order: land(top, "grams")}
    for k in range(order - 1, 0, -1):
        below = counts[k + 1].groupBy(_lower(k + 1).alias("gram")).agg(F.count("*").alias("n"))
        counts[k] = land(below, "grams")
    grams, contexts = {}, {}
    words = counts[1].agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).first()
    if not words.total:
        none = {k: c.select("gram", F.lit(None).cast("double").alias("p")) for k, c in counts.items()}
        nothing = {k: c.select(F.col("gram").alias("context"), F.col("p").alias("left")) for k, c in none.items() if k > 1}
        return KneserNey(order, none, nothing, 1 / vocab_size)
    discount = _discount(counts[1])
    floor = discount * words.kinds / words.total / vocab_size
    grams[1] = land(counts[1].select("gram", ((F.col("n") - discount) / words.total + floor).alias("p")), "probabilities")
    for k in range(2, order + 1):
        discount = _discount(counts[k])
        totals = counts[k].groupBy(_context(k).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        totals = land(totals.select("context", "total", "kinds", (discount * F.col("kinds") / F.col("total")).alias("left")), "contexts")
        contexts[k] = totals.select("context", "left")
        # both tables know how many grams ask for each of their rows, so the grams go through both joins in one pass
        with_keys = counts[k].select("gram", "n", _context(k).alias("context"), _lower(k).alias("lower"))
        met = salted_lookup(with_keys, totals.drop("kinds"), "context", "gram", totals.select("context", F.col("kinds").alias("_n")))
        asking = counts[k - 1].select(F.col("gram").alias("lower"), F.col("n").alias("_n"))
        under = salted_lookup(met, grams[k - 1].withColumnsRenamed({"gram": "lower", "p": "below"}), "lower", "gram", asking)
        p = (F.col("n") - discount) / F.col("total") + F.col("left") * F.col("below")
        grams[k] = land(under.select("gram", p.alias("p")), "probabilities")
    return KneserNey(order, grams, contexts, floor)


def gram_probabilities(wanted: DataFrame, model: KneserNey) -> DataFrame:
    """``gram, p`` of distinct grams of the model's order."""
    rows = wanted.select("gram", F.col("gram").alias("rest"), F.lit(1.0).alias("weight"), F.lit(None).cast("double").alias("p"))
    for k in range(model.order, 0, -1):
        rows = land(rows, "wanted")
        seen = salted_lookup(rows, model.grams[k].withColumnsRenamed({"gram": "rest", "p": "found"}), "rest", "gram")
        p = F.coalesce("p", F.col("weight") * F.col("found"))
        if k == 1:
            return seen.select("gram", F.coalesce(p, F.col("weight") * model.floor).alias("p"))
        seen = land(seen.select("gram", "rest", "weight", p.alias("p"), F.slice("rest", 1, k - 1).alias("context")), "seen")
        # an unseen context leaves everything to the lower order
        met = salted_lookup(seen, model.contexts[k], "context", "gram")
        rows = met.select("gram", F.slice("rest", 2, k - 1).alias("rest"), (F.col("weight") * F.coalesce("left", F.lit(1.0))).alias("weight"), "p")
    raise ValueError("a model has at least order 1")


def kneser_ney_loss(df: DataFrame, model: KneserNey, key: str = "doc_id", ids: str = "ids", context: int = fixed.CONTEXT) -> DataFrame:
    """``key, loss, n``: mean negative log-likelihood of each document cut to the context, as ``ngram.document_loss`` gives it.

    A document of fewer than two ids predicts nothing and is left out. Keys must be unique. A document brings each of its
    grams once, and distinct grams meet the model before any document does.
    """
    cut = df.select(key, F.slice(ids, 1, context).alias("_cut"))
    rows = cut.select(key, F.size("_cut").alias("n"), F.explode(_grams(F.col("_cut"), model.order)).alias("gram"))
    counted = land(rows.groupBy(key, "n", "gram").agg(F.count("*").alias("tf")), "document-grams")
    found = land(gram_probabilities(counted.select("gram").distinct(), model), "found")
    met = salted_lookup(counted, found, "gram", key)
    loss = F.sum(-F.ln("p") * F.col("tf")) / F.sum("tf")
    return met.groupBy(key, "n").agg(loss.alias("loss")).select(key, "loss", "n")
