"""Sub-word ids by the longest piece first, from a supplied table of pieces.

A word is cut from the left into the longest piece that fits, again and again; pieces inside a word carry a mark.
The pieces form a trie with failure links: where no piece goes on, the link says which pieces are settled and
where the rest of the match stands, so a word is read once from left to right whatever its pieces are. The trie
is flat arrays, built once and sent to each worker once. All distinct words of a batch take their steps together.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

INSIDE = "##"
# Largest table of pieces: it travels to every worker. Sub-words exist to keep it far smaller.
MOST_PIECES = 500_000
LONGEST_WORD = 100
_START, _INSIDE = 0, 1
_CODE_BITS = 21


@dataclass(frozen=True)
class PieceTrie:
    """Children by (node, character), failure links and the pieces that a link settles."""

    keys: np.ndarray
    child: np.ndarray
    link: np.ndarray
    first: np.ndarray
    settled: np.ndarray

    @classmethod
    def build(cls, pieces: Iterable[tuple[str, int]], inside: str = INSIDE) -> PieceTrie:
        children: list[dict[int, int]] = [{}, {}]
        ids = {}
        for text, number in pieces:
            node, rest = (_INSIDE, text[len(inside) :]) if text.startswith(inside) and text != inside else (_START, text)
            for c in map(ord, rest):
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                node = children[node][c]
            ids[node] = number
        link, settled = [-1] * len(children), [()] * len(children)
        level = [_START, _INSIDE]
        while level:
            below = []
            for above in level:
                for c, node in children[above].items():
                    below.append(node)
                    if node in ids:
                        link[node], settled[node] = _INSIDE, (ids[node],)
                        continue
                    at, done = link[above], settled[above]
                    while at >= 0 and c not in children[at]:
                        done, at = done + settled[at], link[at]
                    if at >= 0:
                        link[node], settled[node] = children[at][c], done
            level = below
        pairs = sorted((node << _CODE_BITS | c, to) for node, found in enumerate(children) for c, to in found.items())
        keys, child = (np.array([p[i] for p in pairs], np.int64) for i in range(2))
        first = np.r_[0, np.cumsum([len(s) for s in settled])]
        return cls(keys, child, np.array(link, np.int64), first, np.array([i for s in settled for i in s], np.int32))

    def _step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each node, or -1."""
        wanted = nodes << _CODE_BITS | codes
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == wanted, self.child[at], -1) if len(self.keys) else np.full(len(nodes), -1)

    def cut(self, words: list[str], unknown: int, longest: int = LONGEST_WORD) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids of all words); a word that cannot be cut is one ``unknown``."""
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begins = np.r_[0, np.cumsum(sizes)[:-1]] if len(words) else np.empty(0, np.int64)
        node = np.full(len(words), _START)
        alive = (sizes > 0) & (sizes <= longest)
        who, left = [], []

        def fail(at: np.ndarray) -> np.ndarray:
            """Settle pieces of the words ``at`` and follow their links; gives those that have one."""
            goes = self.link[node[at]] >= 0
            alive[at[~goes]] = False
            at = at[goes]
            who.append(at)
            left.append(node[at])
            node[at] = self.link[node[at]]
            return at

        for place in range(int(sizes[alive].max(initial=0))):
            at = np.flatnonzero(alive & (sizes > place))
            while len(at):
                to = self._step(node[at], codes[begins[at] + place])
                node[at[to >= 0]] = to[to >= 0]
                at = fail(at[to < 0])
        at = np.flatnonzero(alive)
        while len(at := at[node[at] != _INSIDE]):
            at = fail(at)
        owner = np.concatenate(who) if who else np.empty(0, np.int64)
        nodes = np.concatenate(left) if left else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        order = order[alive[owner[order]]]
        owner, nodes = owner[order], nodes[order]
        many = self.first[nodes + 1] - self.first[nodes]
        counts = np.bincount(np.repeat(owner, many), minlength=len(words))
        counts[~alive] = 1
        out = np.full(counts.sum(), unknown, np.int32)
        out[np.repeat(alive, counts)] = self.settled[_ranges(self.first[nodes], many)]
        return counts, out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - np.r_[0, ends[:-1]] if len(ends) else starts, lengths)


@dataclass(frozen=True)
class Pieces:
    """A table ``(id int, token string)`` of pieces, as a trie, with the id of the unknown word."""

    trie: PieceTrie
    unknown: int
    inside: str = INSIDE

    @classmethod
    def from_table(cls, table: DataFrame, unknown: str = fixed.UNK, inside: str = INSIDE, reserved=fixed.BASE_TOKENS) -> Pieces:
        """Reserved tokens are never found in a text; no piece may be NULL or stand there twice."""
        rows = table.select("id", "token").limit(MOST_PIECES + 1).collect()
        if len(rows) > MOST_PIECES:
            raise ValueError(f"more than {MOST_PIECES} pieces")
        ids = {r.token: r.id for r in rows}
        if None in ids or len(ids) < len(rows):
            raise ValueError("pieces must be present and differ")
        if unknown not in ids:
            raise ValueError(f"there is no piece {unknown}")
        return cls(PieceTrie.build(((t, i) for t, i in ids.items() if t not in reserved), inside), ids[unknown], inside)


def encode_subwords(df: DataFrame, pieces: Pieces, tokens: str = "tokens", out: str = "ids", longest: int = LONGEST_WORD) -> DataFrame:
    """Replace each token by the ids of its pieces; order is kept.

    A token that pieces do not make up, one of more than ``longest`` characters, an empty and a NULL token are one unknown id.
    A NULL array stays NULL. Nothing is shuffled.
    """
    # plain arrays: a worker needs no copy of this package to read them
    trie = pieces.trie
    shared = df.sparkSession.sparkContext.broadcast((trie.keys, trie.child, trie.link, trie.first, trie.settled))
    unknown = pieces.unknown

    @F.arrow_udf("array<int>")
    def cut(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().dictionary_encode()
        counts, ids = PieceTrie(*shared.value).cut(flat.dictionary.to_pylist(), unknown, longest)
        # the last entry stands for a NULL token
        counts, ids = np.r_[counts, 1], np.r_[ids, np.int32(unknown)].astype(np.int32)
        begins = np.r_[0, np.cumsum(counts)[:-1]]
        word = pc.fill_null(flat.indices.cast(pa.int64()), len(counts) - 1).to_numpy(zero_copy_only=False)
        every = ids[_ranges(begins[word], counts[word])]
        upto = np.r_[0, np.cumsum(counts[word])]
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        offsets = upto[np.r_[0, np.cumsum(lengths)]].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(every), mask=lists.is_null())

    return df.withColumn(out, cut(F.col(tokens)))


def join_pieces(decoded: Column, inside: str = INSIDE) -> Column:
    """Space-joined pieces as words again."""
    return F.replace(decoded, F.lit(" " + inside), F.lit(""))
