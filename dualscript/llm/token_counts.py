"""Token counts by a linear longest-match automaton over a word-piece vocabulary."""

from __future__ import annotations

from collections import deque
from collections.abc import Collection
from dataclasses import dataclass

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 300_000  # words whose counts a worker remembers; the memory bound
MARK = "▁"  # fixed value: sentencepiece's mark of a word's beginning
NODE_BITS = 21  # a code point fits


@dataclass(frozen=True)
class Automaton:
    """A trie with failure links.

    ``step[node << NODE_BITS | code point]`` is a child.  Where a node has no
    child for the next character, the longest pieces it has read are popped:
    ``popped[node]`` is their number and ``fail[node]`` the node that stands for
    what is left, or -1 if the characters read cannot be cut into pieces.
    """

    step: dict[int, int]
    fail: list[int]
    popped: list[int]
    start: int
    rest: int

    def count(self, word: str) -> int | None:
        """Number of greedy longest pieces of ``word``, or None if it has none.

        Every character is read once and every failure link shortens what is
        held, so the work is linear in the word.  No piece is built.
        """
        step, fail, popped = self.step, self.fail, self.popped
        node, n = self.start, 0
        for c in map(ord, word):
            while (child := step.get(node << NODE_BITS | c)) is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return None
            node = child
        # pop until nothing is held
        while node != self.rest:
            if node == self.start:
                return n
            n += popped[node]
            node = fail[node]
            if node < 0:
                return None
        return n


def build(starts: Collection[str], others: Collection[str]) -> Automaton:
    """An automaton for pieces that begin a word and pieces that continue one.

    An empty beginning stands for a mark that is a piece by itself.

    Links follow the breadth-first order.  A whole piece pops itself and leaves
    nothing.  Any other node takes its parent's pops and then follows links
    until one has a child for the node's character.
    """
    step: dict[int, int] = {}
    ends = [False, False]
    start, rest = 0, 1
    for root, pieces in ((start, starts), (rest, others)):
        for piece in pieces:
            node = root
            for c in map(ord, piece):
                key = node << NODE_BITS | c
                if key not in step:
                    step[key] = len(ends)
                    ends.append(False)
                node = step[key]
            if node != root:
                ends[node] = True
    fail, popped = [-1] * len(ends), [0] * len(ends)
    if "" in starts:  # the mark alone begins a word
        fail[start], popped[start] = rest, 1
    children: list[list[tuple[int, int]]] = [[] for _ in ends]
    for key, child in step.items():
        children[key >> NODE_BITS].append((key & ((1 << NODE_BITS) - 1), child))
    queue = deque([start, rest])
    while queue:
        node = queue.popleft()
        for c, child in children[node]:
            if ends[child]:
                fail[child], popped[child] = rest, 1
            else:
                z, n = fail[node], popped[node]
                while z >= 0 and (z << NODE_BITS | c) not in step:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[child], popped[child] = step[z << NODE_BITS | c], n
            queue.append(child)
    return Automaton(step, fail, popped, start, rest)


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin and that continue a word, the mark taken off, of a sentencepiece model.

    Control and byte pieces are left out.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    starts = [p[1:] for p in usual if p.startswith(MARK) and MARK not in p[1:]]
    return starts, [p for p in usual if MARK not in p]


def token_counts(docs: DataFrame, starts: list[str], others: list[str], key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_words, n_tokens, n_unknown``: greedy word-piece tokens of each whole text.

    Words are runs without ASCII white space.  A word that no pieces make up is
    one unknown token.  Null and empty texts have none; keys may be null or
    repeat; an empty table gives an empty result.  The broadcast automaton has
    the size of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(build(starts, others))
    known: dict[bytes, int] = {}  # negative: one unknown token

    @F.pandas_udf("n_words long, n_tokens long, n_unknown long")
    def counts(texts: pd.Series) -> pd.DataFrame:
        count, rows = shared.value.count, []
        for t in texts:
            words = (t or "").encode("utf-8", "surrogatepass").split()
            if len(known) > CACHE_WORDS:
                known.clear()
            found = []
            for w in words:
                n = known.get(w)
                if n is None:
                    n = known[w] = count(w.decode("utf-8", "surrogatepass")) or -1
                found.append(n)
            unknown = found.count(-1)
            rows.append((len(words), sum(found) + 2 * unknown, unknown))
        return pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col(key).alias(key), counts(F.col(text)).alias("_c")).select(key, "_c.*")
