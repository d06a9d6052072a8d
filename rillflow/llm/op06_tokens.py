"""Token counts by a linear longest-match automaton.

Words are cut greedily into the longest vocabulary pieces, left to right.  The vocabulary is a trie; every trie node
has a failure link and the number of pieces that are popped when it is followed, both computed once, so a word is
counted in one pass over its characters, without going back and without building a piece.  The vocabulary's pieces
that start a word begin with the word mark; the others continue one.  A word that can't be cut whole is one unknown
token.

The automaton has the size of the vocabulary and is broadcast.  Counts of a word are remembered for its batch, as
words repeat.

Defined results: null, empty and white texts have no words and no tokens; words are separated by white space;
repeated rows are counted each; ``count_tokens`` keeps extra columns, but for those of its own names, which are replaced.
"""

from __future__ import annotations

from collections import Counter, deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import share

MARK = "▁"
_NONE = -1


class Automaton:
    """Trie nodes are numbers; 0 is the root."""

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        whole = [False]
        parent, letter = [0], [""]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(whole)
                    self.next.append({})
                    whole.append(False)
                    parent.append(node)
                    letter.append(c)
                node = self.next[node][c]
            if piece:
                whole[node] = True
        # fail[v]: what is left of v's string once its longest pieces are popped; pops[v]: how many they are
        self.fail, self.pops = [_NONE] * len(whole), [0] * len(whole)
        todo = deque(self.next[0].values())
        while todo:
            v = todo.popleft()
            todo.extend(self.next[v].values())
            if whole[v]:
                self.fail[v], self.pops[v] = 0, 1
                continue
            z, n = self.fail[parent[v]], self.pops[parent[v]]
            while z != _NONE and letter[v] not in self.next[z]:
                n += self.pops[z]
                z = self.fail[z]
            if z != _NONE:
                self.fail[v], self.pops[v] = self.next[z][letter[v]], n

    def count(self, word: str) -> int:
        """The number of pieces, or 0 for a word that can't be cut whole."""
        node, n = 0, 0
        for c in word:
            while (to := self.next[node].get(c)) is None:
                if (back := self.fail[node]) == _NONE:
                    return 0
                n += self.pops[node]
                node = back
            node = to
        while node:
            if (back := self.fail[node]) == _NONE:
                return 0
            n += self.pops[node]
            node = back
        return n


def read_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def count_text(automaton: Automaton, text: str | None, known: dict[str, int]) -> tuple[int, int, int]:
    """Words, tokens and unknown words."""
    words = tokens = unknown = 0
    for word, times in Counter((text or "").split()).items():
        if (n := known.get(word)) is None:
            n = known[word] = automaton.count(MARK + word)
        words += times
        tokens += times * (n or 1)
        unknown += times * (n == 0)
    return words, tokens, unknown


def count_tokens(docs: DataFrame, pieces: list[str], text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``n_tokens`` and ``n_unknown``."""
    shared = share(docs.sparkSession, Automaton(pieces))

    @F.pandas_udf("n_words long, n_tokens long, n_unknown long")
    def count(texts: pd.Series) -> pd.DataFrame:
        known: dict[str, int] = {}
        return pd.DataFrame([count_text(shared.value, t, known) for t in texts], columns=["n_words", "n_tokens", "n_unknown"])

    names = ("n_words", "n_tokens", "n_unknown")
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), count(F.col(f"`{text}`")).alias("counts"))
    return row.select(*(F.col(f"row.`{c}`") for c in docs.columns if c not in names), *(f"counts.{n}" for n in names))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op06_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    out = count_tokens(docs.select("doc_id", "text"), read_pieces(path or default_path()))
    return out.select("doc_id", "n_words", "n_tokens", "n_unknown")
