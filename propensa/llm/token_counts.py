"""Token counts by dynamic programming over a trie.

The distinct pre-tokens (chunks, see :mod:`pieces`) of a task's texts are put
into a trie.  A node stands for a prefix and stores its forward score: the best
score of any segmentation of the prefix into pieces of a unigram model, and
that segmentation's number of tokens.  Prefixes are shared, so the score of a
shared prefix is computed once: a new node looks back along the path to it
for every piece that ends at it.  The node where a pre-token ends stores its
count, and a text's count is the sum over its pre-tokens.

A model file's scores are read as unigram log-probabilities, whatever the kind
of the model.  Characters that are no piece cost their number of UTF-8 bytes;
equal scores prefer the longest last piece.

One scan without a shuffle.  The trie is kept per Python worker and begun anew
beyond ``MAX_NODES`` nodes, so memory is bounded; counts never depend on that.

Edge cases: a null text has a null count, an empty text 0 tokens; repeated rows
count alike; empty tables give empty results; extra columns pass through, those
named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .packing import text_groups
from .pieces import PieceModel
from .sp_encode import _model_bytes, _other

MAX_NODES = 800_000

_cache: dict = {}


class Trie:
    """Prefixes with forward scores.  Node 0 is the empty prefix."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.scores = {p: float(model.score[i]) for p, i in model.id_of.items()}
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Put a pre-token in; its number of tokens."""
        node, path = 0, [0]
        for at, char in enumerate(word):
            nxt = self.child.get((node, char))
            if nxt is None:
                nxt = self.child[node, char] = len(self.score)
                best, tokens = float("-inf"), 0
                for start in range(max(0, at + 1 - self.model.longest), at + 1):
                    z = self.scores.get(word[start:at + 1])
                    if z is not None and self.score[path[start]] + z > best:
                        best, tokens = self.score[path[start]] + z, self.tokens[path[start]] + 1
                if char not in self.scores and self.score[node] + self.model.unknown_score > best:
                    best, tokens = self.score[node] + self.model.unknown_score, self.tokens[node] + len(char.encode("utf-8", "surrogatepass"))
                self.score.append(best)
                self.tokens.append(tokens)
            node = nxt
            path.append(node)
        self.terminal[word] = self.tokens[node]
        return self.tokens[node]

    def count(self, text: str) -> int:
        if len(self.score) > MAX_NODES:
            self.clear()
        known, total = self.terminal, 0
        for word in self.model.chunks(text):
            n = known.get(word)
            total += self.insert(word) if n is None else n
        return total


def token_counts(df: DataFrame, model: str, column: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` (long), the number of tokens of the text in ``column``."""
    data, rest = _model_bytes(df, model), _other(df, "n_tokens")
    df = df.select(*rest)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _cache:
            _cache[model] = Trie(PieceModel(data.value))
        trie = _cache[model]
        for batch in batches:
            got = [None if t is None else trie.count(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int64())], [*rest, "n_tokens"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("n_tokens", T.LongType())]))
