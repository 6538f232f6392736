"""Token counts of a unigram tokenizer by dynamic programming over a trie.

Every task collects the distinct pre-tokens of a slice of documents, inserts them in a trie and
computes, for every node, the best unigram segmentation of its prefix (total log-probability and
number of pieces) and the forward score (log of the sum over all segmentations). A prefix that
many pre-tokens share is computed once. The terminal nodes' counts are then added up per document.

Pre-tokens are the runs of anything but ASCII white space, each written with the word mark in
front, as the vocabulary's own convention has it. Pieces come from the vocabulary's file with
their scores as log-probabilities; a character that no piece covers is one unknown token with
the lowest score less ten. Ties between segmentations: the fewest pieces win.

Null or empty text: no tokens, forward score 0. Repeated rows and rows with equal ids are counted
one by one; other columns are kept, but columns named like an added one are replaced. Empty
table: no rows. Memory is bounded by the slice (``SLICE_BYTES`` of text, or one document).
"""
from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendspark.llm.decontamination import slices

SLICE_BYTES = 16 << 20
MARK = "▁"
ADDED = T.StructType([
    T.StructField("n_pretokens", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("forward_score", T.DoubleType()),
])


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model with log-probabilities.

    A merge-rank model has ranks for scores (0, -1, -2, ...); they become Zipf probabilities,
    1 / (rank + 1) over their sum, so that forward sums are sums of probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
    if min(scores.values(), default=0.0) < -1000:
        norm = math.log(sum(1.0 / (1.0 - s) for s in scores.values()))
        scores = {p: -math.log(1.0 - s) - norm for p, s in scores.items()}
    return scores


class Trie:
    """Prefixes of pre-tokens; node 0 is the empty prefix. One row of the table per node."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}  # node * 2^21 + code point of the next character: node
        self.best, self.count, self.forward = [0.0], [0], [0.0]

    def insert(self, pretoken: str) -> int:
        """Node of the pre-token; only prefixes not seen before are computed."""
        node, path, edges = 0, [0], self.edges
        for i, ch in enumerate(pretoken):
            edge = node << 21 | ord(ch)
            nxt = edges.get(edge)
            if nxt is None:
                nxt = edges[edge] = self._grow(pretoken, i + 1, path)
            node = nxt
            path.append(node)
        return node

    def _grow(self, text: str, end: int, path: list[int]) -> int:
        """A node for text[:end] from those of its prefixes."""
        get, best, counts, forward, node = self.pieces.get, self.best, self.count, self.forward, path[-1]
        score, count, parts = best[node] + self.unknown, counts[node] + 1, []
        for begin in range(max(0, end - self.longest), end):
            piece = get(text[begin:end])
            if piece is None:
                continue
            at = path[begin]
            s, c = best[at] + piece, counts[at] + 1
            if s > score + 1e-12 or (s > score - 1e-12 and c < count):
                score, count = s, c
            parts.append(forward[at] + piece)
        if get(text[end - 1]) is None:
            parts.append(forward[node] + self.unknown)
        top = max(parts)
        self.best.append(score)
        self.count.append(count)
        self.forward.append(top + math.log(sum([math.exp(x - top) for x in parts])) if len(parts) > 1 else top)
        return len(self.best) - 1


def count_tokens(docs: DataFrame, vocabulary: str, *, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (text, other columns; ``keep``: those to return, else all) with n_pretokens, n_tokens and
    forward_score (sum over pre-tokens). ``vocabulary``: path of a sentencepiece model, read on the driver."""
    added = ADDED.fieldNames()
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    source = docs.select(*dict.fromkeys([*kept, "text"]))
    schema = T.StructType([*source.select(*kept).schema.fields, *ADDED.fields])
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches):
        trie = Trie(pieces.value)
        for batch in batches:
            for part, texts in slices(batch, SLICE_BYTES):
                trie.clear()
                terminal: dict[bytes, tuple[int, float]] = {}
                rows = []
                for raw in texts:
                    n, tokens, forward = 0, 0, 0.0
                    for word, times in Counter(raw.split() if raw else ()).items():
                        found = terminal.get(word)
                        if found is None:
                            node = trie.insert(MARK + word.decode("utf-8", "replace"))
                            found = terminal[word] = (trie.count[node], trie.forward[node])
                        n += times
                        tokens += times * found[0]
                        forward += times * found[1]
                    rows.append((n, tokens, forward))
                cols = list(zip(*rows)) if rows else [()] * 3
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*own, *(pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64())))],
                    names=[*kept, *added])

    return source.mapInArrow(run, schema)
