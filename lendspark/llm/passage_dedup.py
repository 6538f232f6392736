"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of one document; every word that a window covers goes if the same word
sequence also starts earlier (smaller id; same document: earlier start). Windows are judged on the input.

1. Documents are packed into chunks (a stored table), the unit that all exchanges speak of.
2. Confirm, in two rounds. Every window holds an anchor: of its ``anchor``-word phrases the one of least hash, so
   equal windows hold the same one. Chunks send their distinct anchors (one word in six), hash buckets answer which
   of them other chunks have too. Only windows with such an anchor are sent on, with a 128-bit hash of their words,
   and each chunk learns which of its phrases start earlier in another chunk. A chunk sends a phrase once however
   often it repeats, so a passage that a third of all documents hold costs one entry a chunk, and buckets are even.
3. Automata. A chunk's confirmed phrases (those that start earlier elsewhere, those that repeat inside) are compiled
   into Aho-Corasick automata of at most ``phrases`` each (those that occur once in the chunk and overlap are one
   longer phrase), and all its documents stream through them: every occurrence is located, on the words themselves. So automata are sharded by the documents that can
   match them, and each document passes its own shard only, whatever the number of phrases in the corpus.

Nothing is capped or sampled. Null text, or no words: nothing to remove, the text is empty. Documents of equal id are
different documents, ordered by the text's hash, then (equal rows) in any order; null ids come after all others. Ids
of any type that can be ordered. Other columns are ignored. Empty table: no rows.
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored


@dataclass(frozen=True)
class PassageDedup:
    window: int = 20
    anchor: int = 10
    chunk_bytes: int = 1 << 20
    bucket_windows: int = 1 << 21
    phrases: int = 40_000


#: Multipliers of the two lanes of a window's hash, and of the hash that picks anchors.
LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
ANCHOR = np.uint64(0xBF58476D1CE4E5B9)


def _pack(settings: PassageDedup):
    """Rows (id, text) to rows of one chunk: ids, lengths in bytes (null text: 0), compressed texts."""

    def run(batches):
        import xxhash
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0

        def chunk():
            table = pa.table({"id": pa.concat_arrays(ids), "h": [xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], "n": range(len(texts))})
            order = table.sort_by([("id", "ascending"), ("h", "ascending"), ("n", "ascending")])  # nulls last
            texts_in_order = [texts[n] for n in order["n"].to_pylist()]
            body = b"".join(texts_in_order)
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([number], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), order["id"].combine_chunks()),
                "hashes": pa.array([order["h"].to_pylist()], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in texts_in_order]], pa.list_(pa.int64())),
                "n_bytes": pa.array([len(body)], pa.int64()),
                "body": pa.array([zstandard.ZstdCompressor(level=3).compress(body)], pa.binary())})

        for batch in batches:
            start = 0
            for i, text in enumerate(batch.column(1)):
                text = (text.as_py() or "").encode()
                texts.append(text)
                held += len(text) + 64
                if held >= settings.chunk_bytes:
                    ids.append(batch.column(0)[start:i + 1])
                    yield chunk()
                    number, start = number + 1, i + 1
                    ids, texts, held = [], [], 0
            if start < batch.num_rows:
                ids.append(batch.column(0)[start:])
        if texts:
            yield chunk()

    return run


class _Chunk:
    """The words of a chunk's documents in one row, and which positions start a window."""

    def __init__(self, row: dict, settings: PassageDedup):
        import xxhash
        import zstandard

        body, at = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, row["n_bytes"])) if row["n_bytes"] else b"", 0
        self.words, self.ends, self.size = [], [], settings.window
        for length in row["lengths"]:
            self.words += body[at:at + length].split()  # bytes: ASCII white space only
            self.ends.append(len(self.words))
            at += length
        names = {word: n for n, word in enumerate(dict.fromkeys(self.words))}
        self.ids = np.fromiter(map(names.__getitem__, self.words), np.int64, len(self.words))
        self.bits = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, names)), np.uint64).reshape(-1, 2)
        starts = np.r_[0, self.ends[:-1]].astype(np.int64)
        room = np.repeat(np.array(self.ends, np.int64), np.array(self.ends, np.int64) - starts) - np.arange(len(self.ids))
        self.windows = np.flatnonzero(room >= settings.window)

    def rolled(self, lane: int, base: np.uint64, size: int) -> np.ndarray:
        """Polynomial hash of the ``size`` words from every position."""
        n = len(self.ids) - size + 1
        values, out = self.bits[:, lane][self.ids], np.zeros(max(n, 0), np.uint64)
        for j in range(size if n > 0 else 0):
            out *= base
            out += values[j:j + n]
        return out

    def anchors(self, size: int) -> np.ndarray:
        """For each window the hash of its anchor."""
        if not len(self.windows):
            return np.zeros(0, np.uint64)
        grams = self.rolled(0, ANCHOR, size)
        grams ^= grams >> np.uint64(31)
        grams *= LANES[1]
        grams ^= grams >> np.uint64(29)
        return np.lib.stride_tricks.sliding_window_view(grams, self.size - size + 1).min(axis=1)[self.windows]

    def hashes(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both lanes of the windows that start at ``of``."""
        return tuple(self.rolled(k, LANES[k], self.size)[of] if len(of) else np.zeros(0, np.uint64) for k in (0, 1))


def _firsts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes, ascending, of the first of each distinct (a, b), and how many there are of each."""
    order = np.lexsort((b, a))  # stable: the first of equal ones is the earliest
    new = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])] if len(a) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    first, count = order[at], np.diff(np.r_[at, len(a)])
    by = np.argsort(first)
    return first[by], count[by]


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _send_anchors(settings: PassageDedup, buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = np.unique(_Chunk(row, settings).anchors(settings.anchor))
                cuts = np.searchsorted(_bucket(found, buckets), np.arange(buckets + 1))  # the bucket follows the order
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(full, pa.int64()), "chunk": pa.array([row["chunk"]] * len(full), pa.int64()),
                    "anchors": pa.array([found[cuts[k]:cuts[k + 1]].tobytes() for k in full], pa.binary())})

    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Of each chunk's anchors in this bucket those that another chunk has too."""
    parts = [np.frombuffer(x, np.uint64) for x in table["anchors"].to_pylist()]
    every = np.sort(np.concatenate(parts))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    kept = [p[np.isin(p, shared, assume_unique=True)] for p in parts]
    return pa.table({"chunk": table["chunk"].cast(pa.int64()), "anchors": pa.array([k.tobytes() for k in kept], pa.binary())}).filter(
        pa.array([len(k) > 0 for k in kept]))


def _send_windows(settings: PassageDedup, buckets: int, schema: pa.Schema):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist() if answers.num_rows else []:
            chunk = _Chunk(row, settings)
            shared = np.concatenate([np.frombuffer(x, np.uint64) for x in answers["anchors"].to_pylist()])
            windows = chunk.windows[np.isin(chunk.anchors(settings.anchor), shared)]
            one, two = chunk.hashes(windows)
            first, _ = _firsts(one, two)
            windows, one, two = windows[first], one[first], two[first]
            document = np.searchsorted(chunk.ends, windows, side="right")
            home = _bucket(one, buckets)
            for k in np.unique(home):
                mine = home == k
                docs, runs = np.unique(document[mine], return_counts=True)
                out.append({"bucket": int(k), "chunk": row["chunk"], "ids": [row["ids"][d] for d in docs], "hashes": [row["hashes"][d] for d in docs],
                            "runs": runs.tolist(), "starts": windows[mine].astype(np.int64).tobytes(),
                            "windows": np.stack([one[mine], two[mine]]).tobytes()})
        return pa.Table.from_pylist(out, schema)

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """For each chunk where its windows of this bucket start that start earlier in another chunk."""
    rows = table.num_rows
    docs = pa.table({"id": pa.concat_arrays(x.flatten() for x in table["ids"].chunks), "hash": np.concatenate([x.flatten() for x in table["hashes"].chunks]),
                     "chunk": np.repeat(table["chunk"].to_numpy(), [len(x) for x in table["runs"].to_pylist()])})
    docs = docs.append_column("n", pa.array(np.arange(docs.num_rows)))
    rank = np.empty(docs.num_rows, np.int64)
    rank[docs.sort_by([("id", "ascending"), ("hash", "ascending"), ("chunk", "ascending"), ("n", "ascending")])["n"].to_numpy()] = np.arange(docs.num_rows)
    windows = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in table["windows"].to_pylist()]
    place = np.repeat(rank, np.concatenate([x.flatten() for x in table["runs"].chunks]))
    one, two = np.concatenate(windows, axis=1)
    order = np.lexsort((place, two, one))
    again = np.r_[False, (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
    late = np.zeros(len(one), bool)
    late[order] = again
    cuts = np.cumsum([w.shape[1] for w in windows])[:-1]
    starts = [np.frombuffer(x, np.int64)[m] for x, m in zip(table["starts"].to_pylist(), np.split(late, cuts), strict=True)]
    return pa.table({"chunk": table["chunk"].cast(pa.int64()), "starts": pa.array([s.tobytes() for s in starts], pa.binary())}).filter(
        pa.array([len(starts[k]) > 0 for k in range(rows)]))


def _repeated(chunk: _Chunk) -> np.ndarray:
    """Starts of the first of all windows that repeat inside the chunk."""
    one, two = chunk.hashes(chunk.windows)
    by_value = np.sort(one)
    some = np.flatnonzero(np.isin(one, by_value[1:][by_value[1:] == by_value[:-1]]))
    first, count = _firsts(one[some], two[some])
    return chunk.windows[some[first[count > 1]]]


def _located(chunk: _Chunk, settings: PassageDedup, starts: np.ndarray, elsewhere: np.ndarray, again: np.ndarray | None = None) -> np.ndarray:
    """Which words go: the phrases that start at ``starts``, ascending, are located in all documents of the chunk.
    ``elsewhere``: whether a phrase starts earlier in another chunk; if not, its first occurrence (the one in ``starts``)
    stays. ``again``: whether it repeats inside the chunk (not given: it may). Phrases that do not, from one word to the next, are one longer
    phrase: it is found where they are, and the automaton has a path for the passage, not for each of its windows.

    A word is two symbols from ranges of their own, so that an automaton's node has few edges to search; words that no
    phrase has, and the gaps between documents, are one word more."""
    import ahocorasick

    n, size = len(chunk.ids), settings.window
    change = np.zeros(n + 1, np.int64)
    if not len(starts):
        return change[:n] > 0
    used = np.zeros(n + 1, np.int64)
    used[starts] += 1
    used[starts + size] -= 1
    number = np.zeros(len(chunk.bits), np.int64)
    known = np.unique(chunk.ids[np.cumsum(used[:n]) > 0])
    number[known] = np.arange(1, len(known) + 1)
    line = np.insert(number[chunk.ids], chunk.ends, 0)
    base = int(len(known) ** 0.5) + 1  # both ranges end far below the surrogates
    text = np.stack([line // base + 1, line % base + base + 3], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    alone = elsewhere & ~again if again is not None else np.zeros(len(starts), bool)
    first = np.flatnonzero(np.r_[True, (np.diff(starts) != 1) | ~alone[1:] | ~alone[:-1]])
    sizes = starts[np.r_[first[1:], len(starts)] - 1] - starts[first] + size
    starts, elsewhere = starts[first], elsewhere[first]
    places = starts + np.searchsorted(chunk.ends, starts, side="right")  # gaps before a phrase
    ends = np.array(chunk.ends) + np.arange(len(chunk.ends))
    for cut in range(0, len(starts), settings.phrases):
        own, at, words = (x[cut:cut + settings.phrases] for x in (elsewhere, places, sizes))
        automaton = ahocorasick.Automaton()
        for k, (a, n_words) in enumerate(zip(at.tolist(), words.tolist())):
            automaton.add_word(text[2 * a:2 * (a + n_words)], k)
        automaton.make_automaton()
        hits = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
        begin = (hits[:, 0] + 1) // 2 - words[hits[:, 1]]
        goes = own[hits[:, 1]] | (begin != at[hits[:, 1]])
        begin, length = begin[goes], words[hits[goes, 1]]
        begin -= np.searchsorted(ends, begin, side="left")
        change += np.bincount(begin, minlength=n + 1) - np.bincount(begin + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _remove(settings: PassageDedup, schema: pa.Schema):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row, ids in zip(chunks.to_pylist(), chunks["ids"], strict=True):
            chunk = _Chunk(row, settings)
            inside = _repeated(chunk)
            outside = np.concatenate([np.frombuffer(x, np.int64) for x in answers["starts"].to_pylist()] or [np.zeros(0, np.int64)])
            starts = np.union1d(inside, outside)
            gone = _located(chunk, settings, starts, np.isin(starts, outside), np.isin(starts, inside))
            begins, spans = [0, *chunk.ends[:-1]], []
            texts, n_removed = [], []
            for a, b in zip(begins, chunk.ends, strict=True):
                mask = gone[a:b]
                edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
                spans.append([{"begin": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                texts.append(b" ".join(compress(chunk.words[a:b], ~mask)).decode())
                n_removed.append(int(mask.sum()))
            out.append(pa.table({"id": ids.values, "n_words": pa.array(np.diff([0, *chunk.ends]), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                                 "text": pa.array(texts, pa.string()), "removed": pa.array(spans, schema.field("removed").type)}).cast(schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def dedup_passages(docs: DataFrame, settings: PassageDedup = PassageDedup(), *, id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """All documents without the words of repeated windows: the id, ``n_words``, ``n_removed``, the remaining ``text``
    (words joined by one space) and the ``removed`` spans of word positions (end excluded)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(F.col(id).alias("id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    chunks = stored(source.mapInArrow(_pack(settings), (
        f"chunk bigint, ids array<{kind}>, hashes array<bigint>, lengths array<bigint>, n_bytes bigint, body binary")))
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = 1 + total // (6 * settings.bucket_windows)
    bodies = chunks.select("chunk", "lengths", "n_bytes", "body")

    anchors = bodies.mapInArrow(_send_anchors(settings, buckets), "bucket bigint, chunk bigint, anchors binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, "chunk bigint, anchors binary")

    sent = f"bucket bigint, chunk bigint, ids array<{kind}>, hashes array<bigint>, runs array<bigint>, starts binary, windows binary"
    sent_schema = to_arrow_schema(docs.sparkSession.createDataFrame([], sent).schema)
    windows = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_windows(settings, buckets, sent_schema), sent)
    late = windows.groupBy("bucket").applyInArrow(_earlier, "chunk bigint, starts binary")

    result = f"id {kind}, n_words bigint, n_removed bigint, text string, removed array<struct<begin:bigint,end:bigint>>"
    result_schema = to_arrow_schema(docs.sparkSession.createDataFrame([], result).schema)
    out = chunks.groupBy("chunk").cogroup(late.groupBy("chunk")).applyInArrow(_remove(settings, result_schema), result)
    return out.withColumnRenamed("id", id)
