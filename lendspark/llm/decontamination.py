"""Benchmark decontamination by a positional inverted index.

The index is split by document: every task stores, for its own documents, the postings
(positions) of the words that occur in the benchmark, ordered by word. A benchmark window
(13 words in a row, or a shorter item as a whole) is looked up from its rarest word: that
word's postings, moved back by its offset in the window, are the candidate starts; they are
cut down by the next rarer words' postings until all words have agreed. What remains are
exact phrase matches. A proximity match holds at least ``near_words`` of the window's words
within ``slop`` positions of their places, all in one document; as ``window - near_words``
words may be missing, one more than that of the rarest words give the candidates (one of
them is in every match), and which documents share an index makes no difference.

No text and no posting leaves its task, so there is no shuffle. The benchmark itself is the
stated query set: it goes to the tasks in blocks of at most ``MAX_WINDOWS`` windows, of which
the driver holds one at a time; with more than one block, the blocks' hits are united by row,
that is by all kept columns and the text.

Null or wordless text: no words, not contaminated. Null item text: no windows. Rows that
share an item_id count as one item; a null item_id reads as an empty string. Repeated
documents are judged one by one. Empty tables give no rows, or no hits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
MAX_WINDOWS = 500_000
#: Candidates looked at in one go, and bytes of text indexed in one go.
CHUNK, INDEX_BYTES = 2_000_000, 8 << 20
#: Copies of a row made from one array.
COPIES = 100_000

#: Lower-cases A-Z and turns every other ASCII mark into a space; letters, digits and all bytes from 0x80 stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(FOLD).split() if raw else []


class Windows:
    """The windows of some items: word numbers, offsets of each window's words, item of each window."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.vocab: dict[bytes, int] = {}
        rows, owner, self.item_ids = [], [], sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.item_ids)}
        for item, raw in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(raw)]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                part = ids[at : at + size]
                rows.append(part + [-1] * (size - len(part)))
                owner.append(number[item])
        self.words = np.array(rows, dtype=np.int32).reshape(-1, size)
        self.owner = np.array(owner, dtype=np.int32)
        self.lengths = (self.words >= 0).sum(axis=1)


class Index:
    """Positional postings of the benchmark words in some documents."""

    def __init__(self, texts: list[bytes | None], vocab: dict[bytes, int]):
        tokens, self.n_words = [], np.zeros(len(texts), dtype=np.int64)
        for k, raw in enumerate(texts):
            own = words_of(raw)
            self.n_words[k] = len(own)
            tokens += own
            tokens.append(b"")  # no window runs on into the next document
        self.ids = np.fromiter((vocab.get(w, -1) for w in tokens), dtype=np.int32, count=len(tokens))
        self.begins = np.concatenate([[0], np.cumsum(self.n_words + 1)])
        known = np.flatnonzero(self.ids >= 0)
        order = np.argsort(self.ids[known], kind="stable")
        self.postings = known[order]
        self.first = np.searchsorted(self.ids[known][order], np.arange(len(vocab) + 1))

    def _candidates(self, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, start, order of its words from the rarest) in bounded chunks."""
        n = np.diff(self.first)
        counts = np.where(w.words >= 0, n[w.words], np.iinfo(np.int64).max)
        by_rarity = np.argsort(counts, axis=1, kind="stable")
        rarest = by_rarity[:, 0]
        every = np.arange(len(w.words))
        size = counts[every, rarest]
        alive = np.flatnonzero(size > 0)
        at = 0
        while at < len(alive):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(size[alive[at:]]), CHUNK, side="right")) + at)
            part = alive[at:upto]
            at = upto
            win = np.repeat(part, size[part])
            step = np.arange(len(win)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            start = self.postings[self.first[w.words[win, rarest[win]]] + step] - rarest[win]
            ok = (start >= 0) & (start + w.lengths[win] <= len(self.ids))
            yield win[ok], start[ok], by_rarity[win[ok]]

    def phrases(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every exact occurrence."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(w.words) and len(self.postings):
            for win, start, order in self._candidates(w):
                for k in range(1, w.words.shape[1]):
                    o = order[:, k]
                    term = w.words[win, o]
                    ok = (term < 0) | (self.ids[np.minimum(start + o, len(self.ids) - 1)] == term)
                    win, start, order = win[ok], start[ok], order[ok]
                found.append((win, start))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _near_candidates(self, w: Windows, by_rarity: np.ndarray, misses: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(window, place of its first word) by every posting of the window's misses + 1 rarest words, in bounded chunks:
        with no more than ``misses`` words missing, one of these is there, whatever the counts."""
        for r in range(int(misses.max()) + 1):
            own = np.flatnonzero(misses >= r)
            place = by_rarity[own, r]
            term = w.words[own, place]
            ends = np.cumsum(self.first[term + 1] - self.first[term])
            for lo in range(0, int(ends[-1]), CHUNK):
                nth = np.arange(lo, min(lo + CHUNK, int(ends[-1])))
                k = np.searchsorted(ends, nth, side="right")
                at = self.postings[self.first[term[k] + 1] - (ends[k] - nth)]
                yield own[k], at - place[k], self.document_of(at)

    def _there(self, w: Windows, win: np.ndarray, o: np.ndarray | int, at: np.ndarray, doc: np.ndarray, slop: int) -> np.ndarray:
        """Whether the window's word ``o`` lies in the document within ``slop`` of ``at``."""
        term, seen = w.words[win, o], np.zeros(len(win), dtype=bool)
        begin, end = self.begins[doc], self.begins[doc + 1] - 1  # at its end stands no word
        for d in range(-slop, slop + 1):
            x = at + d
            seen |= self.ids[np.where((x >= begin) & (x < end), x, end)] == term
        return seen & (term >= 0)

    def near(self, w: Windows, slop: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, document) where, from some start, at least ``least`` of the window's words lie in the document
        within ``slop`` of their places."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(w.words) and len(self.postings):
            size = w.words.shape[1]
            counts = np.where(w.words >= 0, np.diff(self.first)[w.words], np.iinfo(np.int64).max)
            by_rarity = np.argsort(counts, axis=1, kind="stable")
            need = np.minimum(max(least, 1), w.lengths)
            misses = w.lengths - need
            for win, start, doc in self._near_candidates(w, by_rarity, misses):
                missed = np.zeros(len(win), dtype=np.int64)
                for k in range(size):  # the candidate's word may itself be off by slop: twice that for the others
                    o = by_rarity[win, k]
                    missed += (k < w.lengths[win]) & ~self._there(w, win, o, start + o, doc, 2 * slop)
                    ok = missed <= misses[win]
                    win, start, doc, missed = win[ok], start[ok], doc[ok], missed[ok]
                for d in range(-slop, slop + 1):
                    hits = np.zeros(len(win), dtype=np.int64)
                    for o in range(size):
                        hits += self._there(w, win, o, start + d + o, doc, slop)
                    ok = hits >= need[win]
                    found.append(tuple(np.unique(np.stack([win[ok], doc[ok]]), axis=1)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def document_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, start, side="right") - 1


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_starts", T.ArrayType(T.IntegerType())),
    T.StructField("hit_ends", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("near_items", T.ArrayType(T.StringType())),
])
ARROW = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string()))


def _match(texts: list[bytes | None], w: Windows, slop: int, least: int) -> list[tuple]:
    index = Index(texts, w.vocab)
    win, start = index.phrases(w)
    hit = np.zeros(len(index.ids) + 1, dtype=np.int32)
    np.add.at(hit, start, 1)
    np.add.at(hit, start + w.lengths[win], -1)
    covered = np.cumsum(hit[:-1]) > 0
    items = [set() for _ in texts]
    for d, i in set(zip(index.document_of(start).tolist(), w.owner[win].tolist())):
        items[d].add(w.item_ids[i])
    near = [set() for _ in texts]
    if slop:
        nwin, ndoc = index.near(w, slop, least)
        for d, i in set(zip(ndoc.tolist(), w.owner[nwin].tolist())):
            near[d].add(w.item_ids[i])
    edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    doc = index.document_of(begin)
    out = []
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in range(len(texts)):
        a, b = cut[d], cut[d + 1]
        out.append((int(index.n_words[d]), (begin[a:b] - index.begins[d]).tolist(), (end[a:b] - index.begins[d]).tolist(),
                    sorted(items[d]), sorted(near[d])))
    return out


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of at most MAX_WINDOWS windows (an item is never split)."""
    now, n = [], 0
    for r in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"),
                          F.encode("text", "utf-8").alias("t")).toLocalIterator():
        own = max(1, len(words_of(bytes(r["t"])) if r["t"] is not None else []) - size + 1)
        if now and n + own > MAX_WINDOWS:
            yield now
            now, n = [], 0
        now.append((r["i"], bytes(r["t"]) if r["t"] is not None else b""))
        n += own
    yield now


def benchmark_matches(docs: DataFrame, items: DataFrame, *, keep: list[str] | None = None, window: int = WINDOW,
                      slop: int = 0, near_words: int = 10) -> DataFrame:
    """``docs`` (text, any other columns; ``keep``: those to return, else all) with n_words, the hit runs (half-open,
    in words), the items with exact matches and, where ``slop`` is over 0, those with proximity matches. Columns named
    like an added one are replaced."""
    spark = docs.sparkSession
    added = RESULT.fieldNames()
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    source = docs.select(*dict.fromkeys([*kept, "text"]))
    blocks = [spark.sparkContext.broadcast(block) for block in _blocks(items, window)]
    several = len(blocks) > 1
    if several:
        source = source.withColumns(_row_keys(source))
    parts = []
    for k, block in enumerate(blocks):
        own = [*(kept if k == 0 else []), *(ROW_KEYS if several else [])]  # the first block's rows bring the kept columns
        schema = T.StructType([*source.select(*own).schema.fields, *RESULT.fields])
        parts.append(source.mapInArrow(_matcher(block, own, window, slop, near_words), schema))
    return _united(parts, kept) if several else parts[0]


ROW_KEYS = ("_row_key", "_row_key_2")


def _row_keys(source: DataFrame) -> dict:
    """Two hashes over all columns, in which nulls count too."""
    parts = [c for n in source.columns for c in (F.col(n).isNull(), F.col(n))]
    return {ROW_KEYS[0]: F.xxhash64(*parts), ROW_KEYS[1]: F.xxhash64(F.lit("2"), *reversed(parts))}


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """A batch in slices of about ``limit`` bytes of text (one document at least), with their raw texts."""
    text = batch.column(batch.schema.get_field_index("text"))
    sizes = np.cumsum([0, *(pc.fill_null(pc.binary_length(text), 0).to_pylist())])
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1)
        yield batch.slice(at, upto - at), text.slice(at, upto - at).cast(pa.binary()).to_pylist()
        at = upto


def _matcher(block, kept: list[str], window: int, slop: int, near_words: int):
    def run(batches):
        w = Windows(block.value, window)
        for batch in batches:
            for part, texts in slices(batch, INDEX_BYTES):
                rows = _match(texts, w, slop, near_words)
                found = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(ARROW)]
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, *found], names=[*kept, *RESULT.fieldNames()])

    return run


def _united(parts: list[DataFrame], kept: list[str]) -> DataFrame:
    """One row per document from the blocks' rows: equal rows (equal text included) stay as often as they came."""
    every = parts[0].withColumn("_kept", F.struct(F.lit(True).alias("_first"), *kept)).drop(*kept)
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    grouped = every.groupBy(*ROW_KEYS).agg(
        F.first("_kept", ignorenulls=True).alias("_kept"), F.first("n_words").alias("n_words"), F.count("_kept").alias("_rows"),
        F.flatten(F.collect_set(F.arrays_zip("hit_starts", "hit_ends"))).alias("_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("near_items")))).alias("near_items"))
    runs = F.sort_array("_runs")
    merged = F.aggregate(runs, F.expr("cast(array() as array<struct<hit_starts:int,hit_ends:int>>)"), lambda acc, r: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["hit_ends"] >= r["hit_starts"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["hit_starts"].alias("hit_starts"),
            F.greatest(F.try_element_at(acc, F.lit(-1))["hit_ends"], r["hit_ends"]).alias("hit_ends")))),
    ).otherwise(F.concat(acc, F.array(r))))
    return (grouped.withColumn("_runs", merged)
            .withColumn("hit_starts", F.col("_runs.hit_starts")).withColumn("hit_ends", F.col("_runs.hit_ends"))
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, F.lit(COPIES).cast("long"))))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("_rows") - F.col("_part"), F.lit(COPIES)))))
            .select(*[F.col("_kept")[c].alias(c) for c in kept], "n_words", "hit_starts", "hit_ends", "items", "near_items"))


def with_verdict(matches: DataFrame) -> DataFrame:
    """Adds n_hit and the contamination rule: a hit, and hits make up a twentieth of the words or more."""
    n_hit = F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"),
                        lambda s, x: s + x)
    return matches.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
