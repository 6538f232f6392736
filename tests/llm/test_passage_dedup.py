"""Substring dedup against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm.passage_dedup import PassageDedup, _Chunk, _located, dedup_passages
from lendspark.llm.queries import op11_passage_dedup
from tests.llm.plain import words
from tests.llm.test_text_operators import SCHEMA, corpus, prose


def kept_words(docs: list[tuple], size: int = 20) -> list[tuple]:
    """(id, words, removed, kept text) of documents that are in order."""
    seen, out = set(), []
    for i, text in docs:
        w, gone = words(text), set()
        for at in range(len(w) - size + 1):
            window = tuple(w[at : at + size])
            if window in seen:
                gone |= set(range(at, at + size))
            seen.add(window)
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def got(df, id="doc_id") -> list[tuple]:
    return sorted((tuple(r) for r in df.select(id, "n_words", "n_removed", "text").collect()), key=str)


def rows() -> list[tuple]:
    shared = prose(60, 5)
    extra = [
        (60, " ".join(shared[:20])),  # one window alone
        (61, " ".join(prose(30, 61) + shared + prose(25, 62))),
        (62, " ".join(shared[3:40] + ["x"] + shared[22:])),  # parts of a passage
        (63, " ".join(shared[:19])),  # too short
        (64, " ".join(shared + prose(5, 64) + shared)),  # repeats inside
        (65, "a " * 70 + "b"),  # overlaps itself
        (66, "a " * 25),
        (67, " ".join(shared)),  # one word: no ASCII white space
        (68, " ".join(shared).upper()),  # words are not changed
    ]
    return [r[:2] for r in corpus()] + extra


@pytest.mark.parametrize("settings", [PassageDedup(), PassageDedup(chunk_bytes=3000, bucket_windows=300, phrases=30)])
def test_as_brute_force(spark, settings):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(4)
    assert got(dedup_passages(docs, settings)) == sorted(kept_words(rows()), key=str)


def test_windows_of_other_sizes(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(2)
    assert got(dedup_passages(docs, PassageDedup(window=7, anchor=4, chunk_bytes=5000))) == sorted(kept_words(rows(), 7), key=str)


def test_query_over_a_table(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in kept_words([r[:2] for r in corpus()]))
    assert sorted(tuple(r)[:4] for r in op11_passage_dedup(spark, str(tmp_path)).collect()) == want


def test_spans_are_the_removed_words(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    for r in dedup_passages(docs).join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id").collect():
        gone = {j for s in r["removed"] for j in range(s["begin"], s["end"])}
        assert len(gone) == r["n_removed"]
        assert " ".join(x for j, x in enumerate(words(r["whole"])) if j not in gone) == r["text"]


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(prose(50, 3))
    docs = spark.createDataFrame([(7, text), (7, text), (None, text), (None, None), (9, None), (9, "")], "doc_id long, text string").repartition(3)
    for settings in (PassageDedup(), PassageDedup(chunk_bytes=1)):  # each document a chunk of its own
        assert got(dedup_passages(docs, settings)) == sorted(
            [(7, 50, 0, text), (7, 50, 50, ""), (None, 50, 50, ""), (None, 0, 0, ""), (9, 0, 0, ""), (9, 0, 0, "")], key=str)


def test_empty_table_other_columns_and_text_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_passages(empty).collect() == []
    text = " ".join(prose(40, 8))
    names = ["id", "chunk", "ids", "hashes", "n_words", "n_removed", "removed", "body", "bucket", "starts"]
    docs = spark.createDataFrame([("b", text), ("a", text)], "key string, body_text string").select(
        "*", *[F.lit(1).alias(n) for n in names])
    assert got(dedup_passages(docs, id="key", text="body_text"), "key") == [("a", 40, 0, text), ("b", 40, 40, "")]


def test_located_is_by_the_words_themselves():
    import zstandard

    text = ("p q r s t " * 3 + "z p q r").encode()
    chunk = _Chunk({"body": zstandard.compress(text), "n_bytes": len(text), "lengths": [len(text)]}, PassageDedup(window=3, anchor=2))
    gone = _located(chunk, PassageDedup(window=3), np.array([0]), np.array([False]))
    assert gone.tolist() == [False] * 5 + [True] * 3 + [False] * 2 + [True] * 3 + [False] * 3 + [True] * 3


def test_passages_go_into_the_automaton_as_one_phrase(monkeypatch):
    """Windows that occur once in the chunk are joined to passages; what goes is what goes window by window."""
    import ahocorasick
    import zstandard

    texts = [b"a b c d e f g h i j", b"k a b c l m n o", b"d e f p q r s"]
    row = {"body": zstandard.compress(b"".join(texts)), "n_bytes": sum(map(len, texts)), "lengths": list(map(len, texts))}
    chunk = _Chunk(row, PassageDedup(window=3))
    starts = np.array([0, 1, 2, 3, 4, 13, 14, 20])              # 0 (a b c) and 3 (d e f) repeat
    elsewhere, again = np.array([True] * 5 + [False, True, True]), np.isin(starts, [0, 3])
    automaton, added = ahocorasick.Automaton, []

    class Seen:
        def __init__(self):
            self.own = automaton()
            self.make_automaton, self.iter = self.own.make_automaton, self.own.iter

        def add_word(self, word, k):
            added.append(len(word) // 2)
            self.own.add_word(word, k)

    want = _located(chunk, PassageDedup(window=3), starts, elsewhere)
    monkeypatch.setattr(ahocorasick, "Automaton", Seen)
    got = _located(chunk, PassageDedup(window=3), starts, elsewhere, again)
    assert (got == want).all() and got.any() and sorted(added) == [3, 3, 3, 3, 3, 3, 4]
