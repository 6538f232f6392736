"""Quality rules by distribution divergence (DataFrame functions only).

Every document's character-class histogram and common-word histogram are compared
with language references by Jensen-Shannon distance (square root of the divergence
in bits, 0 to 1). The references are sums over the whole corpus, one for every
language with at least ``reference_words`` words; the common words are the
``top_words`` most frequent ones of each, of any length. A document is rejected when it is far
from every language it is compared with in either histogram, unless it is shorter than that
histogram's guard.

A document is compared with the ``main`` languages (those of at least ``main_share``
of the documents, so at most ``1 / main_share`` of them) and with its own language. A language with too few
words for a reference that is not a main one either has nothing to be held against: its documents are not judged by
divergence (``judged`` false, distances null), only by the fixed rules. The references of other languages than the main
ones are a table of one small row a language, joined on ``lang``; Spark broadcasts it only if it is small when it runs.

Fixed rules besides: fewer than ``min_words`` words, or more than half of the words
inside three-word windows that occur twice or more in the document.

Null text: no words, so it fails the fixed rules. Empty table: no rows. Null and empty
``lang``: one language of their own. Repeated rows are judged one by one.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import let, long_array, stored, words

SYMBOLS = "#*$%&|<>"
SLOTS = 1 << 14
CLASSES = 5


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    top_words: int = 40
    main_share: float = 0.01
    reference_words: int = 2000
    min_chars_guard: int = 200
    min_words_guard: int = 100
    max_char_distance: float = 0.30
    max_word_distance: float = 0.45


def _count_repeat_words(ws: Column) -> Column:
    """Words inside three-word windows found twice or more in the text.

    A window is one long: the hash in the high bits, its position in the low bits
    (as many as this text needs), so that one primitive sort brings equal windows
    together."""

    def covered(a: Column, n: Column, bits: Column) -> Column:
        def keys(h: Column) -> Column:
            return F.transform(h, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long")))

        def from_sorted(s: Column) -> Column:
            high = lambda j: F.call_function("shiftrightunsigned", s[j], bits)
            again = F.filter(F.sequence(F.lit(0), n - 3), lambda j: ((j > 0) & (high(j) == high(j - 1)))
                             | ((j < n - 3) & (high(j) == high(j + 1))))
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            at = F.sort_array(F.transform(again, lambda j: s[j].bitwiseAND(mask)))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.when(k + 1 < F.size(p), F.least(F.lit(3).cast("long"), p[k + 1] - x))
                            .otherwise(F.lit(3).cast("long"))),
                F.lit(0).cast("long"), lambda a, x: a + x))

        windows = F.transform(F.slice(a, 1, n - 2), lambda x, i: F.xxhash64(x, F.get(a, i + 1), F.get(a, i + 2)))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                   .otherwise(let(F.sort_array(keys(h)), from_sorted)))

    return F.when(F.size(ws) < 4, F.lit(0).cast("long")).otherwise(
        let(ws, lambda a: let(F.size(a), lambda n: let(F.length(F.bin(n)), lambda b: covered(a, n, b)))))


def _count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """Adds the per-document counts; the words stay as ``_words``, the character
    classes as ``_counts``: symbols, other ASCII marks and digits, bytes beyond one
    per character, other word characters, space."""
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    ws = F.col("_words")
    n, symbols, marks = F.col("_chars"), F.col("n_symbols"), F.col("_marks")
    return (
        docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
        .withColumn("_words", words(F.col("_text")))
        .withColumn("_chars", F.char_length("_text").cast("long"))
        .withColumn("n_words", F.size(ws).cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join(ws, "")).cast("long"))
        .withColumn("n_symbols", _count_of(F.col("_text"), "[" + SYMBOLS + "]"))
        .withColumn("_marks", _count_of(F.col("_text"), r"[!-/0-9:-@\[-`{-~]"))
        .withColumn("n_dup_lines", let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"))
        .withColumn("n_repeat_words", _count_repeat_words(ws))
        .withColumn("_counts", F.array(symbols, marks - symbols, F.octet_length("_text") - n,
                                       F.col("word_chars") - marks, n - F.col("word_chars")))
        .drop("_marks")
    )


def _kl_term(p: Column, q: Column) -> Column:
    """Half of p * log2(2p / (p + q)); nothing where p is 0."""
    return F.when(p > 0, 0.5 * p * F.log2(2.0 * p / (p + q))).otherwise(0.0)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def references(docs: DataFrame, rules: Rules = Rules()) -> dict:
    """Language references over all rows (lang, _words, _counts): shares of character
    classes, the common words and their shares, all from one aggregation by (language,
    feature). ``langs``, ``chars``, ``vocab`` and ``shares`` are those of the main languages (at most 1 / main_share);
    ``others`` is a table of the rest that have enough words, None if there are none."""
    spark = docs.sparkSession
    long0 = F.lit(1).cast("long")
    features = F.concat(
        F.transform(F.col("_counts"), lambda c, i: F.struct(F.concat(F.lit("\n"), i.cast("string")).alias("w"), c.alias("n"))),
        F.array(F.struct(F.lit("\nwords").alias("w"), F.size("_words").cast("long").alias("n")),
                F.struct(F.lit("\ndocs").alias("w"), long0.alias("n"))),
        F.transform(F.col("_words"), lambda w: F.struct(w.alias("w"), long0.alias("n"))))  # a word has no line feed
    sums = stored(
        docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.inline(features))
        .groupBy("lang", "w").agg(F.sum("n").alias("n")))
    docs_of = sums.where(F.col("w") == "\ndocs").select("lang", F.col("n").alias("n_docs"))
    least = rules.main_share * (docs_of.agg(F.sum("n_docs")).first()[0] or 0)
    names = [r["lang"] for r in docs_of.where(F.col("n_docs") >= least).orderBy("lang").collect()]  # <= 1 / main_share
    others = _other_references(sums.where(~F.col("lang").isin(names)), rules)
    if not names:
        return {"langs": [], "others": others}
    own = sums.where(F.col("lang").isin(names))
    fixed = {(r["lang"], r["w"]): r["n"] for r in own.where(F.col("w").startswith("\n")).collect()}
    chars = []
    for g in names:
        c = [float(fixed[g, f"\n{i}"]) for i in range(CLASSES)]
        chars.append([x / (sum(c) or 1.0) for x in c])
    totals = spark.createDataFrame([(g, fixed[g, "\nwords"]) for g in names], "lang string, n_lang long")
    # words that make up at least 1/5000 of their language: at most 5000 for each
    head = own.where(~F.col("w").startswith("\n")).join(F.broadcast(totals), "lang").where(F.col("n") * 5000 >= F.col("n_lang"))
    ranked = head.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w")))
    rows = ranked.collect()
    vocab = sorted({r["w"] for r in rows if r["rank"] <= rules.top_words})
    at = {w: i for i, w in enumerate(vocab)}
    shares = [[0.0] * len(vocab) for _ in names]
    for r in rows:
        if r["w"] in at:
            shares[names.index(r["lang"])][at[r["w"]]] = r["n"] / r["n_lang"]
    return {"langs": names, "chars": chars, "vocab": vocab, "shares": shares, "others": others}


def _other_references(sums: DataFrame, rules: Rules) -> DataFrame | None:
    """One row (_ref_lang, _ref_chars, _ref_words, _ref_shares) for each language with enough words; the commonest words of
    a language are kept as its rows are aggregated, so no task holds a language's vocabulary."""
    n_words = sums.where((F.col("w") == "\nwords") & (F.col("n") >= rules.reference_words)).select("lang", F.col("n").alias("n_lang"))
    if n_words.isEmpty():
        return None
    fixed = sums.where(F.col("w").startswith("\n")).groupBy("lang").agg(
        *[F.max(F.when(F.col("w") == f"\n{i}", F.col("n"))).alias(f"c{i}") for i in range(CLASSES)])
    total = F.greatest(sum((F.col(f"c{i}") for i in range(CLASSES)), F.lit(0)), F.lit(1))
    common = sums.where(~F.col("w").startswith("\n")).join(n_words, "lang").where(F.col("n") * 5000 >= F.col("n_lang"))
    ranked = common.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w")))
    heads = ranked.where(F.col("rank") <= rules.top_words).groupBy("lang").agg(F.sort_array(F.collect_list(
        F.struct("w", (F.col("n") / F.col("n_lang")).alias("q")))).alias("head"))
    return stored(n_words.join(fixed, "lang").join(heads, "lang", "left").select(
        F.col("lang").alias("_ref_lang"), F.array(*[F.col(f"c{i}") / total for i in range(CLASSES)]).alias("_ref_chars"),
        F.coalesce(F.col("head.w"), F.array().cast("array<string>")).alias("_ref_words"),
        F.coalesce(F.col("head.q"), F.array().cast("array<double>")).alias("_ref_shares")))


def _own_char_distance(counts: Column, ref: Column) -> Column:
    """Distance to the joined reference."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1).cast("long"))
    terms = let(total, lambda t: F.zip_with(F.transform(counts, lambda x: x / t), ref, lambda p, q: _kl_term(p, q) + _kl_term(q, p)))
    return F.sqrt(F.greatest(_total(terms), F.lit(0.0)))


def _own_word_distance(ws: Column, names: Column, shares: Column) -> Column:
    """Distance to the joined reference over its common words and 'any other word'."""
    def to(at: Column, n: Column) -> Column:
        seen = F.transform(names, lambda w, i: F.size(F.filter(at, lambda a: a == i + 1)) / n)
        rest, q_rest = F.greatest(1.0 - F.size(at) / n, F.lit(0.0)), F.greatest(1.0 - _total(shares), F.lit(0.0))
        return _total(F.zip_with(seen, shares, lambda p, q: _kl_term(p, q) + _kl_term(q, p))) + _kl_term(rest, q_rest) + _kl_term(q_rest, rest)

    places = F.filter(F.transform(ws, lambda w: F.array_position(names, w)), lambda i: i > 0)
    return F.when(F.size(names) == 0, F.lit(0.0)).otherwise(let(places, lambda at: F.when(F.size(at) == 0, F.lit(1.0)).otherwise(
        let(F.greatest(F.size(ws), F.lit(1)).cast("double"), lambda n: F.sqrt(F.greatest(to(at, n), F.lit(0.0)))))))


def _char_distance(counts: Column, refs: dict) -> Column:
    """Distance to the nearest language."""
    def one(p: Column) -> Column:
        each = [
            sum((_kl_term(p[i], F.lit(q)) + _kl_term(F.lit(q), p[i]) for i, q in enumerate(ref)), F.lit(0.0))
            for ref in refs["chars"]
        ]
        return F.sqrt(F.greatest(F.array_min(F.array(*each)), F.lit(0.0)))

    def shares(c: Column) -> Column:
        total = F.greatest(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1).cast("long"))
        return let(total, lambda t: F.transform(c, lambda x: x / t))

    return let(let(counts, shares), one)


def _slots(spark, vocab: list[str]) -> tuple[int, list[int]]:
    """A hash seed under which the common words have slots of their own, and each slot's word number (0: none)."""
    rows = spark.createDataFrame([(i + 1, w) for i, w in enumerate(vocab)], "i int, w string")
    size = SLOTS
    while True:
        slots = rows.select("i", *[_slot(F.col("w"), seed, size).alias(f"s{seed}") for seed in range(16)]).collect()
        for seed in range(16):
            own = {r[f"s{seed}"]: r["i"] for r in slots}
            if len(own) == len(vocab):
                return seed, [own.get(k, 0) for k in range(size)]
        size *= 2


def _slot(word: Column, seed: int, size: int) -> Column:
    return F.pmod(F.xxhash64(word, F.lit(seed)), F.lit(size)).cast("int")


def _word_distance(spark, ws: Column, refs: dict) -> Column:
    """Distance to the nearest language over the common words and 'any other word'."""
    vocab = refs["vocab"]
    if not vocab:
        return F.lit(0.0)
    seed, table = _slots(spark, vocab)
    at, names = long_array(table).cast("array<int>"), F.lit(["\n"] + vocab)  # no word holds a line feed

    def number(w: Column) -> Column:
        i = F.get(at, _slot(w, seed, len(table)))
        return F.when(F.get(names, i) == w, i).otherwise(0)

    def from_runs(s: Column, n: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == F.size(s) - 1) | (s[j] != F.try_element_at(s, j + 2)))

        def nearest(runs: Column) -> Column:
            p_rest = F.greatest(1.0 - F.size(s) / n, F.lit(0.0))

            def to(q: list[float]) -> Column:
                ref, q_rest = F.lit([0.0] + q), F.lit(max(0.0, 1.0 - sum(q)))
                seen = _total(F.transform(runs, lambda r: let(ref[r["i"]], lambda x: _kl_term(r["p"], x)
                                                              + _kl_term(x, r["p"]) - 0.5 * x)))
                return seen + 0.5 * sum(q) + _kl_term(p_rest, q_rest) + _kl_term(q_rest, p_rest)

            return F.sqrt(F.greatest(F.array_min(F.array(*[to(q) for q in refs["shares"]])), F.lit(0.0)))

        runs = let(ends, lambda e: F.transform(e, lambda j, k: F.struct(
            s[j].alias("i"), ((j - F.when(k > 0, F.get(e, k - 1)).otherwise(-1)) / n).alias("p"))))
        return let(runs, nearest)

    short = F.filter(ws, lambda w: F.char_length(w) <= max(map(len, vocab)))
    ids = F.filter(F.transform(short, number), lambda i: i > 0)

    return let(F.sort_array(ids), lambda s: F.when(F.size(s) == 0, F.lit(1.0)).otherwise(
        let(F.size(ws).cast("double"), lambda n: from_runs(s, n))))


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` (text, lang, any other columns but those of ``ADDED``, which are replaced) with the counts, the two
    distances, ``judged``, ``base_failed`` and ``kept``."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ADDED]
    measured = measures(docs.select(*names))
    refs = references(measured.select("lang", "_words", "_counts"), rules)
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    none = F.lit(None).cast("double")
    char_d = word_d = none
    own = F.coalesce(F.col("lang"), F.lit(""))
    main = own.isin(refs["langs"])
    if refs["langs"]:
        char_d, word_d = _char_distance(F.col("_counts"), refs), _word_distance(spark, F.col("_words"), refs)
    judged = main
    if refs["others"] is not None:
        measured = measured.join(refs["others"], own == F.col("_ref_lang"), "left")
        has_own = F.col("_ref_lang").isNotNull()
        judged = main | has_own
        char_d = F.when(has_own, F.least(char_d, _own_char_distance(F.col("_counts"), F.col("_ref_chars")))).otherwise(char_d)
        word_d = F.when(has_own, F.least(word_d, _own_word_distance(F.col("_words"), F.col("_ref_words"), F.col("_ref_shares")))).otherwise(word_d)
    far = (((F.col("_chars") >= rules.min_chars_guard) & (F.col("char_distance") > rules.max_char_distance))
           | ((F.col("n_words") >= rules.min_words_guard) & (F.col("word_distance") > rules.max_word_distance)))
    return (
        measured.withColumn("judged", judged)
        .withColumn("char_distance", F.when(F.col("judged"), char_d))
        .withColumn("word_distance", F.when(F.col("judged"), word_d))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~(F.col("judged") & far))
        .drop("_text", "_words", "_counts", "_chars", "_ref_lang", "_ref_chars", "_ref_words", "_ref_shares")
    )


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance",
         "judged", "base_failed", "kept", "_ref_lang", "_ref_chars", "_ref_words", "_ref_shares", "_text", "_words", "_counts", "_chars")
