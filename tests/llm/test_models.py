"""Chat formatting, token counts, toxicity, HTML extraction and the language model: round trips and brute force."""
import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendspark.llm import language_model as lm
from lendspark.llm.chat_format import format_chats, loss_text, read_turns
from lendspark.llm.html_extract import Extraction, covered_tokens, extract_main_text, host_of, page_blocks
from lendspark.llm.token_counts import Trie, count_tokens, load_pieces
from lendspark.llm.toxicity import Model, Scanner, Toxicity, fit, maximal_segments, score_toxicity

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


# --- chat formatting

HARD = ["\\### Assistant: </turn> ok", "### user: x</turn>", "\\", "\\\\", "a\\", "\\h\\l\\c", "#<\\#\\<", "", None, "é\n\n ", "<</turn>>", "\\\\h"]


def chat_rows():
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HARD)]
    rows += [(2, i, ("user", "user", "assistant", "assistant", "a:b#", None)[i % 6], t) for i, t in enumerate(HARD)]
    rows += [(None, 1, "assistant", "x"), (3, None, "user", "first"), (3, 0, "assistant", "z"), (3, 0, "assistant", "z"), (3, 0, "assistant", "a")]
    return rows


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(chat_rows(), "conv_id long, turn long, role string, text string").withColumn("name", F.lit("x"))
    got = format_chats(turns).withColumn("read", read_turns(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    want = {}
    for c, t, r, x in chat_rows():
        want.setdefault(c, []).append(((t is not None, t or 0, r or "", x or "")))
    assert len(got) == 4
    for row in got:
        own = sorted(want[row["conv_id"]])
        assert [(t["role"], t["text"]) for t in row["read"]] == [(r, x) for _, _, r, x in own]
        assert row["loss"] == "".join(x for _, _, r, x in own if r == "assistant")
        assert row["n_turns"] == len(own)
        assert row["n_blocks"] == 1 + sum(a[2] != b[2] for a, b in zip(own, own[1:]))
    assert format_chats(turns.where("false")).count() == 0


# --- token counts

def best_split(text: str, pieces: dict, unknown: float):
    """(score, pieces, forward) by the plain recursion."""
    best, forward = [(0.0, 0)], [0.0]
    for end in range(1, len(text) + 1):
        options = [(b, pieces[text[b:end]]) for b in range(end) if text[b:end] in pieces]
        if text[end - 1] not in pieces:
            options.append((end - 1, unknown))
        s = max(best[b][0] + p for b, p in options)
        c = min(best[b][1] + 1 for b, p in options if best[b][0] + p >= s - 1e-12)
        best.append((s, c))
        forward.append(math.log(sum(math.exp(forward[b] + p) for b, p in options)))
    return best[-1][0], best[-1][1], forward[-1]


def test_trie_against_recursion():
    rng = random.Random(1)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 5 for _ in range(30)} | {"a": -3.0, "b": -3.0}
    trie = Trie(pieces)
    seen = set()
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        seen |= {word[:k] for k in range(1, len(word) + 1)}
        node = trie.insert(word)
        s, c, f = best_split(word, pieces, trie.unknown)
        assert trie.best[node] == pytest.approx(s) and trie.count[node] == c and trie.forward[node] == pytest.approx(f)
    assert len(trie.best) == len(seen) + 1  # one node for each distinct prefix


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary file")
def test_token_counts(spark, monkeypatch):
    pieces = load_pieces(PIECES)
    unknown = min(pieces.values()) - 10
    assert sum(map(math.exp, pieces.values())) == pytest.approx(1.0)
    rows = [(1, "The quick  brown\nfox fox"), (2, None), (3, ""), (4, "日本 \U0001F600 é"), (5, "x" * 3000), (1, "The quick  brown\nfox fox")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).coalesce(1)
    got = count_tokens(docs, PIECES).collect()
    monkeypatch.setattr("lendspark.llm.token_counts.SLICE_BYTES", 1)
    assert sorted(map(str, count_tokens(docs, PIECES).collect())) == sorted(map(str, got))
    assert len(got) == 6
    for r in got:
        own = [best_split("▁" + w, pieces, unknown) for w in (r["text"] or "").split()] if r["doc_id"] != 5 else None
        if own is not None:
            assert (r["n_pretokens"], r["n_tokens"]) == (len(own), sum(x[1] for x in own))
            assert r["forward_score"] == pytest.approx(sum(x[2] for x in own))
    assert count_tokens(docs.where("false"), PIECES, keep=["doc_id"]).count() == 0


# --- toxicity

def slow_segments(w):
    """Ruzzo and Tompa's definition by recursion: take the best segment, then what is left and right of it."""
    def go(a, b):
        best = max(((sum(w[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        s, _, _, i, j = best
        return go(a, i) + [(i, j, s)] + go(j, b)
    return go(0, len(w))


def test_maximal_segments():
    rng = random.Random(5)
    for _ in range(300):
        w = [rng.choice([-5, -3, -2, -1, 1, 2, 3, 4]) + rng.random() * 1e-3 for _ in range(rng.randint(0, 14))]
        got, want = maximal_segments(w), slow_segments(w)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def toxic_docs(n=300):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        w = [f"word{rng.randint(0, 200)}" for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randint(0, len(w))
            w[at:at] = [f"vile{rng.choice('abcdefgh')}{rng.choice('klmnop')}" for _ in range(6)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_held_out_accuracy(spark):
    rows, labels = toxic_docs()
    docs = spark.createDataFrame(rows + [(None, None), (9000, ""), (0, rows[0][1])], "doc_id long, text string").withColumn("score", F.lit("x"))
    marks = spark.createDataFrame(labels + [(None, 1), (5, None), (0, 0)], "doc_id long, toxic int")
    model = fit(docs.where("doc_id % 3 > 0"), marks)
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + 3
    truth = dict(labels)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000 and r["doc_id"] % 3 == 0]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        for p in r["passages"]:
            assert 0 <= p["start"] < p["end"] <= r["n_words"]
    nothing = next(r for r in got if r["doc_id"] == 9000)
    assert nothing["best"] == 0 and nothing["passages"] == [] and nothing["score"] < 0.5
    assert any(r["passages"] for r in held)
    assert score_toxicity(docs, Model({}, Toxicity(), 1.0, 1.0, 0.0)).where("score > 0").count() == 0
    assert fit(docs.where("false"), marks).weights == {} and fit(docs, marks.where("toxic = 0")).weights == {}


def test_longest_beginning_counts():
    s = Scanner({b"\nabcd": 1.0, b"\nabcdef": 3.0, b"abcdxx": 5.0}, Toxicity(drift=0.5))
    assert [s.weight(w) for w in (b"abcdzz", b"abcdefgh", b"abcdxx", b"abc")] == [0.5, 2.5, 4.5, -0.5]


# --- html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">Cookies!</div><!-- <p>no</p> -->
<article><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text<br>line<p>Second &lt;p&gt; x &#233;<ul><li>one<li>two</ul>
<div class="ad">Buy</div><table><tr><td>a<td>b</table><form><p>Send</p></form></article>
<section id="comments"><article class="comment"><p>Nice</p></article></section><aside>Side</aside><footer>&copy; me</footer>"""


def test_page_blocks():
    assert page_blocks(PAGE) == (["Title & more", "First bold text line", "Second <p> x é", "one", "two", "a", "b"], True)
    assert page_blocks("") == ([], False) and page_blocks("just text") == (["just text"], False)
    assert page_blocks("<p>a<p>b<nav>c</p>d</nav>e") == (["a", "b", "e"], False)
    assert page_blocks("<main><p>in</p></main><p>out</p>") == (["in"], True)
    assert page_blocks("<p>unclosed <script>x") == (["unclosed"], False)
    assert page_blocks("a < b <p>c") == (["a < b", "c"], False)


def test_host(spark):
    urls = [("http://A.b:80/c", "a.b"), ("https://u@x.y?q", "x.y"), ("/z", ""), (None, "")]
    assert all(r["h"] == r["want"] for r in spark.createDataFrame(urls, "u string, want string").withColumn("h", host_of(F.col("u"))).collect())


def test_covered_tokens_against_all_substrings():
    rng = random.Random(4)
    for _ in range(20):
        pages = [[" ".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 5))] for _ in range(6)]
        cfg = Extraction(run=4, share=0.5, least_pages=2)
        streams = [[t for b in p for t in (*b.split(), "|")] for p in pages]
        where = {}
        for k, s in enumerate(streams):
            for i in range(len(s) - 3):
                where.setdefault(tuple(s[i : i + 4]), set()).add(k)
        for s, flags in zip(streams, covered_tokens(pages, cfg)):
            want = [False] * len(s)
            for i in range(len(s) - 3):
                if len(where[tuple(s[i : i + 4])]) >= 3:
                    want[i : i + 4] = [True] * 4
            assert flags.tolist() == want


def test_extract_by_host(spark):
    common = "<div><p>Subscribe to our letter today and win a prize every single week</p></div>"
    pages = [(i, "http://h/x", f"<body>{common}<p>{' '.join(f'own{i}x{j}' for j in range(30))}</p></body>") for i in range(20)]
    pages += [(100, None, None), (101, "http://h/y", ""), (102, "http://k/", PAGE), (None, "http://k/", "<p>q"), (0, *pages[0][1:])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    for cfg in (Extraction(), Extraction(shard_bytes=2500, least_pages=3)):
        got = extract_main_text(df, cfg).collect()
        assert len(got) == len(pages)
        text = {r["page_id"]: r["text"] for r in got}
        for i in range(20):
            assert text[i] == " ".join(f"own{i}x{j}" for j in range(30))
        assert text[100] == text[101] == "" and text[None] == "q" and text[102].startswith("Title & more\n\nFirst")
    copies = spark.createDataFrame([(i, "http://h/x", "<article><p>" + "one copy of an article on every page " * 3 + "</p></article>") for i in range(20)],
                                   "page_id long, url string, html string")
    assert extract_main_text(copies).where("text = ''").count() == 0
    assert extract_main_text(df.where("false")).count() == 0


def test_extract_does_not_depend_on_shards(spark):
    """A notice on half of a host's pages goes, one on fewer stays, however the host is cut."""
    often, seldom = "<p>this notice stands on exactly one half of all the pages</p>", "<p>that notice stands on one page less than the half of them</p>"
    pages = [(i, "http://h/x", f"<body>{often * (i < 15)}{seldom * (i % 2 and i > 1)}<p>{' '.join(f'own{i}x{j}' for j in range(30))}</p></body>") for i in range(30)]
    pages += [(100 + i, "http://k/x", f"<body>{often}<p>{' '.join(f'own{i}x{j}' for j in range(30))}</p></body>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for shard_bytes in (3_000_000, 2500, 1):
        text = {r["page_id"]: r["text"] for r in extract_main_text(df, Extraction(shard_bytes=shard_bytes)).collect()}
        assert sum("this notice" in text[i] for i in range(30)) == 0
        assert sum("that notice" in text[i] for i in range(30)) == 14
        assert sum("this notice" in text[100 + i] for i in range(9)) == 9        # fewer than ten pages


# --- language model

def test_draw_tables_is_the_exact_conditional():
    """Against the distribution over all seatings of five customers."""
    d, a, c = 0.6, 0.7, 5
    weights = {}

    def seat(sizes, n, w):
        if n == c:
            weights[len(sizes)] = weights.get(len(sizes), 0) + w
            return
        for k in range(len(sizes)):
            seat(sizes[:k] + [sizes[k] + 1] + sizes[k + 1:], n + 1, w * (sizes[k] - d))
        seat(sizes + [1], n + 1, w * a)

    seat([1], 1, a)
    want = np.array([weights[t] for t in range(1, c + 1)]) / sum(weights.values())
    drawn = lm.draw_tables(np.full(200_000, c), np.full(200_000, a), d, np.random.default_rng(0))
    assert np.abs(np.bincount(drawn, minlength=c + 1)[1:] / 200_000 - want).max() < 0.01
    counts = np.array([0, 1, 2, 16, 17, 1000, 100_000])
    t = lm.draw_tables(counts, np.full(7, 3.0), d, np.random.default_rng(0))
    assert (t <= counts).all() and (t >= np.minimum(counts, 1)).all() and t[5] > 1


def text_rows(n=80):
    rng = random.Random(2)
    follow = {f"w{k}": [f"w{rng.randint(0, 39)}" for _ in range(3)] for k in range(40)}
    rows = []
    for i in range(n):
        w = ["w0"]
        for _ in range(rng.randint(20, 120)):
            w.append(rng.choice(follow[w[-1]]))
        rows.append((i, " ".join(w)))
    return rows + [(900, None), (901, ""), (902, "Only UNSEEN things"), (None, "w1 w2"), (0, rows[0][1])]


@pytest.mark.parametrize("cfg", [lm.Seating(least_buckets=1), lm.Seating(least_buckets=5, sweeps=4, burn_in=2)])
def test_language_model(spark, cfg):
    rows = text_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit("x")).repartition(3)
    got = lm.score_documents(docs, F.col("doc_id") % 4 == 1, cfg).collect()
    assert len(got) == len(rows)
    counts, total = {}, 0
    for i, t in rows:
        if i is None or i % 4 != 1:
            for w in [*(t or "").lower().split(), "\n"]:
                counts[w] = counts.get(w, 0) + 1
                total += 1
    for r in got:
        t = next(t for i, t in rows if i == r["doc_id"])
        own = [*(t or "").lower().split(), "\n"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in own))
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert len(held) == 20 and sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)
    again = {(r["doc_id"], r["score"]) for r in lm.score_documents(docs.repartition(2), F.col("doc_id") % 4 == 1, cfg).collect()}
    assert sorted(x[1] for x in again) == pytest.approx(sorted({(r["doc_id"], r["score"]): r["score"] for r in got}.values()))
    assert lm.score_documents(docs.where("false"), F.lit(False), cfg).count() == 0


def test_language_model_sums_to_one():
    """After every sweep, the probabilities of all known tokens and the unknown one add up to 1 in the parent and in every context."""
    texts = [t.encode() for _, t in text_rows() if t]
    blocks = lm.pack_slice(texts, np.arange(len(texts)), np.zeros(len(texts), bool), 1)
    names = [c.split(" ")[0] for c in lm.BLOCK.split(", ")]
    row = lm._assemble(pa.Table.from_pylist([dict(zip(names, blocks[0]))])).to_pylist()[0]
    b, cfg = lm.Bucket(row), lm.Seating()

    def sums(x):
        return np.bincount(b.context, weights=x, minlength=lm.CONTEXTS)

    tables, per_word, root = b.start()
    shape = lm.Shape(int(b.count.sum()), int(root.sum()), sums(b.count), 0.6, 0.4)
    totals = [lm.Totals(sums(tables), float(tables.sum()), float(root.sum()))]
    for _ in range(3):
        tables, per_word, root = list(b.states(shape, totals, cfg))[-1]
        assert (tables <= b.count).all() and (root <= per_word).all()
        g = lm.Totals(sums(tables), float(tables.sum()), float(root.sum()))
        totals.append(g)
        p = b.parent(per_word, root, shape, g, cfg)
        unknown = (cfg.root_theta + shape.root_discount * g.root_tables) / (shape.types + 1) / (cfg.root_theta + g.root_customers)
        assert p.sum() + unknown == pytest.approx(1.0)
        mass = sums(b.count - shape.discount * tables) + (cfg.theta + shape.discount * g.tables) * (p.sum() + unknown)
        assert np.allclose(mass, cfg.theta + shape.customers)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score_documents(docs, F.lit(True)).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["score"] == 0.0 and got[2]["n_tokens"] == 1
