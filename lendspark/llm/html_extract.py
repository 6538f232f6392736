r"""Main text of HTML pages, with boilerplate found by a suffix array for each host.

First every page is cut into blocks (paragraphs, headings, list items, cells ...). Elements that are
never main text go: scripts, styles, menus, page headers and footers, sidebars, forms, and whatever
carries a class, id or role of adverts, notices, comments and the like. If the page has an
``article`` (else a ``main``) element, only its blocks stay.

Then the blocks' tokens of all pages of a host form one stream; its suffixes are sorted by prefix
doubling up to ``run`` tokens, which yields every substring of ``run`` tokens or more that repeats
across distinct pages. Tokens of substrings that occur on at least ``share`` of the host's pages (and on
``least_pages`` of them) are covered; a block that is covered altogether is boilerplate and is
removed, wherever it stands, and runs between covered ones are kept. Outside ``article`` and ``main`` a
block goes if most of it is covered. A page that would lose all its text keeps it: copies of one
article are no boilerplate.

A host with many pages is split by a hash of the page into shards of about ``shard_bytes`` bytes of
html, each with its own suffix array, so no group grows with the input. The shards decide nothing: a
substring on enough of the host's pages is on that share of the pages of some shard at least, the
substrings that are (some two pages of tokens a shard) are counted on all pages of the host, and the sum is compared
with the pages of the whole host. Between tasks a substring is 64 bits of hash.

Null or empty html, or no text left: empty text. Null url: host "". Repeated rows stay, and count as
pages of their own. Only page_id, url and html are used. Empty table: no rows.
"""
from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored


@dataclass(frozen=True)
class Extraction:
    run: int = 8
    share: float = 0.5
    least_pages: int = 10
    mostly: float = 0.8
    shard_bytes: int = 3_000_000

    def needed(self, pages: int) -> int:
        """Pages of a host of ``pages`` that a substring must be on."""
        return max(self.least_pages, math.ceil(self.share * pages))


# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("head script style noscript template svg math iframe object audio video canvas select button form nav "
                    "footer aside dialog menu title textarea datalist xmp noembed noframes map".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                   "pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes, up to the nearest of the tags behind the bar.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
          "tbody": ("thead tbody tr td th", "table"), "tfoot": ("tbody tr td th", "table")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

# Fixed words: parts of class and id names, and roles, that mark what is not main text.
NOT_MAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar side aside widget widgets "
    "footer foot masthead header topbar toolbar skip "
    "comment comments commentlist reply replies disqus respond discussion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall "
    "newsletter subscribe subscription signup login search share sharing social related recommended "
    "copyright disclaimer hidden".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form "
                           "toolbar status".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
                 r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.S)
PART = re.compile(r"[a-z]+")


def _excluded(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            for part in PART.findall(value):
                if part in NOT_MAIN:
                    return True
        elif name == "role" and value in NOT_MAIN_ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def page_blocks(source: str) -> tuple[list[str], bool]:
    """Text blocks in page order, and whether they come from an ``article`` or ``main`` element."""
    blocks: list[tuple[str, bool, bool, bool]] = []  # text, in article, in main, heading
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements; 1: excluded, 2: article, 4: main, 8: header
    at = 0

    def state(bit: int) -> bool:
        return any(f & bit for _, f in stack)

    def flush() -> None:
        joined = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if joined:
            blocks.append((joined, state(2), state(4), state(8)))

    skipping = 0
    end = len(source)
    while at < end:
        m = TAG.search(source, at)
        stop = m.start() if m else end
        if stop > at and not skipping:
            text.append(source[at:stop])
        if not m:
            break
        at = m.end()
        cdata, closing, opening, attributes = m.groups()
        if cdata is not None:
            if not skipping:
                text.append(cdata.replace("&", "&amp;"))
        elif closing:
            tag = closing.lower()
            if tag in BLOCKS and not skipping:
                flush()
            k = len(stack) - 1
            while k >= 0 and stack[k][0] != tag:
                k -= 1
            if k >= 0:
                skipping -= sum(f & 1 for _, f in stack[k:])
                del stack[k:]
            elif tag == "br" and not skipping:
                text.append(" ")
        elif opening:
            tag = opening.lower()
            if tag in BLOCKS:
                if not skipping:
                    flush()
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in BLOCKS:
                    k -= 1
                if k >= 0 and stack[k][0] == "p":  # a block ends an open paragraph
                    skipping -= sum(f & 1 for _, f in stack[k:])
                    del stack[k:]
            if tag in CLOSES:
                closes, limits = CLOSES[tag]
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in closes and stack[k][0] not in limits:
                    k -= 1
                if k >= 0 and stack[k][0] in closes:
                    skipping -= sum(f & 1 for _, f in stack[k:])
                    del stack[k:]
            if tag in VOID:
                if not skipping and tag in ("br", "img", "wbr", "hr"):
                    text.append(" " if tag != "wbr" else "")
                continue
            if attributes.endswith("/") and tag in ("svg", "math"):
                continue
            out = _excluded(tag, attributes)
            stack.append((tag, (1 if out else 0) | (2 if tag == "article" and not out else 0)
                          | (4 if tag == "main" or 'role="main"' in attributes else 0) | (8 if tag == "header" else 0)))
            skipping += out
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = close.start() if close else end
    flush()
    for zone in (1, 2):
        if any(b[zone] for b in blocks):
            return [b[0] for b in blocks if b[zone] and (not b[3] or _is_title(b, blocks, zone))], True
    return [b[0] for b in blocks if not b[3]], False


def _is_title(block: tuple, blocks: list[tuple], zone: int) -> bool:
    """The header of an article holds its title: the first block there."""
    return next((b for b in blocks if b[zone]), None) is block


def host_of(url: Column) -> Column:
    pattern = r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


def _cut(batches):
    for batch in batches:
        found = [page_blocks(h or "")[0] for h in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.string()))], names=[*batch.schema.names[:-1], "blocks"])


class Runs:
    """Hashes of the ``run``-token substrings of a page: 64 bits of each token (and of the mark after each block), times an
    odd number for its place."""

    KEPT = 1_000_000        # token hashes kept at most

    def __init__(self, run: int):
        self.run, self.known = run, {}
        self.places = np.array([self._bits(f"place {k}") | 1 for k in range(run)], dtype=np.uint64)
        self.mark = self._bits("")       # no token is empty

    @staticmethod
    def _bits(token: str) -> int:
        return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")

    def _token(self, token: str) -> int:
        if (found := self.known.get(token)) is None:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            found = self.known[token] = self._bits(token)
        return found

    def of(self, blocks: list[str]) -> np.ndarray:
        """One hash for each substring, by its first token; none of a page of fewer tokens."""
        stream: list[int] = []
        for b in blocks:
            stream += map(self._token, b.split(" "))
            stream.append(self.mark)
        tokens = np.array(stream, dtype=np.uint64)
        n = max(len(tokens) - self.run + 1, 0)
        out = np.zeros(n, dtype=np.uint64)
        for k, place in enumerate(self.places):
            out += tokens[k:k + n] * place
        return out.view(np.int64)


def repeated_runs(pages: list[list[str]], least: int, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the substrings of ``run`` tokens that occur on ``least`` of the pages or more, and the number of pages of
    each. Suffixes are ranked by prefix doubling."""
    numbers: dict[str, int] = {}
    stream: list[int] = []
    begins = []
    for k, blocks in enumerate(pages):
        stream.append(-k - 1)  # a page's own mark: no substring runs from page to page
        begins.append(len(stream))
        for b in blocks:
            stream += [numbers.setdefault(t, len(numbers) + 1) for t in b.split(" ")]
            stream.append(0)
    n = len(stream)
    _, rank = np.unique(np.array(stream, dtype=np.int64), return_inverse=True)
    rank = rank.astype(np.int64)
    length = 1
    while length < runs.run:
        step = min(length, runs.run - length)
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:]
        _, rank = np.unique(rank * (n + 2) + after + 1, return_inverse=True)
        rank = rank.astype(np.int64)
        length += step
    begins = np.array(begins)
    page = np.searchsorted(begins - 1, np.arange(n), side="right") - 1
    inside = np.flatnonzero((np.arange(n) >= begins[page]) & (np.arange(n) + runs.run <= np.append(begins[1:] - 1, n)[page]))
    pairs = np.unique(rank[inside] * len(pages) + page[inside])
    on_pages = np.bincount(pairs // len(pages), minlength=n)
    _, first = np.unique(rank[inside], return_index=True)
    first = inside[first[on_pages[rank[inside[first]]] >= least]]
    hashes = {k: runs.of(pages[k]) for k in np.unique(page[first]).tolist()}
    found = np.array([hashes[k][at - begins[k]] for k, at in zip(page[first].tolist(), first.tolist())], dtype=np.int64)
    return found, on_pages[rank[first]]


def covered_by(blocks: list[str], repeated: np.ndarray, runs: Runs) -> np.ndarray:
    """A flag for every token of a page's blocks (with a mark after each block): inside one of the ``repeated`` substrings."""
    hashes = runs.of(blocks)
    hits = np.flatnonzero(np.isin(hashes, repeated))
    edge = np.zeros(sum(b.count(" ") + 2 for b in blocks) + 1, dtype=np.int32)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + runs.run, -1)
    return np.cumsum(edge)[:-1] > 0


def covered_tokens(pages: list[list[str]], cfg: Extraction) -> list[np.ndarray]:
    """For each page of a host, a flag for every token of its blocks (with a mark after each block): inside a substring of
    ``run`` tokens or more that occurs on enough distinct pages."""
    runs = Runs(cfg.run)
    repeated, _ = repeated_runs(pages, cfg.needed(len(pages)), runs)
    return [covered_by(blocks, repeated, runs) for blocks in pages]


def main_text(blocks: list[str], inside: bool, repeated: np.ndarray, runs: Runs, cfg: Extraction) -> str:
    kept = blocks
    if len(repeated):
        own = covered_by(blocks, repeated, runs)
        if own.any():
            kept, at = [], 0
            for b in blocks:
                n = len(b.split(" "))
                part = own[at : at + n].mean()
                at += n + 1
                if part < (1.0 if inside else cfg.mostly):
                    kept.append(b)
            kept = kept or blocks
    return "\n\n".join(kept)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """A batch's arrays of whole numbers; null is empty."""
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def host_runs(hosted: DataFrame, cfg: Extraction) -> DataFrame:
    """``hosted`` (page_id, url, host, html): host, runs, the hashes of the substrings that are on enough of its pages. Hosts
    without any are left out."""
    hosts = stored(hosted.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_pages"),
        F.greatest(F.ceil(F.sum(F.octet_length("html")) / F.lit(cfg.shard_bytes)), F.lit(1)).cast("long").alias("shards")))
    shard = F.pmod(F.xxhash64("page_id", "url"), F.col("shards"))
    # one key, so that the pages are dealt by it and not by host alone
    dealt = hosted.join(hosts.where(F.col("host_pages") >= cfg.least_pages), "host").select(
        "host", "host_pages", "shards", F.concat_ws("/", "host", shard.cast("string")).alias("part"), "html").mapInArrow(
        _cut, "host string, host_pages long, shards long, part string, blocks array<string>")

    def candidates(group: pd.DataFrame) -> pd.DataFrame:
        host, n, shards = group["host"].iloc[0], int(group["host_pages"].iloc[0]), int(group["shards"].iloc[0])
        need = cfg.needed(n)
        found, pages = repeated_runs([list(b) for b in group["blocks"]], -(-need * len(group) // n), Runs(cfg.run))
        return pd.DataFrame({"host": host, "run": found, "pages": pages, "need": need, "shards": shards})

    found = stored(dealt.groupBy("part").applyInPandas(candidates, "host string, run long, pages long, need long, shards long"))

    def count(batches):
        runs = Runs(cfg.run)
        for batch in batches:
            seen: Counter = Counter()
            hosts, needs, sources = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for host, need, wanted, source in zip(hosts, needs, _lists(batch.column(2)), sources):
                hashes = np.unique(runs.of(page_blocks(source or "")[0]))
                seen.update((host, need, r) for r in hashes[np.isin(hashes, wanted)].tolist())
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.int64()), pa.array([seen[k] for k in keys], pa.int64())],
                names=["host", "need", "run", "pages"])

    wanted = found.where("shards > 1").groupBy("host", "need").agg(F.collect_set("run").alias("runs"))
    counted = hosted.join(wanted, "host").select("host", "need", "runs", "html").mapInArrow(
        count, "host string, need long, run long, pages long").groupBy("host", "need", "run").agg(F.sum("pages").alias("pages"))
    one_shard = found.where("shards = 1").select("host", "need", "run", "pages")      # counted on the whole host already
    return stored(counted.unionByName(one_shard).where("pages >= need").groupBy("host").agg(F.collect_set("run").alias("runs")))


def extract_main_text(pages: DataFrame, cfg: Extraction = Extraction()) -> DataFrame:
    """``pages`` (page_id, url, html): page_id, url, text."""
    hosted = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")

    def texts(batches):
        runs = Runs(cfg.run)
        for batch in batches:
            out = []
            for repeated, source in zip(_lists(batch.column(2)), batch.column(3).to_pylist()):
                blocks, marked = page_blocks(source or "")
                out.append(main_text(blocks, marked, repeated, runs, cfg))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())], names=["page_id", "url", "text"])

    return hosted.join(host_runs(hosted, cfg), "host", "left").select(
        "page_id", "url", F.coalesce("runs", F.array().cast("array<bigint>")).alias("runs"), "html").mapInArrow(
        texts, "page_id string, url string, text string").withColumn("page_id", F.col("page_id").cast("long"))
