"""Main text of web pages by site style trees.

The pages of one host are merged into a style tree: elements with the same path of names
(tag, class, id) are one node, and a node's distinct child sequences are its styles. A node is
important if its styles differ between pages (presentation) and if what stands below it
differs between pages (content); both are entropies over the pages that have the node:

    presentation = - sum of p(style) log p(style) / log pages
    content      = 1 - mean over its texts of log(pages with the text) / log pages
    importance   = (1 - g^styles) presentation + g^styles content,   g = 0.9

A node on one page has importance 1. Texts count for the element that holds them and for all
elements around it, so a node's content is that of its whole branch. Branches below
``THRESHOLD`` are removed from each page.

Names decide what entropies cannot see: branches whose tag, role, class or id says navigation,
footer, advert, form, comment and so on are always removed, also where their words differ on every
page; ``article`` and ``main`` are never removed, nor is what stands around them, and where a page
has them, the text is theirs. Inside them the entropies remove a box (a ``div``, a list, a table and
so on, no heading or paragraph) that stands with the same words on nearly every page of a host:
importance below ``SURE`` on at least ``MANY`` pages, unless the article repeats as well. If a page
would lose all its text to entropies alone, they are not applied to it.

Text rules: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by one space in page order. Nothing is cut or capped.

Defined results for unusual input: null and empty html give the empty text; a null or
malformed url has the empty host; rows are kept one for one; an empty table gives no rows.
Columns other than id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, per_batch

DECAY = 0.9
THRESHOLD = 0.35
SURE, MANY = 0.05, 8
SENT_NODES = 2_000_000  # removed nodes that may be sent to every task, as sorted numbers: 16 MB
ROWS = 200_000  # statistics that leave a task together

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("ul ol dl table select html body article main section div".split())
NOISE_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe svg "
    "canvas object dialog menu".split()
)
MAIN_TAGS = frozenset(("article", "main"))
BOXES = frozenset("div section ul ol dl table details fieldset figure center".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment "
    "comments consent contentinfo cookie cookies copyright discussion disqus footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion reader-comments related respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget "
    "complementary".split()
)
TITLE_PARTS = frozenset("article entry post content story".split())
NEGATIONS = frozenset("has no with without".split())


def noise_name(name: str) -> bool:
    """Whether a class or id says that its element is no main content: as a whole, by its
    first part (``ad-slot``) or by its last (``site-footer``), but not ``has-sidebar`` and
    not the title block ``entry-header``."""
    name = name.lower()
    if name in NOISE_NAMES:
        return True
    parts = re.split(r"[-_]+", name)
    if len(parts) < 2 or parts[0] in NEGATIONS:
        return False
    if parts[0] in TITLE_PARTS and parts[-1] == "header":
        return False
    return parts[0] in NOISE_NAMES or parts[-1] in NOISE_NAMES


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


class Page:
    """Elements of one page in document order, as parallel lists, and its runs of text."""

    def __init__(self, html: str, host: str):
        self.parent, self.name, self.noise, self.main = [-1], ["#" + host], [False], [False]
        self.key = [xxhash.xxh3_64_intdigest(host.encode()) >> 1]
        self.inside = [False]  # whether it or one around it is an article or main
        self.frame = [True]  # what every page is made of: never a branch to remove
        self.box = [False]
        self.runs: list[tuple[int, str]] = []  # element, text; "" separates blocks
        self._parse(html)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        named = {}
        for match in ATTRIBUTE.finditer(attributes) if attributes else ():
            named[match[1].lower()] = match[2] or match[3] or match[4] or ""
        classes = [c for v in (named.get("class"), named.get("id"), named.get("role")) if v
                   for c in v.split()]
        main = tag in MAIN_TAGS or named.get("role", "").lower() == "main"
        label = tag + "".join("." + re.sub(r"\d+", "0", c) for c in classes)
        body = tag in ("html", "body") or main
        self.parent.append(parent)
        self.name.append(label)
        self.main.append(main)
        self.inside.append(main or self.inside[parent])
        self.frame.append(tag in ("html", "body"))
        self.box.append(tag in BOXES and not main)
        self.noise.append(
            tag in NOISE_TAGS
            or (tag == "header" and not self.inside[parent])
            or (any(map(noise_name, classes)) and (not body or tag == "article"))
        )
        self.key.append(xxhash.xxh3_64_intdigest(label, self.key[parent]) >> 1)
        return len(self.parent) - 1

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        at, end = 0, len(html)
        while at < end:
            match = TOKEN.search(html, at)
            text = html[at : match.start() if match else end]
            if text:
                self.runs.append((stack[-1][1], text))
            if not match:
                break
            at = match.end()
            tag = (match[2] or "").lower()
            if not tag:
                continue
            if match[1]:
                self._close(stack, tag)
                continue
            if tag in CLOSES_P:
                self._close(stack, "p")
            for other in SAME_CLOSES.get(tag, ()):
                self._close(stack, other, BARRIER)
            if tag not in INLINE:
                self.runs.append((stack[-1][1], ""))
            if tag in VOID:
                continue
            element = self._open(stack[-1][1], tag, match[3])
            if tag in RAW:  # its content is text up to its own end tag
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                if tag not in NOISE_TAGS and tag != "title":
                    self.runs.append((element, html[at : stop.start() if stop else end]))
                at = stop.end() if stop else end
            else:
                stack.append((tag, element))

    def _close(self, stack: list[tuple[str, int]], tag: str, barrier: frozenset = frozenset()) -> None:
        """Leave the innermost open ``tag``, if there is one inside the barrier."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                del stack[depth:]
                if tag not in INLINE:
                    self.runs.append((stack[-1][1], ""))
                return
            if stack[depth][0] in barrier:
                return

    def _dropped(self, low, sure) -> list[bool]:
        """Per element, whether it or one around it is removed."""
        noise: list[bool] = []
        for i, parent in enumerate(self.parent):
            noise.append((parent >= 0 and noise[parent]) or self.noise[i])
        around = [False] * len(noise)
        for i, main in enumerate(self.main):
            if main and not noise[i]:
                at = self.parent[i]
                while at >= 0 and not around[at]:
                    around[at] = True
                    at = self.parent[at]
        out: list[bool] = []
        own: list[bool] = []  # whether the article around it differs between pages
        for i, parent in enumerate(self.parent):
            own.append(self.key[i] not in low if self.main[i] else parent >= 0 and own[parent])
            kept = self.inside[i] or around[i] or self.frame[i]
            low_box = self.box[i] and own[i] and self.key[i] in sure
            out.append(
                (parent >= 0 and out[parent]) or noise[i] or (not kept and self.key[i] in low)
                or (self.inside[i] and low_box)
            )
        return out

    def _text(self, kept) -> str:
        parts = [entities.unescape(text) if text else "\n" for at, text in self.runs
                 if not text or kept(at)]
        return " ".join("".join(parts).split())

    def text(self, low, sure=frozenset()) -> str:
        """Main text without noise, without the branches whose key is in ``low`` and, inside the
        article, without the boxes whose key is in ``sure``."""
        dropped = self._dropped(low, sure)
        inside = []
        for i, parent in enumerate(self.parent):
            inside.append(self.main[i] and not dropped[i] or parent >= 0 and inside[parent])
        if any(inside):
            found = self._text(lambda at: inside[at] and not dropped[at])
            return found if found or not sure else self.text(low)
        found = self._text(lambda at: not dropped[at])
        if found or not low:
            return found
        plain = self._dropped((), ())
        return self._text(lambda at: not plain[at])

    def statistics(self) -> Iterator[tuple[int, int, int]]:
        """Distinct rows (node, kind, value): kind 1 the style of a node, kind 0 a text below it."""
        children: dict[int, list[str]] = {}
        for i in range(1, len(self.parent)):
            names = children.setdefault(self.parent[i], [])
            if not names or names[-1] != self.name[i]:  # a run of equal elements counts as one
                names.append(self.name[i])
        yield from {
            (self.key[i], 1, xxhash.xxh3_64_intdigest("|".join(children.get(i, ()))) >> 1)
            for i in range(1, len(self.parent))
        }
        places: dict[int, list[int]] = {}
        for at, text in self.runs:
            words = " ".join(text.split())
            if words:
                places.setdefault(xxhash.xxh3_64_intdigest(words) >> 1, []).append(at)
        for value, holders in places.items():  # one text at a time: pages may be deep
            met: set[int] = set()
            for at in holders:
                while at > 0 and at not in met:
                    met.add(at)
                    at = self.parent[at]
            for node in {self.key[at] for at in met}:
                yield node, 0, value


def _statistics(batches):
    names = ("node", "kind", "value")

    def rows(batch):
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for url, html in zip(part.column("url").to_pylist(), part.column("html").to_pylist()):
                if html:
                    yield from Page(html, host_of(url)).statistics()

    for batch in batches:
        found = rows(batch)
        while some := list(islice(found, ROWS)):
            table = np.array(some, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T], names=names)


def importance(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``node, pages, importance`` of every node of every host's style tree."""
    counts = (
        pages.select(F.col(url).alias("url"), F.col(html).alias("html"))
        .mapInArrow(_statistics, "node bigint, kind bigint, value bigint")
        .groupBy("node", "kind", "value").agg(F.count("*").alias("n"))
    )
    is_style = F.col("kind") == 1
    sums = counts.groupBy("node").agg(
        F.sum(F.when(is_style, F.col("n"))).alias("pages"), F.count_if(is_style).alias("styles"),
        F.sum(F.when(is_style, F.col("n") * F.log("n"))).alias("style_sum"),
        F.avg(F.when(~is_style, F.log("n"))).alias("text_mean"),
    )
    log_pages = F.log(F.col("pages").cast("double"))
    # - sum p log p = log pages - (sum n log n) / pages
    presentation = 1 - F.col("style_sum") / F.col("pages") / log_pages
    content = 1 - F.coalesce(F.col("text_mean"), F.lit(0.0)) / log_pages
    fade = F.pow(F.lit(DECAY), F.col("styles"))
    return sums.select(
        "node", "pages",
        F.when(F.col("pages") > 1, (1 - fade) * presentation + fade * content)
        .otherwise(F.lit(1.0)).alias("importance"),
    )


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            threshold: float = THRESHOLD, sent_nodes: int = SENT_NODES) -> DataFrame:
    """``key, url, text`` for every row."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "site-style")
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    judged = importance(rows).where(F.col("importance") < threshold)
    sure = (F.col("importance") < min(SURE, threshold)) & (F.col("pages") >= MANY)
    low = scratch.write("low", judged.select("node", sure.alias("sure")))
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    if low.count() <= sent_nodes:
        table = low.orderBy("node").toArrow()
        sent = spark.sparkContext.broadcast(
            (table.column("node").to_numpy(), table.column("sure").to_numpy(zero_copy_only=False))
        )

        def work(cols):
            nodes, certain = sent.value
            texts = []
            for url, html in zip(cols["url"], cols["html"]):
                if not html:
                    texts.append("")
                    continue
                page = Page(html, host_of(url))
                keys = np.array(page.key, np.int64)
                at = np.minimum(np.searchsorted(nodes, keys), max(0, len(nodes) - 1))
                hit = nodes[at] == keys if len(nodes) else np.zeros(len(keys), bool)
                found = set(keys[hit].tolist())
                texts.append(page.text(found, set(keys[hit][certain[at[hit]]].tolist()) if found else found))
            return {"id": cols["id"], "url": cols["url"], "text": texts}

        found = rows
    else:  # too many for every task: each page gets the removed nodes that it has
        def nodes(cols):
            keys = [sorted(set(Page(h or "", host_of(u)).key)) for u, h in zip(cols["url"], cols["html"])]
            return {"id": cols["id"], "url": cols["url"], "nodes": keys}

        listed = rows.mapInArrow(
            per_batch(nodes, pa.schema([("id", pa.int64()), ("url", pa.string()),
                                        ("nodes", pa.list_(pa.int64()))])),
            "id bigint, url string, nodes array<bigint>",
        ).select("id", "url", F.explode("nodes").alias("node"))
        own = listed.join(low, "node").groupBy("id", "url").agg(
            F.collect_set("node").alias("low"), F.collect_set(F.when(F.col("sure"), F.col("node"))).alias("sure")
        ).select(F.col("id").alias("own_id"), F.col("url").alias("own_url"), "low", "sure")
        found = rows.join(
            own, F.col("id").eqNullSafe(F.col("own_id")) & F.col("url").eqNullSafe(F.col("own_url")),
            "left",
        ).select("id", "url", "html", "low", "sure")

        def work(cols):
            texts = [Page(h, host_of(u)).text(frozenset(low or ()), frozenset(sure or ())) if h else ""
                     for u, h, low, sure in zip(cols["url"], cols["html"], cols["low"], cols["sure"])]
            return {"id": cols["id"], "url": cols["url"], "text": texts}

    texts = found.mapInArrow(per_batch(work, schema), "id bigint, url string, text string")
    return texts.withColumnsRenamed({"id": key, "url": url})
