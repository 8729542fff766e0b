"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags and texts.  Every text belongs to a block and
to a tag path (its open elements with their classes).  Per path, text length
over number of texts and punctuation are aggregated, smoothed in page order and
fused; paths at or above a threshold are content.  The article is the deepest
element that holds the content: all blocks below it are kept, except those of
elements that are never article text (menus, forms, notices, comments, ...).
Where no element is named an article, it is the deepest one around the content
that is no text block itself, or the one around with the heading; if that is the
page, its divisions without a content path are surroundings.
Elements left out by their names alone stay if they hold the article.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import shield, table, without

#: Elements whose content is never shown as article text.
DROPPED = frozenset("script style noscript template head title nav header footer aside form button select option textarea "
                    "input label fieldset iframe object embed svg canvas audio video map dialog menu".split())
#: Their content is not markup, up to the end tag.
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: An end tag that may be left out: what a new start tag closes.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
          "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "thead": ("tr", "td", "th"),
          "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
BLOCKS_END_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                         "h5 h6 header hr main menu nav ol pre section table ul".split())
SCOPES = frozenset("table td th body article section div ul ol dl".split())
#: Words of class, id and role that mark what surrounds an article.
SURROUND = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner "
                     "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
                     "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead "
                     "topbar toolbar comment comments discussion disqus reply replies respond related recommended share "
                     "sharing social widget login search skip copyright complementary contentinfo dialog alert disclaimer".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that hold the whole page or an article's own headings, whatever they are called.
KEPT = ARTICLE | frozenset("html body h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.S)
#: Words that say how something is arranged, not what it is; words of a state.
FRAMES = frozenset("area bar block bottom box buttons col column container content group holder icons inner item items left links "
                   "list outer panel right row section slot top unit wrap wrapper".split())
STATES = frozenset("has have no not with without is show hide open closed".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: an article is around them, not one of them.
TEXTUAL = HEADINGS | frozenset("p pre blockquote".split())
#: Elements of the whole page (the empty tag stands above all); its parts that may be surroundings.
PAGE, DIVISIONS = frozenset(("", "html", "body")), frozenset("div section table".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？¿¡]")
WORDS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
SMOOTH = (1, 2, 1)  # weights of neighbouring paths
THRESHOLD = 0.5  # of the standard deviation of the fused ratios


def _surrounds(token: str) -> bool:
    """A name of class, id or role says by its last word what an element is:
    sidebar, reader-comments, ad-slot; not has-sidebar, share-price."""
    words = WORDS.findall(token)
    while len(words) > 1 and words[-1] in FRAMES:
        words.pop()
    return bool(words) and words[-1] in SURROUND and not STATES.intersection(words)


def _marks(attrs: str) -> tuple[frozenset[str], bool, str, bool]:
    """(words of class, id and role; one of them names surroundings; class;
    hidden) of a start tag.  Of an attribute given twice the first counts."""
    if not attrs or attrs.isspace():
        return frozenset(), False, "", False
    words: set[str] = set()
    seen: set[str] = set()
    cls, around, hidden = "", False, False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "id", "role"):
            words.update(WORDS.findall(value))
            around = around or any(map(_surrounds, value.split()))
            cls = value if name == "class" else cls
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
    return frozenset(words), around, cls, hidden


class Page:
    """Texts of a page: block, innermost element and tag path of each.

    Elements are numbered; 0 stands above all.  Paths are numbered by (path of
    the parent, tag with its class), so that deep pages stay cheap."""

    def __init__(self, html: str):
        self.texts: list[tuple[int, int, int, str]] = []  # block, element, path, text
        self.parent, self.depth, self.path, self.tag = [0], [0], [0], [""]
        self.article = [0]  # outermost article element around (0: none)
        self.aside = [0]  # innermost element around that its name leaves out (0: none)
        self.paths: dict[tuple[int, str], int] = {}
        self._read(html)
        if any(self.aside):
            self._settle()

    def _open(self, above: int, tag: str, label: str, main: bool, aside: bool) -> int:
        e = len(self.parent)
        self.tag.append(tag)
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.path.append(self.paths.setdefault((self.path[above], label), len(self.paths) + 1))
        self.article.append(self.article[above] or (e if main else 0))
        self.aside.append(e if aside else self.aside[above])
        return e

    def _settle(self) -> None:
        """Leave out what elements named as surroundings hold.

        If no article is named outside of them, one that holds most of the page's
        text stays, or whose named articles are longer than all text outside."""
        tops = sorted(set(self.aside) - {0})
        held, named = dict.fromkeys([0, *tops], 0), dict.fromkeys([0, *tops], 0)
        for _, e, _, text in self.texts:
            n = len(text.strip())
            held[self.aside[e]] += n
            a = self.article[e]
            if a and self.aside[a] == self.aside[e]:
                named[self.aside[e]] += n
        outside, article = held[0], named[0]
        total = sum(held.values())
        for e in reversed(tops):  # inner ones come after those around
            held[self.aside[self.parent[e]]] += held[e]
            named[self.aside[self.parent[e]]] += named[e]
        stays = {0: True}
        for e in tops:
            stays[e] = stays[self.aside[self.parent[e]]] and not article and (2 * held[e] > total or named[e] > outside)
        self.texts = [t for t in self.texts if stays[self.aside[t[1]]]]

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # tag, element, dropped
        block = at = dropped = 0

        def close(k: int) -> None:
            nonlocal block, dropped
            if any(t not in INLINE for t, _, _ in stack[k:]):
                block += 1
            dropped -= sum(out for _, _, out in stack[k:])
            del stack[k:]

        def add(text: str) -> None:
            if text and not dropped:
                e = stack[-1][1] if stack else 0
                self.texts.append((block, e, self.path[e], unescape(text)))

        n = len(html)
        while at < n:
            m = TOKEN.search(html, at)
            if not m:
                add(html[at:])
                break
            add(html[at:m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m["cdata"] is not None:
                    add(m["cdata"].replace("&", "&amp;"))
                continue
            tag = tag.lower()
            if m["end"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break
                else:
                    if tag in ("p", "br"):
                        block += 1
                continue
            ends = ("p",) if tag in BLOCKS_END_P else CLOSES.get(tag, ())
            if ends:
                lowest = None
                for k in range(len(stack) - 1, -1, -1):
                    t = stack[k][0]
                    if t in ends:
                        lowest = k
                        if t == tag or t == "p":
                            break
                    elif t in SCOPES:
                        break
                if lowest is not None:
                    close(lowest)
            if tag not in INLINE:
                block += 1
            if tag in VOID:
                continue
            words, around, cls, hidden = _marks(m["attrs"])
            aside = tag == "form" or (tag not in KEPT and around)
            out = hidden or (tag in DROPPED and tag != "form")
            if m["attrs"].rstrip().endswith("/") and tag not in RAW:
                continue
            main = not out and not aside and (tag in ARTICLE or "main" in words or "article" in words)
            stack.append((tag, self._open(stack[-1][1] if stack else 0, tag, f"{tag}.{cls}" if cls else tag, main, aside), out))
            dropped += out
            if tag in RAW:
                stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else n
                close(len(stack) - 1)

    def common(self, elements: set[int]) -> int:
        """The deepest element around all."""
        out = -1
        for e in elements:
            if out < 0:
                out = e
            while out != e:
                if self.depth[out] >= self.depth[e]:
                    out = self.parent[out]
                else:
                    e = self.parent[e]
        return max(out, 0)

    def container(self, inside: set[int]) -> int:
        """The unnamed article around the elements of the content."""
        e = self.common(inside)
        while self.tag[e] in INLINE or self.tag[e] in TEXTUAL:
            e = self.parent[e]
        heads = {h for h, t in enumerate(self.tag) if t in HEADINGS}
        above = self.parent[e]
        if (self.tag[e] not in PAGE and self.tag[above] not in PAGE and not self.below({e}, heads)
                and any(self.parent[h] == above and h < e for h in heads)):
            return above
        return e

    def surroundings(self, root: int, inside: set[int]) -> set[int]:
        """Divisions right below the page that hold no content; none below another root."""
        if self.tag[root] not in PAGE:
            return set()
        holds = {0}
        for e in inside:
            while e not in holds:
                holds.add(e)
                e = self.parent[e]
        return {e for e, t in enumerate(self.tag) if t in DIVISIONS and self.tag[self.parent[e]] in PAGE and e not in holds}

    def below(self, roots: set[int], elements: set[int]) -> set[int]:
        """Those of ``elements`` inside one of ``roots``; each element on the way is asked once."""
        known = {0: False} | dict.fromkeys(roots, True)
        for e in elements:
            way = []
            while e not in known:
                way.append(e)
                e = self.parent[e]
            known.update(dict.fromkeys(way, known[e]))
        return {e for e in elements if known[e]}


def path_ratios(texts: list[tuple[int, int, int, str]]) -> dict[int, float]:
    """Fused, smoothed ratio of each tag path, paths in page order.

    Text ratio (code points over texts) times the root of the punctuation ratio
    (marks over texts, one at least): long, punctuated texts stand out."""
    length: dict[int, list[float]] = {}
    for _, _, path, text in texts:
        text = SPACES.sub(" ", text).strip()
        if text:
            s = length.setdefault(path, [0.0, 0.0, 0.0])
            s[0] += len(text)
            s[1] += len(PUNCTUATION.findall(text))
            s[2] += 1
    if not length:
        return {}
    fused = np.array([(a / n) * math.sqrt(1 + b / n) for a, b, n in length.values()])
    weight = np.convolve(np.ones(len(fused)), SMOOTH, "same") if len(fused) > 2 else None
    smooth = np.convolve(fused, SMOOTH, "same") / weight if weight is not None else fused
    return dict(zip(length, np.sqrt(fused * smooth)))  # the path itself, backed by its neighbours


def main_text(html: str | None) -> str:
    """The article of one page; null, empty and text-free pages give an empty text."""
    page = Page(html or "")
    texts = page.texts
    ratios = path_ratios(texts)
    if not ratios:
        return ""
    values = np.array(list(ratios.values()))
    limit = min(THRESHOLD * float(values.std()), float(values.max()))
    chosen = {p for p, v in ratios.items() if v >= limit}
    inside = {e for _, e, p, t in texts if p in chosen and t.strip()}
    # A page may name its article: content outside it is surroundings.
    roots = {page.article[e] for e in inside} - {0} or {page.article[e] for _, e, _, t in texts if t.strip()} - {0}
    if not roots:
        root, every = page.container(inside), {e for _, e, _, _ in texts}
        below = page.below({root}, every) - page.below(page.surroundings(root, inside), every)
    blocks: dict[int, list[str]] = {}
    for block, e, _, t in texts:
        if page.article[e] in roots if roots else e in below:
            blocks.setdefault(block, []).append(t)
    clean = (SPACES.sub(" ", "".join(ts)).strip() for ts in blocks.values())
    return " ".join(t for t in clean if t)


@F.pandas_udf(T.StringType())
def main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in pages:
        yield part.map(lambda h: main_text(h if isinstance(h, str) else None)).astype(object)


def extract(pages: DataFrame) -> DataFrame:
    """Every row with ``text`` and its code points ``n_chars``, from the whole ``html``.

    A map over rows: nothing is shuffled.  Null or empty html gives an empty
    text; repeated rows give equal texts; an empty table stays empty; extra
    columns stay, but those named text or n_chars are replaced."""
    safe, own = shield(without(pages, "text", "n_chars"), "html")
    out = safe.withColumn("__t", main_texts("html"))
    return out.select(*own, F.col("__t").alias("text"), F.char_length("__t").cast("long").alias("n_chars"))


def query(spark, sf_dir):
    """op4: the main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
