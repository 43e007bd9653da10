"""Main text of web pages by consensus host paths.

1. Each page is read into blocks of text, each under the path of its
   containers. A step of a path is a tag with its classes, generalised: digits
   and everything behind them are cut off. Containers are scored by the text
   below them, less its links, plus its punctuation.
2. Every page votes with the scores of its containers; votes are summed per
   host and path in Spark (combined before the shuffle, so a host of any size
   is no hot key) and the best path of each host wins.
3. The pages are read again and the blocks under the host's winning path are
   taken; a page without that path falls back to its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, comments of
readers, scripts and styles are never part of a container's text. Element names
say so for certain. A word of a class or id, or a form, says so only of what is
not around the article: elements that hold the page's largest ``article`` or
``main`` (else its first ``h1``) keep their text, so does a form with half of the
page, and where nothing else would be left such words count for nothing.

A page is read in one pass and every element, path and piece of text is handled
a fixed number of times, so time is linear in its length however it is nested.
"""

from __future__ import annotations

import hashlib
import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import id_text, keep, text_of, with_id

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
SKIP = frozenset(
    "head script style noscript template iframe object svg math canvas audio video nav footer aside button "
    "select option textarea input label dialog menu title".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
CLOSES_P = BLOCK - {"html", "body"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("article main section div body td center blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# words of class and id names that mark what is not the article
AWAY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus feedback footer gdpr header hidden masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted "
    "promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription tags toolbar widget widgets".split())

# words that make a class tell of the layout: has-sidebar, no-comments
LAYOUT = frozenset("has no with without layout".split())

_tag = re.compile(r"[a-zA-Z][^\s/>]*")
_delimiter = re.compile(r"=\s*([\"'])|>")
_attr = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_name_words = re.compile(r"[A-Za-z][a-z]*")
_digits = re.compile(r"[\d].*$")
_space = re.compile(r"\s+")
_stops = re.compile(r"[.,;:!?]")
_raw_end = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _attr.finditer(raw)} if raw.strip() else {}


def _step(tag: str, attrs: dict[str, str]) -> str:
    names = sorted({_digits.sub("", c).rstrip("-_").lower() for c in attrs.get("class", "").split()} - {""})
    return ".".join([tag, *names])


def _is_away(tag: str, attrs: dict[str, str]) -> bool:
    """Never article text, by element or attribute."""
    return (tag in SKIP or tag == "header" or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            or (tag != "form" and attrs.get("role", "").lower() in ROLES)
            or re.search(r"display\s*:\s*none", attrs.get("style", "")) is not None)


def _sounds_away(attrs: dict[str, str]) -> bool:
    """A class or id names something that is not the article."""
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        words = {w.lower() for w in _name_words.findall(name)}
        if words & AWAY and not words & LAYOUT:
            return True
    return False


class Page:
    """A page as elements, container paths and blocks of text.

    Elements and paths are numbered with their parents before them, so what holds for all
    below is summed in one pass backwards and what is inherited in one forwards.
    """

    def __init__(self, source: str):
        # of elements; 0 is the page itself
        self.tag, self.up, self.path, self.link = [""], [-1], [0], [False]
        self.hard, self.soft = [False], [False]
        # of paths; 0 is the empty one
        self.above, self.step, self.depth, self.key = [-1], [""], [0], [""]
        self._numbers: dict[tuple[int, str], int] = {}
        self.pieces: list[list[tuple[int, str]]] = []  # of each block: (element, text)
        self._read(source)
        self.blocks = self._blocks()  # (path, text, characters in links), in order

    # -- reading ----------------------------------------------------------
    def _path(self, parent: int, step: str) -> int:
        n = self._numbers.get((parent, step))
        if n is None:
            n = self._numbers[parent, step] = len(self.above)
            self.above.append(parent)
            self.step.append(step)
            self.depth.append(self.depth[parent] + 1)
            self.key.append(hashlib.blake2b(f"{self.key[parent]}>{step}".encode("utf-8", "replace"), digest_size=12).hexdigest())
        return n

    def _element(self, tag: str, attrs: dict[str, str], up: int) -> int:
        self.tag.append(tag)
        self.up.append(up)
        self.link.append(self.link[up] or tag == "a")
        self.path.append(self._path(self.path[up], _step(tag, attrs)) if tag in CONTAINERS else self.path[up])
        self.hard.append(_is_away(tag, attrs))
        plain = tag in ("html", "body") or tag in HEADINGS
        self.soft.append(not plain and (tag == "form" or _sounds_away(attrs)))
        return len(self.tag) - 1

    def _read(self, page: str) -> None:
        stack: list[int] = [0]  # open elements
        where: dict[str, list[int]] = {}  # places in the stack by tag
        walls: list[int] = []  # places of block elements
        block: list[tuple[int, str]] = []

        def flush():
            nonlocal block
            if block:
                self.pieces.append(block)
                block = []

        def add(raw: str):
            if raw:
                block.append((stack[-1], raw))

        def close(tag: str, behind: tuple = ()):
            """Close the innermost ``tag``, unless a block (or one of ``behind``) is open inside it."""
            at = where.get(tag)
            if not at:
                return
            i = at[-1]
            if behind == "block" and walls and walls[-1] > i:
                return
            if behind and behind != "block" and max((where[t][-1] for t in behind if where.get(t)), default=0) > i:
                return
            if walls and walls[-1] >= i:
                flush()
            while len(stack) > i:
                t = self.tag[stack.pop()]
                where[t].pop()
                if t in BLOCK:
                    walls.pop()

        def end_of(i: int) -> int:
            """The place of the ``>`` that ends the tag which begins before i, or -1."""
            while True:
                m = _delimiter.search(page, i)
                if not m:
                    return -1
                if not m[1]:
                    return m.start()
                j = page.find(m[1], m.end())
                if j < 0:  # a quote that never ends: the tag ends where it would without it
                    return page.find(">", m.end())
                i = j + 1

        at, n = 0, len(page)
        while at < n:
            i = page.find("<", at)
            if i < 0:
                add(page[at:])
                break
            add(page[at:i])
            c = page[i + 1:i + 2]
            if page.startswith("<!--", i):
                e = page.find("-->", i + 4)
                at = n if e < 0 else e + 3
                continue
            if c in ("!", "?"):
                e = page.find(">", i)
                if e < 0:
                    break  # no tag can end any more
                at = e + 1
                continue
            ends = c == "/"
            m = _tag.match(page, i + 1 + ends)
            if not m:
                add("<")  # a plain character
                at = i + 1
                if ends:  # </ and no name: nothing that is shown
                    block.pop()
                    e = page.find(">", i)
                    at = n if e < 0 else e + 1
                continue
            e = end_of(m.end())
            if e < 0:
                break  # a tag that the page breaks off in
            tag, raw = m[0].lower(), page[m.end():e]
            at = e + 1
            if ends:
                if tag == "br":
                    add(" ")
                elif tag not in VOID:
                    close(tag, () if tag in BLOCK else "block")
                continue
            if tag in RAW and not raw.rstrip().endswith("/"):
                found = _raw_end[tag].search(page, at)
                at = found.end() if found else n
                continue
            if tag in ("br", "wbr"):
                add(" " if tag == "br" else "")
                continue
            if tag in CLOSES_P:
                close("p", "block")
            for other in SIBLINGS.get(tag, ()):
                close(other, ("ul", "ol", "dl", "table", "select"))
            if tag in BLOCK:
                flush()
            if tag in VOID:
                continue
            where.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                walls.append(len(stack))
            stack.append(self._element(tag, _attributes(raw), stack[-1]))
        flush()

    # -- what is away -------------------------------------------------------
    def _inherited(self, soft: list[bool]) -> list[bool]:
        """Which elements are away: by themselves or by what is around them."""
        n = len(self.tag)
        away, heading_ok, inside = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            u, tag = self.up[i], self.tag[i]
            # a heading in the article's own header is part of the article
            away[i] = self.hard[i] or soft[i] or (away[u] and not (tag in HEADINGS and heading_ok[u]))
            heading_ok[i] = heading_ok[u] or (tag == "header" and inside[u] and not away[u])
            inside[i] = inside[u] or tag in ("article", "main")
        return away

    def _around_article(self, hard: list[bool], size: list[int]) -> set[int]:
        """The elements that hold the article, as far as element names tell it."""
        own = [i for i, t in enumerate(self.tag) if t in ("article", "main") and not hard[i] and not self.soft[i]]
        own = own or [i for i, t in enumerate(self.tag) if t == "h1" and not hard[i]][:1]
        i = max(own, key=lambda x: (size[x], -x), default=0)
        out = set()
        while i > 0:
            out.add(i)
            i = self.up[i]
        return out

    def _blocks(self) -> list[tuple[int, str, int]]:
        hard = self._inherited([False] * len(self.tag))
        size = [0] * len(self.tag)
        for block in self.pieces:
            for i, raw in block:
                size[i] += 0 if hard[i] else len(raw.strip())
        for i in range(len(size) - 1, 0, -1):
            size[self.up[i]] += size[i]
        around = self._around_article(hard, size)
        soft = [s and i not in around and not (self.tag[i] == "form" and 2 * size[i] >= size[0])
                for i, s in enumerate(self.soft)]
        return self._texts(self._inherited(soft)) or self._texts(hard)

    def _texts(self, away: list[bool]) -> list[tuple[int, str, int]]:
        out = []
        for block in self.pieces:
            kept = [(i, html.unescape(raw)) for i, raw in block if not away[i]]
            text = _space.sub(" ", "".join(t for _, t in kept)).strip()
            if text:
                out.append((self.path[kept[0][0]], text, sum(len(t.strip()) for i, t in kept if self.link[i])))
        return out

    # -- containers -----------------------------------------------------------
    def scores(self) -> list[float]:
        """Score of every path as a container: text without links and punctuation below it.

        A container counts a block fully for its own and nine tenths for each level in
        between, so the innermost one that holds the whole article wins.
        """
        score = [0.0] * len(self.above)
        for path, t, link in self.blocks:
            score[path] += max(0, len(t) - 2 * link) + 5 * len(_stops.findall(t))
        for i in range(len(score) - 1, 0, -1):
            score[self.above[i]] += 0.9 * score[i]
        return score

    def name(self, path: int) -> str:
        """A path as its digest and its last step."""
        return f"{self.key[path]}:{self.step[path]}"

    def votes(self) -> list[tuple[int, float]]:
        """(path, score) of all containers above text; the whole body is a last resort."""
        bonus = {"article": 1.5, "main": 1.5, "body": 0.75}
        score = self.scores()
        held = [False] * len(score)
        for path, _, _ in self.blocks:
            held[path] = True
        for i in range(len(held) - 1, 0, -1):
            held[self.above[i]] |= held[i]
        return [(i, score[i] * bonus.get(self.step[i].split(".")[0], 1.0)) for i in range(1, len(score)) if held[i]]

    def best(self) -> str | None:
        return max(((v, -self.depth[i], self.name(i)) for i, v in self.votes()), default=(0, 0, None))[2]

    def under(self, name: str | None) -> list[str]:
        """Texts of the blocks under a container."""
        if name is None:
            return []
        key = name.split(":", 1)[0]
        ok = [False] * len(self.key)
        for i in range(1, len(ok)):
            ok[i] = ok[self.above[i]] or self.key[i] == key
        return [t for path, t, _ in self.blocks if ok[path]]


def extract(source: str, winner: str | None) -> str:
    """Blocks under the winning path, or under the page's own best container, or all where there is none."""
    page = Page(source)
    return "\n".join(page.under(winner) or page.under(page.best()) or [t for _, t, _ in page.blocks])


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")),
                                               r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


BROADCAST_HOSTS = 100_000


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the container path with the most votes on each host."""

    def run(batches):
        for b in batches:
            out = []
            for host, source in zip(b["host"], b["html"]):
                page = Page(source)
                votes = page.votes()
                total = sum(page.scores()[1:]) or 1.0
                out += [(host, page.name(i), page.depth[i], v / total) for i, v in votes]
            # combined per batch: a host's pages share most paths
            df = pd.DataFrame(out, columns=["host", "path", "depth", "votes"])
            yield df.groupby(["host", "path", "depth"], as_index=False)["votes"].sum()

    votes = (pages.select(host_of(url_col).alias("host"), text_of(html_col).alias("html"))
             .mapInPandas(run, "host string, path string, depth int, votes double")
             .groupBy("host", "path", "depth").agg(F.round(F.sum("votes"), 6).alias("votes")))
    return votes.groupBy("host").agg(F.max(F.struct("votes", (-F.col("depth")).alias("n"), "path")).alias("best")) \
        .select("host", F.col("best.path").alias("path"))


def main_text(pages: DataFrame, paths: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per input row.

    Null or empty html gives an empty text. Pages without a host (null or odd
    url) vote together under the empty host. Repeated rows give equal rows. An
    empty table gives an empty result. ``paths`` is broadcast up to
    BROADCAST_HOSTS hosts and joined by shuffle beyond.
    """
    paths = keep(paths)  # counted, then joined
    few = paths.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    src = pages.select(id_text(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       host_of(url_col).alias("host"), text_of(html_col).alias("html"))
    src = src.join(F.broadcast(paths) if few else paths, "host", "left").select("page_id", "url", "path", "html")

    def run(batches):
        for b in batches:
            text = [extract(h, p if isinstance(p, str) else None) for h, p in zip(b["html"], b["path"])]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text,
                                "n_chars": [len(t) for t in text]})

    return with_id(src.mapInPandas(run, "page_id string, url string, text string, n_chars long"), "page_id")
