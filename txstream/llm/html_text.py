"""HTML extraction by maximum-scoring subsequence.

A page is a sequence of words and tags.  A word scores +1, a tag its weight, which is
zero or negative (zero inside an ``<article>`` or ``<main>``: one region is not cut); one
linear scan finds the contiguous stretch of highest score, and its
words outside boilerplate elements (by name, role or class) are the text.  A class or id
names boilerplate by its whole token or the token's first or last part (``cookie-bar``, ``site-footer``),
not by what a state tells (``no-sidebar``, ``with-header``); tokens that the labelled pages show
around their texts, or only beside them, are weighed by that instead.  An element that holds the
page's articles, or most of its words, is its frame and no boilerplate, whatever it is called;
comments, adverts, notices and the like are never a frame by their words alone.  A boilerplate
element scores zero, whatever its length, where it stands within one text: the innermost
element with text on both sides of it is, or lies in, an ``<article>`` or ``<main>``, or
holds these texts without containers, in like containers, or (below body) one of them
without a container.  Elsewhere, between the parts of a page, its words and tags score
``IN_BOILERPLATE`` each.  Tag weights start from ``PRIOR`` and
are learned on labelled pages -- pages whose one ``<article>`` or ``<main>`` tells the
region -- by a structured perceptron: where the best stretch misses words of the region
the tags in between get lighter, where it takes foreign words they get heavier.

Character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined by a blank line in page order; nothing else is dropped.

Defined results: a null or empty page, or one without words outside boilerplate, gives
the empty text; broken markup (unclosed elements, a page cut inside a tag, comment or
reference) is read to its end; repeated pages are extracted alike; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements whose content is no text, boilerplate elements and class words,
# and elements that stand inside a line.
RAW = {"script", "style", "noscript", "template", "svg", "math", "title", "textarea", "iframe",
       "object", "canvas", "head"}
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"}
CLASS_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo",
               "promotion", "banner", "cookie", "cookies", "consent", "notice", "notification",
               "popup", "modal", "comment", "comments", "reply", "replies", "disqus", "sidebar",
               "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
               "masthead", "topbar", "share", "sharing", "social", "related", "recommended",
               "newsletter", "subscribe", "signup", "login", "search", "pagination", "pager",
               "widget", "toolbar", "copyright", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "menu", "alert", "alertdialog"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"br", "hr", "img", "input", "link", "meta", "wbr", "source", "area", "base", "col", "embed"}
REGIONS = {"article", "main"}
CONTAINERS = REGIONS | {"div", "section", "header", "table", "td", "center"}
PRIOR = {"div": -1.0, "section": -0.5, "table": -0.5, "a": -0.3, "ul": -0.2, "ol": -0.2, "li": -0.1, "p": 0.0,
         "h1": 0.0, "h2": 0.0, "h3": 0.0, "h4": 0.0, "blockquote": 0.0, "pre": 0.0, "br": 0.0,
         "tr": -0.05, "td": -0.05, "th": -0.05, "tbody": -0.05, "thead": -0.05, "dl": -0.2, "dt": -0.05, "dd": -0.05}
# First or last parts of class tokens that tell a page's state, not an element's kind, and class
# words of what is never a page's frame.
STATES = {"no", "not", "without", "with", "has", "have", "hide", "hidden", "show", "is", "js", "enable", "enabled",
          "disable", "disabled"}
NO_FRAME = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "cookie",
            "cookies", "consent", "notice", "popup", "comment", "comments", "reply", "replies", "disqus", "breadcrumb",
            "breadcrumbs", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup",
            "pagination", "pager", "copyright"}
FRAMES = {"form", "fieldset", "dialog", "header"}     # boilerplate names that sites put around whole pages
SEEN = 5             # labelled pages that must show a class token before it is weighed
IN_BOILERPLATE = -0.1      # between parts; such words are dropped anyway, a region may reach over them

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"                       # comment
    r"|<[!?][^>]*(?:>|\Z)"                                # doctype, processing instruction
    # tag: a quote opens a value only after the equals sign
    r"|</?[a-zA-Z][^\s/>]*(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*?(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PART = re.compile(r"[^a-z0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


def attributes(tag: str, name: str) -> dict[str, str]:
    """class, id and role of an opening tag (the first of each, as it is written)."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag, 1 + len(name)):
        key = m[1].lower()
        if key in ("class", "id", "role"):
            out.setdefault(key, m[2] or m[3] or m[4] or "")
    return out


def class_tokens(found: dict[str, str]) -> list[str]:
    """Tokens of class and id in lower case, words in camel case apart."""
    both = f"{found.get('class', '')} {found.get('id', '')}"
    return [_CAMEL.sub("-", t).lower() for t in both.split()]


def class_word(token: str) -> str | None:
    """The class word that a token is, or that its first or last part is."""
    parts = [p for p in _PART.split(token) if p]
    if not parts or (len(parts) > 1 and (parts[0] in STATES or parts[-1] in STATES)):
        return None
    return next((p for p in (parts[-1], parts[0]) if p in CLASS_WORDS), None)


def _flag(name: str, found: dict[str, str], inside_region: bool, first_region: bool,
          weights: dict[str, float]) -> str:
    """Why the opening tag begins a boilerplate element: "name", "frame" (a name or word that may
    also be around a text), "word" (one that may not), or "".  The page's first article or main
    never does."""
    if name in BOILERPLATE or (name == "header" and not inside_region):
        return "frame" if name in FRAMES else "name"
    if first_region or name in ("html", "body"):
        return ""
    if found.get("role", "").strip().lower() in ROLES:
        return "frame"
    best = ""
    for token in class_tokens(found):
        weight = weights.get("." + token)
        if weight is not None:
            word = (class_word(token) or "learned") if weight < 0 else None
        else:
            word = class_word(token)
        if word and not (inside_region and word == "header"):
            if word in NO_FRAME:
                return "word"
            best = "frame"
    return best


class Page:
    """Tokens of a page: texts (str) and tags, with flags for boilerplate and the region."""

    def __init__(self, source: str, weights: dict[str, float] | None = None):
        self.kind: list[str] = []          # "" for a text, else the tag's name
        self.text: list[str] = []
        self.opens: list[bool] = []
        self.bad: list[bool] = []
        self.found: list[dict[str, str]] = []       # attributes that matter
        flags: list[str] = []
        weights = weights or {}
        at, depth_region, regions = 0, 0, 0
        while at < len(source):
            m = _TOKEN.search(source, at)
            end = m.start() if m else len(source)
            if end > at:
                self._add("", source[at:end], False)
                flags.append("")
            if not m:
                break
            at = m.end()
            name = _NAME.match(m[0])
            if not name:
                continue
            written, closing = name[1], m[0][1] == "/"
            name = written.lower()
            if name in REGIONS:
                depth_region = max(0, depth_region + (-1 if closing else 1))
                regions += not closing
            found = attributes(m[0], written) if not closing and "=" in m[0] else {}
            self._add(name, m[0], not closing, found)
            flags.append("" if closing or name in VOID else _flag(
                name, found, depth_region > 0, name in REGIONS and regions == 1, weights))
            if not closing and name in RAW and not m[0].endswith("/>"):
                stop = _RAW_END[name].search(source, at) if name != "head" else None
                if name != "head":
                    at = stop.start() if stop else len(source)
        self._mark(flags)
        self._bridge()

    def _add(self, kind: str, text: str, opens: bool, found: dict[str, str] | None = None) -> None:
        self.kind.append(kind)
        self.text.append(text)
        self.opens.append(opens)
        self.found.append(found or {})

    def _mark(self, flags: list[str]) -> None:
        """Spans of boilerplate elements and of head; unclosed ones end at the next region.

        ``inside`` marks what stands in a region that is no boilerplate itself.
        """
        n = len(self.kind)
        self.bad = [False] * n
        ends = self._ends()
        stops: list[int | None] = [None] * n
        for i in range(n):
            if flags[i] or (self.kind[i] == "head" and self.opens[i]):
                stop = ends.get(i)
                stops[i] = stop if stop is not None else next(
                    (j for j in range(i + 1, n) if self.opens[j] and self.kind[j] in
                     ("article", "main", "h1", "body")), n)
        regions = [(i, ends.get(i, n)) for i in range(n)
                   if self.kind[i] in REGIONS and self.opens[i] and not flags[i]]
        regions = [r for k, r in enumerate(regions) if not any(a < r[0] < z for a, z in regions[:k])]
        count = [0 if k else len(t.split()) for k, t in zip(self.kind, self.text, strict=True)]
        for i in range(n):                         # words that are no text in any case
            if flags[i] in ("name", "word") and not (regions and regions[0][0] > i and regions[-1][1] <= stops[i]):
                count[i:stops[i]] = [0] * (stops[i] - i)
        words = list(accumulate(count, initial=0))
        scope = sum(words[z] - words[a] for a, z in regions)

        def frame(i: int) -> bool:
            """The flagged element is around the page's text."""
            a, z = i, stops[i]
            if regions:
                held = sum(words[min(z, q)] - words[max(a, p)] for p, q in regions if min(z, q) > max(a, p))
                if regions[0][0] > a and regions[-1][1] <= z:       # all articles of the page
                    return held > 0 and 2 * (words[z] - words[a]) > words[n]
                return flags[i] == "frame" and 2 * held > scope
            return flags[i] == "frame" and 4 * (words[z] - words[a]) > 3 * words[n]

        self.spans: list[tuple[int, int]] = []     # boilerplate elements with their end tags
        until = -1
        for i in range(n):
            if i < until:
                self.bad[i] = True
            elif stops[i] is not None and not (flags[i] and frame(i)):
                until = stops[i]
                self.bad[i] = True
                self.spans.append((i, until + (i in ends)))
        self.inside = [False] * n
        for a, z in regions:
            if not self.bad[a]:
                self.inside[a + 1:z] = [True] * (z - a - 1)

    def _bridge(self) -> None:
        """Marks the tokens of boilerplate elements that stand within one text."""
        n = len(self.kind)
        self.free = [False] * n
        is_text = [not k and not bad and not t.isspace()
                   for k, t, bad in zip(self.kind, self.text, self.bad, strict=True)]
        places = [i for i in range(n) if is_text[i]]
        upto = list(accumulate(is_text, initial=0))
        starts = {z: a for a, z in self.ends.items()}
        around, at, gap = [(-1, n)], 0, None      # elements around the place, outermost first
        for first, stop in self.spans:
            for i in range(at, first):
                if self.kind[i] and self.opens[i]:
                    z = self.ends.get(i, n if self.kind[i] in REGIONS else -1)
                    if z >= stop:
                        around.append((i, z))
            at = stop
            around = [x for x in around if x[1] >= stop]
            holder = next((k for k in range(len(around) - 1, -1, -1) if upto[first] > upto[around[k][0] + 1]
                           and upto[around[k][1]] > upto[stop]), None)
            if holder is None:
                continue
            within = any(self.kind[a] in REGIONS for a, _ in around[1:holder + 1])
            if not within:
                u, v = places[upto[first] - 1], places[upto[stop]]
                if gap != (u, v):                  # containers that end or begin between the two texts
                    gap = u, v
                    inner = [i for i in range(u + 1, v) if self.kind[i] in CONTAINERS]
                    ending = [i for i in inner if starts.get(i, n) < u]
                    opening = [i for i in inner if self.opens[i] and self.ends.get(i, n) > v]
                left = [starts[i] for i in ending if i < first]
                right = [i for i in opening if i >= stop]
                outside = holder == 0 or self.kind[around[holder][0]] in ("html", "body")
                if any(self.kind[i] in REGIONS for i in left + right):
                    within = False
                elif left and right:
                    within = self.text[left[-1]] == self.text[right[0]]
                else:
                    within = not (outside and (left or right))
            if within:
                self.free[first:stop] = [True] * (stop - first)

    def _ends(self) -> dict[int, int]:
        """Index of the matching end tag of every closed element."""
        open_, out = {}, {}
        for i, name in enumerate(self.kind):
            if not name or name in VOID:
                continue
            if self.opens[i]:
                open_.setdefault(name, []).append(i)
            elif open_.get(name):
                out[open_[name].pop()] = i
        self.ends = out
        return out

    def region(self) -> tuple[int, int] | None:
        """Token range inside the one article or main that is no boilerplate; None if there is not one."""
        for name in ("article", "main"):
            at = [i for i, k in enumerate(self.kind) if k == name and self.opens[i] and not self.bad[i]]
            if len(at) == 1 and at[0] in self.ends:
                return at[0] + 1, self.ends[at[0]]
        return None

    def scores(self, weights: dict[str, float]) -> np.ndarray:
        out = np.empty(len(self.kind))
        for i, name in enumerate(self.kind):
            if self.free[i]:
                out[i] = 0.0
            elif self.bad[i]:
                out[i] = IN_BOILERPLATE * (1 if name else len(self.text[i].split()))
            elif name and self.inside[i]:
                out[i] = 0.0
            elif name:
                out[i] = weights.get(name, -0.5 if name not in INLINE else -0.1)
            else:
                out[i] = len(self.text[i].split())
        return out

    def blocks(self, first: int, last: int) -> list[str]:
        out, line = [], []
        for i in range(first, last):
            name = self.kind[i]
            if not name:
                if not self.bad[i]:
                    line.append(self.text[i])
            elif name == "br":
                line.append(" ")
            elif name not in INLINE:
                out.append(line)
                line = []
        out.append(line)
        texts = (_SPACE.sub(" ", entities.unescape("".join(x))).strip() for x in out if x)
        return [t for t in texts if t]


def best_stretch(scores: np.ndarray) -> tuple[int, int]:
    """Contiguous range of the highest sum (the first and shortest of equals); empty if none is positive."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    low = np.minimum.accumulate(total)
    gain = total - low
    end = int(np.argmax(gain))
    if gain[end] <= 0:
        return 0, 0
    start = int(np.flatnonzero(total[:end] == low[end])[-1])
    return start, end


def learn_classes(pages: list[Page]) -> dict[str, float]:
    """Weights of class tokens, from where they stand on labelled pages: 0 if around the region or
    in it, ``IN_BOILERPLATE`` if on ``SEEN`` pages and only beside it."""
    around, beside = {}, {}
    for page in pages:
        gold = page.region()
        if gold is None:
            continue
        held, apart = set(), set()
        for i, found in enumerate(page.found):
            for token in class_tokens(found) if found else ():
                stop = page.ends.get(i, i)
                if i < gold[0] and stop >= gold[1]:
                    held.add(token)
                elif not gold[0] <= i < gold[1]:
                    apart.add(token)
                elif class_word(token) is None:       # within the text: no boilerplate by itself
                    held.add(token)
        for seen, tokens in ((around, held), (beside, apart - held)):
            for t in tokens:
                seen[t] = seen.get(t, 0) + 1
    out = {f".{t}": 0.0 for t, n in around.items() if n >= SEEN and n > beside.get(t, 0)}
    out |= {f".{t}": IN_BOILERPLATE for t, n in beside.items() if n >= SEEN and t not in around}
    return out


def learn(pages: list[str], rounds: int = 10, rate: float = 0.5) -> dict[str, float]:
    """Weights of class tokens and tags from labelled pages, the tags' until all regions are
    found; never above zero."""
    classes = learn_classes([Page(p) for p in pages])
    weights = {**PRIOR, **classes}
    parsed = [(p, p.region()) for p in (Page(x, classes) for x in pages)]
    for _ in range(rounds):
        wrong = 0
        for page, gold in parsed:
            if gold is None:
                continue
            a, b = best_stretch(page.scores(weights))
            scored = [not (bad or free or (inside and kind)) for bad, free, inside, kind in
                      zip(page.bad, page.free, page.inside, page.kind, strict=True)]
            missed = [page.kind[i] for i in range(*gold) if scored[i] and not a <= i < b]
            foreign = [page.kind[i] for i in range(a, b) if scored[i] and not gold[0] <= i < gold[1]]
            if "" not in missed + foreign:       # the words are right
                continue
            wrong += 1
            for names, step in ((missed, rate), (foreign, -rate)):
                for name in filter(None, names):
                    weights[name] = min(0.0, max(-50.0, weights.get(name, -0.5) + step))
        if not wrong:
            break
    return weights


def extract(source: str | None, weights: dict[str, float]) -> str:
    page = Page(source or "", weights)
    return "\n\n".join(page.blocks(*best_stretch(page.scores(weights))))


def train(pages: DataFrame, sample: int = 300) -> dict[str, float]:
    """Weights from about ``sample`` labelled pages at most, chosen by a hash of page_id and html."""
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    n = labelled.count()
    share = min(1.0, sample / max(1, n))
    chosen = labelled.where(F.pmod(F.xxhash64("page_id", "html", F.lit(3)), F.lit(1 << 62)) < int(share * (1 << 62)))
    got = [r["html"] for r in chosen.orderBy("page_id").select("html").collect()]
    if n and sample and not got:          # by chance at most once in e^sample tables
        got = [labelled.first()["html"]]
    return learn(got)


def _extract_stage(weights: dict[str, float]):
    def run(batches):
        for b in batches:
            texts = [extract(x, weights) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, weights: dict[str, float] | None = None, sample: int = 300) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    weights = weights if weights is not None else train(pages, sample)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract_stage(weights), "page_id long, url string, text string, n_chars long")
