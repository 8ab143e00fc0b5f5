"""Main text of web pages (operator 5).

The standard library's parser streams a page's events once.  Block elements
cut its text into lines; each line has a text-to-tag ratio.  The ratios are
smoothed with a Gaussian, and a threshold (the mean of two clusters of ratios)
splits lines into content and the rest.  The article or main element around
most of the content's characters is the content region; without one, it is the
smallest container that holds nearly all of them, with the content lines that
stand outside and the headings before it.  The region's blocks are the text, without what elements,
roles or class names mark as menus, headers, footers, sidebars, notices,
adverts, forms or comments, and without link lists.  A class name or a form
removes no element that wraps the page.

Choosing a region rather than single lines keeps an article's short
paragraphs, whose own ratio is as low as a menu's.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import map_texts

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol optgroup "
    "option p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = frozenset("article body div main section td table".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Never part of the text, wherever they are.
_DROP = frozenset("aside button canvas dialog footer frameset head iframe input label math menu "
                  "nav noframes noscript object script select style svg template textarea title "
                  "audio video map".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar "
                   "navigation search status toolbar".split())
#: Words of class names and ids that mark what is not the article.
_MARKS = frozenset(
    "ad ads adbox adsbygoogle advert adverts advertisement advertisements advertising sponsor "
    "sponsored promo promotion banner breadcrumb breadcrumbs menu nav navbar navigation sidebar "
    "footer header masthead topbar toolbar cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay comment comments commentlist disqus reply replies respond share "
    "sharing social newsletter subscribe subscription signup login related recommended "
    "recommendations widget widgets pagination pager skip copyright disclaimer".split())
#: Words beside "header" in the class of an article's own headline.
_HEADLINE = frozenset("article blog content entry headline news page post recipe section story "
                      "title".split())
#: Words beside a mark in the names of page furniture.  Inside an article a mark beside
#: any other word (a section on related work, say) decides only with a low ratio.
_PLAIN = frozenset(
    "area article articles author bar block body bottom box button buttons col column container "
    "content count feed form group icon icons inner item items js left link links list main meta "
    "module outer page panel post posts reader reader's readers region right row section site slot "
    "story text the thread title top unit user users wrap wrapper".split())
#: A marked container with this share of the content lines' characters is a wrapper.
MARK_SHARE = 0.5
#: Characters of a paragraph that counts as text by itself.
SENTENCE = 40
#: Words of readers' replies, which can outweigh an article, and their share.
_REPLIES = frozenset("comment comments commentlist disqus reply replies respond".split())
REPLY_SHARE = 0.9
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Elements that class names cannot remove: they hold the page or its headline.
_KEEP = frozenset(("html", "body", "main", "article")) | _HEADING
#: Elements that a new block of the given kind closes if left open.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table select div section article main body".split())


def _gone(attrs) -> bool:
    """Whether the element's attributes say that it is hidden or no text of a page."""
    for name, value in attrs:
        v = value or ""
        if name == "hidden" or name == "aria-hidden" and v.lower() == "true":
            return True
        if name == "style" and "display:none" in v.replace(" ", "").lower():
            return True
        if name == "role" and v.lower() in _ROLES:
            return True
    return False


def _marks(attrs) -> tuple[set, bool]:
    """Words in class names or ids that mark what is not the article, and whether
    one of the names says nothing else."""
    out, sure = set(), False
    for name, value in attrs:
        if name in ("class", "id"):
            for part in (value or "").split():
                words = _SPLIT.split(_CAMEL.sub(" ", part).lower())
                found = _MARKS.intersection(words)
                if found and (found != {"header"} or _HEADLINE.isdisjoint(words)):
                    out |= found
                    sure = sure or all(not w or w.isdigit() or w in _MARKS or w in _PLAIN
                                       for w in words)
    return out, sure


class _Lines(HTMLParser):
    """Lines of a page: [text, tags, container, dropped, tag, linked characters,
    pieces (text, innermost marked element), whether an article or main is around,
    whether an article is].

    What is dropped or marked is settled for each piece of text when it is read, so
    a button inside a sentence takes nothing else along."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: (tag, dropped from here, container, marked element, in an article or main)
        self.stack: list[tuple[str, bool, int, int, bool]] = []
        #: Of marked elements: the one around, whether it holds an article or main, the
        #: words, whether the mark is sure, whether an article or main is around.
        self.marks: list[list] = [[-1, True, set(), True, False]]
        self.parents: list[tuple[int, str]] = [(-1, "body")]  # of containers
        self.lines: list[list] = []
        self.text: list[tuple[str, int]] = []
        self.lost: list[str] = []
        self.tags = self.linked = self.links = 0

    def _end(self):
        """Close the line that is open.  It stands in the innermost element that is
        not dropped, unless nothing but dropped text is in it."""
        if self.text or self.lost or self.tags:
            joined = " ".join("".join(t for t, _ in self.text).split())
            lost = not joined and any(t.strip() for t in self.lost)
            if lost:
                joined = " ".join("".join(self.lost).split())
            around = self.stack if lost else [x for x in self.stack if not x[1]]
            tag, _, container, _, inside = around[-1] if around else ("body", False, 0, 0, False)
            self.lines.append([joined, self.tags, container, lost, tag, self.linked, self.text,
                               inside, any(x[0] == "article" for x in around)])
            self.text, self.lost, self.tags, self.linked = [], [], 0, 0

    def _aside(self) -> bool:
        """Whether an inline element that is dropped stands around: its blocks do not
        cut the sentence that it stands in."""
        if not self.stack or not self.stack[-1][1]:
            return False
        return next(x[0] for x in self.stack if x[1]) not in _BLOCK

    def _pop(self, at: int):
        for tag, *_ in self.stack[at:]:
            self.links -= tag == "a"
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        block = tag in _BLOCK
        if block and not self._aside():
            self._end()
        if block:
            # A block ends an open paragraph; items and cells end their like.
            for i in range(len(self.stack) - 1, -1, -1):
                t, dropped = self.stack[i][:2]
                if t == "p" or t in _CLOSES.get(tag, ()):
                    self._pop(i)
                    break
                if t in _SCOPE or t in ("li", "td", "th", "dd") and tag not in _CLOSES:
                    break
                if dropped and not (i and self.stack[i - 1][1]):
                    break  # what is inside a dropped element closes nothing around it
        self.tags += 1
        if tag in _VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        _, dropped, container, mark, inside = self.stack[-1] if self.stack else ("", False, 0, 0, False)
        if not dropped:
            dropped = tag in _DROP or bool(attrs) and _gone(attrs)
            if tag == "header":  # a page header goes, an article's headline stays
                dropped = dropped or not any(x[0] in ("article", "main") for x in self.stack)
        if not dropped:
            marked, sure = _marks(attrs) if attrs else (set(), False)
            if tag == "form":
                marked.add(tag)
                sure = True
            if tag in ("article", "main") and (tag == "main" or not marked):
                inside, m = True, mark
                while m > 0 and not self.marks[m][1]:
                    self.marks[m][1] = True
                    m = self.marks[m][0]
            elif marked and tag not in _KEEP:
                self.marks.append([mark, False, marked, sure, inside])
                mark = len(self.marks) - 1
        if tag in _CONTAINER:
            self.parents.append((container, tag))
            container = len(self.parents) - 1
        self.links += tag == "a"
        self.stack.append((tag, dropped, container, mark, inside))

    def handle_startendtag(self, tag, attrs):
        # Browsers ignore the slash of elements that are not void.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _BLOCK and not self._aside():
            self._end()
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i][0]
            if t == tag:
                self._pop(i)
                return
            if t in ("article", "main", "body", "table") and tag not in ("body", "html", "main",
                                                                         "article"):
                return  # a stray end tag closes nothing outside its region

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in ("script", "style"):
            return
        if self.stack and self.stack[-1][1]:
            self.lost.append(data)
            return
        self.text.append((data, self.stack[-1][3] if self.stack else 0))
        if self.links:
            self.linked += len("".join(data.split()))


def _kernel(sigma: float) -> np.ndarray:
    r = max(1, round(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return k / k.sum()


def content_lines(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Flags of the lines whose smoothed ratio lies in the upper cluster."""
    k = _kernel(sigma)
    r = len(k) // 2
    smooth = np.convolve(np.pad(ratios, r, mode="edge"), k, "valid")
    cut = smooth.mean()
    for _ in range(20):  # two means in one dimension
        high = smooth > cut
        if high.all() or not high.any():
            break
        new = (smooth[high].mean() + smooth[~high].mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return smooth >= cut


def _content(lines) -> np.ndarray:
    """Flags of the content lines; what is dropped counts as a ratio of 0."""
    return content_lines(np.array([0.0 if x[3] else len(x[0]) / max(1, x[1]) for x in lines]))


def _drop_marked(lines, marks):
    """Drop the text of marked elements (and forms), but for those that wrap the
    page: they hold an article or main, or most of the content lines' characters,
    counted in articles and mains if there are any.  An element in an article whose
    mark is not sure also needs to lie mostly in lines that are neither content nor
    paragraphs of a sentence's length.
    Replies are judged first."""
    for replies, share in ((True, REPLY_SHARE), (False, MARK_SHARE)):
        if len(marks) == 1 or all(x[3] for x in lines):
            return
        within = any(x[7] and not x[3] for x in lines)
        weight, dense, size = ([0] * len(marks) for _ in range(3))
        for x, h in zip(lines, _content(lines)):
            if x[3]:
                continue
            one = len({m for _, m in x[6]}) == 1
            for text, m in x[6][:1] if one else x[6]:
                n = len(x[0]) if one else len(" ".join(text.split()))
                size[m] += n
                dense[m] += n * bool(h or x[4] == "p" and n >= SENTENCE and 2 * x[5] < n)
                if h and (x[7] or not within):
                    weight[m] += n
        for m in range(len(marks) - 1, 0, -1):  # elements inside come later
            for column in (weight, dense, size):
                column[marks[m][0]] += column[m]
        gone = [False]
        for m, (around, holds, words, sure, inside) in enumerate(marks[1:], 1):
            light = not holds and weight[m] < max(1, share * weight[0])
            if inside and not sure:
                light = light and 2 * dense[m] < size[m]
            gone.append(gone[around] or light and replies != _REPLIES.isdisjoint(words))
        for x in lines:
            stay = [(t, m) for t, m in x[6] if not gone[m]]
            if not x[3] and len(stay) < len(x[6]):
                left = " ".join("".join(t for t, _ in stay).split())
                x[0], x[3], x[6] = left or x[0], not left, stay


def main_text(html: str | None, share: float = 0.6, whole: float = 0.95) -> str:
    """The main text of a page, one block per line; empty if there is none.

    The article or main element around the container of ``share`` of the
    content lines' characters; without one, the container of ``whole`` of them,
    the content lines outside and the headings before it.
    """
    if not html:
        return ""
    p = _Lines()
    p.feed(html)
    p.close()
    p._end()
    lines = [x for x in p.lines if x[0]]
    _drop_marked(lines, p.marks)
    kept = [x for x in lines if not x[3]]
    if not kept:
        return ""
    high = _content(lines)
    # Characters of content lines under each container; children come later.
    weight = [0] * len(p.parents)
    for x, h in zip(lines, high):
        if h and not x[3]:
            weight[x[2]] += len(x[0])
    if not any(weight):
        for x in kept:
            weight[x[2]] += len(x[0])
    total = sum(weight)
    for c in range(len(weight) - 1, 0, -1):
        weight[p.parents[c][0]] += weight[c]
    def innermost(part):
        return max(c for c, w in enumerate(weight)
                   if w >= part * total and _holds(c, weight, p.parents))

    region = None
    around = innermost(share)
    while around > 0:  # the article or main element around the region
        if p.parents[around][1] in ("article", "main"):
            region = around
        around = p.parents[around][0]
    bounded = region is not None
    if not bounded:
        region = innermost(whole)
    inside = set()
    for c in range(len(p.parents)):
        if c == region or p.parents[c][0] in inside:
            inside.add(c)
    out, before = [], True
    for x, h in zip(lines, high):
        if x[3]:
            continue
        if x[2] in inside:
            before = False
            out.append(x)
        elif not bounded and (h or before and x[4] in _HEADING and not x[5]):
            out.append(x)
    return "\n".join(x[0] for x in _without_link_lists(out))


def _holds(c: int, weight, parents) -> bool:
    """Whether a container is on the path of largest weight (always true for
    shares above one half; ties at equal weight go to the inner container)."""
    return c == 0 or weight[parents[c][0]] >= weight[c]


def _without_link_lists(lines):
    """Lines without runs of three or more list items that are links only; in an
    article such a list is one of sources."""
    out, run = [], []
    for x in [*lines, None]:
        if x is not None and not x[8] and x[4] in ("li", "a") and x[5] >= len("".join(x[0].split())) > 0:
            run.append(x)
            continue
        if len(run) < 3:
            out.extend(run)
        run = []
        if x is not None:
            out.append(x)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text) per row of ``pages``, from the whole html.

    A null or empty html gives an empty text.  Repeated rows give repeated
    results, null ids and urls stay, other columns are not read, an empty
    table gives none.
    """
    d = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                     F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.col(f"`{html_col}`").cast("string").alias("_html"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        text = pa.array([main_text(h) for h in b.column("_html").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), text],
                                          names=["page_id", "url", "text"])
    return map_texts(d, run, "page_id long, url string, text string", "_html")
