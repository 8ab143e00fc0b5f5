"""Detection of periodic runs of words (operator 11).

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, and that holds at least ``exponent`` periods
and ``min_words`` words.

Suffix automaton with link-cut access: the words are appended one by one to the
suffix automaton of what stands before.  Every state knows where its strings
ended last; states on a path of the link tree with the same last end form one
coloured segment, kept as a splay tree.  Appending a word accesses the path from
the newest state to the root and recolours it with the new end.  On the way each
segment gives one pair: its longest string, of L words, ended d words earlier.
If L >= d the last d words repeat the d before them (a square), and the L + d
words up to here have period d.  L cannot be extended to the left, so where the
next word breaks the period this is a whole run.  Accesses recolour O(log n)
segments each, amortised.  If a smaller period held, some longer string would
have ended nearer, so d is the smallest.

The automaton only sees stretches that can hold a run: in a run of period q all
three-word sequences after the first period have ended at most q words before.
Sequences are compared by hash, which can only add stretches, and for each
power of two the stretches dense enough for such periods are taken, with the
period before them.  A stretch of more than ``_PIECE`` words and eight periods
is cut into pieces that overlap by half; a run found in a piece is extended over
the whole text by comparing words, so memory follows the period, not the text.

Each text is worked on by itself, in the task that read it: nothing is shuffled,
and a frequent word or group of copies has no task of its own.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import slices

EXPONENT = 4
MIN_WORDS = 6
_GRAM = 3
_PIECE = 1 << 16

RUN = "struct<start:bigint,length:bigint,period:bigint>"


class _Automaton:
    """Suffix automaton of a growing sequence; ``append`` returns the pairs
    (distance to the last end, longest string) of the segments it recoloured.

    States are numbered from 1; 0 stands for none.  ``left``, ``right`` and
    ``up`` are the splay trees of the coloured segments, ordered by depth; the
    root of a tree holds its colour, and its ``up`` the state above the segment.
    """

    def __init__(self):
        self.length, self.link, self.next = [0, 0], [0, 0], [{}, {}]
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.end = 1, -1

    def _state(self, length: int, follow: dict) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append(follow)
        for column in (self.left, self.right, self.up):
            column.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Rotate ``x`` to the root of its segment's tree; the colour comes along."""
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if not g or (left[g] != p and right[g] != p):
                self.colour[x] = self.colour[p]
                self._rotate(x, p)
                return
            above = up[g]
            if not above or (left[above] != g and right[above] != g):
                self.colour[x] = self.colour[g]
            if (left[g] == p) == (left[p] == x):
                self._rotate(p, g)
                self._rotate(x, p)
            else:
                self._rotate(x, p)
                self._rotate(x, g)

    def _rotate(self, x: int, p: int) -> None:
        """Lift ``x`` above its parent ``p``."""
        left, right, up = self.left, self.right, self.up
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        g = up[x] = up[p]
        up[p] = x
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def append(self, word: int) -> list[tuple[int, int]]:
        length, link, follow = self.length, self.link, self.next
        self.end += 1
        new, p = self._state(length[self.last] + 1, {}), self.last
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = follow[p][word]
            if length[q] != length[p] + 1:
                q = self._split(q, p, word)
            link[new] = q
        self.up[new] = link[new]
        self.last = new
        return self._access(new)

    def _split(self, q: int, p: int, word: int) -> int:
        """A copy of ``q`` for its strings that the new word ends as well; it
        takes its place above ``q``, in the same segment."""
        follow, link, left, up = self.next, self.link, self.left, self.up
        copy = self._state(self.length[p] + 1, dict(follow[q]))
        link[copy] = link[q]
        link[q] = copy
        while p and follow[p].get(word) == q:
            follow[p][word] = copy
            p = link[p]
        self._splay(q)
        above = left[q]
        left[copy] = above
        if above:
            up[above] = copy
        left[q], up[copy] = copy, q
        return copy

    def _access(self, state: int) -> list[tuple[int, int]]:
        right, up, colour, length, end = (self.right, self.up, self.colour, self.length, self.end)
        found, below, x = [], 0, state
        while x:
            self._splay(x)
            c = colour[x]
            if c >= 0 and length[x]:
                found.append((end - c, length[x]))
            deeper = right[x]
            if deeper:
                colour[deeper] = c
            right[x] = below
            below, x = x, up[x]
        colour[below] = end
        return found


def find_runs(words: list[int], exponent: int = EXPONENT,
              min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers."""
    out, n, automaton = [], len(words), _Automaton()
    for i, word in enumerate(words):
        for d, longest in automaton.append(word):
            if (longest >= (exponent - 1) * d and longest + d >= min_words
                    and (i + 1 == n or words[i + 1] != words[i + 1 - d])):
                out.append((i - longest - d + 1, longest + d, d))
    return out


# ------------------------------------------------------------ stretches to look at

def _distances(ids: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(place, distance to the nearest earlier place) of the sequences of
    ``_GRAM`` words that stand earlier in the same text.  ``start`` and ``end``
    give the bounds of the text around each word."""
    n = len(ids) - _GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(_GRAM):
        h = (h + ids[k:k + n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    bits = np.uint64(int(n).bit_length())
    packed = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = np.nonzero((packed[1:] >> bits) == (packed[:-1] >> bits))[0]
    at, before = place[same + 1], place[same]
    inside = (before >= start[at]) & (at + _GRAM <= end[at])
    at, before = at[inside], before[inside]
    order = np.argsort(at)
    return at[order], (at - before)[order]


def stretches(ids: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT,
              min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """(text, first word, end, largest period) of the stretches of some texts,
    whose words are ``ids`` in a row, that can hold a run."""
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    start, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    at, distance = _distances(ids, start, end)
    longest, low, found = int(sizes.max(initial=0)), 1, []
    while exponent * low <= longest:
        high = 2 * low - 1
        # Sequences after the first period of the shortest run with such a period.
        need = max((exponent - 1) * low, min_words - high) - _GRAM + 1
        if need < 1:  # every word may belong to such a run
            found += [(t, int(e - s), int(e), high) for t, (s, e) in enumerate(zip(sizes, ends)) if s]
        else:
            near = at[distance <= high]
            breaks = np.nonzero(np.diff(near) != 1)[0] + 1
            first = near[np.concatenate([[0], breaks])] if len(near) else near
            last = near[np.concatenate([breaks, [len(near)]]) - 1] if len(near) else near
            for s, e in zip(first, last):
                if e - s + 1 >= need:
                    found.append((int(text[s]), max(int(start[s]), int(s) - high),
                                  min(int(end[s]), int(e) + _GRAM), high))
        low *= 2
    out: list[list[int]] = []
    for t, s, e, high in sorted(found):
        if out and out[-1][0] == t and s <= out[-1][2]:
            out[-1][2], out[-1][3] = max(out[-1][2], e), max(out[-1][3], high)
        else:
            out.append([t, s, e, high])
    return [tuple(x) for x in out]


def _extent(ids: np.ndarray, start: int, end: int, at: int, period: int, step: int) -> int:
    """Words from ``at`` on, in the direction ``step``, that equal the word a
    period back within [start, end)."""
    moved, width = 0, 256
    while True:
        if step > 0:
            a = at + moved
            e = min(end, a + width)
            same = ids[a:e] == ids[a - period:e - period]
        else:
            e = at - moved + 1
            a = max(start, e - width)
            same = (ids[a:e] == ids[a + period:e + period])[::-1]
        if not same.all():
            return moved + int(np.argmin(same))
        moved += len(same)
        if len(same) < width:
            return moved
        width *= 2


def runs_of(ids: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT,
            min_words: int = MIN_WORDS, piece: int = _PIECE) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, whose words are ``ids`` in a row, as
    (start, length, period) by start, then period."""
    out: list[set] = [set() for _ in sizes]
    ends = np.cumsum(sizes)
    for text, first, stop, period in stretches(ids, sizes, exponent, min_words):
        base, top = int(ends[text] - sizes[text]), int(ends[text])
        step = max(piece, 2 * exponent * period)
        for s in range(first, max(first + 1, stop - step), step):
            e = stop if s + 2 * step >= stop else s + 2 * step
            for start, length, q in find_runs(ids[s:e].tolist(), exponent, min_words):
                left, right = s + start, s + start + length
                if left == s:
                    left -= _extent(ids, base, top, left - 1, q, -1)
                if right == e:
                    right += _extent(ids, base, top, right, q, 1)
                out[text].add((left - base, right - left, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Flags of the words that no run holds after its first period."""
    step = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) == 0


# --------------------------------------------------------------------- Spark steps

def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, min_words: int = MIN_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start word,
    length in words, period, by start and period) and collapsed (the words that
    remain when each run keeps its first period, joined by one space).

    Words are separated by ASCII white space.  A null or blank text has no words,
    no runs and an empty ``collapsed``; runs that overlap are all reported; equal
    rows give equal rows; rows without a doc_id count like any other; other
    columns, whatever their names, are not read; an empty table gives an empty
    result.  Memory of a task: a batch of about 8 MB of texts (or one longer
    text), and some 600 bytes for each word of the longest stretch of one piece.
    """
    if exponent < 2 or min_words < 1:
        raise ValueError("exponent must be at least 2 and min_words at least 1")

    def run(batches):
        for b in slices(batches, "text"):
            texts = [t.split() if t else [] for t in b.column("text").to_pylist()]
            number = defaultdict()
            number.default_factory = number.__len__
            sizes = np.array([len(t) for t in texts], np.int64)
            ids = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64,
                              int(sizes.sum()))
            found = runs_of(ids, sizes, exponent, min_words)
            collapsed = []
            for words, runs in zip(texts, found):
                if runs:
                    words = [words[i] for i in np.nonzero(kept_words(len(words), runs))[0]]
                collapsed.append(b" ".join(words))
            as_rows = [[dict(zip(("start", "length", "period"), r)) for r in runs]
                       for runs in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes),
                 pa.array(as_rows, pa.list_(pa.struct([(c, pa.int64()) for c in
                                                       ("start", "length", "period")]))),
                 pa.array(collapsed, pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"])
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    out = d.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def digest(found: DataFrame) -> DataFrame:
    """Numbers of the runs of each row of ``periodic_runs``: doc_id, n_runs; start,
    length, period and exponent_milli of the longest run (ties: smallest start,
    then period; null without runs), and SHA-256 of all runs and of the
    collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n")))
    f = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return f.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-best.size * 1000) div best.period").alias("exponent_milli"),
        F.sha2(F.coalesce(lines, F.lit("")), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
