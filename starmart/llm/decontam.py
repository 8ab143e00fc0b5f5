"""Benchmark decontamination by templates (operator 10).

Numbers, names and units become typed placeholders, so a benchmark question
with other numbers or people has the same template.  A word is a name if the
benchmark writes it only capitalised, in whatever case a document writes it, or
if only a document has it, capitalised.  Which words are names is held in two
bit tables of VOCABULARY_BITS bits by a word's hash, of one size for any
benchmark; words that share a bit are classed alike on both sides.  A unit is a
unit word behind a number.

Items and documents are cut into windows of ``window`` template tokens (half the
item, if it has under twice as many), a window without any plain word into raw
tokens.  One scan of the documents keeps the stretches around windows that pass
a filter of the benchmark's hashes, each distinct stretch once; their windows are
hash-joined in Spark with all windows of all items.  A window that more than
``max_items`` different templates hold identifies no item, so a preamble that many
items share is no match.  It joins like any other, only in the first place of a
run of such windows, and its items are found where they stand nearly whole.

A joined window is extended to both sides over added, dropped and replaced
tokens, up to GAP at a place, wherever JOIN equal tokens (or the item's end)
follow; equal tokens are counted over the whole alignment.  The slots must be
consistent: each value of the benchmark's slots maps to one value of the document
and back ("5 ... 5" may become "7 ... 7", not "7 ... 8").  A match covers
``min_cover`` tokens, or the whole item if that is shorter, where one token in
eight may be missing as long as no slot contradicts; it holds a window that identifies
the item, or any of its windows and nearly the whole item; and it holds MIN_LITERALS plain words, or the item's own values in its slots.  An item
of fewer than MIN_LITERALS tokens matches documents that are that item and nothing
else, as its words identify nothing inside a text.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import cut, map_texts, slices

WINDOW = 8
MIN_COVER = 13
#: Words a match must hold beside its placeholders, unless it is verbatim.
MIN_LITERALS = 5
#: Different templates that may hold a window which identifies an item.
MAX_ITEMS = 10
#: Tokens that may be added, dropped or replaced at one place.
GAP = 3
#: Equal tokens that must follow such a place, but at the end of an item.
JOIN = 3
#: Tokens kept on both sides of a shared window; pieces farther off do not count.
CONTEXT = 24
#: Keys of contaminated texts that are broadcast, about 100 bytes each; more are shuffled.
BROADCAST_KEYS = 100_000
#: Size of the tables of words, 2 MB each.
VOCABULARY_BITS = 24
#: Bounds of the filter of window hashes (log2 of its bits): up to 128 MB.
FILTER_BITS = 16, 30

UNITS = ("mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
         "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres",
         "g", "kg", "mg", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "lb", "lbs",
         "ounce", "ounces", "ton", "tons", "l", "ml", "liter", "liters", "litre", "litres", "gallon",
         "gallons", "s", "ms", "second", "seconds", "minute", "minutes", "hour", "hours", "day",
         "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent",
         "cents", "euro", "euros", "percent", "degree", "degrees", "mph", "kmh", "hz", "khz", "mhz",
         "ghz", "w", "kw", "kwh", "v", "kv", "j", "kj", "cal", "kcal", "pa", "kpa", "bar", "kb", "mb",
         "gb", "tb")

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")
_NUMBER, _NAME, _UNIT = 1, 2, 3
_FIRST_UNIT = 4
_FIRST_WORD = _FIRST_UNIT + len(UNITS)
_UNIT_ID = {u: _FIRST_UNIT + i for i, u in enumerate(UNITS)}
#: Lengths of documents that are compared as a whole.
_SHORT = range(1, MIN_LITERALS)


def _raw(token: str) -> int:
    """Id of a token as it stands, but for its case."""
    return _FIRST_WORD + (int.from_bytes(hashlib.blake2b(
        token.lower().encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 2)


def _plain(token: str) -> bool:
    """Whether a writing of a word shows that it is no name: it begins in lower
    case, or its script has no case."""
    return token[0].islower() or token.lower() == token.upper()


class _Ids(dict):
    """Template id of a raw token, by the tables of the benchmark's plain words and
    of all its words."""

    def __init__(self, plain: np.ndarray, known: np.ndarray):
        super().__init__()
        self.plain, self.known = plain, known

    def __reduce__(self):  # without the memo
        return _Ids, (self.plain, self.known)

    def __missing__(self, token: str) -> int:
        if token[0].isdigit():
            out = _NUMBER
        elif not (out := _UNIT_ID.get(token.lower(), 0)):
            out = _raw(token)
            at = out & (1 << VOCABULARY_BITS) - 1
            byte, bit = at >> 3, at & 7
            if not self.plain[byte] >> bit & 1 and (
                    self.known[byte] >> bit & 1 or token[0].isupper()):
                out = _NAME
        if len(self) > 1 << 17:  # a memo, not a store
            self.clear()
        self[token] = out
        return out


def _templates(tokens: list[str], ids: _Ids) -> np.ndarray:
    t = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
    unit = (t >= _FIRST_UNIT) & (t < _FIRST_WORD)
    unit[1:] &= t[:-1] == _NUMBER
    unit[:1] = False
    t[unit] = _UNIT
    return t


def _mixed(out: np.ndarray, salt: int) -> np.ndarray:
    out = (out ^ np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


def _hashes(t: np.ndarray, widths, salt: int = 0):
    """(width, hash of every window of ``width`` ids), for ascending widths."""
    x = t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    out, done = np.zeros(len(t), np.uint64), 0
    for width in sorted(widths):
        if width > len(t):
            return
        for k in range(done, width):
            out = out[:len(t) - k] * np.uint64(0xBF58476D1CE4E5B9) + x[k:]
        done = width
        yield width, _mixed(out, 2 * width + salt)


def _windows(tokens: list[str], t: np.ndarray, widths):
    """(width, hash of every window): of its template, or of its raw tokens where
    it holds no plain word."""
    widths = [w for w in widths if w <= len(t)]
    literal = np.concatenate([[0], np.cumsum(t >= _FIRST_UNIT)])
    bare = {w: literal[w:] == literal[:-w] for w in widths}
    near = np.zeros(len(t) + 1, np.int32)  # tokens of windows without a plain word
    for w, b in bare.items():
        near[:len(b)] += b
        near[w:] -= b
    places = np.nonzero(np.cumsum(near[:-1]))[0]
    raw = np.zeros(len(t) if len(places) else 0, np.int64)
    memo: dict[str, int] = {}
    for i in places.tolist():
        w = tokens[i]
        raw[i] = memo.get(w) or memo.setdefault(w, _raw(w))
    raws = dict(_hashes(raw, widths, 1)) if len(places) else {}
    for w, h in _hashes(t, widths):
        yield w, np.where(bare[w], raws[w], h) if raws else h


def _whole(tokens: list[str]) -> int:
    """Hash of a short text as a whole."""
    raw = np.array([_raw(w) for w in tokens], np.int64)
    return next(int(h[0]) for _, h in _hashes(raw, [len(raw)], 1 << 20))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _probes(h: np.ndarray, bits: int):
    """The two bits of a hash in the filter."""
    yield h & np.uint64((1 << bits) - 1)
    yield (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


def _passes(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    bits = int(len(table) * 8).bit_length() - 1
    a, b = _probes(h, bits)
    at = np.nonzero(table[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8) & 1)[0]
    b = b[at]
    return at[table[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8) & 1 > 0]


def _width(n: int, window: int) -> int:
    """Window of an item of n tokens: one changed token leaves one whole."""
    return n if n < 8 else min(window, n // 2)


def _bit_table(places: DataFrame, column: str, bits: int) -> np.ndarray:
    """Packed table of ``2**bits`` bits with those in ``column`` set; the driver gets
    at most ``2**(bits - 5)`` rows of 32 bits."""
    got = (places.groupBy(F.shiftright(column, 5).alias("w"))
           .agg(F.bit_or(F.expr(f"shiftleft(1L, int({column} & 31))")).alias("b")).toArrow())
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _vocabulary(items: DataFrame) -> _Ids:
    """Tables of the benchmark's plain words and of all its words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain: dict[int, bool] = {}
        mask = (1 << VOCABULARY_BITS) - 1
        for text in batch.column("text").to_pylist():
            for w in _TOKEN.findall(text):
                if not w[0].isdigit():
                    at = _raw(w) & mask
                    plain[at] = plain.get(at, False) or _plain(w)
        return pa.RecordBatch.from_arrays([pa.array(plain.keys(), pa.int64()),
                                           pa.array(plain.values(), pa.bool_())],
                                          names=["at", "plain"])
    words = cut(map_texts(items.select("text"), run, "at long, plain boolean", "text").distinct())
    return _Ids(_bit_table(words.where("plain"), "at", VOCABULARY_BITS),
                _bit_table(words, "at", VOCABULARY_BITS))


def _item_windows(items: DataFrame, ids, window: int) -> DataFrame:
    """Every different window of every item with its first place and, if that is a first
    place too, the window ``before`` it.  An item of under MIN_LITERALS tokens has
    itself (``kind`` 0)."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for iid, text in zip(b.column("iid").to_pylist(), b.column("text").to_pylist()):
            tokens = _TOKEN.findall(text)
            n = len(tokens)
            if not n:
                continue
            if n < MIN_LITERALS:
                h = np.array([_whole(tokens)], np.uint64).view(np.int64)
                rows.append((iid, 0, int(h[0]), 0, n, None))
                continue
            t = _templates(tokens, ids.value)
            kind = int.from_bytes(hashlib.blake2b(t.tobytes(), digest_size=8).digest(),
                                  "little", signed=True)
            w = _width(n, window)
            for _, h in _windows(tokens, t, [w]):
                values, first = np.unique(h.view(np.int64), return_index=True)
                at = dict(zip(first.tolist(), values.tolist()))
                rows += [(iid, kind, v, q, w, at.get(q - 1)) for q, v in at.items()]
        cols = list(zip(*rows)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["iid", "kind", "h", "q", "w", "before"])
    return map_texts(items.select("iid", "text"), run,
                     "iid long, kind long, h long, q long, w long, before long", "text")


def _stretches(texts: DataFrame, ids, table, widths: list[int]) -> DataFrame:
    """(key, first, fid, tokens, h, p, before): the stretches of each text around windows
    that pass the filter, with the window before each (0 at a text's start); ``fid`` is
    the same for equal stretches."""
    def of(texts: list[str]) -> list[tuple]:
        tokens, bounds = [], [0]
        for text in texts:
            tokens += _TOKEN.findall(text)
            bounds.append(len(tokens))
        t = _templates(tokens, ids.value)
        for b in bounds[1:-1]:  # no unit behind another text's number
            if b < len(t) and t[b] == _UNIT:
                t[b] = _UNIT_ID[tokens[b].lower()]
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        found: dict[int, list] = defaultdict(list)
        for width, h in _windows(tokens, t, widths):
            at = _passes(h, table.value)
            at = at[doc[at] == doc[at + width - 1]]
            v = h.view(np.int64)
            # The window in front of a text's first one is another text's, or partly.
            before = np.where((at > 0) & (doc[at - 1] == doc[at]), v[at - 1], 0)
            for p, d, x, y in zip(at.tolist(), doc[at].tolist(), v[at].tolist(), before.tolist()):
                found[d].append((p - bounds[d], x, y))
        for d, text in enumerate(texts):
            if bounds[d + 1] - bounds[d] in _SHORT:
                h = np.array([_whole(tokens[bounds[d]:bounds[d + 1]])], np.uint64)
                if len(_passes(h, table.value)):
                    found[d].append((0, int(h.view(np.int64)[0]), 0))
        rows = []
        for d, hits in sorted(found.items()):
            hits.sort()
            key = hashlib.md5(texts[d].encode("utf-8", "replace")).hexdigest()
            mine, i = tokens[bounds[d]:bounds[d + 1]], 0
            while i < len(hits):
                j = i
                while j + 1 < len(hits) and hits[j + 1][0] - hits[j][0] <= 2 * CONTEXT:
                    j += 1
                first = max(0, hits[i][0] - CONTEXT)
                held = mine[first:hits[j][0] + max(widths, default=1) + CONTEXT]
                rows.append((key, first, hashlib.md5(" ".join(held).encode("utf-8", "replace"))
                             .hexdigest(), held, [x[1] for x in hits[i:j + 1]],
                             [x[0] - first for x in hits[i:j + 1]],
                             [x[2] for x in hits[i:j + 1]]))
                i = j + 1
        return rows

    types = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()),
             *[pa.list_(pa.int64())] * 3]

    def run(batches):
        for b in slices(batches, "_text", 1 << 20):
            rows = of([t for t in b.column("_text").to_pylist() if t])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, ty) for c, ty in zip(zip(*rows), types)],
                    names=["key", "first", "fid", "tokens", "h", "p", "before"])
    return texts.mapInArrow(run, "key string, first long, fid string, tokens array<string>, "
                                 "h array<long>, p array<long>, before array<long>")


def _onward(a: list, b: list, i: int, j: int) -> list[tuple[int, int]]:
    """Aligned places from (i, j) on: equal tokens, over gaps of up to GAP tokens."""
    out = []
    while True:
        while i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        best = (0, 0, 0)
        for di in range(GAP + 1):
            for dj in range(GAP + 1):
                if (di or dj) and i + di < len(a) and j + dj < len(b):
                    n = 0
                    while (i + di + n < len(a) and j + dj + n < len(b)
                           and a[i + di + n] == b[j + dj + n]):
                        n += 1
                    # Longest first, then the smallest gap.
                    if ((n >= JOIN or n and i + di + n == len(a))
                            and (n, -di - dj) > (best[0], -best[1] - best[2])):
                        best = (n, di, dj)
        if not best[0]:
            return out
        i, j = i + best[1], j + best[2]


def _aligned(a: list, b: list, q: int, p: int) -> list[tuple[int, int]]:
    """The alignment that holds the equal tokens a[q] and b[p]."""
    back = _onward(a[q::-1], b[p::-1], 0, 0)
    return [(q - i, p - j) for i, j in reversed(back)][:-1] + _onward(a, b, q, p)


def _consistent(pairs, words, ids, tokens):
    """(begin, end, plain words needed) of the longest stretches of an alignment whose
    slots map one to one, and of those whose slots hold the item's own values."""
    there: dict = {}
    back: dict = {}
    uses: dict = defaultdict(int)
    held: deque = deque()  # slots of the stretch so far
    begin = same = 0
    for k, (i, j) in enumerate(pairs):
        if ids[i] > _UNIT:
            continue
        a, b = (ids[i], words[i].lower()), (ids[i], tokens[j].lower())
        if a != b:
            yield same, k, 0
            same = k + 1
        if there.get(a, b) != b or back.get(b, a) != a:
            yield begin, k, MIN_LITERALS
            while there.get(a, b) != b or back.get(b, a) != a:
                at, c, d = held.popleft()
                begin = at + 1
                uses[c] -= 1
                if not uses[c]:
                    del there[c], back[d]
        there[a], back[b] = b, a
        uses[a] += 1
        held.append((k, a, b))
    yield same, len(pairs), 0
    yield begin, len(pairs), MIN_LITERALS


def _same_window(words, ids, tokens, t, i, j, width) -> bool:
    """Whether the windows at i and j are equal: as raw tokens, without a plain word."""
    a = ids[i:i + width]
    return (len(a) == width and a == t[j:j + width] and (max(a) > _UNIT or all(
        x.lower() == y.lower() for x, y in zip(words[i:i + width], tokens[j:j + width]))))


def _best(words, ids, tokens, t, seeds, starts, shift, width, min_cover):
    """(tokens covered, first token in the stretch) of an item's best match on the
    diagonal ``shift``, (0, 0) if none.  ``seeds`` are the places of identifying windows,
    ``starts`` those where runs of other windows begin; a match without a seed must be
    nearly the whole item and hold a window."""
    n = len(ids)
    if n < MIN_LITERALS:
        same = [w.lower() for w in words] == [w.lower() for w in tokens]
        return (n, 0) if same else (0, 0)
    nearly = n if n < 8 else n - n // 8
    least, whole = min(min_cover, n), min(min_cover, nearly)
    best, done, known = (0, 0), -1, set(seeds)
    for q in sorted({*seeds, *starts}):
        if q + width <= done or ids[q:q + width] != t[q + shift:q + shift + width]:
            continue
        pairs = _aligned(ids, t, q, q + shift)
        held = [k for k, (i, j) in enumerate(pairs) if j - i == shift
                and _same_window(words, ids, tokens, t, i, j, width)]
        marked = [k for k in held if pairs[k][0] in known]
        done = max(q, pairs[held[-1]][0] if held else q) + width
        for begin, end, need in _consistent(pairs, words, ids, tokens):
            size = end - begin
            limit = whole if size == len(pairs) else least
            if size < limit or size <= best[0]:
                continue
            if not any(begin <= k and k + width <= end
                       for k in (held if size >= nearly else marked)):
                continue
            if sum(ids[i] > _UNIT for i, _ in pairs[begin:end]) < min(need, limit):
                continue
            best = (size, pairs[begin][1])
    return best


def _found(texts: DataFrame, benchmark: DataFrame, window: int, min_cover: int,
           max_items: int) -> DataFrame:
    """(key, item_id, n_windows, n_tokens, first_token) of every contaminated text of
    ``texts`` (a column ``_text``); ``key`` is the text's MD5."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where(
        "text is not null and item_id is not null").withColumn(
        "iid", F.xxhash64("item_id", "text")).dropDuplicates(["iid"])
    ids = sc.broadcast(_vocabulary(items))
    windows = cut(_item_windows(items, ids, window))
    frequent = (windows.where("kind != 0").select("h", "kind").distinct().groupBy("h").count()
                .where(F.col("count") > max_items).select("h", F.lit(True).alias("frequent")))
    seeds = cut(windows.join(frequent, "h", "left").withColumn(
        "frequent", F.col("frequent").isNotNull()))

    n, widths = windows.agg(F.count("*"), F.collect_set(F.when(
        F.col("kind") != 0, F.col("w")))).first()
    low, high = FILTER_BITS
    bits = min(high, max(low, (256 * n).bit_length()))

    def places(b: pa.RecordBatch) -> pa.RecordBatch:
        h = b.column("h").to_numpy().view(np.uint64)
        return pa.RecordBatch.from_arrays([_signed(np.concatenate(list(_probes(h, bits))))],
                                          names=["at"])
    table = sc.broadcast(_bit_table(windows.select("h").mapInArrow(
        lambda batches: (places(b) for b in batches), "at long"), "at", bits))

    held = cut(_stretches(texts, ids, table, sorted(widths)))
    one = held.select("fid", "tokens", "h", "p", "before").dropDuplicates(["fid"])
    hits = one.select("fid", F.explode(F.arrays_zip("h", "p", "before")).alias("_x")).select(
        "fid", "_x.h", "_x.p", F.col("_x.before").alias("_before"))
    # Of windows in a row that both sides hold, frequent ones join in the first place only.
    joined = hits.join(seeds.select("h", "iid", "q", "w", "before", "frequent"), "h").where(
        ~F.col("frequent") | F.col("before").isNull() | (F.col("before") != F.col("_before")))
    diagonals = (joined.groupBy("fid", "iid", "w", (F.col("p") - F.col("q")).alias("shift"))
                 .agg(F.collect_set(F.when(~F.col("frequent"), F.col("q"))).alias("seeds"),
                      F.collect_set(F.when(F.col("frequent"), F.col("q"))).alias("starts")))
    reach = F.greatest(F.col("shift") - CONTEXT, F.lit(0))
    last = F.col("shift") + F.length("text") + CONTEXT  # an item has at most a token a character
    pairs = (diagonals.join(one.select("fid", "tokens"), "fid")
             .join(items.select("iid", "item_id", "text"), "iid")
             .select("fid", "item_id", "text", "seeds", "starts", "w", reach.alias("from"), "shift",
                     F.slice("tokens", (reach + 1).cast("int"),
                             (last - reach).cast("int")).alias("tokens")))

    def verify(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in b.to_pylist():
            words, tokens = _TOKEN.findall(r["text"]), r["tokens"]
            size, first = _best(words, _templates(words, ids.value).tolist(), tokens,
                                _templates(tokens, ids.value).tolist(), r["seeds"], r["starts"],
                                r["shift"] - r["from"], r["w"], min_cover)
            if size:
                width = _width(len(words), window)
                rows.append((r["fid"], r["item_id"], max(1, size - width + 1), size,
                             first + r["from"]))
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
            names=["fid", "item_id", "n_windows", "n_tokens", "at"])
    met = map_texts(pairs, verify, "fid string, item_id long, n_windows long, n_tokens long, "
                                   "at long", "text")

    def best(rows: DataFrame, by: str) -> DataFrame:
        return rows.groupBy(by, "item_id").agg(F.max(F.struct(
            "n_tokens", (-F.col("at")).alias("at"), "n_windows")).alias("_b")).select(
            by, "item_id", "_b.n_windows", "_b.n_tokens", (-F.col("_b.at")).alias("at"))
    met = best(met, "fid").join(held.select("key", "first", "fid").distinct(), "fid")
    return best(met.withColumn("at", F.col("at") + F.col("first")), "key").withColumnRenamed(
        "at", "first_token")


def _key(text) -> F.Column:
    return F.md5(F.col(text).cast("string").cast("binary"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 min_cover: int = MIN_COVER, max_items: int = MAX_ITEMS) -> DataFrame:
    """One row per contaminated document and benchmark item it holds:
    doc_id, item_id, n_windows, n_tokens (covered), first_token (in the text).

    Clean documents give no row; null and empty texts are clean, as are all with
    an empty benchmark.  Items with null or no words never match.  Rows that repeat
    a document give repeated results, a null doc_id stays null.  Of equally long
    matches the first counts.  Only doc_id, text and item_id, text are read.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key("text").alias("key"))
    texts = docs.select(F.col("text").cast("string").alias("_text"))
    return d.join(_found(texts, benchmark, window, min_cover, max_items), "key").drop("key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      min_cover: int = MIN_COVER, max_items: int = MAX_ITEMS) -> DataFrame:
    """``docs`` without the contaminated rows; a row is judged by its text alone, so
    equal texts fare alike, rows without a doc_id too.  Null texts stay."""
    texts = docs.select(F.col("text").cast("string").alias("_text"))
    gone = cut(_found(texts, benchmark, window, min_cover, max_items).select(
        F.col("key").alias("_decontam_key")).distinct())
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    d = docs.alias("_d")
    return d.join(gone, _key("_d.text") == gone["_decontam_key"], "left_anti").select(
        *[F.col(f"_d.`{c}`") for c in docs.columns])
