"""Secret scans with a trigram index (operator 9), DataFrame functions only.

From each rule's regex a Boolean trigram query is derived: trigrams of literal
runs that every match must hold are joined by AND, alternatives by OR.  The
index holds, for every text, which of the rules' trigrams occur in it (lower
case).  It is kept beside each document, as a document-sharded index keeps the
postings of its own shard, so the postings of a query intersect within rows
and nothing is shuffled.  Only candidates are verified with the regex; rules
without a mandatory trigram scan every text.

Matches of a rule are leftmost and do not overlap.  Their places come from the
pieces between matches: lengths of pieces and matches add up to offsets, in a
window over the matches of one text (only matches are shuffled).
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as _C
from re import _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least``
    or more code points."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


def _either_case(words: str) -> str:
    """Each letter of ``words`` as a class of its two ASCII cases."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


#: Kinds and their patterns fixed by the contract, in order.
BASE = (
    Rule("assign", "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token",
                                                     "api_?key")))
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]+", 24),
)

#: Kinds added by this scan.
ADDED = (
    Rule("private_key", "-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP |ENCRYPTED )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", "(?:ghp_|gho_|ghu_|ghs_|ghr_|github_pat_)[A-Za-z0-9_]{36,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", "[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("npm", "npm_[A-Za-z0-9]{36}"),
    Rule("pypi", "pypi-[A-Za-z0-9_-]{50,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{16,}=*"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{3,64}@"),
    Rule("telegram", "[0-9]{8,10}:[A-Za-z0-9_-]{35}"),
)

RULES = BASE + ADDED


# ------------------------------------------------------- Boolean trigram queries

def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """Alternatives of trigram sets, one of which every match holds in lower
    case; None when a match need not hold any trigram (scan fully)."""
    alternatives = _required(_parser.parse(pattern))
    return None if any(not a for a in alternatives) else frozenset(alternatives)


def _letter(members) -> str | None:
    """The one lower-cased character that a class stands for, if it does."""
    if all(op is _C.LITERAL for op, _ in members):
        low = {chr(x).lower() for _, x in members}
        return low.pop() if len(low) == 1 else None
    return None


def _required(seq) -> list[frozenset[str]]:
    """Alternatives (OR) of trigram sets (AND) required by a parsed sequence."""
    found: list[frozenset[str]] = [frozenset()]
    run = ""

    def flush():
        nonlocal run, found
        grams = frozenset(run[i:i + 3] for i in range(len(run) - 2))
        found, run = [f | grams for f in found], ""

    for op, arg in seq:
        one = (chr(arg).lower() if op is _C.LITERAL else
               _letter(arg) if op is _C.IN else None)
        if one is not None and one.isascii():
            run += one
            continue
        flush()
        if op is _C.SUBPATTERN:
            inner = _required(arg[3])
        elif op is _C.BRANCH:
            inner = [a for branch in arg[1] for a in _required(branch)]
        elif op in (_C.MAX_REPEAT, _C.MIN_REPEAT) and arg[0] >= 1:
            inner = _required(arg[2])
        else:
            continue
        found = [f | i for f in found for i in inner]
    flush()
    return found


def _candidate(query, has) -> Column:
    """The Boolean query over the postings kept beside a row."""
    if query is None:
        return F.lit(True)
    out = None
    for grams in sorted(query, key=sorted):
        every = None
        for g in sorted(grams):
            every = has(g) if every is None else every & has(g)
        out = every if out is None else out | every
    return out


# ------------------------------------------------------------------------- scan

def find(docs: DataFrame, rules=RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Matches of all rules: (doc_id, _k1, _k2, kind, rank, start, end), in code
    points, end exclusive.  ``_k1`` and ``_k2`` are hashes of a row's id and
    text; rows equal in both share their matches."""
    d = docs.select(*_keys(docs, id_col, text_col),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for q in queries.values() if q for a in q for g in a})
    low = F.lower("_text")
    # Postings of this row: a bit per trigram, in words of 63.
    words = [grams[i:i + 63] for i in range(0, len(grams), 63)]
    index = d.withColumn("_low", low)
    for w, part in enumerate(words):
        bits = F.lit(0).cast("long")
        for i, g in enumerate(part):
            bits = bits.bitwiseOR(F.when(F.contains("_low", F.lit(g)), F.lit(1 << i).cast("long"))
                                  .otherwise(F.lit(0).cast("long")))
        index = index.withColumn(f"_post{w}", bits)
    index = index.drop("_low")
    place = {g: (w, i) for w, part in enumerate(words) for i, g in enumerate(part)}

    def has(g):
        w, i = place[g]
        return F.col(f"_post{w}").bitwiseAND(F.lit(1 << i).cast("long")) != 0
    # One flag per rule, then the rules that apply to a row.
    per_rule = []
    for rank, r in enumerate(rules):
        # The least length of a plain run can be asked of the regex itself.
        hit = _candidate(queries[r.kind], has) & F.col("_text").rlike(_quick(r))
        rx = F.lit(r.pattern)
        zipped = F.arrays_zip(
            F.transform(F.split("_text", r.pattern, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all("_text", rx, F.lit(0)), F.length).alias("width"),
            F.transform(F.regexp_extract_all("_text", rx, F.lit(r.group)), F.length).alias("held"))
        per_rule.append(F.when(hit, F.struct(F.lit(rank).alias("rank"),
                                             F.lit(r.kind).alias("kind"),
                                             F.lit(r.least).alias("least"), zipped.alias("m"))))
    hits = (index.select("doc_id", "_k1", "_k2", F.explode(F.array_compact(F.array(*per_rule)))
                         .alias("r"))
            .select("doc_id", "_k1", "_k2", "r.rank", "r.kind", "r.least",
                    F.posexplode("r.m").alias("i", "m"))
            .select("doc_id", "_k1", "_k2", "rank", "kind", "least", "i", "m.gap", "m.width",
                    "m.held").distinct())  # rows that repeat a document count once
    upto = Window.partitionBy("_k1", "_k2", "rank").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("width", F.lit(0))).over(upto)
    return (hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("width"))
            .where("width is not null and held >= least")
            .select("doc_id", "_k1", "_k2", "kind", "rank", "start", "end"))


def _quick(r: Rule) -> str:
    """A regex that a text with a match long enough must hold."""
    if r.group == 0 and r.least and r.pattern.endswith("]+"):
        lead = 0 if r.pattern.startswith("[") else len(r.pattern.split("[")[0])
        return f"{r.pattern[:-1]}{{{r.least - lead},}}"
    return r.pattern


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    i, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    return [i.alias("doc_id"), F.xxhash64(i, t).alias("_k1"),
            F.xxhash64(F.lit("2"), t, i).alias("_k2")]


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, found) per row of ``docs``, whole texts; ``found`` is the array
    of (start, rank, kind, end) of all its matches, by start, then rule order.

    A null text is empty.  Repeated rows and rows without a doc_id each get
    their own result, other columns are not read, an empty table gives none.
    """
    found = find(docs, rules, id_col, text_col)
    lists = found.groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("found"))
    rows = docs.select(*_keys(docs, id_col, text_col))
    lists = lists.withColumnsRenamed({"_k1": "_l1", "_k2": "_l2"})
    return rows.join(lists, (F.col("_k1") == F.col("_l1")) & (F.col("_k2") == F.col("_l2")),
                     "left").select(
        "doc_id", F.coalesce("found", F.array().cast(
            "array<struct<start:bigint,rank:int,kind:string,end:bigint>>")).alias("found"))


def _spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans and all spans."""
    n = len(BASE)
    count = lambda k: F.size(F.filter("found", lambda x: x["rank"] == k)).cast("long")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
        F.sha2(_spans(F.filter("found", lambda x: x["rank"] < n)), 256).alias("base_sha256"),
        _spans(F.col("found")).alias("spans"))


def redact(docs: DataFrame, rules=RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every match of every rule replaced in ``text``; a match
    shorter than its rule asks stays."""
    text = F.col("text")
    for r in rules:
        text = F.regexp_replace(text, _quick(r), mask)
    return docs.withColumn("text", text)


# ----------------------------------------------------------------------- oracle

def oracle_sql(rules=RULES) -> str:
    """DuckDB twin of the digest over all documents; rules run on every text."""
    parts = []
    for rank, r in enumerate(rules):
        rx = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT u, {rank} AS rank, '{r.kind}' AS kind, i, {r.least} AS least, "
            f"length(p[i]) AS gap, length(m[i]) AS width, length(g[i]) AS held FROM ("
            f"SELECT u, p, m, g, unnest(range(1, len(p) + 1)) AS i FROM ("
            f"SELECT u, regexp_split_to_array(t, '{rx}') AS p, regexp_extract_all(t, '{rx}', 0) AS m, "
            f"regexp_extract_all(t, '{rx}', {r.group}) AS g FROM d))")
    base = len(BASE)
    one = "kind || ':' || start || ':' || fin, ',' ORDER BY start, rank"
    return f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents),
h AS ({' UNION ALL '.join(parts)}),
e AS (SELECT *, CAST(sum(gap + coalesce(width, 0)) OVER (PARTITION BY u, rank ORDER BY i) AS BIGINT) AS fin
      FROM h),
f AS (SELECT u, rank, kind, fin - width AS start, fin FROM e
      WHERE width IS NOT NULL AND held >= least),
s AS (SELECT u, {', '.join(f"count(*) FILTER (rank = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))},
             string_agg({one}) FILTER (rank < {base}) AS b, string_agg({one}) AS a FROM f GROUP BY u)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN s USING (u)"""
