"""Secret scans by native expressions: known forms, and sliding-window Shannon entropy over candidate strings.

Known forms (assign, access, hex) are leftmost non-overlapping matches. Their places follow from the text between
matches: a match starts after all earlier pieces and matches, counted in code points.

Entropy: a candidate is a maximal run of a class's characters of WINDOW or more. A window of WINDOW characters slides
over it; the entering and the leaving character change one count each and with them the running sum of c * log2(c), from
which the entropy follows as log2(WINDOW) - sum / WINDOW. Counts are an array of the class's alphabet, rewritten once a step. Windows at or over the class's threshold merge into spans.
Allow-listed candidates (plain words, numbers, UUIDs, known placeholders, sequences) are suppressed.

Everything is Spark SQL functions on a row of its own: no shuffle, no Python. Null texts count as empty; very long
texts are scanned whole; repeated rows get a row each; extra columns can't clash, since only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed forms.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
#: A run that is long enough from its leftmost start is the same match as the open-ended form filtered by length.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

WINDOW = 24
#: Candidate pattern, alphabet and least bits of each character class.
CLASSES = {
    "entropy_hex": (r"[0-9a-fA-F]{24,}", "0123456789abcdefABCDEF", 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/_=-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
}
#: Candidates that are no secrets.
ALLOWED = r"^[A-Za-z]+$|^[a-z_-]+$|^[A-Z_-]+$|^[0-9]+$|^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$|(?i)example|placeholder|0123456789abcdef|abcdefghijklmnop|xxxxxxxx"

#: Elements of one block of a running total.
BLOCK = 128
#: Code points of one piece of a text that is redacted.
PIECE = 2048

KINDS = ["assign", "access", "hex", *CLASSES]
_SPAN = "array<struct<s:bigint,k:int,e:bigint>>"


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Of each element: what join (associative, zero as its start) makes of all earlier ones.

    Blocks of BLOCK elements are run through one by one and then shifted by the run of whole blocks, so that appending to
    an array costs a block at most.
    """
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("all"))
    run = lambda x: F.aggregate(x, start, lambda a, v: F.struct(join(a["at"], v).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))

    def in_blocks(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda k: run(F.slice(x, k * BLOCK + 1, F.lit(BLOCK))))
        moved = lambda all_: F.flatten(F.zip_with(all_, run(F.transform(all_, lambda b: b["at"]))["all"], lambda b, o: F.transform(b["all"], lambda v: join(o, v))))
        return _bound(blocks, moved)

    return _bound(values, lambda x: F.when(F.size(x) == 0, F.array().cast("array<bigint>")).otherwise(in_blocks(x)))


def _places(text: Column, found: Column, pattern: str) -> Column:
    """Start of each match: the lengths of all pieces and matches before it and of its own piece."""
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))

    def places(piece: Column) -> Column:
        ends = F.zip_with(F.slice(piece, 1, F.size(found)), found, lambda b, m: b + F.length(m).cast("long"))
        return F.zip_with(_before(ends, lambda a, v: a + v), F.slice(piece, 1, F.size(found)), lambda a, b: a + b)

    return F.when(F.size(found) == 0, F.array().cast("array<bigint>")).otherwise(_bound(pieces, places))


def _spans(starts: Column, found: Column, kind: int, held: Column | None = None) -> Column:
    """Spans (start, kind, end) of matches; held: an array of booleans, the matches that count."""
    out = F.zip_with(starts, found, lambda s, m: F.struct(s.alias("s"), F.lit(kind).alias("k"), (s + F.length(m)).alias("e")))
    if held is not None:
        out = F.transform(F.filter(F.arrays_zip(out.alias("x"), held.alias("h")), lambda z: z["h"]), lambda z: z["x"])
    return out.cast(_SPAN)


def entropy_spans(candidate: Column, start: Column, kind: int, alphabet: str, least: float) -> Column:
    """Merged spans of the windows of one candidate string that hold `least` bits or more."""
    weigh = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    def spans_of(codes: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            into, leaves = F.get(codes, i - 1), i > WINDOW
            out = F.when(leaves, F.get(codes, i - WINDOW - 1)).otherwise(F.lit(0))
            # Count of the leaving character first, so that both changes see current counts.
            gone = F.when(leaves, F.get(a["counts"], out - 1)).otherwise(F.lit(0.0))
            had = F.get(a["counts"], into - 1) - F.when(into == out, 1.0).otherwise(0.0)
            total = a["sum"] + F.when(leaves, weigh(gone - 1) - weigh(gone)).otherwise(F.lit(0.0)) + weigh(had + 1) - weigh(had)
            counts = F.when(into == out, a["counts"]).otherwise(F.transform(a["counts"], lambda c, k: F.when(k == into - 1, c + 1).when(k == out - 1, c - 1).otherwise(c)))
            bits = F.lit(math.log2(WINDOW)) - total / WINDOW
            s, e = start + i - WINDOW, start + i
            last = F.try_element_at(a["spans"], F.lit(-1))
            one = F.struct(s.cast("long").alias("s"), F.lit(kind).alias("k"), e.cast("long").alias("e"))
            longer = F.struct(last["s"].alias("s"), F.lit(kind).alias("k"), e.cast("long").alias("e"))
            more = F.when((F.size(a["spans"]) > 0) & (last["e"] >= s), F.concat(F.slice(a["spans"], F.lit(1), F.size(a["spans"]) - 1), F.array(longer))).otherwise(F.concat(a["spans"], F.array(one)))
            spans = F.when((i >= WINDOW) & (bits >= least), more).otherwise(a["spans"])
            return F.struct(counts.alias("counts"), total.alias("sum"), spans.cast(_SPAN).alias("spans"))

        zero = F.struct(F.array_repeat(F.lit(0.0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast(_SPAN).alias("spans"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, step)["spans"]

    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c).cast("int"))
    return _bound(F.filter(codes, lambda c: c > 0), spans_of)


def _entropy(kind: int, alphabet: str, least: float) -> Callable[[Column], Column]:
    return lambda x: entropy_spans(x["m"], x["s"], kind, alphabet, least)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, text and spans: array of (s, k, e), by start and then kind; k indexes KINDS.

    s and e are code points, e exclusive.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX} | {k: p for k, (p, _, _) in CLASSES.items()}
    for k, p in patterns.items():
        rows = rows.withColumn(k, _found(F.col("text"), p))
    rows = rows.withColumn("values", F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    parts = []
    for n, (k, p) in enumerate(patterns.items()):
        starts, found = _places(F.col("text"), F.col(k), p), F.col(k)
        if k in CLASSES:
            pairs = F.filter(F.zip_with(starts, found, lambda s, m: F.struct(s.alias("s"), m.alias("m"))), lambda x: ~x["m"].rlike(ALLOWED))
            spans = F.flatten(F.transform(pairs, _entropy(n, *CLASSES[k][1:])))
        else:
            spans = _spans(starts, found, n, F.transform("values", lambda v: F.length(v) >= ASSIGN_LEAST) if k == "assign" else None)
        parts.append(F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(spans.cast(_SPAN)))
    return rows.select(F.col("id").alias(id_col), "text", F.array_sort(F.concat(*parts)).alias("spans"))


def _written(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(name, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["k"] < 3)
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret span replaced by a mark; texts without secrets stay as they are, null texts null.

    Spans that overlap share a mark, adjacent ones have one each.
    """
    found = find_secrets(docs.withColumn(id_col, F.struct(*docs.columns)), id_col, text_col)
    long = lambda x: x.cast("long")

    def between(pieces: Column, a: Column, b: Column) -> Column:
        """Code points a to b; only pieces that hold them are looked at."""
        i, j = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
        piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
        head, size = (a % PIECE + 1).cast("int"), (b - a).cast("int")
        over = F.concat(F.substring(piece(i), head, F.lit(PIECE)), F.array_join(F.slice(pieces, i + 2, j - i - 1), ""), F.substring(piece(j), F.lit(1), (b % PIECE).cast("int")))
        return F.when(i == j, F.substring(piece(i), head, size)).otherwise(over)

    def cleaned(x: Column) -> Column:
        ends = F.transform(F.col("spans"), lambda s: long(s["e"]))
        parts = F.zip_with(x["done"], F.col("spans"), lambda at, s: F.when(s["s"] < at, F.lit("")).otherwise(F.concat(between(x["pieces"], at, s["s"]), F.lit(mark))))
        rest = between(x["pieces"], F.array_max(ends), long(F.length("text")))
        return F.concat(F.array_join(parts, ""), rest)

    done = _before(F.transform("spans", lambda s: long(s["e"])), lambda a, v: F.greatest(a, v))
    work = F.struct(_found(F.col("text"), f"(?s).{{1,{PIECE}}}").alias("pieces"), done.alias("done"))
    clean = F.when(F.size("spans") > 0, _bound(work, cleaned)).otherwise(F.col(f"{id_col}.{text_col}"))
    return found.select(*[(clean if c == text_col else F.col(f"{id_col}.{c}")).alias(c) for c in docs.columns])
