"""Quality rules on repetition inside a text, by a suffix array of its words.

The words of a batch's texts are one sequence, in which words of different texts differ. Suffixes are sorted by prefix
doubling: each round sorts only the suffixes that share their first words with another one, so texts without long repeats
are done after a few rounds. The ranks of the rounds stay, and by them two neighbours' longest common prefix is found in a
binary descent. Runs of neighbours with common prefixes of LEAST words or more form the longest-common-prefix intervals; an
interval whose occurrences are preceded by different words is a maximal repeated substring. Every occurrence of a
repeated substring lies in one of a maximal one, so the union of their spans is the part of a text that repeats: it equals the
words of all LEAST-word windows that stand twice or more. The verdict limits the share that is covered and the
longest repeat.

Words are runs of anything but white space (U+0009-U+000D, U+0020), as they are written; lines are split at U+000A.
Null and empty texts have no words: they fail by their number of words. Texts are taken whole, whatever their length; memory
is some 60 bytes a word and 4 more for each doubling of the longest repeat. Every row gives a row, also where ids repeat
or are null; an empty table gives an empty result. Extra columns are not read. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import hash_words, map_batches, mix, text_steps, words_of

#: Words of the shortest repeat that counts; a power of two for the doubling.
LEAST = 8
#: Fewest words of a text; percent of its words that may repeat by the base rule and by the verdict; words of the longest repeat.
LEAST_WORDS, MOST_SHARE, MOST_COVERED, MOST_LONGEST = 20, 30, 30, 100

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[9:14] = IS_WORD[32] = False
IS_LINE = np.ones(256, dtype=bool)
IS_LINE[10] = False
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
_ROW = np.uint64(0xD6E8FEB86659FD93)


def suffix_ranks(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two are equal: a rank is the first place of its group."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.r_[True, words[order][1:] != words[order][:-1]]
    first = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = first[np.cumsum(new) - 1]
    levels, width = [rank], 1
    size = np.diff(np.r_[first, n])
    open_ = order[np.repeat(size > 1, size)]
    while len(open_):
        last = levels[-1]
        own = last[open_].astype(np.int64)
        then = np.where(open_ + width < n, last[np.minimum(open_ + width, n - 1)], -1).astype(np.int64)
        place = np.argsort(own * (n + 1) + then + 1, kind="stable")
        open_, own, then = open_[place], own[place], then[place]
        group = np.r_[True, own[1:] != own[:-1]]
        new = group | np.r_[True, then[1:] != then[:-1]]
        at = np.arange(len(open_))
        begin, start = at[group][np.cumsum(group) - 1], at[new][np.cumsum(new) - 1]
        rank = last.copy()
        rank[open_] = own + start - begin
        levels.append(rank)
        size = np.diff(np.r_[np.flatnonzero(new), len(open_)])
        open_ = open_[np.repeat(size > 1, size)]
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each place the longest common prefix with the place before; 0 where under `least`, a power of two."""
    n = len(levels[-1])
    order = np.empty(n, dtype=np.int64)
    order[levels[-1]] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    deep = least.bit_length() - 1
    if deep >= len(levels) or not n:
        return order, lcp
    at = np.flatnonzero(levels[deep][order][1:] == levels[deep][order][:-1]) + 1
    i, j = order[at - 1].copy(), order[at].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(i, j) < n
        same = np.zeros(len(at), dtype=bool)
        same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
        i[same] += 1 << k
        j[same] += 1 << k
        lcp[at[same]] += 1 << k
    return order, lcp


def intervals(lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(length, first place, last place) of every interval of the suffix array whose suffixes share more than their surroundings."""
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    places = np.flatnonzero(lcp)
    before = -1
    for place, length in zip(places.tolist(), lcp[places].tolist(), strict=True):
        if place != before + 1:  # another run: what is open ends at the place before
            while stack:
                n, begin = stack.pop()
                out.append((n, begin, before))
        begin = place - 1
        while stack and stack[-1][0] > length:
            n, begin = stack.pop()
            out.append((n, begin, place - 1))
        if not stack or stack[-1][0] < length:
            stack.append((length, begin))
        before = place
    while stack:
        n, begin = stack.pop()
        out.append((n, begin, before))
    return out


@dataclass
class Repeats:
    """Of a sequence of words: whether each lies in a repeat, the longest repeat that starts there, and the maximal repeats."""

    covered: np.ndarray
    longest: np.ndarray
    #: (length, one place of each) of the maximal repeated substrings.
    maximal: list[tuple[int, int]]


def repeats(words: np.ndarray, least: int = LEAST) -> Repeats:
    n = len(words)
    if n < 2:
        return Repeats(np.zeros(n, bool), np.zeros(n, np.int64), [])
    order, lcp = common_prefixes(suffix_ranks(words), least)
    # The deepest interval that holds a suffix is as long as the longer of its two common prefixes.
    longest = np.zeros(n, dtype=np.int64)
    longest[order] = np.maximum(lcp, np.r_[lcp[1:], 0])
    cover = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(longest)
    cover[at] += 1
    np.add.at(cover, at + longest[at], -1)
    left = np.where(order > 0, words[order - 1], 0)
    differ = np.cumsum(np.r_[False, (left[1:] != left[:-1]) | (order[1:] == 0) | (order[:-1] == 0)])
    found = [(length, int(order[first])) for length, first, last in intervals(lcp) if differ[last] > differ[first]]
    return Repeats(np.cumsum(cover[:-1]) > 0, longest, found)


def _per_row(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys of each row."""
    _, first = np.unique(mix(keys ^ (row.astype(np.uint64) * _ROW)), return_index=True)
    return np.bincount(row[first], minlength=rows)


SPAN = pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, longest_repeat long, n_repeats long, spans array<struct<first_word:int,end_word:int,start:int,end:int>>"
NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


def measures(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """The columns NAMES for the texts of one step."""
    rows = len(offsets) - 1
    starts, ends, counts = words_of(data, offsets, IS_WORD)
    row = np.repeat(np.arange(rows), counts)
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    chars = np.bincount(row, weights=points[ends] - points[starts], minlength=rows).astype(np.int64)
    symbols = np.diff(np.r_[0, np.cumsum(IS_SYMBOL[data])][offsets])
    a, b, lines = words_of(data, offsets, IS_LINE)
    line_row = np.repeat(np.arange(rows), lines)
    worded = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, line_row = a[worded], b[worded], line_row[worded]
    again = np.bincount(line_row, minlength=rows) - _per_row(hash_words(data, a, b), line_row, rows)
    found = repeats(mix(hash_words(data, starts, ends) ^ (row.astype(np.uint64) * _ROW)))
    covered = np.bincount(row[found.covered], minlength=rows)
    longest = np.zeros(rows, dtype=np.int64)
    np.maximum.at(longest, row, found.longest)
    maximal = np.bincount(row[[place for _, place in found.maximal]], minlength=rows) if found.maximal else np.zeros(rows, np.int64)
    # Runs of covered words, cut at the ends of texts.
    edge = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
    inside = np.r_[False, found.covered, False].astype(np.int8)
    up, down = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    cuts = edge[(edge > 0) & found.covered[edge] & found.covered[edge - 1]]
    up, down = np.sort(np.r_[up, cuts]).astype(np.int64), np.sort(np.r_[down, cuts]).astype(np.int64)
    of = row[up]
    begin = np.cumsum(counts) - counts
    base = points[offsets[:-1]]
    struct = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (up - begin[of], down - begin[of], points[starts[up]] - base[of], points[ends[down - 1]] - base[of])], fields=list(SPAN))
    spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=rows))].astype(np.int32)), struct)
    return [*(pa.array(x.astype(np.int64)) for x in (counts, chars, symbols, again, covered, longest, maximal)), spans]


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    """The contract's rule: too few words, or too many of them in repeats."""
    return (F.col(n_words) < LEAST_WORDS) | (100 * F.col(n_repeat_words) > MOST_SHARE * F.col(n_words))


def kept(n_words: str = "n_words", covered: str = "n_repeat_words", longest: str = "longest_repeat") -> Column:
    """The verdict: the base rule, the share of words in maximal repeats, and the longest of these."""
    return ~base_failed(n_words, covered) & (100 * F.col(covered) <= MOST_COVERED * F.col(n_words)) & (F.col(longest) <= MOST_LONGEST)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, the counts, longest_repeat (words), n_repeats (maximal repeated substrings), spans that repeat (in words and code points), base_failed, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(offsets) - 1), *measures(data, offsets)], names=[id_col, *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    found = map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, {COLUMNS}")
    return found.withColumns({"base_failed": base_failed(), "kept": kept()})


def digests(judged: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return judged.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
