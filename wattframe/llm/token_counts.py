"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A document's pre-tokens (the pieces a tokenizer's pattern cuts a text into; merges never cross them) stand in leaves
of LEAF pieces. Over the leaves a binary tree holds sums of characters and of tokens. An edit descends by characters to the
leaves it touches, cuts only their text anew, with the neighbouring context that the pattern may look at, encodes the new
pieces, and updates the sums on the way to the root. Leaves that an edit overfills split, and the tree over them is planted
anew from known sums. If the new cut doesn't meet the next leaf's old boundary, the
region grows by that leaf.

Counting a corpus and its edited form so costs one full pass over the texts and a bounded region for each edit. Documents
are rows of their own: no shuffle. The vocabulary is a parameter, read by the driver and broadcast; its size is fixed.

Null texts count as empty; very long texts have deeper trees. Edits are half-open code-point ranges of the original
text with a replacement, applied from the last start to the first and clipped to the text as it then is; where ranges overlap, the
one that starts first is applied last and so replaces what it covers. Null edits and null replacements count as none and
as empty. Repeated rows give a row each.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import map_batches

LEAF = 64
#: Characters before an edit that the pattern's decisions may rest on.
CONTEXT = 2
#: Pieces that a task's memo of counts holds, and characters of the longest one.
MEMO, LONGEST = 400_000, 64
#: Fixed value: the published pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Pieces of a text and the number of tokens of a piece."""

    def __init__(self, ranks: str, pattern: str = PATTERN) -> None:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.memo: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= LONGEST:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = n
        return n


class TokenTree:
    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        self.encoded = 0
        pieces = counter.pieces(text)
        self._plant([self._leaf(pieces[i : i + LEAF]) for i in range(0, len(pieces), LEAF)])

    def _leaf(self, pieces: list[str]) -> tuple[list[str], int, int]:
        self.encoded += len(pieces)
        return pieces, sum(map(len, pieces)), sum(map(self.counter.count, pieces))

    def _plant(self, leaves: list[tuple[list[str], int, int]]) -> None:
        """The tree over leaves whose sums are known."""
        self.size = 1 << (max(1, len(leaves)) - 1).bit_length()
        rest = self.size - len(leaves)
        self.leaves = [x for x, _, _ in leaves] + [[] for _ in range(rest)]
        self.chars = [0] * self.size + [n for _, n, _ in leaves] + [0] * rest
        self.tokens = [0] * self.size + [n for _, _, n in leaves] + [0] * rest
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the end of the text belongs to the last character's leaf."""
        at = max(0, min(at, self.chars[1] - 1))
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def edit(self, start: int, end: int, text: str) -> None:
        total = self.chars[1]
        start = max(0, min(start, total))
        end = max(start, min(end, total))
        first, at = self.find(start - CONTEXT)
        last, _ = self.find(end)
        while True:
            old = "".join("".join(leaf) for leaf in self.leaves[first : last + 1])
            new = old[: start - at] + text + old[end - at :]
            after = last + 1
            while after < len(self.leaves) and not self.leaves[after]:
                after += 1
            if after == len(self.leaves):
                pieces = self.counter.pieces(new)
                break
            ahead = "".join(self.leaves[after])
            pieces, length = [], 0
            for piece in self.counter.pieces(new + ahead):
                if length >= len(new):
                    break
                pieces.append(piece)
                length += len(piece)
            if length == len(new) and not ahead.isspace():
                break
            last = after
        many = last - first + 1
        self.encoded = 0
        if len(pieces) > 2 * LEAF * many:  # overfull leaves split, so that a later edit's region stays small
            old = [*zip(self.leaves, self.chars[self.size :], self.tokens[self.size :], strict=True)]
            new = [self._leaf(pieces[i : i + LEAF]) for i in range(0, len(pieces), LEAF)]
            self._plant([x for x in [*old[:first], *new, *old[last + 1 :]] if x[0]])
            return
        for k in range(many):
            leaf, n_chars, n_tokens = self._leaf(pieces[len(pieces) * k // many : len(pieces) * (k + 1) // many])
            self.leaves[first + k], self.chars[self.size + first + k], self.tokens[self.size + first + k] = leaf, n_chars, n_tokens
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for i in range(low, high + 1):
                self._sum(i)
            low, high = low // 2, high // 2


def count_edited(docs: DataFrame, ranks_path: str, edits: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens (before), n_tokens_after, n_pieces (before) and n_recut (pieces cut anew for the edits)."""
    with open(ranks_path, encoding="ascii") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for batch in batches:
            out = []
            for text, changes in zip(batch.column(1), batch.column(2), strict=True):
                tree = TokenTree(text.as_py() or "", counter)
                before, pieces, again = tree.tokens[1], tree.encoded, 0
                for e in sorted((e for e in changes.as_py() or () if e), key=lambda e: (e["start"] or 0, e["end"] or 0), reverse=True):
                    tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                    again += tree.encoded
                out.append((before, tree.tokens[1], pieces, again))
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "n_tokens", "n_tokens_after", "n_pieces", "n_recut"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), edits.cast(EDITS).alias("edits"))
    return map_batches(rows, run, f"`{id_col}` {kind}, n_tokens long, n_tokens_after long, n_pieces long, n_recut long")


def usual_edits(text: Column) -> Column:
    """The query's edits: a mark in the middle, a cut of up to 40 code points after a quarter, and a new ending."""
    n = F.coalesce(F.length(text), F.lit(0))
    quarter, half = F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int")
    edit = lambda a, b, t: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit(t).alias("text"))
    return F.array(edit(half, half, " [edited]\n"), edit(quarter, F.least(quarter + 40, half), ""), edit(F.greatest(n - 1, half), n, "..."))
