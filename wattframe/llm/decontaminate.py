"""Benchmark decontamination by an FM-index per training shard.

A shard is the texts of one task (or of as many rows as fill SHARD symbols). Its index covers every run of words
that could hold a test phrase: words outside the benchmark's vocabulary become one separator, and runs shorter
than the shortest phrase hold none. Over these symbols the task sorts suffixes, derives the Burrows-Wheeler
transform, and answers ranks with a wavelet matrix. All phrases are searched backwards at once; rows of their final
ranges walk to sampled suffix positions; the occurrences' spans merge per document.

The benchmark goes to executors in blocks of some BLOCK_CHARS characters, one pass over the documents for each, so what is
broadcast doesn't grow with the corpus or, beyond a block, with the benchmark. An item is never cut: a longer one is a block
of its own size. A document's row carries its finds from pass to pass. Documents are not shuffled.

Words: A-Z lower-cased, then runs of digits, a-z and code points from U+0080. Null texts have no words; items
without words or with a null id take no part; repeated item ids count once; very long texts are indexed whole. Each row
of documents gives one row with its own finds: repeated and null ids are not joined. Extra columns are carried or not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattframe.llm.common import LOWER, discard, hash_words, map_batches, settle, text_steps, words_of

WINDOW = 13
#: Symbols of one index.
SHARD = 1_000_000
#: Bytes of documents that a shard holds on to until its finds are known.
HELD_BYTES = 64 << 20
#: Characters of benchmark text in one broadcast block; the driver collects and indexes one block at a time.
BLOCK_CHARS = 8_000_000
#: Text positions from one sampled suffix to the next.
SAMPLE = 8

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def _ranks(words: np.ndarray, item: np.ndarray, width: int) -> np.ndarray:
    """Equal numbers for equal windows of `width` words that start at a place; meant for places whose window ends inside its item."""
    rank, n = words.astype(np.int64), 1
    while n < width:
        step = min(n, width - n)  # overlapping halves: their equality is that of the whole
        after = np.zeros_like(rank)
        after[:-step] = np.where(item[step:] == item[:-step], rank[step:] + 1, 0)
        rank = np.unique(rank * (after.max(initial=0) + 1) + after, return_inverse=True)[1].astype(np.int64)
        n += step
    return rank


class Phrases:
    """The distinct windows of some benchmark items. Symbols: 0 ends a shard, 1 separates, words from 2.

    A window is a start in the items' joined symbols and a size. All arrays: some 30 bytes for each benchmark word.
    """

    def __init__(self, ids: list, texts: list[str | None], window: int) -> None:
        self.ids = ids
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, data, offsets in text_steps(pa.array(texts, pa.large_string())):
            data = LOWER[data]
            starts, ends, many = words_of(data, offsets, IS_WORD)
            hashes.append(hash_words(data, starts, ends))
            counts.append(many)
        many = np.concatenate(counts)
        self.vocabulary, symbols = np.unique(np.concatenate(hashes), return_inverse=True)
        self.text = (symbols + 2).astype(np.int32)
        item = np.repeat(np.arange(len(many)), many)
        begin = np.cumsum(many) - many
        size = np.minimum(many, window)[item]
        place = np.arange(len(item))
        whole = place + size <= (begin + many)[item]
        first, owner, at = [], [], 0
        starts = []
        for n in np.unique(size):
            here = np.flatnonzero(whole & (size == n))
            rank = _ranks(self.text, item, int(n))[here]
            _, one, number = np.unique(rank, return_index=True, return_inverse=True)
            starts.append(here[one])
            first.append(np.full(len(one), n))
            owner.append(np.stack([number + at, item[here]]))
            at += len(one)
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.sizes = np.concatenate(first).astype(np.int64) if first else np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(owner, axis=1), axis=1) if owner else np.zeros((2, 0), np.int64)
        self.owners = pairs[1]
        self.owner_at = np.r_[0, np.cumsum(np.bincount(pairs[0], minlength=at))].astype(np.int64)
        self.shortest = int(self.sizes.min()) if at else 0
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.vocabulary & np.uint64((1 << 20) - 1)] = True


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit plane per bit of the alphabet, stably parted by that bit."""

    def __init__(self, sequence: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(place), place
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = (symbol >> (self.bits - 1 - level)) & 1 == 1
            a, b = ones[low], ones[high]
            low = np.where(bit, zeros + a, low - a)
            high = np.where(bit, zeros + b, high - b)
        return high - low

    def access(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros_like(place)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            a = ones[place]
            bit = ones[place + 1] - a
            out = out << 1 | bit
            place = np.where(bit == 1, zeros + a, place - a)
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; the text ends with a symbol smaller than all others."""
    order = np.argsort(text, kind="stable")
    rank = np.zeros(len(text), dtype=np.int64)
    rank[order] = np.r_[0, np.cumsum(text[order][1:] != text[order][:-1])]
    width = 1
    while rank.max() < len(text) - 1:
        key = rank * (len(text) + 1)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank[order] = np.r_[0, np.cumsum(sorted_key[1:] != sorted_key[:-1])]
        width *= 2
    return order


class FmIndex:
    def __init__(self, text: np.ndarray, sigma: int) -> None:
        order = suffix_array(text)
        bwt = text[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))].astype(np.int64)
        self.tree = WaveletMatrix(bwt, sigma)
        self.sampled = order % SAMPLE == 0
        self.sample_at = np.r_[0, np.cumsum(self.sampled)]
        self.samples = order[self.sampled]
        self.length = len(text)

    def search(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (starts and sizes in symbols) that occur, with the range of rows of each."""
        alive = np.arange(len(sizes))
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.length, np.int64)
        for back in range(1, int(sizes.max(initial=0)) + 1):
            here = sizes[alive] >= back
            phrase = alive[here]
            c = symbols[starts[phrase] + sizes[phrase] - back].astype(np.int64)
            low[phrase] = self.first[c] + self.tree.rank(c, low[phrase])
            high[phrase] = self.first[c] + self.tree.rank(c, high[phrase])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return alive, low[alive], high[alive]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions: backward steps from each row to a sampled suffix."""
        out = np.full(len(rows), -1, dtype=np.int64)
        todo, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            done = self.sampled[rows]
            out[todo[done]] = self.samples[self.sample_at[rows[done]]] + steps
            todo, rows = todo[~done], rows[~done]
            c = self.tree.access(rows)
            rows = self.first[c] + self.tree.rank(c, rows)
            steps += 1
        return out


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start + 1, ... of the given sizes."""
    begin = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(begin - starts, sizes)


class Shard:
    """Gathers the symbols of rows, then finds their hits."""

    def __init__(self, phrases: Phrases) -> None:
        self.p = phrases
        self.n_words, self.parts, self.rows, self.size = [], [], 0, 0

    def add(self, texts: pa.Array) -> None:
        for first, data, offsets in text_steps(texts):
            data = LOWER[data]
            starts, ends, counts = words_of(data, offsets, IS_WORD)
            self.n_words.append(counts)
            if self.p.shortest and len(starts):
                self.keep(first, data, offsets, starts, ends, counts)
        self.rows += len(texts)

    def keep(self, first: int, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> None:
        hashes = hash_words(data, starts, ends)
        row = np.repeat(np.arange(len(counts)), counts)
        inside = self.p.maybe[hashes & np.uint64(len(self.p.maybe) - 1)]
        for exact in (False, True):
            if exact:
                some = np.flatnonzero(inside)
                at = np.minimum(np.searchsorted(self.p.vocabulary, hashes[some]), len(self.p.vocabulary) - 1)
                inside[some] = self.p.vocabulary[at] == hashes[some]
            begin = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | (row[1:] != row[:-1])])
            end = np.flatnonzero(inside & np.r_[~inside[1:] | (row[1:] != row[:-1]), True]) + 1
            long = end - begin >= self.p.shortest
            begin, end = begin[long], end[long]
            inside[:] = False
            inside[spread(begin, end - begin)] = True
        if not len(begin):
            return
        sizes = end - begin
        word = spread(begin, sizes)
        gap = np.cumsum(sizes + 1) - 1  # places of the separators
        out = np.ones(int(gap[-1]) + 1, dtype=np.int64)
        slot = np.ones(len(out), dtype=bool)
        slot[gap] = False
        out[slot] = np.searchsorted(self.p.vocabulary, hashes[word]) + 2
        where = np.full((5, len(out)), -1, dtype=np.int64)
        lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        base = lead[offsets[row[word]]]
        before = np.cumsum(counts) - counts
        where[:, slot] = self.rows + first + row[word], word, lead[starts[word]] - base, lead[ends[word]] - base, before[row[word]]
        self.parts.append((out, where))
        self.size += len(out)

    def hits(self) -> tuple[np.ndarray, list, list, np.ndarray]:
        """n_hit, item numbers and merged spans (code points) of each row; n_words."""
        n_hit = np.zeros(self.rows, dtype=np.int64)
        items, spans = [()] * self.rows, [()] * self.rows
        n_words = np.concatenate(self.n_words) if self.n_words else np.zeros(0, np.int64)
        if not self.parts:
            return n_hit, items, spans, n_words
        text = np.r_[np.concatenate([x for x, _ in self.parts]), 0]
        row, word, start, end, first = np.concatenate([w for _, w in self.parts], axis=1)
        index = FmIndex(text, len(self.p.vocabulary) + 2)
        found, low, high = index.search(self.p.text, self.p.starts, self.p.sizes)
        if not len(found):
            return n_hit, items, spans, n_words
        phrase = np.repeat(found, high - low)
        place = index.locate(spread(low, high - low))
        cover = np.zeros(len(text) + 1, dtype=np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + self.p.sizes[phrase], -1)
        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        np.add.at(n_hit, row[hit], 1)
        joined = np.flatnonzero((np.diff(hit) != 1) | (np.diff(row[hit]) != 0))
        for a, b in zip(hit[np.r_[0, joined + 1]], hit[np.r_[joined, len(hit) - 1]], strict=True):
            spans[row[a]] += ((int(start[a]), int(end[b]), int(word[a] - first[a]), int(word[b] - first[b]) + 1),)
        many = self.p.owner_at[phrase + 1] - self.p.owner_at[phrase]
        owner = self.p.owners[spread(self.p.owner_at[phrase], many)]
        for r, item in np.unique(np.stack([np.repeat(row[place], many), owner], axis=1), axis=0):
            items[r] += (int(item),)
        return n_hit, items, spans, n_words


SPAN = ("start", "end", "first_word", "end_word")
SPANS = pa.list_(pa.struct([(k, pa.int32()) for k in SPAN]))
#: What the scan adds at the end of the documents' columns, under these names or others that they leave free.
FOUND = {"n_words": "long", "n_hit": "long", "items": "array<string>", "spans": "array<struct<start:int,end:int,first_word:int,end_word:int>>"}


def free_names(columns: list[str]) -> list[str]:
    """A name for each column of FOUND that no column of the caller has, in any case of its letters."""
    used, out = {c.lower() for c in columns}, []
    for name in FOUND:
        while name in used:
            name = f"found_{name}"
        out.append(name)
    return out


def joined_spans(one: list[tuple], more: list[tuple]) -> list[tuple]:
    """Spans of two block's finds in a document; those that overlap or adjoin become one."""
    out: list[tuple] = []
    for x in sorted([*one, *more], key=lambda x: x[2]):
        if out and x[2] <= out[-1][3]:
            start, end, first, last = out[-1]
            out[-1] = (start, max(end, x[1]), first, max(last, x[3]))
        else:
            out.append(x)
    return out


def _scan(docs: DataFrame, ids: list, texts: list, window: int, text_col: str, names: list[str]) -> DataFrame:
    """The rows of docs with what a block's phrases hit, joined to what earlier blocks hit. No shuffle, a row for each row.

    names: of the columns of finds; the last columns of docs already where an earlier block made them.
    """
    phrases = docs.sparkSession.sparkContext.broadcast(Phrases(ids, texts, window))
    before = docs.columns[-len(names) :] == names
    at, n = docs.columns.index(text_col), len(docs.columns) - before * len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = phrases.value

        def result(shard: Shard, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n_hit, items, spans, n_words = shard.hits()
            row = 0
            for batch in held:
                rows = slice(row, row + batch.num_rows)
                row += batch.num_rows
                hit, named, where = n_hit[rows], [{str(p.ids[i]) for i in x} for x in items[rows]], spans[rows]
                if before:
                    old = [[tuple(y[k] for k in SPAN) for y in x] for x in batch.column(n + 3).to_pylist()]
                    named = [x | set(y) for x, y in zip(named, batch.column(n + 2).to_pylist(), strict=True)]
                    where = [joined_spans(x, y) for x, y in zip(old, where, strict=True)]
                    hit = np.array([sum(x[3] - x[2] for x in y) for y in where], dtype=np.int64)
                found = [pa.array(n_words[rows]), pa.array(hit), pa.array(list(map(sorted, named)), pa.list_(pa.string())), pa.array([[dict(zip(SPAN, y, strict=True)) for y in x] for x in where], SPANS)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *found], names=[*batch.schema.names[:n], *names])

        shard, held, size = Shard(p), [], 0
        for batch in batches:
            shard.add(batch.column(at))
            held.append(batch)
            size += batch.nbytes
            if shard.size >= SHARD or size >= HELD_BYTES:
                yield from result(shard, held)
                shard, held, size = Shard(p), [], 0
        if held:
            yield from result(shard, held)

    found = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in zip(names, FOUND.values(), strict=True)))
    return map_batches(docs, run, StructType([*docs.schema.fields[:n], *found.fields]))


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows and columns of docs, and four more at the end: n_words, n_hit, items (ids as strings, sorted), spans to remove.

    Where docs has a column of such a name, the new one gets another (see free_names).

    Rows keep their own finds from block to block, so every row of docs gives one row whatever its id and whatever the
    number of blocks. With several blocks each pass's rows are settled in the shared folder for the next pass.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("words")).filter("item is not null and words is not null")
    chars = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    out, used, names = docs, None, free_names(docs.columns)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == block).collect()
        out = _scan(out, [r.item for r in rows], [r.words for r in rows], window, text_col, names)
        if block < blocks - 1:
            done = settle(out, "decontaminated")
            if used is not None:
                discard(used)
            out = used = done
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_words, n_hit, items (ids as strings, sorted), spans to remove (code points, end exclusive).

    A window is `window` consecutive words of an item, or all of a shorter item.
    """
    found = scan_documents(docs.select(id_col, text_col), benchmark, window, text_col, item_col, item_text_col)
    return found.select(id_col, *[F.col(c).alias(name) for c, name in zip(found.columns[-len(FOUND) :], FOUND, strict=True)])


def is_contaminated(n_words: str = "n_words", n_hit: str = "n_hit") -> Column:
    """The contract's rule: windows hit a twentieth of the words or more."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"), "spans",
    )
