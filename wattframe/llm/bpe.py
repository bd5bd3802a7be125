"""BPE encoding and decoding by a contiguous rank array.

Each pre-token is a row of parts: a boundary list and, beside it, the merge rank of every adjacent pair. The
encoder scans the rank array for its minimum, deletes that boundary, and refreshes the two neighbouring ranks,
until no pair has a rank. Pre-tokens are short, so scanning a small array is cheaper than a heap. Distinct
pre-tokens are few beside all of them, so a bounded memo holds encoded ones within a task.

The vocabulary file is a parameter: a JSON file of the public `tokenizers` format with NFC, white-space and
lower-case normalisers, a regular-expression split and a byte-level alphabet. It is opened by path on the driver
and sent to executors as one broadcast of fixed size (a vocabulary, not data).

Texts: null counts as empty and gives no tokens. Very long texts are encoded whole. Repeated rows and ids give a row each,
an empty table an empty result. Extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wattframe.llm.common import map_batches

#: Most pre-tokens that a task's memo holds; at the bound it starts anew.
MEMO = 400_000
#: Most adjacent ranks that are scanned one merge at a time where a vocabulary lets longer pre-tokens merge a whole rank in each scan.
SHORT = 64


def byte_alphabet() -> list[str]:
    """The printable character of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    out = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [out[b] for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and added tokens of one vocabulary file."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.special = [c for c in self.added]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        # Merge ranks by id pair, one integer key: (left << 32) | right.
        self.rank: dict[int, int] = {}
        self.merged: dict[int, int] = {}
        for n, (a, b) in enumerate(pairs):
            key = self.ids[a] << 32 | self.ids[b]
            if key not in self.rank:
                self.rank[key] = n
                self.merged[key] = self.ids[a + b]
        #: Whether a merge never makes a pair that ranks before it: then all pairs of the lowest rank may merge in one scan.
        first: dict[int, int] = {}
        for key, n in self.rank.items():
            for part in (key >> 32, key & 0xFFFFFFFF):
                first[part] = min(n, first.get(part, n))
        self.ordered = all(first.get(self.merged[key], n + 1) > n for key, n in self.rank.items())
        alphabet = byte_alphabet()
        self.byte_id = [self.ids[c] for c in alphabet]
        self.byte_end = [self.ids[c + self.suffix] for c in alphabet]


@functools.lru_cache(maxsize=2)
def vocabulary(source: str) -> Vocabulary:
    """Parsed once in a worker, whatever the number of its tasks."""
    return Vocabulary(source)


class Encoder:
    """Encodes texts of one task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")").split
        self.space = regex.compile(r"\s+")
        self.memo: dict[str, tuple[int, ...]] = {}

    def word(self, token: str) -> tuple[int, ...]:
        """Contiguous rank array over one pre-token."""
        raw = token.encode("utf-8")
        ids = [self.v.byte_id[b] for b in raw[:-1]] + [self.v.byte_end[raw[-1]]]
        none = 1 << 60
        rank, merged = self.v.rank.get, self.v.merged
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        if len(ranks) > SHORT and self.v.ordered:
            return self.long_word(ids, ranks)
        while ranks:
            low = min(ranks)
            if low == none:
                break
            at = ranks.index(low)
            ids[at] = merged[ids[at] << 32 | ids[at + 1]]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 32 | ids[at], none)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 32 | ids[at + 1], none)
        return tuple(ids)

    def long_word(self, ids: list[int], ranks: list[int]) -> tuple[int, ...]:
        """The same rank array for a very long pre-token: one pass deletes every boundary of the lowest rank, left to right.

        Merges of one rank are one pair. Merging its occurrences from the left in a pass equals repeated scans where no pair
        of the new part ranks before it, which holds for an ordered vocabulary; others take the plain loop at any length.
        """
        none = 1 << 60
        rank, merged = self.v.rank.get, self.v.merged
        while ranks:
            low = min(ranks)
            if low == none:
                break
            out, i, n = [], 0, len(ids)
            while i < n:
                if i < n - 1 and ranks[i] == low:
                    out.append(merged[ids[i] << 32 | ids[i + 1]])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
            ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        return tuple(ids)

    def plain(self, text: str, out: list[int]) -> None:
        text = self.space.sub(" ", text if text.isascii() else unicodedata.normalize("NFC", text))
        text = text.lower() if text.isascii() else lower(text)
        memo = self.memo
        for token in self.find(text):
            ids = memo.get(token)
            if ids is None:
                if len(memo) >= MEMO:
                    memo.clear()
                ids = self.word(token)
                if len(token) <= SHORT:
                    memo[token] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        if not any(c in text for c in self.v.special):
            self.plain(text, out)
            return out
        for part in self.split(text):
            if part in self.v.added:
                out.append(self.v.added[part])
            elif part:
                self.plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library does where the file names no decoder: the tokens, joined by one space."""
        names = self.v.names
        return " ".join([names[i] for i in ids])


def lower(text: str) -> str:
    """Lower case of each character by itself (no context rule for a final sigma)."""
    return "".join([c.lower() for c in text]) if "Σ" in text else text.lower()


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encodes and decodes every text. One row per input row, in the same partitions: no shuffle.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also ids (array<int>) and decoded.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(source.value))
        for batch in batches:
            counts, shas, back, kept, texts = [], [], [], [], []
            for value in batch.column(1):
                ids = encoder.encode(value.as_py())
                decoded = encoder.decode(ids)
                counts.append(len(ids))
                shas.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if keep_ids:
                    kept.append(ids)
                    texts.append(decoded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(kept, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")
    return map_batches(docs.select(id_col, text_col), run, schema)
