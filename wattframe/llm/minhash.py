"""MinHash near-dedup with odd sketches.

1. One pass over whole texts: distinct word shingles as 64-bit hashes, HASHES minimums of them, ROWS to a band, and the
   odd sketch, a parity bitmap in which each minimum flips one bit. Texts are not shuffled.
2. Documents of one shingle set (a 128-bit digest) meet in a representative, by an aggregate with partial sums.
3. Band buckets of two representatives or more give candidates. Inside a bucket nobody pairs all members. Stars come
   first: members are held against the bucket's leader, first the one that meets most others, then one drawn from
   the bucket's largest component. What isn't joined after that is screened in blocks of bounded size: members outside
   the bucket's largest component against all members of other components, each pair in its first common band only.
4. The XOR population count of two odd sketches estimates how many minimums differ; pairs clearly under the threshold
   go. The rest is confirmed exactly on full shingle sets, which are read again for crowded buckets' members only. A
   block tells which members have screened pairs, the sets of these meet in blocks again, and the links that join
   components come out: pairs of a group that is alike but under the threshold are looked at and never become rows.
5. Components by minimum-label propagation over confirmed links, settled in the shared folder each round.

At a similarity of exactly 0.75 all 70 bands miss a pair with a chance of 1e-6 and the sketch rejects it with 1e-7;
above 0.75 both fall fast.

Words: A-Z lower-cased, then runs of anything but white space (U+0009-U+000D, U+0020). Under five words the whole
sequence is the one shingle. Null or wordless texts have no shingles and link with nothing. Very long texts count
whole. Repeated rows of one id keep a row each and share the union of their links. A row with a null id links with
nothing: its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import LOWER, as_int64, discard, hash_words, map_batches, mix, settle, temporary, text_steps, words_of

SHINGLE = 5
ROWS, BANDS = 6, 70
HASHES = ROWS * BANDS
SKETCH_BITS = 1024
#: Bits by which the odd sketches of two documents at the threshold may differ: mean 172, standard deviation 15.5, and 5.2 of these.
MOST_BITS = 253
#: Members of one block when a bucket is screened.
OUTER, INNER = 1024, 4096
#: Shingles of each side of a block when its pairs are confirmed.
BLOCK_SHINGLES = 1 << 20
#: Bytes of text that one step sketches.
STEP = 1 << 20

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[9:14] = IS_WORD[32] = False

_rng = np.random.default_rng(75)
_TIMES = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_PLACE = _rng.integers(0, 2**63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, joined, and the size of each row's set."""
    data = LOWER[data]
    starts, ends, counts = words_of(data, offsets, IS_WORD)
    words = hash_words(data, starts, ends)
    made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    begin = np.cumsum(counts) - counts
    to = np.cumsum(made)
    out = np.zeros(int(to[-1]) if len(to) else 0, dtype=np.uint64)
    at = np.repeat(begin, made) + np.arange(len(out)) - np.repeat(to - made, made)
    size = np.repeat(np.minimum(counts, SHINGLE), made)
    for k in range(SHINGLE):
        if size.min(initial=SHINGLE) >= SHINGLE:
            out += words[at + k] * _PLACE[k]
        else:
            has = size > k
            out[has] += words[at[has] + k] * _PLACE[k]
    out = mix(out + size.astype(np.uint64) * _PLACE[SHINGLE])
    for b, n in zip(to - made, made, strict=True):
        if n > 1:
            out[b : b + n].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[(to - made)[made > 0]] = True
    total = np.r_[0, np.cumsum(new)]
    return out[new], np.diff(total[np.r_[0, to]])


def sketches(sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set digests (two columns), band hashes and odd sketches of rows that have shingles."""
    begin = np.cumsum(sizes) - sizes
    low = np.empty((HASHES, len(sizes)), dtype=np.uint32)
    high = (sets >> np.uint64(32)).astype(np.uint32)
    work = np.empty_like(high)
    for j in range(HASHES):
        np.multiply(high, _TIMES[j], out=work)
        work += _PLUS[j]
        low[j] = np.minimum.reduceat(work, begin)
    low = low.T.astype(np.uint64)
    digest = np.stack([np.add.reduceat(mix(sets ^ _SALT[0]), begin), np.add.reduceat(mix(sets + _SALT[1]), begin)], axis=1)
    bands = mix((mix(low + _SALT) * _BAND).reshape(-1, BANDS, ROWS).sum(axis=2) + _SALT[:BANDS])
    bit = (mix(low ^ _BAND) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount((bit + np.arange(len(sizes))[:, None] * SKETCH_BITS).ravel(), minlength=len(sizes) * SKETCH_BITS) & 1
    odd = np.packbits(flips.astype(np.uint8).reshape(len(sizes), SKETCH_BITS), axis=1).view(np.uint64)
    return digest, bands, odd


def _lists(values: np.ndarray, has: np.ndarray) -> pa.Array:
    """A list of fixed width for rows that have one, else null."""
    offsets = np.r_[0, np.cumsum(has * values.shape[1])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.r_[~has, False]), pa.array(as_int64(np.ascontiguousarray(values).ravel())))


def sketch_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, digest (two longs), bands and sketch; the last three null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(1), STEP):
                sets, sizes = shingle_sets(data, offsets)
                has = sizes > 0
                digest, bands, odd = sketches(sets, sizes[has]) if has.any() else (np.zeros((0, k), np.uint64) for k in (2, BANDS, SKETCH_BITS // 64))
                ids = batch.column(0).slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), _lists(digest, has), _lists(bands, has), _lists(odd, has)], names=["id", "n_shingles", "digest", "bands", "sketch"])

    return map_batches(docs.select(id_col, text_col), run, f"id {docs.schema[id_col].dataType.simpleString()}, n_shingles long, digest array<long>, bands array<long>, sketch array<long>")


def set_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and the full shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(1), STEP):
                sets, sizes = shingle_sets(data, offsets)
                values = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(as_int64(sets)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sizes)), values], names=["id", "shingles"])

    return map_batches(docs.select(id_col, text_col), run, f"id {docs.schema[id_col].dataType.simpleString()}, shingles array<long>")


def connected(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for ids with links (u, v).

    Each round gives an id the smallest label around, hooks what the ids of a label met onto the label's own id as well,
    and then takes the label of that label, so that whole regions join and rounds grow with the logarithm of a path's
    length. Labels only fall and stay inside their component; when none moves, neighbours agree.
    """
    both = settle(links.select("u", "v").union(links.select(F.col("v"), F.col("u"))).distinct(), "links")
    labels = settle(both.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("c")), "labels")
    while True:
        near = both.join(labels, both.v == labels.id).groupBy("u").agg(F.min("c").alias("m"))
        step = settle(labels.select("id", "c").join(near, F.col("id") == F.col("u")).select("id", "c", F.least("c", "m").alias("n")), "near")
        hooks = step.groupBy("c").agg(F.min("n").alias("h")).filter("h < c").select(F.col("c").alias("own"), "h")
        hooked = step.join(hooks, F.col("id") == F.col("own"), "left").select("id", "c", F.least("n", "h").alias("n"))
        jump = labels.select(F.col("id").alias("n"), F.col("c").alias("r"))
        nxt = settle(hooked.join(jump, "n", "left").select("id", F.least("r", "n").alias("c"), (F.least("r", "n") != F.col("c")).alias("moved")), "labels")
        discard(labels)
        discard(step)
        labels = nxt
        if nxt.filter("moved").isEmpty():
            discard(both)
            return labels.select("id", F.col("c").alias("component"))


def merged(component: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) after more links: only components that a link joins are labelled anew."""
    known = component.union(links.select(F.col("u"), F.col("u")).union(links.select(F.col("v"), F.col("v"))).distinct().join(component, F.col("u") == F.col("id"), "left_anti"))
    cross = links.join(known.toDF("u", "cu"), "u").join(known.toDF("v", "cv"), "v").filter("cu <> cv").select(*_pair("cu", "cv")).distinct()
    anew = connected(cross).toDF("component", "label")
    return settle(known.join(anew, "component", "left").select("id", F.coalesce("label", "component").alias("component")), "component")


def screen(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The pairs (u, v) that sizes and odd sketches let through, with the bits by which these differ."""
    side = heads.select("id", "n_shingles", "sketch")
    near = pairs.join(side.toDF("u", "nu", "su"), "u").join(side.toDF("v", "nv", "sv"), "v")
    apart = sum((F.bit_count(F.col("su")[k].bitwiseXOR(F.col("sv")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    return near.filter(100 * F.least("nu", "nv") >= 75 * F.greatest("nu", "nv")).select("u", "v", apart.alias("apart")).filter(F.col("apart") <= MOST_BITS)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose similarity is 0.75 or more, exactly, on full sets."""
    held = pairs.select("u", "v").join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
    both = F.size(F.array_intersect("a", "b"))
    return held.withColumn("both", both).filter(100 * F.col("both") >= 75 * (F.size("a") + F.size("b") - F.col("both"))).select("u", "v")


def _pair(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("u"), F.greatest(a, b).alias("v")


def _open(members: DataFrame, component: DataFrame) -> DataFrame:
    """band, id, c and main (the largest component there) of members of buckets that hold several components."""
    inside = members.select("band", "id").join(component, "id", "left").select("band", "id", F.coalesce("component", "id").alias("c"))
    parts = inside.groupBy("band", "c").count()
    mixed = parts.groupBy("band").agg(F.count("*").alias("k"), F.max_by("c", F.struct("count", "c")).alias("main")).filter("k > 1")
    return inside.join(mixed.select("band", "main"), "band")


def _blocks(inside: DataFrame, heads: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Members outside their bucket's largest component and all members, each side dealt to blocks (band, i, j) in which any two of
    them meet; with `most` a side's part holds about so many shingles."""
    wide = inside.join(heads, "id")
    off = F.col("c") != F.col("main")
    heavy = lambda cond: F.sum(F.when(cond, F.col("n_shingles"))) / most if most else F.lit(0.0)
    parts = lambda cond, rows: F.ceil(F.greatest(F.count_if(cond) / rows, heavy(cond))).cast("int")
    wide = wide.join(wide.groupBy("band").agg(parts(off, OUTER).alias("outer"), parts(F.lit(True), INNER).alias("inner")), "band")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    outside = wide.filter("c <> main").withColumn("i", own("outer")).withColumn("j", every("inner"))
    outside = outside.select(*[F.col(c).alias(c) for c in outside.columns])
    return outside, wide.withColumn("j", own("inner")).withColumn("i", every("outer"))


def _near(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Of each outside member the block's members of other components that sizes and sketches let through, each pair in its first common band."""

    def rows(t: pa.Table) -> tuple[np.ndarray, ...]:
        flat = lambda c, n: t[c].combine_chunks().flatten().to_numpy().reshape(-1, n)
        return t["id"].to_numpy(), t["c"].to_numpy(), t["n_shingles"].to_numpy(), flat("bands", BANDS), flat("sketch", SKETCH_BITS // 64), (t["c"].to_numpy() == t["main"].to_numpy())

    if not left.num_rows or not right.num_rows:
        return
    band = left["band"][0].as_py()
    ids, comps, sizes, bands, odd, _ = rows(left)
    ids2, comps2, sizes2, bands2, odd2, main2 = rows(right)
    for k in range(len(ids)):
        ok = (comps2 != comps[k]) & (main2 | (ids2 < ids[k])) & (100 * np.minimum(sizes2, sizes[k]) >= 75 * np.maximum(sizes2, sizes[k]))
        at = np.flatnonzero(ok)
        # Unsigned: of a negative number bitwise_count takes the absolute value's bits.
        at = at[np.bitwise_count((odd2[at] ^ odd[k]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= MOST_BITS]
        yield k, at[(bands2[at] == bands[k]).argmax(axis=1) == (bands[k] == band).argmax()]


def suspects(inside: DataFrame, heads: DataFrame) -> DataFrame:
    """The members (band, id, c, main) that a screened pair of different components has: they, not the pairs, are told."""
    outside, inner = _blocks(inside, heads.select("id", "n_shingles", "bands", "sketch"))
    kinds = {f.name: f.dataType.simpleString() for f in inside.schema}

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        here, there = np.zeros(left.num_rows, bool), np.zeros(right.num_rows, bool)
        for k, at in _near(left, right):
            here[k] = len(at) > 0
            there[at] = True
        names = ["band", "id", "c", "main"]
        return pa.concat_tables([left.select(names).filter(pa.array(here)), right.select(names).filter(pa.array(there))])

    return outside.groupBy("band", "i", "j").cogroup(inner.groupBy("band", "i", "j")).applyInArrow(block, ", ".join(f"{c} {kinds[c]}" for c in ("band", "id", "c", "main"))).distinct()


def link_blocks(inside: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between components of the same bucket, exact on full sets. A block tells one link for two components that it joins
    and looks at no pair that its links connect already: at most one link less than it has members, whatever pairs it has looked at."""
    kind = heads.schema["id"].dataType.simpleString()
    full = sets.join(inside.select("id").distinct(), "id", "left_semi").distinct()
    outside, inner = _blocks(inside, heads.select("id", "n_shingles", "bands", "sketch").join(full, "id"), BLOCK_SHINGLES)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        u, v = [], []
        if left.num_rows and right.num_rows:
            ids, ids2 = left["id"].to_numpy(), right["id"].to_numpy()
            size, size2 = (t["shingles"].combine_chunks().value_lengths().to_numpy().astype(np.int64) for t in (left, right))
            word = np.unique(np.concatenate([t["shingles"].combine_chunks().flatten().to_numpy() for t in (left, right)]), return_inverse=True)[1]
            begin, begin2 = np.cumsum(size) - size, size.sum() + np.cumsum(size2) - size2
            root = np.unique(np.concatenate([left["c"].to_numpy(), right["c"].to_numpy()]), return_inverse=True)[1]
            root, root2 = root[: len(ids)], root[len(ids) :]
            mine = np.zeros(len(word), dtype=bool)
            for k, at in _near(left, right):
                at = at[root2[at] != root[k]]
                if not len(at):
                    continue
                own = word[begin[k] : begin[k] + size[k]]
                mine[own] = True
                to = np.cumsum(size2[at])
                both = np.add.reduceat(mine[word[np.repeat(begin2[at] - to + size2[at], size2[at]) + np.arange(to[-1])]], to - size2[at], dtype=np.int64)
                mine[own] = False
                for m in at[100 * both >= 75 * (size[k] + size2[at] - both)]:
                    if (old := root2[m]) != root[k]:
                        u.append(min(ids[k], ids2[m]))
                        v.append(max(ids[k], ids2[m]))
                        root2[root2 == old] = root[k]
                        root[root == old] = root[k]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return outside.groupBy("band", "i", "j").cogroup(inner.groupBy("band", "i", "j")).applyInArrow(block, f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_shingles, component_id (smallest id reachable over links), kept. Ids are integers.

    The result is settled in the shared folder, the tables on the way to it are deleted.
    """
    with temporary(docs.sparkSession) as keep:
        return keep(settle(_near_duplicates(docs, id_col, text_col), "near-duplicates"))


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = settle(sketch_documents(docs, "id", "text"), "sketches")
    some = sketched.filter("n_shingles > 0 and id is not null")
    # Settled, so that the join's sides are plain shuffles and a digest that many documents share can be split.
    classes = settle(some.groupBy("digest").agg(F.min("id").alias("class"), F.count("*").alias("n")).filter("n > 1").drop("n"), "shared")
    classed = settle(some.select("id", "digest").join(classes, "digest", "left").select("id", F.coalesce("class", "id").alias("class")), "classes")
    # Classes that share an id are linked: repeated rows of one id share the union of their links.
    several = classed.groupBy("id").agg(F.min("class").alias("u"), F.max("class").alias("last")).filter("u < last").select("id", "u")
    shared = classed.join(several, "id").filter("class > u").select("u", F.col("class").alias("v")).distinct()
    heads = some.join(classed.filter("id = class").select("id").distinct(), "id", "left_semi").dropDuplicates(["id", "digest"])
    buckets = heads.select("id", F.explode("bands").alias("band"))
    crowded = buckets.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = settle(buckets.join(crowded, "band"), "members")
    reach = settle(members.groupBy("id").agg(F.sum("n").alias("reach")), "reach")
    heads = settle(heads.join(reach.select("id"), "id", "left_semi"), "heads")
    # The same plan at every size: text meets the crowded ids by a shuffle.
    sets = settle(set_documents(docs.join(reach.select("id").hint("merge"), "id", "left_semi"), "id", "text"), "sets")

    leaders = members.join(reach, "id").groupBy("band").agg(F.max_by("id", F.struct("reach", "id")).alias("leader"))
    stars = members.join(leaders, "band").filter("id <> leader").select(*_pair("id", "leader")).distinct()
    links = settle(confirm(screen(stars, heads), sets).union(shared), "links")
    component = connected(links)

    inside = settle(_open(members, component), "open")
    drawn = inside.filter("c = main").groupBy("band").agg(F.min_by("id", F.xxhash64("id", "band")).alias("leader"))
    again = inside.filter("c <> main").join(drawn, "band").select(*_pair("id", "leader"), F.col("id").alias("of")).distinct()
    best = F.row_number().over(Window.partitionBy("of").orderBy("apart", "u", "v"))
    again = screen(again, heads.select("id", "n_shingles", "sketch")).join(again, ["u", "v"]).withColumn("place", best).filter("place <= 3").select("u", "v").distinct()
    component = merged(component, settle(confirm(again, sets), "links"))

    inside = settle(_open(members, component), "open")
    found = settle(suspects(inside, heads), "suspects")
    component = merged(component, settle(link_blocks(found, heads, sets), "links"))

    whole = classed.join(component.withColumnRenamed("id", "class"), "class", "left").groupBy("id").agg(F.min(F.coalesce("component", "class")).alias("component"))
    out = sketched.select("id", "n_shingles").join(whole, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
