"""Near-duplicate documents by BagMinHash.

A document is the multiset of its 5-word shingles (all its words, if fewer);
two documents are linked if their weighted Jaccard similarity, the sum of
minima over the sum of maxima of the multiplicities, is ``SIMILARITY`` or more.
Classes are the connected components of the links.

Signatures.  A multiplicity is discretised into unit levels, and levels into
dyadic blocks 1, 2, 3-4, 5-8, ...  Every (shingle, block) has a Poisson
process whose rate is the number of its levels; a point carries a component of
the signature and a level, both hashed, and counts if the multiplicity reaches
the level.  The first point of each component is its signature value, so two
documents agree in a component with the probability of their weighted Jaccard
similarity.  Blocks a document cannot reach are never entered, and a process
stops once its time lies beyond the last component of its document.

Candidates share one of ``BANDS`` bands of ``ROWS`` components.  The chance to
miss a pair of similarity 0.8 is (1 - 0.8**4)**20 = 3e-5, and less above.

1. equal texts collapse to one (128-bit hash, map-side minimum);
2. each bucket pairs its members with the one that meets most others in all
   its buckets; a pair whose signatures are far apart is let go, the others are
   verified on whole texts;
3. buckets that hold several components after that are compared *between*
   components, in blocks of bounded size inside tasks, until components join;
   at most one link for each component comes out.  Most of a large group is one
   component by then and is never compared with itself.

So every link between candidates is found or follows from links found, without
listing the pairs of a group.  Signatures are far apart if they agree in fewer
than ``LEAST_AGREEING`` of 80 components (five standard deviations below 0.8).

Defined cases: a null text, or one without words, has no links, not even to its
own copies; equal texts are one class, whatever their ids; a null ``doc_id`` is
carried along.  ``class_id`` is the smallest id of the class (null if none has
one), ``class_key`` a number that is unique to the class.  Other columns are
ignored.

Rows are numbered by ``monotonically_increasing_id``, which a file scan repeats
exactly; pass a table that was read, not one that is still to be shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import sizing, wordhash
from tessera.llm.components import components
from tessera.session import ensure_checkpoint_dir

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
COMPONENTS = BANDS * ROWS
LEAST_AGREEING = 46
#: Text of a bucket that one task compares with as much again.
BLOCK_CHARS = 1 << 21

_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def bags(row: int, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle hash and multiplicity, by row, of the texts of a chunk."""
    starts, ends, first = wordhash.word_spans(data, offs)
    words = wordhash.word_hashes(data, starts, ends)
    at, rows = wordhash.windows(first, SHINGLE)
    hashes = [wordhash.window_hashes(words, SHINGLE)[at]]
    owners = [rows]
    n_words = np.diff(first)
    for n in range(1, SHINGLE):  # short texts: one shingle of all words
        short = np.flatnonzero(n_words == n)
        if len(short):
            hashes.append(wordhash.window_hashes(words, n)[first[short]])
            owners.append(short)
    h, r = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    heads = np.flatnonzero(new)
    return r[heads], h[heads], np.diff(np.append(heads, len(h)))


def signatures(n_rows: int, rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``(n_rows, COMPONENTS)`` signature values of bags (see the module)."""
    seeds, owner, rate, reach = [shingles], [rows], [np.ones(len(rows))], [np.ones(len(rows))]
    block, top = 1, 1
    while True:  # levels (top, 2 * top]
        more = np.flatnonzero(weights > top)
        if not len(more):
            break
        seeds.append(wordhash.mix64(shingles[more] + np.uint64(block)))
        owner.append(rows[more])
        rate.append(np.full(len(more), float(top)))
        reach.append(np.minimum(weights[more] - top, top) / top)
        block, top = block + 1, top * 2
    seed, own, rate_, reach_ = map(np.concatenate, (seeds, owner, rate, reach))
    best = np.full(n_rows * COMPONENTS, np.uint64(0x7F800000FFFFFFFF), dtype=np.uint64)  # infinite time
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        steps = 1 if len(seed) > 4096 else 16
        draws = wordhash.mix64(seed[:, None] + np.arange(step + 1, step + steps + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        waits = -np.log(((draws >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate_[:, None]
        times = time[:, None] + np.cumsum(waits, axis=1)
        other = wordhash.mix64(draws ^ np.uint64(0xD6E8FEB86659FD93))
        part = ((other >> _HALF) * np.uint64(COMPONENTS)) >> _HALF
        level = (other & _LOW).astype(np.float64) * 2.0**-32
        hit = level < reach_[:, None]
        place = (own[:, None] * COMPONENTS + part.astype(np.int64))[hit]
        # time in the upper half (positive floats order like integers), the point's name in the lower
        stamp = times.astype(np.float32).view(np.uint32).astype(np.uint64) << _HALF
        np.minimum.at(best, place, (stamp | (draws & _LOW))[hit])
        latest = (best.reshape(n_rows, COMPONENTS).max(axis=1) >> _HALF).astype(np.uint32).view(np.float32)
        time, step = times[:, -1], step + steps
        go = time <= latest[own]
        seed, own, rate_, reach_, time = seed[go], own[go], rate_[go], reach_[go], time[go]
    return (best & _LOW).astype(np.uint32).reshape(n_rows, COMPONENTS)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """``(rows, BANDS)`` hashes of the bands."""
    cells = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xA24BAED4963EE407)
    for k in range(ROWS):
        out = wordhash.mix64(out ^ cells[:, :, k])
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        bands, sigs = np.zeros((n, BANDS), np.int64), np.zeros((n, COMPONENTS), np.uint16)
        any_word = np.zeros(n, dtype=bool)
        for row, data, offs in wordhash.text_chunks(batch.column("text")):
            rows, shingles, weights = bags(row, data, offs)
            there = np.unique(rows)
            if len(there):
                signature = signatures(len(there), np.searchsorted(there, rows), shingles, weights)
                bands[row + there] = band_hashes(signature)
                sigs[row + there] = signature & 0xFFFF
                any_word[row + there] = True
        offsets = np.concatenate([[0], np.cumsum(any_word * BANDS)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in ("node", "doc_id", "k1", "k2")),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[any_word].ravel())),
            pa.array([s.tobytes() for s in sigs], pa.binary()),
        ], ["node", "doc_id", "k1", "k2", "bands", "sig"])


def similarity(left: str, right: str) -> float:
    """Weighted Jaccard similarity of two texts' shingle multisets."""
    bag = []
    for text in (left, right):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        _, shingles, weights = bags(0, data, np.array([0, len(data)]))
        bag.append((shingles, weights))
    (a, wa), (b, wb) = bag
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(wa[ia], wb[ib]).sum())
    either = int(wa.sum() + wb.sum()) - both
    return both / either if either else 0.0


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, COMPONENTS) for c in ("sig_a", "sig_b"))
        keep = pa.array((a == b).sum(axis=1) >= LEAST_AGREEING)
        yield batch.select(["a", "b"]).filter(keep)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        keep = pa.array([similarity(x, y) >= SIMILARITY for x, y in zip(left, right, strict=True)], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _shingled(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Shingle numbers and multiplicities of all texts one after the other, the
    places where each text begins, and the count of different shingles."""
    rows, shingles, weights = [], [], []
    for row, data, offs in wordhash.text_chunks(texts):
        r, h, w = bags(row, data, offs)
        rows.append(r + row)
        shingles.append(h)
        weights.append(w)
    distinct, codes = np.unique(np.concatenate(shingles), return_inverse=True)
    begin = np.searchsorted(np.concatenate(rows), np.arange(len(texts) + 1))
    return codes, np.concatenate(weights), begin, len(distinct)


def _link_blocks(key, table):
    """Links that join components within one pair of blocks of a bucket.

    Of a pair that shares several buckets, the first band takes care.  A member
    is compared only with members it is not yet joined to, so what comes out is
    at most one link for each component."""
    side = np.array(table.column("side").to_pylist())
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, COMPONENTS)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    band = int(np.flatnonzero((bands == key[0].as_py()).all(axis=0))[0])
    codes, weights, begin, n_codes = _shingled(table.column("text"))
    total = np.add.reduceat(weights, begin[:-1])
    mine = np.zeros(n_codes, dtype=np.int64)
    _, joined = np.unique(component, return_inverse=True)  # renamed as components join
    right = side != "left"
    out = []
    for i in np.flatnonzero(side != "right"):
        near = np.flatnonzero(right & (joined != joined[i]))
        near = near[(sig[near] == sig[i]).sum(axis=1) >= LEAST_AGREEING]
        if band:
            near = near[~(bands[near, :band] == bands[i, :band]).any(axis=1)]
        if not len(near):
            continue
        own = slice(begin[i], begin[i + 1])
        mine[codes[own]] = weights[own]
        counts = begin[near + 1] - begin[near]
        at = np.repeat(begin[near] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        both = np.add.reduceat(np.minimum(mine[codes[at]], weights[at]), np.cumsum(counts) - counts)
        mine[codes[own]] = 0
        for j in near[both >= SIMILARITY * (total[near] + total[i] - both)]:
            if joined[j] != joined[i]:
                out.append((node[i], node[j]))
                joined[joined == joined[j]] = joined[i]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def classes(docs: DataFrame) -> DataFrame:
    """``node, doc_id, class_id, class_key, class_size, first`` for each row of
    ``docs``; ``first`` marks one row of each class (least id, then number)."""
    spark = docs.sparkSession
    sizing.bound_arrow(spark)
    ensure_checkpoint_dir(spark)
    numbered = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = numbered.select("node", "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), "text").alias("k2"), "text")
    signed = keyed.mapInArrow(_sign, "node long, doc_id long, k1 long, k2 long, bands array<long>, sig binary").checkpoint()
    worded = F.size("bands") > 0
    signed = signed.withColumns({"k1": F.when(worded, F.col("k1")).otherwise(F.col("node")), "k2": F.when(worded, F.col("k2"))})
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    # steps over short rows take tasks by rows (parts); texts are signed, verified and compared in all partitions
    n_rows = signed.count()
    text_parts = sizing.parts(spark, n_rows)
    # equal texts have equal signatures: any stands for all
    texts = signed.select("*", worded.alias("w")).groupBy("k1", F.coalesce("k2", F.lit(0)).alias("k2"), "w").agg(
        lead.alias("lead"), F.count("*").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"))
    texts = texts.select("k1", "k2", "w", F.col("lead.node").alias("rep"), "lead", "n", "bands", "sig").coalesce(text_parts).checkpoint()

    # one row a distinct text that shares a bucket with another
    banded = texts.filter("w").select(F.col("rep").alias("node"), F.explode("bands").alias("bucket"))
    # checkpointed, so that the joins by bucket are of two shuffled sides and a hot bucket's side is split
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").coalesce(sizing.parts(spark, n_rows * BANDS // 4)).checkpoint()
    n_members = shared.agg(F.sum("n")).first()[0] or 0
    member_parts = sizing.parts(spark, n_members)
    shared = shared.coalesce(member_parts)
    members = banded.join(shared, "bucket").select("bucket", "node", "n").coalesce(member_parts).checkpoint()
    meets = members.groupBy("node").agg(F.sum("n").alias("met")).coalesce(member_parts).checkpoint()
    signs = texts.select(F.col("rep").alias("node"), "bands", "sig")
    held = numbered.select("node", "text").join(signs.join(meets.select("node"), "node"), "node").checkpoint()

    # stars: the member that meets most others is the likeliest origin of its group
    centers = members.join(meets, "node").coalesce(member_parts).groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("center")).coalesce(member_parts).checkpoint()
    spokes = members.join(centers, "bucket").filter("node <> center")
    stars = spokes.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).coalesce(member_parts).distinct().coalesce(member_parts)
    x, y = ([held.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("text").alias(f"text_{c}")) for c in "ab"])
    near = stars.join(x.drop("text_a"), "a").coalesce(member_parts).join(y.drop("text_b"), "b").select("a", "b", "sig_a", "sig_b").coalesce(member_parts).mapInArrow(_close, "a long, b long")
    links = near.join(x.drop("sig_a"), "a").join(y.drop("sig_b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long").checkpoint()
    first = components(links)

    rest = _between_components(members.filter("n > 2").select("bucket", "node"), held, first, member_parts)
    if rest is None:
        found = first
    else:  # what is known of the first components is one edge a node
        found = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))

    named = texts.select("rep", "k1", "k2", "w", "lead", "n").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class_key", F.coalesce("component", "rep"))
    named = named.select("rep", "k1", "k2", "w", "lead", "n", "class_key").coalesce(text_parts).checkpoint()
    whole = named.groupBy("class_key").agg(F.min("lead").alias("lead"), F.sum("n").alias("class_size"))
    told = named.select("k1", "k2", "w", "class_key").join(whole, "class_key").coalesce(text_parts)
    rows = signed.select("node", "doc_id", "k1", F.coalesce("k2", F.lit(0)).alias("k2"), worded.alias("w"))
    return rows.join(told, ["k1", "k2", "w"]).select(
        "node", "doc_id", F.col("lead.doc_id").alias("class_id"), "class_key", "class_size", (F.col("node") == F.col("lead.node")).alias("first"))


def _between_components(members: DataFrame, held: DataFrame, found: DataFrame, n_parts: int) -> DataFrame | None:
    """Links ``a, b`` between different components that share a bucket, or None
    if no bucket holds several components.

    In a bucket the largest component is one side; all others are compared with
    it and with each other, in blocks of about ``BLOCK_CHARS``."""
    sized = held.select("node", F.length("text").cast("long").alias("chars"))
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(sized, "node").coalesce(n_parts).checkpoint()
    counted = placed.groupBy("bucket", "component").agg(F.sum("chars").alias("chars")).coalesce(n_parts)
    mixed = counted.groupBy("bucket").agg(
        F.count("*").alias("several"), F.sum("chars").alias("all"), F.max(F.struct("chars", "component")).alias("big")).filter("several > 1")
    mixed = mixed.select(
        "bucket", F.col("big.component").alias("big"), F.expr(f"cast(big.chars div {BLOCK_CHARS} + 1 as int)").alias("big_blocks"),
        F.expr(f"cast((all - big.chars) div {BLOCK_CHARS} + 1 as int)").alias("blocks")).coalesce(n_parts).checkpoint()
    if mixed.isEmpty():
        return None
    split = placed.join(mixed, "bucket").withColumn("is_big", F.col("component") == F.col("big")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.when(F.col("is_big"), F.col("big_blocks")).otherwise(F.col("blocks"))))
    big = "transform(sequence(0, blocks - 1), i -> struct(i as i, cast(block as int) as j, true as with_big, 'right' as side))"
    small = ("concat(transform(sequence(0, big_blocks - 1), j -> struct(cast(block as int) as i, j as j, true as with_big, 'left' as side)),"
             " transform(sequence(0, blocks - 1), k -> struct(cast(least(block, k) as int) as i, cast(greatest(block, k) as int) as j, false as with_big,"
             " case when block = k then 'both' when block < k then 'left' else 'right' end as side)))")
    dealt = split.select("bucket", "node", "component", F.explode(F.expr(f"if(is_big, {big}, {small})")).alias("p")).select(
        "bucket", "node", "component", "p.*").join(held, "node")
    return dealt.groupBy("bucket", "i", "j", "with_big").applyInArrow(_link_blocks, "a long, b long").checkpoint()


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "class_id", "class_key", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without all but the first row of each class."""
    numbered = docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_node"))
    stay = classes(docs).filter("first").select(F.col("node").alias("_node"))
    return numbered.join(stay, "_node", "left_semi").select("_doc.*")


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """For tests: class (least id) of each id, over all pairs."""
    def bag(text):
        w = (text or "").encode().split()
        return Counter(tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))) if w else Counter()

    bag_of = {d: bag(t) for d, t in rows}
    root = {d: d for d in bag_of}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(bag_of)
    total = {d: sum(b.values()) for d, b in bag_of.items()}
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if total[a] and total[b] and min(total[a], total[b]) >= SIMILARITY * max(total[a], total[b]):
                both = sum((bag_of[a] & bag_of[b]).values())
                if both >= SIMILARITY * (total[a] + total[b] - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}
