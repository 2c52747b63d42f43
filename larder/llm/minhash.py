"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles yields two signature values, its minimum and
its maximum, so a signature of 2k values costs k hash evaluations. Bands of the
signature propose pairs; every link is confirmed on the full shingle sets.

No pairs are emitted inside a group of copies. Equal sets collapse to one
representative. In each band bucket the members are paired with the bucket's
most central one (a star), and only members that the confirmed links leave in
another component than that centre are compared with the rest of its buckets,
in blocks of full sets that return links between components and no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import components, materialise, pick, positional, spread_join


@dataclass(frozen=True)
class MinMaxParams:
    """``shingle``: words per shingle; ``percent``: least Jaccard similarity in
    percent; ``permutations``: hash evaluations (the signature has twice as
    many values); ``rows``: values per band. With 48 permutations and 4 rows,
    24 bands miss a pair at 0.85 with probability 2e-8, at 0.8 with 4e-6.
    ``block_rows``, ``block_shingles``: sets and shingles of a block;
    ``filter_bits``: size of the filter of documents whose sets are compared
    (a power of two, 32768 at least)."""
    shingle: int = 3
    percent: int = 85
    permutations: int = 48
    rows: int = 4
    seed: int = 20240601
    block_rows: int = 512
    block_shingles: int = 200_000
    filter_bits: int = 1 << 26


_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingle_hashes(text, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text;
    a text of fewer words than ``size`` is one shingle."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and the six ASCII spaces
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, _U)
    for i in range(width):
        total = _mix(total * _U(0x9E3779B97F4A7C15) + h[i:i + len(total)])
    return np.unique(total)


def band_keys(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band: bands of minima, then bands of maxima."""
    low = np.full(len(a), 0xFFFFFFFF, _U)
    high = np.zeros(len(a), _U)
    for i in range(0, len(hashes), 4096):
        v = (hashes[i:i + 4096, None] * a + b) >> _U(32)
        low = np.minimum(low, v.min(0))
        high = np.maximum(high, v.max(0))
    sig = np.concatenate([low, high]).reshape(-1, rows)
    key = np.arange(len(sig), dtype=_U)
    for i in range(rows):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + sig[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, p: MinMaxParams) -> DataFrame:
    """``rid, doc_id, n_shingles, set_key, bands`` per document of ``docs
    (rid, doc_id, text)``; ``set_key`` names the shingle set, null for none."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, n_shingles long, set_key binary, bands array<long>"
    half = p.permutations - p.permutations % p.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        rng = np.random.default_rng(p.seed)
        a = rng.integers(1, 2**63, half, dtype=np.uint64) * _U(2) + _U(1)
        b = rng.integers(0, 2**63, half, dtype=np.uint64)
        for batch in batches:
            n, keys, bands = [], [], []
            for text in batch.column("text"):
                h = shingle_hashes(text.as_py(), p.shingle)
                n.append(len(h))
                keys.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                bands.append(band_keys(h, a, b, p.rows) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["rid", "doc_id", "n_shingles", "set_key", "bands"])

    return docs.select("rid", "doc_id", "text").mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` whose full ``sets (node, hashes)`` are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return spread_join(spread_join(pairs, right, "b"), left, "a").filter(
        100 * both >= percent * (F.size("ha") + F.size("hb") - both)).select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame, p: MinMaxParams) -> DataFrame:
    """``node, hashes`` of the representatives in ``nodes (node)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                sets = [shingle_hashes(t.as_py(), p.shingle).view(np.int64) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    nodes = materialise(nodes, "wanted")
    likely = _maybe_among(docs.withColumnRenamed("rid", "node").select("node", "text"), nodes, p.filter_bits)
    return materialise(likely.join(nodes, "node", "left_semi").mapInArrow(run, "node long, hashes array<long>"), "sets")


def _maybe_among(rows: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """The ``rows (node, text)`` whose node may be among ``nodes``, by a filter
    of hash bits: every node's bit is set, so none of them is lost, and most
    other texts are not shuffled for the join that follows. The filter has a
    fixed size, put together by task and then by block of 4 KB; with far more
    nodes than bits it lets all rows through."""
    place = F.pmod(F.xxhash64("node"), F.lit(bits)) + 1
    blocks = nodes.select(place.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("map")).collect()
    known = np.zeros((-(-bits // 32768), 4096), np.uint8)
    for r in blocks:
        known[r["block"] - 1] = np.frombuffer(bytes(r["map"]), np.uint8)
    held = rows.sparkSession.sparkContext.broadcast(known.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy() - 1
            yield batch.select(["node", "text"]).filter(pa.array((held.value[h >> 3] >> (h & 7)) & 1 == 1))

    return rows.withColumn("h", place).mapInArrow(run, "node long, text string")


def _shared(sets: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = count > 1  # a shingle of one set is in no intersection
    at = twice[column]
    owner, column = owner[at], (np.cumsum(twice) - 1)[column[at]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(twice.sum()), 4096):
        i, j = np.searchsorted(column, [first, first + 4096])
        has = np.zeros((len(sets), 4096), np.float32)
        has[owner[i:j], column[i:j] - first] = 1
        both += (has[left] @ has[right].T).astype(np.int64)
    return both


def _group_links(groups: DataFrame, sets: DataFrame, p: MinMaxParams) -> DataFrame:
    """Links ``a, b`` that join different components ``comp`` among the members
    of a centre's buckets, ``groups (a, node, n, comp, odd)``. Odd members are
    compared with all others, block against block, on the full ``sets``. A pair
    of blocks returns a spanning forest of its links, never its pairs."""
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / p.block_rows, F.sum("n") / p.block_shingles)).cast("int")
    sizes = groups.groupBy("a").pivot("odd", [True, False]).agg(blocks).toDF("a", "odds", "evens").fillna(0)
    dealt = spread_join(groups, sizes, "a")
    place = F.when(F.col("odd"), F.pmod(F.xxhash64("node"), F.col("odds"))).otherwise(
        F.col("odds") + F.pmod(F.xxhash64("node"), F.greatest("evens", F.lit(1))))
    last = F.when(F.col("odd"), F.col("odds") + F.col("evens")).otherwise(F.col("odds")) - 1
    dealt = dealt.withColumn("own", place.cast("int")).withColumn("last", last)
    dealt = spread_join(dealt, sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("a", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "comp", "hashes")

    def compare(table: pa.Table) -> pa.Table:
        t = table.sort_by("node")
        node, own = t.column("node").to_numpy(), t.column("own").to_numpy()
        hashes = [x.values.to_numpy() for x in t.column("hashes")]
        left, right = (np.flatnonzero(own == t.column(x)[0].as_py()) for x in ("lo", "hi"))
        size = np.array([len(x) for x in hashes], np.int64)
        both = _shared(hashes, left, right)
        linked = 100 * both >= p.percent * (size[left][:, None] + size[right][None, :] - both)
        label = np.unique(t.column("comp").to_numpy(), return_inverse=True)[1]
        out: list = [[], []]
        for k, i in enumerate(left):
            near = right[linked[k]]
            while len(near := near[label[near] != label[i]]):
                out[0].append(node[i])
                out[1].append(node[near[0]])
                label[label == label[near[0]]] = label[i]
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return dealt.groupBy("a", "lo", "hi").applyInArrow(compare, "a long, b long")


def cluster(docs: DataFrame, p: MinMaxParams = MinMaxParams()) -> DataFrame:
    """``rid, doc_id, n_shingles, set_key, component_id, first_rid`` per row of
    ``docs (rid, doc_id, text)``; ``rid`` is unique. ``first_rid`` is the row
    that stands for its component."""
    sig = materialise(signatures(docs, p), "signatures")
    filled = sig.filter(F.col("set_key").isNotNull())
    # A representative per distinct set; ties of doc_id fall to the smallest rid.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    reps = filled.groupBy("set_key").agg(F.min(F.struct("rid", "n_shingles", "bands")).alias("r"), first,
                                         F.count(F.lit(1)).alias("copies"))
    reps = materialise(reps.select("set_key", F.col("r.rid").alias("node"), F.col("r.n_shingles").alias("n"),
                                   F.col("r.bands").alias("bands"), "first", "copies"), "sets")
    # A bucket's centre is its member with the most company over all bands: of a
    # group of edited copies, the one that the others are closest to.
    members = reps.select("node", "n", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialise(spread_join(members, shared, "band"), "members")
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    ranked = members.join(company, "node").groupBy("band").agg(
        F.max(F.struct("company", (-F.col("node")).alias("first"), "n")).alias("c"))
    centres = ranked.select("band", (-F.col("c.first")).alias("a"), F.col("c.n").alias("an"))
    members = materialise(spread_join(members.drop("size"), centres, "band"), "centred")

    def close(x, y):
        return 100 * F.least(x, y) >= p.percent * F.greatest(x, y)

    star = members.filter(close(F.col("n"), F.col("an")) & (F.col("node") != F.col("a"))).select(
        "a", F.col("node").alias("b")).distinct()
    star = materialise(star, "star")
    sets = _sets(docs, members.select("node").distinct(), p)  # once for both steps: the texts are shuffled for it
    links = materialise(_confirmed(star, sets, p.percent), "links")
    comp = components(links)

    # Members that are not in their centre's component meet the rest of its buckets.
    known = spread_join(members, comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    centre = comp.select(F.col("node").alias("a"), F.col("comp").alias("acomp"))
    known = spread_join(known.drop("an"), centre, "a", "left").withColumn("odd", F.col("comp") != F.coalesce("acomp", "a"))
    known = materialise(known.select("band", "a", "node", "n", "comp", "odd"), "known")
    bands = known.filter("odd").select("band").distinct()
    if bands.limit(1).count():
        groups = known.join(bands, "band", "left_semi").groupBy("a", "node", "n", "comp").agg(F.max("odd").alias("odd"))
        groups = materialise(groups, "groups")
        more = materialise(_group_links(groups, sets, p), "links")
        comp = components(materialise(links.union(more), "links"))

    # The smallest document of each component, then back to every row.
    of_set = materialise(reps.join(comp, "node", "left").select(
        "set_key", F.coalesce("comp", "node").alias("comp"), "first", "copies"), "of-set")
    of_comp = of_set.groupBy("comp").agg(F.min("first").alias("lead"), F.sum("copies").alias("rows")).filter("rows > 1")
    led = spread_join(of_set.select("set_key", "comp"), of_comp, "comp").select("set_key", "lead")
    out = spread_join(sig.drop("bands"), led, "set_key", "left")
    alone = F.col("lead").isNull()
    return out.select("rid", "doc_id", "n_shingles", "set_key",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("component_id"),
                      F.when(alone, F.col("rid")).otherwise(F.col("lead.rid")).alias("first_rid"))


def near_duplicates(docs: DataFrame, params: MinMaxParams = MinMaxParams(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Null or empty texts and texts of spaces have no shingles and link with
    nothing. Repeated rows are exact copies; rows that share the smallest
    doc_id of a component are all ``kept``. A null doc_id takes its
    component's smallest id and is kept only where no other row has one."""
    d = materialise(pick(docs, doc_id=id_col, text=text_col).withColumn("rid", F.monotonically_increasing_id()), "docs")
    return cluster(d, params).select("doc_id", "n_shingles", "component_id",
                                     F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, params: MinMaxParams = MinMaxParams(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: one row of each near-duplicate group
    (smallest doc_id, one row of it) and every row that links with nothing."""
    flat, at, restore = positional(docs)
    flat = materialise(flat.withColumn("rid", F.monotonically_increasing_id()), "docs")
    d = flat.select("rid", F.col(at(id_col)).alias("doc_id"), F.col(at(text_col)).alias("text"))
    drop = materialise(cluster(d, params).filter("rid <> first_rid").select("rid"), "copies")
    return restore(flat.join(drop, "rid", "left_anti"))
