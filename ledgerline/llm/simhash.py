"""Near-duplicates by SimHash: meet-in-the-middle ball hashing.

`simhash` gives each text a 64-bit fingerprint: every bit is the majority over the text's word shingles.
`linked_fingerprints` finds connections between fingerprints at three or fewer differing bits. Every fingerprint
emits the fingerprints within half that radius (itself and its 64 neighbours at one bit), and those of even weight
also the neighbours at two bits, as three differing bits make one of a pair even and the other odd. Of three bits,
two lie in one half of the word, so only two-bit changes within one half are needed. Fingerprints that meet in a
variant `v` are linked to the smallest that is within one bit of `v`: any other that emitted `v` is within
two bits of it, so each such link is at most three bits long; the length is checked once more. Groups of thousands of
near copies therefore cost a number of rows in proportion to the group.

Before that, an exact test drops fingerprints that can't have a partner: of three differing bits, one half of the
word has at most one, so a partner's half is one of 33 values.

Rows: null texts count as empty; texts without words have fingerprint 0 and link like any other; equal rows stay
equal rows; a null id keeps its row and takes the component of its fingerprint; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import connected_components, kept, slices, small_side, table

SEED = 42
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 of each run of `words` words, lower-cased in A-Z, joined by spaces; of the whole if there are fewer."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    runs = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    return np.fromiter((h(x, SEED) for x in runs), np.uint64)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of `hashes` (lengths `counts`): the bits that are set in over half of it.

    Eight bit-lanes of a byte are counted in one 64-bit sum; blocks of 255 hashes keep a lane from overflowing.
    """
    rows = len(counts)
    blocks = -(-counts // 255)
    if not blocks.sum():
        return np.zeros(rows, np.uint64)
    owner = np.repeat(np.arange(rows), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(counts) - counts, blocks) + 255 * nth
    first = np.searchsorted(owner, np.arange(rows))[counts > 0]
    out = np.zeros((rows, 8), np.uint64)
    half = counts[counts > 0][:, None]
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        per_row = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        out[counts > 0] |= (2 * per_row > half).astype(np.uint64) << np.uint64(bit)
    return (out << (np.uint64(8) * np.arange(8, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id_col, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            each = [shingle_hashes(t, words) for t in batch.column(1).to_pylist()]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            fp = majority(np.concatenate([np.zeros(0, np.uint64), *each]), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], [id_col, "fp"])

    kind = df.schema[id_col].dataType
    return df.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(id_col, kind), T.StructField("fp", T.LongType())]))


def _one_bit() -> np.ndarray:
    return np.uint64(1) << np.arange(64, dtype=np.uint64)


def _two_bits() -> np.ndarray:
    b = _one_bit()
    return np.array([b[i] | b[j] for i in range(64) for j in range(i + 1, 64) if i // 32 == j // 32], np.uint64)


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each half of each fingerprint as it is and with one bit changed."""
    flips = np.concatenate([[0], _one_bit()[:32]]).astype(np.uint64)
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for side in (0, 1):
            half = (fp >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
            key = (half[:, None] ^ flips).ravel() | np.uint64(side << 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.repeat(fp, 33).view(np.int64)), pa.array(np.tile(flips > 0, len(fp)))],
                ["key", "fp", "changed"],
            )


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The variants of each fingerprint: near ones at up to one bit; of even ones, far ones at two bits of one half."""
    near, far = np.concatenate([np.zeros(1, np.uint64), _one_bit()]), _two_bits()
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for part in np.array_split(fp, max(1, len(fp) // 2000)):
            even = part[np.bitwise_count(part) % 2 == 0]
            for own, masks in ((part, near), (even, far)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((own[:, None] ^ masks).ravel().view(np.int64)), pa.array(np.repeat(own, len(masks)).view(np.int64)), pa.array(np.full(own.size * masks.size, masks is near))],
                    ["variant", "fp", "near"],
                )


def linked_fingerprints(fps: DataFrame) -> DataFrame:
    """(a, b): links of at most three bits that connect all that links of at most three bits connect.

    `fps` has distinct fingerprints in `fp`.
    """
    fps = fps.select("fp")
    exact = (
        fps.select(F.explode(F.array(F.expr("fp & 4294967295"), F.expr("shiftrightunsigned(fp, 32) | 4294967296"))).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("holders"))
    )
    partnered = (
        fps.mapInArrow(_halves, "key long, fp long, changed boolean").join(exact, "key").where("changed OR holders > 1").select("fp").distinct()
    )
    met = partnered.mapInArrow(_balls, "variant long, fp long, near boolean")
    hub = F.expr("min(CASE WHEN near THEN fp END) OVER (PARTITION BY variant)")
    return (
        met.select("fp", hub.alias("hub"))
        .where("fp <> hub AND bit_count(fp ^ hub) <= 3")
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


def linked_groups(fps: DataFrame) -> DataFrame:
    """(fp, component): the smallest fingerprint reachable, for each of the distinct `fps` that has a link; by ball hashing."""
    return kept(connected_components(linked_fingerprints(fps)).withColumnRenamed("node", "fp"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id_col, fp, component_id): the smallest id reachable by links of three or fewer bits, for every row."""
    prints = kept(simhash(df, id_col, text_col, words))
    nodes = kept(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    parts = linked_groups(nodes)
    named = nodes.join(parts, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), "least")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "component").select("fp", "component_id"), "fp", "left").select(id_col, "fp", "component_id")


def op4_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- One document of each group, at a similarity over word shingles -------------------------------------------------

#: In a band, texts meet whose least shingle hashes agree under all ROWS of its orders: a pair at similarity s with
#: probability s ** ROWS, whatever the number of shingles; at 0.8 in one of the bands with 1 - (1 - 0.8**6)**24 = 0.9993.
BANDS, ROWS = 24, 6
SIMILARITY = 0.8
#: Text that a task holds at once of either side of the pairs that it compares.
PAIR_BYTES = 2 << 20
#: Documents of a bucket that are compared with as many others of it at once.
CHUNK = 1024


def _orders() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_bands(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """[run, band]: a number for the least hashes of each run of `hashes` (lengths `counts`, all above 0) in each band."""
    out = np.empty((len(counts), BANDS), np.uint64)
    if not len(counts):
        return out
    starts = np.cumsum(counts) - counts
    for band, orders in enumerate(_orders()):
        key = np.full(len(counts), band + 1, np.uint64)
        for order in orders:
            key = (key ^ np.minimum.reduceat(hashes * order, starts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out


def sketches(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, same, fp, n, bands): what texts of equal words share, the fingerprint, the number of distinct shingles, and the bands (none without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, PAIR_BYTES):
            texts = batch.column(1).to_pylist()
            each = [shingle_hashes(t, words) for t in texts]
            fp = majority(np.concatenate([np.zeros(0, np.uint64), *each]), np.fromiter(map(len, each), np.int64, len(each)))
            each = [np.unique(h) for h in each]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            found = min_bands(np.concatenate([np.zeros(0, np.uint64), *each]), counts[counts > 0])
            same = [xxhash.xxh128_hexdigest(b" ".join((t or "").encode().lower().split())) for t in texts]
            ends = np.concatenate([[0], np.cumsum((counts > 0) * BANDS)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same), pa.array(fp.view(np.int64)), pa.array(counts), bands], out.names)

    out = T.StructType(
        [T.StructField("id", df.schema[id_col].dataType), T.StructField("same", T.StringType()), T.StructField("fp", T.LongType()), T.StructField("n", T.LongType())]
        + [T.StructField("bands", T.ArrayType(T.LongType()))]
    )
    return df.select(id_col, text_col).mapInArrow(run, out)


def ball_buckets(one: DataFrame) -> DataFrame:
    """(id, n, variant) of `one` (id, fp, n): those whose fingerprints link at three or fewer bits, however many links apart, share a variant.

    By op4's ball hashing. Rows without a partner are left out, and so are those without shingles.
    """
    some = one.where("n > 0").select("id", "fp", "n")
    nodes = kept(some.groupBy("fp").agg(F.count("*").alias("holders")))
    met = nodes.join(linked_groups(nodes), "fp", "left").where("component IS NOT NULL OR holders > 1")
    return some.join(met.select("fp", F.xxhash64(F.lit("ball"), F.coalesce("component", "fp")).alias("variant")), "fp").select("id", "n", "variant")


def _similar(least: float, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, 2, PAIR_BYTES), 3, PAIR_BYTES):
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            remembered: dict[str, set[int]] = {}

            def bag(text: str | None, remembered: dict = remembered) -> set[int]:
                if text not in remembered:
                    if len(remembered) > 32:
                        remembered.clear()
                    remembered[text] = set(shingle_hashes(text, words).tolist())
                return remembered[text]

            good = []
            for x, y in zip(a, b, strict=True):
                p, q = bag(x), bag(y)
                common = len(p & q)
                good.append(bool(p) and common >= least * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _bags(words: int):
    """(id, bag): the distinct shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bags = [np.unique(shingle_hashes(t, words)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], ["id", "bag"])

    return run


def similar_across(bags: list[np.ndarray], part: np.ndarray, chunk: np.ndarray, least: float) -> list[tuple[int, int]]:
    """The pairs of different `part`, and of different `chunk` unless there is one only, at the similarity or above. Exact.

    Prefix filtering: with the shingles of every bag in one order, rarest first, two bags at the similarity share one
    among the first n - ceil(least * n) + 1 of each.
    """
    n = np.fromiter(map(len, bags), np.int64, len(bags))
    owner = np.repeat(np.arange(len(bags)), n)
    _, code, held = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    order = np.lexsort((code, held[code], owner))
    nth = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
    first = nth < np.repeat(n - np.ceil(least * n - 1e-9).astype(np.int64) + 1, n)
    code, owner = code[order][first], owner[first]
    by = np.argsort(code, kind="stable")
    code, owner = code[by], owner[by]
    met, apart = set(), chunk.min() != chunk.max()
    for own in np.split(owner, np.nonzero(np.diff(code))[0] + 1):
        if len(own) < 2 or (part[own] == part[own[0]]).all():
            continue
        for k, x in enumerate(own.tolist()):
            y = own[k + 1 :]
            y = y[(part[y] != part[x]) & (np.minimum(n[y], n[x]) >= least * np.maximum(n[y], n[x]))]
            met.update((x, z) for z in (y[chunk[y] != chunk[x]] if apart else y).tolist())
    good = []
    for x, y in sorted(met):
        common = len(np.intersect1d(bags[x], bags[y], assume_unique=True))
        if common >= least * (n[x] + n[y] - common):
            good.append((x, y))
    return good


def _across(least: float):
    """Links of each block (variant, i, j), whose rows stand together; the rows are (variant, i, j, chunk, part, id, bag)."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks()
        bags = [np.frombuffer(b, np.uint64) for b in block["bag"].to_pylist()]
        part = block["part"].combine_chunks().dictionary_encode().indices.to_numpy()
        found = similar_across(bags, part, block["chunk"].to_numpy(), least)
        ids = block["id"].combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array([p[side] for p in found], pa.int64())) for side in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            cuts = [0, *(np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1).tolist(), len(key)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if stop > start:
                    if held and tuple(key[start]) != last:
                        yield links(held)
                        held = []
                    held.append(batch.slice(start, stop - start))
                    last = tuple(key[start])
        if held:
            yield links(held)

    return run


def _links_across(met: DataFrame, one: DataFrame, found: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): of all that meet in `met` (variant, id), which is held, the similar pairs that the components `found` do not link yet.

    Buckets whose documents are in one component need nothing more. In all others every pair across components is held
    against the similarity, in blocks of two chunks of a bucket, which bound what a task holds.
    """
    named = one.join(found, one["id"] == found["node"], "left").select("id", F.xxhash64(F.coalesce("component", "id")).alias("part"))
    placed = kept(met.select("variant", "id").join(named, "id"))
    open_ = (
        placed.groupBy("variant").agg(F.count("*").alias("rows"), F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low <> high").select("variant", F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks"))
    )
    dealt = kept(placed.join(open_, "variant").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")))
    id_type = dealt.schema["id"].dataType
    bags = texts.join(small_side(dealt.select("id").distinct()), "id", "left_semi").mapInArrow(_bags(words), T.StructType([T.StructField("id", id_type), T.StructField("bag", T.BinaryType())]))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    block = ["variant", "i", "j"]
    blocks = dealt.withColumn("other", other).select("variant", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "part", "id")
    blocks = blocks.join(bags, "id").select(*block, "chunk", "part", "id", "bag").repartition(*block).sortWithinPartitions(*block, "id")
    return blocks.mapInArrow(_across(similarity), T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)]))


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """(id, component_id) of every non-null id: groups linked by texts of equal words or by a Jaccard similarity of their shingles.

    Documents meet by ball hashing, as in op4, of fingerprints over the same shingles: all whose fingerprints link at three or
    fewer bits are one bucket. At similarity 0.8 fingerprints differ in 10 bits on average, beyond any ball that can be
    listed, so MinHash over BANDS bands adds buckets: such a pair meets in a band with probability 0.9993, at 0.85 with 0.99999. In
    each bucket of either kind every document is paired with the least and with its neighbour, so pairs grow with the rows
    and not with their square; the numbers of shingles, then the exact similarity verify each pair. Where that leaves a bucket in
    several components, all pairs across them are verified, so that every pair that meets anywhere is linked.
    """
    id_type = df.schema[id_col].dataType
    drawn = kept(sketches(df.where(F.col(id_col).isNotNull()), id_col, text_col, words))
    one = kept(drawn.groupBy("same").agg(F.min("id").alias("id"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bands").alias("bands")))
    met = kept(ball_buckets(one)).union(one.select("id", "n", F.explode("bands").alias("variant")))
    order = "OVER (PARTITION BY variant ORDER BY id)"
    row = "struct(id, n)"
    # Most buckets hold one document: only those that meet another go further.
    met = met.select("variant", "id", "n", F.expr(f"first_value({row}) {order}").alias("hub"), F.expr(f"lag({row}) {order}").alias("last"), F.expr(f"lead(true) {order}").alias("more"))
    met = kept(met.where("last IS NOT NULL OR more").drop("more"))
    near = met.where("last IS NOT NULL").select(F.col("id").alias("b"), "n", F.explode(F.array_distinct(F.array("hub", "last"))).alias("a"))
    # Of texts at the similarity, the lesser set has at least that share of the greater one.
    near = near.where(f"a.id <> b AND least(n, a.n) >= {similarity}D * greatest(n, a.n)").select("a.id", "b").toDF("a", "b").distinct()
    named = small_side(met.select("id").distinct())
    texts = kept(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(named, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")))
    text = lambda name: texts.select(F.col("id").alias(name), F.col("text").alias(f"{name}_text"))
    both = near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "a_text", "b_text")
    links = both.mapInArrow(_similar(similarity, words), T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)]))
    found = kept(connected_components(links))
    more = kept(_links_across(met, one, found, texts, words, similarity))
    if not more.isEmpty():  # the components stand for the links that made them
        found = kept(connected_components(found.toDF("a", "b").union(more)))
    reps = one.select("same", F.col("id").alias("node")).join(found, "node", "left").select("same", F.coalesce("component", "node").alias("component_id"))
    return drawn.select("id", "same").join(reps, "same").select("id", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `df` without those whose group has a smaller id.

    Null ids come after all others: such rows are told apart by their texts, and of those with one text one row stays.
    Repeated rows of an id stay together. Null texts and texts without words are one group.
    """
    if not df.where(F.col(id_col).isNull()).isEmpty():
        whole = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.when(F.col(id_col).isNull(), F.sha2(F.coalesce(text_col, F.lit("")), 256)).alias("text"))
        left = _without_lost(df.withColumn("_whole", whole), "_whole", text_col, words, similarity)
        nameless = left.where(F.col(id_col).isNull()).dropDuplicates(["_whole"])
        return left.where(F.col(id_col).isNotNull()).union(nameless).drop("_whole")
    return _without_lost(df, id_col, text_col, words, similarity)


def _without_lost(df: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    groups = similar_groups(df, id_col, text_col, words, similarity)
    lost = small_side(groups.where("id <> component_id").select(F.col("id").alias("_lost")).distinct())
    return df.join(lost, df[id_col] == F.col("_lost"), "left_anti")
