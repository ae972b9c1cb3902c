"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine, connected components.

Equal vectors of a label are one node with a multiplicity. In each table a node's bucket is the signs of some random
projections. With n nodes under the largest label there are log2(n) + 5 signs, so that chance brings few together, and as many tables
as find a pair at the limit of the cosine with probability FOUND. Buckets are counted and cut into chunks of about CHUNK nodes on rows of two
numbers; only nodes that share a bucket then bring their vector, as stored, to each pair of chunks, which is
compared by matrix products in double precision, so no task holds more, however large a bucket is. A pair
counts in the first table where it meets. A block gives a row for each node, its links and the least node it is connected to
there, not the pairs, so dense groups give rows in proportion to their size.

Rows: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label, link with
nothing; labels are of any type and compared by value; vectors of different lengths are not compared; repeated rows are vectors of their own and link; a null id counts
as a vector but names no component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import connected_components, kept, small_side, table

FOUND, CHUNK, COSINE = 0.998, 1000, 0.98
#: Groups up to this size are compared many at once.
SMALL = 32
_BLOCK = ["bucket", "i", "j"]
_OUT = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())])


def plan(nodes: int, cosine: float) -> tuple[int, int]:
    """Signs of a bucket, at most 60, and the number of tables."""
    bits = min(60, max(8, math.ceil(math.log2(max(2, nodes))) + 5))
    one = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - FOUND) / math.log(1 - min(one, 0.999))))


def hyperplanes(size: int, many: int) -> np.ndarray:
    return np.random.default_rng(size).standard_normal((size, many))


def _units(raw: np.ndarray) -> np.ndarray:
    unit = raw / np.abs(raw).max(axis=1, keepdims=True)  # keeps squares of tiny and huge components in range
    return unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))


def _codes(bits: int, tables: int):
    """(node, codes): the bucket's code of each node in every table."""
    powers = np.int64(1) << np.arange(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.to_pandas()
            for (size, _), part in whole.groupby([whole["embedding"].map(len), np.arange(len(whole)) // 2000]):
                unit = _units(np.stack(part["embedding"].to_numpy()).astype(np.float64))
                codes = (unit @ hyperplanes(size, tables * bits) >= 0).reshape(len(part), tables, bits) @ powers
                yield pa.RecordBatch.from_arrays([pa.array(part["node"].to_numpy()), pa.array(list(codes), pa.list_(pa.int64()))], ["node", "codes"])

    return run


def _blocks_of_one_size(frame: pd.DataFrame, rows: np.ndarray, cosine: float) -> pd.DataFrame:
    """rows [block, member]: links and the least connected member of every member, for blocks of as many members each."""
    pick = lambda name: frame[name].to_numpy()[rows]
    raw, codes = (np.stack(frame[name].to_numpy()[rows].ravel()) for name in ("embedding", "codes"))
    unit, codes = _units(raw.astype(np.float64)).reshape(*rows.shape, -1), codes.reshape(*rows.shape, -1)
    linked = unit @ unit.transpose(0, 2, 1) >= cosine
    linked[:, np.arange(rows.shape[1]), np.arange(rows.shape[1])] = False
    lab = pick("lab")  # tells apart what shares a bucket's hash
    linked &= lab[:, :, None] == lab[:, None, :]
    side, i, j, tab = pick("chunk"), pick("i")[:, :1], pick("j")[:, :1], pick("tab")[:, 0]
    linked &= (i == j)[:, :, None] | (side[:, :, None] != side[:, None, :])
    for t in range(codes.shape[2]):  # pairs that have met in an earlier table count there
        later = tab > t
        linked[later] &= codes[later, :, None, t] != codes[later, None, :, t]
    links = (linked @ pick("many")[:, :, None])[:, :, 0]
    least = np.broadcast_to(np.arange(rows.shape[1]), rows.shape).copy()
    while True:
        low = np.minimum(least, np.where(linked, least[:, None, :], rows.shape[1]).min(axis=2))
        low = np.take_along_axis(low, low, axis=1)
        if (low == least).all():
            break
        least = low
    names = pick("node")
    hit = links > 0
    return pd.DataFrame({"node": names[hit], "links": links[hit], "hub": np.take_along_axis(names, least, axis=1)[hit]})


def _compared(frame: pd.DataFrame, cosine: float) -> Iterator[pa.RecordBatch]:
    """`frame` holds whole blocks, one after the other."""
    block = [*_BLOCK, "size"]  # vectors of different lengths share a bucket by chance only
    new = (frame[block] != frame[block].shift()).any(axis=1).to_numpy()
    starts = np.nonzero(new)[0]
    sizes = np.diff(np.append(starts, len(frame)))
    for n in np.unique(sizes[sizes > 1]).tolist():
        own = starts[sizes == n]
        step = max(1, 200_000 // (n * n)) if n <= SMALL else 1
        for k in range(0, len(own), step):
            found = _blocks_of_one_size(frame, own[k : k + step, None] + np.arange(n), cosine)
            if len(found):
                yield pa.RecordBatch.from_pandas(found, schema=_OUT, preserve_index=False)


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the block that the next batch may go on with
        for batch in batches:
            frame = batch.to_pandas() if held is None else pd.concat([held, batch.to_pandas()], ignore_index=True)
            if not len(frame):
                continue
            last = (frame[_BLOCK] == frame[_BLOCK].iloc[-1]).all(axis=1).to_numpy()
            cut = len(frame) - int(last.sum())
            yield from _compared(frame.iloc[:cut], cosine)
            held = frame.iloc[cut:].reset_index(drop=True)
        if held is not None:
            yield from _compared(held, cosine)

    return run


def links(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, links, hub), several rows a node, from nodes (node, label, embedding, many) of usable vectors."""
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(most, cosine)
    code = "int" if bits < 32 else "long"
    codes = nodes.select("node", "embedding").mapInArrow(_codes(bits, tables), "node long, codes array<long>").withColumn("codes", F.col("codes").cast(f"array<{code}>"))
    held = kept(nodes.join(codes, "node").select("node", F.xxhash64(F.lit(1), "label").alias("lab"), F.xxhash64("label").alias("other"), "many", F.size("embedding").alias("size"), "embedding", "codes"))
    rows = held.select("node", "lab", "other", "size", F.posexplode("codes").alias("tab", "code")).select("node", "tab", F.xxhash64("lab", "other", "size", "tab", "code").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    dealt = rows.join(small_side(sizes), "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    blocks = dealt.withColumn("other", other).select("bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "tab", "node")
    blocks = blocks.join(held.drop("other"), "node").select(*_BLOCK, "chunk", "tab", "node", "lab", "many", "size", "embedding", "codes")
    return blocks.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "size", "node").mapInArrow(_compare(cosine), "node long, links long, hub long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row."""
    fine = "label IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    label = F.col(label_col) + 0.0 if df.schema[label_col].dataType.typeName() in ("float", "double") else F.col(label_col)  # one zero
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"), label.cast("string").alias("label"))
    key = F.concat_ws(":", F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding"), "label")
    rows = rows.withColumn("key", F.when(F.expr(fine), key))
    same = rows.where("key IS NOT NULL").groupBy("key").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("many"), F.min("id").alias("least"))
    nodes = kept(same.withColumn("node", F.monotonically_increasing_id()))
    found = kept(links(nodes, cosine))
    parts = kept(connected_components(found.select(F.col("node").alias("a"), F.col("hub").alias("b"))))
    direct = found.groupBy("node").agg(F.sum("links").alias("links"))
    slim = nodes.select("node", "key", "many", "least").join(parts, "node", "left").join(direct, "node", "left")
    named = kept(slim.select("key", "least", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"), F.col("component").isNotNull().alias("linked")))
    # A component of one node names itself; of the others the least id is taken before the join.
    least = named.where("linked").groupBy("component").agg(F.min("least").alias("lowest"))
    named = named.join(small_side(least), "component", "left").select("key", "n_links", F.when(F.col("linked"), F.col("lowest")).otherwise(F.col("least")).alias("component_id"))
    out = rows.select("id", "key").join(named, "key", "left").select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def op5_vectors(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
