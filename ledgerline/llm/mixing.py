"""Mixing sources to target weights: balanced sampling by the cube method.

Each source has a target number of words; its ratio to what the source holds says how often each of its documents is
taken: the whole part always, the fraction as an inclusion probability. The cube method (Deville and Tillé, 2004)
turns the probabilities into choices: a vector of probabilities moves in the null space of two constraints, the
numbers of words and of documents, until at most two are undecided. Blocks are bounded shares of a source by a hash
of the id; each holds a few documents back, and what they leave undecided forms the blocks of the next round, some
25 times fewer, until a source has one block. What that leaves, ten documents at most, is the landing problem: it
is rounded to the combination that keeps the source's words closest to its target.

Rows: null texts have size 0; a null source is a source, last in order; rows equal in id, source and size are counted
first and then numbered, so that a hot or null id is spread over blocks like any other rows, each with a choice of its
own; ids of any type pass unchanged; an empty table gives an empty result; other columns are ignored. Choices depend on ids, sizes
and those numbers alone, so reruns agree.
"""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, kept, table

#: Rows of a block, about; a block is one group of a shuffle.
BLOCK = 256
#: Documents that a block holds back for the landing.
HELD = 8
#: Equal rows that are numbered at once.
STRIDE = 1024
#: No document is taken more often.
MOST = 3


def ranked(rows: DataFrame, order: Column) -> DataFrame:
    """Adds `rank`, from 1, in the given order: by ranges, each of which is numbered on its own."""
    placed = kept(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    # One row a range.
    counts = placed.groupBy("_part").count().select("_part", F.expr("sum(count) OVER (ORDER BY _part) - count").alias("_before"))
    return placed.join(counts, "_part").withColumn("rank", F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(order))).drop("_part", "_before")


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = MOST) -> DataFrame:
    """Adds `target` to a table (source, source_size): a weighted share of all words, at most `most` times the source's.

    One row a source: sources are ranked by code point, null last, and weights repeat along that order. All sources get
    the same number of words for a unit of weight but for those that this would lift above their limit, which get their limit;
    what they leave lifts the others, until no more are cut.
    """
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    rows = kept(ranked(sources, F.col("source").asc_nulls_last()).withColumn("weight", weight))
    level, cut = 0.0, -1
    while True:
        full = F.col("source_size") * float(most) < F.col("weight") * level
        all_, held, n, open_ = rows.agg(F.sum("source_size"), F.sum(F.when(full, F.col("source_size"))), F.count_if(full), F.sum(F.when(~full, F.col("weight")))).first()
        if n == cut or not all_ or not open_:
            break
        cut, level = n, (all_ - float(most) * (held or 0)) / open_
    return rows.withColumn("target", F.least(F.col("source_size") * float(most), F.col("weight") * level)).drop("weight", "rank")


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities until at most HELD + 2 are neither 0 nor 1, keeping their sum and their sum of sizes."""
    p, size, draw = prob.tolist(), size.tolist(), rng.random(len(prob) + 3).tolist()
    live = [i for i, x in enumerate(p) if 0 < x < 1][: -HELD or None]
    hand, rest = live[:3], iter(live[3:])
    while len(hand) >= 2:
        if len(hand) == 3:
            a, b, c = (size[i] for i in hand)
            way = (c - b, a - c, b - a)
            if a == b == c:
                way = (1, -1, 0)
        elif size[hand[0]] == size[hand[1]]:
            way = (1, -1)
        else:
            break
        up = min((1 - p[i]) / w if w > 0 else -p[i] / w for i, w in zip(hand, way, strict=True) if w)
        down = min(p[i] / w if w > 0 else (p[i] - 1) / w for i, w in zip(hand, way, strict=True) if w)
        step = up if draw.pop() * (up + down) < down else -down
        for i, w in zip(hand, way, strict=True):
            x = p[i] + step * w
            p[i] = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
        hand = [i for i in hand if 0 < p[i] < 1]
        while len(hand) < 3 and (i := next(rest, None)) is not None:
            hand.append(i)
        if not draw:
            draw = rng.random(len(p)).tolist()
    return np.array(p)


def landing(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the few undecided so that the words differ least from what is expected, then the documents."""
    open_ = np.nonzero((prob > 0) & (prob < 1))[0]
    out = prob.copy()
    if len(open_):
        ways = np.array(list(product((0.0, 1.0), repeat=len(open_)))) - prob[open_]
        words, documents = np.abs(ways @ size[open_]), np.abs(ways.sum(axis=1))
        out[open_] = prob[open_] + ways[np.lexsort((documents, words))[0]]
    return np.round(out, 9)


def _move(group: pa.Table) -> pa.Table:
    group = group.take(pc.sort_indices(group, [("place", "ascending"), ("size", "ascending"), ("nth", "ascending")]))
    seed = zlib.crc32(repr((group["source"][0].as_py(), group["place"][0].as_py())).encode())
    size = group["size"].to_numpy().astype(float)
    p = flight(group["p"].to_numpy(), size, np.random.default_rng(seed))
    p = landing(p, size) if group["last"][0].as_py() else p
    return group.set_column(group.schema.get_field_index("p"), "p", pa.array(p))


def balanced(rows: DataFrame) -> DataFrame:
    """Turns `p` of rows (row_id, source, size, nth, p) into 0 or 1, with p's sums by source kept but for the landing."""
    decided, turn, names = [], 0, rows.columns
    while True:
        # Blocks of a source: counted by source, then dealt by a hash that differs in every round.
        counts = rows.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        place = F.xxhash64(F.lit(turn), "row_id", "size", "nth")
        dealt = rows.join(counts, rows["source"].eqNullSafe(counts["source"])).select(
            rows["*"], place.alias("place"), F.pmod(place, F.col("blocks")).alias("block"), (F.col("blocks") == 1).alias("last")
        )
        moved = kept(dealt.groupBy("source", "block").applyInArrow(_move, dealt.schema).select(*names))
        decided.append(moved.where("p = 0 OR p = 1"))
        rows, turn = moved.where("p > 0 AND p < 1"), turn + 1
        if rows.isEmpty():
            break
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: float = MOST) -> DataFrame:
    """(id_col, size, source, source_size, target, copies) for every row: how often the mix takes it."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    equal = kept(df.select(F.col(id_col).alias("row_id"), F.col(source_col).alias("source"), size).groupBy("row_id", "source", "size").agg(F.count("*").alias("many")))
    aims = targets(equal.groupBy("source").agg(F.sum(F.col("size") * F.col("many")).alias("source_size")), weights, most)
    # A row a source: the join is by source, and adaptive execution splits a source that holds a large share of rows.
    ratio = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    ratio = F.when(F.abs(ratio - F.round(ratio)) < 1e-9, F.round(ratio)).otherwise(ratio)
    rows = equal.join(aims, equal["source"].eqNullSafe(aims["source"])).select(equal["*"], "source_size", "target", F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("p"))
    rows = rows.select("*", F.expr(f"explode(sequence(0L, (many - 1) div {STRIDE}))").alias("stride"))
    rows = rows.select("*", F.expr(f"explode(sequence(stride * {STRIDE}, least(many, (stride + 1) * {STRIDE}) - 1))").alias("nth")).drop("stride", "many")
    chosen = balanced(rows)
    return chosen.select(F.col("row_id").alias(id_col), "size", "source", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))


def op7_mix(spark, sf_dir):
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
