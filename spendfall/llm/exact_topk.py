"""Exact top-k by inner product: tiles of queries and candidate shards, lists merged as a tree.

Queries are gathered into blocks and candidates into shards of a bounded number of vectors.
Every block meets every shard once, as two small matrices: their product is one matrix
multiplication, from which each query keeps its k best. The short lists of a block are then
merged in groups of shards, level by level, so no task holds more than ``MERGED`` lists of
one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendfall.llm.store import small_batches

#: Vectors in a block of queries and in a shard of candidates; lists that are merged at once.
BLOCK = 1024
SHARD = 4096
MERGED = 16
#: Products below this are exact as doubles.
EXACT = float(1 << 53)


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component x; null for a vector that is null or holds null, infinite or undefined ones."""
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _tiles(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """(dims, name, ids, values): vectors of a width gathered into pieces of about ``size``, as flat arrays.

    Pieces are dealt by a hash of the row with its copy number, so equal rows need not meet in
    one piece; a piece is ordered, so a task that is run again makes the same one.
    """
    widths = vectors.groupBy("dims").agg(F.count("*").alias("n"))
    pieces = vectors.join(widths, "dims").withColumn(name, F.pmod(F.xxhash64("id", "vector", "copy"), F.ceil(F.col("n") / size).cast("bigint")))
    return pieces.groupBy("dims", name).agg(F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("rows")).select(
        "dims", name, F.col("rows.id").alias("ids"), F.flatten("rows.vector").alias("values")
    )


def _dealt(blocks: DataFrame, shards: DataFrame, tasks: int) -> DataFrame:
    """Every block with every shard of its width, spread over ``tasks`` tasks by block and shard.

    The number of tasks is stated, because tiles are small as bytes and much as work: merged
    by size they would end in one task.
    """
    key = ["dims", "block", "shard"]
    n_blocks = blocks.groupBy("dims").agg((F.max("block") + 1).alias("n"))
    n_shards = shards.groupBy("dims").agg((F.max("shard") + 1).alias("n"))

    def each(frame: DataFrame, numbers: DataFrame, name: str) -> DataFrame:
        numbered = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias(name)
        return frame.join(numbers, "dims").select(*frame.columns, numbered).repartition(tasks, *key)

    return each(shards, n_blocks, "block").join(each(blocks, n_shards, "shard"), key)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and score of the k best columns of every row, ties to the smaller id; columns ordered by id."""
    rows, places = [], []
    allowed = ids[None, :] != own[:, None]
    for row in range(len(scores)):
        at = np.flatnonzero(allowed[row])
        value = scores[row, at]
        if len(at) > k:
            # all that are no worse than the k-th, then in order
            least = np.partition(value, len(value) - k)[len(value) - k]
            sure, tied = np.flatnonzero(value > least), np.flatnonzero(value == least)
            chosen = np.concatenate((sure, tied[: k - len(sure)]))
            at, value = at[chosen], value[chosen]
        rows.append(np.full(len(at), row))
        places.append(at)
    row, place = np.concatenate(rows), np.concatenate(places)
    return row, ids[place], scores[row, place]


def _product(left: np.ndarray, right: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, where ``needed``."""
    most = float(np.abs(left.astype(float)).max(initial=0)) * float(np.abs(right.astype(float)).max(initial=0)) * left.shape[1]
    if most < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    if most < float(1 << 62):
        return left @ right.T
    out = left.astype(object) @ right.astype(object).T
    out[~needed] = 0
    if any(abs(x) >= 1 << 63 for x in out.ravel()):
        raise OverflowError("An inner product does not fit into 64 bits.")
    return out.astype(np.int64)


def exact_topk(queries: DataFrame, candidates: DataFrame, id_col: str, vector: str, k: int = 5) -> DataFrame:
    """(query_id, rank, id, score) of the k best candidates of each query by integer inner product.

    ``vector`` holds arrays of whole numbers. A candidate with the query's id is the query's
    own and left out; fewer than k others are all returned. Ties go to the smaller id.
    Null vectors, null ids and vectors without components take no part; vectors only meet
    those of their own width. Repeated query rows are one query; repeated candidate rows
    each count. Two different vectors under one id are two queries and share its ranks.
    Other columns are not looked at. A product beyond 64 bits is refused.
    """

    def rows(frame: DataFrame, copies: int) -> DataFrame:
        sound = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("vector")).where("id is not null and size(vector) > 0")
        counted = sound.groupBy("id", "vector").agg(F.least(F.count("*"), F.lit(copies)).alias("n"))
        return counted.select("id", "vector", F.size("vector").alias("dims"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))

    spark = queries.sparkSession
    small_batches(spark)
    blocks = _tiles(rows(queries, 1), BLOCK, "block").withColumnsRenamed({"ids": "own", "values": "asked"})
    # of equal rows no more than k can be among the k best
    shards = _tiles(rows(candidates, k), SHARD, "shard")
    n_candidates = candidates.count()
    n_tiles = math.ceil(queries.count() / BLOCK) * math.ceil(n_candidates / SHARD)
    tiles = _dealt(blocks, shards, max(1, min(n_tiles, int(spark.conf.get("spark.sql.shuffle.partitions")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in range(batch.num_rows):
                dims, block, shard = (batch.column(name)[tile].as_py() for name in ("dims", "block", "shard"))
                own, asked, ids, values = (np.asarray(batch.column(name)[tile].values) for name in ("own", "asked", "ids", "values"))
                order = np.argsort(ids, kind="stable")
                ids, values = ids[order], values.reshape(-1, dims)[order]
                asked = asked.reshape(-1, dims)
                row, id_, score = _best(_product(asked, values, ids[None, :] != own[:, None]), ids, own, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), dims, np.int32)), pa.array(np.full(len(row), block)), pa.array(np.full(len(row), shard)), pa.array(row), pa.array(own[row]), pa.array(id_), pa.array(score)], names=["dims", "block", "shard", "place", "query_id", "id", "score"])

    kept = "dims int, block long, shard long, place long, query_id long, id long, score long"
    lists = tiles.mapInArrow(run, kept)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "score", "id"], ascending=[True, False, True], kind="stable")
        return frame[frame.groupby("place").cumcount() < k]

    # as many levels as it takes for the most shards of a width to become one
    most = n_candidates / SHARD
    width = MERGED
    while True:
        lists = lists.withColumn("group", F.floor(F.col("shard") / MERGED)).groupBy("dims", "block", "group").applyInPandas(lambda f: merge(f.drop(columns="group").assign(shard=f["group"])), kept)
        if width > most:
            break
        width *= MERGED
    rank = F.row_number().over(Window.partitionBy("dims", "block", "place").orderBy(F.desc("score"), "id"))
    return lists.select("query_id", rank.cast("int").alias("rank"), "id", "score").withColumnRenamed("id", id_col)
