"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, components.

SuperMinHash gives every element of a set a random permutation of the signature's places
and the value ``random + rank`` at each, so that the places of one element are spread
evenly and the estimate varies less than with independent hashes. Ranks are dealt one after
another for all elements of a slice at once; a document is finished as soon as no later
rank can lower any of its minima, after a few ranks for all but short texts.

Texts with equal sets are one node. Nodes that share a band meet in a bucket, but no
bucket is expanded into pairs. First every node is compared, on the full sets, with the best
connected node of the largest bucket it is in, then with that of each of its buckets that
still holds several groups. What is then still apart, and only that, meets by an exact prefix
filter: of two sets that are similar enough, the rarest shingles of each, as many as it may
lack of the other and one more, have one in common. Of the nodes of a shingle those outside
its largest group are held against the others. Nothing is capped. Texts with too many
shingles that no other candidate has are left out before, as nothing can be linked with
them; they are most of what would be compared in vain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.llm.components import components
from spendfall.llm.store import dropped, small_batches, stored
from spendfall.llm.textbytes import BASE, U64, Texts, distinct, list_column, mix, shingles, slices

GOLDEN = 0x9E3779B97F4A7C15
#: A power of two.
PARTS = 32


def super_minhash(values: np.ndarray, of: np.ndarray, n: int, places: int = 128) -> np.ndarray:
    """Signatures (n x places) of n sets; ``of`` (ascending) tells each value's set. Empty sets have infinite minima."""
    least = np.full((n, places), np.inf)
    order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(values), 1))
    rows = np.arange(len(values))
    live = np.bincount(of, minlength=n) > 0
    for rank in range(places):
        if not len(values):
            break
        draw = mix(values + U64(GOLDEN * (rank + 1) % 2**64))
        # Fisher-Yates, one step: what is drawn for this rank changes places with what stands there
        at = rank + (mix(draw ^ U64(0xD6E8FEB86659FD93)) % U64(places - rank)).astype(np.int64)
        place = order[rows, at].copy()
        order[rows, at] = order[rows, rank]
        order[rows, rank] = place
        np.minimum.at(least, (of, place.astype(np.int64)), rank + (draw >> U64(11)) * 2.0**-53)
        still = live & (least.max(1) > rank + 1)
        if not still.all():
            keep = still[of]
            if not keep.all():
                values, of, order = values[keep], of[keep], order[keep]
                rows = np.arange(len(values))
            live = still
    return least


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` places; equal keys are of the same band."""
    bits = np.ascontiguousarray(signature).view(U64)
    bands = bits.shape[1] // rows
    keys = np.tile(mix(np.arange(1, bands + 1).astype(U64) * U64(GOLDEN)), (len(bits), 1))
    for k in range(rows):
        keys = mix(keys * BASE + bits[:, k : bands * rows : rows])
    return keys


def _sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    texts = Texts.of(column).lowered()
    return *distinct(*shingles(texts, width, *texts.words())), len(texts)


def signatures(docs: DataFrame, id_col: str, text: str, width: int, places: int, rows: int) -> DataFrame:
    """(id, n_shingles, low, high, bands): the set's size, its fingerprint of 128 bits and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values, of, n = _sets(part.column(text), width)
                size = np.bincount(of, minlength=n)
                low, high = np.zeros(n, U64), np.zeros(n, U64)
                np.add.at(low, of, mix(values))
                np.add.at(high, of, mix(values ^ U64(0xA0761D6478BD642F)))
                some = np.flatnonzero(size)
                keys = np.zeros((n, places // rows), U64)
                keys[some] = band_keys(super_minhash(values, of, n, places)[some], rows)
                lists = list_column(keys[some].view(np.int64).ravel(), np.where(size > 0, places // rows, 0))
                yield pa.RecordBatch.from_arrays([part.column(id_col).cast(pa.int64()), pa.array(size), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), lists], names=["id", "n_shingles", "low", "high", "bands"])

    return docs.select(id_col, text).mapInArrow(run, "id long, n_shingles long, low long, high long, bands array<long>")


def shingle_sets(docs: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(node, shingles): each text's distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values, of, n = _sets(part.column(text), width)
                yield pa.RecordBatch.from_arrays([part.column(id_col).cast(pa.int64()), list_column(values.view(np.int64), np.bincount(of, minlength=n))], names=["node", "shingles"])

    return docs.select(id_col, text).mapInArrow(run, "node long, shingles array<long>")


def _plausible(sets: DataFrame, percent: int) -> DataFrame:
    """(node, reach, parts, n_shingles, shingles) of the sets that can have a link at all.

    A set that shares ``percent`` of a union has so much of itself in common with one other
    set; one with more shingles of its own than the rest is linked with nothing. ``parts``
    counts the shingles that other candidates have too, by a part of their hash: two sets
    share no more than the sum of the smaller counts of each part.
    """
    single = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    own = single.groupBy("node").agg(F.collect_list("shingle").alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for values, alone in zip(batch.column("shingles"), batch.column("own"), strict=True):
                values = np.asarray(values.values)
                if alone.is_valid:
                    values = np.setdiff1d(values, np.asarray(alone.values), assume_unique=True)
                counts.append(np.bincount(values & (PARTS - 1), minlength=PARTS))
            parts = np.array(counts, np.int32).reshape(-1, PARTS)
            reach = parts.sum(1, dtype=np.int64) * (100 + percent)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(reach), list_column(parts.ravel(), np.full(len(parts), PARTS)), batch.column("shingles")], names=["node", "reach", "parts", "shingles"])

    found = sets.join(own, "node", "left").select("node", "shingles", "own").mapInArrow(run, "node long, reach long, parts array<int>, shingles array<long>")
    found = found.withColumn("n_shingles", F.size("shingles").cast("long"))
    return found.where(f"100L * reach >= {percent * (100 + percent)}L * n_shingles")


def _several(rows: DataFrame, key: str) -> DataFrame:
    """Those keys of ``rows`` under which nodes of two groups or more meet."""
    return rows.groupBy(key).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select(key)


def _linked(pairs: DataFrame, plausible: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) of different groups whose sets share ``percent`` of their union or more.

    Two sets of n and m shingles that share i have the similarity i / (n + m - i). Pairs of
    which even the smaller counts of each part are too few go before sets are compared.
    """
    parts = plausible.select("node", "parts", "n_shingles")
    first = pairs.distinct().join(parts.selectExpr("node as u", "parts as some", "n_shingles as n"), "u").join(parts.selectExpr("node as v", "parts as others", "n_shingles as m"), "v")
    able = stored(first.where(f"{_most('some', 'others')} * {100 + percent}L >= {percent}L * (n + m)").select("u", "v"), "pairs")
    sets = plausible.select("node", "shingles")
    both = able.join(sets.selectExpr("node as u", "shingles as left"), "u").join(sets.selectExpr("node as v", "shingles as right"), "v")
    common = both.select("u", "v", F.size(F.array_intersect("left", "right")).alias("same"), (F.size("left") + F.size("right")).alias("total"))
    return common.where(f"100L * same >= {percent}L * (total - same)").select("u", "v")


def _able(percent: int) -> str:
    """Whether the sizes of two sets, and what each shares with any other, leave room for a link."""
    return f"least(reach, most) >= {percent}L * (n_shingles + size)"


def _most(some: str, others: str) -> str:
    """The most that two sets can share by the counts of their parts."""
    return f"aggregate(zip_with({some}, {others}, (a, b) -> least(a, b)), 0L, (s, x) -> s + x)"


def _grouped(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with the groups that ``links`` and their present ones make together."""
    known = nodes.where("component <> node").select(F.col("node").alias("u"), F.col("component").alias("v"))
    reached = components(links.union(known)).withColumnRenamed("component", "to")
    return nodes.join(reached, "node", "left").withColumn("component", F.coalesce("to", "node")).drop("to")


def _starred(nodes: DataFrame, buckets: DataFrame, plausible: DataFrame, percent: int) -> DataFrame:
    """Groups after every node of ``buckets`` (node, bucket, ...) is compared with the best connected one in each."""
    centre = buckets.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("back"), "n_shingles", "reach", "component")).alias("c"))
    centre = centre.select("bucket", (-F.col("c.back")).alias("u"), F.col("c.n_shingles").alias("size"), F.col("c.reach").alias("most"), F.col("c.component").alias("of"))
    pairs = buckets.join(centre, "bucket").where(f"component <> of and {_able(percent)}").select("u", F.col("node").alias("v"))
    return stored(_grouped(nodes, _linked(pairs, plausible, percent)), "nodes")


def _by_prefix(nodes: DataFrame, plausible: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``nodes`` of different groups that have one of their rarest shingles in common.

    All that are similar enough are among them: sets that lack a shingle of each other's
    rarest n - ceil(n * percent / 100) + 1 share too few of the rest. The first shingle that
    two sets share also tells how many they can share at most, by its places in both.
    """
    own = nodes.select("node", "n_shingles", "reach", "component").join(plausible.select("node", "parts", "shingles"), "node")
    each = own.select("node", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = each.join(common, "shingle").withColumn("rank", F.expr("row_number() over (partition by node order by n, shingle)"))
    first = own.drop("shingles").join(ranked, "node").where(f"n > 1 and rank <= n_shingles - ceil(n_shingles * {percent} / 100) + 1").drop("n")
    prefix = stored(first, "prefixes")
    groups = prefix.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    main = groups.groupBy("shingle").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("groups")).where("groups > 1")
    open_ = prefix.join(main, "shingle")
    minor = open_.where("component <> main").select("shingle", F.col("node").alias("u"), F.col("n_shingles").alias("size"), F.col("reach").alias("most"), F.col("component").alias("of"), F.col("rank").alias("place"), F.col("parts").alias("others"))
    least = f"{percent}L * (n_shingles + size)"
    may = f"{100 + percent}L * (1 + least(n_shingles - rank, size - place)) >= {least} and {_most('parts', 'others')} * {100 + percent}L >= {least}"
    met = open_.join(minor, "shingle").where(f"component <> of and (component = main or u < node) and {_able(percent)} and {may}")
    return met.select("u", F.col("node").alias("v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    places: int = 128,
    rows: int = 4,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two texts are linked if their sets of ``width``-word shingles have a Jaccard similarity
    of ``percent`` hundredths or more; A-Z count as a-z. A text with fewer words is one
    shingle. Null, empty and wordless texts are linked with nothing. ``component_id`` is
    the smallest id that can be reached, ``kept`` whether it is the row's own. Repeated
    rows share a result; a row without an id is linked with nothing and kept. Other
    columns of ``docs`` are not looked at. Ids are integers.
    With 32 bands of 4 places a pair at 0.8 is missed once in 10^7 times, at 0.85 once in 10^10.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(id_col, text)
    marked = stored(signatures(docs, id_col, text, width, places, rows), "signatures")
    some = marked.where("id is not null and n_shingles > 0")
    classes = stored(some.groupBy("low", "high").agg(F.min("id").alias("node")), "classes")
    heads = some.join(classes, ["low", "high"]).where("id = node").select("node", "n_shingles", "bands").dropDuplicates(["node"])
    places_of = stored(heads.select("node", F.explode("bands").alias("bucket")), "bands")
    shared = places_of.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = places_of.join(shared, "bucket").groupBy("node").agg(F.collect_list(F.struct("n", "bucket")).alias("buckets"), F.sum("n").alias("degree"))
    members = stored(met, "members")
    dropped(places_of)
    sets = stored(shingle_sets(docs.join(members.select(F.col("node").alias(id_col)), id_col, "left_semi").dropDuplicates([id_col]), id_col, text, width), "sets")
    plausible = stored(_plausible(sets, percent), "plausible")
    dropped(sets)
    # one row a node, with all its buckets; the original of a family of edited copies shares most bands with most of them
    nodes = stored(members.join(plausible.select("node", "reach", "n_shingles"), "node").withColumn("component", F.col("node")), "nodes")
    dropped(members)
    known = ["node", "n_shingles", "reach", "degree", "component"]
    nodes = _starred(nodes, nodes.select(*known, F.array_max("buckets")["bucket"].alias("bucket")), plausible, percent)
    for last in (False, True):
        buckets = nodes.select(*known, F.explode("buckets.bucket").alias("bucket"))
        open_ = buckets.join(_several(buckets, "bucket"), "bucket", "left_semi")
        if last:
            rest = nodes.join(open_.select("node").distinct(), "node", "left_semi")
            nodes = stored(_grouped(nodes, _linked(_by_prefix(rest, plausible, percent), plausible, percent)), "nodes")
        else:
            nodes = _starred(nodes, open_, plausible, percent)
    labels = stored(nodes.select("node", "component"), "labels")
    dropped(plausible, nodes)
    groups = classes.join(labels, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    found = marked.join(groups.select("low", "high", "component_id"), ["low", "high"], "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, unchanged; see :func:`near_duplicates`."""
    found = near_duplicates(docs, id_col, text, **how)
    # an id that is kept with one of its texts stays with all of them
    gone = found.groupBy(id_col).agg(F.max("kept").alias("kept")).where("not kept").select(id_col)
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
