"""MinHash near-duplicate groups of whole texts.

1. Each text's set of 5-word shingles gets ``MINIMA`` universal hash minima.
   Texts with equal sets form a class, and one representative goes on.
2. ``BANDS`` band keys per representative are range-partitioned and sorted, so
   equal keys are neighbours, and a hot key spreads over several partitions.
   A bucket of up to ``SMALL`` gives all its pairs; a larger one, or one cut by
   a partition's edge, ties its members to its first.
3. Signatures verify these pairs: an estimate over ``MARGIN`` below the
   threshold (more than five standard deviations) drops a pair. The rest are
   confirmed on the full shingle sets.
4. Components of the confirmed links come from alternating large-star and
   small-star.
5. A larger bucket whose members now share one component is done. In the
   others, every pair across components is compared: by signature, then on the
   full sets, block by block inside the tasks, which only hand on confirmed
   links. A final round of components joins these links in.

So each pair that shares a band key is either in one component already or is
compared, whatever the bucket's size. A pair at the threshold shares no key
with a chance of 6e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .components import components
from .shingles import BANDS, MINIMA, band_keys, shingle_sets, signature, similar

SMALL = 8
THRESHOLD, MARGIN = 0.75, 0.2
#: Members of an open bucket that one task compares with as many others.
MEMBERS = 1024


def signatures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document: ``doc``, ``n_shingles``, ``digest`` of the set, ``keys`` of its bands (little-endian int64) and ``sketch``, a byte of each minimum; null for an empty set."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), text_or_empty(text_column).cast("binary").alias("_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, digest, keys, sketch = [], [], [], []
            for s in shingle_sets(batch.column(1).to_pylist()):
                minima = signature(s) if len(s) else None
                count.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s) if len(s) else None)
                keys.append(None if minima is None else band_keys(minima[None]).astype("<i8").tobytes())
                sketch.append(None if minima is None else (minima & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), *(pa.array(c, pa.binary()) for c in (digest, keys, sketch))],
                ["doc", "n_shingles", "digest", "keys", "sketch"])

    return rows.mapInArrow(run, "doc long, n_shingles long, digest binary, keys binary, sketch binary")


def _band_rows(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["key", "rep"])

    return reps.select("rep", "keys").mapInArrow(run, "key long, rep long")


def _bucket_pairs(sorted_rows: DataFrame) -> DataFrame:
    """From (key, rep) sorted within partitions: pairs (a, b), with the key where the bucket is open (large, or cut by an edge).

    The rows of an open bucket tie each member to its first one here, and name
    that first one as (key, a, a).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, a, b, is_open) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64(), mask=~is_open), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["key", "a", "b"])

        def closed(keys: np.ndarray, reps: np.ndarray, first_open: bool, last_open: bool) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(starts, len(keys)))
            large = counts > SMALL
            if len(large):
                large[0] |= first_open
                large[-1] |= last_open
            group = np.repeat(np.arange(len(starts)), counts)
            in_large = large[group]
            first = reps[starts][group]
            parts = [(keys[in_large], first[in_large], reps[in_large], np.ones(int(in_large.sum()), bool))]
            for step in range(1, SMALL):  # pairs at distance `step` in small buckets
                i = np.flatnonzero((group[step:] == group[:-step]) & ~in_large[step:]) if len(group) > step else np.zeros(0, np.int64)
                parts.append((keys[i], reps[i], reps[i + step], np.zeros(len(i), bool)))
            return out(*(np.concatenate(c) for c in zip(*parts)))

        keys, reps, first = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            reps = np.concatenate([reps, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on in the next batch
            if cut == 0 and len(keys) > 1:
                # one bucket throughout: hand its members on, tied to the first, and keep that one
                yield out(keys[1:], np.repeat(reps[:1], len(keys) - 1), reps[1:], np.ones(len(keys) - 1, bool))
                keys, reps = keys[:1], reps[:1]
                first = True
            elif cut:
                yield closed(keys[:cut], reps[:cut], first, False)
                keys, reps, first = keys[cut:], reps[cut:], False
        if len(keys):
            yield closed(keys, reps, True, True)

    return sorted_rows.mapInArrow(run, "key long, a long, b long")


def _set(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(_set(x.as_py()), _set(y.as_py())) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree well enough, by one byte of each minimum (which only adds agreement)."""
    both = pairs.join(reps.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(
        reps.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b")), "b").select("a", "b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in (2, 3))
            agree = (a == b).mean(1)
            yield batch.select([0, 1]).filter(pa.array(agree >= THRESHOLD - MARGIN))

    return both.mapInArrow(run, "a long, b long")


def _cross_links(open_members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links (u, v) between different components within open buckets."""
    labelled = written(
        open_members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component")), "open-buckets")
    per_component = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    # the bucket's largest component is compared with the rest, but not within itself
    buckets = per_component.groupBy("key").agg(
        F.count(F.lit(1)).alias("_components"), F.sum("n").alias("_n"), F.max(F.struct("n", "component")).alias("_main")
    ).where("_components > 1").select("key", F.col("_main.component").alias("_main"), F.col("_main.n").alias("_n_main"), (F.col("_n") - F.col("_main.n")).alias("_n_rest"))
    buckets = written(buckets, "minhash-unresolved")  # so that the join below can split a hot key's rows
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / MEMBERS)).cast("int")
    members = labelled.join(buckets, "key").select(
        "key", "rep", "component", (F.col("component") == F.col("_main")).alias("_in_main"), blocks("_n_rest").alias("_rest"), blocks("_n_main").alias("_mains"))
    block = F.pmod(F.xxhash64("rep"), F.when(F.col("_in_main"), F.col("_mains")).otherwise(F.col("_rest"))).cast("int")
    members = members.withColumn("_block", block)
    # task (i, j): rest block i against rest block j >= i; task (i, -1 - j): against main block j
    with_main = F.transform(F.sequence(F.lit(0), F.col("_rest") - 1), lambda i: F.struct(i.alias("i"), (-1 - F.col("_block")).alias("j")))
    of_rest = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("_rest") - 1), lambda x: F.struct(F.least(x, F.col("_block")).alias("i"), F.greatest(x, F.col("_block")).alias("j"))),
        F.transform(F.sequence(F.lit(0), F.col("_mains") - 1), lambda x: F.struct(F.col("_block").alias("i"), (-1 - x).alias("j"))),
    )
    tasks = members.withColumn("_task", F.explode(F.when(F.col("_in_main"), with_main).otherwise(of_rest))).select(
        "key", "rep", "component", "_in_main", "_block", F.col("_task.i").alias("_i"), F.col("_task.j").alias("_j"))
    rows = tasks.join(sets, "rep")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        frame = frame.drop_duplicates("rep").sort_values("rep")
        full = [_set(x) for x in frame["set"]]
        sig = np.stack([signature(x) for x in full])
        rep, component = frame["rep"].to_numpy(), frame["component"].to_numpy()
        left = (~frame["_in_main"] & (frame["_block"] == i)).to_numpy()
        right = (frame["_in_main"] if j < 0 else ~frame["_in_main"] & (frame["_block"] == j)).to_numpy()
        parent: dict[int, int] = {}  # of components joined here

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        # a pair that shares several band keys is compared in the first one's bucket only
        band = int(np.flatnonzero(band_keys(sig[:1])[0] == key[0])[0])
        links = []
        others = np.flatnonzero(right)
        lengths = np.array([len(x) for x in full])
        for x in np.flatnonzero(left):
            ys = others[others > x] if i == j else others
            ys = ys[component[ys] != component[x]]
            small, large = np.minimum(lengths[ys], lengths[x]), np.maximum(lengths[ys], lengths[x])
            ys = ys[small >= THRESHOLD * large]  # no other sizes can be similar
            if not len(ys):
                continue
            equal = sig[ys] == sig[x]
            agree = equal.mean(1)
            here = equal.reshape(len(ys), BANDS, -1).all(2).argmax(1) == band
            ys, agree = ys[here], agree[here]
            for y in ys[np.argsort(-agree, kind="stable")][: int((agree >= THRESHOLD - MARGIN).sum())]:
                a, b = root(int(component[x])), root(int(component[y]))
                if a != b and similar(full[x], full[y]):
                    parent[a] = b
                    links.append((rep[x], rep[y]))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return rows.groupBy("key", "_i", "_j").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when their sets' similarity is at least 0.75. The
    component is the smallest id that links reach, and the document with that
    id is kept. Null and empty texts, and texts without words, have no
    shingles and no links. Rows that share an id are one document for the
    links and share its fate. A null id has no links, a null component, and is
    kept. Empty tables give no rows; other columns are ignored.
    """
    signed = written(signatures(docs, id_column, text_column), "minhash-signed")
    in_links = signed.where(F.col("digest").isNotNull() & F.col("doc").isNotNull())
    # equal sets have equal keys and sketches, so any of the class will do
    classes = written(in_links.groupBy("digest").agg(F.min("doc").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "minhash-classes")
    reps = classes.select("rep", "keys", "sketch")
    bands = _band_rows(reps).repartitionByRange("key", "rep").sortWithinPartitions("key", "rep")
    tied = written(_bucket_pairs(bands), "minhash-buckets")
    cut = tied.where("key is not null and a = b").groupBy("key").agg(F.min("a").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    across = tied.where("key is not null and a = b").join(cut, "key").where("a <> first").select(F.col("first").alias("a"), F.col("a").alias("b"))
    pairs = tied.where("a <> b").select("a", "b").unionByName(across).distinct()
    plausible = written(_plausible(pairs, reps), "minhash-pairs")
    open_members = tied.where("key is not null").select("key", F.col("b").alias("rep"))
    # a bucket of one row has no pair
    shared = written(open_members.groupBy("key").agg(F.countDistinct("rep").alias("n")).where("n > 1").select("key"), "minhash-shared")
    open_members = written(open_members.join(shared, "key", "left_semi").distinct(), "minhash-open")
    needed = plausible.select(F.col("a").alias("doc")).unionByName(plausible.select(F.col("b").alias("doc"))).unionByName(open_members.select(F.col("rep").alias("doc"))).distinct()
    # as many ids as near-duplicates: no bound to broadcast them by, so a merge join at every size
    sets = written(_sets(docs.join(needed.hint("merge"), F.col(id_column).cast("long") == F.col("doc"), "left_semi"), id_column, text_column), "minhash-sets")

    links = written(_confirmed(plausible, sets).select(F.col("a").alias("u"), F.col("b").alias("v")), "minhash-links")
    labels = components(links)
    more = written(_cross_links(open_members, labels, sets), "minhash-links")
    labels = components(links.unionByName(more))
    by_class = classes.select("digest", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("_component"))
    return signed.select("doc", "n_shingles", "digest").join(by_class, "digest", "left").select(
        F.col("doc").alias(id_column), "n_shingles", F.coalesce("_component", "doc").alias("component_id"),
        (F.col("doc").isNull() | (F.coalesce("_component", "doc") == F.col("doc"))).alias("kept"),
    )


def _sets(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias("rep"), text_or_empty(text_column).cast("binary").alias("_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "set"])

    return rows.mapInArrow(run, "rep long, set binary").where(F.octet_length("set") > 0)
