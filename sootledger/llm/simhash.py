"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, verified distances, components."""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.rules import flagged
from sootledger.llm.shared import column_named, components, cut, documents, numbered, renamed, row_hash

BITS = 64
TILE = 512
BANDS, DEPTH = 20, 5  # a pair of similarity 0.8 shares a band in all but 4 of 10,000 cases


def fingerprint(text: bytes | None, size: int = 4) -> int:
    """SimHash of the shingles of `size` words, repeats included; no word gives zero."""
    found = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    if len(found) < size:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(size))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = 4) -> DataFrame:
    """All columns but the text, and `fp`, the 64-bit fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != text]

    def each(batches):
        for batch in batches:
            raw = batch.column(text).cast(pa.binary())
            fp = np.array([fingerprint(t.as_py(), size) for t in raw], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fp)], names=[*kept, "fp"])

    schema = docs.select(*kept).withColumn("fp", F.lit(0).cast("long")).schema
    return docs.mapInArrow(each, schema)


def blocks_for(n: int, distance: int) -> int:
    """Number of blocks, so that a key has at least four times as many values as there are fingerprints."""
    need = log2(max(n, 2)) + 2
    for blocks in range(distance + 2, BITS):
        if BITS * (blocks - distance) / blocks >= min(need, 44):
            return blocks
    raise ValueError("distance too large")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of every choice of blocks that a pair within the distance may share whole."""
    ends = [BITS * i // blocks for i in range(blocks + 1)]
    part = [((1 << (e - s)) - 1) << s for s, e in zip(ends, ends[1:])]
    masks = [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]
    assert len(masks) == comb(blocks, distance)
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _forest(fps: np.ndarray, split: int, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs within the distance.

    split > 0: only pairs of one of the first `split` rows with one of the others.
    """
    root = np.arange(len(fps))
    links = []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left = range(split) if split else range(len(fps) - 1)
    for i in left:
        first = split or i + 1
        for j in np.nonzero(np.bitwise_count(fps[first:] ^ fps[i]) <= distance)[0] + first:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((i, int(j)))
    return links


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs within the distance do.

    `fps` has distinct fingerprints `fp`. Two of them within the distance agree on all but
    `distance` of the blocks, so they meet under one choice of blocks. Keys with one member go.
    A key with many members is cut into tiles of bounded size, each pair of tiles is compared
    in a task of its own, and only a spanning forest leaves it: no pair is lost, none is emitted
    that adds nothing.
    """
    masks = block_masks(blocks_for(fps.count(), distance), distance)
    keyed = fps.select(
        "fp",
        F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                            for i, m in enumerate(masks)))).alias("k"),
    ).select("fp", "k.choice", "k.key")
    shared = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keyed.join(shared, ["choice", "key"]).withColumn("tiles", F.ceil(F.col("n") / TILE))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    tiles = met.select(
        "fp", "choice", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    ).select("fp", "choice", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    group = ["choice", "key", "i", "j"]

    def verify(batches):
        held, at = [], None

        def done(rows):
            rows.sort(key=lambda r: r[4] != r[2])
            split = sum(r[4] == r[2] for r in rows) if at[2] != at[3] else 0
            if at[2] != at[3] and split in (0, len(rows)):
                return []
            values = np.array([r[5] for r in rows], dtype=np.int64).view(np.uint64)
            return [(rows[i][5], rows[j][5]) for i, j in _forest(values, split, distance)]

        for batch in batches:
            found = []
            for r in zip(*(batch.column(c).to_pylist() for c in (*group, "own", "fp"))):
                if r[:4] != at:
                    if len(held) > 1:
                        found += done(held)
                    held, at = [], r[:4]
                held.append(r)
            if found:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found])
        if len(held) > 1 and (found := done(held)):
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found])

    return (
        tiles.repartition(*group).sortWithinPartitions(*group).mapInArrow(verify, "a long, b long").distinct()
    )


def shingles(text: bytes | None, size: int = 5) -> np.ndarray:
    """Hashes of the distinct shingles of `size` words, sorted; a shorter text is one shingle, an empty one has none."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    pieces = [b" ".join(found)] if len(found) < size else map(b" ".join, zip(*(found[i:] for i in range(size))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), dtype="<u8"))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band: a hash of the DEPTH smallest values of the set under hash functions of its own."""
    draws = np.random.default_rng(11).integers(1, 1 << 63, (2, BANDS * DEPTH), dtype=np.uint64)
    least = np.full(BANDS * DEPTH, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 4096):
        x = hashes[i : i + 4096, None] ^ draws[0]
        x = (x ^ (x >> np.uint64(31))) * (draws[1] | np.uint64(1))
        least = np.minimum(least, (x ^ (x >> np.uint64(29))).min(axis=0))
    rows = least.reshape(BANDS, DEPTH)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), 42) for r in rows], dtype=np.uint64)


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets have at least the given share of common members."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (len(a) + len(b) - common)


def sketches(docs: DataFrame, size: int = 4, shingle_size: int = 5) -> DataFrame:
    """All columns but the text; `fp`; `sid`, a hash of the set of shingles; its `bands`; `tk`, a hash of the text."""
    kept = [c for c in docs.columns if c != "text"]

    def each(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps, sids, keys = [], [], []
            for t in texts:
                text = t.as_py()
                fps.append(fingerprint(text, size))
                found = shingles(text, shingle_size)
                sids.append(set_id(found))
                keys.append(bands(found).view(np.int64) if len(found) else [])
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in kept),
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(np.array(sids, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())),
            ], names=[*kept, "fp", "sid", "bands"])

    rows = docs.select(*kept, "text", text_hash().alias("tk"))
    kept = [*kept, "tk"]
    schema = rows.drop("text").withColumns(
        {"fp": F.lit(0).cast("long"), "sid": F.lit(0).cast("long"), "bands": F.array().cast("array<long>")}
    ).schema
    return rows.mapInArrow(each, schema)


def set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), 42)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sets_of(docs: DataFrame, wanted: DataFrame, size: int = 5) -> DataFrame:
    """Rows (sid, members): the sets of shingles with the ids in `wanted` (sid, tk), each once.

    Texts that no one asks for are left out by a bitmap of places of their hashes, before they are read word by
    word. A place can be shared, so the id decides.
    """
    places = F.lit(8 * max(wanted.count(), 1))
    texts = docs.select("text", F.pmod(text_hash(), places).alias("doc_id"))
    texts = flagged(texts, wanted.select(F.pmod("tk", places).alias("doc_id"))).where("trusted")

    def each(batches):
        for batch in batches:
            sets = [shingles(t.as_py(), size) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array([set_id(x) for x in sets], np.uint64).view(np.int64)),
                pa.array([x.tobytes() for x in sets], pa.binary()),
            ], names=["sid", "members"])

    found = texts.select("text").mapInArrow(each, "sid long, members binary")
    return found.dropDuplicates(["sid"]).join(wanted.select("sid"), "sid", "left_semi")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """Keys (choice, key) of two or more sets, and their number n.

    Of keys that hold the same two or three sets, one is enough: their smallest and largest id and the exclusive
    or of all tell which sets they are.
    """
    groups = cut(
        keyed.groupBy("choice", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.bit_xor("sid").alias("all"))
        .where("n > 1")
    )
    small = groups.where("n <= 3").groupBy("n", "lo", "hi", "all").agg(F.min(F.struct("choice", "key")).alias("k"))
    return small.select("k.choice", "k.key", "n").unionByName(groups.where("n > 3").select("choice", "key", "n"))


def similar_links(docs: DataFrame, marked: DataFrame, least: float = 0.8, size: int = 5) -> DataFrame:
    """Links (a, b) between the fingerprints `fp` of texts whose sets of shingles are similar from `least`.

    `docs` has the texts, `marked` their sketches. Texts with one set are one: its fingerprints form a star. Other
    sets that share a band are compared exactly, keys with many members by tiles, and only a spanning forest of
    each pair of tiles leaves. Sets are neither stored nor moved but for those that share a band.
    """
    sets = cut(marked.groupBy("sid").agg(F.min("fp").alias("fp"), F.min("tk").alias("tk")))
    first = sets.select("sid", F.col("fp").alias("b"))
    same = marked.select("sid", F.col("fp").alias("a")).distinct().join(first, "sid").where("a != b")
    keys = marked.select("sid", "bands").dropDuplicates(["sid"])
    keyed = keys.select("sid", F.posexplode("bands").alias("choice", "key"))
    met = cut(keyed.join(shared_keys(keyed), ["choice", "key"])).withColumn("tiles", F.ceil(F.col("n") / TILE))
    met = met.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("tiles")))
    tiles = met.select(
        "sid", "choice", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    ).select("sid", "choice", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    wanted = cut(sets.join(met.select("sid").distinct(), "sid"))
    members = sets_of(docs, wanted, size).join(wanted.select("sid", "fp"), "sid")
    group = ["choice", "key", "i", "j"]

    def verify(batches):
        held, at = [], None

        def done():
            root, out = list(range(len(held))), []

            def find(k):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for k, (own, fp, x) in enumerate(held):
                for m in range(k):
                    if at[2] != at[3] and own == held[m][0]:
                        continue
                    one, two = find(k), find(m)
                    if one != two and alike(x, held[m][2], least):
                        root[max(one, two)] = min(one, two)
                        out.append({"a": fp, "b": held[m][1]})
            return out

        for batch in batches:
            links_found = []
            for r in zip(*(batch.column(c).to_pylist() for c in (*group, "own", "fp", "members"))):
                if r[:4] != at:
                    links_found += done()
                    held, at = [], r[:4]
                held.append((r[4], r[5], np.frombuffer(r[6], dtype=np.uint64)))
            if links_found:
                yield pa.RecordBatch.from_pylist(links_found)
        if held and (last := done()):
            yield pa.RecordBatch.from_pylist(last)

    near = tiles.join(members, "sid").repartition(*group).sortWithinPartitions(*group).mapInArrow(verify, "a long, b long")
    return same.select("a", "b").unionByName(near).where("a != b").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4,
                    similar: float | None = None) -> DataFrame:
    """One row per document: every column but the text, `fp`, and `component_id`.

    The component holds all documents reachable over fingerprints that differ in at most
    `distance` bits, or with `similar` over texts whose sets of five-word shingles are that similar; it is
    named by its smallest id. NULL and empty texts have fingerprint zero and are
    linked like any other. Documents with a NULL id are linked too; a component of such
    documents only has a NULL name. Repeated rows stay, each with its own row. `fp` and `component_id` come in
    place of columns of these names; all others stay as they were, whatever their names.
    """
    columns = docs.drop(text, "fp", "component_id").columns
    rows = docs.select(*numbered(columns), column_named(id).alias("_id"), column_named(text).alias("text"))
    if similar is None:
        marked = cut(fingerprints(rows, "text", size))
    else:
        marked = cut(sketches(rows, size))
    fps = cut(marked.groupBy("fp").agg(F.min("_id").alias("_least")))
    near = links(fps.select("fp"), distance)
    if similar is not None:
        near = near.unionByName(similar_links(rows, marked, similar))
    roots = components(near).withColumnRenamed("node", "fp")
    named = fps.join(roots, "fp", "left").withColumn("_root", F.coalesce("root", "fp"))
    names = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    classes = cut(named.select("fp", "_root").join(names, "_root").select("fp", "component_id"))
    return marked.join(classes, "fp").select(*renamed(columns), "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, size: int = 4, distance: int = 4, similar: float | None = None) -> DataFrame:
    """The documents without near duplicates: of each component, the one with the smallest id stays.

    Where several rows have that id, the one with the smallest hash of all columns stays, once. All columns
    stay as they were, whatever their names.
    """
    columns = docs.columns
    # The hash comes last: Spark would infer a copy of it for each column named behind it.
    rows = docs.select(*numbered(columns), F.col("doc_id").alias("_doc"), row_hash(docs).alias("_hash"))
    slim = docs.select("doc_id", "text", row_hash(docs).alias("_hash"))
    classes = near_duplicates(slim, size=size, distance=distance, similar=similar)
    kept = (
        classes.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("_nameless"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_hash")).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k._hash").alias("_h"))
    )
    out = rows.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))
    if not classes.groupBy("doc_id", "_hash").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["_doc", "_hash"])
    return out.select(*renamed(columns))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")
