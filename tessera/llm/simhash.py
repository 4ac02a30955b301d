"""SimHash near-dedup over vantage-point trees.

Fingerprints: 64 bits from the XXH64 of every word shingle, a bit set when over half of the
hashes set it. Equal fingerprints are merged first, so a group of copies is one point.

Search: a vantage-point tree over a bounded sample of fingerprints (``SAMPLE``) routes
every fingerprint, by its Hamming distance to the node's vantage point, to one home shard. By the
triangle inequality a partner within ``max_bits`` on the other side of a radius has a distance within
``max_bits`` of that radius, so only points that near to the boundary also visit the other
side (inner points visit outwards; that reaches every pair once). Inside a shard a task grows its own
vantage-point tree, with the same bounds, and compares exactly at the leaves. It returns a spanning forest of
the links it found, not all pairs; components follow from the forests by joins.

The number of shards follows the number of fingerprints; the sample only places the cuts and does not
affect which pairs are found.

Edge cases: texts without a word (null, empty) have fingerprint 0, linked like any other; fewer words than a
shingle give one shingle of the whole sequence; null ids count last for the component id; repeated rows each get their
row; texts of any length are read whole, one at a time in a task; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers, null_last, stash, text_bytes
from tessera.llm.components import connected_components

SEED = 42
#: Fingerprints that place the cuts of the routing tree.
SAMPLE = 8192
SHARD_POINTS = 8192
LEAF = 192
_HASH_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(joined, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    stops = ends[shingle - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASH_ROWS):
        some = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _HASH_ROWS], stops[at:at + _HASH_ROWS])])
        bits = np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; fp is the fingerprint's bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or b"", shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(fps)], names=["id", "text_hash", "fp"])

    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), text_bytes(docs[text_col]).alias("text"))
    return rows.mapInArrow(run, "id long, text_hash long, fp long")


def _distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


class _Node:
    """A cut of the routing tree: distance to ``vantage`` at most ``radius`` goes inside."""

    def __init__(self, vantage: np.uint64, radius: int, inside, outside):
        self.vantage, self.radius, self.inside, self.outside = vantage, radius, inside, outside


def _cut(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int, np.ndarray] | None:
    """A vantage point and radius that part the points most evenly; None if none does."""
    for vantage in rng.choice(points, min(4, len(points)), replace=False):
        d = _distances(points, vantage)
        below = np.cumsum(np.bincount(d, minlength=65))
        radius = int(np.argmin(np.abs(below - len(points) / 2)))
        inside = d <= radius
        if 0 < inside.sum() < len(points):
            return vantage, radius, inside
    return None


def routing_tree(sample: np.ndarray, shards: int):
    """A tree whose leaves are shard numbers; an int alone is a tree of one shard."""
    rng, numbers = np.random.default_rng(SEED), iter(range(1 << 30))

    def grow(points: np.ndarray, wanted: int):
        cut = _cut(points, rng) if wanted > 1 and len(points) > 1 else None
        if cut is None:
            return next(numbers)
        vantage, radius, inside = cut
        return _Node(vantage, radius, grow(points[inside], wanted // 2), grow(points[~inside], wanted - wanted // 2))

    return grow(sample, shards)


def _route(tree, points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, point, home) of every shard a point lives in or visits."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []

    def walk(node, pts: np.ndarray, home: np.ndarray) -> None:
        if not len(pts):
            return
        if isinstance(node, int):
            out.append((node, pts, home))
            return
        d = _distances(pts, node.vantage)
        own_inside = d <= node.radius
        reach_inside = own_inside | (~home & (d <= node.radius + max_bits))
        reach_outside = ~own_inside | (d > node.radius - max_bits)
        walk(node.inside, pts[reach_inside], home[reach_inside] & own_inside[reach_inside])
        walk(node.outside, pts[reach_outside], home[reach_outside] & ~own_inside[reach_outside])

    walk(tree, points, np.ones(len(points), bool))
    if not out:
        return np.zeros(0, np.int32), points[:0], np.zeros(0, bool)
    return (np.concatenate([np.full(len(p), s, np.int32) for s, p, _ in out]), np.concatenate([p for _, p, _ in out]), np.concatenate([h for _, _, h in out]))


class _Forest:
    """Union-find over row numbers that takes pairs in bulk; parents only ever get smaller."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            self.parent[x] = self.parent[up]
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.parent, a, b)


def shard_links(points: np.ndarray, n_home: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of the first ``n_home`` points among themselves and with the visitors
    behind them, found by a vantage-point tree."""
    rng, forest = np.random.default_rng(SEED), _Forest(len(points))

    def compare(home: np.ndarray, asking: np.ndarray) -> None:
        step = max(1, (1 << 20) // max(1, len(home)))
        for at in range(0, len(asking), step):
            some = asking[at:at + step]
            near = np.bitwise_count(points[some][:, None] ^ points[home][None, :]) <= max_bits
            i, j = np.nonzero(near)
            a, b = some[i], home[j]
            forest.link(a[a != b], b[a != b])

    def walk(home: np.ndarray, asking: np.ndarray) -> None:
        """``home``: points of this subtree; ``asking``: those among them and others that may lie near one."""
        if not len(home) or not len(asking):
            return
        cut = _cut(points[home], rng) if len(home) > LEAF else None
        if cut is None:
            compare(home, asking)
            return
        vantage, radius, inside = cut
        d = _distances(points[asking], vantage)
        walk(home[inside], asking[d <= radius + max_bits])
        walk(home[~inside], asking[d > radius - max_bits])

    walk(np.arange(n_home), np.arange(len(points)))
    rows = np.arange(len(points))
    roots = forest.roots(rows.copy())
    linked = roots != rows
    return points[rows[linked]], points[roots[linked]]


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) links among distinct fingerprints (column fp) that connect exactly what links of
    ``max_bits`` or fewer differing bits connect."""
    n = distinct.count()
    shards = max(1, -(-n // SHARD_POINTS))
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    tree = routing_tree(sample, shards)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shard, point, home = _route(tree, frame["fp"].to_numpy(np.int64).view(np.uint64), max_bits)
            yield pd.DataFrame({"shard": shard, "fp": point.view(np.int64), "home": home})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        home = frame["home"].to_numpy(bool)
        fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
        points = np.concatenate([np.sort(fps[home]), np.sort(fps[~home])])
        u, v = shard_links(points, int(home.sum()), max_bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    routed = distinct.select("fp").mapInPandas(route, "shard int, fp long, home boolean")
    return routed.groupBy("shard").applyInPandas(search, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp, root, component_id, n_in_component) of every row; root names the component."""
    marked = stash(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stash(marked.groupBy("fp").agg(F.min("id").alias("least_id"), F.count("*").alias("n")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct, max_bits))
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    groups = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"), F.sum("n").alias("n_in_component"))
    by_fp = labelled.select(F.col("fp").alias("of_fp"), "root").join(groups, "root")
    return marked.join(by_fp, F.col("fp") == F.col("of_fp")).select("id", "text_hash", "fp", "root", "component_id", "n_in_component")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of every component the one with the smallest id (null last; then by
    text hash; one of equal rows)."""
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    first = F.min(F.struct(null_last(F.col("id")).alias("doc"), "text_hash")).alias("one")
    stay = found.groupBy("root").agg(first).select(F.col("one.doc.id").alias("stay_id"), F.col("one.text_hash").alias("stay_hash"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"))
    same = F.col("id").eqNullSafe(F.col("stay_id")) & F.col("text_hash").eqNullSafe(F.col("stay_hash"))
    kept = rows.join(stay.hint("shuffle_hash"), same, "left_semi").dropDuplicates(["id", "text_hash"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
