"""Near-duplicate vectors: int8 tile products with error bounds, full precision only where the bounds leave doubt."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import components, groups_of
from tracklake.session import stage

BLOCK = 4096  # vectors of one side of a tile
STRIP = 512  # rows of a tile that are multiplied at once
_ROUNDING = 1e-12  # covers double rounding of norms, bounds and sums
_VECTOR = "vec_id long, digest binary, vector binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows over their lengths in double precision; scaled first so that squares neither overflow nor vanish."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the exact length of what the codes leave out of each unit vector."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    rest = x - scale[:, None] * codes
    return codes, scale, np.sqrt((rest * rest).sum(axis=1))


class Forest:
    """Union-find over row numbers; keeps only links that join two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))


def tile_links(left: np.ndarray, right: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers (left, right) with cosine >= least, strip by strip; without `right`, pairs inside left.

    x.y = (x'+e).(y'+f) with quantised x', y' and rests e, f. So |x.y - x'.y'| <= |e||y| + |x'||f| <= |e| + (1+|e|)|f|.
    Pairs whose product lies further than that from the threshold are decided; the others are computed in double.
    Code products are sums of at most 127*127*width, which single precision holds exactly up to width 1040; wider
    vectors use double precision.
    """
    codes, scale, rest = quantise(left)
    kind = np.float32 if left.shape[1] <= 1040 else np.float64
    other = right if right is not None else left
    codes_r, scale_r, rest_r = (codes, scale, rest) if right is None else quantise(right)
    turned = np.ascontiguousarray(codes_r.T.astype(kind))
    for a in range(0, len(left), STRIP):
        b = min(a + STRIP, len(left))
        start = a + 1 if right is None else 0
        raw = codes[a:b].astype(kind) @ turned[:, start:]
        # First a cheap test in single precision with the strip's largest bound, rounded outwards.
        worst = (rest[a:b, None].max() + (1 + rest[a:b].max()) * rest_r.max()) + 1e-5
        near = raw * scale[a:b, None].astype(kind)
        near *= scale_r[start:].astype(kind)
        i, j = np.nonzero(near >= least - worst)
        i, j = i + a, j + start
        if right is None:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        product = (codes[i].astype(np.int64) * codes_r[j]).sum(axis=1) * scale[i] * scale_r[j]
        bound = rest[i] + (1 + rest[i]) * rest_r[j] + _ROUNDING
        sure = product - bound >= least
        doubt = ~sure & (product + bound >= least)
        sure[doubt] = (left[i[doubt]] * other[j[doubt]]).sum(axis=1) >= least
        yield i[sure], j[sure]


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as double bytes, with a digest; all others are left out."""
    for batch in batches:
        ids, digests, out = [], [], []
        for key, value in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if key is None or not value.is_valid or value.values.null_count:
                continue
            x = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 becomes 0.0
            if len(x) and np.isfinite(x).all() and x.any():
                ids.append(key)
                out.append(x.tobytes())
                digests.append(hashlib.blake2b(out[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(out, pa.binary())],
            names=["vec_id", "digest", "vector"],
        )


def _tiles(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of each tile: per vector its number of linked vectors, and the links that join trees."""
    for group in groups_of(batches, "tile"):
        side = np.array(group.column("side").to_pylist())
        _, low, high = group.column("tile")[0].as_py().split("/")
        two = low != high
        if two and len(set(side.tolist())) < 2:
            continue  # the other block is empty
        data = [np.frombuffer(v, np.float64) for v in group.column("vector").to_pylist()]
        reps = group.column("rep").to_numpy()
        copies = group.column("copies").to_numpy()
        order = np.argsort(side, kind="stable")
        x = unit(np.stack([data[k] for k in order]))
        reps, copies, n_left = reps[order], copies[order], int((side == 0).sum())
        degree, forest = np.zeros(len(x), np.int64), Forest(len(x))
        for i, j in tile_links(x[:n_left], x[n_left:] if two else None, least):
            j = j + n_left if two else j
            np.add.at(degree, i, copies[j])
            np.add.at(degree, j, copies[i])
            for a, b in _spanning(i, j, forest):
                forest.add(a, b)
        some = np.flatnonzero(degree)
        a = np.array([reps[i] for i, _ in forest.links], np.int64)
        b = np.array([reps[j] for _, j in forest.links], np.int64)
        none = np.zeros(len(a), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in ((reps[some], a), (np.zeros(len(some), np.int64) - 1, b), (degree[some], none))],
            names=["a", "b", "n"],
        )


def _spanning(i: np.ndarray, j: np.ndarray, forest: Forest) -> Iterator[tuple[int, int]]:
    """Drops most pairs that are already in one tree before the loop looks at them."""
    while len(i):
        root_i, root_j = _roots(forest.parent, i), _roots(forest.parent, j)
        open_ = root_i != root_j
        i, j = i[open_], j[open_]
        if len(i):
            _, first = np.unique(np.minimum(root_i, root_j)[open_] * len(forest.parent) + np.maximum(root_i, root_j)[open_], return_index=True)
            yield from zip(i[first].tolist(), j[first].tolist())


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = parent[at]
    while (parent[found] != found).any():
        found = parent[found]
    return found


def vector_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                 block: int = BLOCK) -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly), component_id, kept (id = component_id).

    Rows link when their cosine in double precision is at least `least`. Equal vectors are first reduced to one with
    a count. Representatives are dealt into blocks of about `block` by digest, and every pair of blocks is one tile; a
    tile returns counts and a spanning forest instead of pairs, at most two rows a vector. Work is quadratic in the
    number of different vectors: that is the method. Tiles are as many as needed, and none holds more than two blocks.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, not even with copies;
    vectors of different widths do not link. Rows without an id have no links and a null component. Rows that share an id
    are one vertex of a component, while each counts as a vector in n_links. An empty table gives an empty result.
    """
    everything = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"))
    usable = stage(everything.mapInArrow(_prepared, _VECTOR))
    single = stage(usable.groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")))
    widths = single.groupBy(F.length("vector").alias("width")).agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / F.lit(block)).cast("int")
    number = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    dealt = single.withColumn("width", F.length("vector")).join(
        F.broadcast(widths.select("width", blocks.alias("blocks"))), "width").withColumn("block", number)
    # Each vector meets every block once: as the left side of tiles to the right of its block, else as the right side.
    pairs = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    sides = pairs.select(
        F.concat_ws("/", "width", low, high).alias("tile"),
        F.when(F.col("block") == low, 0).otherwise(1).alias("side"), "rep", "copies", "vector")
    tiles = sides.repartition("tile").sortWithinPartitions("tile")
    found = stage(tiles.mapInArrow(partial(_tiles, least=least), "a long, b long, n long"))
    counts = found.where("b = -1").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("far"))
    parts = components(found.where("n = 0").select("a", "b"))
    groups = (
        single.join(counts, "rep", "left").join(parts, F.col("rep") == F.col("vertex"), "left")
        .select("digest", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    linked = usable.join(groups, "digest").select("vec_id", "n_links", "component_id")
    keys = usable.select("vec_id").distinct()
    rest = everything.select("vec_id").join(keys, "vec_id", "left_anti")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
