r"""Embedding near-dedup: spherical k-means cells, blocked cosine products, no link left out.

Vectors are assigned to the nearest of a few centres, found by spherical k-means on a bounded sample. A
vector x of cell c can only have a partner in cell d if it is close enough to the plane between the two
centres: x.c - x.d <= |x - y| * |c - d|, and |x - y| is known from the cosine. So each vector is
compared within its cell and, as a guest, in the later cells that this bound admits; every pair of vectors
meets at most once and every pair that is similar enough meets. The bound has an absolute slack for
rounding, and centres that nearly equal another are left out, so equal vectors always meet.

Cells are cut into blocks of about ``BLOCK`` vectors (fewer if they are wide), and a task multiplies one block
with another. Products are taken in single precision, whose error has a proven limit; those closer than that to
the wanted cosine are taken again in double precision. A task returns link counts and, per vector, the root of its
local component, never the pairs, and holds the links of ``ROWS`` rows at a time; so a cell or a group of copies
may hold any share of all vectors.

Edge cases: vectors that are null, zero or hold null or non-finite components link with nothing; finite ones of any length link, very small and very large ones too; shorter
vectors count as filled up with zeros; rows with the same vec_id are one vector, the smallest usable one of them;
rows without vec_id come back as they are, unlinked; ties at the limit are links; an empty table stays
empty; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats.llm.components import components, local_roots
from hexstats.sources.staging import stage

COSINE = 0.9
#: most vectors of a block, and most bytes
BLOCK, BLOCK_BYTES = 8192, 4 << 20
#: vectors per cell aimed at, and most cells
PER_CELL, MOST_CELLS = 4096, 256
#: vectors that the centres are fitted on, and rounds of fitting
SAMPLE, ROUNDS = 8192, 6
#: rows of a block that are multiplied at a time
ROWS = 512
#: values of close products that are taken again at a time
EXACT = 1 << 20
#: rows that a task gathers before it sends them on
SENT = 20_000
#: distance below which centres are one, and slack of the bound against the rounding of products
SAME, SLACK = 1e-6, 1e-9
ASSIGNED = "vec_id long, cell int, vector binary, visits array<int>"
PAIRED = "pair long, guest boolean, vec_id long, vector binary"
LINKED = "vec_id long, links long, root long"


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """Lists as the rows of a matrix, filled up with zeros."""
    out = np.zeros((len(column), width))
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; first divided by their largest component, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _rows_of_block(width: int) -> int:
    return max(1, min(BLOCK, BLOCK_BYTES // (8 * max(width, 1))))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that can link, one per vec_id."""
    values = F.col("embedding")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull())
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(finite & F.exists(values, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(5)
    found = sample[rng.permutation(len(sample))[:count]]
    for _ in range(ROUNDS):
        near = (sample @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, near, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), found)
    return _apart(found)


def _apart(found: np.ndarray) -> np.ndarray:
    """The centres without those that (nearly) equal an earlier one."""
    kept = np.zeros(len(found), bool)
    for k in range(len(found)):  # at most MOST_CELLS
        kept[k] = not (np.linalg.norm(found[:k][kept[:k]] - found[k], axis=1) < SAME).any()
    return found[kept]


def _admitted(margin: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Whether a partner may be as far over; products of equal vectors differ by their place in a matrix."""
    return margin <= bound + SLACK


def _assigned(vectors: DataFrame, found: np.ndarray) -> DataFrame:
    """Cell of every vector and the later cells it visits; the vector as bytes."""
    reach = np.sqrt(2 - 2 * COSINE) + 1e-9
    apart = reach * np.linalg.norm(found[:, None] - found[None], axis=2)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_dense(batch.column(1), found.shape[1]))
            near = unit @ found.T
            cell = near.argmax(axis=1)
            margin = near[np.arange(len(cell)), cell][:, None] - near
            visits = _admitted(margin, apart[cell]) & (np.arange(len(found)) > cell[:, None])
            limits = np.append(0, np.cumsum(visits.sum(axis=1)))
            lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(np.nonzero(visits)[1], pa.int32()))
            raw = unit.tobytes()
            size = unit.shape[1] * 8
            blobs = pa.array([raw[k : k + size] for k in range(0, len(raw), size)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(cell, pa.int32()), blobs, lists],
                ["vec_id", "cell", "vector", "visits"],
            )

    return vectors.mapInArrow(assign, ASSIGNED)


def _layout(size: np.ndarray, met: np.ndarray, block: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first block of each cell, earlier cells that send guests to each cell): bounded by the cells alone."""
    first = np.append(0, np.cumsum(np.maximum(-(-size // block), 1)))
    return first, [np.flatnonzero(met[:c, c]) for c in range(len(size))]


def _senders_of(block: int, cell: int, first: np.ndarray, senders: list[np.ndarray]) -> np.ndarray:
    """Blocks before a block that send guests to it: those of cells that visit, and earlier ones of its cell."""
    return np.concatenate([*(np.arange(first[c], first[c + 1]) for c in senders[cell]), np.arange(first[cell], block)])


def _pairs_of_blocks(assigned: DataFrame, cells: int, width: int) -> DataFrame:
    """Every vector once for each pair of blocks it takes part in."""
    size = np.zeros(cells, np.int64)
    for row in assigned.groupBy("cell").count().collect():  # a row per cell
        size[row["cell"]] = row["count"]
    met = np.eye(cells, dtype=bool)
    visits = assigned.select("cell", F.explode("visits").alias("other")).groupBy("cell", "other").count()
    for row in visits.collect():  # at most a row per pair of cells
        met[row["cell"], row["other"]] = True
    first, senders = _layout(size, met, _rows_of_block(width))
    blocks, total = np.diff(first), int(first[-1])

    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            cell = batch.column(1).to_numpy()
            own = first[cell] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[cell]
            rows, keys, guest, held = [], [], [], 0
            vectors = batch.column(3).to_pylist()
            for k, visited in enumerate(vectors):
                u, c = int(own[k]), int(cell[k])
                later = np.concatenate([np.arange(u, first[c + 1]), *(np.arange(first[d], first[d + 1]) for d in visited)])
                keys_ = u * total + later
                keys_[0] = -1 - u  # the block with itself
                for key, role in ((keys_, True), (_senders_of(u, c, first, senders) * total + u, False)):
                    rows.append(np.full(len(key), k))
                    keys.append(key)
                    guest.append(np.full(len(key), role))
                    held += len(key)
                if held >= SENT or k == len(vectors) - 1:
                    at, key, role = np.concatenate(rows), np.concatenate(keys), np.concatenate(guest)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(role), batch.column(0).take(pa.array(at)), batch.column(2).take(pa.array(at))],
                        ["pair", "guest", "vec_id", "vector"],
                    )
                    rows, keys, guest, held = [], [], [], 0

    return assigned.mapInArrow(spread, PAIRED)


def _linked(group: pa.Table) -> pa.Table:
    """Links between two blocks, or within one: per vector its number, and the root of its component."""
    ids = group.column("vec_id").to_numpy()
    guest = group.column("guest").to_numpy(zero_copy_only=False)
    none = pa.table({name: pa.array([], pa.int64()) for name in ("vec_id", "links", "root")})
    if not guest.any():
        return none
    vectors = np.frombuffer(b"".join(group.column("vector").to_pylist())).reshape(len(ids), -1)
    order = np.argsort(~guest, kind="stable")
    ids, vectors, guests = ids[order], vectors[order], int(guest.sum())
    within = group.column("pair")[0].as_py() < 0
    left, right, shift = vectors[:guests], (vectors if within else vectors[guests:]), (0 if within else guests)
    links = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    for i, j in _links(left, right):
        if within:
            i, j = i[j > i], j[j > i]
        j = j + shift
        links += np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        # what was joined before stays joined: a vector and its root count as linked
        joined = np.flatnonzero(root != np.arange(len(ids)))
        root = local_roots(np.arange(len(ids)), np.append(i, joined), np.append(j, root[joined]))
    some = links > 0
    smallest = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(smallest, root, ids)
    return pa.table({"vec_id": ids[some], "links": links[some], "root": smallest[root][some]})


def _links(left: np.ndarray, right: np.ndarray):
    """Positions (i, j) of linked rows, for ``ROWS`` rows of ``left`` at a time."""
    # rounding to single precision and adding up: at most width + 2 roundings of products that sum to 1 at most
    slack = 2 * (left.shape[1] + 2) * 2.0**-24
    narrow, across = left.astype(np.float32), right.astype(np.float32).T
    for begin in range(0, len(left), ROWS):
        cosine = narrow[begin : begin + ROWS] @ across
        i, j = np.nonzero(cosine >= COSINE - slack)
        close = np.flatnonzero(cosine[i, j] < COSINE + slack)
        keep = np.ones(len(i), bool)
        for part in np.array_split(close, -(-len(close) * left.shape[1] // EXACT) or 1):
            keep[part] = np.einsum("ij,ij->i", left[begin + i[part]], right[j[part]]) >= COSINE
        if keep.any():
            yield begin + i[keep], j[keep]


def near_copies(vectors: DataFrame) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    good = stage(usable(vectors))
    size = good.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    named = everyone.filter(F.col("vec_id").isNotNull()).distinct()
    if size["n"]:
        count = int(min(max(size["n"] // PER_CELL, 1), MOST_CELLS))
        share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, 1.2 * SAMPLE / size["n"])))
        rows = good.filter(share).limit(SAMPLE).select("embedding").toArrow()
        found = centres(_unit(_dense(rows.column(0).combine_chunks(), size["width"])), count) if rows.num_rows else np.eye(1, size["width"])
        assigned = stage(_assigned(good, found))
        linked = stage(_pairs_of_blocks(assigned, len(found), found.shape[1]).groupBy("pair").applyInArrow(_linked, LINKED))
    else:
        linked = vectors.sparkSession.createDataFrame([], LINKED)
    counts = linked.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    grouped = components(linked.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    found_links = counts.join(grouped, counts["vec_id"] == grouped["id"]).select(
        F.col("vec_id").alias("_id"), "n_links", "component"
    )
    out = named.join(found_links, named["vec_id"] == found_links["_id"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    nameless = everyone.filter(F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(nameless)
