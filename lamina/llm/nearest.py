"""Nearest neighbours from shifted Hilbert orderings.

Vectors are projected to a few dimensions, and several orderings each put them
along a Hilbert curve of their own projection and shift.  Spark range-partitions
an ordering by curve key and cuts it into blocks of neighbouring rows.  A query
is compared with its own and the adjacent rows of every ordering; these windows
merge, and their best rows by the original distance are the answer.

An exact check may follow, and does unless it is turned off: the tenth distance
found so far bounds the true one from above, and every block of the first
ordering that, by its centre and radius, could hold something nearer is
searched for what the windows missed.  Where vectors have a low-dimensional
shape that is little; where they have none, no curve keeps neighbours together
and the check does most of the work, which then grows with rows times queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.shared import shuffle_width, stage
from lamina.session import run_dir

DIMENSIONS, BITS, ORDERINGS, BLOCK, WINDOW = 6, 10, 3, 512, 64
#: Query vectors that one round of the exact check sends to all tasks.
ROUND_BYTES = 8 << 20
SLACK = 1e-9
#: Beyond these magnitudes squares leave the range of doubles.
LARGE, SMALL = 1e100, 1e-100


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve positions of integer points (rows of ``cells``), as int64; Skilling's transposition, for all points at once."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def keys(vectors: np.ndarray, ordering: int, seed: int = 11) -> np.ndarray:
    """Positions along one ordering: a random rotation to few dimensions, a shift, a curve.

    Each vector's direction is what counts; the projection of a unit vector
    lies within -1 and 1, so cells need no fitting to the data.
    """
    rng = np.random.default_rng(seed + ordering)
    m = min(DIMENSIONS, vectors.shape[1])
    turn = np.linalg.qr(rng.normal(size=(vectors.shape[1], m)))[0]
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
    spread = np.tanh(unit @ turn * np.sqrt(vectors.shape[1]) / 2) / 2 + 0.5
    cells = np.floor((spread + rng.random(m)) / 2 * (1 << BITS)).astype(np.int64)
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, row`` (a number of the row's own): rows whose vector has only finite components and some other than 0."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    return own.withColumn("row", F.monotonically_increasing_id())


def scale_of(rows: DataFrame) -> float:
    """The power of two that brings the largest component to about 1, where components are so large or small that squares fail; else 1.

    Vectors of different lengths have no distance and are an error.
    """
    most = F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    found = rows.agg(F.min(F.size("v")).alias("shortest"), F.max(F.size("v")).alias("longest"), most.alias("most")).first()
    if found.shortest != found.longest:
        raise ValueError(f"vectors must have one length, not {found.shortest} to {found.longest} components")
    if found.most is None or SMALL <= found.most <= LARGE:
        return 1.0
    return float(np.ldexp(1.0, min(1000, -int(np.frexp(found.most)[1]))))


def matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each pair of rows; by way of a power of two where squares would overflow or vanish."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        d = a - b
        out = np.sqrt((d * d).sum(1))
        most = np.abs(d).max(1, initial=0.0)
        odd = np.flatnonzero((most > LARGE) | ((most > 0) & (most < SMALL)))
        if len(odd):
            d = np.ldexp(a[odd], -2) - np.ldexp(b[odd], -2) if np.isinf(most[odd]).any() else d[odd]
            up = 2 if np.isinf(most[odd]).any() else 0
            e = np.frexp(np.abs(d).max(1))[1]
            d = np.ldexp(d, -e[:, None])
            out[odd] = np.ldexp(np.sqrt((d * d).sum(1)), e + up)
    return out


def nearest(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, distance) of each query's ``k`` nearest rows of another id, ties to the smaller id."""
    a, b = (queries, rows) if scale == 1 else (queries * scale, rows * scale)
    own, other = (a**2).sum(1), (b**2).sum(1)
    fast = own[:, None] + other[None, :] - 2 * a @ b.T
    same = q_ids[:, None] == ids[None, :]
    fast[same] = np.inf
    if rows.shape[0] > k:
        edge = np.partition(fast, k - 1, axis=1)[:, k - 1]
        q, r = np.nonzero((fast <= (edge + SLACK * (1 + own + other.max()))[:, None]) & ~same)
    else:
        q, r = np.nonzero(~same)
    d = distances(queries[q], rows[r])
    return best(q, ids[r], d, r, k)


def best(q: np.ndarray, ids: np.ndarray, d: np.ndarray, r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` smallest of each query by distance, then id; as (query, ``r``, distance)."""
    order = np.lexsort((ids, d, q))
    q, r, d = q[order], r[order], d[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0)) if len(q) else q
    keep = np.arange(len(q)) - start < k
    return q[keep], r[keep], d[keep]


def blocks_of(rows: DataFrame, ordering: int, scale: float = 1.0) -> DataFrame:
    """One ordering's blocks: ``ids, rows, vectors`` (binary), ``center, radius`` (scaled), ``before, after`` (rows lent to the windows at both ends)."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v = matrix(batch.column(1))
                yield pa.RecordBatch.from_arrays([pa.array(keys(v * scale, ordering)), batch.column(0), batch.column(2), pa.array([x.tobytes() for x in v], pa.binary())], names=["key", "vec_id", "row", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held_rows, held = np.empty(0, np.int64), np.empty(0, np.int64), None
        lent = 0

        def block(n: int, more: int) -> pa.RecordBatch:
            own = held[lent : lent + n] * scale
            center = own.mean(0)
            radius = float(np.sqrt(((own - center) ** 2).sum(1)).max())
            end = lent + n + more
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x[:end].tobytes()], pa.binary()) for x in (held_ids, held_rows, held)), pa.array([center.tobytes()], pa.binary()), pa.array([radius]), pa.array([lent], pa.int32()), pa.array([more], pa.int32())],
                names=["ids", "rows", "vectors", "center", "radius", "before", "after"],
            )

        for batch in batches:
            if not len(batch):
                continue
            new = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float64).reshape(len(batch), -1)
            held_ids, held_rows = (np.concatenate([x, np.asarray(batch.column(i))]) for i, x in ((1, held_ids), (2, held_rows)))
            held = new if held is None else np.concatenate([held, new])
            while len(held) - lent >= BLOCK + WINDOW:
                yield block(BLOCK, WINDOW)
                drop = lent + BLOCK - WINDOW
                held_ids, held_rows, held, lent = held_ids[drop:], held_rows[drop:], held[drop:], WINDOW
        if held is not None:
            while len(held) > lent:
                n = min(BLOCK, len(held) - lent)
                yield block(n, min(WINDOW, len(held) - lent - n))
                drop = lent + n - WINDOW if lent + n > WINDOW else 0
                held_ids, held_rows, held, lent = held_ids[drop:], held_rows[drop:], held[drop:], lent + n - drop

    dealt = stage(rows.mapInArrow(keyed, "key long, vec_id long, row long, v binary"), "keys")
    # A key shared by very many rows (copies of one vector) is spread by vec_id and row.
    sorted_rows = dealt.repartitionByRange(shuffle_width(rows.sparkSession), "key", "vec_id", "row").sortWithinPartitions("key", "vec_id", "row")
    return stage(sorted_rows.mapInArrow(cut, "ids binary, rows binary, vectors binary, center binary, radius double, before int, after int"), "blocks")


def opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float, int, int]]:
    for i, r, v, c, radius, before, after in zip(*(batch.column(x).to_pylist() for x in range(7)), strict=True):
        ids = np.frombuffer(i, np.int64)
        yield ids, np.frombuffer(r, np.int64), np.frombuffer(v, np.float64).reshape(len(ids), -1), np.frombuffer(c, np.float64), radius, before, after


FOUND = "query long, vec_id long, row long, score double"


def windows(blocks: DataFrame, every: int, k: int, scale: float = 1.0) -> DataFrame:
    """``query`` (its row number), ``vec_id, row, score``: the ``k`` nearest of the rows around each query along one ordering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows, vectors, _, _, before, after in opened(batch):
                own = np.flatnonzero(ids[before : len(ids) - after] % every == 0) + before
                if len(own):
                    q, r, d = nearest(vectors[own], ids[own], vectors, ids, k, scale)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[own][q]), pa.array(ids[r]), pa.array(rows[r]), pa.array(d)], names=["query", "vec_id", "row", "score"])

    return blocks.mapInArrow(run, FOUND)


def missed(blocks: DataFrame, queries: list, k: int, scale: float = 1.0) -> DataFrame:
    """Rows of every block that the bounds don't rule out, as near as the bound or nearer; ``k`` a query and task at most.

    ``queries``: (query, query_id, v, bound) of one round; a null bound rules out nothing.
    """
    names = np.array([r.query for r in queries], dtype=np.int64)
    q_ids = np.array([r.query_id for r in queries], dtype=np.int64)
    points = np.frombuffer(b"".join(bytes(r.v) for r in queries), np.float64).reshape(len(queries), -1)
    first = np.array([np.inf if r.bound is None else r.bound for r in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, at = first.copy(), points * scale
        all_q, all_i, all_r, all_d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for batch in batches:
            for ids, rows, vectors, center, radius, before, after in opened(batch):
                own = slice(before, len(ids) - after)
                near = np.sqrt(((at - center) ** 2).sum(1)) - radius
                live = np.flatnonzero(near <= bound * scale * (1 + SLACK) + SLACK)
                for i in range(0, len(live), 2048):
                    some = live[i : i + 2048]
                    q, r, d = nearest(points[some], q_ids[some], vectors[own], ids[own], k, scale)
                    q = some[q]
                    ok = d <= bound[q]
                    all_q, all_i, all_r, all_d = (np.concatenate(x) for x in ((all_q, q[ok]), (all_i, ids[own][r[ok]]), (all_r, rows[own][r[ok]]), (all_d, d[ok])))
                if len(all_q):
                    all_q, place, all_d = best(all_q, all_i, all_d, np.arange(len(all_q)), k)
                    all_i, all_r = all_i[place], all_r[place]
                    count = np.bincount(all_q, minlength=len(points))
                    full = np.flatnonzero(count >= k)
                    bound[full] = np.minimum(bound[full], all_d[np.cumsum(count)[full] - 1])
        yield pa.RecordBatch.from_arrays([pa.array(names[all_q]), pa.array(all_i), pa.array(all_r), pa.array(all_d)], names=["query", "vec_id", "row", "score"])

    return blocks.mapInArrow(run, FOUND)


def search(vectors: DataFrame, every: int = 100, k: int = 10, orderings: int = ORDERINGS, exact: bool = True) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row whose vec_id is divisible by ``every``.

    Distances are Euclidean, in double precision, on the original vectors; ties
    go to the smaller vec_id.  Rows of a query's own vec_id are no candidates;
    of several query rows with one vec_id the first by its bytes counts; equal
    candidate rows each take a rank.  Vectors must have one length.  Null
    vectors and ids take no part; an empty table has no answers.

    ``exact=False`` leaves out the check and answers from the windows alone.
    The check sends ``ROUND_BYTES`` of query vectors to the tasks at a time and
    writes each round's finds, so that the driver never holds more.
    """
    rows = stage(usable(vectors), "vectors")
    scale = scale_of(rows)
    layers = [blocks_of(rows, j, scale) for j in range(orderings)]
    near = None
    for layer in layers:
        own = windows(layer, every, k, scale)
        near = own if near is None else near.unionAll(own)
    near = stage(near.dropDuplicates(["query", "row"]), "windows")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x.tobytes() for x in matrix(batch.column(1))], pa.binary())], names=["query_id", "query", "v"])

    asked = rows.where(F.col("vec_id") % every == 0).mapInArrow(packed, "query_id long, query long, v binary")
    asked = asked.groupBy("query_id").agg(F.min(F.struct("v", "query")).alias("x")).select("query_id", "x.query", "x.v")
    found = near
    if exact:
        # At most k rows of each ordering a query, so that these groups are small.
        tenth = near.groupBy("query").agg(F.sort_array(F.collect_list("score")).alias("all"))
        asked = stage(asked.join(tenth, "query", "left").select("query", "query_id", "v", F.when(F.size("all") >= k, F.element_at("all", k)).alias("bound")), "queries")
        size = asked.agg(F.sum(F.octet_length("v")).alias("n")).first().n or 0
        rounds, at = -(-size // ROUND_BYTES), f"{run_dir(vectors.sparkSession)}/missed-{uuid.uuid4().hex}"
        for n in range(rounds):
            some = asked.where(F.pmod(F.xxhash64("query"), F.lit(rounds)) == n).collect()
            if some:
                missed(layers[0], some, k, scale).write.mode("append").parquet(at)
        if size:
            found = near.unionAll(vectors.sparkSession.read.schema(FOUND).parquet(at)).dropDuplicates(["query", "row"])
    # A task of the check adds at most k rows a query; the k smallest of all are the answer.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    answers = found.join(asked.select("query", "query_id"), "query").withColumn("rank", rank).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
