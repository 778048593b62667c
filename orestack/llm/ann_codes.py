"""Nearest neighbours by inner product from randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from orestack.llm.common import saved

CANDIDATES = 4096  # of one block
QUERIES = 4096
AT_ONCE = 128  # queries that a task estimates together
RERANKED = 20_000  # pairs that a task scores together
BITS = 512  # of a code, at least
ENTRY = "id long, dim int, vector binary, code binary, norm double, fit double"


# A plain dictionary travels with the functions; tasks fill their own.
_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random rotation, the same wherever it is made, of vectors padded with zeros to the bits of a code.

    The error of an estimate falls with the square root of the bits, so short vectors get more than a bit
    per component.
    """
    if (dim, seed) not in _rotations:
        width = -(-max(dim, BITS) // 8) * 8
        q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((width, dim)))
        _rotations[dim, seed] = (q * np.sign(np.diag(r))).T
    return _rotations[dim, seed]


def usable(vector: Column) -> Column:
    """Neither null nor zero nor empty, and every component finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def encode(vectors: DataFrame, key: str, vector: str, seed: int = 7) -> DataFrame:
    """The index: for each vector a sign bit per component of its rotation, packed, and two correction scalars.

    ``norm`` is the length of the vector, ``fit`` the inner product of its direction with the code's. The
    vector travels along for reranking, in the precision that it came in.
    """
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    packed = "<f4" if kind == "float" else "<f8"
    rows = (vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
            .filter(F.col("id").isNotNull() & usable(F.col("vector"))))

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, sizes = batch["id"].to_numpy(), batch["vector"].map(len).to_numpy()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = np.stack(batch["vector"].iloc[at].to_list()).astype(packed)
                wide = x.astype(float)
                norm = np.linalg.norm(wide, axis=1)
                turned = wide / norm[:, None] @ rotation(int(dim), seed)
                bits = np.packbits(turned > 0, axis=1)
                yield pd.DataFrame({"id": ids[at], "dim": np.int32(dim), "vector": [v.tobytes() for v in x],
                                    "code": [b.tobytes() for b in bits], "norm": norm,
                                    "fit": np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])})

    return rows.mapInPandas(codes, ENTRY)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added component by component, so that equal vectors have equal scores wherever they lie."""
    out = np.empty(len(a))
    for start in range(0, len(a), RERANKED):
        part = slice(start, start + RERANKED)
        out[part] = np.cumsum(a[part] * b[part], axis=1)[:, -1]
    return out


def nearest(block: pd.DataFrame, k: int, seed: int, packed: str, bound: float) -> pd.DataFrame:
    """The best ``k`` candidates of one block for each of its queries, with exact scores.

    The code estimates each inner product, and ``bound`` standard errors around it say how far off that
    may be. The ``k`` best by estimate are scored exactly; so is every candidate whose upper bound reaches
    the least of these scores.
    """
    asks, base = block[block["asks"]], block[~block["asks"]]
    dim = int(block["dim"].iloc[0])
    none = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("ask", "row", "query_id", "vec_id")} | {"score": np.zeros(0)})
    if asks.empty or base.empty:
        return none
    ask, known = (np.frombuffer(b"".join(part["vector"]), packed).reshape(-1, dim).astype(float) for part in (asks, base))
    ids, query_ids = base["id"].to_numpy(), asks["id"].to_numpy()
    rows, query_rows = base["row"].to_numpy(), asks["row"].to_numpy()
    order = np.argsort(rows)
    place = np.minimum(np.searchsorted(rows, query_rows, sorter=order), len(rows) - 1)
    own = np.where(rows[order[place]] == query_rows, order[place], -1)
    bits = np.unpackbits(np.frombuffer(b"".join(base["code"]), np.uint8).reshape(len(base), -1), axis=1)
    width = bits.shape[1]
    norm, fit, length = base["norm"].to_numpy(), base["fit"].to_numpy(), asks["norm"].to_numpy()
    signs = ((bits * 2.0 - 1) * (norm / fit / np.sqrt(width))[:, None]).astype(np.float32).T
    turned = (ask @ rotation(dim, seed) / length[:, None]).astype(np.float32)
    error = (norm * (np.sqrt(np.maximum(0, 1 - fit ** 2)) / fit * bound / np.sqrt(width - 1) + 1e-5)).astype(np.float32)
    found = []
    for start in range(0, len(asks), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        estimate = turned[part] @ signs
        mine = np.flatnonzero(own[part] >= 0)
        estimate[mine, own[part][mine]] = -np.inf
        limit = np.full(len(estimate), -np.inf, np.float32)
        if len(ids) > k:
            top = np.argpartition(estimate, len(ids) - k, axis=1)[:, len(ids) - k:]
            row = np.repeat(np.arange(len(top)), k)
            score = products(known[top.ravel()], ask[start + row]) / length[start + row]
            score[np.isneginf(estimate[row, top.ravel()])] = -np.inf
            limit = score.reshape(len(top), k).min(axis=1).astype(np.float32)
        q, c = np.nonzero((estimate >= limit[:, None] - error) & (estimate > -np.inf))
        score = np.concatenate([products(known[c[i: i + RERANKED]], ask[start + q[i: i + RERANKED]])
                                for i in range(0, len(q), RERANKED)] or [np.zeros(0)])
        order = np.lexsort((rows[c], ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        best = rank < k
        found.append(pd.DataFrame({"ask": query_rows[start + q[best]], "row": rows[c[best]], "query_id": query_ids[start + q[best]],
                                   "vec_id": ids[c[best]], "score": score[best]}))
    return pd.concat(found) if found else none


def search(vectors: DataFrame, key: str, vector: str, asks: Column, k: int = 20, bound: float = 3.0,
           seed: int = 7) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` largest inner products of each query.

    Queries are the vectors whose id satisfies ``asks`` (over a column named ``id``), candidates all
    others of the same number of components, nearest first, ties to the smaller id. Every block of
    queries meets every block of candidates in a task of its own: the codes of a block are scanned, and
    at most ``k`` rows per query leave it. Vectors that are null, zero, empty or hold a null or a
    non-finite component, and those without an id, take no part. Rows that repeat an id are candidates and
    queries of their own: only the query's own row is left out, and each such query has its own ranks. Other
    columns are ignored; an empty table gives no rows.
    """
    packed = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    # Numbers that are written stay as they are, whatever runs again.
    base = saved(encode(vectors, key, vector, seed).withColumn("row", F.monotonically_increasing_id()), "codes")
    total, asking = base.agg(F.count("*"), F.count_if(asks)).first()
    base_blocks, ask_blocks = max(1, -(-total // CANDIDATES)), max(1, -(-asking // QUERIES))
    place = F.xxhash64("row")

    def over(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = base.withColumns({"asks": F.lit(False), "base_block": F.pmod(place, F.lit(base_blocks)).cast("int")})
    candidates = candidates.withColumn("ask_block", over(ask_blocks))
    queries = base.filter(asks).withColumns({"asks": F.lit(True), "ask_block": F.pmod(place, F.lit(ask_blocks)).cast("int")})
    queries = queries.withColumn("base_block", over(base_blocks))

    def task(block: pd.DataFrame) -> pd.DataFrame:
        return nearest(block, k, seed, packed, bound)

    best = (candidates.unionByName(queries).groupBy("dim", "ask_block", "base_block")
            .applyInPandas(task, "ask long, row long, query_id long, vec_id long, score double"))
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "row")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
