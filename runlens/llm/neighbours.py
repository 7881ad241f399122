"""Approximate nearest neighbours by inner product over randomly rotated one-bit codes.

Index.  Vectors are dealt to cells by the nearest of some centroids (``fit_cells``, on a bounded sample; their number follows from the number
of vectors).  In its cell a vector is taken relative to the centroid, scaled to length one and rotated at random; its code is the signs of the
rotated components, packed into 64-bit words, with two correction scalars: its distance r from the centroid and how well the signs
represent it (a, the inner product of the unit vector with its own code).  Cells are cut into blocks, so a cell that holds a third
of all rows is many blocks.  Of equal vectors only the k + 1 with the smallest ids can be in any answer; the others stay out of the index.

Estimates.  A rotated query is rounded to four bits a component and stored as bit planes.  Its inner product with a code is then a sum of
bit counts of words (code AND plane); divided by a, times r, plus that with the centroid, it estimates the inner product with the
vector without bias, and with an error bound of ``epsilon`` * r * |q| * sqrt((1 - a^2) / a^2 / (dim - 1)) that holds with a probability that epsilon sets.

Search.  First each query looks into the cells whose centroids are nearest: the 2k best estimates are scored exactly, and the k-th best
score is the level to beat.  Then it looks into every cell that could hold a vector above that level (the centroid's inner product plus ``TAIL``
standard deviations of the rest, or the Cauchy-Schwarz bound if that is less), and all vectors whose estimate plus error bound reaches the level
are scored exactly.  So queries in dense regions look into few cells, and the work on others is what their level asks for.
Only the codes of a block meet the queries; its vectors are read for those blocks that have something to score.

Nothing of all rows comes to the driver: the centroids, and a count and a radius for each cell, are the bounded tables that are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import discard, materialise, only_row, plain

#: Vectors that the cells are fitted on at most (those with the smallest digests of their ids), and rounds of fitting.
SAMPLE_ROWS, ROUNDS = 20_000, 6
#: Cells for each square root of the number of vectors, cells at most, and bytes of centroids at most.
CELL_SHARE, MOST_CELLS, CELL_BYTES = 0.25, 4096, 16 << 20
#: Vectors in a block at most, bytes of a block's vectors at most, and queries that travel together.
BLOCK, BLOCK_BYTES, PACK = 8192, 4 << 20, 2048
#: Width of the error bound, and how many standard deviations from its centroid a cell is thought to reach along a query.
EPSILON, TAIL = 1.4, 4.5
#: Bits of a rounded query's component; queries whose estimates are made together.
QUERY_BITS, TILE = 4, 16


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, all finite and not null, and not all of them zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dim) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, the last filled up with zeros."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("<u8")


def encode(x: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of signs, distance r from the centroid, a) of the rows of x.  A row at the centroid has r = 0 and a = 1."""
    moved = (x - centroid) @ turn
    norm = np.sqrt((moved**2).sum(axis=1))
    unit = moved / np.where(norm > 0, norm, 1.0)[:, None]
    agree = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
    return _words(moved > 0), norm, np.where(norm > 0, agree, 1.0)


class Queries:
    """Rotated queries, rounded to a few bits a component and stored as bit planes."""

    def __init__(self, q: np.ndarray, turn: np.ndarray, bits: int = QUERY_BITS) -> None:
        moved = q @ turn
        self.low = moved.min(axis=1)
        self.step = np.maximum((moved.max(axis=1) - self.low) / ((1 << bits) - 1), 1e-6 * np.abs(moved).max(axis=1) + 1e-30)
        levels = np.rint((moved - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [_words((levels >> b & 1).astype(bool)) for b in range(bits)]
        self.total = levels.sum(axis=1, dtype=np.int64) * self.step + self.low * q.shape[1]
        self.norm = np.sqrt((q**2).sum(axis=1))
        self.dim = q.shape[1]

    def counts(self, codes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """For tiles of queries: their places, and the sums of bit counts of (code AND plane), each plane by its weight, against all codes."""
        n, words = codes.shape
        both, hit = np.empty((TILE, n), np.uint64), np.empty((TILE, n), np.uint8)
        columns = [np.ascontiguousarray(codes[:, w]) for w in range(words)]
        for i in range(0, len(self.norm), TILE):
            own = slice(i, min(i + TILE, len(self.norm)))
            m = own.stop - i
            out = np.zeros((m, n), np.uint16 if words <= 64 else np.uint32)
            for w, column in enumerate(columns):
                for high in range(len(self.planes) - 1, 0, -2):  # two planes' counts of a word, 3 * 64 at most, fit a byte
                    pair = None
                    for plane in (self.planes[high], self.planes[high - 1]):
                        np.bitwise_and(plane[own, w][:, None], column[None, :], out=both[:m])
                        np.bitwise_count(both[:m], out=hit[:m])
                        pair = hit[:m] << np.uint8(1) if pair is None else np.add(pair, hit[:m], out=pair)
                    out += pair.astype(out.dtype) << (high - 1)
            yield own, out

    def parts(self, codes: np.ndarray, norm: np.ndarray, agree: np.ndarray, epsilon: float) -> tuple[np.ndarray, ...]:
        """Of each code: its scale, its number of ones, and the error bound for each unit of a query's norm and of its step."""
        scale = norm / agree / np.sqrt(self.dim)
        spread = epsilon * norm * np.sqrt((1 - agree**2).clip(0) / agree**2 / max(1, self.dim - 1)) + 1e-5 * (norm + 1)
        return scale, np.bitwise_count(codes).sum(axis=1, dtype=np.int64).astype(float), spread, epsilon * norm / agree / np.sqrt(12.0)

    def estimates(self, codes: np.ndarray, norm: np.ndarray, agree: np.ndarray, base: np.ndarray, epsilon: float) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For tiles of queries: (their places, estimates, error bounds) against all codes; ``base`` is each query's product with the centroid."""
        scale, ones, spread, rough = self.parts(codes, norm, agree, epsilon)
        for own, counts in self.counts(codes):
            step, low = self.step[own, None], self.low[own, None]
            estimate = scale * (2 * step * counts + 2 * low * ones - self.total[own, None]) + base[own, None]
            yield own, estimate, self.norm[own, None] * spread + step * rough

    def reaching(self, codes: np.ndarray, norm: np.ndarray, agree: np.ndarray, base: np.ndarray, level: np.ndarray, epsilon: float) -> Iterator[tuple[slice, np.ndarray]]:
        """For tiles of queries: (their places, which codes' estimates plus error bounds reach the queries' levels).

        Solved for the bit count, the condition is a threshold that is a product of a few numbers of the query with a few of the code.
        """
        scale, ones, spread, rough = self.parts(codes, norm, agree, epsilon)
        per = 1 / np.maximum(scale, 1e-300)
        of_code = np.stack([np.minimum(per, 1e12), np.minimum(spread * per, 1e12), np.minimum(rough * per, 1e12), ones, np.ones(len(ones))]).astype(np.float32)
        two = 2 * self.step
        missing = np.clip(level - base, -1e12, 1e12)  # beyond any product of usable vectors, and no overflow
        of_query = np.stack([missing / two, -self.norm / two, np.full(len(two), -0.5), -self.low / self.step, self.total / two - 0.02], axis=1).clip(-1e30, 1e30).astype(np.float32)
        exact = scale <= 1e-12  # at the centroid: the product with it is the score
        for own, counts in self.counts(codes):
            hit = counts.astype(np.float32) >= of_query[own] @ of_code
            hit[:, exact] = (missing[own] <= 1e-5 * self.norm[own])[:, None]
            yield own, hit


def candidates(q: Queries, codes: np.ndarray, norm: np.ndarray, agree: np.ndarray, base: np.ndarray, level: np.ndarray | None, most: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs to be scored: the ``most`` best estimates of each query, or with levels all that may reach its level."""
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if level is not None:
        for own, hit in q.reaching(codes, norm, agree, base, level, epsilon):
            flat = np.flatnonzero(hit)
            r = np.repeat(np.arange(len(hit)), np.diff(np.searchsorted(flat, np.arange(len(hit) + 1) * len(codes))))
            rows.append(r + own.start)
            cols.append(flat - r * len(codes))
    else:
        for own, estimate, _ in q.estimates(codes, norm, agree, base, epsilon):
            m = min(most, len(codes))
            cols.append(np.argpartition(-estimate, m - 1, axis=1)[:, :m].ravel())
            rows.append(np.repeat(np.arange(len(estimate)) + own.start, m))
    return np.concatenate(rows), np.concatenate(cols)


def score_pairs(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray, k: int, level: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, exact score) of each query's k best among its pairs that reach its level; a query is not its own neighbour."""
    others = q_ids[rows] != ids[cols]
    rows, cols = rows[others], cols[others]
    score = np.empty(len(rows))
    for i in range(0, len(rows), 1 << 14):  # row by row, so that equal vectors have equal scores wherever they stand
        own = slice(i, i + (1 << 14))
        score[own] = (x[cols[own]] * q[rows[own]]).sum(axis=1)
    high = score >= level[rows]  # others are behind k known ones
    rows, cols, score = rows[high], cols[high], score[high]
    order = np.lexsort((ids[cols], -score, rows))
    rows, cols, score = rows[order], cols[order], score[order]
    starts = np.searchsorted(rows, rows, side="left")
    best = np.arange(len(rows)) - starts < k
    return q_ids[rows[best]], ids[cols[best]], score[best]


def fit_cells(x: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Centroids of the rows of x by Lloyd's rounds; fewer where there are fewer different rows."""
    different = np.unique(x, axis=0)
    centroids = different[np.random.default_rng(seed).permutation(len(different))[: max(1, cells)]]
    for _ in range(rounds if len(centroids) > 1 else 1):
        near = nearest_cell(x, centroids)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def nearest_cell(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row."""
    half = (centroids**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centroids.T - half, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def first_cells(near: np.ndarray, counts: np.ndarray, wanted: int, most: int = 8) -> np.ndarray:
    """Which cells each query looks into first: the best by its products ``near`` with the centroids, four at least, until they hold ``wanted`` rows."""
    most = min(most, near.shape[1])
    order = np.argsort(-near, axis=1, kind="stable")[:, :most]
    held = np.cumsum(counts[order], axis=1) - counts[order]
    take = (held < wanted) | (np.arange(most)[None, :] < 4)
    out = np.zeros(near.shape, bool)
    np.put_along_axis(out, order, take, axis=1)
    return out & (counts > 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dim: int | None = None,
    epsilon: float = EPSILON,
    tail: float = TAIL,
    cell_share: float = CELL_SHARE,
    block: int = BLOCK,
    pack: int = PACK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k other rows with the largest inner product, in double precision.

    Queries are the rows where ``is_query`` holds.  Nearest first, ties to the smaller id; all candidates if there are fewer than k.
    Vectors that are null, zero, of another length than ``dim`` (the most frequent one if none is given) or have null or
    non-finite components take no part, nor do rows with a null id.  Of rows that repeat an id, the one with the first vector in order
    stands.  Other columns are ignored.  An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows, i, v = plain(vectors.withColumn("_is_query", F.coalesce(is_query, F.lit(False))), id_col, vector_col)
    kind = rows.schema[v].dataType
    dtype = "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"  # as exact as the input
    rows = rows.select(F.col(i).cast("long").alias("id"), F.col(v).cast("array<double>").alias("v"), F.col(rows.columns[-1]).alias("q"))
    rows = rows.where("id is not null and v is not null and size(v) > 0")
    if dim is None:
        common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        if common is None:
            return spark.createDataFrame([], out)
        dim = common["d"]
    rows = rows.where(usable(F.col("v"), dim)).groupBy("id").agg(F.min(F.struct("v", "q")).alias("r")).select("id", "r.v", "r.q")
    rows = materialise(rows, "vectors")
    n, queries = (int(x or 0) for x in rows.agg(F.count("*"), F.count_if("q")).first())
    if not queries:
        return spark.createDataFrame([], out)

    bounded = rows.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(min(SAMPLE_ROWS, max(1, (64 << 20) // (8 * dim)))).select("v")
    cells = max(1, min(round(cell_share * n**0.5), MOST_CELLS, SAMPLE_ROWS // 8, CELL_BYTES // (8 * dim)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"c": [fit_cells(np.stack(pdf["v"].to_numpy()).astype("<f8"), cells).tobytes()]})

    centroids = np.frombuffer(only_row(bounded.groupBy().applyInPandas(fit, "c binary"))["c"], "<f8").reshape(-1, dim)  # CELL_BYTES at most
    shared = spark.sparkContext.broadcast((centroids, rotation(dim)))

    def assign(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centroids, _ = shared.value
        for pdf in pdfs:
            if len(pdf):
                x = np.stack(pdf["v"].to_numpy()).astype("<f8")
                cell = nearest_cell(x, centroids)
                norm = np.sqrt(((x - centroids[cell]) ** 2).sum(axis=1))
                yield pd.DataFrame({"cell": cell.astype(np.int32), "id": pdf["id"], "norm": norm, "x": [r.tobytes() for r in x.astype(dtype)]})

    # Of equal vectors only the k + 1 with the smallest ids can be among anyone's k nearest.
    copies = Window.partitionBy("v").orderBy("id")
    index = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).select("id", "v")
    dealt = index.mapInPandas(assign, "cell int, id long, norm double, x binary")
    size = max(1, min(block, BLOCK_BYTES // (dim * int(dtype[2:]))))
    seen = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("norm").alias("radius")).collect()  # a row for each cell
    counts, radius = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
    for r in seen:
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    subs = -(-counts // size)
    table = F.array(*[F.lit(int(s)) for s in subs])  # one number for each cell

    def pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
        centroids, turn = shared.value
        pdf = pdf.sort_values("id")
        x = np.frombuffer(b"".join(pdf["x"]), dtype).reshape(-1, dim)
        codes, norm, agree = encode(x.astype("<f8"), centroids[pdf["cell"].iloc[0]], turn)
        row = (pdf["cell"].iloc[0], pdf["sub"].iloc[0], pdf["id"].to_numpy("<i8").tobytes(), codes.tobytes(), norm.astype("<f4").tobytes(), agree.astype("<f4").tobytes(), x.tobytes())
        return pd.DataFrame([row], columns=["cell", "sub", "ids", "codes", "norm", "agree", "x"])

    spread = dealt.withColumn("sub", F.pmod(F.xxhash64("id"), F.element_at(table, F.col("cell") + 1)).cast("int"))
    blocks = materialise(
        spread.groupBy("cell", "sub").applyInPandas(pack_block, "cell int, sub int, ids binary, codes binary, norm binary, agree binary, x binary"),
        "blocks",
        **{"parquet.block.size": str(16 << 20)},
    )

    def look(asked: DataFrame, again: bool) -> DataFrame:
        """(query_id, vec_id, score): what the queries (id, v, level) find in their first cells, or in all that may reach their levels."""

        def probe(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centroids, _ = shared.value
            for pdf in pdfs:
                for at in range(0, len(pdf), 1024):
                    own = pdf.iloc[at : at + 1024]
                    q = np.stack(own["v"].to_numpy()).astype("<f8")
                    near = np.where(counts > 0, q @ centroids.T, -np.inf)
                    goes = first_cells(near, counts, 4 * k)
                    if again:
                        norm = np.sqrt((q**2).sum(axis=1))[:, None]
                        reach = near + norm * (radius * min(1.0, tail / np.sqrt(dim)))[None, :]
                        goes |= (reach >= own["level"].to_numpy()[:, None]) & (counts > 0)
                    r, c = np.nonzero(goes)
                    blobs = np.array([x.tobytes() for x in q.astype(dtype)], object)
                    yield pd.DataFrame({"cell": c.astype(np.int32), "id": own["id"].to_numpy()[r], "level": own["level"].to_numpy()[r], "base": near[r, c], "x": blobs[r]})

        def gather(pdf: pd.DataFrame) -> pd.DataFrame:
            row = (pdf["cell"].iloc[0], pdf["id"].to_numpy("<i8").tobytes(), pdf["level"].to_numpy("<f8").tobytes(), pdf["base"].to_numpy("<f8").tobytes(), b"".join(pdf["x"]))
            return pd.DataFrame([row], columns=["cell", "qids", "levels", "bases", "qx"])

        def meet(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            _, turn = shared.value
            for pdf in pdfs:
                for r in pdf.itertuples(index=False):
                    qids, q = np.frombuffer(r.qids, "<i8"), np.frombuffer(r.qx, dtype).reshape(-1, dim)
                    norm, agree = (np.frombuffer(x, "<f4").astype("<f8") for x in (r.norm, r.agree))
                    codes = np.frombuffer(r.codes, "<u8").reshape(len(norm), -1)
                    level = np.frombuffer(r.levels, "<f8")
                    i, c = candidates(Queries(q.astype("<f8"), turn), codes, norm, agree, np.frombuffer(r.bases, "<f8"), level if again else None, 2 * k + 1, epsilon)
                    own, i = np.unique(i, return_inverse=True)
                    if len(own):
                        row = (r.cell, r.sub, qids[own].tobytes(), level[own].tobytes(), q[own].tobytes(), i.astype("<u4").tobytes(), c.astype("<u4").tobytes())
                        yield pd.DataFrame([row], columns=["cell", "sub", "qids", "levels", "qx", "rows", "cols"])

        def rerank(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in pdfs:
                for r in pdf.itertuples(index=False):
                    q, x = (np.frombuffer(b, dtype).reshape(-1, dim).astype("<f8") for b in (r.qx, r.x))
                    pairs = (np.frombuffer(b, "<u4").astype(np.int64) for b in (r.rows, r.cols))
                    found = score_pairs(np.frombuffer(r.qids, "<i8"), q, np.frombuffer(r.ids, "<i8"), x, *pairs, k, np.frombuffer(r.levels, "<f8"))
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

        goes = materialise(asked.mapInPandas(probe, "cell int, id long, level double, base double, x binary"), "probes")
        asks = np.zeros(len(centroids), np.int64)
        for r in goes.groupBy("cell").count().collect():  # a row for each cell
            asks[r["cell"]] = r["count"]
        packs = F.element_at(F.array(*[F.lit(int(max(1, -(-a // pack)))) for a in asks]), F.col("cell") + 1)
        gathered = goes.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), packs).cast("int")).groupBy("cell", "salt")
        gathered = gathered.applyInPandas(gather, "cell int, qids binary, levels binary, bases binary, qx binary")
        # A pack of queries goes to each block of its cell: the keys of the join are blocks, of one size each.
        meetings = gathered.withColumn("sub", F.explode(F.sequence(F.lit(0), F.element_at(table, F.col("cell") + 1) - 1)))
        meetings = meetings.join(blocks.select("cell", "sub", "codes", "norm", "agree"), ["cell", "sub"])
        pairs = meetings.select("cell", "sub", "qids", "levels", "bases", "qx", "codes", "norm", "agree").mapInPandas(meet, "cell int, sub int, qids binary, levels binary, qx binary, rows binary, cols binary")
        scored = pairs.join(blocks.select("cell", "sub", "ids", "x"), ["cell", "sub"]).select("qids", "levels", "qx", "rows", "cols", "ids", "x")
        found = materialise(scored.mapInPandas(rerank, "query_id long, vec_id long, score double"), "found")
        discard(goes)
        return found

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    asked = rows.where("q").select("id", "v")
    early = look(asked.withColumn("level", F.lit(float("-inf"))), False)
    kth = early.withColumn("rank", rank).where(F.col("rank") <= k).groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("s"))
    levels = kth.where(F.col("n") == k).select("id", F.col("s").alias("level"))
    late = look(asked.join(levels, "id", "left").withColumn("level", F.coalesce("level", F.lit(float("-inf")))), True)
    top = early.union(late).distinct().withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
