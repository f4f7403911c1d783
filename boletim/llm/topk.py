"""Exact top-k inner products from an impact-ordered index.

Vectors of small integers are indexed in blocks of rows. A block's index has a posting segment for
each dimension and quantised impact: the rows whose component, rounded to a multiple of ``LEVEL``,
is that impact. For a query the segments are processed by descending gain, the
quantised impact times the query's component; each adds its gain to the sums of its rows. What a row
can still gain from the segments to come and from what quantising left out is bounded, so the work
stops when no row outside the possible members can reach the k-th best proven sum. The possible
members are scored exactly from their vectors.

The blocks of a query come to their results apart, and the best k of these are kept per query, a
bounded list combined on the map side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boletim.llm.common import let_workers_import

#: Rows that an index block holds, and queries that meet it at once.
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
#: Width of a quantised impact.
LEVEL = 8
#: Segments processed between two tries to prove the end.
TRIES = 24


class ImpactIndex:
    """Posting segments of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        levels = (vectors + LEVEL // 2) // LEVEL
        rows, dims = levels.shape
        low = int(levels.min(initial=0))
        width = int(levels.max(initial=0)) - low + 1
        key = (np.arange(dims) * width + (levels - low)).T.ravel()
        order = np.argsort(key, kind="stable")
        segments, starts = np.unique(key[order], return_index=True)
        self.postings = order % max(rows, 1)
        self.starts = np.append(starts, len(order))
        self.dim = segments // width
        self.impact = segments % width + low
        # Rows of impact 0 gain nothing and need no segment.
        self.live = np.flatnonzero(self.impact != 0)

    def place(self, key: int, query: np.ndarray) -> int:
        """The row of an id and vector, or -1."""
        same = np.flatnonzero(self.ids == key)
        found = same[(self.vectors[same] == query).all(axis=1)]
        return int(found[0]) if len(found) else -1

    def top(self, query: np.ndarray, left_out: int, k: int) -> list[tuple[int, int]]:
        """The k best ``(score, row)`` but for the row ``left_out``; ties to the smaller id."""
        members = np.flatnonzero(np.arange(len(self.ids)) != left_out)
        if len(members) <= k:
            return self._exact(query, members, k)
        gain = query[self.dim[self.live]] * self.impact[self.live] * LEVEL
        order = np.argsort(-gain, kind="stable")
        segment, gain = self.live[order], gain[order]
        dims = self.dim[segment]
        sums = np.zeros(len(self.ids), "int64")
        # A component differs from its impact by half a level at most. Of a dimension's segments a
        # row is in one at most: it gains no more than the best to come, no less than the worst.
        slack = int(np.abs(query).sum()) * (LEVEL // 2)
        worst = np.zeros(len(query), "int64")
        np.minimum.at(worst, dims, gain)
        below = int(worst.sum()) - slack
        step = max(len(segment) // TRIES, 1)
        possible = members
        for begin in range(0, len(segment), step):
            end = min(begin + step, len(segment))
            for s, g in zip(segment[begin:end].tolist(), gain[begin:end].tolist()):
                sums[self.postings[self.starts[s] : self.starts[s + 1]]] += g
            best = np.zeros(len(query), "int64")
            np.maximum.at(best, dims[end:], gain[end:])
            above = int(best.sum()) + slack
            reach = sums[members]
            kth = np.partition(reach, len(reach) - k)[len(reach) - k]
            possible = members[reach + above >= kth + below]
            if len(possible) <= max(8 * k, len(members) // 64):
                break
        return self._exact(query, possible, k)

    def _exact(self, query: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return [(int(scores[i]), int(rows[i])) for i in best]


def search(
    vectors: DataFrame,
    is_query: str,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """``query_id, rank, key, score`` of the k best other rows for each row where ``is_query`` holds.

    Components become ``floor(scale * x)``, the score is the inner product; ties go to the smaller
    id. A row without an id, and a vector that is null or holds a null or non-finite component,
    takes no part; vectors of another length than the query's score nothing. Every row asks, with a
    list of its own, and finds every row but itself: rows of one id, and rows equal in id and vector,
    are different rows. Other columns are not read, and an empty table gives no rows. Queries meet
    rows in blocks: each block of rows comes to each block of queries.
    """
    let_workers_import(vectors.sparkSession)
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(F.col(key).isNotNull() & x.isNotNull() & finite)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    rows = (
        usable.select(F.col(key).alias("id"), whole.alias("v"), F.expr(is_query).alias("asks"))
        .groupBy("id", "v", "asks").agg(F.count("*").alias("copies"))
    )
    counts = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("queries")).first()
    blocks = max(-(-counts["rows"] // BLOCK_ROWS), 1)
    chunks = max(-(-counts["queries"] // QUERY_ROWS), 1)
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.withColumn("block", place(blocks)).withColumn("chunk", each(chunks))
    name = F.xxhash64("id", "v").alias("name")
    asked = rows.where("asks").select("id", "v", name, place(chunks).alias("chunk"), each(blocks).alias("block"))

    def meet(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = []
        lengths = have["v"].map(len)
        for length, part in have.groupby(lengths) if len(ask) else ():
            held = np.array(part["v"].tolist(), "int64").reshape(len(part), length)
            index = ImpactIndex(part["id"].to_numpy("int64"), held)
            copies = part["copies"].to_numpy()
            for own, name, query in zip(ask["id"], ask["name"], ask["v"]):
                if len(query) == length:
                    query = np.asarray(query, "int64")
                    at = index.place(own, query)
                    # Of several equal rows, all but the one that asks can be found.
                    best = index.top(query, at if at >= 0 and copies[at] == 1 else -1, k)
                    found += [
                        (own, name, int(index.ids[row]), score)
                        for score, row in best for _ in range(min(int(copies[row]) - (row == at), k))
                    ]
        return pd.DataFrame(found, columns=["query_id", "name", "id", "score"]).astype("int64")

    met = stored.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk"))
    best = Window.partitionBy("query_id", "name").orderBy(F.desc("score"), "id")
    lists = (
        met.applyInPandas(meet, "query_id bigint, name bigint, id bigint, score bigint")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )
    times = rows.where("asks AND copies > 1").select(
        F.col("id").alias("query_id"), name, F.explode(F.sequence(F.lit(1), "copies")).alias("time")
    )
    # Rows equal in id and vector ask alike: one list for each of them.
    return lists.join(times, ["query_id", "name"], "left").select(
        "query_id", "rank", F.col("id").alias(key), "score"
    )
