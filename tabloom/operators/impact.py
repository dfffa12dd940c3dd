"""Exact cosine search over sparse rows by an impact-ordered index.

A block of members becomes postings: for every term its rows, heaviest first, with the largest weight as an upper
bound. A query reads its terms by descending bound until what is left cannot lift a row past the n-th best (max-score); only rows
that still can are scored exactly. Work follows the postings read, and no member row is ever made dense.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sums of at most a few thousand products of numbers up to 1 differ by less.
_SLACK = 1e-9


class ImpactIndex:
    """Postings of unit rows given as CSR arrays; rows of equal score come by id."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int):
        self.ids, self.starts, self.terms, self.weights, self.size = ids, starts, terms, weights, size
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.lexsort((-weights, terms))
        self.rows, self.impacts = row[order], weights[order]
        self.bounds = np.searchsorted(terms[order], np.arange(size + 1))

    def _exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Scores of some rows."""
        sizes = np.diff(self.starts)[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(rows)), sizes)
        return np.bincount(owner, self.weights[at] * query[self.terms[at]], len(rows))

    def best(self, terms: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``n`` best rows, zero scores included; smaller ids first among equals."""
        query = np.zeros(self.size)
        query[terms] = weights
        held = terms[(self.bounds[terms + 1] > self.bounds[terms]) & (weights > 0)]
        most = query[held] * self.impacts[self.bounds[held]]
        order = np.argsort(-most, kind="stable")
        held, left = held[order], np.r_[np.cumsum(most[order][::-1])[::-1], 0.0]
        seen, least = np.zeros(len(self.ids)), 0.0
        for i, term in enumerate(held):
            if left[i] < least - _SLACK:
                break  # no row unseen so far can be among the best
            a, b = self.bounds[term], self.bounds[term + 1]
            seen[self.rows[a:b]] += query[term] * self.impacts[a:b]
            if n < len(seen) and left[i + 1] < left[0] / 2:
                least = float(np.partition(seen, len(seen) - n)[len(seen) - n])
        else:
            i = len(held)
        if n < len(seen):
            least = float(np.partition(seen, len(seen) - n)[len(seen) - n])
        open_ = np.flatnonzero(seen + left[i] >= least - _SLACK)
        if least <= _SLACK:  # rows without a common term fill up by id
            some, none = np.flatnonzero(seen > 0), np.flatnonzero(seen <= 0)
            open_ = np.concatenate([some, none[np.argsort(self.ids[none], kind="stable")[:n]]])
        scores = self._exact(open_, query)
        first = np.lexsort((self.ids[open_], -scores.round(12)))[:n]
        return open_[first], scores[first]


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, starts, terms and weights (of unit length) of rows with a struct of indices and values."""
    vector = table["vector"].combine_chunks()
    fields = dict(zip((f.name for f in vector.type), vector.flatten(), strict=True))
    starts = fields["values"].offsets.to_numpy().astype(np.int64)
    starts, terms = starts - starts[0], fields["indices"].flatten().to_numpy().astype(np.int64)
    weights = fields["values"].flatten().to_numpy().astype(np.float64)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    length = np.sqrt(np.bincount(row, weights * weights, len(starts) - 1))
    return table["id"].to_numpy(), starts, terms, np.divide(weights, length[row], out=np.zeros_like(weights), where=length[row] > 0)


def block_matches(queries: DataFrame, members: DataFrame, keys: list[str], n: int, size: int) -> DataFrame:
    """The ``n`` best members of each block for each query that meets it; both sides have ``id, vector`` and the block's keys."""
    schema = pa.schema([("query_id", pa.int64()), ("member_id", pa.int64()), ("similarity", pa.float64())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        index = ImpactIndex(*_side(right), size)
        ids, starts, terms, weights = _side(left)
        found = [index.best(terms[a:b], weights[a:b], n) for a, b in zip(starts, starts[1:], strict=False)]
        return pa.table([
            pa.array(np.repeat(ids, [len(f[0]) for f in found]), pa.int64()),
            pa.array(index.ids[np.concatenate([f[0] for f in found])], pa.int64()),
            pa.array(np.concatenate([f[1] for f in found]), pa.float64()),
        ], schema=schema)

    return queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(meet, "query_id bigint, member_id bigint, similarity double")
