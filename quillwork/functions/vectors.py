"""Vector functions as Arrow batch functions.

Higher-order array functions are interpreted element by element outside of
whole-stage codegen; on 64-dimensional vectors an Arrow batch with one numpy
reduction is several times faster. Spark still partitions the rows; each call
sees one bounded Arrow batch of the vector columns only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.fixed import COSINE_FLOOR


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def matrix(vectors: pa.Array) -> np.ndarray:
    """A list array as a float64 matrix; all vectors must have one length, whatever batch they are in.

    A null vector is a row of NaN, so what is computed from it can be told from a score.
    """
    sizes = vectors.value_lengths()
    known = sizes.drop_null()
    if len(known) and pc.min_max(known)["min"] != pc.min_max(known)["max"]:
        raise ValueError("vectors of unequal length")
    width = known[0].as_py() if len(known) else 0
    out = np.full((len(vectors), width), np.nan)
    out[vectors.is_valid().to_numpy(zero_copy_only=False)] = (
        vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(known), width)
    )
    return out


def _scores(values: np.ndarray, *vectors: pa.Array) -> pa.Array:
    """Scores, null where one of the vectors is."""
    null = np.zeros(len(values), bool)
    for v in vectors:
        null |= v.is_null().to_numpy(zero_copy_only=False)
    return pa.array(values, mask=null)


def _cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if left.shape[1] != right.shape[1] and left.shape[1] and right.shape[1]:
        raise ValueError("vectors of unequal length")
    if left.shape[1] != right.shape[1]:  # one side is null throughout
        return np.full(len(left), np.nan)

    def norm(x):
        return np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), COSINE_FLOOR)

    return np.einsum("ij,ij->i", left, right) / (norm(left) * norm(right))


def cosine(left, right) -> Column:
    """Cosine of two vectors; a zero vector gives 0, not an error."""

    @F.arrow_udf("double")
    def cosine_(a: pa.Array, b: pa.Array) -> pa.Array:
        return _scores(_cosines(matrix(a), matrix(b)), a, b)

    return cosine_(_column(left), _column(right))


def cosine_of_cubes(left, right) -> Column:
    """Cosine after cubing every element of both vectors."""

    @F.arrow_udf("double")
    def cosine_of_cubes_(a: pa.Array, b: pa.Array) -> pa.Array:
        return _scores(_cosines(matrix(a) ** 3, matrix(b) ** 3), a, b)

    return cosine_of_cubes_(_column(left), _column(right))


def candidate_cosines(candidates, target) -> Column:
    """Both scores of every candidate vector of a row against the row's target.

    Takes ``array<array<float>>`` and ``array<float>``; gives a struct of
    ``cosine`` and ``cosine_3`` arrays. Rows may hold different numbers of
    candidates; the target vector is repeated to match. A null list or target gives
    null, a null candidate a null score.
    """

    @F.arrow_udf("struct<cosine: array<double>, cosine_3: array<double>>")
    def candidate_cosines_(candidates_: pa.Array, target_: pa.Array) -> pa.Array:
        counts = np.asarray(pc.fill_null(candidates_.value_lengths(), 0), dtype=np.int64)
        flat = candidates_.flatten()
        left, right = matrix(flat), matrix(target_)[np.repeat(np.arange(len(counts)), counts)]
        plain, cubed = (_scores(_cosines(left**n, right**n), flat) for n in (1, 3)) if len(left) else (pa.array([], pa.float64()),) * 2
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        missing = pc.or_(candidates_.is_null(), target_.is_null())
        lists = [pa.ListArray.from_arrays(offsets, scores) for scores in (plain, cubed)]
        lists = [pc.if_else(missing, pa.scalar(None, l.type), l) for l in lists]
        return pa.StructArray.from_arrays(lists, names=["cosine", "cosine_3"])

    return candidate_cosines_(_column(candidates), _column(target))


def nearest(vector, centres: list[list[float]]) -> Column:
    """Number of the closest centre; the first one wins a tie.

    The centres travel inside the function, in blocks of bounded size: each block
    gives its nearest centre, and the least of these is the answer. A null vector has none.
    """
    table = np.asarray(centres, dtype=np.float64)
    step = max(1, CENTRE_BYTES // max(1, table[:1].nbytes))
    best = [_nearest_in(_column(vector), table[begin : begin + step], begin) for begin in range(0, len(table), step)]
    return (F.least(*best) if len(best) > 1 else best[0])["number"]


CENTRE_BYTES = 8 << 20


def closest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distance, place) of the nearest centre of each row.

    Distances are compared to nine decimals, and the first centre wins a tie: so
    rounding does not decide between centres that are equally far.
    """
    best, at = np.full(len(rows), np.nan), np.zeros(len(rows), np.int64)
    for place, centre in enumerate(centres):
        distance = np.round(((rows - centre) ** 2).sum(axis=1), 9)
        nearer = np.flatnonzero(~(distance >= best) & ~np.isnan(distance))
        best[nearer], at[nearer] = distance[nearer], place
    return best, at


def _nearest_in(vector: Column, table: np.ndarray, begin: int) -> Column:
    @F.arrow_udf("struct<distance: double, number: int>")
    def nearest_(vectors: pa.Array) -> pa.Array:
        distances, at = closest(matrix(vectors), table)
        found = [pa.array(distances), pa.array((at + begin).astype(np.int32))]
        return pa.StructArray.from_arrays(found, names=["distance", "number"], mask=vectors.is_null())

    return nearest_(vector)
