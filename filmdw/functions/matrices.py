"""Small matrices and vectors as array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def times(matrix: Column, vector: Column) -> Column:
    """Each row of the matrix times the vector."""
    return F.transform(matrix, lambda row: dot(row, vector))


def gram(rows: Column, size: int) -> Column:
    """Sums of products of every two items over an array of rows of ``size`` items."""
    places = F.sequence(F.lit(0), F.lit(size - 1))
    summed = lambda i, j: F.aggregate(rows, F.lit(0.0), lambda total, row: total + row[i] * row[j])
    return F.transform(places, lambda i: F.transform(places, lambda j: summed(i, j)))


def with_penalty(matrix: Column, penalties: list[float]) -> Column:
    """The matrix with one number added to each item of its diagonal."""
    added = F.array(*[F.lit(float(p)) for p in penalties])
    return F.transform(
        matrix, lambda row, i: F.transform(row, lambda x, j: F.when(i == j, x + added[i]).otherwise(x))
    )


def inverse(matrix: Column, size: int) -> Column:
    """Inverse of a positive definite matrix, by Gauss-Jordan steps; items are NULL if it has none."""
    beside = F.transform(
        matrix,
        lambda row, i: F.concat(
            row, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: (i == j).cast("double"))
        ),
    )

    def step(rows: Column, k: Column) -> Column:
        pivot = F.transform(rows[k], lambda x: F.try_divide(x, rows[k][k]))
        return F.transform(
            rows,
            lambda row, i: F.when(i == k, pivot).otherwise(F.zip_with(row, pivot, lambda x, p: x - row[k] * p)),
        )

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), beside, step)
    return F.transform(solved, lambda row: F.slice(row, size + 1, size))
