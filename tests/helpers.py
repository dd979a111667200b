"""Small matrices and the plain-Python product to hold against Spark's."""

from __future__ import annotations

import random
from collections import defaultdict

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# What a failing task surfaces as; the second when several tasks fail at once.
QUERY_FAILURE = (PySparkException, Py4JJavaError)

# The golden pair: 4x3 and 3x2 cells and their product.
A_CELLS = [
    (1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 4), (2, 2, 5), (3, 1, 7),
    (3, 2, 8), (3, 3, 9), (4, 1, 10), (4, 2, 11), (4, 3, 12),
]
B_CELLS = [(1, 1, 10), (1, 2, 15), (2, 2, 2), (3, 1, 11), (3, 2, 9)]
C_CELLS = [
    (1, 1, 43), (1, 2, 46), (2, 1, 40), (2, 2, 70),
    (3, 1, 169), (3, 2, 202), (4, 1, 232), (4, 2, 280),
]


def matrix_a(spark, cells):
    return spark.createDataFrame(cells, "i bigint, k bigint, v bigint")


def matrix_b(spark, cells):
    return spark.createDataFrame(cells, "k bigint, j bigint, v bigint")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(df):
    """Vector records as sorted (row, [(x, v), ...])."""
    return sorted((r[0], [tuple(e) for e in r["vec"]]) for r in df.collect())


def product(a, b, zeros="structural"):
    """C by definition; repeated cells add up."""
    by_k = defaultdict(list)
    for k, j, v in b:
        by_k[k].append((j, v))
    c = defaultdict(int)
    for i, k, v in a:
        for j, w in by_k[k]:
            c[i, j] += v * w
    if zeros == "dense_support":
        for i in {x[0] for x in a}:
            for j in {x[1] for x in b}:
                c[i, j] += 0
    return sorted((i, j, v) for (i, j), v in c.items() if v != 0 or zeros != "drop")


def random_pair(seed, m=23, n=17, p=11, density=0.25, hot=True):
    """Factors with negatives, explicit zeros, empty rows and columns, and a hot k."""
    rng = random.Random(seed)

    def cells(height, width, axis):
        out = []
        for r in range(1, height + 1):
            for c in range(1, width + 1):
                k = c if axis == 1 else r
                share = 0.95 if hot and k == 3 else density
                empty = r == 2 or c == 5
                if not empty and rng.random() < share:
                    out.append((r, c, rng.randint(-3, 3)))
        return out

    return cells(m, n, 1), cells(n, p, 0)
