"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

#: Base rules: least words, most of them (percent) in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Share of a group's documents whose covariance determinant is made least.
SHARE = 0.75

#: Concentration steps (each lowers the determinant; a few come close to where it stays).
STEPS = 3

#: A group with fewer documents is judged with others of its language, then with all.
LEAST_GROUP = 60

#: Standard deviations below which a statistic is not told apart, so that no scatter is singular:
#: ln words, ln word length, ln(1 + symbols %), ln(1 + repeated lines %), ln(1 + repeated words %).
FLOORS = (0.1, 0.02, 0.3, 0.3, 0.5)

#: Axes that are 0 in most documents. What the nearest documents show there may be zeros alone,
#: so the deviation isn't taken below that of the group's ``UPPER`` quantile from its median,
#: ``NORMAL`` being a normal sample's: values of at least a tenth of the group aren't outliers.
SPARSE, UPPER, NORMAL = (2, 3, 4), 0.9, 1.2816

#: Squared distances beyond the 0.9999 quantile of chi-squared with five degrees of freedom
#: are outliers; its median calibrates the distances.
CUTOFF, MEDIAN = 25.745, 4.351

#: Width of the classes in which values and logarithms of distances are counted.
STEP = 1 / 32

_SPACE = r"[\x20\x09-\x0D]+"
_NAMES = [f"x{i}" for i in range(len(FLOORS))]


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that are found twice or more, first included.

    Windows are compared by 64-bit hashes of their words' hashes, sorted with their places.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - 3)
        return F.sort_array(F.transform(places, lambda i: F.struct(F.xxhash64(h[i], h[i + 1], h[i + 2]).alias("t"), i.alias("i"))))

    def again(s: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            before = (i > 0) & (s[F.greatest(i - 1, F.lit(0))]["t"] == x["t"])
            after = (i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["t"] == x["t"])
            return before | after

        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def add(state: Column, p: Column) -> Column:
        new = p + 3 - F.greatest(state["upto"], p)
        return F.struct((state["n"] + new).alias("n"), (p + 3).alias("upto"))

    # each step binds its array once: a lambda's outer expression would be evaluated per element
    sorted_ = F.transform(F.array(hashes), windows)
    places = F.transform(sorted_, again)[0]
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.when(F.size(words) >= 3, F.aggregate(places, start, add, lambda s: s["n"])).otherwise(0)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` of whole texts.

    A null text has no words and no lines: all numbers are 0.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), body.alias("body"))
    words = F.filter(F.split("body", _SPACE), lambda w: w != "")
    lines = F.filter(F.split("body", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def numbers(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    repeats = F.transform(F.array(lines), lambda s: F.size(s) - F.size(F.array_distinct(s)))[0]
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        repeats.cast("long").alias("n_dup_lines"),
        F.inline(F.transform(F.array(words), numbers)),
    )
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _vector() -> list[Column]:
    """The statistics on scales on which they are roughly symmetric."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    columns = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
        F.log1p(100 * F.col("n_repeat_words") / n),
    ]
    return [c.alias(x) for c, x in zip(columns, _NAMES, strict=True)]


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with the group that judges each: language and source, the language, or all."""
    pair = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = pair.withColumn("small", F.col("n") < LEAST_GROUP)
    # documents of small groups are judged together
    rest = small.filter("small").groupBy("lang").agg(F.sum("n").alias("m"))
    named = small.alias("p").join(rest.alias("r"), F.col("p.lang").eqNullSafe(F.col("r.lang")), "left")
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    group = F.when(~F.col("small"), F.concat_ws("\x01", text("p.lang"), text("p.source"))).when(F.col("m") >= LEAST_GROUP, text("p.lang")).otherwise("")
    named = materialize(named.select(F.col("p.lang").alias("l"), F.col("p.source").alias("s"), group.alias("group")), "groups")
    joined = rows.join(named, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")))
    return joined.select("group", "doc_id", *_NAMES)


def _reached(counts: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """The least ``value`` up to which at least ``share`` of the counted rows lie."""
    whole = F.sum("n").over(W.partitionBy(*by))
    upto = F.sum("n").over(W.partitionBy(*by).orderBy(value))
    marked = counts.select(*by, value, upto.alias("upto"), whole.alias("whole"))
    return marked.filter(F.col("upto") >= F.ceil(share * F.col("whole"))).groupBy(*by).agg(F.min(value).alias(value))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges per group, as a first location and a diagonal first scatter; least variances ``f..``."""
    long = rows.select("group", F.posexplode(F.array(*_NAMES)).alias("axis", "x"))
    counts = long.groupBy("group", "axis", F.floor(F.col("x") / STEP).alias("class")).agg(F.count("*").alias("n"))
    counts = materialize(counts, "classes")
    quart = [_reached(counts, ["group", "axis"], "class", q).withColumnRenamed("class", c) for q, c in ((0.25, "a"), (0.5, "b"), (0.75, "c"), (UPPER, "d"))]
    q = quart[0].join(quart[1], ["group", "axis"]).join(quart[2], ["group", "axis"]).join(quart[3], ["group", "axis"])
    pick = lambda k, v: F.max(F.when(F.col("axis") == k, v))
    spread = F.pow((F.col("c") - F.col("a")) * STEP / 1.349, 2)
    means = [pick(k, (F.col("b") + 0.5) * STEP).alias(f"m{k}") for k in range(len(FLOORS))]
    cov = [(pick(i, spread) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(len(FLOORS)) for j in range(i + 1)]
    upper = F.pow((F.col("d") - F.col("b")) * STEP / NORMAL, 2)
    least = [F.greatest(pick(k, upper if k in SPARSE else F.lit(0.0)), F.lit(x**2)).alias(f"f{k}") for k, x in enumerate(FLOORS)]
    return q.groupBy("group").agg(*means, *cov, *least)


def _fit(rows: DataFrame) -> DataFrame:
    """Means and covariances per group."""
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_NAMES)]
    cov = [F.covar_pop(_NAMES[i], _NAMES[j]).alias(f"c{i}{j}") for i in range(len(FLOORS)) for j in range(i + 1)]
    return rows.groupBy("group").agg(*means, *cov)


def _factored(params: DataFrame) -> DataFrame:
    """Cholesky factor ``l..`` of each covariance, its variances raised to the least ones."""
    for j in range(len(FLOORS)):
        square = F.greatest(f"c{j}{j}", f"f{j}")
        for k in range(j):
            square = square - F.col(f"l{j}{k}") ** 2
        params = params.withColumn(f"l{j}{j}", F.sqrt(F.greatest(square, F.lit(FLOORS[j] ** 2 / 100))))
        for i in range(j + 1, len(FLOORS)):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            params = params.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    return params.select("group", *(f"m{i}" for i in range(len(FLOORS))), *(f"l{i}{j}" for i in range(len(FLOORS)) for j in range(i + 1)))


def _distances(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` and its class."""
    df = rows.join(materialize(_factored(params), "factors"), "group")
    for i in range(len(FLOORS)):  # forward substitution
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") ** 2 for i in range(1, len(FLOORS))), F.col("z0") ** 2)
    return df.select("group", "doc_id", *_NAMES, d2.alias("d2"), F.floor(F.log1p(d2) / STEP).alias("class"))


def _classes(far: DataFrame) -> DataFrame:
    return far.groupBy("group", "class").agg(F.count("*").alias("n"))


def outliers(rows: DataFrame) -> DataFrame:
    """``(group, d2, scale)`` and the columns of ``rows`` (``group, doc_id, x..``).

    Minimum covariance determinant by concentration: from medians and quartiles on, each
    step keeps the ``SHARE`` of a group's rows that are nearest and estimates mean and
    covariance from them. Quantiles are taken from counts per class of distance, so rows
    only meet in sums. ``scale`` brings a median distance above a normal sample's down to it.
    """
    params = materialize(_start(rows), "start")
    least = params.select("group", *(f"f{k}" for k in range(len(FLOORS))))
    for _ in range(STEPS):
        far = _distances(rows, params)
        near = _reached(_classes(far), ["group"], "class", SHARE).withColumnRenamed("class", "most")
        near = materialize(near, "nearest")
        params = _fit(far.join(near, "group").filter("class <= most")).join(least, "group")
    far = _distances(rows, params)
    middle = _reached(_classes(far), ["group"], "class", 0.5)
    scale = F.expm1((F.col("class") + 0.5) * STEP) / MEDIAN
    middle = materialize(middle.select("group", F.greatest(scale, F.lit(1.0)).alias("scale")), "scales")
    return far.drop("class").join(middle, "group")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of every row.

    The estimates are made of the rows that pass the base rules; such a row is rejected if
    its calibrated squared distance is over ``CUTOFF``. A group (language and
    source, null being a value) of under ``LEAST_GROUP`` rows is judged with the other small
    ones of its language, and these with all others if they are still too few. Rows keep
    their number whatever is null or repeated; empty input gives no rows.
    """
    stats = statistics(docs, key, text, lang, source)
    rows = materialize(stats.withColumn("base_failed", base_failed()), "statistics")
    passed = rows.filter("NOT base_failed")
    # rows with the same numbers in the same group are judged alike, whatever their ids
    vectors = _grouped(passed.select("lang", "source", F.struct("lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").alias("doc_id"), *_vector()))
    vectors = materialize(vectors, "vectors")
    far = outliers(vectors).filter(F.col("d2") > CUTOFF * F.col("scale"))
    gone = far.select("doc_id.*").distinct()
    marks = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    gone = gone.select(*(F.col(c).alias(f"_{c}") for c in gone.columns))
    same = F.lit(True)
    for c in ["lang", "source"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    for c in marks:
        same = same & (F.col(c) == F.col(f"_{c}"))
    judged = rows.join(gone, same, "left")
    return judged.select("doc_id", *marks, "base_failed", (~F.col("base_failed") & F.col("_n_words").isNull()).alias("kept"))
