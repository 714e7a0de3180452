"""Quality rules with robust multivariate outliers.

text_stats() counts, per text, what fixed rules need. reject_outliers() then estimates, per language and source, a
minimum-covariance-determinant centre and scatter of transformed statistics, and rejects rows by Mahalanobis distance.
DataFrame operations only. The concentration steps work on a written table of a few numbers per row: each is one
partial aggregate by group and start (a hot source costs no more than others), one small join, and one distance per row.

Estimation of a group, deterministic and alike at every size: several starts (medians with scaled median deviations;
mean and covariance of all its rows; those of four disjoint parts, dealt by a hash) each take two concentration steps: keep
the rows within the h-th smallest distance, take their mean and covariance. The start of least determinant goes on for
two more. The covariance is scaled for consistency at h (and by 1 + 2 p / n, as few rows underrate it), and regularised as
in minimum regularised covariance determinants: a fixed floor is added to each variance, so that a statistic that
hardly varies rejects nothing by itself, and a group of any size, even one row, has an estimate of its own.

Cases: null text: no words, base_failed. Null lang or source: a group of its own. Empty table: empty result. Repeated
rows: each judged alike. Statistics depend on the whole text, however long. Names that clash with the statistics are
replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, let, space_words, written

WINDOW = 8


def _repeated(words: Column, k: int = WINDOW) -> Column:
    """Words that lie in a window of k words found twice or more in the text.

    Window hashes are compared with their distinct ones; only a text with a repeat is sorted, and the union of its
    repeated windows is measured by gaps between their sorted positions.
    """

    def union(at: Column) -> Column:
        after = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.element_at(at, -1) + k))
        return F.aggregate(F.zip_with(at, after, lambda a, b: F.least(F.lit(k), b - a)), F.lit(0), lambda x, y: x + y)

    def positions(pairs: Column) -> Column:
        n = F.size(pairs)
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        kept = F.filter(pairs, lambda p, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(F.when(i + 1 < n, same(i, i + 1)), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda p: p["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(let(pairs, positions), union))

    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, k)))
    return F.when(n <= k, 0).otherwise(let(hashes, count))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper (all long)."""
    t = F.coalesce(F.col(text), F.lit(""))

    def stats(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.when(F.locate("\n", t) > 0, let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0).cast("long").alias("n_dup_lines"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        )

    out = docs.withColumn("__stats", let(space_words(F.col(text)), stats))
    return out.withColumns({c: F.col(f"__stats.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")}).drop("__stats")


#: name: (transformed statistic, floor of its standard deviation). Ratios, so that a text's length alone rejects nothing.
_per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
FEATURES = {
    "length": (lambda: F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), 0.1),
    "symbols": (lambda: F.log1p(_per_word("n_symbols")), 0.08),
    "lines": (lambda: F.sqrt(_per_word("n_dup_lines")), 0.08),
    "repeats": (lambda: F.sqrt(_per_word("n_repeat_words")), 0.15),
    "upper": (lambda: F.log1p(_per_word("n_upper")), 0.12),
}


def _cholesky(cov, n: int):
    """Columns of the lower factor of a positive-definite matrix of columns."""
    low = [[None] * n for _ in range(n)]
    names = {}
    for i in range(n):
        for j in range(i + 1):
            rest = reduce(lambda a, b: a - b, [F.col(f"__l{i}_{k}") * F.col(f"__l{j}_{k}") for k in range(j)], cov(i, j))
            low[i][j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"__l{j}_{j}")
            names[f"__l{i}_{j}"] = low[i][j]
    return names


def _distance(n: int) -> dict[str, Column]:
    """Squared Mahalanobis distance of __x by centre __m and factor __l, by forward substitution, as steps of columns."""
    out = {}
    for i in range(n):
        rest = reduce(lambda a, b: a - b, [F.col(f"__l{i}_{k}") * F.col(f"__y{k}") for k in range(i)], F.col(f"__x{i}") - F.col(f"__m{i}"))
        out[f"__y{i}"] = rest / F.col(f"__l{i}_{i}")
    out["__d"] = reduce(lambda a, b: a + b, [F.col(f"__y{i}") * F.col(f"__y{i}") for i in range(n)])
    return out


def _by_steps(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    for name, c in columns.items():
        df = df.withColumn(name, c)
    return df


def chi_square(x: float, df: int) -> float:
    """The share of a chi-square distribution below x, by the series of the incomplete gamma function."""
    a, h = df / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-15:
        n += 1
        term *= h / (a + n)
        total += term
    return total * math.exp(a * math.log(h) - h - math.lgamma(a)) if x > 0 else 0.0


def consistency(share: float, n: int) -> float:
    """What the covariance of the least distant share of normal rows is to be multiplied by, for n statistics."""
    if share >= 1:
        return 1.0
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, n) < share else (low, mid)
    return share / chi_square(high, n + 2)


def _estimate(rows: DataFrame, keys: list[str], floors: list[float], scale: float) -> DataFrame:
    """Per group: mean __m, factor __l of scale * (1 + 2 p / rows) * covariance + floors**2, and log determinant __det."""
    n = len(floors)
    x = [F.col(f"__x{i}") for i in range(n)]
    aggs = [F.count("*").alias("__n"), *[F.avg(x[i]).alias(f"__m{i}") for i in range(n)]]
    aggs += [F.covar_pop(x[i], x[j]).alias(f"__c{i}_{j}") for i in range(n) for j in range(i + 1)]
    out = rows.groupBy(*keys).agg(*aggs)
    cov = lambda i, j: F.col(f"__c{i}_{j}") * scale * (1 + F.lit(2.0 * n) / F.col("__n")) + (floors[i] ** 2 if i == j else 0.0)
    return _by_steps(out, _cholesky(cov, n)).select(*keys, *_params(n), reduce(lambda a, b: a + b, [F.log(f"__l{i}_{i}") * 2 for i in range(n)]).alias("__det"))


def _params(n: int) -> list[str]:
    return [*[f"__m{i}" for i in range(n)], *[f"__l{i}_{j}" for i in range(n) for j in range(i + 1)]]


def _medians(rows: DataFrame, keys: list[str], floors: list[float]) -> DataFrame:
    """Medians and scaled median absolute deviations as centre and (diagonal) factor."""
    n = len(floors)
    mid = rows.groupBy(*keys).agg(*[F.percentile_approx(f"__x{i}", 0.5, 1000).alias(f"__m{i}") for i in range(n)])
    near = _with(rows, mid, keys)
    mad = near.groupBy(*keys).agg(*[F.percentile_approx(F.abs(F.col(f"__x{i}") - F.col(f"__m{i}")), 0.5, 1000).alias(f"__s{i}") for i in range(n)])
    out = _with(mid, mad, keys)
    return out.select(*keys, *[f"__m{i}" for i in range(n)], *[(F.sqrt((F.col(f"__s{i}") * 1.4826) ** 2 + floors[i] ** 2) if i == j else F.lit(0.0)).alias(f"__l{i}_{j}") for i in range(n) for j in range(i + 1)])


def _with(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by keys that may be null; groups are a few rows a key, and a hot key's rows are split by AQE."""
    g = groups.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    return rows.join(g, on, "left").drop(*[f"__g_{k}" for k in keys])


def estimates(base: DataFrame, keys: list[str], floors: list[float], *, share: float = 0.75, parts: int = 4, label: str = "mcd") -> DataFrame:
    """Per group of keys: centre __m, factor __l and __det of the start that ends with the least determinant.

    base: keys, __x0, __x1... and __part (0..parts - 1).
    """
    n = len(floors)
    scale = consistency(share, n)
    started = [*keys, "__start"]
    as_start = lambda df, k: df.withColumn("__start", k).select(*started, *_params(n))
    est = as_start(_medians(base, keys, floors), F.lit(-2))
    est = est.union(as_start(_estimate(base, keys, floors, 1.0), F.lit(-1)))
    est = est.union(as_start(_estimate(base, [*keys, "__part"], floors, 1.0), F.col("__part")))
    est = written(est, label)

    def step(est: DataFrame) -> DataFrame:
        far = _by_steps(_with(base, est, keys), _distance(n)).select(*started, *[f"__x{i}" for i in range(n)], "__d")
        cut = far.groupBy(*started).agg(F.percentile_approx("__d", share, 1000).alias("__cut"))
        kept = _with(far, cut, started).filter("__d <= __cut")
        out = written(_estimate(kept, started, floors, scale), label)
        drop(est)
        return out

    for k in range(4):
        est = step(est)
        if k == 1:
            best = est.groupBy(*keys).agg(F.min_by(F.struct("__start", *_params(n)), F.struct("__det", "__start")).alias("b"))
            before, est = est, written(best.select(*keys, "b.*"), label)
            drop(before)
    return est.select(*keys, *_params(n), "__det")


def distances(rows: DataFrame, keys: list[str], features: dict, *, share: float = 0.75, label: str = "mcd") -> DataFrame:
    """rows and __d, the squared robust distance of each. rows are written: only keys and statistics are reread at each step."""
    floors = [f for _, f in features.values()]
    base = rows.withColumns({f"__x{i}": c() for i, (c, _) in enumerate(features.values())})
    few = base.select(*keys, *[f"__x{i}" for i in range(len(floors))])
    few = few.withColumn("__part", F.pmod(F.xxhash64(*few.columns[len(keys) :]), F.lit(4)).cast("int"))
    return _by_steps(_with(base, estimates(few, keys, floors, share=share, label=label), keys), _distance(len(floors))).select(*rows.columns, "__d")


#: Squared distance beyond which a row goes (five normal statistics exceed it once in 800 rows; the floors make it rarer).
CUTOFF = 20.0

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")


def judge(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), keys: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """keep's columns, keys, the statistics, base_failed, distance double and kept, one row per row of docs.

    A verdict is made on the row itself, by what the row holds, and joined back by no id. Columns of docs that keep
    doesn't name stay out, so that names can't clash.
    """
    named = {c: f"__k{i}" for i, c in enumerate(dict.fromkeys((*keep, *keys, text)))}
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in named.items()])
    stats = text_stats(rows, named[text])
    stats = written(stats if text in keep else stats.drop(named[text]), "stats")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    out = distances(stats.withColumn("base_failed", failed), [named[k] for k in keys], FEATURES).withColumnRenamed("__d", "distance")
    out = out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))
    own = [c for c in named if c in (*keep, *keys)]
    return out.select(*[F.col(named[c]).alias(c) for c in own], *[c for c in (*STATS, "base_failed", "distance", "kept") if c not in own])


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that judge() keeps, whole and with their own columns, whatever their ids and names."""
    text, keys = options.get("text", "text"), options.get("keys", ("lang", "source"))
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    apart = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    out = judge(apart, **{**options, "text": names[text], "keep": tuple(names.values()), "keys": tuple(names[k] for k in keys)})
    return out.filter("kept").select(*[F.col(a).alias(c) for c, a in names.items()])
