"""Quality rules with robust multivariate outliers, in native operations only.

Documents under ``LEAST_WORDS`` words, or with over ``MOST_REPEATS`` per cent of their
words in repeated three-word windows, fail at once. Of the others, the statistics are
transformed to a vector, and for every language and source location and scatter are
estimated by minimum covariance determinant: from the documents nearest to the medians,
concentration steps keep the ``CORE`` nearest by the current estimate and estimate anew.
The same is done for every language as a whole and for all documents. A language's estimate
is pulled towards that of all documents, and a group's towards its language's, by weights
that fall steadily with the number of documents, so that no size switches the method.
A document is rejected if its squared Mahalanobis distance is beyond ``CUTOFF`` times
what that of the central documents leads to expect.

Every step is one aggregation, pre-aggregated map-side, so a source with a third of all
documents is no hot key; medians and quantiles are mergeable sketches. What is known of the
groups goes back to their documents by broadcast while it is small, and else by a salted join,
since the group of all documents is one key.

Definitions. Words are runs of anything but space and \\x09 to \\x0D; null text has none.
Null languages and sources are groups like others. Each row is judged on its own text;
repeated rows get equal verdicts. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import stage

#: Base rules.
LEAST_WORDS = 50
MOST_REPEATS = 50
#: Share of a group that the estimates rest on, and concentration steps.
CORE = 0.75
STEPS = 3
#: Documents at which a group's own location and scatter weigh half.
LOCATION_HALF, SCATTER_HALF = 5, 50
#: Squared distances beyond this are rejected, where the median is that of a chi-square
#: with five degrees of freedom. Text statistics have heavier tails than the normal.
CUTOFF = 100.0

#: What is known of the groups is broadcast up to this size, and dealt by shares beyond it.
BROADCAST_BYTES = 8 << 20
SHARES = 64

#: Median of a chi-square with five degrees of freedom.
_MEDIAN = 4.351460191
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
#: Least spread of a statistic, so that a constant one doesn't make the scatter singular.
_FLOOR = 0.05

_FEATURES = ["x0", "x1", "x2", "x3", "x4"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def windows(w: Column) -> Column:
        hashed = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"), i.alias("i")
            ),
        )

        def repeated(s: Column) -> Column:
            def has_twin(k: Column) -> Column:
                own = F.get(s, k)["h"]
                return F.coalesce(
                    (k > 0) & (F.get(s, k - 1)["h"] == own) | (F.get(s, k + 1)["h"] == own),
                    F.lit(False),
                )

            twins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), has_twin)
            places = F.transform(twins, lambda k: F.get(s, k)["i"])
            covered = F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(covered))

        return F.when(F.size(w) < 3, 0).otherwise(_let(F.sort_array(hashed), repeated))

    return _let(words, windows)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, lang, source) and the base statistics of every document."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != "")
    read = docs.select(
        F.col("doc_id").cast("long"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        F.length(F.translate(whole, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("w"),
    )
    counted = read.select(
        "*", F.col("w.n").cast("long").alias("n_words"), F.col("w.r").cast("long").alias("n_repeat_words")
    ).drop("w")
    few = F.col("n_words") < LEAST_WORDS
    return counted.withColumn(
        "base_failed", few | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))
    )


def _vectors(counted: DataFrame) -> DataFrame:
    words = F.greatest("n_words", F.lit(1))
    return counted.select(
        "*",
        F.log1p("n_words").alias("x0"),
        F.log(F.greatest(F.col("word_chars") / words, F.lit(0.1))).alias("x1"),
        F.sqrt(F.col("n_symbols") / words).alias("x2"),
        F.sqrt(F.col("n_dup_lines") / words).alias("x3"),
        F.sqrt(F.col("n_repeat_words") / words).alias("x4"),
    )


_GROUP = ["g_lang", "g_source"]


def _grouped(rows: DataFrame) -> DataFrame:
    """Every row in its own group, and in those of its language and of all documents, where
    it counts for the estimates only."""
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    own = F.struct(lang.alias("g_lang"), source.alias("g_source"))
    of_lang = F.struct(lang.alias("g_lang"), F.lit("*").alias("g_source"))
    every = F.struct(F.lit("*").alias("g_lang"), F.lit("*").alias("g_source"))
    return rows.withColumn("g", F.explode(F.array(own, of_lang, every))).select("*", "g.g_lang", "g.g_source").drop("g")


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows beside what the staged table ``groups`` says of their group.

    Its size is counted first. Beyond ``BROADCAST_BYTES`` the documents of a group are dealt
    into shares by their id and vector, so that none is one task's.
    """
    names = F.octet_length("g_lang") + F.octet_length("g_source")
    row = F.coalesce(F.sum(names + 16 * len(groups.columns)), F.lit(0))
    if groups.agg(row.alias("bytes")).first()["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(groups), _GROUP)
    share = F.pmod(F.xxhash64("doc_id", *_FEATURES), F.lit(SHARES)).cast("int")
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    dealt = rows.withColumn("g_share", share)
    return dealt.join(groups.withColumn("g_share", shares), [*_GROUP, "g_share"]).drop("g_share")


def _start(rows: DataFrame) -> DataFrame:
    """Medians of each group, and a diagonal scatter from the median deviations."""
    middle = stage(
        rows.groupBy(*_GROUP).agg(*[F.percentile_approx(x, 0.5).alias(f"m_{x}") for x in _FEATURES]),
        "rules_middle",
    )
    spread = _with_group(rows, middle).groupBy(*_GROUP).agg(
        *[F.first(f"m_{x}").alias(f"m_{x}") for x in _FEATURES],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5).alias(f"d_{x}") for x in _FEATURES],
        F.count(F.lit(1)).alias("members"),
    )
    factors = []
    for i, x in enumerate(_FEATURES):
        factors += [F.lit(0.0).alias(f"l_{i}_{j}") for j in range(i)]
        factors.append(F.greatest(F.col(f"d_{x}") * 1.4826, F.lit(_FLOOR)).alias(f"l_{i}_{i}"))
    return spread.select(*_GROUP, *[f"m_{x}" for x in _FEATURES], *factors, "members")


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Squared distances by forward substitution with the scatter's Cholesky factor."""
    out = _with_group(rows, estimates.drop("members"))
    for i, x in enumerate(_FEATURES):
        rest = F.col(x) - F.col(f"m_{x}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l_{i}_{i}"))
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 5)), F.col("y0") * F.col("y0"))
    return out.select(*rows.columns, total.alias("distance"))


_PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]


def _factored(moments: DataFrame) -> DataFrame:
    """Add the Cholesky factors ``l_i_j`` of the scatter ``c_i_j``."""
    for i, j in _PAIRS:
        rest = F.col(f"c_{i}_{j}")
        for k in range(j):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        if i == j:
            factor = F.sqrt(F.greatest(rest, F.lit(_FLOOR**2)))
        else:
            factor = rest / F.col(f"l_{j}_{j}")
        moments = moments.withColumn(f"l_{i}_{j}", factor)
    return moments


def _estimate(nearest: DataFrame) -> DataFrame:
    """Means and Cholesky factors of the scatter of each group's nearest documents."""
    moments = nearest.groupBy(*_GROUP).agg(
        *[F.avg(x).alias(f"m_{x}") for x in _FEATURES],
        *[
            (F.covar_pop(_FEATURES[i], _FEATURES[j]) + F.lit(_FLOOR**2 if i == j else 0.0)).alias(f"c_{i}_{j}")
            for i, j in _PAIRS
        ],
    )
    return _factored(moments).select(
        *_GROUP, *[f"m_{x}" for x in _FEATURES], *[f"l_{i}_{j}" for i, j in _PAIRS]
    )


def _pulled(groups: DataFrame, towards: DataFrame, on: list[str]) -> DataFrame:
    """Location and scatter of groups, pulled towards others' the more the smaller they are."""
    values = [f"m_{x}" for x in _FEATURES] + [f"c_{i}_{j}" for i, j in _PAIRS]
    others = towards.select(*on, *[F.col(v).alias(f"to_{v}") for v in values])
    both = groups.join(others, on) if on else groups.crossJoin(others)

    def pulled(value: str) -> Column:
        half = LOCATION_HALF if value.startswith("m_") else SCATTER_HALF
        own = F.col("members") / (F.col("members") + half)
        return (own * F.col(value) + (1 - own) * F.col(f"to_{value}")).alias(value)

    return both.select(*_GROUP, "members", *map(pulled, values))


def _shrunk(final: DataFrame) -> DataFrame:
    """Estimates of the groups of language and source, from those of all groups and the
    ``unit`` of each one's distances."""
    # without the correction where the median documents are nearer than expected
    unit = F.greatest("unit", F.lit(1.0))
    scatter = [
        (unit * sum(F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j + 1))).alias(f"c_{i}_{j}")
        for i, j in _PAIRS
    ]
    known = final.select(*_GROUP, "members", *[f"m_{x}" for x in _FEATURES], *scatter)
    langs = _pulled(known.where("g_lang <> '*' and g_source = '*'"), known.where("g_lang = '*'"), [])
    own = _pulled(known.where("g_source <> '*'"), langs, ["g_lang"])
    return _factored(own).select(
        *_GROUP, *[f"m_{x}" for x in _FEATURES], *[f"l_{i}_{j}" for i, j in _PAIRS], "members"
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """The base statistics of every document, ``base_failed``, ``kept`` and the squared
    ``distance`` (null where the base rules fail)."""
    counted = stage(statistics(docs, text), "rules_statistics")
    rows = _vectors(counted.where("not base_failed"))
    grouped = _grouped(rows.select("doc_id", "lang", "source", *_FEATURES)).select("doc_id", *_GROUP, *_FEATURES)
    estimates = stage(_start(grouped), "rules_start")
    members = estimates.select(*_GROUP, "members")
    for _ in range(STEPS):
        distances = _with_distance(grouped, estimates)
        limits = stage(
            distances.groupBy(*_GROUP).agg(F.percentile_approx("distance", CORE).alias("limit")),
            "rules_limits",
        )
        nearest = _with_group(distances, limits).where("distance <= limit")
        estimates = stage(_estimate(nearest).join(members, _GROUP), "rules_estimate")
    # the scatter of the nearest is too small; the median distance puts it right
    medians = (
        _with_distance(grouped, estimates)
        .groupBy(*_GROUP)
        .agg((F.percentile_approx("distance", 0.5) / _MEDIAN).alias("unit"))
    )
    final = stage(estimates.join(medians, _GROUP), "rules_final")
    shrunk = stage(_shrunk(final), "rules_shrunk")
    judged = _with_distance(_grouped(rows).where("g_source <> '*'"), shrunk)
    failed = counted.where("base_failed").select(
        "*", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
    )
    return judged.select(
        *counted.columns, (F.col("distance") <= CUTOFF).alias("kept"), "distance"
    ).union(failed)


def verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
