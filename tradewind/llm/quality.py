"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

Every document has a vector of shares (symbols, repeated lines, repeated words, words equal to the
one before, capitals, marks, digits; capitals, marks and digits of ASCII) and its mean word length, counted over the whole text. Shares are pulled towards that of
their group by PRIOR_WORDS words, so short texts with little evidence stay near it, and transformed
by the arcsine of their root, which evens out their variance.

For each group of language and source the minimum covariance determinant estimate gives a centre
and scatter that junk does not move: from two deterministic starts, concentration steps re-estimate
both from the COVERAGE of rows that are nearest until the determinant falls no more (by SETTLED of
its logarithm), and the start with the smaller determinant wins.
A document is rejected if its squared Mahalanobis distance, scaled so that the group's median is
that of the chi-squared distribution, is above LIMIT. The scatter is shrunk a little towards the
start's (as in the regularised variant of the estimate), so that a share that is zero nearly
everywhere has a finite scale.

Groups of under MIN_GROUP rows are pooled by language, and what is still too small into one group;
if that is too small as well, nothing in it is rejected. Each step is one map-side aggregation over
all rows, whatever the size of a group. Quantiles are approximate to RANK_ERROR of the rank.

A NULL text has no words. A NULL language or source is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.batches import (
    BROADCAST_ROWS,
    arrow_schema,
    group_bounds,
    importable,
    join_small,
    map_texts,
)
from tradewind.operators.lineage import written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"

COVERAGE = 0.75
SETTLED = 1e-3
SHRINKAGE = 0.1
PRIOR_WORDS = 40
MIN_GROUP = 60
LIMIT = 100.0
RANK_ERROR = 1000  # 1 / RANK_ERROR is the error of a quantile's rank

# (share, counted, out of, smallest scale of the transformed share)
SHARES = (
    ("symbol_share", "n_symbols", "word_chars", 0.07),
    ("line_share", "n_dup_lines", "n_lines", 0.50),
    ("repeat_share", "n_repeat_words", "n_words", 0.50),
    ("stutter_share", "n_stutters", "n_words", 0.10),
    ("capital_share", "n_capitals", "word_chars", 0.10),
    ("mark_share", "n_marks", "word_chars", 0.10),
    ("digit_share", "n_digits", "word_chars", 0.30),
    ("length_share", "word_chars", "n_words", 0.10),
)
AXES = tuple(name for name, *_ in SHARES)
PAIRS = tuple(combinations_with_replacement(range(len(AXES)), 2))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_capitals", "n_marks", "n_digits", "n_stutters")

_SPACES = " \t\n\x0b\x0c\r"
_MIX = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(64)], np.uint64)


def _repeated_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words in windows of ``size`` words that occur twice or more, the first ones included."""
    count = len(words) - size + 1
    if count < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(count, np.uint64)
    for k in range(size):
        windows += hashes[k:k + count] * _MIX[k]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    # Hashes only nominate; windows count as equal if their words are.
    seen: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for at in np.sort(order[np.r_[same, False] | np.r_[False, same]]).tolist():
        window = tuple(words[at:at + size])
        first = seen.setdefault(window, at)
        if first != at:
            for start in (first, at):
                covered[start] += 1
                covered[min(start + size, len(words))] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts(text: str | None) -> dict[str, int]:
    """The counts of a text that the rules and the vector are made of."""
    text = text or ""
    encoded = text.encode()
    words = encoded.split()  # bytes: ASCII white space only
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    word_chars = len(text) - sum(map(text.count, _SPACES))
    table = np.bincount(np.frombuffer(encoded, np.uint8), minlength=256)
    marks = table[0x21:0x7F].sum() - table[48:58].sum() - table[65:91].sum() - table[97:123].sum()
    return {"n_words": len(words), "word_chars": word_chars,
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": _repeated_words(words), "n_lines": len(lines),
            "n_capitals": int(table[65:91].sum()), "n_marks": int(marks),
            "n_digits": int(table[48:58].sum()),
            "n_stutters": sum(map(eq, words, words[1:]))}


def statistics(rows: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The kept columns, the counts of each text and the verdict of the fixed limits."""
    kinds = dict(rows.dtypes)
    names = [f"_k{i}" for i in range(len(keep))]

    def kernel(texts, _):
        found = [counts(value) for value in texts]
        return {name: [one[name] for one in found] for name in COUNTS}

    schema = ", ".join([*(f"{new} {kinds[name]}" for new, name in zip(names, keep, strict=True)),
                        *(f"{name} bigint" for name in COUNTS)])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passed = [F.col(f"`{name}`").alias(new) for new, name in zip(names, keep, strict=True)]
    return map_texts(rows, text, [], kernel, schema, passed).withColumn("base_failed", failed)


# --- robust outliers -------------------------------------------------------------------

def _share(i: int, ratio: Column) -> Column:
    """A transformed share, pulled towards the ratio of its group."""
    name, counted, of, _ = SHARES[i]
    if name == "length_share":  # a mean, not a share
        return F.log((F.col(counted) + PRIOR_WORDS * ratio) / (F.col(of) + PRIOR_WORDS))
    # a prior of as many words in the unit of the share
    prior = {"n_words": PRIOR_WORDS, "word_chars": 5 * PRIOR_WORDS, "n_lines": 6}[of]
    share = (F.col(counted) + prior * ratio) / (F.col(of) + prior)
    return 2 * F.asin(F.sqrt(F.least(share, F.lit(1.0))))


def _group_name(language: Column, source: Column) -> Column:
    return F.to_json(F.struct(language.cast("string").alias("language"),
                              source.cast("string").alias("source")))


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """(name, grp): the group that each language and source is judged in."""
    sizes = rows.groupBy("name", "language").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < min_group
    pooled = sizes.withColumn("of_language", F.sum(F.when(small, F.col("n"))).over(
        Window.partitionBy("language")))
    by_language = F.to_json(F.struct("language", F.lit(True).alias("pooled")))
    grp = (F.when(~small, F.col("name"))
           .when(F.col("of_language") >= min_group, by_language).otherwise("rest"))
    named = written(pooled.select("name", grp.alias("grp"), "n"))
    rest = named.where("grp = 'rest'").agg(F.sum("n")).first()[0] or 0
    return named.where("grp != 'rest'" if rest < min_group else "true").drop("n")


def _joined(rows: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the columns of their group; there are far fewer groups than rows. ``few`` says
    that the groups may be broadcast, which is counted once and not for every join."""
    groups = groups.withColumnRenamed("grp", "_grp")
    return rows.join(F.broadcast(groups) if few else groups,
                     F.col("grp") == F.col("_grp")).drop("_grp")


# Sums of groups that a task holds before it passes them on.
HELD_GROUPS = 10_000


def _given(rows: DataFrame, estimates: DataFrame, few: bool) -> tuple[DataFrame, Broadcast | None]:
    """The rows and, if they are few, the estimates for the tasks; else the rows joined with them.

    A row takes 600 bytes with its estimate, so few estimates don't travel with the rows.
    """
    if not few:
        return _joined(rows, estimates, few), None
    found = estimates.collect()
    table = {name: np.array([row[name] for row in found]) for name in estimates.columns
             if name != "grp"}
    places = {(row["grp"], row["start"]): i for i, row in enumerate(found)}
    return rows, rows.sparkSession.sparkContext.broadcast((places, table))


def _parts(batch: pa.RecordBatch, given: Broadcast | None) -> Iterator[dict]:
    """The groups, axes and estimates of a batch's rows, once for each start."""
    groups = batch.column("grp").dictionary_encode()
    codes, known = groups.indices.to_numpy(), groups.dictionary.to_pylist()
    values = np.array([batch.column(name).to_numpy(zero_copy_only=False) for name in AXES])
    if given is None:
        found = {name: batch.column(name) for name in batch.schema.names
                 if name not in ("grp", *AXES)}
        yield {"known": known, "codes": codes, "values": values} | {
            name: column.flatten().to_numpy().reshape(len(column), -1)
            if pa.types.is_list(column.type) else column.to_numpy()
            for name, column in found.items()}
        return
    places, table = given.value
    for start in (0, 1):
        place = np.array([places.get((name, start), -1) for name in known], int)[codes]
        inside = place >= 0
        yield {"known": known, "codes": codes[inside], "values": values[:, inside]} | {
            name: column[place[inside]] for name, column in table.items()}


def _squared(part: dict) -> np.ndarray:
    """Squared Mahalanobis distances of the axes from ``centre`` by ``inverse``, term by term as
    :func:`_distance` adds them, so that a row has one distance wherever it is computed."""
    size, inverse = len(AXES), part["inverse"].T
    apart = part["values"] - part["centre"].T
    return sum(((1 if i == j else 2) * inverse[i * size + j] * apart[i] * apart[j]
                for i, j in PAIRS), np.zeros(apart.shape[1]))


def _distances(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """(grp, start, d2) of the axes of rows for each estimate of their group."""
    schema = "grp string, start int, d2 double"
    target = arrow_schema(schema)
    importable(rows.sparkSession)
    rows, given = _given(rows, estimates, few)

    def run(batches):
        for batch in batches:
            for part in _parts(batch, given) if batch.num_rows else ():
                names = pa.array(part["known"], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(part["codes"])), pa.array(part["start"], pa.int32()),
                     pa.array(_squared(part))], schema=target)

    columns = [] if given else ["start", "centre", "inverse"]
    return rows.select("grp", *AXES, *columns).mapInArrow(run, schema)


def _moments(rows: DataFrame, limits: DataFrame | None = None, few: bool = True) -> DataFrame:
    """(grp, start, last, n, totals): sums and products of the axes, an array for each task, over
    the rows within ``reach`` of their estimate in ``limits``. Without limits the axes of all rows
    are squashed, for the start from them. ``last`` is the same in all of a start."""
    schema = "grp string, start int, last double, n bigint, totals array<double>"
    target = arrow_schema(schema)
    importable(rows.sparkSession)
    if limits is None:
        rows, given = rows.withColumns({"start": F.lit(1), "last": F.lit(float("inf"))}), None
        columns = ["start", "last"]
    else:
        rows, given = _given(rows, limits, few)
        columns = [] if given else ["start", "last", "reach", "centre", "inverse"]
    squash = limits is None

    def run(batches):
        held: dict[tuple[str, int], list] = {}

        def taken():
            out = [[*key, *own] for key, own in held.items()]
            held.clear()
            return pa.RecordBatch.from_pydict(
                {name: [row[i] for row in out] for i, name in enumerate(target.names)},
                schema=target)

        for batch in batches:
            for part in _parts(batch, given) if batch.num_rows else ():
                values, codes, start = part["values"], part["codes"], part["start"]
                inside = (np.ones(len(codes), bool) if squash
                          else _squared(part) <= part["reach"])
                chosen = np.flatnonzero(inside)
                chosen = chosen[np.lexsort((start[chosen], codes[chosen]))]
                if not len(chosen):
                    continue
                values = np.tanh(values[:, chosen]) if squash else values[:, chosen]
                bounds, ends = group_bounds(2 * codes[chosen].astype(np.int64) + start[chosen])
                totals = np.array([np.add.reduceat(value, bounds) for value in (
                    *values, *(values[i] * values[j] for i, j in PAIRS))]).T
                for k, (at, end) in enumerate(zip(bounds, ends, strict=True)):
                    row = chosen[at]
                    own = held.setdefault((part["known"][codes[row]], int(start[row])),
                                          [float(part["last"][row]), 0, 0.0])
                    own[1] += int(end - at)
                    own[2] = own[2] + totals[k]
                if len(held) > HELD_GROUPS:
                    yield taken()
        yield taken()

    parts = rows.select("grp", *AXES, *columns).mapInArrow(run, schema)
    return parts.groupBy("grp", "start").agg(
        F.first("last").alias("last"), F.sum("n").alias("n"),
        F.collect_list("totals").alias("totals"))


def _estimates(moments: DataFrame, centred: bool) -> DataFrame:
    """(grp, start, centre, inverse, volume, last): a row per group and start, by numpy."""
    schema = ("grp string, start int, centre array<double>, inverse array<double>, "
              "volume double, last double")
    target = arrow_schema(schema)
    size = len(AXES)
    importable(moments.sparkSession)

    def run(batches):
        for batch in batches:
            out = {name: [] for name in target.names}
            for row in batch.to_pylist():
                totals = np.sum(row["totals"], axis=0)
                mean = totals[:size] / row["n"]
                scatter = np.zeros((size, size))
                for (i, j), value in zip(PAIRS, totals[size:], strict=True):
                    scatter[i, j] = scatter[j, i] = value / row["n"] - mean[i] * mean[j]
                if not centred:  # a start: correlations of squashed values around the median
                    scale = np.sqrt(np.maximum(np.diag(scatter), 1e-3))
                    scatter, mean = scatter / np.outer(scale, scale), np.zeros(size)
                scatter = (1 - SHRINKAGE) * scatter + SHRINKAGE * np.eye(size)
                out["grp"].append(row["grp"])
                out["start"].append(row["start"])
                out["centre"].append(mean)
                out["inverse"].append(np.linalg.inv(scatter).ravel())
                out["volume"].append(float(np.linalg.slogdet(scatter)[1]))
                out["last"].append(row["last"])
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return moments.mapInArrow(run, schema)


def _distance(axes: list[Column]) -> Column:
    """Squared Mahalanobis distance of the axes from ``centre`` by ``inverse``."""
    apart = [axis - F.col("centre")[i] for i, axis in enumerate(axes)]
    return sum(((1 if i == j else 2) * F.col("inverse")[i * len(axes) + j] * apart[i] * apart[j]
                for i, j in PAIRS), F.lit(0.0))


def _concentrated(axes: DataFrame, few: bool = True) -> DataFrame:
    """(grp, centre, inverse): the estimate of smallest determinant per group.

    A step reads the rows twice and is written once. What a step finds stays in its own written
    frame, and all are read together at the end: a plan never holds the steps before it. Distances
    and moments are made by numpy; as expressions they make plans and code of hundreds of terms,
    which take the driver's memory.
    """
    size = len(AXES)
    endless = F.lit(float("inf"))
    squashed = _estimates(_moments(axes), centred=False).drop("last")
    apart = squashed.select(  # the other start: each axis on its own
        "grp", F.lit(0).alias("start"), F.array(*[F.lit(0.0)] * size).alias("centre"),
        F.array(*(F.lit(float(i == j)) for i in range(size) for j in range(size)))
        .alias("inverse"), F.lit(0.0).alias("volume"))
    falling = written(squashed.unionByName(apart).withColumn("volume", endless))
    steps = [falling.limit(0).withColumn("step", F.lit(0))]
    while not falling.isEmpty():
        reach = _distances(axes, falling, few).groupBy("grp", "start").agg(
            F.percentile_approx("d2", COVERAGE, RANK_ERROR).alias("reach"))
        limits = reach.join(F.broadcast(falling) if few else falling, ["grp", "start"])
        step = written(_estimates(_moments(
            axes, limits.withColumnRenamed("volume", "last"), few), centred=True))
        # Quantiles are approximate, so a step may also rise; what has settled is not stepped again.
        falling = step.where(F.col("volume") < F.col("last") - SETTLED).drop("last")
        steps.append(falling.withColumn("step", F.lit(len(steps))))
    newest = reduce(DataFrame.unionByName, steps).groupBy("grp", "start").agg(F.max_by(
        F.struct("centre", "inverse", "volume"), "step").alias("newest")).select(
        "grp", "start", "newest.*")
    return newest.groupBy("grp").agg(F.min_by(
        F.struct("centre", "inverse"), F.struct("volume", "start")).alias("best")).select(
        "grp", "best.*")


def _chi2_median(freedom: int) -> float:
    return freedom * (1 - 2 / (9 * freedom)) ** 3


def fit(found: DataFrame, language: str = "lang", source: str = "source",
        min_group: int = MIN_GROUP) -> DataFrame:
    """Robust estimates from ``statistics``: a row per language and source that is judged.

    (name, ratio, middle, spread, centre, inverse, scale): the group's overall shares, the medians
    and scales of the transformed ones, the centre and inverse scatter of the standardised ones,
    and what squared distances are divided by.
    """
    rows = found.where("NOT base_failed").select(
        _group_name(F.col(language), F.col(source)).alias("name"),
        F.col(language).cast("string").alias("language"), *COUNTS)
    names = _groups(rows, min_group)
    # Two starts for each group, and no more groups than names.
    few = 2 * names.limit(BROADCAST_ROWS).count() <= BROADCAST_ROWS
    grouped = written(rows.drop("language").withColumnRenamed("name", "_name").join(
        F.broadcast(names) if few else names,
        F.col("_name") == F.col("name")).drop("_name", "name"))
    ratios = written(grouped.groupBy("grp").agg(F.array(*(
        F.sum(counted) / F.greatest(F.sum(of), F.lit(1))
        for _, counted, of, _ in SHARES)).alias("ratio")))
    shares = written(_joined(grouped, ratios, few).select(
        "grp", *(_share(i, F.col("ratio")[i]).alias(name) for i, name in enumerate(AXES))))
    middle = written(shares.groupBy("grp").agg(F.array(*(
        F.percentile_approx(name, 0.5, RANK_ERROR) for name in AXES)).alias("middle")))
    spread = _joined(shares, middle, few).groupBy("grp").agg(F.array(*(
        F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(name) - F.col("middle")[i]), 0.5,
                                                RANK_ERROR), F.lit(SHARES[i][3]))
        for i, name in enumerate(AXES))).alias("spread"))
    scales = written(ratios.join(middle, "grp").join(spread, "grp"))
    axes = written(_joined(shares, scales.drop("ratio"), few).select("grp", *(
        ((F.col(name) - F.col("middle")[i]) / F.col("spread")[i]).alias(name)
        for i, name in enumerate(AXES))))
    best = written(_concentrated(axes, few))
    scale = _distances(axes, best.withColumn("start", F.lit(0)), few).groupBy("grp").agg(
        F.greatest(F.percentile_approx("d2", 0.5, RANK_ERROR) / _chi2_median(len(AXES)),
                   F.lit(1.0)).alias("scale"))
    return written(names.join(scales, "grp").join(best, "grp").join(scale, "grp").drop("grp"))


def score(found: DataFrame, models: DataFrame, language: str = "lang", source: str = "source",
          limit: float = LIMIT) -> DataFrame:
    """``found`` with ``distance`` and ``kept``."""
    named = found.withColumn("_name", _group_name(F.col(language), F.col(source)))
    joined = join_small(named, models, F.col("_name") == F.col("name"), "left")
    axes = [(_share(i, F.col("ratio")[i]) - F.col("middle")[i]) / F.col("spread")[i]
            for i in range(len(AXES))]
    judged = joined.withColumn("distance", F.when(
        ~F.col("base_failed"), _distance(axes) / F.col("scale")))
    return judged.select(*found.columns, "distance", (
        ~F.col("base_failed") & ~F.coalesce(F.col("distance") > limit, F.lit(False)))
        .alias("kept"))


def judge(rows: DataFrame, text: str = "text", row_id: str = "doc_id", language: str = "lang",
          source: str = "source", min_group: int = MIN_GROUP, limit: float = LIMIT) -> DataFrame:
    """(row_id, counts, base_failed, distance, kept) of every row.

    ``distance`` is the scaled squared distance that ``limit`` is compared with, NULL where the
    fixed limits fail or the group is too small to judge.
    """
    found = written(statistics(rows, text, (row_id, language, source)))
    models = fit(found, "_k1", "_k2", min_group)
    return score(found, models, "_k1", "_k2", limit).select(
        F.col("_k0").alias(row_id), *COUNTS, "base_failed", "distance", "kept")


def keep_good(rows: DataFrame, text: str = "text", language: str = "lang",
              source: str = "source") -> DataFrame:
    """The rows that ``judge`` keeps, with their columns.

    Texts are counted twice, once for the estimates and once on their way through, which is cheaper
    than to join verdicts to whole texts.
    """
    models = fit(written(statistics(rows, text, (language, source))), "_k0", "_k1")
    names = {name: f"_k{i}" for i, name in enumerate(rows.columns)}
    judged = score(statistics(rows, text, tuple(rows.columns)), models, names[language],
                   names[source])
    return judged.where("kept").select(*(F.col(new).alias(name) for name, new in names.items()))
