"""Feature statistics against a class target, from per-class moments and joint
counts: the table is read once, and never expanded to one column per level."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import as_number
from ..session import cut_lineage, ship_by_value
from .common import attach_scalars, join_keys, long_numeric, long_text, small_side
from .ordered import exact_quantiles, rank_min, running_totals, slot_starts, slotted
from .profile import null_percent
from .projection import select_existing

ship_by_value(__name__)

NULL_LEVEL = "<NA>"


# ---------------------------------------------------------------- numeric matrix and codes

def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column; 0 for a column without values."""
    found = exact_quantiles(long_numeric(df, cols), ["variable"], "value", {"m": .5}).collect()
    known = {r["variable"]: r["m"] for r in found}
    return {c: known.get(c, 0.0) for c in cols}


def median_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns with missing replaced by the median."""
    if not cols:
        return df
    fill = medians(df, cols)
    return df.withColumns({c: F.coalesce(as_number(c), F.lit(fill[c])) for c in cols})


def level_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, level, code): sorted levels numbered from 0, missing included."""
    levels = long_text(df, cols).select("variable", F.coalesce("value", F.lit(NULL_LEVEL)).alias("level")).distinct()
    numbered = running_totals(levels, ["variable"], "level", {"n": F.count(F.lit(1))}, descending=False)
    return numbered.select("variable", "level", (F.col("cum_n") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add the code of every text column."""
    codes = small_side(level_codes(df, cols))
    for c in cols:
        side = codes.filter(F.col("variable") == c).select(F.col("level").alias("_level"),
                                                           F.col("code").alias(c + suffix))
        df = df.join(side, F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL)) == F.col("_level"), "left").drop(
            "_level")
    return df


# ---------------------------------------------------------------- one-way ANOVA

def _f_from_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F and degrees of freedom from one row (n, mean, var) per key and class."""
    total = F.sum("n")
    grand = F.sum(F.col("n") * F.col("mean")) / total
    # between-class sum of squares around the grand mean, taken in two steps
    sums = moments.groupBy(*keys).agg(
        total.alias("n_total"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("var")).alias("within"),
        grand.alias("grand"), F.collect_list(F.struct("n", "mean")).alias("_classes"))
    between = F.aggregate("_classes", F.lit(0.0), lambda acc, c: acc + c["n"] * F.pow(c["mean"] - F.col("grand"), 2))
    stats = sums.withColumn("between", between)
    f = F.when(F.col("within") > 0, (F.col("between") / (F.col("k") - 1)) / (
        F.col("within") / (F.col("n_total") - F.col("k")))).when(
        F.col("between") > 0, F.lit(float("inf")))
    varies = (F.col("k") > 1) & (F.col("n_total") > F.col("k"))
    return stats.select(*keys, F.when(varies, f).alias("f_raw"), (F.col("k") - 1).cast("double").alias("df_between"),
                        (F.col("n_total") - F.col("k")).cast("double").alias("df_within"))


def numeric_class_moments(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(expanded_feature, variable, class, n, mean, var) from one wide aggregate."""
    wide = df.groupBy(target).agg(F.count(F.lit(1)).alias("_n"), *[
        f(F.col(c).cast("double")).alias(f"{p}_{i}") for i, c in enumerate(cols)
        for p, f in (("mean", F.avg), ("var", F.var_pop))])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"mean_{i}").alias("mean"),
                              F.col(f"var_{i}").alias("var")) for i, c in enumerate(cols)])
    return wide.select(F.col(target).alias("class"), F.col("_n").alias("n"), F.explode(rows).alias("_r")).select(
        F.col("_r.variable").alias("expanded_feature"), F.col("_r.variable").alias("variable"),
        F.lit("numeric").alias("expansion"), "class", "n", "_r.mean", "_r.var")


def joint_counts(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(variable, level, class, n): the joint distribution of each column and the
    target."""
    return long_text(df, cols, [target]).groupBy(
        "variable", F.coalesce("value", F.lit(NULL_LEVEL)).alias("level"), F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n"))


def _class_totals(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n_class"))


def dummy_class_moments(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Moments of every 0/1 dummy from the joint counts: a dummy that is set in
    k of n rows has mean k/n and variance k/n·(1-k/n)."""
    counts = joint_counts(df, cols, target)
    classes = small_side(_class_totals(df, target))
    per_level = counts.groupBy("variable", "level").agg(
        F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("_by"))
    grid = F.explode(F.transform(F.col("_all"), lambda c: F.struct(
        c["class"].alias("class"), c["n_class"].alias("n"),
        F.coalesce(F.try_element_at(F.col("_by"), c["class"]), F.lit(0)).alias("hits"))))
    every = classes.agg(F.collect_list(F.struct("class", "n_class")).alias("_all"))  # one entry per class
    share = F.col("_g.hits") / F.col("_g.n")
    return attach_scalars(per_level, every).select("variable", "level", grid.alias("_g")).select(
        F.concat_ws("__", "variable", "level").alias("expanded_feature"), "variable",
        F.lit("dummy").alias("expansion"), F.col("_g.class").alias("class"), F.col("_g.n").alias("n"),
        share.alias("mean"), (share * (1 - share)).alias("var"))


def ordinal_class_moments(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Moments of the ordinal codes, computed from the joint counts."""
    counts = joint_counts(df, cols, target).join(level_codes(df, cols), ["variable", "level"])
    per_code = counts.groupBy("variable", "class", F.col("code").cast("double").alias("code")).agg(F.sum("n").alias("n"))
    sums = per_code.groupBy("variable", "class").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("code")) / F.sum("n")).alias("mean"))
    # squares around the class mean, not a difference of large squares
    around = join_keys(per_code, sums.select("variable", "class", "mean", F.col("n").alias("_all")), ["variable", "class"], "inner")
    spread = around.groupBy("variable", "class").agg(
        F.max("_all").alias("n"), F.max("mean").alias("mean"),
        (F.sum(F.col("n") * F.pow(F.col("code") - F.col("mean"), 2)) / F.max("_all")).alias("var"))
    return spread.select(F.col("variable").alias("expanded_feature"), "variable", F.lit("ordinal").alias("expansion"),
                         "class", "n", "mean", "var")


def anova_f(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
            encode: str = "dummy", p_values: bool = True) -> DataFrame:
    """One-way ANOVA F per expanded feature; a constant feature scores 0 and has
    no p-value. Missing numbers take the median, missing categories are a level."""
    base = df.filter(F.col(target).isNotNull())
    parts = []
    if numeric:
        parts.append(numeric_class_moments(median_fill(base, numeric), numeric, target))
    if categorical:
        build = dummy_class_moments if encode == "dummy" else ordinal_class_moments
        parts.append(build(base, categorical, target))
    moments = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    scored = _f_from_moments(moments, ["expanded_feature", "variable", "expansion"])
    out = scored.withColumn("f_score", F.coalesce("f_raw", F.lit(0.0)))
    keep = ["expanded_feature", "variable", "expansion", "f_score"]
    if not p_values:
        return out.select(*keep)
    return out.withColumn("p_value", f_survival("f_raw", "df_between", "df_within")).select(
        *keep, "p_value", F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant_5pct"))


def _gamma_step(a: float, b: float) -> float:
    """log Γ(a + b) - log Γ(a), without the difference of two large numbers."""
    if a < 20:
        return math.lgamma(a + b) - math.lgamma(a)
    late = lambda z: (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z
    return (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + late(a + b) - late(a)


def _beta_fraction(a: float, b: float, x: float, lead: float) -> float:
    """Continued fraction of the incomplete beta function, for a lead
    a·(1 - x) - b·x that is not negative; runs until it stands still."""
    tiny = 1e-300
    h = a * (lead + 1) / (a + 1)
    c, d = h, 0.0
    for m in count(1):
        top = ((a + m - 1) / (a + 2 * m - 1)) * ((a + b + m - 1) / (a + 2 * m - 1)) * m * (b - m) * x * x
        low = m + m * (b - m) * x / (a + 2 * m - 1) + (a + m) / (a + 2 * m + 1) * (lead + 1 + m * (2 - x))
        d, c = low + top * d, low + top / c
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = c if abs(c) > tiny else tiny
        h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return h


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f) for d1 and d2 degrees of freedom."""
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    a, b, ratio = d2 / 2.0, d1 / 2.0, d1 * f / d2
    x, y = 1 / (1 + ratio), ratio / (1 + ratio)
    lead = b * (f - 1) * x  # a·y - b·x
    front = _gamma_step(max(a, b), min(a, b)) - math.lgamma(min(a, b)) - a * math.log1p(ratio) + b * math.log(y)
    if lead >= 0:
        return math.exp(front) / _beta_fraction(a, b, x, lead)
    return 1.0 - math.exp(front) / _beta_fraction(b, a, y, -lead)


@F.pandas_udf(DoubleType())
def f_survival(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Tail probability of the F distribution; one row per feature passes here."""
    for f, d1, d2 in batches:
        values = [f_tail(x, a, b) if not math.isnan(x) else np.nan for x, a, b in zip(f.astype(float), d1, d2)]
        yield pd.Series(values, dtype="float64").astype(object).where(lambda s: s.notna(), None)


def aggregate_scores(scores: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Expanded features rolled up to their variable, with rank by highest F."""
    out = scores.groupBy("variable").agg(
        F.count(F.lit(1)).alias("expanded_features"), F.max("f_score").alias("f_score_max"),
        F.avg("f_score").alias("f_score_mean"), F.min("p_value").alias("p_value_min"),
        F.max("significant_5pct").alias("significant_5pct"),
        F.count_if(F.col("f_score") == 0).alias("constant_expanded_features"))
    ranked = rank_min(out, "f_score_max", "rank_f_score")
    if dictionary is not None:
        ranked = ranked.join(dictionary, "variable", "left")
    return ranked


def select_k_best(df: DataFrame, ranking: DataFrame, k: int | None, keep: Sequence[str]) -> DataFrame:
    """Keys, weight and target next to the k best variables, or next to all
    significant ones when ``k`` is None."""
    order = [F.desc("f_score_max"), F.asc_nulls_last("p_value_min"), "variable"]
    rows = ranking.filter("significant_5pct").orderBy(*order) if k is None else ranking.orderBy(*order).limit(k)
    return select_existing(df, [*keep, *[r["variable"] for r in rows.collect()]])  # names only


# ---------------------------------------------------------------- mutual information

def mutual_info(df: DataFrame, discrete: Sequence[str], continuous: Sequence[str], target: str,
                bins: int = 10) -> DataFrame:
    """Mutual information (nats) with the target: exact for discrete columns, over
    equal-frequency bins for continuous ones (:func:`neighbour_information` needs none)."""
    base = df.filter(F.col(target).isNotNull())
    parts = [joint_counts(base, discrete, target)] if discrete else []
    if continuous:
        long = long_numeric(median_fill(base, continuous), continuous, [target])
        probs = {f"q{i}": i / bins for i in range(1, bins)}
        edges = exact_quantiles(long, ["variable"], "value", probs)
        listed = small_side(edges.select("variable", F.array(*probs).alias("_edges")))
        number = F.size(F.filter("_edges", lambda e: e < F.col("value")))
        parts.append(long.join(listed, "variable").groupBy(
            "variable", number.cast("string").alias("level"), F.col(target).alias("class")).agg(
            F.count(F.lit(1)).alias("n")))
    joint = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Σ n·ln(n·N / (n_level·n_class)) / N = (Σ n ln n − Σ n_level ln n_level − Σ n_class ln n_class + N ln N) / N
    def xlogx(c: str) -> Column:
        return F.col(c) * F.log(F.col(c).cast("double"))

    # the joint counts are read once: sums by level, by class and over all are grouping sets of one exchange
    sums = joint.groupingSets([["variable", "level"], ["variable", "class"], ["variable"]], "variable", "level", "class").agg(
        F.sum("n").alias("m"), F.sum(xlogx("n")).alias("a"), F.grouping("level").alias("no_level"), F.grouping("class").alias("no_class"))
    whole = (F.col("no_level") == 1) & (F.col("no_class") == 1)
    found = sums.groupBy("variable").agg(
        F.max(F.when(whole, F.col("a"))).alias("a"), F.max(F.when(whole, F.col("m"))).alias("total"),
        F.sum(F.when(~whole, xlogx("m"))).alias("b"))
    return found.select("variable", F.greatest(F.lit(0.0), (F.col("a") - F.col("b") + xlogx("total")) / F.col("total")).alias("mutual_info"))


def digamma(n: Column) -> Column:
    """Digamma of a positive number: six steps up, then the asymptotic series."""
    n = n.cast("double")
    z = n + 6
    late = (F.log(z) - 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4) - 1 / (252 * z ** 6) + 1 / (240 * z ** 8)
            - 1 / (132 * z ** 10))
    for step in range(6):
        late = late - 1 / (n + step)
    return late


def neighbour_information(df: DataFrame, continuous: Sequence[str], target: str, k: int = 3) -> DataFrame:
    """Mutual information (nats) of continuous columns with a class target from nearest
    neighbours: for each row the distance to the k-th nearest value of its own class, and
    the number of rows of any class that are closer; then a mean of digammas.

    Everything runs in range slots. The k nearest of a sorted value are among the k on
    either side, so a slot only needs the k values next to it from the neighbouring slots;
    and the rows closer than a distance are the difference of two places in the order of
    all values, found by sorting the two ends of each row's interval among the values.
    Missing values take the median; a class of one row is left out. A row with k copies in
    its class is at distance 0: all its copies there are its neighbours, and the copies in
    any class are counted, so that ties need no noise."""
    base = df.filter(F.col(target).isNotNull())
    long = long_numeric(median_fill(base, continuous), continuous, [target]).select(
        "variable", F.col(target).alias("class"), F.col("value").cast("double").alias("x"))
    sizes = small_side(long.groupBy("variable", "class").agg(F.count(F.lit(1)).alias("size")))
    rows = join_keys(long, sizes, ["variable", "class"], "inner").filter(F.col("size") > 1)
    group = ["variable", "class"]
    dealt = slotted(rows, group, [F.col("x").asc()]).withColumn("_id", F.monotonically_increasing_id())
    inside = Window.partitionBy("_key").orderBy("x", "_id")
    placed = dealt.withColumns({
        "_near": F.array(*[f("x", j).over(inside) for j in range(1, k + 1) for f in (F.lag, F.lead)]),
        "_place": F.row_number().over(inside), "_rows": F.count(F.lit(1)).over(Window.partitionBy("_key"))})
    # the k values at either end of a slot, and from them those next to every slot
    ends = placed.filter((F.col("_place") <= k) | (F.col("_place") > F.col("_rows") - k)).groupBy("_key").agg(
        F.collect_list(F.when(F.col("_place") <= k, F.col("x"))).alias("_head"),
        F.collect_list(F.when(F.col("_place") > F.col("_rows") - k, F.col("x"))).alias("_tail"))
    slots = Window.partitionBy("_key.variable", "_key.class").orderBy("_key._slot")
    halo = ends.select("_key", F.concat(F.flatten(F.collect_list("_tail").over(slots.rowsBetween(-k, -1))),
                                        F.flatten(F.collect_list("_head").over(slots.rowsBetween(1, k)))).alias("_halo"))
    gaps = F.array_sort(F.transform(F.filter(F.concat("_near", "_halo"), lambda v: v.isNotNull()), lambda v: F.abs(v - F.col("x"))))
    kth = F.least(F.lit(k), F.col("size") - 1).cast("int")
    copies = rows.groupBy(*group, "x").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    found = placed.join(halo, "_key").select(*group, "x", "size", "_id", kth.alias("k"), F.element_at(gaps, kth).alias("r"))
    own = F.when(F.col("r") == 0, F.col("copies")).otherwise(F.col("k"))
    reached = cut_lineage(join_keys(found, copies, [*group, "x"], "left").select("variable", "x", "size", "_id", own.alias("k"), "r"))
    # 1: a value, 0 and 2: the ends of an interval just before or after the values that are equal to it
    point = F.col("r") == 0
    events = F.array(F.struct(F.col("x").alias("t"), F.lit(1).alias("o"), F.lit(0).alias("sign")),
                     F.struct((F.col("x") - F.col("r")).alias("t"), F.when(point, 0).otherwise(2).alias("o"), F.lit(-1).alias("sign")),
                     F.struct((F.col("x") + F.col("r")).alias("t"), F.when(point, 2).otherwise(0).alias("o"), F.lit(1).alias("sign")))
    spread = reached.select("variable", "_id", F.explode(events).alias("_e")).select("variable", "_id", "_e.*")
    sorted_in = slotted(spread, ["variable"], [F.col("t"), F.col("o"), F.col("_id")])
    starts = slot_starts(sorted_in.groupBy("_key").agg(F.count_if(F.col("o") == 1).alias("n")), ["variable"], ["n"]).drop("n")
    upto = Window.partitionBy("_key").orderBy("t", "o", "_id").rowsBetween(Window.unboundedPreceding, 0)
    below = sorted_in.withColumn("_below", F.sum(F.when(F.col("o") == 1, 1).otherwise(0)).over(upto)).join(starts, "_key")
    closer = below.filter("sign <> 0").groupBy("variable", "_id").agg(
        F.sum(F.col("sign") * (F.col("_below") + F.col("_start_n"))).alias("m"))
    both = reached.join(closer, ["variable", "_id"])
    mean = both.groupBy("variable").agg(F.avg(digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m"))).alias("_mean"),
                                        F.count(F.lit(1)).alias("_n"))
    return mean.select("variable", F.greatest(F.lit(0.0), digamma(F.col("_n")) + F.col("_mean")).alias("mutual_info"))


def available_specs(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Candidate rows whose column exists, each variable once, with missing percent."""
    from .ordered import first_per_group

    rest = [c for c in specs.columns if c != "variable"]
    return first_per_group(specs, ["variable"], rest).join(null_percent(df), "variable")
