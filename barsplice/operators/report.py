"""Report tables: replicates side by side, set overlaps, summaries, correlations, positions."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def junctions_category(junctions: DataFrame, replicates: Sequence[str], least: int = 2) -> DataFrame:
    """Junctions by replicate with their mean coverage, kept if seen in at least ``least`` replicates."""
    cover = lambda r: F.sum(F.when(F.col("rep") == r, F.col("coverage"))).alias(f"cov_{r}")
    rows = junctions.groupBy(F.col("chrom").alias("var_id"), "donor", "acceptor", "annotation").agg(*map(cover, replicates))
    there = sum(F.col(f"cov_{r}").isNotNull().cast("int") for r in replicates)
    mean = sum(F.coalesce(F.col(f"cov_{r}"), F.lit(0)) for r in replicates) / there
    return rows.where(there >= least).withColumn("avg_cov", mean)


def venn(members: DataFrame, key: Sequence[str], set_col: str, sets: Sequence[str]) -> DataFrame:
    """``(region, n)``: how many keys lie in exactly each combination of sets, named ``a&b``."""
    bits = [F.max(F.when(F.col(set_col) == s, 1).otherwise(0)).alias(f"in_{i}") for i, s in enumerate(sets)]
    masks = members.where(F.col(set_col).isin(*sets)).groupBy(*key).agg(*bits)
    region = F.concat_ws("&", *(F.when(F.col(f"in_{i}") == 1, s) for i, s in enumerate(sets)))
    return masks.groupBy(region.alias("region")).agg(F.count(F.lit(1)).alias("n"))


def event_summary(category: DataFrame) -> DataFrame:
    """Per label: variants, junctions and quartiles of log10 coverage."""
    rows = category.withColumn("label", F.explode(F.split("annotation", ";"))).withColumn("log_cov", F.log10(F.col("avg_cov") + 1))
    quarter = lambda p: F.percentile("log_cov", p)
    return rows.groupBy("label").agg(
        F.countDistinct("var_id").alias("n_variants"), F.count(F.lit(1)).alias("n_junctions"),
        quarter(0.25).alias("q1"), quarter(0.5).alias("q2"), quarter(0.75).alias("q3"),
    )


def upset_matrix(category: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per variant: 1 for each label it shows, and the log2 of its summed coverage."""
    rows = category.withColumn("label", F.explode(F.split("annotation", ";")))
    shown = [F.max(F.when(F.col("label") == v, 1).otherwise(0)).alias(v) for v in labels]
    flags = rows.groupBy("var_id").agg(*shown)
    total = category.groupBy("var_id").agg(F.log2(F.sum("avg_cov") + 1).alias("log_cov"))
    return flags.join(total, "var_id")


def barcode_summary(known: DataFrame, detected: DataFrame) -> DataFrame:
    """Per variant: expected barcodes (rows), recovered ones (distinct), their share and mean count."""
    expected = known.where("var_id <> 'NA'").groupBy("var_id").agg(F.count(F.lit(1)).alias("expected"))
    by_barcode = detected.where("var_id <> 'NA'").groupBy("var_id", "barcode").agg(F.sum("count").alias("count"))
    got = by_barcode.groupBy("var_id").agg(F.count(F.lit(1)).alias("recovered"), F.avg("count").alias("mean_count"))
    joined = expected.join(got, "var_id", "left").fillna(0, ["recovered"])
    return joined.withColumn("pct", F.round(100 * F.col("recovered") / F.col("expected"), 2))


def read_percentages(summary: DataFrame, total: str, parts: Sequence[str], key: str) -> DataFrame:
    """Long table of percentages of ``total``, two decimals; null without reads."""
    pct = [F.round(100 * F.try_divide(F.col(p).cast("double"), F.col(total).cast("double")), 2).alias(p) for p in parts]
    return summary.select(key, *pct).unpivot([key], list(parts), "part", "pct")


def log_cpm(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """log2 of counts per million of each column, plus 1; the totals are one broadcast row."""
    totals = counts.agg(*(F.sum(c).cast("double").alias(f"__{c}") for c in columns))
    scaled = [F.log2(F.try_divide(F.col(c).cast("double"), F.col(f"__{c}")) * 1e6 + 1).alias(c) for c in columns]
    rest = [c for c in counts.columns if c not in columns]
    return counts.crossJoin(F.broadcast(totals)).select(*rest, *scaled)


def correlations(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, signed, r)``: Pearson correlation of each pair over complete rows and its absolute value."""
    pairs = list(itertools.combinations(columns, 2))
    one = table.agg(*(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("signed")) for i, (a, b) in enumerate(pairs))))
    return one.select(rows.alias("x")).select("x.*", F.abs("x.signed").alias("r"))


RANGES = (("[1,10)", 1, 10), ("[10,100)", 10, 100), ("[100,1000)", 100, 1000), ("[1000,10000)", 1000, 10000), ("[10000,inf)", 10000, None))


def coverage_ranges(rows: DataFrame, column: str = "avg_cov") -> DataFrame:
    """``(range, n, total)`` for all rows and each coverage range that has any."""
    c = F.col(column)
    named = F.array(F.lit("all"), *(F.when((c >= lo) & ((c < hi) if hi else F.lit(True)), name) for name, lo, hi in RANGES))
    spread = rows.select(column, F.explode(F.filter(named, lambda x: x.isNotNull())).alias("range"))
    return spread.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("total"))


def complete_samples(sheet: DataFrame, replicates: int = 3) -> DataFrame:
    """Rows of samples with exactly so many replicates."""
    return sheet.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("sample"))).where(F.col("__n") == replicates).drop("__n")


def segments(exons: DataFrame) -> DataFrame:
    """Exons and the introns between them as numbered segments of each variant: ``var_id, segment, start, end``."""
    order = Window.partitionBy("var_id").orderBy("exon_start")
    rows = exons.withColumn("no", F.row_number().over(order)).withColumn("before", F.lag("exon_end").over(order))
    exon = F.struct(F.concat(F.lit("E"), "no").alias("segment"), F.col("exon_start").alias("start"), F.col("exon_end").alias("end"))
    intron = F.struct(F.concat(F.lit("I"), F.col("no") - 1).alias("segment"), (F.col("before") + 1).alias("start"), (F.col("exon_start") - 1).alias("end"))
    both = F.filter(F.array(exon, F.when(F.col("before").isNotNull(), intron)), lambda s: s.isNotNull())
    return rows.select("var_id", F.explode(both).alias("s")).select("var_id", "s.*")


def rescale(junctions: DataFrame, targets: DataFrame, template: DataFrame) -> DataFrame:
    """Donors and acceptors moved linearly from a variant's segments into those of a template; outside of all: null."""
    shape = template.select("segment", F.col("start").alias("t0"), F.col("end").alias("t1"))
    placed = targets.join(F.broadcast(shape), "segment", "left")
    joined = junctions.join(placed, "var_id")
    moved = lambda c: F.when(
        F.col(c).between(F.col("start"), F.col("end")),
        F.round(F.col("t0") + F.coalesce(F.try_divide((F.col(c) - F.col("start")).cast("double"), (F.col("end") - F.col("start")).cast("double")), F.lit(0.0)) * (F.col("t1") - F.col("t0"))),
    )
    keys = [c for c in junctions.columns]
    return joined.groupBy(*keys).agg(F.min(moved("donor")).cast("bigint").alias("donor_scaled"), F.min(moved("acceptor")).cast("bigint").alias("acceptor_scaled"))


def complete_rows(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null (or NaN) in any of the columns."""
    return table.dropna("any", subset=list(columns))


def any_value(table: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return table.dropna("all")


def of_exon(table: DataFrame, exon: str, whole: bool = False) -> DataFrame:
    """Rows whose ``var_id`` starts with an exon's id; with ``whole`` only if the id ends there, so that e1 is not e10."""
    name = F.col("var_id")
    return table.where((name == exon) | name.startswith(f"{exon}_") if whole else name.startswith(exon))


def exon_ids(exons: DataFrame) -> DataFrame:
    """Distinct first two words of ``var_id``; the common skipping reference has none."""
    return exons.where("var_id <> 'elib'").select(F.substring_index("var_id", "_", 2).alias("exon_id")).distinct()


def within(table: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows whose value lies in a range, bounds included; nulls go if a bound is given."""
    for bound, keep in ((low, F.col(column) >= F.lit(low)), (high, F.col(column) <= F.lit(high))):
        table = table if bound is None else table.where(keep)
    return table


def linear_fit(table: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R squared of ``y`` on ``x`` over rows where neither is zero or null."""
    rows = table.where((F.col(x) != 0) & (F.col(y) != 0))
    return rows.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n")
    )


def local_regression(table: DataFrame, x: str, y: str, by: Sequence[str] = (), span: float = 0.5, degree: int = 2, points: int = 80, bins: int = 4096) -> DataFrame:
    """``(x, fit)`` at evenly spaced places of each group's range: local polynomials with tricube weights.

    Rows where either value is zero or null are left out.  The nearest ``span`` of the rows
    count at each place.  Rows are gathered into moments of equal ``bins`` of the range, so
    that a group is fitted from at most ``bins`` rows however large it is: exact if no bin holds
    two different values, else off by about the square of a bin's share of the range.  A group
    whose values are all the same has one place.
    """
    if not (0 < span <= 1 and degree in (0, 1, 2) and points > 1 and bins > 0):
        raise ValueError("span lies in (0, 1], degree is 0, 1 or 2, and there are at least two points and one bin")
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(by)]
    names = [f"k{i}" for i in range(len(by))]
    rows = table.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where((F.col("x") != 0) & (F.col("y") != 0))
    other = [f"r{i}" for i in range(len(by))]
    ranges = rows.groupBy(*names).agg(F.min("x").alias("low"), F.max("x").alias("high")).withColumnsRenamed(dict(zip(names, other, strict=True)))
    # Without groups the other side is a single row.
    placed = rows.join(ranges, [F.equal_null(F.col(k), F.col(r)) for k, r in zip(names, other, strict=True)]) if by else rows.crossJoin(ranges)
    u = F.when(F.col("high") > F.col("low"), (F.col("x") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    placed = placed.select(*names, "low", "high", "y", u.alias("u"), F.least(F.floor(u * bins), F.lit(bins - 1)).alias("bin"))
    power = lambda k: F.pow("u", F.lit(k)) if k else F.lit(1.0)
    sums = [F.sum(power(k)).alias(f"s{k}") for k in range(2 * degree + 1)] + [F.sum(power(k) * F.col("y")).alias(f"t{k}") for k in range(degree + 1)]
    moments = placed.groupBy(*names, "low", "high", "bin").agg(F.avg("u").alias("u"), *sums)
    types = {f.name: f.dataType.simpleString() for f in moments.schema if f.name in names}

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        low, high = float(group["low"].iloc[0]), float(group["high"].iloc[0])
        at = np.linspace(0, 1, points) if high > low else np.zeros(1)
        values = smooth(at, group["u"].to_numpy(), group[[f"s{k}" for k in range(2 * degree + 1)]].to_numpy(), group[[f"t{k}" for k in range(degree + 1)]].to_numpy(), span)
        return pd.DataFrame({**{c: [group[c].iloc[0]] * len(at) for c in names}, "x": low + at * (high - low), "fit": values})

    shape = ", ".join([*(f"{c} {t}" for c, t in types.items()), "x double", "fit double"])
    fitted = moments.groupBy(*names).applyInPandas(fit, shape)
    return fitted.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(by)), "x", "fit")


def smooth(at: np.ndarray, u: np.ndarray, s: np.ndarray, t: np.ndarray, span: float) -> np.ndarray:
    """Local polynomial fits at places ``at`` from moments of ``u`` (``s``) and of the value (``t``) of bins around ``u``."""
    far = np.abs(u - at[:, None])
    order = np.argsort(far, 1, kind="stable")
    reached = np.cumsum(s[order, 0], 1)
    # Moments are sums of doubles, so the rank is compared with half a row to spare.
    wanted = max(1.0, np.floor(span * s[:, 0].sum() + 1e-5))
    width = np.take_along_axis(far, order, 1)[np.arange(len(at)), (reached > wanted - 0.5).argmax(1)]
    w = np.where(width[:, None] > 0, np.clip(1 - (far / np.where(width > 0, width, 1)[:, None]) ** 3, 0, None) ** 3, far == 0)
    degree = t.shape[1] - 1
    # Shifted to each place, where the polynomial's constant is the fit.
    shifted = lambda m, k: sum(math.comb(k, j) * m[:, j] * (-at[:, None]) ** (k - j) for j in range(k + 1))
    a = np.stack([(w * shifted(s, k)).sum(1) for k in range(2 * degree + 1)], 1)
    b = np.stack([(w * shifted(t, k)).sum(1) for k in range(degree + 1)], 1)
    scale = np.where(width > 0, width, 1)[:, None]
    a, b = a / scale ** np.arange(2 * degree + 1), b / scale ** np.arange(degree + 1)
    normal = a[:, np.add.outer(np.arange(degree + 1), np.arange(degree + 1))]
    return (np.linalg.pinv(normal, rcond=1e-12) @ b[:, :, None])[:, 0, 0]


def histogram(table: DataFrame, column: str, breaks: Sequence[float]) -> DataFrame:
    """``(low, high, n, height)`` of every bin, bounded below but for the first and above, and its share of the fullest; values outside are an error.

    Bins are as many as ``breaks`` say; empty ones have no row.
    """
    edges = [float(b) for b in breaks]
    value = F.col(column).cast("double")
    bins = [((value >= lo if i == 0 else value > lo) & (value <= hi), F.struct(F.lit(lo).alias("low"), F.lit(hi).alias("high"))) for i, (lo, hi) in enumerate(itertools.pairwise(edges))]
    place = F.coalesce(*(F.when(inside, b) for inside, b in bins), F.when(F.raise_error(F.concat(F.lit("outside of all bins: "), value.cast("string"))).isNull(), bins[0][1]))
    counted = table.where(value.isNotNull()).groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("b.*", "n", (F.col("n") / F.max("n").over(Window.partitionBy())).alias("height"))


def natural_key(name: Column) -> Column:
    """Sort key by which r2 comes before r10: runs of digits count as numbers, other runs as text.  For numbers of up to 18 digits."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(parts, lambda p: F.struct((~p.rlike("^\\d")).alias("text"), F.coalesce(p.try_cast("bigint"), F.lit(0)).alias("number"), p.alias("part")))


def sample_replicates(sheet: DataFrame) -> DataFrame:
    """One row per sample with its replicates in natural order."""
    rows = F.sort_array(F.collect_list(F.struct(natural_key(F.col("replicate")).alias("k"), "replicate", "sample_id")))
    return sheet.groupBy("sample").agg(rows.alias("r")).select("sample", F.col("r.replicate").alias("replicates"), F.col("r.sample_id").alias("sample_ids"))


def reference_totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reads on all inclusion and on all skipping references, told by their names."""
    total = lambda word: F.coalesce(F.sum(F.when(F.contains("rname", F.lit(word)), F.col("mapped"))), F.lit(0)).cast("bigint")
    return counts.groupBy(*by).agg(total("_inclusion").alias("inclusion_reads"), total("_skipping").alias("skipping_reads"))


def abbreviate(n: Column) -> Column:
    """1234 as 1.2K and so on to T."""
    steps = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))
    out = n.cast("string")
    for size, letter in reversed(steps):
        out = F.when(F.abs(n) >= size, F.concat(F.round(n / size, 1).cast("string"), F.lit(letter))).otherwise(out)
    return out
