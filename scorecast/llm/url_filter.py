"""URL filter: host and path rules, then a character language-model ratio.

Rules (allow or block a host with its subdomains under a path prefix) decide
the urls they fit, the longest rule wins. All other urls are judged by two
smoothed variable-order Markov models of characters, one of accepted and one
of rejected urls (those that the rules allow or block). A model interpolates
the orders 0 to ``ORDER`` by Witten-Bell smoothing. The score of a url is the
log-likelihood difference (rejected minus accepted) per character. It is
calibrated by a logistic curve, fitted to a histogram of fixed bins; urls with a
probability of rejection of at least ``block_at`` are blocked. The calibration is
cross-fitted: the labelled urls of each fold are scored by models of the other
folds. The final models count all labelled rows and read whole urls as given.

Everything the models know are counts of character n-grams over all labelled
urls, kept as distributed tables: a url is the sum of the log ratios of its
n-grams, so the ratios (of the final models and of those without a fold) are
computed once per distinct n-gram and joined back.

Defined results
  * null url or no ``://``: host and path are empty and no rule fits; the empty
    string is scored like any other;
  * no accepted or no rejected urls: there is no ratio, what no rule decides is
    allowed;
  * null ids and repeated rows: one result row per input row; an empty table
    gives an empty result.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecast.llm.common import free_name, written

ORDER = 5
START, END = "\x02", "\x03"
ALPHABET = 1 << 16  # uniform base of the interpolation
FOLDS = 5           # folds of the labelled urls, for the calibration
FINAL = -1          # the model that leaves out no fold
BINS, BIN = 800, 0.01


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://``."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(verdict, rule) of the longest fitting rule, else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def _windows(text: Column) -> Column:
    """One (ORDER + 1)-gram per character, the end mark included."""
    framed = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substr(framed, i, F.lit(ORDER + 1)))


def log_ratios(grams: DataFrame, models: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(gram, one column per model): log P(last char | rejected) - log P(... | accepted).

    ``grams``: one row per distinct full window and, per model, a column of
    accepted and one of rejected counts (by default ``ratio`` from ``accepted``
    and ``rejected``); counts are 0 for windows of unlabelled urls only. The
    counts of the shorter grams are sums over the full windows that end with
    them. The orders are interpolated from the shortest upwards: a gram meets
    its context in a window of at most as many rows as there are characters,
    and its probability of the next lower order by one join.
    """
    models = models or {"ratio": ("accepted", "rejected")}
    counts = [c for pair in models.values() for c in pair]
    width = ORDER + 1
    shorter = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda n: F.substr(F.col("gram"), width - n + 1, n))
    by_gram = written(grams.select(F.explode(shorter).alias("g"), *counts)
                      .groupBy("g").agg(*[F.sum(c).alias(c) for c in counts]), "url-grams")
    lower = None
    for n in range(1, width + 1):
        context = Window.partitionBy(F.substr("g", F.lit(1), F.lit(n - 1)))
        level = by_gram.filter(F.length("g") == n).select("g", *counts, *[
            F.sum(x).over(context).alias(f"{k}_{c}") for c in counts
            for k, x in (("n", F.col(c)), ("t", (F.col(c) > 0).cast("long")))])
        if lower is not None:
            level = level.join(lower, F.substr("g", F.lit(2), F.lit(n - 1)) == F.col("shorter"))
        lower = level.select(F.col("g").alias("shorter"), *[_smoothed(c, lower is None).alias(f"p_{c}") for c in counts])
    return lower.select(F.col("shorter").alias("gram"), *[
        (F.log(f"p_{r}") - F.log(f"p_{a}")).alias(m) for m, (a, r) in models.items()])


def _smoothed(c: str, lowest: bool) -> Column:
    """Witten-Bell: the count and the lower order's share, where the context
    (``n_`` occurrences, ``t_`` kinds) was seen; else the lower order."""
    below = F.lit(1.0 / ALPHABET) if lowest else F.col(f"p_{c}")
    n, kinds = F.col(f"n_{c}"), F.col(f"t_{c}")
    return F.when(n > 0, (F.col(c) + kinds * below) / (n + kinds)).otherwise(below)


def _logistic(hist: list[tuple[float, float, float]]) -> tuple[float, float]:
    """(slope, shift) of P(rejected | score) on (score, accepted, rejected) bins."""
    x, a, r = (np.array(v, dtype=float) for v in zip(*hist))
    goal_hi, goal_lo = (r.sum() + 1) / (r.sum() + 2), 1 / (a.sum() + 2)
    s, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(s * x + b, -30, 30)))
        d = r * (p - goal_hi) + a * (p - goal_lo)
        w = (a + r) * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, np.array([(d * x).sum() + 1e-3 * s, d.sum()]))
        step = np.clip(step, -5, 5)
        s, b = s - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(s), 1e-3), float(b)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", *,
                block_at: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block), ``llr`` (the
    length-normalised log-likelihood difference, null where there is no ratio)
    and ``p_block``. Input columns of these names are replaced, except the id
    and the url."""
    added = ["host", "path", "rule", "verdict", "llr", "p_block"]
    keep = [c for c in pages.columns if c.lower() not in added or c in (id_col, url_col)]
    hit, key = free_name(pages.columns, "uf_hit"), free_name(pages.columns, "uf_key")
    base = pages.select(*keep).withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    base = base.withColumn(hit, rule_column(F.col("host"), F.col("path"), rules))
    base = base.withColumn(key, F.coalesce(F.col(url_col), F.lit("")))
    label = F.col(f"{hit}.verdict")
    # repeated urls are counted once per row, but scored once
    urls = written(base.groupBy(F.col(key).alias("u")).agg(
        F.sum((label == "allow").cast("long")).alias("accepted"),
        F.sum((label == "block").cast("long")).alias("rejected"))
        .withColumn("fold", F.pmod(F.xxhash64("u"), F.lit(FOLDS)).cast("int")).fillna(0), "urls")
    seen = {r["fold"]: (r["a"], r["r"]) for r in urls.groupBy("fold").agg(
        F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).collect()}  # at most FOLDS rows
    n_accepted, n_rejected = sum(a for a, _ in seen.values()), sum(r for _, r in seen.values())
    if not n_accepted or not n_rejected:
        return base.select(*keep, "host", "path", F.col(f"{hit}.rule").alias("rule"),
                           F.coalesce(label, F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("llr"), F.lit(None).cast("double").alias("p_block"))
    # a fold that holds a whole class has no models of the others
    usable = [f for f, (a, r) in seen.items() if a < n_accepted and r < n_rejected]
    windows = urls.select("u", "accepted", "rejected", "fold", F.explode(_windows(F.col("u"))).alias("gram"))
    # one row per gram with the counts of every model: all rows, and those outside a fold
    models = {FINAL: (F.col("accepted"), F.col("rejected"))}
    models |= {f: tuple(F.when(F.col("fold") != f, F.col(c)).otherwise(0) for c in ("accepted", "rejected")) for f in sorted(usable)}
    names = {f"ratio_{m + 1}": (f"a_{m + 1}", f"r_{m + 1}") for m in models}
    sums = [F.sum(x).alias(c) for pair, cols in zip(names.values(), models.values()) for c, x in zip(pair, cols)]
    grams = written(windows.groupBy("gram").agg(*sums), "url-windows")
    ratios = written(log_ratios(grams, names), "url-ratios")
    own = F.lit(None).cast("double")
    for f in usable:
        own = F.when(F.col("fold") == f, F.col(f"ratio_{f + 1}")).otherwise(own)
    scored = written(windows.join(ratios, "gram").groupBy("u").agg(
        F.avg(f"ratio_{FINAL + 1}").alias("llr"), F.avg(own).alias("cross"),
        F.first("accepted").alias("accepted"), F.first("rejected").alias("rejected")), "url-scores")
    crossed = scored.filter(F.col("accepted") + F.col("rejected") > 0).filter("cross IS NOT NULL").withColumn("llr", F.col("cross"))
    slope, shift = _calibration(crossed, scored)
    z = F.col("llr") * slope + shift
    ready = scored.select(F.col("u").alias(f"{key}r"), "llr", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("p_block"))
    out = base.join(ready, F.col(key) == F.col(f"{key}r"), "left")
    verdict = F.coalesce(F.col(f"{hit}.verdict"), F.when(F.col("p_block") >= block_at, "block").otherwise("allow"))
    return out.select(*keep, "host", "path", F.col(f"{hit}.rule").alias("rule"), verdict.alias("verdict"), "llr", "p_block")


def _calibration(crossed: DataFrame, scored: DataFrame) -> tuple[float, float]:
    """From the cross-fitted scores (the final ones if those lack a class)."""
    at = F.least(F.greatest(F.round(F.col("llr") / BIN), F.lit(-BINS)), F.lit(BINS))
    for rows in (crossed, scored):
        hist = (rows.groupBy(at.alias("b")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
                .collect())  # at most 2 * BINS + 1 rows
        if sum(h["a"] for h in hist) and sum(h["r"] for h in hist):
            return _logistic([(h["b"] * BIN, h["a"], h["r"]) for h in hist])
    return 1.0, 0.0
