"""URL filter: rule lists first, else a character language-model ratio.

Two smoothed variable-order Markov models, one of accepted and one of rejected
URLs, give each character a probability after its up to ``order`` preceding
characters. Orders are interpolated from the uniform distribution upwards
(Witten-Bell: a context seen ``N`` times with ``T`` different successors passes
``T / (N + T)`` of its weight down to the next shorter context). A URL's score
is the log-likelihood difference per character; the threshold is calibrated on
labelled URLs that the models have not seen.

Everything is DataFrame code. Model tables hold one row per distinct context
and character; URLs meet them in equality joins that adaptive execution can
split, so a character sequence that every URL contains is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import lower_ascii, pick
from candlewick.session import cut_lineage

#: The contract's rules: (rule, verdict); host up to the first '/', path from there.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
ORDER = 3
START, END = "\x02", "\x03"
GRID = 64  # calibration thresholds are multiples of 1/64 nat
FOLDS = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # a longer rule overrides
        cut = text.index("/")
        h, p = text[:cut], text[cut:]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def occurrences(urls: DataFrame, order: int) -> DataFrame:
    """``urls`` has ``s``: one row per character (and one for the end) with its
    context, the ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), F.col("s"), F.lit(END))
    grams = F.transform(
        F.sequence(F.lit(1), F.size("chars") - order),
        lambda i: F.struct(
            F.array_join(F.slice("chars", i, order), "").alias("ctx"), F.element_at("chars", i + order).alias("ch")
        ),
    )
    keep = [c for c in urls.columns if c != "s"]
    return (
        urls.withColumn("chars", F.split(padded, ""))
        .select(*keep, F.explode(grams).alias("g"))
        .select(*keep, "g.ctx", "g.ch")
    )


def ratio_model(grams: DataFrame, order: int) -> DataFrame:
    """``grams``: ``ctx, ch, n_allow, n_block`` (zero counts included). Returns
    ``ctx, ch, llr``: the log ratio of the two models' probabilities."""
    letters = Window.partitionBy()
    below = None
    for k in range(order + 1):
        ctx = F.col("ctx") if k == order else F.expr(f"right(ctx, {k})") if k else F.lit("")
        level = grams.groupBy(ctx.alias("ctx"), "ch").agg(
            F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block")
        )
        if k == 0:  # the alphabet: one row per character
            level = level.withColumn("alphabet", F.count(F.lit(1)).over(letters))
            level = level.withColumn("low_allow", 1 / F.col("alphabet")).withColumn("low_block", 1 / F.col("alphabet"))
        else:
            short = F.expr(f"right(ctx, {k - 1})") if k > 1 else F.lit("")
            level = level.withColumn("short", short).join(
                below.select(
                    F.col("ctx").alias("short"), "ch", F.col("p_allow").alias("low_allow"), F.col("p_block").alias("low_block")
                ),
                ["short", "ch"],
            )
        here = Window.partitionBy("ctx")
        for c in ("allow", "block"):
            n = F.sum(f"n_{c}").over(here)
            t = F.count_if(F.col(f"n_{c}") > 0).over(here)
            p = (F.col(f"n_{c}") + t * F.col(f"low_{c}")) / (n + t)
            level = level.withColumn(f"p_{c}", F.when(n > 0, p).otherwise(F.col(f"low_{c}")))
        below = level.select("ctx", "ch", "p_allow", "p_block")
    return below.select("ctx", "ch", (F.ln("p_allow") - F.ln("p_block")).alias("llr"))


def calibrate(scored: DataFrame, grid: int = GRID) -> DataFrame:
    """One row, ``threshold``: between the two steps of a 1/``grid`` histogram
    of scores where the balanced accuracy on the labelled, unseen URLs
    (``label, score``) is best, midway across the gap; the lowest such place on
    a tie, 0 without both labels."""
    hist = scored.groupBy(F.floor(F.col("score") * grid).alias("b")).agg(
        F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("r")
    )
    under = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    all_a, all_r = (F.nullif(F.sum(c).over(everything), F.lit(0)) for c in ("a", "r"))
    gain = (all_a - F.coalesce(F.sum("a").over(under), F.lit(0))) / all_a + F.coalesce(F.sum("r").over(under), F.lit(0)) / all_r
    edge = (F.coalesce(F.lag("b").over(Window.orderBy("b")) + 1, F.col("b")) + F.col("b")) / 2
    best = hist.withColumn("gain", gain).withColumn("edge", edge).where("gain IS NOT NULL")
    best = best.agg(F.min(F.struct((-F.col("gain")).alias("g"), "b", "edge")).alias("m"))
    return best.select(F.coalesce(F.col("m.edge") / grid, F.lit(0.0)).alias("threshold"))


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER, folds: int = FOLDS
) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict, score``.

    URLs that a rule decides train the models (allowed: accepted, blocked:
    rejected) but for one fold of them, by md5 of the URL, which calibrates the threshold.
    URLs without a rule are allowed if their score reaches it. A null or empty
    URL, or one without ``://``, has empty host and path and score
    0.  Without any rejected (or accepted) example the models say nothing: the
    ratio is then one-sided, the threshold 0. Repeated rows are judged once
    and returned as often as they came; an empty table gives an empty result.
    A very long URL is one text of as many characters; of scores equal to the
    threshold all are allowed; extra columns are ignored, whatever their names.
    """
    base = pick(pages, id_col, url_col).toDF("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    host, path = host_and_path(F.col("url"))
    base = base.select("page_id", "url", "copies", host.alias("host"), path.alias("path"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.conv(F.substring(F.md5(F.col("url")), 1, 8), 16, 10).cast("long"), F.lit(folds))
    base = cut_lineage(
        base.select(
            "*", rule.alias("rule"), says.alias("says"), fold.alias("fold"), F.concat("host", "path").alias("s")
        ),
        "urls",
    )
    train = F.col("fold") != 0
    by_text = base.groupBy("s").agg(
        F.sum(F.when(train & (F.col("says") == "allow"), F.col("copies")).otherwise(0)).alias("w_allow"),
        F.sum(F.when(train & (F.col("says") == "block"), F.col("copies")).otherwise(0)).alias("w_block"),
    )
    grams = occurrences(by_text, order).groupBy("ctx", "ch").agg(
        F.sum("w_allow").alias("n_allow"), F.sum("w_block").alias("n_block")
    )
    model = cut_lineage(ratio_model(cut_lineage(grams, "url-grams"), order), "url-model")
    scores = (
        occurrences(by_text.select("s", F.col("s").alias("key")), order)
        .join(model, ["ctx", "ch"])
        .groupBy("key")
        .agg((F.round(F.sum("llr") / F.count(F.lit(1)), 6) + F.lit(0.0)).alias("score"))
    )
    scored = cut_lineage(
        base.join(scores, base["s"] == scores["key"]).withColumn("score", F.when(F.col("s") == "", 0.0).otherwise(F.col("score"))),
        "url-scores",
    )
    bar = calibrate(scored.where((F.col("fold") == 0) & F.col("says").isNotNull()).select(F.col("says").alias("label"), "score"))
    method = F.when(F.col("score") >= bar.scalar(), "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("says", method)).select(
        "page_id", "host", "path", "rule", "verdict", "score", "copies"
    ).withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_c", "copies")
