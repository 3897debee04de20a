"""Operator 4: quality rules with adaptive thresholds, in DataFrame functions only.

For each (lang, source) the distribution of each signal is summed up in a mergeable quantile sketch: counts of fixed-width bins
(one per mille for shares, a tenth of a character for word lengths). Bin counts add up, so partial sketches merge map-side in
any order to the same result, and a quantile is off by one bin at most. Fences come from the sketch's quantiles and replace
fixed cutoffs; the documents are joined with their group's fences and filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import cut

_SPACE = " \t\n\x0b\f\r"
_SPACES = "[\\x20\\x09-\\x0D]+"
#: Signals with a fence above. For shares the unit is 1/1000, for the word length 1/10 character. The share of repeated lines
#: is taken of six lines more than there are, so that one repeated line does not condemn a text of three.
SIGNALS = ("symbol_share", "dup_line_share", "repeat_share", "word_length")
#: A fence is the upper quartile plus REACH times the spread: the larger of quartile range and LEAST_SPREAD (in units).
REACH = 6
LEAST_SPREAD = {"symbol_share": 10, "dup_line_share": 40, "repeat_share": 60, "word_length": 10}
#: Each group's sketch also holds this many documents at even quantiles of its language, so that groups of a few documents follow
#: their language and larger ones themselves, without a step between.
PRIOR = 8


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words and base_failed; other columns stay.

    Repeated 3-word windows are found by sorting: a window's 64-bit hash gives its upper bits, its place the lower ones, so
    equal windows become neighbours in one sort of longs. Long texts therefore cost n log n and no shuffle. As places take bits from
    the hash, the windows found so are candidates; these few are sorted again by their full hash and place.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = ["_words", "_lines", "_tri", "_bits", "_sorted", "_near", "_full", "_hits"]
    core = F.btrim(text, F.lit(_SPACE))
    out = docs.withColumn("_words", F.when(F.length(core) == 0, F.array().cast("array<string>")).otherwise(F.split(core, _SPACES)))
    out = out.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(_SPACE))) > 0))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_bits": F.ceil(F.log2(F.greatest(F.size("_words"), F.lit(2)))).cast("int"),
        }
    )
    tri = F.expr("CASE WHEN size(_words) < 4 THEN cast(array() as array<bigint>) ELSE transform(slice(_words, 3, size(_words) - 2), (w, i) -> shiftleft(xxhash64(_words[i], _words[i + 1], w), _bits) + i) END")
    out = out.withColumn("_tri", tri)
    out = out.withColumn("_sorted", F.sort_array("_tri"))
    near = F.expr(
        "CASE WHEN size(_sorted) < 2 THEN cast(array() as array<bigint>) ELSE filter(transform(_sorted, (x, k) -> IF("
        "(k > 0 AND shiftright(_sorted[greatest(k - 1, 0)], _bits) = shiftright(x, _bits)) OR (k + 1 < size(_sorted) AND shiftright(_sorted[least(k + 1, size(_sorted) - 1)], _bits) = shiftright(x, _bits)), "
        "x & (shiftleft(1L, _bits) - 1), -1L)), x -> x >= 0) END"
    )
    full = F.expr("sort_array(transform(_near, p -> struct(xxhash64(_words[cast(p as int)], _words[cast(p + 1 as int)], _words[cast(p + 2 as int)]) AS h, p AS p)))")
    hits = F.expr(
        "CASE WHEN size(_full) < 2 THEN cast(array() as array<bigint>) ELSE sort_array(filter(transform(_full, (x, k) -> IF("
        "(k > 0 AND _full[greatest(k - 1, 0)].h = x.h) OR (k + 1 < size(_full) AND _full[least(k + 1, size(_full) - 1)].h = x.h), x.p, -1L)), x -> x >= 0)) END"
    )
    out = out.withColumn("_near", near)
    out = out.withColumn("_full", full)
    out = out.withColumn("_hits", hits)
    covered = F.expr("aggregate(transform(_hits, (x, k) -> IF(k + 1 < size(_hits), least(3L, _hits[least(k + 1, size(_hits) - 1)] - x), 3L)), 0L, (a, x) -> a + x)")
    out = out.withColumn("n_repeat_words", covered)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop(*names)


def with_signals(stats: DataFrame) -> DataFrame:
    """Whole units of each signal, as the sketches bin them."""
    return stats.withColumns(
        {
            "symbol_share": F.expr("(1000 * n_symbols) div greatest(word_chars, 1)"),
            "dup_line_share": F.expr("(1000 * n_dup_lines) div (n_lines + 6)"),
            "repeat_share": F.expr("(1000 * n_repeat_words) div greatest(n_words, 1)"),
            "word_length": F.expr("least((10 * word_chars) div greatest(n_words, 1), 10000)"),
        }
    )


def _ranked(bins: DataFrame, keys: list[str]) -> DataFrame:
    whole = Window.partitionBy(*keys, "signal")
    return bins.withColumns({"upto": F.sum("n").over(whole.orderBy("unit")), "rows": F.sum("n").over(whole)})


def _quantile(over: int, of: int):
    """The smallest unit that over / of of the rows do not exceed."""
    return F.min(F.when(of * F.col("upto") >= over * F.col("rows"), F.col("unit")))


def adaptive_fences(measured: DataFrame) -> DataFrame:
    """One row for each (lang, source) of the input: an upper fence for each signal. Null lang or source is a group of its own."""
    signals = measured.where("not base_failed").select("lang", "source", F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).alias("unit")) for s in SIGNALS])).alias("s"))
    bins = cut(signals.groupBy("lang", "source", "s.signal", "s.unit").agg(F.count("*").alias("n")))
    of_lang = _ranked(bins.groupBy("lang", "signal", "unit").agg(F.sum("n").alias("n")), ["lang"])
    even = of_lang.groupBy("lang", "signal").agg(F.array(*[_quantile(2 * k + 1, 2 * PRIOR) for k in range(PRIOR)]).alias("units")).alias("e")
    groups = bins.select("lang", "source", "signal").distinct().alias("g")
    prior = groups.join(even, F.col("g.lang").eqNullSafe(F.col("e.lang")) & (F.col("g.signal") == F.col("e.signal"))).select("g.lang", "g.source", "g.signal", F.explode("e.units").alias("unit"), F.lit(1).cast("long").alias("n"))
    quartile = _ranked(bins.unionByName(prior), ["lang", "source"]).groupBy("lang", "source", "signal").agg(_quantile(1, 4).alias("q1"), _quantile(3, 4).alias("q3"))
    least = F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair])
    fence = F.col("q3") + REACH * F.greatest(F.col("q3") - F.col("q1"), least[F.col("signal")])
    return quartile.groupBy("lang", "source").agg(*[F.max(F.when(F.col("signal") == s, fence)).alias(f"max_{s}") for s in SIGNALS])


def judge(measured: DataFrame, fences: DataFrame) -> DataFrame:
    """Join each row with its group's fences; kept = no base failure and no signal above its fence (no fence: kept)."""
    f = fences.withColumnsRenamed({"lang": "_l", "source": "_s"})
    joined = measured.join(f, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    fits = ~F.col("base_failed")
    for s in SIGNALS:
        fits &= F.coalesce(F.col(s) <= F.col(f"max_{s}"), F.lit(True))
    return joined.withColumn("kept", fits).drop("_l", "_s")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """documents (doc_id, text, lang, source) -> doc_id, the base counts, base_failed, kept.

    Null text: no words, base_failed. Rows are judged one by one, so repeated rows get equal verdicts; null lang or source
    forms a group; other columns are ignored; an empty table gives an empty result. A group's fences rest on its rows that
    pass the base rules and on PRIOR documents that stand for its language, so they change steadily with a group's size. A group
    without such rows has no fences.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    measured = cut(with_signals(with_statistics(slim).drop("text")))
    return judge(measured, adaptive_fences(measured)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
