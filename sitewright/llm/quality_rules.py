"""Quality rules whose thresholds come from the data: one mergeable sketch per language, source and measure.

Native throughout.  A document's measures are whole numbers, so a sketch is a count per value: two sketches merge by adding counts, and
a quantile is off by less than one step of the measure.  Sketches of a language and of all documents are merges of the finest ones and
serve the groups that have too few documents.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.session import checkpoint

BLANKS = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Per measure: how far below and above the median a threshold stays at least.
SLACK = {"symbols": (None, 60), "dup_lines": (None, 300), "repeats": (None, 200), "word_length": (15, 20)}
MAX_STEP = 1000


def with_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every text (null: no words).

    ``n_lines`` counts the lines with a word.  No row leaves its partition: repeated five-word windows are found by sorting a text's own
    window hashes, and only in texts that have any.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(*keep, text.alias("_t"))
    d = d.select(*keep, "_t", F.expr(f"trim(BOTH '{BLANKS}' FROM _t)").alias("_trim"))
    d = d.select(*keep, "_t", F.when(F.col("_trim") != "", F.split("_trim", SPLIT)).otherwise(
        F.array().cast("array<string>")).alias("_w"), F.filter(F.split("_t", "\n"), lambda x: F.trim(
            F.translate(x, BLANKS, " " * len(BLANKS))) != "").alias("_lines"))
    n = F.size("_w").cast("bigint")
    hashes = F.transform("_w", lambda x: F.xxhash64(x))
    d = d.select(*keep, n.alias("n_words"), F.length(F.concat_ws("", "_w")).cast("bigint").alias("word_chars"),
                 F.regexp_count("_t", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
                 F.size("_lines").cast("bigint").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"), hashes.alias("_h"))
    m = F.size("_h") - 4
    # combine five word hashes by position
    window = F.transform(F.slice("_h", F.lit(1), F.greatest(m, F.lit(0))), lambda x, i: F.xxhash64(
        x, F.get("_h", i + 1), F.get("_h", i + 2), F.get("_h", i + 3), F.get("_h", i + 4)))
    d = d.withColumn("_v", window).drop("_h")
    d = d.withColumn("_again", F.size(F.array_distinct("_v")) < F.size("_v"))
    pairs = F.when(F.col("_again"), F.sort_array(F.transform("_v", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    d = d.withColumn("_p", pairs).drop("_v", "_again")
    same = lambda x, j: F.coalesce(x["h"] == F.get("_p", j)["h"], F.lit(False))
    hit = F.filter("_p", lambda x, j: (F.when(j > 0, same(x, j - 1)).otherwise(F.lit(False))) | same(x, j + 1))
    d = d.withColumn("_q", F.sort_array(F.transform(hit, lambda x: x["i"]))).drop("_p")
    cover = F.aggregate("_q", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-5).alias("last")),
                        lambda a, x: F.struct((a["n"] + F.least(x - a["last"], F.lit(5))).alias("n"), x.alias("last")), lambda a: a["n"])
    return d.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("bigint")).drop("_q")


def measures() -> dict[str, Column]:
    """Whole-number measures of a document, all within 0..MAX_STEP."""
    part = lambda a, b: F.when(F.col(b) > 0, F.least(F.floor(1000 * F.col(a) / F.col(b)), F.lit(MAX_STEP))).cast("int")
    length = F.when(F.col("n_words") > 0, F.least(F.floor(10 * F.col("word_chars") / F.col("n_words")), F.lit(MAX_STEP))).cast("int")
    return {"symbols": part("n_symbols", "word_chars"), "dup_lines": part("n_dup_lines", "n_lines"),
            "repeats": part("n_repeat_words", "n_words"), "word_length": length}


def sketches(stats: DataFrame, keys: list[str]) -> DataFrame:
    """One count per (keys, measure, step)."""
    cols = measures()
    long = stats.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), e.alias("step")) for m, e in cols.items()])).alias("_m"))
    return long.select(*keys, "_m.*").filter("step IS NOT NULL").groupBy(*keys, "measure", "step").agg(F.count(F.lit(1)).alias("n"))


def quantile_steps(sketch: DataFrame, keys: list[str], qs: tuple[float, ...]) -> DataFrame:
    """Per keys and measure: rows ``n_docs`` and for every q the lowest step with at least that share of rows at or below it."""
    by = Window.partitionBy(*keys, "measure")
    s = sketch.withColumn("_cum", F.sum("n").over(by.orderBy("step"))).withColumn("_all", F.sum("n").over(by))
    picks = [F.min(F.when(F.col("_cum") >= F.lit(q) * F.col("_all"), F.col("step"))).alias(f"q{round(100 * q)}") for q in qs]
    return s.groupBy(*keys, "measure").agg(F.first("_all").alias("n_docs"), *picks)


def fences(sketch: DataFrame, *, spread: float = 4.0, min_docs: int = 50) -> DataFrame:
    """(lang, source, measure, low, high): the median and ``spread`` times its distance to the 10 % and 90 % points, SLACK at least.

    A (lang, source) with fewer than ``min_docs`` documents takes the fences of its language, and a language with fewer those of all.
    No upper fence lies above that of the language or of all documents, so a source with much junk cannot widen its own.
    """
    qs = (0.1, 0.5, 0.9)

    def bounds(level):
        low = F.lit(None).cast("double")
        high = F.lit(None).cast("double")
        for m, (under, over) in SLACK.items():
            if under is not None:
                low = F.when(F.col("measure") == m, F.col("q50") - F.greatest(F.lit(spread) * (F.col("q50") - F.col("q10")), F.lit(float(under)))).otherwise(low)
            high = F.when(F.col("measure") == m, F.col("q50") + F.greatest(F.lit(spread) * (F.col("q90") - F.col("q50")), F.lit(float(over)))).otherwise(high)
        return F.struct(low.alias("low"), high.alias("high")).alias(level)

    by_lang = sketch.groupBy("lang", "measure", "step").agg(F.sum("n").alias("n"))
    by_all = by_lang.groupBy("measure", "step").agg(F.sum("n").alias("n"))
    fine = quantile_steps(sketch, ["lang", "source"], qs).select("lang", "source", "measure", F.col("n_docs").alias("_n1"), bounds("_f1"))
    lang = quantile_steps(by_lang, ["lang"], qs).select(F.col("lang").alias("_l"), F.col("measure").alias("_m"), F.col("n_docs").alias("_n2"), bounds("_f2"))
    every = quantile_steps(by_all, [], qs).select(F.col("measure").alias("_a"), bounds("_f3"))
    f = fine.join(lang, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m"))).join(every, F.col("measure") == F.col("_a"))
    pick = lambda one, two, three: F.when(F.col("_n1") >= min_docs, one).when(F.col("_n2") >= min_docs, two).otherwise(three)
    low = pick(*[F.col(f"_f{i}.low") for i in (1, 2, 3)])
    high = pick(F.least("_f1.high", "_f2.high", "_f3.high"), F.least("_f2.high", "_f3.high"), F.col("_f3.high"))
    return f.select("lang", "source", "measure", low.alias("low"), high.alias("high"))


def judge(docs: DataFrame, *, min_words: int = 10, max_repeat_percent: int = 20, spread: float = 4.0, min_docs: int = 50,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: its statistics, ``base_failed``, ``kept`` and ``failed`` (names of the measures outside their fences).

    The base rule fails texts with fewer than ``min_words`` words or more than ``max_repeat_percent`` percent repeated words; a null or
    empty text fails it.  Thresholds are learned on the documents that pass it, over the whole table.  A null language or source is a
    group like any other; repeated rows count and are judged one by one; an empty table gives an empty result.
    """
    stats = with_statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                                        F.col(text_col).alias("text")), keep=("doc_id", "lang", "source"))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    stats = checkpoint(stats.withColumn("base_failed", base))
    limits = fences(sketches(stats.filter(~F.col("base_failed")), ["lang", "source"]), spread=spread, min_docs=min_docs)
    wide = limits.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("_limits"))
    wide = wide.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "_limits")
    j = stats.join(wide, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")
    outside = [F.when((e < F.col("_limits")[m]["low"]) | (e > F.col("_limits")[m]["high"]), F.lit(m)) for m, e in measures().items()]
    j = j.withColumn("failed", F.array_compact(F.array(*outside))).drop("_limits")
    return j.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
