"""Quality rules with thresholds that adapt to each language and source.

The base counts of a document are plain numbers of its text. The method turns them into rates, keeps
a quantile sketch of each rate per (language, source) over the documents that pass the base rule, and
rejects a document whose rate lies far above what its group's sketch holds up to a high quantile, or,
for the length of words, far below its low one. How far is told by the sketch itself: by the distance
of that quantile from the median. A sketch is a histogram whose buckets grow with the value (at most
1/16 wide), so sketches merge by adding counts: a group with too few documents beyond a quantile takes
the merged sketch of its language, and that failing, of the corpus. All of it is exact integer
arithmetic, so the same documents give the same thresholds however they are dealt over tasks.

Null texts are empty; empty and short texts fail the base rule. A null language or source is a group
of its own. Repeated rows count as often as they occur and get a row each. Ties in a rate share a
bucket, so equal documents of a group get equal verdicts. An empty table gives an empty result.
Columns other than the four named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import let, text_of, written

# White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Rate: numerator, its factor, denominator, and as a fraction the sketch's quantile that tells the fence.
#: Symbols, repeated lines and repeated words are thousandths; the mean length of a word is hundredths
#: of a character. Most documents have no repeated line or word, so for these a quantile of the few
#: that have is read.
RATES = {
    "symbols": ("n_symbols", 1000, "word_chars", (3, 5)),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", (49, 50)),
    "repeats": ("n_repeat_words", 1000, "n_words", (49, 50)),
    "word_length": ("word_chars", 100, "n_words", (3, 4)),
}
#: How many times the quantile's distance from the median, or a bucket if that is wider, the fence lies
#: beyond the quantile.
FENCE = 4
#: Rates that may be too low as well; the low fence mirrors the high one.
TWO_SIDED = ("word_length",)
#: Documents that a sketch needs beyond a quantile for it to be read.
BEYOND = 10


def _repeat_words(words: Column) -> Column:
    """Words inside a window of three that occurs twice or more."""
    def covered(sorted_windows: Column) -> Column:
        twice = F.filter(sorted_windows, lambda e, k: F.coalesce(
            e.h == F.get(sorted_windows, k - 1).h, F.lit(False)) | F.coalesce(
            e.h == F.get(sorted_windows, k + 1).h, F.lit(False)))
        at = F.sort_array(F.transform(twice, lambda e: e.i))
        return let(at, lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(
                F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))).cast("long")),
            F.lit(0).cast("long"), lambda total, n: total + n))

    def repeated(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")) \
            .otherwise(let(F.sort_array(F.transform(
                hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered))

    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(
        w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)))
    return let(hashes, repeated)


def text_counts(text: Column) -> Column:
    """A struct of the base counts of a text that is not null."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(
        F.btrim(line, F.lit(" \t\x0b\f\r"))) > 0)
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    of_words = let(F.array_remove(F.split(text, SPACES), ""), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeat_words(words).alias("n_repeat_words")))
    of_lines = let(lines, lambda lines: F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines")))
    return F.struct(of_words.alias("words"), of_lines.alias("lines"), (
        # The symbols are one byte each.
        F.octet_length(text) - F.octet_length(bare)).cast("long").alias("n_symbols"))


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """Columns doc_id, lang, source, the counts and base_failed, a row for each document."""
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
        text_counts(text_of(text)).alias("c"))
    flat = counted.select(
        "doc_id", "lang", "source", "c.words.n_words", "c.words.word_chars", "c.n_symbols",
        "c.lines.n_lines", "c.lines.n_dup_lines", "c.words.n_repeat_words")
    return flat.withColumn("base_failed", (F.col("n_words") < 50)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _rate(name: str) -> Column:
    above, factor, below, *_ = RATES[name]
    return F.expr(f"{factor} * {above} div greatest({below}, 1)")


def bucket(value: Column) -> Column:
    """The upper edge of the value's bucket: itself below 16, then 16 buckets to a doubling."""
    shift = F.length(F.bin(value)) - 5
    return F.when(value < 16, value).otherwise(F.call_function(
        "shiftleft", F.call_function("shiftright", value, shift) + 1, shift) - 1)


def width(edge: Column) -> Column:
    """The width of the bucket that ends at an edge."""
    return F.when(edge < 16, F.lit(1)).otherwise(
        F.call_function("shiftleft", F.lit(1), F.length(F.bin(edge)) - 5)).cast("long")


def sketches(counts: DataFrame) -> DataFrame:
    """Mergeable sketches: n by lang, source, rate and bucket, of the documents that pass the base."""
    rates = F.explode(F.array(*[F.struct(
        F.lit(name).alias("rate"), bucket(_rate(name)).alias("edge")) for name in RATES]))
    return counts.filter("NOT base_failed").select("lang", "source", rates.alias("r")).groupBy(
        "lang", "source", "r.rate", "r.edge").agg(F.count("*").alias("n"))


def _of_rate(part: int) -> Column:
    """The numerator (0) or denominator (1) of the quantile of the rate in the column ``rate``."""
    chosen = F.lit(None).cast("long")
    for name, (*_, fraction) in RATES.items():
        chosen = F.when(F.col("rate") == name, F.lit(fraction[part]).cast("long")).otherwise(chosen)
    return chosen


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys and rate: the highest rate that passes and the lowest, and whether the merged sketch
    holds enough documents to tell (``enough``)."""
    merged = sketch.groupBy(*keys, "rate", "edge").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*keys, "rate").orderBy("edge")
    whole = Window.partitionBy(*keys, "rate")
    ranked = merged.select(
        "*", F.sum("n").over(up_to).alias("run"), F.sum("n").over(whole).alias("docs"),
        _of_rate(0).alias("part"), _of_rate(1).alias("of"))

    def quantile(part: Column, of: Column) -> Column:
        return F.min(F.when(of * F.col("run") >= part * F.col("docs"), F.col("edge")))

    part, of = F.col("part"), F.col("of")
    quantiles = ranked.groupBy(*keys, "rate").agg(
        quantile(F.lit(1), F.lit(2)).alias("median"), quantile(part, of).alias("high"),
        quantile(of - part, of).alias("low"),
        (F.max("docs") * F.max(of - part) >= BEYOND * F.max(of)).alias("enough"))
    return quantiles.select(
        *keys, "rate", "enough",
        (F.col("high") + FENCE * F.greatest(width(F.col("high")), F.col("high") - F.col("median")))
        .alias("most"),
        (F.col("low") - FENCE * F.greatest(width(F.col("low")), F.col("median") - F.col("low")))
        .alias("least"))


def thresholds(counts: DataFrame) -> DataFrame:
    """A row for each lang and source, with columns for each rate's fences."""
    sketch = sketches(counts)
    own = fences(sketch, ["lang", "source"]).alias("own")
    of_lang = fences(sketch, ["lang"]).alias("of_lang")
    of_all = fences(sketch, []).alias("of_all")

    def first_enough(fence: str) -> Column:
        return (F.when(F.col("own.enough"), F.col(f"own.{fence}"))
                .when(F.col("of_lang.enough"), F.col(f"of_lang.{fence}"))
                .otherwise(F.col(f"of_all.{fence}")).alias(fence))

    chosen = own.join(of_lang, F.col("own.lang").eqNullSafe(F.col("of_lang.lang"))
                      & (F.col("own.rate") == F.col("of_lang.rate"))) \
        .join(of_all, F.col("own.rate") == F.col("of_all.rate")) \
        .select("own.lang", "own.source", "own.rate", first_enough("most"), first_enough("least"))
    return chosen.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rate") == name, F.col("most"))).alias(f"most_{name}")
          for name in RATES],
        *[F.max(F.when(F.col("rate") == name, F.col("least"))).alias(f"least_{name}")
          for name in TWO_SIDED])


def rule_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                  source: str = "source") -> DataFrame:
    """The base counts, the thresholds that applied, and ``kept``; a row for each document. A group
    of which no document passes the base has no thresholds.

    The counts are written to the shared folder once, so that the texts are read once.
    """
    counts = written(base_counts(docs, doc_id, text, lang, source), "rule-counts")
    limits = thresholds(counts).alias("t")
    c = counts.alias("c")
    joined = c.join(limits, F.col("c.lang").eqNullSafe(F.col("t.lang"))
                    & F.col("c.source").eqNullSafe(F.col("t.source")), "left")
    passed = F.lit(True)
    for name in RATES:
        passed = passed & (_rate(name) <= F.col(f"most_{name}"))
    for name in TWO_SIDED:
        passed = passed & (_rate(name) >= F.col(f"least_{name}"))
    fences_of = [*[f"most_{name}" for name in RATES], *[f"least_{name}" for name in TWO_SIDED]]
    return joined.select("c.*", *fences_of, F.coalesce(
        ~F.col("base_failed") & passed, F.lit(False)).alias("kept"))
