"""Quality rules with adaptive thresholds, in built-in Spark expressions only.

Per text: word and line statistics. Per (lang, source): a mergeable quantile
sketch of every measure, that is, row counts per value bucket. Buckets are
exact below 64 and at most 1/32 wide above, so a quantile read from a sketch is
within 1/32 of the true one; merging is addition, so partial sketches combine
before the shuffle, in any order, with one result. Thresholds are fences above
and below the quartiles of a group: as far out as a multiple of the quartiles'
distance, or as what a few occurrences more are in the group's median text, by
the sketches of the lengths. They replace fixed cutoffs and move with the
language and the source. The thresholds are joined back and filter the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import room_for, spare, stored

WORD_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed value of the contract
WINDOW = 5            # words per window of the repeat measure
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# measure -> (occurrences, the length they are counted over, lower fence too). Where the texts
# of a group are alike in a measure (no symbols, no repeated lines), its quartiles say nothing
# about spread; then the fence leaves room for so many occurrences in the group's median text.
MEASURES = {
    "symbol_rate": (40, "n_words", False),      # symbols per 1000 words
    "dup_line_rate": (10, "n_lines", False),    # repeated lines per 1000 lines with a word
    "upper_rate": (200, "word_chars", False),   # upper-case letters per 1000 characters of words
    "mark_rate": (40, "n_words", False),        # exclamation marks per 1000 words
    "mean_word": (1500, "n_words", True),       # thousandths of a character per word
}
LENGTHS = ("n_words", "n_lines", "word_chars")
FENCE = 6  # interquartile ranges beyond the quartiles
# columns that judge adds, and those that it adds for a while
ADDED = (*MEASURES, *LENGTHS, "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "_lang", "_source",
         "_placed", "_hits", "_n_upper", "_n_marks", *[f"_{m}_{end}" for m in MEASURES for end in ("hi", "lo")])


def _length_of(text: Column, others: str) -> Column:
    """Code points left once runs of ``others`` (a pattern) are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def text_measures(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)
    and the rates of ``MEASURES``. Null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    w, li, g = spare(df, "w"), spare(df, "lines"), spare(df, "grams")
    p = lambda name: prefix + name
    words = F.filter(F.split(t, WORD_SPLIT), lambda x: x != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({w: words, li: lines})
    n = F.size(w)
    gram = lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(WINDOW)])
    df = df.withColumn(g, F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), gram)).otherwise(
        F.array().cast("array<bigint>")))
    # positions of windows found twice or more: equal hashes stand side by side once sorted
    placed = F.array_sort(F.transform(F.col(g), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    hits = F.transform(
        F.filter(
            F.transform(F.sequence(F.lit(0), F.size(g) - 1), lambda j: F.struct(
                F.get(F.col(p("_placed")), j)["i"].alias("i"),
                (F.get(F.col(p("_placed")), j)["h"].eqNullSafe(F.get(F.col(p("_placed")), j - 1)["h"])
                 | F.get(F.col(p("_placed")), j)["h"].eqNullSafe(F.get(F.col(p("_placed")), j + 1)["h"])).alias("two"))),
            lambda x: x["two"]),
        lambda x: x["i"])
    repeated = F.size(F.array_distinct(g)) < F.size(g)
    df = df.withColumn(p("_placed"), F.when(repeated, placed))
    df = df.withColumn(p("_hits"), F.when(F.col(p("_placed")).isNotNull(), F.array_sort(hits)))
    # a window covers WINDOW words, less those that the next repeated window covers too
    covered = F.aggregate(
        F.transform(F.col(p("_hits")), lambda x, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col(p("_hits")), j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumns({
        p("n_words"): n.cast("long"),
        p("word_chars"): _length_of(t, WORD_SPLIT),
        p("n_symbols"): _length_of(t, f"[^{SYMBOLS}]+"),
        p("n_dup_lines"): (F.size(li) - F.size(F.array_distinct(li))).cast("long"),
        p("n_repeat_words"): F.coalesce(covered, F.lit(0)).cast("long"),
        p("n_lines"): F.size(li).cast("long"),
        p("_n_upper"): _length_of(t, r"[^\p{Lu}]+"),
        p("_n_marks"): _length_of(t, "[^!]+"),
    })
    rate = lambda a, b: F.floor(F.lit(1000) * F.col(p(a)) / F.greatest(F.col(p(b)), F.lit(1))).cast("long")
    df = df.withColumns({
        p("symbol_rate"): rate("n_symbols", "n_words"), p("dup_line_rate"): rate("n_dup_lines", "n_lines"),
        p("upper_rate"): rate("_n_upper", "word_chars"), p("mark_rate"): rate("_n_marks", "n_words"),
        p("mean_word"): rate("word_chars", "n_words"),
    })
    return df.drop(w, li, g, p("_placed"), p("_hits"), p("_n_upper"), p("_n_marks"))


def base_failed(prefix: str = "") -> Column:
    n = F.col(prefix + "n_words")
    return (n < MIN_WORDS) | (100 * F.col(prefix + "n_repeat_words") > MAX_REPEAT_PERCENT * n)


def bucket(v: Column) -> Column:
    """Lower end of the value's bucket: itself below 64, else its six leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketch(df: DataFrame, groups: list[str], measures: list[str]) -> DataFrame:
    """(groups, measure, value, rows): the mergeable sketch, one row per bucket."""
    stacked = df.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), bucket(F.col(c)).alias("value")) for m, c in measures])).alias("m"))
    return stacked.groupBy(*groups, "m.measure", "m.value").agg(F.count(F.lit(1)).alias("rows"))


def quartiles(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, q1, q2, q3): least bucket that holds one, two, three quarters."""
    over = Window.partitionBy(*groups, "measure").orderBy("value")
    whole = Window.partitionBy(*groups, "measure")
    ranked = sketched.withColumn("upto", F.sum("rows").over(over)).withColumn("all", F.sum("rows").over(whole))
    return ranked.groupBy(*groups, "measure").agg(*[
        F.min(F.when(4 * F.col("upto") >= k * F.col("all"), F.col("value"))).alias(f"q{k}") for k in (1, 2, 3)])


def thresholds(quart: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group: <measure>_hi and <measure>_lo."""
    at = lambda m, q: F.max(F.when(F.col("measure") == m, F.col(q)))
    out = []
    for m, (occurrences, length, below) in MEASURES.items():
        room = F.greatest(FENCE * (at(m, "q3") - at(m, "q1")),
                          F.floor(F.lit(1000 * occurrences) / F.greatest(at(length, "q2"), F.lit(1))).cast("long"))
        out.append((at(m, "q3") + room).alias(f"{m}_hi"))
        if below:
            out.append((at(m, "q1") - room).alias(f"{m}_lo"))
    return quart.groupBy(*groups).agg(*out)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          prefix: str = "", keep_text: bool = True, broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``.

    The sketches of a group are taken over its rows that pass the base rules,
    so a group full of tiny or looping texts does not move its own fences.
    Null lang or source is a group of its own. Null and empty texts have no
    words and fail the base rules; repeated rows count as often as they occur;
    an empty table gives an empty result. A value at a fence passes.
    ``prefix`` names the added columns apart from clashing ones; without one, a
    clashing column is kept under its name with a leading underscore. The threshold
    table (one row per group) is sent to all tasks up to ``broadcast_rows``
    rows and joined by shuffle beyond.
    """
    p = lambda name: prefix + name
    docs, text, lang, source = room_for(docs, [p(c) for c in ADDED], text, lang, source)
    measured = text_measures(docs, text, prefix)
    if not keep_text:
        measured = measured.drop(text)
    measured = stored(measured.withColumn(p("base_failed"), base_failed(prefix)), "quality-measures")
    g = [p("_lang"), p("_source")]
    grouped = measured.where(~F.col(p("base_failed"))).select(
        F.col(lang).alias(g[0]), F.col(source).alias(g[1]), *[F.col(p(m)).alias(m) for m in (*MEASURES, *LENGTHS)])
    sketched = sketch(grouped, g, [(m, m) for m in (*MEASURES, *LENGTHS)])
    limits = stored(thresholds(quartiles(sketched, g), g), "quality-thresholds")
    limits = limits.select(*g, *[F.col(c).alias(p("_" + c)) for c in limits.columns if c not in g])
    if limits.count() <= broadcast_rows:  # checked size: two names and six longs a row
        limits = F.broadcast(limits)
    joined = measured.join(limits, F.col(lang).eqNullSafe(F.col(g[0])) & F.col(source).eqNullSafe(F.col(g[1])), "left")
    fine = ~F.col(p("base_failed"))
    for m, (_, _, below) in MEASURES.items():
        fine = fine & (F.col(p(m)) <= F.col(p(f"_{m}_hi")))
        if below:
            fine = fine & (F.col(p(m)) >= F.col(p(f"_{m}_lo")))
    out = joined.withColumn(p("kept"), F.coalesce(fine, F.lit(False)))
    return out.drop(*[c for c in limits.columns])


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return judge(docs, text, lang, source, prefix).where(F.col(prefix + "kept")).select(*docs.columns)
