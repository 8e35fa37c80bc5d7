"""Quality rules whose cutoffs come from the corpus itself.

Per document a few integer measures are counted with built-in functions. Each measure is
binned with a bounded relative error, and the bin counts per (lang, source) form a quantile
sketch: two sketches merge by adding counts, so partial aggregation builds them and the
sketch of a language, or of everything, is the sum of its parts. Fences read from the
sketches are joined back and decide which documents stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from paperflow.llm.common import staged, words_of

#: Symbols counted in ``n_symbols``.
SYMBOLS = "[#*$%&|<>]"
#: Sketch resolution: values up to 2**BITS are exact, larger ones keep BITS leading bits.
BITS = 6
#: A (lang, source) sketch of fewer documents gives way to its language's, then to everything's.
MIN_DOCS = 100
#: Fences lie this many interquartile ranges outside the quartiles ...
REACH = 3
#: ... and at least this far (permille; tenths of a character for the word length).
SLACK = {"symbols": 100, "dup_lines": 300, "repeats": 150, "upper": 300, "word_len": 60}
MEASURES = tuple(SLACK)


def counts(docs: DataFrame) -> DataFrame:
    """Integer measures of every whole text: doc_id, lang, source and the counts.

    Null or blank text: all zero. A word is in ``n_repeat_words`` if a five-word window that
    covers it is found twice or more in the text. Equal windows have equal 64-bit hashes, so
    a text whose window hashes all differ has none; in the others the windows are sorted by
    hash and neighbours compared word by word, O(n log n) in the length of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("doc_id", "lang", "source", text.alias("text"))
    one = one.withColumns({
        "_words": words_of(F.col("text")),
        "_lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    one = one.withColumns({
        "n_words": F.size("_words").cast("long"),
        "_starts": F.when(F.size("_words") >= 5, F.sequence(F.lit(0), F.size("_words") - 5)),
    })
    word = lambda i, k: F.get(F.col("_words"), i + k)
    one = one.withColumn("_hashes", F.transform("_starts", lambda i: F.xxhash64(*[word(i, k) for k in range(5)])))
    one = one.withColumn("_windows", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    spot = lambda k: F.get("_windows", k)

    def same(a: Column, b: Column) -> Column:
        hashed = spot(a)["h"] == spot(b)["h"]
        for k in range(5):
            hashed = hashed & (word(spot(a)["i"], k) == word(spot(b)["i"], k))
        return F.coalesce(hashed, F.lit(False))

    at = F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_windows") - 1), lambda k: same(k, k - 1) | same(k, k + 1)),
        lambda k: spot(k)["i"]))
    one = one.withColumn("_at", F.when(F.col("_windows").isNotNull(), at))
    covered = F.aggregate(
        "_at", F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(5), i - s["last"])).alias("n")),
        lambda s: s["n"])
    matches = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    return one.select(
        "doc_id", "lang", "source", "n_words",
        (F.char_length("text") - matches(r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"),
        matches(SYMBOLS).alias("n_symbols"), matches("[A-Z]").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def measures() -> dict[str, Column]:
    """Integer measures that the fences apply to (0 where the divisor is 0)."""
    per = lambda a, b, k: F.expr(f"case when {b} > 0 then ({k} * {a}) div {b} else 0 end")
    return {
        "symbols": per("n_symbols", "word_chars", 1000), "dup_lines": per("n_dup_lines", "n_lines", 1000),
        "repeats": per("n_repeat_words", "n_words", 1000), "upper": per("n_upper", "word_chars", 1000),
        "word_len": per("word_chars", "n_words", 10),
    }


def sketch_bin(v: Column) -> Column:
    """Lower end of the value's bin: exact below 2**BITS, then BITS leading bits are kept."""
    drop = F.greatest(F.lit(0), F.length(F.bin(v)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the mergeable sketch of every (lang, source)."""
    long = counted.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), sketch_bin(c).alias("bin")) for m, c in measures().items()])).alias("m"))
    return long.groupBy("lang", "source", "m.measure", "m.bin").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source) and level 0, 1 (language) or 3 (everything): n_docs and, for
    each measure, ``<measure>_low`` and ``<measure>_high``."""
    levels = [sketch.select("measure", F.lit(k).alias("level"),
                            *[(F.col(c) if c in keep else F.lit(None).cast("string")).alias(c) for c in ("lang", "source")],
                            "bin", "n") for k, keep in ((0, ("lang", "source")), (1, ("lang",)), (3, ()))]
    summed = levels[0].unionByName(levels[1]).unionByName(levels[2]).groupBy(
        "level", "lang", "source", "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "lang", "source", "measure")
    ranked = summed.withColumns({"upto": F.sum("n").over(group.orderBy("bin")), "all": F.sum("n").over(group)})
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bin")))
    cut = ranked.groupBy("level", "lang", "source", "measure").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("all").alias("n_docs"))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])
    reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), slack[F.col("measure")])
    cut = cut.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}")
    return cut.groupBy("level", "lang", "source").agg(
        F.max("n_docs").alias("n_docs"), *[pick(m, c) for m in MEASURES for c in ("low", "high")])


def quality_rules(docs: DataFrame) -> DataFrame:
    """Verdict for every document: the counts, ``base_failed``, ``kept`` and ``sketch_level``.

    ``base_failed``: fewer than 10 words, or over a fifth of them in repeated windows.
    ``kept`` is false for these and for documents with a measure outside the fences of their
    (lang, source) (level 0), or of the language (1) or everything (3) where the group has
    fewer than ``MIN_DOCS`` documents. Only the word length has a lower fence. Null lang or source is a
    group like any other; repeated rows are judged each; an empty table gives no rows; other
    columns of ``docs`` are not read.
    """
    counted = staged(counts(docs), "quality-counts")
    limits = staged(fences(sketches(counted)), "quality-fences")
    names = [f"{m}_{c}" for m in MEASURES for c in ("low", "high")]
    as_struct = lambda level, *keys: limits.filter(F.col("level") == level).select(
        *[F.col(k).alias(f"_{k}{level}") for k in keys], F.struct("n_docs", F.lit(level).alias("level"), *names).alias(f"_f{level}"))
    own, lang = as_struct(0, "lang", "source"), as_struct(1, "lang")
    overall = as_struct(3).first()  # one row, or none for an empty table
    every = F.lit(None) if overall is None else F.struct(*[F.lit(v).alias(k) for k, v in overall["_f3"].asDict().items()])
    # Fences of each group first (as many rows as groups), then one join with the documents.
    table = (own.join(lang, own["_lang0"].eqNullSafe(lang["_lang1"]))
             .select("_lang0", "_source0", F.when(F.col("_f0.n_docs") >= MIN_DOCS, F.col("_f0"))
                     .when(F.col("_f1.n_docs") >= MIN_DOCS, F.col("_f1")).otherwise(every).alias("_f")))
    joined = counted.join(table, counted["lang"].eqNullSafe(table["_lang0"])
                          & counted["source"].eqNullSafe(table["_source0"]), "left")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    inside = F.lit(True)
    for m, value in measures().items():
        inside = inside & (value <= F.col(f"_f.{m}_high"))
        if m == "word_len":
            inside = inside & (value >= F.col(f"_f.{m}_low"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & F.coalesce(inside, F.lit(True))).alias("kept"),
        "n_upper", "n_lines", F.col("_f.level").alias("sketch_level"))
