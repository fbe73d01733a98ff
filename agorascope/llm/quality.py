"""Quality rules with distribution divergence, in DataFrame functions only.

Two histograms of each text, of character classes and of the commonest words of its language, are held against references of
that language by Jensen-Shannon distance. Base rules on length and repetition come first; texts under a minimum length are not
judged by a histogram. References are given, never taken from the judged table: a text has the same verdict in a table, a part
of it or alone. Those of REFERENCES serve where none are passed in; references() fits others to a table of good texts. A text
in a language without a reference, or of null language, is not judged by histograms: it has no distances, and the base
rules alone decide.

Null or blank texts have no words and fail the base rules. Ties do not arise: every column is a function of one row and
the references. Ids are carried, repeated rows get equal rows, other columns are not used; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The commonest words of each language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "im", "des"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "dans"],
}
#: Character classes besides a-z and blanks, counted among the characters that are neither.
CLASSES = {"upper": r"\p{Lu}", "accented": r"[\p{L}&&[^a-z\p{Lu}]]", "digit": r"\p{Nd}", "line": r"[\n\r]", "stop": r"[.,;:]", "call": r"[!?]", "mark": r"[#*$%&|<>=_{}\[\]\\~^@+/]"}
MIN_WORDS, MIN_CHARS, MIN_JUDGED_WORDS = 20, 100, 40
#: Histograms of characters (CLASSES, then a-z, blanks, others) and of common words (those of COMMON, then all others): what
#: references() gave for the texts of sf0.1 labelled good, at three decimals. Fixed values.
REFERENCES: dict[str, tuple[list[float], list[float] | None]] = {
    "de": ([0.013, 0.038, 0.0, 0.003, 0.022, 0.0, 0.0, 0.773, 0.151, 0.0], [0.049, 0.026, 0.021, 0.015, 0.013, 0.01, 0.009, 0.008, 0.007, 0.004, 0.004, 0.005, 0.828]),
    "en": ([0.014, 0.0, 0.0, 0.003, 0.024, 0.0, 0.0, 0.796, 0.163, 0.0], [0.05, 0.025, 0.021, 0.015, 0.01, 0.012, 0.009, 0.008, 0.006, 0.007, 0.006, 0.005, 0.825]),
    "es": ([0.014, 0.077, 0.0, 0.003, 0.023, 0.0, 0.0, 0.725, 0.158, 0.0], [0.051, 0.026, 0.019, 0.014, 0.012, 0.01, 0.0, 0.009, 0.006, 0.008, 0.007, 0.006, 0.831]),
    "fr": ([0.014, 0.087, 0.0, 0.004, 0.024, 0.0, 0.0, 0.708, 0.163, 0.0], [0.049, 0.027, 0.02, 0.014, 0.012, 0.011, 0.01, 0.008, 0.006, 0.006, 0.006, 0.004, 0.826]),
}
#: Jensen-Shannon distances (base 2). A text is rejected if its characters are further than MAX_CHAR + CHAR_SLACK / words
#: (short texts scatter more) and its common words further than MIN_WORD, or its common words further than MAX_WORD.
MAX_CHAR, CHAR_SLACK, MIN_WORD, MAX_WORD = 0.17, 4.0, 0.15, 0.4
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def _once(value: Column, name) -> Column:
    """Binds a costly value for a lambda, so it is computed once."""
    return F.transform(F.array(value), name)[0]


def _plus(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def n_repeat_words(words: Column, window: int = 8) -> Column:
    """Words inside windows that occur twice or more, by sorted 64-bit window hashes."""
    def pairs(h: Column, by: int) -> Column:
        return F.zip_with(h, F.slice(h, by + 1, F.greatest(F.size(h) - by, F.lit(0))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))

    def rolled(h: Column) -> Column:
        h2 = pairs(h, 1)
        return _once(h2, lambda x2: _once(pairs(x2, 2), lambda x4: pairs(x4, 4)))

    hashes = rolled(F.transform(words, lambda w: F.xxhash64(w)))
    size = F.size(words) - (window - 1)

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.transform(s, lambda x, i: F.when((x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]))
            return F.sort_array(F.filter(twice, lambda x: x.isNotNull()))

        def total(p: Column) -> Column:
            return _plus(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.coalesce(F.least(b - a, F.lit(window).cast("long")), F.lit(window).cast("long"))))

        return _once(ordered, lambda s: _once(starts(s), total))

    own = F.slice(hashes, 1, F.greatest(size, F.lit(0)))
    return F.when(size < 2, F.lit(0).cast("long")).otherwise(_once(own, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))))


def _share(count: Column, total: Column) -> Column:
    return F.when(total > 0, count / total).otherwise(F.lit(0.0))


def _is_in(values: list[str]):
    return lambda x: x.isin(*values)


def _equals(value: Column):
    return lambda x: x == value


def histograms(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Adds words_, n_chars_, char_hist, word_hist (null for a language that has no list of common words).

    Common words are counted as they stand between white space, in lower case."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = docs.withColumns({"words_": F.array_remove(F.split(t, BLANK, -1), ""), "n_chars_": F.length(t), "odd_": F.regexp_replace(t, "[a-z]+", "")})
    docs = docs.withColumns({"c_lower": F.col("n_chars_") - F.length("odd_"), "rare_": F.regexp_replace("odd_", "[ \\t]+", "")})
    docs = docs.withColumns({f"c_{n}": F.length("rare_") - F.length(F.regexp_replace("rare_", f"{p}+", "")) for n, p in CLASSES.items()} | {"c_blank": F.length("odd_") - F.length("rare_")})
    known = [f"c_{n}" for n in CLASSES] + ["c_lower", "c_blank"]
    rest = F.col("n_chars_") - sum((F.col(c) for c in known), F.lit(0))
    docs = docs.withColumn("char_hist", F.array(*[_share(F.col(c), F.col("n_chars_")) for c in known], _share(rest, F.col("n_chars_"))))
    hits, hist = F.lit(None).cast("array<string>"), F.lit(None).cast("array<double>")
    for code, list_ in COMMON.items():
        hits = F.when(F.col(lang) == code, F.filter("words_", _is_in(list_))).otherwise(hits)
    docs, n = docs.withColumn("hits_", hits), F.size("words_")
    for code, list_ in COMMON.items():
        own = F.transform(F.array(*map(F.lit, list_)), lambda w: _share(F.size(F.filter("hits_", _equals(w))), F.size("words_")))
        hist = F.when(F.col(lang) == code, F.concat(own, F.array(1 - _share(F.size("hits_"), n)))).otherwise(hist)
    return docs.withColumn("word_hist", hist).drop("odd_", "rare_", "hits_", *known)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms of equal length."""
    def term(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: term(a, (a + b) / 2) + term(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def references(good: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[list[float], list[float] | None]]:
    """References fitted to a table of good texts: histograms of the medians over all its texts of a language that are long
    enough, scaled to a sum of 1; languages without a list in COMMON have that of characters only.

    Medians of shares rounded to a thousandth: exact, and an aggregation buffer holds at most 1001 values for each bin.
    One row per language comes to the driver."""
    rows = histograms(good.select(text, lang).where(F.col(lang).isNotNull()), text, lang)
    rows = rows.where((F.col("n_chars_") >= MIN_CHARS) & (F.size("words_") >= MIN_JUDGED_WORDS))
    middle = lambda c, n: F.array(*[F.median(F.round(F.get(c, F.lit(i)), 3)) for i in range(n)]).alias(c)
    found = rows.groupBy(lang).agg(middle("char_hist", len(CLASSES) + 3), middle("word_hist", 13)).collect()
    scaled = lambda h: [x / (sum(h) or 1.0) for x in h]
    return {r[lang]: (scaled(r["char_hist"]), scaled(r["word_hist"]) if r[lang] in COMMON else None) for r in found}


def judged(docs: DataFrame, refs: dict, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    wordy = r"[^\x20\x09-\x0D]"
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(wordy))
    docs = histograms(docs, text, lang)
    docs = docs.withColumns({
        "n_words": F.size("words_").cast("long"),
        "word_chars": (F.col("n_chars_") - F.length(F.regexp_replace(t, WORD, ""))).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": _once(lines, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long"),
        "n_repeat_words": n_repeat_words(F.col("words_")),
    })
    docs = docs.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    to = lambda v: F.array(*map(F.lit, v))

    def distance(hist: str, own: dict) -> Column:
        if not own:
            return F.lit(None).cast("double")
        table = F.create_map(*[x for code, h in own.items() for x in (F.lit(code), to(h))])
        return _once(F.try_element_at(table, F.col(lang)), lambda ref: F.when(ref.isNotNull(), js_distance(F.col(hist), ref)))

    char, word = distance("char_hist", {k: c for k, (c, _) in refs.items()}), distance("word_hist", {k: w for k, (_, w) in refs.items() if w})
    docs = docs.withColumns({"char_distance": F.when(F.col("n_chars_") >= MIN_CHARS, char), "word_distance": F.when(F.col("n_words") >= MIN_JUDGED_WORDS, word)})
    char, word = F.coalesce("char_distance", F.lit(0.0)), F.col("word_distance")
    far = (char > MAX_CHAR + CHAR_SLACK / F.greatest("n_words", F.lit(1))) & F.coalesce(word > MIN_WORD, F.lit(True)) | F.coalesce(word > MAX_WORD, F.lit(False))
    return docs.withColumn("kept", ~F.col("base_failed") & ~far).drop("words_", "n_chars_", "char_hist", "word_hist")


def quality(docs: DataFrame, refs: dict | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document; refs: by language, as references() gives them."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return judged(rows, REFERENCES if refs is None else refs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def kept_rows(docs: DataFrame, refs: dict | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows, all columns as they are, that the rules keep."""
    rows = docs.select(F.struct("*").alias("row_"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # A filter on `kept` would be pushed down with copies of all that it is made of; a generator computes it once.
    one = F.explode_outer(F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return judged(rows, REFERENCES if refs is None else refs).select("row_", one.alias("one_")).where("one_ is not null").select("row_.*")
