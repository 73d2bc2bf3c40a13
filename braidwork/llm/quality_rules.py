"""Quality rules with DataFrame functions only: repetition counts, then distribution divergence from language references.

Two histograms of a document are compared with those of each language by Jensen-Shannon distance (square root of the
divergence in bits, 0 to 1): character classes of its words (lower-case and caseless letters, upper-case letters, digits, the
rest), and its common words (the language's TOP most common ones, other words). A document is judged against the language
nearest by common words; of equally near ones the first by code. It is rejected if its characters alone are far, or its characters and words both are. Texts
with fewer than GUARD_WORDS words are too short for the histogram of words, and those with fewer than MIN_WORDS fail the base rule.

Words of three-word windows are compared by 64-bit hash. A document's windows are sorted as longs (hash prefix and position in one),
so work is n log n for any length, and nothing leaves the row: there is no shuffle, hence no skew.

Defined edge cases: null and empty texts have no words, lines or symbols, and fail the base rule (fewer than 50 words); repeated
rows are judged alike; an empty table gives no rows; other columns are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, plain, table

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: No verdict by common words below this many words; characters are many enough from MIN_WORDS on.
GUARD_WORDS = 80
#: Rejected: characters beyond MAX_CHAR_DISTANCE, or characters and words both beyond the smaller pair.
MAX_CHAR_DISTANCE, BOTH = 0.25, (0.12, 0.24)
#: Shares of words in running text, per thousand, of each language's most common words, rounded as word-frequency lists of
#: newspapers and encyclopedias give them.
LANGUAGES = {
    "en": {"the": 60, "of": 36, "and": 24, "to": 20, "in": 17, "a": 16, "is": 12, "that": 10, "for": 9, "was": 8, "on": 7, "as": 7},
    "de": {"der": 36, "die": 32, "und": 28, "in": 20, "den": 14, "von": 12, "zu": 11, "das": 10, "mit": 9, "des": 8, "sich": 7, "auf": 7},
    "fr": {"de": 50, "la": 30, "le": 22, "et": 20, "les": 20, "des": 18, "en": 14, "un": 12, "du": 12, "une": 11, "que": 9, "est": 9},
    "es": {"de": 55, "la": 36, "que": 30, "el": 28, "en": 25, "y": 24, "a": 20, "los": 16, "se": 13, "del": 12, "las": 10, "un": 9},
}
#: Shares of word characters by language and class: lower-case and caseless letters, upper-case letters, digits, the rest. Nouns begin with upper
#: case in German; apostrophes, accents apart, make the rest larger in French.
CHARS = {"en": [0.945, 0.025, 0.005, 0.025], "de": [0.925, 0.045, 0.005, 0.025], "fr": [0.938, 0.024, 0.005, 0.033], "es": [0.947, 0.022, 0.005, 0.026]}
BITS = 30


def js_distance(p: Column, q: Column) -> Column:
    """Of two arrays of shares."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    both = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, b: a + b) / 2))


def doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with columns more, all starting with q_: the counts of the rules and q_char_distance, q_word_distance, q_lang. Columns of docs
    that start with q_ are left out."""
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith("q_")])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.withColumn("q_text", text).withColumn("q_words", F.array_remove(F.split("q_text", SPACE), ""))
    low = (1 << BITS) - 1
    triples = F.transform(
        F.when(F.size("q_words") >= 3, F.sequence(F.lit(0), F.size("q_words") - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("q_words", i), F.get("q_words", i + 1), F.get("q_words", i + 2)),
    )
    out = out.withColumn("q_triples", triples)
    sought = F.size(F.array_distinct("q_triples")) < F.size("q_triples")
    # longs of hash prefix and position, sorted: repeats are neighbours, and few others are
    packed = F.transform("q_triples", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    out = out.withColumn("q_sorted", F.when(sought, F.sort_array(packed)).otherwise(F.array().cast("array<long>")))
    prefix = lambda x: F.shiftright(x, BITS)
    near = F.filter("q_sorted", lambda x, j: prefix(x).eqNullSafe(prefix(F.get("q_sorted", j - 1))) | prefix(x).eqNullSafe(prefix(F.get("q_sorted", j + 1))))
    place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
    exact = F.array_sort(F.transform(near, lambda x: F.struct(F.get("q_triples", place(x)).alias("h"), place(x).alias("i"))))
    out = out.withColumn("q_near", exact)
    h = lambda j: F.get("q_near", j)["h"]
    twice = F.filter("q_near", lambda x, j: x["h"].eqNullSafe(h(j - 1)) | x["h"].eqNullSafe(h(j + 1)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    lines = F.filter(F.split("q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumns({"q_lines": lines, "q_joined": F.array_join("q_words", "")})
    out = out.select(
        *[F.col(c) for c in docs.columns],
        "q_words",
        "q_joined",
        F.size("q_words").cast("long").alias("q_n_words"),
        F.length("q_joined").cast("long").alias("q_word_chars"),
        F.regexp_count("q_text", F.lit("[#*$%&|<>]")).cast("long").alias("q_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("q_dup_lines"),
        covered.cast("long").alias("q_repeat_words"),
    )
    return _distances(docs, out)


def _distances(docs: DataFrame, out: DataFrame) -> DataFrame:
    chars = F.col("q_word_chars")
    only = lambda kept: F.length(F.regexp_replace("q_joined", f"[^{kept}]+", ""))
    out = out.withColumns({"q_upper": only(r"\p{Lu}"), "q_digits": only("0-9"), "q_letters": only(r"\p{L}\p{M}")})
    share = lambda x: (x / F.greatest(chars, F.lit(1))).cast("double")
    own = F.array(share(F.col("q_letters") - F.col("q_upper")), share(F.col("q_upper")), share(F.col("q_digits")), share(chars - F.col("q_letters") - F.col("q_digits")))
    every = sorted({w for ws in LANGUAGES.values() for w in ws})
    bare = F.transform("q_words", lambda w: F.lower(F.rtrim(w, F.lit(".,"))))
    out = out.withColumns({"q_shares": own, "q_common": F.filter(bare, lambda w: w.isin(every))})
    count = lambda w: F.size(F.filter("q_common", lambda v: v == w))
    out = out.withColumn("q_counts", F.create_map(*[x for w in every for x in (F.lit(w), count(w))]))
    distances = []
    for lang, words in LANGUAGES.items():
        own = [F.col("q_counts")[w] for w in words]
        some = [(x / F.greatest(F.col("q_n_words"), F.lit(1))).cast("double") for x in own]
        rest = F.lit(1.0) - F.aggregate(F.array(*some), F.lit(0.0), lambda a, b: a + b)
        distances.append(F.struct(js_distance(F.array(*some, rest), doubles([v / 1000 for v in words.values()] + [1 - sum(words.values()) / 1000])).alias("d"), F.lit(lang).alias("lang"), js_distance(F.col("q_shares"), doubles(CHARS[lang])).alias("c")))
    out = out.withColumn("q_nearest", F.array_min(F.array(*distances)))
    return out.select(
        *docs.columns, "q_n_words", "q_word_chars", "q_symbols", "q_dup_lines", "q_repeat_words", F.col("q_nearest")["c"].alias("q_char_distance"), F.col("q_nearest")["d"].alias("q_word_distance"), F.col("q_nearest")["lang"].alias("q_lang")
    )


def judged(docs: DataFrame, text_col: str = "text", guard_words: int = GUARD_WORDS, max_char: float = MAX_CHAR_DISTANCE, both: tuple[float, float] = BOTH) -> DataFrame:
    """measured() with q_base_failed and q_kept."""
    both_far = (F.col("q_char_distance") > both[0]) & (F.col("q_word_distance") > both[1])
    far = (F.col("q_char_distance") > max_char) | ((F.col("q_n_words") >= guard_words) & both_far)
    failed = (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_repeat_words") > REPEAT_PERCENT * F.col("q_n_words"))
    out = measured(docs, text_col).withColumns({"q_base_failed": failed, "q_kept": ~(failed | far)})
    # a filter on the results stays above this row number; pushed below the projections, it would repeat all of them inside each lambda
    above = F.monotonically_increasing_id() >= 0
    return out.select(*[F.when(above, F.col(c)).alias(c) if c.startswith("q_") else F.col(c) for c in out.columns])


def kept(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, unchanged."""
    # the row number keeps the filter above the projections; pushed below, it would repeat all of them inside each lambda
    own, (text,) = plain(docs, text_col)
    rows = judged(own, text).select(*own.columns, "q_kept", F.monotonically_increasing_id().alias("q_row"))
    return rows.where((F.col("q_row") >= 0) & F.col("q_kept")).select(own.columns).toDF(*docs.columns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(ids_and_texts(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        F.col("q_n_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"),
        F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"),
        F.round("q_char_distance", 6).alias("char_distance"),
        F.round("q_word_distance", 6).alias("word_distance"),
        F.col("q_lang").alias("nearest_lang"),
    )
