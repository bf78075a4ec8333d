"""Quality rules: divergence of a text's histograms from language references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import words, written

# Very common words of four languages, in order of commonness.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be by this".split(),
    "de": "der die und den von zu das mit sich des auf ist im dem nicht ein eine".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au".split(),
    "es": "de la que el en y los del se las por un con no una su para".split(),
}
WORD_BINS = sorted({word for listed in COMMON_WORDS.values() for word in listed})

#: Character classes in the order in which they are counted.
CHAR_CLASSES = {
    "lower": "[a-z]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "letter": r"\p{L}+",
    "blank": r"[\x09-\x0D\x20]+",
    "point": "[.,;:!?'\"()-]+",
}
SYMBOLS = r"[#*$%&|<>]+"

#: Fewest words of a text that is compared to the references.
LEAST_WORDS = 50
#: Largest Jensen-Shannon distance (0 to 1) of character classes to the nearest
#: reference; and distances of these and of common words that are too much together.
MOST_CHAR_DISTANCE = 0.27
RATHER_FAR = (0.14, 0.30)
#: A reference is the mean of the histograms of this many texts at least.
LEAST_TEXTS = 20
#: References of up to this many languages, some 600 bytes each, are broadcast.
BROADCAST_LANGUAGES = 10_000


def _repeat_words(listed: str) -> list[tuple[str, Column]]:
    """Columns, to be added in turn, that count words in repeated 3-word windows."""
    array = F.col(listed)
    span = F.when(F.size(array) >= 3, F.sequence(F.lit(0), F.size(array) - 3))
    window = lambda i: F.xxhash64(F.get(array, i), F.get(array, i + 1), F.get(array, i + 2))
    ordered = F.col("_ordered")
    same = lambda x, i: F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))
    step = lambda acc, at: F.struct(
        at.alias("last"),
        (acc["total"] + F.least(F.lit(3), at - acc["last"])).alias("total"),
    )
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    return [
        ("_windows", F.coalesce(F.transform(span, window), F.array().cast("array<bigint>"))),
        (
            # Only texts that repeat a window are sorted.
            "_ordered",
            F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(
                    F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
            ),
        ),
        (
            "_places",
            F.sort_array(
                F.transform(
                    F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)),
                    lambda x: x["i"],
                )
            ),
        ),
        (
            "n_repeat_words",
            F.coalesce(F.aggregate("_places", start, step)["total"], F.lit(0)).cast("long"),
        ),
    ]


def histograms(frame: DataFrame) -> DataFrame:
    """Adds ``_words``, both histograms as counts, and what falls out of them."""
    frame = frame.withColumn("_words", words(F.col("_text")))
    left, sizes = "_text", []
    for name, pattern in CHAR_CLASSES.items():
        frame = frame.withColumn(f"_{name}", F.regexp_replace(left, pattern, ""))
        sizes.append(F.length(left) - F.length(f"_{name}"))
        left = f"_{name}"
    frame = frame.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "_char_counts": F.array(*sizes, F.length(left)),
            "n_symbols": (F.length(left) - F.length(F.regexp_replace(left, SYMBOLS, ""))).cast("long"),
            "_common": F.filter(
                F.transform("_words", lambda word: F.lower(word)), lambda word: word.isin(*WORD_BINS)
            ),
        }
    )
    # Words stand between two blanks each, so that replacing one leaves the others.
    frame = frame.withColumn("_joined", F.concat(F.lit(" "), F.array_join("_common", "  "), F.lit(" ")))
    counted = F.transform(
        F.array(*[F.lit(f" {word} ") for word in WORD_BINS]),
        lambda word: (
            (F.length("_joined") - F.length(F.replace(F.col("_joined"), word, F.lit("")))) / F.length(word)
        ).cast("int"),
    )
    rest = (F.col("n_words") - F.size("_common")).cast("int")
    return frame.withColumn("_word_counts", F.concat(counted, F.array(rest)))


def counts(frame: DataFrame) -> DataFrame:
    """Adds the counts of the base rules; a window's identity is a 64-bit hash."""
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    frame = frame.withColumn("_lines", lines).withColumns(
        {
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    for name, column in _repeat_words("_words"):
        frame = frame.withColumn(name, column)
    return frame


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0), lambda acc, n: acc + n)
    return F.transform(counts, lambda n: n / F.nullif(total, F.lit(0)))


def language_references(marked: DataFrame) -> DataFrame:
    """One row: the languages with enough texts and their mean shares of both histograms.

    ``marked`` has ``_lang``, ``n_words`` and the shares ``_chars`` and ``_shares`` of
    every text. ``langs``, ``chars`` and ``words`` are arrays in one order, empty
    without references. Each text weighs the same, so one very long text does not
    bend a reference.
    """
    n_chars, n_words = len(CHAR_CLASSES) + 1, len(WORD_BINS) + 1
    mean = lambda name, i: F.round(F.avg(F.get(name, F.lit(i))), 9)
    means = (
        marked.where(F.col("_lang").isNotNull() & (F.col("n_words") >= LEAST_WORDS))
        .groupBy(F.col("_lang").alias("lang"))
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.array(*[mean("_chars", i) for i in range(n_chars)]).alias("chars"),
            F.array(*[mean("_shares", i) for i in range(n_words)]).alias("words"),
        )
        .where(F.col("texts") >= LEAST_TEXTS)
    )
    listed = F.sort_array(F.collect_list(F.struct("lang", "chars", "words")))
    return means.agg(listed.alias("found")).select(
        F.col("found.lang").alias("langs"), F.col("found.chars").alias("chars"), F.col("found.words").alias("words")
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares: 0 alike, 1 disjoint."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def nearest(shares: str, references: str) -> Column:
    """Distance to the nearest reference; NULL without references."""
    return F.array_min(F.transform(references, lambda ref: js_distance(F.col(shares), ref)))


NEW = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "char_distance", "word_distance",
)


def _judged(docs: DataFrame, text: str, lang: str, keep: list[str]) -> DataFrame:
    """``_row``, a struct of the columns to keep, beside the columns of ``NEW``.

    Every text is counted once: its counts and shares are written, references are
    means of what is written, and rows meet them when they are read back.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.col(lang).alias("_lang"),
    )
    counted = counts(histograms(rows)).select(
        "_row", "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _shares("_char_counts").alias("_chars"), _shares("_word_counts").alias("_shares"),
    )
    marked = written(counted, "histograms")
    references = written(language_references(marked), "references").select(
        F.col("langs").alias("_langs"), F.col("chars").alias("_ref_chars"), F.col("words").alias("_ref_words")
    )
    small = references.select(F.size("_langs")).first()[0] <= BROADCAST_LANGUAGES
    compared = marked.crossJoin(
        F.broadcast(references) if small else references.hint("shuffle_replicate_nl")
    ).withColumns(
        {"char_distance": nearest("_chars", "_ref_chars"), "word_distance": nearest("_shares", "_ref_words")}
    )
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    beyond = lambda name, most: F.coalesce(F.col(name) > most, F.lit(False))
    comparable = F.coalesce(F.array_contains("_langs", F.col("_lang")), F.lit(True))
    diverges = (F.col("n_words") >= LEAST_WORDS) & comparable & (
        beyond("char_distance", MOST_CHAR_DISTANCE)
        | (beyond("char_distance", RATHER_FAR[0]) & beyond("word_distance", RATHER_FAR[1]))
    )
    judged = compared.withColumn("base_failed", base_failed)
    return judged.withColumn("kept", ~F.col("base_failed") & ~diverges).select("_row", *NEW)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """The rows with counts, distances and verdict (``NEW``).

    A row fails the base rules with under 50 words, or if over half its words lie
    in repeated 3-word windows. It also fails if its character classes lie too
    far from every language reference, or both these and its common words lie
    rather far; texts below ``LEAST_WORDS`` are not compared, nor are any without
    references. Texts of a language that has too few texts for a reference get
    distances too, but do not fail by them: other languages say nothing of it. Texts
    without a language are compared to all. NULL and empty texts fail, an empty table
    gives no rows and repeated rows are judged alike. ``keep`` names the other columns
    to return, all of them if it is None; those named as new are replaced.
    """
    own = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    return _judged(docs, text, lang, own).select("_row.*", *NEW)


def passing(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that the rules keep, with their own columns (but for those named as new).

    NULL and empty texts go, repeated rows stay or go together, and an empty table
    gives no rows. The verdict is computed below a row number, through which Spark
    pushes no filter: pushed down, the filter would repeat the distances it rests on.
    """
    own = [c for c in docs.columns if c not in NEW]
    judged = _judged(docs, text, lang, own).withColumn("_number", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_number") >= 0)).select("_row.*")
