"""Fill-in-middle examples, cut by one match of a counted-quantifier pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit of text: a run of ASCII letters, or any one other code point.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same as an atom: a run of letters is never given back.
_ATOM = "(?:[A-Za-z]++|[^A-Za-z])"

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Percent of the texts that stay plain, and of the others that have the suffix first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = 1


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits that depend on the seed and the key alone.

    They are the first four groups of eight digits of a SHA-256. A NULL key draws
    as an empty one.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def parts_pattern(first: Column, second: Column) -> Column:
    """Pattern of a whole text: the first units, those up to the second cut, the rest.

    Both counted groups are possessive: the matcher takes the units one by one in a
    loop and remembers no way back, so texts of any length need no stack.
    """
    return F.concat(
        F.lit(rf"(?s)\A({_ATOM}{{"), first.cast("string"),
        F.lit(rf"}}+)({_ATOM}{{"), (second - first).cast("string"), F.lit("}+)(.*+)"),
    )


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """An example of every row: the key, ``n``, ``form`` and ``output``.

    ``n`` is the number of units. Two drawn cuts, each from 0 to ``n``, part the text
    into prefix, middle and suffix; ``form`` says how they are put together: ``psm``
    (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the text
    alone). Plain are empty texts, texts that hold a mark, and a drawn share.

    A NULL text counts as empty. The draws depend on the key, so repeated rows give
    equal examples; an empty table gives no rows; other columns are ignored. All of
    it is done where the rows are read: nothing is shuffled.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    first, second, plain, spm = draws(F.col("_key"), seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("_text"), F.lit(mark))
    counted = docs.select(F.col(key).alias("_key"), content.alias("_text")).select(
        "_key", "_text", F.regexp_count(F.col("_text"), F.lit(UNIT)).cast("long").alias("n")
    )
    at = [draw % (F.col("n") + 1) for draw in (first, second)]
    form = (
        F.when((F.col("_text") == "") | marked | (plain % 100 >= 100 - plain_percent), "plain")
        .when(spm % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    order = (
        F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
        .otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    )
    return (
        counted.select("*", form.alias("form"), F.least(*at).alias("_first"), F.greatest(*at).alias("_second"))
        .withColumn("_pattern", parts_pattern(F.col("_first"), F.col("_second")))
        .select(
            F.col("_key").alias(key),
            "n",
            "form",
            F.when(F.col("form") == "plain", F.col("_text"))
            .otherwise(F.regexp_replace(F.col("_text"), F.col("_pattern"), order))
            .alias("output"),
        )
    )


def restored(output: Column, form: Column) -> Column:
    """The text of an example, from its output and form alone.

    The parts hold no mark and none can arise across their ends, so the first mark
    of each kind is the one that was put there.
    """
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)"), F.lit("$2$3$1"))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def measured(examples: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lengths of prefix and middle, and digests of the output and the text read back."""
    output, form = F.col("output"), F.col("form")
    at = {mark: F.instr(output, F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(form == "psm", at[SUFFIX]).otherwise(at[MIDDLE]) - at[PREFIX] - len(PREFIX)
    middle = F.length(output) - at[MIDDLE] - len(MIDDLE) + 1
    shaped = form != "plain"
    return examples.select(
        key,
        "n",
        "form",
        F.when(shaped, prefix).cast("long").alias("prefix_chars"),
        F.when(shaped, middle).cast("long").alias("middle_chars"),
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(output, form).cast("binary"), 256).alias("restored_sha256"),
    )
