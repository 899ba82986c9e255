"""Fill-in-the-middle: a text is cut into prefix, middle and suffix by one regular expression per row.

A unit is a word with the white space before it, or the white space at the end
of the text.  ``regexp_count`` gives the number n of units.  A digest of seed and
id gives two cuts 0 <= a <= b <= n, and the row's own pattern
``(unit{a})(unit{b - a})(rest)`` takes all three parts in one match; the
replacement text puts them in their new order.  The quantifiers are possessive, so
the matcher walks through the units in a loop: no backtracking, no stack that
grows with the text.  Everything is a column expression; rows do not move.

Defined cases: NULL and empty texts are ``plain``, with n = 0; so is a text that
holds a marker, as it could not be restored; a NULL id counts as empty text in the
digest; texts of any length are cut whole; a text of white space alone is one
unit; equal rows get equal results, rows that repeat an id the same draws; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, WORDS

# The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Possessive, with the same matches as the plain form: a word cannot begin with white space.
UNIT = f"{SPACES[:-1]}*+{WORDS}+|{SPACES}+"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(id_: Column, seed: int, count: int = 4) -> list[Column]:
    """``count`` (at most 8) unsigned 32-bit numbers from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars, output of every row.

    ``percent`` of the texts are transformed, ``spm_percent`` of these to the order suffix, prefix, middle.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h = draws(F.col("doc_id"), seed)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = F.when((F.col("text") == "") | marked | (h[2] % 100 >= percent), PLAIN).when(h[3] % 100 < spm_percent, SPM).otherwise(PSM)
    cuts = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    rows = rows.select("*", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))

    def units(count: Column) -> Column:
        return F.concat(F.lit(f"((?:{UNIT}){{"), count.cast("string"), F.lit("}+)"))

    pattern = F.concat(F.lit(r"\A"), units(F.col("a")), units(F.col("b") - F.col("a")), F.lit(r"([\s\S]*+)\z"))
    order = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    plain = F.col("form") == PLAIN
    rows = rows.withColumn("output", F.when(plain, F.col("text")).otherwise(F.regexp_replace("text", pattern, order)))
    # The markers occur once each, so their places give the lengths of the parts.
    place = {m: F.instr("output", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == PSM, place[SUFFIX]).otherwise(place[MIDDLE])
    return rows.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.when(~plain, after_prefix - place[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
        F.when(~plain, F.length("output") - place[MIDDLE] - len(MIDDLE) + 1).cast("long").alias("middle_chars"),
        "output",
    )


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # before the first marker there is nothing
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(F.concat(parts[2], parts[3], parts[1]))
