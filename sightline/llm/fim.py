"""Fill-in-middle transformation by counted-quantifier patterns (operator 13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SECTIONS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"


def _draws(doc_id: str, seed: int) -> list[Column]:
    """Four numbers of 32 bits hashed from the document's id."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, rate: int = 100, spm_rate: int = 50, seed: int = 7, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars and output to ``docs``.

    A text is cut into its n lines, each with its newline.  Two draws from the id say after which
    lines prefix and middle end; a third sends ``rate`` percent of the documents through the
    transformation and a fourth lays ``spm_rate`` percent of these out as spm (suffix first), the
    others as psm.  The draws set the counts of a pattern of the row's own, whose possessive groups
    take so many lines each without stepping back, and one match of it rewrites the text.

    Plain, that is unchanged and with null lengths, are documents that the third draw leaves out,
    texts that hold a section mark themselves and null or empty texts (n 0, output empty).  A null id
    draws as an empty one; rows that repeat an id are cut by the same draws.  All columns stay; one
    named like an added column is replaced.
    """
    h1, h2, h3, h4 = _draws(doc_id, seed)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumns({"_text": body, "_h1": h1, "_h2": h2, "_h3": h3, "_h4": h4})
    rows = rows.withColumn("_n", F.regexp_count("_text", F.lit(UNIT)).cast("long"))
    one, two = F.pmod("_h1", F.col("_n") + 1), F.pmod("_h2", F.col("_n") + 1)
    rows = rows.withColumns({"_a": F.least(one, two), "_b": F.greatest(one, two)})
    plain = (F.col("_text") == "") | F.col("_text").rlike(_SECTIONS) | (F.col("_h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm_rate, "spm").otherwise("psm")
    lines = lambda count: F.concat(F.lit(f"((?:{UNIT}){{"), count.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), lines(F.col("_a")), lines(F.col("_b") - F.col("_a")), F.lit("(.*+)"))
    layout = F.when(F.col("_form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    rows = rows.withColumn("_form", form)
    moved = F.when(F.col("_form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", pattern, layout))
    rows = rows.withColumn("_output", moved)
    # the marks part the output: "", then the sections in their order
    prefix, middle, _ = _sections("_output", "_form")
    cut = F.col("_form") != "plain"
    return rows.withColumns({
        "n": F.col("_n"), "form": F.col("_form"),
        "prefix_chars": F.when(cut, F.length(prefix)).cast("long"),
        "middle_chars": F.when(cut, F.length(middle)).cast("long"),
        "output": F.col("_output"),
    }).drop("_text", "_h1", "_h2", "_h3", "_h4", "_n", "_a", "_b", "_form", "_output")


def _sections(output: str, form: str) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output that is not plain."""
    pieces = F.split(output, _SECTIONS)
    spm = F.col(form) == "spm"
    return F.when(spm, pieces[2]).otherwise(pieces[1]), pieces[3], F.when(spm, pieces[1]).otherwise(pieces[2])


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that an output of the given form was made from."""
    prefix, middle, suffix = _sections(output, form)
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(prefix, middle, suffix))


def fim_digest(docs: DataFrame) -> DataFrame:
    """One row per document with digests of its output and of the text restored from it."""
    done = fill_in_middle(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(), 256).alias("restored_sha256"),
    )
