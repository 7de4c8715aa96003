"""Fill-in-the-middle: a text is cut in three and rearranged by one match of a counted pattern.

``regexp_count`` gives a text's number of units (``n``); two numbers drawn from its id's digest give
the cuts ``a <= b``.  The row's own pattern ``(unit{a})(unit{b-a})(rest)``, with possessive counted
groups, captures prefix, middle and suffix in one match, and the replacement puts them in the
order of the row's form between the marks:

* ``psm``: mark P, prefix, mark S, suffix, mark M, middle;
* ``spm``: mark S, suffix, mark P, prefix, mark M, middle;
* ``plain``: the text as it is.

Possessive loops are iterative in the regex engine, so a text of any length needs no stack, and a
row's pattern has no way to match twice.  ``n`` is counted in blocks of ``BLOCK`` units and then in
single units of what is left, so the matches that the count makes are few whatever the length.
A unit is any pattern whose matches tile a text from its start (default: one code point); what
units leave over at the end is part of the suffix.  Everything is a built-in function, row by row:
no shuffle, nothing gathered.

Defined cases: a null text is empty; an empty text and one that holds a mark are plain; a null id
has an empty decimal form; equal ids draw equal numbers, so repeated rows give equal results; other
columns of the table take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = "(?s:.)"
MARKS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20
BLOCK = 1024


def unit_count(text: Column, unit: str = CODE_POINT, block: int = BLOCK) -> Column:
    """How many units follow one another from the start of ``text``."""
    many = f"(?:{unit}){{{block}}}+"
    rest = F.regexp_replace(text, F.lit(rf"\A(?:{many})*+"), F.lit(""))
    return (F.regexp_count(text, F.lit(rf"\G{many}")).cast("long") * block
            + F.regexp_count(rest, F.lit(rf"\G(?:{unit})")))


def _number(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits (from 0) as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be found again between any texts that hold none of them."""
    if len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for x in marks:
        for y in marks:
            if (x != y and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))):
                raise ValueError(f"marks {x!r} and {y!r} overlap")


def _arranged(groups: tuple[int, int, int], marks: tuple[str, ...]) -> str:
    """A replacement that puts each mark before its group."""
    return "".join(re.sub(r"([\\$])", r"\\\1", m) + f"${g}" for m, g in zip(marks, groups, strict=True))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", unit: str = CODE_POINT,
              marks: tuple[str, str, str] = MARKS, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_units, middle_units (null if plain), output.

    ``marks`` are those before prefix, suffix and middle.  Of a hundred, numbers from ``plain_from`` on
    leave a text plain, and of the others those below ``spm_below`` put the suffix first.
    """
    _check_marks(marks)
    p, s, m = marks
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.sha2(key.cast("binary"), 256).alias("digest"), unit_count(text, unit).alias("n"))
    one, two = (F.pmod(_number(F.col("digest"), k), F.col("n") + 1) for k in (0, 1))
    marked = F.greatest(*(F.contains(F.col("text"), F.lit(x)) for x in marks))
    plain = (F.col("n") == 0) | marked | (_number(F.col("digest"), 2) % 100 >= plain_from)
    form = F.when(plain, "plain").when(_number(F.col("digest"), 3) % 100 < spm_below, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    pattern = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), F.col("a"), F.lit(rf"}}+)((?:{unit}){{"), F.col("b") - F.col("a"),
                       F.lit(r"}+)(.*+)\z"))
    order = (F.when(F.col("form") == "psm", F.lit(_arranged((1, 3, 2), (p, s, m))))
             .otherwise(F.lit(_arranged((3, 1, 2), (s, p, m)))))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("a")).alias("prefix_units"),
                       F.when(cut, F.col("b") - F.col("a")).alias("middle_units"),
                       F.when(cut, F.regexp_replace(F.col("text"), pattern, order)).otherwise(F.col("text")).alias("output"))


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transform`` was given, from its output and form."""
    p, s, m = (re.escape(x) for x in marks)

    def rebuilt(first: str, second: str, replacement: str) -> Column:
        return F.regexp_replace(output, F.lit(rf"(?s)\A{first}(.*?){second}(.*?){m}(.*+)\z"), F.lit(replacement))

    return (F.when(form == "psm", rebuilt(p, s, "$1$3$2")).when(form == "spm", rebuilt(s, p, "$2$3$1"))
            .otherwise(output))
