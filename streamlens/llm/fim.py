"""Fill-in-the-middle transformation by a counted-quantifier regex, in Spark expressions only.

A text is a run of units: white space followed by a word, or the white space left at its end. The units
are counted (``regexp_count``), two cuts a <= b among the n + 1 unit borders are drawn from a digest of
seed and id, and one replacement with a pattern made for the row, ``unit{a}`` and ``unit{b-a}`` possessive,
then the rest, catches prefix, middle and suffix in one match and puts them out in the row's order.
Possessive counts keep the regex engine iterative: it never goes back and its stack does not grow with
the number of units, however long the text.

Forms: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle), ``plain`` (text as it is): the text
is empty or holds a marker, or the draw says so.

Edge cases: a null text counts as empty (plain, no units, empty output); a null id draws as the empty
string; repeated rows give equal results; very long texts are one row's work, linear in their length; an
empty table gives an empty one. Columns of ``df`` with an output's name are replaced, all others stay.
One narrow pass: no shuffle, nothing kept, a lost task is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_WHITE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
UNIT = rf"(?:{_WHITE}*+{_WORD}++|{_WHITE}++)"
#: Output order of the groups 1 (prefix), 2 (middle) and 3 (suffix).
_ORDER = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def draws(row_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(df: DataFrame, row_id: str = "doc_id", text: str = "text", seed: int = 42, fim_percent: int = 50,
              spm_percent: int = 80, out: str = "output", form: str = "form", units: str = "n",
              prefix_chars: str = "prefix_chars", middle_chars: str = "middle_chars") -> DataFrame:
    """``df`` with the transformed text ``out``, its ``form``, the number of ``units`` and, unless plain, the
    code points of prefix and middle. ``fim_percent`` of the ids are transformed, ``spm_percent`` of those as spm."""
    h = draws(F.col(row_id), seed)
    body = F.coalesce(F.col(text), F.lit(""))
    made = {units, form, out, prefix_chars, middle_chars}
    own = "__fim"
    while own in df.columns:
        own += "_"
    # one struct per step, so that each step's expressions are evaluated once
    first = F.struct(body.alias("t"), F.regexp_count(body, F.lit(UNIT)).cast("long").alias("n"), *[x.alias(f"h{k}") for k, x in enumerate(h)])
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col(f"{own}.t"), F.lit(m))
    plain = (F.col(f"{own}.n") == 0) | (F.col(f"{own}.h2") % 100 >= fim_percent) | marked
    kind = F.when(plain, "plain").when(F.col(f"{own}.h3") % 100 < spm_percent, "spm").otherwise("psm")
    one, two = (F.col(f"{own}.h{k}") % (F.col(f"{own}.n") + 1) for k in (0, 1))
    a, b = F.least(one, two).cast("string"), F.abs(one - two).cast("string")
    pattern = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a, F.lit(rf"}}+)({UNIT}{{"), b, F.lit(r"}+)(.*)\z"))
    order = F.when(F.col(f"{own}.form") == "psm", _ORDER["psm"]).otherwise(_ORDER["spm"])
    got = (df.withColumn(own, first)
           .withColumn(own, F.struct(f"{own}.t", f"{own}.n", kind.alias("form"), pattern.alias("pattern")))
           .withColumn(own, F.struct(f"{own}.n", f"{own}.form", F.when(F.col(f"{own}.form") == "plain", F.col(f"{own}.t"))
                                     .otherwise(F.regexp_replace(F.col(f"{own}.t"), F.col(f"{own}.pattern"), order)).alias("out"))))
    text_out, is_psm, is_plain = F.col(f"{own}.out"), F.col(f"{own}.form") == "psm", F.col(f"{own}.form") == "plain"
    at_p, at_s, at_m = (F.instr(text_out, m) for m in (PREFIX, SUFFIX, MIDDLE))
    return got.select(
        *[c for c in df.columns if c not in made],
        F.col(f"{own}.n").alias(units), F.col(f"{own}.form").alias(form),
        F.when(~is_plain, F.when(is_psm, at_s - at_p - len(PREFIX)).otherwise(at_m - at_p - len(PREFIX))).cast("long").alias(prefix_chars),
        F.when(~is_plain, F.length(text_out) - at_m - len(MIDDLE) + 1).cast("long").alias(middle_chars),
        text_out.alias(out))


def restore(df: DataFrame, out: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """``df`` with the exact text rebuilt from a transformed text and its form. A marker stands once in a
    transformed text: no prefix, middle or suffix holds one, and none arises where they are joined. A null
    output or form counts as plain."""
    body, m = F.coalesce(F.col(out), F.lit("")), {k: F.instr(F.col(out), v) for k, v in (("p", PREFIX), ("s", SUFFIX), ("m", MIDDLE))}

    def between(start: Column, stop: Column) -> Column:
        return F.substring(body, start + len(PREFIX), stop - start - len(PREFIX))

    end = F.length(body) + 1
    middle = between(m["m"], end)
    psm = F.concat(between(m["p"], m["s"]), middle, between(m["s"], m["m"]))
    spm = F.concat(between(m["p"], m["m"]), middle, between(m["s"], m["p"]))
    back = F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(body)
    return df.withColumn(text, back)
