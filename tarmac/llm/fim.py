"""Fill-in-the-middle forms of documents, by one match of a counted pattern per row.

A text is a sequence of units.  ``regexp_count`` says how many; a hash of the
document's id says after how many units the prefix and the middle end.  Then
one regular expression, made for the row, matches the whole text: ``unit{a}``
is the prefix, ``unit{b - a}`` the middle, what is left the suffix, and the
replacement text puts the three groups in the order of the row's form.  The
counted groups are possessive: the pattern never backtracks into them, and
Java's matcher then runs a counted group as a loop, so that its stack does not
grow with the text.

The work is a projection of JVM expressions; nothing is shuffled, and a row
depends on nothing but itself.

Defined cases: a null text is the empty text, whose form is plain, as is a
text that holds one of the markers; a null doc_id hashes as the empty id;
repeated rows come out as often as they went in; columns other than doc_id
and text are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: A run of ASCII letters, or any other single character.
UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _draw(seed: str, part: int) -> Column:
    """The ``part``-th 8-digit group of the hash of the id, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint")


def transform(docs: DataFrame, seed: str = "1", plain_from: int = 90, spm_below: int = 20,
              unit: str = UNIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, n, form, prefix_chars, middle_chars, output.

    Of 100 documents ``plain_from`` get a form, ``spm_below`` of 100 of those with the suffix first.
    """
    rows = docs.select(docs["doc_id"], text_of(docs).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("bigint"))
    h1, h2, h3, h4 = (F.pmod(_draw(seed, i), m) for i, m in enumerate(
        (F.col("n") + 1, F.col("n") + 1, F.lit(100), F.lit(100))))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (h3 >= plain_from)
    rows = rows.select("doc_id", "text", "n", F.least(h1, h2).alias("a"), F.greatest(h1, h2).alias("b"),
                       F.when(plain, "plain").when(h4 < spm_below, "spm").otherwise("psm").alias("form"))
    counted = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), counted(F.col("a")), counted(F.col("b") - F.col("a")), F.lit(r"(.*+)\z"))
    order = (F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
             .otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    cut = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.select("doc_id", "text", "n", "form", cut.alias("output"))
    prefix, _, middle = parts(F.col("output"), F.col("form"))
    size = lambda part: F.char_length(part).cast("bigint")
    return rows.select("doc_id", "text", "n", "form", size(prefix).alias("prefix_chars"),
                       size(middle).alias("middle_chars"), "output")


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """(prefix, suffix, middle) of an output; nulls if its form is plain.

    No part holds a marker, and none arises where a part meets a marker, so each is found by its first place.
    """
    p, s, m = (F.instr(output, F.lit(x)) for x in (PREFIX, SUFFIX, MIDDLE))

    def between(start: Column, marker: str, end: Column | None = None) -> Column:
        first = start + len(marker)
        return F.substr(output, first, end - first) if end is not None else F.substr(output, first)

    spm = form == "spm"
    prefix = F.when(spm, between(p, PREFIX, m)).when(form == "psm", between(p, PREFIX, s))
    suffix = F.when(spm, between(s, SUFFIX, p)).when(form == "psm", between(s, SUFFIX, m))
    return prefix, suffix, F.when(form != "plain", between(m, MIDDLE))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    prefix, suffix, middle = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and hashes of the output and of the text restored from it."""
    out = transform(docs, **options)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), d AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:], ''), '') AS suf
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
