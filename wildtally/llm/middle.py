"""Fill-in-the-middle: texts cut at two unit ends into prefix, middle and suffix, and written in another order.

One Arrow-batched pandas UDF. The regex library finds the units of a text; only their end offsets are kept, in a compact
array, so a text with many units costs four bytes each. Where to cut and in which form to write follows from a digest of
the document's id alone, so a lost task makes the same rows again.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import free_name, table

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Layout:
    """How texts are cut and written: the units' pattern, percentages of documents that are cut and, of these, written suffix first, the marks, and a seed."""

    unit: str = r"[^\n]*\n|[^\n]+"
    cut_percent: int = 100
    suffix_first_percent: int = 50
    prefix_mark: str = "<P>"
    suffix_mark: str = "<S>"
    middle_mark: str = "<M>"
    seed: int = 7

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix_mark, self.suffix_mark, self.middle_mark


def unit_ends(text: str, unit: regex.Pattern) -> array:
    """Where each unit ends, in code points."""
    return array("I", (m.end() for m in unit.finditer(text)))


def draws(doc_id: object, seed: int) -> list[int]:
    """Four numbers of 32 bits for a document (of an empty id if it is null)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearranged(text: str, doc_id: object, layout: Layout, unit: regex.Pattern) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle (None if plain), and the text as written."""
    ends = unit_ends(text, unit)
    n = len(ends)
    one, two, three, four = draws(doc_id, layout.seed)
    if not text or any(m in text for m in layout.marks) or three % 100 >= layout.cut_percent:
        return n, PLAIN, None, None, text
    few, more = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (few, more))
    before, middle, after = layout.prefix_mark + text[:a], text[a:b], layout.suffix_mark + text[b:]
    if four % 100 < layout.suffix_first_percent:
        return n, SPM, a, b - a, f"{after}{before}{layout.middle_mark}{middle}"
    return n, PSM, a, b - a, f"{before}{after}{layout.middle_mark}{middle}"


def restored(output: str, form: str, layout: Layout) -> str:
    """The text that was written in `form`: marks stand in no text that was cut, so each occurs once."""
    if form == PLAIN:
        return output
    head, _, middle = output.partition(layout.middle_mark)
    first, second = (layout.prefix_mark, layout.suffix_mark) if form == PSM else (layout.suffix_mark, layout.prefix_mark)
    one, _, two = head.removeprefix(first).partition(second)
    before, after = (one, two) if form == PSM else (two, one)
    return before + middle + after


def parts_of(doc_id: Column, text: Column, layout: Layout) -> Column:
    """struct<n, form, prefix_chars, middle_chars, output> of each text (null: empty)."""

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def work(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        unit = regex.compile(layout.unit)
        rows = [rearranged(t or "", i, layout, unit) for i, t in zip(ids, texts, strict=True)]
        frame = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"], dtype=object)
        return frame.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return work(doc_id.cast("string"), text)


def text_of(output: Column, form: Column, layout: Layout) -> Column:
    """The text that each output was made of."""

    @F.pandas_udf("string")
    def work(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restored(o, f, layout) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return work(output, form)


def fill_in_middle(docs: DataFrame, layout: Layout | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with fim_n (units), fim_form, fim_prefix_chars, fim_middle_chars and fim_output.

    A null or empty text and one that holds a mark is plain: written as it is (null: empty). Rows without an id are cut
    as that of an empty id; repeated rows come out alike; an empty table gives no rows; very long texts are cut whole.
    A column of `docs` that has one of these names stays, and the new one gets an underscore in front.
    """
    layout = layout or Layout()
    told = free_name(docs, "_fim")
    rows = docs.withColumn(told, parts_of(F.col(id_col), F.col(text_col), layout))
    names = {c: free_name(docs, f"fim_{c}") for c in ("n", "form", "prefix_chars", "middle_chars", "output")}
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{told}`.{c}").alias(n) for c, n in names.items()])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's rearranged text and of the text restored from it.

    Null and empty texts are plain with no units; repeated rows and rows without an id stay; an empty table gives no
    rows; other columns are not looked at.
    """
    layout = Layout()
    rows = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), layout)
    again = rows.withColumn("again", text_of(F.col("fim_output"), F.col("fim_form"), layout))
    return again.select(
        "doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_output", 256).alias("output_sha256"), F.sha2("again", 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents
), c AS (
  SELECT *, len(u) AS n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS r FROM d
), f AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS few, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS more,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c
), p AS (
  SELECT *, array_to_string(u[1 : few], '') AS a, array_to_string(u[few + 1 : more], '') AS b, array_to_string(u[more + 1 :], '') AS c FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || c || '<P>' || a || '<M>' || b ELSE '<P>' || a || '<S>' || c || '<M>' || b END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
