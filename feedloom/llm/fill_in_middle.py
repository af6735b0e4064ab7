"""Fill-in-middle transformation by one repeated-capture match.

A text is cut into units (a run of ASCII letters, or any other code point).  One
``regex`` fullmatch of ``(unit)*`` keeps every repetition of its group, so
``match.ends(1)`` holds the end of each unit: its length is the number of units,
and the offset after k units is its (k - 1)th value.  No text is iterated over.

Two cuts, drawn from the SHA-256 of the id, part the text into prefix, middle and
suffix; the form (plain, psm or spm) is drawn from the same digest.  A text that is
empty or holds a marker stays plain, so a marker in an output is always a cut, and
``restored`` gives the exact text back from output and form alone.

The match keeps two offsets a unit: about 100 bytes for a code point of the longest
text that a task holds at once.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text

#: Possessive, as neither part of a unit ever has to give a character back.
UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
#: Of 100 documents these stay plain; of 100 others these are suffix first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = "1:"
#: Texts that are matched and written at a time.
ROWS = 256


def draws(doc_id, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of an id (null: the seed's alone)."""
    d = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(d[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform(doc_id, text: str | None, plain_percent: int = PLAIN_PERCENT,
              spm_percent: int = SPM_PERCENT, seed: str = SEED):
    """(n, form, prefix length, middle length, output) of one text."""
    text = text or ""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= 100 - plain_percent or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
                   seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts units, the lengths count code points and are null where the form
    is plain.  Null texts count as empty; a null id draws from the seed alone; rows
    that repeat an id draw alike.  Repeated rows stay rows; other columns are
    ignored; an empty table gives an empty table.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                ids = b.column(0).to_pylist()
                rows = [transform(i, t, plain_percent, spm_percent, seed)
                        for i, t in zip(ids, b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip((ids, *zip(*rows)), types)], names=names)

    return (docs.select(F.col(doc_id).cast("long"), clean_text(text))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, "
                             "middle_chars long, output string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of a form was made from."""
    out, cut = F.col(output), F.substring_index

    def after(start: str) -> Column:
        return cut(out, start, -1)

    def between(start: str, end: str) -> Column:
        return cut(after(start), end, 1)

    middle = after(MIDDLE)
    return (F.when(F.col(form) == "psm",
                   F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(F.col(form) == "spm",
                  F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(out))


#: DuckDB SQL of the query.
FIM_SQL = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), r AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM u
), f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS first, greatest(h1 % (n + 1), h2 % (n + 1)) AS last FROM r
), p AS (
  SELECT *, array_to_string(units[1:first], '') AS a, array_to_string(units[first + 1:last], '') AS b,
         array_to_string(units[last + 1:], '') AS c FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
              ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
