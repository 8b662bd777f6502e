"""Boilerplate lines: those that stand on too large a share of a site's pages go.

Per host, the number of distinct pages with a line is divided by the host's distinct pages.
The share that makes a line boilerplate falls with the square of its words: a word or two come
back by chance on many pages, a sentence or a paragraph on hardly any, however large the host.
Exact copies of a page count once, so a much copied page is not taken for boilerplate (its
copies are the near-duplicate operator's work).  All of it is DataFrame functions; the text
itself is shuffled once at most, to put the result together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: A line of one word on more than this share of a host's pages is boilerplate, one of w words
#: on more than this share divided by w^2 ...
RATIO = 0.05
#: ... if that many pages have it at least; else every line of a one-page host would be.
MIN_PAGES = 5


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _words(line: Column) -> Column:
    return F.greatest(F.size(F.regexp_extract_all(line, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(1)).cast("long")


def boilerplate_lines(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """From (host, page, text): the boilerplate of each host as (host, line), line a
    digest, and the lines of all pages as (host, page, line, words), each once for a page."""
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""))).alias("line"))
    lines = lines.select("host", "page", _digest(F.col("line")).alias("line"), _words(F.col("line")).alias("words"))
    totals = pages.filter("page is not null").select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    # Distinct by page first, then partial counts: a line on a third of all pages meets
    # nowhere as rows.
    found = lines.distinct().groupBy("host", "line", "words").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    too_many = found.join(totals, "host").filter(F.col("n") * F.col("words") * F.col("words") > F.lit(ratio) * F.col("pages"))
    return too_many.select("host", "line"), lines


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows and columns of ``docs`` with boilerplate lines taken out of the text, plus
    ``n_lines`` and ``n_dropped``.

    Defined cases: a null text stays null with 0 lines; an empty text is one blank line.
    Blank lines are never boilerplate and stay.  Rows without a host make up a host of their
    own.  A line that stands several times on a page counts once, and all of it goes.  Lines
    at exactly their ratio stay.  Repeated rows stay repeated.  A page whose every line is
    boilerplate keeps its row, with its blank lines or an empty text.  Columns called
    n_lines or n_dropped are replaced; others are kept as they are."""
    docs = docs.drop("n_lines", "n_dropped")
    host, page, drop = fresh(docs, "host_key"), fresh(docs, "page_key"), fresh(docs, "drop_lines")
    marked = docs.withColumns({
        host: F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")),
        page: _digest(F.col(text_col)),
    })
    boilerplate, lines = boilerplate_lines(marked.select(F.col(host).alias("host"), F.col(page).alias("page"), F.col(text_col).alias("text")), ratio, min_pages)
    drops = lines.join(boilerplate, ["host", "line"]).groupBy(F.col("host").alias(host), F.col("page").alias(page)).agg(F.collect_set("line").alias(drop))
    joined = marked.join(drops, [host, page], "left")
    kept = F.filter(_lines(F.col(text_col)), lambda x: ~F.array_contains(F.col(drop), _digest(x)))
    hit = F.col(drop).isNotNull()
    # size() of null is -1 or null by setting, so nulls are asked for first
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(_lines(F.col(text_col))))
    return joined.withColumns({
        "n_lines": n_lines.cast("long"),
        "n_dropped": F.when(hit, n_lines - F.size(kept)).otherwise(F.lit(0)).cast("long"),
        text_col: F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(text_col)),
    }).select(*docs.columns, "n_lines", "n_dropped")


def oracle_sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """The result of drop_boilerplate() over ``documents``, for DuckDB."""
    return rf"""
WITH line_rows AS (
  SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM documents
), share AS (
  SELECT source, line, count(*) AS n, greatest(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')), 1) AS words
  FROM line_rows WHERE trim(line) <> '' GROUP BY ALL
), site AS (
  SELECT source, count(DISTINCT text) AS pages FROM documents GROUP BY ALL
), boiler AS (
  SELECT share.source, list(line) AS bad
  FROM share JOIN site ON share.source IS NOT DISTINCT FROM site.source
  WHERE n >= {min_pages} AND n * words * words > {ratio} * pages GROUP BY ALL
), parts AS (
  SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS all_lines,
         list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), x)) AS good
  FROM documents d LEFT JOIN boiler ON d.source IS NOT DISTINCT FROM boiler.source
)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN array_to_string(good, chr(10)) END AS text,
       coalesce(len(all_lines), 0) AS n_lines, coalesce(len(all_lines) - len(good), 0) AS n_dropped
FROM parts"""
