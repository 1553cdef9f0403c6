"""Concatenate and cut: documents become one stream of tokens that is cut into fixed windows.

Pass 1 counts tokens and sums them up by partition; pass 2 turns the prefix sums of these totals into each document's
global offset. Windows are then arithmetic: a document gives one boundary record to each window that it touches, and
no text is moved. A token is a run of anything but white space, and ``eos`` tokens end each document.

Defined results: a document without tokens (null, empty or blank text) isn't in the stream; rows without a doc_id are
dropped; repeated rows are packed as often as they occur, next to each other; the last window may be short and is
kept; an empty table has no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import materialize, read
from siteloom.llm.prefix import running_offsets, with_row, words_count

WINDOW, EOS = 2048, 1


def pieces(docs: DataFrame, window: int = WINDOW, eos: int = EOS, by_place: bool = False) -> DataFrame:
    """window_id, n_tokens (of the window), place, doc_id, doc_from, doc_to: a row a piece.

    doc_from and doc_to are token positions in the document (doc_to is exclusive; the eos token counts), place is the
    first one's position in the window. Documents follow each other by doc_id, or with ``by_place`` by file and row.
    """
    docs = with_row(docs).select(F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"), "_file", "_row") if by_place else docs
    order = ["_file", "_row"] if by_place else ["doc_id", "n_words"]
    counts = materialize(
        docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), words_count().alias("n_words"), *(order if by_place else [])),
        "tokens",
    ).where("n_words > 0").withColumn("n", F.col("n_words") + eos)
    total = counts.agg(F.sum("n")).first()[0] or 0
    first, last = F.col("offset"), F.col("offset") + F.col("n")
    begin, end = F.greatest("offset", F.col("window_id") * window), F.least(last, (F.col("window_id") + 1) * window)
    return running_offsets(counts, order, "n").select(
        "doc_id", "offset", "n", F.explode(F.sequence(F.floor(first / window), F.floor((last - 1) / window))).alias("window_id")
    ).select(
        "window_id", F.least(F.lit(window), F.lit(total) - F.col("window_id") * window).cast("long").alias("n_tokens"),
        (begin - F.col("window_id") * window).alias("place"), "doc_id", (begin - F.col("offset")).alias("doc_from"), (end - F.col("offset")).alias("doc_to"),
    )


def pack(docs: DataFrame, window: int = WINDOW, eos: int = EOS, by_place: bool = False) -> DataFrame:
    """window_id, n_tokens, n_pieces, doc_ids, and pieces (place, doc_id, doc_from, doc_to), by their place in the window.

    A window's pieces are at most as many as its tokens, so its list is bounded.
    """
    listed = pieces(docs, window, eos, by_place).groupBy("window_id", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "doc_from", "doc_to"))).alias("pieces"))
    return listed.select("window_id", "n_tokens", F.size("pieces").cast("long").alias("n_pieces"), F.transform("pieces", lambda p: p.doc_id).alias("doc_ids"), "pieces")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each piece of each window of the whole corpus."""
    return pieces(read(spark, sf_dir, "documents"))


SQL = rf"""
WITH counts AS (
  SELECT doc_id, len(regexp_extract_all(text, '[^ \t\n\r\f]+'))::BIGINT + {EOS} AS n FROM documents
), placed AS (
  SELECT doc_id, n, (sum(n) OVER (ORDER BY doc_id) - n)::BIGINT AS "offset" FROM counts WHERE n > {EOS}
), cut AS (
  SELECT *, unnest(generate_series("offset" // {WINDOW}, ("offset" + n - 1) // {WINDOW})) AS window_id FROM placed
), pieces AS (
  SELECT window_id, greatest("offset", window_id * {WINDOW}) - window_id * {WINDOW} AS place, doc_id,
    greatest("offset", window_id * {WINDOW}) - "offset" AS doc_from,
    least("offset" + n, (window_id + 1) * {WINDOW}) - "offset" AS doc_to
  FROM cut
)
SELECT window_id, (sum(doc_to - doc_from) OVER (PARTITION BY window_id))::BIGINT AS n_tokens, place, doc_id, doc_from, doc_to
FROM pieces
"""
