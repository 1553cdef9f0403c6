"""Time-varying curriculum: sources are mixed to target weights that change over the training run.

Each source has a weight at every knot of training time t in [0, 1]; between knots weights are linear, and at each
knot they sum to 1. A source's demand up to time t is T * (integral of its weight), T being the tokens of the whole
run. Its documents stand in a fixed random order; the one that begins at token offset c of the source is trained on
when demand reaches c, so its position is the inverse of the cumulative demand at c (a quadratic on each segment).
Documents are then range-sorted by position.

T is the least for which every source is used up once, so no document is lost; a source whose demand exceeds its
tokens begins again, and its documents occur once more for each further epoch.

Defined results: a null source is the source ''; a document without words counts as one token; rows without a doc_id
are dropped; repeated rows are documents of their own; ties in position are ordered by source, doc_id and epoch; an
empty table gives an empty result; other columns pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import is_small, materialize, read
from siteloom.llm.prefix import running_offsets, short_file, with_row, words_count

#: Weights at t=1: this part of them is proportional to the root of a source's tokens, the rest to its tokens.
FLATTEN = 0.5
SEED = "curriculum-1"
#: Keeps a position that is whole up to rounding errors from being one less.
EPSILON = 1e-6


def schedule(totals: DataFrame, weights: dict[str, list[float]] | None, knots: list[float]) -> tuple[DataFrame, float]:
    """The plan, a row a source (source, _tokens, _demand, and _sums and _w by knot), and T. Only sums over all sources come to the driver.

    Without own weights a source's go from its share of all tokens (t=0) to a flatter one (t=1).
    """
    every = totals.agg(F.sum("_tokens"), F.sum(F.sqrt("_tokens"))).first()
    total, roots = float(every[0] or 1), float(every[1] or 1)
    first = F.col("_tokens") / F.lit(total)
    last = F.lit(1 - FLATTEN) * F.col("_tokens") / F.lit(total) + F.lit(FLATTEN) * F.sqrt("_tokens") / F.lit(roots)
    line = F.array(*[first if t == 0 else last if t == 1 else first + (last - first) * F.lit(float(t)) for t in knots])
    if weights:
        given = totals.sparkSession.createDataFrame([(s, [float(x) for x in w]) for s, w in weights.items()], "source string, _given array<double>")
        totals = totals.join(given, "source", "left")
    plan = totals.withColumn("_w", F.coalesce("_given", line) if weights else line)
    sums = plan.agg(*[F.sum(F.get("_w", F.lit(k))) for k in range(len(knots))]).first()
    at = lambda k: F.get("_w", F.lit(k))
    plan = plan.withColumn("_w", F.array(*[at(k) / F.lit(sums[k] or 1.0) for k in range(len(knots))]))
    areas = [F.lit(float(knots[k + 1] - knots[k])) * (at(k) + at(k + 1)) / 2 for k in range(len(knots) - 1)]
    up_to = [F.lit(0.0)]
    for area in areas:
        up_to.append(up_to[-1] + area)
    plan = plan.withColumn("_area", up_to[-1])
    found = plan.agg(F.min("_area").alias("least"), F.max(F.col("_tokens") / F.col("_area")).alias("run")).first()
    if found.least is not None and found.least <= 0:
        raise ValueError("a source that has documents has no weight")
    run = float(found.run or 0.0)
    return plan.select("source", "_tokens", (F.lit(run) * F.col("_area")).alias("_demand"), F.array(*[F.lit(run) * x for x in up_to]).alias("_sums"), "_w"), run


def positions(docs: DataFrame, weights: dict[str, list[float]] | None = None, knots: list[float] | None = None, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """doc_id, source, n_tokens, epoch, position (and ``keep``) of every use of a document; not sorted.

    weights: by source, one for each of knots (ascending from 0 to 1; two by default); other sources have the default's.
    """
    counts = materialize(
        docs.where("doc_id IS NOT NULL").select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"),
            F.greatest(words_count(), F.lit(1)).alias("n_tokens"), *keep,
        ).withColumn("_shuffled", F.substring(F.md5(F.concat(F.lit(SEED), F.col("doc_id").cast("string"))), 1, 16)),
        "counts",
    )
    knots = [float(t) for t in knots or (0.0, 1.0)]
    totals = materialize(counts.groupBy("source").agg(F.sum("n_tokens").alias("_tokens")), "totals")
    plan, run = schedule(totals, weights, knots)
    plan = materialize(plan, "plan")
    placed = running_offsets(counts, ["_shuffled", "doc_id"], "n_tokens", ["source"])
    used = placed.join(F.broadcast(plan) if is_small(plan) else plan.hint("merge"), "source").select(
        "doc_id", "source", "n_tokens", "offset", "_tokens", "_sums", "_w", *keep,
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil((F.col("_demand") - F.col("offset")) / F.col("_tokens") - F.lit(1e-9)) - 1))).alias("epoch"),
    )
    at = (F.col("offset") + F.col("epoch") * F.col("_tokens")).cast("double")
    place = F.lit(None).cast("double")
    for k in range(len(knots) - 1):  # the last segment that has begun
        w, slope = F.get("_w", F.lit(k)), (F.get("_w", F.lit(k + 1)) - F.get("_w", F.lit(k))) / F.lit(knots[k + 1] - knots[k])
        r = (at - F.get("_sums", F.lit(k))) / F.lit(run or 1.0)
        root = w + F.sqrt(F.greatest(w * w + 2 * slope * r, F.lit(0.0)))
        here = F.lit(run) * (F.lit(knots[k]) + F.when(root > 0, 2 * r / root).otherwise(F.lit(0.0)))
        place = F.when((at >= F.get("_sums", F.lit(k))) & (F.lit(k == 0) | (F.get("_sums", F.lit(k + 1)) > F.get("_sums", F.lit(k)))), here).otherwise(place)
    return used.select("doc_id", "source", "n_tokens", "epoch", F.floor(place + EPSILON).alias("position"), *keep)


def mix(docs: DataFrame, weights: dict[str, list[float]] | None = None, knots: list[float] | None = None) -> DataFrame:
    """The rows of ``docs``, as often as they are used and range-sorted by position; the columns are those of ``docs``.

    The text is moved once, by the range sort: a row finds its positions by its place in the files, and the table of
    these is broadcast if it is small (else that join is a shuffle too).
    """
    rows = short_file(with_row(docs))
    named = rows.select(*[F.col(f"_doc.{c}").alias(c) for c in ("doc_id", "text", "source")], "_file", "_row")
    uses = materialize(positions(named, weights, knots, ["_file", "_row"]).select("_file", "_row", "position", "epoch"), "positions")
    joined = rows.join(F.broadcast(uses) if is_small(uses) else uses.hint("merge"), ["_file", "_row"])
    return joined.orderBy("position", "_doc.source", "_doc.doc_id", "epoch").select("_doc.*")


def op10_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training positions of all documents, in training order."""
    return positions(read(spark, sf_dir, "documents")).orderBy("position", "source", "doc_id", "epoch")


SQL = rf"""
WITH counts AS (
  SELECT doc_id, coalesce(source, '') AS source, greatest(len(regexp_extract_all(text, '[^ \t\n\r\f]+')), 1)::BIGINT AS n_tokens
  FROM documents
), totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM counts GROUP BY source),
every AS (SELECT sum(tokens)::DOUBLE AS total, sum(sqrt(tokens::DOUBLE)) AS roots FROM totals),
weights AS (
  SELECT source, tokens, tokens / total AS w0, {1 - FLATTEN}::DOUBLE * tokens / total + {FLATTEN}::DOUBLE * sqrt(tokens::DOUBLE) / roots AS w1
  FROM totals, every
), run AS (SELECT max(tokens / ((w0 + w1) / 2)) AS t FROM weights),
placed AS (
  SELECT *, (sum(n_tokens) OVER (PARTITION BY source ORDER BY substr(md5('{SEED}' || doc_id::VARCHAR), 1, 16), doc_id) - n_tokens)::BIGINT AS off
  FROM counts
), used AS (
  SELECT p.*, w.tokens, w0, w1, t,
    unnest(generate_series(0, greatest(0, ceil((t * (w0 + w1) / 2 - off) / w.tokens - 1e-9)::BIGINT - 1))) AS epoch
  FROM placed p JOIN weights w USING (source), run
), inverted AS (SELECT *, (off + epoch * tokens)::DOUBLE / t AS r FROM used)
SELECT doc_id, source, n_tokens, epoch::BIGINT AS epoch,
  floor(t * (2 * r / (w0 + sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * r, 0)))) + {EPSILON})::BIGINT AS position
FROM inverted
"""
