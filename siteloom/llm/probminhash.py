"""MinHash near-dedup by ProbMinHash: probability Jaccard of weighted shingles, banding, verification.

A document's shingles (runs of ``SHINGLE`` words, weighted by how often they occur) each send points of a Poisson process
of rate weight; every point falls into one of ``BANDS * ROWS`` registers at random and the register keeps the shingle
of its first arrival. A shingle stops once its next arrival is later than all registers' arrivals, which ends most
after one point. Two documents agree in a register with the probability Jaccard
    J(a, b) = sum over shared s of 1 / sum over t of max(a[t] / a[s], b[t] / b[s]).

Registers are grouped into bands. Exact copies (of the words) are one node, that of their least doc_id. In every band
bucket each node is compared with the bucket's least one (the hub). A node that fails this is compared with those nodes of
the bucket that are in another component after this step; pairs within a component need no test, as they can't change a
group, and a bucket that lies in one component drops out as a whole. So every pair of a bucket is either tested or joined,
no link is lost, and a hot bucket of copies costs no square of its size. What is left is the square of the components in a
bucket, of nodes that share a band with each other and are yet below the threshold. A pair is verified by its exact J over
the shingles. Groups are the components of the verified pairs.

Defined results: null and empty texts, and texts without words, are in no group; a text of fewer than ``SHINGLE`` words
is one shingle; repeated rows of one doc_id count as one document (that of the longest text in bytes); rows without a doc_id
are dropped by ``duplicates`` and kept by ``keep_one``; an empty table gives an empty result; other columns are
ignored or passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import U, Words, grams, is_small, materialize, mix, read, semi_filter, slices, texts

SHINGLE, BANDS, ROWS, THRESHOLD = 3, 24, 4, 0.5
#: Bytes of text that are turned into shingles at once.
PIECE = 1_000_000


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, hash and weight of the distinct shingles of each text, sorted by doc."""
    h = grams(w.hash, k)
    ok = w.doc[: len(h)] == w.doc[k - 1 :]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    extra = np.array([mix(np.bitwise_xor.reduce(mix(w.hash[w.first[i] : w.first[i + 1]] + np.arange(w.count[i], dtype=U)))[None])[0] for i in short], U)
    doc, h = np.concatenate((w.doc[: len(h)][ok], short)), np.concatenate((h[ok], extra))
    # Sorting by one mixed key finds equal (doc, shingle); the documents are brought together afterwards.
    key = h ^ mix(doc.astype(U))
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    weight = np.diff(np.append(new, len(key)))
    pick = order[new]
    back = np.argsort(doc[pick], kind="stable")
    return doc[pick][back], h[pick][back], weight[back]


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """ProbMinHash signatures (n_docs x m); all shingles of all documents take a step at a time."""
    first = np.full(n_docs * m, np.inf)
    held = np.zeros(n_docs * m, U)
    rate, at = 1.0 / weight, np.zeros(len(h))
    step = 0
    while len(h):
        step += 1
        r = mix(h + U(step * 0xA0761D6478BD642F % 2**64))
        at = at + -np.log(((r >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) * rate
        if step > 1 or len(h) > 4 * m:
            # A point after every register's arrival changes nothing, and neither does any later one of its shingle.
            late = first.reshape(n_docs, m).max(1)
            on = at < late[doc]
            doc, h, rate, at, r = doc[on], h[on], rate[on], at[on], r[on]
        register = doc * m + (mix(r) % U(m)).astype(np.int64)
        order = np.lexsort((at, register))
        reg, arrival, who = register[order], at[order], h[order]
        lead = np.flatnonzero(np.concatenate(([True], reg[1:] != reg[:-1]))) if len(reg) else np.empty(0, np.int64)
        reg, arrival, who = reg[lead], arrival[lead], who[lead]
        # Equal arrivals can't be told apart by time; the lesser shingle then wins.
        better = (arrival < first[reg]) | (arrival == first[reg]) & (who < held[reg])
        first[reg[better]], held[reg[better]] = arrival[better], who[better]
        late = first.reshape(n_docs, m).max(1)
        on = at < late[doc]
        doc, h, rate, at = doc[on], h[on], rate[on], at[on]
    return held.reshape(n_docs, m)


def probability_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Exact, from sorted shingle hashes and their weights."""
    shared, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    a, b = wa[i].astype(float), wb[j].astype(float)
    # A shingle of ratio q = b / a adds max(a[t] / a[s], b[t] / b[s]) = max(a[t], b[t] / q[s]) / a[s] over all t.
    q = b / a
    order = np.argsort(q)
    a, b, q = a[order], b[order], q[order]
    only_a, only_b = wa.sum() - a.sum(), wb.sum() - b.sum()
    low, high = np.searchsorted(q, q, "right"), len(q)
    sum_a = np.concatenate(([0.0], np.cumsum(a)))
    sum_b = np.concatenate(([0.0], np.cumsum(b)))
    # t of q[t] <= q[s] counts by a, of a larger one by b; what only one document has by its own weight.
    total = (only_a + sum_a[low]) / a + (only_b + sum_b[high] - sum_b[low]) / b
    return float((1.0 / total).sum())


def _which() -> list:
    """Which of several texts of a doc_id counts, when it is signed and when it is verified: the greatest (size, mark)."""
    return [F.octet_length("text").cast("long").alias("size"), F.xxhash64("text").alias("mark")]


def candidates(docs: DataFrame, shingle: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Copies (doc_id, node) of the same words, and bucket members (bucket, node) of buckets with several nodes."""
    m = bands * rows

    def sign(batches):
        for batch in batches:
            for part in slices(batch, limit=PIECE):
                w = Words(part.column("text"))
                if not len(w.hash):
                    continue
                rank = mix(np.arange(len(w.hash), dtype=U) - w.first[:-1].astype(U)[w.doc])
                ok = w.count > 0
                ones, twos = (np.add.reduceat(mix(w.hash ^ (rank + U(c))), w.first[:-1][ok]) for c in (1, 2))
                sig = signatures(*shingles(w, shingle), part.num_rows, m)[ok].reshape(-1, bands, rows)
                key = np.zeros(sig.shape[:2], U)
                for r in range(rows):
                    key = key * U(0xD6E8FEB86659FD93) + sig[:, :, r]
                key = mix(key + np.arange(bands, dtype=U))
                kept = part.column("doc_id").filter(pa.array(ok))
                bounds = pa.array(np.arange(len(key) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays([
                    kept, *(part.column(c).filter(pa.array(ok)) for c in ("size", "mark")), pa.array(ones.view(np.int64)), pa.array(twos.view(np.int64)), pa.array(w.count[ok].astype(np.int32)),
                    pa.ListArray.from_arrays(bounds, pa.array(key.reshape(-1).view(np.int64))),
                ], ["doc_id", "size", "mark", "one", "two", "n", "keys"])

    signed = materialize(docs.select("doc_id", "text", *_which()).mapInArrow(sign, "doc_id long, size long, mark long, one long, two long, n int, keys array<long>"), "signatures")
    # Of a repeated doc_id the longest text counts; of exact copies the least doc_id.
    nodes = (
        signed.groupBy("doc_id").agg(F.max(F.struct("size", "mark", "one", "two", "n", "keys")).alias("s")).select("doc_id", "s.*")
        .groupBy("one", "two", "n").agg(F.min(F.struct("doc_id", "keys")).alias("s"), F.collect_list("doc_id").alias("ids"))
    )
    nodes = materialize(nodes.select(F.col("s.doc_id").alias("node"), "s.keys", "ids"), "nodes")
    copies = nodes.where(F.size("ids") > 1).select("node", F.explode("ids").alias("doc_id"))
    members = nodes.select("node", F.explode("keys").alias("bucket"))
    # A bucket's least node is its hub; a hub alone is a bucket of one.
    hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("bucket", "hub")
    return copies, materialize(members.join(hubs, "bucket"), "buckets")


def verify(docs: DataFrame, pairs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Pairs (a, b) with their exact J, and whether it reaches the threshold. Only candidates' texts are moved.

    Texts go to their a's; a group of one a is streamed in the order (a first), so its size doesn't matter.
    """
    needed = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "needed")
    found = materialize(
        semi_filter(docs, needed, "doc_id").groupBy("doc_id").agg(F.max(F.struct(*_which(), "text")).alias("s")).select("doc_id", "s.text"),
        "candidates",
    )
    sides = (
        pairs.select("a", F.col("b").alias("doc_id")).union(pairs.select("a", F.col("a")).distinct()).join(found, "doc_id")
        .repartition("a").sortWithinPartitions("a", "doc_id")
    )

    def compare(batches):
        lead, own = None, None
        for batch in batches:
            for part in slices(batch, limit=PIECE):
                w = Words(part.column("text"))
                doc, h, weight = shingles(w, shingle)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                a, b, out = part.column("a").to_pylist(), part.column("doc_id").to_pylist(), []
                for i in range(part.num_rows):
                    s = slice(cut[i], cut[i + 1])
                    order = np.argsort(h[s])
                    this = h[s][order], weight[s][order]
                    if a[i] == b[i]:  # a sorts before its partners, whose ids are greater
                        lead, own = a[i], this
                    elif a[i] == lead:
                        out.append((a[i], b[i], probability_jaccard(*own, *this)))
                if out:
                    c = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.float64())], ["a", "b", "jaccard"])

    return materialize(sides.mapInArrow(compare, "a long, b long, jaccard double"), "verified").withColumn("same", F.col("jaccard") >= threshold)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the least node of its component.

    Hash-to-min with pointer jumping: each round every node takes the least root of its neighbours, then its root's
    root; a chain of n takes about log n rounds, each of which is written to the shared folder. A giant component's root is
    a hot key on one side of joins whose other side has one row for it, which adaptive skew joins split.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "roots")
    while True:
        near = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("near"))
        hooked = roots.join(near, roots.node == near.a).select("node", "root", F.least("root", "near").alias("new"))
        # A root takes the least root that any of its nodes has found.
        found = hooked.groupBy(F.col("root").alias("r")).agg(F.min("new").alias("best"))
        moved = hooked.join(found, hooked.root == found.r).select("node", "root", F.least("new", "best").alias("new"))
        jump = moved.select(F.col("node").alias("n"), F.col("new").alias("far"))
        after = materialize(moved.join(jump, moved.new == jump.n).select("node", F.col("root").alias("old"), F.least("new", "far").alias("root")), "roots")
        if after.where("old <> root").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")


def duplicates(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, keeper_id: each document that is a copy or a near copy, with its group's least doc_id, which is kept."""
    docs = texts(docs)
    copies, buckets = candidates(docs, shingle, bands, rows)
    stars = buckets.where("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    tested = verify(docs, materialize(stars, "pairs"), shingle, threshold)
    edges = tested.where("same").select("a", "b")
    roots = components(edges)
    failed = tested.where("NOT same").select(F.col("a").alias("hub"), F.col("b").alias("node"))
    if not failed.isEmpty():
        # Members with their components; buckets that lie in one component need nothing more.
        placed = buckets.join(roots, "node", "left").select("bucket", "hub", "node", F.coalesce("root", "node").alias("root"))
        several = placed.groupBy("bucket").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b").select("bucket")
        placed = materialize(placed.join(several, "bucket", "left_semi"), "placed")
        odd = placed.join(failed, ["hub", "node"], "left_semi").select("bucket", F.col("node").alias("x"), F.col("root").alias("x_root"))
        rest = odd.join(placed, "bucket").where("x_root <> root AND node <> hub").select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
        rest = materialize(rest.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not rest.isEmpty():
            more = verify(docs, rest, shingle, threshold).where("same").select("a", "b")
            if not more.isEmpty():
                roots = components(edges.union(more))
    linked = roots.withColumnRenamed("node", "doc_id")
    far = copies.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    # A node's own copies follow it to its root; the node itself is among them.
    every = linked.union(far).groupBy("doc_id").agg(F.min("root").alias("keeper_id"))
    return every.where("doc_id <> keeper_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that ``duplicates`` lists; its columns and other rows stay as they are."""
    gone = materialize(duplicates(docs, **options).select("doc_id"), "gone")
    return docs.join(F.broadcast(gone) if is_small(gone) else gone.hint("merge"), docs.doc_id == gone.doc_id, "left_anti")


def op6_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies and near copies of the whole table, each with the document of its group that stays."""
    return duplicates(read(spark, sf_dir, "documents"))
