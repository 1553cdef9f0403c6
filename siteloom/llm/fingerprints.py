"""Document fingerprints: prefix polynomial hashes.

H[i] = sum of c[j] * B**j over j < i, c being code points, modulo two primes under 2**31. From the prefix arrays any
two spans can be compared at once (after multiplying by the power of B that lines them up), and the longest common
extension of two positions is found by binary search (``Prefixes``). ``fingerprints`` gives each document the hash of its
whole text, and the longest extension that its begin, and its end read backwards, have in common with any document of a
smaller id; extensions under ``LEAD`` characters are none, unless they are the whole text.

Copies of a text are one text, that of their least doc_id. Of texts whose first ``LEAD`` characters another one has, too, a
range-partitioned sort by text is made; in this order the extension of any two texts is the least of those between
neighbours, so only neighbours are compared and a tree of them (``Tree``) has every text's answer: the least id in the
deepest node that holds a smaller one. No group, of whatever size, is held in a task: a partition is streamed, with a
stack as its state, and partitions are joined by their summaries (for each extension of their first or last text the
least id that has it), which are at most as long as a text and are summed up from both sides.

Defined results: a null text is an empty one, whose hash is 0 and which has no partner; of several documents with the
longest extension the least id is the partner; repeated rows of a doc_id are no partners of each other; rows without a
doc_id are dropped; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import KEPT, U, buffers, is_small, materialize, read, shuffles, slices, texts

PRIMES = (U(2147483647), U(2147483629))
BASES = (U(1103515245), U(1664525927))
LEAD = 64
#: Characters of a text that the ranges of the sort are made of; texts that agree in more are in one partition, where they are streamed.
RANGE_KEY = 4096
#: Texts of a partition that the ranges are made from; they come to the driver, cut to ``RANGE_KEY``.
RANGE_SAMPLE = 20
#: Bytes of text that are turned into prefix arrays at once.
PIECE = 1_500_000


def _powers(k: int, n: int) -> np.ndarray:
    have = KEPT.get(("prime", k))
    if have is None or len(have) < n:
        have, step = np.ones(1, U), BASES[k]  # step is B ** len(have)
        while len(have) < n:
            have = np.concatenate((have, have * step % PRIMES[k]))
            step = step * step % PRIMES[k]
        KEPT["prime", k] = have
    return have


class Prefixes:
    """Prefix arrays of a column of texts. Positions are code points of the texts one after the other; text i has start[i] .. start[i + 1]."""

    def __init__(self, column: pa.Array):
        offsets, raw = buffers(column)
        whole = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=whole[1:])
        self.start = whole[offsets]
        code = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        length = np.diff(self.start)
        self.within = np.arange(len(code)) - np.repeat(self.start[:-1], length)
        self.longest = int(length.max(initial=0)) + 1
        self.sums = []
        for k in (0, 1):
            s = np.zeros(len(code) + 1, U)
            np.cumsum(code * _powers(k, self.longest)[self.within] % PRIMES[k], out=s[1:])
            self.sums.append(s)

    def span(self, k: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the spans, still multiplied by B ** (begin's place in its text)."""
        return (self.sums[k][end] - self.sums[k][begin]) % PRIMES[k]

    def fingerprint(self) -> np.ndarray:
        """Of each text."""
        begin, end = self.start[:-1], self.start[1:]
        return (self.span(0, begin, end) << U(31) | self.span(1, begin, end)).astype(np.int64)

    def equal(self, i: np.ndarray, other: Prefixes, j: np.ndarray, n: np.ndarray, at_i: np.ndarray, at_j: np.ndarray) -> np.ndarray:
        """Whether the n characters from i here and from j in ``other`` agree; at_i and at_j are their places in their texts."""
        same = np.ones(len(i), bool)
        for k in (0, 1):
            p = _powers(k, max(int(at_i.max(initial=0)), int(at_j.max(initial=0))) + 1)
            same &= self.span(k, i, i + n) * p[at_j] % PRIMES[k] == other.span(k, j, j + n) * p[at_i] % PRIMES[k]
        return same

    def extension(self, other: Prefixes, at: np.ndarray | int = 0, other_at: np.ndarray | int = 0, rows: np.ndarray | None = None, other_rows: np.ndarray | None = None) -> np.ndarray:
        """Longest common extension of position ``at`` in each text (or those of ``rows``) and ``other_at`` in the text of the same row (or of ``other_rows``) of ``other``."""
        rows = np.arange(len(self.start) - 1) if rows is None else rows
        other_rows, n = rows if other_rows is None else other_rows, len(rows)
        at, other_at = np.broadcast_to(at, n), np.broadcast_to(other_at, n)
        i, j = self.start[rows] + at, other.start[other_rows] + other_at
        low, high = np.zeros(n, np.int64), np.maximum(0, np.minimum(self.start[rows + 1] - i, other.start[other_rows + 1] - j))
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(i, other, j, half, at, other_at)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


class Tree:
    """Nodes of texts that come in order: ``add`` a text with its extension with the one before, ``finish`` at the end; ``found`` gets what is known.

    A text is (id, length, what to hand on); without a length it only stands for others. found: (what, partner, extension,
    partner of its copies); the partner is None where there is none, that of copies is the least id of the texts that begin with it.
    """

    def __init__(self):
        self.stack: list = []  # nodes that are open: [extension, least id, texts that have no smaller id yet]
        self.found: list = []

    def _close(self, to: int) -> None:
        """Close what is deeper than ``to``; the last node closed is of this depth then, or hangs in one."""
        while self.stack and self.stack[-1][0] > to:
            depth, least, waiting = self.stack.pop()
            open_ = []
            for text in waiting:
                if text[1] == depth:
                    text[3] = least
                if text[0] > least:
                    self.found.append((text[2], least, depth, text[3]))
                else:
                    open_.append(text)
            if self.stack and self.stack[-1][0] >= to:
                under = self.stack[-1]
                under[1] = min(under[1], least)
                under[2] += open_
            elif to > 0:
                self.stack.append([to, least, open_])
            else:
                self.found += [(text[2], None, None, text[3]) for text in open_]

    def add(self, id_: int, length: int | None, what, common: int) -> None:
        self._close(common)
        # A text that others go on from hangs in a node of its own length.
        self.stack.append([length if length is not None else 1 << 60, id_, [[id_, length, what, id_]]])

    def finish(self) -> list:
        self._close(0)
        out, self.found = [x for x in self.found if x[0] is not None], []
        return out


def _least(steps: list[tuple[int, int]], cap: int, floor: int) -> list[tuple[int, int]]:
    """(extension, least id that has it or more), ascending in both: what a stretch of texts offers to one that has ``cap`` in common with its edge."""
    best: dict[int, int] = {}
    for length, id_ in steps:
        length = min(length, cap)
        if length >= floor and best.get(length, id_) >= id_:
            best[length] = id_
    out: list[tuple[int, int]] = []
    for length in sorted(best, reverse=True):
        if not out or best[length] < out[-1][1]:
            out.append((length, best[length]))
    return out[::-1]


def _edges(parts: list, joints: dict[int, int], floor: int) -> list[tuple[int, list, list]]:
    """(part, steps before it, steps behind it), from each part's (part, whole, left, right) and the extension across the joint behind it."""
    before, behind, carried = {}, {}, []
    for i, (part, _, _, _) in enumerate(parts):
        if i:
            last, whole, _, right = parts[i - 1]
            carried = _least(_least(carried, whole, floor) + right, joints[last], floor)
        before[part] = carried
    carried = []
    for i in range(len(parts) - 1, -1, -1):
        part = parts[i][0]
        if i + 1 < len(parts):
            _, whole, left, _ = parts[i + 1]
            carried = _least(_least(carried, whole, floor) + left, joints[part], floor)
        behind[part] = carried
    return [(part, before[part], behind[part]) for part, *_ in parts]


_PLACED = "part int, seq long, first long, n_chars long, mark long, common long, edge string, whole long, lefts array<struct<l: long, i: long>>, rights array<struct<l: long, i: long>>"
_STEPS = pa.list_(pa.struct([("l", pa.int64()), ("i", pa.int64())]))


def _placed(batches, lead: int):
    """Of a sorted partition: a row a text with its extension with the text before, and a summary at the end."""
    part, seq, last, last_id = TaskContext.get().partitionId(), 0, None, None
    whole, left, right = 1 << 60, [], []
    for batch in batches:
        for piece in slices(batch, limit=PIECE):
            column = piece.column("text")
            joined = column if last is None else pa.concat_arrays([pa.array([last], column.type), column])
            p = Prefixes(joined)
            n = len(joined)
            common = p.extension(p, rows=np.arange(1, n), other_rows=np.arange(n - 1))
            common = np.concatenate(([0], common)) if last is None else common
            length = np.diff(p.start)[n - piece.num_rows :]
            ids = piece.column("doc_id").to_pylist()
            keep = np.ones(len(ids), bool)
            for k, (id_, c, size) in enumerate(zip(ids, common.tolist(), length.tolist())):
                if id_ == last_id and c == size == last_size:
                    keep[k] = False  # the same row again
                    continue
                c = c if c >= lead else 0
                if seq + k == 0:
                    left.append((size, id_))
                else:
                    whole = min(whole, c)
                    if whole and id_ < left[-1][1]:
                        left[-1:] = [(whole, id_)] if left[-1][0] == whole else [left[-1], (whole, id_)]
                    while right and right[-1][0] > c:
                        _, least = right.pop()
                        if right and right[-1][0] >= c:
                            right[-1] = (right[-1][0], min(right[-1][1], least))
                        else:
                            right.append((c, least))
                right.append((size, id_))
                last_id, last_size = id_, size
            edge = [column[0].as_py() if seq == 0 else None] + [None] * (len(ids) - 1)
            m = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, part, np.int32)), pa.array(np.arange(seq, seq + m)), piece.column("doc_id"), pa.array(length), piece.column("mark"),
                pa.array(np.where(common >= lead, common, 0)), pa.array(edge, pa.string()), pa.nulls(m, pa.int64()), pa.nulls(m, _STEPS), pa.nulls(m, _STEPS),
            ], names=[x.split()[0] for x in _PLACED.split(", ")[:7]] + ["whole", "lefts", "rights"]).filter(pa.array(keep))
            seq += m
            last = column[-1].as_py()
    if last is not None:
        steps = lambda s: pa.array([[{"l": a, "i": b} for a, b in s]], _STEPS)
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([-1], pa.int64()), none, none, none, none, pa.array([last], pa.string()), pa.array([whole], pa.int64()),
            steps(_least(left, 1 << 60, lead)), steps(_least(right, 1 << 60, lead)),
        ], names=[x.split()[0] for x in _PLACED.split(", ")[:7]] + ["whole", "lefts", "rights"])


def _joint(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            a, b = (Prefixes(batch.column(c).slice(i, 1)) for c in ("last", "next"))
            yield pa.RecordBatch.from_arrays([batch.column("part").slice(i, 1), pa.array(a.extension(b))], ["part", "common"])


def _resolved(batches):
    """Of rows by (part, seq): each text's partner and extension."""
    tree, part = Tree(), None
    schema = pa.schema([("first", pa.int64()), ("mark", pa.int64()), ("partner", pa.int64()), ("extension", pa.int64()), ("copied", pa.int64())])

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array([f(x) for x in found], pa.int64()) for f in (lambda x: x[0][0], lambda x: x[0][1], lambda x: x[1], lambda x: x[2], lambda x: x[3])], schema=schema)

    for batch in batches:
        found = []
        for p, id_, size, mark, common in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "n_chars", "mark", "common"))):
            if p != part:
                found += tree.finish()
                part = p
            tree.add(id_, size, (id_, mark) if size is not None else None, common)
        found += [x for x in tree.found if x[0] is not None]
        tree.found = []
        yield out(found)
    yield out(tree.finish())


def shared(sides: DataFrame, lead: int = LEAD) -> DataFrame:
    """first, mark, partner, extension, copied of distinct texts: sides has doc_id, text, mark."""
    spark = sides.sparkSession
    key = F.substring("text", 1, RANGE_KEY)
    laid = sides.repartitionByRange(shuffles(spark), key).sortWithinPartitions("text", "doc_id")
    setting = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), RANGE_SAMPLE)))
    try:
        placed = materialize(laid.mapInArrow(lambda b: _placed(b, lead), _PLACED), "placed")
    finally:
        spark.conf.set(setting, before)
    # A row a partition, of numbers: at most as many as a text has characters, in practice a few.
    parts = [(r.part, r.whole, [tuple(x) for x in r.lefts], [tuple(x) for x in r.rights]) for r in placed.where("seq = -1").select("part", "whole", "lefts", "rights").orderBy("part").collect()]
    follows = spark.createDataFrame([(a[0], b[0]) for a, b in zip(parts, parts[1:])], "part int, after int")
    last = placed.where("seq = -1").select("part", F.col("edge").alias("last"))
    begin = placed.where("seq = 0").select(F.col("part").alias("after"), F.col("edge").alias("next"))
    joints = follows.join(last, "part").join(begin, "after").select("part", "last", "next").mapInArrow(_joint, "part int, common long").collect() if len(parts) > 1 else []
    joints = {r.part: r.common if r.common >= lead else 0 for r in joints}
    stand = []
    for part, earlier, behind in _edges(parts, joints, lead):
        # They stand for all texts before and behind: the extension between two of them is that of the farther one.
        commons = [0] + [length for length, _ in earlier[:-1]]
        stand += [(part, k - len(earlier), id_, None, None, c) for k, ((_, id_), c) in enumerate(zip(earlier, commons))]
        stand += [(part, (1 << 60) + k, id_, None, None, length) for k, (length, id_) in enumerate(behind[::-1])]
        if earlier:
            stand.append((part, None, None, None, None, earlier[-1][0]))  # the first text's own extension with what is before
    pseudo = spark.createDataFrame([x for x in stand if x[1] is not None], "part int, seq long, first long, n_chars long, mark long, common long")
    heads = spark.createDataFrame([(x[0], x[5]) for x in stand if x[1] is None], "part int, head long")
    rows = placed.where("seq >= 0").join(F.broadcast(heads), "part", "left").select(
        "part", "seq", "first", "n_chars", "mark", F.when((F.col("seq") == 0) & F.col("head").isNotNull(), F.col("head")).otherwise(F.col("common")).alias("common")
    )
    return rows.union(pseudo).repartition("part").sortWithinPartitions("part", "seq").mapInArrow(_resolved, "first long, mark long, partner long, extension long, copied long")


def fingerprints(docs: DataFrame, lead: int = LEAD) -> DataFrame:
    """doc_id, n_chars, fingerprint; prefix_id and prefix_length, suffix_id and suffix_length (null without a partner): one row a document."""
    docs = texts(docs).withColumn("mark", F.xxhash64("text"))

    def hashes(batches):
        for batch in batches:
            for piece in slices(batch, limit=PIECE):
                p = Prefixes(piece.column("text"))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("doc_id", "mark", "lead", "tail")), pa.array(np.diff(p.start)), pa.array(p.fingerprint())], ["doc_id", "mark", "lead", "tail", "n_chars", "fingerprint"])

    long_enough = F.length("text") >= lead
    cut = docs.withColumns({"lead": F.when(long_enough, F.xxhash64(F.substring("text", 1, lead))), "tail": F.when(long_enough, F.xxhash64(F.substring("text", -lead, lead)))})
    kept = materialize(cut.mapInArrow(hashes, "doc_id long, mark long, lead long, tail long, n_chars long, fingerprint long"), "fingerprints")
    same = ["fingerprint", "mark", "n_chars"]
    distinct = kept.where("n_chars > 0").groupBy(*same).agg(F.min("doc_id").alias("first"), F.min("lead").alias("lead"), F.min("tail").alias("tail"))
    distinct = materialize(distinct, "distinct")
    answers = None
    for name, key in (("prefix", "lead"), ("suffix", "tail")):
        # Texts whose key is a single one's stay where they are. Equal hashes of other characters only let a text take part in vain.
        groups = distinct.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
        chosen = materialize(distinct.join(groups, key, "left_semi").select(F.col("first").alias("doc_id"), "mark"), "chosen")
        text = F.col("text") if name == "prefix" else F.reverse("text")
        sides = docs.join(F.broadcast(chosen) if is_small(chosen) else chosen.hint("merge"), ["doc_id", "mark"]).select("doc_id", text.alias("text"), "mark")
        found = materialize(shared(sides, lead), "shared").select("first", "mark", F.col("partner").alias(f"_{name}_id"), F.col("extension").alias(f"_{name}"), F.col("copied").alias(f"_{name}_copied"))
        answers = found if answers is None else answers.join(found, ["first", "mark"], "full")
    answers = materialize(answers, "answers")
    every = kept.join(F.broadcast(distinct.select(*same, "first")) if is_small(distinct) else distinct.select(*same, "first").hint("merge"), same, "left")
    own = F.col("doc_id") == F.col("first")
    columns = []
    for name in ("prefix", "suffix"):
        columns += [
            F.when(own, F.col(f"_{name}_id")).otherwise(F.coalesce(f"_{name}_copied", "first")).alias(f"{name}_id"),
            F.when(own, F.col(f"_{name}")).when(F.col("first").isNotNull(), F.col("n_chars")).alias(f"{name}_length"),
        ]
    return every.join(F.broadcast(answers) if is_small(answers) else answers.hint("merge"), ["first", "mark"], "left").select("doc_id", "n_chars", "fingerprint", *columns)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


_HASH = "list_reduce(list_prepend(0::BIGINT, list_reverse({codes})), lambda a, c: (a * {base} + c) % {prime})"
_BOTH = " * 2147483648 + ".join(_HASH.replace("{base}", str(b)).replace("{prime}", str(p)) for b, p in zip(BASES, PRIMES))


def _best(name: str, a: str, b: str, key: str) -> str:
    equal = f"list_position(list_transform(list_zip(list_slice({a}, 1, m), list_slice({b}, 1, m)), lambda p: p[1] <> p[2]), true)"
    return f"""{name} AS (
  SELECT doc_id, max(struct_pack(l := coalesce(nullif({equal}, 0) - 1, m), i := -partner)) AS best FROM (
    SELECT a.doc_id, b.doc_id AS partner, least(a.n_chars, b.n_chars) AS m, {a} , {b}
    FROM (SELECT doc_id, n_chars, text, {key} AS k, {a.replace("_a", "")} AS {a} FROM hashed) a
    JOIN (SELECT doc_id, n_chars, text, {key} AS k, {a.replace("_a", "")} AS {b} FROM hashed) b
      ON a.k = b.k AND b.doc_id < a.doc_id AND (least(a.n_chars, b.n_chars) >= {LEAD} OR a.text = b.text)
  ) GROUP BY doc_id
)"""


SQL = f"""
WITH codes AS (SELECT doc_id, text, list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) AS c FROM documents WHERE text <> ''),
hashed AS (SELECT doc_id, text, c, list_reverse(c) AS r, length(text) AS n_chars, {_BOTH.replace("{codes}", "c")} AS fingerprint FROM codes),
{_best("fore", "c_a", "c_b", f"left(text, {LEAD})")},
{_best("back", "r_a", "r_b", f"right(text, {LEAD})")}
SELECT doc_id, n_chars, fingerprint, -fore.best.i AS prefix_id, fore.best.l AS prefix_length, -back.best.i AS suffix_id, back.best.l AS suffix_length
FROM hashed LEFT JOIN fore USING (doc_id) LEFT JOIN back USING (doc_id)
UNION ALL SELECT doc_id, 0, 0, NULL, NULL, NULL, NULL FROM documents WHERE coalesce(text, '') = ''
"""
