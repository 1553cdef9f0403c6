"""Suffix-array dedup: passages of ``MIN_WORDS`` words and more that repeat across documents.

Symbols are words. Column-wise construction (``Collection``) builds the Burrows-Wheeler transform and the array of common
prefixes of many short texts at once: round r puts the suffix of length r of every text into the order of all shorter
ones. A new suffix begins with symbol c and goes on with its text's suffix of the round before, so its place is among
the suffixes that begin with c, by where their own tails stand; its common prefix with a neighbour is one more than the
least common prefix between the two tails. The state (symbol, tail's place, common prefix, text) is read from and
written to external files one after the other, a round's input and output, in the shared folder.

Two documents share a passage of MIN_WORDS words only if they share the least hash of its ``GRAM``-word runs. So each
document is cut at these minimizers: a window of MIN_WORDS words belongs to one minimizer, and windows of one minimizer
make up one fragment. Fragments with the same minimizer go to the same task, which finds all repeats among them, so the
construction is local and the result is still that of the whole collection. Equal fragments are one text; minimizers
of a single document, and those whose fragments are all equal, need no construction. A collection has about
``COLLECTION`` symbols, a round's arrays are read as a whole, and a state under ``IN_MEMORY`` bytes stays in memory. The
windows of a minimizer whose kinds of fragments have more symbols than that are grouped by their hashes instead, by
partial aggregates, so no minimizer is too hot for a task.

Defined results: a passage counts if its words (runs of letters and digits, in lower case for ASCII) are the same and
another document of smaller id has it; repeats within one document don't count; repeated rows of a doc_id are one
document; null, empty and short texts have none; rows without a doc_id are dropped; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import posixpath
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteloom.llm.common import BASE, INVERSE, U, Words, grams, materialize, mix, powers, read, semi_filter, shared_dir, slices, texts

MIN_WORDS, GRAM = 50, 10
#: Symbols of a collection, and of the most that one minimizer's fragments may have to go into one.
COLLECTION = 1_000_000
#: A state smaller than this stays in memory between rounds.
IN_MEMORY = 16_000_000


class Files:
    """The state's arrays between rounds: one file an array and round, written and read from front to back."""

    def __init__(self, folder: str, external: int = IN_MEMORY):
        self.system, self.path = fs.FileSystem.from_uri(posixpath.join(folder.replace("s3a://", "s3://", 1), f"bwt-{uuid.uuid4().hex}"))
        self.external, self.kept, self.round, self.made = external, {}, 0, False

    def put(self, **arrays: np.ndarray) -> None:
        self.round += 1
        if sum(a.nbytes for a in arrays.values()) <= self.external:
            self.kept = arrays
            return
        if not self.made:
            self.system.create_dir(self.path)
            self.made = True
        self.kept = {}
        for name, a in arrays.items():
            with self.system.open_output_stream(f"{self.path}/{name}-{self.round}") as out:
                out.write(memoryview(np.ascontiguousarray(a)).cast("B"))
            self.kept[name] = a.dtype

    def get(self, name: str) -> np.ndarray:
        a = self.kept[name]
        if isinstance(a, np.ndarray):
            return a
        path = f"{self.path}/{name}-{self.round}"
        with self.system.open_input_stream(path) as stream:
            data = stream.read()
        self.system.delete_file(path)
        return np.frombuffer(data, a)

    def close(self) -> None:
        if self.made:
            self.system.delete_dir(self.path)


class _RangeMinimum:
    """Least value of any range: prefix and suffix minima within blocks, a sparse table over blocks."""

    def __init__(self, values: np.ndarray, block: int = 32):
        self.block, n = block, len(values)
        top = np.iinfo(values.dtype).max
        padded = np.full(-(-max(n, 1) // block) * block, top, values.dtype)
        padded[:n] = values
        self.grid = padded.reshape(-1, block)
        self.fore = np.minimum.accumulate(self.grid, 1)
        self.back = np.minimum.accumulate(self.grid[:, ::-1], 1)[:, ::-1]
        self.table = [self.fore[:, -1]]
        while 2 ** len(self.table) <= len(self.grid):
            s = 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-s], self.table[-1][s:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over low <= i <= high, each range having a value."""
        a, b = low // self.block, high // self.block
        out = np.minimum(self.back[a, low % self.block], self.fore[b, high % self.block])
        same = np.flatnonzero(a == b)
        if len(same):
            at = np.arange(self.block)
            inside = (at >= (low[same] % self.block)[:, None]) & (at <= (high[same] % self.block)[:, None])
            out[same] = np.where(inside, self.grid[a[same]], np.iinfo(out.dtype).max).min(1)
        far = np.flatnonzero(b - a > 1)
        if len(far):
            first, n = a[far] + 1, b[far] - a[far] - 1
            level = np.log2(n).astype(np.int64)
            for k in np.unique(level):
                i = np.flatnonzero(level == k)
                t = self.table[k]
                out[far[i]] = np.minimum(out[far[i]], np.minimum(t[first[i]], t[first[i] + n[i] - 2**k]))
        return out


class Collection:
    """All suffixes of the texts in order: ``text`` and ``length`` of each, and its ``common`` prefix with the one before.

    symbols: the texts' symbols (from 0) one after the other; sizes: how many each has. ``bwt`` is the symbol before
    each suffix (-1 at a text's begin).
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, files: Files):
        end = np.cumsum(sizes)
        m = len(sizes)
        # Round 0: each text's empty suffix. They differ from each other and are less than anything.
        files.put(
            key=np.full(m, -1, np.int32), tail=np.arange(m, dtype=np.int32), common=np.zeros(m, np.int16), text=np.arange(m, dtype=np.int32),
            length=np.zeros(m, np.int16), bwt=np.full(m, -1, np.int32),
        )
        place = np.arange(m)  # of each text's newest suffix
        for r in range(1, int(sizes.max(initial=0)) + 1):
            key, tail, common, text, length, bwt = (files.get(x) for x in ("key", "tail", "common", "text", "length", "bwt"))
            n = len(key)
            on = np.flatnonzero(sizes >= r)
            c, p = symbols[end[on] - r], place[on]
            order = np.lexsort((p, c))
            on, c, p = on[order], c[order], p[order]
            # The symbol before the round's tails is now known: that is the new column of the transform.
            bwt = bwt.copy()
            bwt[p] = c
            # (symbol, tail's place) ascends over all suffixes.
            joint, new = _joint(key, tail, n), _joint(c, p, n)
            at = np.searchsorted(joint, new)
            where = at + np.arange(len(new))
            total = n + len(new)
            fresh = np.zeros(total, bool)
            fresh[where] = True
            old = np.flatnonzero(~fresh)

            def merged(a: np.ndarray, b: np.ndarray, old: np.ndarray = old, where: np.ndarray = where, total: int = total) -> np.ndarray:
                out = np.empty(total, a.dtype)
                out[old], out[where] = a, b
                return out

            key2, tail2 = merged(key, c), merged(tail, p)
            text2, length2 = merged(text, on.astype(np.int32)), merged(length, np.full(len(on), r, np.int16))
            bwt2 = merged(bwt, np.full(len(on), -1, np.int32))
            # Common prefixes change at the new suffixes and at those that now follow one.
            common2 = merged(common, np.zeros(len(on), np.int16))
            touched = np.unique(np.concatenate((where, where + 1)))
            touched = touched[(touched > 0) & (touched < total)]
            same = (key2[touched] == key2[touched - 1]) & (key2[touched] >= 0)
            common2[touched] = 0
            i = touched[same]
            if len(i):
                common2[i] = 1 + _RangeMinimum(common).least(tail2[i - 1] + 1, tail2[i])
            # Places are those before the round until now; each moves by the new suffixes at or before it.
            moved = old
            tail2 = moved[tail2].astype(np.int32)
            place[on] = where
            done = np.ones(m, bool)
            done[on] = False
            place[done] = moved[place[done]]
            files.put(key=key2, tail=tail2, common=common2, text=text2, length=length2, bwt=bwt2)
        self.common, self.text, self.length, self.bwt = (files.get(x) for x in ("common", "text", "length", "bwt"))
        files.close()


def _joint(symbol: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    return (symbol.astype(np.int64) + 1) * (n + 1) + place


def minimizers(w: Words, least: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fragments: the doc, the minimizer's hash, and the first and last window (by their first words) that it is the least of."""
    h, span = grams(w.hash, k), least - k + 1
    n = len(w.hash) - least + 1
    empty = np.empty(0, np.int64)
    if n <= 0:
        return empty, np.empty(0, U), empty, empty
    # The place is in the low bits, so the first of equal hashes is the least.
    bits = U(28)
    low = (h >> bits << bits) | np.arange(len(h), dtype=U)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[span - width : span - width + n])
    at = (low & ((U(1) << bits) - U(1))).astype(np.int64)
    inside = w.doc[:n] == w.doc[least - 1 :]
    at[~inside] = -1
    begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    end = np.append(begin[1:], n) - 1
    keep = at[begin] >= 0
    begin, end = begin[keep], end[keep]
    return w.doc[begin], h[at[begin]], begin, end


def repeats(docs: DataFrame, least: int = MIN_WORDS, k: int = GRAM, collection: int = COLLECTION) -> DataFrame:
    """doc_id, first_doc_id, begin, end: words begin .. end - 1 of the document are passages of first_doc_id, the least document that has them."""
    spark = docs.sparkSession
    docs, folder = texts(docs), shared_dir(spark)

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                doc, anchor, begin, end = minimizers(w, least, k)
                sums = np.zeros(len(w.hash) + 1, U)
                np.cumsum(w.hash * powers(BASE, len(w.hash)), out=sums[1:])
                stop = end + least
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view(np.int64)), pa.array(content(sums, begin, stop)), pa.array(ids[doc]),
                    pa.array((begin - w.first[doc]).astype(np.int32)), pa.array((stop - w.first[doc]).astype(np.int32)),
                ], ["anchor", "content", "doc_id", "begin", "stop"])

    fragments = materialize(docs.mapInArrow(cut, "anchor long, content long, doc_id long, begin int, stop int"), "fragments")
    # Minimizers of one document go first. Aggregates are partial before the shuffle, so a hot minimizer comes as one row a task;
    # the join back splits it, as its other side has one row.
    anchors = fragments.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("_high"), (F.min("content") != F.max("content")).alias("mixed"))
    anchors = materialize(anchors.where("low < _high").drop("_high"), "anchors")
    several = materialize(fragments.join(anchors.hint("merge"), "anchor"), "several")
    alike = several.where("NOT mixed AND doc_id > low").select("doc_id", F.col("low").alias("first_doc_id"), "begin", "stop")
    # Of minimizers with several kinds of fragments one fragment stands for each kind: that of its least document.
    mixed = several.where("mixed").select("anchor", "content", "doc_id", "begin", "stop")
    kinds = mixed.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "begin", "stop")).alias("own"))
    kinds = materialize(kinds.select("anchor", "content", "own.*"), "kinds")
    needed = materialize(kinds.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "content", "begin", "stop")).alias("cuts")), "needed")

    def take(batches):
        """The words' hashes of the fragments that stand for each kind."""
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                cuts, ids = part.column("cuts"), part.column("doc_id").to_pylist()
                own = np.repeat(np.arange(part.num_rows), np.diff(cuts.offsets.to_numpy()))
                flat = cuts.flatten()
                a, kind, b, c = (flat.field(i).to_numpy() for i in range(4))
                fits = w.first[own] + c <= w.first[own + 1]  # another text of a repeated doc_id may be shorter
                own, a, kind, b, c = own[fits], a[fits], kind[fits], b[fits], c[fits]
                sums = np.zeros(len(w.hash) + 1, U)
                np.cumsum(w.hash * powers(BASE, len(w.hash)), out=sums[1:])
                # ... or have other words there.
                begin, stop = w.first[own] + b, w.first[own] + c
                same = content(sums, begin, stop) == kind
                own, a, kind, begin, size = own[same], a[same], kind[same], begin[same], (c - b)[same]
                bounds = np.append(0, np.cumsum(size))
                index = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - begin, size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a), pa.array(kind), pa.array(np.array(ids, np.int64)[own]),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((w.hash[index] >> U(32)).astype(np.uint32).view(np.int32))),
                ], ["anchor", "content", "doc_id", "words"])

    taken = semi_filter(docs, needed, "doc_id").mapInArrow(take, "anchor long, content long, doc_id long, words array<int>")
    # Repeated rows of a document give the same words again.
    taken = taken.groupBy("anchor", "content", "doc_id").agg(F.min("words").alias("words"))
    hot = materialize(kinds.groupBy("anchor").agg(F.sum(F.col("stop") - F.col("begin")).alias("symbols")).where(F.col("symbols") > collection).select("anchor"), "hot")
    if hot.isEmpty():
        found = _built(taken, least, folder)
    else:
        # A minimizer whose kinds are more than a collection has its windows compared by their hash, which needs no task to see them all.
        taken = materialize(taken, "taken")
        found = _built(taken.join(hot, "anchor", "left_anti"), least, folder).union(_by_window(taken.join(hot, "anchor", "left_semi"), least))
    # Each run of windows for all members of its kind.
    runs = materialize(found, "runs")
    members = mixed.join(runs.hint("merge"), ["anchor", "content"]).where("doc_id > first_doc_id").select(
        "doc_id", "first_doc_id", (F.col("begin") + F.col("low")).alias("begin"), (F.col("begin") + F.col("high")).alias("stop")
    )
    pieces = alike.union(members)
    # Windows of one pair that overlap or follow each other are one passage.
    order = Window.partitionBy("doc_id", "first_doc_id").orderBy("begin", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Windows begin at begin .. stop - least; two runs of windows join if no window between them is missing.
    joined = pieces.withColumn("new", F.coalesce((F.col("begin") > reach - (least - 1)).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(order))
    return joined.groupBy("doc_id", "first_doc_id", "run").agg(F.min("begin").cast("long").alias("begin"), F.max("stop").cast("long").alias("end")).drop("run")


_RUNS = "anchor long, content long, first_doc_id long, low int, high int"


def _built(taken: DataFrame, least: int, folder: str) -> DataFrame:
    """Runs of windows by kind, from collections of whole minimizers."""

    def build(batches):
        for rows in _collections(batches):
            yield from _repeated(rows, least, folder)

    return taken.repartition("anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(build, _RUNS)


def _by_window(taken: DataFrame, least: int) -> DataFrame:
    """The same, from hashes of the windows: a row a window, its least document by a partial aggregate."""

    def windows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words = part.column("words")
                size = np.diff(words.offsets.to_numpy())
                symbols = words.flatten().to_numpy().view(np.uint32).astype(U)
                first = np.append(0, np.cumsum(size))
                count = np.maximum(size - least + 1, 0)
                row = np.repeat(np.arange(len(size)), count)
                place = np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(count))[:-1], count)
                sums = np.zeros(len(symbols) + 1, U)
                np.cumsum(mix(symbols) * powers(BASE, len(symbols)), out=sums[1:])
                begin = first[row] + place
                window = content(sums, begin, begin + least)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c).take(pa.array(row)) for c in ("anchor", "content", "doc_id")), pa.array(place.astype(np.int32)), pa.array(window),
                ], ["anchor", "content", "doc_id", "place", "window"])

    rows = materialize(taken.mapInArrow(windows, "anchor long, content long, doc_id long, place int, window long"), "windows")
    firsts = rows.groupBy("anchor", "window").agg(F.min("doc_id").alias("first_doc_id"))
    same = rows.join(firsts.hint("merge"), ["anchor", "window"])
    order = Window.partitionBy("anchor", "content", "first_doc_id").orderBy("place")
    return same.withColumn("run", F.col("place") - F.row_number().over(order)).groupBy("anchor", "content", "first_doc_id", "run").agg(
        F.min("place").alias("low"), (F.max("place") + least).cast("int").alias("high")
    ).select("anchor", "content", "first_doc_id", "low", "high")


def content(sums: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of spans of words, from the running sums of their hashes by powers."""
    return (mix((sums[stop] - sums[begin]) * powers(INVERSE, len(sums))[begin]) ^ mix((stop - begin).astype(U))).view(np.int64)


def _collections(batches):
    """Whole minimizers, sorted, about ``COLLECTION`` symbols at once."""
    held, symbols = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            held.append(batch.slice(at, 1000))
            symbols += held[-1].column("words").flatten().__len__()
            if symbols >= COLLECTION:
                table = pa.Table.from_batches(held).combine_chunks()
                anchors = table.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))  # the last one may go on
                if cut:
                    yield table.slice(0, cut).combine_chunks()
                    held = table.slice(cut).combine_chunks().to_batches()
                    symbols = sum(len(b.column("words").flatten()) for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()


def _repeated(table: pa.Table, least: int, folder: str):
    """Windows that a document of smaller id has: runs of them by member."""
    if not table.num_rows:
        return
    anchors = table.column("anchor").to_numpy()
    sizes, words = _flat(table, "words")
    lows = table.column("doc_id").to_numpy()
    _, symbols = np.unique(words, return_inverse=True)
    _, group = np.unique(anchors, return_inverse=True)
    made = Collection(symbols, sizes, Files(folder))
    # Suffixes that share least words with the one before are of one class.
    window = np.flatnonzero(made.length >= least)
    if not len(window):
        return
    start = made.common < least
    label = np.cumsum(start)[window]
    text = made.text[window]
    offset = sizes[text] - made.length[window]
    order = np.lexsort((lows[text], group[text], label))
    text, offset, label = text[order], offset[order], label[order]
    new = np.concatenate(([True], (label[1:] != label[:-1]) | (group[text][1:] != group[text][:-1])))
    first = lows[text][np.flatnonzero(new)][np.cumsum(new) - 1]
    # Runs of windows of a text with one first document.
    order = np.lexsort((offset, first, text))
    text, offset, first = text[order], offset[order], first[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (first[1:] != first[:-1]) | (offset[1:] != offset[:-1] + 1))))
    last = np.append(new[1:], len(text)) - 1
    text, low, high, first = text[new], offset[new], offset[last] + least, first[new]
    yield pa.RecordBatch.from_arrays([
        pa.array(anchors[text]), pa.array(table.column("content").to_numpy()[text]), pa.array(first), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
    ], ["anchor", "content", "first_doc_id", "low", "high"])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of the whole table that a document of smaller id has."""
    return repeats(read(spark, sf_dir, "documents"))


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i - 1 AS begin, md5(array_to_string(list_slice(w, i, i + {MIN_WORDS - 1}), ' ')) AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {MIN_WORDS - 2})) AS i FROM words WHERE len(w) >= {MIN_WORDS})
), firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_doc_id FROM windows),
runs AS (
  SELECT doc_id, first_doc_id, begin, begin - row_number() OVER (PARTITION BY doc_id, first_doc_id ORDER BY begin) AS run
  FROM firsts WHERE first_doc_id < doc_id
)
SELECT doc_id, first_doc_id, min(begin)::BIGINT AS begin, (max(begin) + {MIN_WORDS})::BIGINT AS "end" FROM runs GROUP BY doc_id, first_doc_id, run
"""
