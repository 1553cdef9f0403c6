"""License scans: normalised text is compared with licence templates by the Dice coefficient over word bigrams.

Text is normalised to runs of ASCII letters (in lower case), digits and characters beyond ASCII. A template of W words is
compared with every window of W words of the text, wherever lines end, and with the whole text if that is shorter.
Windows of n distinct bigrams are compared only with templates whose m fulfil t / (2 - t) <= n / m <= (2 - t) / t, as no
other can reach the threshold t; and only where at least m * t / (2 - t) of their bigrams are the template's, which
leaves few. Windows that reach t and follow each other are one match, reported by the best of them (the first of equals).

Defined results: a null or empty text and a text of fewer than two words match nothing; ties between templates are all
returned; a repeated row is returned as often as it occurs; rows without a doc_id are dropped; texts are read as a whole;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siteloom.llm.common import U, Words, grams, read, slices, texts
from siteloom.llm.license_texts import TEMPLATES

THRESHOLD = 0.8
#: Bigrams of windows that are counted at once.
CELLS = 4_000_000

SCHEMA = "doc_id long, begin long, end long, template long, license string, dice double"


class Template:
    def __init__(self, text: str, threshold: float):
        words = Words(pa.array([text]))
        self.words = len(words.hash)
        self.grams = np.unique(grams(words.hash, 2))
        self.size, self.threshold = len(self.grams), threshold
        self.need = max(1, int(np.ceil(threshold / (2 - threshold) * self.size - 1e-9)))

    def matches(self, gram: np.ndarray, hit: np.ndarray):
        """(begin, end, dice) in a text of bigrams ``gram``, of which ``hit`` are the template's."""
        width = min(self.words - 1, len(gram))
        sums = np.append(0, np.cumsum(hit))
        starts = np.flatnonzero(sums[width:] - sums[:-width] >= self.need)
        found = []
        for at in range(0, len(starts), max(1, CELLS // width)):
            part = starts[at : at + max(1, CELLS // width)]
            cells = np.sort(np.lib.stride_tricks.sliding_window_view(gram, width)[part], 1)
            new = np.ones(cells.shape, bool)
            new[:, 1:] = cells[:, 1:] != cells[:, :-1]
            n, shared = new.sum(1), (new & np.isin(cells, self.grams)).sum(1)
            near = (n * self.threshold / (2 - self.threshold) <= self.size + 1e-9) & (n >= self.threshold / (2 - self.threshold) * self.size - 1e-9)
            dice = 2 * shared / (n + self.size)
            ok = near & (dice >= self.threshold - 1e-12)
            found += list(zip(part[ok].tolist(), dice[ok].tolist()))
        best = None
        for i, (begin, dice) in enumerate(found):
            if best is None or dice > best[1]:
                best = begin, dice
            if i + 1 == len(found) or found[i + 1][0] > begin + 1:
                yield best[0], best[0] + width + 1, best[1]
                best = None


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, begin and end (words begin .. end - 1 are the window), template (its place in the list), license and dice of each match."""
    made = [Template(t, threshold) for _, t in templates]
    every = np.unique(np.concatenate([t.grams for t in made]))
    # Templates of each bigram that any of them has.
    of = np.zeros((len(every), len(made)), bool)
    for i, t in enumerate(made):
        of[np.searchsorted(every, t.grams), i] = True
    needs = np.array([t.need for t in made])

    def run(batches):
        rough = np.zeros(1 << 20, bool)
        rough[every >> U(44)] = True
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                gram = grams(w.hash, 2)
                if not len(gram):
                    continue
                hit = np.flatnonzero(rough[gram >> U(44)] & (w.doc[1:] == w.doc[:-1]))
                hit = hit[np.isin(gram[hit], every)]
                if not len(hit):
                    continue
                which, doc = np.searchsorted(every, gram[hit]), w.doc[hit]
                begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                # A document is looked at for the templates of which it holds enough bigrams.
                enough = np.add.reduceat(of[which].astype(np.int32), begin) >= needs
                id_, out = part.column("doc_id").to_numpy(), []
                for row, t in np.argwhere(enough):
                    d = doc[begin[row]]
                    a, b = w.first[d], w.first[d + 1] - 1
                    own = np.zeros(b - a, bool)
                    s = slice(begin[row], begin[row + 1] if row + 1 < len(begin) else None)
                    own[hit[s][of[which[s], t]] - a] = True
                    out += [(id_[d], x, y, t, templates[t][0], dice) for x, y, dice in made[t].matches(gram[a:b], own)]
                if out:
                    c = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.string()), pa.array(c[5], pa.float64())], ["doc_id", "begin", "end", "template", "license", "dice"]
                    )

    return texts(docs).mapInArrow(run, SCHEMA)


def op2_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate({{}}, '{_UP}', '{_LOW}'), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+')"
_PAIRS = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
SQL = f"""
WITH templates AS (
  SELECT template, license, len(w) AS words, {_PAIRS.format("w")} AS b FROM (SELECT template, license, {_WORDS.format("t")} AS w FROM (VALUES
    {", ".join(f"({i}::BIGINT, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(TEMPLATES))}) v(template, license, t))
), docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
near AS (
  SELECT doc_id, w, template, license, words, t.b FROM (SELECT doc_id, w, {_PAIRS.format("w")} AS b FROM docs WHERE len(w) > 1) d
  JOIN templates t ON len(list_intersect(d.b, t.b)) >= {THRESHOLD / (2 - THRESHOLD)} * len(t.b) - 1e-9
), windows AS (
  SELECT doc_id, template, license, b, i - 1 AS begin, list_slice(w, i, i + words - 1) AS v
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - words + 1) + 1)) AS i FROM near)
), pairs AS (SELECT doc_id, template, license, begin, len(v) AS n, b, {_PAIRS.format("v")} AS c FROM windows),
found AS (SELECT *, 2 * len(list_intersect(c, b)) / (len(c) + len(b))::DOUBLE AS dice FROM pairs),
runs AS (SELECT *, begin - row_number() OVER (PARTITION BY doc_id, template ORDER BY begin) AS run FROM found WHERE dice >= {THRESHOLD} - 1e-12),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template, run ORDER BY dice DESC, begin) AS r FROM runs)
SELECT doc_id, begin::BIGINT AS begin, (begin + n)::BIGINT AS "end", template, license, dice FROM best WHERE r = 1
"""
