"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows that tell quotation from abuse.

The lexicon is a trie of insults (``TERMS``) and of words and stems learnt from labelled rows. The automata of all words within
``allowed(term)`` edits of a term (a word of any ending for a stem, which may have one) are intersected with the trie and
determinised once, on the driver; on the executors they run over all words of a batch at a time, one character a step.
Edits are at any place, a swap of neighbours is one, and digits count as the letters that they resemble.

A match scores 1, less 0.15 an edit; in its window of ``CONTEXT`` words an address (you, ...) adds 0.2, quotation marks
around it take 0.4 and a reporting verb takes 0.4, so either clears even an exact term that addresses nobody. A document is
toxic if a match scores ``THRESHOLD`` or more.

Words and stems (prefixes of any length) are learnt from at most ``TRAIN_TOXIC`` toxic and ``TRAIN_CLEAN`` other labelled
rows (those of least hash): those that pass ``marked`` in a language and whose odds over all languages are as good.
``held_out`` gives the recall by language. A misspelling that is a common word (``LOOKALIKES``), or that the
sample's other documents hold at odds worse than ``ODDS``, is no match, while the term's other misspellings stay. Of
what is learnt, misspellings that the sample doesn't hold are matches only if those that it holds once are toxic at these odds. Copies (the same words in the same order) count once.

Defined results: null and empty texts, and texts without a match, aren't toxic; repeated rows are scored alike; rows
without a doc_id are dropped by ``scan`` and kept by ``keep_clean``; without labels the lexicon is ``TERMS``; an empty
table gives an empty result; other columns are ignored or passed through.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict, deque
from copy import copy
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteloom.llm.common import BASE, U, Words, lean, materialize, mix, powers, read, slices, texts

TERMS = (
    "idiot idiots idiotic moron morons moronic loser losers scum scumbag stupid worthless pathetic disgusting clown "
    "trash imbecile cretin dimwit halfwit jackass dumbass bastard lowlife degenerate vermin parasite subhuman filthy "
    "bitch whore fucking fucker motherfucker asshole retard retarded crybaby pervert wanker dickhead douchebag"
).split()
TRAIN_TOXIC, TRAIN_CLEAN = 3000, 9000
#: Odds that a learnt word's holder is toxic; spellings that are tried, for chance; bytes of the shortest.
ODDS, TRIED, LEAST = 3, 1e5, 4
#: Words of one part of the automaton.
PART = 16
#: Common words that are within the edits of a term.
LOOKALIKES = frozenset(
    b"adore anker apathetic banker batch birch blown boron brash bucking butch chore clod closer closers cown crash cretan crown dastard "
    b"degenerated degenerates degenerative ditch ducking filth flown hanker hitch horde idiom idioms itch laser lasers loner loners lose "
    b"loses losses lover lovers lower lowers luring maroon moon moran morn mucking parasites parasitic pitch poser rash regard regarded "
    b"regards regenerate regenerated scam scud shore slum stash stitch sucking sum tanker thrash trace trashy tucking user vermins wander "
    b"where whole whorl whose witch wore worthiness".split()
)
CONTEXT, THRESHOLD = 6, 0.65
ADDRESS = re.compile(rb"\b(?:you|your|youre|u|ur|du|dich|dein|tu|toi|vous|usted|eres)\b")
REPORT = re.compile(rb"\b(?:said|says|say|wrote|writes|called|calls|quote|quoted|quoting|word|term|insult|sagte|schrieb|dit|dijo|palabra|wort|mot)\b")
QUOTE = re.compile(rb'"|\xe2\x80[\x9c-\x9f]|\xc2[\xab\xbb]')


def allowed(term: str) -> int:
    """Edits that a misspelling of ``term`` may have."""
    return 1 if len(term) < 9 else 2


class _Part:
    """The determinised automaton of some words: ``step[state, symbol]``, state 0 accepts nothing any more, state 1 is the start.

    A state is a set of (node of the trie, edits so far); (node, symbol) waits for the second letter of a swap.
    """

    def __init__(self, words: list[tuple[int, bytes, int]], stem: bool):
        self.stem = stem
        self.shortest = min(len(w) - d for _, w, d in words)
        self.longest = max(len(w) + d for _, w, d in words)
        letters = sorted({c for _, w, _ in words for c in w})
        self.symbol = np.zeros(256, np.int64)
        self.symbol[letters] = np.arange(1, len(letters) + 1)
        for digit, letter in zip(b"0134570", b"oieastg"):
            if self.symbol[digit] == 0 and letter in letters:
                self.symbol[digit] = self.symbol[letter]
        children: list[dict[int, int]] = [{}]
        most, end, own = [0], [-1], {}
        for i, w, d in words:
            node = 0
            most[0] = max(most[0], d)
            for c in w:
                c = int(self.symbol[c])
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    most.append(0)
                    end.append(-1)
                node = children[node][c]
                most[node] = max(most[node], d)
            if end[node] < 0:
                end[node], own[node] = i, d

        def put(best: dict, node, e: int) -> bool:
            ok = e <= most[node if isinstance(node, int) else node[0]] and best.get(node, 9) > e
            if ok:
                best[node] = e
            return ok

        def closed(best: dict) -> frozenset:
            """With the nodes that are reached by leaving out characters of the term."""
            todo = [(node, e) for node, e in best.items() if isinstance(node, int)]
            while todo:
                node, e = todo.pop()
                todo += [(child, e + 1) for child in children[node].values() if put(best, child, e + 1)]
            return frozenset(best.items())

        def after(state: frozenset, c: int) -> frozenset:
            best: dict = {}
            for node, e in state:
                if not isinstance(node, int):
                    if node[1] == c:
                        put(best, node[0], e)
                    continue
                put(best, node, e + 1)  # a character too many
                for s, child in children[node].items():
                    put(best, child, e if s == c else e + 1)
                    if s != c and c in children[child]:
                        put(best, (children[child][c], s), e + 1)
            return closed(best)

        first = closed({0: 0})
        ids, rows, queue = {frozenset(): 0, first: 1}, {0: [0] * (len(letters) + 1)}, deque([first])
        while queue:
            state = queue.popleft()
            row = []
            for c in range(len(letters) + 1):
                to = after(state, c)
                if to not in ids:
                    ids[to] = len(ids)
                    queue.append(to)
                row.append(ids[to])
            rows[ids[state]] = row
        self.step = np.array([rows[i] for i in range(len(ids))], np.int32)
        self.term, self.edits = np.full(len(ids), -1, np.int32), np.zeros(len(ids), np.int32)
        for state, i in ids.items():
            fits = [(e, end[node]) for node, e in state if isinstance(node, int) and end[node] >= 0 and e <= own[node]]
            if fits:
                self.edits[i], self.term[i] = min(fits)

    def run(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, end of what is accepted, state): at the end of a word or, for stems, wherever one is accepted."""
        size = ends - starts
        live = np.flatnonzero((size >= self.shortest) if self.stem else (size >= self.shortest) & (size <= self.longest))
        state, at, done = np.ones(len(live), np.int32), starts[live], []
        while len(live):
            state = self.step[state, self.symbol[data[at]]]
            at = at + 1
            ok = self.term[state] >= 0
            if not self.stem:
                ok &= at == ends[live]
            if ok.any():
                done.append((live[ok], at[ok], state[ok]))
            on = (state > 0) & (at < ends[live])
            live, state, at = live[on], state[on], at[on]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))


class Automaton:
    """Of terms, stems and learnt words, in parts by their length. States count on from part to part; ``term`` and ``edits`` are those of a state.

    An edit is a letter too many, too few or another one, or two neighbours swapped, at any place. A misspelling (of a stem:
    the part of the word that is accepted) that is in ``excluded`` is no match; of the terms in ``doubtful``, only those in
    ``seen`` are.
    """

    def __init__(self, terms: list[str], stems: list[bytes] = (), learnt: list[bytes] = (), excluded: frozenset[bytes] = frozenset(), doubtful: frozenset[int] = frozenset(), seen: frozenset[bytes] = frozenset()):
        words = [(t.encode(), allowed(t), False) for t in terms] + [(s, 1, True) for s in stems] + [(x, allowed(x), False) for x in learnt]
        self.terms = [w.decode(errors="replace") + "*" * is_stem for w, _, is_stem in words]
        self._choose(excluded, doubtful, seen)
        groups = defaultdict(list)
        for i, (w, d, is_stem) in enumerate(words):
            groups[is_stem, len(w)].append((i, w, d))
        self.parts = [_Part(g[i : i + PART], is_stem) for (is_stem, _), g in sorted(groups.items()) for i in range(0, len(g), PART)]
        self.base = np.cumsum([0] + [len(p.step) for p in self.parts])
        self.term = np.concatenate([p.term for p in self.parts] or [np.empty(0, np.int32)])
        self.edits = np.concatenate([p.edits for p in self.parts] or [np.empty(0, np.int32)])

    def _choose(self, excluded: frozenset[bytes], doubtful: frozenset[int], seen: frozenset[bytes]) -> None:
        self.excluded, self.seen = excluded, seen
        self.doubtful = np.isin(np.arange(len(self.terms)), list(doubtful))

    def choosing(self, excluded: frozenset[bytes], doubtful: frozenset[int], seen: frozenset[bytes]) -> Automaton:
        """The same words with other misspellings left out; nothing is determinised again."""
        other = copy(self)
        other._choose(excluded, doubtful, seen)
        return other

    def accepted(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, end, state), the best of a word first; words that are spelt as in the lexicon have no others."""
        found = [(w, at, s + b) for p, b in zip(self.parts, self.base) for w, at, s in [p.run(data, starts, ends)]]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        w, at, s = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((at, self.term[s], self.edits[s], w))
        w, at, s = w[order], at[order], s[order]
        exact = np.zeros(len(starts), bool)
        exact[w[self.edits[s] == 0]] = True
        keep = ~exact[w] | (self.edits[s] == 0)
        return w[keep], at[keep], s[keep]

    def match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that are accepted, and their states."""
        w, at, s = self.accepted(data, starts, ends)
        if len(w):
            raw, fine = data.tobytes(), self.edits[s] == 0
            unsure = self.doubtful[self.term[s]]
            for i in np.flatnonzero(~fine).tolist():
                x = raw[starts[w[i]] : at[i]]
                fine[i] = x not in self.excluded and (not unsure[i] or x in self.seen)
            w, s = w[fine], s[fine]
        w, first = np.unique(w, return_index=True)
        return w, s[first]


def score(edits: int, before: bytes, after: bytes) -> float:
    """Of one match, from the (lower-case) text of its window before and after it."""
    s = 1.0 - 0.15 * edits
    if ADDRESS.search(before) or ADDRESS.search(after):
        s += 0.2
    if len(QUOTE.findall(before)) % 2 and QUOTE.search(after):
        s -= 0.4
    if REPORT.search(before) or REPORT.search(after):
        s -= 0.4
    return round(s, 6)


def window(w: Words, raw: bytes, k: int, context: int) -> tuple[bytes, bytes]:
    """The text before and after word k, as far as ``context`` words in its document."""
    i = w.doc[k]
    a, b = max(w.first[i], k - context), min(w.first[i + 1] - 1, k + context)
    return raw[max(w.offsets[i], w.starts[a] - 3) : w.starts[k]], raw[w.ends[k] : min(w.offsets[i + 1], w.ends[b] + 3)]


def distinct(sample: DataFrame) -> DataFrame:
    """text and toxic (and lang, if there is one) of the rows that hold a word: one of those with the same words in the same order and the same label."""

    more = [c for c in sample.columns if c == "lang"]

    def whole(batches):
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                ok = w.count > 0
                place = np.arange(len(w.starts)) - w.first[w.doc]
                terms = w.hash * powers(BASE, int(w.count.max(initial=0)) + 1)[place]
                same = mix(np.add.reduceat(terms, w.first[:-1][ok])) if ok.any() else np.empty(0, U)
                kept = part.filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in ["text", "toxic", *more]), pa.array(same.view(np.int64))], ["text", "toxic", *more, "same"])

    kept = sample.mapInArrow(whole, "text string, toxic int, " + "lang string, " * len(more) + "same long")
    return kept.groupBy("same", "toxic").agg(*(F.min(c).alias(c) for c in ["text", *more])).select("text", "toxic", *more)


def learn(docs: DataFrame, labels: DataFrame, terms: list[str] = TERMS, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> Automaton:
    """The automaton of the terms, with as many edits as the sample bears out, and of the stems that mark toxic documents."""
    sure = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))

    def least(which: int, n: int) -> DataFrame:  # at most n rows: the documented bound of the sample
        return sure.where(F.col("toxic") == which).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    chosen = F.broadcast(least(1, toxic).union(least(0, clean)))
    plain = Automaton(list(terms), excluded=LOOKALIKES)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    sample = materialize(distinct(texts(docs, lang.alias("lang")).join(chosen, "doc_id")), "sample")
    sizes = {(r.lang, r.toxic): r["count"] for r in sample.groupBy("lang", "toxic").count().collect()}
    n_toxic, n_clean = (sum(n for (_, which), n in sizes.items() if which == label) for label in (1, 0))
    if not n_toxic or not n_clean:
        return plain

    def count(batches):
        """By language and word (kind 0) or prefix (kind: its length): toxic and other documents that hold it."""
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                label = part.column("toxic").to_numpy().astype(bool)
                names, of = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                known, states = plain.match(w.bytes, w.starts, w.ends)
                fresh = np.ones(len(w.starts), bool)
                fresh[known[plain.edits[states] == 0]] = False
                # One batch a piece: a long token has as many kinds as bytes.
                found = [x for kind, i, key in _keys(w, fresh) for x in tally(kind, w.doc[i], key, label, of)]
                if found:
                    lang, kind, key, t, c = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array(names[lang].tolist(), pa.string()), pa.array(kind), pa.array(key), pa.array(t), pa.array(c)], ["lang", "kind", "key", "t", "c"])

    def tally(kind, doc, key, label, of):
        """By language: toxic and other documents of each key, a document counting once."""
        _, i = np.unique(mix(key) ^ mix(doc.astype(np.uint64)), return_index=True)
        lang = of[doc[i]]
        for n in np.unique(lang):
            mine = i[lang == n]
            keys, at = np.unique(key[mine], return_inverse=True)
            bad = label[doc[mine]]
            size = len(keys)
            yield np.full(size, n), np.full(size, kind, np.int32), keys.view(np.int64), np.bincount(at[bad], minlength=size), np.bincount(at[~bad], minlength=size)

    counts = sample.mapInArrow(count, "lang string, kind int, key long, t long, c long").groupBy("lang", "kind", "key").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    every = Window.partitionBy("kind", "key")
    counts = counts.withColumns({"all_t": F.sum("t").over(every), "all_c": F.sum("c").over(every)})
    # What can't pass in any language stays there: marked() asks for at least these odds.
    rows = counts.where((F.col("t") + 0.5 >= ODDS * (F.col("c") + 0.5)) & (F.col("all_t") + 0.5 >= ODDS * (F.col("all_c") + 0.5)) & (F.col("t") > 2)).collect()
    passed = {}
    for r in rows:
        if marked(r.t, r.c, sizes.get((r.lang, 1), 0), sizes.get((r.lang, 0), 0)):
            passed[r.kind, r.key] = r.all_t
    wanted = defaultdict(list)
    for kind, key in passed:
        wanted[kind].append(key)
    wanted = {kind: np.sort(np.array(keys, np.int64).view(np.uint64)) for kind, keys in wanted.items()}

    def spelled(batches):
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"))
                raw, out = w.bytes.tobytes(), {}
                for kind, i, key in _keys(w, np.ones(len(w.starts), bool)):
                    if kind in wanted:
                        hit = np.isin(key, wanted[kind])
                        for k, h in zip(i[hit].tolist(), key[hit].view(np.int64).tolist()):
                            out[kind, h] = raw[w.starts[k] : w.starts[k] + kind if kind else w.ends[k]]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([h for _, h in out], pa.int64()), pa.array(list(out.values()), pa.binary())], ["kind", "key", "word"])

    stems, words = [], []
    if wanted:
        found = sample.where("toxic = 1").mapInArrow(spelled, "kind int, key long, word binary").distinct().collect()
        stems, words = fewest({(bytes(r.word), r.kind > 0): passed[r.kind, r.key] for r in found})
    widest = Automaton(list(terms), stems, words)

    def misspelt(batches):
        """By misspelling that the automaton accepts, and its term: toxic and other documents that hold it."""
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), hashed=False)
                label, raw = part.column("toxic").to_pylist(), w.bytes.tobytes()
                k, at, states = widest.accepted(w.bytes, w.starts, w.ends)
                off = np.flatnonzero(widest.edits[states] > 0)
                held = {(d, raw[a:b], t) for d, a, b, t in zip(*(x[off].tolist() for x in (w.doc[k], w.starts[k], at, widest.term[states])))}
                bad, fine = Counter((x, t) for d, x, t in held if label[d]), Counter((x, t) for d, x, t in held if not label[d])
                every = sorted(bad.keys() | fine.keys())
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, _ in every], pa.binary()), pa.array([t for _, t in every], pa.int32()),
                    pa.array([bad[x] for x in every], pa.int64()), pa.array([fine[x] for x in every], pa.int64()),
                ], ["word", "term", "t", "c"])

    found = sample.mapInArrow(misspelt, "word binary, term int, t long, c long").groupBy("word", "term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    found = materialize(found, "misspelt")
    common = {bytes(r.word) for r in found.where((F.col("c") > 0) & (F.col("t") + 0.5 < ODDS * (F.col("c") + 0.5))).select("word").collect()}
    # What is near a learnt spelling may be common. Misspellings that the sample has once stand for those that it hasn't (Good and Turing).
    learnt = F.col("term") >= len(terms)
    once = {r.term: (r.t, r.c) for r in found.where(learnt & (F.col("t") + F.col("c") == 1)).groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).collect()}
    doubtful = frozenset(len(terms) + i for i in range(len(stems) + len(words)) for t, c in [once.get(len(terms) + i, (0, 0))] if t + 0.5 < ODDS * (c + 0.5))
    seen = found.where(learnt & (F.col("t") - 0.5 >= ODDS * (F.col("c") + 0.5))).select("word").collect()  # it counts without its first document
    return widest.choosing(LOOKALIKES | common, doubtful, frozenset(bytes(r.word) for r in seen))


def _keys(w: Words, fresh: np.ndarray):
    """(kind, words, their hashes): whole words (kind 0) and prefixes of at least ``LEAST`` bytes (kind: the length) of longer ones."""
    size = w.ends - w.starts
    i = np.flatnonzero(fresh & (size >= LEAST))
    yield 0, i, w.hash[i]
    n = LEAST
    while len(i := i[size[i] > n]):
        yield n, i, w.span(w.starts[i], w.starts[i] + n)
        n += 1


def marked(t: int, c: int, n_toxic: int, n_clean: int) -> bool:
    """Whether what t of n_toxic toxic and c of n_clean other documents (of a language) hold tells toxic ones.

    The smoothed log-odds that its holder is toxic, less their standard error, must reach ``ODDS``; and a share of t in t + c
    must be beyond chance (Chernoff's bound, for ``TRIED`` words and prefixes).
    """
    if not t or not n_toxic:
        return False
    if log((t + 0.5) / (c + 0.5)) - sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) < log(ODDS):
        return False
    share, prior = t / (t + c), (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    if share <= prior:
        return False
    return t * log(share / prior) + (c * log((1 - share) / (1 - prior)) if c else 0) >= log(TRIED / 0.01)


def fewest(passed: dict[tuple[bytes, bool], int]) -> tuple[list[bytes], list[bytes]]:
    """(stems, words) that cover ``passed``: toxic documents by (spelling, whether it is a prefix).

    A prefix whose documents all hold one longer spelling stands for this, so one word isn't taken for a stem.
    """
    stems, words = [], []
    for (x, prefix), t in sorted(passed.items(), key=lambda p: (len(p[0][0]), not p[0][1], p[0][0])):
        if x in words or any(x.startswith(s) for s in stems):
            continue
        longer = [(y, p) for (y, p), n in passed.items() if n == t and y.startswith(x)] if prefix else [(x, False)]
        y, p = max(longer, key=lambda o: (len(o[0]), not o[1]))
        (stems if p else words).append(y)
    return stems, [x for x in dict.fromkeys(words) if not any(x.startswith(s) for s in stems)]


def held_out(docs: DataFrame, labels: DataFrame, context: int = CONTEXT, threshold: float = THRESHOLD) -> DataFrame:
    """lang, toxic (the label), n and n_found by language: learnt from one half of the labelled documents, applied to the other."""
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("half")), F.lit(2)) == 1
    automaton = learn(docs, labels.where(~half))
    rest = labels.where(half & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    found = scan(docs, automaton, context, threshold).where("toxic").select("doc_id", F.lit(1).alias("found")).distinct()
    return docs.select("doc_id", lang.alias("lang")).join(rest, "doc_id").join(found, "doc_id", "left").groupBy("lang", F.col("label").alias("toxic")).agg(F.count("*").alias("n"), F.count("found").alias("n_found"))


def scan(docs: DataFrame, automaton: Automaton, context: int = CONTEXT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, toxic, score (the largest), n_matches, n_abusive, terms (in order of the alphabet) of the documents that hold a match."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), hashed=False)
                if not len(w.starts):
                    continue
                found, states = automaton.match(w.bytes, w.starts, w.ends)
                raw, by = w.bytes.tobytes(), defaultdict(list)
                for k, s in zip(found.tolist(), states.tolist()):
                    i = w.doc[k]
                    by[i].append((score(int(automaton.edits[s]), *window(w, raw, k, context)), automaton.terms[automaton.term[s]]))
                if by:
                    ids = part.column("doc_id").to_numpy()
                    best = [max(s for s, _ in v) for v in by.values()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[list(by)]), pa.array([b >= threshold for b in best]), pa.array(best), pa.array([len(v) for v in by.values()], pa.int64()),
                            pa.array([sum(s >= threshold for s, _ in v) for v in by.values()], pa.int64()), pa.array([sorted({t for _, t in v}) for v in by.values()], pa.list_(pa.string())),
                        ], ["doc_id", "toxic", "score", "n_matches", "n_abusive", "terms"],
                    )

    return texts(docs).mapInArrow(run, "doc_id long, toxic boolean, score double, n_matches long, n_abusive long, terms array<string>")


def keep_clean(docs: DataFrame, automaton: Automaton, context: int = CONTEXT, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't toxic; each is decided where it is, nothing is shuffled."""

    def judged(batches):
        for batch in batches:
            bad = np.zeros(batch.num_rows, bool)
            numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column("text")], ["row", "text"])
            for part in slices(numbered):
                w = Words(part.column("text"), hashed=False)
                if not len(w.starts):
                    continue
                raw, row = w.bytes.tobytes(), part.column("row").to_numpy()
                for k, s in zip(*(x.tolist() for x in automaton.match(w.bytes, w.starts, w.ends))):
                    i = w.doc[k]
                    if not bad[row[i]]:
                        bad[row[i]] = score(int(automaton.edits[s]), *window(w, raw, k, context)) >= threshold
            yield batch.filter(pa.array(~bad))

    return lean(docs).mapInArrow(judged, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxic documents of the whole table."""
    docs = read(spark, sf_dir, "documents")
    return scan(docs, learn(docs, read(spark, sf_dir, "labels"))).where("toxic")

