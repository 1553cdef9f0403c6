"""Operators against SQL, brute force, and the cases that each docstring defines."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siteloom.llm import fingerprints, licenses, mixing, neighbours, packing, pii, probminhash, quality, queries, suffixes, toxicity
from siteloom.llm.common import Words, is_small, shared_dir
from tests.conftest import DATA

STORY = " ".join(f"word{i * i % 977}" for i in range(400))
CLASH = dict.fromkeys(("_file", "_row", "_use", "node", "score", "keeper_id", "anchor_id", "offset", "n", "position", "epoch", "entities", "a", "b"), 7)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, copies, clashing names."""
    rows = [
        (1, STORY, "en", "web", 9), (2, STORY, None, None, None), (2, STORY, None, None, None), (3, None, "en", "web", 0), (4, "", "en", "web", 0), (5, " \n ", "en", "web", 3),
        (None, "lost text", "en", "web", 9), (6, STORY + " tail", "en", "web", 9), (7, "Licensed under the MIT License.\nmail a.b@mail.example.com now", "en", "code", 9),
        (8, "you idiot", "en", "web", 9), (9, "long " * 60_000, "en", "web", 9), (10, "ünï çödé", "fr", "web", 9), (6, "another text of a repeated id", "en", "web", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def test_what_may_be_broadcast(spark):
    """Bytes are counted, of strings and arrays too; nothing is small without room."""
    df = spark.createDataFrame([(i, "x" * 100, [1, 2, 3], None) for i in range(100)], "a long, b string, c array<long>, d string")
    assert is_small(df) and not is_small(df, 100 * 100) and is_small(df.limit(0), 0)


def test_shared_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_rows_as_sql(name, same):
    same(queries.queries()[name], queries.oracle_sql()[name])


def test_licenses(spark, odd, empty):
    got = licenses.scan(odd).collect()
    assert [(r.doc_id, r.begin, r.end) for r in got if r.license == "MIT" and r.dice == 1] == [(7, 0, 5)]
    assert licenses.scan(empty).count() == 0
    texts = dict(enumerate(t for _, t in licenses.TEMPLATES))
    whole = {i: texts[i] for i in range(25, 29)}  # whole MIT, ISC and BSD licences
    head = "\n".join(f"// {texts[19][i : i + 70]}" for i in range(0, len(texts[19]), 70))
    rows = [
        (1, f"MIT License\n\nCopyright (c) 2024 Some One\n\n{whole[25]}\n"), (2, f"ISC License\n\nCopyright 2024 Some One\n\n{whole[26]}"),
        (3, f"Copyright (c) 2020, Some One\n\n{whole[27]}"), (4, f"Copyright (c) 2020, Some One\n\n{whole[28]}"), (5, texts[29] + " and so on " + STORY),
        (6, f"{head}\nint main() {{ return 0; }}\n" + STORY), (7, "In prose, it is licensed under\nthe Apache License,\nVersion 2.0. Twice: Licensed under the Apache License, Version 2.0!"),
        (8, "one"), (9, "Released under the MIT License."), (9, "Released under the MIT License."),
    ]
    every = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter((r.doc_id, r.license) for r in every)
    assert {(1, "MIT"), (2, "ISC"), (3, "BSD-2-Clause"), (4, "BSD-3-Clause"), (5, "Apache-2.0"), (6, "MIT")} <= set(found)
    assert [(r.begin, r.end) for r in every if r.doc_id == 7 and r.dice == 1] == [(4, 12), (13, 21)] and not any(d == 8 for d, _ in found) and [r.dice for r in every if r.doc_id == 9].count(1) == 2


def _common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_fingerprints(odd, empty):
    got = {(r.doc_id, r.n_chars): r for r in fingerprints.fingerprints(odd).collect()}
    copy, longer = got[2, len(STORY)], got[6, len(STORY) + 5]
    assert (copy.prefix_id, copy.prefix_length, copy.suffix_id, copy.suffix_length) == (1, len(STORY), 1, len(STORY))
    assert (longer.prefix_id, longer.prefix_length, longer.suffix_id) == (1, len(STORY), None)
    assert got[3, 0].fingerprint == 0 and got[10, 8].prefix_id is None and got[3, 0].suffix_length is None
    assert fingerprints.fingerprints(odd).count() == odd.where("doc_id IS NOT NULL").count()
    assert fingerprints.fingerprints(empty).count() == 0


def _longest(rows, lead):
    """The result by comparing all pairs."""
    out = set()
    for i, t in rows:
        sides = []
        for turn in (1, -1):
            found = [(_common(t[::turn], u[::turn]), -j) for j, u in rows if j < i and t]
            found = [(n, j) for n, j in found if n >= lead or n == len(t) and (-j, t) in set(rows)]
            n, j = max(found, default=(None, None))
            sides += [None if n is None else -j, n]
        out.add((i, len(t), *sides))
    return out


def test_fingerprints_by_brute_force(spark):
    """Headers that many share, prefixes of each other, copies; over one partition and many, with ids in any order of the texts."""
    rng = np.random.default_rng(11)
    texts = ["".join("ab"[x] for x in rng.integers(0, 2, rng.integers(0, 14))) for _ in range(60)]
    texts += [t[: rng.integers(0, len(t) + 1)] + "".join("äb"[x] for x in rng.integers(0, 2, 5)) for t in texts] + texts[:20]
    for order in (rng.permutation(len(texts)), np.argsort(texts), np.argsort(texts)[::-1]):
        rows = [(int(i), texts[k]) for i, k in enumerate(order)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {(r.doc_id, r.n_chars, r.prefix_id, r.prefix_length, r.suffix_id, r.suffix_length) for r in fingerprints.fingerprints(df, lead=3).collect()}
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            assert got == _longest(rows, 3)


def test_prefix_hashes_by_brute_force():
    texts, others = ["abcabcabd", "ünïx", "", "aaaa"], ["abcabd", "xünï", "z", "aaab"]
    p, q = fingerprints.Prefixes(pa.array(texts)), fingerprints.Prefixes(pa.array(others))

    assert p.extension(q).tolist() == [_common(a, b) for a, b in zip(texts, others)]
    assert p.extension(q, np.array([3, 0, 0, 1]), np.array([0, 1, 0, 0])).tolist() == [_common(a[i:], b[j:]) for a, b, i, j in zip(texts, others, [3, 0, 0, 1], [0, 1, 0, 0])]


def _distance(a, b):
    """Levenshtein distance with swaps of neighbours (optimal string alignment)."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def _misspelt(terms, n, seed=1):
    """Terms with up to three edits at any place."""
    rng, out = np.random.default_rng(seed), []
    for t in terms:
        for _ in range(n):
            w = list(t)
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(0, len(w)))
                if rng.random() < 0.3 and k + 1 < len(w):
                    w[k], w[k + 1] = w[k + 1], w[k]
                else:
                    w[k : k + int(rng.integers(0, 2))] = list("abcdefgx"[int(rng.integers(0, 8))])
            out.append("".join(w))
    return out


def test_automaton_by_brute_force():
    terms = ["idiot", "pathetic", "scum", "motherfucker"]
    words = _misspelt(terms, 150)
    w = Words(pa.array([" ".join(words)]), hashed=False)
    automaton = toxicity.Automaton(terms)
    found, states = automaton.match(w.bytes, w.starts, w.ends)
    got = {words[i]: int(automaton.edits[s]) for i, s in zip(found, states)}
    best = {x: min((_distance(x, t) for t in terms if _distance(x, t) <= toxicity.allowed(t)), default=None) for x in words}
    assert got == {x: n for x, n in best.items() if n is not None}


def test_toxicity_scan_by_brute_force(spark):
    """Scores of whole documents, word by word: misspellings, address, quotation, report."""
    terms, rng = ["idiot", "pathetic", "scum"], np.random.default_rng(9)
    other = ["you", "said", '"', "house", "green", "tree", "walks", "Term", "u", "\u201csee\u201d", "nothing", "."]
    rows = [(i, " ".join(x for k in range(12) for x in (other[int(rng.integers(0, len(other)))], w) if k % 3 or x != w)) for i, w in enumerate(_misspelt(terms, 60, 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    automaton = toxicity.Automaton(terms)
    got = {r.doc_id: (r.toxic, r.score, r.n_matches, r.n_abusive) for r in toxicity.scan(df, automaton).collect()}
    wanted = {}
    for i, t in rows:
        raw, scores = t.lower().encode(), []
        places = [(m.start(), m.end()) for m in re.finditer(rb"[a-z0-9\x80-\xff]+", raw)]
        for k, (a, b) in enumerate(places):
            edits = min((_distance(raw[a:b].decode(), x) for x in terms if _distance(raw[a:b].decode(), x) <= toxicity.allowed(x)), default=None)
            if edits is None:
                continue
            before = raw[max(0, places[max(0, k - 6)][0] - 3) : a]
            after = raw[b : min(len(raw), places[min(len(places) - 1, k + 6)][1] + 3)]
            s = 1 - 0.15 * edits + 0.2 * bool(re.search(rb"\b(you|u)\b", before + b" " + after))
            quotes = [x for x in re.findall(rb'"|\xe2\x80[\x9c-\x9f]', before)]
            s -= 0.4 * (len(quotes) % 2 == 1 and bool(re.search(rb'"|\xe2\x80[\x9c-\x9f]', after))) + 0.4 * bool(re.search(rb"\b(said|term)\b", before + b" " + after))
            scores.append(round(s, 6))
        if scores:
            wanted[i] = (max(scores) >= 0.65, max(scores), len(scores), sum(x >= 0.65 for x in scores))
    assert got == wanted and {x[0] for x in wanted.values()} == {True, False}


def test_toxicity_context():
    """Quotation or report clears an exact term by itself; an address inside a quotation doesn't; common words one edit away are no matches."""
    for before, after in ((b'the "', b'" sign'), (b"they called him an ", b" in court"), (b'she wrote "', b'" twice'), (b"the word ", b" is old")):
        assert toxicity.score(0, before, after) < toxicity.THRESHOLD
    for before, after in ((b"what an ", b""), (b"you ", b""), (b'"you ', b'" '), (b'the end". an ', b" indeed")):
        assert toxicity.score(0, before, after) >= toxicity.THRESHOLD
    automaton = toxicity.Automaton(list(toxicity.TERMS), excluded=toxicity.LOOKALIKES)
    w = Words(pa.array(["the crown and my lover lose a witch, a clod and the moon"]), hashed=False)
    assert not len(automaton.match(w.bytes, w.starts, w.ends)[0])


def test_toxicity_learning_odd_tables(spark, odd, empty):
    """No documents, no labels, null and repeated labels, odd texts: the lexicon is the terms alone, or what is left to learn from."""
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (4, 0), (9, 0), (99, 1)], "doc_id long, toxic int")
    for docs, labels in ((empty, none), (odd, none), (empty, some), (odd, some)):
        automaton = toxicity.learn(docs, labels)
        assert set(automaton.terms) == set(toxicity.TERMS)
        assert [(r.doc_id, r.toxic) for r in toxicity.scan(odd, automaton).collect()] == [(8, True)]


def test_toxicity(odd, empty):
    automaton = toxicity.Automaton(list(toxicity.TERMS))
    assert [(r.doc_id, r.toxic) for r in toxicity.scan(odd, automaton).collect()] == [(8, True)]
    kept = toxicity.keep_clean(odd, automaton)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert toxicity.scan(empty, automaton).count() == toxicity.keep_clean(empty, automaton).count() == 0
    quoted = toxicity.score(0, b'he said "', b'" and left')
    assert quoted < toxicity.THRESHOLD <= toxicity.score(0, b"you are an ", b" really")


def test_toxicity_sample_keeps_all_but_copies(spark):
    """Texts that share their least word hash are no copies; the same words in other case and spacing are."""
    rows = [(i, f"same common words here {a}{b}", i % 2) for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "ijklmnop")]
    rows += [(99, "Same  common words here ai!", 0), (98, "words same common here ai", 0), (97, "", 0), (96, "...", 1)]
    got = [tuple(r) for r in toxicity.distinct(spark.createDataFrame(rows, "doc_id long, text string, toxic int")).collect()]
    assert len(got) == 65 and sum(t for _, t in got) == 32


def test_toxicity_learns_by_language(spark):
    """A stem of three endings, with a clean document that holds it, and a whole word; a stem that is clean in another language isn't learnt."""
    rows = [(i, f"le réeuxo{'abc'[i % 3]} texte n{i}", "fr", 1) for i in range(40)] + [(i, f"das schlimmwort text n{i}", "de", 1) for i in range(100, 130)]
    rows += [(i, f"gutwort{'xyz'[i % 3]} text n{i}", "de", 1) for i in range(140, 170)] + [(i, f"gutwort{'xyz'[i % 3]} text n{i}", "es", 0) for i in range(200, 260)]
    rows += [(i, f"le texte n{i}", "fr", 0) for i in range(300, 500)] + [(i, f"das schlimmwortige text n{i}", "de", 0) for i in range(500, 700)] + [(700, "un réeuxoa", "fr", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    automaton = toxicity.learn(docs, docs)
    assert set(automaton.terms) - set(toxicity.TERMS) == {"réeuxo*", "schlimmwort"}
    found = {r.doc_id for r in toxicity.scan(docs, automaton).where("toxic").collect()}
    assert found == {*range(40), *range(100, 130), 700}
    got = {(r.lang, r.toxic): (r.n, r.n_found) for r in toxicity.held_out(docs, docs).collect()}
    assert got["fr", 1][1] == got["fr", 1][0] > 0 == got["es", 0][1] and got["fr", 0][0] > 50


def test_toxicity_misspellings(spark):
    """Edits at any place, swaps as one edit, short terms, stems, two edits alone; lookalikes go one by one."""
    words = "diot xidiot tsupid idoit pathteic worhtless disgustnig scmu scumm".split()
    docs = spark.createDataFrame([(i, f"so a {w} here") for i, w in enumerate(words)] + [(90, "where the losers crown"), (91, "ein shclimmes ding"), (92, "ein schlimmes")], "doc_id long, text string")
    automaton = toxicity.Automaton(list(toxicity.TERMS), [b"schlimm"], excluded=toxicity.LOOKALIKES)
    got = {r.doc_id: (r.toxic, r.terms) for r in toxicity.scan(docs, automaton).collect()}
    assert [got[i] for i in range(len(words))] == [(True, [t]) for t in "idiot idiot stupid idiot pathetic worthless disgusting scum scum".split()]
    assert got[90] == (True, ["losers"]) and got[91] == got[92] == (True, ["schlimm*"])
    # 'stupit' is a word of other documents; 'stupd' is still a misspelling.
    rows = [(i, f"stupid{i} stupid n{i}", 1) for i in range(20)] + [(i, f"stupit text n{i}", 0) for i in range(30, 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learnt = toxicity.learn(table, table)
    test = spark.createDataFrame([(1, "stupit"), (2, "stupd")], "doc_id long, text string")
    assert [r.doc_id for r in toxicity.scan(test, learnt).collect()] == [2]


def test_probability_jaccard_by_definition():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = ({int(k): int(rng.integers(1, 5)) for k in rng.choice(30, 15, False)} for _ in range(2))
        every = a.keys() | b.keys()
        wanted = sum(1 / sum(max(a.get(t, 0) / a[s], b.get(t, 0) / b[s]) for t in every) for s in a.keys() & b.keys())
        sides = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert probminhash.probability_jaccard(*sides[0], *sides[1]) == pytest.approx(wanted)


def test_near_copies(spark, odd, empty):
    got = {(r.doc_id, r.keeper_id) for r in probminhash.duplicates(odd).collect()}
    assert got == {(2, 1), (6, 1)}
    kept = probminhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert probminhash.duplicates(empty).count() == 0
    # All pairs of the small table, by sets of words instead of arrays.
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    ids = sorted(docs)
    found = [probminhash.shingles(Words(pa.array([docs[i]]))) for i in ids]
    sides = [(h[np.argsort(h)], w[np.argsort(h)]) for _, h, w in found]
    roots = {i: i for i in ids}

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            if len(sides[x][0]) and len(sides[y][0]) and probminhash.probability_jaccard(*sides[x], *sides[y]) >= probminhash.THRESHOLD:
                a, b = sorted((root(ids[x]), root(ids[y])))
                roots[b] = a
    wanted = {(i, root(i)) for i in ids if root(i) != i}
    mine = {(r.doc_id, r.keeper_id) for r in probminhash.duplicates(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    assert len({i for i, _ in mine} & {i for i, _ in wanted}) >= 0.9 * len(wanted)
    assert {i for i, _ in mine} <= {i for i, _ in wanted}


def test_near_copies_in_hot_buckets(spark):
    """One band of one register puts all texts with a frequent shingle into one bucket; a chain of copies that fail against the hub is still one group."""
    base = [f"t{i}" for i in range(40)]
    chain = [" ".join(base[: 40 - 4 * k] + [f"n{k}x{j}" for j in range(4 * k)]) for k in range(5)]  # each is near the one before, the last not near the first
    rows = [(10 * i, t) for i, t in enumerate(chain)] + [(1000 + i, f"same three words and {i} other {i * 7} things {i * 11}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {i: (h[np.argsort(h)], w[np.argsort(h)]) for i, t in rows for _, h, w in [probminhash.shingles(Words(pa.array([t])))]}
    near = {(i, j) for i in found for j in found if i < j and probminhash.probability_jaccard(*found[i], *found[j]) >= 0.5}
    roots = {i: i for i in found}
    for _ in found:
        for i, j in near:
            roots[i] = roots[j] = min(roots[i], roots[j])
    got = {(r.doc_id, r.keeper_id) for r in probminhash.duplicates(df, bands=96, rows=1).collect()}
    assert got == {(i, r) for i, r in roots.items() if i != r}


@pytest.mark.parametrize("external", [0, 1 << 30])
def test_collection_by_brute_force(tmp_path, external):
    rng = np.random.default_rng(3)
    sizes = np.array([5, 1, 30, 17, 0, 30])
    symbols = rng.integers(0, 3, sizes.sum())
    symbols[-30:] = symbols[6:36]
    c = suffixes.Collection(symbols, sizes, suffixes.Files(f"file://{tmp_path}", external))
    texts = np.split(symbols, np.cumsum(sizes)[:-1])
    wanted = sorted((tuple(t[i:].tolist()), n, len(t) - i) for n, t in enumerate(texts) for i in range(len(t) + 1))
    assert [(n, k) for _, n, k in wanted] == list(zip(c.text.tolist(), c.length.tolist()))
    assert [texts[n][len(texts[n]) - k - 1] if k < len(texts[n]) else -1 for _, n, k in wanted] == c.bwt.tolist()
    for i in range(1, len(wanted)):
        a, b = wanted[i - 1][0], wanted[i][0]
        assert c.common[i] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_repeats(odd, empty):
    got = {(r.doc_id, r.first_doc_id, r.begin, r.end) for r in suffixes.repeats(odd).collect()}
    assert (2, 1, 0, 400) in got and (6, 1, 0, 400) in got and all(d != 9 for d, *_ in got)
    assert suffixes.repeats(empty).count() == 0


def test_repeats_of_hot_minimizers(spark):
    """Passages in other surroundings, by collections and, for minimizers that are too hot, by windows' hashes: the same rows as from all windows."""
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    passages = [word(70) for _ in range(3)]
    rows = [(i, f"{word(int(rng.integers(0, 40)))} {passages[i % 3]} {word(int(rng.integers(0, 40)))} {passages[(i + i // 3) % 3]}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first, wanted = {}, set()
    for i, t in rows:
        w = t.split()
        for b in range(len(w) - 49):
            first.setdefault(tuple(w[b : b + 50]), i)
    for i, t in rows:
        w, last = t.split(), None
        for b in range(len(w) - 48):
            f = first[tuple(w[b : b + 50])] if b < len(w) - 49 else None
            if last and last[0] != f:
                wanted.add((i, last[0], last[1], b + 49))
                last = None
            if f is not None and f < i and last is None:
                last = (f, b)
    for collection in (suffixes.COLLECTION, 300, 0):
        assert {(r.doc_id, r.first_doc_id, r.begin, r.end) for r in suffixes.repeats(df, collection=collection).collect()} == wanted


def test_quality(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert model.held_out > 0.7
    got = quality.score(odd, model).collect()
    assert len(got) == 12 and all(np.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    assert quality.score(empty, model).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(odd, labels.limit(0))).collect()} == {0.0}
    # Scores are log-density differences, whatever way they are computed.
    x = quality.statistics(pa.array([r.text for r in docs.limit(50).collect()]))
    m = quality.fit(np.concatenate((x, x + 0.3)), np.repeat([0, 1], 50), 0.5, 0.1)
    z = (x - m.centre) / m.scale
    logs = []
    for mean, factor in zip(m.means, m.factors):
        inverse = factor.T @ factor
        logs.append(0.5 * np.linalg.slogdet(inverse)[1] - 0.5 * np.einsum("ij,jk,ik->i", z - mean, inverse, z - mean) + np.log(0.5))
    assert np.allclose(m.scores(x), logs[1] - logs[0])


def test_statistics_by_brute_force():
    """Each statistic from its definition, over texts with nulls, empty ones, several lines and no letters."""
    texts = ["One two, two TWO three. 12%!\nsame\nsame\n", "", None, "...", "   \n\n", "ünï çödé ünï çödé", "a", STORY]
    got = quality.statistics(pa.array(texts))
    for t, row in zip(texts, got):
        raw = (t or "").encode()
        words = re.findall(rb"[a-zA-Z0-9\x80-\xff]+", raw)
        n, size = max(len(words), 1), max(len(raw), 1)
        lengths = np.array([len(w) for w in words] or [0])
        pairs = list(zip(words, words[1:]))
        lines = raw.split(b"\n") if raw else []
        if lines and not lines[-1]:
            lines.pop()
        share = lambda letters: sum(c in letters for c in raw) / size
        shares = np.array([k / size for k in Counter(raw).values()])
        others = bytes(c for c in range(128) if not chr(c).isalnum() and chr(c) not in " \t\n\r\v\f.!?")
        wanted = [
            np.log1p(len(raw)), np.log1p(len(words)), np.log1p(lengths.mean()), np.log1p(lengths.std()), np.sqrt(len(set(words)) / n), np.sqrt(share(others)), np.sqrt(share(b"0123456789")),
            np.sqrt(share(bytes(range(65, 91)))), share(b" \t\n\r\v\f"), np.log1p(len(raw) / max(len(lines), 1)), 1 - len(set(lines)) / len(lines) if lines else 0.0, -(shares * np.log2(shares)).sum(),
            1 - len(set(pairs)) / len(pairs) if pairs else 0.0, np.sqrt(share(b".!?")),
        ]
        for name, a, b in zip(quality.STATISTICS, row, wanted):
            assert a == pytest.approx(b, abs=1e-9), (name, t)


def test_quality_chooses_by_held_out_rows(spark):
    rng = np.random.default_rng(12)
    y = np.repeat([0, 1], [900, 300])
    x = rng.normal(size=(1200, len(quality.STATISTICS))) * (1 + y[:, None]) + y[:, None] * 0.8
    model = quality.chosen(x, y)
    fresh = rng.normal(size=(4000, len(quality.STATISTICS)))
    label = np.repeat([0, 1], 2000)
    accuracy = quality.balanced(model.scores(fresh * (1 + label[:, None]) + label[:, None] * 0.8), label)
    assert accuracy > 0.85 and abs(accuracy - model.held_out) < 0.08
    # A repeated doc_id counts with its longest text, whatever the order of the rows.
    rows = [(i, "word " * (i % 7 + 1) + "x" * i, i % 2) for i in range(40)]
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, None), (5, 0)], "doc_id long, quality int")
    twice = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(i, "short") for i, _, _ in rows], "doc_id long, text string")
    first, second = quality.train(twice, labels), quality.train(twice.orderBy(F.desc("text")), labels)
    assert np.allclose(first.centre, second.centre) and first.bias == second.bias
    assert quality.train(twice.limit(0), labels).means == [] and quality.train(twice, labels.limit(0)).means == []


def test_pii(spark, odd, empty):
    crf = pii.train(spark.read.parquet(f"{DATA}/documents.parquet"))
    got = {r.doc_id: r for r in pii.entities(odd, crf).collect()}
    text = "Licensed under the MIT License.\nmail a.b@mail.example.com now"
    assert [(text[e.begin : e.end], e.label) for e in got[7].entities] == [("a.b@mail.example.com", "EMAIL")]
    out = pii.redact(odd, crf)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("doc_id = 7").first().text.endswith("mail <EMAIL> now") and out.where("doc_id = 3").first().text is None
    assert pii.entities(empty, crf).count() == pii.redact(empty, crf).count() == 0


def test_pii_of_generated_texts(spark):
    """Held-out texts of the same forms (another seed): entities as a whole, over blanks too, and numbers that are none."""
    crf = pii.train(spark.createDataFrame([], "doc_id long, text string"))
    made = pii.generated(300, seed=99)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id long, text string")
    got = {(r.doc_id, e.begin, e.end, e.label) for r in pii.entities(docs, crf).collect() for e in r.entities}
    wanted = {(i, a, b, x) for i, (_, spans) in enumerate(made) for a, b, x in spans}
    assert len(got & wanted) >= 0.95 * len(wanted) and len(got & wanted) >= 0.95 * len(got)
    text = "card 4111 1111 1111 1111, years 1990 1995 2000 2005; +44 20 7946 0958 or +1 (212) 555-1234 now"
    out = pii.redact(spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "doc_id long, text string"), crf).collect()
    assert [r.text for r in out] == ["card <CARD>, years 1990 1995 2000 2005; <PHONE> or <PHONE> now"] * 2 + [None, ""]
    # Documents are labelled by themselves, whatever else is in the batch.
    some = [t for t, _ in made[:40]]
    n = pii.Nodes(pa.array(some))
    every = list(n.entities(n.labelled(crf)))
    for i, t in enumerate(some):
        one = pii.Nodes(pa.array([t]))
        at = int(n.offsets[i])
        assert [(a + at, b + at, x) for _, a, b, x in one.entities(one.labelled(crf))] == [(a, b, x) for r, a, b, x in every if r == i]


def test_decoding_loops_by_brute_force():
    """On small graphs with loops the labelling is nearly always the best one, and never far from it."""
    from itertools import product

    rng = np.random.default_rng(6)
    n, exact, tried = len(pii.LABELS), 0, 25
    every = np.array(list(product(range(n), repeat=5)))
    for _ in range(tried):
        links = rng.normal(size=(2, n, n))
        crf = pii.Crf({}, np.zeros((0, n)), links[0], (links[1] + links[1].T) / 2 + 2 * np.eye(n))
        unary = rng.normal(size=(5, n)) * 2
        chain, skip = np.array([[0, 1], [1, 2], [3, 4]]), np.array([[0, 2], [0, 4], [1, 3]])
        value = sum(unary[i, every[:, i]] for i in range(5)) + sum(crf.chain[every[:, a], every[:, b]] for a, b in chain) + sum(crf.skip[every[:, a], every[:, b]] for a, b in skip)
        mine = value[(every == crf.decode(unary, chain, skip)).all(1)][0]
        exact += mine == value.max()
        assert mine >= value.max() - 2
    assert exact >= 0.8 * tried


def test_copies_are_two_edges_apart():
    """Thirty copies that say little follow one that is next to strong evidence; all are linked with the first."""
    n = pii.Nodes(pa.array(["x123456 " + "filler " * 3 + ("some x123456 more " * 30)]))
    assert len(n.skip) == 30 and (n.skip[:, 0] == 0).all() and not len(n.chain)


def test_decoding_a_chain_by_brute_force():
    from itertools import product

    rng = np.random.default_rng(4)
    n = len(pii.LABELS)
    crf = pii.Crf({}, np.zeros((0, n)), rng.normal(size=(n, n)), rng.normal(size=(n, n)))
    unary = rng.normal(size=(4, n)) * 3
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[2, 3]])  # a tree, on which the messages are exact

    def value(y):
        return sum(unary[i, y[i]] for i in range(4)) + sum(crf.chain[y[a], y[b]] for a, b in chain) + sum(crf.skip[y[a], y[b]] for a, b in skip)

    assert tuple(crf.decode(unary, chain, skip)) == max(product(range(n), repeat=4), key=value)


def test_decoding_reaches_every_copy():
    """Evidence at one end of a chain of 60 copies decides them all, as the best labelling has it."""
    n = len(pii.LABELS)
    crf = pii.Crf({}, np.zeros((0, n)), np.zeros((n, n)), np.eye(n) * 4)
    unary = np.zeros((60, n))
    unary[:, 0] = 0.01
    unary[0, 2] = 30
    chain, skip = np.empty((0, 2), np.int64), np.array([(i, i + 1) for i in range(59)])
    assert crf.decode(unary, chain, skip).tolist() == [2] * 60


def test_curriculum(odd, empty):
    got = mixing.positions(odd).collect()
    assert {r.doc_id for r in got} == set(range(1, 11)) and {r.source for r in got} == {"", "web", "code"}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == len(got)
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize(("weights", "knots"), [(None, None), (None, [0.0, 0.25, 1.0]), ({"a": [1.0, 0.0, 0.5, 0.1], "b": [0.0, 1.0, 0.1, 0.1]}, [0.0, 0.3, 0.6, 1.0])])
def test_curriculum_by_integration(spark, weights, knots):
    """Positions are where a sum of small steps of the weights reaches a document's place in its source."""
    rows = [(i, "w " * (1 + i % 5), "abc"[i % 3 if i < 60 else 0]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.positions(df, weights, knots).collect()
    times = knots or [0.0, 1.0]
    sums = Counter()
    for i, t, s in rows:
        sums[s] += len(t.split())
    total, roots = sum(sums.values()), sum(n**0.5 for n in sums.values())
    w = {s: [n / total + ((1 - mixing.FLATTEN) * n / total + mixing.FLATTEN * n**0.5 / roots - n / total) * t for t in times] for s, n in sums.items()} | (weights or {})
    norm = [sum(x[k] for x in w.values()) for k in range(len(times))]
    grid = np.linspace(0, 1, 400_001)
    demand = {s: np.concatenate(([0], np.cumsum((y[1:] + y[:-1]) / 2 * np.diff(grid)))) for s, x in w.items() for y in [np.interp(grid, times, np.array(x) / norm)]}
    run = max(sums[s] / demand[s][-1] for s in sums)
    by = {s: sorted((r for r in got if r.source == s), key=lambda r: (r.epoch, r.position)) for s in sums}
    assert {r.doc_id for r in got} == set(range(90))
    for s, uses in by.items():
        at = 0
        for r in uses:
            place = run * grid[np.searchsorted(demand[s] * run, at - 1e-6)]
            assert abs(r.position - place) <= 1.01
            at += r.n_tokens
        assert at >= run * demand[s][-1] - 1e-6 and at - uses[-1].n_tokens < run * demand[s][-1] + 1e-6
    assert max(abs(mixing.positions(df, {"a": [1.0, 1.0], "b": [1.0, 1.0], "c": [1.0, 1.0]}).agg(F.max("position")).first()[0] - 3 * max(sums.values())), 0) < 10


def test_rows_of_files_without_places(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, "c", None)], "doc_id long, text string, source string").write.json(str(tmp_path / "docs"))
    docs = spark.read.schema("doc_id long, text string, source string").json(str(tmp_path / "docs"))
    assert sorted(r.doc_id for r in mixing.mix(docs).collect())[:2] == [1, 1] and packing.pack(docs, 4, by_place=True).count() == 2


def test_packing(odd, empty):
    windows = packing.pack(odd, window=64).orderBy("window_id").collect()
    stream = Counter()
    for w in windows:
        assert sum(p.doc_to - p.doc_from for p in w.pieces) == w.n_tokens and w.doc_ids == [p.doc_id for p in w.pieces]
        for p in w.pieces:
            stream[p.doc_id] += p.doc_to - p.doc_from
    assert [w.n_tokens for w in windows[:-1]] == [64] * (len(windows) - 1)
    assert stream[1] == 401 and stream[2] == 802 and not {3, 4, 5} & set(stream) and stream[9] == 60_001
    assert packing.pack(empty).count() == 0


def test_neighbours_odd_vectors(spark):
    """Dropped vectors, repeated ids, ties, clashing names; one task and several, queries in groups of two."""
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [5.0, 5.0]), (4, None), (5, []), (6, [1.0]), (7, [float("nan"), 1.0]), (None, [0.0, 1.0]), (8, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({x: F.lit(1) for x in ("block", "ids", "far", "side", "task", "g", "a")})
    wanted = [(1, 2, 1), (1, 3, 2), (2, 3, 1), (2, 1, 2), (3, 2, 1), (3, 1, 2), (8, 2, 1), (8, 3, 2)]
    for options in ({}, {"block": 1}, {"block": 2, "query_bytes": 16}):
        got = [(r.vec_id, r.neighbour_id, r.rank) for r in neighbours.knn(df, k=2, **options).orderBy("vec_id", "rank").collect()]
        assert got == wanted
    some = neighbours.knn(df, F.col("vec_id") % 2 == 0, k=2).orderBy("vec_id", "rank").collect()
    assert [(r.vec_id, r.neighbour_id, r.rank) for r in some] == [x for x in wanted if x[0] % 2 == 0]
    assert neighbours.knn(df.limit(0)).count() == neighbours.knn(df, F.lit(None).cast("boolean")).count() == 0


def test_neighbours_by_brute_force():
    """More dimensions than one exact float32 sum holds, copies, and blocks that come one after the other."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2500)).astype(np.float32)
    x[40] = x[7]
    a, b = (rng.integers(-127, 128, (n, 2500)).astype(np.int8) for n in (5, 9))
    assert (neighbours.product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()
    ids = np.arange(300)
    search = neighbours.Search(neighbours.Block(ids[:50], x[:50]), 4)
    for part in np.array_split(rng.permutation(300), 7):
        search.see(neighbours.Block(ids[part], x[part]))
    wide = x.astype(np.float64)
    for i in range(50):
        d = ((wide[i] - wide) ** 2).sum(1)
        assert search.found[i].tolist() == [j for j in np.lexsort((ids, d)) if j != i][:4]


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = cp.drop_near_copies(spark, cp.drop_toxic(spark, docs, DATA), DATA)
    assert kept.columns == docs.columns
    alive = {r.doc_id for r in kept.select("doc_id").collect()}
    windows = cp.run(spark, DATA).collect()
    # Every document that has words and was kept is in the stream, and no other.
    words = {r.doc_id for r in docs.where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0).select("doc_id").collect()}
    assert {i for w in windows for i in w.doc_ids} == alive & words
    assert sorted(w.window_id for w in windows) == list(range(len(windows)))
