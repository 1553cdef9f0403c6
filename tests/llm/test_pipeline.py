"""Stages of the pipeline on odd and empty tables, and the whole of it against a version by brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from siteloom.llm import mixing, packing, pii, probminhash, toxicity
from siteloom.llm.common import Words
from tests.llm.test_operators import CLASH, STORY, _distance

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """A folder with a table of nulls, empty and long texts, repeated rows and ids, clashing names, and labels for some."""
    rows = [
        (1, STORY, "en", "web", 9), (2, STORY, None, None, None), (2, STORY, None, None, None), (3, None, "en", "web", 0), (4, "", "en", "web", 0), (5, " \n ", "en", "web", 3),
        (None, "lost text", "en", "web", 9), (6, STORY + " tail", "en", "web", 9), (7, "mail a.b@mail.example.com now", "en", "code", None), (8, "you idiot", "en", "web", 9), (8, "you idiot", "en", "web", 9),
        (9, "long " * 60_000, "en", "web", 9), (10, "ünï çödé", "fr", "web", 9), (None, None, None, None, None), (11, "call +44 20 7946 0958", None, "", 21),
    ]
    folder = tmp_path_factory.mktemp("odd")
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASH.items()})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None, 0), (None, 1, 1), (8, 1, 1), (8, 1, 0), (77, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_on_odd_tables(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    every = ids(docs)
    assert ids(cp.drop_toxic(spark, docs, odd_dir)) == every - Counter({8: 2})
    assert ids(cp.drop_near_copies(spark, docs, odd_dir)) == every - Counter({2: 2, 6: 1})
    redacted = cp.redact_pii(spark, docs, odd_dir)
    assert ids(redacted) == every
    got = {r.doc_id: (r.text, r.n_chars) for r in redacted.collect() if r.doc_id in (3, 4, 7, 11)}
    assert got == {3: (None, None), 4: ("", 0), 7: ("mail <EMAIL> now", None), 11: ("call <PHONE>", 12)}
    ordered = cp.order_by_curriculum(spark, docs, odd_dir)
    assert ids(ordered).keys() == every.keys() - {None} and ids(ordered)[2] >= 2
    for out in (cp.drop_toxic(spark, docs, odd_dir), cp.drop_near_copies(spark, docs, odd_dir), redacted, ordered):
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    packed = cp.pack_windows(spark, docs, odd_dir).collect()
    assert {i for w in packed for i in w.doc_ids} == {1, 2, 6, 7, 8, 9, 10, 11}
    assert {i for w in cp.run(spark, odd_dir).collect() for i in w.doc_ids} == {1, 7, 9, 10, 11}


def test_stages_on_empty_tables(spark, odd_dir, tmp_path):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{odd_dir}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage in plain Python over a list of documents."""
    rng = np.random.default_rng(21)
    word = lambda: "".join("aeioulnrstdm"[x] for x in rng.integers(0, 12, int(rng.integers(3, 9))))
    texts = [" ".join(word() for _ in range(int(rng.integers(40, 300)))) for _ in range(40)]
    texts += [t + " one more" for t in texts[:6]] + texts[6:10] + [texts[i] + " card 4111 1111 1111 1111 of x.y@mail.example.com" for i in (20, 21)]
    texts += [f"{t} you are an {x} now" for t, x in zip(texts[10:14], ("idiot", "idoit", "moron", "scumbag"))] + ["", " \n"]
    rows = [(int(i), t, "en", ("web", "code", None)[int(i) % 3 if int(i) % 2 else 0], len(t)) for i, t in zip(rng.permutation(len(texts)), texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    # Toxicity: any word within the edits of a term that isn't a common word. There is no quotation here.
    def toxic(text):
        for w in text.lower().split():
            best = min((_distance(w, t) for t in toxicity.TERMS if abs(len(w) - len(t)) < 3 and _distance(w, t) <= toxicity.allowed(t)), default=None)
            if best == 0 or best is not None and w.encode() not in toxicity.LOOKALIKES:
                return True
        return False

    kept = [r for r in rows if not toxic(r[1])]
    assert len(kept) <= len(rows) - 4
    # Near copies: components of all pairs.
    sides = {i: (h[np.argsort(h)], w[np.argsort(h)]) for i, t, *_ in kept for _, h, w in [probminhash.shingles(Words(pa.array([t])))]}
    roots = {i: i for i in sides}
    near = [(a, b) for a in sides for b in sides if a < b and len(sides[a][0]) and len(sides[b][0]) and probminhash.probability_jaccard(*sides[a], *sides[b]) >= probminhash.THRESHOLD]
    for _ in sides:
        for a, b in near:
            roots[a] = roots[b] = min(roots[a], roots[b])
    kept = [r for r in kept if roots[r[0]] == r[0]]
    assert len({roots[i] for i in sides}) <= len(sides) - 10
    # Personal data, a document at a time.
    crf = pii.train(spark.createDataFrame(kept, SCHEMA))

    def redact(text):
        n = pii.Nodes(pa.array([text]))
        out, at = b"", 0
        for _, a, b, kind in n.entities(n.labelled(crf)):
            out, at = out + text.encode()[at:a] + f"<{kind}>".encode(), b
        return (out + text.encode()[at:]).decode()

    kept = [(i, redact(t), s or "") for i, t, _, s, _ in kept]
    # Curriculum: places in a source by the hash of the id, positions where the integral of its weight reaches them.
    tokens = {i: max(1, len(t.split())) for i, t, _ in kept}
    sums = Counter()
    for i, _, s in kept:
        sums[s] += tokens[i]
    total, roots_ = sum(sums.values()), sum(n**0.5 for n in sums.values())
    w0 = {s: n / total for s, n in sums.items()}
    w1 = {s: (1 - mixing.FLATTEN) * n / total + mixing.FLATTEN * n**0.5 / roots_ for s, n in sums.items()}
    run = max(n / ((w0[s] + w1[s]) / 2) for s, n in sums.items())
    uses = []
    for s in sums:
        order = sorted((hashlib.md5(f"{mixing.SEED}{i}".encode()).hexdigest()[:16], i) for i, _, x in kept if x == s)
        at, epoch = 0, 0
        while at < run * (w0[s] + w1[s]) / 2 - 1e-6:
            _, i = order[epoch % len(order)]
            r, d = at / run, w1[s] - w0[s]
            uses.append((int(run * 2 * r / (w0[s] + (w0[s] ** 2 + 2 * d * r) ** 0.5) + mixing.EPSILON), s, i, epoch // len(order)))
            at, epoch = at + tokens[i], epoch + 1
    # Packing: one list of (document, token), cut.
    text = {i: t for i, t, _ in kept}
    stream = [(i, k) for _, _, i, _ in sorted(uses) if text[i].split() for k in range(len(text[i].split()) + packing.EOS)]
    wanted = {}
    for at in range(0, len(stream), packing.WINDOW):
        pieces = []
        for place, (i, k) in enumerate(stream[at : at + packing.WINDOW]):
            if pieces and pieces[-1][1] == i and pieces[-1][3] == k:
                pieces[-1] = (*pieces[-1][:3], k + 1)
            else:
                pieces.append((place, i, k, k + 1))
        wanted[at // packing.WINDOW] = pieces
    got = {w.window_id: [(p.place, p.doc_id, p.doc_from, p.doc_to) for p in w.pieces] for w in cp.run(spark, str(tmp_path)).collect()}
    assert got == wanted and len(got) > 2
