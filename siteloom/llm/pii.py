"""PII: a skip-chain conditional random field.

Nodes are tokens (what stands between white space, without noise around it) that hold a digit or an @ sign or have at least
``LONG`` bytes; other tokens can be no entity. Labels are ``LABELS``: the kinds of entities, for phone and card numbers
also that a token goes on with the one before, so that numbers in groups ("+44 20 7946 0958") are one entity. Potentials:
features of a node, of its run (number tokens with a blank between) and of its neighbours; chain edges between tokens that
follow each other; skip edges between distant tokens or runs of the document that are the same, or similar (the same six or
more digits), whose kinds should agree. All alike are linked with the first of them, so n copies make n - 1 edges and
evidence is two edges away from each. Loopy max-product passing of messages in log space, damped, runs over all
documents of a batch at once until no message changes; messages that swing on loops are stopped after ``ROUNDS`` and two
rounds a node of their part, and labels may then differ between copies.

The weights are trained here, piece by piece: nodes by multinomial logistic regression, edges by counts of label pairs.
Labels for training come from strict patterns over at most ``TRAIN_DOCS`` documents that hold a node (those of least
hash of the doc_id), together with generated texts that hold every label in several forms, and numbers that are none.

Defined results: null, empty and blank texts have no entities and stay as they are; texts are read as a whole, at any
length; repeated rows are labelled alike; rows without a doc_id are dropped by ``entities`` and kept by ``redact``; a
model trained on an empty table, or on texts without nodes, knows the generated texts; of a repeated doc_id all texts are
in the sample; an empty table gives an empty result; other columns are ignored or passed through.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import Words, lean, materialize, read, slices, texts

#: A label with + goes on with the entity of the token before.
LABELS = ("O", "EMAIL", "PHONE", "PHONE+", "IP", "CARD", "CARD+", "SECRET")
KINDS = np.array([LABELS.index(x.rstrip("+")) for x in LABELS])
TRAIN_DOCS, ROUNDS, DAMPING, LONG = 2000, 8, 0.3, 20
#: Change of a message that counts as none.
SETTLED = 1e-6
_NOISE = re.compile(r"^[\"'(\[{<,;:!?*#%$&|`]+|[\"')\]}>,;:.!?*#%$&|`]+$")
_PART = re.compile(r"\(\d{2,4}\)")
_SHAPE = re.compile(r"[A-Za-z]+|[0-9]+")
_NUMBER = re.compile(r"\+?\(?\d[\d().-]*")


def core(token: str) -> tuple[int, int]:
    """Begin and end of a token without noise around it; brackets around an area code stay."""
    a, b = 0, len(token)
    if m := _NOISE.match(token):
        a = m.end()
    if a < b and (m := re.search(r"[\"')\]}>,;:.!?*#%$&|`]+$", token[a:])):
        b = a + m.start()
    if a and token[a - 1] == "(" and token[b : b + 1] == ")":
        a, b = a - 1, b + 1
    return (a, b) if a < b else (0, len(token))


def shape_of(token: str) -> str:
    return _SHAPE.sub(lambda m: ("d" if m[0][0].isdigit() else "a") + str(min(len(m[0]), 20)), token)


def features(token: str, before: str, after: str, run: list[str], place: int) -> list[str]:
    """Of a node, from its core, the tokens around it, and its run of number tokens, in which it is the one at ``place``."""
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    loose = _SHAPE.sub(lambda m: "d" if m[0][0].isdigit() else "a", token)
    out = ["bias", f"shape={shape_of(token)}", f"loose={loose}", f"length={min(n // 4, 12)}", f"digits={digits if digits < 4 else 4 + min((digits - 4) // 4, 4)}"]
    if "@" in token:
        out += ["at"] + ["at-domain"] * bool(re.search(r".@[\w.-]*\.\w", token))
    if digits == n:
        out += ["number", f"number={min(n, 20)}"]
    if n >= 16 and re.fullmatch(r"[0-9a-fA-F]+", token) and letters:
        out += ["hex", f"hex-long={n >= 28}"]
    if n >= 16 and letters and digits and token.isalnum():
        out.append("mixed")
    if n >= LONG and letters:
        turns = sum(x.islower() and y.isupper() or x.isupper() and y.islower() for x, y in zip(token, token[1:]))
        vowels = sum(c in "aeiouAEIOU" for c in token)
        out += [f"turns={min(turns, 6)}", f"vowels={min(10 * vowels // letters, 6)}", f"plain={re.fullmatch(r'[A-Za-z0-9_+/=-]+', token) is not None}"]
        if not digits:
            out += [f"letters:turns={min(turns, 6)}", f"letters:vowels={min(10 * vowels // letters, 6)}"]
    if token.startswith("+") and digits:
        out.append("plus")
    if _PART.fullmatch(token):
        out.append("area")
    parts = token.split(".")
    if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts):
        out.append("quad" if all(int(p) < 256 for p in parts) else "wide-quad")
    for name, other in (("before", before), ("after", after)):
        kind = "none" if not other else "plus" if other.startswith("+") and any(c.isdigit() for c in other) else "area" if _PART.fullmatch(other) else "local" if re.match(r"\d{3}-\d{3,4}", other) else "equals" if other == "=" else "digits" if any(c.isdigit() for c in other) else "word"
        out.append(f"{name}={kind}")
    if len(run) > 1:
        total = sum(c.isdigit() for x in run for c in x)
        first = "first" if place == 0 else "later"
        kind = "+" if run[0].startswith("+") else "(" if any("(" in x for x in run[:2]) else "-" if any("-" in x for x in run) else "."  if any("." in x for x in run) else ""
        years = all(re.fullmatch(r"(1[5-9]|20)\d\d", x) for x in run)
        pattern = " ".join(map(shape_of, run)) if len(run) <= 6 else "many"
        out += [f"run:{first}", f"run={pattern}:{first}", f"run-digits={kind}{min(total, 20)}:{first}", f"run-parts={kind}{min(len(run), 7)}:{first}"] + [f"years:{first}"] * years
        shapes = [shape_of(x) for x in run[max(0, place - 4) : place + 4]]
        here = min(place, 4)
        out += [f"upto={' '.join(shapes[: here + 1])}:{min(place, 5)}", f"ahead={' '.join(shapes[here:])}:{first}", f"zero={run[0].startswith('0')}:{first}", f"zero={run[0].startswith('0')}:{pattern}:{first}"]
        out.append(f"run-even={len(set(map(len, run))) == 1}:{min(len(token), 7)}:{min(len(run), 7)}")
    else:
        out.append("run=one")
    return out


_SINGLE = [
    ("EMAIL", re.compile(r"[\w.+-]+@[\w-]+(\.[\w-]+)+")),
    ("CARD", re.compile(r"\d{13,19}|\d{4}(-\d{4}){3}")),
    ("SECRET", re.compile(r"(?=.*\d)(?=.*[A-Za-z])[A-Za-z0-9_-]{20,}|[0-9a-fA-F]{32,}")),
    ("PHONE", re.compile(r"\+\d{10,14}|(\+?\d{1,3}[-.])?\(?\d{3}\)?[-.]\d{3}[-.]\d{4}")),
]
_GROUPS = [
    ("CARD", re.compile(r"\d{4}( \d{4}){3}|3\d{3} \d{6} \d{5}")),
    ("PHONE", re.compile(r"(\+?\d{1,3} )?\(\d{2,4}\) \d{3,4}[ .-]\d{3,4}|\+\d{1,3} \d{3}[.-]\d{3}[.-]\d{4}|\+\d{1,3}( \d{2,5}){2,4}|0\d{2,4} \d{6,8}")),
]


def single(token: str) -> str:
    """The label that patterns give a token by itself, for training."""
    for label, pattern in _SINGLE:
        if pattern.fullmatch(token):
            return label
    parts = token.split(".")
    return "IP" if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) < 256 for p in parts) else "O"


def strict(tokens: list[str]) -> list[str]:
    """The labels that patterns give to the tokens of a run: the longest group from the left, then tokens by themselves."""
    out, i = [], 0
    while i < len(tokens):
        for j in range(min(len(tokens), i + 6), i + 1, -1):
            group = " ".join(tokens[i:j])
            label = next((name for name, pattern in _GROUPS if pattern.fullmatch(group)), None)
            if label:
                out += [label] + [label + "+"] * (j - i - 1)
                i = j
                break
        else:
            out.append(single(tokens[i]))
            i += 1
    return out


def generated(n: int = 600, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Texts with (begin, end, label) of their entities: every label in its usual forms among words and numbers that are none."""
    rng = np.random.default_rng(seed)
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    few = lambda a, b: int(rng.integers(a, b))
    some = lambda letters, k: "".join(letters[i] for i in rng.integers(0, len(letters), k))
    word = lambda: some("aeioulnrstdm", few(2, 9))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    forms = [
        ("EMAIL", lambda: f"{word()}.{num(2)}@mail{num(1)}.example.com"), ("EMAIL", lambda: f"{word()}@{word()}.{some('acegmnort', 3)}"), ("EMAIL", lambda: f"{word()}_{word()}+x@{word()}.co.uk"),
        ("PHONE", lambda: f"+1 ({num(3)}) {num(3)}-{num(4)}"), ("PHONE", lambda: f"({num(3)}) {num(3)}-{num(4)}"), ("PHONE", lambda: f"{num(3)}-{num(3)}-{num(4)}"), ("PHONE", lambda: f"+{few(1, 99)}{num(10)}"),
        ("PHONE", lambda: f"+{few(20, 99)} {num(2)} {num(4)} {num(4)}"), ("PHONE", lambda: f"+{few(20, 99)} {num(3)} {num(3)} {num(3)}"), ("PHONE", lambda: f"+{few(20, 999)} {num(2)} {num(2)} {num(2)} {num(2)}"), ("PHONE", lambda: f"+{few(20, 99)} {num(4)} {num(6)}"),
        ("PHONE", lambda: f"+{few(1, 99)} {num(3)}-{num(3)}-{num(4)}"), ("PHONE", lambda: f"{num(3)}.{num(3)}.{num(4)}"), ("PHONE", lambda: f"+{few(20, 99)} {num(3)} {num(7)}"),
        ("PHONE", lambda: f"0{num(3)} {num(7)}"), ("PHONE", lambda: f"0{num(2)} {num(8)}"), ("PHONE", lambda: f"0{num(4)} {num(6)}"),
        ("IP", lambda: ".".join(str(x) for x in rng.integers(0, 256, 4))), ("CARD", lambda: num(16)), ("CARD", lambda: f"{num(4)}-{num(4)}-{num(4)}-{num(4)}"), ("CARD", lambda: f"{few(3, 7)}{num(3)} {num(4)} {num(4)} {num(4)}"),
        ("CARD", lambda: f"3{num(3)} {num(6)} {num(5)}"), ("SECRET", lambda: some("0123456789abcdef", 40)), ("SECRET", lambda: some("0123456789abcdef", 32)), ("SECRET", lambda: "sk" + some("0123456789abcdef", 24)),
        ("SECRET", lambda: some(mixed, few(24, 44))), ("SECRET", lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)), ("SECRET", lambda: some(mixed + "0123456789_-", few(24, 44))),
    ]
    none = [
        lambda: num(few(1, 7)), lambda: f"{num(1)}.{num(1)}", lambda: f"19{num(2)}-0{few(1, 9)}-1{num(1)}", lambda: f"{num(2)}%", lambda: f"{num(1)},{num(3)}", lambda: f"a{num(2)}", lambda: f"v{num(1)}.{num(1)}.{num(1)}",
        lambda: f"({num(3)})", lambda: f"@{word()}", lambda: " ".join(num(few(1, 4)) for _ in range(few(2, 9))), lambda: " ".join(str(few(1700, 2050)) for _ in range(few(2, 6))), lambda: " ".join(str(few(1800, 2050)) for _ in range(4)), lambda: some("aeioulnrstdmfghpb", few(20, 40)).capitalize(), lambda: some("aeioulnrstdmschfzkg", few(20, 40)), lambda: f"{few(1, 29)} {few(1, 13)} {few(1950, 2030)}",
        lambda: f"{few(0, 24)}:{num(2)}", lambda: f"{few(1900, 1990)}-{few(1990, 2030)}", lambda: f"{num(2)}x{num(2)}", lambda: ".".join(str(x) for x in rng.integers(200, 999, 4)), lambda: f"{num(4)} {num(7)}", lambda: f"{num(3)} {num(3)}", lambda: word() + word() + word() + word() + word(),
        lambda: f"https://{word()}.example.org/{word()}/{word()}-{word()}", lambda: f"{word()}-{word()}-{word()}-{word()}-{word()}", lambda: f"{word()}_{word()}_{word()}_{word()}_{num(1)}", lambda: f"{few(1, 99)} {few(100, 999)} {few(100, 999)}",
    ]
    out = []
    for i in range(n):
        text, spans, repeat = word(), [], None
        for k in range(8):
            text += " " if rng.random() < 0.9 else " = " if rng.random() < 0.5 else ": "
            if k % 2:
                if rng.random() < 0.3:
                    text += ("" if rng.random() < 0.1 else word() + " ") + none[few(0, len(none))]() + ("," if rng.random() < 0.5 else "")
                    text += " " + word()
                else:
                    text += " ".join(word() for _ in range(few(1, 4)))
            elif rng.random() < 0.55:
                label, form = forms[(i * 8 + k) // 2 % len(forms)]
                repeat = repeat if repeat and rng.random() < 0.2 else (label, form())
                if rng.random() < 0.15:
                    text += f"{num(few(1, 4))} "
                spans.append((len(text), len(text) + len(repeat[1]), repeat[0]))
                text += repeat[1] + ("." if rng.random() < 0.2 else "")
            else:
                text += none[few(0, len(none))]()
        out.append((text, spans))
    return out


@dataclass
class Crf:
    index: dict[str, int]
    weights: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log space
    skip: np.ndarray

    def nodes(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(LABELS)))
        for i, names in enumerate(rows):
            out[i] = self.weights[[self.index[x] for x in names if x in self.index]].sum(0)
        return out

    def decode(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Labels of the nodes; chain and skip are edges (n x 2), the earlier node first. Max-product until it settles."""
        edges = np.concatenate((chain.reshape(-1, 2), skip.reshape(-1, 2))).astype(np.int64)
        if not len(edges):
            return unary.argmax(1)
        pair = np.concatenate((np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)))
        # Messages go both ways: the first half from the earlier node.
        source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        back = np.roll(np.arange(len(source)), len(edges))
        message = np.zeros((len(source), len(LABELS)))
        # News goes one edge a round. What stops changing drops out with all that waits for it; loops may swing for ever.
        # Nodes in one run of overlapping edges hold a whole connected part.
        over = np.zeros(len(unary) + 1, np.int64)
        np.add.at(over, edges.min(1), 1)
        np.add.at(over, edges.max(1), -1)
        run = np.concatenate(([0], np.cumsum(np.cumsum(over)[: len(unary) - 1] == 0)))
        most = ROUNDS + 2 * np.bincount(run)[run[source]]
        live, rounds = np.arange(len(source)), 0
        belief = unary.copy()
        while len(live):
            rounds += 1
            new = ((belief[source[live]] - message[back[live]])[:, :, None] + pair[live]).max(1)
            new -= new.max(1, keepdims=True)
            change = (1 - DAMPING) * (new - message[live])
            message[live] += change
            np.add.at(belief, target[live], change)
            moved = np.abs(change).max(1) > SETTLED
            stirred = np.zeros(len(unary), bool)
            stirred[target[live[moved]]] = True
            again = stirred[source]
            again[live[moved]] = True
            live = np.flatnonzero(again & (rounds < most))
        belief = unary.copy()
        np.add.at(belief, target, message)
        return belief.argmax(1)


def fit(rows: list[tuple[list[str], str, int]], chains: Counter, skips: Counter, steps: int = 300) -> Crf:
    """rows: (features, label, count); chains and skips: how often a pair of labels is joined. Logistic regression by gradient steps with L2, edges by smoothed counts."""
    names = sorted({f for x, _, _ in rows for f in x})
    index = {f: i for i, f in enumerate(names)}
    y = np.array([LABELS.index(label) for _, label, _ in rows])
    counts = np.array([c for *_, c in rows], float)
    # Each label has the same say, whatever its part of the sample.
    counts /= np.bincount(y, counts, len(LABELS))[y]
    flat = np.array([index[f] for x, _, _ in rows for f in x])
    owner = np.repeat(np.arange(len(rows)), [len(x) for x, _, _ in rows])
    begins = np.searchsorted(owner, np.arange(len(rows)))
    order = np.argsort(flat, kind="stable")
    firsts = np.searchsorted(flat[order], np.arange(len(names)))
    by = owner[order]
    w, speed = np.zeros((len(names), len(LABELS))), np.zeros((len(names), len(LABELS)))
    target = np.eye(len(LABELS))[y]
    for _ in range(steps):
        z = np.add.reduceat(w[flat], begins)
        z = np.exp(z - z.max(1, keepdims=True))
        error = (z / z.sum(1, keepdims=True) - target) * counts[:, None]
        speed = 0.9 * speed - 0.5 * (np.add.reduceat(error[by], firsts) + 1e-3 * w)
        w = w + speed

    def edges(pairs: Counter, most: float, of: np.ndarray) -> np.ndarray:
        c = np.ones((len(LABELS), len(LABELS)))
        for (a, b), n in pairs.items():
            c[of[LABELS.index(a)], of[LABELS.index(b)]] += n
        p = c / c.sum()
        return np.clip(np.log(p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True))), -most, most)[of][:, of]

    skip = edges(skips, 2.0, KINDS)
    skip = (skip + skip.T) / 2
    # Whatever the sample holds of them: tokens that are alike are of one kind rather than of two.
    skip = np.where(KINDS[:, None] == KINDS, np.maximum(skip, 0.5), np.minimum(skip, -0.5))
    return Crf(index, w, edges(chains, 2.0, np.arange(len(LABELS))), skip)


class Nodes:
    """Nodes and edges of a column of texts; begin and end are byte places in ``raw``, owner is the row. ``joined``: nothing but a blank is between a node and the next."""

    def __init__(self, column: pa.Array):
        w = Words(column, solid=True, hashed=False, lower=False)
        self.raw, self.offsets = w.bytes, w.offsets
        # Tokens with a digit or an @ sign are found from the rare bytes, not by a pass over all tokens.
        marks = np.flatnonzero((w.bytes - np.uint8(48) < 10) | (w.bytes == 64))
        token = np.unique(np.concatenate((np.searchsorted(w.starts, marks, "right") - 1, np.flatnonzero(w.ends - w.starts >= LONG))))
        doc = w.doc[token]
        self.begin, self.end, self.owner, self.tokens, self.around = [], [], doc, [], []
        for t, d in zip(token.tolist(), doc.tolist()):
            raw = w.word(t).decode("utf-8")
            a, b = core(raw)
            self.begin.append(int(w.starts[t]) + len(raw[:a].encode()))
            self.end.append(int(w.starts[t]) + len(raw[:b].encode()))
            self.tokens.append(raw[a:b])
            first, last = w.first[d], w.first[d + 1]
            self.around.append((self._word(w, t - 1) if t > first else "", self._word(w, t + 1) if t + 1 < last else ""))
        n = len(token)
        follows = (np.diff(token) == 1) & (np.diff(doc) == 0) if n > 1 else np.empty(0, bool)
        at = np.flatnonzero(follows)
        self.chain = np.column_stack((at, at + 1)) if len(at) else np.empty((0, 2), np.int64)
        self.joined = np.zeros(n, bool)
        for i in at.tolist():
            self.joined[i] = self.raw[self.end[i] : self.begin[i + 1]].tobytes() in (b" ", b"\t")
        numbers = [_NUMBER.fullmatch(t) is not None for t in self.tokens]
        # Runs: first node and nodes; a plus sign begins one.
        self.run: list[tuple[int, int]] = []
        i = 0
        while i < n:
            j = i + 1
            while j < n and self.joined[j - 1] and numbers[j - 1] and numbers[j] and not self.tokens[j].startswith("+"):
                j += 1
            self.run += [(i, j)] * (j - i)
            i = j
        seen: dict = {}
        skip = set()
        for i, (t, d) in enumerate(zip(self.tokens, doc.tolist())):
            a, b = self.run[i]
            alone = b - a == 1
            digits = re.sub(r"\D", "", t if alone else "".join(self.tokens[a:b]))
            kinds = [("same", t.lower())] if alone or len(digits) >= 6 and i == a and len(t) >= 6 else []
            for kind in kinds + [("digits", digits)] * (i == a and 6 <= len(digits) <= 20):
                if (j := seen.setdefault((d, *kind), i)) != i:
                    skip.add((j, i))
        self.skip = np.array(sorted(skip), np.int64).reshape(-1, 2)

    @staticmethod
    def _word(w: Words, t: int) -> str:
        raw = w.word(t).decode("utf-8")
        a, b = core(raw)
        return raw[a:b]

    def features(self) -> list[list[str]]:
        return [features(t, x, y, self.tokens[a:b], i - a) for i, (t, (x, y), (a, b)) in enumerate(zip(self.tokens, self.around, self.run))]

    def strict(self) -> list[str]:
        out: list[str] = []
        while len(out) < len(self.tokens):
            a, b = self.run[len(out)]
            out += strict(self.tokens[a:b])
        return out

    def labelled(self, crf: Crf) -> np.ndarray:
        return crf.decode(crf.nodes(self.features()), self.chain, self.skip) if self.tokens else np.empty(0, np.int64)

    def entities(self, labels: np.ndarray):
        """(row, begin, end, kind): tokens that go on with the one before are one entity with it."""
        last = None
        for i in np.flatnonzero(labels).tolist():
            kind = LABELS[KINDS[labels[i]]]
            if last and LABELS[labels[i]].endswith("+") and last[4] == i - 1 and self.joined[i - 1] and last[3] == kind:
                last = (*last[:2], self.end[i], kind, i)
            else:
                if last:
                    yield last[:4]
                last = (int(self.owner[i]), self.begin[i], self.end[i], kind, i)
        if last:
            yield last[:4]


def _examples() -> tuple[list, Counter, Counter]:
    """(features, label, count) and pairs of labels of the generated texts."""
    rows, chains, skips = [], Counter(), Counter()
    made = generated()
    n = Nodes(pa.array([t for t, _ in made]))
    labels = []
    for begin, row in zip(n.begin, n.owner.tolist()):
        at = begin - int(n.offsets[row])
        label = next((x + "+" * (at > a) for a, b, x in made[row][1] if a <= at < b), "O")
        labels.append(label if label in LABELS else label.rstrip("+"))
    rows = [(f, label, 1) for f, label in zip(n.features(), labels)]
    chains.update((labels[a], labels[b]) for a, b in n.chain.tolist())
    skips.update((labels[a], labels[b]) for a, b in n.skip.tolist())
    return rows, chains, skips


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Crf:
    """Fit on a bounded sample of the documents that hold a digit or an @ sign, and on the generated texts."""
    sample = texts(docs).where(F.col("text").rlike("[0-9@]")).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = materialize(sample, "sample")

    def learn(batches):
        for batch in batches:
            for part in slices(batch):
                n = Nodes(part.column("text"))
                labels = n.strict()
                out = [("node", label, "", f) for f, label in zip(n.features(), labels)]
                out += [("chain", labels[a], labels[b], []) for a, b in n.chain.tolist()] + [("skip", labels[a], labels[b], []) for a, b in n.skip.tolist()]
                if out:
                    c = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(c[0]), pa.array(c[1]), pa.array(c[2]), pa.array(c[3], pa.list_(pa.string()))], ["kind", "a", "b", "f"])

    found = texts(docs).join(F.broadcast(sample), "doc_id").mapInArrow(learn, "kind string, a string, b string, f array<string>").groupBy("kind", "a", "b", "f").count().collect()
    found = sorted(found, key=lambda r: (r.kind, r.a, r.b, r.f))
    nodes, chains, skips = _examples()
    nodes += [(r.f, r.a, r["count"]) for r in found if r.kind == "node"]
    for kind, pairs in (("chain", chains), ("skip", skips)):
        pairs.update({(r.a, r.b): r["count"] for r in found if r.kind == kind})
    return fit(nodes, chains, skips)


def _redacted(part: pa.RecordBatch, crf: Crf):
    """(row, spans, text) of the rows that hold an entity; spans are (begin, end, label) in characters."""
    n = Nodes(part.column("text"))
    raw, by = n.raw.tobytes(), {}
    for row, begin, end, kind in n.entities(n.labelled(crf)):
        by.setdefault(row, []).append((begin, end, kind))
    for row, spans in by.items():
        at, pieces, places, seen, chars = int(n.offsets[row]), [], [], int(n.offsets[row]), 0
        for begin, end, label in spans:
            chars += len(raw[seen:begin].decode())
            length = len(raw[begin:end].decode())
            places.append((chars, chars + length, label))
            chars, seen = chars + length, end
            pieces += [raw[at:begin].decode(), f"<{label}>"]
            at = end
        pieces.append(raw[at : n.offsets[row + 1]].decode())
        yield row, places, "".join(pieces)


def entities(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, n_entities, entities (begin, end, label), text (redacted) of the documents that hold any; places are characters."""

    def run(batches):
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
        for batch in batches:
            for part in slices(batch):
                ids, out = part.column("doc_id").to_pylist(), list(_redacted(part, crf))
                if out:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[r] for r, *_ in out], pa.int64()), pa.array([len(s) for _, s, _ in out], pa.int64()),
                        pa.array([[dict(zip(("begin", "end", "label"), x)) for x in s] for _, s, _ in out], kind), pa.array([t for *_, t in out], pa.string()),
                    ], ["doc_id", "n_entities", "entities", "text"])

    return texts(docs).mapInArrow(run, "doc_id long, n_entities long, entities array<struct<begin: long, end: long, label: string>>, text string")


def redact(docs: DataFrame, crf: Crf) -> DataFrame:
    """``docs`` with entities in ``text`` replaced by their labels; n_chars, if there is one, is the new length."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                where = part.schema.get_field_index("text")
                changed = {r: t for r, _, t in _redacted(part, crf)}
                if changed:
                    old = part.column(where).to_pylist()
                    new = pa.array([changed.get(i, t) for i, t in enumerate(old)], part.schema.field(where).type)
                    part = part.set_column(where, part.schema.field(where), new)
                yield part

    out = lean(docs).mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of all documents, by a model trained on some of them."""
    docs = read(spark, sf_dir, "documents")
    return entities(docs, train(docs))
