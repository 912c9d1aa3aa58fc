"""Conversation repair, language-model scoring and the source audit against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hangtally.llm import divergence, logbilinear, repair
from hangtally.llm.common import pieces

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_pieces_cut_at_spaces():
    raw = b"ab cde f " * 50 + b"x" * 90 + b" y"
    for size in (1, 7, 64, 1000):
        parts = list(pieces(raw, size))
        assert b"".join(parts) == raw and [w for p in parts for w in p.split()] == raw.split()


# ---- conversation repair ---------------------------------------------------------

def by_trying(rows):
    """Cheapest (cost, audit) over all edits with up to two insertions in each gap."""
    best, order = None, re.compile(r"(s?(ua)+)?")
    for edits in itertools.product(*[("D",) if f in (1, 2) else ("D", "K", "u", "a") for _, f in rows]):
        for gaps in itertools.product(*[("", "u", "a", "ua", "au")] * (len(rows) + 1)):
            out, cost, audit = gaps[0], 2 * sum(map(len, gaps)), "I" * len(gaps[0])
            for (initial, fault), e, gap in zip(rows, edits, gaps[1:]):
                out += ("" if e == "D" else initial if e == "K" else e) + gap
                cost += 3 if e == "D" else (fault == 3) + (0 if e == "K" else 2)
                audit += (e if e in "DK" else "R") + "I" * len(gap)
            if order.fullmatch(out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@pytest.mark.parametrize("seed", range(60))
def test_agenda_finds_the_cheapest_edits(seed):
    r = random.Random(seed)
    rows = [(r.choice("suaaut"), r.choice((0, 0, 0, 1, 2, 3))) for _ in range(r.randint(0, 3))]
    assert repair.solved(rows) == by_trying(rows)


def by_states(rows):
    """The same for any length: cheapest (cost, audit, output) for each state, row by row."""
    add = lambda w, c, a, *row: (w[0] + c, w[1] + a, w[2] + row)
    best = {0: (0, "", ())}
    for k in range(len(rows) + 1):
        for _ in range(3):
            for q, r, to in ((0, "user", 3), (1, "user", 3), (2, "user", 3), (3, "assistant", 2)):
                if q in best:
                    best[to] = min(best.get(to, (9 ** 9,)), add(best[q], 2, "I", (r, "")))
        if k == len(rows):
            return min(w for q, w in best.items() if q in (0, 2))
        role, text, fault = rows[k]
        new = {q: add(w, 3, "D") for q, w in best.items()}
        if fault not in (1, 2):
            for q, i, to in ((0, "s", 1), (0, "u", 3), (1, "u", 3), (2, "u", 3), (3, "a", 2)):
                if q in best and (role[:1] == i or i != "s"):
                    w = add(best[q], fault == 3, "K", (role, text)) if role[:1] == i else add(best[q], 2 + (fault == 3), "R", ({"u": "user", "a": "assistant"}[i], text))
                    new[to] = min(new.get(to, (9 ** 9,)), w)
        best = new


def told(rows):
    """Faults of one conversation's (turn, role, text), in order."""
    seen, out = set(), []
    for turn, role, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])):
        end = text.rstrip(" \t\n\x0b\f\r")
        out.append((turn, role, text, 1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0))
        seen.add((role, text))
    return out


CHATS = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"), (1, 2, "user", "Open"), (1, 3, "user", "Again!"), (1, 4, "assistant", " \t\n"), (1, 9, "assistant", "End."),
         (2, 0, "system", "Be."), (2, 1, "assistant", "Ok."), (2, 2, "user", "A."), (2, 2, "user", "A."), (2, 2, "user", "B."), (2, 3, "user", "A."),
         (3, 0, "tool", "x."), (3, 1, "", "y."), (3, None, "user", None), (3, None, "user", "z."), (3, 2, None, "q\xa0"), (4, 5, "user", ""),
         (None, 1, "user", "n."), (None, None, "assistant", "m."), (None, 2, "assistant", "é\U0001f600."), (5, 0, "user", "dropped"), (-7, None, "user", None),
         *[(6, k, "user" if k % 3 else "assistant", f"t{k % 7}" + "." * (k % 2)) for k in range(40)], *[(8, 3, "user", "same.")] * 9]


@pytest.fixture(scope="module")
def chats(spark):
    return spark.createDataFrame([(*c, 1, "x") for c in CHATS], "conv_id bigint, turn bigint, role string, text string, conv int, mark string").repartition(5)


def wanted(original, rows):
    out, own = [], defaultdict(list)
    for c, *row in rows:
        own[c].append(tuple(" " if v is None and k else v for k, v in enumerate(row)))
    for c in {x[0] for x in original}:
        t = told(own[c])
        cost, audit, made = by_states([x[1:] for x in t])
        turns = [x[0] for x in t if x[0] is not None]
        faults, first = Counter(x[3] for x in t), [x[1][:1] for x in t]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults[1], faults[2], faults[3],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [1, 3, 256])
def test_repair_of_awkward_conversations(spark, monkeypatch, chats, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    assert key(repair.report(chats, chats).collect()) == key(wanted(CHATS, CHATS))


def test_damage_and_empty_tables(chats):
    hurt = []
    for c, t, r, x in CHATS:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
            hurt += [row] * (2 if kind == 3 else 1)
    assert key(repair.damaged(chats).collect()) == key(hurt)
    assert key(repair.report(chats, repair.damaged(chats)).collect()) == key(wanted(CHATS, hurt))
    nothing = hashlib.sha256().hexdigest()
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", nothing) for r in repair.report(chats, chats.limit(0)).collect())
    assert repair.report(chats.limit(0), chats.limit(0)).count() == 0


# ---- language-model scoring --------------------------------------------------------

R = random.Random(8)
STEMS = {l: ["".join(R.choice(a) for _ in range(R.randint(2, 6))) for _ in range(150)] for l, a in (("x", "abcdef"), ("y", "mnopqr"))}
TALK = [(k, " ".join(R.choice(STEMS["xy"[k % 2]]) for _ in range(R.randint(1, 200)))) for k in range(500)]
TALK += [(None, "abc Mno"), (500, None), (501, ""), (502, " \n\t"), (503, "Éa ça\xa0b \x1cx"), (503, "a"), (504, "unseen " * 3000), (505, "z" * 5000), (506, "a" * 70 + " " + "Q" * 3)]


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*t, 1, "x") for t in TALK], "doc_id bigint, text string, row int, word string").repartition(3)


def test_scores_against_plain_python(spark, monkeypatch, talk):
    for name, value in (("OWN", 20), ("HEAD", 120), ("SLAB", 500)):
        monkeypatch.setattr(logbilinear, name, value)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    tokens = lambda t: [*WORDS.findall(lowered(t)), ""]
    c = Counter(w for d, t in TALK if d is not None and not held(d) for w in tokens(t))
    n = sum(c.values())
    training = talk.where(~logbilinear.held_out())
    counts = logbilinear.stored(logbilinear.counted(training), "t")
    assert dict(map(tuple, counts.collect())) == c
    v = logbilinear.vocabulary(counts)
    assert (v.tokens, v.distinct, v.own) == (n, len(c), 20) and 20 < len(v.words) <= 121
    state = logbilinear.fit(training, v)
    model = logbilinear.Model(v.size, state)
    own = {w.decode(): k for k, w in enumerate(v.words[:v.own])}
    unit = lambda w: own.get(w, v.own + logbilinear.class_of(w.encode()))
    members = defaultdict(list)
    for w, m in c.items():
        members[unit(w)].append(m)

    def units_given(one, two):
        logits = model.outputs @ (model.inputs[one] * model.scale[0] + model.inputs[two] * model.scale[1]) + model.bias
        p = np.exp(logits.astype(float) - logits.max())
        return p / p.sum()

    for context in ((v.size, v.size), (3, 25)):   # all words and each class's share for the rest
        p = units_given(*context)
        whole = sum(p[u] * (1 if u < v.own else (sum(m + 0.1 for m in members[u]) + 0.1) / (sum(members[u]) + 0.1 * (len(members[u]) + 1))) for u in range(v.size))
        assert whole == pytest.approx(1)
    got = logbilinear.scored(talk, counts, v, state).collect()
    want = []
    for d, t in TALK:
        base = score = 0.0
        one = two = v.size
        for w in tokens(t):
            u = unit(w)
            base += math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1)))
            inside = 1 if u < v.own else (c[w] + 0.1) / (sum(members[u]) + 0.1 * (len(members[u]) + 1))
            score += math.log10(units_given(one, two)[u]) + math.log10(inside)
            one, two = u, one
        want.append((d, held(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, base, score))
    order = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-4, abs=1e-4)


def test_model_beats_counts_on_held_out_texts(talk):
    rows = [r for r in logbilinear.report(talk.where("doc_id < 500")).collect() if r["held_out"]]
    assert len(rows) > 20 and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.05 * sum(r["n_tokens"] for r in rows)


def test_scores_without_rows_or_training(spark, talk):
    assert logbilinear.report(talk.limit(0)).count() == 0
    lone = logbilinear.report(talk.where(logbilinear.held_out())).collect()
    assert lone and all(r["train_tokens"] == r["n_known"] == r["base_score"] == 0 and math.isfinite(r["score"]) for r in lone)


# ---- source divergence ---------------------------------------------------------------

def audited(docs, least):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    count, seen, groups = Counter(), Counter(), set()
    for lang, source, text in docs:
        lang, source, words = lang or "", source or "", term.findall(lowered(text))
        groups.add((lang, source))
        count.update((lang, source, w) for w in words)
        seen.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (l, w), n in seen.items() if l == lang and n >= least]
        sources = sorted(s for l, s in groups if l == lang)
        shares = lambda n: {w: 1 + 10 ** 9 * (n[w] + 2) // (sum(n.values()) + 2 * len(kept)) for w in kept}
        p = {s: shares({w: count[lang, s, w] for w in kept}) for s in sources}
        q = shares({w: sum(count[lang, s, w] for s in sources) for w in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [("pair", t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in sources if t != s]
            terms = [("term", w, f(p[s][w], q[w])) for w in kept if count[lang, s, w] and p[s][w] > q[w]]
            for part, ranks in ((pairs, None), (terms, 10)):
                for rank, x in enumerate(sorted(part, key=lambda x: (-x[2], x[1].encode()))[:ranks], 1):
                    out.append((lang, s, *x, rank))
    return out


@pytest.mark.parametrize("least, held", [(3, 300_000), (3, 20), (1000, 300_000)])
def test_divergence_against_plain_python(spark, monkeypatch, least, held):
    monkeypatch.setattr(divergence, "LEAST_DOCS", least)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence, "HELD_PAIRS", held)
    r = random.Random(4)
    words = ["Ab", "ab", "é", "É", "漢字", "\U0001f600", "x1y", "z", "zz", "don't", "A-B", "ω"] + [f"w{chr(97 + k)}" for k in range(26)]
    docs = [(r.choice(["en", "de", None, ""]), r.choice([None, "a", "b", "b", "b", "ü"]), " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for _ in range(150)]
    docs += [("en", "a", None), ("en", "silent", ""), ("fr", "only", "un deux"), ("de", "numbers", "1 2 3\x00\t"), ("en", "b", "long " * 4000)] + docs[:5]
    df = spark.createDataFrame([(*d, k, 1, "x") for k, d in enumerate(docs)], "lang string, source string, text string, doc_id int, n int, item string").repartition(4)
    assert key(divergence.audit(df).collect()) == key(audited(docs, least))
    assert divergence.audit(df.limit(0)).count() == 0
