"""Source divergence, spelling variants and licences against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pandas as pd
import pytest

from pulsegrain.llm import divergence, licenses, spelling

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
COLUMNS = "doc_id bigint, text string, lang string, source string"


def table(spark, rows, parts=3):
    df = spark.createDataFrame(rows, COLUMNS).repartition(parts)
    for name in ("n", "term", "number", "value", "rank", "word", "form", "row", "hits", "base", "salt"):
        df = df.selectExpr("*", f"named_struct('x', doc_id) as `{name}`")
    return df


# ---- divergence -----------------------------------------------------------------------------------------------------

def brute_audit(rows, least, top):
    groups, docs, counts = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        key = (lang or "", source or "")
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        groups.add(key)
        counts[key].update(own)
        docs[key[0]].update(set(own))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        own[None] = {t: sum(c[t] for s, c in own.items()) for t in kept}
        share = {s: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()} for s, c in own.items()}
        for s in own:
            if s is None:
                continue
            pairs = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in own if o not in (None, s)]
            found = [(share[None][t] - share[s][t], t.encode(), t) for t in kept if own[s][t] and share[s][t] > share[None][t]]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(found)[:top], 1)}
    return out


@pytest.mark.parametrize("block, top", [(256, 50), (2, 3)])
def test_audit_by_brute_force(spark, monkeypatch, block, top):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rng = random.Random(block)
    words = ["Über", "naïve", "a", "B", "日本", "é", "ﬀ", "\U0001f642", "z", "Zz"] + [f"w{chr(97 + k)}x" for k in range(26)]
    rows = []
    for k in range(220):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S10", None, "ü", "s\x00"][: 6 if k % 3 else 2])
        rows.append((k % 50, " ".join(rng.choices(words, [rng.randrange(1, 9) for _ in words], k=rng.randrange(40))) + rng.choice(["", "1x2", "\n"]), lang, source))
    rows += [(None, None, "xx", "alone"), (1, "", "yy", "one"), (1, "", "yy", "two"), (2, "a_b a.a A" * 20_000, "en", "s1"), rows[5], rows[5]]
    got = divergence.audit(table(spark, rows), 12, top).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == brute_audit(rows, 12, top)


def test_audit_of_ties(spark):
    """Thousands of terms share one value: the first of them in UTF-8 order are in the ranks."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = " ".join(a + b + c for a in letters for b in letters for c in "xyzé")
    rows = [(k, many if k % 2 else "common", "en", "s1" if k % 2 else "s2") for k in range(70)]
    got = divergence.audit(table(spark, rows))
    assert {tuple(r) for r in got.collect()} == brute_audit(rows, 30, 50)
    assert got.where("part = 'term'").count() == 51 and divergence.audit(table(spark, []), 1).count() == 0


def test_tiles_of_blocks():
    """A tile of two blocks gives both orders of every pair once."""
    shares = {0: {"a": 9, "b": 4}, 1: {"a": 2}, 300: {"b": 7}, 301: {}}
    rows = [("l", 0, 1, None, s, 1) for s in shares] + [("l", 0, 1, t, s, p) for s, own in shares.items() for t, p in own.items()]
    got = divergence.excess(pd.DataFrame(rows, columns=["lang", "a", "b", "term", "number", "p"]))
    want = {(s, t): sum(abs(shares[s].get(x, 1) - shares[t].get(x, 1)) for x in "ab") for s in shares for t in shares if (s < 256) != (t < 256)}
    assert {(r.s, r.t): r.excess for r in got.itertuples()} == want


# ---- spelling -------------------------------------------------------------------------------------------------------

def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts[spelling.worn("" if doc_id is None else str(doc_id), run.translate(LOW))] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(list)
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 5 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def test_worn_runs_follow_the_checksum():
    assert {len(spelling.worn(str(d), "abcdefgh")) for d in range(2000)} == {7, 8}
    assert len({spelling.worn(str(d), "abcdefgh") for d in range(4000)}) > 4


@pytest.mark.parametrize("block", [256, 3])
def test_variants_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(block)
    base = ["straßen", "garden", "aaaaaa", "aaaaaaa", "abababab", "Häuser×÷", "mountain", "x" * 300, "prefixes", "ÿyÿyÿy", "gardens"]
    rows, vary = [], []
    for word in base * 6:
        k = rng.randrange(len(word) + 1)
        vary.append(word[:k] + rng.choice(["", "a", "ü", "Z"]) + word[k + rng.randrange(2):])
    for number, word in enumerate([*base, *vary, *(v[:-1] + "q" for v in vary)]):
        for k in range(rng.choice([4, 5, 6, 30, 200, 900])):
            rows.append((number * 1000 + k, f"{word} 7 {word.upper()}-{word}", "en", "s"))
    rows += [(None, "garden " * 9, None, None), (3, None, "x", "y"), (4, "", "x", "y"), (5, "1234 éé", "x", "y"), rows[0], rows[0], (6, "longer " * 50_000, "e", "s")]
    got = spelling.variants(table(spark, rows)).collect()
    want = brute_variants(rows)
    assert len(got) == len(want) and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(r.form and r.root != r.form for r in got) and any(r.n_near > 3 for r in got)


def test_hot_beginnings_by_brute_force(spark):
    """Most words share a beginning or an end, so groups are cut into blocks."""
    rng = random.Random(8)
    words = {"pre" + "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 7))) for _ in range(900)} | {
        "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 7))) + "ung" for _ in range(500)}
    counts = spark.createDataFrame([(w, rng.choice([5, 6, 40, 300])) for w in words], "word string, n bigint")
    words_n = {r.word: r.n for r in counts.collect()}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    got = {r.word: (r.n_near, r.best.form, -r.best.minus) for r in spelling.neighbours(counts.repartition(3)).collect()}
    best = {w: min(o, key=lambda x: (-words_n[x], x)) for w, o in near.items() if o}
    assert got == {w: (len(near[w]), b, words_n[b]) for w, b in best.items()} and len(got) > 800


def test_variants_of_nothing(spark):
    assert spelling.variants(table(spark, [])).count() == 0
    assert spelling.variants(table(spark, [(1, None, "a", "b"), (2, "few words here", None, None)])).count() == 0


# ---- licences -------------------------------------------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_licenses(texts):
    """The method word by word: rarity, anchors, beginnings, key phrases, weights."""
    index, files = licenses.Index(), [words_of(t) for t in texts]
    df = Counter(w for own in files for w in set(own))
    weight = {w: round(1000 * (1 + math.log((1 + len(files)) / (1 + df[w])))) for w in index.words}
    out = []
    for own in files:
        def starts(phrase, own=own):
            p = phrase.split()
            return [i for i in range(len(own)) if own[i:i + len(p)] == p]
        base = {label: starts(phrase) for phrase, label in licenses.BASE}
        places = [i for hits in base.values() for i in hits]
        labels, score = {label for label, hits in base.items() if hits}, 0.0
        for number, template in enumerate(index.places):
            known = sorted({w for _, w in template} & set(own), key=lambda w: (-weight[w], w))[:licenses.ANCHORS]
            votes = defaultdict(set)
            for at, word in enumerate(own):
                if word in known:
                    for place, w in template:
                        if w == word:
                            votes[at - place].add(word)
            if not all(starts(index.phrases[k]) for k in index.keys[number]):
                continue
            for start, agree in votes.items():
                if len(agree) >= licenses.AGREE:
                    there = sum(weight[w] for place, w in template if 0 <= start + place < len(own) and own[start + place] == w)
                    part = there / sum(weight[w] for _, w in template)
                    if part >= licenses.LEAST_SCORE:
                        labels.add(index.labels[number])
                        score = max(score, part)
        names = sorted(label for label, hits in base.items() if hits)
        out.append((len(own), len(places), min(places, default=None), max(places, default=None), ",".join(names), ",".join(sorted(labels)),
                    1.0 if places else pytest.approx(score)))
    return out


def test_licenses_by_brute_force(spark):
    rng = random.Random(6)
    notices = [text for _, _, text in licenses.TEMPLATES]
    parts = ["CC", "by", "cc BY", "all", "Rights RESERVED", "general", "public", "License", "-", "\n", "é", "É", "license", "the", "apache", "mit", "42", "x", "version 2", "all all rights reserved"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)]
    for k in range(150):
        own = rng.choice(notices).split()
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = rng.choice(["Word", "THE", "license", "é"])
        cut = rng.choice([0, 0, len(own) // 3])
        texts.append(f"some words {k}, " * rng.randrange(4) + rng.choice([", ", " - ", "\n"]).join(own[cut:]).title() + rng.choice([".", " more words", "\n\n" + rng.choice(notices)]))
    texts += [None, "", " \n", "cc by", "cc by cc by cc by", "xcc by", "cc byx", "CC-BY", "cc é by", "GENERAL\tpublic(license)", "bacKup worK cc bİ İ",
              "all rights reserved " * 3_000, "licensed under the apache license, version 2.0. " * 2_000, "1 " * 40_000 + "released under the MIT License", "nul\x00cc\x00by\x00"]
    rows = [(n, t, "en", "s") for n, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.find_licenses(table(spark, rows)).collect()}
    for n, want in enumerate(brute_licenses(texts)):
        assert got[n] == want, texts[n] and texts[n][:300]
    assert sum(bool(v[5]) for v in got.values()) > 120


def test_licenses_of_odd_rows(spark):
    rows = [(None, "cc by", None, None), (7, "cc by", None, None), (7, "cc by", None, None), (7, None, "a", "b")]
    got = sorted((str(r.doc_id), r.n_base, r.labels, r.score) for r in licenses.find_licenses(table(spark, rows)).collect())
    assert got == [("7", 0, "", 0.0), ("7", 1, "cc-by", 1.0), ("7", 1, "cc-by", 1.0), ("None", 1, "cc-by", 1.0)]
    assert licenses.find_licenses(table(spark, [])).count() == 0


def test_license_scan_has_no_python(spark):
    plan = licenses.find_licenses(table(spark, [(1, "cc by", "a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|InPandas|ArrowEval|InArrow", plan)
