"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and scores of the words around a hit.

Training. From a bounded sample of labelled rows, terms are counted by documents: words, and the beginnings of words. What is far more frequent in toxic ones enters the lexicon, as a word or, where several such words begin alike, as
a beginning. A logistic regression weighs a document's hits by kind.

Scoring. The lexicon is a trie. Its product with a Levenshtein automaton accepts every word within one edit of an entry; the
product is made deterministic state by state as words ask for it, so most words are dismissed after a few letters. A hit counts
as quoted where quotation marks or words of reporting stand around it, else as abuse.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pulsegrain.llm.common import per_worker

#: Labelled rows that training looks at, at most (a sample by hash beyond that).
MOST_LABELLED = 12_000
#: Entries of the lexicon, at most.
MOST_TERMS = 2_000
#: Entries of at least so many letters are found with one edit too.
LEAST_FUZZY = 5
WINDOW = 6
_KEPT_WORDS = 2**20
_EDGE = re.compile(r"^\W+|\W+$")
_PREFIXES = range(3, 9)
#: How many times as frequent in toxic documents a term must be, and the greatest weight (log of that) it gets.
LEAST_ODDS, MOST_WEIGHT = 6.0, 6.0

# Words that report what somebody said, and quotation marks.
REPORTING = frozenset(
    "said says wrote called quote quoted quoting reported sagte schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split())
_MARKS = "\"'“”„«»‘’‹›"


def plain(word: str) -> str:
    """A word in lower case without what is not a letter or digit at its ends."""
    return _EDGE.sub("", word.lower())


# ---- automaton ------------------------------------------------------------------------------------------------------

class Lexicon:
    """A trie of words and beginnings, and its product with a Levenshtein automaton.

    A state is a set of (trie node, edits used). A transition takes a letter as the next one, as a wrong one or as one
    too many, or skips a letter of the entry first; beginnings accept whatever follows, and decide for the words that they
    cover; those words are entries for the sake of what is an edit away from them. ``find`` gives the weight of the
    entry that a word is: above 0 for an entry itself, below 0 for one with an edit, 0 for none.
    """

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], edits: int = 1) -> None:
        self.edits = edits
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[float] = [0.0]
        self.opens: list[float] = [0.0]
        self.nears: list[float] = [0.0]
        self.fuzzy: list[bool] = [False]
        for entry, weight in words.items():
            node = self._add(entry)
            self.ends[node] = weight
            if len(entry) >= LEAST_FUZZY:
                self.nears[node] = weight
                self._mark(entry)
        for entry, weight in beginnings.items():
            self.opens[self._add(entry)] = weight
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.result: list[float] = []
        self.final: list[bool] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _add(self, entry: str) -> int:
        node = 0
        for c in entry:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                for column, value in ((self.children, {}), (self.ends, 0.0), (self.opens, 0.0), (self.nears, 0.0), (self.fuzzy, False)):
                    column.append(value)
            node = self.children[node][c]
        return node

    def _mark(self, entry: str) -> None:
        """Nodes on the way to an entry that may be met with an edit."""
        node = 0
        self.fuzzy[0] = True
        for c in entry:
            node = self.children[node][c]
            self.fuzzy[node] = True

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Add the states that a skipped letter leads to; keep the fewest edits of a node."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, used = todo.pop()
            if best.get(node, self.edits + 1) <= used:
                continue
            best[node] = used
            if used < self.edits:
                todo += [(child, used + 1) for child in self.children[node].values() if self.fuzzy[child]]
        return frozenset(best.items())

    def _state(self, members: frozenset) -> int:
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            self.steps.append({})
            opened = max([self.opens[n] for n, e in members if e == 0], default=0.0)
            exact = max([opened, *(self.ends[n] for n, e in members if e == 0)])
            near = max([self.nears[n] for n, e in members if e > 0], default=0.0)
            self.result.append(exact or -near)
            self.final.append(opened > 0 or not members)
        return self.states[members]

    def _step(self, state: int, c: str) -> int:
        pairs: set[tuple[int, int]] = set()
        for node, used in self.members[state]:
            child = self.children[node].get(c)
            if child is not None and (used == 0 or self.fuzzy[child]):
                pairs.add((child, used))
            if used < self.edits and self.fuzzy[node]:
                pairs.add((node, used + 1))
                pairs.update((n, used + 1) for n in self.children[node].values() if self.fuzzy[n])
        to = self.steps[state][c] = self._state(self._closed(pairs))
        return to

    def find(self, word: str) -> float:
        state = self.start
        for c in word:
            if self.final[state]:
                break
            to = self.steps[state].get(c)
            state = self._step(state, c) if to is None else to
        return self.result[state]


# ---- features of a text ---------------------------------------------------------------------------------------------

NAMES = ("abuse", "near", "quoted", "density")


def features(text: str, lexicon: Lexicon, kept: dict[str, float]) -> tuple[float, float, float, float]:
    """Weights of different hits that are abuse, of hits with an edit and of quoted hits, up to 20, and hits per hundred words."""
    tokens = text.lower().split()
    try:
        weights = list(map(kept.__getitem__, tokens))
    except KeyError:
        if len(kept) > _KEPT_WORDS:
            kept.clear()
        for token in set(tokens):
            if token not in kept:
                kept[token] = lexicon.find(_EDGE.sub("", token))
        weights = list(map(kept.__getitem__, tokens))
    if not any(weights):
        return 0.0, 0.0, 0.0, 0.0
    hits: list[dict[str, float]] = [{}, {}, {}]
    n = 0
    for at, weight in enumerate(weights):
        if weight:
            n += 1
            hits[2 if _quoted(tokens, at) else int(weight < 0)][tokens[at]] = abs(weight)
    return *(min(20.0, sum(h.values())) for h in hits), min(20.0, 100.0 * n / len(tokens))


def _quoted(tokens: list[str], at: int) -> bool:
    """Whether a mark opens at or before a word and closes at or after it, or a reporting word stands shortly before it."""
    before, after = tokens[max(0, at - WINDOW):at + 1], tokens[at:at + WINDOW + 1]
    opened = any(t[0] in _MARKS for t in before) and any(t.rstrip(".,;:!?")[-1:] in _MARKS for t in after if t.rstrip(".,;:!?"))
    return opened or any(_EDGE.sub("", t) in REPORTING for t in before[:-1])


# ---- training -------------------------------------------------------------------------------------------------------

@dataclass
class Model:
    """What training learns: lexicon and weights (bias first)."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [-9.0, 0.0, 0.0, 0.0, 0.0])


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic, half) of a bounded sample of labelled rows, without those held out; repeated labels count as the highest."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id")))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    count = known.count()
    sample = known.where(place < int(1_000_000 * min(1.0, most / max(1, count)))).withColumn("half", place % 2)
    # The sample is bounded by its parameter; Spark sends it to the tasks if it is small on disk, else it shuffles.
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id").select("text", "toxic", "half")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of terms in a partition: words as they are, beginnings with a hyphen.

    Clean documents count for every term: whether a toxic one has it shows only in the sum over all partitions.
    """
    toxic, clean, n = Counter(), Counter(), [0, 0]
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            own = {plain(w) for w in set(text.as_py().split())} - {""}
            n[label > 0] += 1
            side = toxic if label else clean
            side.update(own)
            side.update({w[:k] + "-" for w in own for k in _PREFIXES if len(w) > k})
    names = list(toxic) + [w for w in clean if w not in toxic]
    rows = [("", n[1], n[0]), *((w, toxic[w], clean[w]) for w in names)]
    for at in range(0, len(rows), 2**16):
        part = list(zip(*rows[at:at + 2**16]))
        yield pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64())], names=["term", "toxic", "clean"])


def _lexicon(terms: dict[str, tuple[int, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings, with weights, out of the terms (count, weight) that speak for toxicity.

    A beginning needs three such words; of those that contain each other the one with most evidence is taken. Words that it
    covers stay if they are long enough to be met with an edit: a beginning itself is only met as it is.
    """
    words = {t: w for t, (_, w) in terms.items() if not t.endswith("-")}
    begins: dict[str, float] = {}
    for term in sorted((t for t in terms if t.endswith("-")), key=lambda t: (-terms[t][0] * terms[t][1], t)):
        name = term[:-1]
        if not any(name.startswith(b) or b.startswith(name) for b in begins) and sum(w.startswith(name) for w in words) >= 3:
            begins[name] = terms[term][1]
    return {w: v for w, v in words.items() if len(w) >= LEAST_FUZZY or not any(w.startswith(b) for b in begins)}, begins


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> list[float]:
    """Logistic regression by Newton steps with a ridge on all weights but the bias."""
    x = np.c_[np.ones(len(x)), x]
    keep = ridge * np.r_[0.01, np.ones(x.shape[1] - 1)]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return [float(v) for v in w]


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_terms: int = MOST_TERMS) -> Model:
    """Learn lexicon and weights from labelled rows that are not held out.

    Terms are counted over half of the sample and weights are fitted on the other half, so that they see words as the
    lexicon meets them later. Terms of at least 1% of the toxic documents (three at least) that are ``LEAST_ODDS`` times as
    frequent there as in clean ones enter, ``most_terms`` at most. Without toxic and clean rows in both halves the model
    is the plain one, which calls nothing toxic.
    """
    sample = training_rows(docs, labels, most)
    counted = sample.where("half = 0").select("text", "toxic").mapInArrow(_terms, "term string, toxic bigint, clean bigint").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 2 or term = ''").persist()
    try:
        totals = counted.where("term = ''").first()
        if totals is None or not totals.toxic or not totals.clean:
            return Model()
        odds = (F.col("toxic") / F.lit(float(totals.toxic))) / ((F.col("clean") + 0.5) / F.lit(float(totals.clean)))
        found = counted.where((F.col("term") != "") & (F.col("toxic") >= max(3.0, 0.01 * totals.toxic)) & (odds >= LEAST_ODDS)).select(
            "term", "toxic", F.least(F.log(odds), F.lit(MOST_WEIGHT)).alias("weight")).orderBy(
            F.desc(F.col("toxic") * F.col("weight")), "term").limit(most_terms).collect()
    finally:
        counted.unpersist()
    words, beginnings = _lexicon({r.term: (r.toxic, r.weight) for r in found})
    lexicon_of = lambda: Lexicon(words, beginnings)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, kept = lexicon_of(), {}
        for batch in batches:
            x = [features(t.as_py(), lexicon, kept) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*x)] + [batch.column(1)], names=[*NAMES, "toxic"])

    # As many rows as the sample's bound allows at most, each a few numbers; equal ones are counted first.
    seen = sample.where("half = 1").select("text", "toxic").mapInArrow(measure, ", ".join(f"{n} double" for n in NAMES) + ", toxic int").collect()
    x = np.array([r[:4] for r in seen], float).reshape(-1, 4)
    y = np.array([r.toxic > 0 for r in seen], float)
    if not len(y) or y.min() == y.max():
        return Model()
    return Model(words, beginnings, _fit(x, y))


# ---- scoring --------------------------------------------------------------------------------------------------------

def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with a score from 0 to 1; the text alone decides it, null counts as empty.

    Texts are read whole and row by row; other columns may have any name. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, kept = per_worker(("lexicon", *model.words.items(), "-", *model.beginnings.items()), lambda: (Lexicon(model.words, model.beginnings), {}))
        bias, *weights = model.weights
        for batch in batches:
            z = [bias + sum(w * v for w, v in zip(weights, features(t.as_py() or "", lexicon, kept))) for t in batch.column(1)]
            score = pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), score], schema=pa.schema([batch.schema.field(0), pa.field("score", pa.float64())]))

    inner = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return inner.mapInArrow(run, StructType([inner.schema["row"], StructField("score", DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs, by a model trained on its labelled rows.

    A null doc_id has no label and is not held out. Repeated rows are scored each for itself.
    """
    found = scores(docs.select("doc_id", "text"), train(docs, labels)).select("row.doc_id", "score")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    return scores(docs, train(docs, labels)).where("score < 0.5").select("row.*")
