"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans. Four of them are exact rules (e-mail, IP address, card, phone) whose valid matches always count;
the others (credentials, bank accounts, names) are proposals. Labelers vote on every span: the shape, a validity rule, a
gazetteer of key words, prefixes and first names, the words before it, and what it is embedded in. A span is then known by
its signature: kind, votes, length class and, for proposals, what the span is made of: its share of digits, whether it has
capitals, small letters or other signs, and whether a label stands right before it. Counting signatures is one aggregation
over all documents; there are only so many (kinds x 3^labelers x length classes x 64), so their counts may go to the driver.
Expectation-maximisation estimates from the votes how often each labeler is right; a logistic classifier, trained on the
posteriors, weighs votes and make-up and decides which signatures of proposals are personal data.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import stored

# Patterns. Groups that repeat are possessive, which changes no match here, as nothing follows them, and keeps
# Java's matcher from recursing on long texts; a match may begin where a run of its first class begins or the last match ended.
_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SECRET = (r"(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey|access_key)\x20{0,2}[=:]\x20{0,2}[\"']?)[^\s\"'<>]{6,}+"
           r"|\bAKIA[0-9A-Z]{16}\b|(?<=\")[0-9a-f]{24,}+(?=\")")
_IBAN = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b"
_NAME = r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{L}++(?:\x20\p{Lu}\p{L}++)?"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "iban", "name")
_PATTERNS = (_EMAIL, _IP, _CARD, _PHONE, _SECRET, _IBAN, _NAME)

# Fixed values of the labelers.
_SHAPES = (
    r"[^@]{1,64}@.{1,250}\.[A-Za-z]{2,}", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}|[0-9]{14,19}",
    r"\+[0-9]{1,3}[ .-]?\(?[0-9].*", r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/=_.-]{12,}", r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,}",
    r"\S+ \p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?")
_GAZETTEERS = (
    r"(?i).*\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)", r"(?!0\.|127\.|255\.).*", r"[3-6].*", r"\+(?:1|7|2[0-9]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-8])\D?.*",
    r"AKIA.*", r"(?:DE|FR|ES|GB|IT|NL|AT|CH|BE|PT|PL)[0-9].*",
    r".* (?:Anna|Maria|Marie|Laura|Sara|Paul|Peter|Thomas|Michael|John|David|James|Mary|Jean|Pierre|José|Juan|Carlos|Hans|Karl)\b.*")
_CUES = (
    r"(?i)(?:mail|contact|kontakt|correo|courriel|write|schreib)", r"(?i)(?:\bip\b|server|host|address|adresse|dirección)",
    r"(?i)(?:card|visa|karte|carte|tarjeta|credit)", r"(?i)(?:tel|phone|call|mobile|fax|ruf)",
    r"(?i)(?:password|passwd|pwd|secret|token|key)", r"(?i)(?:iban|account|konto|compte|cuenta)", r"(?i)(?:name|dear|liebe|cher|estimad)")
_AGAINST = r"(?i)(?:version|isbn|issn|page|seite|chapter|section|figure|doi)\W*$"
_LABEL = r"[\p{L}_][=:]\x20{0,2}[\"']?$"
_CONTEXT = 40
LABELERS = ("shape", "validity", "gazetteer", "context", "edges")
VALIDITY = 1


def _spans(text: Column, number: int) -> Column:
    """Matches of a pattern as structs: number, start, stop (code points), the match, what stands before and after."""
    pattern = _PATTERNS[number]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    n = F.size(found)
    rows = F.arrays_zip(F.slice(between, 1, n).alias("gap"), found.alias("hit"), F.slice(between, 2, n).alias("next"))
    empty = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint,hit:string,before:string,after:string>>")

    def add(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["gap"])
        stop = start + F.length(row["hit"])
        one = F.struct(
            F.lit(number).alias("kind"), start.alias("start"), stop.alias("stop"), row["hit"].alias("hit"),
            F.substring(row["gap"], -_CONTEXT, _CONTEXT).alias("before"), F.substring(row["next"], 1, 1).alias("after"))
        return F.struct(stop.alias("at"), F.array_append(state["out"], one).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out"))
    return F.when(_may_hold(text, number), F.aggregate(rows, start, add, lambda s: s["out"])).otherwise(empty)


def _may_hold(text: Column, number: int) -> Column:
    """A cheap test that no text with a match fails."""
    if number == 0:
        return text.contains("@")
    if number == 3:
        return text.contains("+")
    if number == 4:
        return text.contains("=") | text.contains(":") | text.contains('"') | text.contains("AKIA")
    if number == 6:
        return F.lit(True)
    return text.rlike("[0-9][0-9.\\x20-][0-9.\\x20-]*[0-9]" if number in (1,) else "[0-9]")


def _pick(kind: Column, values: list[Column]) -> Column:
    out = values[-1]
    for number in range(len(values) - 2, -1, -1):
        out = F.when(kind == number, values[number]).otherwise(out)
    return out


def _valid(span: Column) -> Column:
    """Whether a match of an exact rule counts; proposals have no such rule and give null."""
    hit, digits = span["hit"], F.regexp_replace(span["hit"], "[^0-9]", "")
    n = F.length(digits)
    return _pick(span["kind"], [
        F.lit(True), hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), n.between(14, 19) & F.call_function("luhn_check", F.substring(digits, 1, 20)),
        n.between(10, 15), F.lit(None).cast("boolean")])


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, 2 abstains; a null test abstains."""
    return F.when(yes, "1").when(no, "0").otherwise("2")


def _make_up(span: Column) -> Column:
    """What a proposal is made of: digits in quarters of its length, then 0 or 1 for capitals, small letters, other signs, a label before it."""
    hit = span["hit"]
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
    quarters = F.least(F.lit(3), F.floor(4 * digits / F.length(hit)).cast("int")).cast("string")
    flags = [hit.rlike(r"\p{Lu}"), hit.rlike(r"\p{Ll}"), hit.rlike(r"[^\p{L}0-9]"), span["before"].rlike(_LABEL)]
    return F.when(span["kind"] >= len(BASE), F.concat(quarters, *[F.when(f, "1").otherwise("0") for f in flags])).otherwise("")


def _signature(span: Column, valid: Column) -> Column:
    """Kind, votes in the order of LABELERS, length class and make-up as one short text."""
    kind, hit, before, after = span["kind"], span["hit"], span["before"], span["after"]
    shape = _pick(kind, [hit.rlike(rf"^(?:{p})$") for p in _SHAPES])
    known = _pick(kind, [hit.rlike(rf"^(?:{p})$") for p in _GAZETTEERS])
    cue = _pick(kind, [before.rlike(p) for p in _CUES])
    embedded = F.substring(before, -1, 1).rlike(r"[\p{L}\p{N}_]") | after.rlike(r"[\p{L}\p{N}_]")
    length = F.when(F.length(hit) < 12, "s").when(F.length(hit) < 24, "m").otherwise("l")
    return F.concat(
        kind.cast("string"), F.lit(":"), _vote(shape, ~shape), _vote(valid, ~valid), _vote(known, F.lit(False)),
        _vote(cue, before.rlike(_AGAINST)), _vote(~embedded, embedded), F.lit(":"), length, F.lit(":"), _make_up(span))


def spans(text: Column) -> Column:
    """All matches of a text as structs start, kind, stop, valid (null for proposals, false if a base rule fails) and signature."""
    text = F.coalesce(text, F.lit(""))
    every = F.concat(*[_spans(text, n) for n in range(len(KINDS))])
    judged = F.transform(every, lambda s: F.struct(s.alias("span"), _valid(s).alias("valid")))
    return F.transform(judged, lambda s: F.struct(
        s["span"]["start"].alias("start"), s["span"]["kind"].alias("kind"), s["span"]["stop"].alias("stop"), s["valid"].alias("valid"),
        _signature(s["span"], s["valid"]).alias("signature")))


# ---- label model on signatures --------------------------------------------------------------------------------------

def estimate(counts: dict[str, int], rounds: int = 30) -> dict[str, float]:
    """Posterior of each signature by expectation-maximisation over the labelers' votes.

    Votes are independent given the truth; a labeler has its own rates of yes, no and abstention in either case, shared by
    all kinds, and every kind has its own prior. Where the validity rule votes the truth is known and stays; the first
    posteriors of the others are the smoothed majority of their votes.
    """
    votes = {s: tuple(map(int, s.split(":")[1])) for s in counts}
    known = {s: float(v[VALIDITY]) for s, v in votes.items() if v[VALIDITY] < 2}
    post = {s: known.get(s, (v.count(1) + 1) / (v.count(1) + v.count(0) + 2)) for s, v in votes.items()}
    for _ in range(rounds):
        rate = {(j, y, v): 1.0 for j, y, v in product(range(len(LABELERS)), (0, 1), (0, 1, 2))}
        prior: dict[str, list[float]] = {}
        for s, n in counts.items():
            own = prior.setdefault(s.split(":")[0], [1.0, 1.0])
            for y, p in ((0, 1 - post[s]), (1, post[s])):
                own[y] += n * p
                for j, v in enumerate(votes[s]):
                    rate[j, y, v] += n * p
        total = {(j, y): sum(rate[j, y, v] for v in (0, 1, 2)) for j in range(len(LABELERS)) for y in (0, 1)}
        for s in counts:
            no, yes = prior[s.split(":")[0]]
            z = math.log(yes / no) + sum(
                math.log(rate[j, 1, v] / total[j, 1]) - math.log(rate[j, 0, v] / total[j, 0]) for j, v in enumerate(votes[s]) if j != VALIDITY)
            post[s] = known[s] if s in known else 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return post


def classify(counts: dict[str, int], post: dict[str, float], steps: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> dict[str, float]:
    """Score of each signature by a logistic classifier on kind, votes, length and make-up, trained on the posteriors."""
    def features(signature: str) -> list[str]:
        kind, votes, length, made = signature.split(":")
        return [f"k{kind}", f"l{length}", *(f"{j}{v}" for j, v in enumerate(votes) if v != "2"), *(f"m{kind}{j}{v}" for j, v in enumerate(made) if j == 0 or v == "1")]

    names = {s: features(s) for s in counts}
    weights = dict.fromkeys((f for own in names.values() for f in own), 0.0)
    bias, total = 0.0, float(sum(counts.values())) or 1.0
    importance = {s: math.sqrt(n / total) for s, n in counts.items()}
    scale = sum(importance.values()) or 1.0
    score = {}
    for _ in range(steps):
        slope, lift = dict.fromkeys(weights, 0.0), 0.0
        for s, own in names.items():
            score[s] = 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + sum(weights[f] for f in own)))))
            error = importance[s] / scale * (post[s] - score[s])
            lift += error
            for f in own:
                slope[f] += error
        bias += rate * lift * 10
        for f in weights:
            weights[f] += rate * (slope[f] * 10 - ridge * weights[f])
    return score


def accepted(found: DataFrame) -> list[str]:
    """Signatures of proposals that are personal data, from the spans (column ``spans``) of all documents.

    Counts are partial sums of bounded number; nothing of a document goes to the driver.
    """
    rows = found.select(F.explode("spans").alias("s")).groupBy("s.signature").count().collect()
    counts = {r.signature: r["count"] for r in rows}
    score = classify(counts, estimate(counts))
    return sorted(s for s in counts if int(s.split(":")[0]) >= len(BASE) and score[s] >= 0.5)


def decided(found: Column, signatures: list[str]) -> Column:
    """The spans that count, in order of start and kind: valid base ones and accepted proposals."""
    good = F.array(*[F.lit(s) for s in signatures]).cast("array<string>")
    return F.array_sort(F.transform(
        F.filter(found, lambda s: F.coalesce(s["valid"], F.lit(False)) | F.array_contains(good, s["signature"])),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_documents(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row of docs (doc_id, text).

    A null text is empty and has no spans; repeated rows are read each for itself; other columns are ignored; an empty
    table gives no rows. Base matches that fail their rule are dropped and not tried again.
    """
    found = stored(docs.select("doc_id", spans(F.col("text")).alias("spans")), "pii-spans")
    best = found.select("doc_id", decided(F.col("spans"), accepted(found)).alias("found"))

    def only(number: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == number)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return best.select(
        "doc_id", *[only(n).alias(f"n_{k}") for n, k in enumerate(BASE)], F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data in its text replaced by its kind in brackets; overlapping ones by the first.

    All columns are kept; a null text stays null; repeated rows are redacted alike; an empty table gives no rows. Signatures are
    learned from the same documents.
    """
    # Spans are found once and stay with their rows; counting signatures reads nothing else.
    found = stored(docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), spans(F.col("text")).alias("spans")), "pii-rows")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    wrapped = found.select("row", F.col("row.text").alias("text"), decided(F.col("spans"), accepted(found)).alias("found"))

    def put(state: Column, s: Column) -> Column:
        piece = F.substr(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], F.array(piece, F.element_at(names, s["kind"] + 1))))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate("found", start, put, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    clean = F.when(F.size("found") > 0, text).otherwise(F.col("text"))
    return wrapped.select(*[clean.alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in docs.columns])
