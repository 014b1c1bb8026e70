"""Personal data by weak supervision, in DataFrame operations only.

Base spans follow fixed patterns and checks and always stay.  Candidates are the matches of
the same patterns that fail their checks, and of looser patterns: addresses with "at" and
"dot" written out in four languages, other notations of network addresses, national and unpunctuated phone
numbers, card numbers in other groupings, and credentials (``secret``, a kind that has
candidates only).  Four labelers vote on every span, yes, no or not at all:

* form - the fixed pattern with its checks; for credentials the shapes that are issued;
* checksum - Luhn for cards, the sense of the parts of an address, the variety of digits;
* gazetteer - issuer ranges for cards, assigned country codes for phones, top-level domains
  for email, reserved blocks for network addresses, prefixes of issued credentials;
* context - the words beside the span: words that name its kind, in English, French, German or Spanish, vote yes, code-like
  neighbours (version, price, digits that go on) vote no.

Expectation-maximisation over the counts of votes (at most 3 ** 4 patterns a kind) estimates
how reliable each labeler is and how likely each pattern is personal.  A logistic classifier
of each kind is then trained on spans, that is on counts of votes with features of the span
(length, grouping, neighbours, share of digits; at most 3 ** 4 * 2 ** 5 cells a kind), with
those likelihoods as targets.  A candidate joins the spans if the classifier gives it
``ACCEPT`` or more and it overlaps no base span.

A kind without a span that the form labeler confirms gets no additions.  Defined results: null
text counts as empty and has no spans; repeated rows repeat their spans; places count code
points, the end is exclusive; ties of overlapping additions go to the one that starts first,
then to the kind listed first.  Extra columns pass through ``redact``, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Kinds of base spans, and of all spans.
KINDS = ("email", "ip", "card", "phone")
SPANS = (*KINDS, "secret")
ACCEPT = 0.9
BESIDE = 40  # characters of context on each side
#: The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches in time linear in the text and without recursion: a run is entered at its
#: beginning only (or where the last match ended), and nothing that it holds is given back.
LINEAR = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": PATTERNS["phone"],
}
#: Looser forms, for candidates only.
AT_WORDS, DOT_WORDS = "(?:at|arobase|arroba|ät)", "(?:dot|point|punto|punkt)"
AT, DOT = (rf"(?: ?(?:\({w}\)|\[{w}\]|\{{{w}\}}) ?| {w} )" for w in (AT_WORDS, DOT_WORDS))
HEX = "[0-9A-Fa-f]{1,4}"
LOOSE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    "ip": rf"(?i)(?<![0-9A-Za-z:.])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}|[0-9]{{1,3}}(?:(?:\[\.\]|\(\.\)|{DOT})[0-9]{{1,3}}){{3}})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}([._/]|\x{a0}|  |--)(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{6}\1[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+(./-])(?:00[1-9][0-9 ().-]{7,16}[0-9]|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|0[0-9]{1,4}[ /-][0-9]{3,4}[ -]?[0-9]{3,5}|0[1-9](?:([ .-])[0-9]{2})(?:\1[0-9]{2}){3}|[679][0-9]{2}(?:([ .-])[0-9]{2}(?:\2[0-9]{2}){2}| [0-9]{3} [0-9]{3}))(?![0-9]|[.-][0-9])",
    "secret": r"(?<![A-Za-z0-9+/_=.-])(?:[A-Z]{4}[0-9A-Z]{16}|[0-9a-fA-F]{32,128}|[A-Za-z0-9+/_-]{24,128}={0,2})(?![A-Za-z0-9+/_=-])",
}
#: A text without a match of this cannot match the pattern.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}
LOOSE_GUARDS = {
    "email": rf"(?i)[ (\[{{]{DOT_WORDS}[ )\]}}]", "ip": rf"(?i):[0-9A-F]{{0,4}}:|[0-9] ?[\[({{ ](?:\.|{DOT_WORDS})", "card": r"[0-9]{4}(?:[._/]|\x{a0}|  |--)[0-9]{4}", "phone": "[0-9]{2}[0-9)][ ./-]?[0-9]{3}|[0-9]{2}[ .-][0-9]{2}[ .-][0-9]{2}",
    "secret": "[A-Za-z0-9+/_-]{20}",
}
#: The gazetteers.  Country codes as assigned, two-letter domains as a rule, generic
#: ones by name; blocks of addresses that are reserved; ranges of card issuers; prefixes of credentials.
GENERIC = "com|org|net|edu|gov|mil|int|arpa|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|tel|cat|asia|post|app|dev|page|blog|shop|online|site|cloud|email|tech|xyz"
RESERVED_DOMAINS = "example|test|invalid|localhost|local"
COUNTRY_CODES = (
    "1|7|20|21[12368]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|27|29[0178]|3[0-469]|35[0-9]|37[0-8]|38[0-35-79]|4[013-9]|42[013]|50[0-9]|5[1-8]|59[0-9]|"
    "6[0-6]|67[02-9]|68[0-35-9]|69[0-2]|8[1246]|85[02356]|88[06]|9[0-58]|96[0-8]|97[0-7]|99[2-68]"
)
RESERVED_BLOCKS = r"(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|100\.(?:6[4-9]|[789][0-9]|1[01][0-9]|12[0-7])\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|192\.0\.[02]\.|192\.168\.|198\.1[89]\.|198\.51\.100\.|203\.0\.113\."
ISSUERS = "4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12}|35(?:2[89]|[3-8][0-9])[0-9]{12}|62[0-9]{14,17}"
ISSUED = r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[0-9A-Za-z-]{10,}|glpat-[0-9A-Za-z_-]{20})$"
#: How numbers of a country are written at home: ten digits from 0 in pairs, nine digits, an area code and the rest.
NATIONAL = r"^(?:0[1-9](?:[ .-][0-9]{2}){4}|[679][0-9]{2}(?:[ .-][0-9]{2}){3}|[679][0-9]{2} [0-9]{3} [0-9]{3}|0[1-9][0-9]{1,3}[ /-][0-9 -]{5,9})$"
#: Words that name a kind in four languages, at the end of what stands before a span (little words may follow), and words that name something else.
LITTLE = r"(?:\W+(?:is|at|on|to|me|us|ist|an|unter|auf|est|le|la|au|sur|es|al|en|el|de))?\W*$"
NAMING = {
    "email": r"(?i)(?<![\p{L}])(e-?mail|mail|contact|write|reply|address|courriel|adresse|écri\w*|contactez|kontakt|schreib\w*|correo|dirección|contacto|escrib\w*)" + LITTLE,
    "ip": r"(?i)(?<![\p{L}])(ip|ipv[46]|host|server|address|client|from|login|serveur|adresse|hôte|rechner|servidor|dirección|cliente|equipo)" + LITTLE,
    "card": r"(?i)(?<![\p{L}])(card|visa|mastercard|amex|credit|debit|pan|cc|carte|crédit|débit|\w*karte|tarjeta|crédito|débito)" + LITTLE,
    "phone": r"(?i)(?<![\p{L}])(phone|tel|telephone|call|mobile|cell|fax|contact|dial|sms|tél|téléphone|portable|appel\w*|telefon\w*|handy|ruf\w*|anruf\w*|teléfono|móvil|llam\w*)" + LITTLE,
    "secret": r"(?i)(token|secret|passwo?r?d|key|auth|bearer|credentials?|api_?key|jeton|clé|mot de passe|schlüssel|kennwort|passwort|clave|contraseña)[\W_]*$",
}
CODE = r"(?i)(version|v|ver|section|chapter|figure|isbn|issn|\$|€|£|#|no|nr|id|order|invoice|sha|commit|checksum|md5|commande|facture|chapitre|bestellung|rechnung|kapitel|pedido|factura|capítulo)[\W_]*$"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    codes = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(codes, lambda d, i: F.when(i % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(F.filter(doubled, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def _passes(kind: Column, found: Column) -> Column:
    """The checks of the base spans."""
    digits = _digits(found)
    parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    ranged = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.expr("true") & (F.lpad(p, 3, "0") <= F.lit("255"))))
    card = F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    return F.when(kind == "email", F.lit(True)).when(kind == "ip", ranged).when(kind == "card", card).otherwise(F.length(digits).between(10, 15))


MATCH = "struct<kind:string,strict:boolean,nth:int,gap:int,found:string,left:string,right:string>"


def _matches(text: Column, kind: str, pattern: str, guard: str, strict: bool) -> Column:
    """Matches of a pattern: order, characters since the last one, text, and what stands beside."""
    cut = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(pair: Column, i: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), i.alias("nth"), F.char_length(pair["gap"]).alias("gap"), pair["hit"].alias("found"),
            F.right(pair["gap"], F.lit(BESIDE)).alias("left"), F.substring(pair["next"], 1, BESIDE).alias("right"),
        )

    pairs = F.arrays_zip(F.slice(cut, 1, F.size(hits)).alias("gap"), hits.alias("hit"), F.slice(cut, 2, F.size(hits)).alias("next"))
    return F.when(text.rlike(guard), F.transform(pairs, one)).otherwise(F.array().cast(f"array<{MATCH}>"))


def spans(docs: DataFrame) -> DataFrame:
    """A row for each match and one without ``kind`` for each document: ``row``, doc_id, ``digest`` of the text, kind, strict, start, end, found, left, right."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")).withColumn("digest", F.xxhash64("text"))
    every = [_matches(F.col("text"), k, p, GUARDS[k], True) for k, p in LINEAR.items()]
    every += [_matches(F.col("text"), k, p, LOOSE_GUARDS[k], False) for k, p in LOOSE.items()]
    itself = F.array(F.lit(None).cast(MATCH))
    each = rows.select("doc_id", "row", "digest", F.explode(F.concat(itself, *every)).alias("m")).select("doc_id", "row", "digest", "m.*")
    order = Window.partitionBy("row", "kind", "strict").orderBy("nth")
    # one window over all rows, so that texts are searched once; the document's own row has no end
    placed = each.withColumn("end", F.sum(F.col("gap") + F.char_length("found")).over(order))
    return placed.withColumn("start", F.col("end") - F.char_length("found")).drop("nth", "gap")


VOTES = ("form", "checksum", "gazetteer", "context")
SHAPES = ("usual_length", "even_groups", "free_left", "free_right", "numeric")


def _of(kind: Column, each: dict[str, Column]) -> Column:
    """The value for the span's kind."""
    out = F.lit(None)
    for name, value in each.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def voted(found: DataFrame) -> DataFrame:
    """``found`` with ``base``, the votes (``VOTES``: 1, -1 or 0) and the features (``SHAPES``: 0 or 1)."""
    kind, text, digits, left, right = F.col("kind"), F.col("found"), F.col("digits"), F.col("left"), F.col("right")
    rows = found.withColumn("digits", _digits(text)).withColumn("n", F.length("digits")).withColumn("base", F.col("strict") & _passes(kind, text))
    varied = F.size(F.array_distinct(F.split(digits, ""))) > 2
    mixed = F.size(F.array_distinct(F.split(digits, ""))) > F.when(F.col("n") > 8, 3).otherwise(2)
    plain = F.lower(F.regexp_replace(F.regexp_replace(text, f"(?i){AT}", "@"), f"(?i){DOT}|\\[\\.\\]|\\(\\.\\)", "."))
    rows = rows.withColumn("plain", plain)
    plain, last, n = F.col("plain"), F.regexp_extract("plain", "([a-z0-9-]+)$", 1), F.col("n")
    lettered = text.rlike("[A-Za-z]") & text.rlike("[0-9]")
    kinds_of = F.size(F.array_distinct(F.split(F.lower(text), "")))
    hexed = text.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") & F.length(text).isin(32, 40, 64)
    octets = F.forall(F.split(plain, r"\."), lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= F.lit("255")))
    form = _of(kind, {k: _vote(F.col("base"), F.col("strict")) for k in KINDS} | {"secret": _vote((hexed & lettered) | text.rlike(ISSUED), ~lettered)})
    checksum = _of(kind, {
        "email": _vote(plain.rlike(r"^[a-z0-9][a-z0-9._%+-]*+@(?:[a-z0-9-]++\.)++[a-z]{2,}+$") & ~plain.rlike(r"\.\.|@-|-\.|\.-|\.@"), plain.rlike(r"\.\.|@-|-\.|\.@")), "ip": _vote(plain.contains(":") & (F.length(plain) > 8) | octets & varied, ~octets & ~plain.contains(":")),
        "card": _vote(luhn(digits) & varied & n.between(13, 19), F.lit(True)), "phone": _vote(mixed & n.between(10, 13), ~mixed | (n < 7) | (n > 15)), "secret": _vote(lettered & (kinds_of >= 10), kinds_of < 8),
    })
    dialled = F.regexp_replace(digits, "^00", "")
    gazetteer = _of(kind, {
        "email": _vote(last.rlike(f"^(?:{GENERIC}|[a-z]{{2}})$"), last.rlike(f"[0-9]|^(?:{RESERVED_DOMAINS})$")), "ip": _vote(~plain.rlike(f"^(?:{RESERVED_BLOCKS})") & ~plain.rlike("^(?:::|fe80:|f[cd])"), F.lit(True)),
        "card": _vote(digits.rlike(f"^(?:{ISSUERS})$"), F.lit(True)), "phone": _vote(text.rlike(r"^(?:\+|00)") & dialled.rlike(f"^(?:{COUNTRY_CODES})") | text.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-]+[2-9][0-9]{2}") | text.rlike(NATIONAL), text.rlike(r"^(?:\+|00)")),
        "secret": _vote(text.rlike(ISSUED), F.lit(False)),
    })
    joined = left.rlike("[A-Za-z0-9_]$") | right.rlike("^[A-Za-z0-9_@]")
    context = _of(kind, {k: _vote(left.rlike(NAMING[k]) | (left.rlike(r"=\s*[\"']?$") if k == "secret" else F.lit(False)) & ~left.rlike(CODE), joined | left.rlike(CODE)) for k in SPANS})
    groups = F.array_distinct(F.filter(F.split(text, "[0-9A-Za-z]+"), lambda g: g != ""))
    usual = _of(kind, {"email": F.length(plain) <= 64, "ip": F.length(plain) >= 7, "card": n.isin(15, 16), "phone": n.between(10, 12), "secret": F.length(text).isin(20, 32, 36, 40, 64)})
    flags = {"usual_length": usual, "even_groups": F.size(groups) <= 1, "free_left": ~left.rlike(r"[A-Za-z0-9_./-]$"), "free_right": ~right.rlike("^[A-Za-z0-9_/@-]"), "numeric": 2 * n >= F.length(text)}
    votes = {"form": form, "checksum": checksum, "gazetteer": gazetteer, "context": context}
    rows = rows.withColumns(votes | {k: F.coalesce(v, F.lit(False)).cast("int") for k, v in flags.items()})
    return rows.drop("digits", "n", "plain", "found", "left", "right")


@dataclass(frozen=True)
class Labeling:
    """What was learned of each kind.

    ``reliability``: share of right votes of each labeler; ``belief``: likelihood of each
    pattern of votes; ``weights``: of the classifier, by votes, features and a constant.
    """

    reliability: dict[str, tuple[float, ...]]
    belief: dict[tuple[str, tuple[int, ...]], float]
    weights: dict[str, tuple[float, ...]]

    def chance(self, kind: str, votes: tuple[int, ...], shape: tuple[int, ...]) -> float:
        return _logistic(sum(w * x for w, x in zip(self.weights[kind], (*votes, *shape, 1))))


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


#: Where the estimates begin, and what they are drawn to where there are few votes.
FIRST = (0.95, 0.8, 0.7, 0.7)


def _reliabilities(seen: dict[tuple[int, ...], int], rounds: int) -> tuple[tuple[float, ...], dict[tuple[int, ...], float]]:
    """Expectation-maximisation over counts of votes."""
    right, prior, belief, total = list(FIRST), 0.5, {}, sum(seen.values())
    for _ in range(rounds):
        belief = {v: _logistic(math.log(prior / (1 - prior)) + sum(x * math.log(r / (1 - r)) for x, r in zip(v, right))) for v in seen}
        prior = min(0.95, max(0.05, (sum(belief[v] * n for v, n in seen.items()) + 1) / (total + 2)))
        for j in range(len(VOTES)):
            good = sum(n * (belief[v] if v[j] > 0 else 1 - belief[v]) for v, n in seen.items() if v[j])
            cast = sum(n for v, n in seen.items() if v[j])
            right[j] = min(0.99, max(0.55, (good + 4 * FIRST[j]) / (cast + 4)))
    return tuple(right), belief


def _classifier(cells: list[tuple[tuple[int, ...], int, float]], steps: int = 25) -> tuple[float, ...]:
    """Logistic regression on (features, count, target), by Newton steps with a ridge."""
    x = np.array([(*f, 1) for f, _, _ in cells], float)
    n, y = np.array([c for _, c, _ in cells], float), np.array([t for _, _, t in cells])
    n /= n.sum()
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def estimate(counts: list[tuple[str, tuple[int, ...], tuple[int, ...], int]], rounds: int = 60) -> Labeling:
    """From counts of (kind, votes, features); they are few, whatever the corpus."""
    reliability, beliefs, weights = {}, {}, {}
    for kind in SPANS:
        own = sorted((v, f, n) for k, v, f, n in counts if k == kind)
        seen: dict[tuple[int, ...], int] = {}
        for v, _, n in own:
            seen[v] = seen.get(v, 0) + n
        if not any(v[0] > 0 for v in seen):
            continue
        reliability[kind], belief = _reliabilities(seen, rounds)
        beliefs |= {(kind, v): b for v, b in belief.items()}
        weights[kind] = _classifier([((*v, *f), n, belief[v]) for v, f, n in own])
    return Labeling(reliability, beliefs, weights)


def learned(rows: DataFrame) -> Labeling:
    """From the rows of ``voted``."""
    cells = rows.where("kind IS NOT NULL").groupBy("kind", *VOTES, *SHAPES).count().collect()
    return estimate([(r["kind"], tuple(r[v] for v in VOTES), tuple(r[f] for f in SHAPES), r["count"]) for r in cells])


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base spans and all spans as arrays of (start, kind place, kind, end)."""
    rows = materialize(voted(spans(docs)))
    known, joins = learned(rows), F.lit(False)
    for kind, weights in known.weights.items():
        score = F.lit(weights[-1])
        for name, w in zip((*VOTES, *SHAPES), weights):
            score = score + F.col(name) * F.lit(w)
        joins = joins | ((F.col("kind") == kind) & (score >= math.log(ACCEPT / (1 - ACCEPT))))
    place = F.lit(len(SPANS))
    for i, kind in enumerate(SPANS):
        place = F.when(F.col("kind") == kind, i).otherwise(place)
    span = F.struct("start", place.alias("place"), "kind", "end")
    grouped = rows.groupBy("row", "doc_id", "digest").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull() & ~F.col("base") & joins, span))).alias("more"),
    )
    # additions that overlap a base span go; of additions that overlap, the first in order stays
    clear = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    none = F.array().cast(grouped.schema["more"].dataType)
    begin = F.struct(none.alias("kept"), F.lit(-1).cast("long").alias("end"))
    apart = F.aggregate(clear, begin, lambda acc, m: F.when(m["start"] >= acc["end"], F.struct(F.concat(acc["kept"], F.array(m)).alias("kept"), m["end"].cast("long").alias("end"))).otherwise(acc), lambda acc: acc["kept"])
    spread = grouped.withColumn("spans", F.when(F.size("more") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", apart))))
    return spread.select("row", "doc_id", "digest", "base", "spans")


def written(listed: Column) -> Column:
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """The counts and digests of ``find``, by doc_id."""
    found = find(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; other columns as they are.

    Overlapping spans are replaced together, by the kind of the first.
    """
    found = find(docs).where(F.size("spans") > 0).select("doc_id", "digest", "spans").dropDuplicates(["doc_id", "digest"])
    none = F.array().cast(found.schema["spans"].dataType)
    begin = F.struct(none.alias("kept"), F.lit(-1).cast("long").alias("end"))

    def merge(acc: Column, s: Column) -> Column:
        return F.when(s["start"] >= acc["end"], F.struct(F.concat(acc["kept"], F.array(s)).alias("kept"), s["end"].cast("long").alias("end"))).otherwise(F.struct(acc["kept"].alias("kept"), F.greatest(acc["end"], s["end"]).alias("end")))

    def ends(acc: Column, s: Column) -> Column:
        """Where each merged span ends."""
        last = F.element_at(acc, -1)
        return F.when((F.size(acc) == 0) | (s["start"] >= last), F.concat(acc, F.array(s["end"]))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(last, s["end"]))))

    found = found.withColumn("kept", F.aggregate("spans", begin, merge, lambda acc: acc["kept"])).withColumn("ends", F.aggregate("spans", F.array().cast("array<bigint>"), ends)).drop("spans")
    # the columns of docs travel as one, so that no name of theirs can clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    joined = whole.join(found, F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("digest")), "left")
    text = F.col("doc.text")

    def piece(s: Column, i: Column) -> Column:
        after = F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("ends"), i - 1)).cast("int")
        return F.concat(F.substring(text, after + 1, s["start"].cast("int") - after), F.lit("["), s["kind"], F.lit("]"))

    rest = F.substring(text, F.element_at("ends", -1).cast("int") + 1, F.char_length(text))
    shown = F.concat(F.array_join(F.transform("kept", piece), ""), rest)
    new = F.when(F.col("kept").isNotNull(), shown).otherwise(text)
    return joined.select(*[(new if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
