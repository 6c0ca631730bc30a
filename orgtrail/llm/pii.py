"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Candidates are spans of five kinds. Strict forms (``base``) are always reported: e-mail addresses,
IPv4 addresses, card numbers that pass Luhn's check, international phone numbers. Wider forms are
candidates only: written-out addresses, IPv6, card numbers that fail the check, national phone numbers,
person names. Five labelers look at each candidate and vote for, against or not at all: its form, a
check of its contents, a gazetteer (domains, issuer ranges, dialling codes, given names), the words
before it, and its layout. Expectation-maximisation finds how reliable each labeler is for each kind
without any labels, from the counts of all vote patterns in the whole corpus. Its posterior labels train
a logistic classifier on votes, layout and neighbouring words, which decides about the wider candidates.

Texts are scanned twice, once for the votes and once with the model; a row is handled by itself and
nothing is shuffled but vote patterns (at most ``len(KINDS) * 3 ** len(LABELERS)``) and the sample on
which the classifier is fitted, at most ``FIT_SPANS`` spans of each kind, which is the one bound. Searches
are linear in the text: no pattern tries a run of characters from each of its positions.

Edge cases: a null or empty text has no spans. Rows that repeat are handled alike, a null id as any
other. Texts of any length are searched whole, by code points. Of added spans that overlap the first
stays, then the longest, then the kind listed first; one that overlaps a base span is not added. Spans
of the base stay even where they overlap. Ties in a span's start go by kind. Empty tables give no
rows, a corpus without candidates no added spans. A column of the input called like an output is replaced.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest

KINDS = ("email", "ip", "card", "phone", "name")
LABELERS = ("form", "check", "gazetteer", "context", "layout")
#: Spans of each kind on which the classifier is fitted, and its hashed features.
FIT_SPANS, BUCKETS = 10_000, 1 << 12
#: A wider candidate is added from this probability of the classifier on.
ACCEPT = 0.8
EM_ROUNDS, FIT_STEPS = 40, 150
#: Agreements that each labeler starts with (a check is computed, the others are habits),
#: disagreements, and rows of each class.
FAITH, DOUBT, PRIOR = (8.0, 60.0, 8.0, 8.0, 8.0), 2.0, 1.0

# What the contract calls the base, linear in the length of the text.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_WRITTEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}"
    r"(?: ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{2,63}){1,4}"
    r"| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{2,63}){1,4})",
    re.IGNORECASE,
)
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4})?:(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:.])")
_NATIONAL = re.compile(
    r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9A-Za-z]|[.-][0-9])"
)
_CAPITAL = "A-ZÀ-ÖØ-Þ"
_NAME = re.compile(
    rf"(?<![\w'-])(?:(?P<title>Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señor|Señora|Sr|Sra)\.? )?"
    rf"(?P<first>[{_CAPITAL}][\w'-]{{1,30}})(?P<last>(?: [{_CAPITAL}][\w'-]{{1,30}}){{0,2}})(?![\w'-])"
)
_DATE = re.compile(r"(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2}")
_WORD = re.compile(r"[^\W\d_]+")

# Top-level domains, given names, words before personal data and before other numbers.
DOMAINS = frozenset(
    "com org net edu gov mil int info biz io co de fr es at ch be nl it uk us ca au eu pl pt se no dk fi ie cz gr hu ro "
    "jp cn in br mx ar ru tr za nz kr".split()
)
GIVEN = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Mary "
    "Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emily Emma Olivia Anna Peter Paul George Hans "
    "Klaus Jürgen Wolfgang Heinz Günter Helmut Ursula Monika Petra Sabine Renate Jean Pierre Michel Jacques Philippe "
    "Nathalie Isabelle Sylvie Catherine Françoise José Antonio Manuel Francisco Juan Carlos Javier Miguel María Carmen "
    "Josefa Isabel Dolores Pilar Lucía".split()
)
CUES = {
    "email": frozenset("email mail contact courriel correo kontakt contacto écrire write".split()),
    "ip": frozenset("ip ipv host server serveur servidor addr address adresse dirección".split()),
    "card": frozenset("card visa mastercard amex karte kreditkarte carte tarjeta credit".split()),
    "phone": frozenset(
        "phone tel telephone call mobile cell fax telefon telefonnummer anruf tél téléphone appel teléfono móvil".split()
    ),
    "name": frozenset("name named contact attn signed sincerely heißt nom nombre señor dear".split()),
}
OTHER_NUMBERS = frozenset(
    "order invoice id version isbn issn nr ref serial token rechnung facture factura commande pedido page seite".split()
)
#: Issuer ranges: first and last value of the leading digits.
ISSUERS = ((4, 4), (51, 55), (2221, 2720), (34, 34), (37, 37), (6011, 6011), (65, 65), (3528, 3589), (300, 305), (36, 36), (38, 38))


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    """Whatever the number of leading zeros."""
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them: around each @ the longest run before it and the domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The strict spans by start and kind."""
    found = [Span("email", *span, True) for span in _emails(text)]
    if any(c in text for c in "0123456789"):
        for m in _IP.finditer(text):
            if all(_at_most_255(part) for part in m[0].split(".")):
                found.append(Span("ip", *m.span(), True))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                found.append(Span("card", *m.span(), True))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(Span("phone", *m.span(), True))
    return sorted(found, key=_by_start)


def _by_start(span: Span) -> tuple[int, int]:
    return span.start, KINDS.index(span.kind)


def _ipv6(text: str) -> bool:
    try:
        return ipaddress.ip_address(text).version == 6
    except ValueError:
        return False


def wider_spans(text: str, base: list[Span]) -> list[Span]:
    """Further candidates, none of which overlaps a base span."""
    found = []
    if "at" in text or "AT" in text:
        found += [Span("email", *m.span(), False) for m in _WRITTEN_EMAIL.finditer(text)]
    if ":" in text:
        found += [Span("ip", *m.span(), False) for m in _IPV6.finditer(text) if len(m[0]) > 5 and _ipv6(m[0])]
    if any(c in text for c in "0123456789"):
        found += [
            Span("card", *m.span(), False)
            for m in _CARD.finditer(text)
            if m.end() - m.start() >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and not luhn(digits)
        ]
        found += [Span("phone", *m.span(), False) for m in _NATIONAL.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    for m in _NAME.finditer(text):
        if m["title"] or (m["last"] and m["first"] in GIVEN):
            found.append(Span("name", *m.span(), False))
    if not found or not base:
        return found
    starts = np.array([s.start for s in base])
    ends = np.maximum.accumulate([s.end for s in base])
    # Base spans are in order of start: the last that starts before a candidate's end decides.
    before = [int(np.searchsorted(starts, s.end)) for s in found]
    return [s for s, n in zip(found, before) if n == 0 or ends[n - 1] <= s.start]


def _neighbours(text: str, span: Span) -> tuple[list[str], list[str]]:
    """Three words before and two behind, lower-cased."""
    before = _WORD.findall(text[max(0, span.start - 48) : span.start].lower())
    return before[-3:], _WORD.findall(text[span.end : span.end + 32].lower())[:2]


def _check(kind: str, base: bool, shown: str, digits: str) -> int:
    if kind == "email":
        local = re.split(r"@|[\[({ ]at", shown, maxsplit=1)[0].strip()
        return -1 if ".." in shown or local[:1] == "." or local[-1:] == "." else 1
    if kind == "ip":
        return -1 if base and any(len(p) > 1 and p[0] == "0" for p in shown.split(".")) else 1
    if kind == "card":
        return 1 if base else -1
    if kind == "phone":
        return -1 if _DATE.search(shown) or len(set(digits)) < 3 else 1
    return -1 if shown.upper() == shown else 0


def _gazetteer(kind: str, base: bool, shown: str, digits: str) -> int:
    if kind == "email":
        return 1 if _WORD.findall(shown.lower())[-1:] and _WORD.findall(shown.lower())[-1] in DOMAINS else -1
    if kind == "ip":
        return -1 if base and (shown.startswith(("0.", "127.")) or int(shown.split(".")[0].lstrip("0") or "0") >= 224) else 1
    if kind == "card":
        return 1 if any(low <= int(digits[: len(str(low))]) <= high for low, high in ISSUERS) else -1
    if kind == "phone":
        return 1 if base or shown[0] in "0(" else -1
    return 1 if set(shown.replace(".", " ").split()) & GIVEN else 0


def _layout(kind: str, base: bool, shown: str, text: str, span: Span) -> int:
    if kind == "email":
        return 1 if base or shown.count("[") + shown.count("(") + shown.count("{") else 0
    if kind == "ip":
        return -1 if text[span.end : span.end + 1] == "." and text[span.end + 1 : span.end + 2].isdigit() else 0
    if kind == "card":
        return 1 if re.fullmatch(r"[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", shown) else 0
    if kind == "phone":
        return 1 if base or "(" in shown else 0
    return 1 if " " in shown and shown.split()[0].rstrip(".") not in GIVEN else 0


def look(text: str, span: Span) -> tuple[tuple[int, ...], list[int]]:
    """The labelers' votes for a span (1 for, -1 against, 0 none) and the classifier's hashed features."""
    shown = text[span.start : span.end]
    digits = _digits(shown)
    before, behind = _neighbours(text, span)
    cues = CUES[span.kind]
    # The nearest telling word decides.
    context = next((1 if w in cues else -1 for w in reversed(before) if w in cues or w in OTHER_NUMBERS), 0)
    votes = (
        int(span.base),
        _check(span.kind, span.base, shown, digits),
        _gazetteer(span.kind, span.base, shown, digits),
        context,
        _layout(span.kind, span.base, shown, text, span),
    )
    # The form itself is no feature: it tells base from wider, not personal from other.
    layout = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", shown))[:32]
    said = [f"{name}{vote}" for name, vote in zip(LABELERS[1:], votes[1:]) if vote]
    said += [f"layout {layout}", f"digits {len(digits)}", *[f"before {w}" for w in before], *[f"behind {w}" for w in behind], "any"]
    return votes, sorted({crc32(f"{span.kind} {s}".encode()) % BUCKETS for s in said})


@dataclass(frozen=True)
class Labelers:
    """How often each labeler is right when it votes, by kind, and the share of personal data.

    A kind has two shares: of spans for which the form, the first labeler, votes, and of all others.
    """

    right: np.ndarray
    share: np.ndarray

    def posterior(self, kind: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """The probability that a span is personal data, from its votes alone."""
        trust = np.log(self.right) - np.log1p(-self.right)
        odds = np.log(self.share) - np.log1p(-self.share)
        return 1 / (1 + np.exp(-(odds[kind, (votes[:, 0] > 0).astype(int)] + (trust[kind] * votes).sum(axis=1))))


def estimate(kind: np.ndarray, votes: np.ndarray, count: np.ndarray, rounds: int = EM_ROUNDS) -> Labelers:
    """Expectation-maximisation over vote patterns and their counts.

    A labeler that does not vote says nothing. Each starts, and is held by a few imagined votes,
    as better than chance, which also tells the two classes apart.
    """
    faith = np.tile(FAITH, (len(KINDS), 1))
    made = Labelers(faith / (faith + DOUBT), np.full((len(KINDS), 2), 0.5))
    form = (votes[:, 0] > 0).astype(int) if len(count) else None
    for _ in range(rounds if len(count) else 0):
        p = made.posterior(kind, votes)
        agreed, voted = faith.copy(), faith + DOUBT
        np.add.at(agreed, kind, count[:, None] * np.where(votes > 0, p[:, None], np.where(votes < 0, 1 - p[:, None], 0)))
        np.add.at(voted, kind, count[:, None] * (votes != 0))
        mine, all_ = np.full((len(KINDS), 2), PRIOR), np.full((len(KINDS), 2), 2 * PRIOR)
        np.add.at(mine, (kind, form), count * p)
        np.add.at(all_, (kind, form), count)
        made = Labelers(agreed / voted, mine / all_)
    return made


def fit_weights(features: list[list[int]], target: np.ndarray, steps: int = FIT_STEPS, decay: float = 1e-3) -> np.ndarray:
    """Logistic weights by gradient steps with a running scale for each feature, on soft targets."""
    weights = np.zeros(BUCKETS)
    if not features:
        return weights
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    at = np.concatenate([np.array(f, dtype=np.int64) for f in features])
    seen = np.full(BUCKETS, 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.bincount(row, weights[at], minlength=len(features))))
        slope = np.bincount(at, (p - target)[row], minlength=BUCKETS) / len(features) + decay * weights
        seen += slope**2
        weights -= 0.3 * slope / np.sqrt(seen)
    return weights


@dataclass(frozen=True)
class Model:
    labelers: Labelers
    weights: np.ndarray

    def probability(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-self.weights[features].sum())))

    def added(self, text: str, span: Span, accept: float) -> float | None:
        """The probability of a wider span that is added: the labelers must be as sure of it."""
        votes, features = look(text, span)
        p = self.probability(features)
        voted = self.labelers.posterior(np.array([KINDS.index(span.kind)]), np.array([votes]))[0]
        return p if min(p, voted) >= accept else None


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per candidate: kind, votes and features. Spans of a text are found in its own task."""

    def look_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, votes, features = [], [], []
            for value in batch.column(0):
                shown = value.as_py() or ""
                base = base_spans(shown)
                for span in base + wider_spans(shown, base):
                    voted, said = look(shown, span)
                    kinds.append(KINDS.index(span.kind))
                    votes.append(voted)
                    features.append(said)
            columns = [
                pa.array(kinds, pa.int32()),
                pa.array(votes, pa.list_(pa.int32())),
                pa.array(features, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "votes", "features"])

    schema = "kind int, votes array<int>, features array<int>"
    return docs.select(F.col(text).cast("string")).mapInArrow(look_at, schema)


def fit(docs: DataFrame, text: str = "text", fit_spans: int = FIT_SPANS) -> Model:
    """Reliabilities from all candidates, the classifier from at most ``fit_spans`` of each kind."""
    found = at_rest(candidates(docs, text), "pii-candidates")
    patterns = found.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    kind = np.array([row["kind"] for row in patterns], dtype=np.int64)
    votes = np.array([row["votes"] for row in patterns], dtype=np.int64).reshape(-1, len(LABELERS))
    labelers = estimate(kind, votes, np.array([row["count"] for row in patterns], dtype=np.float64))
    by_hash = [F.xxhash64("votes", "features"), "votes", "features"]
    sample = []
    for at in range(len(KINDS)):
        sample += found.filter(F.col("kind") == at).orderBy(*by_hash).limit(fit_spans).collect()
    if not sample:
        return Model(labelers, np.zeros(BUCKETS))
    target = labelers.posterior(
        np.array([row["kind"] for row in sample]), np.array([row["votes"] for row in sample], dtype=np.int64)
    )
    return Model(labelers, fit_weights([row["features"] for row in sample], target))


def find(text: str, model: Model, accept: float = ACCEPT) -> list[tuple[Span, float]]:
    """All spans of a text with their probability: the base, and wider ones that the model takes."""
    base = base_spans(text)
    found = [(span, model.probability(look(text, span)[1])) for span in base]
    wider = sorted(wider_spans(text, base), key=lambda s: (s.start, -s.end, KINDS.index(s.kind)))
    free = 0
    for span in wider:
        if span.start >= free and (p := model.added(text, span, accept)) is not None:
            found.append((span, p))
            free = span.end
    return sorted(found, key=lambda pair: _by_start(pair[0]))


SPAN_TYPE = "array<struct<kind: string, start: int, end: int, base: boolean, probability: double>>"


def with_spans(docs: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The rows with their spans in ``pii``, by start."""
    kept = docs.drop("pii")
    rows = kept.withColumn("pii", F.col(text).cast("string"))
    schema = kept.withColumn("pii", F.lit(None).cast(SPAN_TYPE)).schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [
                    {"kind": s.kind, "start": s.start, "end": s.end, "base": s.base, "probability": p}
                    for s, p in find(value.as_py() or "", model, accept)
                ]
                for value in batch.column(batch.num_columns - 1)
            ]
            fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())]
            column = pa.array(spans, pa.list_(pa.struct(fields)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], batch.schema.names)

    return rows.mapInArrow(search, schema)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping ones the later is cut."""
    start = F.struct(text.alias("text"), F.length(text).alias("limit"))

    def cut(state: Column, span: Column) -> Column:
        end = F.least(span["end"], state["limit"])
        whole = state["text"]
        replaced = F.concat(
            F.substring(whole, F.lit(1), span["start"]),
            F.lit("["),
            F.upper(span["kind"]),
            F.lit("]"),
            F.substring(whole, end + 1, F.length(whole)),
        )
        return F.struct(replaced.alias("text"), span["start"].alias("limit"))

    return F.aggregate(F.reverse(spans), start, cut, lambda state: state["text"])


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def pii_report(docs: DataFrame) -> DataFrame:
    """What the query returns: counts and digest of the base, all spans as text."""
    spanned = with_spans(docs.select("doc_id", "text"), fit(docs))
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spanned.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:4]],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        (F.size("pii") - F.size(base)).cast("long").alias("n_added"),
    )
