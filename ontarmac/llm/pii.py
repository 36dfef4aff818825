"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Base spans (:func:`base_spans`) are fixed rules and always stay. Further candidates are what loose patterns find: mail
addresses written out (``name at host dot org``), numbers of 7 digits or more with separators, dotted or coloured number groups,
identity and bank numbers, and names behind a title; and what the base rules nearly take: numbers with wrong check digits
or octets, numbers behind a plus of a wrong length, and bare runs of 7 to 15 digits. On each candidate and each base
span several labelers vote yes, no or nothing: the base rules, strict patterns and check digits, gazetteers (mail hosts, given names, titles, units), and the words
before it. Expectation-maximisation over the votes of all base spans and candidates of the corpus, counted by vote pattern, estimates every
labeler's reliability and the share of true candidates per kind, without any labelled data. The posterior of each pattern then
is the target of a logistic regression on features of the span itself, its shape and its context. The classifier learns
from base spans too and decides on the candidates that are not; none is added that no labeler votes for.

Vote patterns are bounded (votes of nine labelers and features that are zeros and ones), so the driver sees counts
per pattern, never candidates.

Defined results: a null text is empty and has no spans. A null id gets a row like any other. Rows repeated get equal
results. An empty table gives an empty result. Other columns are not looked at. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "person"]
BASE_KINDS = KINDS[:4]
#: Stricter patterns take their characters before looser ones.
STRICT_FIRST = ["email", "iban", "ssn", "card", "ip", "phone", "person"]

# fixed values: the base patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match always starts where a run of digits does and takes whole runs, so none is tried twice
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
# one group per kind of candidate
LOOSE = {
    "email": re.compile(
        r"\b[A-Za-z0-9][A-Za-z0-9._+-]{0,63}(?: ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]{2,24}){1,3}"
        r"| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z]{2,12}){1,3})\b", re.I
    ),
    "ip": re.compile(r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b|\b[0-9]{1,3}(?: ?\[\.\] ?[0-9]{1,3}){3}\b"),
    "card": re.compile(r"\b[0-9]{4}[ ./-][0-9]{6}[ ./-][0-9]{5}\b|\b[0-9]{15}\b|\b[0-9]{4}(?:[./][0-9]{4}){3}\b"),
    "phone": re.compile(r"(?<![0-9A-Za-z.+])(?:\(?0[0-9]{1,4}\)?|\([0-9]{3}\)|[0-9]{3})[ ./-][0-9]{2,5}(?:[ ./-][0-9]{2,5}){1,3}(?![0-9A-Za-z])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "person": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? ([A-ZÀ-Þ][a-zà-ÿ]{1,20}(?: [A-ZÀ-Þ][a-zà-ÿ]{1,20}){0,2})"),
}

# fixed values: gazetteers and context words
HOSTS = {"gmail", "yahoo", "hotmail", "outlook", "example", "mail", "icloud", "proton", "web", "gmx", "aol"}
GIVEN_NAMES = {"anna", "maria", "peter", "john", "mary", "james", "robert", "michael", "david", "thomas", "jean", "pierre", "marie", "juan", "carlos", "jose", "hans", "klaus", "ursula", "sophie", "laura", "paul", "linda", "susan"}
BEFORE = {
    "email": {"mail", "email", "e-mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "amex", "karte", "carte", "tarjeta", "credit"},
    "phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "telefon", "teléfono", "téléphone"},
    "iban": {"iban", "account", "konto", "compte", "cuenta", "bank"},
    "ssn": {"ssn", "social", "security", "number"},
    "person": {"name", "by", "from", "contact", "author", "dear"},
}
UNITS = {"isbn", "version", "page", "pages", "figure", "section", "order", "invoice", "line", "date", "chapter", "doi"}
BARE = re.compile(r"(?<![0-9A-Za-z.+-])[0-9]{7,15}(?![0-9A-Za-z])")
LABELERS = ["base rules", "pattern", "check digits", "gazetteer", "words before", "unit before", "repeated digit", "in a number", "neighbour"]


# --- base spans ------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``EMAIL`` from the left, searched around each ``@`` only.

    A match must hold an ``@`` behind its local part, so it begins with the run of local characters before one, as far
    as no earlier match took them.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            done = found.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start: leftmost matches of each kind that do not overlap; failing ones are dropped."""
    spans = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    if text.count(".") >= 3:
        spans += [("ip", *m.span()) for m in IP.finditer(text) if _in_range(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return spans


def _in_range(found: str) -> bool:
    return all(int(p) <= 255 for p in _octets(found))


def _octets(found: str) -> list[str]:
    # a part longer than any number up to 255 with leading zeros left out fails without a huge conversion
    return [p.lstrip("0")[:4] or "0" for p in found.split(".")]


# --- candidates and votes --------------------------------------------------------------------------


def _mod97(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _strict(kind: str, value: str) -> int:
    """Whether the value has its kind's usual form: 1 yes, -1 no, 0 no opinion."""
    digits = _DIGIT.findall(value)
    if kind == "email":
        return 1 if "@" in value or "(at)" in value.lower() or "[at]" in value.lower() else 0
    if kind == "ip":
        return -1 if "[" not in value and "." in value and not _in_range(value) else 1
    if kind == "card":
        return 1 if value[0] in "3456" and len(digits) in (15, 16) else -1
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 12 and value[0] in "0(+" else -1 if len(digits) < 8 else 0
    if kind == "iban":
        return 1 if 15 <= len(value.replace(" ", "")) <= 34 else -1
    if kind == "ssn":
        return -1 if value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[7:] == "0000" else 1
    return 1 if " " in value else 0


def _checked(kind: str, value: str) -> int:
    if kind == "card":
        return 1 if luhn("".join(_DIGIT.findall(value))) else -1
    if kind == "iban":
        return 1 if _mod97(value.replace(" ", "").upper()) else -1
    return 0


def votes(kind: str, value: str, before: str, behind: str, base_near: bool, by_rule: int = 0) -> list[int]:
    """One vote per labeler: 1 for personal data, -1 against, 0 for none."""
    words = re.findall(r"[\w-]+", before.lower())[-4:]
    parts = set(re.findall(r"[a-z]+", value.lower()))
    digits = _DIGIT.findall(value)
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if parts & HOSTS else 0
    elif kind == "person":
        gazetteer = 1 if parts & GIVEN_NAMES else 0
    return [
        by_rule,
        _strict(kind, value),
        _checked(kind, value),
        gazetteer,
        1 if BEFORE[kind] & set(words) else 0,
        -1 if UNITS & set(words) else 0,
        -1 if len(digits) >= 7 and len(set(digits)) <= 2 else 0,
        -1 if before[-1:] in "$€£#=." and before[-1:] or behind[:1] in "%€$" and behind[:1] else 0,
        1 if base_near else 0,
    ]


FEATURES = 2 * len(LABELERS) + 6


def features(vote: list[int], value: str, before: str, behind: str) -> list[int]:
    """The span's votes, shape and surroundings as zeros and ones; few, so that patterns can be counted."""
    digits = len(_DIGIT.findall(value))
    shape = [
        digits >= 9,
        digits >= 13,
        len(value) >= 20,
        any(c in value for c in " -./"),
        before[-1:].isspace() or not before,
        not behind or behind[:1].isspace() or behind[:1] in ".,;!?)",
    ]
    return [int(v > 0) for v in vote] + [int(v < 0) for v in vote] + [int(s) for s in shape]


def _failed(text: str) -> Iterator[tuple[str, int, int]]:
    """What looks like a base span and fails its rule, and bare runs of digits."""
    if not _DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if not _in_range(m[0]):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and not luhn(digits):
                yield "card", *m.span()
    for m in PHONE.finditer(text) if "+" in text else ():
        if not 8 <= len(_DIGIT.findall(m[0])) <= 15:
            yield "phone", *m.span()
    for m in BARE.finditer(text):
        yield "phone", *m.span()


class _Judge:
    """Votes and features of the spans of one text."""

    def __init__(self, text: str, base: list[tuple[str, int, int]]):
        self.text, self.starts, self.stops = text, sorted(a for _, a, _ in base), sorted(b for _, _, b in base)

    def _near(self, start: int, end: int, own: bool) -> bool:
        """Whether a base span (but the span itself) ends or begins within 200 characters."""
        starts = bisect_left(self.starts, end + 200) - bisect_right(self.starts, end - 200)
        stops = bisect_left(self.stops, start + 200) - bisect_right(self.stops, start - 200)
        itself = own and end - start < 200
        return starts > itself or stops > itself

    def __call__(self, kind: str, start: int, end: int, by_rule: int) -> tuple[str, int, int, list[int], list[int]]:
        text = self.text
        before, behind, value = text[max(0, start - 40) : start], text[end : end + 10], text[start:end]
        vote = votes(kind, value, before, behind, self._near(start, end, by_rule > 0), by_rule)
        return kind, start, end, vote, features(vote, value, before, behind)


def judged_base(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, list[int], list[int]]]:
    """The base spans with votes and features, as :func:`candidates` has them."""
    judge = _Judge(text, base)
    return [judge(*span, 1) for span in base]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, list[int], list[int]]]:
    """Loose matches and failed ones that no base span overlaps: kind, start, end, votes and features."""
    lowered = text.lower()
    wanted = ["person"]
    if _DIGIT.search(text):
        wanted += ["ip", "card", "phone", "iban", "ssn"]
    if any(s in lowered for s in ("@", " at ", "(at)", "[at]")) and ("dot" in lowered or "@" in lowered):
        wanted.append("email")
    found, judge, taken = [], _Judge(text, base), bytearray(len(text))
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)

    def take(kind: str, start: int, end: int, by_rule: int) -> None:
        if taken.find(1, start, end) < 0:
            found.append(judge(kind, start, end, by_rule))
            taken[start:end] = b"\1" * (end - start)

    for kind in STRICT_FIRST:
        if kind in wanted:
            for m in LOOSE[kind].finditer(text):
                take(kind, *m.span(m.lastindex or 0), 0)
    for span in _failed(text):
        take(*span, -1)
    return found


# --- reliabilities and the classifier --------------------------------------------------------------


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior per vote pattern, reliability per labeler and the share of true candidates.

    A labeler that votes is right with one probability; when it abstains tells nothing. Expectation weighs the votes by
    the reliabilities, maximisation recounts these from the posteriors, starting at 0.8 and kept between 0.55 and
    0.99, so that a labeler cannot turn its meaning round.
    """
    right, share = np.full(patterns.shape[1], 0.8), 0.5
    posterior = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + patterns @ np.log(right / (1 - right))
        posterior = 1 / (1 + np.exp(-odds))
        agrees = np.where(patterns > 0, posterior[:, None], np.where(patterns < 0, 1 - posterior[:, None], 0.0))
        cast = (patterns != 0) * counts[:, None]
        right = np.clip(((agrees * counts[:, None]).sum(axis=0) + 8) / (cast.sum(axis=0) + 10), 0.55, 0.99)
        share = float(np.clip((posterior * counts).sum() / counts.sum(), 0.05, 0.95))
    return posterior, right, share


def span_classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression on soft targets, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - target)) + penalty * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


SPANS = "array<struct<kind: string, start: int, stop: int, votes: array<int>, features: array<int>>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))])
)


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` (base spans) and ``loose`` (candidates) of every row, each with votes and features."""

    def of(texts: list[str]) -> dict[str, list]:
        base, loose = [], []
        for text in texts:
            spans = base_spans(text)
            names = ("kind", "start", "stop", "votes", "features")
            base.append([dict(zip(names, c)) for c in judged_base(text, spans)])
            loose.append([dict(zip(names, c)) for c in candidates(text, spans)])
        return {"base": base, "loose": loose}

    schema = f"id {common.id_type(docs, id_col)}, base {SPANS}, loose {SPANS}"
    rows = common.two_columns(docs, id_col, text_col)
    return rows.mapInArrow(common.per_text(of, {"base": _SPAN_TYPE, "loose": _SPAN_TYPE}), schema)


def vote_counts(found: DataFrame) -> list:
    """How often each pattern of votes and features occurs per kind, over all base spans and candidates."""
    spans = found.select(F.explode(F.concat("base", "loose")).alias("c"))
    return spans.groupBy("c.kind", "c.votes", "c.features").agg(F.count("*").alias("n")).collect()  # bounded by the number of patterns


def train(counted: list) -> dict[str, np.ndarray]:
    """A span classifier per kind, from the counts of :func:`vote_counts`."""
    models = {}
    for kind in KINDS:
        rows = [r for r in counted if r["kind"] == kind]
        if rows:
            by_votes: Counter = Counter()
            for r in rows:
                by_votes[tuple(r["votes"])] += r["n"]
            patterns, counts = np.array(list(by_votes)), np.array(list(by_votes.values()), float)
            posterior = dict(zip(by_votes, label_model(patterns, counts)[0]))
            x, n = np.array([r["features"] for r in rows], float), np.array([r["n"] for r in rows], float)
            models[kind] = span_classifier(x, np.array([posterior[tuple(r["votes"])] for r in rows]), n)
    return models


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: ``id``, ``base`` and ``spans`` (base spans and what the classifier adds), by kind and start."""
    found = cut(found_spans(docs, id_col, text_col))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    limit = float(np.log(threshold / (1 - threshold)))
    models = train(vote_counts(found))

    def good(c):
        decided = F.lit(False)
        for kind, w in models.items():
            weights = F.array(*[F.lit(float(v)) for v in w[:-1]])
            terms = F.zip_with(c["features"], weights, lambda feature, weight: feature * weight)
            score = F.aggregate(terms, F.lit(float(w[-1])), lambda total, term: total + term)
            decided = decided | ((c["kind"] == kind) & (score >= limit))
        return decided & F.exists(c["votes"], lambda vote: vote > 0)

    plain = lambda c: F.struct(
        F.array_position(kinds, c["kind"]).alias("rank"), c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind")
    )
    base = F.transform("base", plain)
    added = F.transform(F.filter("loose", good), plain)
    return found.select("id", base.alias("base"), F.array_sort(F.concat(base, added)).alias("spans"))


def joined(spans) -> F.Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id`` and text of each row with each span that :func:`detect` finds replaced by its kind in angle brackets.

    Of overlapping spans the first counts. Rows are told apart by id and text, so ids may be null or repeat; a null text stays null.
    """

    def of(text: str | None, spans: list) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
            if s["start"] >= at:
                parts += [text[at : s["start"]], f"<{s['kind']}>"]
                at = s["stop"]
        return "".join([*parts, text[at:]])

    replace = F.udf(of, "string", useArrow=True)
    digest = common.text_digest(docs[text_col])
    rows = docs.select(F.struct(docs[id_col].alias("id"), digest.alias("digest")).alias("key"), docs[text_col].cast("string").alias("text"))
    # rows of one id and text have the same spans
    found = detect(rows, "key", "text", threshold).select(F.col("id").alias("found_key"), "spans").dropDuplicates(["found_key"])
    match = F.col("key.id").eqNullSafe(F.col("found_key.id")) & (F.col("key.digest") == F.col("found_key.digest"))
    return rows.join(found.hint("merge"), match).select("key.id", replace("text", "spans").alias("text"))
