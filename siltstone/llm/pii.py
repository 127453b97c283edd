"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay. Looser patterns propose further candidates. On every
candidate several labelers vote for, against, or not at all: its shape, a gazetteer, the words before it, a checksum, and
the characters around it. Expectation-maximisation over the counts of all vote patterns in the corpus estimates how reliable each labeler is;
the probabilities it gives train a logistic classifier of votes and span features, which decides on the candidates.

Votes and features form cells of a bounded number, so what the driver gets are at most ``CELLS`` counts,
whatever the size of the corpus, and still every candidate of every text takes part in both models.

Null and empty texts have no spans. Repeated rows give repeated results. With no candidates at all (or an empty
table) only base spans are returned. Only the key and the text are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import small_batches, strings, struct, written

# Kinds in their order within results: first those with base patterns.
BASE = ("email", "ip", "card", "phone")
MORE = ("loose_email", "loose_phone", "national_id", "iban", "secret")
KINDS = BASE + MORE

DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
# Fixed patterns of the base kinds. A digit before the start would only lead to a match within a match.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Loose patterns, each starting at a word's edge: bounded repeats, or whole runs that are never given back.
LOOSE = {
    "loose_email": re.compile(
        r"(?<![\w.+-])[\w.+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[\w-]{1,63}(?: ?[\[(]? ?(?:dot|DOT|\.) ?[\])]? ?[\w-]{2,24}){1,4}"
    ),
    "loose_phone": re.compile(
        r"(?<![\w.-])(?:\([0-9]{2,4}\) ?|(?:00[0-9]{1,3}[ .-])?)[0-9]{2,4}[ .-][0-9]{3,4}[ .-]?[0-9]{2,4}(?![\w-])"
    ),
    "national_id": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "secret": re.compile(r"(?<![\w/+-])[A-Za-z0-9_/+-]{16,}+={0,2}+(?![\w/+=-])"),
}
# What must be in a text for the pattern to be worth a search.
NEEDED = {
    "loose_email": re.compile(r"[\[(] ?(?:at|AT) ?[\])]"),
    "loose_phone": re.compile(r"[0-9]\)? ?[ .-][0-9]{3}|[0-9]\) ?[0-9]"),
    "national_id": re.compile(r"[0-9]-[0-9]{2}-[0-9]"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}"),
    "secret": re.compile(r"[A-Za-z0-9_/+-]{16}"),
}

# Words that stand before personal data, and gazetteers of what it holds.
CONTEXT = {
    "email": ("mail", "e-mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "from"),
    "card": ("card", "visa", "credit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "telefon", "appel"),
    "national_id": ("ssn", "social", "security", "id", "tax"),
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "secret": ("token", "key", "secret", "password", "api", "bearer", "auth"),
}
AGAINST = ("isbn", "version", "page", "http", "www", "order", "invoice", "sha", "commit", "build")
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "eu", "us", "ru", "cn", "example")
BANK_COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
SECRET_STARTS = ("sk-", "pk-", "ghp_", "AKIA", "xox", "eyJ")

LABELERS = ("shape", "gazetteer", "context", "checksum", "edges")
FEATURES = 16
CELLS = len(KINDS) * 3 ** len(LABELERS) * FEATURES
BEFORE = 32


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @: the run of allowed characters before it, and a domain after it; linear in the text."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            domain = DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                found.append((start, domain.end()))
                done = domain.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches that don't overlap within a kind; those that fail their test are dropped."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Loose matches that overlap neither a base span nor an earlier candidate."""
    taken = sorted((a, b) for _, a, b in base)
    found = []
    for kind, pattern in LOOSE.items():
        if kind in NEEDED and not NEEDED[kind].search(text):
            continue
        k, own = 0, []
        for m in pattern.finditer(text):
            # Here and not in the pattern, where only a bounded look-ahead is linear.
            if kind == "secret" and not (DIGIT.search(m[0]) and LETTER.search(m[0])):
                continue
            a, b = m.span()
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if k == len(taken) or taken[k][0] >= b:
                own.append((kind, a, b))
        found += own
        taken = sorted(taken + [(a, b) for _, a, b in own])
    return found


def votes(text: str, kind: str, start: int, end: int) -> list[int]:
    """1 for personal data, 2 against it, 0 for no opinion; one per labeler."""
    span, topic = text[start:end], kind.removeprefix("loose_")
    digits = _digits(span)
    before = text[max(0, start - BEFORE) : start].lower()
    share = len(digits) / len(span)
    shape = {
        "email": 1 if span.count("@") == 1 or "at" in span.lower() else 0,
        "ip": 1 if not span.startswith("0.") else 2,
        "card": 1 if len(digits) == 16 else 0,
        "phone": 1 if 9 <= len(digits) <= 12 else 2 if len(digits) < 7 else 0,
        "national_id": 1,
        "iban": 1 if 15 <= len(span.replace(" ", "")) <= 34 else 2,
        "secret": 1 if len(set(span)) >= 9 and 0.1 < share < 0.95 else 2,
    }[topic]
    gazetteer = {
        "email": 1 if span.lower().rsplit(".", 1)[-1].strip(" )]") in ENDINGS else 2,
        "ip": 1 if span.startswith(("10.", "192.168.", "172.")) else 0,
        "card": 1 if span[0] in "3456" else 2,
        "phone": 1 if span.startswith(("+1", "+33", "+34", "+44", "+49", "00", "(")) else 0,
        "national_id": 2 if span.startswith(("000", "666", "9")) else 0,
        "iban": 1 if span[:2] in BANK_COUNTRIES else 2,
        "secret": 1 if span.startswith(SECRET_STARTS) else 0,
    }[topic]
    context = 1 if any(w in before for w in CONTEXT[topic]) else 2 if any(w in before for w in AGAINST) else 0
    checksum = 0
    if topic == "card":
        checksum = 1 if luhn(digits) else 2
    elif topic == "iban":
        turned = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in turned[4:] + turned[:4])
        checksum = 1 if int(number) % 97 == 1 else 2
    elif topic == "secret":
        checksum = 1 if re.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}", span) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = 1 if (not left or left in " \n\t:(<\"'=") and (not right or right in " \n\t.,;)>\"'") else 2
    return [shape, gazetteer, context, checksum, edges]


def cell(text: str, kind: str, start: int, end: int) -> int:
    """One number for kind, votes and features of a span."""
    number = KINDS.index(kind)
    for v in votes(text, kind, start, end):
        number = number * 3 + v
    size = end - start
    share = sum("0" <= c <= "9" for c in text[start:end]) / size
    return number * FEATURES + min(3, size // 12) * 4 + min(3, int(share * 4))


def unpack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (rows by labelers) and features of cells."""
    features, rest = numbers % FEATURES, numbers // FEATURES
    given = []
    for _ in LABELERS:
        given.append(rest % 3)
        rest = rest // 3
    return rest, np.stack(given[::-1], axis=1), features


_SPAN = struct(
    kind=T.IntegerType(), start=T.IntegerType(), end=T.IntegerType(), base=T.BooleanType(), cell=T.IntegerType()
)


@F.arrow_udf(T.ArrayType(_SPAN))
def annotations(column: pa.Array) -> pa.Array:
    rows = []
    for text in strings(column):
        base = base_spans(text)
        every = [(s, True) for s in base] + [(s, False) for s in candidates(text, base)]
        rows.append([(KINDS.index(k), a, b, strict, cell(text, k, a, b)) for (k, a, b), strict in every])
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("cell", pa.int32())])
    names = [f.name for f in kind]
    return pa.array([[dict(zip(names, s, strict=True)) for s in r] for r in rows], pa.list_(kind))


class Reliability:
    """What the labelers' agreement says about each labeler, and about each cell.

    One hidden truth per span; a labeler that votes is right with a probability of its own, and better than chance.
    Silence says nothing: else kinds, which differ in who can vote, would be told apart instead of truth. ``PSEUDO``
    is the weight of the prior belief, as a share of all spans.
    """

    PSEUDO, EXPECTED = 0.05, 0.7

    def __init__(self, numbers: np.ndarray, counts: np.ndarray, rounds: int = 60):
        kinds, given, _ = unpack(numbers)
        weights = counts / counts.sum()
        signs = (given == 1).astype(float) - (given == 2)
        voted = weights @ np.abs(signs)
        of_kind = kinds == np.arange(len(KINDS))[:, None]
        truth = 1 / (1 + np.exp(-signs.sum(1)))
        for _ in range(rounds):
            right = (weights * truth) @ (signs > 0) + (weights * (1 - truth)) @ (signs < 0)
            self.accuracy = np.clip(
                (right + self.PSEUDO * self.EXPECTED) / (voted + self.PSEUDO), 0.51, 0.99
            )
            prior = (of_kind @ (weights * truth) + self.PSEUDO / 2) / (of_kind @ weights + self.PSEUDO)
            self.prior = np.clip(prior, 0.2, 0.8)
            odds = np.log(self.prior / (1 - self.prior))[kinds]
            odds = odds + signs @ np.log(self.accuracy / (1 - self.accuracy))
            truth = 1 / (1 + np.exp(-odds))
        self.truth = truth


class SpanClassifier:
    """Logistic regression on kind, votes and features, fitted to probabilities by Newton steps."""

    def __init__(self, numbers: np.ndarray, counts: np.ndarray, truth: np.ndarray, ridge: float = 1.0):
        x, weights = self.design(numbers), counts.astype(float)
        self.coefficients = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ self.coefficients, -30, 30)))
            gradient = x.T @ (weights * (truth - p)) - ridge * self.coefficients
            curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
            step = np.linalg.solve(curvature, gradient)
            self.coefficients += step
            if np.abs(step).max() < 1e-8:
                break

    @staticmethod
    def design(numbers: np.ndarray) -> np.ndarray:
        kinds, given, features = unpack(numbers)
        parts = [np.ones((len(numbers), 1)), kinds[:, None] == np.arange(len(KINDS))]
        parts += [given[:, k, None] == np.array([1, 2]) for k in range(len(LABELERS))]
        parts += [(features // 4)[:, None] == np.arange(4), (features % 4)[:, None] == np.arange(4)]
        return np.concatenate(parts, axis=1).astype(float)

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(numbers) @ self.coefficients, -30, 30)))


def learn(annotated: DataFrame) -> tuple[list[int], Reliability | None]:
    """The cells that the classifier accepts, from the counts of all cells in the corpus (at most ``CELLS`` rows)."""
    counts = annotated.select(F.explode("spans").alias("s")).groupBy("s.cell").count().orderBy("cell").collect()
    if not counts:
        return [], None
    numbers, sizes = (np.array(c, np.int64) for c in zip(*counts, strict=True))
    reliability = Reliability(numbers, sizes)
    accepted = SpanClassifier(numbers, sizes, reliability.truth).probability(numbers) >= 0.5
    return numbers[accepted].tolist(), reliability


def _written_out(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``base`` and ``spans`` (arrays of kind, start, end in code points, end exclusive)."""
    small_batches(docs.sparkSession)
    annotated = written(docs.select(F.col(key), annotations(F.col(text)).alias("spans")), "spans")
    accepted, _ = learn(annotated)
    good = F.array(*map(F.lit, accepted)) if accepted else F.array().cast("array<int>")
    ordered = annotated.select(key, F.array_sort("spans").alias("every"))
    return ordered.select(
        key,
        F.filter("every", lambda s: s["base"]).alias("base"),
        F.filter("every", lambda s: s["base"] | F.array_contains(good, s["cell"])).alias("spans"),
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of base spans by kind, a digest of the base spans, and all spans written out."""
    found = find(docs, key, text)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select(
        key,
        *counts,
        F.sha2(_written_out(F.col("base")), 256).alias("base_sha256"),
        _written_out(F.col("spans")).alias("spans"),
    )
