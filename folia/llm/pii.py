"""Personal data by weak supervision: labelers vote on candidate spans, expectation
maximisation estimates how reliable each is, and a classifier trained on the resulting
probabilities decides about spans that no fixed pattern finds.

Candidates are addresses and numbers in looser forms than the fixed patterns. Labelers
are patterns (strict forms, checksums, dates, decimals), gazetteers (top-level domains,
dialing codes) and context (words before and after). A vote is for, against or none.
The votes on all candidates of all documents are counted by pattern of votes, which is at
most 3 ** len(LABELERS) numbers; the estimation runs on these counts. The classifier
is a logistic regression on the span's own features, fitted on a bounded sample of
candidates (`sample`, by hash; a parameter) with the estimated probabilities as labels.

Base spans always stay; added ones are of kind other and touch no base span. Defined
results: null and empty texts have no spans. Each input row gives one row, with repeated and
null ids as they are. Without candidates nothing is added. Every pattern is read in time
linear in the line, however long its runs of letters or digits are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.bytesops import Texts, chunks, pack
from folia.llm.common import id_text, map_arrow
from folia.llm.spans import Span, digest, joined, lines_with

# Fixed patterns of the contract. What stands before the @ of an address is found from there
# (`mails`): a pattern that begins with it would read a long run of letters once for each of them.
# So that runs of digits are read once, an address of numbers begins at the start of one.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT, DOMAIN = re.compile("@"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
# Looser forms; runs of more digits than a number may have are passed over at once.
LOOSE_AT = re.compile(r"@|[(\[]at[)\]]")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+")
NUMBER_LIKE = re.compile(r"(?!\+?[0-9]{26})\+?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}(?![0-9])")
DATE = re.compile(r"(?:19|20)?[0-9]{2}[./-][0-9]{1,2}[./-](?:19|20)?[0-9]{2}")
DECIMAL = re.compile(r"[0-9]+\.[0-9]+")
# Gazetteers and context words.
DOMAINS = frozenset("com org net edu gov info io co de fr es it nl uk us eu ch at be pl ru jp cn br example".split())
DIALING = ("+1", "+33", "+34", "+39", "+41", "+43", "+44", "+49", "+55", "+61", "+81", "+86", "+91")
PERSONAL = frozenset("phone tel telephone call mobile fax contact mail email e-mail card visa iban account ssn ip address reach number nr".split())
IMPERSONAL = frozenset("token key secret hash sha sha256 md5 isbn issn version serial id order page vol doi build".split())
LONG = pa.int64()
SCHEMA = pa.schema([("doc_id", LONG), *((f"n_{k}", LONG) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_other", LONG)])
VOTES = pa.schema([("votes", pa.string()), ("order", LONG), ("features", pa.binary())])


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def mails(line: str, at: re.Pattern = AT, domain: re.Pattern = DOMAIN) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping spans of LOCAL characters, `at` and `domain`, in time linear
    in the line: each stretch between two marks is read once from its end. Marks of more
    than one character may have a space before and after."""
    least = 0  # nothing before it belongs to a further address
    for m in at.finditer(line):
        p, q = m.span()
        if q - p > 1:
            p -= p > least and line[p - 1] == " "
            q += line[q : q + 1] == " "
        if p > least:
            start = least + len(line[least:p].rstrip(LOCAL))
            rest = domain.match(line, q) if start < p else None
            if rest:
                yield start, rest.end()
                least = rest.end()
                continue
        least = max(least, m.end())


def _small(part: str) -> bool:
    """Whether the digits are a number up to 255, however many zeros it begins with."""
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _byte_marks(t: Texts) -> dict[str, np.ndarray]:
    data = t.data
    digit = (data >= 48) & (data <= 57)
    after = np.append(digit[1:], False)
    before = np.insert(digit[:-1], 0, False) if len(digit) else digit
    return {"at": data == 64, "dot": (data == 46) & before & after, "digit": digit, "plus": (data == 43) & after, "loose": (data == 64) | (data == 40) | (data == 91)}


def base_spans(t: Texts) -> list[list[Span]]:
    marks = _byte_marks(t)
    by = lambda pattern: lambda line: (m.span() for m in pattern.finditer(line))
    kinds = [
        ("email", mails, marks["at"], lambda v: True),
        ("ip", by(IP), marks["dot"], lambda v: all(map(_small, v.split(".")))),
        ("card", by(CARD), marks["digit"], lambda v: 16 <= len(d := _digits(v)) <= 19 and luhn(d)),
        ("phone", by(PHONE), marks["plus"], lambda v: 8 <= len(_digits(v)) <= 15),
    ]
    out: list[list[Span]] = [[] for _ in range(t.size)]
    for place, (kind, spans, hit, test) in enumerate(kinds):
        for text, first, line in lines_with(t, hit):
            base = int(t.code_points[first] - t.code_points[t.offsets[text]])
            out[text] += [(place, kind, base + a, base + b) for a, b in spans(line) if test(line[a:b])]
    return out


@dataclass
class Candidate:
    kind: str
    text: int
    start: int
    end: int
    value: str
    before: list[str]
    after: str


def candidates(t: Texts) -> list[Candidate]:
    """Spans of the looser forms, in code points of their text."""
    marks, out = _byte_marks(t), []
    loose = lambda line: mails(line, LOOSE_AT, LOOSE_DOMAIN)
    numbers = lambda line: (m.span() for m in NUMBER_LIKE.finditer(line))
    for kind, spans, hit in (("m", loose, marks["loose"]), ("n", numbers, marks["digit"])):
        for text, first, line in lines_with(t, hit):
            base = int(t.code_points[first] - t.code_points[t.offsets[text]])
            for a, b in spans(line):
                words = [w.strip(".,:;()\"'=").lower() for w in line[max(0, a - 48) : a].split()[-3:]]
                out.append(Candidate(kind, text, base + a, base + b, line[a:b], words, line[b : b + 1]))
    return out


# Each labeler: 1 for personal, -1 against, 0 none.
LABELERS = (
    lambda c: 1 if EMAIL.fullmatch(c.value) else 0,
    lambda c: 1 if PHONE.fullmatch(c.value) and 8 <= len(_digits(c.value)) <= 15 else 0,
    lambda c: (1 if luhn(d) else -1) if 13 <= len(d := _digits(c.value)) <= 19 and "@" not in c.value else 0,
    lambda c: (1 if re.split(r"[.)\]\x20]", c.value)[-1].lower() in DOMAINS else -1) if "@" in c.value or "at" in c.value else 0,
    lambda c: 1 if c.value.startswith(DIALING) else 0,
    lambda c: 1 if PERSONAL.intersection(c.before) else 0,
    lambda c: -1 if IMPERSONAL.intersection(c.before) else 0,
    lambda c: -1 if DATE.fullmatch(c.value) or DECIMAL.fullmatch(c.value) else 0,
)
N_FEATURES = 14


def features(c: Candidate) -> list[float]:
    digits = _digits(c.value)
    n = max(len(c.value), 1)
    return [
        1.0,
        float("@" in c.value),
        float("(at)" in c.value or "[at]" in c.value),
        c.value.count(".") / n,
        float(c.value.startswith("+")),
        len(digits) / n,
        float(len(digits) in range(8, 16)),
        float(len(digits) >= 16),
        float(luhn(digits) if len(digits) >= 13 else 0),
        len(re.findall(r"[\x20()-]", c.value)) / n,
        float(bool(PERSONAL.intersection(c.before))),
        float(bool(IMPERSONAL.intersection(c.before))),
        float(bool(DATE.fullmatch(c.value) or DECIMAL.fullmatch(c.value))),
        float(c.after.isalnum()),
    ]


def reliabilities(votes: np.ndarray, counts: np.ndarray, steps: int = 100) -> tuple[float, np.ndarray]:
    """Expectation maximisation over counted patterns of votes.

    Returns the share of personal spans, and the probability of each vote (-1, 0, 1) of
    each labeler by class. No labeler may be worse than chance: one that would be
    is given the same probability in both classes.
    """
    share = 0.5
    table = np.tile(np.array([[0.3, 0.4, 0.3]]), (2, votes.shape[1], 1))
    table[1, :, 2], table[1, :, 0] = 0.5, 0.1
    table[0, :, 2], table[0, :, 0] = 0.1, 0.5
    for _ in range(steps):
        p = posterior(votes, share, table)
        weight = np.stack([counts * (1 - p), counts * p])
        new = float(np.clip(weight[1].sum() / counts.sum(), 0.01, 0.99))
        for vote in (-1, 0, 1):
            table[:, :, vote + 1] = (weight @ (votes == vote) + 1) / (weight.sum(1, keepdims=True) + 3)
        for vote, more in ((2, 1), (0, 0)):
            wrong = table[more, :, vote] < table[1 - more, :, vote]
            table[:, wrong, vote] = ((weight @ (votes == vote - 1)).sum(0) + 1)[wrong] / (counts.sum() + 3)
        if abs(new - share) < 1e-9:
            break
        share = new
    return share, table


def posterior(votes: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """The probability that each pattern of votes belongs to a personal span.

    No vote says nothing about the class, so it is left out.
    """
    odds = np.full(len(votes), np.log(share / (1 - share)))
    for j in range(votes.shape[1]):
        for vote in (-1, 1):
            odds += np.where(votes[:, j] == vote, np.log(table[1, j, vote + 1] / table[0, j, vote + 1]), 0.0)
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_logistic(x: np.ndarray, p: np.ndarray, steps: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on probabilities instead of labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - q) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _written(votes: np.ndarray) -> str:
    return "".join("-0+"[v + 1] for v in votes)


def _read(votes: list[str]) -> np.ndarray:
    return np.array([["-0+".index(x) - 1 for x in v[1:]] for v in votes]).reshape(-1, len(LABELERS))


def fit_spans(docs: DataFrame, sample: int = 20_000) -> tuple[np.ndarray, dict[str, tuple[float, np.ndarray]]]:
    """Weights of the classifier, and by kind of candidate the estimates it learned from:
    addresses and numbers are judged by other labelers, so each kind has its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                own = candidates(t)
                votes = [c.kind + _written([f(c) for f in LABELERS]) for c in own]
                order = [hash_of(c) for c in own]
                yield pack({"votes": votes, "order": order, "features": [np.array(features(c), np.float32).tobytes() for c in own]}, VOTES)

    seen = map_arrow(id_text(docs), run, VOTES)
    # Equal candidates count together: patterns of votes and features are few.
    table = seen.groupBy("votes", "features").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("order")).cache()
    patterns = table.groupBy("votes").agg(F.sum("n").alias("n")).collect()
    rows = table.orderBy("order", "votes", "features").limit(sample).collect()
    table.unpersist()
    estimates, x, p = {}, [np.zeros((0, N_FEATURES))], [np.zeros(0)]
    for kind in sorted({r.votes[0] for r in patterns}):
        own = sorted((r for r in patterns if r.votes[0] == kind), key=lambda r: r.votes)
        share, by_class = reliabilities(_read([r.votes for r in own]), np.array([r.n for r in own], float))
        estimates[kind] = share, by_class
        some = [r for r in rows if r.votes[0] == kind]
        if some:
            x.append(np.stack([np.frombuffer(bytes(r.features), np.float32) for r in some]).astype(float))
            p.append(posterior(_read([r.votes for r in some]), share, by_class))
    return fit_logistic(np.concatenate(x), np.concatenate(p)), estimates


def hash_of(c: Candidate) -> int:
    import zlib

    return zlib.crc32(c.value.encode(), c.start)


def personal_data(docs: DataFrame, sample: int = 20_000) -> DataFrame:
    """All spans of every document; those the patterns find, and what the classifier adds."""
    weights, _ = fit_spans(docs, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                base = base_spans(t)
                more: list[list[Span]] = [[] for _ in base]
                for c in candidates(t):
                    clear = not any(c.start < b and a < c.end for _, _, a, b in base[c.text])
                    if clear and np.array(features(c)) @ weights > 0:
                        more[c.text].append((4, "other", c.start, c.end))
                yield pack(
                    {f"n_{k}": [sum(s[1] == k for s in own) for own in base] for k in KINDS}
                    | {
                        "doc_id": batch.column("doc_id").slice(t.first, t.last - t.first),
                        "base_sha256": [digest(x, False) for x in base],
                        "spans": [joined(x + y, False) for x, y in zip(base, more, strict=True)],
                        "n_other": [len(x) for x in more],
                    },
                    SCHEMA,
                )

    return map_arrow(id_text(docs), run, SCHEMA)
