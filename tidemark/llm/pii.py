"""Personal data: fixed patterns, and weakly supervised spans beside them.

Spans of the fixed patterns (email, ip, card, phone) always stand. Beside them a broad pattern proposes
candidates of further kinds: keys and tokens (secret: a run of at least 16 letters, digits and `_+/-`, or three
runs of at least 10 joined by dots), spelled-out addresses (contact: "at" and "dot" in brackets or between blanks)
and grouped numbers (number: two to five groups of two to four digits, joined by one of `-/ .` throughout). What
is shorter, or written with other signs, is no candidate. Labelers of three sorts vote on each candidate - shape patterns, gazetteers of words,
and the words before it - for, against, or not at all. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is personal; a logistic
classifier over the candidates' features, fitted to these likelihoods, decides. There are at most
3 ** 5 vote patterns and 2 ** 6 feature patterns a kind, so the counts that reach the driver are bounded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "contact", "number")
KINDS = BASE_KINDS + ADDED_KINDS
ACCEPT = 0.5

# The base patterns, possessive where a shorter match could not succeed either.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each domain back over the characters a local part may have."""
    past = 0
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            past = match.end()
            yield start, past


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        if 16 <= match.end() - match.start() <= 60:
            digits = match[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in match[0]) <= 15:
                spans.append(("phone", *match.span()))
    return spans


# Candidates of the added kinds: runs of 16 or more signs or three joined by dots; addresses with "at" and "dot" in
# brackets or between blanks; two to five groups of two to four digits with one separator throughout
SECRET = re.compile(
    r"(?<![A-Za-z0-9_+/-])(?:[A-Za-z0-9_+/-]{10,}+(?:\.[A-Za-z0-9_+/-]{10,}+){2}|[A-Za-z0-9_+/-]{16,}+={0,2})(?![A-Za-z0-9_+/-])"
)
CONTACT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(](?i:at)[\])] ?| (?i:at) )[A-Za-z0-9-]{1,63}+"
    r"(?:(?: ?[\[(](?i:dot)[\])] ?| (?i:dot) )[A-Za-z0-9-]{1,63}+)++"
)
NUMBER = re.compile(r"(?<![0-9A-Za-z+.-])[0-9]{2,4}([-/ .])[0-9]{2,4}(?:\1[0-9]{2,4}){0,3}(?![0-9A-Za-z-])")
PATTERNS = (("secret", SECRET), ("contact", CONTACT), ("number", NUMBER))
# How issued keys and signed tokens begin, and frequent ends of domain names
ISSUED = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk[-_][A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_+/-]+){2}")
ENDS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch".split())

# Gazetteers: words that stand before such data, and words that speak against it
SECRET_WORDS = frozenset("token key apikey api_key secret password passwd pwd auth bearer credential access".split())
CONTACT_WORDS = frozenset("mail email e-mail contact write reach address".split())
NUMBER_WORDS = frozenset("ssn social passport tax id phone tel telephone call account iban nino".split())
WORDS = {"secret": SECRET_WORDS, "contact": CONTACT_WORDS, "number": NUMBER_WORDS}
AGAINST = frozenset("version page pages chapter section figure date year release isbn sha commit checksum md5".split())
LABELERS = 5
BEFORE = 32


def mixed_case(value: str) -> bool:
    """Whether upper and lower case alternate as in random letters. In joined words capitals stand alone, or runs of small letters are long."""
    small = re.findall(r"[a-z]+", value)
    lower, upper = sum(map(len, small)), sum("A" <= c <= "Z" for c in value)
    return lower >= 4 and upper >= 4 and lower < 3 * len(small) and re.search(r"[A-Z]{2}", value) is not None


def votes_and_features(kind: str, text: str, start: int, end: int) -> tuple[int, int]:
    """The labelers' votes in base 3 (0 against, 1 none, 2 for) and the features in base 2."""
    value = text[start:end]
    before = text[max(0, start - BEFORE) : start].lower()
    words = re.findall(r"[a-z_-]+", before)[-3:]
    named, against = any(w in WORDS[kind] for w in words), any(w in AGAINST for w in words)
    assigned = bool(re.search(r"[=:]\s*[\"']?$", before))
    digits = sum(c.isdigit() for c in value)
    letters = sum(c.isalpha() for c in value)
    if kind == "secret":
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
        mixed = mixed_case(value)
        issued = bool(ISSUED.fullmatch(value))
        shaped = issued or bool(re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", value)) or len(value) >= 40 and (digits > 0 or mixed) and "." not in value
        strong = issued or mixed or turns >= len(value) // 5 and digits >= 4 and letters >= 4
        weak = not (issued or mixed) and (letters == 0 or turns <= 2 or "/" in value and "." in value)
    elif kind == "contact":
        tail = re.split(r"[^A-Za-z0-9]+", value)[-1].lower()
        bare = not re.search(r"[\])]", value)  # plain words may say the same, so the end of a domain has to be a frequent one
        shaped = tail in ENDS if bare else 2 <= len(tail) <= 6 and tail.isalpha()
        strong = digits > 0 or "." in re.split(r"(?i)[ \[(]at[ \])]", value)[0]
        weak = len(value) > 80 or bare and not shaped
    else:
        shaped = bool(re.fullmatch(r"[0-9]{3}([- .])[0-9]{2}\1[0-9]{4}|[0-9]{3}([- .])[0-9]{3}\2[0-9]{4}", value))
        loose = "." in value or " " in value  # sums and lists of figures look alike
        strong = shaped if loose else digits >= 9
        date = r"(?:19|20)[0-9]{2}([-/ .])[0-9]{2}(?:\1[0-9]{2,4})?|[0-9]{2}([-/ .])[0-9]{2}\2[0-9]{2,4}"
        weak = bool(re.fullmatch(date, value)) or digits < 7 or loose and not shaped
    votes = (2 if shaped else 1, 2 if strong else 0 if weak else 1, 2 if named else 0 if against else 1, 2 if assigned else 1, 0 if weak else 1)
    features = (shaped, strong, weak, named, against, assigned)
    return sum(v * 3**k for k, v in enumerate(votes)), sum(int(f) << k for k, f in enumerate(features))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, votes, features) of proposals that touch no base span; the earlier kind goes first."""
    taken = sorted((a, b) for _, a, b in base)
    out: list[tuple[str, int, int, int, int]] = []
    for kind, pattern in PATTERNS:
        if kind == "contact" and not any(word in text for word in ("dot", "Dot", "DOT")):
            continue
        for match in pattern.finditer(text):
            a, b = match.span()
            if _free(taken, a, b):
                out.append((kind, a, b, *votes_and_features(kind, text, a, b)))
        taken = sorted(taken + [(a, b) for k, a, b, *_ in out if k == kind])
    return out


def _free(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    from bisect import bisect_left

    at = bisect_left(taken, (a, a))
    return (at == len(taken) or taken[at][0] >= b) and (at == 0 or taken[at - 1][1] <= a)


@dataclass
class Model:
    """For each kind the feature patterns that are accepted, and the labelers' reliabilities."""

    accepted: dict[str, frozenset[int]]
    reliability: dict[str, list[float]]


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: the likelihood of each pattern, and for each labeler the
    probabilities of its votes given a negative and a positive span. It starts from the balance of votes."""
    signs = (votes == 2).sum(1) - (votes == 0).sum(1)
    likely = 1 / (1 + np.exp(-2.0 * signs))
    for _ in range(rounds):
        table = np.zeros((votes.shape[1], 2, 3))
        for side, weight in enumerate((1 - likely, likely)):
            for vote in range(3):
                table[:, side, vote] = ((votes == vote) * (counts * weight)[:, None]).sum(0) + (1.5 if vote == 2 * side else 0.5)
        table /= table.sum(2, keepdims=True)
        prior = (counts * likely).sum() + 1
        prior /= counts.sum() + 2
        logs = [np.log(table[np.arange(votes.shape[1]), side, votes]).sum(1) for side in (0, 1)]
        odds = logs[1] - logs[0] + math.log(prior / (1 - prior))
        likely = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return likely, table


def classifier(features: np.ndarray, likely: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic weights fitted to the likelihoods, each pattern weighted by its count; the constant last."""
    x = np.column_stack([features, np.ones(len(features))]).astype(float)
    share = counts / counts.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (share * (p - likely)) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(rows: list[tuple[str, int, int, int]]) -> Model:
    """A model from (kind, votes, features, count)."""
    accepted, reliability = {}, {}
    for kind in ADDED_KINDS:
        own = sorted(r for r in rows if r[0] == kind)
        if not own:
            accepted[kind] = frozenset()
            continue
        votes = np.array([[v // 3**k % 3 for k in range(LABELERS)] for _, v, _, _ in own])
        bits = np.array([[f >> k & 1 for k in range(6)] for _, _, f, _ in own])
        counts = np.array([float(n) for *_, n in own])
        likely, table = estimate(votes, counts)
        weights = classifier(bits, likely, counts)
        every = np.array([[f >> k & 1 for k in range(6)] + [1] for f in range(64)], float)
        keep = 1 / (1 + np.exp(-every @ weights)) >= ACCEPT
        seen = {f for _, _, f, _ in own}
        accepted[kind] = frozenset(f for f in range(64) if keep[f] and f in seen)
        reliability[kind] = [float((t[1, 2] + t[0, 0]) / 2) for t in table]
    return Model(accepted, reliability)


SPANS = "array<struct<kind:string,start:int,end:int,votes:int,features:int>>"


def proposed(text: Column) -> Column:
    """Base spans (votes -1) and candidates of a whole text; a null text has none."""

    def run(column: pa.Array) -> pa.Array:
        rows = []
        for value in texts(column):
            text = value.decode("utf-8", "replace")
            base = base_spans(text)
            spans = [(k, a, b, -1, -1) for k, a, b in base] + candidates(text, base)
            rows.append([dict(zip(("kind", "start", "end", "votes", "features"), s, strict=True)) for s in spans])
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.int32()), ("features", pa.int32())])
        return pa.array(rows, pa.list_(kind))

    return F.arrow_udf(run, SPANS)(text.cast("string"))


def train(spans: DataFrame) -> Model:
    """A model from a column `spans` of all documents; only counts of patterns are gathered."""
    each = spans.select(F.explode(F.filter("spans", lambda s: s["votes"] >= 0)).alias("c"))
    counted = each.groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n"))
    return learn([(r["kind"], r["votes"], r["features"], r["n"]) for r in counted.collect()])


def accepted(spans: Column, model: Model) -> Column:
    """Base spans, and candidates that the model accepts, by kind, then start."""

    def stands(span: Column) -> Column:
        ok = span["votes"] < 0
        for kind, patterns in sorted(model.accepted.items()):
            if patterns:
                ok |= (span["kind"] == kind) & span["features"].isin(sorted(patterns))
        return ok

    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        F.filter(spans, stands),
        lambda s: F.struct(F.array_position(order, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, base) of each document: all accepted spans, and those of the fixed patterns.

    Null and empty texts have none. Other columns are not read; the proposals of the texts are written once,
    so that the texts are read once.
    """
    from tidemark.session import materialize

    seen = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), proposed(F.col("text")).alias("spans")), "pii-spans")
    model = train(seen)
    base = accepted(F.filter("spans", lambda s: s["votes"] < 0), Model({}, {}))
    return seen.select("doc_id", accepted(F.col("spans"), model).alias("spans"), base.alias("base"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, counts: str = "n_chars") -> DataFrame:
    """Documents with each span replaced by its kind in brackets, all columns kept; n_chars follows the text.

    A span that another one overlaps is replaced together with it, under the kind of the first. Null texts stay null.
    """
    model = train(docs.select(proposed(F.col("text")).alias("spans")))

    def run(column: pa.Array) -> pa.Array:
        out = []
        for value, known in zip(texts(column), column.is_valid().to_pylist(), strict=True):
            out.append(replaced(value.decode("utf-8", "replace"), model) if known else None)
        return pa.array(out, pa.string())

    cleaned = docs.withColumn("text", F.arrow_udf(run, "string")(F.col("text").cast("string")))
    if counts in docs.columns:
        kind = dict(docs.dtypes)[counts]
        cleaned = cleaned.withColumn(counts, F.when(F.col(counts).isNotNull(), F.length("text").cast(kind)))
    return cleaned


def replaced(text: str, model: Model) -> str:
    base = base_spans(text)
    spans = [(a, b, k) for k, a, b in base]
    spans += [(a, b, k) for k, a, b, _, f in candidates(text, base) if f in model.accepted.get(k, ())]
    parts, past = [], 0
    for a, b, kind in sorted(spans):
        if a >= past:
            parts += [text[past:a], f"[{kind.upper()}]"]
        past = max(past, b)
    return "".join([*parts, text[past:]])
