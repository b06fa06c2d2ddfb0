"""Personal data: base rules, and boosted trees over further candidates.

The base rules find e-mail addresses, IP addresses, card numbers and phone
numbers; their spans always stand. Beside them, high-recall generators propose
overlapping candidates that the rules miss or that look alike: numbers in
groups with any separators, dotted, bracketed and colon-separated addresses,
addresses with "at" and "dot" spelled out. Each candidate has features of its
format (digits, groups, separators, checksum, range checks) and of its context
(neighbouring characters, key words before it, digits around it). Gradient
boosted trees are trained on the candidates of all documents, equal ones as one
row with their number as its weight (the points at which a feature may be split
are Spark's own quantiles). Their labels do not come from the base rules: ``judged`` holds what
a candidate says, in normal form, against its kind's own checks (checksum,
ranges, grouping, a prefix or a key word before it); one on which the checks
are silent teaches nothing. As personal data are rarely written in odd ways,
every base span is also rewritten in such ways within its own
context (``rewritten``) and taught as positive. On a held-out part the score
at which candidates reach ``PRECISION`` gives each kind's threshold; there,
those on which the checks are silent count as wrong. Candidates above it are
added, best first, where they overlap no span that is already there.

The trees go to every task (a fixed number of nodes) and texts are searched
whole, in one pass without a shuffle. Every scan is linear in the text.

Defined results: a null or empty text has no spans; without positive training
candidates, or where no score reaches the precision, a kind gets no further
spans; rows repeat as they are; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import broadcast, landed, read_table

KINDS = ("email", "ip", "card", "phone")
TRAIN_CANDIDATES = 50_000  # of those to look at
SENT = 20_000  # lessons a task holds before it sends them on
TASK_LESSONS = 100_000  # different lessons of a training task
TREES, DEPTH = 10, 3
PRECISION = 0.99
LEAST_POSITIVES = 20

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# generators: wider nets
GROUPS = re.compile(r"[+(]?[0-9](?:[\x20().,/_-]{0,2}[0-9])++")
HEXADDRESS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
BRACKETED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}(?![0-9])")
LOOSE_AT = re.compile(r"@\x20?[A-Za-z0-9-]+(?:\x20?\.[A-Za-z0-9-]+)+")
SPELLED = re.compile(r"(?:\x20?[\[(]at[\])]|\x20at\x20|@)\x20?[A-Za-z0-9-]+(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)"
                     r"[A-Za-z0-9-]+)+")
DIGIT = re.compile("[0-9]")
CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
        "card": ("card", "visa", "credit", "account", "iban"), "phone": ("tel", "phone", "call", "fax", "mobile")}
PLAIN = str.maketrans("", "", "[]()")
AT = re.compile(r"\x20?(?:[\[(]at[\])]|\bat\b|@)\x20?")
DOT = re.compile(r"\x20?(?:[\[(]dot[\])]|\bdot\b|\.)\x20?")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _before(text: str, at: int, floor: int) -> int:
    """Start of the run of address characters that ends at ``at``."""
    while at > floor and text[at - 1] in LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> dict[str, list[Span]]:
    """The base rules' spans by kind, in order."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    floor = 0
    for m in AT_DOMAIN.finditer(text):
        start = _before(text, m.start(), floor)
        if start < m.start():
            out["email"].append((start, m.end()))
            floor = m.end()
    first = DIGIT.search(text)
    if first is None:
        return out
    for m in QUAD.finditer(text, first.start()):
        if all(map(_small, m.group().split("."))):
            out["ip"].append(m.span())
    for m in CARD.finditer(text, first.start()):
        if m.end() - m.start() <= 40 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end): the generators' overlapping proposals."""
    out = []
    if DIGIT.search(text):
        for m in GROUPS.finditer(text):
            n = len(digits_of(m.group())) if m.end() - m.start() <= 60 else 0
            if 12 <= n <= 20:
                start = m.start() + (m.group()[0] in "+(")
                out.append(("card", start, m.end()))
            if 7 <= n <= 16:
                out.append(("phone", m.start(), m.end()))
        for m in QUAD.finditer(text):
            out.append(("ip", *m.span()))
        if "[.]" in text or "(.)" in text:
            out += [("ip", *m.span()) for m in BRACKETED.finditer(text)]
    if text.count(":") >= 3:
        for m in HEXADDRESS.finditer(text):
            out.append(("ip", *m.span()))
    if "@" in text or "dot" in text:
        floor = 0
        for m in (SPELLED if "dot" in text else LOOSE_AT).finditer(text):
            start = _before(text, m.start(), max(floor, m.start() - 64))
            if start < m.start():
                out.append(("email", start, m.end()))
                floor = m.end()
    return out


def judged(text: str, kind: str, start: int, end: int) -> bool | None:
    """Whether a candidate is personal data by its kind's checks on its normal
    form; None where they do not say."""
    span, head = text[start:end], text[max(0, start - 24):start].lower()
    digits, groups = digits_of(span), [len(x) for x in re.findall("[0-9]+", span)]
    cue = any(c in head for c in CUES[kind])
    if kind == "email":
        plain = DOT.sub(".", AT.sub("@", span, count=1))
        return ADDRESS.fullmatch(plain) is not None and ("@" in span or "[" in span or "(" in span or " dot " in span)
    if kind == "ip":
        if ":" in span:
            parts = span.split(":")
            full = len(parts) == 8 and "" not in parts or span.count("::") == 1 and len(parts) <= 8
            return full and any(c.isalpha() for c in span)
        return len(groups) == 4 and all(map(_small, span.translate(PLAIN).split(".")))
    if kind == "card":
        even = len(groups) == 1 or set(groups[:-1]) == {4} or groups in ([4, 6, 5], [4, 6, 4])
        if not luhn(digits) or not 13 <= len(digits) <= 19 or len(set(digits)) < 2:
            return False
        return True if even and (cue or len(digits) >= 16) else None
    prefixed = span[0] == "+" or digits[:2] == "00" and digits[2:3] not in ("", "0")
    if len(groups) == 1 and not prefixed and not cue or not 8 <= len(digits.removeprefix("00")) <= 15:
        return False
    return True if prefixed or cue else None


def rewritten(kind: str, span: str) -> list[str]:
    """A base span in the odd ways such data are written."""
    digits = digits_of(span)
    if kind == "email":
        user, host = span.split("@", 1)
        return [f"{user}{at}{host.replace('.', dot)}" for at, dot in
                ((" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", "."))]
    if kind == "ip":
        return [span.replace(".", "[.]"), span.replace(".", "(.)")]
    if kind == "card":
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [mark.join(fours) for mark in (".", "/", "_", "  ")]
    groups = re.findall("[0-9]+", span)
    return ["00" + " ".join(groups), "00" + ".".join(groups), "00" + "-".join(groups), "00" + digits]


FEATURES = ("kind_email", "kind_ip", "kind_card", "kind_phone", "length", "digits", "letters", "groups", "longest",
            "spaces", "dashes", "dots", "brackets", "other", "plus", "luhn", "quad_ok", "at_sign", "spelled",
            "letter_before", "letter_after", "mark_before", "mark_after", "cue", "digits_near")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, in the order of ``FEATURES``."""
    span, head, tail = text[start:end], text[max(0, start - 24):start], text[end:end + 8]
    digits = digits_of(span)
    runs = [len(x) for x in re.findall("[0-9]+", span)]
    counts = [span.count(" "), span.count("-"), span.count("."), span.count("(") + span.count(")")]
    letters = sum(c.isalpha() for c in span)
    parts = span.translate(PLAIN).split(".")
    quad = len(parts) == 4 and all(p.isdigit() and p.isascii() and _small(p) for p in parts)
    before, after = head[-1:], tail[:1]
    low = head.lower()
    return [float(x) for x in (
        *(kind == k for k in KINDS), len(span), len(digits), letters, len(runs), max(runs, default=0), *counts,
        len(span) - len(digits) - letters - sum(counts), span[:1] == "+" or before == "+", luhn(digits), quad,
        "@" in span, kind == "email" and "@" not in span, before.isalnum(), after.isalnum(),
        bool(before) and not before.isalnum() and not before.isspace(),
        bool(after) and not after.isalnum() and not after.isspace(),
        any(c in low for c in CUES[kind]), sum("0" <= c <= "9" for c in head + tail))]


class Trees:
    """A boosted ensemble as plain arrays."""

    def __init__(self, model):
        self.weights = list(model.treeWeights)
        self.trees = [self._nodes(t._java_obj.rootNode()) for t in model.trees]

    def _nodes(self, node):
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        return (split.featureIndex(), split.threshold(), self._nodes(node.leftChild()), self._nodes(node.rightChild()))

    def score(self, x: list[float]) -> float:
        margin = 0.0
        for w, node in zip(self.weights, self.trees):
            while isinstance(node, tuple):
                at, cut, left, right = node
                node = left if x[at] <= cut else right
            margin += w * node
        return 1 / (1 + math.exp(-2 * margin))


def lessons(text: str) -> Iterator[tuple[str, list[float], bool | None]]:
    """(kind, features, verdict) of a text's candidates, and of its base spans rewritten."""
    for kind, a, b in candidates(text):
        yield kind, features(text, kind, a, b), judged(text, kind, a, b)
    for kind, spans in base_spans(text).items():
        for a, b in spans:
            head, tail = text[max(0, a - 24):a], text[b:b + 8]
            for odd in rewritten(kind, text[a:b]):
                whole = (kind, len(head), len(head) + len(odd))
                other = head + odd + tail
                if whole in candidates(other):
                    yield kind, features(other, *whole), True


def proposed(docs: DataFrame) -> DataFrame:
    """(kind, x, label, held): the lessons of all documents; label null where
    the checks are silent."""
    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sent() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["kind", "x", "label", "held"]).astype({"label": "Float64"})

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                held = hashlib.md5(f"{doc_id}".encode()).digest()[0] % 3 == 0
                for kind, x, verdict in lessons(text or ""):
                    rows.append((kind, x, None if verdict is None else float(verdict), held))
                    if len(rows) == SENT:
                        yield sent()
                        rows = []
            yield sent()

    return docs.select("doc_id", "text").mapInPandas(propose, "kind string, x array<double>, label double, held boolean")


def training_rows(docs: DataFrame) -> DataFrame:
    """(kind, x, label, held, n): the different lessons of all documents, and
    how often each occurs."""
    return landed(proposed(docs).groupBy("kind", "x", "label", "held").agg(F.count(F.lit(1)).alias("n")), "pii-lessons")


def training_candidates(docs: DataFrame) -> DataFrame:
    """(kind, x, label, held): at most ``TRAIN_CANDIDATES`` lessons, the first by
    a hash, to look at. Nothing is learned from them."""
    # equal rows are alike, so the choice does not depend on their order
    return landed(proposed(docs).orderBy(F.xxhash64("kind", "x", "label", "held"), "kind", "x").limit(TRAIN_CANDIDATES),
                  "pii-candidates")


def fit(docs: DataFrame) -> tuple[Trees | None, dict[str, float]]:
    """The trees, and the score from which a candidate of a kind is redacted."""
    rows = training_rows(docs)
    train = rows.where("not held and label is not null")
    sizes = [r["count"] for r in train.groupBy("label").count().collect()]
    if len(sizes) < 2:
        return None, {}
    # by hash and in order: what a task adds up does not depend on how docs are dealt
    tasks = max(2, -(-sum(sizes) // TASK_LESSONS))
    train = train.repartition(tasks, "kind", "x", "label").sortWithinPartitions("kind", "x", "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, weightCol="n").fit(
        train.select(array_to_vector("x").alias("features"), "label", F.col("n").cast("double").alias("n")))
    trees = Trees(model)
    return trees, calibrated(rows.where("held"), trees)


def calibrated(held: DataFrame, trees: Trees) -> dict[str, float]:
    """The least score of each kind from which on ``PRECISION`` of the held-out
    candidates are right, ``LEAST_POSITIVES`` at least; those on which the checks
    are silent count as wrong."""
    sent = broadcast(held.sparkSession, trees)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent()
        for batch in batches:
            yield pd.DataFrame({"kind": batch["kind"], "score": [model.score(x) for x in batch["x"]],
                                "n": batch["n"], "good": batch["n"] * (batch["label"] == 1.0)})

    # a row for each sum of leaves that occurs: the trees bound their number, not the documents
    scores = held.select("kind", "x", "label", "n").mapInPandas(
        score, "kind string, score double, n long, good long").groupBy("kind", "score").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"))
    above = Window.partitionBy("kind").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = scores.select("kind", "score", F.sum("n").over(above).alias("n"), F.sum("good").over(above).alias("good"))
    fit = run.where((F.col("good") >= LEAST_POSITIVES) & (F.col("good") / F.col("n") >= PRECISION))
    return {r.kind: r.score for r in fit.groupBy("kind").agg(F.min("score").alias("score")).collect()}


def find(text: str | None, trees: Trees | None, cuts: dict[str, float]) -> tuple[dict, list[tuple[str, int, int]]]:
    """(base spans by kind, all spans by kind and start) of one text."""
    base = base_spans(text or "")
    spans = [(k, *s) for k in KINDS for s in base[k]]
    if text and trees is not None:
        taken, scored = bytearray(len(text)), []
        for _, a, b in spans:
            taken[a:b] = b"\x01" * (b - a)
        for kind, a, b in candidates(text):
            if kind in cuts and taken.find(1, a, b) < 0:
                score = trees.score(features(text, kind, a, b))
                if score >= cuts[kind]:
                    scored.append((-score, a, b, kind))
        for _, a, b, kind in sorted(scored):
            if taken.find(1, a, b) < 0:
                taken[a:b] = b"\x01" * (b - a)
                spans.append((kind, a, b))
        spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return base, spans


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, redact: bool = True) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted):
    a row per row of ``docs``; ``redacted`` is the text with each span replaced
    by its kind in brackets, null unless ``redact``."""
    sent = broadcast(docs.sparkSession, fit(docs))

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees, cuts = sent()
        for batch in batches:
            rows = []
            for text in batch:
                base, spans = find(text, trees, cuts)
                digest = hashlib.sha256(_joined([(k, *s) for k in KINDS for s in base[k]]).encode()).hexdigest()
                clean = redacted(text, spans) if redact else None
                rows.append((*(len(base[k]) for k in KINDS), digest, _joined(spans), clean))
            yield pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"])

    run = F.pandas_udf(search, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                               "spans string, redacted string")
    return docs.select("doc_id", run(F.col("text")).alias("_found")).select("doc_id", "_found.*")


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with its spans (overlapping ones as one) replaced."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"), redact=False).drop("redacted")
