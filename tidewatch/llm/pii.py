"""Personal data: generators with high recall propose spans, boosted trees score them, calibrated thresholds select.

Base patterns (email, ip, card, phone) are found on the whole text and always stay. Looser generators propose
overlapping spans of the same kinds: spelled-out addresses, broken-up quads, digit groups with and
without a leading part. Spark's gradient-boosted trees are trained on findings whose truth is known because
they were planted: genuine values in many forms, and near misses, at random places of a bounded sample
of the documents. A threshold per kind is calibrated on planted places that no tree has seen.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces
from tidewatch.shared import durable

KINDS = ("email", "ip", "card", "phone")

# Bounds of what the classifier is trained on: documents, characters of each, findings planted in all of them.
SAMPLE_ROWS, SAMPLE_CHARS, PLANTED = 1500, 4000, 6000
# The share of selected places that must be genuine on the places held out; no threshold reaching it selects none.
PRECISION = 0.99
TREES, DEPTH = 24, 4
CONTEXT = 40

Span = tuple[str, int, int]

# ---------------------------------------------------------------------------------------------
# Base patterns. A run can only match from its first character on, so each run is read once.

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c)
        if i % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, in the order of their start and then of :data:`KINDS`."""
    out: list[Span] = []
    if "@" in text:
        end = 0
        for match in DOMAIN.finditer(text):
            start = match.start()
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < match.start():
                end = match.end()
                out.append(("email", start, end))
    for match in QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match[0].split(".")):
            out.append(("ip", *match.span()))
    for match in DIGITS.finditer(text):
        if match.end() - match.start() >= 14:
            digits = NOT_DIGIT.sub("", match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *match.span()))
    if "+" in text:
        for match in PLUS.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
                out.append(("phone", *match.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---------------------------------------------------------------------------------------------
# Generators

AT = r"(?:\s?@\s?|\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|\s(?:at|AT)\s)"
DOT = r"(?:\s?\.\s?|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\s(?:dot|DOT)\s)"
# Bounded parts: a name ends at 64 characters and a label of a domain at 63.
SPELLED = re.compile(rf"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]{{0,63}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}")
BROKEN_QUAD = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s?\[?\(?\.\)?\]?\s?[0-9]{1,3}){3}(?![\w.]*[0-9])")
COLONS = re.compile(r"(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
GROUPS = re.compile(r"(?<![\w.,])[+(]{0,2}[0-9]{1,19}(?:[ ./()-]{1,3}[0-9]{1,19}){0,8}(?![\w%]|[.,][0-9])")
GROUP = re.compile(r"[0-9]+")


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data; several can overlap, one place can be proposed as several kinds."""
    found: set[Span] = set()
    for match in SPELLED.finditer(text):
        start, end = match.span()
        found.add(("email", start, end))
        # A domain may have taken a following word in: also without its last part.
        marks = list(re.finditer(DOT, text[start:end]))
        if len(marks) > 1:
            found.add(("email", start, start + marks[-1].start()))
    for pattern in (BROKEN_QUAD, COLONS):
        found.update(("ip", *match.span()) for match in pattern.finditer(text))
    for match in GROUPS.finditer(text):
        start, end = match.span()
        digits = sum(c.isdigit() for c in match[0])
        if digits < 7:
            continue
        starts = [m.start() for m in GROUP.finditer(match[0])]
        ends = [m.end() for m in GROUP.finditer(match[0])]
        for a, b in ((0, len(ends) - 1), (1, len(ends) - 1), (0, len(ends) - 2)):
            if a > b or a >= len(starts) or b < 0:
                continue
            left = start if a == 0 else start + starts[a] - (match[0][starts[a] - 1] in "(+")
            right = start + ends[b]
            n = sum(c.isdigit() for c in text[left:right])
            if 7 <= n <= 15:
                found.add(("phone", left, right))
            if 12 <= n <= 19:
                found.add(("card", left, right))
    return sorted(found, key=lambda s: (s[1], s[2], KINDS.index(s[0])))


# Fixed words that stand before such values.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "from", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "carte", "karte", "tarjeta"),
    "phone": ("call", "phone", "tel", "telephone", "mobile", "fax", "cell", "telefon"),
}
# Fixed words that stand before other numbers.
OTHER_CUES = ("order", "invoice", "version", "page", "section", "no", "number", "id", "item", "isbn", "serial", "chapter", "date")
WORD = re.compile(r"[\w-]+")


def features(text: str, span: Span) -> list[float]:
    """Format of the span and what stands around it."""
    kind, start, end = span
    value = text[start:end]
    groups = GROUP.findall(value)
    digits = "".join(groups)
    lengths = [len(g) for g in groups] or [0]
    marks = re.sub(r"\w", "", value)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    words = [w.lower() for w in WORD.findall(before)[-3:]]
    last, following = before[-1:] or " ", after[:1] or " "
    labels = re.split(DOT, value) if kind == "email" else []
    parts = [int(g) for g in groups[:4] if len(g) <= 3]
    return [
        *(float(kind == k) for k in KINDS),
        float(len(value)), float(len(digits)), float(len(groups)), float(min(lengths)), float(max(lengths)),
        float(lengths[0]), float(lengths[-1]), float(lengths[-2] if len(lengths) > 1 else 0),
        float(len(set(marks)) <= 1), *(float(marks.count(c)) for c in " -.(/:@["), float(value.startswith("+")), float(value.startswith("00")),
        float(len(set(digits))), float(luhn(digits)) if digits else 0.0, float(digits[:1] in "3456") if digits else 0.0,
        float(max(parts, default=0)), float(len(parts) == 4 and max(parts) <= 255), float(any(len(g) > 1 and g[0] == "0" for g in groups)),
        float(len(labels)), float(len(labels[-1].strip()) if labels else 0), float(bool(labels) and labels[-1].strip().isalpha()),
        float(bool(re.search(r"\b(?:at|AT)\b|@", value))), float(bool(re.search(r"\b(?:dot|DOT)\b|\.", value))), float("[" in value or "(" in value),
        float(sum(c.isalpha() for c in value)), float(last.isalnum()), float(last in "=/#$€£\"'_"), float(following.isalnum()), float(following in "%/=_\"'€$°"),
        float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
        float(any(w in CUES[kind] for w in words)), float(bool(words) and words[-1] in CUES[kind]), float(any(w in OTHER_CUES for w in words)),
        float(before.rstrip().endswith(":")), float(not before.strip()),
    ]


# ---------------------------------------------------------------------------------------------
# Planted findings


def _digits(rng: random.Random, n: int) -> str:
    return str(rng.randint(1, 9)) + "".join(rng.choices("0123456789", k=n - 1))


def _card(rng: random.Random, genuine: bool, n: int = 16) -> str:
    start = rng.choice("3456") + "".join(rng.choices("0123456789", k=n - 2))
    check = next(d for d in range(10) if luhn(f"{start}{d}"))
    return f"{start}{check if genuine else (check + rng.randint(1, 9)) % 10}"


def _name(rng: random.Random) -> str:
    return "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 9)))


def _grouped(digits: str, sep: str, sizes: Sequence[int]) -> str:
    out, at = [], 0
    for size in sizes:
        out.append(digits[at : at + size])
        at += size
    return sep.join(part for part in [*out, digits[at:]] if part)


def _quad(rng: random.Random, genuine: bool = True) -> list[str]:
    parts = [rng.randint(1, 255) for _ in range(4)]
    if not genuine:
        parts[rng.randrange(4)] = rng.randint(256, 999)
    return [str(p) for p in parts]


TLDS = ("com", "org", "net", "de", "fr", "es", "io", "edu")

FORMS = {
    # form: (kind or None for a near miss, value)
    "email": ("email", lambda r: f"{_name(r)}.{_name(r)}@{_name(r)}.{r.choice(TLDS)}"),
    "email spelled": ("email", lambda r: f"{_name(r)} at {_name(r)} dot {r.choice(TLDS)}"),
    "email round": ("email", lambda r: f"{_name(r)}(at){_name(r)}(dot){r.choice(TLDS)}"),
    "email square": ("email", lambda r: f"{_name(r)} [at] {_name(r)} [dot] {r.choice(TLDS)}"),
    "email apart": ("email", lambda r: f"{_name(r)} @ {_name(r)}.{r.choice(TLDS)}"),
    "ip": ("ip", lambda r: ".".join(_quad(r))),
    "ip apart": ("ip", lambda r: " . ".join(_quad(r))),
    "ip square": ("ip", lambda r: "[.]".join(_quad(r))),
    "ip six": ("ip", lambda r: ":".join(f"{r.randrange(1 << 16):x}" for _ in range(8))),
    "card": ("card", lambda r: _card(r, True)),
    "card dashes": ("card", lambda r: _grouped(_card(r, True), r.choice(" -"), (4, 4, 4))),
    "card dots": ("card", lambda r: _grouped(_card(r, True), ".", (4, 4, 4))),
    "card wide": ("card", lambda r: _grouped(_card(r, True), r.choice(["  ", " - ", "/"]), (4, 4, 4))),
    "phone plus": ("phone", lambda r: f"+{r.randint(1, 99)} ({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}"),
    "phone round": ("phone", lambda r: f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}"),
    "phone dashes": ("phone", lambda r: f"{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}"),
    "phone dots": ("phone", lambda r: f"{_digits(r, 3)}.{_digits(r, 3)}.{_digits(r, 4)}"),
    "phone zeros": ("phone", lambda r: f"00{r.randint(20, 99)} {_digits(r, 2)} {_digits(r, 4)} {_digits(r, 4)}"),
    "talk": (None, lambda r: f"{_name(r)} at {_name(r)}. {_name(r)}"),
    "handle": (None, lambda r: f"@{_name(r)} {_name(r)}"),
    "quad beyond": (None, lambda r: ".".join(_quad(r, False))),
    "version": (None, lambda r: f"{r.randint(0, 30)}.{r.randint(0, 30)}.{r.randint(0, 9)}"),
    "card failing": (None, lambda r: _card(r, False)),
    "card failing grouped": (None, lambda r: _grouped(_card(r, False), r.choice([" ", "-", ".", "  ", "/"]), (4, 4, 4))),
    "order": (None, lambda r: _digits(r, r.randint(7, 13))),
    "long number": (None, lambda r: _digits(r, r.randint(17, 25))),
    "day": (None, lambda r: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"),
    "day and time": (None, lambda r: f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.{r.randint(1900, 2030)} {r.randint(0, 23):02}:{r.randint(0, 59):02}"),
    "clock": (None, lambda r: f"{r.randint(0, 23)}:{r.randint(0, 59):02}:{r.randint(0, 59):02}"),
    "years": (None, lambda r: f"{r.randint(1500, 2030)}-{r.randint(1500, 2030)} {r.randint(1, 400)}"),
    "book": (None, lambda r: f"97{r.randint(8, 9)}-{r.randint(0, 9)}-{_digits(r, 4)}-{_digits(r, 4)}-{r.randint(0, 9)}"),
    "row": (None, lambda r: " ".join(_digits(r, r.randint(1, 4)) for _ in range(r.randint(3, 7)))),
    "parts": (None, lambda r: "-".join(_digits(r, r.randint(2, 6)) for _ in range(r.randint(2, 4)))),
}


def planted_candidates(text: str, number: int, forms: Sequence[str], planted: int) -> Iterator[tuple[str, str, int, bool, list[float]]]:
    """(kind, form, label, held, features) of what the generators propose around values planted in ``text``."""
    places = [m.end() for m in re.finditer(r"\S(?=\s|$)", text)] or [0]
    for k in range(planted):
        rng = random.Random(number * 1009 + k)
        form = rng.choice(forms)
        kind, make = FORMS[form]
        at, value = rng.choice(places), make(rng)
        cue = ""
        if rng.random() < 0.4:
            cue = " " + rng.choice(CUES[kind] if kind else OTHER_CUES) + rng.choice(["", ":"])
        left = text[max(0, at - 2 * CONTEXT) : at] + cue + " "
        whole = left + value + rng.choice(["", "", ".", ","]) + text[at : at + 2 * CONTEXT]
        span = (len(left), len(left) + len(value))
        held, base = rng.random() < 1 / 3, base_spans(whole)
        for candidate in candidates(whole):
            inside = candidate[1] < span[1] and span[0] < candidate[2]
            label = int(inside and (candidate[0], candidate[1:]) == (kind, span))
            if inside or not any(b[1] < candidate[2] and candidate[1] < b[2] for b in base):
                yield candidate[0], form if inside else "text", label, held, features(whole, candidate)


def planted_rows(docs: DataFrame, forms: Sequence[str] = tuple(FORMS)) -> DataFrame:
    """kind, form, label, held and features of the candidates around planted values (see the bounds above)."""
    hashed = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("number"), F.left("text", F.lit(SAMPLE_CHARS)).alias("text"))
    total = docs.count()
    if total > SAMPLE_ROWS:
        share = 2 * SAMPLE_ROWS / total
        hashed = hashed.where(F.pmod(F.col("number"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = hashed.orderBy("number").limit(SAMPLE_ROWS)
    each = min(64, -(-PLANTED // max(1, min(total, SAMPLE_ROWS))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                row
                for number, text in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist())
                for row in planted_candidates(text or "", number, forms, each)
            ]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], ["kind", "form", "label", "held", "features"]
            )

    return sample.mapInArrow(read, "kind string, form string, label int, held boolean, features array<double>")


# ---------------------------------------------------------------------------------------------
# Model


@dataclass
class Model:
    """Trees as arrays (feature -1: a leaf) with their weights, and the least score of every kind."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=lambda: dict.fromkeys(KINDS, float("inf")))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities from the boosted margins, for all rows at once."""
        margin = np.zeros(len(rows))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                low = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def tree_arrays(node) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of one of Spark's trees, the root first."""
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            rows[at][:2] = [split.featureIndex(), split.threshold()]
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        return at

    walk(node)
    columns = list(zip(*rows))
    return tuple(np.array(c, t) for c, t in zip(columns, (np.int64, float, np.int64, np.int64, float)))


def train(docs: DataFrame, forms: Sequence[str] = tuple(FORMS)) -> Model:
    """Boosted trees and thresholds from values planted in a bounded sample of ``docs``; no rows: nothing is selected."""
    rows = durable(planted_rows(docs, forms))
    model = Model()
    fitted = rows.where("NOT held").select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
    if fitted.isEmpty():
        return model
    boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64).fit(fitted.coalesce(1))
    model.trees = [tree_arrays(tree._java_obj.rootNode()) for tree in boosted.trees]
    model.weights = list(boosted.treeWeights)
    model.thresholds = thresholds(model, rows.where("held").select("kind", "label", "features").toArrow())
    return model


def thresholds(model: Model, held: pa.Table) -> dict[str, float]:
    """Of every kind the least score from which on ``PRECISION`` of the held-out places are genuine."""
    out = dict.fromkeys(KINDS, float("inf"))
    if held.num_rows == 0:
        return out
    kinds, labels = np.array(held["kind"].to_pylist()), held["label"].to_numpy()
    score = model.scores(np.array(held["features"].to_pylist(), float))
    for kind in KINDS:
        own = kinds == kind
        order = np.argsort(-score[own], kind="stable")
        ranked, truth = score[own][order], labels[own][order]
        if not truth.any():
            continue
        precise = np.cumsum(truth) / np.arange(1, len(truth) + 1) >= PRECISION
        precise &= np.append(ranked[1:] < ranked[:-1], True)  # a threshold takes all places of its score
        if precise.any():
            out[kind] = max(0.5, float(ranked[np.flatnonzero(precise)[-1]]))
    return out


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Selected candidates that overlap no base span and no better candidate."""
    free = [c for c in candidates(text) if not any(b[1] < c[2] and c[1] < b[2] for b in base)] if model.trees else []
    if not free:
        return []
    score = model.scores(np.array([features(text, c) for c in free]))
    ranked = sorted((-s, c[1], -c[2], KINDS.index(c[0]), c) for s, c in zip(score.tolist(), free) if s >= model.thresholds[c[0]])
    chosen: list[Span] = []
    for *_, c in ranked:
        if not any(o[1] < c[2] and c[1] < o[2] for o in chosen):
            chosen.append(c)
    return chosen


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the ``spans`` of every whole text: kind, code points from and up to, whether a base pattern found it.

    Null and empty texts have none. A row per row, repeated ones too; a null id stays null; other columns
    are ignored; an empty table gives no row. Spans stand by start, then by kind as in :data:`KINDS`. Of equal scores
    the earlier, then the longer candidate is taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers at most
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text or "", base, shared.value)]
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(read, "doc_id long, spans " + SPANS)


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the ``text`` with every span replaced by its kind in brackets (overlapping spans as one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = sorted([*base, *added_spans(text or "", base, shared.value)], key=lambda s: (s[1], KINDS.index(s[0])))
                parts, at = [], 0
                for kind, start, end in spans:
                    if start >= at:
                        parts += [text[at:start], f"[{kind}]"]
                    at = max(at, end)
                out.append(None if text is None else "".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(read, "doc_id long, text string")


def personal_data_digest(found: DataFrame) -> DataFrame:
    """Per row: base spans of each kind, a hash of all base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
