"""Personal data: exact base patterns, and a semi-Markov conditional random field for what they miss.

The field scores whole candidate segments: up to `MAX_TOKENS` neighbouring tokens that hold a digit or an @.
Boundaries and types are chosen jointly by dynamic programming over a cluster of such tokens, whose cost is
bounded by the segment length and the number of types. It is trained on a bounded sample of documents, in which the
base matches serve as labels, by the gradient of the conditional likelihood (forward-backward over segments).
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 6
#: Documents that the field is fitted on, at most, and passes over them.
FIT_DOCUMENTS, FIT_PASSES = 1_000, 12
#: Longer documents are not picked for the sample, so that its size is bounded.
FIT_CHARACTERS = 20_000
_SPANS = "array<struct<start:bigint,kind_order:int,kind:string,end:bigint,base:boolean>>"

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_HOT = re.compile(r"[0-9@]\S*")
_TRIM_LEFT, _TRIM_RIGHT = "([{<\"'`,;:!?*#$%&|=", ")]}>\"'`,;:!?.*#$%&|="


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part cannot hold an @, so the leftmost match for an @ starts where the run before it does."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done = max(done, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) of the base matches that pass their checks, sorted."""
    found = [(s, 0, "email", e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    found.append((m.start(), 1, "ip", m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, "phone", m.end()))
    return sorted(found)


def clusters(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring tokens, one white space apart, that hold a digit or an @."""
    run: list[tuple[int, int]] = []
    at = 0
    while match := _HOT.search(text, at):
        start, end = match.span()
        while start > at and not text[start - 1].isspace():
            start -= 1
        if run and start - run[-1][1] > 1:
            yield run
            run = []
        run.append((start, end))
        at = end
    if run:
        yield run


def _bin(n: int) -> int:
    return n if n <= 16 else 16 + min(n.bit_length(), 12)


def segments(text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[str]]]:
    """(first token, last token + 1, start, end, features) of every segment of a cluster, without outer punctuation."""
    out = []
    for i in range(len(run)):
        for j in range(i + 1, min(len(run), i + MAX_TOKENS) + 1):
            start, end = run[i][0], run[j - 1][1]
            while start < end and text[start] in _TRIM_LEFT:
                start += 1
            while end > start and text[end - 1] in _TRIM_RIGHT:
                end -= 1
            if start == end:
                continue
            body = text[start:end]
            digits = _digits(body)
            letters = sum(c.isalpha() for c in body)
            dots = body.count(".")
            shape = re.sub("[^\\W\\d_]+", "a", re.sub("[0-9]+", "0", body[:64]))
            before = text[max(0, start - 12) : start].split()
            features = [
                f"tokens={j - i}",
                f"digits={_bin(len(digits))}",
                f"letters={_bin(letters) if letters < 4 else 'many'}",
                f"ats={min(body.count('@'), 2)}",
                f"dots={min(dots, 4)}",
                f"plus={body[0] == '+'}{body.count('+') > 1}",
                f"gaps={min(body.count(' ') + body.count('-'), 5)}",
                f"brackets={'(' in body}{')' in body}",
                f"luhn={12 <= len(digits) <= 19 and luhn(digits)}{letters == 0}",
                f"bytes={dots == 3 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in body.split('.'))}",
                f"shape={shape[:24]}",
                f"before={before[-1].lower().strip(':') if before else ''}",
                f"tail={'@' in body and bool(_DOMAIN.fullmatch(body.rpartition('@')[2]))}",
            ]
            out.append((i, j, start, end, features))
    return out


class SemiMarkovCRF:
    """Weights by kind and feature; a token outside segments scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = dict(weights or {})

    def score(self, kind: str, features: list[str]) -> float:
        get = self.weights.get
        return get((kind, "bias"), 0.0) + sum(get((kind, f), 0.0) for f in features)

    def _lattice(self, parts) -> dict[int, list[tuple[int, str, float, int]]]:
        by_end = defaultdict(list)
        for n, (i, j, _, _, features) in enumerate(parts):
            for kind in KINDS:
                by_end[j].append((i, kind, self.score(kind, features), n))
        return by_end

    def decode(self, tokens: int, parts) -> list[tuple[str, int, int]]:
        """The best choice of non-overlapping typed segments: (kind, start, end)."""
        by_end = self._lattice(parts)
        best, back = [0.0] * (tokens + 1), [None] * (tokens + 1)
        for j in range(1, tokens + 1):
            best[j] = best[j - 1]
            for i, kind, score, n in by_end[j]:
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind, n)
        out, j = [], tokens
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind, n = back[j]
                out.append((kind, parts[n][2], parts[n][3]))
                j = i
        return out[::-1]

    def gradient(self, tokens: int, parts, gold: set[tuple[str, int, int]]) -> tuple[dict, float]:
        """Observed minus expected features, and the log-likelihood of one cluster."""
        by_end = self._lattice(parts)
        by_start = defaultdict(list)
        for j, arcs in by_end.items():
            for i, kind, score, n in arcs:
                by_start[i].append((j, score))
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        alpha, beta = [0.0] * (tokens + 1), [0.0] * (tokens + 1)
        for j in range(1, tokens + 1):
            alpha[j] = alpha[j - 1]
            for i, _, score, _ in by_end[j]:
                alpha[j] = add(alpha[j], alpha[i] + score)
        for i in range(tokens - 1, -1, -1):
            beta[i] = beta[i + 1]
            for j, score in by_start[i]:
                beta[i] = add(beta[i], beta[j] + score)
        out, likelihood = defaultdict(float), -alpha[tokens]
        for j, arcs in by_end.items():
            for i, kind, score, n in arcs:
                share = -math.exp(alpha[i] + score + beta[j] - alpha[tokens])
                if (kind, parts[n][2], parts[n][3]) in gold:
                    share += 1
                    likelihood += score
                if abs(share) > 1e-6:
                    for feature in ("bias", *parts[n][4]):
                        out[kind, feature] += share
        return out, likelihood

    def fit(self, texts: list[str], passes: int = FIT_PASSES, rate: float = 0.5, decay: float = 1e-3) -> SemiMarkovCRF:
        """Stochastic gradient steps (with Adagrad) in the order given, so equal texts give equal weights."""
        data = []
        for text in texts:
            base = base_spans(text)
            for run in clusters(text):
                parts = segments(text, run)
                gold, taken = set(), 0
                for start, _, kind, end in base:
                    hit = next((p for p in parts if (p[2], p[3]) == (start, end) and p[0] >= taken), None)
                    if hit:
                        gold.add((kind, start, end))
                        taken = hit[1]
                data.append((len(run), parts, gold))
        squares: dict = defaultdict(lambda: 1e-3)
        for _ in range(passes):
            for tokens, parts, gold in data:
                for key, step in self.gradient(tokens, parts, gold)[0].items():
                    step -= decay * self.weights.get(key, 0.0)
                    squares[key] += step * step
                    self.weights[key] = self.weights.get(key, 0.0) + rate * step / math.sqrt(squares[key])
        return self


def find_spans(text: str, model: SemiMarkovCRF) -> list[tuple[int, int, str, int, bool]]:
    """(start, order of the kind, kind, end, base): the base spans, and decoded segments that overlap none of them."""
    base = base_spans(text)
    added = []
    for run in clusters(text):
        taken = [(s, e) for s, _, _, e in base if s < run[-1][1] and e > run[0][0]]
        for kind, start, end in model.decode(len(run), segments(text, run)):
            if all(end <= s or start >= e for s, e in taken):
                added.append((start, KINDS.index(kind), kind, end, False))
    return sorted([(*span, True) for span in base] + added)


def fit_model(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = FIT_DOCUMENTS) -> SemiMarkovCRF:
    """Fits the field on at most `limit` documents that hold a digit or an @: those with the least md5 of the id."""
    texts = docs.select(F.col(text_column).alias("text"), F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("_order"))
    hot = texts.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= FIT_CHARACTERS))
    rows = hot.count()
    if not rows:
        return SemiMarkovCRF()
    # A prefix of the order with about twice the wanted rows, so that few texts are held while the least are picked.
    share = min(1.0, 2.0 * limit / rows + 100.0 / rows)
    bound = format(min(int(share * (1 << 32)), (1 << 32) - 1), "08x")
    near = hot.where(F.substring("_order", 1, 8) <= bound)
    return SemiMarkovCRF().fit([row["text"] for row in near.orderBy("_order", "text").limit(limit).collect()])


def _finder(model: SemiMarkovCRF) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = ("start", "kind_order", "kind", "end", "base")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = [[dict(zip(names, s)) for s in find_spans(text, model)] for text in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "spans": spans})

    return run


def find_pii(docs: DataFrame, model: SemiMarkovCRF, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and `spans` (array of start, kind_order, kind, end, base; code points, end exclusive) of every row.

    Base spans always stay, and may overlap those of another kind. A null text counts as empty; repeated and null
    ids are kept. Other columns are ignored. Nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return rows.mapInPandas(_finder(model), f"id {kind}, spans {_SPANS}").withColumnRenamed("id", id_column)
