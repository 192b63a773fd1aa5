"""Personal data by a skip-chain conditional random field over candidate tokens.

Base matches (e-mail, IP address, card, phone) follow fixed rules; each is found by a scan that is linear in the text.
Candidates are what no rule takes: numbers written otherwise or run together, addresses cut short or spelt out ("name
(at) host dot org"). They form a chain with the base matches in the order of the text; skip edges join tokens that
repeat or resemble each other anywhere in the document. Base matches are observed. Loopy belief propagation spreads
labels over both kinds of edges, and a candidate whose marginal for a kind is sure enough becomes a span of that kind,
by its own shape or by what it resembles. Weights are trained piecewise on a bounded sample of documents: a softmax on
features of a token's shape, and log odds of agreement along both kinds of edges. Base matches are labelled, and so
are candidates that their digits rule out; the others have no label, as that no rule takes them proves nothing.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filewright.llm.common import share, small_batches, worker_state

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: Different texts, about, that train the field; they are drawn from those that hold a digit or a sign of an address.
TRAINING_DOCS = 5_000
SURE = 0.9
ROUNDS = 10

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
_AT = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+")
#: A day, with or without a time after it, is no candidate.
_DAY = re.compile(r"(?:(?:19|20)[0-9]{2}[-. ][01]?[0-9][-. ][0-3]?[0-9]|[0-3]?[0-9][-. ][0-3]?[0-9][-. ](?:19|20)[0-9]{2})(?![0-9])")
#: An address spelt out, from its "at" on: in brackets, or as a word if the dots are words as well.
_SPELT = re.compile(r" ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]+)+| at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+")
_SIGNS = ("(at)", "[at]", " dot ")
_PLAIN = ((re.compile(r" ?[\[(]at[\])] ?| at "), "@"), (re.compile(r" ?[\[(]dot[\])] ?| dot "), "."))


def _before(text: str, at: int, least: int) -> int:
    """The first of the local-part characters that end just before ``at``."""
    i = at
    while i > least and (c := text[i - 1]).isascii() and (c.isalnum() or c in "._%+-"):
        i -= 1
    return i


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _ascii_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches: by kind, then start."""
    out = []
    if not _HINT.search(text):
        return out
    end, at = 0, text.find("@")
    while at >= 0:
        start = _before(text, at, end)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((1, start, stop))
            start = stop + 1
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_ascii_digits(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def may_hold(text: str) -> bool:
    """Whether a text holds a digit or a sign of an address; others have neither base matches nor candidates."""
    return bool(_HINT.search(text)) or any(sign in text for sign in _SIGNS)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans that may be personal data though no base rule says so: numbers of 7 digits or more, addresses cut short or spelt out.

    A number of more digits than any rule takes may be several, one space apart: each part is a candidate.
    """
    if not may_hold(text):
        return []
    taken = sorted((a, b) for _, a, b in base)
    found = []
    for m in _NUMBER.finditer(text):
        if text[m.end() : m.end() + 1].isalpha() or _DAY.match(m.group()):
            continue
        n = len(_ascii_digits(m.group()))
        if 7 <= n <= 19:
            found.append((m.start(), m.end()))
        elif n > 19:
            found += [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(r"[^ ]+", m.group()) if 7 <= len(_ascii_digits(p.group())) <= 40]
    at = text.find("@")
    while at >= 0:
        start = _before(text, at, 0)
        m = _AT.match(text, start) if start < at else None
        if m:
            found.append((start, m.end()))
        at = text.find("@", max(at + 1, m.end() if m else 0))
    if any(sign in text for sign in _SIGNS):
        for m in _SPELT.finditer(text):
            if (start := _before(text, m.start(), 0)) < m.start():
                found.append((start, m.end()))
    free, i = [], 0
    for a, b in sorted(found):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if (i == len(taken) or taken[i][0] >= b) and (not free or free[-1][1] <= a):
            free.append((a, b))
    return free


def plain(token: str) -> str:
    """A token with the words and brackets of a spelt-out address as its signs."""
    if any(c.isalpha() for c in token) and "@" not in token:
        for pattern, sign in _PLAIN:
            token = pattern.sub(sign, token)
    return token


def features(token: str) -> np.ndarray:
    """The shape of a token, and whether it holds what cards, addresses and IP addresses are made of, however written."""
    token = plain(token)
    digits = _ascii_digits(token)
    n = len(digits)
    parts = token.split(".")
    ip = len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p[-9:]) <= 255 for p in parts)
    card = 13 <= n <= 19 and luhn(digits) and "@" not in token
    return np.array([
        1.0, "@" in token, "@" in token and "." in token.rpartition("@")[2], n == 0, 7 <= n <= 8, 9 <= n <= 11, n == 12, 13 <= n <= 15, n == 16, 17 <= n <= 19, n > 19,
        card, 13 <= n <= 19 and not card, ip, "." in token, "(" in token or ")" in token, "-" in token, " " in token, n == len(token),
    ], float)


def surely_other(token: str) -> bool:
    """Whether a candidate is told by its digits to be no personal data: it fails what a card or an IP address must
    meet, or is a plain number. All other candidates teach nothing: a rule that misses them is no proof."""
    token = plain(token)
    if "@" in token:
        return False
    n, parts = len(_ascii_digits(token)), token.split(".")
    if 13 <= n <= 19:
        return not luhn(_ascii_digits(token))
    quad = len(parts) == 4 and all(p.isdigit() for p in parts)
    return n > 19 or n == len(token) or quad


def keys(token: str) -> list[str]:
    """Tokens that share a key resemble each other: the same last seven digits, or the same local part."""
    token = plain(token)
    if "@" in token:
        return ["@" + token.partition("@")[0].lower()]
    digits = _ascii_digits(token)
    return ["#" + digits[-7:]] if len(digits) >= 7 else ["=" + token]


def skip_edges(tokens: list[str]) -> list[tuple[int, int]]:
    """Each token and the one before it, and the first, with the same key: a linear number of edges joins them all."""
    seen: dict[str, tuple[int, int]] = {}
    out = set()
    for i, token in enumerate(tokens):
        for k in keys(token):
            if k in seen:
                out.update({(j, i) for j in seen[k]})
                seen[k] = (seen[k][0], i)
            else:
                seen[k] = (i, i)
    return sorted(out)


class Field:
    """Weights of the conditional random field; labels are the kinds and OTHER."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def train(cls, docs: list[tuple[list[str], list[int | None]]], rounds: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> Field:
        """Piecewise: each factor on its own. ``docs``: the tokens of a document and their labels, None if not known."""
        width, labels = len(features("")), OTHER + 1
        x = np.array([features(t) for tokens, known in docs for t, k in zip(tokens, known) if k is not None]).reshape(-1, width)
        y = np.array([k for _, known in docs for k in known if k is not None], np.int64)
        unary = np.zeros((width, labels))
        for _ in range(rounds if len(y) else 0):
            z = x @ unary
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            unary -= rate * (x.T @ p / len(y) + ridge * unary)
        pairs = [np.full((labels, labels), 0.5), np.full((labels, labels), 0.5) + np.eye(labels)]
        share = (np.bincount(y, minlength=labels) + 1) / (len(y) + labels)
        for tokens, known in docs:
            for edges, table in ((zip(range(len(known) - 1), range(1, len(known))), pairs[0]), (skip_edges(tokens), pairs[1])):
                for a, b in edges:
                    if known[a] is not None and known[b] is not None:
                        table[known[a], known[b]] += 1
                        table[known[b], known[a]] += 1
        # what an edge says beyond the shares of the labels
        chain, skip = (np.log(t / t.sum()) - np.log(np.outer(share, share)) for t in pairs)
        return cls(unary, np.clip(chain, -1, 1), np.clip(skip, -6, 6))

    def marginals(self, tokens: list[str], known: list[int | None]) -> np.ndarray:
        """Each token's distribution over the labels, by loopy belief propagation; ``known`` labels are observed."""
        n, labels = len(tokens), OTHER + 1
        logs = np.array([features(t) for t in tokens]) @ self.unary
        for i, k in enumerate(known):
            if k is not None:
                logs[i] = -50.0
                logs[i, k] = 0.0
        skips = skip_edges(tokens)
        apart = set(skips)
        edges = [(i, i + 1, self.chain) for i in range(n - 1) if (i, i + 1) not in apart] + [(a, b, self.skip) for a, b in skips]
        if not edges:
            return _normal(logs)
        source = np.array([e[0] for e in edges] + [e[1] for e in edges])
        target = np.array([e[1] for e in edges] + [e[0] for e in edges])
        potential = np.array([e[2] for e in edges] + [e[2].T for e in edges])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), labels))
        for _ in range(ROUNDS):
            belief = logs.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[back]
            fresh = _logsum(out[:, :, None] + potential)
            fresh -= fresh.max(1, keepdims=True)
            messages = 0.5 * messages + 0.5 * fresh
        belief = logs.copy()
        np.add.at(belief, target, messages)
        return _normal(belief)


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(1, keepdims=True)))[:, 0]


def _normal(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def tokens_of(text: str) -> tuple[list[tuple[int, int]], list[int | None], list[tuple[int, int, int]]]:
    """The tokens of a document's field in the order of the text, their labels where a base rule gives one, the base."""
    base = base_spans(text)
    spans = sorted([(a, b, kind) for kind, a, b in base] + [(a, b, OTHER) for a, b in candidates(text, base)])
    return [(a, b) for a, b, _ in spans], [k if k != OTHER else None for _, _, k in spans], base


def added_spans(text: str, field: Field, spans, known) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the candidates that the field is sure of."""
    if all(k is not None for k in known):
        return []
    out = []
    for i, p in enumerate(field.marginals([text[a:b] for a, b in spans], known)):
        if known[i] is None and (kind := int(p.argmax())) != OTHER and p[kind] >= SURE:
            out.append((kind, *spans[i]))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _sample(docs: DataFrame, most: int) -> list[tuple[list[str], list[int]]]:
    """Tokens and labels of about ``most`` different texts that may hold any, chosen by a hash of the text; each whole."""
    signs = F.col("text").rlike(r"[0-9@]|\(at\)|\[at\]| dot ")
    hashed = docs.where(signs).select("text", F.xxhash64("text").alias("h"))
    n = max(1, hashed.agg(F.approx_count_distinct("h")).first()[0])
    some = hashed.where(F.pmod("h", F.lit(n)) < most).groupBy("h").agg(F.first("text").alias("text")).select("text")

    def run(batches):
        for batch in batches:
            tokens, labels = [], []
            for text in batch.column(0).to_pylist():
                spans, known, _ = tokens_of(text)
                if spans:
                    tokens.append([text[a:b] for a, b in spans])
                    labels.append([OTHER if k is None and surely_other(t) else k for t, k in zip(tokens[-1], known)])
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int32()))], names=["tokens", "labels"])

    table = some.mapInArrow(run, "tokens array<string>, labels array<int>").toArrow()
    return sorted(zip(table.column("tokens").to_pylist(), table.column("labels").to_pylist()), key=lambda r: r[0])


def find(docs: DataFrame, training_docs: int = TRAINING_DOCS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base, base_sha256 and spans.

    base and the counts are of the base matches; spans are those and what the field adds; all are written
    kind:start:end, by kind, then start, joined by commas, in code points with the end exclusive. A null text counts
    as empty: no spans. Repeated rows are judged each, very long texts whole and in linear time; an empty table gives an
    empty one, and without any base match in the sample the field adds what it has been told nothing against: nothing.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared, name = share(spark, Field.train(_sample(rows, training_docs))), uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string()), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        field = worker_state(name, lambda: shared.value)
        for batch in batches:
            counts, bases, spans = [], [], []
            for text in batch.column(1).to_pylist():
                if not may_hold(text):
                    counts.append((0, 0, 0, 0))
                    bases.append("")
                    spans.append("")
                    continue
                where, known, base = tokens_of(text)
                counts.append(tuple(sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))))
                bases.append(_written(base))
                spans.append(_written(base + added_spans(text, field, where, known)))
            digests = [hashlib.sha256(b.encode()).hexdigest() for b in bases]
            columns = list(zip(*counts)) if counts else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(bases, pa.string()), pa.array(digests, pa.string()), pa.array(spans, pa.string())], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, spans string")
