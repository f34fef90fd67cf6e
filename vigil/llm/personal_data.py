"""Personal data by fixed patterns and a skip-chain conditional random field."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import text_of, written

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")
CLUE = re.compile(r"[0-9@]")
EDGES = "\"'`.,;:!?()[]{}<>|*#&%$=_/"
# Words that announce a kind.
CUES = {
    "email": frozenset("email e-mail mail mailto contact correo courriel write".split()),
    "ip": frozenset("ip host server address addr ipv4 from client".split()),
    "card": frozenset("card visa mastercard amex credit debit kreditkarte carte tarjeta payment paid".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon tel. teléfono sms whatsapp".split()),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start; each in one pass over the text.

    An address is read from its "@" on: what stands before it back to a
    character no local part has, or to the end of the address before.
    """
    spans = []
    at, before = text.find("@"), 0
    while at >= 0:
        start = at
        while start > before and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            spans.append((0, start, found.end()))
            before = found.end()
        else:
            before = max(before, at + 1)
        at = text.find("@", before)
    for found in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in found[0].split(".")):
            spans.append((1, found.start(), found.end()))
    for found in CARD.finditer(text):
        if 16 <= len(found[0]) <= 40 and 16 <= len(digits := NOT_DIGITS.sub("", found[0])) <= 19 and luhn(digits):
            spans.append((2, found.start(), found.end()))
    at = text.find("+")
    while at >= 0:
        found = PHONE.match(text, at)
        if found and 8 <= len(NOT_DIGITS.sub("", found[0])) <= 15:
            spans.append((3, found.start(), found.end()))
        at = text.find("+", found.end() if found else at + 1)
    return spans


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, word before) of the tokens with a digit or an at sign, punctuation around them left out."""
    out = []
    found = CLUE.search(text)
    while found:
        start = end = found.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        token = text[start:end]
        left = len(token) - len(token.lstrip(EDGES))
        right = len(token.rstrip(EDGES))
        head = text[max(0, start - 40) : start].split()
        out.append((start + left, start + max(right, left), head[-1].lower().strip(EDGES) if head else ""))
        found = CLUE.search(text, end)
    return out


N_FEATURES = 22


def features(token: str, before: str) -> np.ndarray:
    digits = NOT_DIGITS.sub("", token)
    n = len(digits)
    parts = token.split(".")
    dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    name, _, domain = token.partition("@")
    return np.array(
        [
            1,
            "@" in token,
            bool(name) and "." in domain.strip("."),
            dotted,
            dotted and all(len(p) < 4 and int(p) < 256 for p in parts),
            n == 0,
            1 <= n < 7,
            7 <= n < 10,
            10 <= n < 13,
            13 <= n < 16,
            16 <= n < 20,
            n >= 20,
            16 <= n < 20 and luhn(digits),
            token.startswith("+"),
            token.startswith(("+", "(", "00")) and 8 <= n < 16,
            any(c.isalpha() for c in token),
            n == len(token),
            "-" in token,
            *(before in CUES[kind] for kind in KINDS),
        ],
        float,
    )


def similar_key(token: str) -> str | None:
    """Tokens with equal keys are the same or similar: the last nine digits, or the text in lower case."""
    digits = NOT_DIGITS.sub("", token)
    if len(digits) >= 7:
        return digits[-9:]
    return token.lower() if len(token) >= 6 else None


@dataclass
class SkipChainModel:
    """Log potentials: features x labels, neighbours, similar tokens (labels x labels)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    rounds: int = 12
    damping: float = 0.5

    def marginals(self, x: np.ndarray, observed: np.ndarray, edges: list[tuple[int, int, bool]]) -> np.ndarray:
        """Label probabilities of each token by loopy message passing; observed: a label, or -1."""
        node = x @ self.unary
        known = observed >= 0
        node[known] = -30.0
        node[known, observed[known]] = 0.0
        if edges:
            a, b = (np.array([e[k] for e in edges]) for k in (0, 1))
            potential = np.exp(np.where(np.array([e[2] for e in edges])[:, None, None], self.skip, self.chain))
            source, target = np.concatenate((a, b)), np.concatenate((b, a))
            potential = np.concatenate((potential, potential.transpose(0, 2, 1)))
            back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
            message = np.zeros((len(source), NONE + 1))
            for _ in range(self.rounds):
                belief = node.copy()
                np.add.at(belief, target, message)
                out = belief[source] - message[back]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                new = np.log(np.maximum(np.einsum("ei,eij->ej", out, potential), 1e-30))
                new -= new.max(axis=1, keepdims=True)
                change = np.abs(new - message).max()
                message = self.damping * message + (1 - self.damping) * new
                if change < 1e-4:
                    break
            np.add.at(node, target, message)
        p = np.exp(node - node.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def graph(text: str, tokens: list[tuple[int, int, str]]) -> list[tuple[int, int, bool]]:
    """Edges between tokens next to each other, and skip edges from each token to the next similar one."""
    edges = [
        (i, i + 1, False) for i in range(len(tokens) - 1) if tokens[i + 1][0] - tokens[i][1] < 4
    ]
    last: dict[str, int] = {}
    for i, (start, end, _) in enumerate(tokens):
        key = similar_key(text[start:end])
        if key is not None:
            if key in last:
                edges.append((last[key], i, True))
            last[key] = i
    return edges


def observed_labels(tokens: list[tuple[int, int, str]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The kind of the first pattern span that overlaps each token, else -1."""
    out = np.full(len(tokens), -1)
    by_start = sorted(spans, key=lambda s: s[1])
    k = 0
    for i, (start, end, _) in enumerate(tokens):
        while k < len(by_start) and by_start[k][2] <= start:
            k += 1
        for kind, a, b in by_start[k : k + 4]:
            if a < end and start < b:
                out[i] = kind
                break
    return out


def fit_skip_chain(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pairs: np.ndarray, steps: int = 600) -> SkipChainModel:
    """Piecewise training: features by multinomial regression, edges by the log odds of their label pairs.

    x, y, weight: distinct feature rows, their labels and how often they occur;
    pairs[s] counts label pairs of chain (0) and skip (1) edges.
    """
    unary = np.zeros((N_FEATURES, NONE + 1))
    share = weight / max(weight.sum(), 1)
    for _ in range(steps):
        z = x @ unary
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        unary -= 0.5 * (x.T @ (p * share[:, None]) + 1e-4 * unary)
    potentials = []
    for counts in pairs:
        joint = (counts + counts.T) / 2 + 0.5
        joint /= joint.sum()
        potentials.append(np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0))))
    return SkipChainModel(unary, potentials[0], potentials[1])


def train_skip_chain(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 3000) -> SkipChainModel:
    """A model from at most `sample_rows` documents, by hash of the id, labelled by the fixed patterns.

    The tokens' distinct feature rows with their labels and the label pairs at
    edges are counted by Spark; only those counts (a few hundred rows: features
    are yes or no) reach the driver. Without tokens the model labels nothing.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64(F.lit(4), "doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text")  # at most sample_rows ids

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                tokens = candidates(text)
                labels = observed_labels(tokens, pattern_spans(text))
                labels[labels < 0] = NONE
                for (start, end, before), label in zip(tokens, labels):
                    out.append(("".join(str(int(v)) for v in features(text[start:end], before)), int(label), -1))
                for i, j, skip in graph(text, tokens):
                    out.append(("skip" if skip else "chain", int(labels[i]), int(labels[j])))
            yield pd.DataFrame(out, columns=["what", "a", "b"])

    counted = written(sample.mapInPandas(count, "what string, a int, b int").groupBy("what", "a", "b").count(), "counts")
    rows = sorted(counted.collect())
    own = [r for r in rows if r["b"] < 0]
    pairs = np.zeros((2, NONE + 1, NONE + 1))
    for r in rows:
        if r["b"] >= 0:
            pairs[int(r["what"] == "skip"), r["a"], r["b"]] += r["count"]
    x = np.array([[float(c) for c in r["what"]] for r in own]).reshape(len(own), N_FEATURES)
    return fit_skip_chain(x, np.array([r["a"] for r in own], int), np.array([r["count"] for r in own], float), pairs)


def whole(kind: int, text: str) -> bool:
    """Whether the text has as much as an entity of the kind needs; shorter tokens are parts of one at most."""
    digits = len(NOT_DIGITS.sub("", text))
    if kind == 0:
        return "@" in text.strip("@")
    if kind == 1:
        return text.count(".") == 3 and digits >= 4
    return 16 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


def added_spans(text: str, base: list[tuple[int, int, int]], model: SkipChainModel, least: float = 0.5) -> list[tuple[int, int, int]]:
    """Spans outside the base spans that the field labels with a kind.

    Neighbours of one kind that are no whole entity each are joined; what is
    none then either is left out.
    """
    tokens = candidates(text)
    if not tokens:
        return []
    observed = observed_labels(tokens, base)
    if (observed >= 0).all():
        return []
    x = np.array([features(text[start:end], before) for start, end, before in tokens])
    p = model.marginals(x, observed, graph(text, tokens))
    spans: list[tuple[int, int, int]] = []
    for i, (start, end, _) in enumerate(tokens):
        kind = int(p[i].argmax())
        if observed[i] >= 0 or kind == NONE or p[i, kind] < least or end <= start:
            continue
        if spans and spans[-1][0] == kind and spans[-1][2] == tokens[i - 1][1] and text[spans[-1][2] : start] == " ":
            if not whole(kind, text[spans[-1][1] : spans[-1][2]]):
                spans[-1] = (kind, spans[-1][1], end)
                continue
        spans.append((kind, start, end))
    return [(kind, start, end) for kind, start, end in spans if whole(kind, text[start:end])]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(set(spans)))


def find_personal_data(
    docs: DataFrame, model: SkipChainModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the fixed patterns' spans, spans holds the
    field's too, as kind:start:end in code points. Null and empty texts have
    none (the digest is that of the empty text); repeated rows are read each; a
    null id stays null; other columns are not read. No shuffle.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base = pattern_spans(text)
                n = [sum(kind == k for kind, *_ in base) for k in range(NONE)]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                out.append((*n, digest, _joined(base + added_spans(text, base, model))))
            columns = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            frame = pd.DataFrame(out, columns=columns, index=batch.index)
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield frame

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return texts.mapInPandas(
        find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
