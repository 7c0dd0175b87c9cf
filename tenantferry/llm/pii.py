"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

A word is a run of bytes other than ASCII white space. Its shape maps capital letters, other letters and
digits to one byte each; features are functions of the shape, so that a shape's scores are computed
once. The field is trained by gradient ascent on a small labelled table of words (forward-backward in log space,
all sentences at once). Most words are sure to be outside: where the score of ``O`` leads by more than any
two transitions can make up, every best path has ``O`` there. The chain is cut at such words, which changes
no path, and Viterbi runs in numpy over the remaining short runs of a batch together.

A run of words with one label makes a span, trimmed of marks at its ends and tested for the number of its digits;
spans that touch a pattern's span are left out, so those of the patterns stay. Null texts count as empty ones.
Offsets are code points, ends are exclusive. Texts are taken whole; all steps are linear in their length.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.llm.common import utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
FIELDS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

# -- patterns -------------------------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failed start inside a run of digits fails for the rest of the run too, so only its first digit is tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = str.maketrans("", "", " -().+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# -- the field ------------------------------------------------------------------------------------------

_TABLE = bytes(
    b"A"[0] if 65 <= c <= 90 else b"a"[0] if 97 <= c <= 122 or c >= 128 else b"0"[0] if 48 <= c <= 57 else c for c in range(256))
_MARKS = b"#$%&*<>|!?,;:\"'[]{}.~^=_"


def shapes(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def features(shape: bytes) -> list[str]:
    """The named features of a word's shape."""
    core = shape.strip(_MARKS)
    digits = core.count(b"0")
    groups = [len(x) for x in re.findall(rb"0+", core)]
    rough = re.sub(rb"(.)\1+", rb"\1", core)[:12].decode("latin-1")
    return [
        "bias", f"rough={rough}", f"digits={min(digits, 20)}", f"groups={min(len(groups), 6)}",
        f"longest={min(max(groups, default=0), 20)}", f"first={core[:1].decode('latin-1')}", f"at={core.count(b'@') == 1}",
        f"dots={min(core.count(b'.'), 4)}", f"dashes={min(core.count(b'-'), 4)}", f"plus={core[:1] == b'+'}",
        f"opens={core[:1] == b'('}", f"letters={b'a' in core.lower()}", f"only_digits={digits == len(core) > 0}",
        f"form={'.'.join(map(str, groups[:5]))}" if groups else "no_digit",
        "mailish" if re.fullmatch(rb"[A-Za0.%+-]+@[A-Za0-]+(?:\.[A-Za0-]+)+", core) else "not_mailish",
    ]


@dataclass
class Field:
    index: dict[str, int]
    weights: np.ndarray  # feature x label
    move: np.ndarray  # label x label
    start: np.ndarray
    stop: np.ndarray
    lead: float = 0.0  # how far O must lead to hold in every best path

    def scores(self, shape: bytes) -> np.ndarray:
        known = [self.index[f] for f in features(shape) if f in self.index]
        return self.weights[known].sum(axis=0)


def _lead(field: Field) -> float:
    """The most that other labels can gain in the two moves around a word, against O there."""
    before = np.vstack([field.move, field.start])
    after = np.hstack([field.move, field.stop[:, None]])
    gain = (before - before[:, :1])[:, None, :] + (after - after[:1]).T[None, :, :]
    return float(gain[:, :, 1:].max()) + 1e-9


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(rows: list[tuple[int, int, str, str]], steps: int = 60, rate: float = 0.15, l2: float = 2e-3) -> Field:
    """Fit on (sentence, position, word, label) rows. Labels not in ``LABELS`` count as O; without rows all is O."""
    sentences: dict[int, list[tuple[int, str, str]]] = {}
    for s, p, word, label in rows:
        if word is not None and word.strip():
            sentences.setdefault(s, []).append((p, word, label))
    data = [[(shapes(w.encode())[0], LABELS.index(y) if y in LABELS else 0) for _, w, y in sorted(x)] for x in sentences.values()]
    k = len(LABELS)
    index: dict[str, int] = {}
    for x in data:
        for shape, _ in x:
            for f in features(shape):
                index.setdefault(f, len(index))
    field = Field(index, np.zeros((len(index), k)), np.zeros((k, k)), np.zeros(k), np.zeros(k))
    if not data:
        field.index, field.weights = {"bias": 0}, np.array([[20.0] + [0.0] * (k - 1)])
        field.lead = _lead(field)
        return field
    data.sort(key=len, reverse=True)
    n, longest = len(data), len(data[0])
    lens = np.array([len(x) for x in data])
    width = len(features(data[0][0][0]))
    at = np.full((n, longest, width), len(index))
    gold = np.zeros((n, longest), int)
    for i, x in enumerate(data):
        for t, (shape, y) in enumerate(x):
            at[i, t] = [index[f] for f in features(shape)]
            gold[i, t] = y
    real = np.arange(longest) < lens[:, None]
    hot = np.eye(k)[gold] * real[:, :, None]
    pairs = np.einsum("ita,itb->ab", hot[:, :-1], hot[:, 1:])
    last = hot[np.arange(n), lens - 1].sum(axis=0)
    params = [field.weights, field.move, field.start, field.stop]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    for step in range(1, steps + 1):
        w = np.vstack([field.weights, np.zeros(k)])
        e = w[at].sum(axis=2)
        ahead, back = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        ahead[:, 0] = field.start + e[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + field.move[None], 1) + e[:, t]
        back[np.arange(n), lens - 1] = field.stop
        for t in range(longest - 2, -1, -1):
            inner = _logsum(field.move[None] + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where((t < lens - 1)[:, None], inner, back[:, t])
        total = _logsum(ahead[np.arange(n), lens - 1] + field.stop, 1)
        prob = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
        grads = [np.zeros((len(index) + 1, k)), None, None, None]
        np.add.at(grads[0], at, np.repeat((hot - prob)[:, :, None, :], width, axis=2))
        grads[0] = grads[0][:-1]
        joint = np.zeros((k, k))
        for t in range(1, longest):
            on = lens > t
            x = ahead[on, t - 1, :, None] + field.move[None] + (e[on, t] + back[on, t])[:, None, :] - total[on, None, None]
            joint += np.exp(x).sum(axis=0)
        grads[1] = pairs - joint
        grads[2] = hot[:, 0].sum(axis=0) - prob[:, 0].sum(axis=0)
        grads[3] = last - prob[np.arange(n), lens - 1].sum(axis=0)
        for p, g, (m, v) in zip(params, grads, moments):
            g = g / n - l2 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    field.lead = _lead(field)
    return field


def viterbi(field: Field, runs: list[np.ndarray], before: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """Best labels of each run of word scores. before, after: what a first and last label add, for each run."""
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    lens = np.array([len(runs[i]) for i in order])
    best = before[order] + np.array([runs[i][0] for i in order])
    backs = []
    for t in range(1, lens[0]):
        on = int(np.searchsorted(-lens, -t, side="left"))  # runs longer than t
        x = best[:on, :, None] + field.move[None]
        backs.append(x.argmax(axis=1).astype(np.int8))
        best[:on] = x.max(axis=1) + np.array([runs[i][t] for i in order[:on]])
    label = (best + after[order]).argmax(axis=1)
    out: list[np.ndarray] = [np.empty(0)] * len(runs)
    paths = np.zeros((len(order), lens[0]), np.int8)
    paths[np.arange(len(order)), lens - 1] = label
    for t in range(lens[0] - 1, 0, -1):
        on = int(np.searchsorted(-lens, -t, side="left"))
        paths[:on, t - 1] = backs[t - 1][np.arange(on), paths[:on, t]]
    for j, i in enumerate(order):
        out[i] = paths[j, :lens[j]].astype(int)
    return out


class Tagger:
    """Decodes texts in batches, with the scores of the shapes seen so far."""

    MOST_SHAPES = 200_000

    def __init__(self, field: Field) -> None:
        self.field = field
        self.known: dict[bytes, int] = {}
        self.table: list[np.ndarray] = []
        self.open: list[bool] = []

    def _number(self, shape: bytes) -> int:
        scores = self.field.scores(shape)
        self.table.append(scores)
        self.open.append(bool(scores[0] - scores[1:].max() <= self.field.lead))
        self.known[shape] = len(self.table) - 1
        return len(self.table) - 1

    def label(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text: (first word, end word, label) of the runs of words with one label other than O."""
        if len(self.table) > self.MOST_SHAPES:
            self.known, self.table, self.open = {}, [], []
        f, runs, place, before, after = self.field, [], [], [], []
        for n, text in enumerate(texts):
            words = shapes(text)
            known = self.known
            ids = [known[w] if w in known else self._number(w) for w in words]
            free = np.flatnonzero(np.array(self.open, bool)[ids]) if ids else np.empty(0, int)
            if not len(free):
                continue
            for part in np.split(free, np.flatnonzero(np.diff(free) > 1) + 1):
                a, b = int(part[0]), int(part[-1]) + 1
                runs.append(np.array([self.table[i] for i in ids[a:b]]))
                place.append((n, a))
                before.append(f.start if a == 0 else f.move[0])
                after.append(f.stop if b == len(ids) else f.move[:, 0])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if runs:
            for (n, a), path in zip(place, viterbi(f, runs, np.array(before), np.array(after))):
                edges = np.flatnonzero(np.diff(path)) + 1
                for x, y in zip([0, *edges], [*edges, len(path)]):
                    if path[x]:
                        out[n].append((a + int(x), a + int(y), int(path[x])))
        return out


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK_CHARS = _MARKS.decode() + "-"
#: Digits that a span of the field must hold, besides the exact checks of ``_holds``.
_DIGITS = {"ip": (4, 12), "card": (13, 19), "phone": (9, 15), "email": (0, 1 << 30)}


def _holds(kind: str, span: str) -> bool:
    digits = [c for c in span if c in "0123456789"]
    least, most = _DIGITS[kind]
    if not least <= len(digits) <= most:
        return False
    if kind == "card":
        return luhn("".join(digits))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return kind != "email" or "@" in span.strip("@")


def field_spans(text: str, found: list[tuple[int, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The field's runs of words as spans named crf_<kind>, without those that touch a pattern's span."""
    if not found:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    out = []
    for a, b, label in found:
        kind = LABELS[label]
        start, end = words[a][0], words[b - 1][1]
        inner = text[start:end]
        start += len(inner) - len(inner.lstrip(_MARK_CHARS))
        end -= len(inner) - len(inner.rstrip(_MARK_CHARS))
        if start < end and _holds(kind, text[start:end]) and not any(s < end and start < e for _, s, e in taken):
            out.append((f"crf_{kind}", start, end))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(tagger: Tagger, texts: list[bytes]) -> pd.DataFrame:
    rows = []
    for raw, found in zip(texts, tagger.label(texts)):
        text = raw.decode("utf-8", "replace")
        base = base_spans(text)
        added = field_spans(text, found, base)
        count = [sum(k == kind for k, _, _ in base) for kind in KINDS]
        rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
    return pd.DataFrame(rows, columns=[x.split()[0] for x in FIELDS.split(", ")])


def found(field: Field, text: Column) -> Column:
    """A struct of ``FIELDS`` for a text column."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field)
        for texts in batches:
            yield find(tagger, list(texts))

    return F.pandas_udf(run, FIELDS)(utf8(text))


MAX_LABELLED_WORDS = 100_000


def train_on(labelled: DataFrame, most: int = MAX_LABELLED_WORDS) -> Field:
    """Train on a small table (sentence, position, word, label); more than ``most`` rows are refused."""
    rows = labelled.select("sentence", "position", "word", "label").orderBy("sentence", "position").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the labelled table has more than {most} words")
    return train([tuple(r) for r in rows])


def documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``FIELDS``. Other columns are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), found(field, F.col(text_col)).alias("f")).select("doc_id", "f.*")


# -- a small labelled table -------------------------------------------------------------------------------


def sample_rows(n: int = 600, seed: int = 7) -> list[tuple[int, int, str, str]]:
    """Sentences with labelled words, made by rule: filler, numbers that are no personal data, and personal data."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    letters = lambda a, b: "".join(r.choice("abcdefghijklmnopqrstuvwxyzéñäß") for _ in range(r.randint(a, b)))
    latin = lambda a, b: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, b)))

    def filler() -> list[tuple[str, str]]:
        word = letters(1, 12)
        other = [
            f"{digits(r.randint(1, 8))}", f"{r.randint(1900, 2030)}-{digits(2)}-{digits(2)}", f"{digits(1)}.{digits(2)}", f"{digits(3)}.{digits(3)}",
            f"${digits(2)}.{digits(2)}", f"{digits(2)}:{digits(2)}", f"({digits(1)})", f"({digits(4)})", f"v{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(2)}/{digits(2)}/{digits(4)}",
            "|", f"@{latin(3, 8)}", f"{latin(3, 6)}@", f"#{digits(3)}", f"{latin(2, 4)}{digits(4)}", f"{digits(3)}%", f"+{digits(1)}", "-", "=",
            f"\"{''.join(r.choice('0123456789abcdef') for _ in range(40))}\"", f"{latin(3, 8)}.{latin(2, 3)}", f"{digits(30)}", f"{digits(22)}",
            f"{word[:3]}-{word[3:] or 'a'}", f"{digits(4)}-{digits(4)}", f"{digits(1)}.{digits(1)}.{digits(1)}", word.upper(),
        ]
        x = r.choice(other) if r.random() < 0.3 else word.capitalize() if r.random() < 0.2 else word
        return [(x, "O")]

    def personal() -> list[tuple[str, str]]:
        kind = r.choice(KINDS)
        if kind == "email":
            text = r.choice([f"{latin(2, 8)}.{digits(2)}@{latin(3, 8)}{digits(1)}.{latin(3, 8)}.{latin(2, 3)}", f"{latin(2, 8)}@{latin(3, 8)}.{latin(2, 3)}", f"{latin(1, 6)}_{latin(1, 6)}@{latin(3, 8)}.{latin(2, 3)}"])
        elif kind == "ip":
            text = ".".join(str(r.randint(0, 255)) for _ in range(4))
        elif kind == "card":
            sep = r.choice(["", "", " ", "-"])
            text = sep.join(digits(4) for _ in range(4))
        else:
            a, b, c = digits(3), digits(3), digits(4)
            text = r.choice([
                f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"+{digits(1)} {a} {b} {c}", f"+{digits(2)} {a} {c}{digits(3)}",
                f"+{digits(2)}-{a}-{b}-{c}", f"+{digits(1)} ({a}) {b}-{c}", f"+{digits(12)}", f"{a}.{b}.{c}", f"+{digits(2)} ({a}) {b} {c}",
            ])
        return [(x, kind) for x in text.split()]

    rows = []
    for s in range(n):
        words = []
        for _ in range(r.randint(3, 9)):
            part = personal() if r.random() < 0.18 else filler()
            if r.random() < 0.2:
                part[-1] = (part[-1][0] + r.choice([",", ".", "###", "%%%", "***", "$$$", "&&&", ";", "!!"]), part[-1][1])
            if words and words[-1][1] == part[0][1] != "O":
                words.append((letters(2, 8), "O"))
            words += part
        rows += [(s, p, w, y) for p, (w, y) in enumerate(words)]
    return rows


def sample_table(spark: SparkSession, n: int = 600, seed: int = 7) -> DataFrame:
    return spark.createDataFrame(sample_rows(n, seed), "sentence long, position long, word string, label string")
