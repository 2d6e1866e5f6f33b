"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features.

The patterns find e-mail addresses, IPv4 addresses, payment cards (Luhn) and international phone numbers. The field
adds what has no fixed form: secrets (keys, tokens, passwords), national phone numbers and identity numbers. It is
trained on the small labelled table below and decoded by Viterbi over all tokens of every text. Tokens whose own score
outweighs whatever their neighbours' labels could add are "O" in every best sequence, and what lies between two of
them is decoded by itself: the same labels as over the whole text, in numpy batches. A span of the field that
the patterns' spans cover is dropped; one that reaches beyond them stays beside them, and redaction takes the union.

Every pattern is written so that a failed start isn't tried again within the same run of characters: linear time
in the text, whatever it holds. Rows aren't shuffled.

Defined cases: a null text counts as empty and has no spans; positions are code points, ends exclusive; repeated
rows get a row each; an empty table gives an empty result; columns other than the id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
#: What the field may add; a phone of the field joins the pattern's kind.
LABELS = ("O", "secret", "phone", "id")
KINDS = (*BASE_KINDS, "secret", "id")

Span = tuple[str, int, int]

# ---- patterns -------------------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", found.end() if found else at + 1)


def patterns(text: str) -> list[Span]:
    """The base spans, by kind and then start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---- tokens and features --------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W_]++(?:[._%+@/-]++[^\W_]++)*|[^\w\s]|_")
FEATURE_BITS = 12
#: Tokens decoded at once, and tokens whose scores are kept.
GROUP_TOKENS, KEPT_TOKENS = 100_000, 200_000


@lru_cache(maxsize=20_000)
def _shape(token: str) -> tuple[str, ...]:
    """Word-shape features of one token, by itself."""
    runs = re.sub(r"[^\W\d_a-z]+", "X", re.sub(r"[a-zß-öø-ÿ]+", "x", re.sub(r"[0-9]+", "9", token)))
    digits = sum(c.isdigit() for c in token)
    n = len(token)
    hexed = n >= 8 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", token) is not None
    mixed = 0 < digits < n
    kind = "hex" if hexed and mixed else "mixed" if mixed and token.isalnum() else "number" if digits == n else "word" if token.isalpha() else "other"
    sized = "1 2 3 4 5-7 8-11 12-15 16-19 20-31 32+".split()[bisect_left((1, 2, 3, 4, 7, 11, 15, 19, 31), n)]
    turns = len(re.findall(r"[A-Za-z]+|[0-9]+", token))
    out = [f"kind {kind}", f"{kind} {sized}", f"shape {runs[:12]}", f"digits {min(digits, 12)} {kind}", f"turns {min(turns, 8)}"]
    if mixed and token.isalnum() and token == token.upper():
        out.append(f"capital letters and digits {sized}")
    if token.isalpha() and token.lower() in CUES:
        out.append(f"cue {CUES[token.lower()]}")
    if n == 1 and not token.isalnum():
        out.append(f"mark {token}")
    if re.fullmatch(r"[0-9]{3}-[0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}", token):
        out.append("national")
    if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", token):
        out.append("identity")
    return tuple(out)


#: Words that announce personal data, by what they announce.
CUES = {
    **dict.fromkeys("token secret key apikey api auth credential".split(), "secret"),
    **dict.fromkeys("password passwd pwd".split(), "password"),
    "bearer": "bearer",
    **dict.fromkeys("phone tel telephone call mobile fax telefon teléfono téléphone".split(), "phone"),
    **dict.fromkeys("ssn social identity passport national".split(), "id"),
    **dict.fromkeys("version license page chapter figure table year section release".split(), "count"),
}


def _like(token: str) -> str:
    """A token of the same features; one for all plain words of a length and case."""
    if token.isascii() and token.isalpha() and token.lower() not in CUES:
        n = min(len(token), 32)
        if token.islower():
            return "q" * n
        if token.isupper():
            return "Q" * n
        if token[0].isupper() and token[1:].islower():
            return "Q" + "q" * (n - 1)
    return token


@lru_cache(maxsize=40_000)
def _ids(prefix: str, token: str) -> tuple[int, ...]:
    return tuple(zlib.crc32(f"{prefix} {f}".encode()) & ((1 << FEATURE_BITS) - 1) for f in _shape(token))


#: Features a token has at most: its own, and its two neighbours' on either side.
WIDTH = 45
_NONE = 1 << FEATURE_BITS


def featurise(tokens: list[str]) -> np.ndarray:
    """(tokens, WIDTH) feature numbers, filled up with _NONE."""
    out = np.full((len(tokens), WIDTH), _NONE, np.int32)
    for i, t in enumerate(tokens):
        ids = list(_ids("0", t if len(t) <= 200 else t[:100] + t[-100:]))
        for k in (-1, 1, -2, 2):
            j = i + k
            ids += _ids(str(k), tokens[j][:200]) if 0 <= j < len(tokens) else _ids(str(k), "\n")
        out[i, : min(WIDTH, len(ids))] = ids[:WIDTH]
    return out


# ---- the field ------------------------------------------------------------------------------------------------


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = max(map(len, rows))
    x, on = np.full((len(rows), size, WIDTH), _NONE, np.int32), np.zeros((len(rows), size), bool)
    for i, r in enumerate(rows):
        x[i, : len(r)], on[i, : len(r)] = r, True
    return x, on


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights of features by label and of label pairs."""

    def __init__(self, steps: int = 120, l2: float = 0.02):
        rows, labels = zip(*labelled_table(), strict=True)
        x, on = _pad([featurise(t) for t in rows])
        k = len(LABELS)
        y = np.zeros(on.shape, np.int64)
        for i, names in enumerate(labels):
            y[i, : len(names)] = [LABELS.index(n) for n in names]
        size = (1 << FEATURE_BITS) + 1
        self.w, self.t = np.zeros((size, k)), np.zeros((k, k))
        m, v = np.zeros(self.w.size + k * k), np.zeros(self.w.size + k * k)
        for step in range(1, steps + 1):
            p, pairs = self._expect(x, on)
            p[on, y[on]] -= 1
            gw = np.stack([np.bincount(x[on].ravel(), np.repeat(p[on][:, c], WIDTH), minlength=size) for c in range(k)], 1)
            gw[_NONE] = 0
            both = on[:, 1:] & on[:, :-1]
            np.subtract.at(pairs, (y[:, :-1][both], y[:, 1:][both]), 1)
            g = np.concatenate([(gw / len(rows) + l2 / len(rows) * self.w).ravel(), (pairs / len(rows)).ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            d = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.w -= d[: self.w.size].reshape(self.w.shape)
            self.t -= d[self.w.size :].reshape(k, k)

    def _expect(self, x: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of each token and expected counts of label pairs, by forward and backward sums."""
        e = self.w[x].sum(2) * on[..., None]
        n, size, k = e.shape
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for i in range(1, size):
            a[:, i] = np.where(on[:, i, None], _log_sum(a[:, i - 1, :, None] + self.t, 1) + e[:, i], a[:, i - 1])
        for i in range(size - 2, -1, -1):
            b[:, i] = np.where(on[:, i + 1, None], _log_sum(self.t + (e[:, i + 1] + b[:, i + 1])[:, None, :], 2), b[:, i + 1])
        z = _log_sum(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * on[..., None]
        pairs = np.zeros((k, k))
        for i in range(1, size):
            q = a[:, i - 1, :, None] + self.t + (e[:, i] + b[:, i])[:, None, :] - z[:, None, None]
            pairs += (np.exp(q) * on[:, i, None, None]).sum(0)
        return p, pairs

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence, given its tokens' features."""
        return self.best([self.w[r].sum(1) for r in rows])

    def best(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence, given its tokens' scores: Viterbi, over batches of sequences of like
        length."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
        order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: len(rows[i]))
        while order:
            size = len(rows[order[-1]])
            n = max(1, min(len(order), 20_000 // size))
            group, order = order[-n:], order[:-n]
            e, on = np.zeros((n, size, len(LABELS))), np.zeros((n, size), bool)
            for g, i in enumerate(group):
                e[g, : len(rows[i])], on[g, : len(rows[i])] = rows[i], True
            best, back = e[:, 0], np.zeros((len(group), size, len(LABELS)), np.int8)
            for i in range(1, size):
                s = best[:, :, None] + self.t
                back[:, i] = np.where(on[:, i, None], s.argmax(1), np.arange(len(LABELS)))
                best = np.where(on[:, i, None], s.max(1) + e[:, i], best)
            y = np.zeros((len(group), size), np.int64)
            y[:, -1] = best.argmax(1)
            for i in range(size - 1, 0, -1):
                y[:, i - 1] = back[np.arange(len(group)), i, y[:, i]]
            for g, i in enumerate(group):
                out[i] = y[g, : len(rows[i])]
        return out

    def scores(self, tokens: list[str]) -> np.ndarray:
        """(tokens, labels): what each token's features add to each label; sequences are set apart by two line feeds."""
        known = self.__dict__.setdefault("known", {})
        if len(known) > KEPT_TOKENS:
            known.clear()
        if not known:
            self.kinds, self.parts = {}, np.zeros((0, 5, len(LABELS)))
        added = []
        for t in set(tokens).difference(known):
            like = _like(t)
            key = (_shape(like if len(like) <= 200 else like[:100] + like[-100:]), _shape(like[:200]))
            if key not in self.kinds:
                self.kinds[key] = len(self.kinds)
                names = [(str(k), key[k != 0]) for k in (-2, -1, 0, 1, 2)]
                added.append([self.w[[zlib.crc32(f"{p} {f}".encode()) & ((1 << FEATURE_BITS) - 1) for f in shape]].sum(0) for p, shape in names])
            known[t] = self.kinds[key]
        if added:
            self.parts = np.concatenate([self.parts, np.array(added)])
        at = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        e = self.parts[at, 2]
        for k in (-2, -1, 1, 2):
            e[max(0, -k) : len(at) - max(0, k)] += self.parts[at[max(0, k) : len(at) + min(0, k)], k + 2]
        return e

    def labels(self, tokens: list[str], edge: np.ndarray) -> np.ndarray:
        """The best labels of sequences set apart by line feeds, which ``edge`` marks."""
        e = self.scores(tokens)
        # What another label than "O" can gain at most from the labels before and after it, or from having none there.
        gain = np.maximum(0, (self.t - self.t[:, :1]).max(0)) + np.maximum(0, (self.t - self.t[:1]).max(1))
        sure = (e[:, :1] - e[:, 1:] > gain[1:] + 1e-6).all(1) & ~edge
        y = np.zeros(len(tokens), np.int64)
        open_ = np.flatnonzero(np.diff(np.concatenate([[0], (~sure & ~edge).view(np.int8), [0]])))
        spans = [(a - 1 if a and sure[a - 1] else a, b + 1 if b < len(tokens) and sure[b] else b) for a, b in open_.reshape(-1, 2).tolist()]
        for (a, b), found in zip(spans, self.best([e[a:b] for a, b in spans]), strict=True):
            y[a:b] = np.where(sure[a:b], 0, found)
        return y


#: The labelled table: prose is "w" for any word; personal data stand in braces, as {label what}.
TABLE = """
w w. W w token = "{secret hex40}" w w, w.
w w secret = "{secret hex32}" w w.
w key: {secret hex32} w w w
W w password={secret hex18} w w w.
w password: {secret mixed12} w w.
w pwd={secret mixed10} w w
w api key {secret mixed24} w, w w
w w {secret upper20} w w w.
W. {secret upper20} W w w.
w w, {secret upper20} w w
w w {secret caps20} w w w.
w, W w {secret caps20} w.
w {secret caps20} w
W {secret upper20} w
{secret caps20} w
{secret upper20}
w {secret upper20}.
password={secret hex18} w
w token="{secret hex40}"
w bearer {secret hex40} w w
w w call {phone ( area ) local} w w.
w phone {phone area - local} w w w
w tel {phone area . local3 . local4} w w
w w {phone ( area ) local} w, w w
w social {id ssn} w w.
w ssn {id ssn} w w w
w w {id ssn} w w
w w + 1 ( area ) local w w.
w version 3. W w w.
w license n.n. W w w
w w, n w w n w.
w in yyyy w w w.
w w n% w w, n.n w
w w n-n w w w
w page nn, w section n.n.n w w
w w yyyy-nn-nn w w
w w nn:nn:nn w w w
w w big w w w
w card big w w
w w n,nnn w nnn w w
w w = w w w
w n = n w w
w w ip.ip.ip.ip w w w
w w w@w.w w w
w w.nn@mailn.w.w w w w
w wn w wnn w w
Wn Wnn w w.
w W-nnn w w w
w (w n) w [nn] w
w "w" = "w" w
w http://w.w/w/nnn?w=n w w
w # w nnn w $n.nn w
w nnnn$$$ w*** w### ip.ip.ip.ip### w
w password: {secret letters} w w.
w password= {secret letters} w w
password={secret letters} w
w bearer {secret letters} w w
w bearer {secret letters}, w w
w api key {secret letters} w w
w apikey={secret letters} w
w token: {secret letters} w w
w w password w w w
w password was w, w w
w bearer w w, w w
w secret long w w
w token long w w
w key: w w, w w
w key: W w w
w w long w long w.
W long, w long: long w
w LOUD LOUD!! LOUD LOUD!! LOUD w
LOUD!! LOUD!! LOUD, LOUD!! LOUD.
w! LOUD! LOUD!! w
w w | w w | w
w w. | W w w
w password={secret mailed} w w
password={secret mailed}, w
w password: {secret mailed} w
"""


def labelled_table(copies: int = 12, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """The table's rows with their blanks filled in, as tokens and labels."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, n: "".join(rng.choice(list(letters), n))
    hexes, lower, upper, digits = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def alnum(letters: str, n: int) -> str:
        s = pick(letters, n - 2)
        return s[:2] + pick(digits, 1) + s[2:] + pick(lower if letters[-1] != "Z" else upper, 1)

    makers = {
        "hex40": lambda: pick(hexes, 40), "hex32": lambda: pick(hexes, 32), "hex18": lambda: pick(hexes, 18),
        "mixed12": lambda: alnum(lower + upper + digits, 12), "mixed10": lambda: alnum(lower + digits, 10), "mixed24": lambda: alnum(lower + upper + digits, 24),
        "mailed": lambda: f"{alnum(lower + digits, 4)}@{pick(lower, 5)}.com!{pick(lower, 1)}{pick(digits, 1)}",
        "letters": lambda: pick(lower + upper, 1) + pick(lower if rng.random() < 0.7 else lower + upper, int(rng.integers(11, 24))),
        "long": lambda: pick(lower + "éäñü", int(rng.integers(11, 18))), "LOUD": lambda: pick(upper + "ÉÄÑÜ", int(rng.integers(1, 12))),
        "upper20": lambda: pick(upper, 4) + alnum(digits + upper, 16), "caps20": lambda: pick(upper, 12) + pick(digits, 1) + pick(upper, 7),
        "area": lambda: pick("23456789", 1) + pick(digits, 2),
        "local": lambda: f"{pick(digits, 3)}-{pick(digits, 4)}", "local3": lambda: pick(digits, 3), "local4": lambda: pick(digits, 4),
        "ssn": lambda: f"{pick(digits, 3)}-{pick(digits, 2)}-{pick(digits, 4)}", "yyyy": lambda: f"{rng.integers(1800, 2030)}", "big": lambda: pick("123456789", 1) + pick(digits, 15),
    }
    blanks = re.compile(r"\b(?:hex\d\d|mixed\d\d|letters|mailed|long|LOUD|upper20|caps20|area|local[34]?|ssn|yyyy|big)\b|\bip\b|\b[Ww](?=\b|n+\b)|(?<![a-z])n+(?![a-z])|(?<=mail)n|(?<=[Ww])n+\b")

    def fill(text: str) -> str:
        def one(m: re.Match) -> str:
            name = m.group()
            if name in makers:
                return makers[name]()
            if name == "ip":
                return str(rng.integers(0, 256))
            if name in "Ww":
                word = pick(lower + "éäñü", int(rng.integers(1, 11)))
                return word.capitalize() if name == "W" else word
            return pick(digits, len(name) if len(name) > 1 else int(rng.integers(1, 4)))

        return blanks.sub(one, text)

    rows = []
    for line in TABLE.strip().splitlines() * copies:
        tokens, labels = [], []
        for k, part in enumerate(re.split(r"\{(\w+ [^}]*)\}", line)):
            label, body = part.split(" ", 1) if k % 2 else ("O", part)
            found = _TOKEN.findall(fill(body).replace(" - ", "-").replace(" . ", ".") if k % 2 else fill(body))
            tokens += found
            labels += [label] * len(found)
        rows.append((tokens, labels))
    return rows


def _spans(text: str, y: list[int]) -> list[Span]:
    """The runs of like labels among the text's tokens."""
    tokens, out, k = [m.span() for m in _TOKEN.finditer(text)], [], 0
    while k < len(tokens):
        j = k
        while j + 1 < len(tokens) and y[j + 1] == y[k]:
            j += 1
        if y[k]:
            out.append((LABELS[y[k]], tokens[k][0], tokens[j][1]))
        k = j + 1
    return out


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """What the field finds in each text."""
    out: list[list[Span]] = [[] for _ in texts]
    tokens, held = ["\n", "\n"], []
    for i, text in enumerate(texts):
        found = _TOKEN.findall(text)
        held.append((i, len(tokens), len(tokens) + len(found)))
        tokens += found
        tokens += ["\n", "\n"]
        if len(tokens) >= GROUP_TOKENS or i + 1 == len(texts):
            edge = np.ones(len(tokens), bool)
            for _, a, b in held:
                edge[a:b] = False
            y = field.labels(tokens, edge)
            for j, a, b in held:
                if y[a:b].any():
                    out[j] = _spans(texts[j], y[a:b].tolist())
            tokens, held = ["\n", "\n"], []
    return out


def _covered(span: Span, base: list[Span]) -> bool:
    """Whether the base spans together hold the whole span."""
    at = span[1]
    for a, b in sorted((a, b) for _, a, b in base):
        if a <= at:
            at = max(at, b)
    return at >= span[2]


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Of each text: the base spans, and all spans, by kind and start."""
    out = []
    for text, more in zip(texts, field_spans(texts, field), strict=True):
        base = patterns(text)
        added = [s for s in more if not _covered(s, base)]
        out.append((base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, base spans by kind, a digest of the base spans, and all spans."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Field())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(batch.column(1).to_pylist(), shared.value)
            columns = {"doc_id": batch.column(0)}
            for kind in BASE_KINDS:
                columns[f"n_{kind}"] = pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns["spans"] = pa.array([joined(spans) for _, spans in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, SCHEMA)


def blank(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; spans that overlap become the first's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; all rows and columns stay, null texts stay null."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Field())

    @F.pandas_udf("string")
    def cleaned(texts):
        import pandas as pd

        given = [t if isinstance(t, str) else "" for t in texts]
        done = [blank(t, spans) if spans else t for t, (_, spans) in zip(given, find(given, shared.value), strict=True)]
        return pd.Series([d if isinstance(t, str) else None for t, d in zip(texts, done, strict=True)], dtype=object)

    return docs.withColumn(text_col, cleaned(F.col(text_col)))
