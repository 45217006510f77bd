"""Personal data: fixed patterns, and a linear-chain conditional random field that finds what they miss.

The patterns find e-mail addresses, IPv4 addresses, card numbers and telephone numbers in their plain forms. The field
looks at the shapes of words and their neighbours, learns from a small labelled table, and is decoded by Viterbi for
all stretches of a batch at once. Its spans are added where no pattern's span is, if they are ``likely``: right numbers
and a form that may be looser than the patterns'.

The labelled table has two parts: a sample of the corpus with the patterns' spans (``labelled_table``), and examples
made in code of the forms the patterns miss, with look-alikes that are none (``examples``). Stretches of the sample
that have such a form stay out of it, so that what the patterns miss is not taught to be nothing.

The field reads only stretches of words around one with a digit, an ``@`` or an "at" or "dot" in place of a sign, such
as ``jane (at) example.com`` or ``jane at example dot com``: without these there is no personal data of these kinds.
An "at" without brackets counts only before a domain with "dot", as "look at example.com" is plain speech.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import arrow_map
from siltworks.llm.words import chunks

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{begin}-{kind}" for kind in KINDS for begin in "BI"))
DIMENSIONS = 1 << 14
SAMPLE = 1500  # documents that the labelled table is made from
AROUND = 2  # words kept on both sides of one with a digit or an @

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# All digits before the first dot belong to a match, so starts within a run of digits need no try.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_BRACKETED = r"[\[({<][\x20\t]?(?:at|dot)[\x20\t]?[\])}>]"
_SPOKEN = r"(?:\bat[\x20\t]+|@[\x20\t]*)[a-z0-9-]+(?:[\x20\t]+dot[\x20\t]+[a-z0-9-]+)+"
_NEAR = re.compile(rf"{_SPOKEN}|{_BRACKETED}|[0-9@]+", re.IGNORECASE | re.ASCII)
_AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s*@\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+(?:dot|\.)\s+", re.IGNORECASE)
_BARE_AT = re.compile(r"\s+at\s+(?=\S+\s+dot\s)", re.IGNORECASE)
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_LOOSE_CARD = re.compile(r"[0-9](?:[\s._/\u2013\u2014-]{0,3}[0-9])+")
_LOOSE_PHONE = re.compile(r"(?=.*[^0-9])\+?\(?[0-9][0-9().\s/\u2013-]*[0-9]", re.DOTALL)
_MARKS = frozenset(("at", "(at)", "dot", "(dot)"))
_YEARED = re.compile(r"(?:19|20)[0-9]{2}/[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    """Whether a span of the kind has the right numbers in it."""
    if kind == "email":
        return _email_at(text, text.find("@"), 0) == (0, len(text))
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    digits = _NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def likely(kind: str, text: str) -> bool:
    """Whether a span of the field can be of the kind: valid, or in a looser form with the right numbers in it.

    Signs of e-mail and IP addresses may be in brackets or in words or have blanks around them. Cards may have other
    separators. Telephone numbers need no ``+``; without one, a year and a number after a slash are none, nor are pairs of
    digits unless they are five and begin with 0.
    """
    if kind == "card":
        return _LOOSE_CARD.fullmatch(text) is not None and valid(kind, text)
    if kind == "phone":
        groups = _DIGITS.findall(text)
        pairs = text[:1] != "+" and all(len(g) <= 2 for g in groups)
        some = not pairs or len(groups) == 5 and groups[0][0] == "0"
        return some and _LOOSE_PHONE.fullmatch(text) is not None and not _YEARED.fullmatch(text) and valid(kind, text)
    if valid(kind, text):
        return True
    if kind == "email":
        plain = _DOT.sub(".", _AT.sub("@", _BARE_AT.sub("@", text)))
        return _LOOSE_EMAIL.fullmatch(plain) is not None
    return kind == "ip" and valid(kind, _DOT.sub(".", text))


def _email_at(text: str, at: int, first: int) -> tuple[int, int] | None:
    """The address around an ``@``, not beginning before ``first``."""
    start = at
    while start > first and text[start - 1] in _LOCAL:
        start -= 1
    found = _DOMAIN.match(text, at + 1) if 0 <= start < at else None
    return (start, found.end()) if found else None


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: leftmost and not overlapping within a kind, those with wrong numbers left out."""
    spans: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        if found := _email_at(text, at, done):
            spans.append((found[0], 0, found[1]))
            done = found[1]
        at = text.find("@", max(at + 1, done))
    if _TRIGGER.search(text):
        for number, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            for match in pattern.finditer(text):
                if valid(KINDS[number], match.group()):
                    spans.append((match.start(), number, match.end()))
    return sorted(spans)


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Words (start, end) near a word with a digit, an ``@`` or what stands for a sign, in runs."""
    marks = [m.span() for m in _NEAR.finditer(text)]
    if not marks:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    starts, ends = np.array(words, dtype=np.int64).T
    begin, end = np.array(marks, dtype=np.int64).T
    first = np.searchsorted(ends, begin, "right")
    after = np.searchsorted(starts, end, "left")
    near = np.zeros(len(words) + 2 * AROUND + 1, dtype=np.int64)
    np.add.at(near, first, 1)
    np.add.at(near, after + 2 * AROUND, -1)
    inside = np.cumsum(near)[AROUND : AROUND + len(words)] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
    return [words[i:j] for i, j in zip(edges[::2], edges[1::2])]


def core(text: str, start: int, end: int) -> tuple[int, int]:
    """A word without punctuation around it, but for signs that begin a number."""
    while start < end and text[start] in "\"'<[{,;:":
        start += 1
    while end > start and text[end - 1] in "\"'>]},;:.!?":
        end -= 1
    return start, end


_RUNS = re.compile(r"([0-9]+)|([A-Z]+)|([a-z]+)|([^\x00-\x7F]+)")
_INNER_AT = re.compile(r"[\[({<]at[\])}>]", re.IGNORECASE)
_INNER_DOT = re.compile(r"[\[({<](?:dot|\.)[\])}>]", re.IGNORECASE)
_NAME = re.compile(r"[aA9U._%+-]*[aAU][aA9U._%+-]*")


def coarse(word: str, plain: str) -> str:
    """The shape with names of any make as one sign, and signs in brackets as two others."""
    if "[" in plain or "(" in plain or "{" in plain or "<" in plain:
        if plain not in _MARKS:
            plain = _RUNS.sub(lambda m: "9AaU"[m.lastindex - 1], _INNER_DOT.sub("\x01", _INNER_AT.sub("\x02", word)))
    return plain if plain in _MARKS else _NAME.sub("L", plain)


def shape(word: str) -> tuple[str, str]:
    """The word with runs of digits and letters as one sign, without and with their lengths; "at" and "dot" as they are."""
    if len(word) <= 5 and word.lower() in _MARKS:
        return word.lower(), word.lower()

    def sign(m: re.Match) -> str:
        return "9AaU"[m.lastindex - 1]

    return _RUNS.sub(sign, word), _RUNS.sub(lambda m: f"{sign(m)}{min(len(m.group()), 20)}", word)


def observations(words: Sequence[str]) -> np.ndarray:
    """Per word the numbers of its features: its shapes, its length and its neighbours' shapes, and coarser shapes."""
    plain, exact = zip(*map(shape, words))
    rough = ("<", *map(coarse, words, plain), ">")
    plain = ("<", "<", *plain, ">", ">")
    rows = []
    for i, word in enumerate(words):
        named = (
            f"p{plain[i + 2]}", f"e{exact[i]}", f"b{plain[i + 1]}|{plain[i + 2]}", f"n{plain[i + 2]}|{plain[i + 3]}",
            f"bb{plain[i]}|{plain[i + 1]}", f"l{min(len(word), 24)}|{plain[i + 2][:1]}",
            f"c{rough[i + 1]}", f"t{rough[i]}|{rough[i + 1]}|{rough[i + 2]}",
        )
        rows.append([xxhash.xxh64_intdigest(x) % DIMENSIONS for x in named])
    return np.array(rows, dtype=np.int64)


@dataclass
class Field:
    """Weights of features by tag, of tag pairs, and of the first tag."""

    words: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def scores(self, batch: np.ndarray) -> np.ndarray:
        """Tag scores of padded stretches (stretch, word, feature)."""
        return self.words[batch].sum(axis=2)

    def decode(self, batch: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best tags of all stretches together, by Viterbi."""
        scores = self.scores(batch)
        n, most, _ = scores.shape
        best = scores[:, 0] + self.first
        back = np.zeros((n, most, len(TAGS)), dtype=np.int8)
        for t in range(1, most):
            through = best[:, :, None] + self.pairs[None]
            back[:, t] = through.argmax(axis=1)
            step = through.max(axis=1) + scores[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        tags = np.zeros((n, most), dtype=np.int8)
        tag = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(most - 1, -1, -1):
            tags[:, t] = np.where(t < lengths, tag, 0)
            tag = np.where((t < lengths) & (t > 0), back[rows, t, tag], tag)
        return tags


def _padded(found: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in found])
    batch = np.zeros((len(found), lengths.max(), found[0].shape[1]), dtype=np.int64)
    for i, x in enumerate(found):
        batch[i, : len(x)] = x
    return batch, lengths


def _groups(found: Sequence[np.ndarray], most: int = 1 << 14) -> Iterator[list[int]]:
    """Numbers of stretches of like lengths, so that padding stays small."""
    held: list[int] = []
    for i in sorted(range(len(found)), key=lambda i: (len(found[i]), i)):
        if held and (len(held) + 1) * len(found[i]) > most:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def sums(field: Field, scores: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logarithms of the sums over all tags before and after each word, and over all taggings of a stretch."""
    most = scores.shape[1]
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + field.first
    for t in range(1, most):
        moved = _log_sum(ahead[:, t - 1, :, None] + field.pairs[None], 1) + scores[:, t]
        ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
    for t in range(most - 2, -1, -1):
        moved = _log_sum(field.pairs[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(inside[:, t + 1, None], moved, 0)
    return ahead, behind, _log_sum(ahead[:, -1], 1)


def fit_field(found: Sequence[np.ndarray], tags: Sequence[np.ndarray], rounds: int = 40, rate: float = 0.1, penalty: float = 1e-4) -> Field:
    """Maximum likelihood with a ridge penalty: forward and backward sums give the gradient, in steps of adaptive size."""
    n_tags = len(TAGS)
    field = Field(np.zeros((DIMENSIONS, n_tags)), np.zeros((n_tags, n_tags)), np.zeros(n_tags))
    batches = [(*_padded([found[i] for i in g]), [tags[i] for i in g]) for g in _groups(found)]
    values = (field.words, field.pairs, field.first)
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    total = sum(map(len, found))
    for step in range(1, rounds + 1):
        slopes = [np.zeros_like(v) for v in values]
        for batch, lengths, gold in batches:
            scores = field.scores(batch)
            n, most, _ = scores.shape
            inside = np.arange(most)[None] < lengths[:, None]
            ahead, behind, norm = sums(field, scores, inside)
            share = np.exp(ahead + behind - norm[:, None, None]) * inside[:, :, None]
            truth = np.zeros_like(share)
            for i, own in enumerate(gold):
                truth[i, np.arange(len(own)), own] = 1
            gap = truth - share
            flat = gap[inside]
            for k in range(batch.shape[2]):
                np.add.at(slopes[0], batch[:, :, k][inside], flat)
            slopes[2] += gap[:, 0].sum(axis=0)
            for t in range(1, most):
                both = ahead[:, t - 1, :, None] + field.pairs[None] + (scores[:, t] + behind[:, t])[:, None, :] - norm[:, None, None]
                expected = np.exp(both) * inside[:, t, None, None]
                seen = truth[:, t - 1, :, None] * truth[:, t, None, :]
                slopes[1] += (seen - expected).sum(axis=0)
        for value, slope, (mean, square) in zip(values, slopes, moments):
            slope = slope / total - penalty * value
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            value += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return field


def _tags_of(text: str, words: Sequence[tuple[int, int]], spans: Sequence[Span]) -> list[str]:
    """Tags of a stretch by the spans that its words' cores are in."""
    tags, last = [], None
    for start, end in words:
        start, end = core(text, start, end)
        own = next((s for s in spans if s[0] < end and start < s[2]), None)
        tags.append("O" if own is None else f"{'I' if own == last else 'B'}-{KINDS[own[1]]}")
        last = own
    return tags


def _missed(text: str, words: Sequence[tuple[int, int]], spans: Sequence[Span], most: int = 9) -> bool:
    """Whether up to ``most`` words have a likely form that no span overlaps."""
    cores = [core(text, *w) for w in words]
    for i, (start, _) in enumerate(cores):
        for _, end in cores[i : i + most]:
            if any(s[0] < end and start < s[2] for s in spans):
                break
            for kind in range(len(KINDS)):
                a, _, b = _bare(text, (start, kind, end))
                if likely(KINDS[kind], text[a:b]):
                    return True
    return False


def _forms(r: random.Random) -> list[tuple[int, str]]:
    """One span of each form that the patterns miss, with its kind."""

    def word(least: int, most: int) -> str:
        made = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(least, most)))
        return made.capitalize() if r.random() < 0.15 else made

    def name() -> str:
        return r.choice(("{}", "{}", "{}", "{}.{}", "{}_{}", "{}{n}", "{}.{}{n}", "{}-{}")).format(word(1, 9), word(2, 9), n=r.randint(1, 99))

    def host() -> str:
        return r.choice(("{}", "{}", "{}", "{}-{}", "{}{n}")).format(word(2, 10), word(2, 8), n=r.randint(1, 99))

    ends = ("com", "org", "net", "de", "co.uk", "example.com", "edu", "io")
    out: list[tuple[int, str]] = []
    for at in (" (at) ", " [at] ", "(at)", "[at]", " @ ", "@ ", " @", " @", " (AT) ", " ( at ) ", "{at}", " {at} "):
        out.append((0, f"{name()}{at}{host()}.{r.choice(ends)}"))
    for at, dot in ((" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" at ", " dot "), (" AT ", " DOT "), ("@", "[.]"), ("@", " dot "), ("@", " (dot) "), (" @ ", " dot ")):
        out.append((0, f"{name()}{at}{host()}{dot}{r.choice(ends).replace('.', dot)}"))
    parts = [str(r.choice((r.randint(0, 9), r.randint(10, 99), r.randint(100, 255)))) for _ in range(4)]
    for dot in ("[.]", "(.)", " . ", "[dot]", "(dot)", " [dot] ", " (dot) ", " dot ", " [.] "):
        out.append((1, dot.join(parts)))
    out += [(1, f"{'.'.join(parts[:3])}[.]{parts[3]}"), (1, f"{parts[0]}[.]{'.'.join(parts[1:])}")]
    for sep in (".", "/", "_", " - ", "  ", "\u2013", " / ", "--"):
        for sizes in ((4, 4, 4, 4), (4, 6, 5)):
            digits = "".join(str(r.randint(1, 9)) for _ in range(sum(sizes) - 1))
            digits += next(d for d in "0123456789" if luhn(digits + d))
            cut = [sum(sizes[:i]) for i in range(len(sizes))]
            out.append((2, sep.join(digits[c : c + n] for c, n in zip(cut, sizes))))

    def number(form: str) -> str:
        return "".join(str(r.randint(1, 9)) if c == "9" else c for c in form)

    for form in (
        "999-999-9999", "999.999.9999", "999 999 9999", "(999) 999-9999", "(999)999-9999", "1-999-999-9999", "1 (999) 999-9999",
        "999/999-9999", "0099 99 9999999", "00 99 99 9999 9999", "099/9999999", "0999 9999999", "099 9999 9999", "09 99 99 99 99",
        "(099) 9999 9999", "+99/99/9999999", "0999-999999", "999\u2013999\u20139999",
    ):
        out.append((3, number(form)))
    return out


def _look_alikes(r: random.Random) -> list[str]:
    """Words with digits, ``@``, "at" or "dot" that are no personal data."""
    n = r.randint
    digits = "".join(str(n(0, 9)) for _ in range(n(5, 19)))
    return [
        f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 28):02}.{n(1, 12):02}.{n(1900, 2099)}", f"{n(1, 12)}/{n(1, 28)}/{n(1900, 2099)}",
        f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02} {n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}", f"{n(1900, 2020)}-{n(1900, 2099)}",
        f"{n(0, 9)}.{n(0, 99)}", f"{n(0, 9)}.{n(0, 9)}.{n(0, 99)}", f"{n(1, 999)},{n(100, 999)},{n(100, 999)}.{n(10, 99)}", digits, f"{n(1, 99)}.", f"{n(1, 99)}",
        f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}", f"{n(100, 999)}-{n(10, 99)}-{n(1000, 9999)}", f"{n(1, 99)} {n(100, 999)} {n(100, 999)}",
        " ".join(str(n(0, 10 ** n(1, 5))) for _ in range(n(5, 9))), f"pp. {n(1, 999)}-{n(1000, 1999)}", f"1. {n(2, 9)}. {n(3, 9)}. {n(4, 9)}",
        f"{n(1, 99)} @ {n(1, 99)}.{n(10, 99)}", f"@{r.choice(('jane', 'news', 'acme2'))}", f"at {n(1, 12)}:{n(10, 59)}", f"(at) {r.choice(('noon', 'home', 'least'))}",
        f"dot {n(1, 9)}", f"at the dot on page {n(1, 99)}", f"({n(1900, 2099)})", f"{n(10, 99)}%", f"{n(0, 2**128):032x}", f"{n(0, 2**32):08x}-{n(0, 2**16):04x}",
        f"{n(1, 999)}.{n(100, 999)}.{n(100, 999)},{n(10, 99)}", f"{n(1950, 2030)}/{n(1, 99999):07}", f"{n(1, 99)}/{n(1950, 2030)}",
        f"x{n(1, 99)}_{n(1, 99)}", f"${n(1, 999)}.{n(10, 99)}", f"RFC-{n(100, 9999)}",
    ]


def example_texts(seed: int = 1, rounds: int = 24) -> list[tuple[str, list[Span]]]:
    """Texts with the forms that the patterns miss and their spans, and texts with look-alikes and none."""
    r = random.Random(seed)
    plain = ("so", "the", "Call", "write", "of", "and", "now", "reach", "us", "Mail", "token", "then", "from", "Words", "is", "are", "order", "in", "to", "h\u00e9", "lo")
    signs = ("", "", "", "", ",", ".", ":")
    out = []
    for _ in range(rounds):
        for kind, form in [*_forms(r), *((-1, x) for x in _look_alikes(r))]:
            ahead = " ".join(r.choice(plain) for _ in range(r.randint(0, 3)))
            ahead += (r.choice(("", "", ":")) + " ") if ahead else ""
            text = f"{ahead}{form}{r.choice(signs)} {' '.join(r.choice(plain) for _ in range(r.randint(0, 3)))}"
            out.append((text, [(len(ahead), kind, len(ahead) + len(form))] if kind >= 0 else []))
    return out


def examples() -> list[tuple[list[str], list[str]]]:
    """``words, tags`` of the example texts' stretches, the same at every call."""
    out = []
    for text, spans in example_texts():
        for words in stretches(text):
            cores = [core(text, *w) for w in words]
            out.append(([text[i:j] for i, j in cores], _tags_of(text, words, spans or pattern_spans(text))))
    return out


def labelled_table(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``words, tags`` of stretches in at most ``most`` documents that have any, chosen by hash of their ids.

    The patterns' spans are the labels, so the table needs no hand; a table labelled by hand has the same form.
    Stretches with a likely form that the patterns miss are left out.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    chosen = texts.select(F.col("doc_id").alias("chosen")).distinct().orderBy(F.xxhash64("chosen"), "chosen").limit(most)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = pattern_spans(text)
                for words in stretches(text):
                    if _missed(text, words, spans):
                        continue
                    cores = [core(text, *w) for w in words]
                    rows.append(([text[i:j] for i, j in cores], _tags_of(text, words, spans)))
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i in (0, 1)], ["words", "tags"])

    # At most ``most`` ids, so the broadcast is bounded.
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"), "left_semi").select("text")
    return arrow_map(sample, scan, "words array<string>, tags array<string>")


def train(labelled: DataFrame, most: int = 50_000, more: Sequence[tuple[list[str], list[str]]] = ()) -> Field | None:
    """Fit on a small labelled table, at most ``most`` stretches, and on ``more``; None if both are empty.

    Equal tables give equal fields.
    """
    rows = labelled.filter(F.size("words") > 0).orderBy(F.xxhash64("words"), "words", "tags").limit(most).collect()
    number = {tag: i for i, tag in enumerate(TAGS)}
    table = [*((r["words"], r["tags"]) for r in rows), *more]
    if not table:
        return None
    return fit_field([observations(words) for words, _ in table], [np.array([number[t] for t in tags]) for _, tags in table])


def field_spans(field: Field, texts: Sequence[str]) -> list[list[Span]]:
    """The spans that the field sees in each text."""
    owners, places, found = [], [], []
    for row, text in enumerate(texts):
        for words in stretches(text):
            cores = [core(text, *w) for w in words]
            owners.append(row)
            places.append(cores)
            found.append(observations([text[i:j] for i, j in cores]))
    spans: list[list[Span]] = [[] for _ in texts]
    for group in _groups(found):
        tags = field.decode(*_padded([found[i] for i in group]))
        for i, own in zip(group, tags):
            current = None
            for (start, end), tag in zip(places[i], own.tolist()):
                kind = (tag - 1) // 2
                if tag and not (tag % 2) and current is not None and current[1] == kind:
                    current[2] = end
                elif tag:
                    current = [start, kind, end]
                    spans[owners[i]].append(current)
                else:
                    current = None
    return [sorted(tuple(s) for s in own) for own in spans]


def _bare(text: str, span: Span) -> Span:
    """An address without round brackets around it, which a word's core keeps for the sake of numbers."""
    start, kind, end = span
    if kind < 2:
        start += start < end and text[start] == "("
        end -= start < end and text[end - 1] == ")"
    return start, kind, end


def merged(text: str, base: Sequence[Span], seen: Sequence[Span]) -> list[Span]:
    """The base spans and those of the field that are likely and overlap none taken before."""
    out = list(base)
    for span in (_bare(text, s) for s in seen):
        if likely(KINDS[span[1]], text[span[0] : span[2]]) and all(span[2] <= s[0] or s[2] <= span[0] for s in out):
            out.append(span)
    return sorted(out)


def _joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_personal(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row ``doc_id``, the counts of the patterns' spans by kind, ``base`` and ``spans``.

    ``base`` has the patterns' spans and ``spans`` the field's as well, each as ``kind:start:end`` in code points,
    end exclusive, by start and then kind. One pass without a shuffle, over whole texts. NULL and empty texts have
    no spans; repeated rows are searched alike. Without a field there are only the patterns' spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                texts = [text or "" for text in part.column(1).to_pylist()]
                base = [pattern_spans(text) for text in texts]
                seen = field_spans(shared.value, texts) if shared.value else [[] for _ in texts]
                every = [merged(*x) for x in zip(texts, base, seen)]
                counts = [pa.array([sum(s[1] == k for s in own) for own in base], pa.int64()) for k in range(len(KINDS))]
                strings = [pa.array([_joined(own) for own in x], pa.string()) for x in (base, every)]
                names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base", "spans"]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, *strings], names)

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}, base string, spans string"
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), scan, schema)
