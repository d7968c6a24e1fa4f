"""PII: base patterns, and beyond them spans that boosted trees choose among high-recall candidates.

Candidate generators propose overlapping spans of looser form (an e-mail address written out, telephone numbers without
a plus, card numbers with other separators, spaced or bracketed addresses, and secrets: values beside words like token or
password, and long runs as keys and hashes are). Features of format and context go through
gradient-boosted trees, one model a kind. The models learn from generated, labelled examples (EXAMPLES of them a kind,
seeded), as no table has labels; the threshold of a kind is the lowest at which PRECISION is reached on generated
examples held out from training. Of candidates that overlap each other the most likely one stays; base spans all stay,
and a candidate that overlaps one is dropped. Base spans are of KINDS; a secret is a span of its own kind, listed last.

Cases: a null text is an empty one without spans; texts are read whole; offsets are code points, the end exclusive; equal
rows get equal spans; of candidates that are equally likely the first stays; no rows give none; extra columns pass through
(an input column named like an output column, in whatever case, is replaced).
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.boosting import BoostedTrees
from orthoweave.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
ALL_KINDS = (*KINDS, SECRET)
#: Generated examples a kind, their seed, precision of the calibrated thresholds, characters of context on either side.
EXAMPLES, SEED, PRECISION, CONTEXT = 3000, 11, 0.995, 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# Patterns begin where a run of digits begins: from within it the outcome would be the same, at quadratic cost.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:@|\(at\)|\[at\]|\{at\}| at ) ?(?:[A-Za-z0-9-]{1,63} ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?){1,4}[A-Za-z]{2,24}(?![A-Za-z0-9])", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(dot\)|\[dot\]|\.) ?[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{2,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.])(?:00[ -]?[0-9]{1,3}[ .-]?|0)?\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])"),
}
#: Where a loose pattern can match at all: what every match of it holds.
_HINT = {"email": re.compile(r"@|\(at\)|\[at\]|\{at\}| at ", re.I), "ip": re.compile(r"[0-9]"), "card": re.compile(r"[0-9]{4}"), "phone": re.compile(r"[0-9]{2}")}
_SAYS = {
    "email": re.compile(r"e-?mail|contact|write|reach|correo|courriel|address|mailto", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|client|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment", re.I),
    "phone": re.compile(r"tel|phone|call|mobil|fax|cell|whatsapp|contact|sms|ruf", re.I),
    SECRET: re.compile(r"pass(?:wor[dt]|wd|phrase)?\b|pwd|secret|token|\w*key|auth\w*|credential|bearer|clave|schlüssel|kennwort", re.I),
}
#: A run as keys and hashes are, and the value that is given to a name; the latter may be shorter.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9+/_=-])")
_GIVEN = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|key|auth\w{0,20}|credentials?|bearer)[\"'\]]? {0,3}(?::=|=>|[=:]) {0,3}[\"']?([^\s\"'<>,;]{6,}+)", re.I)


def luhn(digits: str) -> bool:
    odd = [int(c) for c in reversed(digits)]
    return sum(odd[::2] + [d * 2 - 9 * (d > 4) for d in odd[1::2]]) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them from the left, by way of the at signs: time grows with the text alone."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        got = _DOMAIN.match(text, at + 1) if start < at else None
        if got:
            yield start, got.end()
            free = got.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    for kind, loose in _LOOSE.items():
        if _HINT[kind].search(text):
            for m in loose.finditer(text):
                yield kind, m.start(), m.end()
    yield from dict.fromkeys(secrets(text))


def secrets(text: str) -> Iterator[tuple[str, int, int]]:
    if any(len(w) >= 16 for w in text.split()):
        for m in _RUN.finditer(text):
            yield SECRET, m.start(), m.end()
    if "=" in text or ":" in text:
        for m in _GIVEN.finditer(text):
            yield SECRET, m.start(1), m.end(1)


def secret_features(text: str, a: int, b: int) -> list[float]:
    span, left, right = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    n, of = b - a, Counter(span)
    digits, upper, lower = (sum(f(c) for c in span) for f in (str.isdigit, str.isupper, str.islower))
    changes = sum((x.isdigit() != y.isdigit()) or (x.isupper() != y.isupper()) for x, y in zip(span, span[1:]))
    cue = _SAYS[SECRET].search(left)
    return [
        n, digits / n, upper / n, lower / n, changes / n, -sum(v / n * math.log2(v / n) for v in of.values()), len(of) / n,
        sum(c in "0123456789abcdefABCDEF" for c in span) / n, sum(c in "+/=" for c in span) / n, sum(c in "-_." for c in span) / n,
        cue is not None, left.rstrip(" \"'")[-1:] in ("=", ":", ">"), left[-1:] in ('"', "'") and right[:1] == left[-1:], right[:1].isalnum(), n % 8 == 0, max(map(len, re.split("[^A-Za-z]+", span))) / n,
    ]


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    span, left, right = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    if kind == SECRET:
        return secret_features(text, a, b)
    digits = _DIGITS.sub("", span)
    runs = [len(r) for r in re.findall(r"[0-9]+", span)] or [0]
    signs = re.findall(r"[^0-9A-Za-z]+", span)
    numbers = [int(r) for r in re.findall(r"[0-9]+", span)][:8] or [0]
    return [
        len(span), len(digits), len(runs), max(runs), min(runs), runs[0], runs[-1], len(signs), len(set(signs)),
        span.count("."), span.count("-"), span.count(" "), span.count("/"), "(" in span, span[0] in "0(", max(numbers), luhn(digits) if digits else 0,
        bool(re.search(r"[\[({](?:at|dot)[\])}]", span, re.I)), "@" in span, bool(_SAYS[kind].search(left)), bool(_SAYS[kind].search(right)),
        left[-1:].isalnum(), right[:1].isalnum(), left.rstrip()[-1:] in (":", "=", "#"), sum(c.isdigit() for c in left + right), 1900 <= numbers[0] <= 2099 or 1900 <= numbers[-1] <= 2099,
    ]


def _example(kind: str, rng: random.Random) -> tuple[str, str, str, bool]:
    """Text before, span, text after, whether it is personal data."""
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(1, 5)))
    if kind == SECRET:
        return _secret_example(rng, word, prose)
    cue = {"email": "email", "ip": "server ip", "card": "card", "phone": "tel"}[kind]
    yes = rng.random() < 0.5
    before = prose() + rng.choice([" ", ". ", ", "]) + (cue + rng.choice([": ", " "]) if rng.random() < (0.7 if yes else 0.05) else "")
    after = rng.choice([" ", ". ", ", "]) + prose()
    if kind == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "(dot)"), ("{at}", "{dot}"), (" at ", "."), (" at ", " dot ")])
        local = rng.choice([f"{word()}.{digit(2)}", f"{word()}.{word()}", f"{word()}_{word()}", f"{word()}.{word()}{digit(2)}"])
        span = f"{local}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}" if yes else f"{word()} at {word()}{rng.choice([' dot ', '. ', '.'])}{word()}"
    elif kind == "ip":
        dot = rng.choice(["[.]", "(dot)", "[dot]"]) if yes else rng.choice([". ", " .", " . "])
        span = dot.join(str(rng.randint(0, 255 if yes else 999)) for _ in range(4))
    elif kind == "card":
        body = digit(15)
        if yes:
            body += next(c for c in "0123456789" if luhn(body + c))
        else:
            body += rng.choice([c for c in "0123456789" if not luhn(body + c)])
        sep = rng.choice([".", "/", "_", "  ", " - "])
        span = sep.join(body[i : i + 4] for i in range(0, 16, 4))
    elif yes:
        span = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "0{}/{} {}", "0{} {} {}"]).format(digit(3), digit(3), digit(4))
    else:
        span = rng.choice(
            [f"{rng.randint(1900, 2099)}-{rng.randint(10, 12)}-{rng.randint(10, 31)}", f"{rng.randint(10, 31)}.{rng.randint(10, 12)}.{rng.randint(1900, 2099)}", f"{digit(2)}.{digit(2)}", f"{digit(3)}.{digit(3)}.{digit(3)}", f"{digit(2)}-{digit(2)}", f"{digit(4)}/{digit(2)}", f"{digit(2)} {digit(3)}", f"{digit(3)} {digit(3)} {digit(3)} {digit(3)}", f"{digit(4)} {digit(4)} {digit(4)} {digit(4)}"]
        )
    return before, span, after, yes


def _secret_example(rng: random.Random, word, prose) -> tuple[str, str, str, bool]:
    """Keys, hashes and passwords; against them words, numbers, paths, names and plain settings."""
    of = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    letters = upper + upper.lower()
    yes = rng.random() < 0.5
    after = rng.choice([" ", ". ", ", ", "\n", "!! ", "### "]) + prose()
    name = rng.choice(["token", "secret", "password", "passwd", "api_key", "access key", "key", "auth", "TOKEN", "PASSWORD", "Bearer", "API_KEY"])
    sign, quote = rng.choice([" = ", "=", ": ", ":"]), rng.choice(['"', "'", ""])
    before = prose() + rng.choice([" ", ". ", "\n"])
    if yes and rng.random() < 0.75:
        short = of(letters, 4) + of(digits, rng.randint(2, 4)) + rng.choice("!#%?x") + of(letters, rng.randint(0, 6))
        span = rng.choice([of(digits + "abcdef", rng.choice([32, 40, 64])), of(digits + "ABCDEF", rng.choice([32, 40, 64])), of(letters + digits + "+/", rng.randint(20, 64)), of(letters + digits + "_-", rng.randint(20, 48)), short])
        return before + name + sign + quote, span, quote + after, True
    if yes:
        span = rng.choice([of(digits + "abcdef", rng.choice([32, 40, 64])), of(digits + "ABCDEF", rng.choice([32, 40, 64])), of(letters + digits + "+/", rng.randint(32, 64)), "AKIA" + of(upper + digits, 16), "ghp_" + of(letters + digits, 36), "sk-" + of(letters + digits, 40)])
        return before, span, after, True
    if rng.random() < 0.3:
        span = rng.choice([word() + word(), of(digits, rng.randint(6, 9)), "required", "disabled", word() + "_" + word(), f"{word()}.{word()}()", "os.environ"])
        return before + rng.choice([name, "keyword", "monkey", "title", "author"]) + sign, span, after, False
    long = "".join(word() for _ in range(rng.randint(3, 8)))
    span = rng.choice([long, long.upper(), long.title(), "-".join(word() for _ in range(6)), "_".join(word() for _ in range(6)), "/".join(word() for _ in range(6)), of(digits, rng.randint(16, 40)), f"{of(digits, 4)}-{of(digits, 2)}-{of(digits, 2)}-{long}", "-" * rng.randint(16, 80), "_" * 30, "".join(word().title() for _ in range(4)), rng.choice(letters) * 40, "+".join(word() for _ in range(5)), long + of(digits, 2), f"{of(digits, 4)}/{of(digits, 2)}/{long}"])
    return before, span, after, False


@functools.cache
def models(examples: int = EXAMPLES, seed: int = SEED) -> dict[str, tuple[BoostedTrees, float]]:
    """For each kind the trees, and the probability from which a candidate is redacted."""
    got = {}
    for kind in ALL_KINDS:
        rng = random.Random(f"{seed}{kind}")
        x, y = [], []
        for _ in range(examples):
            before, span, after, yes = _example(kind, rng)
            text = before + span + after
            for k, a, b in candidates(text):
                if k == kind and a < len(before) + len(span) and b > len(before):
                    x.append(features(text, kind, a, b))
                    y.append(yes and a <= len(before) and b >= len(before) + len(span))
        x, y = np.array(x, np.float64), np.array(y, np.float64)
        cut = len(y) * 2 // 3
        trees = BoostedTrees().fit(x[:cut], y[:cut])
        p, truth = trees.predict(x[cut:]), y[cut:]
        order = np.argsort(-p, kind="stable")
        precise = np.cumsum(truth[order]) / np.arange(1, len(order) + 1) >= PRECISION
        last = np.flatnonzero(precise)
        got[kind] = (trees, max(0.5, float(p[order][last[-1]])) if len(last) else 2.0)
    return got


def find(text: str | None, chosen: dict[str, tuple[BoostedTrees, float]]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans; each by kind as listed, then by place."""
    text = text or ""
    base = base_spans(text)
    by_kind: dict[str, list[tuple[int, int]]] = {}
    for kind, a, b in candidates(text):
        by_kind.setdefault(kind, []).append((a, b))
    likely = []
    for kind, spans in by_kind.items():
        trees, least = chosen[kind]
        for p, (a, b) in zip(trees.predict(np.array([features(text, kind, a, b) for a, b in spans], np.float64)), spans, strict=True):
            if p >= least:
                likely.append((-p, a, b, kind))
    taken = Taken((a, b) for _, a, b in base)
    added = [(kind, a, b) for _, a, b, kind in sorted(likely) if taken.take(a, b)]
    order = lambda s: (ALL_KINDS.index(s[0]), s[1])
    return sorted(base, key=order), sorted(base + added, key=order)


class Taken:
    """Disjoint places of a text, by start; those given at first may overlap."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def take(self, a: int, b: int) -> bool:
        """Takes the place if all of it is free."""
        i = bisect.bisect_right(self.starts, a)
        if (i and self.ends[i - 1] > a) or (i < len(self.starts) and self.starts[i] < b):
            return False
        self.starts.insert(i, a)
        self.ends.insert(i, b)
        return True


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all of them) and n_added."""
    chosen = models()
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def found(column: pd.Series) -> pd.DataFrame:
        rows = []
        for t in column:
            base, spans = find(t, chosen)
            rows.append((*[sum(s[0] == k for s in base) for k in KINDS], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    new = {"n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"}
    return docs.withColumn("__ow_p", found(F.col(text))).select(*[c for c in docs.columns if c.lower() not in new], "__ow_p.*")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each run of overlapping spans becomes one mark, named for the span that begins it."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, *, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with every span in text replaced by a mark, and n_chars, if it is there, set to the new length."""
    chosen = models()
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(column: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, find(t, chosen)[1]) for t in column], dtype=object)

    got = docs.withColumn(text, clean(F.col(text)))
    return got.withColumn(n_chars, F.length(text).cast(dict(docs.dtypes)[n_chars])) if n_chars in docs.columns else got
